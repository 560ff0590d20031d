"""Operators for preparing training text, each built by its own method."""

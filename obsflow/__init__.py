"""Spark-native hourly observation lakehouse."""

"""Leaves of documents whose schema nobody has declared.

A payload is parsed once into a VARIANT and walked by one nested expression, so that
documents of any mixture of shapes become rows of path, kind and value in a single
narrow step: no schema inference, no UDF, no shuffle.

Where values are not wanted, documents are counted by their shape, a text that Spark
makes of a VARIANT in one pass, and only the shapes that differ are walked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.operators.contract import _kind, _let

#: Levels of objects that are opened; what lies deeper stays whole, as JSON text of kind OBJECT.
LEVELS = 8

# Precisions and scales, but not within names: those with other characters are quoted.
_SIZES = r"(`[^`]*`)|\([0-9]+,[0-9]+\)"
# Names with their colon, empty objects, kinds (with the bracket they open), closing brackets.
_TOKENS = r"(?:`[^`]*+`)++: |\w++: |OBJECT<>|\w++<?|>"


def _leaf(path: Column, kind: Column, value: Column) -> Column:
    return F.array(F.struct(path.alias("path"), kind.alias("kind"), value.alias("value")))


def _value(path: Column, value: Column) -> Column:
    """One leaf. Strings are given plainly, everything else as JSON, a JSON null as NULL."""

    def of_kind(kind: Column) -> Column:
        plain = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
        return _leaf(path, kind, plain.when(kind != "VOID", F.to_json(value)))

    return _let(_kind(value), of_kind)


def _below(value: Column, path: Column, prefix: Column, whole: Sequence[str], levels: int) -> Column:
    """Leaves of a value at ``path``; those of an object that is opened begin with ``prefix``."""
    if levels == 0:
        return _value(path, value)

    def opened(entries: Column) -> Column:
        def each(entry: Column) -> Column:
            key = F.concat(prefix, entry["key"])
            return _below(entry["value"], key, F.concat(key, F.lit(".")), whole, levels - 1)

        open_it = F.size(entries) > 0
        if whole:
            open_it = open_it & ~path.isin(*whole)
        inside = F.flatten(F.transform(F.map_entries(entries), each))
        return F.when(open_it, inside).otherwise(_value(path, value))

    return _let(F.try_variant_get(value, "$", "map<string,variant>"), opened)


def leaves(text: Column, whole: Sequence[str] = (), levels: int = LEVELS) -> Column:
    """Array of (path, kind, value) of a JSON text.

    Keys are joined by dots. Arrays, empty objects and the objects at the paths of ``whole``
    (maps, whose keys are data) are leaves. Kinds are those of the contract check. Text
    that is no JSON document, or NULL, is one leaf of kind CORRUPT at the path ''.
    """
    root = F.lit("")

    def walked(document: Column) -> Column:
        return F.when(document.isNull(), _leaf(root, F.lit("CORRUPT"), text)).otherwise(
            _below(document, root, root, whole, levels)
        )

    return _let(F.try_parse_json(text), walked)


def variant_leaves(
    df: DataFrame, text: str, keep: Sequence[str] = (), whole: Sequence[str] = (), levels: int = LEVELS
) -> DataFrame:
    """One row per leaf: the ``keep`` columns, ``path``, ``kind``, ``value``."""
    return df.select(*keep, F.inline(leaves(F.col(text), whole, levels)))


def leaf_shape(text: Column) -> Column:
    """Names and kinds of all values of a JSON text, as one text; NULL if it is no JSON document.

    Documents of one shape have leaves of the same paths and kinds.
    """
    return F.regexp_replace(F.schema_of_variant(F.try_parse_json(text)), _SIZES, "$1")


def shape_leaves(shape: Column, whole: Sequence[str] = (), levels: int = LEVELS) -> Column:
    """Array of (path, kind) of the leaves of documents of a shape, as :func:`leaves` has them."""
    start = F.struct(
        F.array().cast("array<string>").alias("open"),  # of each opened object, what its paths begin with
        F.lit("").alias("path"),
        F.lit(0).alias("closed"),  # brackets open within a leaf
        F.array().cast("array<struct<path: string, kind: string>>").alias("found"),
    )

    def step(at: Column, token: Column) -> Column:
        brackets, path, closed = at["open"], at["path"], at["closed"]
        name = F.substring(token, F.lit(1), F.length(token) - 2)
        plain = F.replace(F.substring(name, F.lit(2), F.length(name) - 2), F.lit("``"), F.lit("`"))
        key = F.when(name.startswith("`"), plain).otherwise(name)
        opens, within = token.endswith("<"), closed > 0
        is_name, ends = token.endswith(": "), token == ">"
        enters = (token == "OBJECT<") & (F.size(brackets) < levels)
        if whole:
            enters = enters & ~path.isin(*whole)
        prefix = F.when(F.size(brackets) == 0, "").otherwise(F.concat(path, F.lit(".")))
        kind = F.when(token.startswith("DECIMAL") | (token == "FLOAT"), "DOUBLE").otherwise(F.substring_index(token, "<", 1))
        leaf = ~(within | is_name | ends | enters)
        return F.struct(
            F.when(within | is_name, brackets).when(ends, F.slice(brackets, F.lit(1), F.size(brackets) - 1))
            .when(enters, F.array_append(brackets, prefix)).otherwise(brackets).alias("open"),
            F.when(~within & is_name, F.concat(F.element_at(brackets, -1), key)).otherwise(path).alias("path"),
            F.when(within & opens, closed + 1).when(within & ends, closed - 1).when(leaf & opens, F.lit(1))
            .otherwise(closed).alias("closed"),
            F.when(leaf, F.array_append(at["found"], F.struct(path.alias("path"), kind.alias("kind"))))
            .otherwise(at["found"]).alias("found"),
        )

    tokens = F.regexp_extract_all(shape, F.lit(_TOKENS), F.lit(0))
    corrupt = F.array(F.struct(F.lit("").alias("path"), F.lit("CORRUPT").alias("kind")))
    return F.coalesce(F.aggregate(tokens, start, step, lambda at: at["found"]), corrupt)

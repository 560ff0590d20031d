"""Flattening of nested payloads.

The schema is walked on the driver; what runs on the executors is one
projection, which Catalyst merges with its neighbours and prunes down to the
nested fields in use.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_mapped(df: DataFrame, fields: Iterable[tuple[str, str]], keep=()) -> DataFrame:
    """Select ``(path, name)`` pairs, after the columns named in ``keep``."""
    return df.select(*keep, *[F.col(path).alias(name) for path, name in fields])


def leaf_paths(schema: T.StructType, prefix: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """Paths of all fields that are not structs; an empty struct has none."""
    for field in schema:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from leaf_paths(field.dataType, path)
        else:
            yield path


def leaf_column(path: tuple[str, ...]) -> Column:
    quoted = ".".join("`" + part.replace("`", "``") + "`" for part in path)
    return F.col(quoted).alias("_".join(path))


def flatten_leaves(df: DataFrame, branch: str | None = None) -> DataFrame:
    """Every leaf as a column named by its path; arrays and maps count as leaves.

    ``branch`` keeps the leaves below one top-level field only.
    """
    paths = leaf_paths(df.schema)
    return df.select(*[leaf_column(p) for p in paths if branch in (None, p[0])])


def rename_positional(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rename all columns by position; the number of names must fit."""
    return df.toDF(*names)


def select_identity_plus(df: DataFrame, identity: Iterable[str], measures: Iterable[str]) -> DataFrame:
    """The identity columns followed by a feed's measures."""
    return df.select(*identity, *measures)


def explode_results(df: DataFrame, array: str, out: str = "results") -> DataFrame:
    """One row per element of an array of structs, then its leaves as columns.

    A NULL or empty array yields no row.
    """
    return flatten_leaves(df.select(F.explode(array).alias(out)))


def explode_tagged(df: DataFrame, arrays: Iterable[str], tag: str, keep: Iterable[str] = ()) -> DataFrame:
    """Union-by-name of several arrays of structs held in the same row.

    Fields that an array's element lacks are NULL and ``tag`` names the array a
    row came from. The arrays are joined inside the row and exploded once, so
    the input is scanned once and not once per array.
    """
    arrays = list(arrays)
    elements = {a: df.schema[a].dataType.elementType for a in arrays}
    fields: dict[str, T.DataType] = {}
    for element in elements.values():
        for field in element:
            fields.setdefault(field.name, field.dataType)

    def aligned(array: str) -> Column:
        present = set(elements[array].names)

        def row(item: Column) -> Column:
            values = [
                (item[name] if name in present else F.lit(None)).cast(dtype).alias(name)
                for name, dtype in fields.items()
            ]
            return F.struct(F.lit(array).alias(tag), *values)

        # A NULL array would null the whole concatenation.
        return F.transform(F.coalesce(F.col(array), F.array().cast(df.schema[array].dataType)), row)

    items = F.concat(*[aligned(a) for a in arrays])
    return df.select(*keep, F.explode(items).alias("_item")).select(*keep, "_item.*")


def drop_all_empty_lists(df: DataFrame, arrays: Iterable[str]) -> DataFrame:
    """Drop rows in which every one of the arrays is empty or NULL."""
    any_filled = F.lit(False)
    for a in arrays:
        any_filled = any_filled | (F.coalesce(F.array_size(a), F.lit(0)) > 0)
    return df.where(any_filled)

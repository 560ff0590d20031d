"""How the payloads of a history depart from a declared schema.

Payloads of an hour are counted by their shape before any shape is taken apart into the
paths and kinds of its leaves, so both that work and what is shuffled follow the number of
different shapes and not that of payloads. Shapes are stored per hour and merge by adding:
the drift of any range of hours is read from them, not from payloads.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.times import hour_start
from obsflow.operators.contract import ACCEPTED
from obsflow.operators.leaves import leaf_shape, shape_leaves


def _fields(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.StructField]]:
    """All fields with their paths, structs before what they hold."""
    for field in schema:
        yield prefix + field.name, field
        if isinstance(field.dataType, T.StructType):
            yield from _fields(field.dataType, f"{prefix}{field.name}.")


def _kinds(field: T.StructField) -> list[str]:
    if isinstance(field.dataType, T.StructType):
        kinds = ["OBJECT"]  # a leaf only when it is empty
    elif isinstance(field.dataType, T.ArrayType):
        kinds = ["ARRAY"]
    else:
        kinds = list(ACCEPTED[type(field.dataType)])
    return [*kinds, "VOID"] if field.nullable else kinds


def hour_shapes(
    df: DataFrame, text: str, at: str, schema: T.StructType, by: Sequence[str] = ()
) -> DataFrame:
    """(by, hour, path, kind, payloads): in how many payloads of an hour a path has a kind."""
    maps = [path for path, field in _fields(schema) if isinstance(field.dataType, T.MapType)]
    shape, found = leaf_shape(F.col(text)), F.col("shape")
    if maps:  # their keys are data and would make every payload a shape of its own
        shape = F.array_sort(F.array_distinct(shape_leaves(shape, maps)))
    else:
        found = F.array_distinct(shape_leaves(found))
    hour = hour_start(at).alias("hour")
    counted = df.select(*by, hour, shape.alias("shape")).groupBy(*by, "hour", "shape").agg(F.count(F.lit(1)).alias("payloads"))
    return merge_shapes(counted.select(*by, "hour", F.inline(found), "payloads"), by)


def merge_shapes(shapes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Shapes of several batches, one row per hour, path and kind."""
    return shapes.groupBy(*by, "hour", "path", "kind").agg(F.sum("payloads").alias("payloads"))


def _change(schema: T.StructType) -> Column:
    accepted = {"": ["OBJECT"]} | {path: _kinds(field) for path, field in _fields(schema)}
    listed = F.create_map(*(part for path, kinds in accepted.items() for part in (F.lit(path), F.lit(kinds))))
    kinds = F.try_element_at(listed, F.col("path"))
    return (
        F.when(F.col("kind") == "CORRUPT", "corrupt").when(kinds.isNull(), "new")
        .when(~F.array_contains(kinds, F.col("kind")), "retyped")
    )


def schema_drift(shapes: DataFrame, schema: T.StructType, by: Sequence[str] = ()) -> DataFrame:
    """One row per departure: the ``by`` columns, path, kind, change, first_hour, last_hour, hours, payloads.

    ``new``: a path that is not declared. ``retyped``: a declared one with a kind it does not
    accept. ``lost``: a declared leaf that no payload of an hour holds, not even as null
    (kind NULL, payloads 0). ``corrupt``: no JSON document. ``hours`` counts the hours from
    the first to the last in which it is so. A leaf that turned into an object is lost and
    its parts are new. ``shapes`` has one row per hour, path and kind; no shapes: no rows.
    """
    spans = (F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"), F.count(F.lit(1)).alias("hours"))
    departed = (
        shapes.withColumn("change", _change(schema)).where("change IS NOT NULL")
        .groupBy(*by, "path", "kind", "change").agg(*spans, F.sum("payloads").alias("payloads"))
    )
    declared = [path for path, field in _fields(schema) if not isinstance(field.dataType, T.StructType)]
    # Of an hour's paths only declared ones are gathered, however many others it has.
    held = F.collect_set(F.when(F.col("path").isin(declared), F.col("path")))
    absent = shapes.groupBy(*by, "hour").agg(F.array_except(F.lit(declared), held).alias("paths"))
    lost = (
        absent.select(*by, "hour", F.explode("paths").alias("path")).groupBy(*by, "path").agg(*spans)
        .withColumns({"kind": F.lit(None).cast("string"), "change": F.lit("lost"), "payloads": F.lit(0).cast("long")})
    )
    return departed.unionByName(lost)

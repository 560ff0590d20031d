"""Reading landed payloads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.documents import map_to_rows
from obsflow.schemas import HOUR_BUCKET

CORRUPT = "_corrupt_record"
# Spark's folder name for a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Characters that Spark writes as %XX in a folder name. Fixed value.
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def scan_json(
    spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = True
) -> DataFrame:
    """Read every JSON document of a folder with its declared schema.

    A document that does not parse becomes a row with its text in
    ``_corrupt_record``. Files written one document per line should be read with
    ``multi_line=False``: such files can be split between tasks.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    # The limit shows the optimizer that there is nothing to join or shuffle.
    return spark.createDataFrame([], schema).limit(0)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, fmt: str = "parquet"
) -> DataFrame:
    """Read a table; one that was never written is empty if a schema is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _empty(spark, schema)


def partition_folder(by: Sequence[str], values: Sequence) -> str:
    """Folder of one partition, named as Spark's writer names it."""
    escaped = lambda v: "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in str(v))
    return "/".join(
        f"{c}={NULL_PARTITION if v is None or v == '' else escaped(v)}" for c, v in zip(by, values)
    )


def read_partition(
    spark: SparkSession, root: str, schema: T.StructType, by: Sequence[str], values: Sequence, *, fmt: str = "parquet"
) -> DataFrame | None:
    """Read one partition from its folder, without listing the rest of the table; None if it does not exist."""
    reader = spark.read.schema(schema).option("basePath", root).format(fmt)
    try:
        return reader.load(f"{root}/{partition_folder(by, values)}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_hour_bucket(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    method: str,
    when: datetime,
    *,
    strict: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """Read one hour bucket from its folder.

    What an hourly run costs does not grow with the history kept that way.
    ``schema`` names the partition columns too.
    """
    bucket = (method, when.year, when.month, when.day, when.hour)
    found = read_partition(spark, root, schema, HOUR_BUCKET, bucket, fmt=fmt)
    if found is None and strict:
        raise ValueError(f"no data landed for {method} in the hour of {when:%Y-%m-%d %H}:00")
    return _empty(spark, schema) if found is None else found


def hour_bucket_scan(
    landed: DataFrame, method: str, when: datetime, *, strict: bool = False
) -> DataFrame:
    """The rows of one method's hour bucket; the filter is on partition columns only.

    A missing bucket has no rows; with ``strict`` it raises instead.
    """
    bucket = landed.where(
        (F.col("method") == method)
        & (F.col("year") == when.year)
        & (F.col("month") == when.month)
        & (F.col("day") == when.day)
        & (F.col("hour") == when.hour)
    )
    if strict and bucket.isEmpty():
        raise ValueError(f"no data landed for {method} in the hour of {when:%Y-%m-%d %H}:00")
    return bucket


def read_city_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``country -> city`` as rows (country, city).

    A country with several cities has them under keys with a digit at the end.
    """
    text = spark.read.text(path, wholetext=True)
    return map_to_rows(text, "value", "country", "city")


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Read a dimension from a relational database (needs the driver's jar)."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()

"""The last payload of each key, kept in the state of a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.sinks.deltas import DeltaTable
from obsflow.sources.landing import CORRUPT


def _landed(spark, landing, schema, multi_line, max_files_per_batch) -> DataFrame:
    return (
        spark.readStream.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .option("maxFileAge", "36500d")
        .json(landing)
        .withColumn("_file", F.input_file_name())
    )


def stream_latest(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    table: DeltaTable,
    checkpoint: str,
    *,
    plan: Callable[[DataFrame], DataFrame],
    arrivals: str = "1 hour",
    delay: str = "10 minutes",
    multi_line: bool = True,
    max_files_per_batch: int = 10_000,
) -> None:
    """Run ``plan`` over the files that have landed since the last call and append what is new to ``table``.

    The state holds the last row of each of the table's keys, by its ``latest`` columns, for
    an arrival window: a batch emits only keys whose last row has changed, and reads
    nothing of the hours it touches. The watermark is on the time of arrival, which the
    stream records per batch, and not on that of the payload. So no payload is ever too
    late, however old its hour, while the state stays bounded by what arrives in
    ``arrivals`` and ``delay``; a key that comes again after its state is gone is emitted
    again, and the table settles it on reading. The same holds for files that come
    twice, for a batch repeated after a failure and for a new checkpoint.

    Documents that do not parse are left to ``set_aside_corrupt``.
    """
    rows = plan(_landed(spark, landing, schema, multi_line, max_files_per_batch).where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file"))
    rows = rows.select(*table.schema.names).withColumn("_arrived", F.current_timestamp())
    last = (
        rows.withWatermark("_arrived", delay)
        .groupBy(F.window("_arrived", arrivals).alias("_window"), *table.keys)
        .agg(F.max_by(F.struct(*table.schema.names), F.struct(*table.latest)).alias("_row"))
    )

    def add(batch: DataFrame, number: int) -> None:
        table.append(batch.select("_row.*"))

    (
        last.writeStream.outputMode("update").foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def set_aside_corrupt(
    spark: SparkSession, landing: str, schema: T.StructType, path: str, checkpoint: str,
    *, multi_line: bool = True, max_files_per_batch: int = 10_000,
) -> None:
    """Write landed documents that do not parse, with the file they came from, each once; a folder per batch."""

    def add(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # a corrupt column alone cannot be read from the files
        try:
            corrupt = batch.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, F.col("_file").alias("file"))
            if not corrupt.isEmpty():
                corrupt.write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            batch.unpersist()

    (
        _landed(spark, landing, schema, multi_line, max_files_per_batch).writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )

"""Loading only what has landed since the last run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.plans.feeds import current_feed
from obsflow.schemas import HOUR_BUCKET
from obsflow.sinks.tables import merge_rows
from obsflow.sources.landing import CORRUPT


def incremental_load(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    *,
    plan: Callable[[DataFrame], DataFrame] = current_feed,
    keys: Sequence[str],
    order: Sequence[Column],
    by: Sequence[str] = HOUR_BUCKET,
    set_aside: str | None = None,
    multi_line: bool = True,
    max_files_per_batch: int = 10_000,
) -> None:
    """Run ``plan`` over the files that have landed since the last call, then stop.

    The checkpoint remembers which files are done, however old they are. What ``plan``
    returns is merged into ``target``: per ``keys`` the first row in ``order`` stays, and
    only the partitions ``by`` that a batch touches are written again. A landing that
    rewrites its files, or a batch repeated after a failure, therefore changes nothing.

    Documents that do not parse are appended to ``set_aside`` (default: ``target`` with
    ``-corrupt``), one folder per batch, with the file they came from.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    aside = set_aside or f"{target}-corrupt"
    landed = (
        spark.readStream.schema(with_corrupt)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .option("maxFileAge", "36500d")
        .json(landing)
        .withColumn("_file", F.input_file_name())
    )

    def load(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # a corrupt column alone cannot be read from the files
        try:
            corrupt = batch.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, F.col("_file").alias("file"))
            if not corrupt.isEmpty():
                corrupt.write.mode("overwrite").parquet(f"{aside}/batch={number}")
            rows = plan(batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file"))
            merge_rows(rows, target, by, [*by, *keys], order)
        finally:
            batch.unpersist()

    (
        landed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )

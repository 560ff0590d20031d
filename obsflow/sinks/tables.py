"""Writing tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obsflow.functions.text import empty_to_null
from obsflow.functions.times import minute_bucket, with_hour_bucket
from obsflow.operators.latest import first_per_key
from obsflow.operators.lookup import BROADCAST_BYTES, measured_bytes
from obsflow.schemas import HOUR_BUCKET
from obsflow.scratch import remove
from obsflow.sources.landing import read_table

#: Rows of one partition that the optimizer takes for smaller are gathered before they are written.
#: Larger ones stay where they are, in no more files than so much fills or there are cores.
GATHERED_BYTES = 32 << 20


def _for_one_partition(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Few rows in files of the advisory size; many without a shuffle, tasks of little put together."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size < GATHERED_BYTES:
        return df.hint("rebalance", *by)
    files = max(size // GATHERED_BYTES, df.sparkSession.sparkContext.defaultParallelism)
    return df.coalesce(files) if files < 2**31 else df  # a frame of unknown size has the largest number


def _partition_folder(df: DataFrame, path: str, partition: Mapping[str, object]) -> str:
    """Where Spark keeps a partition of a table, values escaped as it does."""
    named = df.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([path, *[named(c, None if v is None else str(v)) for c, v in partition.items()]])


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(at(target), True)
    files.mkdirs(at(target).getParent())
    if not files.rename(at(source), at(target)):
        raise OSError(f"{source} could not be moved to {target}")


def _replace_partition(df: DataFrame, path: str, partition: Mapping[str, object], fmt: str) -> int:
    """Write a frame as one partition of a table, as a dynamic overwrite does, but without its sort.

    Spark sorts the rows of each task by the partition columns, and what a task cannot
    hold of them goes to disk, though here all rows have the same values. They are
    written to a hidden folder of the table and take the partition's place once all are
    there. No rows leave it as it is. A row of another partition fails the write.
    """
    path, spark, written = path.rstrip("/"), df.sparkSession, Observation()
    elsewhere = F.lit(False)
    for name, value in partition.items():
        elsewhere = elsewhere | ~F.col(name).eqNullSafe(F.lit(value))
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(elsewhere).alias("elsewhere")]
    fresh, there = f"{path}/.fresh-{uuid.uuid4().hex}", _partition_folder(df, path, partition)
    try:
        writer = df.observe(written, *counts).drop(*partition).write.format(fmt)
        if fmt == "parquet":
            writer = writer.option("compression", "zstd")  # two thirds of the default's size, in the same time
        writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").save(fresh)
        rows, strays = written.get["rows"], written.get["elsewhere"]
        if strays:
            raise ValueError(f"{strays} rows do not belong to {there}")
        if rows:
            _move(spark, fresh, there)
    finally:
        remove(spark, fresh)
    return rows


def write_hour_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str] = HOUR_BUCKET,
    *,
    sort_by: Sequence[str] = (),
    fmt: str = "parquet",
    gathered: bool = False,
    only: Mapping[str, object] | None = None,
) -> int:
    """Write a partitioned table, replacing the partitions the frame has rows for.

    Rebalancing gathers a partition's rows into files of the advisory size and
    splits a partition that holds far more than that over several tasks. Returns the
    number of rows written. They are observed after the shuffle, in the tasks that write:
    of those each counts once, also when lost ones run again.

    With ``gathered`` rows are written as they lie, without that shuffle: for rows of one
    partition that come from another shuffle, or from files of a good size.

    ``only``: the values of ``by``, where all rows belong to one partition. Then rows are
    not sorted by it, and shuffled only where they are few.
    """
    if only is not None:
        laid_out = df if gathered else _for_one_partition(df, by)
        if sort_by:
            laid_out = laid_out.sortWithinPartitions(*sort_by)
        return _replace_partition(laid_out, path, {c: only[c] for c in by}, fmt)
    written = Observation()
    laid_out = df if gathered else df.hint("rebalance", *by)
    if sort_by:
        laid_out = laid_out.sortWithinPartitions(*by, *sort_by)
    laid_out = laid_out.observe(written, F.count(F.lit(1)).alias("rows"))
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .format(fmt)
        .save(path)
    )
    return written.get["rows"]


def _touched(batch: DataFrame, by: Sequence[str]) -> DataFrame:
    return batch.select(*by).distinct()


def _stored_rows(
    batch: DataFrame, path: str, by: Sequence[str], fmt: str, touched: DataFrame | None = None
) -> DataFrame:
    """Stored rows of the partitions a batch touches; ``by`` is the method, then the time.

    The table is read with its declared schema. Bounds on the time prune its partitions,
    whatever their number, and the touched ones are matched by value: names of folders
    play no part, so any text can be a method.
    """
    spark = batch.sparkSession
    touched = _touched(batch, by) if touched is None else touched
    time = F.struct(*by[1:])
    first, last, size = touched.agg(F.min(time), F.max(time), F.count(F.lit(1))).first()
    stored = read_table(spark, path, batch.schema, fmt=fmt)
    if size == 0:
        return stored.limit(0)
    bound = lambda row: F.struct(*[F.lit(v).cast("int").alias(c) for c, v in row.asDict().items()])
    stored = stored.where(time.between(bound(first), bound(last)))
    same = [F.col(f"stored.{c}").eqNullSafe(F.col(f"touched.{c}")) for c in by]
    if measured_bytes(touched) <= BROADCAST_BYTES:
        touched = F.broadcast(touched)
    return stored.alias("stored").join(touched.alias("touched"), same, "left_semi")


def merge_rows(
    batch: DataFrame,
    path: str,
    by: Sequence[str],
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    sort_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Bring a batch into a partitioned table: its rows replace those with the same keys.

    Only the partitions the batch has rows for are read and written again.
    """
    batch = batch.select(*[c for c in batch.columns if c not in by], *by)
    # Bounded, measured and joined: kept, so that the batch is not computed for each of these.
    touched = _touched(batch, by).persist()
    try:
        stored = _stored_rows(batch, path, by, fmt, touched)
        rows = batch.withColumn("_age", F.lit(0)).unionByName(stored.withColumn("_age", F.lit(1)))
        kept = first_per_key(rows, keys, [F.asc("_age"), *order]).drop("_age")
        write_hour_partitions(kept, path, by, sort_by=sort_by, fmt=fmt)
    finally:
        touched.unpersist()


def land_raw(
    payloads: DataFrame,
    path: str,
    *,
    method: str = "method",
    city: str = "city",
    ts: str = "ingest_ts",
    tie: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Land payloads in hour buckets; within one, the last payload of a requested city stays.

    An empty method is stored as NULL, which is what a partition's folder makes of it.
    """
    bucketed = with_hour_bucket(payloads, empty_to_null(F.col(method)), F.col(ts))
    order = [F.desc_nulls_last(c) for c in (ts, *tie)]
    merge_rows(bucketed, path, HOUR_BUCKET, [*HOUR_BUCKET, city], order, fmt=fmt)


def land_raw_minute(
    payloads: DataFrame,
    path: str,
    *,
    method: str = "method",
    city: str = "city",
    ts: str = "ingest_ts",
    tie: Sequence[str] = (),
) -> None:
    """Land payloads per minute bucket: the last payload of a city and minute stays.

    The minute is a column the files are sorted by, not a folder: a folder per
    minute would leave files of a few rows, while the files' statistics skip
    other minutes just as well.
    """
    bucketed = with_hour_bucket(payloads, empty_to_null(F.col(method)), F.col(ts)).withColumn(
        "minute_bucket", minute_bucket(F.col(ts))
    )
    order = [F.desc_nulls_last(c) for c in (ts, *tie)]
    by = ["method", "year", "month", "day"]
    keys = [*by, "minute_bucket", city]
    merge_rows(bucketed, path, by, keys, order, sort_by=["minute_bucket"])


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Append to a table of a relational database (needs the driver's jar)."""
    df.write.mode("append").format("jdbc").options(url=url, dbtable=table, **options).save()

"""Landing without rewriting: batches are appended, the last write is found on reading.

A table is two folders with the same partitions. ``deltas`` only grows: a landing adds its
own rows as new files and reads nothing. ``base`` holds one row per key of partitions that
were compacted. Reading passes partitions without deltas through as they are; in the others
the last row of each key stays, by the payload's own time and tie, so the order in which
batches come, or come again, plays no part. Compaction takes a bounded number of closed
partitions, the oldest first, merges their deltas into their base and removes the files it
has read, and no others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.text import empty_to_null
from obsflow.functions.times import minute_bucket, naive_run_ts, with_hour_bucket
from obsflow.operators.latest import first_per_key
from obsflow.operators.lookup import BROADCAST_BYTES, measured_bytes
from obsflow.schemas import BUCKET_FIELDS, HOUR_BUCKET
from obsflow.scratch import remove
from obsflow.sinks.tables import write_hour_partitions
from obsflow.sources.landing import partition_folder, read_table

DAY_BUCKET = HOUR_BUCKET[:-1]


def _all_equal(a: str, b: str, columns: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return same


@dataclass(frozen=True)
class DeltaTable:
    """``schema`` has the partition columns ``by`` (the method, then the time) at its end.

    Per ``keys``, which hold ``by``, the row with the largest ``latest`` columns stays,
    NULL last. Rows that agree in all of these are the same payload landed again.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    by: tuple[str, ...]
    keys: tuple[str, ...]
    latest: tuple[str, ...]

    @property
    def base(self) -> DataFrame:
        return read_table(self.spark, f"{self.path}/base", self.schema)

    @property
    def deltas(self) -> DataFrame:
        return read_table(self.spark, f"{self.path}/deltas", self.schema)

    def append(self, rows: DataFrame) -> None:
        """Add a batch. What is written is the batch, whatever the table holds; what is read of the table is nothing."""
        rows.select(*self.schema.names).hint("rebalance", *self.by).write.mode("append").partitionBy(*self.by).parquet(
            f"{self.path}/deltas"
        )

    def _last(self, rows: DataFrame) -> DataFrame:
        return first_per_key(rows, self.keys, [F.desc_nulls_last(c) for c in self.latest])

    def read(self, condition: Column | None = None) -> DataFrame:
        """The table's rows; ``condition`` may use the partition columns, and prunes both folders."""
        base, deltas = self.base, self.deltas
        if condition is not None:
            base, deltas = base.where(condition), deltas.where(condition)
        touched = deltas.select(*self.by).distinct()
        if measured_bytes(touched) <= BROADCAST_BYTES:
            touched = F.broadcast(touched)
        same = _all_equal("base", "touched", self.by)
        by_touch = lambda how: base.alias("base").join(touched.alias("touched"), same, how)
        return by_touch("left_anti").unionByName(self._last(by_touch("left_semi").unionByName(deltas)))

    def compact(self, until: datetime, most: int = 100) -> int:
        """Merge the deltas of up to ``most`` partitions that lie wholly before ``until``; returns their number.

        Deltas that land meanwhile stay for the next time. A run that broke off is repeated:
        until its files are removed their rows only say again what the base holds. A reader
        that listed the files before they were removed has to list them again.
        """
        until = naive_run_ts(until)
        time = self.by[1:]
        bound = F.struct(*[F.lit(getattr(until, c)).alias(c) for c in time])
        closed = self.deltas.select(*self.by).distinct().where(F.struct(*time) < bound)
        chosen = closed.orderBy(*time, self.by[0]).limit(most).collect()  # ``most`` rows
        if not chosen:
            return 0
        files = [f for row in chosen for f in self._files(f"{self.path}/deltas/{partition_folder(self.by, row)}")]
        deltas = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/deltas").parquet(*files)
        # Bounds on the time prune the base's partitions; the chosen ones are matched by value.
        bounds = [F.struct(*[F.lit(row[c]).cast("int").alias(c) for c in time]) for row in (chosen[0], chosen[-1])]
        these = self.spark.createDataFrame(chosen, deltas.select(*self.by).schema)
        stored = self.base.where(F.struct(*time).between(*bounds)).alias("base")
        stored = stored.join(F.broadcast(these.alias("these")), _all_equal("base", "these", self.by), "left_semi")
        write_hour_partitions(self._last(stored.unionByName(deltas)), f"{self.path}/base", self.by)
        for f in files:
            remove(self.spark, f)
        return len(chosen)

    def _files(self, folder: str) -> list[str]:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        listed = there.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(there)
        found = [s.getPath() for s in listed]
        return [p.toString() for p in found if not p.getName().startswith(("_", "."))]


@dataclass(frozen=True)
class Landing:
    """A landing of payloads as a DeltaTable; see ``hour_landing`` and ``minute_landing``."""

    table: DeltaTable
    method: str
    ts: str

    def land(self, payloads: DataFrame) -> None:
        """Append a batch of payloads. An empty method is stored as NULL."""
        rows = with_hour_bucket(payloads, empty_to_null(F.col(self.method)), F.col(self.ts))
        self.table.append(rows.withColumn("minute_bucket", minute_bucket(F.col(self.ts))))


def _landing(spark, path, payloads, by, unit, method, city, ts, tie) -> Landing:
    kinds = dict(BUCKET_FIELDS)
    own = [f for f in payloads.fields if f.name not in HOUR_BUCKET]
    extra = [T.StructField("minute_bucket", T.StringType()), *[T.StructField(c, kinds[c]) for c in HOUR_BUCKET if c not in by]]
    schema = T.StructType([*own, *extra, *[T.StructField(c, kinds[c]) for c in by]])
    keys = tuple(dict.fromkeys((*by, *unit, city)))
    return Landing(DeltaTable(spark, path, schema, tuple(by), keys, (ts, *tie)), method, ts)


def hour_landing(
    spark: SparkSession, path: str, payloads: T.StructType, *, method: str = "method", city: str = "city",
    ts: str = "ingest_ts", tie: Sequence[str] = (), by: Sequence[str] = HOUR_BUCKET,
) -> Landing:
    """Of a requested city the last payload of an hour stays. ``payloads``: schema of what is landed.

    ``by``: HOUR_BUCKET or, where batches reach over many hours, DAY_BUCKET.
    """
    return _landing(spark, path, payloads, by, HOUR_BUCKET, method, city, ts, tie)


def minute_landing(
    spark: SparkSession, path: str, payloads: T.StructType, *, method: str = "method", city: str = "city",
    ts: str = "ingest_ts", tie: Sequence[str] = (),
) -> Landing:
    """Of a requested city the last payload of a minute stays; partitions are days, the minute is a column."""
    return _landing(spark, path, payloads, DAY_BUCKET, ("minute_bucket",), method, city, ts, tie)

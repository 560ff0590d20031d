"""Where intermediate tables go.

The folder is the one the cluster names in ``spark.checkpoint.dir``, which every
executor can reach. Only a local session without that setting gets a temporary
folder of this machine.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="obsflow-")


# Paths given out inside each open ``temporary`` block.
_open_blocks: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for one intermediate table."""
    path = f"{scratch_root(spark).rstrip('/')}/obsflow/{label}-{uuid.uuid4().hex}"
    for block in _open_blocks:
        block.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table that this library has written to scratch and that nothing reads any more."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what this library writes to scratch inside the block.

    Only the paths given out inside are removed. Frames that read them must have been
    written or counted before the block ends.
    """
    made: list[str] = []
    _open_blocks.append(made)
    try:
        yield
    finally:
        _open_blocks.remove(made)
        for path in made:
            remove(spark, path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as a table and read it back: its rows are fixed from here on."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

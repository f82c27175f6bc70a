"""Reading the input tables, and the folder that all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class _Made(threading.local):
    """The tables that this thread has saved: operators in other threads have theirs."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_made = _Made()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="genospark-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset, a temporary one of this process in local mode, as in tests; on a cluster an error, since executors don't share the driver's folders."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (found or _own_dir()).rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """df written as a table in the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}.parquet"
    _made.paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables saved inside are deleted at the end, but for those that went through what it gives: keep(df) -> saved table."""
    first, kept = len(_made.paths), set()

    def keep(df: DataFrame) -> DataFrame:
        out = saved(df)
        kept.add(_made.paths[-1])
        return out

    try:
        yield keep
    finally:
        for path in _made.paths[first:]:
            if path not in kept:
                p = spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        del _made.paths[first:]


def bucket_of(column, modulus: int):
    """crc32 of the id as text, modulo: the split into training and held-out rows."""
    return F.crc32(F.col(column).cast("string")) % modulus


def in_small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows of this subpackage are whole texts: Arrow batches of Spark's default 10,000 rows would hold tens of MB each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))

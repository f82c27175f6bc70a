"""The folder that driver and executors share, tables in it, and which tables are small enough to be sent to every task."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table of a row per sample, rule or file is broadcast.
FEW = 100_000


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="genospark-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset: a temporary one of this process in local mode, as in tests; on a cluster an error, since executors don't share the driver's folders."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (found or _own_dir()).rstrip("/")


class Shelf:
    """Tables in the shared folder. Each shelf knows its own, so that threads don't meet; leaving a `with` block deletes them, but for the kept ones."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def put(self, df: DataFrame, keep: bool = False) -> DataFrame:
        """df written and read again: cuts the lineage, and no lost executor takes it along."""
        path = f"{shared_dir(self.spark)}/{uuid.uuid4().hex}.parquet"
        if not keep:
            self.paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Shelf:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self.paths.clear()


def few(df: DataFrame, most: int = FEW) -> DataFrame:
    """df, to be broadcast if it has `most` rows at most; else as it is, and Spark joins it by a shuffle. df is counted, so it should be cheap or stored."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def few_met(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rows of table whose key is among those of rows, to be broadcast if they are few: a table of very many samples doesn't deal rows by the few samples that these have, each to one task. rows is read once more for its keys."""
    shelf = Shelf(rows.sparkSession)
    keys = shelf.put(rows.select(key).distinct(), keep=True)
    return few(shelf.put(table.join(few(keys), key, "left_semi"), keep=True))

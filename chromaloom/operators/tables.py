"""Intermediate results as Parquet tables in the folder that the cluster shares.

A written table cuts lineage, survives the loss of executors, is scanned with column pruning, and
its rows are counted from file footers.
"""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch that written tables hand to Python at most (one row more at least).
BATCH_BYTES = 1 << 20

_opened: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: that of ``spark.checkpoint.dir``.

    Where it is unset, a single-machine session gets a folder of its own; a cluster raises an error,
    since executors would write to disks that others do not see.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir names no folder that all executors of {master} share")
        base = f"/tmp/checkpoints/{os.getpid()}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _sweep() -> None:
    for spark, path in _opened:
        if getattr(spark.sparkContext, "_jsc", None) is not None:
            _delete(spark, path)


def _bounded(df: DataFrame):
    """``df`` planned in a clone of its session, in which batches to Python are bounded by bytes.

    The settings of the user's session stay as they are, also while the job runs.
    """
    clone = df.sparkSession._jsparkSession.cloneSession()
    clone.conf().set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    plan = df._jdf.queryExecution().logical()
    return df.sparkSession._jvm.org.apache.spark.sql.classic.Dataset.ofRows(clone, plan)


class Workspace:
    """A folder of Parquet tables below the shared folder, removed when Python ends."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
        _opened.append((spark, self.path))

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it again: its lineage ends here."""
        at = f"{self.path}/{name}"
        _bounded(df).write().mode("overwrite").parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self.spark, f"{self.path}/{name}")

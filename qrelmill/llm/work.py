"""Shared work folder: intermediate tables that cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (or set on the context).

    Only a single-process session without either gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = current.get() if current.isDefined() else None
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="qrelmill-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


# Spark removes the shuffle files of a plan when it ends, not when the driver's garbage collector
# finds them unused: until then they would stand on disk beside those of all later plans.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside leave no shuffle files."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Work:
    """Tables of one operator call, below a folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table; only that stays of the work."""
        with shuffles_removed(self.spark):
            df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Remove tables that no result reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``, one row at least,
    so that a task's memory does not follow the number of rows in a batch."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // limit
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else []
        ends = [*starts[1:], batch.num_rows]
        for start, end in zip(starts, ends, strict=True):
            yield batch.slice(start, end - start)

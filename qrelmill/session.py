"""Session settings and small run-time helpers shared by every job."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Broadcasting is always decided on a measured size; above this many bytes a
# side is never collected, whatever its row count.
BROADCAST_BYTES = 64 * 1024 * 1024

# Tasks behind a shuffle are laid together up to TASK_BYTES, and exchanges of large inputs
# start with one partition for each INPUT_BYTES of input files, so the memory of a task does
# not grow with the tables.
TASK_BYTES = 16 * 1024 * 1024
INPUT_BYTES = 16 * 1024 * 1024

FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A JSON object that repeats a key keeps the last value, as json.loads does.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on to a session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def sized(spark: SparkSession, paths: Iterable[str]) -> int:
    """Let exchanges start with enough partitions for the files at ``paths``, never with
    fewer than the session asks for; the number of partitions they start with."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    folders = [hadoop.Path(p) for p in paths]
    wanted = -(-sum(f.getFileSystem(conf).getContentSummary(f).getLength() for f in folders) // INPUT_BYTES)
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > asked:
        spark.conf.set(FIRST_PARTITIONS, wanted)
    else:
        spark.conf.unset(FIRST_PARTITIONS)
    return max(wanted, asked)


def build_session(app: str = "qrelmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: that of ``spark.checkpoint.dir``
    or of the context, else the warehouse. Never a machine-local temporary one."""
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or (current.get() if current.isDefined() else None)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the shared folder: computed once, read by every later
    step, and still there when an executor is lost. The folder is the caller's to
    clear once the results that read it are stored."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

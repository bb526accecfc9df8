"""Live task state from the append-only audit log.

Each micro-batch is folded on its own and written under its batch number, so a
replayed batch overwrites itself and the cost of a batch does not grow with the
state. Folds merge in any order; every ``compact_every`` batches they are merged
into one base, and the folds and bases behind it are removed.

Counts per status are kept as signed changes: the stream remembers the last event
of every task, and when a later one arrives it takes the task out of its old
status and adds it to the new. A batch writes the sums of its own changes, so that
neither the task state nor earlier counts are read for it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.tasks import RUNNING, audit_status_counts, fold_audit, merge_states
from ..schemas import AUDIT_EVENTS

LAST_EVENT = "seq bigint, dataset string, stage string, status string"
CHANGES = "dataset string, stage string, status string, n bigint"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _complete(spark: SparkSession, path: str) -> dict[str, int]:
    """Finished folds below ``path`` by folder name, with their number: one
    listing finds the marks that Spark leaves in finished folders."""
    jvm, root, fs = _folder(spark, path)
    if not fs.exists(root):
        return {}
    marks = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/*-*/_SUCCESS"))
    names = [m.getPath().getParent().getName() for m in marks]
    return {n: int(n.split("-")[1]) for n in names}


def _prune(spark: SparkSession, path: str, base: int) -> None:
    """Remove what the finished base of batch ``base`` replaces."""
    jvm, _, fs = _folder(spark, path)
    for name, number in _complete(spark, path).items():
        if number < base or (number == base and name.startswith("batch-")):
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)


def _parts(spark: SparkSession, path: str, upto: int | None = None) -> list[str]:
    found = {n: b for n, b in _complete(spark, path).items() if upto is None or b <= upto}
    bases = [b for n, b in found.items() if n.startswith("base-")]
    base = max(bases) if bases else -1
    parts = [f"{path}/base-{base}"] if bases else []
    return parts + [f"{path}/{n}" for n, b in found.items() if n.startswith("batch-") and b > base]


def read_state(spark: SparkSession, state_path: str, upto: int | None = None) -> DataFrame | None:
    """The current task state, or None before the first batch."""
    parts = _parts(spark, state_path, upto)
    if not parts:
        return None
    folds = spark.read.parquet(*parts)
    return merge_states(folds, folds.limit(0))


def read_counts(spark: SparkSession, counts_path: str) -> DataFrame | None:
    """Tasks per (dataset, stage, status) now, or None before the first batch."""
    parts = _parts(spark, counts_path)
    return _added(spark.read.schema(CHANGES).parquet(*parts)) if parts else None


def _added(changes: DataFrame) -> DataFrame:
    return changes.groupBy("dataset", "stage", "status").agg(F.sum("n").alias("n")).where("n <> 0")


def stream_fold_audit(
    spark: SparkSession,
    log_path: str,
    state_path: str,
    checkpoint: str,
    compact_every: int = 50,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the folded state of the JSON log at ``log_path`` current."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fold_audit(batch).write.mode("overwrite").parquet(f"{state_path}/batch-{batch_id}")
        # A replayed batch finds its base finished and must not read and replace it.
        if (batch_id + 1) % compact_every == 0 and f"base-{batch_id}" not in _complete(session, state_path):
            state = read_state(session, state_path, batch_id)
            state.write.mode("overwrite").parquet(f"{state_path}/base-{batch_id}")
            _prune(session, state_path, batch_id)

    return _started(spark.readStream.schema(AUDIT_EVENTS).json(log_path).writeStream.foreachBatch(fold), checkpoint, available_now)


def _started(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def status_counts(state: DataFrame) -> DataFrame:
    """Tasks per (dataset, stage, status) of a whole state."""
    return state.groupBy("dataset", "stage", "status").count().withColumnRenamed("count", "n")


def _signed(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What the new events of one task change: -1 where it was, +1 where it is."""
    before = now = tuple(state.get) if state.exists else None
    for frame in frames:
        for seq, *place in zip(frame["seq"], frame["dataset"], frame["stage"], frame["status"], strict=True):
            if now is None or seq > now[0]:
                now = (int(seq), *place)
    if now != before:
        state.update(now)
    rows = [(*now[1:], 1)] if before is None else [] if now[1:] == before[1:] else [(*before[1:], -1), (*now[1:], 1)]
    yield pd.DataFrame(rows, columns=["dataset", "stage", "status", "n"])


def status_changes(events: DataFrame) -> DataFrame:
    """Signed changes of the counts (dataset, stage, status, n) by a stream of audit
    events. Replayed and late events change nothing: the highest ``seq`` decides."""
    status = F.when(F.col("kind") == "finish", F.col("status")).otherwise(RUNNING)
    last = events.where("seq IS NOT NULL").select("task_id", "seq", "dataset", "stage", status.alias("status"))
    return last.groupBy("task_id").applyInPandasWithState(_signed, CHANGES, LAST_EVENT, "update", GroupStateTimeout.NoTimeout)


def stream_status_counts(
    spark: SparkSession, log_path: str, counts_path: str, checkpoint: str, compact_every: int = 50, available_now: bool = True
) -> StreamingQuery:
    """Keep the counts (``read_counts``) of the JSON log at ``log_path`` current."""

    def add(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        _added(batch).write.mode("overwrite").parquet(f"{counts_path}/batch-{batch_id}")
        if (batch_id + 1) % compact_every == 0 and f"base-{batch_id}" not in _complete(session, counts_path):
            parts = _parts(session, counts_path, batch_id)
            _added(session.read.schema(CHANGES).parquet(*parts)).write.mode("overwrite").parquet(f"{counts_path}/base-{batch_id}")
            _prune(session, counts_path, batch_id)

    changes = status_changes(spark.readStream.schema(AUDIT_EVENTS).json(log_path))
    return _started(changes.writeStream.foreachBatch(add).outputMode("update"), checkpoint, available_now)


__all__ = [
    "audit_status_counts",
    "read_counts",
    "read_state",
    "status_changes",
    "status_counts",
    "stream_fold_audit",
    "stream_status_counts",
]

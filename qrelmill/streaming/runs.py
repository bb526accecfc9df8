"""Task runs that can be stopped at any point and taken up again.

The tasks of a plan are stored once, as files of at most ``batch_tasks`` tasks. A
stream reads one file per micro-batch, and its checkpoint says which batches
are closed. A batch logs that its tasks start, sends them, stores their results and logs
that they finished, in this order and each as one committed write. A run that was
stopped, by an error or with its machine, goes on behind the last closed batch: of all
tasks, only those of the open batch are sent again, and not even those if their
results are stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.tasks import Wording, run_tasks, skipped_results
from ..schemas import TASK_RESULTS
from ..sources.sinks import append_task_log, append_task_starts

PLANNED = (
    "task_id string, dataset string, stage string, `system` string, `user` string, expected_json boolean, "
    "skipped boolean, status string, attempts int, result string, raw_response string"
)


def _stored(spark: SparkSession, pattern: str) -> list[str]:
    """The folders below ``pattern`` whose write was committed."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(mark)
    return [m.getPath().getParent().toString() for m in found or []]


def store_plan(plan: DataFrame, path: str, batch_tasks: int) -> None:
    """Store the tasks of ``plan`` below ``path``, unless an earlier call did. A task that
    is planned twice is stored once."""
    spark = plan.sparkSession
    once = plan.select(*spark.createDataFrame([], PLANNED).columns).dropDuplicates(["task_id"])
    if not _stored(spark, f"{path}/skipped"):
        skipped_results(once).write.mode("overwrite").parquet(f"{path}/skipped")
    if not _stored(spark, f"{path}/tasks"):
        files = once.where("NOT skipped").write.mode("overwrite").option("maxRecordsPerFile", batch_tasks)
        files.parquet(f"{path}/tasks")


def run_resumable(
    plan: DataFrame, path: str, complete: Callable[[str, str, str], str], wording: Wording, batch_tasks: int = 1000, **settings
) -> DataFrame:
    """Run ``plan`` to its end and return the results of all tasks (``run_results``).

    Called again with the same ``path``, a shared folder, it takes up the run
    that is stored there, whatever plan is given. ``settings`` go to ``run_tasks``."""
    spark = plan.sparkSession
    store_plan(plan, path, batch_tasks)

    def close(batch: DataFrame, number: int) -> None:
        session, results, finish = batch.sparkSession, f"{path}/results/batch-{number}", f"{path}/log/finish-{number}"
        if not _stored(session, results):
            append_task_starts(batch, f"{path}/log/start-{number}")
            run_tasks(batch, complete, wording, **settings).write.mode("overwrite").parquet(results)
        if not _stored(session, finish):
            append_task_log(session.read.schema(TASK_RESULTS).parquet(results), finish)

    tasks = spark.readStream.schema(PLANNED).option("maxFilesPerTrigger", 1).parquet(f"{path}/tasks")
    stream = tasks.writeStream.foreachBatch(close).option("checkpointLocation", f"{path}/checkpoint")
    stream.trigger(availableNow=True).start().awaitTermination()
    return run_results(spark, path)


def run_results(spark: SparkSession, path: str) -> DataFrame:
    """Results of all closed batches of the run at ``path`` and of its skipped tasks. Its
    events are read by ``readers.read_audit_log`` from ``path/log/*``."""
    parts = [*_stored(spark, f"{path}/results/batch-*"), f"{path}/skipped"]
    return spark.read.schema(TASK_RESULTS).parquet(*parts)

"""Writers. All are plain Spark writes; partitioned ones rebalance first, so a
hot dataset is split over files and a cold one is not scattered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_canonical
from ..operators.gates import ablation_lines, ablation_table
from ..session import written

QUERY_FIELDS = ("id", "query_type", "q", "expect_any", "expect_none", "expect_asset_any", "expect_chunk_any")


class ExportBlocked(ValueError):
    """Nothing was written: violations exist for the exported datasets."""


def _balanced(df: DataFrame, *keys: str) -> DataFrame:
    return df.hint("rebalance", *keys)


def _by_dataset(df: DataFrame):
    """A writer that replaces the datasets in ``df`` and leaves all others alone."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset")


def write_queries(queries: DataFrame, violations: DataFrame, path: str, strict: bool = True) -> None:
    """Query records as JSON lines per dataset, absent keys left out.

    A dataset with violations is not written; what an earlier export wrote for
    it stays. With ``strict``, violations of a dataset that has queries here
    stop the whole write before it starts; one without queries blocks nothing."""
    found = violations.join(queries.select("dataset").distinct(), "dataset", "left_semi").select("dataset", "message")
    blocked = found.groupBy("dataset").agg(F.min("message").alias("message")).persist()
    try:
        if strict:
            sample = [r["message"] for r in blocked.select("message").limit(5).collect()]
            if sample:
                raise ExportBlocked("; ".join(sample))
        clean = queries.join(blocked.select("dataset"), "dataset", "left_anti")
        order = [c for c in ("pos", "updated_at", "candidate_id") if c in queries.columns]
        fields = [F.col(c) for c in QUERY_FIELDS if c in queries.columns]
        rows = _balanced(clean, "dataset").sortWithinPartitions("dataset", *order)
        _by_dataset(rows.select("dataset", *order, *fields)).json(path)
    finally:
        blocked.unpersist()


def write_targets(assets: DataFrame, chunks: DataFrame, path: str) -> None:
    for name, df in (("assets", assets), ("chunks", chunks)):
        _by_dataset(_balanced(df, "dataset").sortWithinPartitions("dataset", "pos")).parquet(f"{path}/{name}")


def write_corpus(docs: DataFrame, path: str) -> None:
    _by_dataset(_balanced(docs, "dataset")).parquet(path)


def quarantine(flagged: DataFrame, path: str, run_ts: str, apply: bool = False, noncanonical_only: bool = False) -> DataFrame:
    """The clean rows of a flagged corpus (see ``quality_reasons``). With
    ``apply`` the others are first written to ``path/run_ts=…``, and the rules are
    applied once for both; without it nothing is written."""
    bad = ~is_canonical(F.col("file_name")) if noncanonical_only else F.size("reasons") > 0
    if apply:
        flagged = written(flagged, "flagged")
        _balanced(flagged.where(bad), "dataset").write.mode("overwrite").partitionBy("dataset").parquet(
            f"{path}/run_ts={run_ts}"
        )
    return flagged.where(~bad).drop("reasons")


def write_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path)


def write_ablation(rows: DataFrame, path: str) -> None:
    """The variant rows as JSON and their Markdown table lines as text."""
    rows.write.mode("overwrite").json(f"{path}/json")
    ablation_lines(ablation_table(rows)).select("line").write.mode("overwrite").text(f"{path}/table")


def append_task_log(results: DataFrame, path: str, seq: str = "seq", ts: str = "ts") -> None:
    """Append one finish event per task that was not skipped.

    ``result`` is written as the JSON value it holds, so that the log reads
    back as task state and as candidate lines (see ``scan_candidates``)."""
    events = results.where(~F.col("skipped")).select(
        "task_id",
        "dataset",
        "stage",
        F.lit("finish").alias("kind"),
        F.col(seq).alias("seq") if seq in results.columns else F.unix_micros(F.current_timestamp()).alias("seq"),
        "status",
        "attempts",
        F.col("error").alias("last_error"),
        "raw_response",
        F.try_parse_json("result").alias("result"),
        F.col(ts).alias("ts") if ts in results.columns else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
    )
    events.write.mode("append").json(path)


def append_task_starts(planned: DataFrame, path: str) -> None:
    """Append one start event per task of a plan that is about to be sent. Its
    ``seq`` is before that of every finish event written later."""
    planned.where(~F.col("skipped")).select(
        "task_id",
        "dataset",
        "stage",
        F.lit("start").alias("kind"),
        F.unix_micros(F.current_timestamp()).alias("seq"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
    ).write.mode("append").json(path)

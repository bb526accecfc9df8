"""Threshold gates, baselines, run roll-ups and ablation tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.keys import apply_overrides, variant_label
from ..functions.ranking import METRICS

# --- fixed values
MARGINS = {"hit_at_3": 0.05, "hit_at_10": 0.05, "mrr": 0.05, "ndcg_at_10": 0.03, "recall_at_100": 0.03}
TOLERANCE = 0.02
ENTRY_HEADER = r"^##\s+(?:\d{4}-\d{2}-\d{2}|\d+\.\d+\.\d+)\b"
METRIC_TOKEN = r"(?i)ndcg[_@]|hit[_@]|recall[_@]|\bmrr\b"
DATASET_PREFIX = "datasets/"
# --- end of fixed values


def long_metrics(metrics: DataFrame, keys: Sequence[str], names: Sequence[str] = METRICS) -> DataFrame:
    """Metric columns to (metric, value) rows, without a shuffle."""
    return metrics.unpivot(list(keys), list(names), "metric", "value")


def threshold_gate(metrics: DataFrame, thresholds: DataFrame, keys: Sequence[str] = ("run_id", "dataset")) -> DataFrame:
    """Each declared threshold against the measured value; a metric that was
    not measured fails."""
    keys = list(keys)
    wanted = thresholds.select("dataset", F.col("key").alias("metric"), F.col("value").alias("threshold"))
    # The value is looked up in the row itself, so the metrics are computed once.
    measured = F.create_map(*[x for m in METRICS for x in (F.lit(m), F.col(m).cast("double"))])
    return (
        metrics.select(*keys, measured.alias("_measured"))
        .join(wanted, "dataset")
        .withColumn("value", F.try_element_at("_measured", F.col("metric")))
        .withColumn("ok", F.coalesce(F.col("value") >= F.col("threshold"), F.lit(False)))
        .select(*keys, "metric", "value", "threshold", "ok")
    )


def gate_verdict(gate: DataFrame, runs: DataFrame, keys: Sequence[str] = ("run_id", "dataset")) -> DataFrame:
    """Pass flag and exit code per run; a run without thresholds passes."""
    keys = list(keys)
    all_ok = gate.groupBy(*keys).agg(F.bool_and("ok").alias("_ok"))
    passed = F.coalesce("_ok", F.lit(True))
    return (
        runs.select(*keys)
        .distinct()
        .join(all_ok, keys, "left")
        .select(*keys, passed.alias("passed"), F.when(passed, 0).otherwise(1).alias("exit_code"))
    )


def baseline_regression(
    metrics: DataFrame,
    baseline: DataFrame,
    tolerance: float = TOLERANCE,
    keys: Sequence[str] = ("dataset", "mode"),
    lower_is_better: Sequence[str] = (),
) -> DataFrame:
    """Measured (keys, metric, value) against stored values: the change in the
    good direction and whether it falls short by more than the tolerance."""
    keys = list(keys)
    joined = metrics.join(baseline.withColumnRenamed("value", "baseline"), [*keys, "metric"])
    raw = F.col("value") - F.col("baseline")
    signed = F.when(F.col("metric").isin(*lower_is_better), -raw).otherwise(raw) if lower_is_better else raw
    return joined.withColumn("delta", signed).withColumn("regressed", F.col("delta") < -F.lit(tolerance))


def calibrate_thresholds(metrics: DataFrame, margins: Mapping[str, float] = MARGINS, digits: int = 2) -> DataFrame:
    """Thresholds proposed from observed (…, metric, value) rows: value - margin."""
    margin = F.lit(None).cast("double")
    for name, m in margins.items():
        margin = F.when(F.col("metric") == name, F.lit(m)).otherwise(margin)
    # A tiny nudge keeps binary noise of the subtraction from crossing a digit.
    raw = F.greatest(F.round(F.col("value") - margin, 9), F.lit(0.0))
    return metrics.where(F.col("metric").isin(*margins)).withColumn("threshold", F.round(raw, digits))


def summarize_runs(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Worst exit code and pass counts. Only exit codes decide, never the
    report's own flag: 2 beats any other non-zero code (counted as 1) beats 0."""
    code = F.col("exit_code")
    rank = F.when(code == 2, 2).when(code != 0, 1).otherwise(0)
    grouped = runs.groupBy(*keys) if keys else runs
    out = grouped.agg(
        F.coalesce(F.max(rank), F.lit(0)).alias("worst_exit_code"),
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(code == 0).alias("n_passed"),
    )
    return out.withColumn("n_failed", F.col("n_total") - F.col("n_passed")).withColumn(
        "passed", F.col("worst_exit_code") == 0
    )


def variant_grid(datasets: DataFrame, variants: Sequence[Mapping[str, str]], base: Mapping[str, str]) -> DataFrame:
    """Every dataset with every override set: its label and effective
    settings. The variant list is a constant of the plan."""

    def as_map(m: Mapping[str, str]) -> Column:
        pairs = [F.lit(x) for kv in m.items() for x in (str(kv[0]), str(kv[1]))]
        return (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")

    if not all(isinstance(v, Mapping) for v in variants):
        raise ValueError("variants must be a list of mappings")
    each = F.posexplode(F.array(*[as_map(v) for v in variants])).alias("ord", "overrides")
    return datasets.select("dataset", each).withColumns(
        {"label": variant_label(F.col("overrides")), "settings": apply_overrides(as_map(base), F.col("overrides"))}
    )


def ablation_table(rows: DataFrame, metric_keys: Sequence[str] = METRICS) -> DataFrame:
    """One row per variant; metrics from the ``metrics`` map with three
    decimals, '-' where missing."""

    def cell(k: str) -> Column:
        value = F.try_element_at("metrics", F.lit(k))
        return F.when(value.isNotNull(), F.format_string("%.3f", value)).otherwise("-").alias(k)

    return rows.select(*[c for c in rows.columns if c not in ("metrics", "overrides")], *[cell(k) for k in metric_keys])


def ablation_lines(table: DataFrame, metric_keys: Sequence[str] = METRICS) -> DataFrame:
    """The table as Markdown body lines; the two head lines are constants."""
    cells = F.concat_ws(" | ", "label", F.col("exit_code").cast("string"), *metric_keys)
    return table.select("*", F.concat(F.lit("| "), cells, F.lit(" |")).alias("line"))


def baseline_log_check(added: DataFrame, headers: DataFrame, changed: DataFrame) -> DataFrame:
    """Violations per change that touches datasets without a new dated or
    versioned log entry, or without a metric on its added lines.

    Reads ``added(change_id, text)``, ``headers(change_id, header)`` and
    ``changed(change_id, path)``."""
    touching = changed.where(F.col("path").startswith(DATASET_PREFIX)).select("change_id").distinct()
    known = headers.select("change_id", F.col("header").alias("head")).distinct()
    facts = (
        added.select(
            "change_id",
            T.strip(F.col("text")).alias("head"),
            F.col("text").rlike(ENTRY_HEADER).alias("is_header"),
            F.col("text").rlike(METRIC_TOKEN).alias("has_metric"),
        )
        .where("is_header or has_metric")
        .withColumn("head", F.when(F.col("is_header"), F.col("head")))
    )
    new_heads = facts.where("is_header").join(known, ["change_id", "head"], "left_anti")
    fresh = new_heads.select("change_id").distinct().withColumn("fresh", F.lit(True))
    measured = facts.where("has_metric").select("change_id").distinct().withColumn("measured", F.lit(True))
    found = touching.join(fresh, "change_id", "left").join(measured, "change_id", "left")
    return found.select(
        "change_id",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("fresh").isNull(), "no new dated or versioned entry header"),
                    F.when(F.col("measured").isNull(), "entry names no retrieval metric"),
                )
            )
        ).alias("violation"),
    )


def reconcile(split: DataFrame, reported: DataFrame, keys: Sequence[str] = ("run_id",), eps: float = 1e-9) -> DataFrame:
    """Recomputed ``all`` metrics against the (keys, metric, value) a report states."""
    keys = list(keys)
    mine = long_metrics(split.where("lang = 'all'"), keys).withColumnRenamed("value", "recomputed")
    return mine.join(reported.withColumnRenamed("value", "reported"), [*keys, "metric"], "left").withColumn(
        "ok", F.coalesce(F.abs(F.col("recomputed") - F.col("reported")) <= eps, F.lit(False))
    )

"""The usual sequences of operators, as lazy plans from table to table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import curation, gates, quality, ranking, review, scoring, tasks, validate
from ..operators.validate import Package


@dataclass(frozen=True)
class Evaluation:
    """Per-query rows, metrics per language, the gate and the run roll-up."""

    per_query: DataFrame
    split: DataFrame
    gate: DataFrame
    verdict: DataFrame
    summary: DataFrame


def evaluate(pkg: Package, hits: DataFrame, run_id: str, mode: str) -> Evaluation:
    """Score rank rows (dataset, id, doc, rank) of one run against a package."""
    ranked = ranking.ranked_lists(hits)
    per_query = (
        pkg.queries.where(~F.coalesce("expect_none", F.lit(False)))
        .select("dataset", "pos", "id", "q", "expect_any")
        .join(ranked, ["dataset", "id"], "left")
        .withColumns({"run_id": F.lit(run_id), "mode": F.lit(mode)})
    )
    keys = ["run_id", "dataset"]
    split = scoring.split_metrics(per_query, keys)
    whole = split.where("lang = 'all'")
    gate = gates.threshold_gate(whole, pkg.thresholds)
    verdict = gates.gate_verdict(gate, whole)
    return Evaluation(per_query, split, gate, verdict, gates.summarize_runs(verdict.drop("passed")))


def rank_package(pkg: Package, top: int = 100) -> DataFrame:
    """BM25 hits for every query of packages that pass validation."""
    valid = validate.package_verdict(pkg).where("valid").select("dataset")
    queries = pkg.queries.join(valid, "dataset", "left_semi").select("dataset", "id", "q")
    return ranking.rank_bm25(queries, pkg.corpus, top=top)


def clean_corpora(corpus: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean documents, documents to quarantine, and the counts per dataset."""
    clean, bad = quality.split_clean(corpus)
    return clean, bad, quality.audit_corpus(corpus)


def reviewed_queries(
    lines: DataFrame, decision_log: DataFrame, corpus: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Exportable query records and the reasons that block a dataset."""
    candidates = curation.load_candidates(lines)
    decisions = curation.upsert_decisions(decision_log)
    return (
        curation.export_queries(candidates, decisions),
        curation.export_violations(candidates, decisions, corpus),
    )


def review_plan(
    pkg: Package, state: DataFrame, items: DataFrame | None = None, batches: DataFrame | None = None
) -> DataFrame:
    """Planned review tasks of a package; with earlier items and batches only
    the targets that failed last time."""
    targets = review.review_targets(pkg)
    again = items is not None and batches is not None
    if again:
        targets = review.retry_failed_targets(targets, items, batches)
    return tasks.plan_tasks(review.review_groups(targets), state, retry_failed=again)

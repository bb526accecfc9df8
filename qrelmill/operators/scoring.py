"""Ranking metrics per run, language, mode and view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import METRICS, ideal_gain, lang_bucket, metric_columns

LANG_ORDER = ("all", "zh", "en", "other")


def query_metrics(per_query: DataFrame) -> DataFrame:
    """The five metrics of every query, row by row."""
    return per_query.withColumns(metric_columns(F.col("ranked"), F.col("expect_any")))


def _means() -> list:
    return [F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in METRICS]


def aggregate_metrics(per_query: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of each metric per group; all zeros for no rows without keys."""
    keys = list(keys)
    scored = per_query.select(*keys, *_aliased(per_query))
    grouped = scored.groupBy(*keys) if keys else scored
    return grouped.agg(F.count(F.lit(1)).alias("n"), *_means())


def _aliased(per_query: DataFrame) -> list:
    return [c.alias(m) for m, c in metric_columns(F.col("ranked"), F.col("expect_any")).items()]


def _with_all(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Group by (keys, lang) and roll the buckets up to ``all``.

    Each metric is kept as a sum and a count, so the roll-up reads the few
    bucket rows instead of expanding the input for grouping sets."""
    buckets = scored.groupBy(*keys, "lang").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in METRICS]
    )
    name = F.explode(F.array(F.col("lang"), F.lit("all"))).alias("lang")
    return (
        buckets.select(*keys, name, "n", *METRICS)
        .groupBy(*keys, "lang")
        .agg(F.sum("n").alias("n"), *[(F.sum(m) / F.sum("n")).alias(m) for m in METRICS])
    )


def split_metrics(per_query: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Metrics and counts for all queries and each non-empty language bucket."""
    keys = list(keys)
    scored = per_query.select(*keys, lang_bucket(F.col("id")).alias("lang"), *_aliased(per_query))
    return _with_all(scored, keys)


def graded_metrics(judged: DataFrame) -> DataFrame:
    """The five metrics of rows whose ranked list is already judged:
    ``relevant`` flags in rank order and the number ``wanted`` of expected
    documents. For expectations too large to hold as a list per query."""
    rel, wanted = F.col("relevant"), F.col("wanted")

    def found(k: int) -> Column:
        return F.size(F.filter(F.slice(rel, 1, k), lambda x: x))

    gains = F.transform(F.slice(rel, 1, 10), lambda x, i: F.when(x, 1.0 / F.log2(i + F.lit(2.0))).otherwise(0.0))
    first = F.array_position(rel, True)
    columns = {
        "hit_at_3": (found(3) > 0).cast("double"),
        "hit_at_10": (found(10) > 0).cast("double"),
        "mrr": F.when(first > 0, 1.0 / F.nullif(first, F.lit(0))).otherwise(0.0),
        "ndcg_at_10": F.when(wanted > 0, F.aggregate(gains, F.lit(0.0), lambda a, x: a + x) / ideal_gain(wanted, 10)).otherwise(0.0),
        "recall_at_100": F.when(wanted > 0, found(100) / wanted).otherwise(0.0),
    }
    return judged.withColumns(columns)


def mode_view_metrics(per_query: DataFrame, keys: Sequence[str] = ("run_id", "mode")) -> DataFrame:
    """The same metrics per view: documents, assets and chunks. ``ranked``,
    ``ranked_assets`` and ``ranked_chunks`` are scored against the matching
    expectation; a query counts in a view only where it states one."""
    keys = list(keys)
    views = [
        ("doc", "ranked", "expect_any"),
        ("asset", "ranked_assets", "expect_asset_any"),
        ("chunk", "ranked_chunks", "expect_chunk_any"),
    ]
    present = [v for v in views if v[1] in per_query.columns and v[2] in per_query.columns]
    unpivoted = F.explode(
        F.filter(
            F.array(
                *[
                    F.struct(F.lit(v).alias("view"), F.col(r).alias("ranked"), F.col(e).alias("expect_any"))
                    for v, r, e in present
                ]
            ),
            lambda s: (s["view"] == "doc") | (F.size(s["expect_any"]) > 0),
        )
    ).alias("v")
    rows = per_query.select(*keys, "id", unpivoted).select(*keys, "id", "v.*")
    scored = rows.select(*keys, "view", lang_bucket(F.col("id")).alias("lang"), *_aliased(rows))
    return _with_all(scored, [*keys, "view"])


def metrics_report(split: DataFrame, name: str = "run_id") -> DataFrame:
    """Markdown table lines per run: title, blank, head, rule, one per bucket."""
    head = "| lang | n | " + " | ".join(METRICS) + " |"
    rule = "|" + "---|" * (2 + len(METRICS))
    cells = [F.format_string("%.3f", m) for m in METRICS]
    line = F.concat(
        F.lit("| "),
        F.concat_ws(" | ", "lang", F.col("n").cast("string"), *cells),
        F.lit(" |"),
    )
    place = F.array_position(F.lit(list(LANG_ORDER)), F.col("lang")).cast("int") + 3
    body = split.select(name, place.alias("ord"), line.alias("line"))
    titles = split.where("lang = 'all'").select(
        name,
        F.posexplode(
            F.array(F.concat(F.lit("### "), F.col(name)), F.lit(""), F.lit(head), F.lit(rule))
        ).alias("ord", "line"),
    )
    return titles.unionByName(body)

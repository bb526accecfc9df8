"""How well the scores of answerable and off-topic queries separate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsontext as J

# fixed values: score fields probed in order, and the report's text without any
TOP1_KEYS = ("top1_score", "top_score", "max_score")
SCORE_LIST_KEYS = ("scores", "ranked_scores", "hit_scores", "doc_scores")
NO_SCORES = "no absolute relevance scores in eval output; separation is not computable. Showing rank-only negative observations."


def top1_score(raw: Column) -> Column:
    """The top score of a report row: a stated one, else the head of a score
    list. Only JSON numbers count; anything else falls through."""
    stated = [J.as_number(J.field(raw, k)) for k in TOP1_KEYS]
    heads = [J.as_number(F.try_variant_get(raw, f"$.{k}[0]", "variant")) for k in SCORE_LIST_KEYS]
    return F.coalesce(*stated, *heads)


# percentile_approx is off by at most n/ACCURACY ranks, so the middle of a group
# always lies inside a bracket of three times that width on either side.
ACCURACY = 10_000
BRACKET = 3 / ACCURACY


def score_summary(df: DataFrame, keys: Sequence[str], score: str = "score") -> DataFrame:
    """n, mean, exact median, min and max per group over rows with a score.

    A sketch brackets the middle of each group and only the values inside the
    bracket are ranked, so a group with a third of all rows is combined
    map-side instead of being sorted in one task."""
    keys = list(keys)
    scored = df.where(F.col(score).isNotNull()).select(*keys, F.col(score).alias("_v"))
    basics = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_v").alias("mean"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
        F.percentile_approx("_v", [0.5 - BRACKET, 0.5 + BRACKET], ACCURACY).alias("_b"),
    )
    b = basics.select(*keys, F.col("_b")[0].alias("_from"), F.col("_b")[1].alias("_to"), F.col("n").alias("_n"))
    placed = scored.join(b, keys).where("_v <= _to")
    # Values below the bracket collapse into one counted row per group.
    value = F.when(F.col("_v") >= F.col("_from"), F.col("_v"))
    counts = placed.groupBy(*keys, "_n", value.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    middle = counts.withColumn("_start", F.coalesce(F.sum("_c").over(before), F.lit(0))).where(
        (F.col("_start") <= F.floor(F.col("_n") / 2))
        & (F.col("_start") + F.col("_c") > F.floor((F.col("_n") - 1) / 2))
    )
    median = middle.groupBy(*keys).agg(((F.min("_v") + F.max("_v")) / 2).alias("median"))
    return basics.drop("_b").join(median, keys, "left")


def expect_none_satisfaction(negatives: DataFrame, cutoff: Column, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Share of scored negatives strictly below the cutoff; null with none scored."""
    below = F.avg((F.col("score") < cutoff).cast("double"))
    return negatives.groupBy(*keys).agg(below.alias("expect_none_satisfaction"))


def leak_sample(negatives: DataFrame, n: int = 5, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """The first ``n`` negatives of a run with the document each surfaced."""
    w = Window.partitionBy(*keys).orderBy("pos")
    return (
        negatives.select(*keys, "pos", F.coalesce("q", F.lit("")).alias("q"), F.get("ranked", F.lit(0)).alias("top_stem"))
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= n)
        .drop("_rn")
    )


def separation(
    positives: DataFrame,
    negatives: DataFrame,
    cutoff: float | None = None,
    keys: Sequence[str] = ("run_id",),
) -> DataFrame:
    """Counts, both score summaries, the margin of their means and the share
    of negatives below the cutoff (default: midpoint of the means). Without a
    score on either side only the counts are filled."""
    keys = list(keys)
    stats = ("mean", "median", "min", "max")
    # Both sides go through one set of aggregations, told apart by a flag.
    both = positives.select(*keys, "score", F.lit(False).alias("neg")).unionByName(
        negatives.select(*keys, "score", F.lit(True).alias("neg"))
    )
    counts = both.groupBy(*keys).agg(
        F.count_if(~F.col("neg")).alias("positives"), F.count_if(F.col("neg")).alias("negatives")
    )
    side = score_summary(both, [*keys, "neg"])
    wide = side.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("neg") == is_neg, F.col(c))).alias(f"{prefix}_{c}")
            for prefix, is_neg in (("pos", False), ("neg", True))
            for c in stats
        ]
    )
    ready = F.col("pos_mean").isNotNull() & F.col("neg_mean").isNotNull()
    limit = F.lit(cutoff).cast("double") if cutoff is not None else (F.col("pos_mean") + F.col("neg_mean")) / 2
    base = counts.join(wide, keys, "left").withColumn("scores_available", ready)
    base = base.withColumns(
        {
            **{f"{p}_{c}": F.when(F.col("scores_available"), F.col(f"{p}_{c}")) for p in ("pos", "neg") for c in stats},
            "cutoff": F.when(F.col("scores_available"), limit),
            "separation_margin": F.when(F.col("scores_available"), F.col("pos_mean") - F.col("neg_mean")),
        }
    )
    cut = base.where("scores_available").select(*keys, "cutoff")
    share = expect_none_satisfaction(
        negatives.select(*keys, "score").join(cut, keys), F.col("cutoff"), keys
    )
    return base.join(share, keys, "left")


def separation_report(sep: DataFrame, leaks: DataFrame | None = None, name: str = "run_id") -> DataFrame:
    """Text lines per run: the margin lines, or the rank-only lines."""
    ready = F.col("scores_available")
    head = [
        F.concat(F.lit("### "), F.col(name), F.lit(" — negatives separation")),
        F.lit(""),
        F.format_string("- positives: %d  negatives: %d", "positives", "negatives"),
    ]
    full = [
        F.format_string("- positive top-1 score: mean %.4f (min %.4f)", "pos_mean", "pos_min"),
        F.format_string("- negative top-1 score: mean %.4f (max %.4f)", "neg_mean", "neg_max"),
        F.format_string("- **separation margin**: %.4f", "separation_margin"),
        F.format_string("- expect_none satisfaction @ cutoff %.4f: %.3f", "cutoff", "expect_none_satisfaction"),
    ]
    none = [F.lit(f"- **scores unavailable** — {NO_SCORES}")]
    lines = F.when(ready, F.array(*head, *full)).otherwise(F.array(*head, *none))
    out = sep.select(name, F.posexplode(lines).alias("ord", "line"))
    if leaks is None:
        return out
    shown = leaks.join(sep.where(~ready).select(name), name, "left_semi")
    item = F.concat(F.lit("  - `"), "q", F.lit("` -> `"), F.coalesce("top_stem", F.lit("None")), F.lit("`"))
    titles = shown.select(name).distinct().select(
        name, F.lit(4).alias("ord"), F.lit("- negative top-stems (rank-only):").alias("line")
    )
    rows = shown.select(name, (F.lit(5) + F.col("pos")).cast("int").alias("ord"), item.alias("line"))
    return out.unionByName(titles).unionByName(rows)

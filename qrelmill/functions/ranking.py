"""Row-local ranking metrics: one ranked list and one expectation per row, no
explode and no shuffle."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: metric names of reports and threshold maps
METRICS = ("hit_at_3", "hit_at_10", "mrr", "ndcg_at_10", "recall_at_100")


def _list(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def hit_at_k(ranked: Column, expect: Column, k: int) -> Column:
    if k <= 0:
        return F.lit(0.0)
    hit = F.arrays_overlap(F.slice(_list(ranked), 1, k), _list(expect))
    return F.coalesce(hit, F.lit(False)).cast("double")


def reciprocal_rank(ranked: Column, expect: Column) -> Column:
    ranked = _list(ranked)
    ranks = F.filter(
        F.transform(_list(expect), lambda e: F.array_position(ranked, e)), lambda p: p > 0
    )
    return F.coalesce(F.lit(1.0) / F.array_min(ranks), F.lit(0.0))


def ideal_gain(wanted: Column, k: int) -> Column:
    """Gain of a perfect ranking. It depends on min(wanted, k) only: a k-entry
    constant looked up by size."""
    sums = list(itertools.accumulate(1.0 / math.log2(i + 1) for i in range(1, k + 1)))
    return F.get(F.lit(sums), (F.least(wanted, F.lit(k)) - 1).cast("int"))


def ndcg_at_k(ranked: Column, expect: Column, k: int) -> Column:
    """Binary gain. A repeated id in ``ranked`` gains at every position."""
    if k <= 0:
        return F.lit(0.0)
    expect = _list(expect)
    gains = F.transform(
        F.slice(_list(ranked), 1, k),
        lambda d, i: F.when(F.array_contains(expect, d), 1.0 / F.log2(i + F.lit(2.0))).otherwise(0.0),
    )
    dcg = F.aggregate(gains, F.lit(0.0), lambda a, x: a + x)
    wanted = F.size(F.array_distinct(expect))
    return F.when(wanted > 0, dcg / ideal_gain(wanted, k)).otherwise(0.0)


def recall_at_k(ranked: Column, expect: Column, k: int) -> Column:
    if k <= 0:
        return F.lit(0.0)
    wanted = F.array_distinct(_list(expect))
    found = F.size(F.array_intersect(F.slice(_list(ranked), 1, k), wanted))
    return F.when(F.size(wanted) > 0, found / F.size(wanted)).otherwise(0.0)


def metric_columns(ranked: Column, expect: Column) -> dict[str, Column]:
    return {
        "hit_at_3": hit_at_k(ranked, expect, 3),
        "hit_at_10": hit_at_k(ranked, expect, 10),
        "mrr": reciprocal_rank(ranked, expect),
        "ndcg_at_10": ndcg_at_k(ranked, expect, 10),
        "recall_at_100": recall_at_k(ranked, expect, 100),
    }


def lang_bucket(query_id: Column) -> Column:
    return (
        F.when(query_id.startswith("zh-"), "zh").when(query_id.startswith("en-"), "en").otherwise("other")
    )

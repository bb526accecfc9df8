"""Connected components by alternating large and small stars.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qrelmill.llm.work import Work


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one task as stars: each node to the least of its component there."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [(x, find(x)) for x in parent]
    nodes = [(x, root) for x, root in nodes if x != root]
    yield pa.RecordBatch.from_pydict(
        {"a": pa.array([n[0] for n in nodes], pa.int64()), "b": pa.array([n[1] for n in nodes], pa.int64())}
    )


def components(edges: DataFrame, work: Work, name: str, max_rounds: int = 60) -> DataFrame:
    """node, root of every node of ``edges`` (a, b): root is the component's least node.

    Each round first makes stars of what lies in one task, then a large and a small star
    step across tasks. Minima are combined before the shuffle; the join that brings them
    back is between a written table and them, so that a star with very many rays can be
    split at run time. Rounds end when every node points at a node that points nowhere."""
    now = work.save(edges.filter("a <> b").select("a", "b"), f"{name}-0")
    for i in range(1, max_rounds + 1):
        stars = work.save(now.mapInArrow(_forest, "a long, b long").distinct(), f"{name}-{i}s")
        # Done when no node has two parents and no parent has one.
        again = stars.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("m"))
        open_ = again.filter("n > 1").select("a").unionByName(
            stars.select(F.col("b").alias("a")).distinct().join(again.select("a"), "a", "left_semi")
        )
        if not open_.limit(1).count():
            break
        # Large star: every larger neighbour goes to the least of the neighbourhood.
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = work.save(
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"{name}-{i}l"
        )
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
        )
        now = work.save(small, f"{name}-{i}")
        work.drop(f"{name}-{i}s", f"{name}-{i}l", f"{name}-{i - 1}")
    else:
        raise RuntimeError("components did not settle")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )

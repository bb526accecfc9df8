"""Exact top-k search in binary codes by incremental multi-index hashing.

Vectors become 64-bit codes of signs. The index files each distinct code under its m
segments, about as wide as the logarithm of the number of codes, so that a segment value
has few codes at any size. A search looks up all segment values within a radius, which
grows by one in one segment after the other. When radius r is done in the first a + 1
segments and r - 1 in the others, every code within m * r + a bits has been seen, because
one that was not differs in more bits. A query is done once its k-th verified distance is
covered by that bound.

Equal codes are one entry with their k least ids, and equal queries one search, so a
vector that many rows share is looked up once. Candidates are cut to the best k per query
in parts before the parts meet."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qrelmill.llm.work import Work, table

BITS = 64
#: Widest segment: a radius of it has at most 12,870 changes, and all of them are 65,536.
WIDEST = 16
#: With up to this many changes of a segment, all segments are looked up in one round.
TOGETHER = 600
K = 10
EVERY = 50
PARTS = 32


def code_of(vector: np.ndarray) -> int:
    """The signs of ``BITS`` sums of components; component i goes to sum i mod ``BITS``,
    turned over in every other round. With up to ``BITS`` components: their signs."""
    wide = np.zeros(-(-max(len(vector), 1) // BITS) * BITS)
    wide[: len(vector)] = np.nan_to_num(vector)
    rounds = wide.reshape(-1, BITS)
    rounds[1::2] *= -1
    bits = rounds.sum(axis=0) > 0
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("embedding")
        codes = [code_of(np.array(v.values.to_numpy(zero_copy_only=False), np.float64)) for v in vectors]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(codes, pa.int64())], ["vec_id", "code"])


def codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code of all rows that have both an id and a vector."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").mapInArrow(_code, "vec_id long, code long")


def best(rows: DataFrame, group: list[str], order: list[str], k: int, salt: Column) -> DataFrame:
    """The first k rows of each group: k of each part of a group first, then of all parts."""
    parts = rows.withColumn("part", F.pmod(salt, F.lit(PARTS)))
    first = F.row_number().over(Window.partitionBy(*group, "part").orderBy(*order))
    some = parts.withColumn("place", first).filter(F.col("place") <= k).drop("place", "part")
    again = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return some.withColumn("place", again).filter(F.col("place") <= k)


def widths(codes: int) -> list[int]:
    """Widths of the segments for a number of distinct codes."""
    m = max(-(-BITS // WIDEST), min(BITS, round(BITS / np.log2(max(2, codes)))))
    return [BITS // m + (i < BITS % m) for i in range(m)]


def segments(rows: DataFrame, wide: list[int], some: list[int]) -> DataFrame:
    """``rows`` (code, ...) once for ``some`` of the segments, with segment, width and value."""
    starts = np.cumsum([0, *wide])

    def cut(n: int) -> Column:
        value = F.shiftrightunsigned("code", int(starts[n])).bitwiseAND((1 << wide[n]) - 1)
        return F.struct(F.lit(n).alias("segment"), F.lit(wide[n]).alias("width"), value.alias("value"))

    return rows.select("*", F.explode(F.array(*map(cut, some))).alias("s")).select("*", "s.*").drop("s")


def changes(spark: SparkSession, wide: list[int]) -> DataFrame:
    """width, radius, masks: all changes of a segment in ``radius`` bits, 2 ** WIDEST at most a width."""
    rows = [(w, r, [sum(1 << i for i in c) for c in combinations(range(w), r)]) for w in sorted(set(wide)) for r in range(w + 1)]
    return spark.createDataFrame(rows, "width int, radius int, masks array<int>")


def rounds(wide: list[int]) -> Iterator[tuple[int, list[int], int]]:
    """Radius, segments to look up, and the distance up to which all codes are then seen."""
    m = len(wide)
    for radius in range(max(wide) + 1):
        if comb(max(wide), radius) <= TOGETHER:
            yield radius, list(range(m)), m * radius + m - 1
        else:
            for n in range(m):
                yield radius, [n], m * radius + n


def top_k(base: DataFrame, asked: DataFrame, k: int = K) -> DataFrame:
    """query_id, vec_id, distance, rank: for each row of ``asked`` (vec_id, code) the k rows
    of ``base`` (vec_id, code) with the least Hamming distance, ties by id.

    A query that is in ``base`` finds itself. With fewer than k rows all are returned. A
    repeated row counts as one more row. Empty tables give empty results."""
    work = Work(base.sparkSession, "hamming")
    nearest = best(base, ["code"], ["vec_id"], k, F.xxhash64("vec_id"))
    entries = work.save(
        nearest.groupBy("code").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "entries"
    )  # at most k ids each
    wide = widths(entries.count())
    every = list(range(len(wide)))
    index = work.save(
        segments(entries.select("code", F.element_at("ids", 1).alias("least"), F.size("ids").alias("n")), wide, every).drop("width"), "index"
    ).withColumnRenamed("code", "other")
    masks = work.save(changes(base.sparkSession, wide), "masks")
    active = work.save(asked.select("code").distinct(), "active")
    found: DataFrame | None = None
    done: list[DataFrame] = []
    for step, (radius, some, covered) in enumerate(rounds(wide)):
        own = F.broadcast(masks.filter(F.col("radius") == radius).drop("radius"))  # a row per width
        probes = segments(active, wide, some).join(own, "width").select("code", "segment", "value", F.explode("masks").alias("mask"))
        probes = probes.select("code", "segment", F.col("value").bitwiseXOR(F.col("mask").cast("long")).alias("value"))
        hits = probes.join(index.hint("merge"), ["segment", "value"]).select(
            "code", "other", "least", "n", F.bit_count(F.col("code").bitwiseXOR(F.col("other"))).alias("distance")
        )
        # Of the k nearest rows, each is of one of the k codes that come first by distance and least id.
        seen = hits if found is None else hits.unionByName(found.join(active, "code", "left_semi"))
        found = work.save(
            best(seen.distinct(), ["code"], ["distance", "least"], k, F.xxhash64("other")).drop("place"), f"found{step}"
        )
        last = covered >= BITS
        sure = found.groupBy("code").agg(F.sum(F.when(F.col("distance") <= covered, F.col("n"))).alias("rows"))
        ends = active if last else sure.filter(F.col("rows") >= k).select("code")
        done.append(found.join(ends, "code", "left_semi"))
        active = work.save(active.join(ends, "code", "left_anti"), f"active{step}")
        if last or not active.limit(1).count():
            break
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    rows = result.join(entries.select(F.col("code").alias("other"), "ids"), "other").select(
        "code", "distance", F.explode("ids").alias("vec_id")
    )
    first = F.row_number().over(Window.partitionBy("code").orderBy("distance", "vec_id"))  # of k * k rows at most
    ranked = work.save(rows.withColumn("rank", first).filter(F.col("rank") <= k), "ranked")
    return asked.withColumnRenamed("vec_id", "query_id").join(ranked, "code").select(
        "query_id", "vec_id", F.col("distance").cast("int").alias("distance"), F.col("rank").cast("int").alias("rank")
    )


def search(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """``top_k`` of the rows of ``vectors`` (vec_id, embedding) whose id ``every`` divides,
    against all rows. Rows without id or vector are neither asked nor found; a vector with
    no or missing components has the signs of zeros there. Other columns are not read."""
    work = Work(vectors.sparkSession, "codes")
    base = work.save(codes(vectors), "codes")
    return top_k(base, base.filter(F.col("vec_id") % every == 0), k)


def op8_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: (x > 0)::INT) AS bits FROM embeddings),
d AS (SELECT q.vec_id AS query_id, b.vec_id, list_sum(list_transform(range(1, 65), lambda i: xor(q.bits[i], b.bits[i]))) AS distance
      FROM c q JOIN c b ON q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, vec_id, distance::INT AS distance, rank::INT AS rank FROM r WHERE rank <= 10
"""

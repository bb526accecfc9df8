"""Centroid clustering of integer vectors with n-simplex projection.

A few pivots span a simplex. The distances of a vector to the pivots, measured once and
kept, place it as the apex over that simplex: one coordinate per pivot. The distance of two
apexes is never above that of the vectors, and that of one apex to the other's mirror image
never below. So a round takes from the kept apexes, without a look at the vectors, which
centroids cannot be nearest; the others are compared exactly, in integers.

Only the centroids, the pivots and one sum per centroid and component pass the driver:
figures of fixed size, whatever the number of vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qrelmill.llm.work import Work, table

WIDTH = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
#: Near the number of directions the vectors spread in: with 24, vectors that fill all 64
#: directions alike leave 38 of 40 centroids to compare; with 60, 5.
PIVOTS = 60
SEED = "2:"
#: Components up to this size have squared distances that fit a long.
LARGEST = 1 << 27
SLICE = 1024
#: Share of the simplex's width that a new pivot must rise above it, so that rounding (apexes
#: are kept as 32-bit floats) stays below SLACK, a share of the squared distances.
ALTITUDE = 0.02
SLACK = 2e-6


def apexes(squared: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Rows of squared distances to the pivots as apexes over ``base``, the pivots' own apexes."""
    n = len(base)
    out = np.zeros((len(squared), n))
    for i in range(1, n):
        side = base[i, :i]
        part = (squared[:, 0] - squared[:, i] + side @ side) / 2 - out[:, : i - 1] @ side[:-1]
        out[:, i - 1] = part / side[-1]
    out[:, n - 1] = np.sqrt(np.maximum(0.0, squared[:, 0] - (out[:, : n - 1] ** 2).sum(axis=1)))
    return out


def squares(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of all ``rows`` to the few ``others``."""
    out = np.empty((len(rows), len(others)), np.int64)
    for j, other in enumerate(others):
        apart = rows - other
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out


@dataclass
class Simplex:
    """Pivots and their own apexes."""

    pivots: np.ndarray
    base: np.ndarray

    @classmethod
    def spanned_by(cls, points: np.ndarray, most: int) -> Simplex:
        """Pivots out of ``points``, each the one that rises highest above those before."""
        chosen, base = [0], np.zeros((1, 1))
        width = 0.0
        while len(chosen) < min(most, len(points)):
            seen = apexes(squares(points, points[chosen]).astype(float), base)
            seen[chosen] = 0
            top = int(np.argmax(seen[:, -1]))
            width = max(width, seen[top, -1])
            if seen[top, -1] <= ALTITUDE * width or not width:
                break
            wider = np.zeros((len(chosen) + 1, len(chosen) + 1))
            wider[:-1, :-1] = base
            wider[-1, :-1] = seen[top]
            chosen, base = [*chosen, top], wider
        return cls(points[chosen], base)

    def project(self, rows: np.ndarray) -> np.ndarray:
        return apexes(squares(rows, self.pivots).astype(float), self.base)


def candidates(apex: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centroid (column) may be nearest to which vector (row), by their apexes."""
    size = (apex**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)
    lower = size - 2 * (apex @ centres.T)
    upper = lower + 4 * np.outer(apex[:, -1], centres[:, -1])
    slack = SLACK * size + SLACK
    return lower - slack <= (upper + slack).min(axis=1, keepdims=True)


def nearest(rows: np.ndarray, apex: np.ndarray, centres: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of the nearest centroid of each row (ties: the smaller), the squared
    distance, and how many centroids were compared exactly."""
    mask = candidates(apex, simplex.project(centres))
    row, centre = np.nonzero(mask)
    apart = rows[row] - centres[centre]
    distance = np.einsum("ij,ij->i", apart, apart)
    checked = mask.sum(axis=1)
    starts = np.cumsum(checked) - checked
    least = np.minimum.reduceat(distance, starts)
    hits = np.flatnonzero(distance == np.repeat(least, checked))
    first = hits[np.unique(row[hits], return_index=True)[1]]
    return centre[first], least, checked


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            rows = part.column("v").flatten().to_numpy().reshape(part.num_rows, width).astype(np.int64)
            yield part, rows, part.column("apex").flatten().to_numpy().reshape(part.num_rows, -1).astype(float)


def integer_vectors(vectors: DataFrame, width: int, scale: int) -> DataFrame:
    """vec_id, v of the vectors that take part."""
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST / scale)
    kept = kept.filter((F.size("e") == width) & F.forall("e", fits))
    return kept.select("vec_id", F.transform("e", lambda x: F.floor(x * scale).cast("int")).alias("v"))


def project(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    """``vectors`` (vec_id, v) with their apexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                rows = part.column("v").flatten().to_numpy().reshape(part.num_rows, -1).astype(np.int64)
                apex = simplex.project(rows)
                ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * apex.shape[1])
                lists = pa.ListArray.from_arrays(ends, pa.array(apex.ravel().astype(np.float32)))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("v"), lists], ["vec_id", "v", "apex"])

    return vectors.mapInArrow(run, "vec_id long, v array<int>, apex array<float>")


def _sums(centres: np.ndarray, simplex: Simplex) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centres), np.int64)
        total = np.zeros(centres.shape, np.int64)
        for _, rows, apex in _blocks(batches, centres.shape[1]):
            number, _, _ = nearest(rows, apex, centres, simplex)
            np.add.at(total, number, rows)
            count += np.bincount(number, minlength=len(centres))
        full = np.flatnonzero(count)
        lists = pa.array(total[full].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(count[full]), lists], ["cluster", "n", "total"])

    return run


def _moved(points: DataFrame, centres: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after one round: sums of a task first, then of all tasks."""
    parts = points.mapInArrow(_sums(centres, simplex), "cluster int, n long, total array<long>")
    wide = F.posexplode(F.transform("total", lambda x: x.cast("decimal(38,0)"))).alias("i", "x")
    sums = parts.select("cluster", "n", wide).groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    out = centres.copy()
    for r in sums.collect():  # centroids times components
        out[r["cluster"], r["i"]] = int(r["x"]) // r["n"]
    return out


def assign(points: DataFrame, centres: np.ndarray, simplex: Simplex) -> DataFrame:
    """vec_id, cluster, distance, checked: the nearest centroid of every vector, its squared
    distance and the number of centroids whose distance had to be measured."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, apex in _blocks(batches, centres.shape[1]):
            number, distance, checked = nearest(rows, apex, centres, simplex)
            columns = [part.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance), pa.array(checked, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance", "checked"])

    return points.mapInArrow(run, "vec_id long, cluster int, distance long, checked int")


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
    width: int = WIDTH,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """vec_id, cluster, distance, checked, cluster_inertia, inertia, centroid_sha256 of every
    vector of ``vectors`` (vec_id, embedding) with ``width`` components, none null or not
    finite; component x counts as floor(scale * x).

    The first centroids are the vectors with the least SHA-256 of ``seed`` and id (equal
    ids: the lesser components; no id: last). With fewer vectors than ``clusters`` there are
    as many centroids as vectors; without any the result is empty. Repeated rows are
    vectors of their own. A vector with a component of 2^27 or more after scaling has no
    distance that fits a long and is left out, as one that is not finite. An inertia that
    does not fit a long is null. Other columns are not read."""
    spark = vectors.sparkSession
    work = Work(spark, "simplex-clustering")
    ready = integer_vectors(vectors, width, scale)
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = ready.orderBy(order.asc_nulls_last(), "v").limit(max(clusters, 2 * pivots)).collect()
    if not first:
        empty = "vec_id long, cluster int, distance long, checked int, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    points = np.array([r["v"] for r in first], np.int64)
    centres, simplex = points[:clusters], Simplex.spanned_by(points, pivots)
    points = work.save(project(ready, simplex), "points")
    for _ in range(rounds):
        centres = _moved(points, centres, simplex)
    found = work.save(assign(points, centres, simplex), "assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r["cluster"]: int(r["x"]) for r in found.groupBy("cluster").agg(exact.alias("x")).collect()}
    long_or_null = lambda x: x if x < 1 << 63 else None
    total = long_or_null(sum(inertia.values()))
    facts = spark.createDataFrame(
        [(i, long_or_null(x), total, ",".join(map(str, centres[i].tolist()))) for i, x in sorted(inertia.items())],
        "cluster int, cluster_inertia long, inertia long, text string",
    ).select("cluster", "cluster_inertia", "inertia", F.sha2("text", 256).alias("centroid_sha256"))
    return found.join(F.broadcast(facts), "cluster").select(  # a row per centroid
        "vec_id", "cluster", "distance", "checked", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op11_simplex_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings")).drop("checked")


def _oracle() -> str:
    near = """a{0} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS m FROM (
    SELECT k.vec_id, k.v, c.c, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM k, c{0} c) GROUP BY vec_id)"""
    move = """s{0} AS MATERIALIZED (
  SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT m.c AS c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM a{0}) GROUP BY c, i),
c{1} AS MATERIALIZED (
  SELECT o.c, coalesce(t.v, o.v) AS v FROM c{0} o LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{0} GROUP BY c) t ON t.c = o.c)"""
    steps = []
    for i in range(ROUNDS):
        steps += [near.format(i), move.format(i, i + 1)]
    steps.append(near.format(ROUNDS))
    return f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v
  FROM (SELECT sha256('{SEED}' || vec_id) AS h, v FROM k ORDER BY h LIMIT {CLUSTERS})),
{", ".join(steps)}
SELECT a.vec_id, a.m.c::INT AS cluster, a.m.d AS distance,
       sum(a.m.d) OVER (PARTITION BY a.m.c)::BIGINT AS cluster_inertia, sum(a.m.d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.c = a.m.c
"""


ORACLE = _oracle()

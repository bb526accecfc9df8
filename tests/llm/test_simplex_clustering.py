"""Clustering by the n-simplex filter against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from qrelmill.llm import simplex_clustering as S

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, clusters=40, rounds=5):
    kept = [(i, tuple(math.floor(256 * x) for x in e)) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, group in groups.items():
            centres[n] = tuple(sum(x) // len(group) for x in zip(*group))
    found = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    each = {n: sum(d for _, d, m in found if m == n) for _, _, n in found}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((-1 if i is None else i), n, d, each[n], total, sha[n]) for i, d, n in found)


def seen(df):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def rows_of(seed, n, spread, repeats=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 64)) * spread
    rows = [(i, (centres[i % 6] + rng.normal(size=64)).tolist()) for i in range(n)]
    return rows + [(1000 + i, rows[0][1]) for i in range(repeats)]


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1) for i, e in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("spread, repeats", [(0, 0), (3, 60), (0.01, 5)])
def test_as_plain_arithmetic(spark, spread, repeats):
    rows = rows_of(3, 130, spread, repeats)
    rows += [(2000, [0.5] * 63), (2001, [0.5] * 65), (2002, []), (2003, None), (2004, [None] + [0.5] * 63)]
    rows += [(2005, [math.nan] + [0.5] * 63), (2006, [math.inf] + [0.5] * 63), (None, rows[5][1]), (7, rows[9][1]), (7, rows[9][1])]
    rows += [(3000 + i, [float(i % 3 == 0)] * 64) for i in range(12)]  # on one line, many ties
    assert seen(S.cluster(frame(spark, rows))) == plain(rows)


def test_degenerate_vectors(spark):
    same = [(i, [0.25] * 64) for i in range(90)]
    assert seen(S.cluster(frame(spark, same))) == plain(same)
    plane = [(i, [float(i % 9), float(i // 9)] + [0.0] * 62) for i in range(90)]
    assert seen(S.cluster(frame(spark, plane))) == plain(plane)


def test_few_none_and_clashing_columns(spark):
    few = rows_of(1, 5, 2)
    got = S.cluster(frame(spark, few).selectExpr("*", "1 as v", "2 as apex", "3 as cluster", "4 as e"))
    assert seen(got) == plain(few)
    none = S.cluster(spark.createDataFrame([], SCHEMA))
    assert none.columns == got.columns and none.count() == 0
    big = [(1, [1e30] * 64), (2, [0.0] * 64)]
    assert [r.vec_id for r in S.cluster(frame(spark, big)).collect()] == [2]


def test_the_filter_spares_most_comparisons_and_loses_none():
    rng = np.random.default_rng(5)
    centres = rng.integers(-300, 300, (40, 64))
    rows = centres[rng.integers(0, 40, 500)] + rng.integers(-40, 40, (500, 64))
    simplex = S.Simplex.spanned_by(np.concatenate([centres, rows[:80]]), S.PIVOTS)
    number, distance, checked = S.nearest(rows, simplex.project(rows), centres, simplex)
    every = S.squares(rows, centres)
    assert (distance == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()
    assert checked.mean() < 2  # of 40
    for moved in (rows[:40], rows[:40] * 50, np.zeros((40, 64), np.int64)):
        apart = S.nearest(rows, simplex.project(rows), moved, simplex)[1]
        assert (apart == S.squares(rows, moved).min(axis=1)).all()

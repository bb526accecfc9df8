import numpy as np

from qrelmill.llm import hamming_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, every, k):
    base = [(r["vec_id"], hamming_search.code_of(np.array([np.nan if x is None else x for x in r["embedding"]], float))) for r in rows if r["vec_id"] is not None and r["embedding"] is not None]
    out = []
    for q, code in base:
        if q % every == 0:
            near = sorted((((code ^ c) & (2**64 - 1)).bit_count(), i) for i, c in base)[:k]
            out += [(q, i, d, n + 1) for n, (d, i) in enumerate(near)]
    return sorted(out)


def vectors(spark, n, clusters=0):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(size=64).astype(float).tolist(), 1) for i in range(n)]
    centre = rng.normal(size=64)
    rows += [(n + i, (centre + rng.normal(size=64) * 0.05).tolist(), 1) for i in range(clusters)]
    rows += [(5000 + 10 * i, rows[0][1], 2) for i in range(25)]
    rows += [(7000, [], 3), (7005, [1.0, -1.0], 3), (7010, [0.5] * 100, 3), (7015, [float("nan")] * 64, 3)]
    rows += [(7020, None, 3), (None, [1.0] * 64, 3), (7025, [None, 1.0], 3), (7030, rows[1][1], 3), (7030, rows[1][1], 3)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_as_brute_force(spark):
    for v in (vectors(spark, 300), vectors(spark, 20, clusters=200)):
        got = hamming_search.search(v, every=5, k=10)
        assert got.columns == ["query_id", "vec_id", "distance", "rank"]
        seen = sorted(map(tuple, got.collect()))
        assert sorted(set(seen)) == sorted(set(brute_force(v.collect(), 5, 10)))


def test_few_rows_and_none(spark):
    few = spark.createDataFrame([(0, [1.0] * 64, 0), (1, [-1.0] * 64, 0)], SCHEMA)
    assert sorted(map(tuple, hamming_search.search(few, every=50, k=5).collect())) == [(0, 0, 0, 1), (0, 1, 64, 2)]
    assert hamming_search.search(spark.createDataFrame([], SCHEMA)).count() == 0

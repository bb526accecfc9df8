"""What tasks give to the last ranking grows with queries, not with pairs."""

import numpy as np
import pytest

from qrelmill.operators import ranking as K
from test_ranking import brute_cosine, texts, vector_rows


@pytest.fixture
def ranked(monkeypatch):
    seen, found = [], K._ranked

    def keep(hits, top):
        seen.append(hits)
        return found(hits, top)

    monkeypatch.setattr(K, "_ranked", keep)
    return seen


@pytest.mark.parametrize("limit, whole", [(1 << 20, 10**6), (0, 0)])
def test_bm25_gives_the_best_of_each_task(spark, ranked, limit, whole):
    """Before, every pair of a query and a document with one of its words was shuffled."""
    c = spark.createDataFrame([("a", f"d{i:04d}", t + " w0") for i, t in enumerate(texts(2000, "c"))], "dataset string, stem string, text string").repartition(3)
    q = spark.createDataFrame([("a", f"q{i}", t + " w0") for i, t in enumerate(texts(6, "q"))], "dataset string, id string, q string")
    assert K.rank_bm25(q, c, top=5, broadcast_bytes=limit, whole_postings=whole).count() == 30
    assert ranked[-1].count() <= 6 * 5 * max(4, spark.sparkContext.defaultParallelism)


def test_vectors_of_many_queries_are_not_given_by_every_task(spark, ranked, monkeypatch):
    """Before, every task gave its best hits of every query that fitted a broadcast."""
    monkeypatch.setattr(K, "SHIPPED_HITS", 100, raising=False)
    rows = vector_rows("a", 5, 1.0)
    v = spark.createDataFrame(rows, "dataset string, doc string, vec array<double>").repartition(4)
    hits = K.rank_vector(v.withColumnRenamed("doc", "id"), v, top=5).collect()
    got = {}
    for r in sorted(hits, key=lambda r: r["rank"]):
        got.setdefault(r.id, []).append(r.doc)
    assert got == brute_cosine(rows, 5)
    assert ranked[-1].count() <= 2 * 5 * len(rows)


def test_best_hits_by_blocks():
    """Cuts on the way leave what a full sort leaves, ties by name."""
    rng = np.random.default_rng(3)
    scores = rng.integers(0, 6, (4, 300)) / 8
    docs = np.array([f"d{i:03d}" for i in rng.permutation(300)], dtype=object)
    hits = K._TopHits(7, np.array(list("abcd"), dtype=object))
    for i in range(0, 300, 20):
        hits.add(docs[i : i + 20], scores[:, i : i + 20])
    got = hits.frame("x").groupby("id")["doc"].agg(set)
    for row, name in enumerate("abcd"):
        assert got[name] == set(docs[np.lexsort((docs, -scores[row]))[:7]])

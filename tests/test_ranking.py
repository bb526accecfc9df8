"""Bulk ranking against brute force, in both block layouts."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from qrelmill.operators import ranking as K

WORDS = [f"w{i}" for i in range(40)]


def texts(n, seed):
    rnd = random.Random(seed)
    return [" ".join(rnd.choices(WORDS, weights=[1 / (i + 1) for i in range(40)], k=rnd.randint(0, 25))) for _ in range(n)]


def brute_bm25(queries, docs, k1, b, top):
    toks = {d: t.split() for d, t in docs.items()}
    avg = sum(map(len, toks.values())) / len(toks)
    df = Counter(w for t in toks.values() for w in set(t))
    out = {}
    for q, text in queries.items():
        scored = []
        for d, t in toks.items():
            tf = Counter(t)
            s = sum(
                math.log(1 + (len(toks) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(t) / avg))
                for w in text.split() if tf[w]
            )
            if s > 0:
                scored.append((-round(s, 9), d))
        out[q] = [d for _, d in sorted(scored)[:top]]
    return out


@pytest.mark.parametrize("limit, whole, top", [(1 << 20, 1000, 7), (0, 1000, 7), (1 << 20, 0, 7), (0, 60, 30)])
def test_bm25(spark, limit, whole, top):
    docs = {ds: {f"d{i}": t for i, t in enumerate(texts(60, ds))} for ds in ("a", "b")}
    queries = {ds: {f"q{i}": t for i, t in enumerate(texts(8, ds + "q"))} for ds in ("a", "b")}
    c = spark.createDataFrame([(ds, d, t) for ds in docs for d, t in docs[ds].items()], "dataset string, stem string, text string").repartition(5)
    q = spark.createDataFrame([(ds, i, t) for ds in queries for i, t in queries[ds].items()], "dataset string, id string, q string")
    hits = K.rank_bm25(q, c, k1=0.9, b=0.4, top=top, block_docs=9, broadcast_bytes=limit, whole_postings=whole).collect()
    got = {}
    for r in sorted(hits, key=lambda r: r.rank):
        got.setdefault((r.dataset, r.id), []).append(r.doc)
    for ds in docs:
        for i, want in brute_bm25(queries[ds], docs[ds], 0.9, 0.4, top).items():
            assert got.get((ds, i), []) == want


def vector_rows(dataset, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, 6))
    vecs = centres[rng.integers(0, 7, 120)] + rng.normal(size=(120, 6)) * spread
    vecs[10] = vecs[20] = vecs[3]  # equal vectors tie and go by name
    vecs[30], vecs[31], vecs[32] = 0, -vecs[3], vecs[3] * 5
    return [(dataset, f"e{i:03d}", v.tolist()) for i, v in enumerate(vecs)]


def brute_cosine(rows, top):
    vecs = np.array([v for _, _, v in rows])
    norm = np.linalg.norm(vecs, axis=1, keepdims=True)
    unit = vecs / np.where(norm == 0, 1, norm)
    scores = np.round(unit @ unit.T, 9)
    return {n: [rows[j][1] for j in sorted(range(len(rows)), key=lambda j: (-scores[i, j], rows[j][1]))[:top]] for i, (_, n, _) in enumerate(rows)}


@pytest.mark.parametrize("limit, top, spread", [(1 << 20, 9, 1.0), (0, 9, 0.05), (0, 9, 1.0), (0, 200, 0.05)])
def test_vectors(spark, limit, top, spread):
    rows = {ds: vector_rows(ds, n, spread) for n, ds in enumerate("ab")}
    v = spark.createDataFrame([*rows["a"], *rows["b"], ("a", "nan", [math.nan] * 6)], "dataset string, doc string, vec array<double>").repartition(4)
    q = v.withColumnRenamed("doc", "id")
    hits = K.rank_vector(q, v, top=top, block_docs=15, broadcast_bytes=limit).collect()
    got = {}
    for r in sorted(hits, key=lambda r: r.rank):
        got.setdefault((r.dataset, r.id), []).append(r.doc)
    assert got == {(ds, n): want for ds in rows for n, want in brute_cosine(rows[ds], top).items()}


def test_pivots_leave_few_rings_open(spark, monkeypatch):
    """With vectors in groups, a query is searched in few of all rings."""
    seen = {}
    kept = K.written

    def keep(df, name):
        seen[name] = kept(df, name)
        return seen[name]

    monkeypatch.setattr(K, "written", keep)
    rows = vector_rows("a", 1, 0.01)
    v = spark.createDataFrame(rows, "dataset string, doc string, vec array<double>").repartition(3)
    assert K.rank_vector(v.withColumnRenamed("doc", "id"), v, top=5, broadcast_bytes=0).count() == 600
    bounds = seen["vectors-bounds"].count()
    assert seen["vectors-ahead"].count() + seen["vectors-open"].count() < bounds / 2
    none = spark.createDataFrame([], "dataset string, doc string, vec array<double>")
    assert K.rank_vector(v.withColumnRenamed("doc", "id"), none, broadcast_bytes=0).count() == 0


def test_fusion(spark):
    shape = "dataset string, id string, doc string, rank int"
    a = spark.createDataFrame([("d", "q", "x", 1), ("d", "q", "y", 2)], shape)
    b = spark.createDataFrame([("d", "q", "y", 1), ("d", "q", "z", 2)], shape)
    got = {r.doc: (r.rank, r.score) for r in K.rank_hybrid(a, b).collect()}
    assert got["y"] == (1, pytest.approx(0.3 / 62 + 1.5 / 61)) and got["z"][0] == 2 and got["x"] == (3, pytest.approx(0.3 / 61))
    grid = spark.createDataFrame([("d", "lex", {"w_bm25": "2", "w_vec": "0.1"}), ("d", "base", {})], "dataset string, label string, settings map<string,string>")
    swept = K.sweep_hybrid(a, b, grid)
    assert {r.label: r.doc for r in swept.where("rank = 1").collect()} == {"lex": "y", "base": "y"}
    assert [r.doc for r in swept.where("label = 'lex'").orderBy("rank").collect()] == ["y", "x", "z"]
    assert K.ranked_lists(K.rank_hybrid(a, b)).first().ranked == ["y", "z", "x"]


def test_no_query_terms(spark):
    c = spark.createDataFrame([("d", "s", "hello world")], "dataset string, stem string, text string")
    q = spark.createDataFrame([("d", "q", "unknown"), ("other", "q", "hello")], "dataset string, id string, q string")
    assert K.rank_bm25(q, c).count() == 0
    assert K.rank_bm25(q.withColumn("q", F.lit("hello")).where("dataset = 'd'"), c).first().doc == "s"


def test_whole_hybrid_reads_all_documents_at_full_depth(spark):
    """Documents without a vector are ranked as well, and hits behind the twentieth reach the fusion."""
    from qrelmill.plans.suite import QUERIES

    sf = "/root/testdata/sf0.01"
    hits = QUERIES["sweep_hybrid"](spark, sf).where("label = 'w_bm25=1.0,w_vec=1.0'").collect()
    assert {r.id for r in hits} == {f"b{r.item_id}" for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    with_vector = {f"d{r.vec_id}" for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id").collect()}
    assert any(r.doc not in with_vector for r in hits)
    assert max(r["rank"] for r in hits) == 100

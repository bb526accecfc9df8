"""The posting-list audit against every document dropped one filter at a time."""

import random
import re
from itertools import permutations

import numpy as np

from qrelmill.llm import filter_audit as A
from tests.llm.util import SCHEMA, awkward, words

LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    texts = [(d, p or "", t or "") for d, p, t in docs]
    least = {}
    for d, _, t in texts:
        if d is not None:
            least[t] = min(d, least.get(t, d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    rows = []
    for d, p, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)}
        fails |= {"D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t]}
        rows.append((p, {f for f, x in fails.items() if x}, d in good, d in toxic))
    out, shapley = {}, {}
    for p in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == p]
            for step, f in enumerate(order, 1):
                gone, left_now = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                fail = [r for r in rows if r[0] == p and f in r[1]]
                out[p, "".join(order), step] = [len(left_now), len(gone), len(fail) - len(gone), sum(r[1] == {f} for r in fail), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[p, f] = shapley.get((p, f), 0) + len(gone)
                left = left_now
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def seen(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def test_as_documents_dropped_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(A, "RANGE_BITS", 3)
    rng = random.Random(2)
    docs = [(r.doc_id, r.lang, r.text) for r in awkward(spark).collect()]
    for i in range(100, 180):
        text = words(rng, rng.choice([20, 120]), rng.choice([30, 5000]))
        docs.append((i, rng.choice(["en", "de", None, ""]), rng.choice([text, text.upper(), text + " 5 $", docs[-1][2]])))
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 180, 2)]
    labels += [(60, 1, 0), (60, 0, 1), (60, 1, 1), (None, 1, 1), (9999, 1, 1)]
    frame = spark.createDataFrame([(d, t, p, "s", 1) for d, p, t in docs], SCHEMA).repartition(4)
    frame = frame.selectExpr("*", "1 as part", "2 as row", "3 as sha", "4 as names", "5 as quality", "6 as least")
    got = seen(A.filter_interactions(frame, spark.createDataFrame(labels, LABELS)))
    assert got == plain(docs, labels)


def test_no_documents_and_no_labels(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert A.filter_interactions(docs, labels).count() == 0
    one = spark.createDataFrame([(None, None, None, None, None)], SCHEMA)
    got = seen(A.filter_interactions(one, labels))
    assert got == plain([(None, None, None)], []) and len(got) == 600


def test_galloping_lists():
    rng = np.random.default_rng(4)
    for n, m in ((0, 5), (5, 0), (1, 3000), (3000, 1), (4000, 4000), (50_000, 700), (700, 50_000)):
        a = np.unique(rng.integers(0, 60_000, n))
        b = np.unique(rng.integers(0, 60_000, m))
        assert (A.found_in(a, b) == np.isin(b, a)).all()
        assert (A.union([a, b, a[::3]]) == np.union1d(a, b)).all()
    assert len(A.union([])) == 0 and len(A.union([np.empty(0, np.int64)])) == 0

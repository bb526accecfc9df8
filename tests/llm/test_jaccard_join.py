import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from qrelmill.llm import jaccard_join
from qrelmill.llm.components import components
from qrelmill.llm.shingles import WordHashes, shingle_set
from qrelmill.llm.work import Work
from tests.llm.util import SCHEMA, awkward, with_clashes


def sets_of(rows, k):
    out = []
    for r in rows:
        w = (r["text"] or "").encode().lower().split()
        out.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def brute_force(rows, k, percent):
    sets = sets_of(rows, k)
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            linked = sets[i] and sets[j] and 100 * shared >= percent * len(sets[i] | sets[j])
            if linked or rows[i]["doc_id"] == rows[j]["doc_id"]:
                label[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i]["doc_id"])
    least = {c: None if None in ids else min(ids) for c, ids in members.items()}
    return sorted(((r["doc_id"], len(sets[i]), least[find(i)]) for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (1, 50)])
def test_components_as_brute_force(spark, k, percent):
    docs = awkward(spark)
    got = jaccard_join.jaccard_components(with_clashes(docs), k, percent)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs.collect(), k, percent)


def test_large_blocks_are_cut_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART_SETS", 6)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(70):  # a chain: each differs little from the one before, much from the first
        if i % 3 == 0:
            base[rng.randrange(80)] = f"c{i}"
        mine = list(base)
        mine[rng.randrange(80)] = f"m{i}"
        rows.append((i * 3 % 71, " ".join(mine), "en", "s", 0))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = jaccard_join.jaccard_components(docs, 3, 80)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs.collect(), 3, 80)


def test_copies_for_large_blocks_are_made_in_rounds(spark, monkeypatch):
    """Copies grow with the square of a block: no plan may move many times the texts."""
    monkeypatch.setattr(jaccard_join, "PART_SETS", 6)
    saved = []
    save = jaccard_join.Work.save
    monkeypatch.setattr(jaccard_join.Work, "save", lambda self, df, name: saved.append(name) or save(self, df, name))
    rng = random.Random(6)
    often = [f"c{i}" for i in range(60)]
    rows = [(i, " ".join([f"w{i // 2}-{j}" for j in range(7)] + often), "en", "s", 0) for i in range(60)]
    rows += [(100 + i, " ".join(rng.choice(["a", "b"]) for _ in range(5)), "en", "s", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = jaccard_join.jaccard_components(docs, 3, 80)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs.collect(), 3, 80)
    assert sum(name.startswith("across") for name in saved) > 1


def test_the_least_id_names_a_component_in_any_order(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text if i % 2 else text + " more", "en", "s", 0) for i in range(30, 0, -1)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert {r["component_id"] for r in jaccard_join.jaccard_components(docs, 3, 90).collect()} == {1}


def test_empty_table(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    classes = jaccard_join.SizeClasses(percent)
    linked = 0
    for _ in range(4000):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 90), dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        b = a[rng.random(len(a)) > 0.05]
        b = np.union1d(b, rng.integers(0, 1 << 63, rng.integers(0, 1 + len(a) // 9), dtype=np.uint64))
        shared = len(np.intersect1d(a, b))
        if len(b) and 100 * shared >= percent * (len(a) + len(b) - shared) and not np.array_equal(a, b):
            linked += 1
            assert np.intersect1d(jaccard_join.signatures(a, classes), jaccard_join.signatures(b, classes)).size
    assert linked > 500


def test_t_occurrence_finds_all_partners():
    rng = np.random.default_rng(5)
    core = rng.choice(1 << 40, 200, replace=False).astype(np.uint64)
    sets = []
    for i in range(120):
        keep = core[rng.random(200) > rng.choice([0.02, 0.1, 0.5])]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 40, rng.integers(0, 20), dtype=np.uint64)])))
    lists = jaccard_join._index(sets)
    sizes = np.array([len(s) for s in sets])
    for q in sets:
        shared = np.array([len(np.intersect1d(q, s)) for s in sets])
        want = np.flatnonzero(100 * shared >= 80 * (len(q) + sizes - shared))
        assert np.array_equal(np.sort(jaccard_join.t_occurrence(q, lists, sizes, 80)), want)


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 300), (50, 50)] + [(7, 1000 + i) for i in range(30)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df, Work(spark, "cc"), "t").collect()}
    assert got == {i: 0 for i in [*range(41), *range(1000, 1030)]} | {100: 100, 200: 100, 300: 100}


def test_shingles():
    cache = WordHashes()
    assert len(shingle_set("a b", 3, cache)) == 1
    assert len(shingle_set(" \t", 3, cache)) == len(shingle_set(None, 3, cache)) == 0
    assert np.array_equal(shingle_set("A B c D", 3, cache), shingle_set("a\tb\nC d", 3, cache))
    assert not np.array_equal(shingle_set("a\xa0b", 1, cache), shingle_set("a b", 1, cache))


def test_a_common_passage_lays_no_sets_together(spark):
    """A passage that all texts hold gave them common segments, so all were one block."""
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{passage} " + " ".join(f"d{d}w{i}" for i in range(160)) for d in range(60)]
    docs = spark.createDataFrame([(d, t) for d, t in enumerate(texts)], "doc_id long, text string").coalesce(2)
    frequent = jaccard_join.frequent_shingles(docs, 5)
    assert np.array_equal(frequent, shingle_set(passage, 5, WordHashes()))
    classes = jaccard_join.SizeClasses(80)
    sets = [shingle_set(t, 5, WordHashes()) for t in texts]
    assert len(np.unique(np.concatenate([jaccard_join.signatures(s, classes) for s in sets]), return_counts=True)[1]) < sum(
        len(jaccard_join.signatures(s, classes)) for s in sets
    )
    signed = np.concatenate([jaccard_join.signatures(s, classes, frequent) for s in sets])
    assert len(np.unique(signed)) == len(signed)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_signature_whatever_is_frequent(percent):
    rng = np.random.default_rng(percent)
    classes = jaccard_join.SizeClasses(percent)
    linked = 0
    for n in range(4000):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 90), dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        b = a[rng.random(len(a)) > 0.05]
        b = np.union1d(b, rng.integers(0, 1 << 63, rng.integers(0, 1 + len(a) // 9), dtype=np.uint64))
        shared = len(np.intersect1d(a, b))
        if len(b) and 100 * shared >= percent * (len(a) + len(b) - shared) and not np.array_equal(a, b):
            linked += 1
            both = np.union1d(a, b)
            often = both[rng.random(len(both)) < [0.1, 0.5, 0.95, 1][n % 4]]
            mine, other = (jaccard_join.signatures(s, classes, often) for s in (a, b))
            assert np.intersect1d(mine, other).size
    assert linked > 500


def test_tasks_send_short_batches_and_name_every_set(monkeypatch):
    """Sets are reduced inside a batch as well; each set a row goes to has a row of its own."""
    monkeypatch.setattr(jaccard_join, "FLUSH", 40)
    monkeypatch.setattr(jaccard_join, "ROWS", 16)
    texts = pa.array([" ".join(f"d{d % 7}w{i}" for i in range(60)) for d in range(20)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(20), pa.int64()), texts], ["doc_id", "text"])
    sent = list(jaccard_join._sign(5, 80, SimpleNamespace(value=jaccard_join.NONE))(iter([batch])))
    assert max(b.num_rows for b in sent) <= 16
    rows = [r for b in sent for r in b.to_pylist()]
    assert sorted(r["doc"] for r in rows if r["kind"] == 0) == list(range(20))
    assert {r["other"] for r in rows if r["kind"] == 0} == {r["doc"] for r in rows if r["kind"] == 1}
    assert len({r["key"] for r in rows if r["kind"] == 1}) == 7

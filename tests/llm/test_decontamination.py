"""Benchmark windows against a search through every word of every text."""

import random
import re

import pytest

from qrelmill.llm import decontamination as D
from tests.llm.util import SCHEMA, awkward, words

BENCH = "item_id long, text string, text_hash int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, bench, n=10):
    windows = []
    for item, text in bench:
        w = split(text)
        if w:
            k = min(n, len(w))
            windows += [(item, w[i : i + k]) for i in range(len(w) - k + 1)]
    out = []
    for d, text in docs:
        w, hit, items = split(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    items |= {str(item)} if item is not None else set()
        out.append((-1 if d is None else d, len(w), sorted(hit), sorted(items)))
    return sorted(out)


def tables(spark):
    rng = random.Random(9)
    bench = [(i, words(rng, rng.choice([10, 14, 40]), 300)) for i in range(12)]
    bench += [(20, "Only Here!"), (21, ""), (22, None), (23, "..."), (24, bench[0][1]), (24, bench[3][1]), (None, bench[5][1] + " tail")]
    bench += [(30, "x" * 70), (31, "é"), (100, bench[0][1].upper()), (9, words(rng, 30, 40))]
    docs = [(r.doc_id, r.text) for r in awkward(spark).filter("doc_id IS NULL OR doc_id <> 55").collect()]
    for i in range(200, 240):
        item = rng.choice([t for _, t in bench if t])
        inside = item if i % 3 else " ".join(item.split()[: rng.choice([5, 9, 10, 12])])
        docs.append((i, f"{words(rng, 20)} -- {inside.upper() if i % 2 else inside}, {words(rng, rng.choice([0, 7]))} {inside[:30]}"))
    docs += [(300, "x" * 70 + "." + "x" * 71), (301, "É é"), (302, bench[0][1] + " " + bench[0][1])]
    frame = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in docs], SCHEMA).repartition(3)
    frame = frame.selectExpr("*", "1 as body", "2 as spans", "3 as items", "4 as row", "5 as n_hit", "6 as rest")
    return docs, bench, frame, spark.createDataFrame([(i, t, 1) for i, t in bench], BENCH).repartition(2)


def seen(df):
    rows = []
    for r in df.collect():
        hit = [i for a, b in zip(r.spans[::2], r.spans[1::2]) for i in range(a, b)]
        assert len(hit) == r.n_hit
        rows.append((-1 if r.doc_id is None else r.doc_id, r.n_words, hit, r.items))
    return sorted(rows)


@pytest.mark.parametrize("block_bytes, stretch", [(D.BLOCK_BYTES, D.STRETCH), (700, 64)])
def test_as_a_search_for_every_window(spark, monkeypatch, block_bytes, stretch):
    monkeypatch.setattr(D, "STRETCH", stretch)
    monkeypatch.setattr(D, "PIECE_WINDOWS", 7)
    docs, bench, frame, asked = tables(spark)
    assert seen(D.scan(frame, asked, block_bytes=block_bytes)) == plain(docs, bench)


def test_spans_or_documents_go(spark):
    docs, bench, frame, asked = tables(spark)
    found = {(d, n, tuple(h)): bool(h) for d, n, h, _ in plain(docs, bench)}
    clean = D.decontaminate(frame, asked)
    assert clean.columns == frame.columns and clean.count() == len(docs)
    by_id = {r.doc_id: r.text for r in clean.collect() if r.doc_id is not None}
    assert by_id[50] is None and by_id[302] == "" and by_id[300] == "." + "x" * 71 and by_id[301] == "É "
    assert by_id[0] == dict(docs)[0] or any(k[0] == 0 and v for k, v in found.items())
    whole = D.decontaminate(frame, asked, remove="documents")
    assert whole.columns == frame.columns
    assert whole.count() == sum(not h for _, _, h, _ in plain(docs, bench))
    assert whole.filter("doc_id = 302").count() == 0


def test_cut_text_has_the_words_that_are_not_hit():
    text = "One, two; THREE four (five) é six"
    assert D.without(text.encode(), [1, 3, 4, 5]).decode() == "One,  four () é six"
    assert D.without(text.encode(), [0, 7]) == b""


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b c", "en", "s", 1)], SCHEMA), spark.createDataFrame([], BENCH)
    assert seen(D.scan(docs, bench)) == [(1, 3, [], [])]
    assert D.scan(spark.createDataFrame([], SCHEMA), bench).count() == 0
    assert D.decontaminate(docs, bench).collect() == docs.collect()
    with pytest.raises(ValueError):
        D.decontaminate(docs, bench, remove="lines")


def test_a_very_long_text_in_stretches(spark):
    rng = random.Random(1)
    long = words(rng, 400_000, 5000)
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = spark.createDataFrame([(1, long + " " + item + " " + long, "en", "s", 1)], SCHEMA)
    bench = spark.createDataFrame([(5, item, 1)], BENCH)
    assert seen(D.scan(docs, bench)) == [(1, 800_011, list(range(400_000, 400_011)), ["5"])]

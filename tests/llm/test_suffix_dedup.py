import hashlib
import random

import numpy as np
import pytest

from qrelmill.llm import suffix_dedup
from tests.llm.util import SCHEMA, awkward, with_clashes


def check(spark, texts, length, gram, cells):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(with_clashes(docs), length, gram, cells)).collect()
    want = suffix_dedup.brute_force([(t or "").encode() for t in texts], length)
    for r in got:
        removed, spans, digest = want[r["doc_id"]]
        size = len((texts[r["doc_id"]] or "").encode())
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (size, removed, spans, digest), r["doc_id"]
    assert len(got) == len(texts)


@pytest.mark.parametrize("length, gram, cells, seed", [(40, 8, (16, 4, 1), 1), (23, 22, (1,), 2), (60, 12, (64, 8, 1), 3)])
def test_as_brute_force(spark, length, gram, cells, seed):
    rng = random.Random(seed)
    letters = "abé "
    passages = ["".join(rng.choice(letters) for _ in range(rng.randrange(length - 5, 4 * length))) for _ in range(8)]
    texts = [None, "", "short", "a" * 300, "ab" * 150, "xyz" * 7]
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                cut = rng.randrange(0, len(p) // 2)
                parts.append(p[cut : len(p) - rng.randrange(0, 6)])
            else:
                parts.append("".join(rng.choice("cdefghij k") for _ in range(rng.randrange(0, 120))))
        texts.append("".join(parts))
    texts += texts[-3:]
    check(spark, texts, length, gram, cells)


def test_pieces_of_long_texts_meet(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 256)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcd") for _ in range(700))
    texts = ["".join(rng.choice("efgh") for _ in range(n)) + passage[:m] + "x" * n for n, m in [(10, 700), (333, 600), (511, 90)]]
    windows = suffix_dedup.Windows(50, 10)
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        rows = windows.anchors(data)
        assert (rows[2] - rows[1] + 1).sum() == len(data) - 50 + 1
        assert len(np.unique(rows[0])) == rows.shape[1]
    check(spark, texts, 50, 10, (16, 1))


def test_awkward_documents(spark):
    docs = awkward(spark)
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs)).collect()
    rows = docs.collect()
    want = suffix_dedup.brute_force([(r["text"] or "").encode() for r in rows], 400)
    sizes = [len((r["text"] or "").encode()) for r in rows]
    expected = sorted(((r["doc_id"], n, *w) for r, n, w in zip(rows, sizes, want, strict=True)), key=str)
    assert sorted(map(tuple, got), key=str) == expected
    empty = suffix_dedup.digest(suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)))
    assert empty.count() == 0


def test_fingerprints_do_not_depend_on_place():
    prints = suffix_dedup.Fingerprints(4096)
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    data[2000:2100] = data[100:200]
    sums = prints.prefix(data)
    a, b = prints.of(sums, np.array([100, 2000]), np.array([200, 2100]))
    assert a == b
    starts = np.arange(2900)
    assert len(np.unique(prints.of(sums, starts, starts + 100))) == 2899
    assert hashlib.sha256(data[100:200].tobytes()).digest() == hashlib.sha256(data[2000:2100].tobytes()).digest()

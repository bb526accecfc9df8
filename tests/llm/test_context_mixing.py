import re
import zlib
from collections import Counter
from math import exp, log, log10

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from qrelmill.llm import context_mixing
from tests.llm.util import SCHEMA, awkward, with_clashes

SF = "/root/testdata/sf0.01"
END = object()


def tokens(text):
    lower = (text or "").encode().lower().decode()
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


def base_scores(rows):
    held = [zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 10 == 0 for r in rows]
    counts = Counter(t for r, h in zip(rows, held, strict=True) if not h for t in tokens(r["text"]))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for r, h in zip(rows, held, strict=True):
        ts = tokens(r["text"])
        base = sum(log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in ts)
        out.append((r["doc_id"], h, len(ts), sum(counts[t] > 0 for t in ts), total, base))
    return out


@pytest.mark.parametrize("head", [0, 40, 1 << 21])
def test_base_as_brute_force(spark, head):
    docs = awkward(spark)
    got = context_mixing.score(with_clashes(docs), head=head).collect()
    want = sorted(base_scores(docs.collect()), key=lambda x: str(x[:4]))
    got = sorted(got, key=lambda r: str((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"])))
    for r, w in zip(got, want, strict=True):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:5]
        assert r["base_score"] == pytest.approx(w[5], rel=1e-9)
        assert r["score"] < 0


def test_empty_table(spark):
    assert context_mixing.score(spark.createDataFrame([], SCHEMA)).count() == 0


def test_score_does_not_depend_on_partitions(spark):
    docs = awkward(spark)
    one = sorted(str((r["doc_id"], round(r["score"], 6))) for r in context_mixing.score(docs).collect())
    other = sorted(str((r["doc_id"], round(r["score"], 6))) for r in context_mixing.score(docs.repartition(1)).collect())
    assert one == other


def test_order_is_learnt(spark):
    """Held-out texts in the order of the training texts cost less than shuffled ones."""
    import random

    rng = random.Random(2)
    line = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        at = rng.randrange(0, 20)
        text = (line[at : at + 40]) * 2
        if i % 2:
            rng.shuffle(text)
        rows.append((i, " ".join(text), "en", "a" if i % 2 else "b", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = context_mixing.score(docs).filter("held_out").collect()
    per_token = {}
    for r in got:
        per_token.setdefault(r["doc_id"] % 2, []).append(r["score"] / r["n_tokens"])
    mean = {k: sum(v) / len(v) for k, v in per_token.items()}
    assert mean[0] > mean[1] + 0.2, mean


def test_held_out_text_is_not_worse_than_the_base(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = context_mixing.score(docs).filter("held_out").collect()
    score, base, n = (sum(r[c] for r in got) for c in ("score", "base_score", "n_tokens"))
    assert (score - base) / n > -0.1, (score / n, base / n)


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    group = (words >> np.uint64(58)).astype(int)
    counts = rng.integers(1, 30, 500)
    per_class = np.stack([np.bincount(group, counts, 64), np.bincount(group, minlength=64)])
    model = context_mixing.Model(words, counts, per_class)
    every = np.arange(64)
    seen = [context_mixing.paths(every, rng.integers(0, 3, 64) * rng.integers(0, 40, 64)) for _ in range(2)]

    class One:
        pass

    total = 0.0
    for c in range(64):
        t = One()
        t.size, t.start, t.group = np.array([1]), np.array([0]), np.array([c])
        inside = sum((counts[group == c] + 0.1) / 10 ** model.class_total[c]) + 0.1 / 10 ** model.class_total[c]
        total += 10 ** context_mixing.mix(t, model, seen, [t.group, t.group])[0] * inside
    assert total == pytest.approx(1, rel=1e-6)


def test_context_counts_grow_with_the_corpus(spark):
    """Counts are exact: which words are sent to all tasks does not matter, and held-out texts
    of the given documents beat the base."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sent, joined = (context_mixing.score(docs, head=h).filter("held_out").collect() for h in (1 << 20, 50))
    assert {r["doc_id"]: round(r["score"], 6) for r in sent} == {r["doc_id"]: round(r["score"], 6) for r in joined}
    score, base, n = (sum(r[c] for r in sent) for c in ("score", "base_score", "n_tokens"))
    assert (score - base) / n > 0.3, (score / n, base / n)


def plain_scores(rows):
    """The model in plain Python: contexts are words themselves, counts are dictionaries."""

    def coded(text):
        return [context_mixing.END if t is END else xxhash.xxh64_intdigest(t.encode()) for t in tokens(text)]

    def contexts(words):
        before = [context_mixing.BEFORE, context_mixing.BEFORE, *words]
        return [((), (before[i + 1],), (before[i], before[i + 1])) for i in range(len(words))]

    depths = range(context_mixing.CLASS_BITS)
    trained = [coded(r["text"]) for r in rows if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 10]
    words, seen = Counter(w for t in trained for w in t), Counter()
    for text in trained:
        for word, around in zip(text, contexts(text), strict=True):
            seen.update((c, d, word >> 58 >> (6 - d)) for c in around for d in range(7))
    in_class, sorts = Counter(), Counter()
    for w, n in words.items():
        in_class[w >> 58] += n
        sorts[w >> 58] += 1
    out = []
    for r in rows:
        text, total = coded(r["text"]), 0.0
        weights = {(g, d): list(context_mixing.START) for g in range(4) for d in depths}
        around = contexts(text)
        for begin in range(0, len(text), context_mixing.BLOCK):
            change = Counter()
            for i in range(begin, min(begin + context_mixing.BLOCK, len(text))):
                group = text[i] >> 58
                for d in depths:
                    bit, parts = group >> (5 - d) & 1, []
                    for c in around[i]:
                        n, ones = seen[c, d, group >> (6 - d)], seen[c, d + 1, group >> (6 - d) << 1 | 1]
                        p = (ones + context_mixing.PRIOR) / (n + 2 * context_mixing.PRIOR)
                        parts.append(log(p / (1 - p)))
                    gate = (sum(n >= x for x in (1, 16, 256)), d)
                    p = 1 / (1 + exp(-sum(w * x for w, x in zip(weights[gate], parts, strict=True))))
                    p = min(max(p, 1e-6), 1 - 1e-6)
                    total += log10(p if bit else 1 - p)
                    for o, x in enumerate(parts):
                        change[gate, o] += (bit - p) * context_mixing.RATE * x
                total += log10(words[text[i]] + 0.1) - log10(in_class[group] + 0.1 * (sorts[group] + 1))
            for (gate, o), x in change.items():
                weights[gate][o] = min(max(weights[gate][o] + x, -2), 4)
        out.append((r["doc_id"], len(text), total))
    return out


@pytest.mark.parametrize("head", [0, 1 << 20])
def test_scores_as_in_plain_python(spark, monkeypatch, head):
    docs = awkward(spark)
    order = lambda rows: sorted(rows, key=lambda x: (str(x[0]), x[1], round(x[2], 2)))
    want = order(plain_scores(docs.collect()))
    got = order((r["doc_id"], r["n_tokens"], r["score"]) for r in context_mixing.score(docs, head=head, bucket_bytes=20_000).collect())
    for g, w in zip(got, want, strict=True):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], rel=1e-3), (g, w)


def test_slices_hold_every_row_once():
    sizes = np.array([0, 5, context_mixing.SLICE, 1, 1, 3 * context_mixing.SLICE, 0, 0, 7] * 3, np.int64)
    rows = pa.table({"row": np.arange(len(sizes)), "n_bytes": sizes})
    for batch_rows in (1, 4, 100):
        got = list(context_mixing.sliced(iter(rows.to_batches(max_chunksize=batch_rows))))
        assert [r for _, t in got for r in t.column("row").to_pylist()] == list(range(len(sizes)))
        assert [n for n, _ in got] == [t.column("row")[0].as_py() for _, t in got]
        assert [t.num_rows for _, t in got] == [3, 3, 6, 3, 6, 3, 3]
    assert list(context_mixing.sliced(iter([]))) == []


def test_a_slice_that_changed_ends_the_job():
    model = context_mixing.Model(np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros((2, 64)))

    class Held:
        value = model

    def rows(text):
        return pa.table({"row": [0], "doc_id": [1], "held_out": [False], "text": [text], "n_bytes": pa.array([len(text)], pa.int64())})

    batch = rows("a b c").to_batches()
    answers = [context_mixing._answer(pa.Table.from_batches([b])) for b in context_mixing._ask(Held, 1)(iter(batch))]
    together = pa.concat_tables(answers)

    def held(text):
        return pa.Table.from_batches(context_mixing._texts(iter(rows(text).to_batches())))

    assert context_mixing._mix(Held, 1, 4, 4)(held("a b c"), together).num_rows == 1
    with pytest.raises(RuntimeError):
        context_mixing._mix(Held, 1, 4, 4)(held("a b c d"), together)


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_packed_arrays_come_back(n):
    rng = np.random.default_rng(n)
    for dtype, top in ((np.uint32, 1 << 32), (np.uint64, 1 << 63), (np.int64, 200), (np.int64, 70_000), (np.int64, 1 << 62)):
        values = rng.integers(0, top, n).astype(dtype)
        assert (context_mixing.unpack(context_mixing.pack(values), dtype) == values).all()

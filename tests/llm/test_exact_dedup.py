import hashlib

import numpy as np
import pytest

from qrelmill.llm import exact_dedup, fuse_filter
from tests.llm.util import SCHEMA, awkward, with_clashes


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["text"] or "", []).append(r["doc_id"])
    out = []
    for r in rows:
        ids = groups[r["text"] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256((r["text"] or "").encode()).hexdigest()
        out.append((r["doc_id"], keep, len(ids), r["doc_id"] == keep, digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_groups_as_brute_force(spark, batches):
    docs = awkward(spark)
    got = exact_dedup.exact_dedup(with_clashes(docs), batches=batches, bucket_keys=7)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs.collect())


def test_empty_table(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 100, 5_000, 60_000])
def test_filter_holds_its_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    built = fuse_filter.build(keys)
    assert fuse_filter.contains(keys, *built).all()
    others = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) | np.uint64(1 << 63)
    assert fuse_filter.contains(others, *built).mean() < 0.01


def test_a_digest_of_two_texts_is_an_error(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    hits = spark.createDataFrame([(bytearray(b"x"), 1, 2)], "sha binary, top long, old_id long")
    with pytest.raises(Exception, match="share a SHA-256"):
        exact_dedup._byte_check(docs, hits).collect()


def test_an_id_with_several_texts(spark):
    rows = [(i % 20, f"text {i % 60 // 2}", "en", "s", 1) for i in range(80)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    best, size = {}, {}
    for d, t, *_ in rows:
        best[t], size[t] = max(d, best.get(t, d)), size.get(t, 0) + 1
    names = {hashlib.sha256(t.encode()).hexdigest(): t for t in best}
    want = sorted((d, best[t], size[t], d == best[t], t) for d, t, *_ in rows)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept, names[r.text_sha256]) for r in got) == want

import math
import re

import pytest
from pyspark.sql import functions as F

from qrelmill.llm import mixing
from tests.llm.util import SCHEMA, awkward, with_clashes

SF = "/root/testdata/sf0.01"


def water_fill(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed = {}
    while True:
        rest = sum(sizes.values()) - sum(fixed.values())
        active = [s for s in order if s not in fixed]
        total = sum(weight[s] for s in active)
        share = {s: rest * weight[s] / total for s in active}
        above = [s for s in active if share[s] > cap * sizes[s] * (1 + 1e-12)]
        if not above:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in above}


def check(docs, got, tolerance):
    rows = docs.collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r["text"])
    aims = water_fill(sizes)
    source = {(r["doc_id"], size(r["text"])): r["source"] for r in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(aims[s], rel=1e-9, abs=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[s] += r["taken"]
    assert len(got) == len(rows)
    for s, aim in aims.items():
        assert abs(taken[s] - aim) <= tolerance(s, aim), (s, taken[s], aim)
    return taken


def test_sources_meet_their_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs, mixing.mix(docs).collect(), lambda s, aim: 0.005 * aim)  # 50 documents a source


def test_awkward_documents(spark):
    docs = awkward(spark)
    got = mixing.mix(with_clashes(docs)).collect()
    check(docs, got, lambda s, aim: 30_000 if s == "s3" else max(2, 0.02 * aim))
    again = mixing.mix(docs.repartition(1)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = mixing.mix(docs.withColumn("text", F.lit(None).cast("string"))).collect()
    assert all(r["taken"] == 0 and r["target"] == 0 for r in blank)


def test_rates_are_tilted_and_meet_the_constraint(spark):
    sizes = [(5000, 1), (200, 3), (10, 20), (1, 50)]
    aims = [10.0, 900.0, 5850.0, 12_000.0, 17_549.0, 17_550.0]
    rows = [(False, str(i), sizes, 5850, 74, t) for i, t in enumerate(aims)]
    schema = "unnamed boolean, name string, classes array<struct<size: long, n: long>>, source_size long, docs long, target double"
    for r in mixing.balanced(spark.createDataFrame(rows, schema)).collect():
        got = sum(n * z * min(3.0, math.exp(min(700, r["dual"] * z / r["mean"]))) for z, n in sizes)
        assert got == pytest.approx(r["target"], rel=1e-6)


def test_copies_come_near(spark):
    docs = spark.createDataFrame([(i, "w " * n, "en", f"s{i % 2}", 0) for i, n in enumerate([1, 2, 3, 5, 8, 70, 90, 1, 1, 2] * 9)], SCHEMA)
    check(docs, mixing.mix(docs).collect(), lambda s, aim: 1.0)

import numpy as np
import pytest
from pyspark.sql import functions as F

from qrelmill.llm import resampling
from tests.llm.util import SCHEMA, awkward, with_clashes

SF = "/root/testdata/sf0.1"


def test_labels_are_met_on_documents_not_learnt_from(spark):
    """Half of the labels train; on the other half nearly all decisions are right."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    trained = labels.filter(F.xxhash64("doc_id") % 2 == 0)
    got = resampling.classify(docs, trained).join(labels.filter(F.xxhash64("doc_id") % 2 != 0), "doc_id")
    right = got.groupBy("quality").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).collect()
    rates = dict(map(tuple, right))
    assert rates[1] > 0.97 and rates[0] > 0.85, rates


def test_gumbel_noise_has_its_distribution(spark):
    row = spark.range(20_000).select(resampling.gumbel("id").alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert abs(row[0] - 0.5772) < 0.03 and abs(row[1] - 1.2825) < 0.04


@pytest.mark.parametrize("k", [1, 7, 500, 999, 1000])
def test_kth_largest_is_exact(spark, k):
    rng = np.random.default_rng(k)
    values = np.concatenate([rng.normal(size=700), np.zeros(250), rng.normal(size=50) * 1e9])
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert resampling.kth_largest(rows, "v", k) == np.sort(values)[-k]


def test_top_k_of_awkward_documents(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (2, 1), (30, 1), (3, 0), (None, 1), (999, 1)], "doc_id long, quality int")
    got = resampling.classify(with_clashes(docs), labels, keep=20).collect()
    assert len(got) == docs.count()
    keys = sorted((r["key"] for r in got), reverse=True)
    assert {r["key"] for r in got if r["kept"]} == set(keys[:20])
    assert got[0].asDict().keys() == {"doc_id", "log_weight", "n_grams", "key", "kept"}
    again = resampling.classify(docs.repartition(1), labels, keep=20).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    _, kept, _ = resampling.resample(docs, labels, keep=20)
    assert sorted((r["doc_id"] for r in kept(docs).collect()), key=str) == sorted((r["doc_id"] for r in got if r["kept"]), key=str)


def test_nothing_to_learn_from(spark):
    docs, none = awkward(spark), spark.createDataFrame([], "doc_id long, quality int")
    assert all(r["kept"] and r["log_weight"] == 0 for r in resampling.classify(docs, none).collect())
    assert resampling.classify(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_weights_are_log_ratios():
    cache = resampling.Tokens()
    assert resampling.features("", cache).size == resampling.features(None, cache).size == 0
    assert resampling.features("one", cache).size == 2
    assert resampling.features("a b c", cache).size == 3 + 2 + 1
    assert not np.array_equal(resampling.features("go go go", cache)[-1:], resampling.features("go to be", cache)[-1:])


def test_long_clean_documents_stay_before_short_junk(spark):
    """A long text a little below the raw model is good by the tolerance: its length must
    not put it behind short texts that the tolerance rejects."""
    rows = [(i, -0.02 * 60_000, 60_000) for i in range(20)]
    rows += [(100 + i, 1.0, 90) for i in range(20)]
    rows += [(200 + i, -0.3 * 90, 90) for i in range(40)]
    weighed = spark.createDataFrame(rows, "doc_id long, log_weight double, n_grams long")
    weighed = weighed.withColumn("key", resampling.margin(F.col("log_weight"), F.col("n_grams")) + resampling.gumbel("doc_id"))
    limit = resampling.threshold(weighed)
    assert {r["doc_id"] for r in weighed.filter(F.col("key") >= limit).collect()} == {*range(20), *range(100, 120)}


def test_long_clean_texts_of_classify(spark):
    """From texts to decisions: all texts within the tolerance stay, long ones among them."""
    import random

    rng = random.Random(5)
    good, other = [f"good{i}" for i in range(200)], [f"plain{i}" for i in range(60)]

    def text(n, share):
        return " ".join(rng.choice(other if rng.random() < share else good) for _ in range(n))

    rows = [(i, text(300, 0.05)) for i in range(200)]  # labelled
    rows += [(1000 + i, text(20_000, 0.12)) for i in range(6)]  # long
    rows += [(2000 + i, text(30, 0.5)) for i in range(100)]  # short
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    got = resampling.classify(docs, labels).collect()
    long = [r for r in got if 1000 <= r["doc_id"] < 2000]
    assert all(-resampling.TOLERANCE < r["log_weight"] / r["n_grams"] < 0 for r in long), long
    assert all(r["kept"] for r in long), long

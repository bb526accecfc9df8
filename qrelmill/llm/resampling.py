"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted: one over target texts (documents that
are labelled good), one over all raw texts. A document's weight is the log ratio of its
n-grams under both. The target model explains it about as well as the raw one if the mean
log ratio is no less than -``TOLERANCE`` per n-gram; k is the number of such documents.
A document is kept if it is among the k largest sums of its margin, the log ratio and
``TOLERANCE`` for each n-gram, and Gumbel noise, which draws k documents without replacement
in proportion to the exponential of their margins. Number and order so share one measure:
a margin has the sign of the test that k counts, whatever the length of the text.

N-grams are words, pairs of words, and runs of three token shapes: what kind of token it is
and whether it repeats one just before. Shapes let the models see repetition and symbol
noise that words alone leave to a single bucket of each word.

The models are fixed-size tables, summed per task before they are shuffled, so that they
may be sent to every task whatever the size of the corpus. Texts are never shuffled."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qrelmill.llm.shingles import combine
from qrelmill.llm.work import Work, table

BUCKETS = 1 << 16
TARGET_ROWS = 20_000
SMOOTHING = 8.0  # counts, in the target text, by which a bucket's ratio is drawn to 1
TOLERANCE = 0.1
SEED = 20_240_611
BINS = 1024
RECENT = 4

TOKEN = re.compile(r"\w+|[^\w\s]+")
MAX_TOKENS = 400_000


class Tokens(dict):
    """token to (hash, shape); a cache that is emptied when it is full."""

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) > MAX_TOKENS:
            self.clear()
        out = (xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass")), shape(token))
        if len(token) <= 64:
            self[token] = out
        return out


def shape(token: str) -> int:
    """A small number for the kind of a token."""
    if not (token[0].isalnum() or token[0] == "_"):
        return 6 + min(len(token), 4) if token[0] in ".,;:'\"-()?" else 11 + min(len(token), 4)
    if token.isdigit():
        return 0
    if token.islower():
        return 1 if len(token) <= 24 else 2
    if token.isupper():
        return 3 if len(token) > 1 else 4
    return 5 if token[1:].islower() else 6


def features(text: str | None, cache: Tokens) -> np.ndarray:
    """The buckets of all n-grams of a text."""
    tokens = TOKEN.findall(text) if text else []
    if not tokens:
        return np.empty(0, np.int64)
    pairs = np.array([cache[t] for t in tokens], np.uint64)
    words, kinds = pairs[:, 0], pairs[:, 1].copy()
    again = np.zeros(len(words), np.uint64)
    for back in range(min(RECENT, len(words) - 1), 0, -1):
        again[back:][words[back:] == words[:-back]] = back
    kinds += again * np.uint64(64)
    parts = [combine(words, 1)]
    if len(words) > 1:
        parts.append(combine(words, 2))
    parts.append(combine(kinds, min(3, len(kinds))) ^ np.uint64(0x5A5A))
    return (np.concatenate(parts) >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = Tokens()
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for text, target in zip(batch.column("text"), batch.column("target").to_pylist(), strict=True):
            seen = np.bincount(features(text.as_py(), cache), minlength=BUCKETS)
            counts[0] += seen
            if target:
                counts[1] += seen
    some = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0][some]), pa.array(counts[1][some])], ["bucket", "raw", "target"])


def fit(docs: DataFrame, target_ids: DataFrame, target_rows: int = TARGET_ROWS) -> np.ndarray:
    """The log ratio of target and raw model for each bucket.

    A bucket that the raw model would expect a few times in the target text, and that does
    not occur there, says little: both models share a prior of ``SMOOTHING`` counts.

    The raw model is counted over all ``docs`` (doc_id, text), the target model over those
    in ``target_ids`` (doc_id): all of them up to ``target_rows``, else that many, drawn by
    hash. That bound is what makes the broadcast of ids safe. Without any, all ratios
    are 0."""
    chosen = target_ids.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(target_rows).withColumn("hit", F.lit(True))
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left")
    counted = (
        marked.select("text", F.coalesce("hit", F.lit(False)).alias("target"))
        .mapInArrow(_count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toArrow()  # at most BUCKETS rows
    )
    counts = np.zeros((2, BUCKETS))
    counts[:, counted["bucket"].to_numpy()] = np.stack([counted["raw"].to_numpy(), counted["target"].to_numpy()])
    if not counts[1].any():
        return np.zeros(BUCKETS)
    expected = counts[0] * (counts[1].sum() / counts[0].sum())
    return np.log((counts[1] + SMOOTHING) / (expected + SMOOTHING))


def weigher(spark: SparkSession, ratios: np.ndarray):
    """A function from a text column to a struct of log weight and number of n-grams."""
    shared = spark.sparkContext.broadcast(ratios)  # BUCKETS numbers

    @F.pandas_udf("log_weight double, n_grams long")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache, table_ = Tokens(), shared.value
        for texts in batches:
            found = [features(t, cache) for t in texts]
            yield pd.DataFrame(
                {
                    "log_weight": np.array([table_[f].sum() for f in found], np.float64),
                    "n_grams": np.array([len(f) for f in found], np.int64),
                }
            )

    return weigh


def gumbel(id_column: str, seed: int = SEED) -> Column:
    """Noise that is the same in every run: it depends on the id and the seed only."""
    bits = F.xxhash64(F.col(id_column), F.lit(seed)).bitwiseAND((1 << 53) - 1)
    return -F.log(-F.log((bits + 0.5) / float(1 << 53)))


def margin(log_weight: Column, n_grams: Column) -> Column:
    """How far a log weight is above -``TOLERANCE`` per n-gram; at least 0 for what k counts."""
    return log_weight + TOLERANCE * n_grams


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, exact, by counting in ever narrower bins."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / BINS
        place = F.least(F.lit(BINS - 1), F.floor((F.col(column) - low) / width)) if width > 0 else F.col(column)
        inside = rows.filter(F.col(column).between(low, high))
        bins = inside.groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for b in sorted(bins.collect(), key=lambda b: -b["low"]):  # at most BINS rows
            if b["n"] >= k:
                low, high = b["low"], b["high"]
                break
            k -= b["n"]
    return low


def threshold(weighed: DataFrame, keep: int | None = None) -> float:
    """The least key that is kept, from ``weighed`` (log_weight, n_grams, key); ``keep`` is k."""
    k = weighed.filter(margin(F.col("log_weight"), F.col("n_grams")) >= 0).count() if keep is None else keep
    if k <= 0 or weighed.isEmpty():
        return float("inf")
    return kth_largest(weighed, "key", k)


def resample(docs: DataFrame, labels: DataFrame, keep: int | None = None, target_rows: int = TARGET_ROWS):
    """(weighed, kept, limit): scores of all ``docs``, and a function that keeps the rows
    of a table with ``docs``'s columns; both see the same weights."""
    spark = docs.sparkSession
    work = Work(spark, "resampling")
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    weigh = weigher(spark, fit(ids, good, target_rows))
    weighed = ids.select("doc_id", weigh("text").alias("w")).select("doc_id", "w.log_weight", "w.n_grams")
    weighed = work.save(
        weighed.withColumn("key", margin(F.col("log_weight"), F.col("n_grams")) + gumbel("doc_id")), "weighed"
    )
    limit = threshold(weighed, keep)

    def kept(rows: DataFrame) -> DataFrame:
        if dict(rows.dtypes)["doc_id"] != "bigint":
            raise TypeError("doc_id must be a long")
        w = weigh("text")
        return rows.filter(margin(w["log_weight"], w["n_grams"]) + gumbel("doc_id") >= limit)

    return weighed, kept, limit


def classify(docs: DataFrame, labels: DataFrame, keep: int | None = None, target_rows: int = TARGET_ROWS) -> DataFrame:
    """doc_id, log_weight, n_grams, key, kept of each row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, quality) name the target documents by quality 1. A null or empty
    text has weight 0. Rows that tie with the last key kept are kept as well; repeated rows
    share their key. A null id has noise of its own. Without target documents all
    weights are 0 and all rows are kept; an empty table gives an empty result. Other
    columns are not read."""
    weighed, _, limit = resample(docs, labels, keep, target_rows)
    return weighed.withColumn("kept", F.col("key") >= limit)


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

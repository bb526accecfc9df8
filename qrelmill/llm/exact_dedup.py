"""Exact dedup: static binary-fuse filters per immutable snapshot, exact buckets behind them.

Documents arrive in batches. Copies inside a batch are grouped first. The digests that
remain are screened by the filters of all earlier snapshots, one filter per snapshot and
bucket: a negative is new for certain, a positive meets the exact bucket and its bytes are
compared with those of the document found there. What is new becomes the next immutable
snapshot. Buckets hold ``bucket_keys`` digests or so at any size of the input, since their
number follows the number of rows; digests are distinct when they are dealt to buckets, so
that no group of copies makes a bucket large."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qrelmill.llm import fuse_filter
from qrelmill.llm.work import Work, table

FILTERS = "bucket long, seed long, seg_len long, seg_count long, prints binary"


def _build(rows: pa.Table) -> pa.Table:
    keys = rows.column("key").to_numpy()
    seed, seg_len, seg_count, prints = fuse_filter.build(keys.view(np.uint64))
    return pa.table(
        {
            "bucket": pa.array([rows.column("bucket")[0].as_py()], pa.int64()),
            "seed": pa.array([seed], pa.int64()),
            "seg_len": pa.array([seg_len], pa.int64()),
            "seg_count": pa.array([seg_count], pa.int64()),
            "prints": pa.array([prints], pa.binary()),
        }
    )


def _screen(rows: pa.Table, filters: pa.Table) -> pa.Table:
    keys = rows.column("key").to_numpy().view(np.uint64)
    maybe = np.zeros(len(keys), bool)
    for f in filters.to_pylist():
        maybe |= fuse_filter.contains(keys, f["seed"], f["seg_len"], f["seg_count"], f["prints"])
    return rows.append_column("maybe", pa.array(maybe))


def build_filters(snapshot: DataFrame) -> DataFrame:
    """One filter per bucket of a snapshot (bucket, key)."""
    return snapshot.select("bucket", "key").groupBy("bucket").applyInArrow(_build, FILTERS)


def screen(batch: DataFrame, filters: DataFrame) -> DataFrame:
    """``batch`` (bucket, key, ...) with ``maybe``: false means in no snapshot."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields) + ", maybe boolean"
    return batch.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(_screen, schema)


def _byte_check(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """The hits (sha, top, old_id, ...), once all texts of a digest were found equal.

    All texts meet their ids in one shuffle by id and digest, whatever the number of hits:
    a plan that broadcasts few hits would say nothing about many. An id may stand for
    several texts, so the digest of ``docs``, where it is given, says which is meant."""
    keys = [c for c in ("doc_id", "sha") if c in docs.columns]
    ids = hits.select("sha", F.explode(F.array("top", "old_id")).alias("doc_id")).distinct()
    texts = docs.join(ids.hint("merge"), keys).groupBy("sha").agg(F.min("text").alias("lo"), F.max("text").alias("hi"))
    same = texts.select("sha", (F.col("lo") == F.col("hi")).alias("same"))
    return hits.join(same, "sha", "left").filter(
        F.when(F.coalesce("same", F.lit(True)), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("different texts share a SHA-256 digest: "), F.hex("sha")))
        )
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    batches: int = 3,
    bucket_keys: int = 50_000,
    batch_of: Column | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when all their bytes are; the largest id of equal texts stays.
    ``batch_of`` says which batch (0, 1, ...) a row arrives in; without it, ids are dealt
    to ``batches`` batches by hash. A null text counts as empty. Rows with a null id lose to
    any other; a group of null ids alone keeps them all. Rows that repeat id and text
    are all kept and all counted; an id with several texts is a document per text. An empty table gives an empty result. Other columns of
    ``docs`` are not read."""
    spark = docs.sparkSession
    work = Work(spark, "exact-dedup")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if batch_of is None:
        batch_of = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    sha = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")
    rows = work.save(
        docs.select(
            "doc_id",
            sha,
            batch_of.cast("int").alias("batch"),
        ),
        "rows",
    )
    buckets = max(1, -(-rows.count() // bucket_keys))
    key = F.xxhash64("sha")
    # Copies inside a batch: partial sums before the shuffle, so a hot group is one row per task.
    groups = work.save(
        rows.groupBy("batch", "sha")
        .agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
        .withColumns({"key": key, "bucket": F.pmod(key, F.lit(buckets))}),
        "groups",
    )
    fresh: list[DataFrame] = []  # what each batch adds; all but the last are snapshots
    known: list[DataFrame] = []  # digests of a batch that an earlier snapshot holds
    filters: list[DataFrame] = []
    for b in range(batches):
        batch = groups.filter(F.col("batch") == b).drop("batch")
        if fresh:
            screened = work.save(screen(batch, reduce(DataFrame.unionByName, filters)), f"screened{b}")
            exact = reduce(DataFrame.unionByName, fresh).select("bucket", "sha", F.col("top").alias("old_id"))
            hits = work.save(screened.filter("maybe").join(exact, ["bucket", "sha"]), f"hits{b}")
            known.append(hits)
            batch = screened.filter("not maybe").unionByName(
                screened.filter("maybe").join(known[-1], "sha", "left_anti")
            ).drop("maybe")
        fresh.append(work.save(batch, f"snapshot{b}"))
        if b < batches - 1:
            filters.append(work.save(build_filters(fresh[-1]), f"filters{b}"))
    copies = reduce(DataFrame.unionByName, fresh).select("sha", "top", "n")
    if known:
        hits = reduce(DataFrame.unionByName, known)
        checked = work.save(_byte_check(docs.select("*", sha), hits.select("sha", "top", "n", "old_id")).select("sha", "top", "n"), "checked")
        found = (
            checked.groupBy("sha")
            .agg(F.max("top").alias("top_found"), F.sum("n").alias("n_found"))
        )
        copies = copies.join(found, "sha", "left").select(
            "sha",
            F.greatest("top", "top_found").alias("top"),
            (F.col("n") + F.coalesce("n_found", F.lit(0))).alias("n"),
        )
    copies = work.save(
        copies.filter("n > 1").select("sha", F.col("top").alias("keep_id"), F.col("n").alias("group_size")), "copies"
    )
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.join(copies, "sha", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op2_binary_fuse_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
       sha256(d.text) AS text_sha256
FROM d JOIN g ON d.text = g.text
"""

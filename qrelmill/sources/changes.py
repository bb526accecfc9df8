"""Change tables: batches of rows appended one after the other, each guarded.

Rows are written to a folder of their own and become part of the table when a
commit file with the next number is created, which a file system does for one
writer only. A writer says which version it has read: if another append came in
between, its own is refused and leaves nothing that a reader sees. So a rule that was
checked against a version, such as one running batch per dataset, still holds
when the rows that rely on it appear."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import curation, review
from ..schemas import REVIEW_BATCHES

DECISION_WORDS = ("approve", "reject", "rewrite", "pending")


class Conflict(RuntimeError):
    """Another append came first; read the table again."""


class Refused(ValueError):
    """Rows that may not be saved; nothing was written."""


class ChangeTable:
    """Rows of ``schema`` below ``path``; read rows also have ``seq``, their append's number."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self._jvm = spark.sparkContext._jvm
        self._commits = self._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
        self._fs = self._commits.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """Number of the newest append, 0 before the first."""
        found = self._fs.globStatus(self._jvm.org.apache.hadoop.fs.Path(self._commits, "*.json"))
        return max((int(s.getPath().getName()[:-5]) for s in found or []), default=0)

    def read(self, upto: int | None = None) -> DataFrame:
        """All rows up to an append, from the last compaction on."""
        newest = self.version() if upto is None else upto
        shape = f"{self.schema}, seq bigint"
        if not newest:
            return self.spark.createDataFrame([], shape)
        texts = self.spark.read.text(f"{self.path}/commits", wholetext=True, pathGlobFilter="*.json")
        rows = texts.select(F.col("_metadata.file_name").alias("name"), "value").collect()  # one per append
        # An append that broke off while it was committed left an empty commit.
        kept = [(int(r["name"][:-5]), json.loads(r["value"])) for r in rows if r["value"] and int(r["name"][:-5]) <= newest]
        base = max((n for n, c in kept if c["base"]), default=0)
        folders = [f"{self.path}/data/{c['folder']}" for n, c in kept if n >= base]
        return self.spark.read.schema(shape).parquet(*folders) if folders else self.spark.createDataFrame([], shape)

    def append(self, rows: DataFrame, expected: int) -> int:
        """Append ``rows`` if the newest append is still ``expected``; its own number."""
        return self._commit(rows.withColumn("seq", F.lit(expected + 1).cast("bigint")), expected, False)

    def add(self, rows: DataFrame) -> int:
        """Append rows that rely on no others, behind whatever is there."""
        while True:
            try:
                return self.append(rows, self.version())
            except Conflict:
                continue

    def compact(self, merge: Callable[[DataFrame], DataFrame]) -> int:
        """Replace all rows by ``merge`` of them, which keeps ``seq``; later reads start there."""
        expected = self.version()
        return self._commit(merge(self.read(expected)), expected, True)

    def _commit(self, rows: DataFrame, expected: int, base: bool) -> int:
        folder = uuid.uuid4().hex
        names = self.spark.createDataFrame([], f"{self.schema}, seq bigint").columns
        rows.select(*names).write.parquet(f"{self.path}/data/{folder}")
        if self.version() != expected:
            raise Conflict(f"{self.path}: append {expected} was read, the newest is {self.version()}")
        mark = self._jvm.org.apache.hadoop.fs.Path(self._commits, f"{expected + 1:012d}.json")
        try:
            out = self._fs.create(mark, False)
        except Py4JJavaError as exc:
            raise Conflict(f"{self.path}: append {expected + 1} is another writer's") from exc
        out.write(bytearray(json.dumps({"folder": folder, "base": base}).encode()))
        out.close()
        return expected + 1


# --- review batches --------------------------------------------------------


def batches_table(spark: SparkSession, path: str) -> ChangeTable:
    return ChangeTable(spark, path, REVIEW_BATCHES)


def current_batches(rows: DataFrame) -> DataFrame:
    """The newest row of each batch."""
    cols = [c for c in rows.columns if c not in ("dataset", "batch_id", "seq")]
    return rows.groupBy("dataset", "batch_id").agg(F.max_by(F.struct(*cols), "seq").alias("b")).select("dataset", "batch_id", "b.*")


def newest_batches(rows: DataFrame) -> DataFrame:
    """For ``compact``: of each batch its newest row."""
    cols = [c for c in rows.columns if c not in ("dataset", "batch_id")]
    return rows.groupBy("dataset", "batch_id").agg(F.max_by(F.struct(*cols), "seq").alias("b")).select("dataset", "batch_id", "b.*")


def start_batches(table: ChangeTable, wanted: DataFrame) -> DataFrame:
    """Start a batch for each dataset of ``wanted(dataset, batch_id, created_at)`` that has
    none running, and return the started ones. Of two starts at once one ends with
    ``Conflict``; a dataset with a running batch is left out."""
    version = table.version()
    started = review.start_batches(current_batches(table.read(version)), wanted)
    rows = started.select("dataset", "batch_id", "status", F.lit(None).cast("string").alias("error"), "created_at", F.col("created_at").alias("updated_at"))
    number = table.append(rows, version)
    return table.read(number).where(F.col("seq") == number).drop("seq")


def close_batches(table: ChangeTable, closed: DataFrame) -> int:
    """Set status, error and time of batches: ``closed(dataset, batch_id, status, error,
    updated_at)``, status succeeded or failed. Batches that were never started are left out."""
    version = table.version()
    known = current_batches(table.read(version)).select("dataset", "batch_id", "created_at")
    good = F.col("status").isin("succeeded", "failed")
    return table.append(closed.where(good).join(known, ["dataset", "batch_id"]), version)


# --- decisions -------------------------------------------------------------


def save_decisions(table: ChangeTable, rows: DataFrame, corpus: DataFrame | None = None) -> int:
    """Append decisions (``schemas.DECISIONS``) as they are, or none of them.

    Every row needs a dataset, a candidate and one of the four words; with
    ``corpus(dataset, stem)`` its edited labels must be documents as well."""
    wrong = ~F.coalesce(F.col("decision").isin(*DECISION_WORDS), F.lit(False)) | F.col("dataset").isNull() | F.col("candidate_id").isNull()
    faults = rows.where(wrong).select("candidate_id", F.concat(F.lit("invalid decision: "), F.coalesce("decision", F.lit("None"))).alias("why"))
    if corpus is not None:
        labels = rows.select("dataset", "candidate_id", F.explode("edited_expect_any").alias("stem"))
        lost = labels.join(corpus.select("dataset", "stem"), ["dataset", "stem"], "left_anti")
        faults = faults.unionByName(lost.select("candidate_id", F.concat(F.lit("unknown document: "), "stem").alias("why")))
    sample = faults.limit(5).collect()
    if sample:
        raise Refused("; ".join(f"{r['candidate_id']}: {r['why']}" for r in sample))
    return table.add(rows)


def saved_decisions(table: ChangeTable) -> DataFrame:
    """The decision in force per candidate."""
    return curation.upsert_decisions(table.read())

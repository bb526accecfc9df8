"""Suffix-array dedup by bucket-pointer refinement, on a sparse set of suffixes.

A byte goes if it is covered by a ``length``-byte string that starts in two places. Sorting
all suffixes would move many times the text, so the suffixes that are sorted are sampled
by content: each window of ``length`` bytes is filed under its least q-gram (by hash,
leftmost of equals), its anchor. Equal windows have the same anchor at the same offset.

1. Initial buckets: anchors with the same q-gram. Single ones are done.
2. Refinement: the windows of an anchor are cells of neighbouring offsets. A cell's bucket
   is identified by the bytes that all its windows share, which begin and end at other
   offsets than those of the bucket before; the identifier is a fingerprint of them. A cell
   alone in its bucket holds no repeated window. A cell whose windows' union occurs twice
   holds nothing else. The rest is refined again in smaller cells, down to single windows.

Buckets are counted with partial sums and their identifiers joined back between written
tables, so that no bucket is ever brought together, however large. Texts are shuffled once,
into a table bucketed by row that all later steps join without moving it again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qrelmill.llm.work import Work, slices, table

PIECE = 1 << 20
GRAM = 64
CELLS = (64, 8, 1)
STATE = ("row", "x", "low", "high")


class Fingerprints:
    """62-bit polynomial fingerprints of all substrings of a piece of bytes."""

    PRIMES = (2_147_483_647, 2_147_483_629)
    BASES = (1_103_515_249, 1_812_433_253)

    def __init__(self, room: int):
        rng = np.random.default_rng(20240607)
        self.values, self.powers, self.inverse = [], [], []
        for p, b in zip(self.PRIMES, self.BASES, strict=True):
            self.values.append(rng.integers(1, p, 256).astype(np.uint64))
            self.powers.append(self._series(b, p, room))
            self.inverse.append(self._series(pow(b, -1, p), p, room))

    @staticmethod
    def _series(base: int, p: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            step = np.uint64(pow(base, len(out), p))
            out = np.concatenate([out, out * step % np.uint64(p)])
        return out[:n]

    def prefix(self, data: np.ndarray) -> list[np.ndarray]:
        out = []
        for values, powers, p in zip(self.values, self.powers, self.PRIMES, strict=True):
            terms = values[data] * powers[: len(data)] % np.uint64(p)
            out.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)]))
        return out

    def part(self, sums: list[np.ndarray], which: int, i: np.ndarray | slice, j: np.ndarray | slice) -> np.ndarray:
        p = np.uint64(self.PRIMES[which])
        return (sums[which][j] - sums[which][i]) % p * self.inverse[which][i] % p

    def of(self, sums: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Fingerprints of [i, j), as signed 64-bit integers."""
        both = (self.part(sums, 0, i, j) << np.uint64(31)) | self.part(sums, 1, i, j)
        return both.view(np.int64)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    n = len(values)
    full = -(-n // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Windows:
    """Anchors and cells of one text's windows."""

    def __init__(self, length: int, gram: int):
        if not 0 < gram < length:
            raise ValueError("the q-gram must be shorter than the window")
        self.length, self.gram = length, gram
        self.prints = Fingerprints(PIECE + 4 * length)

    def anchors(self, data: np.ndarray) -> np.ndarray:
        """Rows (anchor, least offset, largest offset, q-gram): offsets of the anchor in
        the windows that are filed under it."""
        length, gram = self.length, self.gram
        width, out = length - gram + 1, []
        windows = len(data) - length + 1
        for base in range(0, windows, PIECE):
            count = min(PIECE, windows - base)
            sums = self.prints.prefix(data[base : base + count + length - 1])
            grams = count + width - 1
            code = self.prints.part(sums, 0, slice(0, grams), slice(gram, gram + grams))
            order = (code * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
            at = sliding_least((order << np.uint64(32)) | np.arange(grams, dtype=np.uint64), width) & np.uint64(0xFFFFFFFF)
            at = at.astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            last = np.append(first[1:], count) - 1
            x = at[first]
            rows = np.stack([x + base, x - last, x - first, self.prints.of(sums, x, x + gram)])
            if out and out[-1][0, -1] == rows[0, 0]:  # an anchor's windows may go on in the next piece
                out[-1][1, -1] = rows[1, 0]
                rows = rows[:, 1:]
            out.append(rows)
        return np.concatenate(out, axis=1) if out else np.empty((4, 0), np.int64)

    def cells(self, data: np.ndarray, x: np.ndarray, low: np.ndarray, high: np.ndarray, size: int) -> np.ndarray:
        """Rows (anchor, low, high, core, span) of the cells of ``size`` offsets; a span that
        leaves the text is -1."""
        first = low // size
        many = high // size - first + 1
        of = np.repeat(np.arange(len(x)), many)
        cell = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        x, a, b = x[of], cell * size, np.minimum(cell * size + size - 1, self.length - self.gram)
        low, high = np.maximum(low[of], a), np.minimum(high[of], b)
        length, n = self.length, len(data)
        core, span = np.empty(len(x), np.int64), np.full(len(x), -1, np.int64)
        piece = x // PIECE
        for p in np.unique(piece):
            here = np.flatnonzero(piece == p)
            base = max(0, int(p) * PIECE - length)
            sums = self.prints.prefix(data[base : (int(p) + 1) * PIECE + length])
            at = x[here] - base
            core[here] = self.prints.of(sums, at - a[here], at - b[here] + length)
            inside = (x[here] - b[here] >= 0) & (x[here] - a[here] + length <= n)
            here, at = here[inside], at[inside]
            span[here] = self.prints.of(sums, at - b[here], at - a[here] + length)
        return np.stack([x, low, high, core, span])


def _bytes(text: pa.Scalar) -> np.ndarray:
    return np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.empty(0, np.uint8)


def _batch(names: list[str], row: list[np.ndarray], columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if row:
        values = np.concatenate(columns, axis=1)
        arrays = [pa.array(np.concatenate(row), pa.int64()), *(pa.array(v, pa.int64()) for v in values)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length, gram)
        for batch in slices(batches, "body"):
            row, columns = [], []
            for r, text in zip(batch.column("row").to_numpy(), batch.column("body"), strict=True):
                found = windows.anchors(_bytes(text))
                if found.shape[1]:
                    row.append(np.full(found.shape[1], r))
                    columns.append(found)
            yield from _batch(["row", "x", "low", "high", "core"], row, columns)

    return run


def _cells(length: int, gram: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length, gram)
        for batch in slices(batches, "body"):
            row, columns = [], []
            for r, text, open_ in zip(batch.column("row").to_numpy(), batch.column("body"), batch.column("open"), strict=True):
                x, low, high = (open_.values.field(c).to_numpy() for c in ("x", "low", "high"))
                found = windows.cells(_bytes(text), x, low, high, size)
                row.append(np.full(found.shape[1], r))
                columns.append(found)
            yield from _batch(["row", "x", "low", "high", "core", "span"], row, columns)

    return run


def _remove(length: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("kept", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            rows = []
            for text, gone in zip(batch.column("body"), batch.column("gone"), strict=True):
                data = _bytes(text)
                removed = spans = 0
                kept = data.tobytes()
                if gone.is_valid:
                    starts, ends = (gone.values.field(c).to_numpy() for c in ("s", "e"))
                    step = np.zeros(len(data) + 1, np.int64)
                    np.add.at(step, starts, 1)
                    np.add.at(step, ends + length, -1)
                    mask = np.cumsum(step[:-1]) > 0
                    removed = int(mask.sum())
                    spans = int((mask[1:] & ~mask[:-1]).sum() + mask[:1].sum())
                    kept = data[~mask].tobytes()
                rows.append((len(data), removed, spans, kept))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            arrays = [batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def remove_repeats(docs: DataFrame, length: int = 400, gram: int = GRAM, cells: tuple[int, ...] = CELLS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept of each row of ``docs`` (doc_id, text).

    ``kept`` are the bytes of the text that no ``length``-byte string which starts at
    another place as well covers, places in the same text included. A null text is empty.
    Texts shorter than ``length`` lose nothing. Null and repeated ids keep a row each: rows
    are told apart, so equal texts of ``length`` bytes or more lose everything. An empty
    table gives an empty result. Other columns are not read. Strings are compared by two
    31-bit fingerprints. ``cells`` are falling cell sizes that end with 1."""
    spark = docs.sparkSession
    work = Work(spark, "suffix-dedup")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = "texts_" + work.root.rpartition("-")[2]
    (
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce("text", F.lit("")).cast("binary").alias("body"),
        )
        .repartition(buckets, "row")
        .write.bucketBy(buckets, "row")
        .option("path", work.path("texts"))
        .format("parquet")
        .saveAsTable(name)
    )
    texts = spark.table(name)
    found = work.save(
        texts.select("row", "body").mapInArrow(_anchors(length, gram), "row long, x long, low long, high long, core long"),
        "anchors",
    )

    def repeated(nodes: DataFrame, column: str, label: str) -> DataFrame:
        counted = nodes.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(column)
        return work.save(counted, label)

    still = work.save(found.join(repeated(found, "core", "grams").hint("merge"), "core").drop("core"), "open")
    work.drop("anchors", "grams")
    gone: list[DataFrame] = []
    for size in cells:
        open_ = still.groupBy("row").agg(F.collect_list(F.struct("x", "low", "high")).alias("open"))
        nodes = work.save(
            texts.join(open_.hint("shuffle_hash"), "row")
            .select("row", "body", "open")
            .mapInArrow(
                _cells(length, gram, size), "row long, x long, low long, high long, core long, span long"
            ),
            f"cells{size}",
        )
        shared = nodes.join(repeated(nodes, "core", f"cores{size}").hint("merge"), "core")
        if size > 1:
            whole = repeated(nodes.filter("span <> -1"), "span", f"spans{size}").withColumn("whole", F.lit(True))
            shared = shared.join(whole.hint("merge"), "span", "left")
        else:  # the core of a single window is the window
            shared = shared.withColumn("whole", F.lit(True))
        shared = work.save(shared.select("row", "x", "low", "high", "core", "span", "whole"), f"shared{size}")
        work.drop(f"cells{size}", f"cores{size}", f"spans{size}")
        gone.append(shared.filter("whole").select("row", F.expr("x - high").alias("s"), F.expr("x - low").alias("e")))
        # Open cells go on, and one cell of each settled span of their buckets, which they may repeat.
        unsettled = shared.filter("whole IS NULL")
        beside = (
            shared.filter("whole")
            .groupBy("core", "span")
            .agg(F.min(F.struct(*STATE)).alias("one"))
            .join(unsettled.select("core").distinct().hint("merge"), "core", "left_semi")
        )
        still = unsettled.select(*STATE).unionByName(beside.select("one.*"))
    cover = gone[0]
    for more in gone[1:]:
        cover = cover.unionByName(more)
    cover = cover.groupBy("row").agg(F.collect_list(F.struct("s", "e")).alias("gone"))
    return (
        texts.join(cover.hint("shuffle_hash"), "row", "left")
        .select("doc_id", "body", "gone")
        .mapInArrow(_remove(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_bucket_pointer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(remove_repeats(table(spark, sf_dir, "documents")))


def brute_force(texts: list[bytes], length: int) -> list[tuple[int, int, str]]:
    """(removed, spans, sha256 of what is kept) of each text, from all windows."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mask[i : i + length] = b"\x01" * length
        kept = bytes(c for c, m in zip(t, mask, strict=True) if not m)
        spans = len([r for r in bytes(mask).split(b"\x00") if r])
        out.append((sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return out

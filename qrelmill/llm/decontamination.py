"""Benchmark decontamination: windows of benchmark words found again in training texts.

The benchmark's words are numbered and its windows of ``n`` words (a shorter item is one
window) go to every task as a hash set: a bitmap of hashes, the sorted hashes, and the word
numbers of each window, against which every hit is verified. A benchmark over
``block_bytes`` is cut into blocks that are sent one after the other, so that what a task
holds is bounded whatever the size of the benchmark; texts never meet it in a shuffle.

Words are runs of letters and digits after lower-casing A-Z; all characters beyond ASCII
count as letters. One translation of the bytes of a text makes both steps."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qrelmill.llm.work import Work, slices, table

N = 10
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
#: Words numbered, and windows hashed, at a time.
STRETCH = 1 << 18
PIECE_WINDOWS = 4096
LONG_WORD = 64
PLAIN = bytes(ord(" ") if c < 128 and not chr(c).isalnum() else ord(chr(c).lower()) if c < 128 else c for c in range(256))
#: Stands between texts; no word is equal to it.
BORDER = b"\x01"


def key_of(word: bytes) -> bytes:
    """The word, or a digest in place of a very long one."""
    return word if len(word) <= LONG_WORD else b"\x02" + hashlib.sha256(word).hexdigest().encode()


def pieces(bench: DataFrame, n: int) -> DataFrame:
    """item, piece: the words of an item, joined; long items in pieces of ``PIECE_WINDOWS``
    windows, so that no row is large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, out = [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = [key_of(w) for w in text.translate(PLAIN).split()]
                for start in range(0, max(1, len(words) - n + 1) if words else 0, PIECE_WINDOWS):
                    items.append(item)
                    out.append(b" ".join(words[start : start + PIECE_WINDOWS + n - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(out, pa.binary())], ["item", "piece"])

    rows = bench.select(F.col("item_id").cast("string").alias("item"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return rows.mapInArrow(run, "item string, piece binary")


class Length:
    """The distinct windows of one length: hash set, words, and items of each."""

    def __init__(self, length: int, windows: np.ndarray, items: np.ndarray):
        self.length = length
        self.words, number = np.unique(windows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([number.ravel(), items]), axis=1)
        self.seed = 0
        while True:  # until no two windows share a hash
            self.seed += 1
            hashes = self.hash(self.words.ravel(), np.arange(len(self.words)) * length)
            order = np.argsort(hashes)
            self.hashes = hashes[order]
            if (self.hashes[1:] != self.hashes[:-1]).all():
                break
        self.words = self.words[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by_place = np.argsort(place[pairs[0]], kind="stable")
        self.items = pairs[1][by_place]
        self.starts = np.searchsorted(place[pairs[0]][by_place], np.arange(len(order) + 1))
        self.shift = np.uint64(64 - max(16, int(len(order)).bit_length() + 4))
        self.maybe = np.zeros(1 << int(64 - int(self.shift)), bool)
        self.maybe[self.hashes >> self.shift] = True

    def hash(self, ids: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
        """Hashes of the windows that start ``at`` places of ``ids``."""
        with np.errstate(over="ignore"):
            factor = np.uint64((0x9E3779B97F4A7C15 * (2 * self.seed + 1)) & (2**64 - 1))
            h = np.zeros(at.stop - at.start if isinstance(at, slice) else len(at), np.uint64)
            for j in range(self.length):
                part = ids[at.start + j : at.stop + j] if isinstance(at, slice) else ids[at + j]
                h = (h + part.astype(np.uint64) + np.uint64(1)) * factor
                h ^= h >> np.uint64(29)
        return h

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``ids`` where a window starts, and the number of the window."""
        places, windows = [], []
        last = len(ids) - self.length + 1
        for start in range(0, last, STRETCH):
            h = self.hash(ids, slice(start, min(last, start + STRETCH)))
            some = np.flatnonzero(self.maybe[h >> self.shift])
            found = np.searchsorted(self.hashes, h[some])
            same = self.hashes[np.minimum(found, len(self.hashes) - 1)] == h[some]
            some, found = some[same] + start, found[same]
            sure = np.ones(len(some), bool)
            for j in range(self.length):  # word for word
                sure &= ids[some + j] == self.words[found, j]
            places.append(some[sure])
            windows.append(found[sure])
        if not places:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(places), np.concatenate(windows)


class Windows:
    """All windows of some benchmark pieces. Items are numbered in the order of their names;
    an item without a name has -1: its windows hit, but it is not counted."""

    def __init__(self, rows: list[tuple[str | None, bytes]], n: int):
        self.names = sorted({item for item, _ in rows if item is not None})
        number = {name: i for i, name in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        found: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        for item, piece in rows:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in piece.split(b" ")], np.int32)
            windows = np.lib.stride_tricks.sliding_window_view(ids, min(n, len(ids)))
            some = found.setdefault(windows.shape[1], ([], []))
            some[0].append(windows)
            some[1].append(np.full(len(windows), number.get(item, -1)))
        self.long_words = any(w[:1] == b"\x02" for w in self.vocabulary)
        self.lengths = [Length(k, np.concatenate(w), np.concatenate(i)) for k, (w, i) in sorted(found.items())]

    def numbered(self, texts: list[bytes]) -> np.ndarray:
        """The word numbers of all texts, -1 after each text and 0 for words of no window."""
        data = (b" " + BORDER + b" ").join([t.translate(PLAIN) for t in [*texts, b""]])
        known, parts, at = self.vocabulary.get, [], 0
        while at < len(data):
            end = data.find(b" ", at + 8 * STRETCH)
            words = data[at : end if end >= 0 else len(data)].split()
            if self.long_words:
                words = map(key_of, words)
            parts.append(np.fromiter([-1 if w == BORDER else known(w, 0) for w in words], np.int32))
            at = end if end >= 0 else len(data)
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def find(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, list[str]]]:
        """For each text: its number of words, which of them are hit, and the items that hit."""
        ids = self.numbered(texts)
        ends = np.flatnonzero(ids == -1)
        change = np.zeros(len(ids) + 1, np.int32)
        spots: list[tuple[Length, np.ndarray, np.ndarray]] = []
        for length in self.lengths:
            places, windows = length.hits(ids)
            change[: len(ids)] += np.bincount(places, minlength=len(ids)).astype(np.int32)[: len(ids)]
            change -= np.bincount(places + length.length, minlength=len(ids) + 1).astype(np.int32)
            spots.append((length, places, windows))
        hit = np.cumsum(change[:-1]) > 0
        start = 0
        for end in ends:
            names: list[str] = []
            if hit[start:end].any():
                items = []
                for length, places, windows in spots:
                    lo, hi = np.searchsorted(places, [start, end])
                    items += [length.items[length.starts[w] : length.starts[w + 1]] for w in np.unique(windows[lo:hi])]
                names = [self.names[i] for i in np.unique(np.concatenate(items)) if i >= 0]
            yield end - start, hit[start:end], names
            start = end + 1


def runs(hit: np.ndarray) -> np.ndarray:
    """First and end of each run of hits, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate(([False], hit, [False]))))


def without(text: bytes, spans: list[int]) -> bytes:
    """``text`` without the words of ``spans``, from the first letter of a span to its last."""
    plain = np.frombuffer(text.translate(PLAIN), np.uint8) != ord(" ")
    edges = runs(plain)
    firsts, ends = edges[::2], edges[1::2]
    kept, at = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        kept.append(text[at : firsts[a]])
        at = ends[b - 1]
    return b"".join([*kept, text[at:]])


FOUND = "n_words long, n_hit long, spans array<int>, items array<string>"


def _marked(rows: DataFrame, windows: Windows) -> DataFrame:
    """``rows`` (..., body binary, spans, items) with the hits of ``windows`` added."""
    shared = rows.sparkSession.sparkContext.broadcast(windows)  # of block_bytes of text at most
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", SLICE_BYTES):
            texts = batch.column("body").to_pylist()
            n_words, n_hit, spans, items = [], [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
            for (total, hit, found), (old, named) in zip(shared.value.find(texts), before, strict=True):
                for a, b in zip(old[::2], old[1::2], strict=True):
                    hit[a:b] = True
                n_words.append(total)
                n_hit.append(int(hit.sum()))
                spans.append(runs(hit))
                items.append(sorted({*named, *found}) if named else found)
            new = {
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.int32())),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in names], names)

    return rows.mapInArrow(run, rows.schema)


def _scanned(rows: DataFrame, bench: DataFrame, n: int, block_bytes: int) -> DataFrame:
    """``rows`` (..., body) with what the whole benchmark hits (``FOUND``)."""
    work = Work(rows.sparkSession, "decontamination")
    cut = work.save(pieces(bench, n), "pieces")
    size = F.length("piece") + F.coalesce(F.length("item"), F.lit(0)) + 16
    blocks = max(1, -(-(cut.agg(F.sum(size)).first()[0] or 0) // block_bytes))
    while True:  # pieces are far smaller than a block
        dealt = cut.withColumn("block", F.pmod(F.xxhash64("item", "piece"), F.lit(blocks)))
        largest = dealt.groupBy("block").agg(F.sum(size).alias("size")).agg(F.max("size")).first()[0] or 0
        if largest <= 2 * block_bytes:
            break
        blocks *= 2
    names = [c.strip().split(" ") for c in FOUND.split(", ")]
    none = {c: F.lit(0).cast("long") if kind == "long" else F.array().cast(kind) for c, kind in names}
    rows = rows.select("*", *(value.alias(c) for c, value in none.items()))
    for block in range(blocks):
        some = dealt.filter(F.col("block") == block).select("item", "piece").collect()  # 2 * block_bytes at most
        marked = _marked(rows, Windows([(r["item"], bytes(r["piece"])) for r in some], n))
        if block == blocks - 1:
            return marked
        rows = work.save(marked, f"block{block}")
        if block:
            work.drop(f"block{block - 1}")
    return rows


def scan(docs: DataFrame, bench: DataFrame, n: int = N, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, spans, items of every row of ``docs`` (doc_id, text): the number
    of words, of words inside a window of a benchmark item, the first word and end of each
    run of them in turn, and the items with such a window, sorted as strings.

    ``bench``: item_id, text. Null texts have no words, and an item without words no window.
    An item without an id hits, but is not listed; items that share an id are one. Repeated
    rows stay rows. Other columns are not read. Without a benchmark nothing is hit."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"))
    return _scanned(rows, bench, n, block_bytes).drop("body")


def decontaminate(
    docs: DataFrame, bench: DataFrame, remove: str = "spans", n: int = N, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` without what ``scan`` finds, columns unchanged: with ``remove`` "spans" every
    run of hit words is cut out of its text, with "documents" the documents that have one
    go. Null texts stay null."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(whole, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"))
    found = _scanned(rows, bench, n, block_bytes)
    if remove == "documents":
        return found.filter("n_hit = 0").select("row.*")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", SLICE_BYTES):
            texts = [
                without(body, spans).decode("utf-8") if spans else None
                for body, spans in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "rest"])

    kept = found.select("row", "body", "spans").mapInArrow(cut, f"row {docs.schema.simpleString()}, rest string")
    text = F.coalesce("rest", "row.text").alias("text")
    return kept.select(*(text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def op13_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS MATERIALIZED (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS MATERIALIZED (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
t AS MATERIALIZED (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k))),
m AS MATERIALIZED (SELECT t.r, t.i, t.n, k.item FROM t JOIN k ON t.n = k.n AND t.g = k.g),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m WHERE item IS NOT NULL) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(s.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.r = d.r LEFT JOIN s ON s.r = d.r
"""

"""LM scoring by online logistic context mixing.

A word is coded by the six bits of its class, a hash, and by its frequency inside the
class. Each bit is predicted from counts in several hashed contexts: the bits before it
alone, with the last word, and with the last two words. The predictions are mixed in the
logistic domain by weights that a gate selects: the bit's place and how often the longest
context was seen. A text starts with the same weights everywhere and refines them as it
goes, block by block, by the gradient of its coding cost, so its score depends on the
training counts and on itself only.

Training counts cover all training texts. Words are counted exactly; the at most ``HEAD``
most frequent are sent to all tasks. Contexts have slots in a table that grows with the
corpus: a bucket for each ``BUCKET_BYTES`` of text, 2^26 slots in a bucket, so that one or
two slots in a hundred are in use at any size. Rows between tasks are not single keys but
sorted arrays of them: a slice of about ``SLICE`` bytes of text sends each bucket its keys
and how often its training texts hold them; the bucket sums all slices and answers each with
the counts on the way to its classes; slice and answers meet again to be mixed. Slices are
the same in both passes as long as a partition's rows come in one order; if they do not, the
answers do not fit and the job ends with an error."""

from __future__ import annotations

from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qrelmill.llm.shingles import WordHashes, combine, word_hashes, words_of
from qrelmill.llm.work import Work, slices, table

CLASS_BITS = 6
CLASSES = 1 << CLASS_BITS
BUCKET_BYTES = 8 << 20  # of text, for each bucket of contexts
SLICE = 4 << 20
ORDERS = 3
HEAD = 1 << 20
ADDED = 0.1  # of the base score
PRIOR = 0.4  # of a bit's counts
START = (0.4, 0.3, 0.3)
RATE = 0.004
BLOCK = 32
GATES = 4
TOGETHER = 256

#: Hashes of what is no word: the end, and the two places before the first word.
END, BEFORE = 0x9D8A7C6B5F4E3D21, 0x1B2C3D4E5F607182

_DEPTHS = np.arange(CLASS_BITS)
_ROUND = np.uint64(CLASSES - 1)

#: Of a worker process: hashes of the words that it met last.
WORDS = WordHashes()


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, none negative, in the fewest bytes that hold the largest, as compressed
    planes: all lowest bytes first, all highest last. The first byte says how many."""
    width = max(1, -(-int(values.max()).bit_length() // 8)) if values.size else 1
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), np.uint8).reshape(packed[0], -1)
    out = np.zeros((planes.shape[1], np.dtype(dtype).itemsize), np.uint8)
    out[:, : packed[0]] = planes.T
    return out.view(dtype).ravel()


def joined(packed: list[bytes], dtype) -> np.ndarray:
    return np.concatenate([np.empty(0, dtype), *(unpack(p, dtype) for p in packed)])


class Tokens:
    """Hashed tokens of a batch of texts, one after the other."""

    def __init__(self, texts: pa.Array, cache: WordHashes):
        hashes, sizes = [], []
        for text in texts:
            words = words_of(text.as_py())
            hashes.append(word_hashes(words, cache))
            hashes.append(np.array([END], np.uint64))
            sizes.append(len(words) + 1)
        self.hash = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.size = np.array(sizes, np.int64)
        self.words, self.word = np.unique(self.hash, return_inverse=True)
        self.start = np.cumsum(self.size) - self.size
        self.group = (self.hash >> np.uint64(64 - CLASS_BITS)).astype(np.int64)
        n = len(self.hash)
        before = np.full(n + 2, np.uint64(BEFORE))
        before[2:] = self.hash
        one, two = before[1 : n + 1].copy(), before[:n].copy()
        first = self.start[self.size > 0]
        one[first] = np.uint64(BEFORE)
        two[first] = np.uint64(BEFORE)
        second = first[self.size[self.size > 0] > 1] + 1
        two[second] = np.uint64(BEFORE)
        last = combine(one, 1) if n else one
        both = combine(np.stack([two, one], axis=1).ravel(), 2)[::2] ^ np.uint64(END) if n else one
        #: Contexts of the orders 1 and 2, with room for a class in the low bits.
        self.keys = np.stack([last, both]) & ~_ROUND


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        tokens = Tokens(batch.column("text"), WORDS)
        word, n = tokens.words, np.bincount(tokens.word)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n, pa.int64())], ["word", "n"])


def paths(entries: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For sorted distinct entries, a slot and a class in the low bits, and their counts:
    counts (entry, depth) of what shares the slot and the first ``depth`` bits of the class."""
    out = np.empty((len(entries), CLASS_BITS + 1), np.float32)
    for depth in range(CLASS_BITS + 1):
        node = entries >> entries.dtype.type(CLASS_BITS - depth)
        new = np.concatenate(([True], node[1:] != node[:-1]))
        starts = np.flatnonzero(new)
        out[:, depth] = np.add.reduceat(n, starts)[np.cumsum(new) - 1]
    return out


def stretch(path: np.ndarray) -> np.ndarray:
    """The prediction (entry, depth) of the bits that follow, in the logistic domain. It is
    that of the bit there is, not of a 1: the mixing is the same for both."""
    seen, agree = path[:, :-1], path[:, 1:]
    return np.log((agree + np.float32(PRIOR)) / (seen - agree + np.float32(PRIOR)))


def gates(seen: np.ndarray) -> np.ndarray:
    return (seen >= 1).astype(np.int16) + (seen >= 16) + (seen >= 256)


class Model:
    """What every scoring task holds: frequent words and what is known of classes."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, per_class: np.ndarray):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        #: log10 of what a class's counts sum to, smoothed, with one unknown word a class
        self.class_total = np.log10(per_class[0] + ADDED * (per_class[1] + 1))
        self.alone = stretch(paths(np.arange(CLASSES), per_class[0]))

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of frequent words; 0 for all others."""
        return look_up(self.words, self.counts, hashes)


def look_up(known: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of ``wanted`` in the sorted ``known``; 0 for none."""
    if not len(known):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, values[at], 0)


def mix(tokens: Tokens, model: Model, seen: list[np.ndarray], at: list[np.ndarray]) -> np.ndarray:
    """log10 probability of the class bits of each text. For the orders 1 and 2, ``seen`` are
    the paths of entries and ``at`` the entry of each token."""
    total = np.zeros(len(tokens.size))
    tables = [model.alone, *(stretch(p) for p in seen)]
    places = [tokens.group, *at]
    gate_of = gates(seen[-1][:, :-1]) * np.int16(CLASS_BITS) + _DEPTHS.astype(np.int16)
    low, high, one = np.float32(1e-6), np.float32(1 - 1e-6), np.float32(1)
    order = np.argsort(-tokens.size, kind="stable")
    for begin in range(0, len(order), TOGETHER):
        docs = order[begin : begin + TOGETHER]
        weights = np.repeat(np.array(START, np.float32)[:, None], len(docs) * GATES * CLASS_BITS, axis=1)
        for step in range(0, int(tokens.size[docs[0]]), BLOCK):
            active = docs[tokens.size[docs] > step]  # the longest come first
            inside = step + np.arange(BLOCK) < tokens.size[active][:, None]
            text, place = np.nonzero(inside)
            here = tokens.start[active[text]] + step + place
            stretched = [t.take(p[here], axis=0) for t, p in zip(tables, places, strict=True)]
            gate = gate_of.take(places[-1][here], axis=0) + text[:, None] * (GATES * CLASS_BITS)
            dot = sum(w.take(gate) * x for w, x in zip(weights, stretched, strict=True))
            p = np.clip(one / (one + np.exp(-dot)), low, high)
            cost = np.log10(np.multiply.reduce(p, axis=1))  # at least 1e-36 before the logarithm
            total[active] += np.bincount(text, cost, minlength=len(active))
            error = (one - p) * np.float32(RATE)
            flat, size = gate.ravel(), len(active) * GATES * CLASS_BITS
            for w, x in zip(weights, stretched, strict=True):
                w[:size] += np.bincount(flat, (error * x).ravel(), minlength=size)
            np.clip(weights[:, :size], -2, 4, out=weights[:, :size])
    return total


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(id, rows) of slices: they end with the row that fills ``SLICE`` bytes, where a text
    counts a little more than its own, so that empty ones fill slices too."""
    held, size = [], 0

    def whole() -> tuple[int, pa.Table]:
        rows = pa.Table.from_batches(held).combine_chunks()
        return rows.column("row")[0].as_py(), rows

    for batch in batches:
        start, ends = 0, np.cumsum(batch.column("n_bytes").to_numpy() + 16)
        while start < batch.num_rows:
            end = int(np.searchsorted(ends, SLICE - size + (ends[start - 1] if start else 0))) + 1
            full = end <= batch.num_rows
            end = min(end, batch.num_rows)
            held.append(batch.slice(start, end - start))
            size += int(ends[end - 1] - (ends[start - 1] if start else 0))
            start = end
            if full:
                yield whole()
                held, size = [], 0
    if held:
        yield whole()


def entries_of(keys: np.ndarray, buckets: int, low: int) -> np.ndarray:
    """(bucket, rest) of hashes, as numbers that sort by bucket first: the bucket from the
    upper half of a hash, ``low`` bits of the lower half as the rest."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return (bucket << np.uint64(low)) | (keys & np.uint64((1 << low) - 1))


def asked(tokens: Tokens, count: np.ndarray, buckets: int):
    """For the kinds 0 (words whose ``count`` is 0), 1 and 2 (contexts): the keys in the order in
    which buckets see and answer them, the bucket of each, and each token's place (-1: none)."""
    rare = count == 0
    words = tokens.words[rare]
    at = np.where(rare, np.cumsum(rare) - 1, -1)[tokens.word]
    bucket = ((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    yield words, bucket.astype(np.int64), at
    for keys in tokens.keys:
        found, back = np.unique(entries_of(keys | tokens.group.astype(np.uint64), buckets, 32), return_inverse=True)
        yield found.astype(np.uint32), (found >> np.uint64(32)).astype(np.int64), back


def _ask(shared, buckets: int):
    """Rows (kind, bucket, slice, keys, counts): what a slice asks and adds to each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for name, rows in sliced(batches):
            tokens = Tokens(rows.column("text").chunk(0), WORDS)
            learnt = ~np.repeat(rows.column("held_out").to_numpy(), tokens.size)
            for kind, (keys, bucket, at) in enumerate(asked(tokens, model.count(tokens.words), buckets)):
                counts = np.bincount(at[learnt & (at >= 0)], minlength=len(keys)).astype(np.uint32)
                new = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(new[1:], len(bucket))
                parts = list(zip(new.tolist(), ends.tolist(), strict=True)) if len(bucket) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(parts), kind, np.int8)),
                        pa.array(bucket[[a for a, _ in parts]].astype(np.int32), pa.int32()),
                        pa.array(np.full(len(parts), name, np.int64)),
                        pa.array([pack(np.diff(keys[a:b], prepend=keys.dtype.type(0))) for a, b in parts], pa.binary()),
                        pa.array([pack(counts[a:b]) for a, b in parts], pa.binary()),
                    ],
                    names=["kind", "bucket", "slice", "keys", "counts"],
                )

    return run


def _answer(part: pa.Table) -> pa.Table:
    """One bucket: the counts of all slices summed, and for each slice those of its keys.

    A word has its count. A context's entry has the counts on its way: first how often the
    context was seen, then, unless all of that was the same class, what is lost at each step
    of the way."""
    kind = part.column("kind")[0].as_py()
    dtype = np.uint32 if kind else np.uint64
    keys = [np.cumsum(unpack(k, dtype), dtype=dtype) for k in part.column("keys").to_pylist()]
    ends = np.cumsum([len(k) for k in keys])[:-1]
    found, back = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(back, joined(part.column("counts").to_pylist(), np.uint32), minlength=len(found))
    way = paths(found, n) if kind else None
    first, differ, rest = [], [], []
    for one in np.split(back, ends):
        if way is None:
            first.append(pack(n[one].astype(np.int64)))
            differ.append(b"")
            rest.append(b"")
        else:
            mine = way[one]
            several = mine[:, 0] != mine[:, -1]
            first.append(pack(mine[:, 0].astype(np.int64)))
            differ.append(np.packbits(several).tobytes())
            rest.append(pack(-np.diff(mine[several].T.astype(np.int64), axis=0)))
    return pa.table(
        {
            "slice": part.column("slice"),
            "kind": part.column("kind"),
            "bucket": part.column("bucket"),
            "first": pa.array(first, pa.binary()),
            "differ": pa.array(differ, pa.binary()),
            "rest": pa.array(rest, pa.binary()),
        }
    )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (slice, rows): a slice as one compressed Arrow stream."""
    for name, rows in sliced(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_table(rows)
        packed = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([packed], pa.binary())], ["slice", "rows"])


def _mix(shared, buckets: int, total: int, distinct: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        model = shared.value
        rows = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(texts.column("rows")[0].as_py())).read_all()
        answers = answers.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        kinds = answers.column("kind").to_numpy()
        tokens = Tokens(rows.column("text").combine_chunks(), WORDS)
        size = len(tokens.size)

        def blobs(name: str, kind: int) -> list[bytes]:
            begin, end = np.searchsorted(kinds, [kind, kind + 1])
            return answers.column(name).slice(begin, end - begin).to_pylist()

        count = model.count(tokens.words)
        seen, at = [], []
        for kind, (keys, _, where) in enumerate(asked(tokens, count, buckets)):
            parts = [unpack(b, np.int64) for b in blobs("first", kind)]
            first = np.concatenate(parts) if parts else np.empty(0, np.int64)
            if len(first) != len(keys):
                raise RuntimeError("a slice changed between two passes: store the input first")
            if kind == 0:
                count[count == 0] = first
                continue
            bits = zip(blobs("differ", kind), parts, strict=True)
            differ = np.concatenate([np.unpackbits(np.frombuffer(d, np.uint8), count=len(f)) for d, f in bits])
            path = np.repeat(first.astype(np.float32)[:, None], CLASS_BITS + 1, axis=1)
            lost = np.concatenate([unpack(r, np.int64).reshape(CLASS_BITS, -1) for r in blobs("rest", kind)], axis=1)
            path[differ == 1, 1:] = (first[differ == 1] - np.cumsum(lost, axis=0)).T
            seen.append(path), at.append(where)
        mixed = mix(tokens, model, seen, at)
        of = np.repeat(np.arange(size), tokens.size)
        sums = lambda x: np.bincount(of, x, minlength=size)
        logs = sums(np.log10(count + ADDED)[tokens.word])
        result = logs - sums(model.class_total[tokens.group]) + mixed
        n_bytes = rows.column("n_bytes").to_numpy()
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "held_out": rows.column("held_out"),
                "n_tokens": pa.array(tokens.size),
                "n_known": pa.array(sums((count > 0)[tokens.word]).astype(np.int64)),
                "train_tokens": pa.array(np.full(size, total, np.int64)),
                "base_score": pa.array(logs - tokens.size * log10(total + ADDED * (distinct + 1))),
                "score": pa.array(result),
                "bits_per_byte": pa.array(-result / log10(2) / np.maximum(n_bytes, 1), mask=n_bytes == 0),
            }
        )

    return run


def _cut(by_size: dict[int, int], room: int) -> int:
    """The least power of two from which on at most ``room`` counts are as large."""
    cut = 64
    for s in range(63, -1, -1):
        room -= by_size.get(s, 0)
        if room < 0:
            break
        cut = s
    return cut


def fit(training: DataFrame, work: Work, head: int = HEAD):
    """(model, tokens, distinct words) of ``training`` (text). The model lists the at most
    ``head`` most frequent words, cut where a power of two of the count begins."""
    words = work.save(
        training.select("text").mapInArrow(_train, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    group = F.shiftrightunsigned("word", 64 - CLASS_BITS)
    size = F.floor(F.log2("n")).cast("int")
    cells = words.groupBy(group.alias("c"), size.alias("s")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    per_class = np.zeros((2, CLASSES))
    by_size: dict[int, int] = {}
    for c in cells:  # at most CLASSES * 64 rows
        per_class[:, c["c"]] += (c["n"], c["v"])
        by_size[c["s"]] = by_size.get(c["s"], 0) + c["v"]
    cut = _cut(by_size, head)
    frequent = words.filter(F.col("n") >= 2.0**cut).toArrow()  # at most ``head`` rows
    model = Model(frequent["word"].to_numpy().view(np.uint64), frequent["n"].to_numpy(), per_class)
    return model, int(per_class[0].sum()), int(per_class[1].sum())


def score(docs: DataFrame, head: int = HEAD, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte.

    Rows whose crc32(doc_id as text) mod 10 is not 0 are learnt from; a null id counts as
    empty text, so it is held out. A null or empty text has its end token only, and no bits
    per byte. Repeated rows are scored, and learnt from, one by one. Without training rows
    no word is known. An empty table gives an empty result. Other columns are not read.
    Words are compared by 64-bit hashes, contexts by their bucket and 26 bits of a hash."""
    spark = docs.sparkSession
    work = Work(spark, "context-mixing")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
    )
    buckets = -(-(rows.agg(F.sum("n_bytes")).first()[0] or 1) // bucket_bytes)
    model, total, distinct = fit(rows.filter(~F.col("held_out")), work, head)
    shared = spark.sparkContext.broadcast(model)  # at most ``head`` words
    asks = rows.mapInArrow(_ask(shared, buckets), "kind byte, bucket int, slice long, keys binary, counts binary")
    answers = asks.groupBy("kind", "bucket").applyInArrow(
        _answer, "slice long, kind byte, bucket int, first binary, differ binary, rest binary"
    )
    texts = rows.mapInArrow(_texts, "slice long, rows binary")
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, bits_per_byte double"
    )
    return texts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_mix(shared, buckets, total, distinct), schema)


def op10_logistic_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))

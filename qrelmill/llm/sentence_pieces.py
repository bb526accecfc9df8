"""SentencePiece encoding and decoding by a streaming Viterbi search.

The trellis has a node for each character position and keeps the best last piece of each.
Only the positions of a window as long as the longest piece can still be continued. Once
the paths from all of them lead back to one position, that part of the path is certain:
its ids are emitted and the trellis in front of it is forgotten.

For a unigram model the best path has the highest sum of scores. For a BPE model, the
library's segmentation is the one path on which no two neighbouring pieces would have been
merged differently: a transition is allowed if the merges over both pieces alone give
these two pieces again. Each position then has just one last piece, found the same way."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qrelmill.llm.work import slices, table

# Fixed values of the format.
SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
UNKNOWN_TEXT = " ⁇ "

MAX_UNITS = 700_000
MAX_PAIRS = 600_000
LONG_UNIT = 48


class PieceModel:
    """The pieces of a model file, with both directions."""

    def __init__(self, path: str, model_type: int | None = None):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm = proto.normalizer_spec
        if norm.name != "identity" or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are read")
        self.type = model_type or proto.trainer_spec.model_type
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER)}
        self.score = {p.piece: p.score for p in proto.pieces if p.type in (NORMAL, USER)}
        self.longest = max(map(len, self.pieces))
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown_score = min(self.score.values()) - UNKNOWN_PENALTY
        self.shown = [
            bytes([int(p.piece[3:-1], 16)])
            if p.type == BYTE
            else b""
            if p.type == CONTROL
            else UNKNOWN_TEXT.encode()
            if p.type == UNKNOWN
            else p.piece.replace(SPACE, " ").encode()
            for p in proto.pieces
        ]
        #: No piece goes from another character to a space mark: all paths meet there.
        self.meets = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces)
        self.unit = re.compile(f"[ {SPACE}]*[^ {SPACE}]+|[ {SPACE}]+" if self.meets else "(?s).+")
        #: Ends of pieces: a candidate that is none cannot grow into a piece.
        self.ends = {p[i:] for p in self.pieces for i in range(len(p))}
        self._pairs: dict[tuple[str | None, str], bool] = {}
        self._units: dict[str, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """The merges of a short text, best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stable(self, a: str | None, b: str) -> bool:
        """Whether the merges over both pieces give them again; with no ``a``, over ``b``."""
        if len(self._pairs) > MAX_PAIRS:
            self._pairs.clear()
        got = self._pairs[a, b] = (self.merge(b) == [b]) if a is None else (self.merge(a + b) == [a, b])
        return got

    def _candidates(self, text: str, end: int, base: int) -> list[tuple[int, str]]:
        """(start, piece) of all pieces that end at ``end``, shortest first; a character
        that is no piece is one."""
        out, pieces, ends = [], self.pieces, self.ends
        start = end - 1
        p = text[start:end]
        out.append((start, p))
        while p in ends and start > base:
            start -= 1
            p = text[start:end]
            if p in pieces:
                out.append((start, p))
        return out

    def segment(self, text: str) -> Iterator[list[str]]:
        """The pieces of ``text``, in runs, as they become certain."""
        base, n, limit = 0, len(text), 2 * self.longest
        score: list[float] = [0.0]
        last: list[str | None] = [None]
        bpe, pieces, ends, pairs, stable = self.type == BPE, self.pieces, self.ends, self._pairs, self._stable
        for end in range(1, n + 1):
            if bpe:
                # The longest end of a piece here, then the pieces from long to short.
                start = end - 1
                while start > base and text[start - 1 : end] in ends:
                    start -= 1
                while True:
                    p = text[start:end]
                    if p in pieces or start == end - 1:
                        before = last[start - base]
                        ok = pairs.get((before, p))
                        if ok or (ok is None and stable(before, p)):
                            break
                    start += 1
                last.append(p)
            else:
                best, piece = None, ""
                for start, p in self._candidates(text, end, base):
                    total = score[start - base] + self.score.get(p, self.unknown_score)
                    if best is None or total > best:
                        best, piece = total, p
                score.append(best)
                last.append(piece)
            if end == n or end - base >= limit:
                meet = end if end == n else self._meeting(base, end, last)
                if meet > base:
                    yield self._path(base, meet, last)
                    del score[: meet - base], last[: meet - base]
                    base = meet

    def _meeting(self, base: int, end: int, last: list[str | None]) -> int:
        """The position that the paths of all live positions have in common."""
        live = set(range(end - self.longest + 1, end + 1))
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(top - len(last[top - base]) if top > base else base)
        return live.pop()

    @staticmethod
    def _path(base: int, at: int, last: list[str | None]) -> list[str]:
        out = []
        while at > base:
            out.append(last[at - base])
            at -= len(out[-1])
        return out[::-1]

    def _ids(self, unit: str) -> bytes:
        ids: list[int] = []
        for run in self.segment(unit.replace(" ", SPACE)):
            for piece in run:
                i = self.pieces.get(piece)
                if i is not None:
                    ids.append(i)
                elif self.bytes:
                    ids += (self.bytes[b] for b in piece.encode())
                else:
                    ids.append(self.unknown)
        out = np.array(ids, np.int32).tobytes()
        if len(unit) <= LONG_UNIT:
            if len(self._units) > MAX_UNITS:
                self._units.clear()
            self._units[unit] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as packed 32-bit integers."""
        if not text:
            return b""
        get, ids = self._units.get, self._ids
        return b"".join([get(u) or ids(u) for u in self.unit.findall(self.prefix + text)])

    def decode(self, ids: list[int]) -> str:
        shown = self.shown
        text = b"".join([shown[i] for i in ids]).decode("utf-8", "replace")
        return text[len(self.prefix) :] if text[:1] == " " else text


@lru_cache(maxsize=2)
def loaded(path: str) -> PieceModel:
    """One model per worker process and file."""
    return PieceModel(path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids of each row of ``docs`` (doc_id, text), with ``model`` on every node.

    A null or empty text has no ids. Null or repeated ids keep a row each; an empty table
    gives an empty result; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model)
        for batch in slices(batches, "text"):
            packed = [pieces.encode(t.as_py() or "") for t in batch.column("text")]
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
            ids = np.frombuffer(b"".join(packed), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text of each row of ``encoded`` (doc_id, ids); null ids decode to null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model)
        for batch in batches:
            texts = [None if (i := x.as_py()) is None else pieces.decode(i) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
    return rows.mapInArrow(run, "doc_id long, text string")


def encode_checked(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_ids, ids, round_trip: each text is encoded, decoded and compared.

    The model writes a space mark as a space, so a text that holds the mark itself counts
    as round-tripped when the two differ in nothing else. Nulls as in ``encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model)
        for batch in slices(batches, "text"):
            packed, same = [], []
            for t in batch.column("text"):
                text = t.as_py() or ""
                packed.append(ids := pieces.encode(text))
                same.append(pieces.decode(np.frombuffer(ids, np.int32).tolist()) == text.replace(SPACE, " "))
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
            ids = np.frombuffer(b"".join(packed), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), lists, pa.array(same, pa.bool_())],
                ["doc_id", "n_ids", "ids", "round_trip"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_ids long, ids array<int>, round_trip boolean")


def op3_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_checked(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))

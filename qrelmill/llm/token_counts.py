"""Token counts through a compiled tokenizer.

The byte-level BPE of a tokenizer file is compiled into a deterministic transducer over
bytes. A state is what the tokens still to come can depend on: the longest suffix that
begins some token, and for each position in it the last token there and the tokens emitted
since. Each transition is annotated with the number of tokens it emits (negative where a
byte joins tokens again). Transitions are made when first taken and dropped when there are
too many, as in a lazy automaton; they are a cache and never change a count.

Texts are cut into chunks. A chunk's state map says what it does to any state it may be
entered in: the ``head`` up to the first place where all states meet, the tokens emitted
from there on, and the ``tail`` behind the last such place, which is the state it leaves.
All states meet where white space follows another character, because no token spans that.
Maps compose associatively, so the maps of a text are reduced pairwise."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from math import inf
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qrelmill.llm.work import table

CHUNK_CHARS = 1 << 16
MAX_STATES = 400_000
MAX_WORDS = 400_000
LONG_WORD = 64

# The contractions that the byte-level pre-tokenizer splits off.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: Characters that count as white space in patterns (Unicode White_Space).
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: a printable Latin-1
    byte is itself, the others follow from code point 256 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    rest = [b for b in range(256) if b not in set(shown)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


def character_classes(path: str) -> tuple[str, str]:
    """The letters and the numbers as character classes.

    Code points that this Python's tables don't know yet are asked of the library."""
    import regex
    from tokenizers import Tokenizer

    ask = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    known = regex.compile(r"[\p{L}\p{N}]")
    of = []
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        kind = unicodedata.category(c)[0]
        if kind == "C" and unicodedata.category(c) == "Cn" and known.match(c):
            kind = "L" if len(ask(f"a{c}a")) == 1 else "N" if len(ask(f"1{c}1")) == 1 else kind
        of.append(kind)
    of.append("")

    def ranges(initial: str) -> str:
        parts, start = [], None
        for cp, kind in enumerate(of):
            if kind == initial and start is None:
                start = cp
            elif kind != initial and start is not None:
                parts.append(f"\\U{start:08x}-\\U{cp - 1:08x}")
                start = None
        return "".join(parts)

    return ranges("L"), ranges("N")


class Transducer:
    """Counts the tokens of pre-tokens by running bytes through lazy transitions."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.rank: dict[tuple[bytes, bytes], int] = {}
        made: dict[bytes, tuple[bytes, bytes, int]] = {}
        for i, merge in enumerate(spec["model"]["merges"]):
            a, b = (raw(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self.rank.setdefault((a, b), i)
            if made.setdefault(a + b, (a, b, i)) != (a, b, i):
                raise ValueError(f"two merges make {a + b!r}")
        self.made = made
        self._right: dict[bytes, list[tuple[bytes, float]]] = {}
        self._left: dict[bytes, list[tuple[bytes, float]]] = {}
        single = [bytes([b]) for b in range(256)]
        self.tokens = set(single) | {t for t, (a, b, r) in made.items() if not self._crossed(a, b, r)}
        self.prefixes = {t[:i] for t in self.tokens for i in range(len(t) + 1)}
        self._stable: dict[tuple[bytes, bytes], bool] = {}
        self._reset()
        self.words: dict[str, int] = {}
        words, numbers = character_classes(path)
        self.pattern = re.compile(
            f"{CONTRACTIONS}| ?[{words}]+| ?[{numbers}]+| ?[^{SPACE}{words}{numbers}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        )
        self.sync = re.compile(f"[^{SPACE}](?=[{SPACE}])")
        self.space = re.compile(f"[{SPACE}]")
        if any(self.space.search(t) for t in self.specials):
            raise ValueError("special strings with white space could be cut")
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None

    def _edge(self, token: bytes, side: int, cache: dict) -> list[tuple[bytes, float]]:
        """The parts of ``token`` that stand at one edge while it is built, each with the
        rank of the merge that takes it up (none takes up the whole)."""
        if token not in cache:
            out: list[tuple[bytes, float]] = [(token, inf)]
            part = token
            while part in self.made:
                rank = self.made[part][2]
                part = self.made[part][side]
                out.append((part, rank))
            cache[token] = out
        return cache[token]

    def _crossed(self, a: bytes, b: bytes, limit: float = inf) -> bool:
        """True if a merge over the border between two tokens comes before the merges that
        take up its parts; of equal ranks, the leftmost merges first."""
        for x, taken_x in self._edge(a, 1, self._right):
            for y, taken_y in self._edge(b, 0, self._left):
                r = self.rank.get((x, y))
                if r is not None and r < min(taken_x, limit) and r <= taken_y:
                    return True
        return False

    def stable(self, a: bytes, b: bytes) -> bool:
        got = self._stable.get((a, b))
        if got is None:
            got = self._stable[a, b] = not self._crossed(a, b)
        return got

    def _reset(self) -> None:
        start = (b"", ((None, 0),))
        self.states = [start]
        self.ids = {start: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self._stable.clear()

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        suffix, history = self.states[state]
        grown = suffix + bytes([byte])
        for j in range(len(grown)):
            token = grown[j:]
            if token in self.tokens:
                last, before = history[j]
                if last is None or self.stable(last, token):
                    break
        else:
            raise AssertionError("every byte is a token")
        emitted = before + 1
        history = (*history, (token, emitted))
        cut = 0
        while grown[cut:] not in self.prefixes:
            cut += 1
        following = (grown[cut:], tuple((t, n - emitted) for t, n in history[cut:]))
        to = self.ids.get(following)
        if to is None:
            to = self.ids[following] = len(self.states)
            self.states.append(following)
        out = self.steps[state << 8 | byte] = (to, emitted)
        return out

    def run(self, data: bytes) -> int:
        """Tokens of one pre-token."""
        if len(self.steps) > MAX_STATES or len(self.states) > MAX_STATES:
            self._reset()
        steps, state, total = self.steps, 0, 0
        for byte in data:
            state, emitted = steps.get(state << 8 | byte) or self._step(state, byte)
            total += emitted
        return total

    def __missing(self, word: str) -> int:
        n = self.run(word.encode())
        if len(word) <= LONG_WORD:
            if len(self.words) > MAX_WORDS:
                self.words.clear()
            self.words[word] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a text that begins and ends where all states meet, or of a whole text."""
        specials = 0
        parts = [text]
        if self.special:
            parts = self.special.split(text)
            specials = len(parts) - 1
        get, missing, total = self.words.get, self.__missing, specials
        for part in parts:
            for word in self.pattern.findall(part):
                n = get(word)
                total += missing(word) if n is None else n
        return total


class ChunkMap(NamedTuple):
    """What a chunk does to the state before it; without ``synced`` all of it is head."""

    head: str
    count: int
    tail: str
    synced: bool


def chunk_map(machine: Transducer, chunk: str) -> ChunkMap:
    first = machine.sync.search(chunk)
    if not first:
        return ChunkMap(chunk, 0, "", False)
    last = len(chunk) - 1
    space = machine.space
    while not (space.match(chunk, last) and not space.match(chunk, last - 1)):
        last -= 1
    return ChunkMap(chunk[: first.end()], machine.count(chunk[first.end() : last]), chunk[last:], True)


def compose(machine: Transducer, a: ChunkMap, b: ChunkMap) -> ChunkMap:
    """The map of two neighbours: associative, with the empty chunk's map as unit."""
    if not a.synced and not b.synced:
        joined = a.head + b.head
    elif a.synced and b.synced:
        between = machine_map(machine, a.tail + b.head)
        return ChunkMap(a.head, a.count + between + b.count, b.tail, True)
    else:
        joined = a.tail + b.head if a.synced else a.head + b.head
    # At a seam white space may follow another character where neither chunk saw it.
    seam = chunk_map(machine, joined)
    if not a.synced and not b.synced:
        return seam
    if a.synced:
        if not seam.synced:
            return ChunkMap(a.head, a.count, joined, True)
        return ChunkMap(a.head, a.count + machine.count(seam.head) + seam.count, seam.tail, True)
    if not seam.synced:
        return ChunkMap(joined, b.count, b.tail, True)
    return ChunkMap(seam.head, seam.count + machine.count(seam.tail) + b.count, b.tail, True)


def machine_map(machine: Transducer, between: str) -> int:
    """Tokens of a stretch whose both ends are meeting places."""
    return machine.count(between)


def reduce_maps(machine: Transducer, maps: list[ChunkMap]) -> int:
    """Tokens of a text from the maps of its chunks, composed pairwise level by level."""
    while len(maps) > 1:
        pairs = [compose(machine, maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)]
        maps = pairs + maps[len(pairs) * 2 :]
    whole = maps[0]
    return machine.count(whole.head) + whole.count + machine.count(whole.tail)


@lru_cache(maxsize=2)
def compiled(path: str) -> Transducer:
    """One transducer per worker process and file."""
    return Transducer(path)


def _map_chunks(path: str):
    schema = pa.schema(
        [
            ("row", pa.int64()),
            ("doc_id", pa.int64()),
            ("no", pa.int32()),
            ("n_bytes", pa.int64()),
            ("head", pa.string()),
            ("n", pa.int64()),
            ("tail", pa.string()),
            ("synced", pa.bool_()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(path)
        for batch in batches:
            chunks = batch.column("chunk")
            maps = [chunk_map(machine, c.as_py()) for c in chunks]
            heads, counts, tails, synced = zip(*maps, strict=True) if maps else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("no"),
                    batch.column("n_bytes"),
                    pa.array(heads, pa.string()),
                    pa.array(counts, pa.int64()),
                    pa.array(tails, pa.string()),
                    pa.array(synced, pa.bool_()),
                ],
                schema=schema,
            )

    return run


def _reduce_chunks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(path)
        for batch in batches:
            totals = [
                reduce_maps(machine, [ChunkMap(m["head"], m["n"], m["tail"], m["synced"]) for m in maps.as_py()])
                for maps in batch.column("maps")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is a byte-level BPE file that every node has at this path. Texts longer
    than ``chunk_chars`` are cut, and their chunks dealt to all tasks; only the maps come
    together again. A null text counts as empty and has no tokens; null or repeated ids
    keep a row each; an empty table gives an empty result; other columns are not read."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = F.length("text")
    short = rows.filter(size <= chunk_chars).select(
        "row", "doc_id", F.lit(0).alias("no"), F.octet_length("text").cast("long").alias("n_bytes"), F.col("text").alias("chunk")
    )
    cut = f"transform(sequence(0, (length(text) - 1) div {chunk_chars}), i -> substring(text, i * {chunk_chars} + 1, {chunk_chars}))"
    long = (
        rows.filter(size > chunk_chars)
        .select((-1 - F.col("row")).alias("row"), "doc_id", F.posexplode(F.expr(cut)).alias("no", "chunk"))
        .repartition("row", "no")
        .select("row", "doc_id", "no", F.octet_length("chunk").cast("long").alias("n_bytes"), "chunk")
    )
    maps = short.unionByName(long).mapInArrow(
        _map_chunks(tokenizer),
        "row long, doc_id long, no int, n_bytes long, head string, n long, tail string, synced boolean",
    )
    whole = maps.groupBy("row", "doc_id").agg(
        F.sum("n_bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("no", "head", "n", "tail", "synced"))).alias("maps"),
    )
    counted = whole.select("doc_id", "n_bytes", "maps").mapInArrow(
        _reduce_chunks(tokenizer), "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))

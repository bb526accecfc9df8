"""N-gram Jaccard join by T-occurrence search, and the components of its links.

1. Routing. Documents of similar size share a size class. For a class, at most d shingles
   can differ between two linked sets, so if hash space is cut into more than d segments,
   some segment holds the same shingles in both: its hash is a signature that linked sets
   share. A class has as many segments more as it may have empty ones, which sign
   nothing; a set with more empty ones, which small sets may have, signs the class as
   well. Shingles that very many sets hold, such as those of a licence line, are left out of
   the segments first: a segment with nothing else would lay all those sets in one block.
   A set that has too many empty segments without them signs with its whole set as well.
   Signatures are reduced inside each task, so a group of copies sends a row for each
   ``FLUSH`` signatures. Equal sets become one set; sets that share a signature land in
   one block.
2. Search. In a block the sets are indexed by inverted lists, one per shingle. For a set
   of a shingles a partner must occur on at least T = t * a of its lists. DivideSkip sets
   the L longest lists aside, merges the short ones, keeps what occurs T - L times there
   and finds the rest by binary search in the long lists.
3. Large blocks are cut into parts of bounded size. Each part is searched alone; then only
   sets outside the block's largest component are searched against all parts, since the
   others are connected already. No link between components is lost, and no pairs leave a
   task: only as many links as join its sets. The copies this takes are made in rounds of
   bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qrelmill.llm.components import components
from qrelmill.llm.shingles import WordHashes, shingle_set
from qrelmill.llm.work import Work, shuffles_removed, table

PART_SETS = 800
PART_SHINGLES = 1_500_000
FLUSH = 500_000  # signatures or shingles held by a task
ROWS = 1 << 16  # of a batch that a task sends
ROW_BYTES = 64  # of a row besides its text
REPEATED = 3  # sets among those of one flush, from which a shingle may be frequent
FREQUENT = 1 << 17  # shingles that are left out of segments
NONE = np.empty(0, np.uint64)
NULL_ID = -(1 << 63)  # a null id sorts before all others


class SizeClasses:
    """Size classes and, for the smaller set of a pair, how many segments its class needs."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lows = np.array([1], np.int64)
        self.plans: dict[int, tuple[int, int] | None] = {}

    def _extend(self, size: int) -> None:
        lows = self.lows.tolist()
        while lows[-1] <= size:
            low = lows[-1]
            lows.append(max(low + 1, (low - 1) * 100 // self.percent + 1))
        self.lows = np.array(lows, np.int64)

    def _plan(self, c: int) -> tuple[int, int] | None:
        """(segments, of them spare) of class ``c``; None where only equal sets can link."""
        if c not in self.plans:
            least, small = int(self.lows[c]), int(self.lows[c + 1]) - 1
            large = small * 100 // self.percent
            differ = (small + large) * (100 - self.percent) // (100 + self.percent)
            plan = None
            if differ:
                for spare in range(2, differ // 2 + 4):
                    m = differ + 1 + spare
                    plan = (m, spare)
                    empty = m * exp(-least / m)  # expected of the smallest sets
                    if empty + 4 * sqrt(empty) + 1 <= spare:
                        break
            self.plans[c] = plan
        return self.plans[c]

    def segments(self, size: int) -> list[tuple[int, int, int]]:
        """(class, segments, spare) under which a set of ``size`` signs: as the smaller one
        of a pair under its own class, as the larger one under the class before."""
        top = size * 100 // self.percent + 2
        if self.lows[-1] <= top:
            self._extend(2 * top)
        own = int(np.searchsorted(self.lows, size, side="right")) - 1
        out = []
        for c in (own, own - 1):
            if c >= 0 and (plan := self._plan(c)) is not None:
                out.append((c, *plan))
        return out


def _scramble(h: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(29)
    return h


def set_key(s: np.ndarray) -> np.uint64:
    """A hash of a whole set."""
    with np.errstate(over="ignore"):
        both = np.array([_scramble(s, 0x51ED).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)
    return _scramble(both, 0x7A11)[0]


def without(s: np.ndarray, some: np.ndarray) -> np.ndarray:
    """What a sorted set holds besides ``some``, sorted as well."""
    if not len(some):
        return s
    at = np.minimum(np.searchsorted(some, s), len(some) - 1)
    return s[some[at] != s]


def signatures(s: np.ndarray, classes: SizeClasses, frequent: np.ndarray = NONE) -> np.ndarray:
    """The signatures of a sorted set; linked unequal sets share at least one, whatever
    shingles are ``frequent`` (sorted). Where two sets agree in empty segments only, both
    have too many of them without the frequent shingles, and sign with all."""
    out = []

    def sign(part: np.ndarray, c: int, m: int, salt: int) -> int:
        """The number of empty segments."""
        if not len(part):
            return m
        segment = ((part >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(_scramble(part, 0x2545F491), starts)
            place = segment[starts] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(c * 0x1000193 + 1)
        out.append(_scramble(sums + _scramble(place, 0x0C1A55), salt))
        return m - len(starts)

    rare = without(s, frequent)
    for c, m, spare in classes.segments(len(s)):
        # Too many empty segments cannot be left out.
        if sign(rare, c, m, 0x516) > spare and (not len(frequent) or sign(s, c, m, 0xA11) > spare):
            out.append(_scramble(np.array([c], np.uint64), 0xE3717))
    return np.concatenate(out) if out else NONE


def _repeated(k: int):
    """Rows (shingle, n): shingles that at least ``REPEATED`` sets of one flush hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        sets: list[np.ndarray] = []
        held = 0

        def counted() -> pa.RecordBatch:
            shingles, n = np.unique(np.concatenate([NONE, *sets]), return_counts=True)
            some = n >= REPEATED
            sets.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(shingles[some].view(np.int64)), pa.array(n[some], pa.int64())], ["shingle", "n"]
            )

        for batch in batches:
            for text in batch.column("text"):
                sets.append(shingle_set(text.as_py(), k, cache))
                held += len(sets[-1])
                if held > FLUSH:
                    yield counted()
                    held = 0
        yield counted()

    return run


def frequent_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """The ``FREQUENT`` shingles that repeat most in ``docs`` (text), sorted. Every text is
    counted; which shingles these are decides how sets are dealt to blocks, not what links."""
    counts = docs.select("text").mapInArrow(_repeated(k), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    with shuffles_removed(docs.sparkSession):
        most = counts.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    return np.sort(most["shingle"].to_numpy().view(np.uint64))


def _sign(k: int, percent: int, frequent: Broadcast):
    """Rows (kind, key, doc, other, n): kind 0 maps a row to its set's first id in the task,
    kind 1 and 2 carry the keys of sets and signatures, kind 3 links ids inside the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, classes, often = WordHashes(), SizeClasses(percent), frequent.value
        first: dict[int, int] = {}
        keys: list[np.ndarray] = []
        docs: list[int] = []
        held = 0

        def rows(kind: int, key, doc, other, n) -> Iterator[pa.RecordBatch]:
            for start in range(0, len(doc), ROWS):
                part = slice(start, start + ROWS)
                size = len(doc[part])
                wide = lambda x: pa.array(x[part], pa.int64()) if x is not None else pa.nulls(size, pa.int64())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, kind, np.int8)), wide(key), wide(doc), wide(other), wide(n)],
                    ["kind", "key", "doc", "other", "n"],
                )

        def reduced() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if keys:
                key, doc = np.concatenate(keys), np.repeat(np.array(docs, np.int64), [len(x) for x in keys])
                keys.clear()
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                new = np.concatenate(([True], key[1:] != key[:-1]))
                least = doc[new]
                yield from rows(2, key[new].view(np.int64), least, None, None)
                links = np.stack([doc, least[np.cumsum(new) - 1]])[:, ~new]
                links = np.unique(links[:, links[0] != links[1]], axis=1)
                if links.size:
                    yield from rows(3, _scramble(links[0].view(np.uint64), 3).view(np.int64), links[0], links[1], None)
            if first:
                yield from rows(1, np.fromiter(first, np.uint64).view(np.int64), np.fromiter(first.values(), np.int64), None, None)
            keys.clear(), docs.clear(), first.clear()
            held = 0

        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            of, sizes = np.array(ids), np.zeros(len(ids), np.int64)
            for i, text in enumerate(batch.column("text")):
                s = shingle_set(text.as_py(), k, cache)
                sizes[i] = len(s)
                if len(s):
                    own = set_key(s)
                    seen = first.get(int(own))
                    if seen is None:
                        first[int(own)] = int(ids[i])
                        keys.append(signatures(s, classes, often))
                        docs.append(int(ids[i]))
                        held += len(keys[-1])
                    else:
                        of[i] = seen
                if held > FLUSH:
                    yield from reduced()
            yield from rows(0, _scramble(ids.astype(np.int64).view(np.uint64), 1).view(np.int64), ids, of, sizes)
        yield from reduced()

    return run


def t_occurrence(
    query: np.ndarray, lists: tuple[np.ndarray, np.ndarray, np.ndarray], sizes: np.ndarray, percent: int
) -> np.ndarray:
    """Indexes of the sets that link with ``query``. ``lists`` are the distinct shingles of
    the index, where each one's list starts, and the lists, ascending."""
    shingles, starts, posts = lists
    at = np.minimum(np.searchsorted(shingles, query), len(shingles) - 1)
    at = at[shingles[at] == query]
    a = len(query)
    need = -(-percent * a // 100)
    if len(at) < need:
        return np.empty(0, np.int64)
    begin, end = starts[at], starts[at + 1]
    length = end - begin
    order = np.argsort(length, kind="stable")
    longest = int(length[order[-1]])
    # DivideSkip: how many lists to set aside grows with T and falls with the longest list.
    aside = min(need - 1, int(need / (0.01 * log2(longest + 1) + 1)), int((length > 16).sum()))
    short, long = order[: len(at) - aside], order[len(at) - aside :]
    merged = np.concatenate([posts[begin[i] : end[i]] for i in short])
    seen = np.bincount(merged, minlength=len(sizes))
    found = np.flatnonzero(seen >= need - aside)
    shared = seen[found]
    for n, i in enumerate(long):
        if not len(found):
            break
        one = posts[begin[i] : end[i]]
        place = np.searchsorted(one, found)
        shared = shared + ((place < len(one)) & (one[np.minimum(place, len(one) - 1)] == found))
        if n % 16 == 15:  # what can no longer reach T is skipped
            keep = shared + (len(long) - n - 1) >= need
            found, shared = found[keep], shared[keep]
    both = a + sizes[found] - shared
    return found[100 * shared >= percent * both]


def _index(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    return flat[starts], np.append(starts, len(flat)), owner


def links_between(
    asked: list[np.ndarray], indexed: list[np.ndarray], ids_asked: np.ndarray, ids_indexed: np.ndarray, percent: int
) -> np.ndarray:
    """Pairs of ids (2 x n) that join all linked sets into their components."""
    if not asked or not indexed:
        return np.empty((2, 0), np.int64)
    lists = _index(indexed)
    sizes = np.array([len(s) for s in indexed])
    nodes, where = np.unique(np.concatenate([ids_asked, ids_indexed]), return_inverse=True)
    label = np.arange(len(nodes))
    own, other = where[: len(ids_asked)], where[len(ids_asked) :]
    out = []
    for q, node in zip(asked, own, strict=True):
        partners = other[t_occurrence(q, lists, sizes, percent)]
        labels, firsts = np.unique(label[partners], return_index=True)
        for lab, f in zip(labels, firsts, strict=True):
            mine = label[node]
            if lab != mine:
                out.append((nodes[node], nodes[partners[f]]))
                label[label == lab] = mine
    return np.array(out, np.int64).T.reshape(2, -1)


def _search(k: int, percent: int):
    """Links inside one part: of rows with ``ask`` to rows with ``hold``."""

    def run(part: pa.Table) -> pa.Table:
        cache = WordHashes()
        ids = part.column("doc_id").to_numpy()
        ask, hold = (part.column(c).to_numpy() for c in ("ask", "hold"))
        sets = [shingle_set(t.as_py(), k, cache) for t in part.column("text")]
        some = np.array([len(s) > 0 for s in sets])
        a, h = np.flatnonzero(ask & some), np.flatnonzero(hold & some)
        found = links_between([sets[i] for i in a], [sets[i] for i in h], ids[a], ids[h], percent)
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return run


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs`` (doc_id, text).

    Two documents link when 100 * intersection >= percent * union of their sets of
    ``words``-word shingles; component_id is the least id reachable by links, itself
    included. A null or empty text has an empty set and no link. Rows that repeat an id
    count as linked with each other. A null id sorts before all ids, and all null ids are
    one node: a component that holds it has a null component_id. An empty table gives an
    empty result. Other columns are not read. Shingles are compared by 64-bit hashes."""
    spark = docs.sparkSession
    work = Work(spark, "jaccard")
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), "text")
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, words))  # at most FREQUENT numbers
    signed = docs.mapInArrow(_sign(words, percent, frequent), "kind byte, key long, doc long, other long, n long")
    # In key order, the first id of a key is what all later ones go to.
    ordered = Window.partitionBy("kind", "key").orderBy("doc").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    linked = (
        signed.withColumn("least", F.min("doc").over(ordered))
        .withColumn("to", F.coalesce("other", "least"))
        .filter("kind = 0 OR doc <> to")
        .select("kind", "doc", F.col("to"), "n")
    )
    routed = work.save(linked, "routed")
    own = routed.filter("kind = 0").select(F.col("doc").alias("doc_id"), F.col("to").alias("local"), F.col("n").alias("n_shingles"))
    same = routed.filter("kind = 1").select(F.col("doc").alias("local"), F.col("to").alias("rep"))

    def to_rep(edges: DataFrame, column: str) -> DataFrame:
        renamed = same.withColumnRenamed("local", column)
        return edges.join(renamed, column, "left").withColumn(column, F.coalesce("rep", column)).drop("rep")

    near = routed.filter("kind >= 2").select(F.col("doc").alias("a"), F.col("to").alias("b")).distinct()
    blocks = work.save(components(to_rep(to_rep(near, "a"), "b"), work, "blocks").withColumnRenamed("root", "block"), "members")
    sizes = own.filter("doc_id = local").groupBy("doc_id").agg(F.max("n_shingles").alias("n"))
    members = blocks.join(sizes.withColumnRenamed("doc_id", "node"), "node")
    parts = F.greatest(F.ceil(F.col("sets") / PART_SETS), F.ceil(F.col("shingles") / PART_SHINGLES))
    block_sizes = members.groupBy("block").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    cut = work.save(
        blocks.join(block_sizes.select("block", parts.cast("int").alias("parts"), "shingles"), "block").select(
            "node", "block", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "shingles"
        ),
        "cut",
    )
    # Small blocks share parts: a part may hold any number of blocks, its links are exact.
    weight = cut.filter("parts = 1").agg(F.count(F.lit(1)), F.count_distinct("block")).first()
    shared = max(1, -(-weight[0] // (PART_SETS // 2)))
    weighed = docs.withColumn("bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + ROW_BYTES)
    texts = work.save(
        weighed.join(cut.select(F.col("node").alias("doc_id"), "block", "parts", "part"), "doc_id"), "texts"
    )
    alone = F.col("parts") == 1
    groups = texts.withColumns(
        {
            "g": F.when(alone, F.pmod(F.xxhash64("block"), F.lit(shared))).otherwise(F.col("block")),
            "p": F.when(alone, F.lit(-1)).otherwise(F.col("part")),
            "ask": F.lit(True),
            "hold": F.lit(True),
        }
    )
    search = _search(words, percent)
    inside = work.save(
        groups.select("g", "p", "doc_id", "text", "ask", "hold").groupBy("g", "p").applyInArrow(search, "a long, b long"), "inside"
    )
    # Blocks of several parts: whatever is not in the largest component meets every part.
    large = cut.filter("parts > 1").select("node", "block", "parts")
    roots = components(inside.join(large.select(F.col("node").alias("a")), "a", "left_semi"), work, "partial")
    rooted = work.save(
        large.join(roots, "node", "left").select("node", "block", "parts", F.coalesce("root", "node").alias("root")), "rooted"
    )
    counts = rooted.groupBy("block", "root").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy("block").agg(F.max(F.struct("c", "root")).alias("m")).select("block", F.col("m.root").alias("main"))
    others = work.save(rooted.join(main, "block").filter("root <> main").select("node", "block"), "others")
    chunks = others.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PART_SETS).cast("int").alias("chunks"))
    wide = texts.filter("parts > 1").join(chunks, "block")
    outside = wide.join(others.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    lone = work.save(outside.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("chunks")).cast("int")), "lone")
    # Copies for all cells of a block's parts and chunks grow with the square of the block. They
    # are made in rounds, each of about as many bytes as the texts have, and leave with their round.
    copied = [wide.agg(F.sum(F.col("bytes") * F.col("chunks"))), lone.agg(F.sum(F.col("bytes") * F.col("parts")))]
    moved = sum(c.first()[0] or 0 for c in copied)
    rounds = max(1, -(-moved // (texts.agg(F.sum("bytes")).first()[0] or 1)))
    for n in range(rounds):

        def cells(count: str, of: str) -> Column:
            """The numbers below ``count`` whose cell with the row's ``of`` is in this round."""
            return F.explode(F.filter(F.sequence(F.lit(0), F.col(count) - 1), lambda x: F.pmod(x + F.col(of), F.lit(rounds)) == n))  # noqa: B023

        held = wide.select(
            "block", "part", cells("chunks", "part").alias("chunk"), "doc_id", "text", F.lit(False).alias("ask"), F.lit(True).alias("hold")
        )
        asked = lone.select(
            "block", cells("parts", "chunk").alias("part"), "chunk", "doc_id", "text", F.lit(True).alias("ask"), F.lit(False).alias("hold")
        )
        across = held.unionByName(asked).groupBy("block", "part", "chunk").applyInArrow(search, "a long, b long")
        work.save(across, f"across/{n}")
    joined = spark.read.schema(inside.schema).parquet(work.path("inside"), *(work.path(f"across/{n}") for n in range(rounds)))
    final = components(joined, work, "links")
    work.drop("members", "cut", "texts", "inside", "rooted", "others", "lone", "across")  # what follows reads routed and final
    # From each task's first id of a set to the component: no key larger than a task's rows.
    locals_ = own.select("local").distinct().join(same, "local", "left").select("local", F.coalesce("rep", "local").alias("rep"))
    placed = work.save(
        locals_.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("local", F.coalesce("root", "rep").alias("component")),
        "placed",
    )
    # The first id that a task met need not be the least of its set.
    least = own.groupBy("local").agg(F.min("doc_id").alias("least")).join(placed, "local")
    least = work.save(least.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    named = work.save(placed.join(least, "component").select("local", "component_id"), "named")
    return own.join(named, "local").select(
        F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"),
        "n_shingles",
        F.nullif("component_id", F.lit(NULL_ID)).alias("component_id"),
    )


def op7_divide_skip_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS shingle
  FROM w),
n AS (SELECT w.doc_id, count(s.shingle) AS n_shingles FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
      WHERE 100 * o >= 90 * (a.n_shingles + b.n_shingles - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.c)
SELECT n.doc_id, n.n_shingles, min(r.c) AS component_id FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n_shingles
"""

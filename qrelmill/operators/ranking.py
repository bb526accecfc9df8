"""Bulk ranking of corpora: BM25, vectors and rank fusion.

BM25 joins queries with the postings of their terms; a query with very many
postings skips the document blocks whose highest scores cannot reach its best
hits. Vectors are scored in numpy blocks that keep the best ``top`` per query, so
pairs are never emitted: queries of measured small size are sent to all tasks, others
meet only the documents that the angles to a few pivots leave open.

Scores are rounded to nine places before ranking and ties go to the smaller
document name, so ranks do not depend on block shapes or summation order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..session import BROADCAST_BYTES, written

# fixed values: published BM25 defaults and the fusion settings
BM25_K1, BM25_B = 1.2, 0.75
RRF_K, WEIGHT_BM25, WEIGHT_VECTOR = 60, 0.3, 1.5
DIGITS = 9
BLOCK_DOCS = 2000
# SLACK is for rounded sums.
WHOLE_POSTINGS = 1_000_000
# Fixed numbers of pivots and of rings around each, so there are at most their product of rings.
PIVOTS, RINGS = 64, 24
SLACK = 1e-6
# Queries and documents that one task holds at once, and the scores it computes at once.
BLOCK_QUERIES, BLOCK_VECTORS = 8192, 16384
UNIT_DOCS = 8192
BLOCK_SCORES = 4_194_304
# Above this many hits of one task, queries are not sent to all tasks.
SHIPPED_HITS = 1_000_000
HITS = "dataset string, id string, doc string, score double"


class _TopHits:
    """The running best hits of the queries ``ids``; a hit below ``least`` of its query is none.

    Hits are taken as they come and cut to the best ``top`` per query now and then. Names
    are compared only among hits that tie for the last place."""

    def __init__(self, top: int, ids: np.ndarray, least: np.ndarray | None = None) -> None:
        self.top, self.ids = top, ids
        self.least = np.full(len(ids), -np.inf) if least is None else least.copy()
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` has a row per query and a column per document; NaN is no hit."""
        row, col = np.nonzero(scores >= (self.least - 10.0**-DIGITS)[:, None])
        score = np.round(scores[row, col], DIGITS)
        near = score >= self.least[row]
        self.found.append((row[near], docs[col[near]], score[near]))
        self.size += int(near.sum())
        if self.size > 3 * self.top * len(self.ids):
            self._cut()

    def _cut(self) -> None:
        row, docs, score = (np.concatenate(x) for x in zip(*self.found))
        order = np.lexsort((-score, row))
        row, docs, score = row[order], docs[order], score[order]
        first = np.searchsorted(row, np.arange(len(self.ids) + 1))
        full = np.flatnonzero(np.diff(first) >= self.top)
        self.least[full] = score[first[full] + self.top - 1]
        keep = score > self.least[row]
        above = np.bincount(row[keep], minlength=len(self.ids))
        tied = np.flatnonzero(score == self.least[row])
        tied = tied[np.lexsort((docs[tied], row[tied]))]
        place = np.arange(len(tied)) - np.searchsorted(row[tied], row[tied])
        keep[tied[place < self.top - above[row[tied]]]] = True
        self.found = [(row[keep], docs[keep], score[keep])]
        self.size = int(keep.sum())

    def frame(self, dataset: str) -> pd.DataFrame:
        if self.found:
            self._cut()
        row, docs, score = self.found[0] if self.found else (np.empty(0, dtype=int), [], [])
        return pd.DataFrame({"dataset": dataset, "id": self.ids[row], "doc": docs, "score": score})


def _ranked(hits: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("dataset", "id").orderBy(F.col("score").desc(), "doc")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


# --- BM25 ------------------------------------------------------------------


def query_terms(queries: DataFrame) -> DataFrame:
    return (
        queries.select("dataset", "id", F.explode(tokenize(F.col("q"))).alias("term"))
        .groupBy("dataset", "id", "term")
        .agg(F.count(F.lit(1)).alias("times"))
    )


def postings(corpus: DataFrame, asked: DataFrame, small: bool = False) -> DataFrame:
    """(dataset, doc, length, term, tf) of the asked terms in one pass over
    ``corpus(dataset, stem, text)``; ``asked(dataset, term, …)``.

    Every document of an asked dataset has one more posting, of the empty term, so that the
    number of documents and their lengths can be read from the postings alone.
    ``small`` says the asked terms were measured to fit a broadcast; otherwise
    both sides are shuffled by term."""
    wanted = asked.select("dataset", "term").distinct()
    wanted = wanted.unionByName(asked.select("dataset").distinct().withColumn("term", F.lit("")))
    wanted = F.broadcast(wanted) if small else wanted
    tokens = corpus.select("dataset", F.col("stem").alias("doc"), tokenize(F.col("text")).alias("tokens"))
    terms = F.explode(F.array_append("tokens", F.lit(""))).alias("term")
    return (
        tokens.select("dataset", "doc", F.size("tokens").alias("length"), terms)
        .join(wanted, ["dataset", "term"], "left_semi")
        .groupBy("dataset", "doc", "length", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def by_document(listed: DataFrame) -> DataFrame:
    """(dataset, doc, p): the postings of each document as one list of (length, term, tf)."""
    return listed.groupBy("dataset", "doc").agg(F.collect_list(F.struct("length", "term", "tf")).alias("p"))


def corpus_statistics(listed: DataFrame) -> DataFrame:
    """(dataset, term, docs, length) of documents with postings; the empty term's row holds
    the number of documents of a dataset and their total length."""
    rows = listed.select("dataset", F.inline("p"))
    return rows.groupBy("dataset", "term").agg(F.count(F.lit(1)).alias("docs"), F.sum("length").alias("length"))


def term_weights(asked: DataFrame, statistics: DataFrame) -> DataFrame:
    """(dataset, id, term, weight, docs): occurrences in the query times the term's
    inverse document frequency, for terms the corpus knows."""
    size = statistics.where("term = ''").select("dataset", F.col("docs").alias("n"))
    idf = F.log(F.lit(1.0) + (F.col("n") - F.col("docs") + 0.5) / (F.col("docs") + 0.5))
    return (
        asked.join(statistics.where("term <> ''"), ["dataset", "term"])
        .join(size, "dataset")
        .select("dataset", "id", "term", (F.col("times") * idf).alias("weight"), "docs")
    )


def scored_postings(listed: DataFrame, sizes: DataFrame, k1: float, b: float) -> DataFrame:
    """(dataset, doc, p): per document a list of (term, part), where a part is what one
    occurrence of the term in a query adds to the score, but for the term's weight.
    ``sizes(dataset, n, total)``."""

    def scored(x: Column) -> Column:
        norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * x["length"] * F.col("n") / F.col("total"))
        return F.struct(x["term"].alias("term"), (x["tf"] * F.lit(k1 + 1) / (x["tf"] + norm)).alias("part"))

    known = F.filter("p", lambda x: x["term"] != "")
    return listed.join(sizes, "dataset").select("dataset", "doc", F.transform(known, scored).alias("p"))


def _scores(found: DataFrame) -> DataFrame:
    return found.groupBy("dataset", "id", "doc").agg(F.round(F.sum(F.col("weight") * F.col("part")), DIGITS).alias("score"))


class _Weights:
    """The weights of some queries by term, and the scores they give to documents."""

    def __init__(self, rows: pd.DataFrame) -> None:
        ids, terms = pd.Index(rows["id"].unique()), pd.Index(rows["term"].unique())
        self.ids, self.terms = ids.to_numpy(dtype=object), terms
        code = terms.get_indexer(rows["term"])
        order = np.argsort(code, kind="stable")
        self.query = ids.get_indexer(rows["id"])[order]
        self.weight = rows["weight"].to_numpy()[order]
        self.first = np.searchsorted(code[order], np.arange(len(terms) + 1))

    def add_scores(self, hits: _TopHits, docs: pd.DataFrame, block_docs: int) -> None:
        """The hits among ``docs(doc, terms, parts)``, ``block_docs`` at once."""
        step = max(1, min(block_docs, BLOCK_SCORES // len(self.ids)))
        for start in range(0, len(docs), step):
            rows = docs.iloc[start : start + step]
            hits.add(rows["doc"].to_numpy(dtype=object), self._scores(rows))

    def _scores(self, docs: pd.DataFrame) -> np.ndarray:
        doc = np.repeat(np.arange(len(docs)), docs["terms"].map(len))
        code, part = self.terms.get_indexer(np.concatenate(list(docs["terms"]))), np.concatenate(list(docs["parts"]))
        known = code >= 0
        doc, code, part = doc[known], code[known], part[known]
        times = self.first[code + 1] - self.first[code]
        at = np.repeat(self.first[code] - np.cumsum(times) + times, times) + np.arange(times.sum())
        cell = self.query[at] * len(docs) + np.repeat(doc, times)
        sums = np.bincount(cell, self.weight[at] * np.repeat(part, times), minlength=len(self.ids) * len(docs))
        return np.where(sums > 0, sums, np.nan).reshape(len(self.ids), len(docs))


def _shipped_scores(weights: DataFrame, parts: DataFrame, top: int, block_docs: int) -> DataFrame:
    """All queries are sent to every task; each keeps their best of its documents."""
    shared = weights.sparkSession.sparkContext.broadcast(weights.select("dataset", "id", "term", "weight").toPandas())

    def by_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = {d: _Weights(part) for d, part in shared.value.groupby("dataset", sort=False)}
        best: dict[str, _TopHits] = {}
        for batch in batches:
            for dataset, part in batch.groupby("dataset", sort=False):
                if dataset in asked:
                    hits = best.setdefault(dataset, _TopHits(top, asked[dataset].ids))
                    asked[dataset].add_scores(hits, part, block_docs)
        for dataset, hits in best.items():
            yield hits.frame(dataset)

    return parts.select("dataset", "doc", F.col("p.term").alias("terms"), F.col("p.part").alias("parts")).mapInPandas(by_task, HITS)


def _by_units(weights: DataFrame, parts: DataFrame, sizes: DataFrame, top: int, block_docs: int) -> DataFrame:
    """Hits among which are the best ``top`` of every query; queries are not sent to all tasks.

    Blocks of queries meet units of documents, and a pair of both gives at most ``top`` hits
    per query. About the square root of all units go first; in the others, only scores count
    that reach the query's ``top``-th so far. So a query has about twice that root times ``top`` hits."""
    per_dataset = sizes.select("dataset", F.ceil(F.col("n") / UNIT_DOCS).alias("units"))
    asking = weights.groupBy("dataset").agg(F.ceil(F.approx_count_distinct("id") / BLOCK_QUERIES).alias("blocks"))
    ways = written(per_dataset.join(asking, "dataset"), "bm25-ways")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n).cast("bigint") - 1))
    ahead = lambda unit: F.col(unit) % F.ceil(F.sqrt("units")) == 0
    rows = weights.groupBy("dataset", "id").agg(F.collect_list(F.struct("term", "weight")).alias("w")).join(ways, "dataset")
    left = rows.select("dataset", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", F.col("w.term").alias("terms"), F.col("w.weight").alias("weights"), "units")
    right = parts.join(ways, "dataset").select(
        "dataset", F.pmod(F.xxhash64("doc"), F.col("units")).alias("unit"), "doc", F.col("p.term").alias("terms"), F.col("p.part").alias("parts"), "units", "blocks"
    )

    def search(asked: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(docs):
            return _TopHits(top, np.empty(0, dtype=object)).frame("")
        n = asked["terms"].map(len)
        by_term = _Weights(pd.DataFrame({
            "id": np.repeat(asked["id"].to_numpy(dtype=object), n), "term": np.concatenate(list(asked["terms"])), "weight": np.concatenate(list(asked["weights"])),
        }))
        least = asked.set_index("id")["least"].reindex(by_term.ids).to_numpy()
        hits = _TopHits(top, by_term.ids, least)
        by_term.add_scores(hits, docs, block_docs)
        return hits.frame(asked["dataset"].iloc[0])

    def hits(queries: DataFrame, first: bool) -> DataFrame:
        met = queries.select("*", every("units").alias("unit")).where(ahead("unit") == F.lit(first)).drop("units")
        docs = right.where(ahead("unit") == F.lit(first)).select("dataset", "unit", "doc", "terms", "parts", every("blocks").alias("block"))
        keys = ["dataset", "unit", "block"]
        return met.groupBy(*keys).cogroup(docs.groupBy(*keys)).applyInPandas(search, HITS)

    none = F.lit(float("-inf"))
    best = written(_ranked(hits(left.withColumn("least", none), True), top), "bm25-first")
    least = best.where(F.col("rank") == top).select("dataset", "id", F.col("score").alias("least"))
    rest = left.join(least, ["dataset", "id"], "left").withColumn("least", F.coalesce("least", none))
    return best.drop("rank").unionByName(hits(rest, False))


def rank_bm25(
    queries: DataFrame,
    corpus: DataFrame,
    k1: float = BM25_K1,
    b: float = BM25_B,
    top: int = 100,
    block_docs: int = BLOCK_DOCS,
    broadcast_bytes: int = BROADCAST_BYTES,
    whole_postings: int = WHOLE_POSTINGS,
) -> DataFrame:
    """Top documents per query: DF(dataset, id, doc, score, rank).

    ``queries(dataset, id, q)``, ``corpus(dataset, stem, text)``.

    Only postings of asked terms are kept, as a list per document. Some thousands of queries
    that fit a broadcast are scored where the documents lie. Of more queries, those whose
    terms have at most ``whole_postings`` postings, counted exactly, are joined with them;
    heavier ones meet the documents unit by unit, ``block_docs`` of them at once."""
    asked = query_terms(queries)
    # A term takes two characters of its query at least, and a row with names and figures in the broadcast.
    most = F.sum((F.length("q") / 2 + 1) * (F.length("dataset") + F.length("id") + 64))
    needed, number = queries.agg(most, F.count(F.lit(1))).first()
    small = (needed or 0) <= broadcast_bytes

    def light(df: DataFrame) -> DataFrame:
        """For tables with at most one row per asked term and query."""
        return F.broadcast(df) if small else df

    listed = written(by_document(postings(corpus, asked, small)), "bm25-postings")
    statistics = corpus_statistics(listed)
    cost = Window.partitionBy("dataset", "id")  # the terms of one query
    weights = written(term_weights(asked, statistics).withColumn("cost", F.sum("docs").over(cost)).drop("docs"), "bm25-weights")
    sizes = statistics.where("term = ''").select("dataset", F.col("docs").alias("n"), F.greatest("length", F.lit(1)).alias("total"))
    sizes = written(sizes, "bm25-sizes")
    parts = scored_postings(listed, light(sizes), k1, b)
    if small and number <= BLOCK_QUERIES:
        return _ranked(_shipped_scores(weights, parts, top, block_docs), top)
    cheap = weights.where(F.col("cost") <= whole_postings)
    hits = _scores(parts.select("dataset", "doc", F.inline("p")).join(light(cheap), ["dataset", "term"]))
    heavy = weights.where(F.col("cost") > whole_postings)
    if heavy.limit(1).count():
        hits = hits.unionByName(_by_units(heavy, parts, sizes, top, block_docs))
    return _ranked(hits, top)


# --- vectors ---------------------------------------------------------------


def _unit(rows: pd.Series) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in rows])
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(norm == 0, 1.0, norm)


def _add_cosines(hits: _TopHits, asked: np.ndarray, docs: pd.DataFrame, block_docs: int) -> None:
    step = max(1, min(block_docs, BLOCK_SCORES // len(asked)))
    for start in range(0, len(docs), step):
        rows = docs.iloc[start : start + step]
        hits.add(rows["doc"].to_numpy(dtype=object), asked @ _unit(rows["vec"]).T)


def _shipped_hits(queries: DataFrame, vectors: DataFrame, top: int, block_docs: int) -> DataFrame:
    """All queries are sent to every task; each keeps their best of its documents."""
    shared = vectors.sparkSession.sparkContext.broadcast(queries.toPandas())  # size measured by the caller

    def by_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = {d: (part["id"].to_numpy(dtype=object), _unit(part["vec"])) for d, part in shared.value.groupby("dataset", sort=False)}
        best: dict[str, _TopHits] = {}
        for batch in batches:
            for dataset, part in batch.groupby("dataset", sort=False):
                if dataset in asked:
                    ids, unit = asked[dataset]
                    _add_cosines(best.setdefault(dataset, _TopHits(top, ids)), unit, part, block_docs)
        for dataset, hits in best.items():
            yield hits.frame(dataset)

    return vectors.mapInPandas(by_task, HITS)


def _angled(rows: DataFrame, name: str, pivots: np.ndarray) -> DataFrame:
    """``rows`` (dataset, ``name``, vec) with their angles to all pivots."""

    def angles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = np.arccos(np.clip(_unit(batch["vec"]) @ pivots.T, -1.0, 1.0))
                yield batch.assign(angles=list(found))

    found = rows.mapInPandas(angles, f"dataset string, {name} string, vec array<double>, angles array<double>")
    return found.where(~F.isnan(F.array_max("angles")))  # a vector with NaN has no cosine to any other


def _filed(rows: DataFrame, name: str, pivots: np.ndarray) -> DataFrame:
    """``rows`` with their nearest pivot, the angle to it and its ring."""
    near = F.array_position("angles", F.array_min("angles")).cast("int") - 1
    rows = _angled(rows, name, pivots).withColumns({"pivot": near, "angle": F.array_min("angles")})
    return rows.withColumn("ring", F.floor(F.col("angle") * (RINGS / np.pi)).cast("int"))


def _pivoted_hits(queries: DataFrame, vectors: DataFrame, top: int, block_docs: int) -> DataFrame:
    """Hits among which are the best ``top`` of every query, by angles to pivots.

    Documents and queries are filed under their nearest pivot and a ring of angles around
    it. The angle of a query to a document is at least the difference of their angles to
    the pivot, which bounds the cosine between all queries of a ring and all documents of
    another. Rings that hold ``top`` documents are searched first, best bound first; of the
    others, those whose bound reaches the ``top``-th score so far of a query of the ring.

    There are at most (PIVOTS x RINGS) squared bounds per dataset. Rings of queries next to
    each other form blocks, which meet the documents of their rings one after the other
    in one task, so that a query gives ``top`` hits, whatever the number of documents."""
    some = vectors.orderBy(F.xxhash64("doc"), "doc").limit(PIVOTS).select("vec").toPandas()
    if not len(some):
        return vectors.sparkSession.createDataFrame([], HITS)
    pivots = _unit(some["vec"])
    place, cell, unit = ["dataset", "pivot", "ring"], ["dataset", "at", "around"], ["dataset", "block", "part"]
    filed = written(_filed(vectors, "doc", pivots).drop("angles"), "vectors-filed")
    rings = filed.groupBy(*place).agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
    asked = written(_filed(queries, "id", pivots).withColumnsRenamed({"pivot": "at", "ring": "around"}), "vectors-asked")
    before = Window.partitionBy("dataset").orderBy("at", "around").rowsBetween(Window.unboundedPreceding, -1)
    cells = asked.groupBy(*cell).agg(F.count(F.lit(1)).alias("asking"))
    cells = cells.withColumn("block", F.floor(F.coalesce(F.sum("asking").over(before), F.lit(0)) / BLOCK_VECTORS))
    cells = written(cells.withColumn("parts", F.ceil(F.col("asking") / BLOCK_VECTORS)), "vectors-cells")
    spans = asked.select(*cell, F.posexplode("angles").alias("pivot", "own")).groupBy(*cell, "pivot")
    spans = spans.agg(F.min("own").alias("least_own"), F.max("own").alias("most_own"))
    gap = F.greatest(F.lit(0.0), F.col("low") - F.col("most_own"), F.col("least_own") - F.col("high"))
    bounds = spans.join(rings, ["dataset", "pivot"])
    bounds = written(bounds.select(*cell, "pivot", "ring", "n", F.cos(gap).alias("bound"), "least_own"), "vectors-bounds")
    order = Window.partitionBy(*cell).orderBy(F.col("bound").desc(), "least_own", "pivot", "ring")
    passed = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    ahead = written(bounds.withColumn("passed", passed).where(F.col("passed") < top).select(*cell, "pivot", "ring"), "vectors-ahead")

    def blocks(pairs: DataFrame) -> DataFrame:
        parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1)).alias("part")
        return pairs.join(cells, cell).select("dataset", "pivot", "ring", "block", parts).distinct()

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks one after the other, the queries of each before its documents."""
        key, asking, vecs, hits = None, [], None, None
        for batch in batches:
            for now, rows in batch.groupby(unit, sort=False):
                if now != key:
                    if hits:
                        yield hits.frame(key[0])
                    key, asking, hits = now, [], None
                is_doc = rows["is_doc"].to_numpy()
                if not is_doc.all():
                    asking.append(rows[~is_doc])
                if is_doc.any():
                    if not hits:
                        every = pd.concat(asking)
                        hits, vecs = _TopHits(top, every["doc"].to_numpy(dtype=object), every["least"].to_numpy()), _unit(every["vec"])
                    _add_cosines(hits, vecs, rows[is_doc], block_docs)
        if hits:
            yield hits.frame(key[0])

    def hits(met: DataFrame, least: Column, asking: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.col("parts")).alias("part")
        left = asking.join(F.broadcast(cells), cell).select("dataset", "block", part, F.lit(False).alias("is_doc"), F.col("id").alias("doc"), "vec", least.alias("least"))
        right = filed.join(met, place).select(*unit, F.lit(True).alias("is_doc"), "doc", "vec", F.lit(0.0).alias("least"))
        rows = left.unionByName(right).repartition(*unit).sortWithinPartitions(*unit, "is_doc")
        return rows.mapInPandas(search, HITS)

    none = F.lit(float("-inf"))
    met = written(blocks(ahead), "vectors-blocks")
    first = written(_ranked(hits(met, none, asked), top), "vectors-first")
    least = first.where(F.col("rank") == top).select("dataset", "id", F.col("score").alias("least"))
    reached = asked.select(*cell, "id").join(least, ["dataset", "id"], "left").withColumn("least", F.coalesce("least", none))
    lowest = reached.groupBy(*cell).agg(F.min("least").alias("lowest"))
    open_ = (
        bounds.join(ahead, [*cell, "pivot", "ring"], "left_anti")
        .join(lowest, cell)
        .where(F.col("bound") >= F.col("lowest") - SLACK)
        .select(*cell, "pivot", "ring")
    )
    rest = written(blocks(written(open_, "vectors-open")).join(met, [*unit, "pivot", "ring"], "left_anti"), "vectors-rest")
    asking = asked.join(least, ["dataset", "id"], "left")
    return first.drop("rank").unionByName(hits(rest, F.coalesce("least", none), asking))


def rank_vector(
    query_vectors: DataFrame,
    vectors: DataFrame,
    top: int = 100,
    block_docs: int = BLOCK_DOCS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Top documents per query by cosine: DF(dataset, id, doc, score, rank).

    ``query_vectors(dataset, id, vec)``, ``vectors(dataset, doc, vec)``. Queries
    that are measured to fit a broadcast, and whose hits are few enough for every task to
    give all of them, meet all documents where they lie; more
    of them are led by pivots to the documents that may be their best."""
    wide = F.col("vec").cast("array<double>").alias("vec")
    queries, docs = query_vectors.select("dataset", "id", wide), vectors.select("dataset", "doc", wide)
    measured, number = queries.agg(F.sum(8 * F.size("vec") + F.length("id") + F.length("dataset") + 64), F.count(F.lit(1))).first()
    if (measured or 0) <= broadcast_bytes and number * top <= SHIPPED_HITS:
        return _ranked(_shipped_hits(queries, docs, top, block_docs), top)
    return _ranked(_pivoted_hits(queries, docs, top, block_docs), top)


# --- fusion ----------------------------------------------------------------


def rank_hybrid(
    bm25: DataFrame,
    vector: DataFrame,
    k: int = RRF_K,
    w_bm25: float = WEIGHT_BM25,
    w_vec: float = WEIGHT_VECTOR,
    top: int = 100,
) -> DataFrame:
    """Weighted reciprocal rank fusion of two rankings. Both legs go into one
    aggregation instead of a full join."""

    def leg(df: DataFrame, weight: float):
        return df.select("dataset", "id", "doc", (F.lit(weight) / (F.lit(k) + F.col("rank"))).alias("s"))

    fused = (
        leg(bm25, w_bm25)
        .unionByName(leg(vector, w_vec))
        .groupBy("dataset", "id", "doc")
        .agg(F.round(F.sum("s"), DIGITS).alias("score"))
    )
    return _ranked(fused, top)


def sweep_hybrid(bm25: DataFrame, vector: DataFrame, grid: DataFrame, top: int = 100) -> DataFrame:
    """Fusion under every setting of a variant grid in one job: settings are
    read from the ``settings`` map (rrf_k, w_bm25, w_vec; text values)."""

    def setting(name: str, default: float):
        return F.coalesce(F.try_element_at("settings", F.lit(name)).cast("double"), F.lit(float(default)))

    variants = grid.select(
        "dataset",
        "label",
        setting("rrf_k", RRF_K).alias("k"),
        setting("w_bm25", WEIGHT_BM25).alias("wb"),
        setting("w_vec", WEIGHT_VECTOR).alias("wv"),
    )
    legs = bm25.select("dataset", "id", "doc", "rank", F.lit(True).alias("lexical")).unionByName(
        vector.select("dataset", "id", "doc", "rank", F.lit(False).alias("lexical"))
    )
    part = F.when(F.col("lexical"), F.col("wb")).otherwise(F.col("wv")) / (F.col("k") + F.col("rank"))
    fused = (
        legs.join(variants, "dataset")
        .groupBy("dataset", "label", "id", "doc")
        .agg(F.round(F.sum(part), DIGITS).alias("score"))
    )
    w = Window.partitionBy("dataset", "label", "id").orderBy(F.col("score").desc(), "doc")
    return fused.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def ranked_lists(hits: DataFrame, keys: tuple[str, ...] = ("dataset", "id")) -> DataFrame:
    """Rank rows as one ``ranked`` list per query (at most ``top`` entries)."""
    listed = hits.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "doc"))).alias("r"))
    return listed.select(*keys, F.col("r.doc").alias("ranked"))

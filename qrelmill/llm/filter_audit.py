"""What filters remove alone, in which order, and together, from sorted posting lists.

Every filter keeps, per part of the corpus and range of row ids, the sorted list of the ids
that fail it. Documents that a filter removes after others are the difference of its list
and the union of theirs, so every order of the filters is answered from the lists: unions
are merged and differences taken by galloping, range by range, and only their sizes leave
a range. The texts are read once, and no text is shuffled.

Five filters have 120 orders, but what is gone before a filter depends only on the set of
those before it: 16 unions for each of five filters."""

from __future__ import annotations

from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qrelmill.llm.work import Work, table

#: Ids of a range: the lists of one range are what a task holds at a time.
RANGE_BITS = 15
BLOCK = 512
GOOD, TOXIC, ALL = "good", "toxic", "all"
COPY = "E"
SPACES = r"[ \t\n\x0B\f\r]+"


def text_filters(text: Column) -> dict[str, Column]:
    """Name and failure condition of each filter that reads one text."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 80 * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def gallop(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each of the sorted ``wanted`` the first place in the sorted ``ids`` that is not
    below it. From the place of one block of ``wanted``, steps double until the block's last
    is passed; the block is looked up in the stretch that this encloses."""
    out = np.empty(len(wanted), np.int64)
    at = 0
    for start in range(0, len(wanted), BLOCK):
        block = wanted[start : start + BLOCK]
        step = len(block)
        while at + step < len(ids) and ids[at + step] < block[-1]:
            step *= 2
        places = at + np.searchsorted(ids[at : at + step + 1], block)
        out[start : start + BLOCK] = places
        at = int(places[-1])
    return out


def found_in(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of the sorted ``wanted`` are among the sorted ``ids``."""
    if not len(ids) or not len(wanted):
        return np.zeros(len(wanted), bool)
    places = gallop(ids, wanted)
    return ids[np.minimum(places, len(ids) - 1)] == wanted


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Union of k sorted lists: the longest takes in the others, shortest first, each by
    galloping to the places of the ids that are still missing."""
    if not lists:
        return np.empty(0, np.int64)
    *rest, out = sorted(lists, key=len)
    for ids in rest:
        new = ids[~found_in(out, ids)]
        if len(new):
            out = np.insert(out, gallop(out, new) if len(out) else np.zeros(len(new), np.int64), new)
    return out


SIZES = "part string, filter string, before int, removed long, good long, toxic long, gone long, failing long, rows long"


def interactions(filters: list[str]):
    """A function from the posting lists of one part and range to the sizes of all
    differences: ``before`` has a bit for each filter applied earlier."""

    def run(rows: pa.Table) -> pa.Table:
        lists = {f: np.empty(0, np.int64) for f in [*filters, GOOD, TOXIC, ALL]}
        for name, ids in zip(rows.column("name").to_pylist(), rows.column("ids"), strict=True):
            lists[name] = ids.values.to_numpy()
        part = rows.column("part")[0].as_py()
        out = []
        for size in range(len(filters)):
            for earlier in combinations(range(len(filters)), size):
                gone = union([lists[filters[i]] for i in earlier])
                before = sum(1 << i for i in earlier)
                for i, f in enumerate(filters):
                    if i in earlier:
                        continue
                    failing = lists[f]
                    removed = failing[~found_in(gone, failing)]
                    good, toxic = found_in(lists[GOOD], removed).sum(), found_in(lists[TOXIC], removed).sum()
                    out.append((part, f, before, len(removed), good, toxic, len(gone), len(failing), len(lists[ALL])))
        columns = list(zip(*out, strict=True))
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 6]
        names = ["part", "filter", "before", "removed", "good", "toxic", "gone", "failing", "rows"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def posting_lists(docs: DataFrame, labels: DataFrame, work: Work) -> DataFrame:
    """part, range, name, ids: the sorted ids of the rows that fail each filter, and of the
    good, the toxic and all rows. Ids number the rows of one written table."""
    text = F.coalesce("text", F.lit("")).alias("text")
    plain = docs.select(F.col("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text)
    fails = F.array(*(F.when(c, F.lit(f)) for f, c in text_filters(F.col("text")).items()))
    facts = plain.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "part",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"),
        F.array_append(F.array_compact(fails), F.lit(ALL)).alias("names"),
    )
    facts = work.save(facts, "facts")
    # A written table joins a written table, so that a text with very many copies can be split at run time.
    copies = facts.groupBy("sha").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("top")).filter("top > least")
    copies = work.save(copies.select("sha", "least"), "copies")
    later = facts.join(copies.hint("merge"), "sha").filter("doc_id > least").select("part", "row", F.lit(COPY).alias("name"))
    marks = labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, F.lit(GOOD))).alias("good"), F.max(F.when(F.col("toxic") == 1, F.lit(TOXIC))).alias("toxic")
    )
    marks = work.save(marks, "marks")
    named = facts.filter("doc_id IS NOT NULL").join(marks.hint("merge"), "doc_id")
    marked = named.select("part", "row", F.explode(F.array_compact(F.array("good", "toxic"))).alias("name"))
    one = facts.select("part", "row", F.explode("names").alias("name")).unionByName(later).unionByName(marked)
    lists = one.groupBy("part", F.shiftright("row", RANGE_BITS).alias("range"), "name").agg(
        F.sort_array(F.collect_list("row")).alias("ids")
    )  # at most 2 ** RANGE_BITS ids each
    return work.save(lists, "lists")


def audit(lists: DataFrame, filters: list[str]) -> DataFrame:
    """The steps of all orders of ``filters`` over ``lists`` (part, range, name, ids); see
    ``filter_interactions``."""
    spark = lists.sparkSession
    sizes = lists.groupBy("part", "range").applyInArrow(interactions(filters), SIZES).groupBy("part", "filter", "before")
    sums = sizes.agg(*(F.sum(c).alias(c) for c in ("removed", "good", "toxic", "gone", "failing", "rows")))
    sums = Work(spark, "filter-audit").save(sums, "sums")  # parts x filters x sets of the other filters
    orders = []
    for order in permutations(filters):
        before = 0
        for step, f in enumerate(order, 1):
            orders.append(("".join(order), step, f, before))
            before |= 1 << filters.index(f)
    plan = spark.createDataFrame(orders, "filter_order string, step int, filter string, before int")
    times = plan.groupBy("filter", "before").agg(F.count(F.lit(1)).alias("times"))
    shapley = sums.join(F.broadcast(times), ["filter", "before"]).groupBy("part", "filter")
    shapley = shapley.agg(F.sum(F.col("removed") * F.col("times")).alias("shapley"))
    every = (1 << len(filters)) - 1
    others = F.create_map(*(F.lit(x) for i, f in enumerate(filters) for x in (f, every - (1 << i))))
    alone = sums.filter(F.col("before") == others[F.col("filter")]).select("part", "filter", F.col("removed").alias("unique_fails"))
    per_filter = shapley.join(alone, ["part", "filter"])
    steps = sums.join(F.broadcast(plan), ["filter", "before"])  # orders x filters: fixed
    return steps.join(per_filter, ["part", "filter"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("rows") - F.col("gone") - F.col("removed")).alias("kept"),
        "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        "shapley",
    )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (language; null and '' are one), order of the filters A to E and step:
    documents of the part kept after the step and removed in it, ``redundant`` failing
    documents that were gone before, ``unique_fails`` failing this filter alone, the removed
    documents with a label good or toxic, and ``shapley``, what the filter removes in all
    orders together.

    ``docs``: doc_id, lang, text (null counts as empty); ``labels``: doc_id, quality, toxic.
    Rows that repeat an id are documents of their own; a label holds for all of them, and if
    labels repeat an id, one that says so is enough. A row without an id is no copy and has
    no copies and no label. Other columns are not read. Without documents there are no parts."""
    work = Work(docs.sparkSession, "filter-postings")
    ids = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    return audit(posting_lists(ids, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic"), work), list("ABCDE"))


def op12_posting_list_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
m AS MATERIALIZED (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
l AS MATERIALIZED (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS MATERIALIZED (
  SELECT d.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
    (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * len(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 10 * len(d.text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN d.doc_id > m.least THEN 16 ELSE 0 END) AS fails
  FROM d JOIN m ON d.text = m.text LEFT JOIN l ON l.doc_id = d.doc_id),
c AS MATERIALIZED (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
n AS (SELECT unnest(range(5)) AS i),
o AS MATERIALIZED (
  SELECT a.i AS a, b.i AS b, c.i AS c, d.i AS d, e.i AS e FROM n a, n b, n c, n d, n e
  WHERE (1 << a.i) | (1 << b.i) | (1 << c.i) | (1 << d.i) | (1 << e.i) = 31),
s AS MATERIALIZED (
  SELECT array_to_string(list_transform([a, b, c, d, e], lambda x: chr((65 + x)::INT)), '') AS filter_order, step,
         [a, b, c, d, e][step] AS i,
         list_sum(list_transform([a, b, c, d, e][:step - 1], lambda x: 1 << x)) AS seen
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
t AS MATERIALIZED (
  SELECT part, filter_order, step, i,
    sum(CASE WHEN fails & (coalesce(seen, 0)::BIGINT | (1 << i)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails & coalesce(seen, 0)::BIGINT = 0 AND fails & (1 << i) > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails & coalesce(seen, 0)::BIGINT > 0 AND fails & (1 << i) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = (1 << i) THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails & coalesce(seen, 0)::BIGINT = 0 AND fails & (1 << i) > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails & coalesce(seen, 0)::BIGINT = 0 AND fails & (1 << i) > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, i)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, i))::BIGINT AS shapley
FROM t
"""

"""Mixing sources to target weights by entropy balancing. DataFrame operations only.

Of all document rates that meet a source's target of words, entropy balancing takes those
nearest to one (in relative entropy): documents tilted exponentially by their size,
w = min(cap, exp(lambda * size / mean)), with one dual value per source. The dual is convex and
Newton steps, kept inside a bracket, solve it, for all sources in parallel. All a step
needs of a source is how many documents it has of each size, so documents are counted by
source and size first, with partial sums: a hot source and groups of copies become a few
numbers there. A source of w words has at most sqrt(2 w) sizes, so its counts are a list
of a proven bound (1.5 million for 10^12 words) that one row can hold.

Rates become copies per (source, size): a rounded total, then corrected from the largest
size down by whole copies as long as they bring the source nearer to its target. Inside a
class the documents that get the odd copies are the first by hash, ranked in hash
ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qrelmill.llm.work import Work, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20_240_612
NEWTON_ROUNDS = 60
TOLERANCE = 1e-9
HASH_RANGES = 4096

KEY = ["unnamed", "name"]  # a source: whether it is null, and its name


def word_count(column: str) -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, work: Work, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources`` (unnamed, name, source_size, ...) with weight and target.

    Weights go round the sources in code-point order, null last. A target above ``cap``
    times its source stops there; the rest is shared again by weight until none is above,
    which only needs the common level of target per weight."""
    ranged = work.save(sources.repartitionByRange(*KEY).withColumn("range", F.spark_partition_id()), "ranged")
    before = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = before.withColumn("before", F.sum("n").over(Window.orderBy("range")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("range").orderBy(*KEY)) - 1 + F.col("before")
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double")
    weighed = work.save(ranged.join(before, "range").withColumn("weight", weight).drop("range", "before"), "weighed")
    full = F.col("source_size") * float(cap)
    level = 0.0
    while True:
        stopped = full < level * F.col("weight")
        row = weighed.agg(
            F.sum("source_size"), F.sum(F.when(stopped, full)), F.sum(F.when(~stopped, F.col("weight")))
        ).first()
        following = ((row[0] or 0) - (row[1] or 0.0)) / row[2] if row[2] else level
        if following <= level:
            break
        level = following
    return weighed.withColumn("target", F.least(full, F.col("weight") * level))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def balanced(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """``sources`` (classes, source_size, docs, target, ...) with mean and ``dual``: the value
    at which the tilted rates of a source's classes (size, n) give its target of words."""
    most = F.lit(float(cap))
    mean, target = F.col("mean"), F.col("target")
    state = F.struct(
        F.lit(0.0).alias("dual"), (mean * -60.0).alias("low"), (mean * F.log(most)).alias("high"), F.lit(False).alias("done")
    )

    def sums(dual: Column) -> Column:
        def add(a: Column, c: Column) -> Column:
            tilt = F.exp(dual * c["size"] / mean)
            words = c["n"] * c["size"] * F.least(most, tilt)
            slope = F.when(tilt < most, words * c["size"] / mean).otherwise(0.0)
            return F.struct((a["got"] + words).alias("got"), (a["slope"] + slope).alias("slope"))

        return F.aggregate("classes", F.struct(F.lit(0.0).alias("got"), F.lit(0.0).alias("slope")), add)

    def newton(s: Column, _: Column) -> Column:
        def move(f: Column) -> Column:
            over = f["got"] > target
            low, high = F.when(over, s["low"]).otherwise(s["dual"]), F.when(over, s["dual"]).otherwise(s["high"])
            step = s["dual"] - F.try_divide(f["got"] - target, f["slope"])
            inside = F.coalesce((step > low) & (step < high), F.lit(False))
            done = F.abs(f["got"] - target) <= TOLERANCE * target
            dual = F.when(done, s["dual"]).when(inside, step).otherwise((low + high) / 2)
            return F.struct(dual.alias("dual"), low.alias("low"), high.alias("high"), done.alias("done"))

        return F.when(s["done"], s).otherwise(_let(sums(s["dual"]), move))

    # Sources that need every copy, or none, stay at their end of the bracket.
    all_of_it = target >= F.col("source_size") * most * (1 - 1e-12)
    solved = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_ROUNDS)), state, newton)["dual"]
    dual = F.when(F.col("source_size") == 0, 0.0).when(all_of_it, mean * F.log(most)).when(target <= 0, mean * -60.0)
    return sources.withColumn("mean", F.greatest(F.lit(1.0), F.try_divide(F.col("source_size").cast("double"), F.col("docs")))).withColumn(
        "dual", dual.otherwise(solved)
    )


def copies(sources: DataFrame, work: Work, cap: int = CAP) -> DataFrame:
    """``sources`` (classes from the largest size down, mean, dual, target, ...) with ``given``:
    size, n and ``k``, the copies that all documents of the class have together.

    Each step is written before the next reads it: a plan that merges them would
    compute the step before once per class."""

    def rounded(c: Column) -> Column:
        lot = F.xxhash64(*KEY, c["size"], F.lit(SEED)).bitwiseAND((1 << 53) - 1) / float(1 << 53)
        rate = F.least(F.lit(float(cap)), F.exp(F.col("dual") * c["size"] / F.col("mean")))
        k = F.when(c["size"] > 0, F.least(c["n"] * cap, F.floor(c["n"] * rate + lot))).otherwise(F.lit(0).cast("long"))
        return F.struct(c["size"].alias("size"), c["n"].alias("n"), k.alias("k"))

    drawn = work.save(sources.withColumn("drawn", F.transform("classes", rounded)).drop("classes"), "drawn")
    got = F.aggregate("drawn", F.lit(0).cast("long"), lambda a, c: a + c["k"] * c["size"])

    def correct(s: Column, c: Column) -> Column:
        room = F.when(s["off"] > 0, c["n"] * cap - c["k"]).otherwise(c["k"])
        useful = (c["size"] > 0) & (room > 0) & (c["size"] < 2 * F.abs(s["off"]))

        def move(many: Column) -> Column:
            return F.struct(
                (s["off"] - many * c["size"]).alias("off"),
                F.concat(s["moves"], F.array(F.struct(c["size"].alias("size"), many.alias("many")))).alias("moves"),
            )

        nearest = F.greatest(F.lit(1).cast("long"), F.round(F.abs(s["off"]) / F.greatest(c["size"], F.lit(1))).cast("long"))
        return F.when(useful, _let(F.signum(s["off"]).cast("long") * F.least(room, nearest), move)).otherwise(s)

    none = F.expr("cast(array() as array<struct<size: bigint, many: bigint>>)")
    start = F.struct((F.col("target") - got).alias("off"), none.alias("moves"))
    moved = work.save(drawn.withColumn("moved", F.map_from_entries(F.aggregate("drawn", start, correct)["moves"])), "moved")
    return moved.withColumn(
        "given",
        F.transform(
            "drawn",
            lambda c: F.struct(
                c["size"], c["n"], (c["k"] + F.coalesce(F.try_element_at(F.col("moved"), c["size"]), F.lit(0))).alias("k")
            ),
        ),
    ).drop("drawn", "moved")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of each row of ``docs`` (doc_id,
    text, source). ``copies`` is how often the mix takes the document, up to ``cap``.

    A null text has size 0. Documents of size 0 are not taken, and neither is anything when
    all sizes are 0. A null source is a source. Null and repeated ids keep a row each. An
    empty table gives an empty result. Other columns are not read. Ties by hash go by id;
    rows that tie in everything share out their copies."""
    spark = docs.sparkSession
    work = Work(spark, "mixing")
    h = F.xxhash64("doc_id", F.lit(SEED))
    rows = work.save(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").isNull().alias("unnamed"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"),
            word_count("text").alias("size"),
        ).withColumns({"h": h, "range": F.pmod(h, F.lit(HASH_RANGES)).cast("int")}),
        "rows",
    )
    classes = rows.groupBy(*KEY, "size").agg(F.count(F.lit(1)).alias("n"))
    sources = classes.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("classes"),
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("docs"),
    )
    solved = work.save(balanced(targets(sources, work, weights, cap), cap), "solved")
    given = copies(solved, work, cap).select(*KEY, "source_size", "target", F.explode("given").alias("g")).select(
        *KEY, "source_size", "target", "g.size", "g.n", "g.k"
    )
    # A document's rank in its class: its hash range's offset and its place in the range.
    cells = rows.groupBy(*KEY, "size", "range").agg(F.count(F.lit(1)).alias("here"))
    offset = F.sum("here").over(Window.partitionBy(*KEY, "size").orderBy("range")) - F.col("here")
    cells = work.save(
        cells.withColumn("offset", offset)
        .join(given, [*KEY, "size"])
        .select(
            *KEY, "size", "range", "offset", "source_size", "target",
            F.floor(F.col("k") / F.col("n")).alias("each"), (F.col("k") % F.col("n")).alias("odd"),
        ),
        "cells",
    )
    place = F.row_number().over(Window.partitionBy(*KEY, "size", "range").orderBy("h", "doc_id"))
    ranked = rows.withColumn("place", place).join(cells, [*KEY, "size", "range"])
    many = (F.col("each") + (F.col("offset") + F.col("place") <= F.col("odd")).cast("int")).cast("int")
    return ranked.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * many).cast("long").alias("taken"), many.alias("copies")
    )


def op6_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))

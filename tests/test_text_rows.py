"""Rows with texts are numbered in ranges long before their number alone asks for it."""

from pyspark.sql import functions as F

from qrelmill.operators import corpus as C
from qrelmill.operators import ordering, review

N = ordering.SAFE_TEXTS + 1500


def _ranges(df) -> bool:
    return "_range" in df._jdf.queryExecution().optimizedPlan().toString()


def test_packs_of_many_texts_are_cut_into_ranges(spark):
    name = F.format_string("%06d", F.col("id"))
    docs = spark.range(N).select(F.lit("all").alias("dataset"), F.concat(name, F.lit(".md")).alias("file_name"), name.alias("stem"), F.lit("t").alias("text"))
    pieces = C.corpus_pack(docs)
    packs = C.assemble_packs(pieces)
    assert _ranges(pieces) and _ranges(packs) and not _ranges(C.corpus_pack(docs.limit(10)))
    assert pieces.where(F.col("ord") != F.col("stem").cast("int")).count() == 0
    rows = packs.orderBy("part").collect()
    assert [(r.part, r.parts) for r in rows] == [(i, len(rows)) for i in range(-(-N // ordering.PART_PIECES))]
    assert "".join(r.pack for r in rows) == "".join(f"\n\n# STEM: {i:06d}\nt" for i in range(N))


def test_groups_of_many_targets_are_cut_into_ranges(spark):
    rows = spark.range(N).select(
        F.lit("all").alias("dataset"), F.lit(1).alias("kind_ord"), F.col("id").alias("pos"), F.lit("").alias("name"),
        F.lit("corpus_doc").alias("target_type"), F.format_string("%06d", F.col("id")).alias("target_id"), F.lit('{"a":1}').alias("payload"),
    )
    groups = review.review_groups(rows, 8)
    assert _ranges(groups)
    got = [[t.target_id for t in r.targets] for r in groups.orderBy("grp").collect()]
    assert got == [[f"{i:06d}" for i in range(g, min(g + 8, N))] for g in range(0, N, 8)]

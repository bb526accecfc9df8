"""Document features, sections, blocks, markers and listings of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .ordering import PART_PIECES, SAFE_TEXTS, assemble_text, dense_index

DOC_KEY = ["dataset", "stem"]


def corpus_features(corpus: DataFrame) -> DataFrame:
    """All row-local features in one narrow pass; the text itself is dropped."""
    body = T.strip_front_matter(F.col("text"))
    stats = T.char_stats(body)
    return corpus.select(
        "dataset",
        "stem",
        "file_name",
        T.is_canonical(F.col("file_name")).alias("canonical"),
        T.document_language(F.col("text"), F.col("file_name")).alias("language"),
        T.front_matter(F.col("text")).alias("front_matter"),
        T.headings(F.col("text")).alias("headings"),
        T.target_markers(F.col("text")).alias("target_markers"),
        T.image_refs(F.col("text")).alias("image_refs"),
        stats.alias("stats"),
        F.length("text").alias("chars"),
        F.octet_length("text").alias("bytes"),
    )


def image_rows(corpus: DataFrame) -> DataFrame:
    return corpus.select(
        *DOC_KEY, "file_name", F.posexplode(T.image_refs(F.col("text"))).alias("pos", "ref")
    ).select(*DOC_KEY, "file_name", "pos", "ref.alt", "ref.path")


def sections(corpus: DataFrame) -> DataFrame:
    """One row per H2 section; cut row by row, so no text is shuffled."""
    return corpus.select(
        *DOC_KEY, F.posexplode(T.section_list(F.col("text"))).alias("section_no", "s")
    ).select(*DOC_KEY, "section_no", "s.heading", "s.section_text")


def section_for(targets: DataFrame, sections_df: DataFrame, limit: int = 4000) -> DataFrame:
    """Text of the section each target names; '' where there is none.

    Sections nobody names drop out in a semi-join on the same key (a broadcast
    where targets are few), and the text is cut before it is shuffled."""
    key = ["dataset", "doc", "heading"]
    cut = (
        sections_df.withColumnRenamed("stem", "doc")
        .join(targets.select(*key).distinct(), key, "left_semi")
        .select(*key, T.truncate(F.col("section_text"), limit).alias("section_text"))
    )
    return targets.join(cut, ["dataset", "doc", "heading"], "left").withColumn(
        "section_text", F.coalesce("section_text", F.lit(""))
    )


def markdown_blocks(corpus: DataFrame) -> DataFrame:
    """Typed non-blank lines: h1, h2, h3, image, target or paragraph."""
    lines = corpus.select(
        *DOC_KEY, F.posexplode(T.split_lines(F.col("text"))).alias("line_no", "raw")
    ).withColumn("line", T.rstrip(F.col("raw")))
    line = F.col("line")
    bare = T.strip(line)
    whole_image = rf"^{T.IMAGE}\z"
    kind = (
        F.when(bare.rlike(whole_image), "image")
        .when(line.startswith("### "), "h3")
        .when(line.startswith("## "), "h2")
        .when(line.startswith("# "), "h1")
        .when(line.startswith("Target: "), "target")
        .otherwise("paragraph")
    )
    content = (
        F.when(F.col("kind") == "image", F.regexp_extract(bare, T.IMAGE, 1))
        .when(F.col("kind") == "h3", F.substring(line, 5, 2**31 - 1))
        .when(F.col("kind") == "h2", F.substring(line, 4, 2**31 - 1))
        .when(F.col("kind") == "h1", F.substring(line, 3, 2**31 - 1))
        .otherwise(line)
    )
    path = F.substring_index(T.strip(F.regexp_extract(bare, T.IMAGE, 2)), " ", 1)
    return (
        lines.where(line != "")
        .withColumn("kind", kind)
        .select(
            *DOC_KEY,
            "line_no",
            "kind",
            content.alias("content"),
            F.when(F.col("kind") == "image", path).alias("path"),
        )
    )


def stamp_markers(corpus: DataFrame, prefix: str = "docmark") -> DataFrame:
    """Add the retrieval marker to canonical documents that lack it."""
    marker = T.marker_for_stem(F.col("stem"), prefix)
    todo = T.is_canonical(F.col("file_name")) & ~F.contains(F.col("text"), marker)
    return corpus.withColumn("changed", todo).withColumn(
        "text",
        F.when(
            F.col("changed"),
            T.insert_marker(F.col("text"), F.col("file_name").startswith("zh-"), marker),
        ).otherwise(F.col("text")),
    )


def language_counts(corpus: DataFrame) -> DataFrame:
    lang = T.document_language(F.col("text"), F.col("file_name"))
    return (
        corpus.select("dataset", lang.alias("lang"))
        .groupBy("dataset")
        .agg(
            F.count_if(F.col("lang").startswith("zh")).alias("zh"),
            F.count_if(F.col("lang").startswith("en")).alias("en"),
        )
    )


def corpus_listing(corpus: DataFrame) -> DataFrame:
    return corpus.select("dataset", "file_name", F.octet_length("text").alias("bytes"))


def corpus_pack(corpus: DataFrame, path: str = "file_name", safe_rows: int = SAFE_TEXTS) -> DataFrame:
    """The prompt pack of each dataset as ordered pieces.

    Laying the pieces end to end by ``ord`` gives the pack; a dataset of any
    size stays distributed. ``assemble_packs`` joins the pieces into parts."""
    placed = dense_index(corpus, ["dataset"], [path], "ord", None, safe_rows)
    piece = F.concat(F.lit("\n\n# STEM: "), F.col("stem"), F.lit("\n"), F.col("text"))
    return placed.select("dataset", "ord", "stem", piece.alias("piece"))


def assemble_packs(pieces: DataFrame, per_part: int = PART_PIECES, safe_rows: int = SAFE_TEXTS) -> DataFrame:
    """The packs as strings: ``pack`` in numbered parts of ``per_part`` pieces,
    one part for a dataset of at most that many documents."""
    return assemble_text(pieces.withColumnRenamed("piece", "pack"), ["dataset"], ["ord"], "pack", "", per_part, safe_rows)

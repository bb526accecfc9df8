"""Catalogue tables to asset/chunk targets, queries and section documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .curation import document_head
from .ordering import PART_PIECES, assemble_text


def union_catalogs(base: DataFrame, extra: DataFrame) -> DataFrame:
    return base.unionByName(extra)


def _target() -> Column:
    return F.concat_ws(".", "category", "slug")


def _heading() -> Column:
    return F.concat_ws(" / ", "zh", "en")


def catalog_assets(items: DataFrame) -> DataFrame:
    return items.select(
        "dataset",
        "pos",
        F.concat(_target(), F.lit(".image")).alias("id"),
        F.col("category").alias("doc"),
        F.format_string("images/%s/%s.png", "image_dir", "slug").alias("path"),
        _heading().alias("heading"),
        _target().alias("anchor"),
    )


def catalog_chunks(items: DataFrame) -> DataFrame:
    return items.select(
        "dataset",
        "pos",
        F.concat(_target(), F.lit(".text")).alias("id"),
        F.col("category").alias("doc"),
        _heading().alias("heading"),
        _target().alias("anchor"),
        F.concat(_target(), F.lit(".image")).alias("asset_id"),
    )


def _query(kind: str, query_type: str, text: str, assets: Column, chunks: Column, prefix: Column) -> Column:
    return F.struct(
        F.concat(prefix, F.lit(kind)).alias("id"),
        F.lit(query_type).alias("query_type"),
        F.col(text).alias("q"),
        assets.cast("array<string>").alias("expect_asset_any"),
        chunks.cast("array<string>").alias("expect_chunk_any"),
    )


def catalog_queries(items: DataFrame) -> DataFrame:
    """One asset query and one text query per item."""
    none = F.lit(None)
    prefix = F.concat_ws("_", "category", "slug")
    image = F.array(F.concat(_target(), F.lit(".image")))
    text = F.array(F.concat(_target(), F.lit(".text")))
    both = F.array(
        _query("_asset", "asset", "asset_query", image, none, prefix),
        _query("_chunk", "text_chunk", "chunk_query", none, text, prefix),
    )
    return items.select(
        "dataset", "pos", F.posexplode(both).alias("sub", "x"), F.array("category").alias("expect_any")
    ).select("dataset", "pos", "sub", "x.*", "expect_any")


def _extended_head(version: str, extra: Column) -> Column:
    return F.concat(
        F.lit("---\ntitle: "),
        F.col("title"),
        F.lit(f"\nlanguage: zh-CN\nsource: local-synthetic\nmodality: image-text\nversion: {version}\n"),
        extra,
        F.lit("\n---\n\n# "),
        F.col("title"),
        F.lit("\n\n"),
        F.col("intro"),
        F.lit("\n"),
    )


def catalog_pieces(items: DataFrame, version: str, hint: str) -> DataFrame:
    """Ordered text pieces of the section document of each category: a head at
    pos -1, then one section per item. ``hint`` is the last line of a section, with
    placeholders {zh}, {en} and {title}."""
    shown = F.lit(hint)
    for name in ("zh", "en", "title"):
        shown = F.replace(shown, F.lit("{" + name + "}"), F.col(name))
    section = F.concat_ws(
        "\n\n",
        F.concat(F.lit("## "), _heading()),
        F.concat(F.lit("Target: "), _target()),
        F.format_string("![%s图片 - %s](./images/%s/%s.png)", "zh", "en", "image_dir", "slug"),
        "desc",
        "visual",
        "use",
        shown,
    )
    heads = items.select("dataset", "category", "title", "intro").distinct()
    head = _extended_head(version, F.concat(F.lit("category: "), F.col("category")))
    return heads.select(
        "dataset", F.col("category").alias("stem"), F.lit(-1).cast("bigint").alias("pos"), head.alias("text")
    ).unionByName(
        items.select(
            "dataset",
            F.col("category").alias("stem"),
            F.col("pos").cast("bigint").alias("pos"),
            F.concat(section, F.lit("\n")).alias("text"),
        )
    )


def documents_of(pieces: DataFrame, per_part: int = PART_PIECES) -> DataFrame:
    """The documents of the pieces; one of very many pieces is several numbered parts."""
    docs = assemble_text(pieces, ["dataset", "stem"], ["pos"], "text", "\n", per_part)
    return docs.select("dataset", "stem", F.concat("stem", F.lit(".md")).alias("file_name"), "part", "parts", "text")


def expand_catalog(items: DataFrame, version: str, hint: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Assets, chunks, queries and corpus of ``items(dataset, category, title,
    intro, image_dir, pos, slug, zh, en, desc, visual, use, asset_query,
    chunk_query)``; ``pos`` orders items within the dataset."""
    return (
        catalog_assets(items),
        catalog_chunks(items),
        catalog_queries(items),
        documents_of(catalog_pieces(items, version, hint)),
    )


# --- multi-image groups ----------------------------------------------------


def _anchor() -> Column:
    return F.concat(F.lit("groups."), "slug")


def group_chunks(groups: DataFrame) -> DataFrame:
    return groups.select(
        "dataset",
        "pos",
        F.concat(_anchor(), F.lit(".text")).alias("id"),
        "doc",
        _heading().alias("heading"),
        _anchor().alias("anchor"),
        F.col("assets").alias("asset_ids"),
    )


def group_queries(groups: DataFrame) -> DataFrame:
    prefix = F.concat(F.lit("groups_"), "slug")
    chunk = F.array(F.concat(_anchor(), F.lit(".text")))
    both = F.array(
        _query("_chunk", "text_chunk", "chunk_query", F.col("assets"), chunk, prefix),
        _query("_asset_group", "asset_group", "asset_query", F.col("assets"), chunk, prefix),
    )
    return groups.select(
        "dataset", "pos", F.posexplode(both).alias("sub", "x"), F.array("doc").alias("expect_any")
    ).select("dataset", "pos", "sub", "x.*", "expect_any")


def group_pieces(groups: DataFrame, version: str) -> DataFrame:
    images = F.transform(
        "image_paths", lambda p: F.concat(F.lit("!["), _heading(), F.lit("](./"), p, F.lit(")"))
    )
    section = F.concat_ws(
        "\n\n",
        F.concat(F.lit("## "), _heading()),
        F.concat(F.lit("Target: "), _anchor()),
        F.array_join(images, "\n\n"),
        "summary",
        "detail",
    )
    heads = groups.select("dataset", "doc", "title", "intro").distinct()
    head = _extended_head(version, F.lit("target_shape: multi-image-chunk"))
    return heads.select(
        "dataset", F.col("doc").alias("stem"), F.lit(-1).cast("bigint").alias("pos"), head.alias("text")
    ).unionByName(
        groups.select(
            "dataset",
            F.col("doc").alias("stem"),
            F.col("pos").cast("bigint").alias("pos"),
            F.concat(section, F.lit("\n")).alias("text"),
        )
    )


def expand_groups(groups: DataFrame, version: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Multi-image chunks, their queries and the section documents of
    ``groups(dataset, doc, title, intro, pos, slug, zh, en, assets,
    image_paths, summary, detail, chunk_query, asset_query)``."""
    return group_chunks(groups), group_queries(groups), documents_of(group_pieces(groups, version))


# --- topics ----------------------------------------------------------------


def expand_topics(topics: DataFrame, source: str = "local-diverse-synthetic") -> tuple[DataFrame, DataFrame]:
    """Corpus and positive queries of ``topics(dataset, pos, stem, language,
    title, question, body)``."""
    corpus = topics.select(
        "dataset",
        "stem",
        F.concat("stem", F.lit(".md")).alias("file_name"),
        F.concat(document_head("title", "language", source), "body", F.lit("\n")).alias("text"),
    )
    queries = topics.select("dataset", "pos", F.col("question").alias("q"), F.array("stem").alias("expect_any"))
    return corpus, queries

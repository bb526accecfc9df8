"""From drafted candidates to reviewed query sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext as J
from ..functions import keys as K
from ..functions import text as T
from .ordering import PART_PIECES, SAFE_ROWS, assemble_text, chunk_rows, even_spread
from .tasks import SUCCEEDED, fill, prompt_tasks

EXPORTED = ("approve", "rewrite")
EMPTY = "cast(array() as array<string>)"


def extract_candidates(lines: DataFrame) -> DataFrame:
    """Candidate objects of JSON lines.

    Reads (dataset, source, line_no, v): an array gives its objects; an object
    with q or corrected_q counts in direct files; an audit line of a succeeded
    drafting task gives the objects of its result. ``pos`` keeps file order."""
    v = F.col("v")
    result = J.field(v, "result")
    drafted = (J.as_string(J.field(v, "stage")) == "generate_candidates") & (
        J.as_string(J.field(v, "status")) == SUCCEEDED
    )

    def asks(x: Column) -> Column:
        return J.is_object(x) & (J.has_field(x, "q") | J.has_field(x, "corrected_q"))

    found = (
        F.when(J.is_array(v), J.elements(v))
        .when((F.col("source") == "direct") & asks(v), F.array(v))
        .when(J.is_object(v) & drafted & J.is_array(result), J.elements(result))
        .when(J.is_object(v) & drafted & asks(result), F.array(result))
    )
    return (
        lines.select("dataset", "line_no", F.posexplode(found).alias("item_no", "raw"))
        .where(J.is_object(F.col("raw")))
        .select("dataset", F.struct("line_no", "item_no").alias("pos"), "raw")
    )


def normalize_candidates(raw: DataFrame) -> DataFrame:
    """Query text, expected documents and identity of each candidate object."""
    v = F.col("raw")

    def first_of(a: str, b: str) -> Column:
        one, two = J.field(v, a), J.field(v, b)
        return F.when(J.truthy(one), one).otherwise(two)

    q = T.strip(J.text_or(first_of("q", "corrected_q")))
    expect = J.coerce_string_list(first_of("expect_any", "corrected_expect_any"))
    return (
        raw.withColumn("q", q)
        .where("q <> ''")
        .withColumn("expect_any", expect)
        .withColumn("candidate_id", K.candidate_id(v, F.col("q"), F.col("expect_any")))
    )


def dedup_candidates(df: DataFrame) -> DataFrame:
    """The first occurrence per identity. The raw record travels as text
    through the map-side combined minimum."""
    cols = [c for c in df.columns if c not in ("dataset", "candidate_id", "raw")]
    firsts = (
        df.withColumn("_raw", F.to_json("raw"))
        .groupBy("dataset", "candidate_id")
        .agg(F.min_by(F.struct(*cols, "_raw"), "pos").alias("c"))
    )
    return firsts.select(
        "dataset", "candidate_id", *[F.col(f"c.{c}") for c in cols], F.parse_json(F.col("c._raw")).alias("raw")
    )


def load_candidates(lines: DataFrame) -> DataFrame:
    return dedup_candidates(normalize_candidates(extract_candidates(lines)))


def upsert_decisions(log: DataFrame) -> DataFrame:
    """The latest saved decision per candidate of an append-only log.

    Decisions saved at the same time are told apart by ``seq`` where the log
    has it, else by their content, so that the choice is always the same."""
    cols = ["decision", "edited_q", "edited_expect_any", "notes", "updated_at"]
    ties = [c for c in ("seq",) if c in log.columns] + cols[:-1]
    return (
        log.groupBy("dataset", "candidate_id")
        .agg(F.max_by(F.struct(*cols), F.struct("updated_at", *ties)).alias("d"))
        .select("dataset", "candidate_id", "d.*")
    )


def stage_notes(recent: DataFrame) -> DataFrame:
    """One note per stage: of the newest rows the oldest one speaks."""
    note = F.concat_ws(
        "",
        "status",
        F.lit(" · attempts "),
        F.col("attempts").cast("string"),
        F.lit(" · "),
        F.coalesce("last_error", F.lit("")),
    )
    return (
        recent.withColumn("note", note)
        .groupBy("dataset", "stage")
        .agg(F.max_by("note", "rank").alias("note"))
    )


def review_queue(candidates: DataFrame, decisions: DataFrame, recent: DataFrame) -> DataFrame:
    """What a reviewer sees: candidates with decision (default pending), edits
    over the drafted values, evidence, confidence and the drafting note."""
    notes = stage_notes(recent).where("stage = 'generate_candidates'").select("dataset", F.col("note").alias("audit"))
    raw = F.col("raw")
    evidence, rationale = J.field(raw, "evidence"), J.field(raw, "rationale")
    confidence = J.field(raw, "confidence")
    edited = F.col("edited_expect_any")
    joined = candidates.join(decisions, ["dataset", "candidate_id"], "left").join(notes, "dataset", "left")
    return joined.select(
        "dataset",
        "candidate_id",
        "pos",
        F.coalesce(T.none_if_empty(F.col("decision")), F.lit("pending")).alias("status"),
        "q",
        F.coalesce(T.none_if_empty(F.col("edited_q")), F.col("q")).alias("edited_q"),
        F.when(F.size(edited) > 0, edited).otherwise(F.col("expect_any")).alias("expected"),
        F.when(J.truthy(evidence), J.py_str(evidence)).otherwise(J.text_or(rationale)).alias("evidence"),
        F.when(confidence.isNull(), "").otherwise(J.py_str(confidence)).alias("confidence"),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("notes", F.lit("")).alias("notes"),
    )


def _reviewed(candidates: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    chosen = decisions.where(F.col("decision").isin(*EXPORTED))
    known = candidates.select(
        "dataset", "candidate_id", F.col("q").alias("c_q"), F.col("expect_any").alias("c_any"), "raw"
    )
    return chosen.join(known, ["dataset", "candidate_id"], how)


def _effective(df: DataFrame) -> DataFrame:
    edited = F.col("edited_expect_any")
    any_ = F.when(F.size(edited) > 0, edited).otherwise(F.coalesce("c_any", F.expr(EMPTY)))
    none = J.truthy(J.field(F.col("raw"), "expect_none"))
    return df.withColumn("x_any", any_).withColumn("x_none", none & (F.size("x_any") == 0))


def export_queries(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Query records of approved and rewritten candidates, to be read in
    (updated_at, candidate_id) order; edits win over the drafted values."""
    rows = _effective(_reviewed(candidates, decisions, "inner"))
    raw = F.col("raw")
    given = J.field(raw, "id")
    return rows.where((F.size("x_any") > 0) | F.col("x_none")).select(
        "dataset",
        "updated_at",
        "candidate_id",
        F.when(J.truthy(given), J.py_str(given)).otherwise(F.col("candidate_id")).alias("id"),
        F.coalesce(T.none_if_empty(T.strip(F.col("edited_q"))), F.col("c_q")).alias("q"),
        J.as_string(J.field(raw, "query_type")).alias("query_type"),
        F.when(F.size("x_any") > 0, F.col("x_any")).alias("expect_any"),
        F.when(F.col("x_none"), True).alias("expect_none"),
        J.string_array(J.field(raw, "expect_asset_any")).alias("expect_asset_any"),
        J.string_array(J.field(raw, "expect_chunk_any")).alias("expect_chunk_any"),
    )


def export_violations(candidates: DataFrame, decisions: DataFrame, corpus: DataFrame) -> DataFrame:
    """Reasons that block the export of a dataset."""
    rows = _effective(_reviewed(candidates, decisions, "left"))
    unknown = F.col("c_q").isNull()
    usable = (F.size("x_any") > 0) | F.coalesce("x_none", F.lit(False))
    direct = rows.where(unknown | ~usable).select(
        "dataset",
        "candidate_id",
        F.when(unknown, F.concat(F.lit("reviewed candidate not found: "), "candidate_id"))
        .otherwise(F.concat("candidate_id", F.lit(": must set expect_any or expect_none")))
        .alias("message"),
    )
    stems = corpus.select("dataset", F.col("stem").alias("item"))
    lost = (
        rows.where(~unknown)
        .select("dataset", "candidate_id", F.posexplode("x_any").alias("i", "item"))
        .join(stems, ["dataset", "item"], "left_anti")
        .select(
            "dataset",
            "candidate_id",
            F.concat("candidate_id", F.lit(": expect_any references missing stem: "), "item").alias("message"),
        )
    )
    exported = rows.where(~unknown & usable).select("dataset").distinct()
    nothing = (
        corpus.select("dataset").distinct()
        .unionByName(decisions.select("dataset").distinct()).distinct()
        .join(exported, "dataset", "left_anti")
        .select(
            "dataset",
            F.lit("").alias("candidate_id"),
            F.lit("no approved or rewritten candidates to export").alias("message"),
        )
    )
    return direct.unionByName(lost).unionByName(nothing)


# --- deterministic query sets ----------------------------------------------


def marker_queries(
    corpus: DataFrame,
    limit: int = 80,
    prefix: str = "docmark",
    question_zh: str = "哪个文档包含检索标记 {marker}？",
    question_en: str = "Which document contains retrieval marker {marker}?",
    safe_rows: int = SAFE_ROWS,
) -> DataFrame:
    """Up to ``limit`` positive queries per dataset: half over evenly spread
    zh documents, the rest over en documents, each expecting its own stem."""
    half = limit // 2
    lang = F.when(F.col("file_name").startswith("zh-"), "zh").when(F.col("file_name").startswith("en-"), "en")
    docs = corpus.select("dataset", "stem", "file_name", lang.alias("lang")).where("lang is not null")
    zh_taken = docs.groupBy("dataset").agg(
        F.least(F.count_if(F.col("lang") == "zh"), F.lit(half)).alias("zh_taken")
    )
    share = F.when(F.col("lang") == "zh", F.lit(half)).otherwise(F.lit(limit) - F.col("zh_taken"))
    picked = even_spread(docs.join(zh_taken, "dataset"), share, ["dataset", "lang"], ["file_name"], safe_rows)
    marker = T.marker_for_stem(F.col("stem"), prefix)
    text = F.when(F.col("lang") == "zh", F.replace(F.lit(question_zh), F.lit("{marker}"), marker)).otherwise(
        F.replace(F.lit(question_en), F.lit("{marker}"), marker)
    )
    return picked.select(
        "dataset", "lang", "file_name", text.alias("q"), F.array("stem").alias("expect_any"), F.lit(None).cast("boolean").alias("expect_none")
    )


def append_negatives(queries: DataFrame, negatives: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` off-topic questions appended to every dataset that has queries."""
    texts = F.lit(list(negatives)[: max(n, 0)]).cast("array<string>")
    extra = queries.select("dataset").distinct().select("dataset", F.posexplode(texts).alias("neg_pos", "q"))
    return queries.select("dataset", "q", "expect_any", "expect_none", F.lit(None).cast("int").alias("neg_pos")).unionByName(
        extra.select("dataset", "q", F.expr(EMPTY).alias("expect_any"), F.lit(True).alias("expect_none"), "neg_pos")
    )


def replace_by_prefix(df: DataFrame, new: DataFrame, prefix: str, key: str = "id") -> DataFrame:
    """Drop rows whose key starts with the prefix and append the new ones."""
    kept = df.where(~F.coalesce(F.col(key), F.lit("")).startswith(prefix))
    return kept.unionByName(new, allowMissingColumns=True)


# --- model results to corpus and queries -----------------------------------


def materialize_cluster_queries(results: DataFrame, cluster_docs: DataFrame, corpus: DataFrame) -> DataFrame:
    """Drafted queries of succeeded per-cluster tasks whose stem belongs to the
    task's cluster and to the corpus.

    ``results(dataset, task_id, cluster, status, result)``,
    ``cluster_docs(dataset, cluster, language, stem)``."""
    drafted = (
        results.where(F.col("status") == SUCCEEDED)
        .select("dataset", "task_id", "cluster", F.posexplode(J.elements(F.try_parse_json("result"))).alias("pos", "v"))
        .where(J.is_object(F.col("v")))
    )
    v = F.col("v")

    def text(name: str) -> Column:
        x = J.field(v, name)
        return F.when(x.isNull(), "").otherwise(T.strip(J.py_str(x)))

    rows = drafted.select("dataset", "task_id", "cluster", "pos", text("stem").alias("stem"), text("q").alias("q"))
    valid = cluster_docs.select("dataset", "cluster", "stem", "language")
    return (
        rows.where("q <> ''")
        .join(valid, ["dataset", "cluster", "stem"])
        .join(corpus.select("dataset", "stem"), ["dataset", "stem"], "left_semi")
        .select(
            "dataset",
            "task_id",
            "pos",
            F.concat_ws("-", "language", "stem").alias("id"),
            "q",
            F.array("stem").alias("expect_any"),
        )
    )


def materialize_corpus(results: DataFrame, meta: DataFrame, source_marker: str) -> DataFrame:
    """Documents of succeeded writing tasks.

    ``results(dataset, task_id, source_ord, ord, status, result)`` lists stored
    rows first (source_ord 0) and new ones after; ``meta(dataset, task_id, stem,
    language, title)``. A {text} result is one document named by its metadata;
    a list or object names its own. The first document per stem wins, even
    when it turns out blank and is then dropped."""
    v = F.col("v")
    parsed = (
        results.where(F.col("status") == SUCCEEDED)
        .withColumn("v", F.try_parse_json("result"))
        .where(v.isNotNull())
        .join(
            meta.select("dataset", "task_id", F.col("stem").alias("m_stem"), F.col("language").alias("m_lang"), F.col("title").alias("m_title")),
            ["dataset", "task_id"],
            "left",
        )
    )
    is_text = J.is_object(v) & J.is_string(J.field(v, "text"))
    docs = parsed.withColumn("is_text", is_text).select(
        "dataset", "task_id", "source_ord", "ord", "is_text", "m_stem", "m_lang", "m_title",
        F.posexplode(F.when(J.is_array(v) & ~is_text, J.elements(v)).otherwise(F.array(v))).alias("item", "d"),
    ).where(J.is_object(F.col("d")))
    d = F.col("d")
    plain = F.col("is_text")
    own_stem = F.when(plain, F.coalesce("m_stem", "task_id")).otherwise(
        F.when(J.truthy(J.field(d, "stem")), J.py_str(J.field(d, "stem"))).otherwise(F.col("task_id"))
    )
    named = docs.withColumn("stem", T.safe_stem(own_stem))
    title = F.when(plain, F.coalesce("m_title", "stem")).otherwise(
        F.when(J.truthy(J.field(d, "title")), J.py_str(J.field(d, "title"))).otherwise(F.col("stem"))
    )
    lang = F.when(plain, F.coalesce("m_lang", F.lit(""))).otherwise(F.lower(J.text_or(J.field(d, "language"))))
    body = T.strip(F.when(plain, J.as_string(J.field(d, "text"))).otherwise(J.text_or(J.field(d, "markdown"))))
    first = (
        named.select("dataset", "stem", title.alias("title"), lang.alias("language"), body.alias("body"), F.struct("source_ord", "ord", "task_id", "item").alias("o"))
        .groupBy("dataset", "stem")
        .agg(F.min_by(F.struct("title", "language", "body"), "o").alias("x"))
        .select("dataset", "stem", "x.*")
        .where("body <> ''")
    )
    markdown = F.when(F.col("body").startswith("#"), F.col("body")).otherwise(
        F.concat(F.lit("# "), "title", F.lit("\n\n"), "body")
    )
    return first.select(
        "dataset",
        "stem",
        F.concat("stem", F.lit(".md")).alias("file_name"),
        "language",
        F.concat(document_head("title", "language", source_marker), markdown, F.lit("\n")).alias("text"),
    )


def document_head(title: str, language: str, source: str) -> Column:
    """Front matter block; the language line only where there is one."""
    return F.concat(
        F.lit("---\ntitle: "),
        F.col(title),
        F.lit("\n"),
        F.when(F.col(language) != "", F.concat(F.lit("language: "), F.col(language), F.lit("\n"))).otherwise(""),
        F.lit(f"source: {source}\n---\n\n"),
    )


# --- topic clusters --------------------------------------------------------


def cluster_entries(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The two texts of a cluster document, its sibling entry and its listing line, and
    its columns ``carry``.

    ``docs(dataset, cluster, pos, slug, title, focus)``."""
    entry = F.concat("title", F.lit(" ("), "focus", F.lit(")"))
    line = F.concat(
        F.lit("- stem="), "cluster", F.lit("-"), "slug", F.lit(" | title="), "title", F.lit(" | focus: "), "focus"
    )
    more = [c for c in carry if c not in ("pos", "slug")]
    return docs.select("dataset", "cluster", "pos", "slug", entry.alias("entry"), line.alias("line"), *more)


def cluster_siblings(docs: DataFrame, per_part: int = PART_PIECES) -> DataFrame:
    """For each document of a cluster, all other documents in numbered parts:
    dataset, cluster, slug, part, parts, siblings.

    The list of a cluster is built once per part of ``per_part`` neighbours by ``pos``,
    and each document reads all parts and leaves itself out, so no pairs are formed.
    Laid end to end with "; " between them the parts name every other document. A
    part without any is left out; a document that is alone has one empty part."""
    return _told(docs, per_part, ("slug",)).select("dataset", "cluster", "slug", "part", "parts", "siblings")


def cluster_siblings_laid(docs: DataFrame, per_part: int = PART_PIECES) -> DataFrame:
    """The parts of ``cluster_siblings`` laid end to end: dataset, cluster, slug, siblings.

    The parts of a cluster are brought together once, and each document writes its own
    text when it is read, so that only the documents and one list per cluster are moved."""
    placed, listed = _cluster_parts(docs, per_part)
    whole = listed.groupBy("dataset", "cluster").agg(F.array_sort(F.collect_list(F.struct("part", "all")))["all"].alias("every"))
    told = F.filter("every", lambda part: F.exists(part, lambda x: x["slug"] != F.col("slug")))
    laid = F.array_join(F.transform(told, _other_entries), "; ").alias("siblings")
    return placed.select("dataset", "cluster", "slug").join(whole, ["dataset", "cluster"]).select("dataset", "cluster", "slug", laid)


def _told(docs: DataFrame, per_part: int, carry: Sequence[str]) -> DataFrame:
    """Each document, with its columns ``carry``, and the parts of its cluster without itself.
    The texts are written last and move no more."""
    placed, listed = _cluster_parts(docs, per_part, carry)
    parts = listed.groupBy("dataset", "cluster").agg(F.count(F.lit(1)).cast("int").alias("parts"))
    known = placed.select("dataset", "cluster", *carry)
    read = known.join(listed.join(parts, ["dataset", "cluster"]), ["dataset", "cluster"])
    told = F.exists("all", lambda x: x["slug"] != F.col("slug")) | (F.col("parts") == 1)
    return read.where(told).withColumn("siblings", _other_entries(F.col("all"))).drop("all")


def _cluster_parts(docs: DataFrame, per_part: int, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Each document with its part, and the entries of each part in order."""
    entries = cluster_entries(docs, carry).drop("line")
    parts = chunk_rows(entries, per_part, ["dataset", "cluster"], ["pos", "slug"]).withColumnRenamed("grp", "part")
    listed = parts.groupBy("dataset", "cluster", "part").agg(
        F.sort_array(F.collect_list(F.struct("pos", "slug", "entry"))).alias("all")
    )
    return parts, listed


def _other_entries(entries: Column) -> Column:
    others = F.filter(entries, lambda x: x["slug"] != F.col("slug"))
    return F.array_join(F.transform(others, lambda x: x["entry"]), "; ")


def cluster_listing(docs: DataFrame, per_part: int = PART_PIECES) -> DataFrame:
    """The prompt listing of each cluster in numbered parts, with the number
    ``n`` of documents of the whole cluster."""
    sizes = docs.groupBy("dataset", "cluster").agg(F.count(F.lit(1)).alias("n"))
    lines = cluster_entries(docs).select("dataset", "cluster", "pos", "slug", F.col("line").alias("listing"))
    listed = assemble_text(lines, ["dataset", "cluster"], ["pos", "slug"], "listing", "\n", per_part)
    return listed.join(sizes, ["dataset", "cluster"]).select("dataset", "cluster", "n", "part", "parts", "listing")


def cluster_doc_tasks(
    docs: DataFrame,
    version: str,
    system: str,
    user: str,
    stage: str = "generate_cluster_corpus",
    per_part: int = PART_PIECES,
) -> DataFrame:
    """One writing task per cluster document and part of its siblings, so that its tasks
    tell it of all of them; the first part's source is that of a cluster of one part.

    Placeholders: {title}, {focus}, {siblings}, {language}."""
    rows = _told(docs, per_part, ("slug", "title", "focus", "language")).withColumn("stem", F.concat_ws("-", "cluster", "slug"))
    values = {c: F.col(c) for c in ("title", "focus", "siblings", "language")}
    later = F.when(F.col("part") > 0, F.concat(F.lit("part"), F.col("part").cast("string")))
    source = F.concat_ws(":", "dataset", "stem", "language", F.lit(version), later)
    extra = ("stem", "language", "title", "part")
    return prompt_tasks(rows, stage, version, F.lit(system), fill(user, values), source, False, extra)


def cluster_query_tasks(docs: DataFrame, version: str, system: str, user: str, stage: str = "generate_cluster_queries") -> DataFrame:
    """One query-drafting task per part of a cluster's listing; the first part's
    source is that of a cluster of one part. Placeholders: {n}, {listing}."""
    rows = cluster_listing(docs)
    later = F.when(F.col("part") > 0, F.concat(F.lit("part"), F.col("part").cast("string")))
    source = F.concat_ws(":", "dataset", F.lit("queries"), "cluster", F.lit(version), later)
    values = {"n": F.col("n"), "listing": F.col("listing")}
    return prompt_tasks(rows, stage, version, F.lit(system), fill(user, values), source, True, ("cluster", "part"))

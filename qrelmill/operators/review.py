"""Quality-review targets, batches and items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext as J
from ..functions import text as T
from ..session import written
from .corpus import section_for, sections
from .ordering import PART_PIECES, SAFE_TEXTS, chunk_rows, list_parts
from .tasks import SUCCEEDED, fill, prompt_tasks
from .validate import Package

# --- fixed values
DECISIONS = ("fail", "warn", "pass")
RETRY_HINT = "Retry the quality review or inspect this target manually."
DOC_CHARS, SECTION_CHARS, CONTEXT_CHARS = 6000, 4000, 1800
NOTE_TEXT_LEVEL = "targets.yaml is optional for text_doc_level datasets."
NOTE_MULTIMODAL = "targets.yaml is expected for multimodal datasets."
NOTE_NEGATIVE = "expect_none=true means this is an intentional out-of-domain negative query."
NOTE_POSITIVE = "expect_any should resolve to one or more corpus document stems."
# --- end of fixed values

def dataset_mode(pkg: Package) -> DataFrame:
    """multimodal, multimodal_without_targets or text_doc_level per dataset."""
    images = pkg.corpus.groupBy("dataset").agg(F.bool_or(F.col("text").rlike(T.IMAGE)).alias("has_images"))
    mode = (
        F.when(F.col("has_targets"), "multimodal")
        .when(F.coalesce("has_images", F.lit(False)), "multimodal_without_targets")
        .otherwise("text_doc_level")
    )
    return pkg.datasets.join(images, "dataset", "left").select("dataset", mode.alias("dataset_mode"))


def _positive(queries: DataFrame) -> DataFrame:
    return queries.where(~F.coalesce("expect_none", F.lit(False)))


def summary_docs(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """Distinct documents expected by positive queries and whether each is
    missing from the corpus: the lists behind the counts of ``query_summary``."""
    wanted = _positive(queries).select("dataset", F.explode("expect_any").alias("doc")).distinct()
    known = corpus.select("dataset", F.col("stem").alias("doc"), F.lit(False).alias("missing"))
    return wanted.join(known, ["dataset", "doc"], "left").withColumn("missing", F.coalesce("missing", F.lit(True)))


def query_summary(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    negative = F.coalesce("expect_none", F.lit(False))
    counts = queries.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~negative).alias("positive"),
        F.count_if(negative).alias("negative"),
    )
    docs = (
        summary_docs(queries, corpus)
        .groupBy("dataset")
        .agg(F.count(F.lit(1)).alias("n_expected"), F.count_if("missing").alias("n_missing"))
    )
    return counts.join(docs, "dataset", "left").fillna(0, ["n_expected", "n_missing"])


def _named_docs(corpus: DataFrame, named: DataFrame) -> DataFrame:
    """The documents that ``named(dataset, doc)`` mentions, before any text is
    shuffled further: a broadcast semi-join where few are named."""
    docs = corpus.withColumnRenamed("stem", "doc")
    return docs.join(named.select("dataset", "doc").distinct(), ["dataset", "doc"], "left_semi")


def expected_contexts(queries: DataFrame, corpus: DataFrame, limit: int = CONTEXT_CHARS) -> DataFrame:
    """Per query the expected documents in stated order with existence,
    headings and leading text; empty for negatives. Texts are cut before they
    meet the query side."""
    wanted = _positive(queries).select("dataset", "pos", F.posexplode("expect_any").alias("i", "doc"))
    cut = _named_docs(corpus, wanted).select(
        "dataset",
        "doc",
        F.lit(True).alias("exists"),
        T.headings(F.col("text")).alias("headings"),
        T.truncate(F.col("text"), limit).alias("text"),
    )
    entry = F.struct(
        "i",
        "doc",
        F.coalesce("exists", F.lit(False)).alias("exists"),
        F.coalesce("headings", F.array().cast("array<string>")).alias("headings"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    found = (
        wanted.join(cut, ["dataset", "doc"], "left")
        .groupBy("dataset", "pos")
        .agg(F.sort_array(F.collect_list(entry)).alias("c"))
    )
    bare = F.transform("c", lambda x: x.dropFields("i"))
    none = F.expr("cast(array() as array<struct<doc string, exists boolean, headings array<string>, text string>>)")
    return (
        queries.select("dataset", "pos", "id")
        .join(found.select("dataset", "pos", bare.alias("contexts")), ["dataset", "pos"], "left")
        .withColumn("contexts", F.coalesce("contexts", none))
    )


def review_targets(pkg: Package, per_part: int = PART_PIECES) -> DataFrame:
    """Everything to review: dataset, dataset_list, corpus_doc, query, target_asset
    and target_chunk rows with a JSON payload, ordered by (kind_ord, pos, name).

    A document list of any size is kept in parts of ``per_part`` names. The
    dataset row holds the first part of each list and, where there are more,
    their number; the other parts are dataset_list rows right behind it. A query
    row names the first part of the documents and, of the others, those that it
    expects. Rows whose manifest entry is not a mapping are left out."""
    queries = pkg.queries.where("is_mapping")
    wanted = summary_docs(queries, pkg.corpus)
    lists = (
        list_parts(pkg.corpus, "dataset", "stem", per_part)
        .withColumn("which", F.lit("corpus_docs"))
        .unionByName(
            list_parts(wanted, "dataset", "doc", per_part).withColumn("which", F.lit("positive_expect_any_docs"))
        )
        .unionByName(
            list_parts(wanted.where("missing"), "dataset", "doc", per_part).withColumn(
                "which", F.lit("missing_expect_any_docs")
            )
        )
    )
    none_listed = F.array().cast("array<string>")

    def first(which: str, name: str) -> DataFrame:
        more = F.when(F.col("parts") > 1, F.col("parts"))
        head = lists.where((F.col("which") == which) & (F.col("part") == 0))
        return head.select("dataset", F.col("list").alias(name), more.alias(f"{name}_parts"))

    docs_list = first("corpus_docs", "list")
    expected = first("positive_expect_any_docs", "expected")
    missing = first("missing_expect_any_docs", "missing")
    totals = pkg.corpus.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_docs"))

    def out(df: DataFrame, kind_ord: int, kind: str, target_id: Column, payload: Column, pos: Column, name: Column) -> DataFrame:
        return df.select(
            "dataset",
            F.lit(kind_ord).alias("kind_ord"),
            pos.cast("bigint").alias("pos"),
            name.alias("name"),
            F.lit(kind).alias("target_type"),
            target_id.alias("target_id"),
            F.to_json(payload).alias("payload"),
        )

    none = F.lit("")
    head = (
        pkg.datasets.join(dataset_mode(pkg), "dataset")
        .join(totals, "dataset", "left")
        .join(docs_list, "dataset", "left")
        .join(query_summary(queries, pkg.corpus), "dataset", "left")
        .join(expected, "dataset", "left")
        .join(missing, "dataset", "left")
    )
    text_level = F.col("dataset_mode") == "text_doc_level"
    data = out(
        head,
        0,
        "dataset",
        F.col("dataset"),
        F.struct(
            "dataset_mode",
            F.coalesce("n_docs", F.lit(0)).alias("corpus_doc_count"),
            F.coalesce("list", none_listed).alias("corpus_docs"),
            F.col("list_parts").alias("corpus_docs_parts"),
            F.col("has_targets").alias("has_targets_yaml"),
            F.when(text_level, NOTE_TEXT_LEVEL).otherwise(NOTE_MULTIMODAL).alias("targets_yaml_note"),
            F.struct(
                F.coalesce("total", F.lit(0)).alias("total"),
                F.coalesce("positive", F.lit(0)).alias("positive"),
                F.coalesce("negative", F.lit(0)).alias("negative_expect_none"),
                F.coalesce("missing", none_listed).alias("missing_expect_any_docs"),
                F.col("missing_parts").alias("missing_expect_any_docs_parts"),
                F.coalesce("expected", none_listed).alias("positive_expect_any_docs"),
                F.col("expected_parts").alias("positive_expect_any_docs_parts"),
            ).alias("query_summary"),
        ),
        F.lit(0),
        none,
    )
    later = out(
        lists.where("part > 0"),
        0,
        "dataset_list",
        F.concat_ws("#", "dataset", "which", F.col("part").cast("string")),
        F.struct(F.col("which").alias("list"), "part", "parts", F.col("list").alias("docs")),
        F.col("part"),
        F.col("which"),
    )
    text = F.col("text")
    docs = out(
        pkg.corpus,
        1,
        "corpus_doc",
        F.col("stem"),
        F.struct(
            F.col("stem").alias("doc"),
            T.truncate(text, DOC_CHARS).alias("text"),
            T.headings(text).alias("headings"),
            T.target_markers(text).alias("target_markers"),
            T.image_refs(text).alias("image_refs"),
        ),
        F.lit(0),
        F.col("stem"),
    )
    negative = F.coalesce("expect_none", F.lit(False))
    ctx = expected_contexts(queries, pkg.corpus).drop("id")
    asked = queries.join(ctx, ["dataset", "pos"], "left").join(docs_list, "dataset", "left")
    # The contexts come from a join with the whole corpus, whatever part names the document.
    expected_here = F.transform(F.filter("contexts", lambda c: c["exists"]), lambda c: c["doc"])
    query_rows = out(
        asked,
        2,
        "query",
        F.coalesce(T.none_if_empty(F.col("id")), F.concat(F.lit("query-"), F.col("pos").cast("string"))),
        F.struct(
            F.struct("id", "q", "query_type", "expect_any", "expect_none", "expect_asset_any", "expect_chunk_any").alias("query"),
            F.when(negative, "negative").otherwise("positive").alias("query_role"),
            F.when(F.col("list_parts").isNull(), F.coalesce("list", none_listed))
            .otherwise(F.array_union("list", expected_here))
            .alias("known_corpus_docs"),
            F.col("list_parts").alias("known_corpus_docs_parts"),
            F.col("contexts").alias("expected_doc_contexts"),
            F.when(negative, NOTE_NEGATIVE).otherwise(NOTE_POSITIVE).alias("review_note"),
        ),
        F.col("pos"),
        none,
    )
    # Assets and chunks look their sections up together: one pass over the text.
    marked = pkg.assets.where("is_mapping").select(
        F.lit(3).alias("kind_ord"), "dataset", "pos", "id", "doc", "path", "heading", "anchor"
    ).unionByName(
        pkg.chunks.where("is_mapping").select(
            F.lit(4).alias("kind_ord"), "dataset", "pos", "id", "doc", "heading", "anchor", "asset_id", "asset_ids"
        ),
        allowMissingColumns=True,
    )
    refs = _named_docs(pkg.corpus, marked.where("kind_ord = 3")).select("dataset", "doc", T.image_refs(text).alias("refs"))
    found = section_for(marked, sections(pkg.corpus), SECTION_CHARS).join(refs, ["dataset", "doc"], "left")
    no_refs = F.expr("cast(array() as array<struct<alt string, path string>>)")
    asset = F.struct(
        F.struct("id", "doc", "path", "heading", "anchor").alias("asset"),
        "section_text",
        F.coalesce("refs", no_refs).alias("image_refs_in_doc"),
    )
    chunk = F.struct(
        F.struct("id", "doc", "heading", "anchor", "asset_id", "asset_ids").alias("chunk"),
        "section_text",
        T.image_refs(F.col("section_text")).alias("section_image_refs"),
    )
    is_asset = F.col("kind_ord") == 3
    numbered = F.concat(F.when(is_asset, "asset-").otherwise("chunk-"), F.col("pos").cast("string"))
    target_rows = found.select(
        "dataset",
        "kind_ord",
        F.col("pos").cast("bigint").alias("pos"),
        none.alias("name"),
        F.when(is_asset, "target_asset").otherwise("target_chunk").alias("target_type"),
        F.coalesce(T.none_if_empty(F.col("id")), numbered).alias("target_id"),
        F.when(is_asset, F.to_json(asset)).otherwise(F.to_json(chunk)).alias("payload"),
    )
    return data.unionByName(later).unionByName(docs).unionByName(query_rows).unionByName(target_rows)


def review_groups(
    targets: DataFrame,
    size: int = 8,
    version: str = "v1",
    system: str = "You are a strict evaluator for retrieval evaluation datasets.",
    user: str = "Review the following dataset targets.\nDataset: {dataset}\nBatch index: {index}\nTargets:\n{source}",
    safe_rows: int = SAFE_TEXTS,
) -> DataFrame:
    """Tasks over consecutive groups of ``size`` targets, numbered from 1.
    ``targets`` of each group are kept as (target_type, target_id) for later.
    Rows that go on with a dataset's lists are targets as well: they come right
    behind their dataset, so that every name of a list is in some task."""
    stored = written(targets, "review-targets")  # numbering reads them several times
    placed = chunk_rows(stored, size, ["dataset"], ["kind_ord", "pos", "name", "target_id"], safe_rows)
    entry = F.concat(
        F.lit('{"target_type":'),
        J.json_quote(F.col("target_type")),
        F.lit(',"target_id":'),
        J.json_quote(F.col("target_id")),
        F.when(F.col("payload") == "{}", "").otherwise(F.concat(F.lit(","), F.substring("payload", 2, 2**31 - 1))),
        F.when(F.col("payload") == "{}", "}").otherwise(""),
    )
    groups = (
        placed.groupBy("dataset", "grp")
        .agg(F.array_sort(F.collect_list(F.struct("slot", entry.alias("json"), "target_type", "target_id"))).alias("g"))
        .select(
            "dataset",
            "grp",
            F.concat(F.lit("["), F.array_join(F.col("g.json"), ", "), F.lit("]")).alias("source"),
            F.transform("g", lambda x: F.struct(x["target_type"], x["target_id"])).alias("targets"),
        )
    )
    values = {"dataset": F.col("dataset"), "index": F.col("grp") + 1, "source": F.col("source")}
    return prompt_tasks(
        groups, "quality_review", version, F.lit(system), fill(user, values), F.col("source"), True, ("grp", "targets")
    )


# --- responses -------------------------------------------------------------


def _as_number(v: Column) -> Column:
    """A number, or text that reads as one; a plain cast would take Java's
    suffixes and hexadecimal forms as well."""
    text = F.trim(F.try_variant_get(v, "$", "string"))
    plain = text.rlike(r"^[+-]?(\d+(_\d+)*\.?\d*|\.\d+)([eE][+-]?\d+)?$") | text.rlike("(?i)^[+-]?(inf|infinity|nan)$")
    return F.when(J.is_number(v) | (J.is_string(v) & plain), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def _clamped_score(v: Column) -> Column:
    number = F.when(J.is_number(v) | J.is_string(v), _as_number(v)).when(
        J.kind(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int").cast("double")
    )
    ok = number.isNotNull() & ~F.isnan(number)
    return F.when(ok, F.greatest(F.lit(0.0), F.least(F.lit(100.0), number)).cast("int")).otherwise(0)


def _is_infinite(v: Column) -> Column:
    return F.coalesce(F.abs(_as_number(v)) == float("inf"), F.lit(False))


def normalize_items(results: DataFrame) -> DataFrame:
    """Review items of model results, row by row per result.

    ``results(dataset, batch_id, task_id, status, result)`` gives the items as an
    array per task, so one bad item voids its whole task without a shuffle;
    ``void`` rows carry the reason and no item."""
    root = F.try_parse_json("result")
    listed = F.when(J.is_object(root), J.field(root, "items")).otherwise(root)

    def item(v: Column) -> Column:
        flags = J.field(v, "risk_flags")
        flag_list = F.when(J.is_array(flags), J.string_array(flags)).when(J.truthy(flags), F.array(J.py_str(flags)))
        return F.struct(
            T.strip(J.text_or(J.field(v, "target_type"))).alias("target_type"),
            T.strip(J.text_or(J.field(v, "target_id"))).alias("target_id"),
            F.lower(T.strip(J.text_or(J.field(v, "decision")))).alias("decision"),
            _clamped_score(J.field(v, "score")).alias("score"),
            T.strip(J.text_or(J.field(v, "reason"))).alias("reason"),
            T.strip(J.text_or(J.field(v, "suggested_fix"))).alias("suggested_fix"),
            F.filter(
                F.coalesce(flag_list, F.array().cast("array<string>")), lambda s: T.strip(s) != ""
            ).alias("risk_flags"),
            F.to_json(v).alias("raw"),
            J.is_object(v).alias("_object"),
            _is_infinite(J.field(v, "score")).alias("_inf"),
        )

    ok = F.forall(
        "items",
        lambda i: i["_object"]
        & (i["target_type"] != "")
        & (i["target_id"] != "")
        & i["decision"].isin(*DECISIONS)
        & ~i["_inf"],
    )
    usable = (F.col("status") == SUCCEEDED) & F.col("items").isNotNull() & ok
    return (
        results.withColumn("items", F.transform(J.elements(listed), item))
        .withColumn("void", ~F.coalesce(usable, F.lit(False)))
        .select("dataset", "batch_id", "task_id", "status", "error", "void", "items")
    )


def item_rows(normalized: DataFrame) -> DataFrame:
    return (
        normalized.where(~F.col("void"))
        .select("dataset", "batch_id", "task_id", F.posexplode("items").alias("pos", "i"))
        .select("dataset", "batch_id", "task_id", "pos", "i.*")
        .drop("_object", "_inf")
    )


def fill_failed_items(normalized: DataFrame, groups: DataFrame) -> DataFrame:
    """All items of a batch: the valid ones, and one failing item per target
    of each task without a valid response. ``groups`` is ``review_groups``."""
    failed = (
        normalized.where("void")
        .join(groups.select("task_id", "targets"), "task_id")
        .select(
            "dataset",
            "batch_id",
            "task_id",
            F.when(F.col("status") == SUCCEEDED, "Invalid review JSON")
            .otherwise(F.coalesce("error", F.concat(F.lit("LLM task status: "), "status")))
            .alias("reason"),
            F.posexplode("targets").alias("pos", "t"),
        )
        .select(
            "dataset",
            "batch_id",
            "task_id",
            "pos",
            "t.target_type",
            "t.target_id",
            F.lit("fail").alias("decision"),
            F.lit(0).alias("score"),
            "reason",
            F.lit(RETRY_HINT).alias("suggested_fix"),
            F.array(F.lit("schema_issue")).alias("risk_flags"),
            F.lit(None).cast("string").alias("raw"),
        )
    )
    return item_rows(normalized).unionByName(failed)


# --- batches ---------------------------------------------------------------


def latest_batch(batches: DataFrame) -> DataFrame:
    cols = [c for c in batches.columns if c != "dataset"]
    return (
        batches.groupBy("dataset")
        .agg(F.max_by(F.struct(*cols), F.struct("created_at", "batch_id")).alias("b"))
        .select("dataset", "b.*")
    )


def running_batch(batches: DataFrame) -> DataFrame:
    return latest_batch(batches.where(F.col("status") == "running"))


def batch_may_start(batches: DataFrame, datasets: DataFrame | None = None) -> DataFrame:
    """Whether a dataset may start a batch: it has none running. With
    ``datasets``, those that never had a batch may as well."""
    rows = batches.select("dataset", "status")
    if datasets is not None:
        rows = rows.unionByName(datasets.select("dataset", F.lit("").alias("status")))
    return rows.groupBy("dataset").agg((F.count_if(F.col("status") == "running") == 0).alias("may_start"))


def start_batches(batches: DataFrame, wanted: DataFrame) -> DataFrame:
    """The batch rows to append for ``wanted(dataset, batch_id, started_at, ...)``:
    those of datasets without a running batch, one per dataset, as running."""
    open_ = batch_may_start(batches, wanted).where("may_start").select("dataset")
    first = wanted.groupBy("dataset").agg(F.min("batch_id").alias("batch_id"))
    return wanted.join(first, ["dataset", "batch_id"], "left_semi").join(open_, "dataset", "left_semi").withColumn(
        "status", F.lit("running")
    )


def _of_batch(items: DataFrame, batches: DataFrame, batch_id: str | None) -> DataFrame:
    if batch_id is not None:
        return items.where(F.col("batch_id") == batch_id)
    return items.join(latest_batch(batches).select("dataset", "batch_id"), ["dataset", "batch_id"], "left_semi")


def batch_items(items: DataFrame, batches: DataFrame, decision: str | None = None, batch_id: str | None = None) -> DataFrame:
    """Items of a batch (default: the latest of each dataset), worst first."""
    rows = _of_batch(items, batches, batch_id)
    if decision:
        rows = rows.where(F.col("decision") == decision)
    severity = F.when(F.col("decision") == "fail", 0).when(F.col("decision") == "warn", 1).otherwise(2)
    return rows.withColumn("severity", severity).orderBy("dataset", "severity", "target_type", "target_id")


def batch_stats(items: DataFrame, batches: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Zero-filled pass / warn / fail counts of each dataset's batch."""
    rows = _of_batch(items, batches, batch_id)
    chosen = (
        batches.where(F.col("batch_id") == batch_id) if batch_id is not None else latest_batch(batches)
    ).select("dataset", "batch_id")
    counts = rows.groupBy("dataset", "batch_id").agg(
        *[F.count_if(F.col("decision") == d).alias(d) for d in ("pass", "warn", "fail")]
    )
    return chosen.join(counts, ["dataset", "batch_id"], "left").fillna(0, ["pass", "warn", "fail"])


def retry_failed_targets(targets: DataFrame, items: DataFrame, batches: DataFrame) -> DataFrame:
    """Targets whose id, of whatever type, failed in the latest batch."""
    failed = _of_batch(items, batches, None).where(F.col("decision") == "fail").select("dataset", "target_id")
    return targets.join(failed.distinct(), ["dataset", "target_id"], "left_semi")

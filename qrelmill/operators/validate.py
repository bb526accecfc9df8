"""Integrity checks over many dataset packages at once.

Every check returns rows of (dataset, section, pos, sub, code, message);
``validate_packages`` is their union. (section, pos, sub) is the reading order
inside a package, so no global sort is needed to report in order.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import written

# fixed values: threshold keys a package may declare
THRESHOLD_KEYS = ("hit_at_3", "hit_at_10", "mrr", "ndcg_at_10", "recall_at_100")

# fixed values: the codes and messages of findings throughout this module
OUT = ["dataset", "section", "pos", "sub", "code", "message"]
PACKAGE, ASSET, CHUNK, IMAGE, THRESHOLD, QUERY = range(6)


@dataclass(frozen=True)
class Package:
    """The tables of all packages. ``datasets`` carries the presence flags
    has_meta, has_queries, has_targets and has_corpus. ``checked`` tables hold only
    rows that are looked at (see ``_active``) and, for the corpus, the structure of
    the documents in place of their text (see ``stored_package``)."""

    datasets: DataFrame
    thresholds: DataFrame
    queries: DataFrame
    assets: DataFrame
    chunks: DataFrame
    corpus: DataFrame
    asset_files: DataFrame
    checked: bool = False


def with_query_kinds(queries: DataFrame) -> DataFrame:
    """Fill the kind columns of a typed query table that has only arrays."""

    def kind(col: str, empty: str) -> Column:
        c = F.col(col)
        return F.when(c.isNull(), "absent").when(F.size(c) == 0, empty).otherwise("list")

    out = queries
    for name, value in {
        "is_mapping": F.lit(True),
        "expect_any_kind": kind("expect_any", "absent"),
        "expect_asset_kind": kind("expect_asset_any", "bad"),
        "expect_chunk_kind": kind("expect_chunk_any", "bad"),
    }.items():
        if name not in out.columns:
            out = out.withColumn(name, value)
    return out


def with_chunk_kinds(chunks: DataFrame) -> DataFrame:
    out = chunks
    c = F.col("asset_ids")
    for name, value in {
        "is_mapping": F.lit(True),
        "asset_ids_kind": F.when(c.isNull(), "absent").when(F.size(c) == 0, "bad").otherwise("list"),
    }.items():
        if name not in out.columns:
            out = out.withColumn(name, value)
    return out


def _rows(df: DataFrame, section: int, pos: Column, sub: Column | int, code: str, message: Column) -> DataFrame:
    sub = F.lit(sub) if isinstance(sub, int) else sub
    return df.select(
        "dataset",
        F.lit(section).alias("section"),
        pos.cast("bigint").alias("pos"),
        sub.cast("bigint").alias("sub"),
        F.lit(code).alias("code"),
        message.alias("message"),
    )


def _exploded(df: DataFrame, section: int | Column, pos: Column, findings: list[tuple[Column, str, Column]]) -> DataFrame:
    """Several row-local findings per row in one pass over ``df``."""
    built = F.array_compact(
        F.array(
            *[
                F.when(
                    cond,
                    F.struct(
                        F.lit(i).cast("bigint").alias("sub"),
                        F.lit(code).alias("code"),
                        msg.alias("message"),
                    ),
                )
                for i, (cond, code, msg) in enumerate(findings)
            ]
        )
    )
    section = section if isinstance(section, Column) else F.lit(section)
    return df.select(
        "dataset", section.alias("section"), pos.cast("bigint").alias("pos"), F.explode(built).alias("f")
    ).select("dataset", "section", "pos", "f.sub", "f.code", "f.message")


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def _numbered(label: str, rest: str, *args: Column) -> Column:
    return F.format_string(f"{label} #%d {rest}", F.col("pos"), *args)


def _shown(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit("None"))


def _active(df: DataFrame, pkg: Package, flag: str | None = None) -> DataFrame:
    """Rows of packages that have a corpus folder (and the given manifest):
    without a corpus folder checking stops after the presence checks."""
    if pkg.checked:
        return df
    keep = F.col("has_corpus")
    if flag:
        keep = keep & F.col(flag)
    return df.join(pkg.datasets.where(keep).select("dataset"), "dataset", "left_semi")


# --- package level ---------------------------------------------------------

# table of a package -> flag it needs, section and finding when it is empty
_LISTS = {
    "corpus": (None, PACKAGE, "empty_corpus", "corpus/ has no markdown files"),
    "assets": ("has_targets", ASSET, "no_assets", "targets.yaml must contain non-empty assets list"),
    "chunks": ("has_targets", CHUNK, "no_chunks", "targets.yaml must contain non-empty chunks list"),
    "queries": ("has_queries", QUERY, "no_queries", "queries.yaml must contain non-empty queries list"),
}


def check_presence(pkg: Package) -> DataFrame:
    return _exploded(
        pkg.datasets,
        PACKAGE,
        F.lit(0),
        [
            (~F.col("has_meta"), "missing_meta", F.lit("missing dataset.yaml")),
            (~F.col("has_queries"), "missing_queries", F.lit("missing queries.yaml")),
            (~F.col("has_corpus"), "missing_corpus", F.lit("missing corpus/")),
        ],
    )


def check_lists(pkg: Package, tables: tuple[str, ...] = tuple(_LISTS)) -> DataFrame:
    """Packages whose tables are empty. Each table is reduced to its dataset
    names before the join, so a large package is no hot key."""
    filled = None
    for name in tables:
        part = getattr(pkg, name).select("dataset").distinct().withColumn("filled", F.lit(name))
        filled = part if filled is None else filled.unionByName(part)
    filled = filled.groupBy("dataset").agg(F.collect_set("filled").alias("filled"))
    empty = pkg.datasets.where("has_corpus").join(filled, "dataset", "left")
    found = []
    for name in tables:
        flag, section, code, message = _LISTS[name]
        lacks = ~F.coalesce(F.array_contains("filled", name), F.lit(False))
        found.append(
            F.when(
                lacks & F.col(flag) if flag else lacks,
                F.struct(F.lit(section).alias("section"), F.lit(code).alias("code"), F.lit(message).alias("message")),
            )
        )
    return empty.select("dataset", F.explode(F.array_compact(F.array(*found))).alias("f")).select(
        "dataset",
        "f.section",
        F.lit(0).cast("bigint").alias("pos"),
        F.lit(5).cast("bigint").alias("sub"),
        "f.code",
        "f.message",
    )


def check_empty_corpus(pkg: Package) -> DataFrame:
    return check_lists(pkg, ("corpus",))


def check_target_lists(pkg: Package) -> DataFrame:
    return check_lists(pkg, ("assets", "chunks"))


# --- structure and targets -------------------------------------------------

HEADING, ANCHOR = "## ", "Target: "


def structure(corpus: DataFrame, longest: int) -> DataFrame:
    """dataset, stem, file_name, heads, anchors, images of each document in one pass
    over its text: up to ``longest`` characters behind every heading and target mark, and
    the paths of its images. That is all the checks ask of a text."""

    def behind(mark: str) -> Column:
        # A look-ahead finds marks inside what stands behind an earlier one, too.
        return F.array_distinct(F.regexp_extract_all("text", F.lit(rf"(?={mark}([\s\S]{{0,{longest}}}))"), F.lit(1)))

    images = F.transform(T.image_refs(F.col("text")), lambda r: T.strip(r["path"]))
    name = F.col("file_name") if "file_name" in corpus.columns else F.concat("stem", F.lit(".md"))
    return corpus.select(
        "dataset", "stem", name.alias("file_name"), behind(HEADING).alias("heads"), behind(ANCHOR).alias("anchors"), images.alias("images")
    )


TARGET_COLUMNS = ("section", "dataset", "pos", "is_mapping", "id", "doc", "path", "heading", "anchor", "asset_id", "asset_ids", "asset_ids_kind")


def target_rows(pkg: Package, sections: tuple[int, ...] = (ASSET, CHUNK)) -> DataFrame:
    """Asset and chunk rows of checked packages as one table."""
    out = None
    for section, rows in ((ASSET, pkg.assets), (CHUNK, pkg.chunks)):
        if section not in sections:
            continue
        part = _active(rows, pkg, "has_targets").withColumn("section", F.lit(section))
        kinds = {"asset_ids": "array<string>"}
        part = part.select(*(F.col(c) if c in part.columns else F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in TARGET_COLUMNS))
        out = part if out is None else out.unionByName(part)
    return out


def _longest(targets: DataFrame) -> int:
    most = F.greatest(F.length("heading"), F.length("anchor"), F.lit(0))
    return targets.agg(F.max(most)).first()[0] or 0


def with_text_flags(targets: DataFrame, documents: DataFrame) -> DataFrame:
    """Target rows plus found_doc, found_heading and found_anchor, from the
    ``documents`` of ``structure``: texts neither move nor are read again."""

    def begins(parts: str, needle: str) -> Column:
        return F.exists(parts, lambda x: F.startswith(x, F.coalesce(F.col(needle), F.lit(""))))

    hits = (
        targets.where("is_mapping")
        .select("section", "dataset", "pos", "doc", "heading", "anchor")
        .join(documents.select("dataset", F.col("stem").alias("doc"), "heads", "anchors"), ["dataset", "doc"])
        .groupBy("section", "dataset", "pos")
        .agg(
            F.bool_or(begins("heads", "heading")).alias("found_heading"),
            F.bool_or(begins("anchors", "anchor")).alias("found_anchor"),
            F.lit(True).alias("found_doc"),
        )
    )
    out = targets.join(hits, ["section", "dataset", "pos"], "left")
    return out.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in ("found_doc", "found_heading", "found_anchor")})


def flagged_targets(pkg: Package, sections: tuple[int, ...] = (ASSET, CHUNK)) -> DataFrame:
    targets = target_rows(pkg, sections)
    return with_text_flags(targets, pkg.corpus if pkg.checked else structure(pkg.corpus, _longest(targets)))


def stored_package(pkg: Package) -> Package:
    """The package tables as the checks read them, each written once: rows that are looked
    at, and the structure of documents. The corpus text is read here and nowhere else."""
    datasets = written(pkg.datasets, "package-datasets")
    pkg = replace(pkg, datasets=datasets)
    assets = written(_active(pkg.assets, pkg, "has_targets"), "package-assets")
    chunks = written(_active(pkg.chunks, pkg, "has_targets"), "package-chunks")
    narrow = replace(pkg, assets=assets, chunks=chunks, checked=True)
    documents = structure(_active(pkg.corpus, pkg), _longest(target_rows(narrow)))
    return replace(
        narrow,
        corpus=written(documents, "package-structure"),
        queries=written(_active(pkg.queries, pkg, "has_queries"), "package-queries"),
        thresholds=_active(pkg.thresholds, pkg, "has_meta"),
    )


def check_targets(
    pkg: Package,
    sections: tuple[int, ...] = (ASSET, CHUNK),
    fields: bool = True,
    documents: bool = True,
    targets: DataFrame | None = None,
) -> DataFrame:
    """Asset and chunk rows in one pass over them; ``targets`` are ``flagged_targets`` where
    they are known already.

    ``fields``: shape of the rows. ``documents``: missing document (which ends
    the checks of a chunk), heading or anchor absent from the text (as
    substrings), and the shape of a chunk's asset reference."""
    if targets is None:
        targets = flagged_targets(pkg, sections) if documents else target_rows(pkg, sections)
    chunk, asset = F.col("section") == CHUNK, F.col("section") == ASSET
    label = F.when(chunk, "chunk").otherwise("asset")

    def message(rest: str, *args: Column) -> Column:
        return F.format_string(f"%s target #%d {rest}", label, F.col("pos"), *args)

    ok = F.col("is_mapping")
    findings = []
    if fields:
        findings += [
            (~ok, "not_mapping", message("must be a mapping")),
            (ok & _blank("id"), "empty_id", message("has empty id")),
            (asset & ok & _blank("path"), "empty_path", message("has empty path")),
            (asset & ok & _blank("heading"), "empty_heading", message("has empty heading")),
        ]
    if documents:
        found = ok & F.col("found_doc")
        one, many = ~_blank("asset_id"), F.col("asset_ids_kind") == "list"
        findings += [
            (ok & ~F.col("found_doc"), "missing_doc", message("references missing doc: %s", _shown("doc"))),
            (chunk & found & _blank("heading"), "empty_heading", message("has empty heading")),
            (
                found & ~_blank("heading") & ~F.col("found_heading"),
                "heading_not_found",
                message("heading not found in %s.md: %s", F.col("doc"), F.col("heading")),
            ),
            (chunk & found & _blank("anchor"), "empty_anchor", message("has empty anchor")),
            (
                chunk & found & ~_blank("anchor") & ~F.col("found_anchor"),
                "anchor_not_found",
                message("anchor not found in %s.md: %s", F.col("doc"), F.col("anchor")),
            ),
            (chunk & found & one & many, "both_asset_fields", message("must not set both asset_id and asset_ids")),
            (
                chunk & found & ~one & (F.col("asset_ids_kind") == "bad"),
                "asset_ids_not_list",
                message("asset_ids must be a non-empty list"),
            ),
            (
                chunk & found & ~one & (F.col("asset_ids_kind") == "absent"),
                "empty_asset_id",
                message("has empty asset_id"),
            ),
        ]
    return _exploded(targets, F.col("section"), F.col("pos"), findings).withColumn(
        "code", F.concat(F.when(F.col("section") == CHUNK, "chunk_").otherwise("asset_"), "code")
    )


def check_asset_fields(pkg: Package) -> DataFrame:
    return check_targets(pkg, (ASSET,), documents=False)


def check_chunk_fields(pkg: Package) -> DataFrame:
    return check_targets(pkg, (CHUNK,), documents=False)


def check_asset_documents(pkg: Package) -> DataFrame:
    return check_targets(pkg, (ASSET,), fields=False)


def check_chunk_documents(pkg: Package) -> DataFrame:
    return check_targets(pkg, (CHUNK,), fields=False)


# --- names -----------------------------------------------------------------

STEM, ASSET_ID, CHUNK_ID, FILE = "stem", "asset target", "chunk target", "file"
REFERENCE = ["dataset", "section", "pos", "sub", "what", "item", "shown", "label"]


def _valid_ids(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_mapping") & ~_blank("id")).select("dataset", F.col("id").alias("item"))


def known_names(pkg: Package, kinds: tuple[str, ...]) -> DataFrame:
    """dataset, what, item: every name of the ``kinds`` that something may refer to, once."""
    tables = {
        STEM: lambda: pkg.corpus.select("dataset", F.col("stem").alias("item")),
        ASSET_ID: lambda: _valid_ids(pkg.assets),
        CHUNK_ID: lambda: _valid_ids(pkg.chunks),
        FILE: lambda: pkg.asset_files.select("dataset", T.normalize_path(F.col("path")).alias("item")),
    }
    out = None
    for what in kinds:
        part = tables[what]().select("dataset", F.lit(what).alias("what"), "item")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def _reference(df: DataFrame, section: int, pos: Column, sub: Column, what: Column | str, item: Column, shown: Column, label: Column) -> DataFrame:
    what = F.lit(what) if isinstance(what, str) else what
    columns = (F.col("dataset"), F.lit(section), pos.cast("bigint"), sub.cast("bigint"), what, item, shown, label)
    return df.select(*(c.alias(n) for c, n in zip(columns, REFERENCE, strict=True)))


def _file_references(pkg: Package, targets: DataFrame | None) -> DataFrame:
    rows = target_rows(pkg, (ASSET,)) if targets is None else targets.where(F.col("section") == ASSET)
    path = F.col("path")
    rows = rows.where(F.col("is_mapping") & ~_blank("path"))
    return _reference(rows, ASSET, F.col("pos"), F.lit(2), FILE, T.normalize_path(path), path, F.lit(None).cast("string"))


def _image_references(pkg: Package, targets: DataFrame | None) -> DataFrame:
    """A remote image has no local name, so that no file is found for it."""
    documents = pkg.corpus if pkg.checked else structure(_active(pkg.corpus, pkg), 0)
    rows = documents.select("dataset", "file_name", F.posexplode("images").alias("sub", "path"))
    path = F.col("path")
    far = path.startswith("http://") | path.startswith("https://")
    return _reference(rows, IMAGE, F.lit(0), F.col("sub"), FILE, F.when(~far, T.normalize_path(path)), path, F.col("file_name"))


def _chunk_references(pkg: Package, targets: DataFrame | None) -> DataFrame:
    """Asset references of chunks whose document exists. A package without any valid
    asset id has only its empty references reported."""
    one, many = ~_blank("asset_id"), F.col("asset_ids_kind") == "list"
    if targets is None:
        docs = pkg.corpus.select("dataset", F.col("stem").alias("doc"))
        targets = target_rows(pkg, (CHUNK,)).join(docs, ["dataset", "doc"], "left_semi").withColumn("found_doc", F.lit(True))
    rows = targets.where((F.col("section") == CHUNK) & F.col("is_mapping") & F.col("found_doc") & (one != many))
    any_known = _valid_ids(_active(pkg.assets, pkg, "has_targets")).select("dataset", F.lit(True).alias("any_known")).distinct()
    listed = F.posexplode(F.when(one, F.array("asset_id")).otherwise(F.col("asset_ids"))).alias("sub", "item")
    rows = rows.select("dataset", "pos", listed).join(any_known, "dataset", "left")
    rows = rows.where(_blank("item") | F.col("any_known"))
    item = F.when(~_blank("item"), F.col("item"))
    return _reference(rows, CHUNK, F.col("pos"), F.col("sub") + 10, ASSET_ID, item, item, F.lit(None).cast("string"))


def _query_references(pkg: Package, targets: DataFrame | None) -> DataFrame:
    """Expected documents, assets and chunks; the three arrays are exploded in one pass."""
    queries = _active(pkg.queries, pkg, "has_queries").where("is_mapping")

    def refs(what: str, col: str, kind: str, base: int) -> Column:
        return F.transform(
            F.when(F.col(kind) == "list", F.col(col)).otherwise(F.array().cast("array<string>")),
            lambda x, i: F.struct(F.lit(what).alias("what"), (i + base).cast("bigint").alias("sub"), x.alias("item")),
        )

    several = F.concat(
        refs(STEM, "expect_any", "expect_any_kind", 100),
        refs(ASSET_ID, "expect_asset_any", "expect_asset_kind", 10**6),
        refs(CHUNK_ID, "expect_chunk_any", "expect_chunk_kind", 2 * 10**6),
    )
    flags = pkg.datasets.select("dataset", "has_targets")
    rows = queries.select("dataset", "pos", F.explode(several).alias("r")).select("dataset", "pos", "r.*").join(flags, "dataset")
    rows = rows.where((F.col("what") == STEM) | F.col("has_targets"))
    return _reference(rows, QUERY, F.col("pos"), F.col("sub"), F.col("what"), F.col("item"), _shown("item"), F.lit(None).cast("string"))


#: What refers to something, and the kinds of names it refers to.
REFERENCES = {
    "files": (_file_references, (FILE,)),
    "images": (_image_references, (FILE,)),
    "chunks": (_chunk_references, (ASSET_ID,)),
    "queries": (_query_references, (STEM, ASSET_ID, CHUNK_ID)),
}


def check_references(pkg: Package, parts: tuple[str, ...] = tuple(REFERENCES), targets: DataFrame | None = None) -> DataFrame:
    """References to documents, targets and files that do not exist: all of them as one
    long table meet one table of names."""
    refs, kinds = None, []
    for part in parts:
        make, names = REFERENCES[part]
        rows = make(pkg, targets)
        refs = rows if refs is None else refs.unionByName(rows)
        kinds += [k for k in names if k not in kinds]
    lost = refs.join(known_names(pkg, tuple(kinds)), ["dataset", "what", "item"], "left_anti")
    section, shown, pos = F.col("section"), F.col("shown"), F.col("pos")
    far = shown.startswith("http://") | shown.startswith("https://")
    code = (
        F.when(section == ASSET, "asset_missing_file")
        .when(section == CHUNK, F.when(shown.isNull(), "chunk_empty_asset_ref").otherwise("chunk_missing_asset"))
        .when(section == IMAGE, F.when(far, "image_remote").otherwise("image_missing"))
        .otherwise(F.concat(F.lit("query_missing_"), F.substring_index("what", " ", 1)))
    )
    message = (
        F.when(section == ASSET, _numbered("asset target", "references missing file: %s", shown))
        .when((section == CHUNK) & shown.isNull(), _numbered("chunk target", "asset_ids contains empty id"))
        .when(section == CHUNK, _numbered("chunk target", "references missing asset target: %s", shown))
        .when(section == IMAGE, F.concat("label", F.when(far, " uses remote image reference: ").otherwise(" references missing image: "), "shown"))
        .otherwise(_numbered("query", "references missing %s: %s", F.col("what"), shown))
    )
    return lost.select("dataset", "section", pos, "sub", code.alias("code"), message.alias("message"))


def check_asset_files(pkg: Package) -> DataFrame:
    return check_references(pkg, ("files",))


def check_chunk_assets(pkg: Package) -> DataFrame:
    return check_references(pkg, ("chunks",))


def check_images(pkg: Package) -> DataFrame:
    return check_references(pkg, ("images",))


def check_query_references(pkg: Package) -> DataFrame:
    return check_references(pkg, ("queries",))


# --- thresholds ------------------------------------------------------------


def check_thresholds(pkg: Package) -> DataFrame:
    return _exploded(
        _active(pkg.thresholds, pkg, "has_meta"),
        THRESHOLD,
        F.col("pos"),
        [
            (
                ~F.col("key").isin(*THRESHOLD_KEYS),
                "threshold_unknown",
                F.concat(F.lit("unknown threshold key: "), "key"),
            ),
            (
                ~F.col("numeric"),
                "threshold_not_numeric",
                F.concat(F.lit("threshold "), "key", F.lit(" must be numeric")),
            ),
        ],
    )


# --- queries ---------------------------------------------------------------


def check_query_fields(pkg: Package, lists: bool = True) -> DataFrame:
    """Row-local query checks, with ``lists`` also packages without any query."""
    ok = F.col("is_mapping")
    has_any = F.col("expect_any_kind") != "absent"
    has_none = F.coalesce("expect_none", F.lit(False))
    fields = _exploded(
        _active(pkg.queries, pkg, "has_queries"),
        QUERY,
        F.col("pos"),
        [
            (~ok, "query_not_mapping", _numbered("query", "must be a mapping")),
            (ok & T.is_blank(F.col("id")), "query_empty_id", _numbered("query", "has empty id")),
            (ok & T.is_blank(F.col("q")), "query_empty_q", _numbered("query", "has empty q")),
            (ok & has_any & has_none, "query_both", _numbered("query", "has both expect_any and expect_none")),
            (ok & ~has_any & ~has_none, "query_neither", _numbered("query", "must set expect_any or expect_none")),
            (
                ok & (F.col("expect_any_kind") == "other"),
                "query_expect_not_list",
                _numbered("query", "expect_any must be a list"),
            ),
            (
                ok & (F.col("expect_asset_kind") == "bad"),
                "query_asset_not_list",
                _numbered("query", "expect_asset_any must be a non-empty list"),
            ),
            (
                ok & (F.col("expect_chunk_kind") == "bad"),
                "query_chunk_not_list",
                _numbered("query", "expect_chunk_any must be a non-empty list"),
            ),
        ],
    )
    return fields.unionByName(check_lists(pkg, ("queries",))) if lists else fields


def check_query_duplicates(pkg: Package) -> DataFrame:
    """Every occurrence after the first of an id, and of a text.

    Ids and texts are one long table. The first position per value is a map-side
    combined minimum and the join back lets adaptive execution split a hot
    value, so a third of all rows may share one text."""
    queries = _active(pkg.queries, pkg, "has_queries").where("is_mapping")
    given = lambda c, sub: F.when(~T.is_blank(F.col(c)), F.struct(F.lit(sub).alias("sub"), F.col(c).alias("value")))
    both = F.explode(F.array_compact(F.array(given("id", 1), given("q", 2)))).alias("v")
    rows = queries.select("dataset", "pos", both).select("dataset", "pos", "v.*")
    first = (
        rows.groupBy("dataset", "sub", "value")
        .agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    again = rows.join(first, ["dataset", "sub", "value"]).where("pos > first_pos")
    is_id = F.col("sub") == 1
    return again.select(
        "dataset",
        F.lit(QUERY).alias("section"),
        F.col("pos").cast("bigint").alias("pos"),
        F.col("sub").cast("bigint").alias("sub"),
        F.when(is_id, "query_duplicate_id").otherwise("query_duplicate_text").alias("code"),
        F.concat(F.when(is_id, "duplicate query id: ").otherwise("duplicate query text: "), "value").alias("message"),
    )


CHECKS = {
    "presence": check_presence,
    "empty_corpus": check_empty_corpus,
    "target_lists": check_target_lists,
    "asset_fields": check_asset_fields,
    "asset_documents": check_asset_documents,
    "asset_files": check_asset_files,
    "chunk_fields": check_chunk_fields,
    "chunk_documents": check_chunk_documents,
    "chunk_assets": check_chunk_assets,
    "images": check_images,
    "thresholds": check_thresholds,
    "query_fields": check_query_fields,
    "query_duplicates": check_query_duplicates,
    "query_references": check_query_references,
}


def validate_packages(pkg: Package) -> DataFrame:
    """All checks, over tables that are written once (``stored_package``)."""
    pkg = stored_package(pkg)
    targets = written(flagged_targets(pkg), "package-targets")
    parts = [
        check_presence(pkg),
        check_lists(pkg),
        check_targets(pkg, targets=targets),
        check_references(pkg, targets=targets),
        check_thresholds(pkg),
        check_query_fields(pkg, lists=False),
        check_query_duplicates(pkg),
    ]
    out = parts[0].select(*OUT)
    for part in parts[1:]:
        out = out.unionByName(part.select(*OUT))
    return out


def package_verdict(pkg: Package, violations: DataFrame | None = None) -> DataFrame:
    """Violation count per package; a package is valid when it has none."""
    found = validate_packages(pkg) if violations is None else violations
    counts = found.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_violations"))
    return (
        pkg.datasets.select("dataset")
        .join(counts, "dataset", "left")
        .withColumn("n_violations", F.coalesce("n_violations", F.lit(0)))
        .withColumn("valid", F.col("n_violations") == 0)
    )


def coverage_balance(corpus: DataFrame, queries: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Acceptance rule of a bilingual package: every document is expected by a
    positive query, and zh and en queries are balanced."""
    gold = (
        queries.where(~F.coalesce("expect_none", F.lit(False)))
        .select("dataset", F.explode("expect_any").alias("stem"))
        .distinct()
    )
    uncovered = (
        corpus.select("dataset", "stem")
        .join(gold, ["dataset", "stem"], "left_anti")
        .groupBy("dataset")
        .agg(F.count(F.lit(1)).alias("uncovered"))
    )
    per_lang = queries.groupBy("dataset").agg(
        F.count_if(F.col("id").startswith("zh-")).alias("n_zh"),
        F.count_if(F.col("id").startswith("en-")).alias("n_en"),
    )
    out = (
        corpus.select("dataset").distinct()
        .join(uncovered, "dataset", "left")
        .join(per_lang, "dataset", "left")
        .fillna(0, ["uncovered", "n_zh", "n_en"])
    )
    gap = F.abs(F.col("n_zh") - F.col("n_en"))
    balanced = gap <= F.lit(tolerance) * (F.col("n_zh") + F.col("n_en"))
    return out.withColumn("balanced", balanced).withColumn(
        "accepted", (F.col("uncovered") == 0) & F.col("balanced")
    )

"""Corpora, package manifests, evaluation reports and task logs as DataFrames."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsontext as J
from ..functions import text as T
from ..operators.validate import Package
from ..schemas import AUDIT_EVENTS

EMPTY = "cast(array() as array<string>)"


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _whole_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return (
        spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
        .select(_decoded(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("text"))
    )


def below(path: Column, root: str) -> Column:
    """The part of a file's path below ``root``, with a leading slash. The root
    may be given with or without scheme and may hold any folder names."""
    plain = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    bare = F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    return F.when(bare.startswith(plain + "/"), F.substr(bare, F.lit(len(plain) + 1))).otherwise(bare)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths and sizes below ``root``; file contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    )


def scan_corpus(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    """Markdown documents ``<root>/<dataset>/corpus/*.md`` as (dataset, stem,
    file_name, text). With ``recursive`` also nested ones and HTML, as prompt
    packs use them. Malformed UTF-8 becomes U+FFFD."""
    if recursive:
        files, inner = _whole_files(spark, root, "*.{md,html,htm,MD,HTML,HTM}"), r".+"
    else:
        files, inner = _whole_files(spark, root, "*.md"), r"[^/]+"
    pattern = rf"/([^/]+)/corpus/({inner})$"
    rel = F.regexp_extract("path", pattern, 2)
    name = F.element_at(F.split(rel, "/"), -1)
    return files.where(F.col("path").rlike(pattern)).select(
        F.regexp_extract("path", pattern, 1).alias("dataset"),
        T.stem(name).alias("stem"),
        name.alias("file_name"),
        *([rel.alias("rel_path")] if recursive else []),
        "text",
    )


def discover_datasets(files: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Datasets with a ``dataset.yaml`` in a file listing, sorted; with
    ``names`` only those, given as names or paths."""
    pattern = r"/([^/]+)/dataset\.yaml$"
    found = files.where(F.col("path").rlike(pattern)).select(F.regexp_extract("path", pattern, 1).alias("dataset"))
    if names:
        found = found.where(F.col("dataset").isin(*[n.rstrip("/").rsplit("/", 1)[-1] for n in names]))
    return found.distinct().orderBy("dataset")


# --- manifests -------------------------------------------------------------


def _yaml_to_json(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml

    def convert(text: str) -> str:
        try:
            value = yaml.safe_load(text)
        except yaml.YAMLError:
            value = None
        return json.dumps(value if isinstance(value, dict) else {}, ensure_ascii=False, default=str)

    for batch in batches:
        yield pd.DataFrame({"dataset": batch["dataset"], "manifest": batch["manifest"], "json": batch["text"].map(convert)})


def scan_manifests(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, manifest, json) of every dataset.yaml, queries.yaml and
    targets.yaml. YAML parsing is the only Python stage; a file that is not a
    mapping counts as empty."""
    pattern = r"/([^/]+)/(dataset|queries|targets)\.yaml$"
    files = (
        _whole_files(spark, root, "{dataset,queries,targets}.yaml")
        .where(~F.contains(below(F.col("path"), root), F.lit("/corpus/")))
        .select(
            F.regexp_extract("path", pattern, 1).alias("dataset"),
            F.regexp_extract("path", pattern, 2).alias("manifest"),
            "text",
        )
    )
    return files.mapInPandas(_yaml_to_json, "dataset string, manifest string, json string")


def _text(v: Column, name: str) -> Column:
    return J.as_string(J.field(v, name))


def _rows(manifests: DataFrame, manifest: str, field: str) -> DataFrame:
    listed = J.elements(J.field(F.try_parse_json("json"), field))
    return manifests.where(F.col("manifest") == manifest).select(
        "dataset", F.posexplode(listed).alias("i", "v")
    ).select("dataset", (F.col("i") + 1).alias("pos"), "v")


def _strings(v: Column) -> Column:
    """Array elements as text; an element that is not a string becomes its
    printed form, an empty list stays empty."""
    return J.string_array(v)


def queries_from(manifests: DataFrame) -> DataFrame:
    v = F.col("v")
    any_, asset, chunk = (J.field(v, k) for k in ("expect_any", "expect_asset_any", "expect_chunk_any"))

    def target_kind(x: Column) -> Column:
        null = x.isNull() | F.is_variant_null(x)
        return F.when(null, "absent").when(J.is_array(x) & (F.size(J.elements(x)) > 0), "list").otherwise("bad")

    return _rows(manifests, "queries", "queries").select(
        "dataset",
        "pos",
        J.is_object(v).alias("is_mapping"),
        _text(v, "id").alias("id"),
        _text(v, "q").alias("q"),
        _text(v, "query_type").alias("query_type"),
        _strings(any_).alias("expect_any"),
        F.when(~J.truthy(any_), "absent").when(J.is_array(any_), "list").otherwise("other").alias("expect_any_kind"),
        J.truthy(J.field(v, "expect_none")).alias("expect_none"),
        _strings(asset).alias("expect_asset_any"),
        target_kind(asset).alias("expect_asset_kind"),
        _strings(chunk).alias("expect_chunk_any"),
        target_kind(chunk).alias("expect_chunk_kind"),
    )


def assets_from(manifests: DataFrame) -> DataFrame:
    v = F.col("v")
    return _rows(manifests, "targets", "assets").select(
        "dataset",
        "pos",
        J.is_object(v).alias("is_mapping"),
        *[_text(v, k).alias(k) for k in ("id", "doc", "path", "heading", "anchor")],
    )


def chunks_from(manifests: DataFrame) -> DataFrame:
    v = F.col("v")
    ids = J.field(v, "asset_ids")
    null = ids.isNull() | F.is_variant_null(ids)
    kind = F.when(null, "absent").when(J.is_array(ids) & (F.size(J.elements(ids)) > 0), "list").otherwise("bad")
    return _rows(manifests, "targets", "chunks").select(
        "dataset",
        "pos",
        J.is_object(v).alias("is_mapping"),
        *[_text(v, k).alias(k) for k in ("id", "doc", "heading", "anchor", "asset_id")],
        F.transform(J.elements(ids), J.as_string).alias("asset_ids"),
        kind.alias("asset_ids_kind"),
    )


def thresholds_from(manifests: DataFrame) -> DataFrame:
    """Declared thresholds. A boolean counts as numeric, as in Python."""
    declared = J.field(F.try_parse_json("json"), "thresholds")
    entries = F.map_entries(F.try_variant_get(declared, "$", "map<string,variant>"))
    e = F.col("e")
    number = F.coalesce(
        J.as_number(e["value"]),
        F.when(J.kind(e["value"]) == "BOOLEAN", F.try_variant_get(e["value"], "$", "boolean").cast("int").cast("double")),
    )
    return (
        manifests.where("manifest = 'dataset'")
        .select("dataset", F.posexplode(F.when(J.is_object(declared), entries)).alias("pos", "e"))
        .select(
            "dataset", "pos", e["key"].alias("key"), number.alias("value"), number.isNotNull().alias("numeric")
        )
    )


def package_flags(files: DataFrame, manifests: DataFrame) -> DataFrame:
    """One row per dataset folder with its description and presence flags."""
    pattern = r"/([^/]+)/(dataset\.yaml|queries\.yaml|targets\.yaml|corpus/.+)$"
    part = F.substring_index(F.regexp_extract("path", pattern, 2), "/", 1)
    flags = (
        files.where(F.col("path").rlike(pattern))
        .select(F.regexp_extract("path", pattern, 1).alias("dataset"), part.alias("part"))
        .groupBy("dataset")
        .agg(
            F.bool_or(F.col("part") == "dataset.yaml").alias("has_meta"),
            F.bool_or(F.col("part") == "queries.yaml").alias("has_queries"),
            F.bool_or(F.col("part") == "targets.yaml").alias("has_targets"),
            F.bool_or(F.col("part") == "corpus").alias("has_corpus"),
        )
    )
    described = manifests.where("manifest = 'dataset'").select(
        "dataset", _text(F.try_parse_json("json"), "description").alias("description")
    )
    return flags.join(described, "dataset", "left")


def load_packages(spark: SparkSession, root: str) -> Package:
    """All packages below ``root`` as tables. A corpus folder without any file
    cannot be told from a missing one in a file listing."""
    files = list_files(spark, root)
    manifests = scan_manifests(spark, root)
    inner = r"^/([^/]+)/corpus/(.+)$"
    inside = files.withColumn("path", below(F.col("path"), root))
    asset_files = inside.where(F.col("path").rlike(inner)).select(
        F.regexp_extract("path", inner, 1).alias("dataset"),
        F.regexp_extract("path", inner, 2).alias("path"),
        "length",
    )
    return Package(
        datasets=package_flags(files, manifests),
        thresholds=thresholds_from(manifests),
        queries=queries_from(manifests),
        assets=assets_from(manifests),
        chunks=chunks_from(manifests),
        corpus=scan_corpus(spark, root),
        asset_files=asset_files,
    )


# --- line files ------------------------------------------------------------


def _lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Text lines with a sortable ``line_no`` (block start, order inside), so a
    large file is read by many tasks and still keeps its order."""
    return spark.read.text(path, recursiveFileLookup=True, pathGlobFilter=glob).select(
        _decoded(F.col("_metadata.file_path")).alias("path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        ).alias("line_no"),
        "value",
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Parsed JSON lines; blank and malformed ones drop out."""
    return lines.withColumn("v", F.try_parse_json("value")).where("v is not null").drop("value")


def scan_eval_stream(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation output lines as (run_id, line_no, v); the run is the file stem."""
    name = F.element_at(F.split("path", "/"), -1)
    return parse_lines(_lines(spark, path).select(T.stem(name).alias("run_id"), "line_no", "value"))


def select_report(lines: DataFrame, rule: str = "last") -> DataFrame:
    """One report line per run.

    ``last``: the last line with metrics and a pass flag or thresholds.
    ``longest``: the line with the longest per_query list, the last on a tie.
    ``longest_metrics``: the same among lines with metrics, where a line without
    a list counts as length 0."""
    v = F.col("v")
    listed = J.field(v, "per_query")
    length = F.when(J.is_array(listed), F.size(J.elements(listed)))
    has_metrics = J.is_object(v) & J.has_field(v, "metrics")
    if rule == "last":
        keep = has_metrics & (J.has_field(v, "passed") | J.has_field(v, "thresholds"))
        order = F.struct(F.lit(0).alias("n"), "line_no")
    elif rule == "longest":
        keep, order = length.isNotNull(), F.struct(length.alias("n"), "line_no")
    elif rule == "longest_metrics":
        keep, order = has_metrics, F.struct(F.coalesce(length, F.lit(0)).alias("n"), "line_no")
    else:
        raise ValueError(f"unknown rule: {rule}")
    chosen = lines.where(keep).groupBy("run_id").agg(
        F.max_by(F.to_json(v), order).alias("json"), F.max(order).alias("o")
    )
    return chosen.select("run_id", F.col("o.line_no").alias("line_no"), F.parse_json("json").alias("v"))


def explode_report(report: DataFrame, field: str = "per_query") -> DataFrame:
    """Rows of a report list: per_query or negative_diagnostics."""
    row = F.col("raw")
    return report.select("run_id", F.posexplode(J.elements(J.field(F.col("v"), field))).alias("pos", "raw")).select(
        "run_id",
        "pos",
        _text(row, "id").alias("id"),
        _text(row, "q").alias("q"),
        F.coalesce(J.string_array(J.field(row, "expect_any")), F.expr(EMPTY)).alias("expect_any"),
        F.coalesce(J.string_array(J.field(row, "ranked")), F.expr(EMPTY)).alias("ranked"),
        "raw",
    )


def report_metrics(report: DataFrame) -> DataFrame:
    """The metric map of a report as (run_id, metric, value) rows."""
    entries = F.map_entries(F.try_variant_get("v", "$.metrics", "map<string,variant>"))
    return report.select("run_id", F.explode(entries).alias("e")).select(
        "run_id", F.col("e.key").alias("metric"), J.as_number(F.col("e.value")).alias("value")
    ).where("value is not null")


def scan_candidates(spark: SparkSession, root: str, log: str | None = None) -> DataFrame:
    """Candidate lines per dataset: of ``<dataset>/candidates.jsonl`` where that
    file exists, else of the audit log ``<dataset>/<dataset>.jsonl`` and, with
    ``log``, of the task log that ``append_task_log`` wrote there."""
    pattern = r"/([^/]+)/([^/]+)\.jsonl$"
    lines = _lines(spark, root, "*.jsonl").select(
        F.regexp_extract("path", pattern, 1).alias("dataset"),
        F.regexp_extract("path", pattern, 2).alias("file"),
        "line_no",
        "value",
    )
    direct = F.col("file") == "candidates"
    lines = lines.where(direct | (F.col("file") == F.col("dataset"))).withColumn(
        "source", F.when(direct, "direct").otherwise("audit")
    )
    found = parse_lines(lines.drop("file"))
    return preferred_source(found if log is None else found.unionByName(log_lines(spark, log)))


def log_lines(spark: SparkSession, log: str) -> DataFrame:
    """The events of a task log as candidate lines of source ``audit``."""
    lines = parse_lines(_lines(spark, log).select("line_no", "value"))
    return lines.select(J.as_string(J.field(F.col("v"), "dataset")).alias("dataset"), "line_no", F.lit("audit").alias("source"), "v").where(
        "dataset is not null"
    )


def preferred_source(lines: DataFrame) -> DataFrame:
    """Direct lines of datasets that have any, audit lines of the others."""
    has_direct = lines.where("source = 'direct'").select("dataset").distinct()
    audit = lines.where("source = 'audit'").join(has_direct, "dataset", "left_anti")
    return lines.where("source = 'direct'").unionByName(audit)


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_EVENTS).json(path)

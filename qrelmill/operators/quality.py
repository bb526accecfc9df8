"""Corpus quality rules, quarantine and repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import written

# --- fixed values: prompt leftovers (first match wins) and rule limits
LEAK_PATTERNS = (
    "The user wants",
    "We need",
    "Let's",
    "Return a JSON",
    "Output Markdown only",
    "Must include",
    "Chinese characters",
    "I will",
    "Need to",
    "count Chinese",
    "synthetic mention",
    "Do not output JSON",
    "Let's craft",
    "We must",
    "The requirement",
)
MIN_CJK = 180
MAX_ENGLISH_SHARE = 0.18
MIN_WORDS = 120
# --- end of fixed values


def reason_list(text: Column, file_name: Column) -> Column:
    """Quality findings of one document, in rule order."""
    body = T.strip_front_matter(text)
    cjk = F.regexp_count(body, F.lit(r"[\u4e00-\u9fff]"))
    leak = F.coalesce(*[F.when(F.contains(text, F.lit(p)), F.lit(p)) for p in LEAK_PATTERNS])
    is_zh, is_en = file_name.startswith("zh-"), file_name.startswith("en-")
    rules = [
        F.when(~T.is_canonical(file_name), "noncanonical_filename"),
        F.when(T.is_blank(text), "empty"),
        F.when(~T.lstrip(text).startswith("---"), "missing_frontmatter"),
        F.concat(F.lit("prompt_leak:"), leak),
        F.when(is_zh & (cjk < MIN_CJK), "too_few_chinese_chars"),
        F.when(is_zh & (T.word_count(body, 4) > cjk * MAX_ENGLISH_SHARE), "too_much_english_in_zh_doc"),
        F.when(is_en & (T.word_count(body, 2) < MIN_WORDS), "too_few_english_words"),
        F.when(~F.contains(body, F.lit("\n## ")), "missing_section_heading"),
    ]
    return F.array_compact(F.array(*rules))


def quality_reasons(corpus: DataFrame) -> DataFrame:
    return corpus.withColumn("reasons", reason_list(F.col("text"), F.col("file_name")))


def bad_files(corpus: DataFrame) -> DataFrame:
    """The documents with findings, one row each: the detail behind the counts
    of ``audit_corpus``, kept as rows so that a bad dataset of any size fits."""
    return (
        corpus.select("dataset", "file_name", reason_list(F.col("text"), F.col("file_name")).alias("reasons"))
        .where(F.size("reasons") > 0)
    )


def audit_corpus(corpus: DataFrame) -> DataFrame:
    """Counts per dataset. Only flags reach the shuffle, never the text."""
    return (
        corpus.select(
            "dataset",
            T.is_canonical(F.col("file_name")).alias("canonical"),
            (F.size(reason_list(F.col("text"), F.col("file_name"))) > 0).alias("bad"),
        )
        .groupBy("dataset")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if("canonical").alias("canonical"),
            F.count_if("bad").alias("bad"),
        )
    )


def split_clean(corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean documents and the others. The rules read every text several times, so they are
    applied once and their result is stored for both sides."""
    flagged = written(quality_reasons(corpus), "flagged")
    return (
        flagged.where(F.size("reasons") == 0).drop("reasons"),
        flagged.where(F.size("reasons") > 0),
    )


def expected_grid(datasets: DataFrame, n: int) -> DataFrame:
    """Expected document slots 1..n per dataset: odd Chinese, even English."""
    slot = F.explode(F.sequence(F.lit(1), F.lit(n))).alias("idx")
    lang = F.when(F.col("idx") % 2 == 1, "zh").otherwise("en")
    return (
        datasets.select("dataset", slot)
        .withColumn("lang", lang)
        .withColumn("stem", F.format_string("%s-synthetic-%03d", "lang", "idx"))
    )


def missing_documents(corpus: DataFrame, n: int) -> DataFrame:
    grid = expected_grid(corpus.select("dataset").distinct(), n)
    return grid.join(corpus.select("dataset", "stem"), ["dataset", "stem"], "left_anti")


def render_template(
    grid: DataFrame,
    templates: dict[str, str],
    concepts: Sequence[tuple[str, str]],
    tradeoffs: Sequence[tuple[str, str, str, str]],
    failures: Sequence[tuple[str, str]],
) -> DataFrame:
    """Fill the language's template for every slot of ``grid``.

    ``templates`` maps a language to text with the placeholders {index},
    {concept}, {left}, {right} and {failure}. The lookups are short lists of
    (zh, en), (left_zh, right_zh, left_en, right_en) and (zh, en) entries,
    picked by slot number modulo their length; they become constant arrays of
    the plan, so filling is a narrow projection."""
    idx, zh = F.col("idx"), F.col("lang") == "zh"

    def pick(entries: Sequence[tuple[str, ...]], place: int) -> Column:
        return F.get(F.lit([e[place] for e in entries]), F.pmod(idx, F.lit(len(entries))).cast("int"))

    def either(entries: Sequence[tuple[str, ...]], zh_place: int, en_place: int) -> Column:
        return F.when(zh, pick(entries, zh_place)).otherwise(pick(entries, en_place))

    values = {
        "{index}": F.format_string("%03d", "idx"),
        "{concept}": either(concepts, 0, 1),
        "{left}": either(tradeoffs, 0, 2),
        "{right}": either(tradeoffs, 1, 3),
        "{failure}": either(failures, 0, 1),
    }
    body = F.when(zh, F.lit(templates["zh"])).otherwise(F.lit(templates["en"]))
    for name, value in values.items():
        body = F.replace(body, F.lit(name), value)
    return grid.withColumn("text", body)


def repair_corpus(
    corpus: DataFrame, rendered: DataFrame, datasets: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Repaired corpus, quarantined rows and counts per dataset.

    Non-canonical documents are quarantined. A grid slot of ``rendered`` that
    is absent or has findings takes the rendered text, others stay; canonical
    documents outside the grid stay as they are."""
    flagged = quality_reasons(corpus)
    canonical = T.is_canonical(F.col("file_name"))
    quarantined = flagged.where(~canonical)
    kept = flagged.where(canonical).select(
        "dataset", "stem", F.col("text").alias("old_text"), (F.size("reasons") > 0).alias("bad")
    )
    slots = rendered.select("dataset", "stem", F.col("text").alias("new_text"))
    replace = F.col("new_text").isNotNull() & (F.col("old_text").isNull() | F.col("bad"))
    merged = kept.join(slots, ["dataset", "stem"], "full").select(
        "dataset",
        "stem",
        F.concat("stem", F.lit(".md")).alias("file_name"),
        F.when(replace, F.col("new_text")).otherwise(F.col("old_text")).alias("text"),
        replace.alias("replaced"),
    )
    moved = quarantined.groupBy("dataset").agg(F.count(F.lit(1)).alias("moved"))
    counts = (
        merged.groupBy("dataset")
        .agg(F.count_if("replaced").alias("repaired"), F.count(F.lit(1)).alias("total"))
        .join(moved, "dataset", "full")
        .fillna(0, ["moved", "repaired", "total"])
    )
    return merged, quarantined, counts

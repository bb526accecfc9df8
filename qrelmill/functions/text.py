"""Column functions over Markdown text. All of them are row-local and stay in
the JVM; none needs a Python UDF."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: white space and line ends as Python's str methods see them
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# --- fixed values: Markdown patterns; (?d) makes \n the only line end
HEADING = rf"(?dm)^##{SPACE}+(.+)$"
SECTION = rf"(?dm)^##{SPACE}+.+$(?s:.*?)(?=^##{SPACE}+.+$|\z)"
TARGET = rf"(?dm)^Target:{SPACE}*(.+)$"
IMAGE = r"!\[([^\]]*)\]\(([^)\n]+)\)"
LANGUAGE = rf"(?dm)^language:{SPACE}*([^\r\n]+)"
CANONICAL = r"^(zh|en)-synthetic-\p{Nd}{3}\.md$"
TRUNCATED = "\n...[truncated]"
DEFAULT_STEM = "synthetic-doc"
MARKER_LABEL_ZH = "检索标记：{marker}。"
MARKER_LABEL_EN = "Retrieval marker: {marker}."
# --- end of fixed values


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the
    body names it. Inside lambdas nothing else shares a repeated expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}++\z", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{SPACE}++\z", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def split_lines(text: Column) -> Column:
    """Lines as ``str.splitlines`` yields them: no empty line after a final
    line end, none at all for an empty text."""
    return let(
        F.split(text, LINE_END, -1),
        lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p),
    )


def strip_front_matter(text: Column) -> Column:
    third = F.when(text.startswith("---"), F.get(F.split(text, "---", 3), 2))
    return F.coalesce(third, text)


def document_language(text: Column, file_name: Column) -> Column:
    by_name = F.when(file_name.startswith("zh-"), "zh").when(file_name.startswith("en-"), "en").otherwise("")
    return let(
        F.regexp_extract(text, LANGUAGE, 1),
        lambda d: F.when(d != "", F.lower(strip(d))).otherwise(by_name),
    )


def front_matter(text: Column) -> Column:
    """``key: value`` lines of the leading block; a repeated key keeps its last value."""
    parts = F.when(text.startswith("---"), F.split(text, "---", 3))
    block = F.when(F.size(parts) == 3, F.get(parts, 1)).otherwise("")
    entries = F.transform(
        F.filter(F.split(block, "\n"), lambda x: F.contains(x, F.lit(":"))),
        lambda x: F.struct(
            strip(F.substring_index(x, ":", 1)).alias("key"),
            strip(F.regexp_replace(x, r"(?s)^[^:]*:", "")).alias("value"),
        ),
    )

    def last_per_key(e: Column) -> Column:
        keys = F.transform(e, lambda x: x["key"])
        return let(
            keys,
            lambda k: F.filter(
                e, lambda x, i: F.array_position(F.slice(k, i + 2, F.size(k)), x["key"]) == 0
            ),
        )

    return F.map_from_entries(let(entries, last_per_key))


def headings(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(HEADING), F.lit(1))


def target_markers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TARGET), F.lit(1))


def image_refs(text: Column) -> Column:
    """``![alt](path "title")`` references as (alt, path) in text order."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(IMAGE), F.lit(0)),
        lambda m: F.struct(
            F.regexp_extract(m, IMAGE, 1).alias("alt"),
            F.substring_index(strip(F.regexp_extract(m, IMAGE, 2)), " ", 1).alias("path"),
        ),
    )


def section_list(text: Column) -> Column:
    """H2 sections as (heading, section_text) in text order; of sections that
    share a heading only the last stays."""
    whole = F.transform(
        F.regexp_extract_all(text, F.lit(SECTION), F.lit(0)),
        lambda s: F.struct(
            strip(F.regexp_extract(s, HEADING, 1)).alias("heading"),
            strip(s).alias("section_text"),
        ),
    )

    def last_per_heading(w: Column) -> Column:
        names = F.reverse(F.transform(w, lambda x: x["heading"]))
        return let(
            names,
            lambda n: F.filter(w, lambda x, i: F.array_position(n, x["heading"]) == F.size(n) - i),
        )

    return F.when(text.contains("##"), let(whole, last_per_heading)).otherwise(
        F.slice(whole, 1, 0)
    )


def truncate(text: Column, n: int) -> Column:
    return F.when(
        F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit(TRUNCATED))
    ).otherwise(text)


def is_canonical(file_name: Column) -> Column:
    return file_name.rlike(CANONICAL)


def stem(file_name: Column) -> Column:
    return F.regexp_replace(file_name, r"(?<=.)\.[^.]*\z", "")


def marker_for_stem(stem: Column, prefix: str = "docmark") -> Column:
    return F.concat(F.lit(prefix), F.replace(stem, F.lit("-"), F.lit("")))


def insert_marker(text: Column, is_zh: Column, marker: Column) -> Column:
    """Put the labelled marker below the first H1, or at the end without one."""
    label = F.when(is_zh, F.replace(F.lit(MARKER_LABEL_ZH), F.lit("{marker}"), marker)).otherwise(
        F.replace(F.lit(MARKER_LABEL_EN), F.lit("{marker}"), marker)
    )

    def stamped(lines: Column) -> Column:
        flags = F.transform(lines, lambda x: x.startswith("# "))
        return let(
            F.array_position(flags, True).cast("int"),
            lambda first: F.when(
                first > 0,
                F.concat(
                    F.array_join(
                        F.concat(
                            F.slice(lines, 1, first),
                            F.array(F.lit(""), label),
                            F.slice(lines, first + 1, F.size(lines)),
                        ),
                        "\n",
                    ),
                    F.lit("\n"),
                ),
            ),
        )

    return F.coalesce(
        let(split_lines(text), stamped), F.concat(rstrip(text), F.lit("\n\n"), label, F.lit("\n"))
    )


def safe_stem(value: Column) -> Column:
    """One pass over the text: a run of other characters, hyphens among them, is one
    hyphen, and none stays at the ends. ``\\W`` is Java's, of ASCII words, several times
    as fast as the class spelled out; lower-cased text holds no A-Z."""
    slug = F.btrim(F.regexp_replace(F.lower(value), r"\W+", "-"), F.lit("-"))
    return let(slug, lambda s: F.when(s == "", F.lit(DEFAULT_STEM)).otherwise(s))


def word_count(text: Column, min_len: int) -> Column:
    """Runs of ASCII letters that stand as whole words. The look-arounds spell
    out a Unicode-aware word edge, so the Java version does not matter."""
    edge = r"\p{L}\p{N}_"
    return F.regexp_count(text, F.lit(rf"(?<![{edge}])[A-Za-z]{{{min_len},}}(?![{edge}])"))


def char_stats(text: Column) -> Column:
    return F.struct(
        F.regexp_count(text, F.lit(r"[\u4e00-\u9fff]")).alias("cjk"),
        word_count(text, 4).alias("words4"),
        word_count(text, 2).alias("words2"),
        F.regexp_count(text, F.lit("\n## ")).alias("h2"),
    )


def normalize_path(path: Column) -> Column:
    """A relative path without ``.`` segments and doubled slashes, and with each
    ``..`` taken together with the segment before it; one that leads out of the
    folder stays."""
    plain = F.regexp_replace(F.regexp_replace(path, r"/(\./)+", "/"), r"^(\./)+", "")
    plain = F.regexp_replace(plain, r"/{2,}", "/")

    def step(done: Column, segment: Column) -> Column:
        up = (segment == "..") & (F.size(done) > 0) & (F.element_at(done, -1) != "..")
        return F.when(up, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(F.concat(done, F.array(segment)))

    resolved = F.array_join(F.aggregate(F.split(plain, "/"), F.array().cast("array<string>"), step), "/")
    return F.when(F.contains(plain, F.lit("..")), resolved).otherwise(plain)


def tokenize(text: Column) -> Column:
    """Lower-cased word tokens; runs of CJK characters become character
    bigrams (a single character stays as it is)."""
    cjk = r"[\u4e00-\u9fff]"
    lower = F.lower(text)
    # Text without CJK, the usual case, needs no second look at its tokens.
    words = F.regexp_extract_all(lower, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    runs = F.regexp_extract_all(lower, F.lit(rf"{cjk}+|[\p{{L}}\p{{N}}_&&[^\u4e00-\u9fff]]+"), F.lit(0))
    bigrams = F.flatten(
        F.transform(
            runs,
            lambda r: F.when(
                r.rlike(rf"^{cjk}{{2,}}"),
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))),
                    lambda i: F.substring(r, i, F.lit(2)),
                ),
            ).otherwise(F.array(r)),
        )
    )
    return F.when(text.rlike(cjk), bigrams).otherwise(words)

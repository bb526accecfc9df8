"""JSON that arrives as text: model responses, manifest values, report rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, none_if_empty, strip

NUMERIC_KIND = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"
FENCE = r"(?is)```(?:json)?\s*(.*?)```"
PARSE_FAILED = "JSON parse failed"
BAD_ROOT = "JSON root must be an object or array"


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_object(v: Column) -> Column:
    return F.coalesce(kind(v).startswith("OBJECT"), F.lit(False))


def is_array(v: Column) -> Column:
    return F.coalesce(kind(v).startswith("ARRAY"), F.lit(False))


def is_string(v: Column) -> Column:
    return F.coalesce(kind(v) == "STRING", F.lit(False))


def is_number(v: Column) -> Column:
    """A JSON number; booleans and numeric strings are not."""
    return F.coalesce(kind(v).rlike(NUMERIC_KIND), F.lit(False))


def field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def has_field(v: Column, name: str) -> Column:
    """The key is present, whatever its value: a JSON null still counts."""
    return field(v, name).isNotNull()


def elements(v: Column) -> Column:
    """Array elements as variants, null for anything that is not an array."""
    return F.when(is_array(v), F.try_variant_get(v, "$", "array<variant>"))


def as_number(v: Column) -> Column:
    return F.when(is_number(v), F.try_variant_get(v, "$", "double"))


def as_string(v: Column) -> Column:
    return F.when(is_string(v), F.try_variant_get(v, "$", "string"))


def truthy(v: Column) -> Column:
    """Python truth of a JSON value: null, false, 0, "", [] and {} are false."""
    k = kind(v)
    return (
        F.when(v.isNull() | (k == "VOID"), False)
        .when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(k.rlike(NUMERIC_KIND), F.try_variant_get(v, "$", "double") != 0)
        .otherwise(~F.to_json(v).isin('""', "[]", "{}"))
    )


def py_str(v: Column) -> Column:
    """``str(value)`` of a scalar; nested values keep their JSON text."""
    k = kind(v)
    return (
        F.when(v.isNull() | (k == "VOID"), "None")
        .when(k == "BOOLEAN", F.initcap(F.try_variant_get(v, "$", "string")))
        .when(k.startswith("OBJECT") | k.startswith("ARRAY"), F.to_json(v))
        .otherwise(F.try_variant_get(v, "$", "string"))
    )


def text_or(v: Column, default: str = "") -> Column:
    """``str(value or default)``."""
    return F.when(truthy(v), py_str(v)).otherwise(F.lit(default))


def string_array(v: Column) -> Column:
    """Array elements as text, in order; null for a non-array."""
    return F.transform(elements(v), py_str)


def split_list_text(s: Column) -> Column:
    """``[a, "b"]`` or line-separated text as a list of unquoted parts."""
    cleaned = F.regexp_replace(strip(s), r"^[\[\]]+|[\[\]]+\z", "")

    def unquote(x: Column) -> Column:
        x = F.regexp_replace(strip(x), r'^"+|"+\z', "")
        return F.regexp_replace(x, r"^'+|'+\z", "")

    return F.filter(F.transform(F.split(cleaned, r"[,\n]", -1), unquote), lambda x: x != "")


def coerce_string_list(v: Column) -> Column:
    """A list value as trimmed non-empty strings, a string as its parts,
    anything else as an empty list."""
    empty = F.array().cast("array<string>")
    listed = F.filter(F.transform(string_array(v), strip), lambda x: x != "")
    return F.coalesce(
        F.when(is_array(v), listed).when(
            is_string(v), split_list_text(F.try_variant_get(v, "$", "string"))
        ),
        empty,
    )


def extract_json_text(text: Column) -> Column:
    """The JSON part of a model response: fenced body, else the text when it
    starts like JSON, else the span from the earliest opener to the last
    closer of the same kind, else the text."""

    def pick(s: Column) -> Column:
        def span(opener: str, closer: str) -> tuple[Column, Column]:
            start = F.instr(s, opener)
            back = F.instr(F.reverse(s), closer)
            end = F.when(back > 0, F.length(s) - back + 1).otherwise(0)
            return F.when((start > 0) & (end > start), start), end

        obj, obj_end = span("{", "}")
        arr, arr_end = span("[", "]")
        start = F.least(obj, arr)
        end = F.when(obj.isNotNull() & (obj == start), obj_end).otherwise(arr_end)
        return (
            F.when(s.rlike(FENCE), strip(F.regexp_extract(s, FENCE, 1)))
            .when(s.startswith("{") | s.startswith("["), s)
            .when(start.isNotNull(), F.substring(s, start, end - start + 1))
            .otherwise(s)
        )

    return let(strip(text), pick)


def parse_model_json(text: Column) -> Column:
    """struct<v variant, error string>: the value, or why there is none."""


    def judge(v: Column) -> Column:
        root_ok = is_object(v) | is_array(v)
        return F.struct(
            F.when(root_ok, v).alias("v"),
            F.when(v.isNull(), PARSE_FAILED).when(~root_ok, BAD_ROOT).alias("error"),
        )

    return let(F.try_parse_json(extract_json_text(text)), judge)


def json_quote(s: Column) -> Column:
    """A JSON string literal with non-ASCII kept, as ``json.dumps`` writes it."""
    arr = F.to_json(F.array(s))
    quoted = F.regexp_replace(F.substring(arr, F.lit(2), F.length(arr) - 2), r"\\/", "/")
    # Control characters are written with lower-case hex digits; hardly a text has one.
    low = quoted
    for digit in "ABCDEF":
        low = F.regexp_replace(low, rf"(?<!\\)((?:\\\\)*\\u00[01]){digit}", f"$1{digit.lower()}")
    return F.when(s.rlike(r"[\x00-\x07\x0b\x0e-\x1f]"), low).otherwise(quoted)

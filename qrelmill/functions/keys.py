"""Content-derived identities, retry rules and labels."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import jsontext as J

# fixed values: how a provider status decides about another attempt
RETRYABLE = (408, 409, 429, 529)
NOT_RETRYABLE = (400, 401, 403)


def hash_text(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def task_id(dataset, stage, source_hash, prompt_version, system, user) -> Column:
    payload = F.concat_ws("\n", dataset, stage, source_hash, prompt_version, system, user)
    return F.substring(F.sha2(payload.cast("binary"), 256), 1, 32)


@F.pandas_udf(StringType())
def _sorted_json(texts: pd.Series) -> pd.Series:
    """Nested JSON with sorted keys, ``", "`` and ``": "``; only such values get here."""

    def spaced(text: str | None) -> str | None:
        return None if text is None else json.dumps(json.loads(text), sort_keys=True, ensure_ascii=False)

    return texts.map(spaced, na_action="ignore")


def candidate_id(raw: Column, q: Column, expect_any: Column) -> Column:
    """The record's own id, else 12 hex digits over its text, labels and evidence."""
    evidence = J.field(raw, "evidence")
    rationale = J.field(raw, "rationale")
    chosen = F.when(J.truthy(evidence), evidence).when(J.truthy(rationale), rationale)
    evidence_json = (
        F.when(chosen.isNull(), F.lit('""'))
        .when(J.is_string(chosen), J.json_quote(F.try_variant_get(chosen, "$", "string")))
        .otherwise(_sorted_json(F.when(~J.is_string(chosen), F.to_json(chosen))))
    )
    payload = F.concat(
        F.lit('{"evidence": '),
        evidence_json,
        F.lit(', "expect_any": ['),
        F.array_join(F.transform(expect_any, J.json_quote), ", "),
        F.lit('], "q": '),
        J.json_quote(q),
        F.lit("}"),
    )
    given = J.field(raw, "id")
    return F.when(J.truthy(given), J.py_str(given)).otherwise(
        F.substring(F.sha1(payload.cast("binary")), 1, 12)
    )


def may_retry(status: int | None) -> bool:
    """``retry_decision`` for one status outside a plan."""
    known = isinstance(status, int)
    return not known or (status not in NOT_RETRYABLE and (status in RETRYABLE or status >= 500))


def retry_decision(status: Column) -> Column:
    """Whether a failed attempt may be repeated; an unknown status may."""
    return (
        F.when(status.isNull(), True)
        .when(status.isin(*NOT_RETRYABLE), False)
        .when(status.isin(*RETRYABLE), True)
        .otherwise(status >= 500)
    )


def variant_label(overrides: Column) -> Column:
    pairs = F.transform(
        F.array_sort(F.map_entries(overrides)),
        lambda e: F.concat(e["key"], F.lit("="), e["value"]),
    )
    return F.when(F.coalesce(F.size(overrides), F.lit(0)) <= 0, "baseline").otherwise(
        F.array_join(pairs, ",")
    )


def apply_overrides(base: Column, overrides: Column) -> Column:
    """``base`` with the keys of ``overrides`` replaced or added."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(overrides, k))
    return F.map_concat(kept, overrides)

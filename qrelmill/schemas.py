"""Table shapes. Every table is keyed by ``dataset`` (evaluation tables by
``run_id``), so one job covers many packages at once."""

from __future__ import annotations

DATASETS = "dataset string, description string, has_meta boolean, has_queries boolean, has_targets boolean, has_corpus boolean"
THRESHOLDS = "dataset string, pos int, key string, value double, numeric boolean"
CORPUS = "dataset string, stem string, file_name string, text string"

# ``*_kind`` columns keep what the array column cannot: whether the manifest
# field was absent, a usable list, or something else.
QUERIES = (
    "dataset string, pos int, is_mapping boolean, id string, q string, query_type string, "
    "expect_any array<string>, expect_any_kind string, expect_none boolean, "
    "expect_asset_any array<string>, expect_asset_kind string, "
    "expect_chunk_any array<string>, expect_chunk_kind string"
)
ASSETS = (
    "dataset string, pos int, is_mapping boolean, id string, doc string, path string, "
    "heading string, anchor string"
)
CHUNKS = (
    "dataset string, pos int, is_mapping boolean, id string, doc string, heading string, "
    "anchor string, asset_id string, asset_ids array<string>, asset_ids_kind string"
)
ASSET_FILES = "dataset string, path string, length bigint"

TASKS = (
    "dataset string, stage string, source_hash string, prompt_version string, "
    "`system` string, `user` string, expected_json boolean, task_id string"
)
AUDIT_EVENTS = (
    "task_id string, dataset string, stage string, kind string, seq bigint, status string, "
    "attempts int, last_error string, raw_response string, result string, ts string"
)
AUDIT_STATE = (
    "task_id string, dataset string, stage string, status string, attempts int, "
    "last_error string, raw_response string, result string, created_at string, updated_at string"
)
TASK_RESULTS = (
    "task_id string, dataset string, stage string, status string, attempts int, "
    "result string, raw_response string, error string, skipped boolean"
)
PER_QUERY = (
    "run_id string, dataset string, mode string, pos int, id string, q string, "
    "expect_any array<string>, ranked array<string>"
)
DECISIONS = (
    "dataset string, candidate_id string, decision string, edited_q string, "
    "edited_expect_any array<string>, notes string, updated_at string"
)
REVIEW_BATCHES = (
    "dataset string, batch_id string, status string, error string, "
    "created_at string, updated_at string"
)
REVIEW_ITEMS = (
    "dataset string, batch_id string, target_type string, target_id string, decision string, "
    "score int, reason string, suggested_fix string, risk_flags array<string>, raw string, created_at string"
)

"""Batch task planning, execution state, attempt logs and responses."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsontext as J
from ..functions import keys as K
from ..functions import text as T
from ..schemas import TASK_RESULTS

SUCCEEDED, FAILED, MANUAL, RUNNING, DRY_RUN = (
    "succeeded",
    "failed",
    "needs_manual_review",
    "running",
    "dry_run",
)
@dataclass(frozen=True)
class Wording:
    """The texts a run adds to its tasks: after the user prompt of a JSON task, and
    the prompt that asks for a broken response to be mended (before that response)."""

    json_only: str
    repair_system: str
    repair_user: str


@dataclass(frozen=True)
class RetryPolicy:
    max_attempts: int = 6
    initial_seconds: float = 2.0
    max_seconds: float = 60.0
    jitter: bool = True
    slowdown_after: int = 3


# --- planning --------------------------------------------------------------


def task_ids(df: DataFrame) -> DataFrame:
    """Add source_hash (from ``source`` where absent) and the task identity."""
    if "source_hash" not in df.columns:
        df = df.withColumn("source_hash", K.hash_text(F.col("source")))
    names = ("dataset", "stage", "source_hash", "prompt_version", "system", "user")
    return df.withColumn("task_id", K.task_id(*[F.col(c) for c in names]))


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """A prompt template with {name} placeholders as one concat expression."""
    parts: list[Column] = []
    for piece in re.split(r"(\{[a-z_]+\})", template):
        name = piece[1:-1] if piece.startswith("{") else None
        if name in values:
            parts.append(values[name].cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def prompt_tasks(
    inputs: DataFrame,
    stage: str,
    version: str,
    system: Column,
    user: Column,
    source: Column,
    expected_json: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One task per input row. ``carry`` keeps input columns as task metadata."""
    out = inputs.select(
        "dataset",
        F.lit(stage).alias("stage"),
        K.hash_text(source).alias("source_hash"),
        F.lit(version).alias("prompt_version"),
        system.alias("system"),
        user.alias("user"),
        F.lit(expected_json).alias("expected_json"),
        *carry,
    )
    return task_ids(out)


def grid_tasks(grid: DataFrame, topic: str, version: str, system: str, user_zh: str, user_en: str) -> DataFrame:
    """One writing task per expected document slot (see ``expected_grid``)."""
    values = {"index": F.format_string("%03d", "idx"), "topic": F.lit(topic), "stem": F.col("stem")}
    user = F.when(F.col("lang") == "zh", fill(user_zh, values)).otherwise(fill(user_en, values))
    source = F.concat_ws(
        ":", "dataset", F.lit(topic), F.col("idx").cast("string"), "lang", "stem", F.lit(version)
    )
    return prompt_tasks(
        grid, "generate_bilingual_corpus", version, F.lit(system), user, source, False, ("idx", "lang", "stem")
    )


def pack_tasks(packs: DataFrame, n_queries: int, version: str, system: str, user: str) -> DataFrame:
    """One query-drafting task per corpus pack."""
    values = {"queries": F.lit(str(n_queries)), "corpus": F.col("pack")}
    source = F.when(F.col("pack") != "", F.col("pack")).otherwise(
        F.concat("dataset", F.lit(f":{n_queries}"))
    )
    return prompt_tasks(packs, "generate_candidates", version, F.lit(system), fill(user, values), source)


def topic_tasks(topics: DataFrame, n_items: int, version: str, system: str, user: str) -> DataFrame:
    """One fact-drafting task per (dataset, topic)."""
    values = {"items": F.lit(str(n_items)), "topic": F.col("topic")}
    source = F.concat("topic", F.lit(f":{n_items}"))
    return prompt_tasks(
        topics, "generate_factbook", version, F.lit(system), fill(user, values), source, True, ("topic",)
    )


def plan_tasks(
    tasks: DataFrame, state: DataFrame, resume: bool = False, retry_failed: bool = False, dry_run: bool = False
) -> DataFrame:
    """Tasks with a ``skipped`` flag. A task whose stored status is succeeded
    is skipped when resuming or retrying and carries its stored result."""
    if dry_run:
        return tasks.select(
            "*",
            F.lit(True).alias("skipped"),
            F.lit(DRY_RUN).alias("status"),
            F.lit(0).alias("attempts"),
            F.lit(None).cast("string").alias("result"),
            F.lit(None).cast("string").alias("raw_response"),
        )
    done = state.where(F.col("status") == SUCCEEDED) if (resume or retry_failed) else state.where(F.lit(False))
    stored = done.select("task_id", "status", "attempts", "result", "raw_response")
    return tasks.join(stored, "task_id", "left").withColumn("skipped", F.col("status").isNotNull())


# --- audit log -------------------------------------------------------------

STATE_VALUES = ("attempts", "last_error", "raw_response", "result")


def fold_audit(events: DataFrame) -> DataFrame:
    """Current row per task from start and finish events.

    A start sets status and time only; a finish replaces all but the creation
    time. Every value is an order-keyed maximum, so replayed or reordered
    events give the same row, and partial folds merge map-side."""
    finish = F.col("kind") == "finish"
    order = F.col("seq")
    last_finish = F.max_by(
        F.struct(*STATE_VALUES), F.when(finish, order)
    ).alias("f")
    status = F.when(finish, F.col("status")).otherwise(RUNNING)
    out = events.groupBy("task_id").agg(
        F.max_by(F.struct("dataset", "stage", status.alias("status"), F.col("ts").alias("updated_at")), order).alias("s"),
        last_finish,
        F.min("ts").alias("created_at"),
        F.max(order).alias("last_seq"),
        F.max(F.when(finish, order)).alias("finish_seq"),
    )
    has_finish = F.col("finish_seq").isNotNull()
    return out.select(
        "task_id",
        "s.dataset",
        "s.stage",
        "s.status",
        F.when(has_finish, F.col("f.attempts")).otherwise(0).alias("attempts"),
        *[F.when(has_finish, F.col(f"f.{c}")).alias(c) for c in STATE_VALUES[1:]],
        "created_at",
        "s.updated_at",
        "last_seq",
        "finish_seq",
    )


def merge_states(a: DataFrame, b: DataFrame) -> DataFrame:
    """Merge two folds of disjoint or overlapping event sets into one."""
    both = a.unionByName(b)
    out = both.groupBy("task_id").agg(
        F.max_by(F.struct("dataset", "stage", "status", "updated_at"), "last_seq").alias("s"),
        F.max_by(F.struct(*STATE_VALUES), "finish_seq").alias("f"),
        F.min("created_at").alias("created_at"),
        F.max("last_seq").alias("last_seq"),
        F.max("finish_seq").alias("finish_seq"),
    )
    has_finish = F.col("finish_seq").isNotNull()
    return out.select(
        "task_id",
        "s.dataset",
        "s.stage",
        "s.status",
        F.when(has_finish, F.col("f.attempts")).otherwise(0).alias("attempts"),
        *[F.when(has_finish, F.col(f"f.{c}")).alias(c) for c in STATE_VALUES[1:]],
        "created_at",
        "s.updated_at",
        "last_seq",
        "finish_seq",
    )


def scan_audit(state: DataFrame, stage: str | None = None, status: str | None = None) -> DataFrame:
    """Task rows by stage and status in ``updated_at`` order."""
    if stage is not None:
        state = state.where(F.col("stage") == stage)
    if status is not None:
        state = state.where(F.col("status") == status)
    return state.orderBy("updated_at", "task_id")


def audit_status_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("dataset", "status").agg(F.count(F.lit(1)).alias("n"))


def recent_tasks(state: DataFrame, n: int = 300) -> DataFrame:
    """The newest ``n`` task rows of each dataset."""
    w = Window.partitionBy("dataset").orderBy(F.col("updated_at").desc(), "task_id")
    return (
        state.select("dataset", "task_id", "stage", "status", "attempts", "last_error", "updated_at")
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= n)
    )


def batch_outcome(results: DataFrame) -> DataFrame:
    bad = F.bool_or(F.col("status").isin(FAILED, MANUAL))
    return results.groupBy("dataset").agg(bad.alias("failed"))


# --- responses and attempts ------------------------------------------------


def classify_responses(responses: DataFrame) -> DataFrame:
    """Status and result of raw responses: text tasks keep {text}; JSON tasks
    use the response, else its one repaired version, else wait for a person.

    Reads (raw, repaired, expected_json); ``result`` is JSON text."""
    first, second = F.col("_p1"), F.col("_p2")
    v = F.coalesce(first["v"], second["v"])
    text_result = F.to_json(F.struct(F.col("raw").alias("text")))
    plain = ~F.col("expected_json")
    repaired = F.coalesce("repaired", "raw")
    return (
        responses.withColumn("_p1", J.parse_model_json(F.col("raw")))
        .withColumn("_p2", J.parse_model_json(repaired))
        .withColumn(
            "status", F.when(plain | v.isNotNull(), SUCCEEDED).otherwise(MANUAL)
        )
        .withColumn("result", F.when(plain, text_result).otherwise(F.to_json(v)))
        .withColumn("error", F.when(~plain & v.isNull(), second["error"]))
        .withColumn("raw_response", F.when(plain | first["v"].isNotNull(), F.col("raw")).otherwise(repaired))
        .drop("_p1", "_p2", "repaired", "raw")
    )


def attempt_failed(status_code: Column, body: Column, error: Column) -> Column:
    """An attempt fails on an error, a status other than 2xx or a blank body."""
    refused = F.coalesce(~status_code.between(200, 299), F.lit(False))
    return error.isNotNull() | refused | T.is_blank(body)


def attempt_rollup(attempts: DataFrame, budget: int | None = None, policy: RetryPolicy = RetryPolicy()) -> DataFrame:
    """Final state per task from its attempt log within the budget: success at
    k counts k attempts; a retryable end counts the budget, any other end 1.

    Only order-keyed minima, so the log is combined map-side."""
    budget = budget or policy.max_attempts
    failed = attempt_failed(F.col("status_code"), F.col("body"), F.col("error"))
    ends = ~failed | ~K.retry_decision(F.col("status_code")) | (F.col("attempt") >= budget)
    message = F.coalesce("error", F.when(failed, F.lit("empty response")))
    out = (
        attempts.where(F.col("attempt") <= budget)
        .groupBy("task_id")
        .agg(
            F.min_by(
                F.struct(
                    (~failed).alias("ok"),
                    F.col("attempt"),
                    K.retry_decision(F.col("status_code")).alias("retryable"),
                    message.alias("message"),
                ),
                F.when(ends, F.col("attempt")),
            ).alias("e"),
            F.bool_or(ends).alias("ended"),
        )
    )
    e = F.col("e")
    return out.select(
        "task_id",
        F.when(~F.col("ended"), RUNNING).when(e["ok"], SUCCEEDED).otherwise(FAILED).alias("status"),
        F.when(~F.col("ended"), 0)
        .when(e["ok"], e["attempt"])
        .when(e["retryable"], budget)
        .otherwise(1)
        .cast("int")
        .alias("attempts"),
        F.when(F.col("ended") & ~e["ok"], e["message"]).alias("error"),
    )


# --- execution -------------------------------------------------------------


class CallError(RuntimeError):
    """Raised by a completion function; ``status_code`` steers the retry."""

    def __init__(self, message: str, status_code: int | None = None) -> None:
        super().__init__(message)
        self.status_code = status_code


class StopRun(BaseException):
    """Raised by a completion function to end the whole run, not its task."""


def pause_after(status: int | None, attempt: int, budget: int, limited: int, policy: RetryPolicy) -> float | None:
    """Seconds between a failed attempt and the next, or None when there is no next.

    ``limited`` is the number of attempts in a row that a rate limit refused."""
    if attempt >= budget or not K.may_retry(status):
        return None
    slower = policy.initial_seconds * limited if limited >= policy.slowdown_after else 0.0
    return min(policy.max_seconds, policy.initial_seconds * 2 ** (attempt - 1)) + min(policy.max_seconds, slower)


def _settled(answered: DataFrame) -> DataFrame:
    """Task results from responses (raw, repaired, expected_json, attempts) or, where a task
    got none, its ``call_error``."""
    lost = F.col("call_error").isNotNull()
    return classify_responses(answered).withColumns(
        {
            "status": F.when(lost, FAILED).otherwise(F.col("status")),
            "result": F.when(~lost, F.col("result")),
            "error": F.when(lost, F.col("call_error")).otherwise(F.col("error")),
            "skipped": F.lit(False),
        }
    )


RESULT_COLUMNS = [c.strip().split(" ")[0] for c in TASK_RESULTS.split(",")]


def skipped_results(plan: DataFrame) -> DataFrame:
    """The stored results of tasks that a plan does not send."""
    return plan.where("skipped").withColumn("error", F.lit(None).cast("string")).select(*RESULT_COLUMNS)


def recorded_results(plan: DataFrame, attempts: DataFrame, repairs: DataFrame, budget: int | None = None) -> DataFrame:
    """What a run of ``plan`` ends with, read from its log alone.

    ``attempts(task_id, attempt, status_code, body, error)`` holds what each
    call returned, ``repairs(task_id, repaired)`` the mended responses. Tasks
    without a final attempt are still running. No call is made."""
    rolled = attempt_rollup(attempts, budget)
    bodies = attempts.select("task_id", F.col("attempt").alias("attempts"), F.col("body").alias("raw"))
    answered = (
        plan.where(~F.col("skipped"))
        .select("task_id", "dataset", "stage", "expected_json")
        .join(rolled.withColumnsRenamed({"status": "ended", "error": "call_error"}), "task_id", "left")
        .join(bodies, ["task_id", "attempts"], "left")
        .join(repairs.select("task_id", "repaired"), "task_id", "left")
        .withColumn("raw", F.when(F.col("ended") == SUCCEEDED, F.col("raw")))
    )
    open_ = F.coalesce(F.col("ended") == RUNNING, F.lit(True))
    settled = _settled(answered).withColumns(
        {
            "status": F.when(open_, RUNNING).otherwise(F.col("status")),
            "attempts": F.coalesce("attempts", F.lit(0)),
            "result": F.when(~open_, F.col("result")),
            "error": F.when(~open_, F.col("error")),
        }
    )
    return settled.select(*RESULT_COLUMNS).unionByName(skipped_results(plan))


def run_tasks(
    plan: DataFrame,
    complete: Callable[[str, str, str], str],
    wording: Wording,
    model: str = "",
    policy: RetryPolicy = RetryPolicy(),
    concurrency: int = 8,
    max_attempts: int | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Apply ``complete(system, user, model) -> text`` to the planned tasks.

    ``concurrency`` partitions call at the same time, each one task after the
    other with back-off; a response that is not JSON gets one repair call.
    Only the calls run in Python: parsing and the final state are column
    expressions. Tasks planned as skipped come back with their stored result
    and are never sent. Every action on the returned plan sends the calls
    again: ``streaming.runs.run_resumable`` stores each batch once."""
    budget = max_attempts or policy.max_attempts

    def ask(system: str, user: str) -> tuple[str | None, str | None, int | None]:
        """Text of one call, or its error and status."""
        try:
            text = complete(system, user, model)
        except Exception as exc:  # the provider's errors are open-ended
            return None, str(exc), getattr(exc, "status_code", None)
        return (text, None, None) if text.strip() else (None, "empty response", None)

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limited = 0
        for batch in batches:
            out = batch[["task_id", "dataset", "stage", "expected_json"]].assign(raw=None, call_error=None, attempts=0)
            for n, t in enumerate(batch.itertuples(index=False)):
                user = t.user + wording.json_only if t.expected_json else t.user
                attempt, wait, status = 0, 0.0, None
                while wait is not None:
                    attempt += 1
                    if wait:
                        sleep(wait * random.uniform(0.5, 1.5) if policy.jitter else wait)
                    text, error, status = ask(t.system, user)
                    limited = 0 if error is None else limited + (status == 429)
                    wait = None if error is None else pause_after(status, attempt, budget, limited, policy)
                spent = attempt if error is None else budget if K.may_retry(status) else 1
                out.iloc[n, -3:] = [text, error, spent]
            yield out

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # A failed repair leaves the response as it was.
            mended = [
                ask(wording.repair_system, wording.repair_user + raw)[0] if broken else None
                for raw, broken in zip(batch["raw"], batch["broken"], strict=True)
            ]
            yield batch.drop(columns="broken").assign(repaired=mended)

    called = "task_id string, dataset string, stage string, expected_json boolean, raw string, call_error string, attempts int"
    sent = (
        plan.where(~F.col("skipped"))
        .select("task_id", "dataset", "stage", "system", "user", "expected_json")
        .repartition(concurrency, "task_id")
        .mapInPandas(call, called)
    )
    no_json = F.col("raw").isNotNull() & F.col("expected_json") & J.parse_model_json(F.col("raw"))["v"].isNull()
    answered = sent.withColumn("broken", no_json).mapInPandas(repair, called + ", repaired string")
    return _settled(answered).select(*RESULT_COLUMNS).unionByName(skipped_results(plan))

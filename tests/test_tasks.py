"""Task identity, retries, audit folds and the streaming state."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from qrelmill import schemas as X
from qrelmill.functions import keys as K
from qrelmill.operators import tasks as T
from qrelmill.sources import readers, sinks
from qrelmill.streaming import audit, runs

ATTEMPTS = "task_id string, attempt int, status_code int, body string, error string"


def test_task_id(spark):
    values = ("d", "stage", "v1", "sys é", "user\nline")
    df = spark.createDataFrame([(*values, "源")], "dataset string, stage string, prompt_version string, system string, user string, source string")
    row = T.task_ids(df).first()
    source = hashlib.sha256("源".encode()).hexdigest()
    payload = "\n".join(["d", "stage", source, "v1", "sys é", "user\nline"])
    assert row.source_hash == source and row.task_id == hashlib.sha256(payload.encode()).hexdigest()[:32]


def test_candidate_id(spark):
    raws = [
        {"q": 'a "x" \\ 中\n/', "evidence": "e\t/", "expect_any": ["d-1", "é"]},
        {"q": "b"},
        {"q": "c", "rationale": "why", "id": ""},
        {"q": "c", "id": "own"},
    ]
    df = spark.createDataFrame([(json.dumps(r), r["q"], r.get("expect_any", [])) for r in raws], "j string, q string, e array<string>")
    got = [r[0] for r in df.select(K.candidate_id(F.parse_json("j"), F.col("q"), F.col("e"))).collect()]
    for r, g in zip(raws, got):
        payload = json.dumps(
            {"q": r["q"], "expect_any": r.get("expect_any", []), "evidence": r.get("evidence") or r.get("rationale") or ""},
            ensure_ascii=False, sort_keys=True,
        )
        assert g == (r.get("id") or hashlib.sha1(payload.encode()).hexdigest()[:12])


@pytest.mark.parametrize(
    "log, budget, want",
    [
        ([(429, None, "e"), (529, None, "e"), (None, "ok", None)], 6, ("succeeded", 3)),
        ([(401, None, "no")], 6, ("failed", 1)),
        ([(500, None, "e"), (404, None, "no")], 6, ("failed", 1)),
        ([(None, "", None), (None, "ok", None)], 6, ("succeeded", 2)),
        ([(500, None, "e"), (500, None, "e")], 2, ("failed", 2)),
        ([(500, None, "e")], 3, ("running", 0)),
    ],
)
def test_attempt_rollup(spark, log, budget, want):
    df = spark.createDataFrame([("t", i + 1, *a) for i, a in enumerate(log)], ATTEMPTS)
    row = T.attempt_rollup(df, budget).first()
    assert (row.status, row.attempts) == want


def test_retry_decision(spark):
    codes = [408, 409, 429, 529, 500, 503, 400, 401, 403, 404, None]
    df = spark.createDataFrame([(c,) for c in codes], "c int")
    assert [r[0] for r in df.select(K.retry_decision(F.col("c"))).collect()] == [True] * 6 + [False] * 4 + [True]


def test_what_counts_as_a_failed_attempt(spark):
    rows = [(200, "ok", None), (None, "ok", None), (204, "\n\t ", None), (None, "\n", None), (302, "ok", None), (200, "ok", "boom")]
    df = spark.createDataFrame(rows, "s int, b string, e string")
    failed = [r[0] for r in df.select(T.attempt_failed(F.col("s"), F.col("b"), F.col("e"))).collect()]
    assert failed == [False, False, True, True, True, True]


EVENTS = [
    ("a", "d", "s", "start", 1, None, None, None, None, None, "t1"),
    ("a", "d", "s", "finish", 2, "failed", 3, "boom", "raw", None, "t2"),
    ("a", "d", "s", "start", 3, None, None, None, None, None, "t3"),
    ("b", "d", "s", "start", 4, None, None, None, None, None, "t4"),
    ("b", "d", "s", "finish", 5, "succeeded", 1, None, "raw b", '{"x":1}', "t5"),
    ("c", "d", "s", "start", 6, None, None, None, None, None, "t6"),
]


def states(df):
    return {r.task_id: (r.status, r.attempts, r.last_error, r.result, r.created_at, r.updated_at) for r in df.collect()}


WANT = {
    "a": ("running", 3, "boom", None, "t1", "t3"),
    "b": ("succeeded", 1, None, '{"x":1}', "t4", "t5"),
    "c": ("running", 0, None, None, "t6", "t6"),
}


def test_fold_is_idempotent_and_mergeable(spark):
    df = spark.createDataFrame(EVENTS, X.AUDIT_EVENTS)
    assert states(T.fold_audit(df)) == WANT
    assert states(T.fold_audit(df.union(df).orderBy(F.rand(1)))) == WANT
    for cut in range(1, 7):
        a, b = T.fold_audit(df.where(f"seq < {cut}")), T.fold_audit(df.where(f"seq >= {cut - 1}"))
        assert states(T.merge_states(b, a)) == WANT


def test_plan_tasks(spark):
    tasks = spark.createDataFrame([("a",), ("b",), ("z",)], "task_id string")
    state = T.fold_audit(spark.createDataFrame(EVENTS, X.AUDIT_EVENTS))
    got = {r.task_id: (r.skipped, r.result) for r in T.plan_tasks(tasks, state, resume=True).collect()}
    assert got == {"a": (False, None), "b": (True, '{"x":1}'), "z": (False, None)}
    assert T.plan_tasks(tasks, state).where("skipped").count() == 0
    assert T.plan_tasks(tasks, state, dry_run=True).where("status = 'dry_run' and skipped").count() == 3


def make_tasks(spark, users, expected_json=True):
    df = spark.createDataFrame([("d", u) for u in users], "dataset string, u string")
    return T.prompt_tasks(df, "s", "v", F.lit("sys"), F.col("u"), F.col("u"), expected_json, ("u",))


WORDING = T.Wording("\nJSON, please.", "Mend this.", "Text: ")


def test_pause_after_a_failed_attempt():
    policy = T.RetryPolicy(initial_seconds=2, max_seconds=5, slowdown_after=3)
    pauses = [T.pause_after(429, n, 6, n, policy) for n in range(1, 7)]
    assert pauses == [2, 4, 5 + 5, 5 + 5, 5 + 5, None]
    assert T.pause_after(401, 1, 6, 0, policy) is None and T.pause_after(404, 1, 6, 0, policy) is None
    assert T.pause_after(None, 1, 6, 0, policy) == 2 and T.pause_after(503, 2, 6, 2, policy) == 4


def test_run_tasks(spark):
    def complete(system, user, model):
        if user.startswith("fail"):
            raise T.CallError("denied", 401)
        if user.startswith("busy"):
            raise T.CallError("busy", 503)
        if user.startswith("fenced"):
            return '```json\n{"a": 1}\n```'
        if user.startswith("broken") or user.startswith("hopeless"):
            return user.split("\n")[0]
        if system == WORDING.repair_system:
            return '{"fixed": true}' if "broken" in user else "still bad"
        return ""

    users = ["fail", "busy", "fenced", "broken", "hopeless", "empty"]
    plan = T.plan_tasks(make_tasks(spark, users), T.fold_audit(spark.createDataFrame([], X.AUDIT_EVENTS)))
    names = {r.task_id: r.u for r in plan.collect()}
    res = T.run_tasks(plan, complete, WORDING, policy=T.RetryPolicy(max_attempts=2), sleep=lambda s: None, concurrency=2)
    got = {names[r.task_id]: (r.status, r.attempts, r.result, r.error) for r in res.collect()}
    assert got["fail"] == ("failed", 1, None, "denied")
    assert got["busy"] == ("failed", 2, None, "busy")
    assert got["empty"] == ("failed", 2, None, "empty response")
    assert got["fenced"] == ("succeeded", 1, '{"a":1}', None)
    assert got["broken"] == ("succeeded", 1, '{"fixed":true}', None)
    assert got["hopeless"][0] == "needs_manual_review" and got["hopeless"][3]
    assert T.batch_outcome(res).first().failed


def test_text_tasks_and_skip(spark):
    plan = T.plan_tasks(make_tasks(spark, ["x"], False), T.fold_audit(spark.createDataFrame([], X.AUDIT_EVENTS)))
    row = T.run_tasks(plan, lambda s, u, m: "not json", WORDING).first()
    assert (row.status, json.loads(row.result), row.skipped) == ("succeeded", {"text": "not json"}, False)
    done = plan.select("task_id", F.lit("succeeded").alias("status"), F.lit(4).alias("attempts"), F.lit("{}").alias("result"), F.lit("r").alias("raw_response"))

    def never(s, u, m):
        raise AssertionError("called")

    again = T.run_tasks(T.plan_tasks(make_tasks(spark, ["x"], False), done, retry_failed=True), never, WORDING).first()
    assert again.skipped and again.attempts == 4


def test_a_stopped_run_goes_on(spark, tmp_path):
    """A run that ends half-way sends only the tasks of its open batch again."""
    path, calls = str(tmp_path / "run"), tmp_path / "calls"
    calls.mkdir()
    gate, names = tmp_path / "gate", [f"u{i:02d}" for i in range(20)]

    def complete(system, user, model):
        name = user.split("\n")[0]
        if system == WORDING.repair_system:
            return "still not"
        if name == "u11" and not gate.exists():
            raise T.StopRun("quota")
        with open(calls / name, "a") as f:
            f.write("x")
        if name == "u03":
            raise T.CallError("denied", 403)
        return "no json" if name == "u05" else '{"a": 1}'

    state = T.fold_audit(spark.createDataFrame([], X.AUDIT_EVENTS))
    done = make_tasks(spark, ["old"]).select("task_id", F.lit("succeeded").alias("status"), F.lit(3).alias("attempts"), F.lit("{}").alias("result"), F.lit("r").alias("raw_response"))
    plan = T.plan_tasks(make_tasks(spark, [*names, "old", "u01"]), done.unionByName(state.select(*done.columns)), resume=True).coalesce(1)

    def go():
        return runs.run_resumable(plan, path, complete, WORDING, batch_tasks=4, concurrency=2, sleep=lambda s: None)

    with pytest.raises(Exception, match="quota"):
        go()
    closed = {r.task_id for r in runs.run_results(spark, path).where("NOT skipped").collect()}
    gate.touch()
    results = {r.task_id: r for r in go().collect()}
    assert len(results) == 21 and results == {r.task_id: r for r in go().collect()}
    users = {r.task_id: r.u for r in plan.collect()}
    sent = {u: len((calls / u).read_text()) for u in names}
    often = {u for u, n in sent.items() if n > 1}
    assert len(closed) < 20 and not often & {users[t] for t in closed} and len(often) < 4
    got = {users[t]: (r.status, r.attempts, r.skipped) for t, r in results.items()}
    assert got["u03"] == ("failed", 1, False) and got["u05"][0] == "needs_manual_review" and got["old"] == ("succeeded", 3, True)
    log = T.fold_audit(readers.read_audit_log(spark, f"{path}/log/*"))
    assert {users[r.task_id]: (r.status, r.attempts) for r in log.collect()} == {u: v[:2] for u, v in got.items() if u != "old"}


def test_results_of_a_recorded_run(spark):
    plan = T.plan_tasks(make_tasks(spark, ["ok", "late", "denied", "broken", "bad", "open", "none"]), T.fold_audit(spark.createDataFrame([], X.AUDIT_EVENTS)))
    ids = {r.u: r.task_id for r in plan.collect()}
    log = [("ok", 1, None, "[1]", None), ("late", 1, 429, None, "busy"), ("late", 2, None, "{}", None), ("denied", 1, 403, None, "no")]
    log += [("broken", 1, None, "x", None), ("bad", 1, None, "y", None), ("open", 1, 500, None, "e")]
    attempts = spark.createDataFrame([(ids[u], *a) for u, *a in log], ATTEMPTS)
    repairs = spark.createDataFrame([(ids["broken"], "[2]"), (ids["bad"], "z")], "task_id string, repaired string")
    users = {v: k for k, v in ids.items()}
    got = {users[r.task_id]: (r.status, r.attempts, r.result, r.error if r.status == "failed" else None) for r in T.recorded_results(plan, attempts, repairs, 3).collect()}
    assert got == {
        "ok": ("succeeded", 1, "[1]", None), "late": ("succeeded", 2, "{}", None), "denied": ("failed", 1, None, "no"),
        "broken": ("succeeded", 1, "[2]", None), "bad": ("needs_manual_review", 1, None, None),
        "open": ("running", 0, None, None), "none": ("running", 0, None, None),
    }


def test_log_round_trip(spark, tmp_path):
    res = spark.createDataFrame([("t", "d", "s", "succeeded", 2, "{}", "raw", None, False, 7, "ts")], X.TASK_RESULTS + ", seq bigint, ts string")
    sinks.append_task_log(res, str(tmp_path / "log"))
    state = T.fold_audit(readers.read_audit_log(spark, str(tmp_path / "log"))).first()
    assert (state.task_id, state.status, state.attempts, state.result, state.updated_at) == ("t", "succeeded", 2, "{}", "ts")


def test_stream_equals_batch_over_replays_and_compaction(spark, tmp_path):
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    df = spark.createDataFrame(EVENTS, X.AUDIT_EVENTS)
    for lo, hi in ((1, 2), (3, 3), (2, 5), (6, 6)):  # overlapping: events arrive twice
        df.where(f"seq between {lo} and {hi}").coalesce(1).write.mode("append").json(log)
        audit.stream_fold_audit(spark, log, state, str(tmp_path / "ck"), compact_every=2).awaitTermination()
    assert states(audit.read_state(spark, state)) == WANT
    kept = {p.name for p in (tmp_path / "state").iterdir()}
    assert sum(n.startswith("base-") for n in kept) <= 1 and len(kept) <= 2
    counts = {r.status: r["n"] for r in audit.status_counts(audit.read_state(spark, state)).collect()}
    assert counts == {"running": 2, "succeeded": 1}


def test_counts_by_signed_changes(spark, tmp_path, monkeypatch):
    """Counts follow overlapping, late and replayed events, and no batch reads the task state."""
    monkeypatch.setattr(audit, "read_state", None)
    log, counts, offsets = (str(tmp_path / n) for n in ("log", "counts", "ck"))
    df = spark.createDataFrame(EVENTS, X.AUDIT_EVENTS)
    seen = []
    for lo, hi in ((4, 5), (1, 2), (3, 3), (2, 5), (6, 6)):
        df.where(f"seq between {lo} and {hi}").coalesce(1).write.mode("append").json(log)
        audit.stream_status_counts(spark, log, counts, offsets, compact_every=2).awaitTermination()
        seen.append({r.status: r["n"] for r in audit.read_counts(spark, counts).collect()})
    assert seen == [{"succeeded": 1}, {"succeeded": 1, "failed": 1}, {"succeeded": 1, "running": 1}, {"succeeded": 1, "running": 1}, {"succeeded": 1, "running": 2}]
    assert sum(p.name.startswith("base-") for p in (tmp_path / "counts").iterdir()) == 1

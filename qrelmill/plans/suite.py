"""Every operator bound to the given tables, with the same result in SQL.

``QUERIES`` maps a name to a function of (spark, sf_dir); ``ORACLES`` to the
DuckDB statement over the raw tables. Nested values are flattened or hashed to
scalars so both sides compare by value."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import jsontext as J
from ..functions import keys as K
from ..functions import ranking as R
from ..functions import text as T
from ..operators import catalog, corpus, curation, gates, ordering, quality, ranking, review, scoring
from ..operators import separation as sep
from ..operators import tasks, validate
from ..schemas import DECISIONS, REVIEW_ITEMS
from ..session import configure, shared_folder
from ..sources import changes, readers, sinks
from ..streaming import audit
from .bindings import Tables, duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ORACLES_OF: dict[str, str] = {}  # without the views


def register(name: str, views: str = "", sql: str | None = None):
    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES_OF[name] = sql
            ORACLES[name] = duck(views, sql)
        return fn

    return wrap


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def big(c, name: str):
    return (F.col(c) if isinstance(c, str) else c).cast("bigint").alias(name)


def joined(c, sep_: str = "|"):
    return F.array_join(c, sep_)


METRIC_LIST = R.METRICS

# --- H: ranking metrics ----------------------------------------------------

QUERY_METRICS_SQL = """
q as (select o_orderkey, run_id, mode, id, ranked, expect_any from v_per_query),
m as (
  select run_id, mode, id, o_orderkey,
    case when len(list_filter(ranked[1:3], lambda x: list_contains(expect_any, x))) > 0 then 1.0::double else 0.0::double end as hit_at_3,
    case when len(list_filter(ranked[1:10], lambda x: list_contains(expect_any, x))) > 0 then 1.0::double else 0.0::double end as hit_at_10,
    coalesce(1.0 / list_min(list_filter(list_transform(expect_any, lambda x: list_position(ranked, x)), lambda p: p > 0)), 0.0) as mrr,
    case when len(expect_any) = 0 then 0.0 else
      coalesce(list_sum(list_transform(range(1, least(10, len(ranked)) + 1), lambda i: case when list_contains(expect_any, ranked[i]) then 1.0 / log2(i + 1) else 0.0 end)), 0.0)
      / list_sum(list_transform(range(1, least(10, len(list_distinct(expect_any))) + 1), lambda i: 1.0 / log2(i + 1))) end as ndcg_at_10,
    case when len(expect_any) = 0 then 0.0 else
      len(list_distinct(list_filter(ranked[1:100], lambda x: list_contains(expect_any, x)))) / len(list_distinct(expect_any)) end as recall_at_100,
    case when starts_with(id, 'zh-') then 'zh' when starts_with(id, 'en-') then 'en' else 'other' end as lang
  from q)"""
MEANS_SQL = ", ".join(f"round(avg({m}), 6) as {m}" for m in METRIC_LIST)


@register(
    "query_metrics",
    "v_per_query",
    f"with {QUERY_METRICS_SQL} select id, lang, "
    + ", ".join(f"round({m}, 6) as {m}" for m in METRIC_LIST)
    + " from m",
)
def _(t):
    scored = scoring.query_metrics(t.per_query)
    return scored.select("id", R.lang_bucket(F.col("id")).alias("lang"), *[r6(m).alias(m) for m in METRIC_LIST])


@register("aggregate_metrics", "v_per_query", f"with {QUERY_METRICS_SQL} select run_id, mode, count(*) as n, {MEANS_SQL} from m group by run_id, mode")
def _(t):
    out = scoring.aggregate_metrics(t.per_query, ["run_id", "mode"])
    return out.select("run_id", "mode", "n", *[r6(m).alias(m) for m in METRIC_LIST])


SPLIT_SQL = f"""{QUERY_METRICS_SQL},
split as (select run_id, case when grouping(lang) = 1 then 'all' else lang end as lang, count(*) as n, {MEANS_SQL}
  from m group by grouping sets ((run_id, lang), (run_id)))"""


@register("split_metrics", "v_per_query", f"with {SPLIT_SQL} select * from split")
def split_metrics(t):
    out = scoring.split_metrics(t.per_query)
    return out.select("run_id", "lang", "n", *[r6(m).alias(m) for m in METRIC_LIST])


@register(
    "mode_view_metrics",
    "v_per_query",
    "with base as (select *, 'doc' as view from v_per_query union all by name "
    "select o_orderkey, run_id, mode, id, top_price, ranked, expect_asset_any as expect_any, expect_asset_any, 'asset' as view "
    "from v_per_query where len(expect_asset_any) > 0), "
    + QUERY_METRICS_SQL.replace(
        "select o_orderkey, run_id, mode, id, ranked, expect_any from v_per_query",
        "select o_orderkey, run_id, concat(mode, '/', view) as mode, id, ranked, expect_any from base",
    )
    + f""" select split_part(mode, '/', 1) as mode, split_part(mode, '/', 2) as view,
      case when grouping(lang) = 1 then 'all' else lang end as lang, count(*) as n, {MEANS_SQL}
      from m group by grouping sets ((mode, lang), (mode))""",
)
def _(t):
    pq = t.per_query.withColumn("ranked_assets", F.col("ranked"))
    out = scoring.mode_view_metrics(pq, ["mode"])
    return out.select("mode", "view", "lang", "n", *[r6(m).alias(m) for m in METRIC_LIST])


@register(
    "metrics_report",
    "v_per_query",
    f"""with {SPLIT_SQL}
    select run_id, 0 as ord, '### ' || run_id as line from split where lang = 'all'
    union all select run_id, 1, '' from split where lang = 'all'
    union all select run_id, 2, '| lang | n | {' | '.join(METRIC_LIST)} |' from split where lang = 'all'
    union all select run_id, 3, '|' || repeat('---|', 7) from split where lang = 'all'
    union all select run_id, 3 + list_position(['all', 'zh', 'en', 'other'], lang),
      concat('| ', lang, ' | ', n, {", ".join(f"' | ', printf('%.3f', {m})" for m in METRIC_LIST)}, ' |') from split""",
)
def _(t):
    return scoring.metrics_report(split_metrics(t)).select("run_id", big("ord", "ord"), "line")


# --- I: separation ---------------------------------------------------------


@register(
    "top1_score",
    "v_scored",
    """select run_id, pos, case when pos % 4 = 0 then round(score, 6) when pos % 4 = 1 then coalesce(round(score, 6), 7.0)
         when pos % 4 = 2 then round(score, 6) else 0.25 end as score from v_scored""",
)
def _(t):
    score = F.coalesce(F.round("score", 6).cast("string"), F.lit("null"))
    raw = (
        F.when(F.col("pos") % 4 == 0, F.concat(F.lit('{"top1_score": '), score, F.lit("}")))
        .when(F.col("pos") % 4 == 1, F.concat(F.lit('{"top_score": true, "max_score": '), score, F.lit(', "scores": [7, 1]}')))
        .when(F.col("pos") % 4 == 2, F.concat(F.lit('{"top1_score": "0.9", "scores": ["x"], "hit_scores": ['), score, F.lit("]}")))
        .otherwise('{"scores": [], "ranked_scores": [true], "doc_scores": [0.25, 1]}')
    )
    return t.scored.select("run_id", "pos", sep.top1_score(F.parse_json(raw)).alias("score"))


@register(
    "score_summary",
    "v_scored",
    """select run_id, negative, count(score) as n, round(avg(score), 6) as mean, round(median(score), 6) as median,
       round(min(score), 6) as min, round(max(score), 6) as max from v_scored group by run_id, negative having count(score) > 0""",
)
def _(t):
    out = sep.score_summary(t.scored, ["run_id", "negative"])
    return out.select("run_id", "negative", "n", *[r6(c).alias(c) for c in ("mean", "median", "min", "max")])


@register(
    "expect_none_satisfaction",
    "v_scored",
    """select run_id, round(avg(case when score < 0.5 then 1.0 when score >= 0.5 then 0.0 end), 6) as satisfied
       from v_scored where negative group by run_id""",
)
def _(t):
    out = sep.expect_none_satisfaction(t.scored.where("negative"), F.lit(0.5))
    return out.select("run_id", r6("expect_none_satisfaction").alias("satisfied"))


def _sides(t):
    scored = t.scored.withColumn("ranked", F.array("top_doc"))
    return scored.where("not negative"), scored.where("negative")


@register(
    "leak_sample",
    "v_scored",
    """select run_id, pos, q, top_doc as top_stem from v_scored where negative
       qualify row_number() over (partition by run_id order by pos) <= 5""",
)
def _(t):
    return sep.leak_sample(_sides(t)[1])


SEPARATION_SQL = """
s as (select run_id, count(*) filter (where not negative) as positives, count(*) filter (where negative) as negatives,
  avg(score) filter (where not negative) as pos_mean, median(score) filter (where not negative) as pos_median,
  min(score) filter (where not negative) as pos_min, max(score) filter (where not negative) as pos_max,
  avg(score) filter (where negative) as neg_mean, median(score) filter (where negative) as neg_median,
  min(score) filter (where negative) as neg_min, max(score) filter (where negative) as neg_max from v_scored group by run_id),
c as (select *, pos_mean is not null and neg_mean is not null as scores_available, (pos_mean + neg_mean) / 2 as cutoff from s),
x as (select c.run_id, avg(case when v.score < c.cutoff then 1.0 when v.score >= c.cutoff then 0.0 end) as share
  from c join v_scored v on v.run_id = c.run_id and v.negative group by c.run_id)"""


@register(
    "separation",
    "v_scored",
    f"""with {SEPARATION_SQL}
    select c.run_id, positives, negatives, scores_available, {", ".join(f"round({s}_{k}, 6) as {s}_{k}" for s in ("pos", "neg") for k in ("mean", "median", "min", "max"))},
      round(pos_mean - neg_mean, 6) as separation_margin, round(cutoff, 6) as cutoff, round(share, 6) as expect_none_satisfaction
    from c left join x on x.run_id = c.run_id""",
)
def separation_query(t):
    pos, neg = _sides(t)
    out = sep.separation(pos, neg)
    nums = [f"{s}_{k}" for s in ("pos", "neg") for k in ("mean", "median", "min", "max")]
    nums += ["separation_margin", "cutoff", "expect_none_satisfaction"]
    return out.select("run_id", "positives", "negatives", "scores_available", *[r6(c).alias(c) for c in nums])


@register(
    "separation_report",
    "v_scored",
    f"""with {SEPARATION_SQL}, j as (select c.*, share from c left join x on x.run_id = c.run_id)
    select run_id, 0 as ord, '### ' || run_id || ' — negatives separation' as line from j
    union all select run_id, 1, '' from j
    union all select run_id, 2, printf('- positives: %d  negatives: %d', positives, negatives) from j
    union all select run_id, 3, printf('- positive top-1 score: mean %.4f (min %.4f)', pos_mean, pos_min) from j where scores_available
    union all select run_id, 4, printf('- negative top-1 score: mean %.4f (max %.4f)', neg_mean, neg_max) from j where scores_available
    union all select run_id, 5, printf('- **separation margin**: %.4f', pos_mean - neg_mean) from j where scores_available
    union all select run_id, 6, printf('- expect_none satisfaction @ cutoff %.4f: %.3f', cutoff, share) from j where scores_available
    union all select run_id, 3, '- **scores unavailable** — {sep.NO_SCORES}' from j where not scores_available""",
)
def _(t):
    return sep.separation_report(sep.separation(*_sides(t))).select("run_id", big("ord", "ord"), "line")


# --- J: gates --------------------------------------------------------------


def _measured(t):
    return scoring.aggregate_metrics(t.per_query.withColumn("dataset", F.regexp_replace("run_id", "run-", "src")), ["run_id", "dataset"])


MEASURED_SQL = QUERY_METRICS_SQL + """,
measured as (unpivot (select run_id, replace(run_id, 'run-', 'src') as dataset, avg(hit_at_3) as hit_at_3, avg(hit_at_10) as hit_at_10,
  avg(mrr) as mrr, avg(ndcg_at_10) as ndcg_at_10, avg(recall_at_100) as recall_at_100 from m group by run_id)
  on hit_at_3, hit_at_10, mrr, ndcg_at_10, recall_at_100 into name metric value value)"""
GATE_SQL = MEASURED_SQL + """,
wanted as (select split_part(dataset, '-', 1) as dataset, key as metric, value as threshold from v_thresholds),
gate as (select r.run_id, r.dataset, w.metric, m2.value, w.threshold, coalesce(m2.value >= w.threshold, false) as ok
  from (select distinct run_id, dataset from measured) r join wanted w on w.dataset = r.dataset
  left join measured m2 on m2.run_id = r.run_id and m2.metric = w.metric)"""


def _gate(t):
    thresholds = t.thresholds.withColumn("dataset", F.substring_index("dataset", "-", 1))
    return gates.threshold_gate(_measured(t), thresholds)


@register("threshold_gate", "v_per_query v_thresholds", f"with {GATE_SQL} select run_id, dataset, metric, round(value, 6) as value, round(threshold, 6) as threshold, ok from gate")
def _(t):
    return _gate(t).select("run_id", "dataset", "metric", r6("value").alias("value"), r6("threshold").alias("threshold"), "ok")


@register(
    "gate_verdict",
    "v_per_query v_thresholds",
    f"""with {GATE_SQL} select m3.run_id, m3.dataset, coalesce(bool_and(ok), true) as passed, case when coalesce(bool_and(ok), true) then 0 else 1 end as exit_code
    from (select distinct run_id, dataset from measured) m3 left join gate g on g.run_id = m3.run_id group by m3.run_id, m3.dataset""",
)
def _(t):
    return gates.gate_verdict(_gate(t), _measured(t))


@register(
    "baseline_regression",
    "v_per_query",
    f"""with {MEASURED_SQL}, b as (select metric, avg(value) as baseline from measured group by metric)
    select m4.run_id, m4.metric, round(value, 6) as value, round(baseline, 6) as baseline, round(value - baseline, 6) as delta, value - baseline < -0.005 as regressed
    from measured m4 join b on b.metric = m4.metric""",
)
def _(t):
    long = gates.long_metrics(_measured(t), ["run_id"])
    mean = long.groupBy("metric").agg(F.avg("value").alias("value"))
    base = long.select("run_id", "metric").join(mean, "metric")
    out = gates.baseline_regression(long, base, 0.005, ["run_id"])
    return out.select("run_id", "metric", *[r6(c).alias(c) for c in ("value", "baseline", "delta")], "regressed")


@register(
    "calibrate_thresholds",
    "v_per_query",
    f"""with {MEASURED_SQL} select run_id, metric, round(greatest(round(value - case when metric in ('ndcg_at_10', 'recall_at_100') then 0.03 else 0.05 end, 9), 0), 2) as threshold from measured""",
)
def _(t):
    return gates.calibrate_thresholds(gates.long_metrics(_measured(t), ["run_id"])).select("run_id", "metric", "threshold")


@register(
    "summarize_runs",
    "v_runs",
    """select dataset, case when bool_or(exit_code = 2) then 2 when bool_or(exit_code <> 0) then 1 else 0 end as worst_exit_code,
      count(*) as n_total, count(*) filter (where exit_code = 0) as n_passed, count(*) filter (where exit_code <> 0) as n_failed,
      bool_and(exit_code = 0) as passed from v_runs group by dataset""",
)
def _(t):
    return gates.summarize_runs(t.runs, ["dataset"])


VARIANTS = [{}, {"rrf_k": "30"}, {"w_vec": "1.0", "w_bm25": "1.0"}]
BASE_SETTINGS = {"rrf_k": "60", "w_bm25": "0.3"}


@register(
    "variant_grid",
    "v_datasets",
    """select dataset, v.ord, v.label, v.settings from v_datasets, (values (0, 'baseline', 'rrf_k=60,w_bm25=0.3'), (1, 'rrf_k=30', 'rrf_k=30,w_bm25=0.3'),
      (2, 'w_bm25=1.0,w_vec=1.0', 'rrf_k=60,w_bm25=1.0,w_vec=1.0')) v(ord, label, settings)""",
)
def _(t):
    grid = gates.variant_grid(t.datasets, VARIANTS, BASE_SETTINGS)
    return grid.select("dataset", big("ord", "ord"), "label", K.variant_label(F.col("settings")).alias("settings"))


@register(
    "ablation_table",
    "v_per_query",
    f"""with {QUERY_METRICS_SQL}, a as (select run_id as label, cast(max(case when mode = 'bm25' then 1 else 0 end) as int) as exit_code, avg(hit_at_3) as hit_at_3, avg(mrr) as mrr from m group by run_id)
    select label, exit_code, printf('%.3f', hit_at_3) as hit_at_3, '-' as hit_at_10, printf('%.3f', mrr) as mrr, '-' as ndcg_at_10, '-' as recall_at_100,
      concat('| ', label, ' | ', exit_code, ' | ', printf('%.3f', hit_at_3), ' | - | ', printf('%.3f', mrr), ' | - | - |') as line from a""",
)
def _(t):
    rows = t.per_query.groupBy("run_id").agg(
        F.max((F.col("mode") == "bm25").cast("int")).alias("exit_code"),
        F.avg(R.hit_at_k(F.col("ranked"), F.col("expect_any"), 3)).alias("h"),
        F.avg(R.reciprocal_rank(F.col("ranked"), F.col("expect_any"))).alias("r"),
    )
    metrics = F.create_map(F.lit("hit_at_3"), F.col("h"), F.lit("mrr"), F.col("r"))
    table = gates.ablation_table(rows.select(F.col("run_id").alias("label"), "exit_code", metrics.alias("metrics")))
    return gates.ablation_lines(table)


@register(
    "baseline_log_check",
    "v_added v_headers v_changed",
    r"""with touching as (select distinct change_id from v_changed where starts_with(path, 'datasets/')),
    fresh as (select distinct change_id from v_added a where regexp_matches(text, '^##\s+(\d{4}-\d{2}-\d{2}|\d+\.\d+\.\d+)\b')
      and not exists (select 1 from v_headers h where h.change_id = a.change_id and h.header = trim(a.text))),
    measured as (select distinct change_id from v_added where regexp_matches(lower(text), 'ndcg[_@]|hit[_@]|recall[_@]|\bmrr\b'))
    select change_id, 'no new dated or versioned entry header' as violation from touching where change_id not in (select change_id from fresh)
    union all select change_id, 'entry names no retrieval metric' from touching where change_id not in (select change_id from measured)""",
)
def _(t):
    return gates.baseline_log_check(t.added, t.headers, t.changed)


@register(
    "reconcile",
    "v_per_query",
    f"""with {MEASURED_SQL} select run_id, metric, round(value, 6) as recomputed, round(value + case when metric = 'mrr' then 0.001 else 0 end, 6) as reported, metric <> 'mrr' as ok from measured""",
)
def _(t):
    split = scoring.split_metrics(t.per_query)
    reported = gates.long_metrics(_measured(t), ["run_id"]).withColumn(
        "value", F.col("value") + F.when(F.col("metric") == "mrr", 0.001).otherwise(0.0)
    )
    out = gates.reconcile(split, reported)
    return out.select("run_id", "metric", r6("recomputed").alias("recomputed"), r6("reported").alias("reported"), "ok")


# --- A: report streams and listings ----------------------------------------


def _report_lines(t):
    lines = t.report_lines.select("run_id", F.struct("line_no").alias("line_no"), "value")
    return readers.parse_lines(lines)


@register(
    "scan_eval_stream",
    "v_report_lines",
    """select run_id, line_no, contains(value, '"metrics"') as has_metrics from v_report_lines where value <> 'not json'""",
)
def _(t):
    return _report_lines(t).select("run_id", F.col("line_no.line_no").alias("line_no"), J.has_field(F.col("v"), "metrics").alias("has_metrics"))


for _rule, _keep, _order in (
    ("last", "contains(value, '\"passed\"')", "line_no"),
    ("longest", "contains(value, '\"per_query\"')", "(n_rows, line_no)"),
    ("longest_metrics", "contains(value, '\"metrics\"')", "(n_rows, line_no)"),
):

    def _select(t, rule=_rule):
        report = readers.select_report(_report_lines(t), rule)
        return report.select(
            "run_id",
            F.col("line_no.line_no").alias("line_no"),
            big(F.size(J.elements(J.field(F.col("v"), "per_query"))), "n_rows"),
        )

    register(
        f"select_report_{_rule}",
        "v_report_lines",
        f"select run_id, arg_max(line_no, {_order}) as line_no, arg_max(n_rows, {_order}) as n_rows from v_report_lines where {_keep} group by run_id",
    )(_select)


@register(
    "explode_report",
    "v_report_lines v_lines",
    """with best as (select run_id, arg_max(line_no, (n_rows, line_no)) as line_no from v_report_lines where contains(value, '"per_query"') group by run_id)
    select b.run_id, l.rk - 1 as pos, l.doc as id, 0 as n_expect from best b join v_lines l on l.run_id = b.run_id and l.o_orderkey = b.line_no""",
)
def _(t):
    rows = readers.explode_report(readers.select_report(_report_lines(t), "longest"))
    return rows.select("run_id", big("pos", "pos"), "id", F.size("expect_any").alias("n_expect"))


@register("discover_datasets", "v_docs", "select distinct dataset from v_docs where num % 3 <> 0")
def _(t):
    name = F.when(F.col("num") % 3 == 0, "readme.md").otherwise("dataset.yaml")
    files = t.docs.select(F.concat_ws("/", F.lit("/data"), "dataset", name).alias("path"))
    return readers.discover_datasets(files)


@register(
    "preferred_source",
    "v_candidate_lines",
    """select dataset, line_no, source from v_candidate_lines c where value <> 'not json' and (source = 'direct'
      or not exists (select 1 from v_candidate_lines d where d.dataset = c.dataset and d.source = 'direct' and d.value <> 'not json'))""",
)
def _(t):
    return readers.preferred_source(readers.parse_lines(t.candidate_lines)).select("dataset", "line_no", "source")


# --- B: text features ------------------------------------------------------

BODY_SQL = "case when starts_with(text, '---') and len(string_split(text, '---')) >= 3 then array_to_string(string_split(text, '---')[3:], '---') else text end"
LANG_SQL = r"""case when regexp_extract(text, '(?m)^language:\s*([^\r\n]+)', 1) <> '' then lower(trim(regexp_extract(text, '(?m)^language:\s*([^\r\n]+)', 1)))
  when starts_with(file_name, 'zh-') then 'zh' when starts_with(file_name, 'en-') then 'en' else '' end"""


def words_sql(n: int, text: str = "body") -> str:
    return f"len(list_filter(regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}_]+'), lambda x: regexp_full_match(x, '[A-Za-z]{{{n},}}')))"


@register(
    "corpus_features",
    "v_corpus",
    rf"""with b as (select *, {BODY_SQL} as body from v_corpus)
    select dataset, stem, regexp_matches(file_name, '^(zh|en)-synthetic-\d{{3}}\.md$') as canonical, {LANG_SQL} as language,
      array_to_string(regexp_extract_all(text, '(?m)^##\s+(.+)$', 1), '|') as headings,
      array_to_string(regexp_extract_all(text, '(?m)^Target:\s*(.+)$', 1), '|') as targets,
      len(regexp_extract_all(body, '[\x{{4e00}}-\x{{9fff}}]')) as cjk, {words_sql(4)} as words4, {words_sql(2)} as words2,
      len(string_split(body, chr(10) || '## ')) - 1 as h2, len(text) as chars, strlen(text) as bytes from b""",
)
def _(t):
    f = corpus.corpus_features(t.corpus)
    return f.select(
        "dataset", "stem", "canonical", "language", joined("headings").alias("headings"), joined("target_markers").alias("targets"),
        big("stats.cjk", "cjk"), big("stats.words4", "words4"), big("stats.words2", "words2"), big("stats.h2", "h2"),
        big("chars", "chars"), big("bytes", "bytes"),
    )


@register(
    "front_matter",
    "v_corpus",
    r"""select dataset, stem, case when starts_with(text, '---') then regexp_extract(text, 'title: ([^\n]*)', 1) end as title,
      case when starts_with(text, '---') then regexp_extract(text, 'language: ([^\n]*)', 1) end as language,
      case when starts_with(text, '---') then regexp_extract(text, 'source: ([^\n]*)', 1) end as source from v_corpus""",
)
def _(t):
    fm = t.corpus.select("dataset", "stem", T.front_matter(F.col("text")).alias("m"))
    return fm.select("dataset", "stem", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("title", "language", "source")])


@register("strip_front_matter", "v_corpus", f"select dataset, stem, md5({BODY_SQL}) as body_md5 from v_corpus")
def _(t):
    return t.corpus.select("dataset", "stem", F.md5(T.strip_front_matter(F.col("text"))).alias("body_md5"))


@register(
    "image_refs",
    "v_corpus",
    r"""select dataset, stem, alt, split_part(trim(target), ' ', 1) as path, count(*) as n from (select dataset, stem,
      unnest(regexp_extract_all(text, '!\[([^\]]*)\]\(([^)\n]+)\)', 1)) as alt, unnest(regexp_extract_all(text, '!\[([^\]]*)\]\(([^)\n]+)\)', 2)) as target from v_corpus)
      group by all""",
)
def _(t):
    return corpus.image_rows(t.corpus).groupBy("dataset", "stem", "alt", "path").agg(F.count(F.lit(1)).alias("n"))


SECTIONS_SQL = """
parts as (select dataset, stem, unnest(string_split(text, chr(10) || '## ')[2:]) as part, generate_subscripts(string_split(text, chr(10) || '## ')[2:], 1) as i from v_corpus),
secs as (select dataset, stem, trim(split_part(part, chr(10), 1)) as heading, trim('## ' || part, ' ' || chr(10)) as section_text, i from parts),
last_secs as (select dataset, stem, heading, arg_max(section_text, i) as section_text from secs group by all)"""


@register("sections", "v_corpus", f"with {SECTIONS_SQL} select dataset, stem, heading, md5(section_text) as section_md5 from last_secs")
def _(t):
    return corpus.sections(t.corpus).select("dataset", "stem", "heading", F.md5("section_text").alias("section_md5"))


@register(
    "section_for",
    "v_corpus v_chunks",
    f"""with {SECTIONS_SQL} select c.dataset, c.pos, c.doc, c.heading, md5(coalesce(case when len(section_text) > 4000 then section_text[1:4000] || chr(10) || '...[truncated]'
      else section_text end, '')) as section_md5 from v_chunks c left join last_secs s on s.dataset = c.dataset and s.stem = c.doc and s.heading = c.heading""",
)
def _(t):
    out = corpus.section_for(t.chunks, corpus.sections(t.corpus))
    return out.select("dataset", "pos", "doc", "heading", F.md5("section_text").alias("section_md5"))


@register(
    "stamp_markers",
    "v_corpus",
    r"""with s as (select *, 'docmark' || replace(stem, '-', '') as marker, regexp_matches(file_name, '^(zh|en)-synthetic-\d{3}\.md$') as canonical from v_corpus),
    l as (select *, case when prefix = 'zh' then '检索标记：' || marker || '。' else 'Retrieval marker: ' || marker || '.' end as label from s)
    select dataset, stem, canonical as changed, md5(case when canonical then regexp_replace(text, '(?m)^(# .*)$', concat('\1', chr(10), chr(10), label))
      || case when ends_with(text, chr(10)) then '' else chr(10) end else text end) as text_md5 from l""",
)
def _(t):
    return corpus.stamp_markers(t.corpus).select("dataset", "stem", "changed", F.md5("text").alias("text_md5"))


@register(
    "safe_stem",
    "v_docs",
    r"""with b as (select dataset, n, doc_id, regexp_replace(lower(trim(body)), '[^a-z0-9_-]+', '-', 'g') as s from v_docs)
    select doc_id, md5(case when trim(regexp_replace(s, '-{2,}', '-', 'g'), '-') = '' then 'synthetic-doc' else trim(regexp_replace(s, '-{2,}', '-', 'g'), '-') end) as slug_md5 from b""",
)
def _(t):
    return t.docs.select("doc_id", F.md5(T.safe_stem(F.col("body"))).alias("slug_md5"))


@register(
    "markdown_blocks",
    "v_corpus",
    r"""with l as (select dataset, stem, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no from v_corpus),
    r as (select *, rtrim(raw) as line from l where rtrim(raw) <> '')
    select dataset, stem, line_no, case when regexp_full_match(trim(line), '!\[([^\]]*)\]\(([^)\n]+)\)') then 'image' when starts_with(line, '### ') then 'h3'
      when starts_with(line, '## ') then 'h2' when starts_with(line, '# ') then 'h1' when starts_with(line, 'Target: ') then 'target' else 'paragraph' end as kind,
      md5(case when regexp_full_match(trim(line), '!\[([^\]]*)\]\(([^)\n]+)\)') then regexp_extract(line, '!\[([^\]]*)\]', 1) when starts_with(line, '### ') then line[5:]
      when starts_with(line, '## ') then line[4:] when starts_with(line, '# ') then line[3:] else line end) as content_md5 from r""",
)
def _(t):
    return corpus.markdown_blocks(t.corpus).select("dataset", "stem", big("line_no", "line_no"), "kind", F.md5("content").alias("content_md5"))


@register(
    "coerce_string_list",
    "v_turns",
    """select line_no, case line_no % 4 when 0 then concat('a', line_no, '|b') when 1 then concat('x', line_no, '|3') when 2 then '' else '' end as listed from v_turns""",
)
def _(t):
    n = F.col("line_no")
    raw = (
        F.when(n % 4 == 0, F.concat(F.lit('"[a'), n, F.lit(", 'b' ,]\"")))
        .when(n % 4 == 1, F.concat(F.lit('[" x'), n, F.lit(' ", "", 3]')))
        .when(n % 4 == 2, "null")
        .otherwise('{"a": 1}')
    )
    return t.turns.select("line_no", joined(J.coerce_string_list(F.parse_json(raw))).alias("listed"))


@register(
    "extract_json_text",
    "v_responses",
    """select dataset, task_no, md5(case task_no % 6 when 0 then concat('{"t": ', task_no, '}') when 1 then concat('[', task_no, ', 2]') when 3 then trim(raw, ' ' || chr(10))
      when 4 then trim(raw) else raw end) as json_md5 from v_responses""",
)
def _(t):
    return t.responses.select("dataset", "task_no", F.md5(J.extract_json_text(F.col("raw"))).alias("json_md5"))


@register(
    "parse_model_json",
    "v_responses",
    """select dataset, task_no, case task_no % 6 when 0 then concat('{"t":', task_no, '}') when 1 then concat('[', task_no, ',2]') when 4 then concat('{"a":{"b":', task_no, '}}') end as value,
      case task_no % 6 when 2 then 'JSON parse failed' when 3 then 'JSON parse failed' when 5 then 'JSON root must be an object or array' end as error from v_responses""",
)
def _(t):
    p = t.responses.select("dataset", "task_no", J.parse_model_json(F.col("raw")).alias("p"))
    return p.select("dataset", "task_no", F.to_json("p.v").alias("value"), F.col("p.error").alias("error"))


@register("language_counts", "v_corpus", f"""select dataset, count(*) filter (where starts_with({LANG_SQL}, 'zh')) as zh, count(*) filter (where starts_with({LANG_SQL}, 'en')) as en from v_corpus group by dataset""")
def _(t):
    return corpus.language_counts(t.corpus)


@register("corpus_listing", "v_corpus", "select dataset, file_name, strlen(text) as bytes from v_corpus")
def _(t):
    return corpus.corpus_listing(t.corpus).select("dataset", "file_name", big("bytes", "bytes"))


@register(
    "tokenize",
    "v_corpus",
    r"""with runs as (select dataset, stem, unnest(regexp_extract_all(lower(text), '[\x{4e00}-\x{9fff}]+|[\p{L}\p{N}_]+')) as run from v_corpus),
    toks as (select dataset, stem, unnest(case when regexp_full_match(run, '[\x{4e00}-\x{9fff}]{2,}') then list_transform(range(1, len(run)), lambda i: run[i:i+1]) else [run] end) as tok from runs)
    select dataset, stem, count(*) as n, count(distinct tok) as n_distinct, min(tok) as first_tok, max(tok) as last_tok from toks group by dataset, stem""",
)
def _(t):
    toks = t.corpus.select("dataset", "stem", T.tokenize(F.col("text")).alias("k"))
    return toks.select(
        "dataset", "stem", big(F.size("k"), "n"), big(F.size(F.array_distinct("k")), "n_distinct"),
        F.array_min("k").alias("first_tok"), F.array_max("k").alias("last_tok"),
    )


PACK_PART = 20
PACK_SQL = f"""n as (select *, (row_number() over (partition by dataset order by file_name) - 1) // {PACK_PART} as part from v_corpus),
packs as (select dataset, part, max(max(part)) over (partition by dataset) + 1 as parts,
  string_agg(concat(chr(10), chr(10), '# STEM: ', stem, chr(10), text), '' order by file_name) as pack from n group by dataset, part)"""


@register(
    "corpus_pack",
    "v_corpus",
    f"with {PACK_SQL} select dataset, part, parts, md5(pack) as pack_md5 from packs",
)
def _(t):
    packs = corpus.assemble_packs(corpus.corpus_pack(t.corpus), PACK_PART)
    return packs.select("dataset", big("part", "part"), big("parts", "parts"), F.md5("pack").alias("pack_md5"))


@register(
    "corpus_pack_whole",
    "v_corpus",
    """with n as (select (row_number() over (order by file_name || '@' || dataset) - 1) // 1000 as part, file_name || '@' || dataset as f, stem, text from v_corpus)
    select part, (select max(part) + 1 from n) as parts, md5(string_agg(concat(chr(10), chr(10), '# STEM: ', stem, chr(10), text), '' order by f)) as pack_md5 from n group by part""",
)
def _(t):
    """All documents as one dataset: more than one part, none left out."""
    path = F.concat("file_name", F.lit("@"), "dataset").alias("file_name")
    whole = t.corpus.select(F.lit("all").alias("dataset"), path, "stem", "text")
    packs = corpus.assemble_packs(corpus.corpus_pack(whole))
    return packs.select(big("part", "part"), big("parts", "parts"), F.md5("pack").alias("pack_md5"))


@register(
    "corpus_pack_pieces",
    "v_corpus",
    "select dataset, row_number() over (partition by dataset order by file_name) - 1 as ord, stem, len(stem) + len(text) + 11 as piece_chars from v_corpus",
)
def _(t):
    return corpus.corpus_pack(t.corpus).select("dataset", big("ord", "ord"), "stem", big(F.length("piece"), "piece_chars"))


# --- C: quality ------------------------------------------------------------

REASONS_SQL = rf"""
b as (select *, {BODY_SQL} as body from v_corpus),
f as (select *, len(regexp_extract_all(body, '[\x{{4e00}}-\x{{9fff}}]')) as cjk, {words_sql(4)} as w4, {words_sql(2)} as w2,
  regexp_matches(file_name, '^(zh|en)-synthetic-\d{{3}}\.md$') as canonical from b),
reasons as (select dataset, stem, file_name, canonical, text, array_to_string(list_filter([
  case when not canonical then 'noncanonical_filename' end,
  case when trim(text, ' ' || chr(10)) = '' then 'empty' end,
  case when not starts_with(ltrim(text, ' ' || chr(10)), '---') then 'missing_frontmatter' end,
  'prompt_leak:' || list_filter([{", ".join("'" + p.replace("'", "''") + "'" for p in quality.LEAK_PATTERNS)}], lambda p: contains(text, p))[1],
  case when starts_with(file_name, 'zh-') and cjk < 180 then 'too_few_chinese_chars' end,
  case when starts_with(file_name, 'zh-') and w4 > cjk * 0.18 then 'too_much_english_in_zh_doc' end,
  case when starts_with(file_name, 'en-') and w2 < 120 then 'too_few_english_words' end,
  case when not contains(body, chr(10) || '## ') then 'missing_section_heading' end], lambda x: x is not null), '|') as reasons from f)"""


@register("quality_reasons", "v_corpus", f"with {REASONS_SQL} select dataset, file_name, reasons from reasons")
def _(t):
    return quality.quality_reasons(t.corpus).select("dataset", "file_name", joined("reasons").alias("reasons"))


@register("audit_corpus", "v_corpus", f"with {REASONS_SQL} select dataset, count(*) as total, count(*) filter (where canonical) as canonical, count(*) filter (where reasons <> '') as bad from reasons group by dataset")
def _(t):
    return quality.audit_corpus(t.corpus)


@register("bad_files", "v_corpus", f"with {REASONS_SQL} select dataset, file_name, reasons from reasons where reasons <> ''")
def _(t):
    return quality.bad_files(t.corpus).select("dataset", "file_name", joined("reasons").alias("reasons"))


@register("split_clean", "v_corpus", f"with {REASONS_SQL} select dataset, stem, reasons = '' as clean from reasons")
def _(t):
    clean, bad = quality.split_clean(t.corpus)
    return clean.select("dataset", "stem", F.lit(True).alias("clean")).unionByName(bad.select("dataset", "stem", F.lit(False).alias("clean")))


GRID = 1000
GRID_SQL = f"""grid as (select d.dataset, i as idx, case when i % 2 = 1 then 'zh' else 'en' end as lang,
  case when i % 2 = 1 then 'zh' else 'en' end || '-synthetic-' || lpad(cast(i as varchar), case when i < 1000 then 3 else 4 end, '0') as stem
  from (select distinct dataset from v_corpus) d, range(1, {GRID + 1}) r(i))"""


@register("missing_documents", "v_corpus", f"with {GRID_SQL} select dataset, idx, lang, stem from grid g where not exists (select 1 from v_corpus c where c.dataset = g.dataset and c.stem = g.stem)")
def _(t):
    return quality.missing_documents(t.corpus, GRID).select("dataset", big("idx", "idx"), "lang", "stem")


TEMPLATES = {
    "zh": "---\ntitle: 文档 {index}\nlanguage: zh\n---\n\n# 文档 {index}\n\n## 概念\n\n" + "本文讨论{concept}，并比较{left}与{right}，常见问题是{failure}。" * 8 + "\n",
    "en": "---\ntitle: Note {index}\nlanguage: en\n---\n\n# Note {index}\n\n## Concept\n\n" + "This note covers {concept} and weighs {left} against {right} while watching for {failure}. " * 12 + "\n",
}
CONCEPTS = [("切分", "chunking"), ("召回", "recall"), ("向量", "vectors")]
TRADEOFFS = [("速度", "质量", "speed", "quality"), ("成本", "覆盖", "cost", "coverage")]
FAILURES = [("漂移", "drift"), ("过期", "staleness"), ("混淆", "confusion"), ("重复", "repetition"), ("缺失", "gaps")]


def _template_sql() -> str:
    def listed(values):
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    def pick(zh, en, n):
        return f"case when lang = 'zh' then {listed(zh)}[idx % {n} + 1] else {listed(en)}[idx % {n} + 1] end"

    out = "case when lang = 'zh' then '{}' else '{}' end".format(TEMPLATES["zh"], TEMPLATES["en"])
    for name, value in {
        "{index}": "lpad(cast(idx as varchar), case when idx < 1000 then 3 else 4 end, '0')",
        "{concept}": pick([c[0] for c in CONCEPTS], [c[1] for c in CONCEPTS], 3),
        "{left}": pick([c[0] for c in TRADEOFFS], [c[2] for c in TRADEOFFS], 2),
        "{right}": pick([c[1] for c in TRADEOFFS], [c[3] for c in TRADEOFFS], 2),
        "{failure}": pick([c[0] for c in FAILURES], [c[1] for c in FAILURES], 5),
    }.items():
        out = f"replace({out}, '{name}', {value})"
    return out


def _rendered(t):
    grid = quality.expected_grid(t.corpus.select("dataset").distinct(), GRID)
    return quality.render_template(grid, TEMPLATES, CONCEPTS, TRADEOFFS, FAILURES)


@register("render_template", "v_corpus", f"with {GRID_SQL} select dataset, stem, md5({_template_sql()}) as text_md5 from grid")
def _(t):
    return _rendered(t).select("dataset", "stem", F.md5("text").alias("text_md5"))


REPAIR_SQL = f"""{REASONS_SQL}, {GRID_SQL}, slots as (select dataset, stem, {_template_sql()} as new_text from grid),
kept as (select * from reasons where canonical),
merged as (select coalesce(k.dataset, s.dataset) as dataset, coalesce(k.stem, s.stem) as stem, new_text is not null and (k.stem is null or reasons <> '') as replaced,
  case when new_text is not null and (k.stem is null or reasons <> '') then new_text else text end as text
  from kept k full join slots s on s.dataset = k.dataset and s.stem = k.stem)"""


@register("repair_corpus", "v_corpus", f"with {REPAIR_SQL} select dataset, stem, replaced, md5(text) as text_md5 from merged")
def _(t):
    merged, _, _ = quality.repair_corpus(t.corpus, _rendered(t))
    return merged.select("dataset", "stem", "replaced", F.md5("text").alias("text_md5"))


@register(
    "repair_counts",
    "v_corpus",
    f"""with {REPAIR_SQL}, mv as (select dataset, count(*) as moved from reasons where not canonical group by dataset)
    select m.dataset, coalesce(max(mv.moved), 0) as moved, count(*) filter (where replaced) as repaired, count(*) as total from merged m left join mv on mv.dataset = m.dataset group by m.dataset""",
)
def _(t):
    return quality.repair_corpus(t.corpus, _rendered(t))[2].select("dataset", "moved", "repaired", "total")


# --- D: integrity ----------------------------------------------------------


def _package(t) -> validate.Package:
    return validate.Package(
        # One row per package, read by every check.
        datasets=t.datasets.persist(),
        thresholds=t.thresholds,
        queries=t.queries,
        assets=t.assets,
        chunks=t.chunks,
        corpus=t.corpus.select("dataset", "stem", "file_name", "text"),
        asset_files=t.asset_files,
    )


PKG_VIEWS = "v_datasets v_thresholds v_queries v_assets v_chunks v_corpus v_asset_files"
BASE_SQL = """
live as (select * from v_datasets where has_corpus),
tgt as (select * from live where has_targets),
a as (select x.*, c.text, c.stem is not null as found from v_assets x join tgt on tgt.dataset = x.dataset left join v_corpus c on c.dataset = x.dataset and c.stem = x.doc),
c as (select x.*, c.text, c.stem is not null as found, coalesce(asset_id, '') <> '' as one from v_chunks x join tgt on tgt.dataset = x.dataset left join v_corpus c on c.dataset = x.dataset and c.stem = x.doc),
q as (select x.*, expect_any_kind <> 'absent' as has_any from v_queries x join live l on l.dataset = x.dataset and l.has_queries),
good_assets as (select distinct dataset, id from a where is_mapping and id <> ''),
good_chunks as (select distinct dataset, id from c where is_mapping and id <> ''),
refs as (select dataset, pos, unnest(case when one then [asset_id] else asset_ids end) as item from c where is_mapping and found and one <> (asset_ids_kind = 'list')),
images as (select c.dataset, c.file_name, split_part(trim(unnest(regexp_extract_all(text, '!\\[[^\\]]*\\]\\(([^)\\n]+)\\)', 1))), ' ', 1) as path from v_corpus c join live l on l.dataset = c.dataset)""".replace("\\\\", "\\")


def _hash(n: str) -> str:
    return f"{n} #' || pos || '"


CHECK_SQL = {
    "presence": """select dataset, 'missing_meta' as code, 'missing dataset.yaml' as message from v_datasets where not has_meta
      union all select dataset, 'missing_queries', 'missing queries.yaml' from v_datasets where not has_queries
      union all select dataset, 'missing_corpus', 'missing corpus/' from v_datasets where not has_corpus""",
    "empty_corpus": "select dataset, 'empty_corpus' as code, 'corpus/ has no markdown files' as message from live where dataset not in (select dataset from v_corpus)",
    "target_lists": """select dataset, 'no_assets' as code, 'targets.yaml must contain non-empty assets list' as message from tgt where dataset not in (select dataset from v_assets)
      union all select dataset, 'no_chunks', 'targets.yaml must contain non-empty chunks list' from tgt where dataset not in (select dataset from v_chunks)""",
    "asset_fields": f"""select dataset, 'asset_not_mapping' as code, '{_hash("asset target")} must be a mapping' as message from a where not is_mapping
      union all select dataset, 'asset_empty_id', '{_hash("asset target")} has empty id' from a where is_mapping and id = ''
      union all select dataset, 'asset_empty_path', '{_hash("asset target")} has empty path' from a where is_mapping and path = ''
      union all select dataset, 'asset_empty_heading', '{_hash("asset target")} has empty heading' from a where is_mapping and heading = ''""",
    "asset_documents": f"""select dataset, 'asset_missing_doc' as code, '{_hash("asset target")} references missing doc: ' || doc as message from a where is_mapping and not found
      union all select dataset, 'asset_heading_not_found', '{_hash("asset target")} heading not found in ' || doc || '.md: ' || heading from a where is_mapping and found and heading <> '' and not contains(text, '## ' || heading)""",
    "asset_files": f"""select dataset, 'asset_missing_file' as code, '{_hash("asset target")} references missing file: ' || path as message from a where is_mapping and path <> ''
      and not exists (select 1 from v_asset_files f where f.dataset = a.dataset and f.path = replace(a.path, './', ''))""",
    "chunk_fields": f"""select dataset, 'chunk_not_mapping' as code, '{_hash("chunk target")} must be a mapping' as message from c where not is_mapping
      union all select dataset, 'chunk_empty_id', '{_hash("chunk target")} has empty id' from c where is_mapping and id = ''""",
    "chunk_documents": f"""select dataset, 'chunk_missing_doc' as code, '{_hash("chunk target")} references missing doc: ' || doc as message from c where is_mapping and not found
      union all select dataset, 'chunk_empty_heading', '{_hash("chunk target")} has empty heading' from c where is_mapping and found and heading = ''
      union all select dataset, 'chunk_heading_not_found', '{_hash("chunk target")} heading not found in ' || doc || '.md: ' || heading from c where is_mapping and found and heading <> '' and not contains(text, '## ' || heading)
      union all select dataset, 'chunk_empty_anchor', '{_hash("chunk target")} has empty anchor' from c where is_mapping and found and anchor = ''
      union all select dataset, 'chunk_anchor_not_found', '{_hash("chunk target")} anchor not found in ' || doc || '.md: ' || anchor from c where is_mapping and found and anchor <> '' and not contains(text, 'Target: ' || anchor)
      union all select dataset, 'chunk_both_asset_fields', '{_hash("chunk target")} must not set both asset_id and asset_ids' from c where is_mapping and found and one and asset_ids_kind = 'list'
      union all select dataset, 'chunk_asset_ids_not_list', '{_hash("chunk target")} asset_ids must be a non-empty list' from c where is_mapping and found and not one and asset_ids_kind = 'bad'
      union all select dataset, 'chunk_empty_asset_id', '{_hash("chunk target")} has empty asset_id' from c where is_mapping and found and not one and asset_ids_kind = 'absent'""",
    "chunk_assets": f"""select dataset, 'chunk_empty_asset_ref' as code, '{_hash("chunk target")} asset_ids contains empty id' as message from refs where item = ''
      union all select dataset, 'chunk_missing_asset', '{_hash("chunk target")} references missing asset target: ' || item from refs r where item <> ''
        and dataset in (select dataset from good_assets) and not exists (select 1 from good_assets g where g.dataset = r.dataset and g.id = r.item)""",
    "images": """select dataset, 'image_remote' as code, file_name || ' uses remote image reference: ' || path as message from images where starts_with(path, 'http')
      union all select dataset, 'image_missing', file_name || ' references missing image: ' || path from images i where not starts_with(path, 'http')
        and not exists (select 1 from v_asset_files f where f.dataset = i.dataset and f.path = replace(i.path, './', ''))""",
    "thresholds": """select t.dataset, 'threshold_unknown' as code, 'unknown threshold key: ' || key as message from v_thresholds t join live on live.dataset = t.dataset and has_meta where key = 'precision'
      union all select t.dataset, 'threshold_not_numeric', 'threshold ' || key || ' must be numeric' from v_thresholds t join live on live.dataset = t.dataset and has_meta where not numeric""",
    "query_fields": f"""select dataset, 'query_not_mapping' as code, '{_hash("query")} must be a mapping' as message from q where not is_mapping
      union all select dataset, 'query_empty_id', '{_hash("query")} has empty id' from q where is_mapping and trim(id) = ''
      union all select dataset, 'query_empty_q', '{_hash("query")} has empty q' from q where is_mapping and trim(q) = ''
      union all select dataset, 'query_both', '{_hash("query")} has both expect_any and expect_none' from q where is_mapping and has_any and expect_none
      union all select dataset, 'query_neither', '{_hash("query")} must set expect_any or expect_none' from q where is_mapping and not has_any and not expect_none
      union all select dataset, 'query_expect_not_list', '{_hash("query")} expect_any must be a list' from q where is_mapping and expect_any_kind = 'other'
      union all select dataset, 'query_asset_not_list', '{_hash("query")} expect_asset_any must be a non-empty list' from q where is_mapping and expect_asset_kind = 'bad'
      union all select dataset, 'query_chunk_not_list', '{_hash("query")} expect_chunk_any must be a non-empty list' from q where is_mapping and expect_chunk_kind = 'bad'
      union all select dataset, 'no_queries', 'queries.yaml must contain non-empty queries list' from live where has_queries and dataset not in (select dataset from v_queries)""",
    "query_duplicates": """select dataset, 'query_duplicate_id' as code, 'duplicate query id: ' || id as message from q where is_mapping and trim(id) <> '' qualify row_number() over (partition by dataset, id order by pos) > 1
      union all select dataset, 'query_duplicate_text', 'duplicate query text: ' || q from (select dataset, pos, q as q from q where is_mapping and trim(q) <> '' qualify row_number() over (partition by dataset, q order by pos) > 1)""",
    "query_references": f"""select x.dataset, 'query_missing_' || split_part(what, ' ', 1) as code, '{_hash("query")} references missing ' || what || ': ' || item as message from (
        select dataset, pos, 'stem' as what, unnest(expect_any) as item from q where is_mapping and expect_any_kind = 'list'
        union all select dataset, pos, 'asset target', unnest(expect_asset_any) from q where is_mapping and expect_asset_kind = 'list' and dataset in (select dataset from tgt)
        union all select dataset, pos, 'chunk target', unnest(expect_chunk_any) from q where is_mapping and expect_chunk_kind = 'list' and dataset in (select dataset from tgt)) x
      where not exists (select 1 from (select dataset, 'stem' as what, stem as item from v_corpus union all select dataset, 'asset target', id from good_assets
        union all select dataset, 'chunk target', id from good_chunks) k where k.dataset = x.dataset and k.what = x.what and k.item = x.item)""",
}
ALL_CHECKS_SQL = " union all ".join(f"select * from ({s})" for s in CHECK_SQL.values())

for _name, _sql in CHECK_SQL.items():

    def _check(t, name=_name):
        return validate.CHECKS[name](_package(t)).select("dataset", "code", "message")

    register(f"check_{_name}", PKG_VIEWS, f"with {BASE_SQL} {_sql}")(_check)


@register("validate_packages", PKG_VIEWS, f"with {BASE_SQL} select dataset, code, count(*) as n, min(message) as first_message from ({ALL_CHECKS_SQL}) group by dataset, code")
def _(t):
    out = validate.validate_packages(_package(t))
    return out.groupBy("dataset", "code").agg(F.count(F.lit(1)).alias("n"), F.min("message").alias("first_message"))


@register(
    "package_verdict",
    PKG_VIEWS,
    f"""with {BASE_SQL}, v as (select dataset, count(*) as n from ({ALL_CHECKS_SQL}) group by dataset)
    select d.dataset, coalesce(v.n, 0) as n_violations, coalesce(v.n, 0) = 0 as valid from v_datasets d left join v on v.dataset = d.dataset""",
)
def _(t):
    return validate.package_verdict(_package(t))


@register(
    "coverage_balance",
    "v_corpus v_queries",
    """with gold as (select distinct dataset, unnest(expect_any) as stem from v_queries where not expect_none),
    u as (select c.dataset, count(*) filter (where g.stem is null) as uncovered from v_corpus c left join gold g on g.dataset = c.dataset and g.stem = c.stem group by c.dataset),
    l as (select dataset, count(*) filter (where starts_with(id, 'zh-')) as n_zh, count(*) filter (where starts_with(id, 'en-')) as n_en from v_queries group by dataset)
    select u.dataset, uncovered, n_zh, n_en, abs(n_zh - n_en) <= 0.5 * (n_zh + n_en) as balanced, uncovered = 0 and abs(n_zh - n_en) <= 0.5 * (n_zh + n_en) as accepted from u join l on l.dataset = u.dataset""",
)
def _(t):
    return validate.coverage_balance(t.corpus, t.queries, 0.5)


# --- E: curation -----------------------------------------------------------

CANDIDATES_SQL = """
lines as (select * from v_candidate_lines where value <> 'not json'),
lists as (select dataset, conv_id, turn, line_no, 0 as item, 'list ' || line_no as q, '' as expect, '' as given, '' as evidence, false as expect_none, false as plain from lines where starts_with(value, '[')
  union all select dataset, conv_id, turn, line_no, 2, 'list b ' || line_no, 'a|b', '', '', false, false from lines where starts_with(value, '[')),
direct as (select l.dataset, l.conv_id, l.turn, l.line_no, 0 as item, t.text as q, concat('doc-', l.line_no, '|', case when l.source = 'direct' then 'x' end) as expect,
  case when l.line_no % 3 = 0 then 'cand-' || (l.line_no % 50) else '' end as given, t.role as evidence, false as expect_none, true as plain
  from lines l join v_turns t on t.line_no = l.line_no where l.source = 'direct' and not starts_with(l.value, '[')),
drafted as (select l.dataset, l.conv_id, l.turn, l.line_no, 0 as item, t.text as q, '' as expect, '' as given, '' as evidence, l.turn % 2 = 0 as expect_none, true as plain
  from lines l join v_turns t on t.line_no = l.line_no where l.source = 'audit' and not starts_with(l.value, '[') and l.turn % 3 <> 2 and l.line_no % 5 <> 4),
found as (select * from lists union all select * from direct union all select * from drafted),
named as (select *, case when given <> '' then given else substr(sha1(concat('{"evidence": "', evidence, '", "expect_any": [',
    case when expect = '' then '' else '"' || replace(expect, '|', '", "') || '"' end, '], "q": "', replace(trim(q), chr(10), chr(92) || 'n'), '"}')), 1, 12) end as candidate_id from found),
cands as (select * from named qualify row_number() over (partition by dataset, candidate_id order by line_no, item) = 1),
decided as (select * from v_decision_log qualify row_number() over (partition by dataset, candidate_id order by updated_at desc) = 1)"""


def _lines_of(t):
    return readers.parse_lines(t.candidate_lines.select("dataset", "source", F.struct("line_no").alias("line_no"), "value"))


def _candidates(t):
    return curation.load_candidates(_lines_of(t))


def _decisions(t):
    return curation.upsert_decisions(t.decision_log)


@register("extract_candidates", "v_candidate_lines v_turns", f"""with {CANDIDATES_SQL} select dataset, line_no, item as item_no, md5(trim(q)) as q_md5 from found
  union all select dataset, line_no, 1, md5('') from drafted""")
def _(t):
    raw = curation.extract_candidates(_lines_of(t))
    v = F.col("raw")
    q = F.coalesce(F.try_variant_get(v, "$.q", "string"), F.try_variant_get(v, "$.corrected_q", "string"))
    return raw.select("dataset", F.col("pos.line_no.line_no").alias("line_no"), big("pos.item_no", "item_no"), F.md5(T.strip(q)).alias("q_md5"))


@register("normalize_candidates", "v_candidate_lines v_turns", f"with {CANDIDATES_SQL} select dataset, line_no, item as item_no, candidate_id, md5(trim(q)) as q_md5, expect as expected from named")
def _(t):
    c = curation.normalize_candidates(curation.extract_candidates(_lines_of(t)))
    return c.select("dataset", F.col("pos.line_no.line_no").alias("line_no"), big("pos.item_no", "item_no"), "candidate_id", F.md5("q").alias("q_md5"), joined("expect_any").alias("expected"))


@register("dedup_candidates", "v_candidate_lines v_turns", f"with {CANDIDATES_SQL} select dataset, candidate_id, line_no, md5(trim(q)) as q_md5 from cands")
def _(t):
    return _candidates(t).select("dataset", "candidate_id", F.col("pos.line_no.line_no").alias("line_no"), F.md5("q").alias("q_md5"))


@register("upsert_decisions", "v_decision_log", """select dataset, candidate_id, decision, edited_q, array_to_string(edited_expect_any, '|') as edited_expect, notes, updated_at from v_decision_log
  qualify row_number() over (partition by dataset, candidate_id order by updated_at desc) = 1""")
def _(t):
    d = _decisions(t)
    return d.select("dataset", "candidate_id", "decision", "edited_q", joined("edited_expect_any").alias("edited_expect"), "notes", "updated_at")


def _draft_state(t):
    """Audit rows of the drafting stage, per dataset of the candidates."""
    state = t.turns.select(
        "dataset", F.concat(F.lit("t-"), "line_no").alias("task_id"),
        F.when(F.col("turn") % 2 == 0, "generate_candidates").otherwise("generate_corpus").alias("stage"),
        F.col("role").alias("status"), F.col("turn").cast("int").alias("attempts"), F.lit(None).cast("string").alias("last_error"),
        F.lpad(F.col("line_no").cast("string"), 9, "0").alias("updated_at"),
    )
    return tasks.recent_tasks(state, 300)


@register(
    "review_queue",
    "v_candidate_lines v_turns v_decision_log",
    f"""with {CANDIDATES_SQL}, newest as (select * from v_turns qualify row_number() over (partition by dataset order by line_no desc) <= 300),
    note as (select dataset, concat(arg_min(role, line_no), ' · attempts ', arg_min(turn, line_no), ' · ') as note from newest where turn % 2 = 0 group by dataset)
    select c.dataset, c.candidate_id, coalesce(nullif(d.decision, ''), 'pending') as status, md5(coalesce(nullif(d.edited_q, ''), trim(c.q))) as q_md5,
      case when len(d.edited_expect_any) > 0 then array_to_string(d.edited_expect_any, '|') else c.expect end as expected, c.evidence,
      case when c.evidence <> '' then '0.5' else '' end as confidence, coalesce(note, '') as audit
    from cands c left join decided d on d.dataset = c.dataset and d.candidate_id = c.candidate_id left join note n on n.dataset = c.dataset""",
)
def _(t):
    q = curation.review_queue(_candidates(t), _decisions(t), _draft_state(t))
    return q.select("dataset", "candidate_id", "status", F.md5("edited_q").alias("q_md5"), joined("expected").alias("expected"), "evidence", "confidence", "audit")


REVIEWED_SQL = CANDIDATES_SQL + """,
chosen as (select d.*, c.q as c_q, c.expect as c_expect, c.expect_none as c_none, c.candidate_id is not null as known, case when len(d.edited_expect_any) > 0 then array_to_string(d.edited_expect_any, '|') else coalesce(c.expect, '') end as expected,
  c.given from decided d left join cands c on c.dataset = d.dataset and c.candidate_id = d.candidate_id where decision in ('approve', 'rewrite'))"""


@register("export_queries", "v_candidate_lines v_turns v_decision_log", f"""with {REVIEWED_SQL} select dataset, candidate_id as id, md5(coalesce(nullif(trim(edited_q), ''), trim(c_q))) as q_md5, expected, c_none and expected = '' as negative, updated_at
  from chosen where known and (expected <> '' or c_none)""")
def _(t):
    e = curation.export_queries(_candidates(t), _decisions(t))
    return e.select("dataset", "id", F.md5("q").alias("q_md5"), F.coalesce(joined("expect_any"), F.lit("")).alias("expected"), F.coalesce("expect_none", F.lit(False)).alias("negative"), "updated_at")


@register(
    "export_violations",
    "v_candidate_lines v_turns v_decision_log",
    f"""with {REVIEWED_SQL}, stems as (select distinct dataset, 'doc-' || line_no as stem from v_turns where role <> 'assistant'),
    items as (select dataset, candidate_id, unnest(string_split(expected, '|')) as item from chosen where known and expected <> '')
    select dataset, 'reviewed candidate not found: ' || candidate_id as message from chosen where not known
    union all select dataset, candidate_id || ': must set expect_any or expect_none' from chosen where known and expected = '' and not c_none
    union all select dataset, candidate_id || ': expect_any references missing stem: ' || item from items i where not exists (select 1 from stems s where s.dataset = i.dataset and s.stem = i.item)
    union all select dataset, 'no approved or rewritten candidates to export' from (select dataset from stems union select dataset from decided)
      where dataset not in (select dataset from chosen where known and (expected <> '' or c_none))""",
)
def _(t):
    stems = t.turns.where("role <> 'assistant'").select("dataset", F.concat(F.lit("doc-"), "line_no").alias("stem"))
    return curation.export_violations(_candidates(t), _decisions(t), stems).select("dataset", "message")


@register(
    "even_spread",
    "v_docs",
    """with r as (select dataset, doc_id, row_number() over (partition by dataset order by doc_id) - 1 as idx, count(*) over (partition by dataset) as n from v_docs),
    picks as (select distinct dataset, cast(floor(i * (n / 17.0::double)) as bigint) as idx from (select distinct dataset, n from r), range(0, 17) g(i) where 17 < n)
    select r.dataset, r.doc_id from r left join picks p on p.dataset = r.dataset and p.idx = r.idx where n <= 17 or p.idx is not null""",
)
def _(t):
    return ordering.even_spread(t.docs, 17, ["dataset"], ["doc_id"]).select("dataset", "doc_id")


@register(
    "even_spread_ranges",
    "v_per_query",
    """with r as (select mode, id, row_number() over (partition by mode order by top_price, o_orderkey) - 1 as idx, count(*) over (partition by mode) as n from v_per_query),
    picks as (select distinct mode, cast(floor(i * (n / 1000.0::double)) as bigint) as idx from (select distinct mode, n from r), range(0, 1000) g(i))
    select r.mode, r.id from r join picks p on p.mode = r.mode and p.idx = r.idx""",
)
def _(t):
    return ordering.even_spread(t.per_query, 1000, ["mode"], ["top_price", "o_orderkey"], safe_rows=1000).select("mode", "id")


MARKER_SQL = """
docs as (select dataset, stem, file_name, case when starts_with(file_name, 'zh-') then 'zh' when starts_with(file_name, 'en-') then 'en' end as lang from v_corpus),
r as (select *, row_number() over (partition by dataset, lang order by file_name) - 1 as idx, count(*) over (partition by dataset, lang) as n from docs where lang is not null),
z as (select dataset, least(count(*) filter (where lang = 'zh'), 10) as taken from r group by dataset),
w as (select r.*, case when lang = 'zh' then 10 else 21 - taken end as k from r join z on z.dataset = r.dataset),
picks as (select distinct dataset, lang, cast(floor(i * (n / k::double)) as bigint) as idx from (select distinct dataset, lang, n, k from w where k < n), range(0, 21) g(i) where i < k),
picked as (select w.* from w left join picks p on p.dataset = w.dataset and p.lang = w.lang and p.idx = w.idx where k >= n or p.idx is not null),
marked as (select dataset, stem, case when lang = 'zh' then '哪个文档包含检索标记 docmark' || replace(stem, '-', '') || '？' else 'Which document contains retrieval marker docmark' || replace(stem, '-', '') || '?' end as q from picked)"""


@register("marker_queries", "v_corpus", f"with {MARKER_SQL} select dataset, q, stem as expected from marked")
def _(t):
    return curation.marker_queries(t.corpus, 21).select("dataset", "q", joined("expect_any").alias("expected"))


NEGATIVES = ["What is the weather tomorrow?", "How do I bake bread?", "怎样修理汽车？"]


@register(
    "append_negatives",
    "v_corpus",
    f"""with {MARKER_SQL} select dataset, q, stem as expected, false as negative from marked
    union all select d.dataset, n.q, '', true from (select distinct dataset from marked) d, (values ('{NEGATIVES[0]}'), ('{NEGATIVES[1]}')) n(q)""",
)
def _(t):
    out = curation.append_negatives(curation.marker_queries(t.corpus, 21), NEGATIVES, 2)
    return out.select("dataset", "q", joined("expect_any").alias("expected"), F.coalesce("expect_none", F.lit(False)).alias("negative"))


@register("catalog_assets", "v_items_catalog", """select dataset, pos, category || '.' || slug || '.image' as id, category as doc, 'images/' || image_dir || '/' || slug || '.png' as path,
  zh || ' / ' || en as heading, category || '.' || slug as anchor from v_items_catalog""")
def _(t):
    return catalog.catalog_assets(t.items_catalog)


@register("catalog_chunks", "v_items_catalog", """select dataset, pos, category || '.' || slug || '.text' as id, category as doc, zh || ' / ' || en as heading, category || '.' || slug as anchor,
  category || '.' || slug || '.image' as asset_id from v_items_catalog""")
def _(t):
    return catalog.catalog_chunks(t.items_catalog)


@register("catalog_queries", "v_items_catalog", """select dataset, category || '_' || slug || '_asset' as id, 'asset' as query_type, asset_query as q, category as expected, category || '.' || slug || '.image' as assets, '' as chunks from v_items_catalog
  union all select dataset, category || '_' || slug || '_chunk', 'text_chunk', chunk_query, category, '', category || '.' || slug || '.text' from v_items_catalog""")
def _(t):
    return _flat_queries(catalog.catalog_queries(t.items_catalog))


def _flat_queries(df):
    return df.select(
        "dataset", "id", "query_type", "q", joined("expect_any").alias("expected"),
        F.coalesce(joined("expect_asset_any"), F.lit("")).alias("assets"), F.coalesce(joined("expect_chunk_any"), F.lit("")).alias("chunks"),
    )


@register(
    "catalog_documents",
    "v_items_catalog",
    """with parts as (select dataset, category, -1 as pos, concat('---', chr(10), 'title: ', any_value(title), chr(10), 'language: zh-CN', chr(10), 'source: local-synthetic', chr(10), 'modality: image-text', chr(10), 'version: v1', chr(10),
      'category: ', category, chr(10), '---', chr(10), chr(10), '# ', any_value(title), chr(10), chr(10), any_value(intro), chr(10)) as part from v_items_catalog group by dataset, category
    union all select dataset, category, pos, concat('## ', zh, ' / ', en, chr(10), chr(10), 'Target: ', category, '.', slug, chr(10), chr(10), '![', zh, '图片 - ', en, '](./images/', image_dir, '/', slug, '.png)', chr(10), chr(10),
      "desc", chr(10), chr(10), visual, chr(10), chr(10), use, chr(10), chr(10), 'Find by: ', zh, ', ', en, ' (', title, ')', chr(10)) from v_items_catalog)
    select dataset, category as stem, md5(string_agg(part, chr(10) order by pos)) as text_md5 from parts group by dataset, category""",
)
def _(t):
    return _whole_documents(catalog.documents_of(catalog.catalog_pieces(t.items_catalog, "v1", "Find by: {zh}, {en} ({title})")))


def _whole_documents(docs):
    """The digest of each document, its parts laid end to end."""
    laid = F.array_sort(F.collect_list(F.struct("part", "text")))["text"]
    return docs.groupBy("dataset", "stem").agg(F.md5(F.array_join(laid, "\n")).alias("text_md5"))


@register("union_catalogs", "v_items_catalog", "select dataset, count(*) * 2 as n, count(distinct slug) as n_slugs from v_items_catalog group by dataset")
def _(t):
    both = catalog.union_catalogs(t.items_catalog, t.items_catalog)
    return both.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("slug").alias("n_slugs"))


@register("group_chunks", "v_groups", "select dataset, pos, 'groups.' || slug || '.text' as id, doc, zh || ' / ' || en as heading, 'groups.' || slug as anchor, array_to_string(assets, '|') as asset_ids from v_groups")
def _(t):
    return catalog.group_chunks(t.groups).withColumn("asset_ids", joined("asset_ids"))


@register("group_queries", "v_groups", """select dataset, 'groups_' || slug || '_chunk' as id, 'text_chunk' as query_type, chunk_query as q, doc as expected, array_to_string(assets, '|') as assets, 'groups.' || slug || '.text' as chunks from v_groups
  union all select dataset, 'groups_' || slug || '_asset_group', 'asset_group', asset_query, doc, array_to_string(assets, '|'), 'groups.' || slug || '.text' from v_groups""")
def _(t):
    return _flat_queries(catalog.group_queries(t.groups))


@register(
    "group_documents",
    "v_groups",
    """with parts as (select dataset, doc, -1 as pos, concat('---', chr(10), 'title: ', any_value(title), chr(10), 'language: zh-CN', chr(10), 'source: local-synthetic', chr(10), 'modality: image-text', chr(10), 'version: v1', chr(10),
      'target_shape: multi-image-chunk', chr(10), '---', chr(10), chr(10), '# ', any_value(title), chr(10), chr(10), any_value(intro), chr(10)) as part from v_groups group by dataset, doc
    union all select dataset, doc, pos, concat('## ', zh, ' / ', en, chr(10), chr(10), 'Target: groups.', slug, chr(10), chr(10),
      '![', zh, ' / ', en, '](./', image_paths[1], ')', chr(10), chr(10), '![', zh, ' / ', en, '](./', image_paths[2], ')', chr(10), chr(10), summary, chr(10), chr(10), detail, chr(10)) from v_groups)
    select dataset, doc as stem, md5(string_agg(part, chr(10) order by pos)) as text_md5 from parts group by dataset, doc""",
)
def _(t):
    return _whole_documents(catalog.documents_of(catalog.group_pieces(t.groups, "v1")))


@register(
    "replace_by_prefix",
    "v_items_catalog v_groups",
    """select dataset, category || '.' || slug || '.text' as id from v_items_catalog where not starts_with(category, 'brand-1')
    union all select dataset, 'groups.' || slug || '.text' from v_groups""",
)
def _(t):
    return curation.replace_by_prefix(catalog.catalog_chunks(t.items_catalog), catalog.group_chunks(t.groups), "brand-1").select("dataset", "id")


@register(
    "expand_topics",
    "v_topics",
    """select dataset, stem, md5(concat('---', chr(10), 'title: ', title, chr(10), case when language <> '' then concat('language: ', language, chr(10)) else '' end,
      'source: local-diverse-synthetic', chr(10), '---', chr(10), chr(10), body, chr(10))) as text_md5, question as q from v_topics""",
)
def _(t):
    docs, queries = catalog.expand_topics(t.topics)
    asked = queries.select("dataset", F.get("expect_any", F.lit(0)).alias("stem"), "q")
    return docs.join(asked, ["dataset", "stem"]).select("dataset", "stem", F.md5("text").alias("text_md5"), "q")


def cluster_parts(size: int) -> str:
    return f"cp as (select *, (row_number() over (partition by dataset, cluster order by pos, slug) - 1) // {size} as part from v_cluster_docs)"


SIBLINGS_SQL = """select a.dataset, a.cluster, a.slug, coalesce(string_agg(b.title || ' (' || b.focus || ')', '; ' order by b.pos, b.slug), '') as siblings
    from v_cluster_docs a left join v_cluster_docs b on b.dataset = a.dataset and b.cluster = a.cluster and b.slug <> a.slug group by all"""


@register("cluster_siblings", "v_cluster_docs", SIBLINGS_SQL)
def _(t):
    return curation.cluster_siblings_laid(t.cluster_docs, 1000)


@register("cluster_siblings_whole", "v_cluster_docs", SIBLINGS_SQL)
def _(t):
    return curation.cluster_siblings_laid(t.cluster_docs, 3)


@register(
    "cluster_listing",
    "v_cluster_docs",
    f"""with {cluster_parts(30)} select dataset, cluster, part, max(max(part)) over (partition by dataset, cluster) + 1 as parts,
      md5(string_agg(concat('- stem=', cluster, '-', slug, ' | title=', title, ' | focus: ', focus), chr(10) order by pos, slug)) as listing_md5,
      (sum(count(*)) over (partition by dataset, cluster))::bigint as n from cp group by dataset, cluster, part""",
)
def _(t):
    return curation.cluster_listing(t.cluster_docs, 30).select(
        "dataset", "cluster", big("part", "part"), big("parts", "parts"), F.md5("listing").alias("listing_md5"), big("n", "n")
    )


@register(
    "materialize_cluster_queries",
    "v_cluster_results v_cluster_docs",
    """select d.dataset, r.task_id, d.language || '-' || d.stem as id, 'ask ' || d.pos as q from v_cluster_results r join v_cluster_docs d on r.task_id = 'q-' || d.stem
    where r.status = 'succeeded' and d.pos % 7 <> 0 and d.pos % 9 <> 0 and d.focus <> 'BUILDING'""",
)
def _(t):
    docs = t.cluster_docs
    corpus_ = docs.where("focus <> 'BUILDING'")
    out = curation.materialize_cluster_queries(t.cluster_results, docs, corpus_)
    return out.select("dataset", "task_id", "id", "q")


@register(
    "materialize_corpus",
    "v_results v_meta",
    """with r as (select v.*, d.n, d.doc_id, m.stem as m_stem, m.language as m_lang, m.title as m_title from v_results v join v_docs d on v.ord = d.doc_id left join v_meta m on m.dataset = v.dataset and m.task_id = v.task_id where v.status = 'succeeded'),
    d as (select dataset, task_id, source_ord, ord, doc_id,
      case doc_id % 3 when 0 then coalesce(lower(replace(m_stem, ' ', '-')), task_id) when 1 then 'doc-' || (n % 30) else task_id end as stem,
      case doc_id % 3 when 0 then m_title when 1 then 'T ' || doc_id end as title0,
      case doc_id % 3 when 0 then coalesce(m_lang, '') when 1 then 'en' else '' end as language,
      case doc_id % 3 when 0 then case when doc_id % 33 = 0 then '' when doc_id % 2 = 0 then '# H body ' || doc_id else 'body ' || doc_id end else 'md ' || doc_id end as body from r),
    f as (select *, coalesce(title0, stem) as title from d qualify row_number() over (partition by dataset, stem order by source_ord, ord, task_id) = 1)
    select dataset, stem, language, md5(concat('---', chr(10), 'title: ', title, chr(10), case when language <> '' then concat('language: ', language, chr(10)) else '' end, 'source: marker', chr(10), '---', chr(10), chr(10),
      case when starts_with(body, '#') then body else concat('# ', title, chr(10), chr(10), body) end, chr(10))) as text_md5 from f where body <> ''""",
)
def _(t):
    return curation.materialize_corpus(t.results, t.meta, "marker").select("dataset", "stem", "language", F.md5("text").alias("text_md5"))


# --- F: tasks --------------------------------------------------------------


def _doc_tasks(t):
    docs = t.docs
    return tasks.prompt_tasks(
        docs, "generate_corpus", "v1", F.lit("Write a document."),
        tasks.fill("About {lang}:\n{body}", {"lang": F.col("lang"), "body": F.col("body")}), F.col("body"), carry=("doc_id",),
    )


TASK_ID_SQL = """tk as (select dataset, doc_id, sha256(body) as source_hash, substr(sha256(concat_ws(chr(10), dataset, 'generate_corpus', sha256(body), 'v1', 'Write a document.',
  concat('About ', lang, ':', chr(10), body))), 1, 32) as task_id from v_docs)"""


@register("task_ids", "v_docs", f"with {TASK_ID_SQL} select doc_id, source_hash, task_id from tk")
def _(t):
    return _doc_tasks(t).select("doc_id", "source_hash", "task_id")


@register(
    "grid_tasks",
    "v_corpus",
    f"""with {GRID_SQL}, tk as (select *, case when lang = 'zh' then '写 ' || lpad(cast(idx as varchar), case when idx < 1000 then 3 else 4 end, '0') || ' topic' else 'Write ' || stem end as usr,
      sha256(concat_ws(':', dataset, 'topic', idx, lang, stem, 'v2')) as source_hash from grid)
    select dataset, stem, substr(sha256(concat_ws(chr(10), dataset, 'generate_bilingual_corpus', source_hash, 'v2', 'sys', usr)), 1, 32) as task_id from tk""",
)
def _(t):
    grid = quality.expected_grid(t.corpus.select("dataset").distinct(), GRID)
    return tasks.grid_tasks(grid, "topic", "v2", "sys", "写 {index} {topic}", "Write {stem}").select("dataset", "stem", "task_id")


@register(
    "topic_tasks",
    "v_topics",
    """select dataset, substr(sha256(concat_ws(chr(10), dataset, 'generate_factbook', sha256(title || ':30'), 'v1', 'sys', 'Create 30 entries for ' || title)), 1, 32) as task_id from v_topics""",
)
def _(t):
    topics = t.topics.withColumnRenamed("title", "topic")
    return tasks.topic_tasks(topics, 30, "v1", "sys", "Create {items} entries for {topic}").select("dataset", "task_id")


@register(
    "pack_tasks",
    "v_corpus",
    f"""with {PACK_SQL}
    select dataset, substr(sha256(concat_ws(chr(10), dataset, 'generate_candidates', sha256(pack), 'v1', 'sys', 'Draft 30 queries.' || pack)), 1, 32) as task_id from packs""",
)
def _(t):
    packs = corpus.assemble_packs(corpus.corpus_pack(t.corpus), PACK_PART)
    return tasks.pack_tasks(packs, 30, "v1", "sys", "Draft {queries} queries.{corpus}").select("dataset", "task_id")


@register(
    "cluster_doc_tasks",
    "v_cluster_docs",
    f"""with {cluster_parts(7)}, n as (select dataset, cluster, max(part) + 1 as parts from cp group by all),
    s as (select a.dataset, a.stem, a.language, a.title, b.part, coalesce(string_agg(b.title || ' (' || b.focus || ')', '; ' order by b.pos, b.slug) filter (b.slug <> a.slug), '') as siblings
      from cp a join cp b on b.dataset = a.dataset and b.cluster = a.cluster join n on n.dataset = a.dataset and n.cluster = a.cluster
      group by a.dataset, a.stem, a.language, a.title, b.part, n.parts having count(*) filter (b.slug <> a.slug) > 0 or n.parts = 1)
    select dataset, stem, part, substr(sha256(concat_ws(chr(10), dataset, 'generate_cluster_corpus',
      sha256(concat_ws(':', dataset, stem, language, 'v1', case when part > 0 then 'part' || part end)), 'v1', 'sys', concat(title, ' not ', siblings))), 1, 32) as task_id from s""",
)
def _(t):
    docs = t.cluster_docs.drop("stem")
    tasks_ = curation.cluster_doc_tasks(docs, "v1", "sys", "{title} not {siblings}", per_part=7)
    return tasks_.select("dataset", "stem", big("part", "part"), "task_id")


@register(
    "cluster_query_tasks",
    "v_cluster_docs",
    f"""with {cluster_parts(1000)}, l as (select dataset, cluster, part, string_agg(concat('- stem=', cluster, '-', slug, ' | title=', title, ' | focus: ', focus), chr(10) order by pos, slug) as listing,
      (sum(count(*)) over (partition by dataset, cluster))::bigint as n from cp group by dataset, cluster, part)
    select dataset, cluster, substr(sha256(concat_ws(chr(10), dataset, 'generate_cluster_queries', sha256(concat_ws(':', dataset, 'queries', cluster, 'v1', case when part > 0 then 'part' || part end)), 'v1', 'sys', concat(n, ' docs: ', listing))), 1, 32) as task_id from l""",
)
def _(t):
    return curation.cluster_query_tasks(t.cluster_docs, "v1", "sys", "{n} docs: {listing}").select("dataset", "cluster", "task_id")


FOLD_SQL = """
ordered as (select *, row_number() over (partition by task_id order by seq desc) as back, max(case when kind = 'finish' then seq end) over (partition by task_id) as finish_seq from v_audit_events),
fold as (select task_id, max(dataset) as dataset, max(stage) as stage, max(case when back = 1 then case when kind = 'start' then 'running' else status end end) as status,
  coalesce(max(case when seq = finish_seq then attempts end), 0) as attempts, max(case when seq = finish_seq then last_error end) as last_error,
  max(case when seq = finish_seq then result end) as result, min(ts) as created_at, max(case when back = 1 then ts end) as updated_at from ordered group by task_id)"""


def _fold(t):
    return tasks.fold_audit(t.audit_events)


@register("fold_audit", "v_audit_events", f"with {FOLD_SQL} select task_id, dataset, stage, status, attempts, last_error, result, created_at, updated_at from fold")
def _(t):
    return _fold(t).select("task_id", "dataset", "stage", "status", "attempts", "last_error", "result", "created_at", "updated_at")


@register("merge_states", "v_audit_events", f"with {FOLD_SQL} select task_id, status, attempts, last_error, created_at, updated_at from fold")
def _(t):
    odd = F.xxhash64("seq") % 2 == 0
    merged = tasks.merge_states(tasks.fold_audit(t.audit_events.where(odd)), tasks.fold_audit(t.audit_events.where(~odd)))
    return merged.select("task_id", "status", "attempts", "last_error", "created_at", "updated_at")


@register("scan_audit", "v_audit_events", f"with {FOLD_SQL} select task_id, stage, status, updated_at from fold where stage = 'purchase' and status = 'succeeded'")
def _(t):
    return tasks.scan_audit(_fold(t), "purchase", "succeeded").select("task_id", "stage", "status", "updated_at")


@register("audit_status_counts", "v_audit_events", f"with {FOLD_SQL} select dataset, status, count(*) as n from fold group by dataset, status")
def _(t):
    return tasks.audit_status_counts(_fold(t))


@register("recent_tasks", "v_audit_events", f"with {FOLD_SQL}, r as (select *, row_number() over (partition by dataset order by updated_at desc, task_id) as rank from fold) select dataset, task_id, status, updated_at, rank from r where rank <= 40")
def _(t):
    return tasks.recent_tasks(_fold(t), 40).select("dataset", "task_id", "status", "updated_at", big("rank", "rank"))


@register("batch_outcome", "v_audit_events", f"with {FOLD_SQL} select stage as dataset, bool_or(status in ('failed', 'needs_manual_review')) as failed from fold group by stage")
def _(t):
    return tasks.batch_outcome(_fold(t).withColumn("dataset", F.col("stage")))


@register(
    "plan_tasks",
    "v_docs v_results",
    f"""with {TASK_ID_SQL}, st as (select tk.task_id, r.status, r.result from v_results r join tk on tk.doc_id = r.ord)
    select tk.doc_id, tk.task_id, st.task_id is not null as skipped, st.result from tk left join st on st.task_id = tk.task_id and st.status = 'succeeded'""",
)
def _(t):
    planned = _doc_tasks(t)
    ids = planned.select("doc_id", "task_id")
    state = t.results.select(F.col("ord").alias("doc_id"), "status", "result").join(ids, "doc_id").select(
        "task_id", "status", F.lit(1).alias("attempts"), "result", F.lit("raw").alias("raw_response")
    )
    return tasks.plan_tasks(planned, state, resume=True).select("doc_id", "task_id", "skipped", "result")


CLASSIFY_SQL = """
p as (select *, task_no % 6 in (0, 1, 4) as ok1, task_no % 4 = 0 as ok2 from v_responses),
k as (select dataset, task_no, case when not expected_json or ok1 or ok2 then 'succeeded' else 'needs_manual_review' end as status,
  case when expected_json and not ok1 and not ok2 then case when task_no % 4 = 1 then 'JSON parse failed' when task_no % 6 = 5 then 'JSON root must be an object or array' else 'JSON parse failed' end end as error,
  case when not expected_json then null when task_no % 6 = 0 then concat('{"t":', task_no, '}') when task_no % 6 = 1 then concat('[', task_no, ',2]') when task_no % 6 = 4 then concat('{"a":{"b":', task_no, '}}')
    when ok2 then concat('{"fixed":', task_no, '}') end as result from p)"""


@register("classify_responses", "v_responses", f"with {CLASSIFY_SQL} select dataset, task_no, status, error, result from k")
def _(t):
    out = tasks.classify_responses(t.responses)
    return out.select("dataset", "task_no", "status", "error", F.when(F.col("expected_json"), F.col("result")).alias("result"))


@register("retry_decision", "v_attempts", "select task_id, attempt, status_code, status_code is null or status_code in (408, 409, 429, 529) or (status_code not in (400, 401, 403) and status_code >= 500) as retry from v_attempts")
def _(t):
    return t.attempts.select("task_id", "attempt", "status_code", K.retry_decision(F.col("status_code")).alias("retry"))


@register(
    "attempt_rollup",
    "v_attempts",
    """with a as (select *, coalesce(status_code not between 200 and 299, false) or error is not null or trim(body, ' ' || chr(10) || chr(9)) = '' as failed, status_code is null or status_code in (429, 529) or status_code >= 500 as retryable from v_attempts where attempt <= 4),
    e as (select task_id, min(attempt) as at from a where not failed or not retryable or attempt = 4 group by task_id)
    select t.task_id, case when e.at is null then 'running' when x.failed then 'failed' else 'succeeded' end as status,
      cast(case when e.at is null then 0 when not x.failed then e.at when x.retryable then 4 else 1 end as int) as attempts,
      case when x.failed then coalesce(x.error, 'empty response') end as error
    from (select distinct task_id from a) t left join e on e.task_id = t.task_id left join a x on x.task_id = e.task_id and x.attempt = e.at""",
)
def _(t):
    return tasks.attempt_rollup(t.attempts, 4)


@register(
    "run_tasks",
    "v_attempts",
    f"""with a as (select *, coalesce(status_code not between 200 and 299, false) or error is not null or trim(body, ' ' || chr(10) || chr(9)) = '' as failed, status_code is null or status_code in (429, 529) or status_code >= 500 as retryable from v_attempts where attempt <= 4),
    e as (select task_id, min(attempt) as at from a where not failed or not retryable or attempt = 4 group by task_id),
    t as (select distinct task_id, length(task_id) % 2 = 0 as expected_json, task_id like '%9-%' as skipped,
      case when length(task_id) % 3 = 0 then '{{"fixed":true}}' else 'still bad' end as repaired from v_attempts)
    select t.task_id, case when skipped then 'succeeded' when e.at is null then 'running' when x.failed then 'failed' when expected_json and repaired = 'still bad' then 'needs_manual_review' else 'succeeded' end as status,
      cast(case when skipped then 2 when e.at is null then 0 when not x.failed then e.at when x.retryable then 4 else 1 end as int) as attempts,
      case when skipped then '{{"kept":1}}' when e.at is null or x.failed then null when not expected_json then '{{"text":"' || x.body || '"}}' when repaired = 'still bad' then null else repaired end as result,
      case when not skipped and x.failed then coalesce(x.error, 'empty response') end as error, skipped
    from t left join e on e.task_id = t.task_id left join a x on x.task_id = e.task_id and x.attempt = e.at""",
)
def _(t):
    """The end of every task of a recorded run: skipped, retried, repaired, failed or open."""
    size, skipped = F.length("task_id"), F.col("task_id").like("%9-%")
    named = t.attempts.select("task_id").distinct().select(
        "task_id",
        (size % 2 == 0).alias("expected_json"),
        skipped.alias("skipped"),
        F.when(size % 3 == 0, '{"fixed":true}').otherwise("still bad").alias("repaired"),
    )
    kept = lambda v: F.when(F.col("skipped"), F.lit(v))
    plan = named.select(
        "task_id", F.lit("d").alias("dataset"), F.lit("s").alias("stage"), "expected_json", "skipped",
        kept("succeeded").alias("status"), kept(2).alias("attempts"), kept('{"kept":1}').alias("result"), kept("raw").alias("raw_response"),
    )
    out = tasks.recorded_results(plan, t.attempts, named.select("task_id", "repaired"), 4)
    error = F.when(F.col("status") == "failed", F.col("error")).alias("error")
    return out.select("task_id", "status", "attempts", "result", error, "skipped")


@register("chunk_rows", "v_docs", "with r as (select dataset, doc_id, row_number() over (partition by dataset order by doc_id) - 1 as idx from v_docs) select dataset, doc_id, idx // 8 as grp, idx % 8 as slot from r")
def _(t):
    return ordering.chunk_rows(t.docs, 8, ["dataset"], ["doc_id"]).select("dataset", "doc_id", "grp", big("slot", "slot"))


# --- G: quality review -----------------------------------------------------


@register(
    "dataset_mode",
    PKG_VIEWS,
    r"""select d.dataset, case when any_value(has_targets) then 'multimodal' when bool_or(regexp_matches(text, '!\[([^\]]*)\]\(([^)\n]+)\)')) then 'multimodal_without_targets' else 'text_doc_level' end as dataset_mode
    from v_datasets d left join v_corpus c on c.dataset = d.dataset group by d.dataset""",
)
def _(t):
    return review.dataset_mode(_package(t))


SUMMARY_SQL = """
wanted as (select distinct dataset, unnest(expect_any) as doc from v_queries where not expect_none),
flagged as (select w.*, c.stem is null as missing from wanted w left join v_corpus c on c.dataset = w.dataset and c.stem = w.doc),
totals as (select dataset, count(*) as total, count(*) filter (where not expect_none) as positive, count(*) filter (where expect_none) as negative from v_queries group by dataset)"""


@register("query_summary", "v_queries v_corpus", f"""with {SUMMARY_SQL} select t.dataset, total, positive, negative, count(f.doc) as n_expected, count(*) filter (where missing) as n_missing from totals t left join flagged f on f.dataset = t.dataset group by all""")
def _(t):
    return review.query_summary(t.queries, t.corpus)


@register("summary_docs", "v_queries v_corpus", f"with {SUMMARY_SQL} select dataset, doc, missing from flagged")
def _(t):
    return review.summary_docs(t.queries, t.corpus)


HEADINGS_SQL = r"array_to_string(regexp_extract_all(c.text, '(?m)^##\s+(.+)$', 1), ',')"


@register(
    "expected_contexts",
    "v_queries v_corpus",
    rf"""with w as (select dataset, pos, unnest(expect_any) as doc, generate_subscripts(expect_any, 1) as i from v_queries where not expect_none),
    e as (select w.*, concat(w.doc, ':', c.stem is not null, ':', coalesce({HEADINGS_SQL}, ''), ':', md5(coalesce(case when len(c.text) > 1800 then c.text[1:1800] || chr(10) || '...[truncated]' else c.text end, ''))) as entry
      from w left join v_corpus c on c.dataset = w.dataset and c.stem = w.doc)
    select q.dataset, q.pos, coalesce(string_agg(entry, '|' order by i), '') as contexts from v_queries q left join e on e.dataset = q.dataset and e.pos = q.pos group by q.dataset, q.pos""",
)
def _(t):
    ctx = review.expected_contexts(t.queries, t.corpus)
    shown = F.transform("contexts", lambda x: F.concat(x["doc"], F.lit(":"), x["exists"].cast("string"), F.lit(":"), F.array_join(x["headings"], ","), F.lit(":"), F.md5(x["text"])))
    return ctx.select("dataset", "pos", joined(shown).alias("contexts"))


def _target_rows(df):
    return df.select("dataset", big("kind_ord", "kind_ord"), "target_type", "target_id")


@register(
    "review_targets",
    PKG_VIEWS,
    """select dataset, 0 as kind_ord, 'dataset' as target_type, dataset as target_id from v_datasets
    union all select dataset, 1, 'corpus_doc', stem from v_corpus
    union all select dataset, 2, 'query', case when id = '' then 'query-' || pos else id end from v_queries where is_mapping
    union all select dataset, 3, 'target_asset', case when id = '' then 'asset-' || pos else id end from v_assets where is_mapping
    union all select dataset, 4, 'target_chunk', case when id = '' then 'chunk-' || pos else id end from v_chunks where is_mapping""",
)
def _(t):
    return _target_rows(review.review_targets(_package(t)))


@register(
    "review_payloads",
    PKG_VIEWS,
    rf"""with {SECTIONS_SQL}, {SUMMARY_SQL},
    ls as (select dataset, stem, heading, case when len(section_text) > 4000 then section_text[1:4000] || chr(10) || '...[truncated]' else section_text end as t from last_secs)
    select c.dataset, 'corpus_doc' as target_type, c.stem as target_id, md5(case when len(c.text) > 6000 then c.text[1:6000] || chr(10) || '...[truncated]' else c.text end) as text_md5, len(regexp_extract_all(c.text, '!\[([^\]]*)\]\(([^)\n]+)\)')) as n from v_corpus c
    union all select a.dataset, 'target_asset', case when id = '' then 'asset-' || pos else id end, md5(coalesce(ls.t, '')), coalesce(len(regexp_extract_all(c.text, '!\[([^\]]*)\]\(([^)\n]+)\)')), 0) from v_assets a
      left join ls on ls.dataset = a.dataset and ls.stem = a.doc and ls.heading = a.heading left join v_corpus c on c.dataset = a.dataset and c.stem = a.doc where is_mapping
    union all select a.dataset, 'target_chunk', case when id = '' then 'chunk-' || pos else id end, md5(coalesce(ls.t, '')), len(regexp_extract_all(coalesce(ls.t, ''), '!\[([^\]]*)\]\(([^)\n]+)\)')) from v_chunks a
      left join ls on ls.dataset = a.dataset and ls.stem = a.doc and ls.heading = a.heading where is_mapping
    union all select q.dataset, 'query', case when id = '' then 'query-' || pos else id end, md5(case when expect_none then 'negative' else 'positive' end), case when expect_none then 0 else coalesce(len(expect_any), 0) end from v_queries q where is_mapping
    union all select d.dataset, 'dataset', d.dataset, md5(concat(coalesce(t.total, 0), '/', coalesce(t.positive, 0))), (select count(*) from v_corpus c where c.dataset = d.dataset) from v_datasets d
      left join (select dataset, count(*) as total, count(*) filter (where not expect_none) as positive from v_queries where is_mapping group by dataset) t on t.dataset = d.dataset""",
)
def _(t):
    rows = review.review_targets(_package(t)).withColumn("v", F.parse_json("payload"))
    v = F.col("v")

    def text(path):
        return F.try_variant_get(v, path, "string")

    def size(path):
        return F.coalesce(F.size(F.try_variant_get(v, path, "array<variant>")), F.lit(0))

    kind = F.col("target_type")
    shown = (
        F.when(kind == "corpus_doc", text("$.text"))
        .when(kind == "query", text("$.query_role"))
        .when(kind == "dataset", F.concat(text("$.query_summary.total"), F.lit("/"), text("$.query_summary.positive")))
        .otherwise(text("$.section_text"))
    )
    n = (
        F.when(kind == "corpus_doc", size("$.image_refs"))
        .when(kind == "query", size("$.expected_doc_contexts"))
        .when(kind == "dataset", F.try_variant_get(v, "$.corpus_doc_count", "int"))
        .when(kind == "target_asset", size("$.image_refs_in_doc"))
        .otherwise(size("$.section_image_refs"))
    )
    return rows.select("dataset", "target_type", "target_id", F.md5(shown).alias("text_md5"), big(n, "n"))


@register(
    "review_groups",
    "v_targets",
    """with r as (select *, row_number() over (partition by dataset order by pos) - 1 as idx from v_targets),
    g as (select dataset, idx // 8 as grp, '[' || string_agg(concat('{"target_type":"', target_type, '","target_id":"', target_id, '",', substr(payload, 2)), ', ' order by idx) || ']' as source, count(*) as n from r group by dataset, idx // 8)
    select dataset, grp, n, substr(sha256(concat_ws(chr(10), dataset, 'quality_review', sha256(source), 'v1', 'sys', concat('Batch ', grp + 1, ': ', source))), 1, 32) as task_id from g""",
)
def _(t):
    g = review.review_groups(t.targets, 8, "v1", "sys", "Batch {index}: {source}")
    return g.select("dataset", "grp", big(F.size("targets"), "n"), "task_id")


@register(
    "review_groups_whole",
    "v_bench_queries v_bench_corpus",
    """with w as (select dataset, id, 'd' || substr(id, 2) as doc from v_bench_queries),
    f as (select w.*, c.stem is null as missing from w left join v_bench_corpus c on c.dataset = w.dataset and c.stem = w.doc)
    select dataset, 'corpus_docs' as list, stem as doc, count(*) as n from v_bench_corpus group by all
    union all select dataset, 'positive_expect_any_docs', doc, 1 from (select distinct dataset, doc from f)
    union all select dataset, 'missing_expect_any_docs', doc, 1 from (select distinct dataset, doc from f where missing)
    union all select dataset, 'known to ' || id, doc, 1 from f where not missing""",
)
def _(t):
    """Every name of one dataset of all documents, read back from the prompts."""
    none = {"names": "cast(null as array<string>)", "text": "cast(null as string)"}
    one = t.bench_corpus.select("dataset").distinct()
    blank = _package(t)
    asked = t.bench_queries.select(
        "dataset",
        F.row_number().over(Window.partitionBy("dataset").orderBy("id")).alias("pos"),
        F.lit(True).alias("is_mapping"),
        "id",
        "q",
        F.expr(none["text"]).alias("query_type"),
        F.array(F.concat(F.lit("d"), F.substring("id", 2, 99))).alias("expect_any"),
        F.lit("list").alias("expect_any_kind"),
        F.lit(False).alias("expect_none"),
        F.expr(none["names"]).alias("expect_asset_any"),
        F.lit("absent").alias("expect_asset_kind"),
        F.expr(none["names"]).alias("expect_chunk_any"),
        F.lit("absent").alias("expect_chunk_kind"),
    )
    pkg = validate.Package(
        datasets=one.select("dataset", F.lit("").alias("description"), *(F.lit(c != "has_targets").alias(c) for c in blank.datasets.columns[2:])),
        thresholds=blank.thresholds.limit(0),
        queries=asked,
        assets=blank.assets.limit(0),
        chunks=blank.chunks.limit(0),
        corpus=t.bench_corpus.select("dataset", "stem", F.concat("stem", F.lit(".md")).alias("file_name"), "text"),
        asset_files=blank.asset_files.limit(0),
    )
    shape = """array<struct<target_id:string,list:string,docs:array<string>,corpus_docs:array<string>,known_corpus_docs:array<string>,
      query:struct<expect_any:array<string>>,query_summary:struct<positive_expect_any_docs:array<string>,missing_expect_any_docs:array<string>>>>"""
    groups = review.review_groups(review.review_targets(pkg, per_part=100), 8, user="{source}")
    seen = groups.select("dataset", F.explode(F.from_json("user", shape)).alias("x"))
    head = ("corpus_docs", "query_summary.positive_expect_any_docs", "query_summary.missing_expect_any_docs")
    named = F.concat(
        F.array(*(F.struct(F.lit(c.split(".")[-1]).alias("list"), F.col(f"x.{c}").alias("docs")) for c in head)),
        F.array(
            F.struct(F.col("x.list").alias("list"), F.col("x.docs").alias("docs")),
            F.struct(
                F.concat(F.lit("known to "), "x.target_id").alias("list"),
                F.array_intersect("x.query.expect_any", "x.known_corpus_docs").alias("docs"),
            ),
        ),
    )
    rows = seen.select("dataset", F.explode(named).alias("l")).select("dataset", "l.list", F.explode("l.docs").alias("doc"))
    return rows.groupBy("dataset", "list", "doc").agg(F.count(F.lit(1)).alias("n"))


NORMAL_SQL = """
st as (select *, coalesce(status = 'succeeded' and doc_id % 17 <> 0 and not (doc_id % 7 = 0 and doc_id % 21 = 0) and not (doc_id % 7 <> 0 and doc_id % 13 = 0), false) as ok from v_review_results r),
a as (select st.dataset, st.batch_id, st.task_id, st.doc_id, 0 as pos, 'query' as target_type, 't-' || d.n as target_id, case when st.doc_id % 2 = 0 then 'warn' else 'pass' end as decision,
  case st.doc_id % 5 when 0 then 87 when 1 then 100 when 2 then 0 when 3 then 0 else 55 end as score, 'r' || st.doc_id as reason, case when st.doc_id % 3 = 0 then 'duplicate' else 'a|3' end as flags
  from st join v_docs d on d.doc_id = st.doc_id where ok),
b as (select dataset, batch_id, task_id, doc_id, 1, 'corpus_doc', 'd-' || doc_id, 'fail', 0, '', '' from st where ok and doc_id % 7 = 0)"""


def _normalized(t):
    return review.normalize_items(t.review_results)


@register("normalize_items", "v_review_results v_docs", f"with {NORMAL_SQL} select dataset, task_id, pos, target_type, target_id, decision, score, reason, flags from (select * from a union all select * from b)")
def _(t):
    i = review.item_rows(_normalized(t))
    return i.select("dataset", "task_id", big("pos", "pos"), "target_type", "target_id", "decision", big("score", "score"), "reason", joined("risk_flags").alias("flags"))


@register(
    "fill_failed_items",
    "v_review_results v_docs",
    f"""with {NORMAL_SQL} select dataset, task_id, target_id, decision, score, reason, flags from (select * from a union all select * from b)
    union all select st.dataset, task_id, 'd-' || doc_id, 'fail', 0, case when status = 'succeeded' then 'Invalid review JSON' else error end, 'schema_issue' from st where not ok""",
)
def _(t):
    groups = t.review_results.select("task_id", F.array(F.struct(F.lit("corpus_doc").alias("target_type"), F.concat(F.lit("d-"), "doc_id").alias("target_id"))).alias("targets"))
    i = review.fill_failed_items(_normalized(t), groups)
    return i.select("dataset", "task_id", "target_id", "decision", big("score", "score"), "reason", joined("risk_flags").alias("flags"))


LATEST_SQL = "latest as (select * from v_batches qualify row_number() over (partition by dataset order by created_at desc, batch_id desc) = 1)"


@register("latest_batch", "v_batches", f"with {LATEST_SQL} select dataset, batch_id, status, created_at from latest")
def _(t):
    return review.latest_batch(t.batches).select("dataset", "batch_id", "status", "created_at")


@register("running_batch", "v_batches", "select dataset, max(batch_id) as batch_id, max(created_at) as created_at from v_batches where status = 'running' group by dataset")
def _(t):
    return review.running_batch(t.batches).select("dataset", "batch_id", "created_at")


@register(
    "batch_may_start",
    "v_batches v_corpus",
    """select dataset, not bool_or(status = 'running') as may_start from (select dataset, status from v_batches
    union all select distinct dataset, '' from v_corpus union all select distinct dataset || '-new', '' from v_corpus) group by dataset""",
)
def _(t):
    known = t.corpus.select("dataset").distinct()
    new = known.select(F.concat("dataset", F.lit("-new")).alias("dataset"))
    return review.batch_may_start(t.batches, known.unionByName(new))


@register("batch_items", "v_items v_batches", f"with {LATEST_SQL} select i.dataset, i.batch_id, target_type, target_id, decision, score, case decision when 'fail' then 0 when 'warn' then 1 else 2 end as severity from v_items i join latest l on l.dataset = i.dataset and l.batch_id = i.batch_id")
def _(t):
    return review.batch_items(t.items, t.batches)


@register("batch_stats", "v_items v_batches", f"""with {LATEST_SQL} select l.dataset, l.batch_id, count(*) filter (where decision = 'pass') as pass, count(*) filter (where decision = 'warn') as warn, count(*) filter (where decision = 'fail') as fail
  from latest l left join v_items i on l.dataset = i.dataset and l.batch_id = i.batch_id group by l.dataset, l.batch_id""")
def _(t):
    return review.batch_stats(t.items, t.batches)


@register("retry_failed_targets", "v_items v_batches v_targets", f"""with {LATEST_SQL}, bad as (select distinct i.dataset, target_id from v_items i join latest l on l.dataset = i.dataset and l.batch_id = i.batch_id where decision = 'fail')
  select t.dataset, t.target_type, t.target_id from v_targets t join bad b on b.dataset = t.dataset and b.target_id = t.target_id""")
def _(t):
    return review.retry_failed_targets(t.targets, t.items, t.batches).select("dataset", "target_type", "target_id")


# --- K: bulk ranking -------------------------------------------------------


def _bm25_sql(queries: str, corpus_: str, top: int) -> str:
    return f"""
dt as (select dataset, stem, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) as term from {corpus_}),
tf as (select dataset, stem, term, count(*) as tf from dt group by dataset, stem, term),
dl as (select dataset, stem, sum(tf) as dl from tf group by dataset, stem),
st as (select dataset, count(*) as n, sum(dl) / count(*) as avg_len from dl group by dataset),
qt as (select dataset, id, term, count(*) as times from (select dataset, id, unnest(regexp_extract_all(lower(q), '[\\p{{L}}\\p{{N}}_]+')) as term from {queries}) group by all),
df as (select dataset, term, count(*) as df from tf group by dataset, term),
bm as (select qt.dataset, qt.id, tf.stem as doc, round(sum(times * ln(1 + (n - df + 0.5::double) / (df + 0.5::double)) * tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * dl / avg_len))), 9) as score
  from qt join tf on tf.term = qt.term and tf.dataset = qt.dataset join df on df.term = qt.term and df.dataset = qt.dataset join dl on dl.stem = tf.stem and dl.dataset = tf.dataset
  join st on st.dataset = qt.dataset group by qt.dataset, qt.id, tf.stem),
bm25 as (select *, row_number() over (partition by dataset, id order by score desc, doc) as rank from bm qualify rank <= {top})"""


@register("rank_bm25", "v_bench_queries v_bench_corpus", f"with {_bm25_sql('v_bench_queries', 'v_bench_corpus', 100)} select id, doc, round(score, 6) as score, rank from bm25")
def _(t):
    hits = ranking.rank_bm25(t.bench_queries, t.bench_corpus)
    return hits.select("id", "doc", r6("score").alias("score"), big("rank", "rank"))


@register("rank_bm25_blocks", "v_bench_queries v_bench_corpus", f"with {_bm25_sql('v_bench_queries', 'v_bench_corpus', 10)} select id, doc, round(score, 6) as score, rank from bm25")
def _(t):
    """The best ten, with every query scored block by block and nothing broadcast."""
    hits = ranking.rank_bm25(t.bench_queries, t.bench_corpus, top=10, block_docs=64, broadcast_bytes=0, whole_postings=0)
    return hits.select("id", "doc", r6("score").alias("score"), big("rank", "rank"))


VECTOR_SQL = """
vv as (select id, cast(vec as double[]) as vec from v_vectors),
cs as (select 'all' as dataset, a.id, b.id as doc, round(list_inner_product(a.vec, b.vec) / sqrt(list_inner_product(a.vec, a.vec)) / sqrt(list_inner_product(b.vec, b.vec)), 9) as score from vv a, vv b),
vec as (select *, row_number() over (partition by id order by score desc, doc) as rank from cs qualify rank <= 100)"""


# Scores have nine places; a step off the middle makes both engines round to six alike.
@register("rank_vector", "v_vectors", f"with {VECTOR_SQL} select dataset, id, doc, round(score + 1e-10, 6) as score, rank from vec")
def _(t):
    """Every vector asks, all are ranked."""
    vectors = t.vectors.withColumn("dataset", F.lit("all"))
    hits = ranking.rank_vector(vectors.select("dataset", "id", "vec"), vectors.select("dataset", "doc", "vec"))
    return hits.select("dataset", "id", "doc", F.round(F.col("score") + 1e-10, 6).alias("score"), big("rank", "rank"))


@register("rank_vector_pivots", "v_vectors", f"with {VECTOR_SQL} select dataset, id, doc, round(score + 1e-10, 6) as score, rank from vec")
def _(t):
    """The same with queries that are not sent to the tasks."""
    vectors = t.vectors.withColumn("dataset", F.lit("all"))
    hits = ranking.rank_vector(vectors.select("dataset", "id", "vec"), vectors.select("dataset", "doc", "vec"), broadcast_bytes=0)
    return hits.select("dataset", "id", "doc", F.round(F.col("score") + 1e-10, 6).alias("score"), big("rank", "rank"))


def _rrf_sql(label: str, k: str, wb: str, wv: str) -> str:
    return f"""select '{label}' as label, dataset, id, doc, round(sum(s), 9) as score from (select dataset, id, doc, {wb}::double / ({k} + rank) as s from bm25
      union all select dataset, id, doc, {wv}::double / ({k} + rank) from vec) group by all"""


@register(
    "evaluate_ranking",
    "v_vectors",
    """with vv as (select id, label, cast(vec as double[]) as vec from v_vectors),
    cs as (select a.id, a.label, b.label = a.label as rel, b.id as doc, round(list_inner_product(a.vec, b.vec) / sqrt(list_inner_product(a.vec, a.vec)) / sqrt(list_inner_product(b.vec, b.vec)), 9) as score from vv a, vv b),
    r as (select *, row_number() over (partition by id order by score desc, doc) as rk from cs),
    m as (select id, label, max(case when rel and rk <= 3 then 1.0::double else 0 end) as h3, max(case when rel and rk <= 10 then 1.0::double else 0 end) as h10, coalesce(max(case when rel and rk <= 100 then 1.0::double / rk end), 0) as rr,
      sum(case when rel and rk <= 10 then 1 / log2(rk + 1) else 0 end) / list_sum(list_transform(range(1, least(10, cast(sum(case when rel then 1 else 0 end) as bigint)) + 1), lambda i: 1 / log2(i + 1))) as ndcg,
      sum(case when rel and rk <= 100 then 1.0::double else 0 end) / sum(case when rel then 1 else 0 end) as recall from r group by id, label)
    select label, count(*) as n, round(avg(h3), 6) as hit_at_3, round(avg(h10), 6) as hit_at_10, round(avg(rr), 6) as mrr, round(avg(ndcg), 6) as ndcg_at_10, round(avg(recall), 6) as recall_at_100 from m group by label""",
)
def _(t):
    """Rank every vector against all others, then score against its label."""
    vectors = t.vectors.withColumn("dataset", F.lit("all"))
    hits = ranking.rank_vector(vectors.select("dataset", "id", "vec"), vectors.select("dataset", "doc", "vec"), top=100)
    labels = vectors.select("id", "label")
    # The expected set of a query is its whole label; only the ranked part and
    # the size of the set matter, so no list of a label's members is built.
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("wanted"))
    doc_labels = labels.select(F.col("id").alias("doc"), F.col("label").alias("doc_label"))
    asked = labels.join(sizes, "label")
    rows = (
        hits.join(doc_labels, "doc")
        .join(asked, "id")
        .groupBy("id", "label", "wanted")
        .agg(F.sort_array(F.collect_list(F.struct("rank", (F.col("doc_label") == F.col("label")).alias("rel")))).alias("r"))
    )
    out = scoring.graded_metrics(rows.select("label", F.col("r.rel").alias("relevant"), "wanted"))
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), 6).alias(m) for m in METRIC_LIST])


# --- L: streaming ----------------------------------------------------------


@register("stream_fold_audit", "v_audit_events", f"with {FOLD_SQL} select task_id, dataset, stage, status, attempts, last_error, created_at, updated_at from fold")
def _(t):
    """Write the audit log as JSON, stream it into the folded state, read that."""
    root = _logged(t)
    audit.stream_fold_audit(t.spark, f"{root}/log", f"{root}/state", f"{root}/offsets").awaitTermination()
    return audit.read_state(t.spark, f"{root}/state").select("task_id", "dataset", "stage", "status", "attempts", "last_error", "created_at", "updated_at")


@register("stream_status_counts", "v_audit_events", f"with {FOLD_SQL} select dataset, stage, status, count(*) as n from fold group by dataset, stage, status")
def _(t):
    root = _logged(t)
    audit.stream_status_counts(t.spark, f"{root}/log", f"{root}/counts", f"{root}/offsets").awaitTermination()
    return audit.read_counts(t.spark, f"{root}/counts")


def _logged(t) -> str:
    root = f"{shared_folder(t.spark)}/audit-{uuid.uuid4().hex}"
    t.audit_events.write.json(f"{root}/log")
    return root


VECTOR_WHOLE_SQL = """
ev as (select vec_id, cast(embedding as double[]) as vec from embeddings),
cs as (select q.dataset, q.id, 'd' || b.vec_id as doc, round(list_inner_product(a.vec, b.vec) / sqrt(list_inner_product(a.vec, a.vec)) / sqrt(list_inner_product(b.vec, b.vec)), 9) as score
  from v_bench_queries q join ev a on q.id = 'b' || a.vec_id cross join ev b),
vec as (select *, row_number() over (partition by dataset, id order by score desc, doc) as rank from cs qualify rank <= 100)"""
WHOLE_LEGS_SQL = VECTOR_WHOLE_SQL + "," + _bm25_sql("v_bench_queries", "v_bench_corpus", 100)


def _whole_legs(t):
    """Both legs at full depth in one dataset: all documents, and all embeddings. A
    benchmark text asks with the embedding of its number, where there is one."""
    vectors = t.embeddings.select("vec_id", F.col("embedding").alias("vec"))
    asking = t.bench_queries.join(vectors, F.col("id") == F.concat(F.lit("b"), "vec_id")).select("dataset", "id", "vec")
    docs = vectors.select(F.lit("all").alias("dataset"), F.concat(F.lit("d"), "vec_id").alias("doc"), "vec")
    return ranking.rank_bm25(t.bench_queries, t.bench_corpus), ranking.rank_vector(asking, docs)


@register(
    "rank_hybrid",
    "v_bench_queries v_bench_corpus",
    f"with {WHOLE_LEGS_SQL}, f as ({_rrf_sql('x', '60', '0.3', '1.5')}) select dataset, id, doc, round(score, 6) as score, row_number() over (partition by dataset, id order by score desc, doc) as rank from f qualify rank <= 100",
)
def _(t):
    bm25, vec = _whole_legs(t)
    return ranking.rank_hybrid(bm25, vec).select("dataset", "id", "doc", r6("score").alias("score"), big("rank", "rank"))


@register(
    "sweep_hybrid",
    "v_bench_queries v_bench_corpus",
    f"""with {WHOLE_LEGS_SQL}, f as ({_rrf_sql('baseline', '60', '0.3', '1.5')} union all {_rrf_sql('rrf_k=30', '30', '0.3', '1.5')} union all {_rrf_sql('w_bm25=1.0,w_vec=1.0', '60', '1.0', '1.0')})
    select label, dataset, id, doc, round(score, 6) as score, row_number() over (partition by label, dataset, id order by score desc, doc) as rank from f qualify rank <= 100""",
)
def _(t):
    bm25, vec = _whole_legs(t)
    grid = gates.variant_grid(t.bench_queries.select("dataset").distinct(), VARIANTS, BASE_SETTINGS)
    out = ranking.sweep_hybrid(bm25, vec, grid, top=100)
    return out.select("label", "dataset", "id", "doc", r6("score").alias("score"), big("rank", "rank"))


# --- A: written and read back ----------------------------------------------


def _folder(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


@register(
    "write_queries",
    "v_queries",
    """select dataset, pos, id, q, coalesce(array_to_string(expect_any, '|'), '') as expected, expect_none from v_queries where dataset not like '%3'
    union all select dataset, pos, id, 'old', '', null from v_queries where dataset like '%3' and pos < 50""",
)
def _(t):
    """Two exports: the second replaces the datasets that nothing blocks."""
    path = _folder(t, "queries")
    rows = t.queries.select("dataset", "pos", "id", "q", "expect_any", "expect_none")
    none = rows.limit(0).select("dataset", F.lit("").alias("message"))
    sinks.write_queries(rows.where("pos < 50").select("dataset", "pos", "id", F.lit("old").alias("q")), none, path)
    bad = rows.where("dataset like '%3'").select("dataset", F.lit("blocked").alias("message"))
    sinks.write_queries(rows, bad, path, strict=False)
    shape = "pos bigint, id string, q string, expect_any array<string>, expect_none boolean, dataset string"
    back = t.spark.read.schema(shape).json(path)
    return back.select("dataset", "pos", "id", "q", F.coalesce(F.array_join("expect_any", "|"), F.lit("")).alias("expected"), "expect_none")


@register(
    "write_targets",
    "v_assets v_chunks",
    "select 'asset' as kind, dataset, pos, id, doc from v_assets union all select 'chunk', dataset, pos, id, doc from v_chunks",
)
def _(t):
    path = _folder(t, "targets")
    sinks.write_targets(t.assets, t.chunks, path)
    out = None
    for kind in ("asset", "chunk"):
        rows = t.spark.read.parquet(f"{path}/{kind}s").select(F.lit(kind).alias("kind"), "dataset", "pos", "id", "doc")
        out = rows if out is None else out.unionByName(rows)
    return out


@register(
    "write_corpus",
    "v_corpus",
    "select dataset, stem, case when dataset like '%1' then 'again ' || md5(text) else md5(text) end as body from v_corpus",
)
def _(t):
    """All datasets, then some of them anew."""
    path = _folder(t, "corpus")
    docs = t.corpus.select("dataset", "stem", F.md5("text").alias("body"))
    sinks.write_corpus(docs, path)
    sinks.write_corpus(docs.where("dataset like '%1'").withColumn("body", F.concat(F.lit("again "), "body")), path)
    return t.spark.read.parquet(path).select("dataset", "stem", "body")


@register("quarantine", "v_corpus", f"with {REASONS_SQL} select dataset, file_name, case when reasons = '' then 'clean' else 'moved' end as place from reasons")
def _(t):
    path = _folder(t, "quarantine")
    flagged = quality.quality_reasons(t.corpus)
    clean = sinks.quarantine(flagged, path, "20240101", apply=True)
    moved = t.spark.read.parquet(f"{path}/run_ts=20240101")
    here = lambda df, place: df.select("dataset", "file_name", F.lit(place).alias("place"))
    return here(clean, "clean").unionByName(here(moved, "moved"))


@register("write_summary", "v_runs", ORACLES_OF["summarize_runs"])
def _(t):
    path = _folder(t, "summary")
    summary = gates.summarize_runs(t.runs, ["dataset"])
    sinks.write_summary(summary, path)
    return t.spark.read.schema(summary.schema).json(path)


@register("write_ablation", "v_runs", "select dataset as label, concat('| ', dataset, ' | ', max(exit_code), ' | ', printf('%.3f', count(*) / 8), ' | - | - | - | - |') as line from v_runs group by dataset")
def _(t):
    path = _folder(t, "ablation")
    metrics = F.create_map(F.lit("hit_at_3"), F.col("n") / 8)
    rows = t.runs.groupBy("dataset").agg(F.max("exit_code").alias("exit_code"), F.count(F.lit(1)).alias("n"))
    sinks.write_ablation(rows.select(F.col("dataset").alias("label"), "exit_code", metrics.alias("metrics")), path)
    lines = t.spark.read.text(f"{path}/table").select(F.trim(F.split("value", r"\|")[1]).alias("label"), F.col("value").alias("line"))
    known = t.spark.read.json(f"{path}/json").select("label")
    return lines.join(known, "label", "left_semi")


@register(
    "append_task_log",
    "v_results",
    """select task_id, status, cast(source_ord + 1 as int) as attempts, case when status = 'failed' then 'lost' end as last_error, result is not null as answered from v_results""",
)
def _(t):
    """Starts and ends of a run appended to a log, and the state that is read from it."""
    path = _folder(t, "log")
    failed = F.col("status") == "failed"
    results = t.results.select(
        "task_id", "dataset", F.lit("s").alias("stage"), "status", (F.col("source_ord") + 1).cast("int").alias("attempts"), "result",
        F.col("result").alias("raw_response"), F.when(failed, F.lit("lost")).alias("error"), F.lit(False).alias("skipped"),
    )
    sinks.append_task_starts(results, path)
    sinks.append_task_log(results, path)
    state = tasks.fold_audit(readers.read_audit_log(t.spark, path))
    return state.select("task_id", "status", "attempts", "last_error", F.col("result").isNotNull().alias("answered"))


# --- guarded change tables -------------------------------------------------


@register(
    "batch_ledger",
    "v_batches",
    """with old as (select dataset, batch_id, case when status = 'running' and batch_id = 'b-4' and dataset like '%2' then 'failed' else status end as status,
      case when status = 'running' and batch_id = 'b-4' and dataset like '%2' then 'stopped' else error end as error from v_batches),
    free as (select dataset from old group by dataset having count(*) filter (where status = 'running') = 0)
    select dataset, batch_id, status, error from old union all select dataset, 'b-new', 'succeeded', null from free""",
)
def _(t):
    """Stored batches, some failed, a new one started and finished where none was running."""
    table = changes.batches_table(t.spark, _folder(t, "batches"))
    table.add(t.batches)
    current = changes.current_batches(table.read())
    stopped = (F.col("status") == "running") & (F.col("batch_id") == "b-4") & F.col("dataset").like("%2")
    failed = current.where(stopped).select("dataset", "batch_id", F.lit("failed").alias("status"), F.lit("stopped").alias("error"), F.lit("t2").alias("updated_at"))
    changes.close_batches(table, failed)
    fresh = current.select("dataset").distinct().select("dataset", F.lit("b-new").alias("batch_id"), F.lit("t3").alias("created_at"))
    done = changes.start_batches(table, fresh).select(
        "dataset", "batch_id", F.lit("succeeded").alias("status"), F.lit(None).cast("string").alias("error"), F.lit("t4").alias("updated_at")
    )
    changes.close_batches(table, done)
    table.compact(changes.newest_batches)
    return changes.current_batches(table.read()).select("dataset", "batch_id", "status", "error")


@register("add_items", "v_items", "select dataset, batch_id, target_type, target_id, decision, score from v_items")
def _(t):
    table = changes.ChangeTable(t.spark, _folder(t, "items"), REVIEW_ITEMS)
    empty = t.spark.createDataFrame([], REVIEW_ITEMS)
    for part in (F.col("score") < 50, F.col("score") >= 50):
        table.add(empty.unionByName(t.items.where(part), allowMissingColumns=True))
    return table.read().select("dataset", "batch_id", "target_type", "target_id", "decision", "score")


@register("save_decisions", "v_decision_log", ORACLES_OF["upsert_decisions"])
def _(t):
    table = changes.ChangeTable(t.spark, _folder(t, "decisions"), DECISIONS)
    for part in range(3):
        changes.save_decisions(table, t.decision_log.where(F.pmod(F.length("notes"), F.lit(3)) == part))
    d = changes.saved_decisions(table)
    return d.select("dataset", "candidate_id", "decision", "edited_q", joined("edited_expect_any").alias("edited_expect"), "notes", "updated_at")

"""Views that present the given tables in the shapes of ``qrelmill.schemas``.

Each view is one SELECT in the dialect Spark and DuckDB share; ``arr(…)``,
``null_strings`` and ``no_strings`` are spelled per engine. Every view covers
its whole base tables. Arithmetic on the row ids plants the cases the operators
have to find."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import sized

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

LONG_TEXT = ("documents",)

N = "cast(floor(doc_id / 20) as bigint)"
NUM = "cast(doc_id % 20 as int)"
DS = "source || '-' || cast(cast(floor(doc_id / 20000) as bigint) as string)"
NL = "chr(10)"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    # dataset package per source; canonical and other names; every quality rule fires somewhere
    "v_docs": (
        (),
        f"""select {DS} as dataset, {NUM} as num, doc_id, {N} % 1000 as n, lang, text as body, source,
          case when lang = 'en' then 'en' else 'zh' end as prefix from documents""",
    ),
    "v_corpus": (
        ("v_docs",),
        f"""select dataset, num, doc_id, n, prefix,
          case when doc_id % 11 = 0 then 'note-' || cast(n as string)
               else prefix || '-synthetic-' || lpad(cast(n as string), 3, '0') end as stem,
          case when doc_id % 11 = 0 then 'note-' || cast(n as string)
               else prefix || '-synthetic-' || lpad(cast(n as string), 3, '0') end || '.md' as file_name,
          concat(
            case when doc_id % 13 = 0 then '' else concat('---', {NL}, 'title: Doc ', doc_id, {NL}, 'language: ',
              case when prefix = 'zh' and doc_id % 2 = 0 then 'zh-CN' else upper(lang) end, {NL}, 'source: ', source, {NL}, '---', {NL}, {NL}) end,
            '# Doc ', doc_id, {NL}, {NL},
            case when doc_id % 7 = 0 then '' else concat('## Overview', {NL}, {NL}, 'Target: src.doc', doc_id, {NL}, {NL},
              '![Figure ', doc_id, '](./images/', doc_id, '.png)', {NL}, {NL}) end,
            case when prefix = 'zh' and doc_id % 3 <> 1 then concat(repeat('检索评测数据', 60), {NL}, {NL}) else '' end,
            body,
            case when doc_id % 4 = 0 then concat({NL}, {NL}, '## Details', {NL}, {NL}, 'See ![remote](https://example.com/a.png) and ![local](images/',
              doc_id, '.png "t")', {NL}, {NL}, '## Overview', {NL}, {NL}, 'Again ', doc_id) else '' end,
            case when doc_id % 17 = 0 then concat({NL}, {NL}, 'We need this. I will go.') else '' end
          ) as text from v_docs""",
    ),
    "v_datasets": (
        ("v_docs",),
        """select dataset, cast(max(num) as int) as num, 'about ' || dataset as description, max(num) % 9 <> 5 as has_meta, max(num) % 9 <> 6 as has_queries,
          max(num) % 4 <> 3 as has_targets, max(num) % 9 <> 7 as has_corpus from v_docs group by dataset
          union all select lower(p_brand), cast(max(p_size) as int), 'empty shell', true, max(p_size) % 2 = 0, max(p_size) % 3 <> 0, true from part group by p_brand""",
    ),
    "v_asset_files": (
        ("v_docs",),
        """select dataset, concat('images/', doc_id, case when doc_id % 6 = 0 then '.jpg' else '.png' end) as path,
          cast(1 as bigint) as length from v_docs""",
    ),
    "v_thresholds": (
        ("v_datasets",),
        """select dataset, 0 as pos, 'hit_at_3' as key, cast(0.5 + (num % 5) * 0.1 as double) as value, true as numeric from v_datasets
          union all select dataset, 1, 'mrr', cast(0.5 + (num % 5) * 0.1 as double), num % 6 <> 0 from v_datasets
          union all select dataset, 2, case when num % 5 = 0 then 'precision' else 'hit_at_10' end, cast(0.5 + (num % 5) * 0.1 as double), true from v_datasets
          union all select dataset, 3, 'ndcg_at_10', cast(0.5 + (num % 5) * 0.1 as double), true from v_datasets""",
    ),
    "v_assets": (
        ("v_corpus",),
        """select dataset, cast(n + 1 as int) as pos, doc_id % 59 <> 0 as is_mapping,
          case when doc_id % 41 = 0 then '' else concat('asset-', doc_id) end as id,
          case when doc_id % 43 = 0 then 'ghost' else stem end as doc,
          case when doc_id % 61 = 0 then '' else concat('./images/', doc_id, '.png') end as path,
          case when doc_id % 47 = 0 then '' when doc_id % 5 = 0 then 'Absent' else 'Overview' end as heading,
          concat('src.doc', doc_id) as anchor from v_corpus""",
    ),
    "v_chunks": (
        ("v_corpus",),
        """select dataset, cast(n + 1 as int) as pos, doc_id % 67 <> 0 as is_mapping,
          case when doc_id % 37 = 0 then '' else concat('chunk-', doc_id) end as id,
          case when doc_id % 53 = 0 then 'ghost' else stem end as doc,
          case when doc_id % 71 = 0 then '' when doc_id % 6 = 1 then 'Details' else 'Overview' end as heading,
          case when doc_id % 73 = 0 then '' when doc_id % 10 = 3 then 'nowhere' else concat('src.doc', doc_id) end as anchor,
          case when doc_id % 3 = 0 then concat('asset-', case when doc_id % 15 = 0 then -1 else doc_id end)
               when doc_id % 31 = 1 then 'asset-0' end as asset_id,
          case when doc_id % 3 = 1 then arr(concat('asset-', doc_id), case when doc_id % 7 = 2 then '' when doc_id % 7 = 3 then 'ghost' else concat('asset-', doc_id) end)
               when doc_id % 3 = 2 and doc_id % 4 = 1 then no_strings else null_strings end as asset_ids,
          case when doc_id % 3 = 1 then 'list' when doc_id % 3 = 2 and doc_id % 4 = 1 then 'bad' else 'absent' end as asset_ids_kind
          from v_corpus""",
    ),
    "v_queries": (
        ("v_corpus",),
        """select dataset, cast(n + 1 as int) as pos, doc_id % 79 <> 0 as is_mapping,
          case when doc_id % 19 = 0 then ' ' when doc_id % 23 = 0 then 'dup' else concat(prefix, '-q', doc_id) end as id,
          case when doc_id % 83 = 0 then '' else concat('Which passage has digest ', md5(text_body), '?') end as q,
          case when doc_id % 5 = 0 then 'asset' else 'text_chunk' end as query_type,
          case when doc_id % 9 = 0 then null_strings when doc_id % 29 = 0 then arr(stem, concat('missing-', doc_id)) else arr(stem) end as expect_any,
          case when doc_id % 9 = 0 then 'absent' when doc_id % 89 = 0 then 'other' else 'list' end as expect_any_kind,
          (doc_id % 18 = 0 or doc_id % 31 = 0) as expect_none,
          case when doc_id % 37 = 0 then no_strings when doc_id % 8 = 0 then arr(concat('asset-', doc_id), 'ghost') else null_strings end as expect_asset_any,
          case when doc_id % 37 = 0 then 'bad' when doc_id % 8 = 0 then 'list' else 'absent' end as expect_asset_kind,
          case when doc_id % 97 = 0 then no_strings when doc_id % 10 = 0 then arr(concat('chunk-', doc_id)) else null_strings end as expect_chunk_any,
          case when doc_id % 97 = 0 then 'bad' when doc_id % 10 = 0 then 'list' else 'absent' end as expect_chunk_kind
          from (select c.*, d.text as text_body from v_corpus c join documents d on c.doc_id = d.doc_id)""",
    ),
    # ranked lists: the lines of an order by price, relevant = returned lines
    "v_lines": (
        (),
        """select o_orderkey, concat('run-', cast(o_custkey % 7 as string)) as run_id,
          case o_orderstatus when 'F' then 'bm25' when 'O' then 'vector' else 'hybrid' end as mode,
          concat(case substr(o_orderpriority, 1, 1) when '1' then 'zh-' when '2' then 'en-' else '' end, 'q', o_orderkey) as id,
          concat(l_partkey, '#', l_linenumber, '#', cast(round(l_extendedprice * 100) as bigint)) as doc,
          l_extendedprice as price, l_returnflag = 'R' as relevant, l_linestatus = 'O' as open_line,
          row_number() over (partition by o_orderkey order by l_extendedprice desc, l_partkey, l_linenumber) as rk
          from lineitem join orders on l_orderkey = o_orderkey""",
    ),
    "v_per_query": (
        ("v_lines",),
        """select o_orderkey, run_id, mode, id, max(price) as top_price,
          ordered_docs as ranked, relevant_docs as expect_any, open_docs as expect_asset_any
          from v_lines group by o_orderkey, run_id, mode, id""",
    ),
    # scores: negatives are the orders without a returned line; every seventh has no score
    "v_scored": (
        ("v_lines",),
        """select run_id, o_orderkey as pos, concat('q', o_orderkey) as q, max(case when relevant then 1 else 0 end) = 0 as negative,
          case when o_orderkey % 7 = 3 or run_id = 'run-5' then null else max(price) / cast(105000 as double) end as score,
          max(case when rk = 1 then doc end) as top_doc
          from v_lines group by run_id, o_orderkey""",
    ),
    # audit log: one task per user and event type
    "v_audit_events": (
        (),
        """select md5(concat(user_id, ':', event_type)) as task_id, concat('ds-', cast(user_id % 13 as string)) as dataset, event_type as stage,
          case when event_id % 3 = 0 then 'start' else 'finish' end as kind, event_id as seq,
          case when event_id % 3 = 0 then null when value < 20 then 'failed' when value < 30 then 'needs_manual_review' else 'succeeded' end as status,
          cast(1 + event_id % 6 as int) as attempts,
          case when value < 20 then concat('error ', event_id) end as last_error,
          concat('raw ', event_id) as raw_response, props as result, ts_text as ts
          from (select *, iso(ts) as ts_text from events)""",
    ),
    "v_attempts": (
        (),
        """select concat('task-', user_id, '-', event_type) as task_id,
          cast(row_number() over (partition by user_id, event_type order by event_id) as int) as attempt,
          cast(case when value < 8 then 429 when value < 12 then 529 when value < 15 then 500 when value < 16 then 401
               when value < 17 then 404 when value < 30 then 200 end as int) as status_code,
          case when value < 17 then null when value < 20 then ' ' when value < 22 then concat(' ', chr(10), chr(9)) else concat('ok ', event_id) end as body,
          case when value < 17 then concat('http error ', event_id) end as error
          from events""",
    ),
    # candidate lines: conversation turns as drafted queries
    "v_turns": (
        (),
        """select concat('ds-', cast(conv_id % 10 as string)) as dataset, conv_id, turn, role, conv_id * 1000 + turn as line_no,
          replace(text, chr(10), concat(chr(92), 'n')) as esc, text from conversations""",
    ),
    "v_candidate_lines": (
        ("v_turns",),
        """select dataset, conv_id, turn, line_no,
          case when conv_id % 10 < 5 then 'direct' else 'audit' end as source,
          case
            when line_no % 17 = 5 then 'not json'
            when line_no % 13 = 0 then concat('[{"q": "list ', line_no, '"}, 3, {"q": "list b ', line_no, '", "expect_any": "[a, b]"}]')
            when conv_id % 10 < 5 then concat('{"', case when turn % 2 = 0 then 'q' else 'corrected_q' end, '": "', esc, '", ',
               case when line_no % 3 = 0 then concat('"id": "cand-', cast(line_no % 50 as string), '", ') else '' end,
               '"expect_any": ["doc-', line_no, '", " x "], "evidence": "', role, '", "confidence": 0.5}')
            else concat('{"stage": "', case when turn % 3 = 2 then 'other' else 'generate_candidates' end, '", "status": "',
               case when line_no % 5 = 4 then 'failed' else 'succeeded' end, '", "result": [{"q": "', esc, '", "expect_none": ',
               case when turn % 2 = 0 then 'true' else 'false' end, '}, {"q": " "}]}')
          end as value from v_turns""",
    ),
    "v_decision_log": (
        ("v_turns",),
        """select dataset, concat('cand-', cast(line_no % 50 as string)) as candidate_id,
          case line_no % 4 when 0 then 'approve' when 1 then 'rewrite' when 2 then 'reject' else 'pending' end as decision,
          case when line_no % 4 = 1 then concat(' edited ', line_no, ' ') else '' end as edited_q,
          case when line_no % 8 = 1 then arr(concat('doc-', line_no)) else no_strings end as edited_expect_any,
          concat('note ', line_no) as notes, concat('2024-01-01T00:00:', lpad(cast(line_no as string), 9, '0')) as updated_at
          from v_turns""",
    ),
    # review batches and items from the document labels
    "v_batches": (
        ("v_docs",),
        """select dataset, concat('b-', cast(n % 5 as string)) as batch_id,
          case when max(num) % 3 = 0 and n % 5 = 4 then 'running' else 'succeeded' end as status, cast(null as string) as error,
          concat('2024-01-0', cast(n % 5 + 1 as string)) as created_at, concat('2024-01-0', cast(n % 5 + 1 as string)) as updated_at
          from v_docs group by dataset, n % 5""",
    ),
    "v_items": (
        ("v_docs",),
        """select d.dataset, concat('b-', cast(d.n % 5 as string)) as batch_id, case when d.doc_id % 2 = 0 then 'query' else 'corpus_doc' end as target_type,
          concat('t-', cast(d.n % 40 as string)) as target_id,
          case when l.toxic = 1 then 'fail' when l.quality = 1 then 'pass' when d.doc_id % 50 = 3 then 'skip' else 'warn' end as decision,
          cast(d.doc_id % 101 as int) as score
          from v_docs d join labels l on d.doc_id = l.doc_id""",
    ),
    "v_targets": (
        ("v_docs",),
        """select dataset, 1 as kind_ord, doc_id as pos, '' as name, case when doc_id % 2 = 0 then 'query' else 'corpus_doc' end as target_type,
          concat('t-', n) as target_id, concat('{"doc":', doc_id, '}') as payload from v_docs""",
    ),
    # review responses: one result per document batch of eight
    "v_review_results": (
        ("v_docs",),
        """select dataset, concat('b-', cast(n % 5 as string)) as batch_id, concat('task-', doc_id) as task_id,
          case when doc_id % 11 = 0 then 'failed' else 'succeeded' end as status,
          case when doc_id % 11 = 0 then concat('error ', doc_id) end as error,
          case when doc_id % 7 = 0 then concat('{"items": [', item_a, ', ', item_b, ']}')
               when doc_id % 13 = 0 then '{"oops": 1}'
               else concat('[', item_a, ']') end as result,
          doc_id
          from (select v_docs.*,
            concat('{"target_type": "query", "target_id": " t-', n, ' ", "decision": "', case when doc_id % 17 = 0 then 'maybe' when doc_id % 2 = 0 then 'WARN' else 'pass' end,
              '", "score": ', case when doc_id % 5 = 0 then '"87.9"' when doc_id % 5 = 1 then '140' when doc_id % 5 = 2 then '-3' when doc_id % 5 = 3 then '"n/a"' else '55.5' end,
              ', "reason": "r', doc_id, '", "risk_flags": ', case when doc_id % 3 = 0 then '"duplicate"' else '["a", 3, " "]' end, '}') as item_a,
            concat('{"target_type": "', case when doc_id % 21 = 0 then '' else 'corpus_doc' end, '", "target_id": "d-', doc_id, '", "decision": "fail", "score": null}') as item_b
            from v_docs)""",
    ),
    # catalogue rows from parts: brand = category, part = item
    "v_items_catalog": (
        (),
        """select concat('cat-', cast(p_size % 3 as string)) as dataset, replace(lower(p_brand), '#', '-') as category,
          concat('Title ', p_brand) as title, concat('Intro ', p_brand) as intro, lower(p_type) as image_dir,
          p_partkey as pos, concat('item_', p_partkey) as slug, concat('zh', p_partkey) as zh, p_name as en,
          concat('desc ', p_type) as desc, concat('visual ', p_size) as visual, concat('use ', p_brand) as use,
          concat('asset query ', p_partkey) as asset_query, concat('chunk query ', p_partkey) as chunk_query
          from part""",
    ),
    "v_groups": (
        (),
        """select concat('cat-', cast(s_nationkey % 3 as string)) as dataset, concat('sets-', cast(s_nationkey % 4 as string)) as doc,
          concat('Sets ', cast(s_nationkey % 4 as string)) as title, 'Intro' as intro, s_suppkey as pos, concat('g', s_suppkey) as slug,
          concat('zh', s_suppkey) as zh, s_name as en, arr(concat('a.', s_suppkey, '.image'), 'b.x.image') as assets,
          arr(concat('images/a/', s_suppkey, '.png'), 'images/b/x.png') as image_paths,
          concat('summary ', s_suppkey) as summary, concat('detail ', s_nationkey) as detail,
          concat('cq ', s_suppkey) as chunk_query, concat('aq ', s_suppkey) as asset_query from supplier""",
    ),
    "v_topics": (
        ("v_docs",),
        """select dataset, n as pos, concat('topic-', doc_id) as stem, case when doc_id % 9 = 0 then '' else lang end as language,
          concat('Topic ', doc_id) as title, concat('What is topic ', doc_id, '?') as question, body from v_docs""",
    ),
    "v_cluster_docs": (
        (),
        """select concat('cl-', cast(c_nationkey % 5 as string)) as dataset, concat('cust', cast(c_custkey % 211 as string)) as cluster,
          c_custkey as pos, concat('s', c_custkey) as slug, concat('cust', cast(c_custkey % 211 as string), '-s', c_custkey) as stem,
          case when c_custkey % 211 % 2 = 0 then 'zh' else 'en' end as language, c_name as title, c_mktsegment as focus
          from customer""",
    ),
    # writing-task results per document
    "v_results": (
        ("v_docs",),
        """select dataset, concat('w-', doc_id) as task_id, cast(doc_id % 2 as int) as source_ord, doc_id as ord,
          case when doc_id % 14 = 0 then 'failed' else 'succeeded' end as status,
          case when doc_id % 3 = 0 then concat('{"text": "', case when doc_id % 33 = 0 then '  ' else concat(case when doc_id % 2 = 0 then '# H ' else '' end, 'body ', doc_id) end, '"}')
               when doc_id % 3 = 1 then concat('[{"stem": "Doc ', cast(n % 30 as string), '", "title": "T ', doc_id, '", "language": "EN", "markdown": "md ', doc_id, '"}, 5]')
               else concat('{"markdown": " md ', doc_id, ' ", "language": null}') end as result
          from v_docs""",
    ),
    "v_meta": (
        ("v_docs",),
        """select dataset, concat('w-', d.doc_id) as task_id, concat('Stem ', cast(n % 45 as string)) as stem, lang as language,
          concat('Meta ', d.doc_id) as title from v_docs d join labels l on d.doc_id = l.doc_id""",
    ),
    "v_cluster_results": (
        ("v_cluster_docs",),
        """select dataset, concat('q-', stem) as task_id, cluster, case when pos % 10 = 0 then 'failed' else 'succeeded' end as status,
          concat('[{"stem": "', case when pos % 7 = 0 then 'other' else stem end, '", "q": "', case when pos % 9 = 0 then ' ' else concat('ask ', pos) end, '"}, 1]') as result
          from v_cluster_docs""",
    ),
    # model responses from conversation turns
    "v_responses": (
        ("v_turns",),
        """select dataset, line_no as task_no, line_no % 5 <> 0 as expected_json,
          case line_no % 6 when 0 then concat('```json', chr(10), '{"t": ', line_no, '}', chr(10), '```')
            when 1 then concat('Answer: [', line_no, ', 2] done')
            when 2 then concat('{"a": ', line_no)
            when 3 then text when 4 then concat(' {"a": {"b": ', line_no, '}} ') else cast(line_no as string) end as raw,
          case line_no % 4 when 0 then concat('{"fixed": ', line_no, '}') when 1 then 'still broken' else cast(null as string) end as repaired
          from v_turns""",
    ),
    # evaluation output lines: per customer nation one run with several reports
    "v_report_lines": (
        ("v_lines",),
        """select run_id, cast(o_orderkey as bigint) as line_no,
          case when o_orderkey % 11 = 0 then '{"event": "progress"}'
               when o_orderkey % 13 = 0 then 'not json'
               else concat('{"metrics": {"mrr": ', cast(count(*) as string), '}, ',
                 case when o_orderkey % 3 = 0 then '"passed": true, ' else '' end,
                 '"per_query": [', json_rows, ']}') end as value, count(*) as n_rows
          from v_lines group by run_id, o_orderkey""",
    ),
    # change log: one change per page host
    "v_added": (
        (),
        """select concat('change-', cast(page_id % 17 as string)) as change_id, page_id as line_no,
          case when page_id % 17 % 5 = 4 and page_id % 6 in (0, 2) then 'recall that'
            when page_id % 6 = 0 then concat('## 2026-06-', lpad(cast(page_id % 28 + 1 as string), 2, '0'), ' entry')
            when page_id % 6 = 1 then concat('### 1.0.', page_id) when page_id % 6 = 2 and page_id % 17 % 3 <> 0 then concat('ndcg_at_10 0.', page_id)
            when page_id % 6 = 3 then 'recall that' when page_id % 6 = 4 then html else '## 1.2.3' end as text
          from pages""",
    ),
    "v_headers": (
        (),
        """select concat('change-', cast(page_id % 17 as string)) as change_id,
          case when page_id % 17 % 2 = 0 and page_id % 2 = 0 then concat('## 2026-06-', lpad(cast(page_id % 28 + 1 as string), 2, '0'), ' entry')
            when page_id % 2 = 0 then '## 2025-01-01 older' else '## 1.2.3' end as header
          from pages""",
    ),
    "v_changed": (
        (),
        """select concat('change-', cast(page_id % 17 as string)) as change_id,
          case when page_id % 17 % 6 = 5 then url else concat('datasets/', page_id) end as path from pages""",
    ),
    # evaluation runs and measured metrics per nation and mode
    "v_runs": (
        (),
        """select concat('ds-', cast(o_custkey % 25 as string)) as dataset, o_orderpriority as mode, o_orderkey as run_no,
          cast(case when o_totalprice < 5000 then 2 when o_totalprice < 40000 and o_custkey % 25 > 4 then 1
            when o_orderkey % 4001 = 7 then 3 else 0 end as int) as exit_code from orders""",
    ),
    "v_vectors": ((), """select concat('v-', cast(label as string)) as dataset, concat('e', vec_id) as id, concat('e', vec_id) as doc, embedding as vec, label from embeddings"""),
    "v_bench_queries": (
        (),
        """select case when item_id < 0 then 'none' else 'all' end as dataset, concat('b', item_id) as id, text as q from benchmark""",
    ),
    "v_bench_corpus": ((), """select case when doc_id < 0 then 'none' else 'all' end as dataset, concat('d', doc_id) as stem, text from documents"""),
}

SPARK_SPELLING = {
    "null_strings": "cast(null as array<string>)",
    "no_strings": "cast(array() as array<string>)",
    "arr(": "array(",
    "iso(ts)": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
    "ordered_docs": "transform(array_sort(collect_list(struct(rk, doc))), x -> x.doc)",
    "relevant_docs": "transform(array_sort(collect_list(case when relevant then struct(rk, doc) end)), x -> x.doc)",
    "open_docs": "transform(array_sort(collect_list(case when open_line then struct(rk, doc) end)), x -> x.doc)",
    "json_rows": "array_join(transform(array_sort(collect_list(struct(rk, doc))), x -> concat('{\"id\": \"', x.doc, '\"}')), ', ')",
}
DUCKDB_SPELLING = {
    "null_strings": "cast(null as varchar[])",
    "no_strings": "cast([] as varchar[])",
    "arr(": "list_value(",
    "iso(ts)": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
    "ordered_docs": "list(doc order by rk)",
    "relevant_docs": "coalesce(list(doc order by rk) filter (where relevant), [])",
    "open_docs": "coalesce(list(doc order by rk) filter (where open_line), [])",
    "json_rows": "string_agg(concat('{\"id\": \"', doc, '\"}'), ', ' order by rk)",
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(name: str) -> None:
        for dep in VIEWS[name][0]:
            visit(dep)
        if name not in out:
            out.append(name)

    for name in names:
        visit(name)
    return out


def with_clause(names: list[str], spelling: dict[str, str]) -> str:
    parts = []
    for name in _closure(names):
        sql = VIEWS[name][1]
        for word, text in spelling.items():
            sql = sql.replace(word, text)
        parts.append(f"{name} as ({sql})")
    return "with " + ",\n".join(parts)


def duck(names: str, select: str) -> str:
    """A DuckDB statement over the named views; view names separated by blanks."""
    extra = ""
    if select.lstrip().lower().startswith("with "):
        select = select.lstrip()[5:]
        extra = ", "
        return with_clause(names.split(), DUCKDB_SPELLING) + extra + select
    return (with_clause(names.split(), DUCKDB_SPELLING) + "\n" if names else "") + select


class Tables:
    """The views over one scale-factor folder, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._known: dict[str, DataFrame] = {}
        self._paths: list[str] = []
        sized(spark, ())

    def base(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._read(name)
        return self._known[name]

    def _read(self, name: str) -> DataFrame:
        self._paths.append(f"{self.sf_dir}/{name}.parquet")
        sized(self.spark, self._paths)
        df = self.spark.read.parquet(self._paths[-1])
        tasks = self.spark.sparkContext.defaultParallelism
        if name in LONG_TEXT and df.rdd.getNumPartitions() < tasks:
            # One small file is one task; text work needs all cores.
            df = df.repartition(tasks)
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in TABLES:
            return self.base(name)
        view = "v_" + name
        if view not in VIEWS:
            raise AttributeError(name)
        if view not in self._known:
            sql = with_clause([view], SPARK_SPELLING)
            for table in TABLES:
                if f" {table}" in sql:
                    self.base(table).createOrReplaceTempView(table)
            self._known[view] = self.spark.sql(f"{sql} select * from {view}")
        return self._known[view]

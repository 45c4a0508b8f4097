"""DuckDB oracle SQL for every registered query.

Each statement restates the semantics in plain SQL over the pre-registered
views (region ... conversations). Shared fixed tables (message pool, lexicon)
are rendered from the same Python constants the Spark side uses; the logic is
written independently (joins and GROUP BY where Spark uses row-local maps).
"""

from __future__ import annotations

from feedlens.functions import lexicon as lx
from feedlens.sources import tables as tb


def _q(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def _values(rows) -> str:
    return ",\n    ".join("(" + ", ".join(_q(v) if isinstance(v, str) or v is None else str(v)
                                         for v in r) + ")" for r in rows)


POOL = f"pool(k, msg) AS (VALUES\n    {_values(list(enumerate(tb.MESSAGE_POOL)))})"
LEX = f"lex(word, pol_milli, kind) AS (VALUES\n    {_values(lx.seed_lexicon())})"

ISO = "strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') || '+0000'"

FEED = f"""feed AS (
  SELECT 'p' || CAST(e.event_id // 4 AS VARCHAR) AS id,
         {ISO.format(x="date_trunc('hour', e.ts)")} AS created_time,
         pp.msg AS message,
         CAST(100 + ((e.event_id // 4) * 37) % 901 AS BIGINT) AS total_count,
         'c' || CAST(e.event_id AS VARCHAR) AS comment_id,
         {ISO.format(x="e.ts")} AS comment_created_time,
         cp.msg AS comment_message,
         CAST(floor(e.value) AS BIGINT) AS comment_likes,
         CAST(e.ts AS DATE) AS comment_date,
         e.event_id // 4 AS post_no
  FROM events e
  LEFT JOIN pool cp ON cp.k = e.event_id % 12
  LEFT JOIN pool pp ON pp.k = (e.event_id // 4) % 12)"""


def scored_cte(src: str, key: str, text: str, name: str = "scored") -> str:
    """CTEs that score ``src.text`` per ``key`` by explode + lexicon join."""
    return f"""toks_{name} AS (
  SELECT {key} AS k, ws, unnest(generate_series(1, len(ws))) AS i
  FROM (SELECT {key}, regexp_extract_all(lower({text}), '\\p{{L}}+') AS ws FROM {src})),
hits_{name} AS (
  SELECT t.k,
         CASE WHEN m.kind = 'neg' THEN -(l.pol_milli // 2)
              WHEN m.kind = 'boost' THEN greatest(-1000, least(1000, l.pol_milli + l.pol_milli // 2))
              ELSE l.pol_milli END AS v
  FROM toks_{name} t
  JOIN lex l ON l.word = t.ws[t.i] AND l.kind = 'pol'
  LEFT JOIN lex m ON t.i > 1 AND m.word = t.ws[t.i - 1] AND m.kind IN ('neg', 'boost')),
agg_{name} AS (SELECT k, sum(v) AS s, count(*) AS n FROM hits_{name} GROUP BY k),
{name} AS (
  SELECT x.*,
         CASE WHEN x.{text} IS NULL THEN NULL
              WHEN a.n IS NULL THEN 0.0
              ELSE CAST(a.s AS DOUBLE) / (CAST(1000.0 AS DOUBLE) * a.n) END AS sentiment_score
  FROM {src} x LEFT JOIN agg_{name} a ON a.k = x.{key})"""


COMMENTS = f"WITH {POOL},\n{LEX},\n{FEED},\n{scored_cte('feed', 'comment_id', 'comment_message')}"

CATEGORY = """CASE WHEN sentiment_score >= 0.5 THEN 'Promoter'
            WHEN sentiment_score >= 0.1 AND sentiment_score < 0.5 THEN 'Passive'
            ELSE 'Detractor' END"""
LABEL = """CASE WHEN sentiment_score > 0 THEN 'Positive'
            WHEN sentiment_score < 0 THEN 'Negative' ELSE 'Neutral' END"""

SQL: dict[str, str] = {}

SQL["daily_nps_csat"] = f"""{COMMENTS}
SELECT comment_date,
       count(*) AS total_comments,
       count(*) FILTER (WHERE {CATEGORY} = 'Promoter') AS promoters,
       count(*) FILTER (WHERE {CATEGORY} = 'Detractor') AS detractors,
       CAST(sum(CASE WHEN sentiment_score >= 0.4 THEN 1 ELSE 0 END) AS BIGINT) AS csat_positive,
       (CAST(count(*) FILTER (WHERE {CATEGORY} = 'Promoter') - count(*) FILTER (WHERE {CATEGORY} = 'Detractor') AS DOUBLE)
          / count(*)) * 100 AS NPS,
       (CAST(sum(CASE WHEN sentiment_score >= 0.4 THEN 1 ELSE 0 END) AS DOUBLE) / count(*)) * 100 AS CSAT
FROM scored GROUP BY comment_date"""

SQL["overall_csat"] = f"""{COMMENTS}
SELECT count(*) AS total_comments,
       count(*) FILTER (WHERE sentiment_score >= 0.1) AS satisfied,
       CASE WHEN count(*) = 0 THEN NULL
            ELSE (CAST(count(*) FILTER (WHERE sentiment_score >= 0.1) AS DOUBLE) / count(*)) * 100 END AS csat_score
FROM scored"""

SQL["overall_nps"] = f"""{COMMENTS}
SELECT count(*) AS total_comments,
       count(*) FILTER (WHERE {CATEGORY} = 'Promoter') AS promoters,
       count(*) FILTER (WHERE {CATEGORY} = 'Passive') AS passives,
       count(*) FILTER (WHERE {CATEGORY} = 'Detractor') AS detractors,
       CASE WHEN count(*) = 0 THEN NULL ELSE
         (CAST(count(*) FILTER (WHERE {CATEGORY} = 'Promoter') - count(*) FILTER (WHERE {CATEGORY} = 'Detractor') AS DOUBLE)
          / count(*)) * 100 END AS nps
FROM scored"""

SQL["category_distribution"] = f"""{COMMENTS}
SELECT {CATEGORY} AS sentiment_category, count(*) AS count FROM scored GROUP BY 1"""

SQL["daily_sentiment_trend"] = f"""{COMMENTS}
SELECT comment_date, {LABEL} AS sentiment_label, count(*) AS count
FROM scored GROUP BY 1, 2 ORDER BY 1, 2"""

SQL["daily_net_sentiment"] = f"""{COMMENTS}
SELECT comment_date, count(*) AS total_comments,
       count(*) FILTER (WHERE sentiment_score > 0) AS positives,
       count(*) FILTER (WHERE sentiment_score < 0) AS negatives,
       count(*) FILTER (WHERE sentiment_score > 0) - count(*) FILTER (WHERE sentiment_score < 0) AS net_sentiment_score,
       (CAST(count(*) FILTER (WHERE sentiment_score > 0) - count(*) FILTER (WHERE sentiment_score < 0) AS DOUBLE)
          / count(*)) * 100 AS net_sentiment_pct
FROM scored GROUP BY comment_date ORDER BY comment_date"""

DOCS = f"WITH {LEX},\n{scored_cte('documents', 'doc_id', 'text')}"

SQL["document_sentiment"] = f"""{DOCS}
SELECT doc_id, lang, CAST(len(regexp_extract_all(lower(text), '\\p{{L}}+')) AS BIGINT) AS n_words,
       sentiment_score, {LABEL} AS sentiment_label
FROM scored"""

SQL["sentiment_by_lang"] = f"""{DOCS}
SELECT lang, count(*) AS n_docs,
       count(*) FILTER (WHERE sentiment_score > 0) AS n_positive,
       count(*) FILTER (WHERE sentiment_score < 0) AS n_negative,
       count(*) FILTER (WHERE NOT (sentiment_score > 0 OR sentiment_score < 0) OR sentiment_score IS NULL) AS n_neutral,
       min(sentiment_score) AS min_score, max(sentiment_score) AS max_score
FROM scored GROUP BY lang"""

SQL["conversation_sentiment"] = f"""WITH {LEX},
turns AS (SELECT row_number() OVER () AS turn_key, role, text FROM conversations),
{scored_cte('turns', 'turn_key', 'text')}
SELECT role, {LABEL} AS sentiment_label, count(*) AS n_turns,
       CAST(sum(len(regexp_extract_all(lower(text), '\\p{{L}}+'))) AS BIGINT) AS total_words
FROM scored GROUP BY 1, 2"""

SQL["conversation_sentiment_plugged"] = SQL["conversation_sentiment"]

LEARNT = """labelled AS (SELECT d.doc_id, d.text, l.quality FROM documents d JOIN labels l USING (doc_id)
             WHERE d.doc_id % 2 = 0 AND l.quality IN (0, 1)),
sizes AS (SELECT count(*) FILTER (WHERE quality = 1) AS np, count(*) FILTER (WHERE quality = 0) AS nn FROM labelled),
seen AS (SELECT DISTINCT rid, quality, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS word
         FROM (SELECT row_number() OVER () AS rid, * FROM labelled)),
counts AS (SELECT word, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality = 0) AS n FROM seen GROUP BY word),
odds AS (SELECT word, ln((p + 1.0::DOUBLE) / (np + 2.0::DOUBLE)) - ln((n + 1.0::DOUBLE) / (nn + 2.0::DOUBLE)) AS o FROM counts, sizes
         WHERE p + n >= 3 AND least(np, nn) > 0),
learnt AS (SELECT word, CAST(floor(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, o / 3.0::DOUBLE)) * 500.0::DOUBLE + 0.5::DOUBLE) * 2 AS INTEGER) AS pol_milli,
                  'pol' AS kind FROM odds)"""

SQL["induced_lexicon"] = f"""WITH {LEARNT}
SELECT * FROM learnt WHERE abs(pol_milli) >= 100"""

SQL["induced_sentiment"] = f"""WITH {LEX},
{LEARNT},
lex2 AS (SELECT * FROM learnt WHERE abs(pol_milli) >= 100 AND word NOT IN (SELECT word FROM lex WHERE kind <> 'pol')
         UNION ALL SELECT word, 0, kind FROM lex WHERE kind <> 'pol'),
held AS (SELECT d.doc_id, d.lang, d.text, l.quality AS label FROM documents d JOIN labels l USING (doc_id) WHERE d.doc_id % 2 = 1),
{scored_cte('held', 'doc_id', 'text', 'seeded')},
{scored_cte('held', 'doc_id', 'text', 'taught').replace("JOIN lex ", "JOIN lex2 ")}
SELECT s.lang, count(*) AS n_texts,
       count(*) FILTER (WHERE (coalesce(s.sentiment_score, 0) > 0) = (s.label = 1)) AS n_agree_seed,
       count(*) FILTER (WHERE (coalesce(t.sentiment_score, 0) > 0) = (s.label = 1)) AS n_agree_learnt
FROM seeded s JOIN taught t USING (doc_id) GROUP BY s.lang"""

NESTED_POSTS = f"""{FEED},
posts AS (
  SELECT post_no, id, message, total_count, min(created_time) AS created_time
  FROM feed GROUP BY post_no, id, message, total_count),
ann AS (
  SELECT 'a' || CAST(c_custkey AS VARCHAR) AS id, '2024-01-01T00:00:00.000000+0000' AS created_time,
         'Welcome ' || c_name AS message, CAST(c_custkey % 1000 AS BIGINT) AS total_count,
         c_custkey % 2 = 0 AS no_object
  FROM customer)"""

SQL["flatten_posts"] = f"""WITH {POOL},
{NESTED_POSTS}
SELECT p.id, p.created_time, p.message, p.total_count, f.comment_id, f.comment_created_time,
       f.comment_message, f.comment_likes
FROM feed f JOIN posts p ON p.post_no = f.post_no"""

SQL["flatten_posts_outer"] = f"""WITH {POOL},
{NESTED_POSTS}
SELECT p.id, p.created_time, p.message, p.total_count, f.comment_id, f.comment_created_time,
       f.comment_message, f.comment_likes
FROM feed f JOIN posts p ON p.post_no = f.post_no
UNION ALL
SELECT id, created_time, message, total_count, NULL, NULL, NULL, NULL FROM ann"""

SQL["usage_cost"] = """WITH usage AS (
  SELECT CASE WHEN user_id = 7 THEN NULL ELSE 'user' || CAST(user_id AS VARCHAR) || '@example.com' END AS owned_by,
         CAST(ts AS DATE) AS usage_date,
         CASE event_type WHEN 'view' THEN 'STANDARD_ALL_PURPOSE_COMPUTE'
                         WHEN 'click' THEN 'ENTERPRISE_SERVERLESS_SQL_COMPUTE'
                         WHEN 'signup' THEN 'STANDARD_JOBS_COMPUTE'
                         WHEN 'error' THEN 'PREMIUM_ALL_PURPOSE_COMPUTE_SERVERLESS_SQL'
                         WHEN 'purchase' THEN 'STANDARD_DLT_CORE' ELSE 'OTHER' END AS sku_name,
         CAST(value AS DECIMAL(12, 2)) AS usage_quantity
  FROM events)
SELECT owned_by AS user_email, usage_date, sku_name,
       CAST(SUM(usage_quantity) AS DOUBLE) AS total_dbu_used,
       CAST(CASE WHEN sku_name LIKE '%ALL_PURPOSE_COMPUTE%' THEN SUM(usage_quantity) * 0.15
                 WHEN sku_name LIKE '%SERVERLESS_SQL%' THEN SUM(usage_quantity) * 0.22
                 ELSE SUM(usage_quantity) * 0.10 END AS DOUBLE) AS estimated_cost_usd
FROM usage
WHERE owned_by IS NOT NULL
GROUP BY user_email, usage_date, sku_name
ORDER BY usage_date DESC"""

BASE = """base AS (
  SELECT CASE WHEN o_orderkey % 500 = 13 THEN NULL ELSE o_orderkey END AS o_orderkey,
         o_custkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus, o_totalprice,
         CAST(o_orderdate AS DATE) AS o_orderdate, NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority,
         CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS cust_ref
  FROM orders)"""
COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, cust_ref"
BAD_REF = "(cust_ref IS NOT NULL AND TRY_CAST(cust_ref AS INTEGER) IS NULL)"
MULTI_MSG = f"""concat_ws(' | ',
    CASE WHEN o_orderstatus IS NULL THEN 'Column o_orderstatus is null' END,
    CASE WHEN o_orderpriority IS NULL THEN 'Column o_orderpriority is null' END,
    CASE WHEN {BAD_REF} THEN 'Column cust_ref is not INT' END)"""

SQL["null_rule_errors"] = f"""WITH {BASE}
SELECT {COLS}, 'Column o_orderpriority is null' AS error_message FROM base WHERE o_orderpriority IS NULL"""

SQL["multi_rule_errors"] = f"""WITH {BASE}
SELECT {COLS}, {MULTI_MSG} AS error_message
FROM base WHERE o_orderstatus IS NULL OR o_orderpriority IS NULL OR {BAD_REF}"""

SQL["data_type_rule"] = f"""WITH {BASE}
SELECT {COLS}, 'Column cust_ref is not INT' AS error_message FROM base WHERE {BAD_REF}"""

SQL["rule_outcomes"] = f"""WITH {BASE},
c AS (SELECT count(*) FILTER (WHERE o_orderstatus IS NULL) AS n1,
             count(*) FILTER (WHERE o_orderpriority IS NULL) AS n2,
             count(*) FILTER (WHERE {BAD_REF}) AS n3 FROM base),
r AS (SELECT 1 AS dcv_id, 'o_orderstatus' AS column_name, 'column_null_validation' AS validation_name, n1 AS n_errors FROM c
      UNION ALL SELECT 2, 'o_orderpriority', 'column_null_validation', n2 FROM c
      UNION ALL SELECT 3, 'cust_ref', 'data_type_validation', n3 FROM c)
SELECT CAST(dcv_id AS BIGINT) AS dcv_id, column_name, validation_name, n_errors,
       CASE WHEN n_errors > 0 THEN 'Validation Passed' ELSE 'Validation Passed with no errors' END AS result,
       'Validation Passed' AS status
FROM r"""

SQL["array_null_rule"] = f"""WITH {POOL},
{NESTED_POSTS},
elems AS (SELECT id, any_value(message) AS message, bool_or(comment_message IS NULL) AS has_null_elem
          FROM feed GROUP BY id),
allp AS (SELECT id, message, has_null_elem, false AS no_object FROM elems
         UNION ALL SELECT id, message, false, no_object FROM ann)
SELECT id, concat_ws(' | ',
         CASE WHEN message IS NULL THEN 'Column message is null' END,
         CASE WHEN no_object THEN 'Column comments.data.message is null' END,
         CASE WHEN has_null_elem THEN 'Column comments.data.message has null elements' END) AS error_message
FROM allp
WHERE message IS NULL OR no_object OR has_null_elem"""

SQL["promote_valid"] = f"""WITH {BASE},
errs AS (SELECT DISTINCT o_orderkey FROM base
         WHERE o_orderstatus IS NULL OR o_orderpriority IS NULL OR {BAD_REF})
SELECT b.* FROM base b
WHERE NOT EXISTS (SELECT 1 FROM errs e WHERE e.o_orderkey = b.o_orderkey)"""

_NS = " AND ".join(f"t.{c} IS NOT DISTINCT FROM s.{c}" for c in COLS.split(", "))
_CO = ", ".join(f"coalesce(t.{c}, s.{c}) AS {c}" for c in COLS.split(", "))
SQL["error_upsert"] = f"""WITH {BASE},
t AS (SELECT {COLS}, 'Column o_orderstatus is null' AS msg FROM base WHERE o_orderstatus IS NULL),
s_raw AS (SELECT {COLS}, 'Column o_orderpriority is null' AS msg FROM base WHERE o_orderpriority IS NULL
          UNION ALL
          SELECT {COLS}, 'Column o_orderstatus is null' FROM base
          WHERE o_orderstatus IS NULL AND o_orderpriority = '1-URGENT'),
s AS (SELECT {COLS}, list_sort(list_distinct(list(msg))) AS sp FROM s_raw GROUP BY ALL)
SELECT {_CO},
       CASE WHEN t.msg IS NULL THEN array_to_string(s.sp, ' | ')
            WHEN s.sp IS NULL THEN t.msg
            ELSE array_to_string(list_concat(string_split(t.msg, ' | '),
                   list_filter(s.sp, lambda x: NOT list_contains(string_split(t.msg, ' | '), x))), ' | ')
       END AS error_message
FROM t FULL OUTER JOIN s ON {_NS}"""

SQL["error_upsert_maps"] = f"""SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus AS status, o_orderpriority AS priority,
       2::BIGINT AS n_attributes, o_orderdate AS day, error_message FROM ({SQL["error_upsert"]})"""

AUD = """aud AS (
  SELECT CAST(o_custkey % 20 AS INTEGER) AS dataset_id, CAST(o_orderdate AS DATE) AS business_date,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(CAST(o_orderkey % 3 * 8 AS INTEGER)) AS batch_ts,
         o_orderkey AS seq,
         CASE WHEN o_orderstatus = 'F' THEN 'Validated'
              WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'In-Progress' ELSE 'Success' END
              ELSE CASE WHEN o_orderpriority = '1-URGENT' THEN 'Validation Failed' ELSE 'Failed' END END AS status
  FROM orders),
aud2 AS (SELECT *, CASE WHEN status LIKE '%Failed%' THEN 'order ' || CAST(seq AS VARCHAR) || ' failed' END AS error_message
         FROM aud),
cur AS (SELECT dataset_id, batch_ts, business_date, arg_max(status, seq) AS status,
               arg_max_null(error_message, seq) AS error_message, max(seq) AS seq, count(*) AS n_events
        FROM aud2 GROUP BY dataset_id, batch_ts, business_date),
reg AS (SELECT dataset_id AS id, 'dataset_' || CAST(dataset_id AS VARCHAR) AS name,
               CASE WHEN dataset_id % 3 = 2 THEN 'instagram' ELSE 'facebook' END AS source_name,
               CASE WHEN dataset_id % 5 = 0 THEN 'gold' ELSE 'silver' END AS layer,
               'silver_' || CAST(dataset_id AS VARCHAR) AS silver_table,
               'errors_' || CAST(dataset_id AS VARCHAR) AS error_table_name,
               CASE WHEN dataset_id % 5 = 0 THEN 'gold_' || CAST(dataset_id AS VARCHAR) END AS gold_table
        FROM (SELECT DISTINCT dataset_id FROM aud)),
tv AS (SELECT r.id AS dataset_id, r.name, c.batch_ts, c.business_date, r.silver_table, r.error_table_name
       FROM reg r JOIN cur c ON c.dataset_id = r.id
       WHERE c.status = 'Success' AND r.source_name = 'facebook' AND r.layer = 'silver')"""

SQL["audit_current"] = f"""WITH {AUD}
SELECT * FROM cur"""

SQL["audit_compacted"] = SQL["audit_current"]

SQL["audit_lifecycle"] = f"""WITH {AUD}
SELECT dataset_id, status, count(*) AS n_batches,
       CASE WHEN status IN ('Started', 'In-Progress', 'Success', 'Failed') THEN 'ingest'
            WHEN status IN ('Validated', 'Validation Failed') THEN 'validation'
            WHEN status = 'Validation Passed' THEN 'rule'
            WHEN status = 'Skipped' THEN 'aggregation' ELSE 'unknown' END AS phase,
       status IN ('Success', 'Failed', 'Validated', 'Validation Failed', 'Validation Passed', 'Skipped') AS is_terminal
FROM cur GROUP BY dataset_id, status"""

SQL["datasets_to_validate"] = f"""WITH {AUD}
SELECT * FROM tv"""

SQL["pending_rules"] = f"""WITH {AUD},
cols AS (SELECT id AS dataset_id,
                unnest([{{'ix': 1, 'column_name': 'o_orderstatus', 'column_datatype': 'STRING', 'validation_id': 1}},
                        {{'ix': 2, 'column_name': 'o_orderpriority', 'column_datatype': 'STRING', 'validation_id': 1}},
                        {{'ix': 3, 'column_name': 'cust_ref', 'column_datatype': 'INT', 'validation_id': 2}}],
                       recursive := true)
         FROM reg),
binds AS (SELECT CAST(dataset_id * 10 + ix AS BIGINT) AS dcv_id, dataset_id, column_name, column_datatype, validation_id
          FROM cols WHERE (dataset_id + ix) % 4 <> 0),
val(id, vname) AS (VALUES (1, 'column_null_validation'), (2, 'data_type_validation')),
ra AS (SELECT CAST((o_custkey % 20) * 10 + o_custkey % 3 + 1 AS BIGINT) AS dcv_id,
              CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(CAST(o_orderkey % 3 * 8 AS INTEGER)) AS batch_ts, o_orderkey AS seq,
              CASE WHEN o_totalprice > 300000 THEN 'Failed' ELSE 'Validation Passed' END AS status
       FROM orders),
racur AS (SELECT dcv_id, batch_ts, arg_max(status, seq) AS status FROM ra GROUP BY 1, 2)
SELECT tv.dataset_id, tv.batch_ts, tv.business_date, b.dcv_id, b.column_name, b.column_datatype,
       v.vname AS validation_name, r.status AS audit_status
FROM tv JOIN binds b ON b.dataset_id = tv.dataset_id
JOIN val v ON v.id = b.validation_id
LEFT JOIN racur r ON r.dcv_id = b.dcv_id AND r.batch_ts = tv.batch_ts
WHERE r.status IS NULL OR r.status = 'Failed'"""

AUD_MONTHLY = AUD.replace("CAST(o_orderdate AS DATE)", "CAST(date_trunc('month', o_orderdate) AS DATE)")


def plan_cte(aud: str) -> str:
    return f"""{aud},
da AS (SELECT unnest([1, 2])::INTEGER AS aggregation_id, id AS dataset_id,
              CASE WHEN id = 15 THEN 'no' ELSE 'yes' END AS is_active
       FROM reg WHERE layer = 'gold'),
ag(aggregation_id, aggregation_name) AS (VALUES (1, 'daily_kpi'), (2, 'sentiment_trend')),
deps AS (SELECT id AS dataset_id, CAST((id + unnest([1, 2, 3])) % 20 AS INTEGER) AS dependant_dataset_id
         FROM reg WHERE layer = 'gold'),
active AS (SELECT da.dataset_id, da.aggregation_id, ag.aggregation_name
           FROM da JOIN ag ON ag.aggregation_id = da.aggregation_id WHERE da.is_active = 'yes'),
dates AS (SELECT DISTINCT d.dataset_id, c.batch_ts, c.business_date
          FROM active x JOIN deps d ON d.dataset_id = x.dataset_id
          JOIN cur c ON c.dataset_id = d.dependant_dataset_id),
plan AS (SELECT dt.dataset_id, dt.batch_ts, dt.business_date, x.aggregation_id, x.aggregation_name, g.gold_table,
                d.dependant_dataset_id, s.silver_table,
                CASE WHEN c.status = 'Validated' THEN c.status END AS status, own.status AS dataset_status,
                c.seq AS dependency_seq
         FROM dates dt JOIN active x ON x.dataset_id = dt.dataset_id
         JOIN reg g ON g.id = dt.dataset_id
         JOIN deps d ON d.dataset_id = dt.dataset_id
         JOIN reg s ON s.id = d.dependant_dataset_id
         LEFT JOIN cur c ON c.dataset_id = d.dependant_dataset_id AND c.batch_ts = dt.batch_ts
         LEFT JOIN cur own ON own.dataset_id = dt.dataset_id AND own.batch_ts = dt.batch_ts),
ready AS (SELECT dataset_id, aggregation_id, aggregation_name, batch_ts, business_date, count(*) AS n_dependencies, count(status) AS n_validated,
                 coalesce(string_agg(CASE WHEN status IS NULL THEN CAST(dependant_dataset_id AS VARCHAR) END, ','
                                     ORDER BY CAST(dependant_dataset_id AS VARCHAR)), '') AS missing,
                 count(status) = count(*) AS ready, max(dependency_seq) AS ready_seq
          FROM plan GROUP BY dataset_id, aggregation_id, aggregation_name, batch_ts, business_date)"""


PLAN = plan_cte(AUD)

SQL["aggregation_plan"] = f"""WITH {PLAN}
SELECT * EXCLUDE (dependency_seq) FROM plan"""

SQL["dependency_readiness"] = f"""WITH {PLAN}
SELECT * FROM ready"""

SQL["aggregation_guard"] = f"""WITH {plan_cte(AUD_MONTHLY)},
runs AS (SELECT CAST(o_custkey % 4 * 5 AS INTEGER) AS dataset_id,
                CASE WHEN o_orderkey % 2 = 0 THEN 'daily_kpi' ELSE 'sentiment_trend' END AS aggregation_name,
                CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) + to_hours(CAST(o_orderkey % 3 * 8 AS INTEGER)) AS batch_ts,
                max(o_orderkey) AS seq,
                arg_max(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Failed' ELSE 'Success' END, o_orderkey) AS status
         FROM orders GROUP BY 1, 2, 3)
SELECT r.dataset_id, r.aggregation_id, r.aggregation_name, r.batch_ts, r.business_date, r.ready_seq FROM ready r
WHERE r.ready AND NOT EXISTS (SELECT 1 FROM runs x WHERE x.dataset_id = r.dataset_id AND x.aggregation_name = r.aggregation_name
                              AND x.batch_ts = r.batch_ts AND x.status = 'Success' AND x.seq >= r.ready_seq)"""

SQL["row_rules"] = """WITH items AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax,
         count(*) OVER (PARTITION BY l_orderkey, l_suppkey) > 1 AS f1,
         l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) AS f2,
         NOT (l_quantity < 49 OR l_discount + l_tax < 0.1) AS f3 FROM lineitem)
SELECT * EXCLUDE (f1, f2, f3),
       concat_ws(' | ', CASE WHEN f1 THEN 'Key l_orderkey, l_suppkey is not unique' END,
                 CASE WHEN f2 THEN 'Key l_partkey is not in part' END,
                 CASE WHEN f3 THEN 'Row does not satisfy l_quantity < 49 OR l_discount + l_tax < 0.1' END) AS error_message
FROM items WHERE f1 OR f2 OR f3"""

SQL["row_rule_outcomes"] = f"""WITH marked AS ({SQL["row_rules"]}),
n AS (SELECT unnest([1, 2, 3]) AS dcv_id, unnest(['l_orderkey', 'l_partkey', 'l_quantity']) AS column_name,
             unnest(['row_unique_validation', 'row_reference_validation', 'row_condition_validation']) AS validation_name,
             unnest([count(*) FILTER (WHERE contains(error_message, 'is not unique')),
                     count(*) FILTER (WHERE contains(error_message, 'is not in part')),
                     count(*) FILTER (WHERE contains(error_message, 'does not satisfy'))]) AS n_errors FROM marked)
SELECT CAST(dcv_id AS BIGINT) AS dcv_id, column_name, validation_name, n_errors,
       CASE WHEN n_errors > 0 THEN 'Validation Passed' ELSE 'Validation Passed with no errors' END AS result, 'Validation Passed' AS status FROM n
UNION ALL SELECT 4, 'l_returns', 'column_null_validation', NULL, 'Column l_returns not found', 'Failed'"""

_PENDING = SQL["pending_rules"]
SQL["validate_all_pending"] = f"""{_PENDING[:_PENDING.index("SELECT tv.dataset_id")].rstrip()},
allbinds AS (SELECT dcv_id, dataset_id FROM binds
             UNION ALL SELECT * FROM (VALUES (14, 1), (64, 6), (74, 7), (94, 9))),
pend AS (SELECT tv.dataset_id, tv.batch_ts, b.dcv_id FROM tv JOIN allbinds b ON b.dataset_id = tv.dataset_id
         LEFT JOIN racur r ON r.dcv_id = b.dcv_id AND r.batch_ts = tv.batch_ts
         WHERE r.status IS NULL OR r.status = 'Failed'),
b AS (SELECT o.*, tv.dataset_id, tv.batch_ts FROM (
        SELECT o_orderkey AS ok, o_orderkey % 500 = 13 AS no_key, o_custkey, NULLIF(o_orderstatus, 'P') AS st, o_totalprice AS price,
               NULLIF(o_orderpriority, '5-LOW') AS pr, o_orderkey % 7 = 0 AS bad_ref,
               CAST(o_custkey % 20 AS INTEGER) AS ds,
               CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(CAST(o_orderkey % 3 * 8 AS INTEGER)) AS ts FROM orders) o
      JOIN tv ON tv.dataset_id = o.ds AND tv.batch_ts = o.ts),
fails AS (SELECT ok, dataset_id, batch_ts, dataset_id * 10 + 1 AS dcv_id FROM b WHERE st IS NULL
          UNION ALL SELECT ok, dataset_id, batch_ts, dataset_id * 10 + 2 FROM b WHERE pr IS NULL
          UNION ALL SELECT ok, dataset_id, batch_ts, dataset_id * 10 + 3 FROM b WHERE bad_ref
          UNION ALL SELECT ok, dataset_id, batch_ts, 14 FROM b
                    WHERE dataset_id = 1 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)
          UNION ALL SELECT ok, dataset_id, batch_ts, 64 FROM (
                    SELECT *, count(*) OVER (PARTITION BY batch_ts, o_custkey, pr) AS same FROM b WHERE dataset_id = 6 AND pr IS NOT NULL)
                    WHERE same > 1
          UNION ALL SELECT ok, dataset_id, batch_ts, 94 FROM b WHERE dataset_id = 9 AND NOT (price < 200000 OR st = 'F')),
hits AS (SELECT f.* FROM fails f JOIN pend p ON p.dataset_id = f.dataset_id AND p.batch_ts = f.batch_ts AND p.dcv_id = f.dcv_id),
rules AS (SELECT dataset_id, batch_ts, count(*) AS n_rules, count(*) FILTER (WHERE dcv_id = 74) AS n_failed FROM pend GROUP BY 1, 2),
errs AS (SELECT dataset_id, batch_ts, count(*) AS n_rule_errors, count(DISTINCT ok) AS n_errors FROM hits GROUP BY 1, 2),
good AS (SELECT dataset_id, batch_ts, count(*) AS n_silver FROM b
         WHERE dataset_id <> 7 AND (no_key OR ok NOT IN (SELECT ok FROM hits)) GROUP BY 1, 2)
SELECT tv.dataset_id, tv.batch_ts, tv.business_date,
       CASE WHEN tv.dataset_id = 7 THEN 'Validation Failed' ELSE 'Validated' END AS status,
       CASE WHEN tv.dataset_id = 7 THEN 'Column o_region not found' END AS error_message,
       coalesce(n_rules, 0) AS n_rules, coalesce(n_failed, 0) AS n_failed, coalesce(n_rule_errors, 0) AS n_rule_errors,
       coalesce(n_errors, 0) AS n_errors, coalesce(n_silver, 0) AS n_silver
FROM tv LEFT JOIN rules USING (dataset_id, batch_ts) LEFT JOIN errs USING (dataset_id, batch_ts) LEFT JOIN good USING (dataset_id, batch_ts)""".replace(
    "CAST(o_orderdate AS DATE)", "CAST(date_trunc('month', o_orderdate) AS DATE)")

_PAT = r"post_detail_(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})\.json"
LANDING = f"""lr AS (
  SELECT o_orderkey, 'landing/post_detail/' ||
    CASE dayofyear(o_orderdate) % 10
      WHEN 3 THEN 'post_detail_' || strftime(o_orderdate, '%Y-%m-%d') || '.json'
      WHEN 5 THEN 'post_detail_' || strftime(o_orderdate, '%Y-%m-%d') || '_' || tm || '.json.bak'
      WHEN 7 THEN 'post_detail_' || strftime(o_orderdate, '%Y') || '-13-' || strftime(o_orderdate, '%d') || '_' || tm || '.json'
      WHEN 8 THEN 'posts_' || strftime(o_orderdate, '%Y-%m-%d') || '_' || tm || '.json'
      ELSE 'post_detail_' || strftime(o_orderdate, '%Y-%m-%d') || '_' || tm || '.json' END AS source_file
  FROM (SELECT *, lpad(CAST(dayofyear(o_orderdate) % 24 AS VARCHAR), 2, '0') || '-' ||
                  lpad(CAST((dayofyear(o_orderdate) * 7) % 60 AS VARCHAR), 2, '0') || '-' ||
                  lpad(CAST((dayofyear(o_orderdate) * 13) % 60 AS VARCHAR), 2, '0') AS tm
        FROM orders)),
p1 AS (SELECT *, regexp_extract(source_file, '{_PAT}', 1) AS file_date,
              regexp_extract(source_file, '.*/(.*)', 1) AS filename FROM lr),
parsed AS (SELECT *, regexp_extract(file_date, '(\\d{{4}})', 1) AS year,
                  regexp_extract(file_date, '-(\\d{{2}})-', 1) AS month,
                  regexp_extract(file_date, '-(\\d{{2}})_', 1) AS day,
                  CASE WHEN file_date <> '' THEN try_strptime(file_date, '%Y-%m-%d_%H-%M-%S') END AS ts
           FROM p1),
named AS (SELECT *, regexp_full_match(filename, '{_PAT}') AND ts IS NOT NULL AS ok FROM parsed)"""

SQL["file_stamp_parse"] = f"""WITH {LANDING}
SELECT DISTINCT source_file, filename, file_date, year, month, day,
       CAST(ts AS DATE) AS business_date, CAST(hour(ts) AS INTEGER) AS batch_hour, ok AS name_ok
FROM named"""

SQL["quarantine_split"] = f"""WITH {LANDING}
SELECT source_file, filename, CASE WHEN ok THEN 'Accepted' ELSE 'Quarantined' END AS status,
       CASE WHEN ok THEN CAST(min(ts) AS DATE) END AS business_date,
       CASE WHEN ok THEN min(ts) END AS batch_ts, count(*) AS n_rows,
       CASE WHEN NOT ok THEN 'Filename ' || filename || ' format mismatch' END AS error_message
FROM named GROUP BY source_file, filename, ok"""

SQL["message_decode"] = f"""SELECT '{tb.TOPIC}' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
       event_id AS "offset",
       CASE WHEN user_id % 50 = 0 THEN NULL ELSE 'host-' || CAST(user_id AS VARCHAR) END AS key,
       CASE WHEN json_valid(v) THEN CAST(json_extract(v, '$.k') AS BIGINT) END AS k,
       json_valid(v) AS is_valid, v AS raw_value
FROM (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'not json {{' ELSE props END AS v FROM events)"""

SQL["message_encode"] = f"""SELECT CAST(user_id AS VARCHAR) AS key,
       to_json({{'event_id': event_id, 'event_type': event_type, 'user_id': user_id,
                'value_cents': CAST(round(value * 100) AS BIGINT)}}) :: VARCHAR AS value,
       '{tb.TOPIC}' AS topic
FROM events"""

SQL["rescue_unknown_keys"] = """SELECT event_id,
       CASE WHEN event_type <> 'signup' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE event_type WHEN 'click' THEN '{"src":"click"}'
                       WHEN 'error' THEN '{"code":' || CAST(user_id AS VARCHAR) || ',"extra":null}'
                       WHEN 'signup' THEN '{"k":"many","v":[1,{"w":2.5}]}' END AS rescued
FROM events"""

SQL["schema_drift"] = """WITH seen AS (
  SELECT CAST(ts AS DATE) AS day, unnest(CASE event_type WHEN 'click' THEN [{'key': 'src', 'type': 'STRING'}]
           WHEN 'error' THEN [{'key': 'code', 'type': 'BIGINT'}, {'key': 'extra', 'type': 'VOID'}]
           WHEN 'signup' THEN [{'key': 'k', 'type': 'STRING'}, {'key': 'v', 'type': 'ARRAY<VARIANT>'}] END, recursive := true)
  FROM events)
SELECT day, key, count(*) AS n_rows, type, min(day) OVER (PARTITION BY key) AS first_day FROM seen GROUP BY day, key, type"""

TIMED = f"""{COMMENTS},
timed AS (SELECT * REPLACE (CASE WHEN CAST(substr(comment_id, 2) AS BIGINT) % 40 = 0 THEN NULL ELSE comment_date END AS comment_date),
                 comment_date AS file_date FROM scored)"""
SQL["gold_refresh"] = SQL["daily_nps_csat"].replace(COMMENTS, TIMED).replace("FROM scored GROUP BY comment_date", "FROM timed GROUP BY comment_date")
SQL["gold_stream"] = SQL["gold_refresh"]

def gold_by_day(source: str, daily: str = "true") -> str:
    """Two reports over ``source``, the first over some of its rows only."""
    return f"""d AS (SELECT comment_date, count(*) AS total_comments, count(*) FILTER (WHERE {CATEGORY} = 'Promoter') AS promoters
      FROM {source} WHERE {daily} GROUP BY 1),
t AS (SELECT comment_date, count(*) AS n_labelled, count(*) FILTER (WHERE sentiment_score > 0) AS n_positive
      FROM {source} GROUP BY 1)
SELECT coalesce(d.comment_date, t.comment_date) AS comment_date, total_comments, promoters, n_labelled, n_positive
FROM d FULL JOIN t ON d.comment_date IS NOT DISTINCT FROM t.comment_date"""


SQL["aggregate_ready"] = f"""{TIMED},
ready AS (SELECT * FROM timed WHERE day(file_date) IN (2, 3, 17)),
{gold_by_day("ready", "day(file_date) <> 2")}"""

SQL["batches_to_gold"] = f"""{COMMENTS},
p AS (SELECT post_no, day(CAST(min(substr(created_time, 1, 10)) AS DATE)) = 10 AND post_no // 3 % 3 = 1 AS again
      FROM feed GROUP BY post_no HAVING bool_and(message IS NOT NULL) AND bool_and(comment_message IS NOT NULL)),
kept AS (SELECT s.* REPLACE (CASE WHEN p.again THEN CAST(CAST(substr(comment_created_time, 1, 26) AS TIMESTAMP) + INTERVAL 36 HOURS AS DATE)
                                  ELSE comment_date END AS comment_date)
         FROM scored s JOIN p ON p.post_no = s.post_no WHERE NOT p.again OR p.post_no % 2 <> 0),
{gold_by_day("kept")}"""

BATCH_DAY = "CASE WHEN o_custkey % 100 = 1 THEN NULL ELSE strftime(o_orderdate, '%Y-%m') END"
SQL["validate_retry"] = f"""WITH {BASE},
errs AS (SELECT DISTINCT o_orderkey FROM base WHERE o_orderstatus IS NULL OR o_orderpriority IS NULL)
SELECT o_orderkey, o_custkey, {BATCH_DAY} AS file_date FROM base b
WHERE NOT EXISTS (SELECT 1 FROM errs e WHERE e.o_orderkey = b.o_orderkey)"""

SQL["catalog_promotion"] = f"""WITH {BASE},
b AS (SELECT *, coalesce(o_orderkey, 0) % 2 AS part, o_orderstatus IS NULL AS f1, o_orderpriority IS NULL AS f2, {BAD_REF} AS f3 FROM base),
e AS (SELECT *, CASE WHEN part = 0 THEN CASE WHEN f1 THEN 'Column o_orderstatus is null' END
                     WHEN f2 THEN concat_ws(' | ', 'Column o_orderpriority is null', CASE WHEN f3 THEN 'Column cust_ref is not INT' END,
                                            CASE WHEN f1 THEN 'Column o_orderstatus is null' END)
                     WHEN f1 OR f3 THEN concat_ws(' | ', CASE WHEN f3 THEN 'Column cust_ref is not INT' END, CASE WHEN f1 THEN 'Column o_orderstatus is null' END)
                END AS m FROM b)
SELECT o_orderkey, o_custkey, m AS error_message, 'errors' AS held_in FROM e WHERE m IS NOT NULL
UNION ALL SELECT o_orderkey, o_custkey, NULL, 'silver' FROM e
WHERE o_orderkey IS NOT NULL AND CASE WHEN part = 0 THEN NOT f1 ELSE NOT f2 END"""

SQL["error_table_upsert"] = f"""WITH {BASE}
SELECT o_orderkey, o_custkey, {BATCH_DAY} AS file_date,
       concat_ws(' | ', CASE WHEN o_orderstatus IS NULL THEN 'Column o_orderstatus is null' END,
                 CASE WHEN o_orderpriority IS NULL THEN 'Column o_orderpriority is null' END) AS error_message
FROM base WHERE o_orderstatus IS NULL OR o_orderpriority IS NULL"""

SQL["batch_read_formats"] = f"""WITH {POOL},
{FEED}
SELECT f.format, strftime(comment_date, '%Y') AS year, strftime(comment_date, '%m') AS month,
       strftime(comment_date, '%d') AS day, count(*) AS n_rows, CAST(sum(comment_likes) AS BIGINT) AS sum_likes
FROM feed, (VALUES ('json'), ('csv')) f(format)
GROUP BY 1, 2, 3, 4"""

# Posts landed in bronze: every post of a landing file whose name matches
# (files of day 5 carry a ".json.bak" suffix and are quarantined), with the
# date parts of the file stamp, the comment count and what didn't fit the schema.
ALL_POSTS = """WITH ev AS (SELECT event_id // 4 AS post_no, date_trunc('hour', ts) AS h FROM events),
posts AS (SELECT 'p' || CAST(post_no AS VARCHAR) AS id, post_no AS n, min(h) AS h, count(*) AS n_comments
          FROM ev GROUP BY post_no),
ann AS (SELECT 'a' || CAST(c_custkey AS VARCHAR) AS id, c_custkey AS n,
               TIMESTAMP '2024-01-01 00:00:00' AS h, 0 AS n_comments FROM customer),
allp AS (SELECT *, nullif(concat_ws(',', CASE WHEN n % 50 = 0 THEN '"channel":"web"' END,
                 CASE WHEN n % 70 = 0 THEN '"likes":{"summary":{"total_count":"many"}}' END), '') AS rest
         FROM (SELECT * FROM posts UNION ALL SELECT * FROM ann))"""
BRONZE_COLS = "CAST(n_comments AS INTEGER) AS n_comments, '{' || rest || '}' AS rescued"

SQL["stream_to_bronze"] = f"""{ALL_POSTS}
SELECT id, strftime(h, '%Y') AS year, strftime(h, '%m') AS month, strftime(h, '%d') AS day, {BRONZE_COLS}
FROM allp WHERE dayofmonth(h) <> 5"""
SQL["stream_to_csv_bronze"] = SQL["stream_to_bronze"]

SQL["stream_quarantine"] = f"""{ALL_POSTS},
named AS (SELECT *, 'post_detail_' || strftime(h, '%Y-%m-%d') || '_00-00-00.json'
                    || CASE WHEN dayofmonth(h) = 5 THEN '.bak' ELSE '' END AS landing_file FROM allp)
SELECT id, NULL::VARCHAR AS raw, landing_file FROM named WHERE dayofmonth(h) = 5
UNION ALL SELECT NULL, '[{{"id": "' || id || '", "message": "cut off', landing_file FROM named WHERE n % 60 = 0
UNION ALL SELECT NULL, unnest([CAST(n AS VARCHAR), 'abc']), landing_file FROM named WHERE n % 90 = 0"""

SQL["stream_json_to_bronze"] = SQL["stream_to_bronze"]
SQL["stream_json_quarantine"] = SQL["stream_quarantine"].replace(
    """UNION ALL SELECT NULL, '[{"id": "' || id || '", "message": "cut off', landing_file FROM named WHERE n % 60 = 0\n""", "")

# the first drain has the messages of even offsets, the second all
SQL["topic_drain"] = f"""{ALL_POSTS}
SELECT id, {BRONZE_COLS} FROM allp
UNION ALL SELECT id, {BRONZE_COLS} FROM allp WHERE (n // 4) % 2 = 0"""

SQL["drain_counts"] = f"""{ALL_POSTS},
m AS (SELECT CAST(n % 4 + CASE WHEN id LIKE 'a%' THEN 4 ELSE 0 END AS INTEGER) AS partition, n // 4 AS o FROM allp)
SELECT '{tb.TOPIC}' AS topic, partition, count(*) FILTER (WHERE o % 9 <> 0) AS n_messages, count(*) FILTER (WHERE o % 9 = 0) AS n_null,
       min(o) AS min_offset, max(o) AS max_offset FROM m GROUP BY partition"""

_NAMED = SQL["stream_quarantine"]
SQL["archive_consumed"] = f"""{_NAMED[:_NAMED.index("SELECT id, NULL::VARCHAR")]}
SELECT landing_file, CAST(sum(1 + CASE WHEN n % 60 = 0 THEN 1 ELSE 0 END + CASE WHEN n % 90 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_lines,
       true AS some_archived FROM named GROUP BY landing_file"""

"""DuckDB oracle SQL for every registered query (same fixture rules as
``tidelog.sources.testdata``, written independently as plain SQL)."""

from __future__ import annotations

from tidelog.sources import testdata as td


def _uuid(h: str) -> str:
    return (f"(substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'||"
            f"substr({h},17,4)||'-'||substr({h},21,12))")


def _bucket(x: str, n: int = 8) -> str:
    return f"((('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 8))::BIGINT) % {n})"


EID = _uuid("md5(CAST(event_id AS VARCHAR))")

EV = f"""ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST({_bucket('user_id')} AS VARCHAR) AS "partition",
         {EID} AS eid,
         CASE WHEN event_id % 10 <= 5 THEN 'business' WHEN event_id % 10 <= 8 THEN 'data' ELSE 'undefined' END AS category,
         CASE WHEN event_id % 10 BETWEEN 6 AND 8 THEN ['C','U','D','S'][CAST(event_id % 4 AS INTEGER) + 1] END AS data_op,
         CASE WHEN event_id % 10 <= 8 THEN
              CASE WHEN event_id % 89 = 1 THEN 'legacy.' || event_type ELSE event_type END END AS md_event_type,
         (event_id % 97 = 0) AS malformed,
         CASE WHEN event_id % 10 = 9 AND event_id % 20 = 19 AND event_type IN ('click','purchase','signup')
              THEN NULL ELSE {EID} END AS resolved_eid
  FROM events)"""

LOG = EV + """,
log AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_type, "partition" ORDER BY ts, event_id) - 1 AS BIGINT)
               AS "offset" FROM ev)"""

BAT = """bat AS (
  SELECT event_type, "partition", CAST(floor("offset" / 20) AS BIGINT) AS batch_no, max("offset") AS last_offset,
         count(*) AS n_events, bool_or(malformed) AS bad, max(ts) AS newest
  FROM log GROUP BY ALL)"""

CUR = """cnt AS (SELECT event_type, "partition", count(*) AS n FROM log GROUP BY ALL),
cur AS (SELECT event_type, "partition",
               CASE WHEN "partition" = '6' THEN 'BEGIN' ELSE CAST((n * 4) // 5 - 1 AS VARCHAR) END AS "offset",
               CAST(CASE WHEN "partition" = '6' THEN -1 ELSE (n * 4) // 5 - 1 END AS BIGINT) AS committed
        FROM cnt WHERE "partition" <> '7')"""

GOOD = """good AS (SELECT l.* FROM log l JOIN bat b ON l.event_type = b.event_type AND l."partition" = b."partition"
                 AND CAST(floor(l."offset" / 20) AS BIGINT) = b.batch_no WHERE NOT b.bad)"""

TYPES = "['click','error','purchase','signup','view']"

SUBS = f"""subs AS (
  SELECT {_uuid("md5('sub-' || CAST(c_custkey AS VARCHAR))")} AS id, c_mktsegment AS owning_application,
         CASE WHEN len(t) = 0 THEN ['view'] ELSE t END AS event_types,
         CASE WHEN c_nationkey % 5 <> 0 THEN 'cg-' || CAST(c_nationkey % 3 AS VARCHAR) END AS consumer_group,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(c_custkey AS BIGINT)) AS created_at,
         ['begin','end','cursors'][CAST(c_custkey % 3 AS INTEGER) + 1] AS read_from
  FROM (SELECT *, list_filter([
          CASE WHEN (c_custkey >> 0) % 2 = 1 THEN 'click' END,
          CASE WHEN (c_custkey >> 1) % 2 = 1 THEN 'error' END,
          CASE WHEN (c_custkey >> 2) % 2 = 1 THEN 'purchase' END,
          CASE WHEN (c_custkey >> 3) % 2 = 1 THEN 'signup' END,
          CASE WHEN (c_custkey >> 4) % 2 = 1 THEN 'view' END], lambda x: x IS NOT NULL) AS t FROM customer))"""

REQ = f"""req AS (
  SELECT CAST(n_nationkey AS BIGINT) AS request_id,
         ['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'][CAST((n_nationkey * 3) % 5 AS INTEGER) + 1]
           AS owning_application,
         CASE WHEN n_nationkey % 3 = 0 THEN [{TYPES}[CAST(n_nationkey % 5 AS INTEGER) + 1]]
              ELSE [{TYPES}[CAST(n_nationkey % 5 AS INTEGER) + 1], {TYPES}[CAST((n_nationkey + 2) % 5 AS INTEGER) + 1]]
         END AS event_types,
         CASE WHEN n_nationkey % 2 = 1 THEN 'cg-' || CAST(n_nationkey % 3 AS VARCHAR) END AS consumer_group
  FROM nation)"""


def _first_match(req: str) -> str:
    return f"""m AS (
  SELECT r.request_id, s.id AS subscription_id, s.created_at FROM subs s JOIN {req} r
    ON s.owning_application = r.owning_application
   AND len(list_filter(r.event_types, lambda x: NOT list_contains(s.event_types, x))) = 0
   AND (r.consumer_group IS NULL OR s.consumer_group = r.consumer_group)),
first AS (SELECT request_id, subscription_id FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY created_at DESC, subscription_id) AS rn FROM m)
  WHERE rn = 1)"""


# publish input: per event the first failing step and the assigned partition
PIN = f"""pin AS (
  SELECT event_id, resolved_eid, event_type || '/' || CAST(event_id // 50 AS VARCHAR) AS batch_id,
         CAST(event_id // 50 AS BIGINT) AS blk, category,
         CASE WHEN malformed THEN 'validating'
              WHEN category <> 'undefined' AND event_type <> 'error' AND event_id % 89 = 1 THEN 'enriching'
              WHEN event_type = 'purchase' AND category = 'undefined' THEN 'partitioning' END AS fail_step,
         CASE WHEN malformed THEN CASE WHEN category = 'data' THEN '$.data.value' ELSE '$.value' END
                                  || ': expected double'
              WHEN category <> 'undefined' AND event_type <> 'error' AND event_id % 89 = 1
                   THEN 'metadata.event_type: enrichment would overwrite a present value'
              WHEN event_type = 'purchase' AND category = 'undefined' THEN 'metadata.partition missing or unknown'
         END AS fail_detail,
         CASE WHEN event_type IN ('click', 'signup') THEN "partition"
              WHEN event_type = 'purchase' THEN CASE WHEN category <> 'undefined' THEN "partition" END
              ELSE CAST({_bucket('resolved_eid')} AS VARCHAR) END AS ppart
  FROM ev)"""


def _round(r: int, src: str) -> str:
    return f"""o{r} AS (
  SELECT *, {r} AS rnd,
         CASE WHEN fail_step IS NOT NULL THEN 'failed' WHEN bad THEN 'aborted' WHEN wf THEN 'failed'
              ELSE 'submitted' END AS st,
         CASE WHEN fail_step IS NOT NULL THEN fail_step WHEN bad THEN 'none' WHEN wf THEN 'publishing'
              ELSE 'none' END AS sp,
         CASE WHEN fail_step IS NOT NULL THEN fail_detail WHEN bad THEN NULL WHEN wf THEN 'write to partition failed'
         END AS dt
  FROM (SELECT *, bool_or(fail_step IS NOT NULL) OVER (PARTITION BY batch_id) AS bad,
               COALESCE(bool_or(ppart = '3' AND blk % 4 = {r % 4} AND {str(r <= 2).upper()})
                        OVER (PARTITION BY batch_id, ppart), false) AS wf
        FROM {src}))"""


RETRYABLE = "(resolved_eid IS NOT NULL AND sp <> 'validating' AND st <> 'submitted')"
PIN_COLS = "event_id, resolved_eid, batch_id, blk, category, fail_step, fail_detail, ppart"
R0 = PIN + ",\n" + _round(0, "pin")


def _retry_sql(max_retries: int = 5) -> str:
    ctes = [LOG, PIN, _round(0, "pin")]
    for r in range(0, max_retries + 1):
        ctes.append(f"""p{r + 1} AS (SELECT {PIN_COLS} FROM o{r}
  WHERE ({RETRYABLE} OR resolved_eid IS NULL)
    AND EXISTS (SELECT 1 FROM o{r} x WHERE x.resolved_eid IS NOT NULL AND x.sp <> 'validating'
                AND x.st <> 'submitted'))""")
        ctes.append(_round(r + 1, f"p{r + 1}"))
    allr = " UNION ALL ".join(f"SELECT event_id, rnd, st FROM o{r}" for r in range(max_retries + 2))
    return ("WITH " + ",\n".join(ctes) + f""",
allr AS ({allr})
SELECT event_id, count(*) AS attempts,
       CAST(min(CASE WHEN st = 'submitted' THEN rnd END) AS BIGINT) AS first_submitted_round,
       arg_max(st, rnd) AS final_status
FROM allr GROUP BY event_id""")


OUTCOMES = f"""oc AS (
  SELECT event_id, CASE WHEN event_id % 50 <> 7 THEN {EID} END AS eid,
         CASE WHEN event_id % 10 = 0 THEN 'failed' WHEN event_id % 10 <= 3 THEN 'aborted' ELSE 'submitted' END
           AS publishing_status,
         CASE WHEN event_id % 10 = 0 THEN 'validating' WHEN event_id % 10 <= 2 THEN 'enriching'
              WHEN event_id % 10 = 3 THEN 'partitioning' ELSE 'none' END AS step,
         CASE WHEN event_id % 10 = 0 THEN '$.value: expected double' WHEN event_id % 10 = 3 THEN 'no partition'
         END AS detail
  FROM events)"""

SUB = td.SUBSCRIPTION_ID

SENT = """sent AS (
  SELECT event_type, "partition", batch_no, CAST(last_offset AS VARCHAR) AS off, false AS keepalive,
         newest + INTERVAL 1 SECOND AS sent_ts FROM bat
  UNION ALL
  SELECT event_type, "partition", batch_no, CAST(last_offset AS VARCHAR), true, newest + INTERVAL 31 SECOND
  FROM bat WHERE batch_no % 10 = 9)"""

LAG = "CAST(COALESCE((epoch_us(as_of) - epoch_us(oldest)) // 1000000, 0) AS BIGINT)"

ORACLE = {
    # undefined events carry no occurred_at: they count, but have no age
    "flagship": f"""WITH {LOG}, {BAT}, {CUR}, {GOOD},
gstat AS (
  SELECT g.event_type, g."partition", count(*) AS received_events,
         count(*) FILTER (WHERE c.committed IS NULL OR g."offset" > c.committed) AS unconsumed_events,
         min(g.occurred_at) FILTER (WHERE c.committed IS NULL OR g."offset" > c.committed) AS oldest,
         max(g.occurred_at) AS newest
  FROM (SELECT *, CASE WHEN category <> 'undefined' THEN ts END AS occurred_at FROM good) g LEFT JOIN cur c ON g.event_type = c.event_type AND g."partition" = c."partition" GROUP BY ALL),
asof_t AS (SELECT max(newest) AS as_of FROM gstat),
dead AS (SELECT event_type, "partition", count(*) AS dead_letter_batches, sum(n_events) AS dead_letter_events
         FROM bat WHERE bad GROUP BY ALL)
SELECT COALESCE(g.event_type, d.event_type) AS event_type, COALESCE(g."partition", d."partition") AS "partition",
       CAST(COALESCE(received_events, 0) AS BIGINT) AS received_events,
       CAST(COALESCE(dead_letter_batches, 0) AS BIGINT) AS dead_letter_batches,
       CAST(COALESCE(dead_letter_events, 0) AS BIGINT) AS dead_letter_events,
       CAST(COALESCE(unconsumed_events, 0) AS BIGINT) AS unconsumed_events,
       CASE WHEN g.event_type IS NOT NULL THEN {LAG} END AS consumer_lag_seconds
FROM gstat g FULL JOIN dead d ON g.event_type = d.event_type AND g."partition" = d."partition", asof_t""",

    "assign_offsets": f"""WITH {LOG} SELECT event_id, event_type, "partition", "offset" FROM log""",

    "chunk_batches": f"""WITH {LOG}, {BAT}
SELECT event_type, "partition", batch_no, last_offset, n_events FROM bat""",

    "read_batches": f"""WITH {LOG}, {BAT}
SELECT event_type, "partition",
       CAST(count(*) + count(*) FILTER (WHERE batch_no % 10 = 9) AS BIGINT) AS batches,
       CAST(count(*) FILTER (WHERE batch_no % 10 = 9) AS BIGINT) AS keepalives,
       CAST(sum(n_events) AS BIGINT) AS events
FROM bat GROUP BY ALL""",

    "split_good_bad": f"""WITH {LOG}, {BAT},
m AS (SELECT event_type, "partition", CAST(floor("offset" / 20) AS BIGINT) AS batch_no,
             arg_min(category, "offset") AS category, min("offset") AS first_bad
      FROM log WHERE malformed GROUP BY ALL)
SELECT b.event_type, b."partition", b.last_offset AS batch_offset, b.n_events,
       'event ' || CAST(m.first_bad - b.batch_no * 20 AS VARCHAR) || ': '
       || CASE WHEN m.category = 'data' THEN '$.data.value' ELSE '$.value' END || ': expected double' AS error
FROM bat b JOIN m ON b.event_type = m.event_type AND b."partition" = m."partition" AND b.batch_no = m.batch_no""",

    "decode_events": f"""WITH {LOG}, {BAT}, {GOOD}
SELECT event_type, "partition", "offset", category, data_op,
       CASE WHEN category = 'data' THEN event_type END AS data_type,
       CASE WHEN category <> 'undefined' THEN eid END AS eid, md_event_type,
       CASE WHEN category <> 'undefined' THEN epoch_us(ts) END AS occurred_us,
       CASE WHEN category <> 'undefined' THEN 'u' || CAST(user_id AS VARCHAR) END AS compaction_key,
       user_id, round(value, 4) AS value, k
FROM good""",

    "classify_events": f"""WITH {EV} SELECT event_id, category, malformed AS failed FROM ev""",

    "event_id": f"""WITH {EV} SELECT event_id, resolved_eid FROM ev""",

    "is_uuid": """SELECT event_id, event_id % 13 <> 0 AS is_uuid, event_id % 5 <> 4 AS is_op FROM events""",

    "unconsumed": f"""WITH {LOG}, {CUR}
SELECT l.event_id, l.event_type, l."partition", l."offset" FROM log l
LEFT JOIN cur c ON l.event_type = c.event_type AND l."partition" = c."partition"
WHERE c.committed IS NULL OR l."offset" > c.committed""",

    "subscription_stats": f"""WITH {LOG}, {CUR},
s AS (SELECT l.event_type, l."partition",
             count(*) FILTER (WHERE c.committed IS NULL OR l."offset" > c.committed) AS unconsumed_events,
             min(l.ts) FILTER (WHERE c.committed IS NULL OR l."offset" > c.committed) AS oldest
      FROM log l LEFT JOIN cur c ON l.event_type = c.event_type AND l."partition" = c."partition" GROUP BY ALL),
asof_t AS (SELECT max(ts) AS as_of FROM events)
SELECT event_type, "partition", CAST(unconsumed_events AS BIGINT) AS unconsumed_events,
       {LAG} AS consumer_lag_seconds
FROM s, asof_t""",

    "cursors_get": f"""WITH {LOG}, {CUR} SELECT event_type, "partition", "offset", committed AS offset_num FROM cur""",

    "read_from_cursors": f"""WITH {LOG}
SELECT event_type, "partition", count(*) AS events, min("offset") AS first_offset FROM log
WHERE CASE WHEN "partition" IN ('0', '1', '2', '3') THEN "offset" > 100 ELSE true END GROUP BY ALL""",

    "stream_limit": f"""WITH {LOG}, {CUR}
SELECT l.event_id, l.event_type, l."partition", l."offset" FROM log l
LEFT JOIN cur c ON l.event_type = c.event_type AND l."partition" = c."partition"
WHERE c.committed IS NULL OR l."offset" > c.committed
ORDER BY l.ts, l.event_type, l."partition", l."offset" LIMIT 1000""",

    "read_bounded": f"""WITH {LOG}, {BAT}
SELECT event_type, "partition", batch_no, false AS keepalive, n_events FROM bat
UNION ALL
SELECT event_type, "partition", batch_no, true, CAST(0 AS BIGINT) FROM bat WHERE batch_no % 10 = 9""",

    "commit_cumulative": f"""WITH {LOG}, {BAT}
SELECT event_type, "partition", CAST(max(last_offset) AS VARCHAR) AS "offset",
       arg_max({_uuid("md5(event_type || '/' || \"partition\" || '/' || CAST(batch_no AS VARCHAR))")}, last_offset)
         AS cursor_token
FROM bat WHERE batch_no % 7 <> 3 GROUP BY ALL""",

    "commit_cursors": f"""WITH {LOG}, {BAT}, {CUR}
SELECT b.event_type, b."partition", b.last_offset AS offset_num,
       CASE WHEN c.committed IS NULL OR b.last_offset > c.committed THEN 'committed' ELSE 'outdated' END AS result
FROM bat b LEFT JOIN cur c ON b.event_type = c.event_type AND b."partition" = c."partition"
WHERE b.batch_no % 7 <> 3""",

    "reset_cursors": f"""WITH {LOG}, {BAT}
SELECT '{SUB}' AS subscription_id, event_type, "partition", CAST(last_offset AS VARCHAR) AS "offset", true AS reset
FROM bat WHERE batch_no = 0""",

    "expired_batches": f"""WITH {LOG}, {BAT}
SELECT b.event_type, b."partition", b.batch_no FROM bat b
WHERE NOT EXISTS (
  SELECT 1 FROM bat c WHERE c.event_type = b.event_type AND c."partition" = b."partition" AND c.batch_no % 7 <> 3
    AND c.last_offset >= b.last_offset
    AND c.newest + INTERVAL 1 SECOND + to_seconds(CAST((c.batch_no % 5) * 20 AS BIGINT))
        <= b.newest + INTERVAL 61 SECOND)""",

    "inflight_pause": f"""WITH {LOG}, {BAT},
o AS (SELECT event_type, "partition", batch_no,
             CAST(COALESCE(sum(CASE WHEN batch_no % 7 = 3 THEN n_events ELSE 0 END) OVER (
               ORDER BY newest, event_type, "partition", CAST(last_offset AS VARCHAR)
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS outstanding_before
      FROM bat)
SELECT event_type, "partition", batch_no, outstanding_before, outstanding_before >= 100 AS paused FROM o""",

    "keepalive_runs": f"""WITH {LOG}, {BAT}, {SENT},
ord AS (SELECT *, sum(CASE WHEN keepalive THEN 0 ELSE 1 END) OVER w AS island,
               sum(CASE WHEN keepalive THEN 1 ELSE 0 END) OVER w AS ka
        FROM sent WINDOW w AS (ORDER BY sent_ts, event_type, "partition", off, keepalive
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
base AS (SELECT island, min(ka - CASE WHEN keepalive THEN 1 ELSE 0 END) AS b FROM ord GROUP BY island)
SELECT event_type, "partition", batch_no, keepalive, CAST(island AS BIGINT) AS island,
       CAST(CASE WHEN keepalive THEN ka - b ELSE 0 END AS BIGINT) AS run_length,
       keepalive AND (ka - b) = 2 AS closes
FROM ord JOIN base USING (island)""",

    "compact_latest": f"""WITH {LOG},
c AS (SELECT *, CASE WHEN category <> 'undefined' THEN 'u' || CAST(user_id AS VARCHAR) END AS ckey
      FROM log WHERE event_type IN ('purchase', 'signup'))
SELECT event_type, "partition", ckey AS partition_compaction_key, arg_max(event_id, "offset") AS event_id,
       max("offset") AS "offset"
FROM c WHERE ckey IS NOT NULL GROUP BY ALL
UNION ALL
SELECT event_type, "partition", ckey, event_id, "offset" FROM c WHERE ckey IS NULL""",

    "traffic_statistics": """SELECT event_type, round(avg(n), 6) AS messages_per_minute,
       round(sum(b) / sum(n), 6) AS message_size, CAST(count(*) AS BIGINT) AS active_minutes
FROM (SELECT event_type, date_trunc('minute', ts) AS m, count(*) AS n, sum(strlen(props)) AS b FROM events GROUP BY ALL)
GROUP BY event_type""",

    "trace_counts": """SELECT substr(md5(CAST(user_id AS VARCHAR)), 1, 16) AS trace_id, count(*) AS events
FROM events WHERE event_id % 10 <= 5 AND event_id % 5 = 0 AND event_id % 97 <> 0 GROUP BY 1""",

    "partition_counts": f"""WITH {EV} SELECT event_type, "partition", count(*) AS events FROM ev GROUP BY ALL""",

    "order_in_instance": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey)
       AS BIGINT) AS key_rank,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber)
       AS BIGINT) AS arrival_rank,
  COALESCE(max(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > l_linenumber, false) AS out_of_order
FROM lineitem""",

    "find_subscription": f"""WITH {SUBS}, {REQ}, {_first_match("req")}
SELECT request_id, subscription_id FROM first""",

    "create_if_absent": f"""WITH {SUBS}, {REQ},
req2 AS (SELECT request_id, owning_application, consumer_group,
                CASE WHEN request_id % 4 = 0 THEN list_distinct(list_concat(event_types, ['error','signup','view']))
                     ELSE event_types END AS event_types FROM req),
{_first_match("req2")}
SELECT request_id, subscription_id, false AS created FROM first
UNION ALL
SELECT request_id,
       {_uuid("md5(owning_application || '/' || array_to_string(list_sort(event_types), ',') || '/' || COALESCE(consumer_group, ''))")},
       true
FROM req2 WHERE request_id NOT IN (SELECT request_id FROM first)""",

    "list_subscriptions": f"""WITH {SUBS}
SELECT id, owning_application, consumer_group, epoch_us(created_at) AS created_us FROM subs
WHERE owning_application = 'BUILDING' AND list_contains(event_types, 'click') AND list_contains(event_types, 'view')
ORDER BY created_at DESC, id LIMIT 10 OFFSET 5""",

    "page_links": f"""WITH {SUBS}
SELECT count(*) AS total, true AS has_prev, count(*) > 15 AS has_next FROM subs
WHERE owning_application = 'BUILDING' AND list_contains(event_types, 'click') AND list_contains(event_types, 'view')""",

    "subscription_get": f"""WITH {SUBS}
SELECT id, owning_application, array_to_string(event_types, ',') AS event_types, consumer_group, read_from
FROM subs WHERE id = '{SUB}'""",

    "authorized_events": """SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'error', 'view')""",

    "drop_deleted_types": """SELECT event_id, event_type FROM events WHERE event_type <> 'error'""",

    "with_event_type": """SELECT e.event_id, e.event_type, r.partition_strategy, r.cleanup_policy, r.type_category
FROM events e LEFT JOIN (VALUES
  ('click', 'hash', 'delete', 'business'), ('error', 'random', 'delete', 'undefined'),
  ('purchase', 'user_defined', 'compact', 'data'), ('signup', 'hash', 'compact', 'business'),
  ('view', 'random', 'delete', 'business')) r(name, partition_strategy, cleanup_policy, type_category)
ON e.event_type = r.name""",

    "retention_filter": """WITH a AS (SELECT max(ts) AS as_of FROM events)
SELECT event_id, event_type FROM events, a
WHERE CASE event_type WHEN 'click' THEN ts >= as_of - INTERVAL 20 DAY
                      WHEN 'error' THEN ts >= as_of - INTERVAL 7 DAY
                      WHEN 'view' THEN ts >= as_of - INTERVAL 25 DAY
                      ELSE true END""",

    "scope_allowed": """SELECT event_type, count(*) AS events FROM events
WHERE event_type IN ('error', 'purchase', 'signup', 'view') GROUP BY ALL""",

    "publish_once": f"""WITH {EV}, {R0}
SELECT event_id, resolved_eid AS eid, ppart AS "partition", st AS publishing_status, sp AS step FROM o0""",

    "assign_partition": f"""WITH {EV}, {PIN}
SELECT event_id, ppart AS "partition", (event_type = 'purchase' AND category = 'undefined') AS rejected
FROM pin JOIN (SELECT event_id, event_type FROM events) USING (event_id)""",

    "validate_events": f"""WITH {EV}
SELECT event_id, event_id % 1009 <> 5 AS size_ok,
       CASE WHEN malformed THEN CASE WHEN category = 'data' THEN '$.data.value' ELSE '$.value' END || ': expected double'
            WHEN event_id % 1009 = 5 THEN 'event larger than 999000 bytes' END AS violation
FROM ev""",

    "validate_by_type": f"""WITH {EV}, p AS (SELECT *, CASE WHEN category = 'data' THEN '$.data' ELSE '$' END AS base FROM ev)
SELECT event_id, CASE WHEN event_type = 'click' AND malformed THEN base || '.value: expected double'
                      WHEN event_type = 'view' AND NOT malformed THEN base || '.value: expected a string'
                      WHEN event_type = 'purchase' THEN base || '.receipt: missing' END AS violation
FROM p""",

    "partition_by_path": f"""SELECT event_id,
       CASE WHEN event_id % 7 > 1 THEN CAST({_bucket('user_id')} AS VARCHAR) END AS "partition",
       CASE WHEN event_id % 7 <= 1 THEN 'partition key missing: user.id' END AS partition_error FROM events""",

    "event_id_deep": f"""SELECT event_id, CASE WHEN event_id % 7 IN (0, 1, 5) THEN {EID} END AS resolved_eid FROM events""",

    "encode_events": f"""WITH {EV}, t AS (SELECT *, CAST(user_id AS VARCHAR) AS u, CAST(event_id % 3 AS VARCHAR) AS team,
  CASE WHEN event_id % 2 = 0 THEN '"both":"2"' END AS span FROM ev), x AS (SELECT *,
  '"eid":"' || eid || '","event_type":"' || event_type || '","occurred_at":"2024-05-06T07:08:09Z","partition":"' || "partition" || '"' AS md,
  '"user_id":' || u || ',"z":{{"s":"a\\":null,b"}}}}' AS rest FROM t)
SELECT event_id, CASE category
  WHEN 'business' THEN '{{"metadata":{{' || md || coalesce(',"span_ctx":{{' || span || ',"own":"1"}}', '') || ',"team":"t' || team || '"}},' || rest
  WHEN 'data' THEN '{{"data":{{"metadata":{{"eid":"own","flow_id":"own","span_ctx":{{"both":"1","own":"1"}},"team":"t' || team || '"}},' || rest
       || ',"data_op":"' || data_op || '","data_type":"' || event_type || '","metadata":{{' || md || coalesce(',"span_ctx":{{' || span || '}}', '') || '}}}}'
  ELSE '{{"metadata":{{"eid":"own","flow_id":"own","span_ctx":{{"both":"1","own":"1"}},"team":"t' || team || '"}},' || rest END AS raw
FROM x""",

    "enrich_metadata": f"""WITH {EV}
SELECT event_id,
       CASE WHEN category <> 'undefined' AND event_type <> 'error' AND event_id % 89 = 1
            THEN 'metadata.event_type: enrichment would overwrite a present value' END AS enrich_error,
       CASE WHEN category <> 'undefined' AND event_type <> 'error' THEN 'flow-1' END AS flow_id,
       CASE WHEN category <> 'undefined' AND event_type <> 'error' THEN epoch_us(TIMESTAMP '2025-01-01 00:00:00') END AS received_us
FROM ev""",

    "events_to_retry": f"""WITH {EV}, {R0}
SELECT event_id FROM o0 WHERE {RETRYABLE} OR resolved_eid IS NULL""",

    "outcome_summary": f"""WITH {EV}, {R0}
SELECT st AS publishing_status, sp AS step, count(*) AS items,
       min(CASE WHEN st = 'submitted' THEN 1 ELSE 0 END) OVER () = 1 AS call_ok
FROM o0 GROUP BY st, sp""",

    "failed_ids": f"""WITH {EV}, {R0}
SELECT batch_id,
       COALESCE(string_agg(resolved_eid, ',' ORDER BY resolved_eid), '') AS failed_eids,
       COALESCE(string_agg(CASE WHEN sp = 'validating'
                                THEN 'eid: ' || COALESCE(resolved_eid, 'N/A') || ', detail: ' || COALESCE(dt, 'N/A')
                           END, ',' ORDER BY CASE WHEN sp = 'validating'
                                THEN 'eid: ' || COALESCE(resolved_eid, 'N/A') || ', detail: ' || COALESCE(dt, 'N/A')
                           END), '') AS invalid_details
FROM o0 WHERE st <> 'submitted' GROUP BY batch_id""",

    "merge_rejects": f"""WITH {EV}, {R0}, {OUTCOMES},
rej AS (SELECT eid, publishing_status, step FROM oc WHERE publishing_status <> 'submitted'
        UNION ALL SELECT resolved_eid, st, sp FROM o0 WHERE st <> 'submitted'),
d AS (SELECT publishing_status, step, count(*) AS distinct_rejects FROM (SELECT DISTINCT * FROM rej) GROUP BY ALL),
a AS (SELECT publishing_status, step, count(*) AS all_rejects FROM rej GROUP BY ALL)
SELECT publishing_status, step, distinct_rejects, all_rejects FROM d JOIN a USING (publishing_status, step)""",

    "needs_retry": f"""WITH {OUTCOMES}
SELECT event_id, NOT (step = 'validating') AND publishing_status <> 'submitted' AS needs_retry,
       publishing_status <> 'submitted' AS not_submitted FROM oc""",

    "read_outcomes": f"""WITH {OUTCOMES}
SELECT CAST(event_id // 50 AS BIGINT) AS call, row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) - 1 AS item_no,
       eid, CASE WHEN event_id % 61 = 0 THEN 'lost' ELSE publishing_status END AS publishing_status, step, detail,
       CASE WHEN event_id % 61 = 0 THEN '$.publishing_status: not one of submitted,failed,aborted' END AS item_error FROM oc""",

    "error_kind": f"""WITH {OUTCOMES}
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'problem' WHEN 1 THEN 'basic' WHEN 2 THEN 'raw' ELSE 'none' END AS kind,
       CASE WHEN event_id % 4 = 0 THEN 'Unprocessable' END AS title, CASE WHEN event_id % 4 = 0 THEN CAST(422 AS BIGINT) END AS status,
       CASE WHEN event_id % 4 = 0 THEN coalesce(detail, 'none') END AS detail, CASE WHEN event_id % 4 = 1 THEN 'x' END AS error,
       CASE WHEN event_id % 4 = 1 THEN 'y' END AS error_description,
       CASE WHEN event_id % 4 = 2 THEN 'oops ' || CAST(event_id AS VARCHAR) END AS text FROM oc""",

    "mask_token": """SELECT event_id,
       'GET /events?user=' || CAST(user_id AS VARCHAR) || ' Authorization: Bearer <secret>' AS line FROM events""",

    "backoff_delay": f"""WITH {OUTCOMES}
SELECT event_id, CAST(k AS BIGINT) AS k, round(100.0 * pow(1.5, k * (k + 1) / 2.0), 3) AS delay_ms
FROM oc, range(0, 6) t(k) WHERE NOT (step = 'validating') AND publishing_status <> 'submitted'""",

    "parse_offset_ts": """SELECT event_id,
       CASE event_id % 3 WHEN 0 THEN epoch_us(date_trunc('second', ts))
                         WHEN 1 THEN epoch_us(date_trunc('second', ts)) - 7200000000 END AS parsed_us
FROM events""",

    "publish_with_retry": _retry_sql(),

    "publish_append": f"""WITH {EV}, {PIN},
o AS (SELECT *, bool_or(fail_step IS NOT NULL) OVER (PARTITION BY batch_id) AS bad FROM pin)
SELECT ev.event_type, ppart AS "partition", event_id, CAST(row_number() OVER (
       PARTITION BY ev.event_type, ppart ORDER BY blk % 2, ts, event_id) - 1 AS BIGINT) AS "offset"
FROM o JOIN ev USING (event_id) WHERE NOT bad""",

    "stream_subscription": f"""WITH {EV},
c AS (SELECT event_type, "partition", count(*) FILTER (WHERE event_id % 2 = 0) AS run_1,
             count(*) FILTER (WHERE event_id % 2 = 1) AS run_2 FROM ev WHERE NOT malformed GROUP BY ALL)
SELECT event_type, "partition", run_1, run_2,
       CAST(CASE "partition" WHEN '0' THEN greatest(run_1 + run_2 - 10, 0) WHEN '1' THEN run_1 + run_2 ELSE 0 END AS BIGINT) AS run_3,
       CAST(CASE "partition" WHEN '0' THEN greatest(run_1 + run_2 - 1, 9) ELSE run_1 + run_2 - 1 END AS BIGINT) AS committed
FROM c""",

    "stream_consume": f"""WITH {LOG}, {BAT}
SELECT event_type, "partition", max(last_offset) AS committed_offset,
       CAST(sum(CASE WHEN bad THEN 0 ELSE n_events END) AS BIGINT) AS received_events,
       CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS dead_letter_batches
FROM bat GROUP BY ALL""",

    "stream_expired": None,

    "stream_flush": f"""WITH {LOG}, {BAT}
SELECT event_type, "partition", batch_no, batch_no * 20 AS first_offset, last_offset, n_events,
       CASE WHEN n_events = 20 THEN 'limit' ELSE 'timeout' END AS reason
FROM bat""",

    "stream_compaction": f"""WITH {LOG},
c AS (SELECT *, CASE WHEN category <> 'undefined' THEN 'u' || CAST(user_id AS VARCHAR) END AS ckey
      FROM log WHERE event_type IN ('purchase', 'signup'))
SELECT event_type, "partition", ckey AS partition_compaction_key, arg_max(event_id, "offset") AS event_id,
       max("offset") AS "offset"
FROM c WHERE ckey IS NOT NULL GROUP BY ALL
UNION ALL
SELECT event_type, "partition", ckey, event_id, "offset" FROM c WHERE ckey IS NULL""",

    "stream_traffic": """SELECT event_type, round(avg(n), 6) AS messages_per_minute,
       CAST(count(*) AS BIGINT) AS active_minutes
FROM (SELECT event_type, date_trunc('minute', ts) AS m, count(*) AS n FROM events GROUP BY ALL) GROUP BY ALL""",
}
ORACLE["stream_expired"] = ORACLE["expired_batches"]

"""Reference SQL (DuckDB dialect) for every query in ``catalog.QUERIES``.

Same whole tables, same fixed parameters, same output column names.
"""

from __future__ import annotations

MESSAGES = """messages AS (
  SELECT event_type AS topic,
         CAST(user_id % 3 AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY event_type, user_id % 3
                                 ORDER BY ts, event_id) - 1 AS BIGINT) AS "offset",
         ts AS "timestamp", props AS value, event_id AS seq
  FROM events)"""

LEDGER = """ledger AS (
  SELECT 'all' AS role, topic, "partition", "offset", seq, "timestamp" FROM messages
  UNION ALL
  SELECT 'formal' AS role, topic, "partition", "offset", seq, "timestamp" FROM messages
  WHERE "timestamp" < TIMESTAMP '2024-01-10 00:00:00')"""

LATEST = """latest AS (
  SELECT role, topic, "partition", max_by("offset", seq) AS "offset"
  FROM ledger GROUP BY role, topic, "partition")"""

LAG = """lag_tbl AS (
  SELECT topic, CAST(greatest(0, sum(CASE WHEN role = 'all' THEN "offset" ELSE -"offset" END))
         AS BIGINT) AS lag
  FROM latest GROUP BY topic)"""

WATERMARKS = """marks AS (
  SELECT topic, "partition", min("offset") AS low_watermark,
         CAST(max("offset") + 1 AS BIGINT) AS high_watermark
  FROM messages GROUP BY topic, "partition")"""

NEXT_POS = """nextpos AS (
  SELECT topic, "partition", CAST(max_by("offset", seq) + 1 AS BIGINT) AS next_offset
  FROM ledger WHERE role = 'formal' GROUP BY topic, "partition")"""


def _envelope(expr: str) -> str:
    doc = f"CAST(json_object('attempts', 1, 'data', coalesce({expr}, '')) AS VARCHAR)"
    for raw, esc in (("'<'", "'\\u003c'"), ("'>'", "'\\u003e'"), ("'&'", "'\\u0026'"),
                     ("chr(8232)", "'\\u2028'"), ("chr(8233)", "'\\u2029'")):
        doc = f"replace({doc}, {raw}, {esc})"
    return doc


ROUTED = f"""routed AS (
  SELECT 'queues:' || topic AS queue, {_envelope('value')} AS payload,
         topic, "partition", "offset", "timestamp", seq
  FROM messages)"""

RELAY = """relay AS (
  SELECT queue,
         CAST(row_number() OVER (PARTITION BY queue ORDER BY "timestamp", "partition", "offset")
              - 1 AS BIGINT) AS pos,
         payload, topic, "partition", "offset", CAST(0 AS BIGINT) AS batch_id, seq
  FROM routed)"""

# A queue table of batches of 20,000 sequence numbers, and the place of each item in its queue.
PLACED = """placed AS (
  SELECT *, row_number() OVER (PARTITION BY queue ORDER BY batch_id, pos) AS place
  FROM (SELECT queue, pos, payload, topic, "partition", "offset", CAST(floor(seq / 20000) AS BIGINT) AS batch_id FROM relay))"""
QUEUE_COLS = 'queue, pos, payload, topic, "partition", "offset", batch_id'

GATE = """gate AS (
  SELECT topic, time_bucket(INTERVAL 30 MINUTE, "timestamp", TIMESTAMP '1970-01-01') + INTERVAL 30 MINUTE AS tick,
         CAST(count(*) AS BIGINT) AS len, count(*) <= 2 AS is_open
  FROM messages GROUP BY ALL)"""

GATED = """gated AS (
  SELECT m.*, coalesce(g.is_open, true) AS is_open
  FROM messages m ASOF LEFT JOIN gate g ON g.topic = m.topic AND m."timestamp" >= g.tick)"""

# Lag at the end of every tick with activity, straight from its definition: the last position of
# each (role, partition) before the tick's end.
LAG_LINE = """spots AS (
  SELECT DISTINCT topic, time_bucket(INTERVAL 10 SECOND, "timestamp", TIMESTAMP '1970-01-01') + INTERVAL 10 SECOND AS tick
  FROM ledger),
keys AS (SELECT DISTINCT role, topic, "partition" FROM ledger),
asked AS (SELECT s.topic, s.tick, k.role, k."partition" FROM spots s JOIN keys k USING (topic)),
known AS (
  SELECT a.topic, a.tick, a.role, coalesce(l."offset", 0) AS pos
  FROM asked a ASOF LEFT JOIN ledger l
    ON l.topic = a.topic AND l.role = a.role AND l."partition" = a."partition" AND a.tick > l."timestamp"),
line AS (
  SELECT topic, tick, CAST(greatest(0, sum(CASE WHEN role = 'all' THEN pos ELSE -pos END)) AS BIGINT) AS lag
  FROM known GROUP BY topic, tick)"""

MSG_COLS = 'topic, "partition", "offset", "timestamp", value, seq'


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _gauge_lists() -> str:
    # Per topic: the list of gauge values after each sample (fold in order).
    step = ("CASE WHEN l = 0 THEN 0 "
            "ELSE least(1000000, greatest(0, coalesce(acc[-1], 0) + "
            "CASE WHEN l >= 700 THEN 1000 ELSE -1000 END)) END")
    return f"""samples AS (
  SELECT event_type AS topic, event_id AS seq, CAST(floor(value * 20) AS BIGINT) AS len
  FROM events),
folded AS (
  SELECT topic,
         list_reduce(list(len ORDER BY seq), lambda acc, l: list_append(acc, {step}),
                     CAST([] AS BIGINT[])) AS gauges,
         list(seq ORDER BY seq) AS seqs,
         list(len ORDER BY seq) AS lens
  FROM samples GROUP BY topic)"""


SQL: dict[str, str] = {
    "stream_source": _with(MESSAGES) + f"SELECT {MSG_COLS} FROM messages",
    "log_source": _with(MESSAGES)
    + 'SELECT topic, "partition", "offset", "timestamp", value, "offset" AS seq FROM messages',
    "log_rewind": _with(MESSAGES, LEDGER, NEXT_POS, """readings AS (
  SELECT topic, "partition", "offset", CAST(0 AS BIGINT) AS epoch FROM messages
  UNION ALL
  SELECT m.topic, m."partition", m."offset", CAST(1 AS BIGINT) AS epoch
  FROM messages m LEFT JOIN nextpos n ON n.topic = m.topic AND n."partition" = m."partition"
  WHERE m."offset" >= coalesce(n.next_offset, 0))""") + """
SELECT topic, "partition", epoch, count(*) AS n, min("offset") AS first_offset, max("offset") AS last_offset,
       max("offset") AS latest_offset
FROM readings GROUP BY topic, "partition", epoch""",
    "ledger_all": _with(MESSAGES, LEDGER)
    + "SELECT role, topic, \"partition\", \"offset\", seq FROM ledger WHERE role = 'all'",
    "queue_append": _with(MESSAGES, ROUTED) + """
SELECT queue,
       CAST(row_number() OVER (PARTITION BY queue ORDER BY "timestamp", "partition", "offset")
            - 1 AS BIGINT) AS pos,
       payload, topic, "partition", "offset", CAST(floor(seq / 1000) AS BIGINT) AS batch_id
FROM routed""",
    "list_sink": _with(MESSAGES, ROUTED)
    + 'SELECT queue, "partition", "offset", "offset" AS place, payload FROM routed',
    "queue_claim": _with(MESSAGES, ROUTED, RELAY, PLACED)
    + f"SELECT {QUEUE_COLS}, CASE WHEN place <= 5 THEN 'one' ELSE 'two' END AS worker FROM placed WHERE place <= 10",
    "queue_depth_kept": _with(MESSAGES) + """
SELECT 'queues:' || topic AS queue, count(*) AS pushed, least(10, count(*)) AS taken, count(*) - least(10, count(*)) AS depth
FROM messages GROUP BY topic""",
    "queue_compacted": _with(MESSAGES, ROUTED, RELAY, PLACED) + f"SELECT {QUEUE_COLS} FROM placed WHERE place > 10",
    "lag_table_upsert": _with(MESSAGES, LEDGER) + """,
old_latest AS (
  SELECT role, topic, "partition", max_by("offset", seq) AS "offset"
  FROM ledger WHERE "timestamp" < TIMESTAMP '2024-01-20 00:00:00'
  GROUP BY role, topic, "partition"),
old_lag AS (
  SELECT topic, CAST(greatest(0, sum(CASE WHEN role = 'all' THEN "offset" ELSE -"offset" END))
         AS BIGINT) AS lag, CAST(1 AS BIGINT) AS version
  FROM old_latest GROUP BY topic),
""" + LATEST + ",\n" + LAG + """,
new_lag AS (
  SELECT topic, lag, CAST(2 AS BIGINT) AS version FROM lag_tbl
  WHERE topic IN (SELECT topic FROM messages
                  WHERE "timestamp" >= TIMESTAMP '2024-01-30 23:30:00')),
merged AS (SELECT * FROM old_lag UNION ALL SELECT * FROM new_lag)
SELECT topic, max_by(lag, version) AS lag, max(version) AS version
FROM merged GROUP BY topic""",
    "msg_projection": _with(MESSAGES)
    + "SELECT topic, \"partition\", \"offset\", coalesce(value, '') AS data FROM messages",
    "envelope": f"SELECT source AS topic, doc_id AS seq, {_envelope('text')} AS payload "
                "FROM documents",
    "queue_name": _with(MESSAGES) + "SELECT seq, topic, 'queues:' || topic AS queue FROM messages",
    "ledger_key": _with(MESSAGES, LEDGER, LATEST)
    + "SELECT '<' || role || '>##<' || CAST(\"partition\" AS VARCHAR) || '>##' || topic AS key, "
      "\"offset\" FROM latest",
    "ledger_key_decode": _with(MESSAGES, LEDGER, LATEST) + """,
keyed AS (
  SELECT '<' || role || '>##<' || CAST("partition" AS VARCHAR) || '>##' || topic AS key, "offset"
  FROM latest
  UNION ALL
  SELECT topic AS key, count(*) AS "offset" FROM messages GROUP BY topic)
SELECT key,
       string_split(key, '##')[1] = '<all>' AS is_all,
       TRY_CAST(regexp_extract(string_split(key, '##')[2], '^<(.*)>$', 1) AS INTEGER)
         AS "partition",
       string_split(key, '##')[3] AS topic,
       "offset"
FROM keyed WHERE len(string_split(key, '##')) > 2""",
    "offset_parse": _with(MESSAGES, WATERMARKS) + """,
snap AS (
  SELECT topic, "partition", CAST(max_by("offset", seq) + 1 AS BIGINT) AS next_offset
  FROM messages WHERE "timestamp" < TIMESTAMP '2024-01-01 02:00:00'
  GROUP BY topic, "partition"),
texts AS (
  SELECT m.topic, m."partition", coalesce(CAST(s.next_offset AS VARCHAR), 'unset') AS offset_text
  FROM marks m LEFT JOIN snap s USING (topic, "partition"))
SELECT topic, "partition", offset_text,
       coalesce(CASE WHEN regexp_full_match(offset_text, '[+-]?[0-9]+')
                     THEN TRY_CAST(offset_text AS BIGINT) END, 0) AS "offset"
FROM texts""",
    "subscribe_filter": _with(MESSAGES)
    + f"SELECT {MSG_COLS} FROM messages WHERE topic IN ('click', 'purchase', 'signup')",
    "valid_records": _with(MESSAGES) + """
SELECT topic, seq, value FROM (
  SELECT topic, seq, value FROM messages
  UNION ALL SELECT CASE WHEN lang <> 'es' THEN source END AS topic, doc_id AS seq, text AS value FROM documents)
WHERE topic IS NOT NULL""",
    "rejected_records": _with(MESSAGES) + """
SELECT topic, seq, value, 'missing_topic' AS reason FROM (
  SELECT topic, seq, value FROM messages
  UNION ALL SELECT CASE WHEN lang <> 'es' THEN source END AS topic, doc_id AS seq, text AS value FROM documents)
WHERE topic IS NULL""",
    "admitted": _with(MESSAGES, GATE, GATED) + f"SELECT {MSG_COLS} FROM gated WHERE is_open",
    "deferred": _with(MESSAGES, GATE, GATED) + f"SELECT {MSG_COLS} FROM gated WHERE NOT is_open",
    "relay_batch": _with(MESSAGES, ROUTED, RELAY)
    + 'SELECT queue, pos, payload, topic, "partition", "offset", batch_id FROM relay',
    "relay_runs": _with(MESSAGES, ROUTED, RELAY)
    + 'SELECT queue, pos, payload, topic, "partition", "offset", batch_id FROM relay',
    "latest_offset": _with(MESSAGES, LEDGER, LATEST) + "SELECT * FROM latest",
    "topic_lag": _with(MESSAGES, LEDGER, LATEST, LAG) + "SELECT topic, lag FROM lag_tbl",
    "partition_lag": _with(MESSAGES, LEDGER, WATERMARKS, NEXT_POS) + """
SELECT m.topic, m."partition", low_watermark, high_watermark, next_offset,
       CAST(high_watermark - coalesce(next_offset, low_watermark) AS BIGINT) AS lag
FROM marks m LEFT JOIN nextpos n USING (topic, "partition")""",
    "watermarks": _with(MESSAGES, WATERMARKS) + "SELECT * FROM marks",
    "committed_position": _with(MESSAGES, LEDGER, WATERMARKS, NEXT_POS) + """
SELECT m.topic, m."partition", n.next_offset
FROM marks m LEFT JOIN nextpos n USING (topic, "partition")""",
    "queue_depth": _with(MESSAGES) + """
SELECT c.queue, CAST(coalesce(d.depth, 0) AS BIGINT) AS depth
FROM (SELECT 'queues:' || t AS queue
      FROM unnest(['click', 'error', 'purchase', 'signup', 'view', 'refund']) AS u(t)) c
LEFT JOIN (SELECT 'queues:' || topic AS queue, count(*) AS depth FROM messages GROUP BY 1) d
  USING (queue)""",
    "queue_pop": _with(MESSAGES, ROUTED, RELAY)
    + 'SELECT queue, pos, payload, topic, "partition", "offset", batch_id FROM relay WHERE pos < 5',
    "queue_remaining": _with(MESSAGES, ROUTED, RELAY)
    + 'SELECT queue, pos, payload, topic, "partition", "offset", batch_id FROM relay '
      'WHERE pos >= 5',
    "queue_position": f"""
SELECT 'queues:' || role AS queue, conv_id, turn, {_envelope('text')} AS payload,
       CAST(row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS BIGINT) AS pos
FROM conversations""",
    "queue_depth_timeline": _with(MESSAGES) + """,
ops AS (
  SELECT 'queues:' || topic AS queue, CAST(seq * 2 AS BIGINT) AS op_seq, CAST(1 AS BIGINT) AS delta
  FROM messages
  UNION ALL
  SELECT 'queues:' || topic, CAST(seq * 2 + 1 AS BIGINT), CAST(-2 AS BIGINT)
  FROM messages WHERE seq % 2 = 0),
running AS (
  SELECT queue, op_seq, delta,
         sum(delta) OVER (PARTITION BY queue ORDER BY op_seq
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
  FROM ops)
SELECT queue, op_seq, delta,
       CAST(s - least(0, min(s) OVER (PARTITION BY queue ORDER BY op_seq
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
            AS BIGINT) AS depth
FROM running""",
    "gate_state": _with(MESSAGES, GATE) + "SELECT topic, tick, len, is_open FROM gate",
    "gate_transitions": _with(MESSAGES, GATE) + """
SELECT topic, tick, CASE WHEN is_open THEN 'resume' ELSE 'pause' END AS event
FROM (SELECT *, lag(is_open, 1, true) OVER (PARTITION BY topic ORDER BY tick) AS was_open
      FROM gate)
WHERE was_open <> is_open""",
    "lag_timeline": _with(MESSAGES, LEDGER, LAG_LINE) + "SELECT topic, tick, lag FROM line",
    "lag_timeline_dense": _with(MESSAGES, LEDGER, LAG_LINE) + """,
grid AS (
  SELECT topic, unnest(generate_series(min(tick), (SELECT max(tick) FROM line), INTERVAL 10 SECOND)) AS tick
  FROM line GROUP BY topic)
SELECT g.topic, g.tick, l.lag
FROM grid g ASOF JOIN line l ON l.topic = g.topic AND g.tick >= l.tick""",
    "relay_stream": _with(MESSAGES, ROUTED)
    + 'SELECT queue, payload, topic, "partition", "offset" FROM routed',
    "lag_stream": _with(MESSAGES, LEDGER, LATEST, LAG) + "SELECT topic, lag FROM lag_tbl",
    "lag_service": _with(MESSAGES, LEDGER, LATEST, LAG) + "SELECT topic, lag FROM lag_tbl",
    "pressure_gauge": _with(_gauge_lists())
    + "SELECT topic, gauges[-1] AS gauge FROM folded",
    "pressure_timeline": _with(_gauge_lists()) + """
SELECT topic, seqs[i] AS seq, lens[i] AS len, gauges[i] AS gauge
FROM folded, range(1, len(seqs) + 1) AS r(i)""",
    "pressure_stream": _with(_gauge_lists()) + """
SELECT topic, seqs[i] AS seq, lens[i] AS len, gauges[i] AS gauge
FROM folded, range(1, len(seqs) + 1) AS r(i)""",
    "replay": _with(MESSAGES, LEDGER, NEXT_POS) + f"""
SELECT {', '.join('m.' + c for c in MSG_COLS.split(', '))}
FROM messages m LEFT JOIN nextpos n USING (topic, "partition")
WHERE m."offset" >= coalesce(n.next_offset, 0)""",
    "relay_counts": _with(MESSAGES, GATE, GATED) + """
SELECT topic, "partition", CAST(count(*) AS BIGINT) AS seen,
       CAST(count(*) FILTER (WHERE is_open) AS BIGINT) AS pushed,
       CAST(count(*) FILTER (WHERE NOT is_open) AS BIGINT) AS deferred,
       max(CASE WHEN is_open THEN "offset" END) AS last_pushed_offset
FROM gated GROUP BY topic, "partition\"""",
}

# a kept timeline equals one scan over all rows
SQL["depth_timeline_kept"] = SQL["queue_depth_timeline"]
SQL["pressure_timeline_kept"] = SQL["pressure_timeline"]

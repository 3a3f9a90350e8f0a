"""DuckDB SQL twins of the registered queries (the correctness oracle).

Tables ``events`` and ``documents`` are views over the same Parquet files the
Spark queries read.  The change logs are derived by the same rule as
``tidemark.sources.fixtures``.
"""

from __future__ import annotations

ZEROS = "unhex('00000000000000000000')"

LOGS = """
events_ct AS (
  SELECT event_type AS table_name,
         unhex(lpad(hex(event_id // 4 + 1), 20, '0')) AS start_lsn,
         unhex(lpad(hex(event_id + 1), 20, '0')) AS seqval,
         unnest(CASE event_id % 5 WHEN 0 THEN [1] WHEN 1 THEN [3, 4]
                                  WHEN 2 THEN [5] ELSE [2] END) AS operation,
         event_id, ts, user_id, value,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE props END AS props
  FROM events),
documents_ct AS (
  SELECT lang AS table_name,
         unhex(lpad(hex(doc_id // 3 + 1), 20, '0')) AS start_lsn,
         unhex(lpad(hex(doc_id + 1), 20, '0')) AS seqval,
         unnest(CASE doc_id % 4 WHEN 0 THEN [1] WHEN 1 THEN [3, 4] ELSE [2] END) AS operation,
         doc_id, text, source, n_chars
  FROM documents)"""

OPTYPE = (
    "CASE WHEN operation = 2 THEN 'Insert' WHEN operation IN (3, 4) THEN 'Update' "
    "WHEN operation = 1 THEN 'Delete' END"
)
KEYS = "table_name, lower(hex(start_lsn)) AS lsn, lower(hex(seqval)) AS seq"
TS = "replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z'"
EV_DATA = (
    "{'event_id': CAST(event_id AS VARCHAR), 'props': props, 'ts': " + TS + ", "
    "'user_id': CAST(user_id AS VARCHAR), 'value': CAST(value AS VARCHAR)}"
)
DOC_DATA = (
    "{'doc_id': CAST(doc_id AS VARCHAR), 'n_chars': CAST(n_chars AS VARCHAR), "
    "'source': source, 'text': text}"
)
META = (
    "{'LSN': lower(hex(start_lsn)), 'OperationID': operation, 'OperationType': " + OPTYPE + ", "
    "'Seq': lower(hex(seqval)), 'TableName': table_name}"
)
DISPLAY = (
    "concat_ws(':', substr(lower(hex(start_lsn)), 1, 8), substr(lower(hex(start_lsn)), 9, 8), "
    "substr(lower(hex(start_lsn)), 17, 4))"
)


def change_json(data: str) -> str:
    return f"CAST(to_json({{'data': {data}, 'metadata': {META}}}) AS VARCHAR)"


def event(data: str, ts: str) -> str:
    return (
        f"{{'table_name': table_name, 'change_type': lower({OPTYPE}), 'data': {data}, "
        f"'timestamp': {ts}, 'lsn': {DISPLAY}}}"
    )


def raw_bytes(cols: str) -> str:
    return (
        "CAST(strlen(CAST(to_json({'__$start_lsn': base64(start_lsn), '__$seqval': base64(seqval), "
        f"'__$operation': operation, {cols}}}) AS VARCHAR)) AS INTEGER)"
    )


EV_RAW = raw_bytes(
    "'event_id': event_id, 'ts': strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 'user_id': user_id, "
    "'value': value, 'props': props"
)
DOC_RAW = raw_bytes("'doc_id': doc_id, 'text': text, 'source': source, 'n_chars': n_chars")

EVENT_TABLES = "['click', 'error', 'purchase', 'signup', 'view']"
ALL_TABLES = "['click', 'error', 'purchase', 'signup', 'view', 'de', 'en', 'es', 'fr']"


def sample_stats_cte(log: str, raw: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT table_name, CAST(sum(row_bytes) AS BIGINT) AS total_bytes, count(*) AS sample_rows,
         CAST(sum(row_bytes) AS DOUBLE) / count(*) AS avg_row_bytes
  FROM (SELECT table_name, {raw} AS row_bytes,
               row_number() OVER (PARTITION BY table_name
                                  ORDER BY start_lsn DESC, seqval DESC, operation DESC) AS rk
        FROM {log}) WHERE rk <= 100
  GROUP BY table_name)"""


SIZE = (
    "CASE WHEN avg_row_bytes IS NOT NULL THEN CAST(greatest(50, least(1000, floor(CAST(262144 AS DOUBLE) / "
    "(avg_row_bytes * CAST(1.2 AS DOUBLE))))) AS INTEGER) END"
)


def sizes_cte(tables: str, stats: str, name: str = "sizes") -> str:
    return f"""
{name} AS (
  SELECT c.table_name, coalesce({SIZE}, 100) AS batch_size,
         coalesce(s.sample_rows, 0) AS sample_rows, s.avg_row_bytes
  FROM (SELECT unnest({tables}) AS table_name) c LEFT JOIN {stats} s ON s.table_name = c.table_name)"""


CURSOR = f"""
pub AS (SELECT * FROM events_ct WHERE operation IN (1, 2, 4)),
multi AS (
  SELECT table_name, min(start_lsn) AS lsn, arg_min(first_seq, start_lsn) AS seq
  FROM (SELECT table_name, start_lsn, min(seqval) AS first_seq FROM pub
        GROUP BY table_name, start_lsn HAVING count(*) >= 2)
  GROUP BY table_name),
newest AS (
  SELECT table_name, start_lsn, seqval FROM (
    SELECT table_name, start_lsn, seqval,
           row_number() OVER (PARTITION BY table_name ORDER BY start_lsn DESC, seqval DESC) AS rn
    FROM pub) WHERE rn = 1),
offsets AS (
  SELECT table_name, lsn AS last_lsn, TIMESTAMP '2024-06-01 12:00:00' AS updated_at, seq AS last_seq
    FROM multi WHERE table_name = 'click'
  UNION ALL SELECT table_name, start_lsn, TIMESTAMP '2024-06-01 12:00:00', seqval
    FROM newest WHERE table_name = 'view'
  UNION ALL SELECT table_name, lsn, TIMESTAMP '2024-06-01 12:00:00', CAST(NULL AS BLOB)
    FROM multi WHERE table_name = 'error'
  UNION ALL SELECT table_name, CAST(NULL AS BLOB), TIMESTAMP '2024-06-01 12:00:00', {ZEROS}
    FROM newest WHERE table_name = 'purchase'),
backfill AS (
  SELECT o.table_name, min(p.seqval) AS backfill_seq
  FROM offsets o JOIN pub p ON p.table_name = o.table_name AND p.start_lsn = o.last_lsn
  WHERE o.last_seq IS NULL AND o.last_lsn IS NOT NULL
  GROUP BY o.table_name)"""


def cursor_cte(tables: str) -> str:
    return f"""
cursor AS (
  SELECT c.table_name,
         CASE WHEN o.table_name IS NULL THEN {ZEROS} ELSE o.last_lsn END AS lsn,
         CASE WHEN o.table_name IS NULL THEN {ZEROS}
              WHEN o.last_seq IS NULL THEN coalesce(b.backfill_seq, {ZEROS})
              ELSE o.last_seq END AS seq
  FROM (SELECT unnest({tables}) AS table_name) c
  LEFT JOIN offsets o ON o.table_name = c.table_name
  LEFT JOIN backfill b ON b.table_name = c.table_name)"""


AFTER = "(k.start_lsn > c.lsn OR (k.start_lsn = c.lsn AND k.seqval > c.seq))"

POLL = (
    CURSOR
    + ","
    + cursor_cte(EVENT_TABLES)
    + ","
    + sample_stats_cte("events_ct", EV_RAW, "ev_stats")
    + ","
    + sizes_cte(EVENT_TABLES, "ev_stats")
    + """,
poll AS (
  SELECT * FROM (
    SELECT k.*, rank() OVER (PARTITION BY k.table_name ORDER BY k.start_lsn, k.seqval) AS poll_rank
    FROM pub k JOIN cursor c ON c.table_name = k.table_name
    WHERE """
    + AFTER
    + """) r JOIN sizes s USING (table_name)
  WHERE poll_rank <= 1000 AND poll_rank <= s.batch_size)"""
)

DRAIN = (
    CURSOR
    + ","
    + cursor_cte(ALL_TABLES)
    + ","
    + sample_stats_cte("events_ct", EV_RAW, "ev_stats")
    + ","
    + sample_stats_cte("documents_ct", DOC_RAW, "doc_stats")
    + ","
    + sizes_cte(ALL_TABLES, "(SELECT * FROM ev_stats UNION ALL SELECT * FROM doc_stats)")
    + """,
keys AS (
  SELECT table_name, start_lsn, seqval, operation FROM events_ct WHERE operation IN (1, 2, 4)
  UNION ALL
  SELECT table_name, start_lsn, seqval, operation FROM documents_ct WHERE operation IN (1, 2, 4)),
drained AS (
  SELECT r.*, (r.seq_rank - 1) // s.batch_size AS batch_no FROM (
    SELECT k.*, rank() OVER (PARTITION BY k.table_name ORDER BY k.start_lsn, k.seqval) AS seq_rank
    FROM keys k JOIN cursor c ON c.table_name = k.table_name
    WHERE """
    + AFTER
    + """) r JOIN sizes s ON s.table_name = r.table_name)"""
)


def W(ctes: str, body: str) -> str:
    return f"WITH {LOGS},{ctes}\n{body}" if ctes else f"WITH {LOGS}\n{body}"


ORACLE: dict[str, str] = {
    "change_scan": W("", f"SELECT {KEYS}, operation, event_id, {TS} AS ts, user_id, value, props FROM events_ct"),
    "op_filter": W("", f"SELECT {KEYS}, operation FROM events_ct WHERE operation IN (1, 2, 4)"),
    "op_decode": W(
        "",
        f"SELECT * FROM (SELECT {KEYS}, operation, {OPTYPE} AS operation_type FROM events_ct) "
        "WHERE operation_type IS NOT NULL",
    ),
    "lsn_hex": W("", f"SELECT {KEYS}, operation FROM documents_ct"),
    "row_data": W(
        "",
        f"SELECT {KEYS}, CAST(doc_id AS VARCHAR) AS doc_id, CAST(n_chars AS VARCHAR) AS n_chars, "
        "source, text FROM documents_ct WHERE operation IN (1, 2, 4)",
    ),
    "change_envelope": W(
        "",
        f"SELECT {KEYS}, operation AS operation_id, {OPTYPE} AS operation_type, "
        f"CAST(to_json({EV_DATA}) AS VARCHAR) AS data_json FROM events_ct WHERE operation IN (1, 2, 4)",
    ),
    "change_json": W("", f"SELECT {change_json(EV_DATA)} AS value FROM events_ct WHERE operation IN (1, 2, 4)"),
    "multi_table_feed": W(
        "",
        f"SELECT {KEYS}, operation, {change_json(EV_DATA)} AS change_json FROM events_ct "
        "WHERE operation IN (1, 2, 4) UNION ALL "
        f"SELECT {KEYS}, operation, {change_json(DOC_DATA)} AS change_json FROM documents_ct "
        "WHERE operation IN (1, 2, 4)",
    ),
    "ordered_feed": W(
        "",
        f"SELECT {KEYS}, rank() OVER (PARTITION BY table_name ORDER BY start_lsn, seqval) AS ord "
        "FROM events_ct WHERE operation IN (1, 2, 4)",
    ),
    "resume_cursor": W(
        CURSOR + "," + cursor_cte(EVENT_TABLES),
        "SELECT table_name, lower(hex(lsn)) AS lsn, lower(hex(seq)) AS seq FROM cursor",
    ),
    "seq_backfill": W(
        CURSOR,
        "SELECT o.table_name, lower(hex(o.last_lsn)) AS last_lsn, "
        "coalesce(lower(hex(b.backfill_seq)), '00000000000000000000') AS last_seq "
        "FROM offsets o LEFT JOIN backfill b ON b.table_name = o.table_name "
        "WHERE o.last_seq IS NULL AND o.last_lsn IS NOT NULL",
    ),
    "null_cursor": W(
        CURSOR + "," + cursor_cte(EVENT_TABLES),
        "SELECT c.table_name, coalesce(n.n_changes, 0) AS n_changes FROM cursor c LEFT JOIN ("
        "  SELECT k.table_name, count(*) AS n_changes FROM pub k JOIN cursor c ON c.table_name = k.table_name"
        f"  WHERE {AFTER} GROUP BY k.table_name) n ON n.table_name = c.table_name",
    ),
    "change_poll": W(POLL, f"SELECT {KEYS}, operation, poll_rank FROM poll"),
    "sample_recent": W(
        "",
        f"SELECT * FROM (SELECT {KEYS}, operation, row_number() OVER (PARTITION BY table_name "
        "ORDER BY start_lsn DESC, seqval DESC, operation DESC) AS sample_rank FROM events_ct) "
        "WHERE sample_rank <= 100",
    ),
    "sample_row_bytes": W(
        "",
        f"SELECT * FROM (SELECT {KEYS}, operation, row_number() OVER (PARTITION BY table_name "
        f"ORDER BY start_lsn DESC, seqval DESC, operation DESC) AS sample_rank, {EV_RAW} AS row_bytes "
        "FROM events_ct) WHERE sample_rank <= 100",
    ),
    "sample_stats": W(
        sample_stats_cte("events_ct", EV_RAW, "ev_stats") + "," + sample_stats_cte("documents_ct", DOC_RAW, "doc_stats"),
        "SELECT * FROM ev_stats UNION ALL SELECT * FROM doc_stats",
    ),
    "batch_size": W(
        sample_stats_cte("events_ct", EV_RAW, "ev_stats")
        + ","
        + sample_stats_cte("documents_ct", DOC_RAW, "doc_stats")
        + ","
        + sizes_cte(ALL_TABLES, "(SELECT * FROM ev_stats UNION ALL SELECT * FROM doc_stats)"),
        "SELECT table_name, batch_size FROM sizes",
    ),
    "batch_size_default": W(
        sample_stats_cte("events_ct", EV_RAW, "ev_stats")
        + ","
        + sample_stats_cte("documents_ct", DOC_RAW, "doc_stats")
        + ","
        + sizes_cte(ALL_TABLES[:-1] + ", 'refunds']", "(SELECT * FROM ev_stats UNION ALL SELECT * FROM doc_stats)"),
        "SELECT table_name, batch_size, sample_rows FROM sizes",
    ),
    "batch_metrics": W(
        sample_stats_cte("events_ct", EV_RAW, "ev_stats")
        + ","
        + sample_stats_cte("documents_ct", DOC_RAW, "doc_stats")
        + ","
        + sizes_cte(ALL_TABLES, "(SELECT * FROM ev_stats UNION ALL SELECT * FROM doc_stats)"),
        "SELECT table_name, batch_size AS current_batch_size, '2024-06-01 12:00:00' AS last_sample_time, "
        "CAST(sample_rows AS INTEGER) AS last_sample_size, CAST(trunc(avg_row_bytes) AS INTEGER) AS avg_row_size, "
        "262144 AS max_message_size, CAST(0.2 AS DOUBLE) AS buffer_factor FROM sizes",
    ),
    "drain_batches": W(DRAIN, f"SELECT {KEYS}, seq_rank, batch_no FROM drained"),
    "batch_counts": W(
        DRAIN, "SELECT table_name, batch_no, count(*) AS n_changes FROM drained GROUP BY table_name, batch_no"
    ),
    "batch_high_water": W(
        DRAIN,
        "SELECT table_name, batch_no, lower(hex(start_lsn)) AS lsn, lower(hex(seqval)) AS seq FROM ("
        "  SELECT *, row_number() OVER (PARTITION BY table_name, batch_no "
        "                               ORDER BY start_lsn DESC, seqval DESC) AS rn FROM drained) "
        "WHERE rn = 1",
    ),
    "offsets_upgrade": W(
        CURSOR,
        "SELECT table_name, lower(hex(last_lsn)) AS last_lsn, CAST(NULL AS VARCHAR) AS last_seq, "
        "strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM offsets",
    ),
    "offsets_merge": W(
        POLL
        + """,
hw AS (
  SELECT table_name, start_lsn, seqval FROM (
    SELECT table_name, start_lsn, seqval,
           row_number() OVER (PARTITION BY table_name ORDER BY start_lsn DESC, seqval DESC) AS rn
    FROM poll) WHERE rn = 1),
merged AS (
  SELECT table_name, start_lsn AS last_lsn, seqval AS last_seq,
         TIMESTAMP '2024-06-02 08:30:00' AS updated_at FROM hw
  UNION ALL
  SELECT table_name, last_lsn, last_seq, updated_at FROM offsets
  WHERE table_name NOT IN (SELECT table_name FROM hw))""",
        "SELECT table_name, lower(hex(last_lsn)) AS last_lsn, lower(hex(last_seq)) AS last_seq, "
        "strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM merged",
    ),
    "change_event": W(
        "",
        f"SELECT {KEYS}, lower({OPTYPE}) AS change_type, "
        f"CAST(to_json({event(EV_DATA, TS)}) AS VARCHAR) AS event_json "
        "FROM events_ct WHERE operation IN (1, 2, 4)",
    ),
    "lsn_display": W("", f"SELECT DISTINCT table_name, lower(hex(start_lsn)) AS lsn, {DISPLAY} AS lsn_display FROM events_ct"),
    "batch_envelope": W(
        sample_stats_cte("documents_ct", DOC_RAW, "doc_stats")
        + ","
        + sizes_cte("['de', 'en', 'es', 'fr']", "doc_stats")
        + """,
b AS (
  SELECT r.*, (r.rk - 1) // s.batch_size AS batch_no FROM (
    SELECT *, rank() OVER (PARTITION BY table_name ORDER BY start_lsn, seqval) AS rk
    FROM documents_ct WHERE operation IN (1, 2, 4)) r JOIN sizes s ON s.table_name = r.table_name)""",
        "SELECT table_name, batch_no, count(*) AS n_changes, CAST(to_json({"
        "'table_name': table_name, 'server_name': 'localhost', "
        f"'changes': list({event(DOC_DATA, 'CAST(NULL AS VARCHAR)')} ORDER BY start_lsn, seqval), "
        "'metadata': {'batch_size': count(*), 'poll_interval': '5s'}}) AS VARCHAR) AS envelope_json "
        "FROM b GROUP BY table_name, batch_no",
    ),
    "lsn_range": W(
        """
last AS (SELECT max(event_id // 4 + 1) AS m FROM events)""",
        f"SELECT {KEYS}, operation FROM events_ct, last WHERE operation IN (1, 2, 4) AND start_lsn "
        "BETWEEN unhex(lpad(hex(m // 10), 20, '0')) AND unhex(lpad(hex(m // 2), 20, '0'))",
    ),
    "feed_catalog": W(
        "",
        "SELECT table_name, lower(hex(min(start_lsn))) AS min_lsn, lower(hex(max(start_lsn))) AS max_lsn, "
        "count(*) AS n_changes FROM events_ct GROUP BY table_name UNION ALL "
        "SELECT table_name, lower(hex(min(start_lsn))), lower(hex(max(start_lsn))), count(*) "
        "FROM documents_ct GROUP BY table_name",
    ),
}
# An envelope's room: the budget less what stands around its changes (a count of 19 digits).
HEAD = "CAST(to_json({'table_name': table_name, 'server_name': 'localhost'}) AS VARCHAR)"
ORACLE["envelope_by_bytes"] = W(
    f"""
ev AS (
  SELECT table_name, start_lsn, seqval, operation,
         CAST(to_json({event(DOC_DATA, 'CAST(NULL AS VARCHAR)')}) AS VARCHAR) AS event_json
  FROM documents_ct WHERE operation IN (1, 2, 4)),
sums AS (
  SELECT *, CAST(sum(strlen(event_json) + 1) OVER w AS BIGINT) AS upto FROM ev
  WINDOW w AS (PARTITION BY table_name ORDER BY start_lsn, seqval, operation ROWS UNBOUNDED PRECEDING)),
rooms AS (
  SELECT DISTINCT table_name, 262144 - (strlen({HEAD}) - 1 + strlen(',"changes":[') +
    strlen('],"metadata":{{"batch_size":1000000000000000000,"poll_interval":"5s"}}}}')) AS room
  FROM ev),
ends AS (SELECT table_name, upto FROM sums),
cuts(table_name, envelope_no, begin_at, end_at) AS (
  SELECT table_name, CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM rooms
  UNION ALL
  SELECT c.table_name, c.envelope_no + 1, c.end_at,
         greatest(min(e.upto), coalesce(max(CASE WHEN e.upto <= c.end_at + r.room THEN e.upto END), 0))
  FROM cuts c JOIN rooms r ON r.table_name = c.table_name
              JOIN ends e ON e.table_name = c.table_name AND e.upto > c.end_at
  GROUP BY c.table_name, c.envelope_no, c.end_at),
joined AS (
  SELECT c.table_name, c.envelope_no, count(*) AS n_changes,
         concat(substr({HEAD.replace('table_name}', 'c.table_name}').replace(': table_name', ': c.table_name')}, 1,
                       length({HEAD.replace(': table_name', ': c.table_name')}) - 1), ',"changes":[',
                string_agg(s.event_json, ',' ORDER BY s.start_lsn, s.seqval, s.operation),
                '],"metadata":{{"batch_size":', count(*), ',"poll_interval":"5s"}}}}') AS envelope_json
  FROM cuts c JOIN sums s ON s.table_name = c.table_name AND s.upto > c.begin_at AND s.upto <= c.end_at
  GROUP BY c.table_name, c.envelope_no)""",
    "SELECT table_name, envelope_no, n_changes, CAST(strlen(envelope_json) AS INTEGER) AS envelope_bytes, envelope_json FROM joined",
).replace("WITH ", "WITH RECURSIVE ", 1)
ORACLE["schema_epochs"] = W(
    """
lasts AS (SELECT lang AS table_name, max(doc_id // 3 + 1) AS m FROM documents GROUP BY lang),
placed AS (
  SELECT d.*, CASE WHEN doc_id // 3 + 1 > 2 * m // 3 THEN 3 WHEN doc_id // 3 + 1 > m // 3 THEN 2 ELSE 1 END AS epoch
  FROM documents_ct d JOIN lasts l ON l.table_name = d.table_name WHERE operation IN (1, 2, 4))""",
    f"SELECT {KEYS}, operation, epoch, CASE epoch "
    "WHEN 1 THEN CAST(to_json({'doc_id': CAST(doc_id AS VARCHAR), 'source': source, 'text': text}) AS VARCHAR) "
    f"WHEN 2 THEN CAST(to_json({DOC_DATA}) AS VARCHAR) "
    "ELSE CAST(to_json({'doc_id': CAST(doc_id AS VARCHAR), 'n_chars': CAST(CAST(n_chars AS DECIMAL(12, 2)) AS VARCHAR), "
    "'text': text}) AS VARCHAR) END AS data_json FROM placed",
)
UPDATED = """
updated AS (
  SELECT lang AS table_name, unhex(lpad(hex(doc_id // 3 + 1), 20, '0')) AS start_lsn,
         unhex(lpad(hex(doc_id + 1), 20, '0')) AS seqval, operation, doc_id, text,
         CASE WHEN operation <> 3 OR doc_id % 5 <> 0 THEN source END AS source,
         CASE WHEN operation = 3 AND doc_id % 3 = 0 THEN n_chars - 1 ELSE n_chars END AS n_chars
  FROM (SELECT *, unnest(CASE WHEN doc_id % 16 = 5 THEN [4] WHEN doc_id % 16 = 9 THEN [3]
                              WHEN doc_id % 4 = 1 THEN [3, 4] ELSE [2] END) AS operation FROM documents))"""
ORACLE["all_update_old"] = W(UPDATED, f"SELECT {KEYS}, operation, doc_id, source, n_chars FROM updated WHERE operation IN (1, 2, 3, 4)")
ORACLE["update_pairs"] = W(
    UPDATED
    + f""",
images AS (SELECT table_name, start_lsn, seqval, operation, doc_id, source, n_chars, text,
                  CAST(to_json({DOC_DATA}) AS VARCHAR) AS image FROM updated WHERE operation IN (3, 4)),
pairs AS (
  SELECT coalesce(b.table_name, a.table_name) AS table_name, coalesce(b.start_lsn, a.start_lsn) AS start_lsn,
         coalesce(b.seqval, a.seqval) AS seqval, b.image AS before, a.image AS after,
         CASE WHEN b.image IS NULL THEN 'after' WHEN a.image IS NULL THEN 'before' ELSE 'pair' END AS images,
         CASE WHEN b.image IS NOT NULL AND a.image IS NOT NULL THEN array_to_string(list_filter([
           CASE WHEN b.doc_id IS DISTINCT FROM a.doc_id THEN 'doc_id' END,
           CASE WHEN b.n_chars IS DISTINCT FROM a.n_chars THEN 'n_chars' END,
           CASE WHEN b.source IS DISTINCT FROM a.source THEN 'source' END,
           CASE WHEN b.text IS DISTINCT FROM a.text THEN 'text' END], lambda x: x IS NOT NULL), ',') END AS changed
  FROM (SELECT * FROM images WHERE operation = 3) b FULL JOIN (SELECT * FROM images WHERE operation = 4) a
    ON b.table_name = a.table_name AND b.start_lsn = a.start_lsn AND b.seqval = a.seqval)""",
    f"SELECT {KEYS}, images, changed, before, after FROM pairs",
)
# The number of ranges never changes a result.
ORACLE["ordered_feed_bucketed"] = ORACLE["ordered_feed"]
ORACLE["drain_batches_bucketed"] = ORACLE["drain_batches"]

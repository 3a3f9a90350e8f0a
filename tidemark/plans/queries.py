"""Registered queries: one per operator of the change feed.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over change logs that
Spark derives from the whole ``events`` / ``documents`` tables.  Binary cursor
values are returned as lowercase hex and timestamps as strings so results
compare across engines.  The DuckDB twin of every query is in
``tidemark.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.decode import lsn_display, lsn_hex, stringify, to_json_keep_nulls
from tidemark.operators.batching import (
    batch_size_values,
    batch_totals,
    batch_metrics,
    drain_batches,
    sample_recent,
    sample_row_bytes,
    sample_stats,
    table_batch_sizes,
    table_high_water,
)
from tidemark.operators.common import run_concurrently
from tidemark.operators.cursor import (
    changes_after,
    changes_between,
    cursor_frame,
    load_cursors,
    op_filter,
    poll,
    resume_cursor,
    seq_backfill,
)
from tidemark.operators.epochs import epoch_data_json
from tidemark.operators.images import all_changes, update_json, update_pairs
from tidemark.operators.offsets import merge_offsets, upgrade_offsets
from tidemark.operators.ordering import ranked_keys, sequence_rank
from tidemark.plans.feed import batch_envelopes, byte_envelopes, change_events, decoded_changes, multi_table_changes, uniform_changes
from tidemark.schema import OPERATION, SEQVAL, START_LSN, TABLE_NAME
from tidemark.sources.changelog import scan_changes
from tidemark.sources.fixtures import (
    DOCUMENT_TABLES,
    EVENT_TABLES,
    FIXTURE_TIME,
    documents_ct,
    documents_schema_history,
    events_ct,
    offsets_fixture,
    updated_documents_ct,
)

# Fixed parameters of the registered queries.
SERVER_NAME = "localhost"
POLL_INTERVAL = "5s"
MERGE_TIME = "2024-06-02 08:30:00"
RANGE_FROM, RANGE_TO = 10, 2       # lsn_range: from a tenth to half of the log's largest LSN
BUCKETS = 13                       # ranges of the *_bucketed queries; the others follow the session
MISSING_TABLE = "refunds"          # configured, but absent from every log

ALL_TABLES = EVENT_TABLES + DOCUMENT_TABLES


def _keys(df: DataFrame) -> list:
    return [TABLE_NAME, lsn_hex(START_LSN).alias("lsn"), lsn_hex(SEQVAL).alias("seq")]


def _ts(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


# --- scans, filters, projections -------------------------------------------------

def q_change_scan(spark: SparkSession, sf: str) -> DataFrame:
    log = scan_changes(events_ct(spark, sf))
    return log.select(
        *_keys(log), F.col(OPERATION).alias("operation"),
        "event_id", stringify("ts", log.schema["ts"].dataType).alias("ts"), "user_id", "value", "props",
    )


def q_op_filter(spark, sf):
    log = op_filter(events_ct(spark, sf))
    return log.select(*_keys(log), F.col(OPERATION).alias("operation"))


def q_op_decode(spark, sf):
    d = decoded_changes(events_ct(spark, sf), ops=None)
    return d.select(*_keys(d), F.col(OPERATION).alias("operation"), "operation_type")


def q_lsn_hex(spark, sf):
    log = documents_ct(spark, sf)
    return log.select(*_keys(log), F.col(OPERATION).alias("operation"))


def q_row_data(spark, sf):
    d = decoded_changes(documents_ct(spark, sf))
    return d.select(*_keys(d), "data.doc_id", "data.n_chars", "data.source", "data.text")


def q_change_envelope(spark, sf):
    d = decoded_changes(events_ct(spark, sf))
    return d.select(
        *_keys(d),
        F.col(OPERATION).alias("operation_id"),
        "operation_type",
        to_json_keep_nulls("data").alias("data_json"),
    )


def q_change_json(spark, sf):
    d = uniform_changes(decoded_changes(events_ct(spark, sf)))
    return d.select(F.col("change_json").alias("value"))


def q_multi_table_feed(spark, sf):
    u = multi_table_changes([events_ct(spark, sf), documents_ct(spark, sf)], ALL_TABLES)
    return u.select(*_keys(u), F.col(OPERATION).alias("operation"), "change_json")


def q_ordered_feed(spark, sf):
    r = sequence_rank(op_filter(events_ct(spark, sf)), "ord")
    return r.select(*_keys(r), "ord")


def q_ordered_feed_bucketed(spark, sf):
    r = sequence_rank(op_filter(events_ct(spark, sf)), "ord", buckets=BUCKETS)
    return r.select(*_keys(r), "ord")


def q_lsn_display(spark, sf):
    log = events_ct(spark, sf)
    return log.select(TABLE_NAME, lsn_hex(START_LSN).alias("lsn"), lsn_display(START_LSN).alias("lsn_display")).distinct()


def q_change_event(spark, sf):
    d = decoded_changes(events_ct(spark, sf), timestamp_col="ts")
    return change_events(d)


def q_lsn_range(spark, sf):
    log = events_ct(spark, sf)
    last = int.from_bytes(log.agg(F.max(START_LSN)).first()[0] or b"", "big")
    r = changes_between(log, (last // RANGE_FROM).to_bytes(10, "big"), (last // RANGE_TO).to_bytes(10, "big"))
    return r.select(*_keys(r), F.col(OPERATION).alias("operation"))


def q_feed_catalog(spark, sf):
    out = None
    for log in (events_ct(spark, sf), documents_ct(spark, sf)):
        c = log.groupBy(TABLE_NAME).agg(
            lsn_hex(F.min(START_LSN)).alias("min_lsn"),
            lsn_hex(F.max(START_LSN)).alias("max_lsn"),
            F.count(F.lit(1)).alias("n_changes"),
        )
        out = c if out is None else out.unionByName(c)
    return out


# --- cursor ---------------------------------------------------------------------

def _cursor(spark, sf):
    log = events_ct(spark, sf)
    offs = offsets_fixture(log)
    return log, offs, resume_cursor(spark, EVENT_TABLES, offs, log)


def q_resume_cursor(spark, sf):
    _, _, cur = _cursor(spark, sf)
    return cur.select(TABLE_NAME, lsn_hex("lsn").alias("lsn"), lsn_hex("seq").alias("seq"))


def q_seq_backfill(spark, sf):
    log = events_ct(spark, sf)
    offs = offsets_fixture(log)
    b = seq_backfill(log, offs, EVENT_TABLES)
    need = offs.where(F.col("last_seq").isNull() & F.col("last_lsn").isNotNull())
    j = need.join(b, TABLE_NAME, "left")
    return j.select(
        TABLE_NAME,
        lsn_hex("last_lsn").alias("last_lsn"),
        F.coalesce(lsn_hex("backfill_seq"), F.lit("0" * 20)).alias("last_seq"),
    )


def q_null_cursor(spark, sf):
    """Changes after every cursor; the table whose stored LSN is NULL reads none."""
    log = events_ct(spark, sf)
    cur = load_cursors(spark, EVENT_TABLES, offsets_fixture(log), log)
    n = changes_after(log, cur, len(cur)).groupBy(TABLE_NAME).agg(F.count(F.lit(1)).alias("n_changes"))
    return cursor_frame(spark, cur).select(TABLE_NAME).join(n, TABLE_NAME, "left").select(
        TABLE_NAME, F.coalesce("n_changes", F.lit(0)).alias("n_changes")
    )


def _poll(spark, sf):
    log = events_ct(spark, sf)
    offs = offsets_fixture(log)
    cur, sizes = run_concurrently(
        lambda: load_cursors(spark, EVENT_TABLES, offs, log),
        lambda: batch_size_values(table_batch_sizes(spark, EVENT_TABLES, log), len(EVENT_TABLES)),
    )
    return log, offs, poll(log, cur, sizes, len(EVENT_TABLES))


def q_change_poll(spark, sf):
    _, _, p = _poll(spark, sf)
    return p.select(*_keys(p), F.col(OPERATION).alias("operation"), "poll_rank")


# --- batch sizing -----------------------------------------------------------------

def q_sample_recent(spark, sf):
    s = sample_recent(events_ct(spark, sf), table_bound=len(EVENT_TABLES))
    return s.select(*_keys(s), F.col(OPERATION).alias("operation"), "sample_rank")


def q_sample_row_bytes(spark, sf):
    b = sample_row_bytes(sample_recent(events_ct(spark, sf), table_bound=len(EVENT_TABLES)))
    return b.select(*_keys(b), F.col(OPERATION).alias("operation"), "sample_rank", "row_bytes")


def q_sample_stats(spark, sf):
    out = None
    for log, n in ((events_ct(spark, sf), len(EVENT_TABLES)), (documents_ct(spark, sf), len(DOCUMENT_TABLES))):
        s = sample_stats(sample_row_bytes(sample_recent(log, table_bound=n)))
        out = s if out is None else out.unionByName(s)
    return out


def _sizes(spark, sf, tables=ALL_TABLES):
    return table_batch_sizes(spark, tables, [events_ct(spark, sf), documents_ct(spark, sf)])


def q_batch_size(spark, sf):
    return _sizes(spark, sf).select(TABLE_NAME, "batch_size")


def q_batch_size_default(spark, sf):
    return _sizes(spark, sf, ALL_TABLES + (MISSING_TABLE,)).select(TABLE_NAME, "batch_size", "sample_rows")


def q_batch_metrics(spark, sf):
    m = batch_metrics(_sizes(spark, sf), FIXTURE_TIME)
    return m.withColumn("last_sample_time", _ts("last_sample_time"))


# --- draining a backlog ---------------------------------------------------------------

def _backlog(spark, sf):
    """Keys after every table's cursor, and the tables' batch sizes."""
    ev, docs = events_ct(spark, sf), documents_ct(spark, sf)
    offs = offsets_fixture(ev)
    logs = [ev, docs]
    keys = logs[0].select(TABLE_NAME, START_LSN, SEQVAL, OPERATION).unionByName(
        logs[1].select(TABLE_NAME, START_LSN, SEQVAL, OPERATION)
    )
    cur, sizes = run_concurrently(
        lambda: load_cursors(spark, ALL_TABLES, offs, keys),
        lambda: batch_size_values(table_batch_sizes(spark, ALL_TABLES, logs), len(ALL_TABLES)),
    )
    return changes_after(keys, cur, len(ALL_TABLES)), sizes


def _drain(spark, sf, buckets=None):
    after, sizes = _backlog(spark, sf)
    return drain_batches(after, sizes, len(ALL_TABLES), buckets)


def _totals(spark, sf):
    after, sizes = _backlog(spark, sf)
    return batch_totals(ranked_keys(after), sizes, len(ALL_TABLES))


def q_drain_batches(spark, sf):
    d = _drain(spark, sf)
    return d.select(*_keys(d), "seq_rank", "batch_no")


def q_drain_batches_bucketed(spark, sf):
    d = _drain(spark, sf, BUCKETS)
    return d.select(*_keys(d), "seq_rank", "batch_no")


def q_batch_counts(spark, sf):
    return _totals(spark, sf).select(TABLE_NAME, "batch_no", "n_changes")


def q_batch_high_water(spark, sf):
    return _totals(spark, sf).select(TABLE_NAME, "batch_no", lsn_hex("lsn").alias("lsn"), lsn_hex("seq").alias("seq"))


def q_batch_envelope(spark, sf):
    docs = documents_ct(spark, sf)
    sizes = batch_size_values(table_batch_sizes(spark, DOCUMENT_TABLES, docs), len(DOCUMENT_TABLES))
    d = decoded_changes(docs)
    b = drain_batches(d, sizes, len(DOCUMENT_TABLES), envelope_parts=True)
    return batch_envelopes(b, SERVER_NAME, POLL_INTERVAL)


def q_envelope_by_bytes(spark, sf):
    """Envelopes of at most the standard message budget, by greedy cuts."""
    return byte_envelopes(decoded_changes(documents_ct(spark, sf)), SERVER_NAME, POLL_INTERVAL)


# --- schema changes and images -----------------------------------------------------------

def q_schema_epochs(spark, sf):
    """Every published change with the columns its table had at that time."""
    log = documents_ct(spark, sf)
    e = epoch_data_json(op_filter(log), documents_schema_history(log))
    return e.select(*_keys(e), F.col(OPERATION).alias("operation"), "epoch", "data_json")


def q_update_pairs(spark, sf):
    """Before- and after-image of every update, and the columns that differ."""
    p = update_json(update_pairs(updated_documents_ct(spark, sf)))
    return p.select(*_keys(p), "images", F.array_join("changed", ",").alias("changed"), "before", "after")


def q_all_update_old(spark, sf):
    """Rows of the change function with both images of every update."""
    log = updated_documents_ct(spark, sf)
    rows = all_changes(log, bytes(10), b"\xff" * 10, "all update old")
    return rows.select(*_keys(rows), F.col(OPERATION).alias("operation"), "doc_id", "source", "n_chars")


# --- offsets ---------------------------------------------------------------------------

def _offsets_out(o: DataFrame) -> DataFrame:
    return o.select(
        TABLE_NAME,
        lsn_hex("last_lsn").alias("last_lsn"),
        lsn_hex("last_seq").alias("last_seq"),
        _ts("updated_at").alias("updated_at"),
    )


def q_offsets_upgrade(spark, sf):
    old = offsets_fixture(events_ct(spark, sf)).drop("last_seq")
    return _offsets_out(upgrade_offsets(old))


def q_offsets_merge(spark, sf):
    _, offs, p = _poll(spark, sf)
    merged = merge_offsets(offs, table_high_water(p), F.lit(MERGE_TIME).cast("timestamp_ntz"))
    return _offsets_out(merged)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "change_scan": q_change_scan,
    "op_filter": q_op_filter,
    "op_decode": q_op_decode,
    "lsn_hex": q_lsn_hex,
    "row_data": q_row_data,
    "change_envelope": q_change_envelope,
    "change_json": q_change_json,
    "multi_table_feed": q_multi_table_feed,
    "ordered_feed": q_ordered_feed,
    "ordered_feed_bucketed": q_ordered_feed_bucketed,
    "resume_cursor": q_resume_cursor,
    "seq_backfill": q_seq_backfill,
    "null_cursor": q_null_cursor,
    "change_poll": q_change_poll,
    "sample_recent": q_sample_recent,
    "sample_row_bytes": q_sample_row_bytes,
    "sample_stats": q_sample_stats,
    "batch_size": q_batch_size,
    "batch_size_default": q_batch_size_default,
    "batch_metrics": q_batch_metrics,
    "drain_batches": q_drain_batches,
    "drain_batches_bucketed": q_drain_batches_bucketed,
    "batch_counts": q_batch_counts,
    "batch_high_water": q_batch_high_water,
    "offsets_upgrade": q_offsets_upgrade,
    "offsets_merge": q_offsets_merge,
    "change_event": q_change_event,
    "lsn_display": q_lsn_display,
    "batch_envelope": q_batch_envelope,
    "lsn_range": q_lsn_range,
    "feed_catalog": q_feed_catalog,
    "envelope_by_bytes": q_envelope_by_bytes,
    "schema_epochs": q_schema_epochs,
    "update_pairs": q_update_pairs,
    "all_update_old": q_all_update_old,
}

"""Change records: decode, envelope, JSON, flat events and batch envelopes.

Each change log is decoded with its own schema, so a change's ``data`` holds
exactly the columns of its table (NULLs included).  Logs with different
columns are then unioned in a uniform shape
``(table_name, __$start_lsn, __$seqval, __$operation, change_json)``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.decode import (
    data_struct,
    lsn_display,
    lsn_hex,
    metadata_struct,
    operation_type,
    stringify,
    to_json_keep_nulls,
)
from tidemark.operators.cursor import op_filter
from tidemark.operators.messages import BLOCK_MESSAGES, KEY, byte_cuts
from tidemark.schema import OPERATION, PUBLISHED_OPS, SEQVAL, STANDARD_MESSAGE_BYTES, START_LSN, TABLE_NAME, q, source_columns


def decoded_changes(
    log: DataFrame,
    ops: Iterable[int] | None = PUBLISHED_OPS,
    timestamp_col: str | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Filter operation codes, decode them and build the ``data`` struct.

    ``ops=None`` keeps every code; rows whose code does not decode are dropped
    either way.  Output: ``table_name``, system columns, ``operation_type``,
    ``data`` (struct of strings, keys sorted) and ``commit_time`` (ISO string of
    ``timestamp_col``, or NULL).  Columns named in ``keep`` are carried along and
    stay out of ``data``.
    """
    keep = list(keep)
    cols = [c for c in source_columns(log) if c not in keep]
    src = op_filter(log, ops) if ops is not None else log
    types = {f.name: f.dataType for f in log.schema.fields}
    ts = stringify(timestamp_col, types[timestamp_col]) if timestamp_col else F.lit(None).cast("string")
    out = src.select(
        TABLE_NAME,
        START_LSN,
        SEQVAL,
        OPERATION,
        operation_type(OPERATION).alias("operation_type"),
        data_struct(log, cols).alias("data"),
        ts.alias("commit_time"),
        *[F.col(q(c)) for c in keep],
    )
    return out.where(F.col("operation_type").isNotNull())


def change_record(decoded: DataFrame):
    """``{data, metadata}`` struct of a decoded change (keys sorted)."""
    return F.struct(F.col("data"), metadata_struct().alias("metadata"))


def with_change_json(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn("change_json", to_json_keep_nulls(change_record(decoded)))


def uniform_changes(decoded: DataFrame) -> DataFrame:
    """Schema-independent shape of decoded changes, safe to union across logs."""
    return with_change_json(decoded).select(TABLE_NAME, START_LSN, SEQVAL, OPERATION, "change_json")


def multi_table_changes(
    logs: list[DataFrame],
    tables: Iterable[str] | None = None,
) -> DataFrame:
    """Decode every log with its own columns, then union the uniform results."""
    out = None
    for lg in logs:
        if tables is not None:
            lg = lg.where(F.col(TABLE_NAME).isin(sorted(set(tables))))
        u = uniform_changes(decoded_changes(lg))
        out = u if out is None else out.unionByName(u)
    return out


def change_event_struct():
    """Flat event: table, lowercase change type, data, timestamp, LSN in display form."""
    return F.struct(
        F.col(TABLE_NAME).alias("table_name"),
        F.lower(F.col("operation_type")).alias("change_type"),
        F.col("data"),
        F.col("commit_time").alias("timestamp"),
        lsn_display(START_LSN).alias("lsn"),
    )


def change_events(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        TABLE_NAME,
        lsn_hex(START_LSN).alias("lsn"),
        lsn_hex(SEQVAL).alias("seq"),
        F.lower(F.col("operation_type")).alias("change_type"),
        to_json_keep_nulls(change_event_struct()).alias("event_json"),
    )


def _envelope_ends(server_name: str, poll_interval: str):
    """JSON before and behind the changes of an envelope; the latter takes the number of changes."""
    before = to_json_keep_nulls(F.struct(F.col(TABLE_NAME).alias("table_name"), F.lit(server_name).alias("server_name")))
    before = F.concat(F.expr("left(_b, length(_b) - 1)"), F.lit(',"changes":[')), before
    behind = lambda n: F.concat(
        F.lit('],"metadata":{"batch_size":'), n.cast("string"), F.lit(',"poll_interval":' + json.dumps(poll_interval, ensure_ascii=False) + "}}")
    )
    return before, behind


def byte_envelopes(
    decoded: DataFrame, server_name: str, poll_interval: str, max_bytes: int = STANDARD_MESSAGE_BYTES, ranges: int | None = None, block_messages: int = BLOCK_MESSAGES
) -> DataFrame:
    """Envelopes of at most ``max_bytes`` bytes each, by greedy cuts in the order of every table's changes.

    Columns ``table_name``, ``envelope_no``, ``n_changes``, ``envelope_bytes`` and
    ``envelope_json``.  Only an envelope that holds one change may be larger.  The room
    for changes counts a comma for each and 19 digits for their number.  Copies of one
    change (same key, code and content) are one change.  Changes of one key are in the
    order of their code, then their content's digest.
    """
    (head, head_json), behind = _envelope_ends(server_name, poll_interval)
    digit = F.lit(10**18).cast("long")
    taken = F.octet_length(head) + F.octet_length(behind(digit))
    ev = decoded.select(TABLE_NAME, START_LSN, SEQVAL, OPERATION, to_json_keep_nulls(change_event_struct()).alias("event_json"))
    ev = ev.withColumn("digest", F.md5("event_json"))
    narrow = ev.groupBy(*KEY).agg(F.max(F.octet_length("event_json") + 1).cast("long").alias("bytes"))
    roomy = narrow.withColumn("_b", head_json).withColumn("_room", F.greatest(F.lit(1), F.lit(int(max_bytes)) - taken)).drop("_b")
    cuts = byte_cuts(roomy.select(*KEY, "bytes", "_room"), F.col("_room"), ranges, block_messages)
    c = cuts.select(*[F.col(k).alias(f"_c{k}") for k in KEY], "envelope_no")
    cond = None
    for k in KEY:
        e = F.col(k).eqNullSafe(F.col(f"_c{k}"))
        cond = e if cond is None else cond & e
    once = ev.groupBy(*KEY).agg(F.min("event_json").alias("event_json"))
    placed = once.join(c, cond).select(TABLE_NAME, "envelope_no", F.struct(START_LSN, SEQVAL, OPERATION, "digest", "event_json").alias("_e"))
    g = placed.groupBy(TABLE_NAME, "envelope_no").agg(F.array_sort(F.collect_list("_e")).alias("_es"), F.count(F.lit(1)).alias("n_changes"))
    body = F.array_join(F.transform("_es", lambda e: e["event_json"]), ",")
    out = g.withColumn("_b", head_json).withColumn("envelope_json", F.concat(head, body, behind(F.col("n_changes"))))
    return out.select(TABLE_NAME, "envelope_no", "n_changes", F.octet_length("envelope_json").alias("envelope_bytes"), "envelope_json")


def batch_envelopes(
    batched: DataFrame, server_name: str, poll_interval: str, with_high_water: bool = False
) -> DataFrame:
    """One envelope per ``(table_name, batch_no)``: the batch's events in order.

    ``batched`` is a decoded frame with ``batch_no``.  A batch holds at most
    ``batch_size`` changes plus ties; with ``envelope_part`` (from
    ``drain_batches(..., envelope_parts=True)``) no envelope holds more than
    ``batch_size`` changes.
    """
    keys = [TABLE_NAME, "batch_no"] + (["envelope_part"] if "envelope_part" in batched.columns else [])
    per = batched.select(
        *keys,
        F.struct(F.col(START_LSN).alias("k1"), F.col(SEQVAL).alias("k2"), change_event_struct().alias("ev")).alias("_e"),
    )
    aggs = [F.array_sort(F.collect_list("_e")).alias("_evs"), F.count(F.lit(1)).alias("n_changes")]
    if with_high_water:
        aggs.append(F.max(F.struct(F.col("_e.k1").alias("k1"), F.col("_e.k2").alias("k2"))).alias("_hw"))
    g = per.groupBy(*keys).agg(*aggs)
    env = F.struct(
        F.col(TABLE_NAME).alias("table_name"),
        F.lit(server_name).alias("server_name"),
        F.transform("_evs", lambda e: e["ev"]).alias("changes"),
        F.struct(F.col("n_changes").alias("batch_size"), F.lit(poll_interval).alias("poll_interval")).alias("metadata"),
    )
    out = [TABLE_NAME, "batch_no", "n_changes", to_json_keep_nulls(env).alias("envelope_json")]
    if with_high_water:
        # the last change of the envelope, for saving offsets after publishing it
        out += [F.col("_hw.k1").alias(START_LSN), F.col("_hw.k2").alias(SEQVAL)]
    return g.select(*out)

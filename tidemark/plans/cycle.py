"""One feed cycle for many tables: resume, read, publish, then save offsets.

Delivery is at-least-once, as in a poll loop: the batch is published first and
the offsets are saved only after the publisher acknowledges it.  If publishing
fails, the offsets stay where they were and the next cycle reads the same
changes again.  Each published change carries ``(table, LSN, Seq,
OperationID)`` so a consumer can drop repeats.

What a cycle publishes is fixed before it starts: the polled keys (or, in a
drain, every table's last key) are control values, so new files in the log do
not change it, and the publisher reads the changes straight from the log.  Only
narrow keys are checkpointed (in the session's shared ``spark.checkpoint.dir``).
The same table may be in several logs: their keys are ranked together.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.decode import lsn_hex
from tidemark.operators.batching import BatchSizer, batch_size_values, drain_batches, table_batch_sizes
from tidemark.operators.common import collect_bounded, default_parallelism, run_concurrently, table_count
from tidemark.operators.cursor import changes_after, last_lsns, load_cursors, poll_keys, polled_changes, up_to
from tidemark.operators.histogram import END, PollBounds
from tidemark.operators.offsets import OffsetStore, merge_offsets
from tidemark.operators.ordering import ranked_keys
from tidemark.plans.feed import batch_envelopes, decoded_changes, with_change_json
from tidemark.schema import (
    DEFAULT_BUFFER_FACTOR,
    DEFAULT_SAMPLE_SIZE,
    OPERATION,
    SEQVAL,
    STANDARD_MESSAGE_BYTES,
    START_LSN,
    TABLE_NAME,
)
from tidemark.session import checkpoint_dir
from tidemark.sources.commit_sink import CommittedFeed

Publisher = Callable[[DataFrame, int], bool]
log = logging.getLogger(__name__)


@dataclass
class CycleResult:
    published: bool
    rows: int
    offsets_version: int | None
    error: Exception | None = None


@dataclass
class Cycle:
    """What one cycle publishes: the rows, their number, and the cursor after them (one row per table)."""

    batch: DataFrame
    rows: int
    high_water: DataFrame


def _keys(logs: list[DataFrame]) -> DataFrame:
    out = None
    for lg in logs:
        k = lg.select(TABLE_NAME, START_LSN, SEQVAL, OPERATION)
        out = k if out is None else out.unionByName(k)
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _not_after(ends: dict[str, tuple[bytes, bytes]]) -> Column:
    """``(lsn, seq)`` not above the table's end, from driver-side values (one per configured table)."""
    kv = []
    for t, (lsn, seq) in sorted(ends.items()):
        kv += [F.lit(t), F.struct(F.lit(bytearray(lsn)).alias("l"), F.lit(bytearray(seq)).alias("s"))]
    if not kv:
        return F.lit(False)
    return F.struct(F.col(START_LSN).alias("l"), F.col(SEQVAL).alias("s")) <= F.element_at(F.create_map(*kv), F.col(TABLE_NAME))


def plan_cycle(
    spark: SparkSession,
    logs: list[DataFrame],
    tables: Iterable[str],
    offsets: DataFrame,
    mode: str = "poll",
    sample_size: int = DEFAULT_SAMPLE_SIZE,
    max_message_bytes: int = STANDARD_MESSAGE_BYTES,
    buffer_factor: float = DEFAULT_BUFFER_FACTOR,
    buckets: int | None = None,
    sizer: BatchSizer | None = None,
    now: _dt.datetime | None = None,
    envelopes: bool = False,
    server_name: str = "localhost",
    poll_interval: str = "5s",
    poll_bounds: PollBounds | None = None,
) -> Cycle:
    """Changes to publish in this cycle, uniform across logs.

    ``mode="poll"``: the first batch of every table (one poll);
    ``mode="drain"``: the whole backlog, numbered into batches.
    With a ``sizer``, batch sizes are reused until its resample interval passes.
    With ``poll_bounds``, a poll reads keys only up to the LSN by which its batches are
    surely full, not those of the whole backlog.
    Rows: ``table_name``, system columns, ``batch_no``, ``change_json``.

    ``envelopes=True`` (drain mode) gives one row per batch envelope instead:
    ``table_name``, ``batch_no``, ``n_changes``, ``envelope_json`` and the
    envelope's last ``(lsn, seq)``; no envelope holds more than its batch size.
    """
    if mode not in ("poll", "drain"):
        raise ValueError(f"unknown mode {mode!r}")
    if envelopes and mode != "drain":
        raise ValueError("envelopes are built from drain batches (mode='drain')")
    tables = sorted(set(tables))
    bound = table_count(tables)
    logs = [lg.where(F.col(TABLE_NAME).isin(tables)) for lg in logs]
    # The highest saved cursor bounds the window the sampler reads first.
    top_lsn = offsets.where(F.col(TABLE_NAME).isin(tables)).agg(F.max("last_lsn")).first()[0]
    recent = bytes(top_lsn) if top_lsn is not None else None
    if sizer is not None:
        stamp = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        size_job = lambda: sizer.get(spark, tables, logs, stamp, recent)
    else:
        size_job = lambda: batch_size_values(
            table_batch_sizes(spark, tables, logs, sample_size, max_message_bytes, buffer_factor, recent),
            len(tables),
        )
    cursor, sizes = run_concurrently(lambda: load_cursors(spark, tables, offsets, _keys(logs)), size_job)
    if mode == "poll":
        uppers = poll_bounds.bounds(_keys(logs), cursor, sizes) if poll_bounds is not None else None
        return _poll_cycle(logs, cursor, sizes, bound, uppers)
    return _drain_cycle(spark, logs, cursor, sizes, bound, buckets, envelopes, server_name, poll_interval)


def _lines(numbered: DataFrame) -> DataFrame:
    return with_change_json(numbered).select(TABLE_NAME, START_LSN, SEQVAL, OPERATION, "batch_no", "change_json")


def _poll_cycle(logs, cursor, sizes, bound, uppers=None) -> Cycle:
    top = poll_keys(logs if uppers is None else [up_to(lg, uppers) for lg in logs], cursor, sizes, bound)
    last = last_lsns(top, bound)
    if not last and uppers is not None and any(u != END for u in uppers.values()):
        # the counted rows are gone from the log (cleaned up): read without bounds
        return _poll_cycle(logs, cursor, sizes, bound)
    polled = [polled_changes(lg, cursor, top, bound, last).drop("poll_rank", "batch_size") for lg in logs]
    rows = sum(p.select(TABLE_NAME).count() for p in polled) if last else 0
    batch = _union([_lines(decoded_changes(p).withColumn("batch_no", F.lit(0).cast("long"))) for p in polled])
    hw = top.groupBy(F.col("_pt").alias(TABLE_NAME)).agg(F.max(F.struct("_pl", "_ps")).alias("_hw"))
    return Cycle(batch, rows, hw.select(TABLE_NAME, F.col("_hw._pl").alias("lsn"), F.col("_hw._ps").alias("seq")))


def _drain_cycle(spark, logs, cursor, sizes, bound, buckets, envelopes, server_name, poll_interval) -> Cycle:
    after = changes_after(_keys(logs), cursor, bound)
    newest = after.groupBy(TABLE_NAME).agg(F.max(F.struct(F.col(START_LSN).alias("l"), F.col(SEQVAL).alias("s"))).alias("c"))
    # a NULL seq is never after a cursor of the same LSN, but may follow it; it sorts first there
    ends = {r[0]: (bytes(r[1].l), bytes(r[1].s or b"")) for r in collect_bounded(newest, bound, "drain ends")}
    lsns = {t: e[0] for t, e in ends.items()}

    def window(lg: DataFrame) -> DataFrame:
        return changes_after(up_to(lg, lsns), cursor, bound).where(F.coalesce(_not_after(ends), F.col(SEQVAL).isNull()))

    keys = ranked_keys(_union([window(lg).select(TABLE_NAME, START_LSN, SEQVAL) for lg in logs]), buckets)
    rows = keys.agg(F.sum("copies")).first()[0] or 0
    parts = []
    for lg in logs:
        b = drain_batches(decoded_changes(window(lg)), sizes, bound, buckets, envelopes, keys)
        parts.append(batch_envelopes(b, server_name, poll_interval, with_high_water=True) if envelopes else _lines(b))
    hw = spark.createDataFrame(
        [(t, bytearray(l), bytearray(s)) for t, (l, s) in sorted(ends.items())], "table_name string, lsn binary, seq binary"
    )
    return Cycle(_union(parts), int(rows), hw)


def cycle_changes(spark: SparkSession, logs: list[DataFrame], tables: Iterable[str], offsets: DataFrame, **kw) -> DataFrame:
    """The rows of ``plan_cycle``."""
    return plan_cycle(spark, logs, tables, offsets, **kw).batch


def run_cycle(
    spark: SparkSession,
    logs: list[DataFrame],
    tables: Iterable[str],
    store: OffsetStore,
    publish: Publisher,
    cycle_id: int = 0,
    now: _dt.datetime | None = None,
    **kw,
) -> CycleResult:
    """Resume -> read -> publish -> (on ack) merge and save offsets.

    A failed publish is logged and returned as the result's ``error``; offsets
    then stay where they were.
    """
    checkpoint_dir(spark)
    offsets = store.read()
    cycle = plan_cycle(spark, logs, tables, offsets, now=now, **kw)
    if cycle.rows == 0:
        return CycleResult(True, 0, None)
    try:
        if not publish(cycle.batch, cycle_id):
            raise RuntimeError("the publisher did not acknowledge the batch")
    except Exception as e:  # a sink may fail in any way; the cause is kept
        log.exception("cycle %s: publishing %s changes failed; offsets are unchanged", cycle_id, cycle.rows)
        return CycleResult(False, cycle.rows, None, e)
    stamp = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    merged = merge_offsets(offsets, cycle.high_water, F.lit(stamp).cast("timestamp_ntz"))
    return CycleResult(True, cycle.rows, store.write(merged))


def run_committed_cycle(
    spark: SparkSession, logs: list[DataFrame], tables: Iterable[str], path: str, now: _dt.datetime | None = None, **kw
) -> CycleResult:
    """Resume -> read -> publish lines and offsets in one commit (see ``sources.commit_sink``).

    The feed's folder holds its own offsets, so there is no save that could fail after
    the publish, and no change becomes visible twice.  One job at a time per folder.
    """
    checkpoint_dir(spark)
    feed = CommittedFeed(spark, path)
    feed.sweep()
    offsets = feed.read()
    cycle = plan_cycle(spark, logs, tables, offsets, now=now, **kw)
    if cycle.rows == 0:
        return CycleResult(True, 0, None)
    number = (feed.latest_cycle() or 0) + 1
    try:
        feed.commit(in_table_order(cycle.batch), number, offsets)
    except Exception as e:  # nothing of the batch is visible; the cause is kept
        log.exception("cycle %s: publishing %s changes failed; nothing was committed", number, cycle.rows)
        return CycleResult(False, cycle.rows, None, e)
    return CycleResult(True, cycle.rows, number)


def in_table_order(batch: DataFrame, files: int | None = None) -> DataFrame:
    """``(table_name, lsn, seq, value)`` of a batch, dealt by range and sorted, so that files follow the order.

    A hash of the line breaks ties, so changes that share a key still spread over files.
    """
    n = files or default_parallelism(batch.sparkSession)
    return (
        batch.withColumn("_tb", F.xxhash64(OPERATION, "change_json"))
        .repartitionByRange(n, TABLE_NAME, START_LSN, SEQVAL, "_tb")
        .select(TABLE_NAME, START_LSN, SEQVAL, "_tb", F.col("change_json").alias("value"))
        .sortWithinPartitions(TABLE_NAME, START_LSN, SEQVAL, "_tb")
        .drop("_tb")
    )


def json_lines_publisher(path: str, files: int | None = None) -> Publisher:
    """Publisher writing one JSON line per change, partitioned by table.

    Lines keep the change order of each table: the batch is range-partitioned
    on ``(table, lsn, seq)`` (so a hot table is spread over several files whose
    names follow the order) and sorted within partitions, with the write's
    partition column leading so the writer adds no sort of its own.  Each
    cycle appends a new ``cycle=N`` folder; a cycle that is replayed after a
    failed save writes its lines again (at-least-once).
    """

    def publish(batch: DataFrame, cycle_id: int) -> bool:
        (
            in_table_order(batch, files)
            .drop(START_LSN, SEQVAL)
            .write.mode("append")
            .partitionBy(TABLE_NAME)
            .text(f"{path}/cycle={cycle_id}")
        )
        return True

    return publish


def published_keys(batch: DataFrame) -> DataFrame:
    """``(table_name, lsn, seq, operation)`` in hex: the de-duplication key of published rows."""
    return batch.select(TABLE_NAME, lsn_hex(START_LSN).alias("lsn"), lsn_hex(SEQVAL).alias("seq"), OPERATION)


def envelope_publisher(path: str) -> Publisher:
    """Publisher writing one batch envelope (JSON) per line, partitioned by table.

    For ``run_cycle(..., mode="drain", envelopes=True)``.  Envelopes keep their
    batch order within a table; each cycle appends a ``cycle=N`` folder.
    """

    def publish(batch: DataFrame, cycle_id: int) -> bool:
        n = default_parallelism(batch.sparkSession)
        (
            batch.repartitionByRange(n, TABLE_NAME, "batch_no")
            .select(TABLE_NAME, "batch_no", F.col("envelope_json").alias("value"))
            .sortWithinPartitions(TABLE_NAME, "batch_no")
            .drop("batch_no")
            .write.mode("append")
            .partitionBy(TABLE_NAME)
            .text(f"{path}/cycle={cycle_id}")
        )
        return True

    return publish

"""Continuous feed on Structured Streaming.

The change log directory is a file stream source: Spark keeps the read
position (which files are done) in the query's ``checkpointLocation``, so a
restarted query reads only new files, and the first run reads everything
retained.  Decoding and JSON are the same stateless functions as in batch.
The text sink commits each micro-batch through its own log, so a batch that
fails is replayed from the same source offsets.

``strict`` mode also applies a cursor: rows at or below a table's ``(lsn, seq)``
are dropped even if they arrive in a new file.  It is a stream-static join with
the cursor snapshot (one row per configured table, broadcast) plus the keyset
filter, so no callback into Python is needed.  In a resumable feed (``run_feed``)
that cursor is the stream's low-water frontier, so a change that is only read
later than larger ones is never taken for a late one.

Admission per micro-batch is bounded with ``maxFilesPerTrigger``.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.decode import lsn_hex
from tidemark.operators.common import broadcast_bounded
from tidemark.operators.cursor import after_cursor, cursor_frame, load_cursors, op_filter
from tidemark.operators.offsets import merge_offsets
from tidemark.plans.feed import decoded_changes, with_change_json
from tidemark.schema import OFFSETS_SCHEMA, OPERATION, SEQVAL, START_LSN, TABLE_NAME
from tidemark.streaming.frontier import FrontierState, advance_from_sink, change_keys, low_water, moved, without

log = logging.getLogger(__name__)
FILE_TIME = "file_time"       # when a change's log file was written: event time of replayed changes


def read_change_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    tables: Iterable[str] | None = None,
    max_files_per_trigger: int | None = None,
    with_file_time: bool = False,
) -> DataFrame:
    """The log as a stream; ``with_file_time`` adds when each change's file was written."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    df = r.parquet(path)
    if with_file_time:
        df = df.select("*", F.col("_metadata.file_modification_time").alias(FILE_TIME))
    if tables is not None:
        df = df.where(F.col(TABLE_NAME).isin(sorted(set(tables))))
    return df


def published_stream(
    changes: DataFrame,
    cursor: DataFrame | None = None,
    table_bound: int | None = None,
) -> DataFrame:
    """Stateless: (optional strict cursor) -> op filter -> decode -> JSON line.

    Output: ``table_name``, the key ``(lsn, seq, operation)`` in hex, and
    ``value`` (the change JSON); and ``file_time``, if the changes have it.
    """
    timed = FILE_TIME in changes.columns
    src = op_filter(changes)
    if cursor is not None:
        cur = broadcast_bounded(
            cursor.select(F.col(TABLE_NAME).alias("_ct"), F.col("lsn").alias("_clsn"), F.col("seq").alias("_cseq")),
            table_bound,
        )
        src = (
            src.join(cur, F.col(TABLE_NAME) == F.col("_ct"), "inner")
            .where(after_cursor(F.col("_clsn"), F.col("_cseq")))
            .drop("_ct", "_clsn", "_cseq")
        )
    d = with_change_json(decoded_changes(src, keep=[FILE_TIME] if timed else ()))
    return d.select(
        TABLE_NAME,
        lsn_hex(START_LSN).alias("lsn"),
        lsn_hex(SEQVAL).alias("seq"),
        F.col(OPERATION).alias("operation"),
        F.col("change_json").alias("value"),
        *([FILE_TIME] if timed else []),
    )


def read_published_stream(spark: SparkSession, path: str, fmt: str = "text", max_files_per_trigger: int | None = None) -> DataFrame:
    """Published lines as a stream, with their change key and the time their file was written.

    ``path`` holds what the text or Parquet feed, or a cycle's publisher, wrote:
    lines by table, below ``cycle=N`` folders or not.
    """
    schema = "value string" if fmt == "text" else "lsn string, seq string, operation int, value string"
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    lines = r.format(fmt).load(path).select("value", F.col("_metadata.file_modification_time").alias(FILE_TIME))
    m = F.from_json("value", "metadata struct<TableName: string, LSN: string, Seq: string, OperationID: int>").getField("metadata")
    at = lambda name: F.col("_m").getField(name)
    return lines.withColumn("_m", m).select(
        at("TableName").alias(TABLE_NAME), at("LSN").alias("lsn"), at("Seq").alias("seq"), at("OperationID").alias("operation"), "value", FILE_TIME
    )


def without_replays(published: DataFrame, delay: str) -> DataFrame:
    """Each change key ``(table, lsn, seq, operation)`` once within ``delay`` of its first appearance.

    Delivery is at-least-once: a cycle that fails to save its offsets publishes the
    same changes again.  The streaming state keeps the keys that appeared within
    ``delay`` (by the time their file was written), hashed over all partitions, so a
    replay within it is dropped and the state stays bounded; copies inside one batch
    are one change too.  Rows without a key (lines that are no change) are kept.
    """
    keyed = F.col(TABLE_NAME).isNotNull()
    only = F.when(~keyed, F.concat_ws(" ", "value", F.expr("uuid()")))
    marked = published.withColumn("_only", only).withWatermark(FILE_TIME, delay)
    return marked.dropDuplicatesWithinWatermark([TABLE_NAME, "lsn", "seq", "operation", "_only"]).drop("_only")


def start_text_feed(
    published: DataFrame,
    out_path: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
    fmt: str = "text",
) -> StreamingQuery:
    """Write the feed partitioned by table; ``availableNow`` drains and stops.

    ``fmt="text"`` writes bare JSON lines.  ``fmt="parquet"`` keeps the key
    columns next to ``value``, so ``published_high_water`` reads two narrow
    columns instead of parsing every line.
    """
    cols = ["value"] if fmt == "text" else ["lsn", "seq", "operation", "value"]
    w = (
        published.select(TABLE_NAME, *cols)
        .writeStream.format(fmt)
        .outputMode("append")
        .partitionBy(TABLE_NAME)
        .option("checkpointLocation", checkpoint_location)
        .option("path", out_path)
    )
    if query_name:
        w = w.queryName(query_name)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def published_high_water(spark: SparkSession, out_path: str, fmt: str = "text") -> DataFrame:
    """Cursor per table from what the sink committed: ``(table_name, lsn, seq)``.

    Reads the sink through its commit log, so files of failed batches are not
    counted.  A Parquet feed is read on its key columns only; a text feed's
    lines are parsed.  LSN and Seq are fixed-width lowercase hex, so their
    string order is the binary order.
    """
    if fmt == "parquet":
        pub = spark.read.format("parquet").load(out_path)
        meta = pub.select(TABLE_NAME, F.col("lsn").alias("l"), F.col("seq").alias("s"))
    else:
        pub = spark.read.format("text").load(out_path)
        # one parse per line, keeping only the two metadata fields
        m = F.from_json("value", "metadata struct<LSN: string, Seq: string>").getField("metadata")
        meta = pub.select(TABLE_NAME, m.getField("LSN").alias("l"), m.getField("Seq").alias("s"))
    hw = meta.groupBy(TABLE_NAME).agg(F.max(F.struct("l", "s")).alias("c"))
    return hw.select(TABLE_NAME, F.unhex("c.l").alias("lsn"), F.unhex("c.s").alias("seq"))


def save_stream_offsets(spark: SparkSession, out_path: str, offsets: DataFrame, now, fmt: str = "text") -> DataFrame:
    """Offsets after a stream run: stored offsets merged with the published high water."""
    return merge_offsets(offsets, published_high_water(spark, out_path, fmt), now)


def micro_batch_handler(
    tables: Iterable[str], store, publish, mode: str = "drain", retained: Callable[[], list[DataFrame]] | None = None, state_path: str | None = None, **kw
):
    """A ``(micro_batch_df, batch_id)`` function running one feed cycle on a micro-batch.

    It starts strictly after the stream's frontier (see ``streaming.frontier``), not
    after the largest published key: files may come in any order, so a change that is
    only read later is published, and a change that was published before, or lies at or
    below the frontier, is dropped.  Batch numbering is that of the micro-batch.  A
    failed publish raises, so Spark fails the micro-batch and replays it from the same
    source offsets on restart.

    ``retained`` opens the logs that the stream reads; the frontier then moves to where
    no retained change is unpublished, is what the offsets store gets, and bounds the
    published keys that ``state_path`` (default: beside the store) keeps.  Without it
    the frontier stays where the stream began, all keys since are kept, and the store
    gets the largest published key, which another job must not resume from.

    It is a plain function, tested without a stream; ``start_cycle_stream`` wires it.
    """
    from tidemark.plans.cycle import plan_cycle
    from tidemark.session import checkpoint_dir

    tables = sorted(set(tables))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checkpoint_dir(spark)
        state = FrontierState(spark, state_path or f"{store.root}-frontier")
        offsets = store.read()
        found = state.load()
        start, committed = (found[0], found[1]) if found else ({}, state.no_keys())
        new = [t for t in tables if t not in start]
        logs = retained() if retained is not None else []
        keys = _union([change_keys(lg.where(F.col(TABLE_NAME).isin(tables))) for lg in logs or [batch]])
        if new:
            start = start | load_cursors(spark, new, offsets, keys)
        live = {t: start[t] for t in tables}
        stored = [(t, None if c[0] is None else bytearray(c[0]), None, None if c[1] is None else bytearray(c[1])) for t, c in live.items()]
        cycle = plan_cycle(spark, [without(batch, committed)], tables, spark.createDataFrame(stored, OFFSETS_SCHEMA), mode=mode, **kw)
        if cycle.rows == 0:
            return
        try:
            if not publish(cycle.batch, int(batch_id)):
                raise RuntimeError("the publisher did not acknowledge the batch")
        except Exception as e:
            log.exception("micro-batch %s: publishing %s changes failed; the frontier is unchanged", batch_id, cycle.rows)
            raise RuntimeError(f"publishing micro-batch {batch_id} failed; it will be replayed") from e
        committed = committed.unionByName(change_keys(op_filter(batch.where(F.col(TABLE_NAME).isin(tables)))))
        after = low_water(keys, committed, live) if logs else live
        state.save(start | after, committed)
        updates = cursor_frame(spark, moved(live, after))
        if not logs:
            had = offsets.where(F.col(TABLE_NAME).isin(tables)).select(TABLE_NAME, F.col("last_lsn").alias("lsn"), F.col("last_seq").alias("seq"))
            updates = cycle.high_water.unionByName(had)  # the larger of the two counts
        elif not moved(live, after):
            return
        store.write(merge_offsets(offsets, updates, _utc_now()))

    return handle


def run_feed(
    spark: SparkSession,
    logs: list[str],
    tables: Iterable[str],
    out_path: str,
    checkpoint_location: str,
    store=None,
    fmt: str = "text",
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    wait: Callable[[StreamingQuery], None] = lambda q: q.awaitTermination(),
    replay_delay: str | None = None,
) -> None:
    """The file-stream feed over all logs, resumable at any point.

    With an offsets ``store`` the stream starts strictly after its frontier (kept in
    ``<checkpoint>/frontier``; before the first run, the stored offsets), and when it
    ends, also by an error, the frontier and the store move to where no retained change
    is unpublished.  ``replay_delay`` drops replayed changes (see ``without_replays``).
    """
    tables = sorted(set(tables))
    schemas = [spark.read.option("mergeSchema", "true").parquet(p).schema for p in logs]
    opened = lambda: [spark.read.schema(s).parquet(p) for p, s in zip(logs, schemas)]
    cursors, cursor = None, None
    if store is not None:
        state = FrontierState(spark, f"{checkpoint_location.rstrip('/')}/frontier")
        found = state.load()
        cursors = found[0] if found else {}
        new = [t for t in tables if t not in cursors]
        if new:
            cursors = cursors | load_cursors(spark, new, store.read(), _union([change_keys(lg) for lg in opened()]))
        cursors = {t: cursors[t] for t in tables}
        cursor = cursor_frame(spark, cursors)
    streams = [read_change_stream(spark, p, s, tables, max_files_per_trigger, with_file_time=replay_delay is not None) for p, s in zip(logs, schemas)]
    feed = _union([published_stream(s, cursor, len(tables)) for s in streams])
    if replay_delay is not None:
        feed = without_replays(feed, replay_delay)
    query = start_text_feed(feed, out_path, checkpoint_location, processing_time=processing_time, fmt=fmt)
    try:
        wait(query)
    finally:
        query.stop()
        if store is not None and query.recentProgress:
            after = advance_from_sink(spark, state, cursors, opened(), out_path, fmt)
            updates = moved(cursors, {t: after[t] for t in tables})
            if updates:
                store.write(merge_offsets(store.read(), cursor_frame(spark, updates), _utc_now()))


def _utc_now():
    return F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def start_cycle_stream(
    changes: DataFrame,
    handler,
    checkpoint_location: str,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Run ``handler`` on every micro-batch with ``foreachBatch``.

    In classic PySpark ``foreachBatch`` opens a local callback port for the
    Python function; environments that forbid that should use
    ``start_text_feed`` instead.
    """
    w = changes.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint_location)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()

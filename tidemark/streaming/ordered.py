"""Ordered stream output: each table's changes leave the stream in ``(lsn, seq)`` order.

Log files may be read in any order, so a stream that publishes what it reads is
ordered only inside a micro-batch.  Here changes wait in keyed streaming state,
by table and LSN slot (``width`` LSNs), until the stream's low-water mark has
passed the slot.  LSNs are one sequence over all tables of a database, so the
mark is one watermark over the log: the largest slot read less ``lag`` slots.
Slots close in rising order, each once; a closed slot is sorted and published
as a whole, so a table's output is ordered across micro-batches, too.

The state is Spark's own windowed aggregation (append mode): slots are event
time, closing a slot is the watermark passing its window.  No Python runs.

Choose ``lag`` above the disorder of the files, in slots: a change whose slot
has closed is late and dropped (``numRowsDroppedByWatermark`` of the progress
counts them), as it could only be published out of order.  Changes of the last
``lag`` slots stay in the state until larger LSNs are read, also from one run to
the next.  A slot of one table is sorted by one task; ``width`` sets its rows.
A transaction is never split, so a very large one is one slot's work.

Rows without an LSN have no place in the order and are dropped; without a seq
they come first in their LSN.  Copies of a change stay, next to each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.schema import TABLE_NAME
from tidemark.streaming.stream import published_stream, read_change_stream

SLOT = "slot"


def lsn_slot(lsn_hex: Column, width: int) -> Column:
    """Slot of a 20-digit hex LSN: the number divided by ``width``, exact over all 80 bits."""
    high, low = (F.conv(F.substring(lsn_hex, at, 10), 16, 10).cast("decimal(13,0)") for at in (1, 11))
    whole = high * F.lit(1 << 40).cast("decimal(13,0)") + low
    size = F.lit(int(width)).cast("decimal(20,0)")
    return ((whole - whole % size) / size).cast("long")  # a quotient with decimals would be rounded


def ordered_slots(published: DataFrame, width: int, lag: int) -> DataFrame:
    """Closed slots ``(table_name, slot, changes)`` of a published stream; ``changes`` are in ``(lsn, seq)`` order.

    ``LSN / width`` must stay below some 9e12 (it is told in seconds of event time).
    """
    if width < 1 or lag < 0:
        raise ValueError("width must be at least 1 and lag at least 0")
    at = F.timestamp_seconds(lsn_slot(F.col("lsn"), width))
    timed = published.where(F.col("lsn").isNotNull()).withColumn("_at", at).withWatermark("_at", f"{int(lag)} seconds")
    change = F.struct("lsn", "seq", "operation", "value")
    closed = timed.groupBy(F.window("_at", "1 second").alias("_w"), TABLE_NAME).agg(F.array_sort(F.collect_list(change)).alias("changes"))
    return closed.select(TABLE_NAME, F.unix_seconds(F.col("_w.start")).alias(SLOT), "changes")


def start_ordered_feed(
    published: DataFrame, out_path: str, checkpoint_location: str, width: int, lag: int, processing_time: str | None = None
) -> StreamingQuery:
    """Write JSON lines below ``table_name=T/slot=N``: one file for each slot, whose lines are in order.

    A slot's lines are one value, so no later sort can mix them; slots are written
    once, in rising order, and their numbers give a table's whole order.
    """
    slots = ordered_slots(published, width, lag)
    lines = slots.select(TABLE_NAME, SLOT, F.array_join(F.col("changes.value"), "\n").alias("value"))
    w = lines.writeStream.format("text").outputMode("append").partitionBy(TABLE_NAME, SLOT)
    w = w.option("checkpointLocation", checkpoint_location).option("path", out_path)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()


def run_ordered_feed(
    spark: SparkSession,
    logs: list[str],
    tables,
    out_path: str,
    checkpoint_location: str,
    width: int,
    lag: int,
    cursor: DataFrame | None = None,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    wait: Callable[[StreamingQuery], None] = lambda q: q.awaitTermination(),
) -> None:
    """The ordered feed over all logs; the checkpoint keeps what still waits.

    ``cursor`` (``table_name, lsn, seq``) starts strictly after a key of each table.
    """
    tables = sorted(set(tables))
    feed = None
    for path in logs:
        schema = spark.read.option("mergeSchema", "true").parquet(path).schema
        part = published_stream(read_change_stream(spark, path, schema, tables, max_files_per_trigger), cursor, len(tables))
        feed = part if feed is None else feed.unionByName(part)
    query = start_ordered_feed(feed, out_path, checkpoint_location, width, lag, processing_time)
    try:
        wait(query)
    finally:
        query.stop()


def read_ordered_feed(spark: SparkSession, out_path: str) -> DataFrame:
    """Committed lines ``(table_name, slot, value)``; order by table and slot, lines keep their order inside a slot's file."""
    return spark.read.format("text").load(out_path)

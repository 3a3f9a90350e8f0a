"""Message cuts by bytes: greedy envelopes that keep a budget.

A batch size from average bytes cannot keep a message budget: large rows come
together, and the floor of the size forces many of them into one message.  Here each
table's changes, in order, are cut greedily: a message takes changes until the next
one would not fit.  Only a single change larger than the budget goes beyond it.

Where a message starts depends on the one before, all the way back, so the cuts are
found in steps that never put a table into one task:

1. Distributed prefix sums give every change the bytes before it (ranges of keys,
   sums inside a range, totals of the ranges before it).
2. The bytes of a table are divided into blocks of ``BLOCK_MESSAGES`` budgets.  A
   message that begins before a block ends at most one budget into it, so only changes
   there can be the first start of the block.  From each of them the walk to the first
   start behind the block is made inside the block (plus one budget of the next).
3. Pointer doubling over these block-to-block steps marks, in a logarithmic number of
   joins, the one start per block that the walk from the table's first change meets.
4. Every block is walked once from its start, and counts of blocks number the messages.

A block holds a bounded number of bytes, so a group is bounded however large a table is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import OPERATION, SEQVAL, START_LSN, TABLE_NAME
from tidemark.session import checkpoint_dir

KEY = (TABLE_NAME, START_LSN, SEQVAL, OPERATION, "digest")
BLOCK_MESSAGES = 64           # budgets in a block


def with_bytes_before(sized: DataFrame, ranges: int | None = None) -> DataFrame:
    """Adds ``start``, the bytes of the table's changes before each one, and checkpoints.

    ``sized`` has the ``KEY`` columns, unique, and ``bytes``.  Order within a table is
    that of the key.
    """
    spark = sized.sparkSession
    checkpoint_dir(spark)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sized.repartitionByRange(n, *KEY).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    totals = dealt.groupBy(TABLE_NAME, "_range").agg(F.sum("bytes").alias("_n"))
    below = Window.partitionBy(TABLE_NAME).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col(TABLE_NAME).alias("_bt"), F.col("_range").alias("_br"), F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(TABLE_NAME, "_range").orderBy(*KEY[1:]).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_inside", F.coalesce(F.sum("bytes").over(inside), F.lit(0)))
    j = local.join(before, F.col(TABLE_NAME).eqNullSafe(F.col("_bt")) & (F.col("_range") == F.col("_br")))
    start = (F.col("_before") + F.col("_inside")).cast("long")
    return j.select(*sized.columns, start.alias("start")).checkpoint(eager=True)


def _next_starts(start: np.ndarray, end: np.ndarray, at: np.ndarray, room: int) -> np.ndarray:
    """Index behind the message that begins at each index of ``at``."""
    return np.maximum(np.searchsorted(end, start[at] + room, side="right"), at + 1)


def _sorted_block(group: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, int, int]:
    group = group.sort_by("start")
    start = group.column("start").to_numpy()
    return group, start, start + group.column("bytes").to_numpy(), int(group.column("room")[0].as_py()), int(group.column("block_end")[0].as_py())


def _blocks(placed: DataFrame, block_messages: int) -> DataFrame:
    """Every change in its block, and those within one budget of a block's begin in the block before as well."""
    size = F.col("room") * block_messages
    own = F.floor(F.col("start") / size)
    ahead = (F.col("start") - own * size < F.col("room")) & (own > 0)
    both = placed.withColumn("block", F.explode(F.when(ahead, F.array(own, own - 1)).otherwise(F.array(own))))
    return both.withColumn("block_end", (F.col("block") + 1) * size)


def _steps(blocks: DataFrame, table_type: T.DataType, block_messages: int) -> DataFrame:
    """``(table_name, start, behind)``: from every possible first start of a block to the first start behind it."""
    schema = T.StructType([T.StructField(TABLE_NAME, table_type), T.StructField("start", T.LongType()), T.StructField("behind", T.LongType())])

    def walk(group: pa.Table) -> pa.Table:
        group, start, end, room, block_end = _sorted_block(group)
        first = int(np.searchsorted(start, block_end))  # changes of the next block follow
        begin = block_end - room * block_messages
        entries = np.flatnonzero(start[:first] < begin + room)
        entries = entries if len(entries) else np.arange(min(1, first))
        at = entries.copy()
        while True:
            open_ = at < first
            if not open_.any():
                break
            at[open_] = _next_starts(start, end, at[open_], room)
        behind = np.where(at > 0, end[np.maximum(at - 1, 0)], 0)
        tables = group.column(TABLE_NAME).slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(entries), np.int64)))
        return pa.table([tables, pa.array(start[entries]), pa.array(behind)], names=schema.names)

    return blocks.groupBy(TABLE_NAME, "block").applyInArrow(walk, schema)


def _first_starts(steps: DataFrame, n_blocks: int) -> DataFrame:
    """``(table_name, start)`` that the walk from each table's first change meets, one per block, by pointer doubling."""
    steps = steps.checkpoint(eager=True)
    met = steps.where(F.col("start") == 0).select(TABLE_NAME, "start").distinct()
    jump = steps
    for _ in range(max(0, n_blocks - 1).bit_length()):
        far = jump.select(F.col(TABLE_NAME).alias("_jt"), F.col("start").alias("_js"), F.col("behind").alias("_jb"))
        on = F.col(TABLE_NAME).eqNullSafe(F.col("_jt"))
        met = met.unionByName(met.join(far, on & (F.col("start") == F.col("_js"))).select(TABLE_NAME, F.col("_jb").alias("start"))).distinct().checkpoint(eager=True)
        jump = jump.join(far, on & (F.col("behind") == F.col("_js")), "left").select(TABLE_NAME, "start", F.coalesce("_jb", "behind").alias("behind")).checkpoint(eager=True)
    return met


def byte_cuts(sized: DataFrame, room: Column, ranges: int | None = None, block_messages: int = BLOCK_MESSAGES) -> DataFrame:
    """``KEY`` columns with ``envelope_no`` (from 0 in every table): greedy cuts of at most ``room`` bytes.

    ``sized`` has the ``KEY`` columns, unique, and positive ``bytes``; ``room`` is a
    positive long that is the same for all changes of a table.
    """
    if block_messages < 2:
        raise ValueError("a block holds two messages at least")
    table_type = sized.schema[TABLE_NAME].dataType
    placed = with_bytes_before(sized.withColumn("room", room.cast("long")), ranges)
    blocks = _blocks(placed, block_messages)
    last = blocks.agg(F.max("block")).first()[0]
    entry = _first_starts(_steps(blocks, table_type, block_messages), 0 if last is None else int(last) + 1)
    e = entry.select(F.col(TABLE_NAME).alias("_et"), F.col("start").alias("_es"))
    marked = blocks.join(e, F.col(TABLE_NAME).eqNullSafe(F.col("_et")) & (F.col("start") == F.col("_es")), "left").withColumn("entry", F.col("_es").isNotNull()).drop("_et", "_es")
    schema = T.StructType([*[sized.schema[n] for n in KEY], T.StructField("block", T.LongType()), T.StructField("number", T.LongType())])

    def cut(group: pa.Table) -> pa.Table:
        group, start, end, room_, block_end = _sorted_block(group)
        first = int(np.searchsorted(start, block_end))
        entries = np.flatnonzero(group.column("entry").to_numpy(zero_copy_only=False)[:first])
        number = np.full(len(start), -1, dtype=np.int64)
        if len(entries):
            at, k = int(entries[0]), 0
            while at < first:
                to = int(_next_starts(start, end, np.array([at]), room_)[0])
                number[at:to] = k
                at, k = to, k + 1
        mine = pa.array(np.flatnonzero(number >= 0))
        return group.select([*KEY, "block"]).take(mine).append_column("number", pa.array(number[number >= 0]))

    numbered = marked.groupBy(TABLE_NAME, "block").applyInArrow(cut, schema).checkpoint(eager=True)
    counts = numbered.groupBy(TABLE_NAME, "block").agg((F.max("number") + 1).alias("_n"))
    below = Window.partitionBy(TABLE_NAME).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(TABLE_NAME).alias("_bt"), F.col("block").alias("_bb"), F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"))
    j = numbered.join(before, F.col(TABLE_NAME).eqNullSafe(F.col("_bt")) & (F.col("block") == F.col("_bb")))
    return j.select(*KEY, (F.col("_before") + F.col("number")).cast("long").alias("envelope_no"))

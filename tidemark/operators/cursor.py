"""Cursor operators: keyset filter, resume position, sequence backfill, poll.

A cursor is one row per table: ``(table_name, lsn, seq)``.  Reading resumes
strictly after it: ``lsn > c.lsn OR (lsn = c.lsn AND seq > c.seq)``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.decode import zero_cursor
from tidemark.operators.common import broadcast_bounded, collect_bounded, table_count, table_frame
from tidemark.operators.batching import with_batch_size
from tidemark.schema import MAX_BATCH, OPERATION, PUBLISHED_OPS, SEQVAL, START_LSN, TABLE_NAME
from tidemark.session import checkpoint_dir


def after_cursor(lsn, seq) -> Column:
    """Strict keyset predicate on ``(lsn, seq)``.

    With literal bounds the OR form reaches the Parquet scan's ``PushedFilters``.
    A NULL cursor LSN matches nothing (three-valued logic), as in SQL.
    """
    lsn = F.lit(lsn) if isinstance(lsn, (bytes, bytearray)) else lsn
    seq = F.lit(seq) if isinstance(seq, (bytes, bytearray)) else seq
    return (F.col(START_LSN) > lsn) | ((F.col(START_LSN) == lsn) & (F.col(SEQVAL) > seq))


def op_filter(df: DataFrame, ops: Iterable[int] = PUBLISHED_OPS) -> DataFrame:
    """Keep published operation codes (drops update before-images and unknown codes)."""
    return df.where(F.col(OPERATION).isin(list(ops)))


def changes_between(df: DataFrame, from_lsn: bytes, to_lsn: bytes, ops: Iterable[int] = PUBLISHED_OPS) -> DataFrame:
    """Changes with ``from_lsn <= lsn <= to_lsn`` (closed range), published codes only."""
    rng = (F.col(START_LSN) >= F.lit(from_lsn)) & (F.col(START_LSN) <= F.lit(to_lsn))
    return op_filter(df.where(rng), ops)


def _configured_offsets(offsets: DataFrame, tables: Iterable[str] | DataFrame) -> DataFrame:
    if isinstance(tables, DataFrame):
        return offsets.join(tables.select(TABLE_NAME), TABLE_NAME, "left_semi")
    return offsets.where(F.col(TABLE_NAME).isin(sorted(set(tables))))


def seq_backfill(log: DataFrame, offsets: DataFrame, tables: Iterable[str] | DataFrame) -> DataFrame:
    """Seed ``last_seq`` for offsets rows that have an LSN but no sequence.

    Returns ``(table_name, backfill_seq)``: the smallest published sequence value
    at the stored LSN, or NULL when that LSN is not in the log.  The offsets side
    holds at most one row per configured table, so it is broadcast and the log is
    never shuffled for this join; only the per-table minimum is.
    """
    need = (
        _configured_offsets(offsets, tables)
        .where(F.col("last_seq").isNull() & F.col("last_lsn").isNotNull())
        .select(F.col(TABLE_NAME).alias("_t"), F.col("last_lsn").alias("_lsn"))
    )
    need = broadcast_bounded(need, table_count(tables))
    hits = op_filter(log).join(
        need, (F.col(TABLE_NAME) == F.col("_t")) & (F.col(START_LSN) == F.col("_lsn")), "inner"
    )
    return hits.groupBy(TABLE_NAME).agg(F.min(SEQVAL).alias("backfill_seq"))


def resume_cursor(
    spark: SparkSession,
    tables: Iterable[str] | DataFrame,
    offsets: DataFrame,
    log: DataFrame,
) -> DataFrame:
    """Position to resume from, one row per configured table: ``(table_name, lsn, seq)``.

    * no offsets row -> zero cursor (replay everything retained);
    * row with NULL ``last_seq`` -> smallest sequence at ``last_lsn`` (zeros if absent);
    * row with NULL ``last_lsn`` -> kept NULL, so the poll returns nothing.
    """
    cfg = table_frame(spark, tables)
    bound = table_count(tables)
    off = broadcast_bounded(
        _configured_offsets(offsets, tables).select(
            TABLE_NAME, "last_lsn", "last_seq", F.lit(True).alias("_has_row")
        ),
        bound,
    )
    back = broadcast_bounded(seq_backfill(log, offsets, tables), bound)
    j = cfg.join(off, TABLE_NAME, "left").join(back, TABLE_NAME, "left")
    missing = F.col("_has_row").isNull()
    lsn = F.when(missing, zero_cursor()).otherwise(F.col("last_lsn"))
    seq = (
        F.when(missing, zero_cursor())
        .when(F.col("last_seq").isNull(), F.coalesce(F.col("backfill_seq"), zero_cursor()))
        .otherwise(F.col("last_seq"))
    )
    return j.select(TABLE_NAME, lsn.alias("lsn"), seq.alias("seq"))


# Up to this many tables the exact cursor is written into the scan filter itself;
# beyond, a long OR of per-table terms costs more per row than a hash join.
MAX_LITERAL_TABLES = 4

Cursors = dict  # table_name -> (lsn bytes | None, seq bytes | None)


def load_cursors(
    spark: SparkSession,
    tables: Iterable[str],
    offsets: DataFrame,
    log: DataFrame,
) -> Cursors:
    """``resume_cursor`` for a configured table list, as driver-side values.

    The offsets of the configured tables are at most one row per table, so they
    are collected (the bound is checked).  The sequence backfill runs only when
    some row needs it, as a scan filtered by ``lsn IN (<stored LSNs>)`` literals
    that reach the Parquet scan.
    """
    from tidemark.schema import ZERO_CURSOR_HEX

    tables = sorted(set(tables))
    zero = bytes.fromhex(ZERO_CURSOR_HEX)
    rows = collect_bounded(
        _configured_offsets(offsets, tables).select(TABLE_NAME, "last_lsn", "last_seq"),
        len(tables),
        "offsets",
    )
    stored = {r[0]: (None if r[1] is None else bytes(r[1]), None if r[2] is None else bytes(r[2])) for r in rows}
    need = {t: lsn for t, (lsn, seq) in stored.items() if seq is None and lsn is not None}
    back = {}
    if need:
        lsns = sorted(set(need.values()))
        hits = op_filter(
            log.where(F.col(TABLE_NAME).isin(sorted(need)) & F.col(START_LSN).isin([bytearray(b) for b in lsns]))
        )
        for t, lsn, seq in collect_bounded(
            hits.groupBy(TABLE_NAME, START_LSN).agg(F.min(SEQVAL)), len(need) * len(lsns), "backfill"
        ):
            if need.get(t) == bytes(lsn):
                back[t] = bytes(seq)
    out = {}
    for t in tables:
        if t not in stored:
            out[t] = (zero, zero)
        else:
            lsn, seq = stored[t]
            out[t] = (lsn, seq if seq is not None else back.get(t, zero))
    return out


def cursor_frame(spark: SparkSession, cursors: Cursors) -> DataFrame:
    rows = [(t, None if l is None else bytearray(l), None if s is None else bytearray(s)) for t, (l, s) in sorted(cursors.items())]
    return spark.createDataFrame(rows, "table_name string, lsn binary, seq binary")


def cursor_predicate(cursors: Cursors) -> Column:
    """``OR`` over tables of ``table = t AND (lsn, seq) > cursor_t``, all literals.

    Tables whose cursor LSN is NULL match nothing and are left out.
    """
    pred = None
    for t, (lsn, seq) in sorted(cursors.items()):
        if lsn is None:
            continue
        # a NULL seq compares as NULL here and in the join path: later LSNs only
        bound = F.lit(None).cast("binary") if seq is None else bytearray(seq)
        term = (F.col(TABLE_NAME) == F.lit(t)) & after_cursor(bytearray(lsn), bound)
        pred = term if pred is None else pred | term
    return pred if pred is not None else F.lit(False)


MAX_CURSOR_GROUPS = 16
BY_TABLE = "partitioned_by_table"   # column metadata set by the log reader


def _partitioned_by_table(log: DataFrame) -> bool:
    """True when the reader found one folder per table (see ``read_change_log``)."""
    return bool(log.schema[TABLE_NAME].metadata.get(BY_TABLE))


def _pruned_by_cursor(log: DataFrame, live: Cursors) -> DataFrame:
    """Pushed ``table_name IN (...)`` and ``lsn >= floor`` filters for many cursors.

    On a log partitioned by ``table_name``, tables are grouped by cursor LSN
    (up to ``MAX_CURSOR_GROUPS``) and each group is scanned with its own floor,
    so one quiet table with an old cursor does not pull every other table's
    history into the scan; directory pruning keeps the groups apart.  On other
    logs one scan with the lowest floor is cheaper than several full scans.
    """
    order = sorted(live.items(), key=lambda kv: kv[1][0])
    if len(order) <= 1 or not _partitioned_by_table(log):
        floor = order[0][1][0]
        return log.where(F.col(TABLE_NAME).isin([t for t, _ in order]) & (F.col(START_LSN) >= F.lit(bytearray(floor))))
    n_groups = min(MAX_CURSOR_GROUPS, len(order))
    out = None
    for g in range(n_groups):
        part = order[g * len(order) // n_groups:(g + 1) * len(order) // n_groups]
        if not part:
            continue
        floor = part[0][1][0]
        scan = log.where(F.col(TABLE_NAME).isin([t for t, _ in part]) & (F.col(START_LSN) >= F.lit(bytearray(floor))))
        out = scan if out is None else out.unionByName(scan)
    return out


def changes_after(log: DataFrame, cursor, table_bound: int | None = None) -> DataFrame:
    """Published changes strictly after each table's cursor (tables without a cursor drop out).

    ``cursor`` is a cursor frame or driver-side ``Cursors``.  With up to
    ``MAX_LITERAL_TABLES`` live tables the exact cursor becomes a literal filter
    pushed into the Parquet scan; with more, ``table_name IN (...)`` and an
    ``lsn >=`` floor are pushed (per group of tables on a table-partitioned
    log, see ``_pruned_by_cursor``) and a broadcast join applies each table's
    exact cursor.
    """
    if isinstance(cursor, dict):
        live = {t: c for t, c in cursor.items() if c[0] is not None}
        if len(live) <= MAX_LITERAL_TABLES:
            # the floor reaches the scan even where an OR over tables and LSNs does not
            floor = F.col(START_LSN) >= F.lit(bytearray(min(c[0] for c in live.values()))) if live else F.lit(False)
            return op_filter(log.where(cursor_predicate(live) & floor))
        log = _pruned_by_cursor(log, live)
        cursor = cursor_frame(log.sparkSession, live)
        table_bound = len(live)
    cur = broadcast_bounded(
        cursor.select(F.col(TABLE_NAME).alias("_ct"), F.col("lsn").alias("_clsn"), F.col("seq").alias("_cseq")),
        table_bound,
    )
    j = op_filter(log).join(cur, F.col(TABLE_NAME) == F.col("_ct"), "inner")
    return j.where(after_cursor(F.col("_clsn"), F.col("_cseq"))).drop("_ct", "_clsn", "_cseq")


def poll_keys(
    logs: list[DataFrame],
    cursor,
    batch_sizes,
    table_bound: int | None = None,
    max_batch: int = MAX_BATCH,
) -> DataFrame:
    """Keys of one poll over all logs together: the first ``batch_size`` changes of every table.

    Columns ``_pt, _pl, _ps`` (table, LSN, seq), ``poll_rank`` and
    ``batch_size``; at most ``max_batch`` distinct keys per table, checkpointed.
    The literal bound lets Spark plan a ``WindowGroupLimit`` that keeps
    ``max_batch`` keys per table and task before the shuffle, so even a table
    (or one key's copies) holding most of the log sends few keys.  A batch size
    above ``max_batch`` is refused, never cut.
    """
    if isinstance(batch_sizes, dict) and max(batch_sizes.values(), default=0) > max_batch:
        raise ValueError(f"a batch size is above max_batch = {max_batch}")
    keys = None
    for log in logs:
        k = changes_after(log, cursor, table_bound).select(TABLE_NAME, START_LSN, SEQVAL)
        keys = k if keys is None else keys.unionByName(k)
    w = Window.partitionBy(TABLE_NAME).orderBy(F.col(START_LSN), F.col(SEQVAL))
    # a key's rank is the row number of its first copy (copies are contiguous in the order)
    first = keys.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= F.lit(max_batch))
    ranked = first.groupBy(TABLE_NAME, START_LSN, SEQVAL).agg(F.min("_rn").alias("poll_rank"))
    sized = with_batch_size(ranked, batch_sizes, table_bound)
    too_large = F.raise_error(F.concat(F.lit(f"a batch size is above max_batch = {max_batch}: "), F.col("batch_size").cast("string")))
    size = F.when(F.col("batch_size") > max_batch, too_large.cast("int")).otherwise(F.col("batch_size"))
    top = sized.withColumn("batch_size", size).where(F.col("poll_rank") <= F.col("batch_size"))
    checkpoint_dir(top.sparkSession)
    return top.select(
        F.col(TABLE_NAME).alias("_pt"),
        F.col(START_LSN).alias("_pl"),
        F.col(SEQVAL).alias("_ps"),
        F.col("poll_rank").cast("long").alias("poll_rank"),
        "batch_size",
    ).checkpoint(eager=True)


def last_lsns(top: DataFrame, table_bound: int) -> dict[str, bytes]:
    """Last LSN of every table among polled keys (one row per table)."""
    rows = collect_bounded(top.groupBy("_pt").agg(F.max("_pl")), table_bound, "last polled LSNs")
    return {r[0]: bytes(r[1]) for r in rows if r[1] is not None}


def up_to(log: DataFrame, last: dict[str, bytes]) -> DataFrame:
    """Changes of the given tables up to their last LSN.

    Pushed to the scan: exact bounds for few tables, ``table_name IN (...)`` and
    the highest bound for many (a broadcast of one row per table does the rest).
    """
    if not last:
        return log.where(F.lit(False))
    if len(last) <= MAX_LITERAL_TABLES:
        pred = None
        for t, lsn in sorted(last.items()):
            term = (F.col(TABLE_NAME) == F.lit(t)) & (F.col(START_LSN) <= F.lit(bytearray(lsn)))
            pred = term if pred is None else pred | term
        return log.where(pred & (F.col(START_LSN) <= F.lit(bytearray(max(last.values())))))
    spark = log.sparkSession
    ends = spark.createDataFrame([(t, bytearray(x)) for t, x in sorted(last.items())], "_ut string, _ul binary")
    near = log.where(F.col(TABLE_NAME).isin(sorted(last)) & (F.col(START_LSN) <= F.lit(bytearray(max(last.values())))))
    return near.join(broadcast_bounded(ends, len(last)), F.col(TABLE_NAME) == F.col("_ut")).where(F.col(START_LSN) <= F.col("_ul")).drop("_ut", "_ul")


def from_floors(log: DataFrame, floors: dict[str, bytes]) -> DataFrame:
    """Changes of the given tables at or after their floor LSN, any code.

    Pushed to the scan as in ``up_to``: exact bounds for few tables, for many
    ``table_name IN (...)`` and the lowest bound, with a broadcast for the rest.
    """
    if not floors:
        return log.where(F.lit(False))
    lowest = F.col(START_LSN) >= F.lit(bytearray(min(floors.values())))
    if len(floors) <= MAX_LITERAL_TABLES:
        pred = None
        for t, lsn in sorted(floors.items()):
            term = (F.col(TABLE_NAME) == F.lit(t)) & (F.col(START_LSN) >= F.lit(bytearray(lsn)))
            pred = term if pred is None else pred | term
        return log.where(pred & lowest)
    starts = log.sparkSession.createDataFrame([(t, bytearray(x)) for t, x in sorted(floors.items())], "_ft string, _fl binary")
    near = log.where(F.col(TABLE_NAME).isin(sorted(floors)) & lowest)
    return near.join(broadcast_bounded(starts, len(floors)), F.col(TABLE_NAME) == F.col("_ft")).where(F.col(START_LSN) >= F.col("_fl")).drop("_ft", "_fl")


def polled_changes(log: DataFrame, cursor, top: DataFrame, table_bound: int | None = None, last: dict | None = None) -> DataFrame:
    """The full rows of polled keys in one log; adds ``batch_size`` and ``poll_rank``.

    With ``last`` (see ``last_lsns``) the scan ends at each table's last polled
    LSN, so a poll reads its own window of wide rows and not the backlog.
    """
    after = changes_after(log if last is None else up_to(log, last), cursor, table_bound)
    cond = (F.col(TABLE_NAME) == F.col("_pt")) & (F.col(START_LSN) == F.col("_pl")) & (F.col(SEQVAL) == F.col("_ps"))
    # the keys are checkpointed, so their number is known and not only bounded
    return after.join(broadcast_bounded(top, top.count()), cond, "inner").drop("_pt", "_pl", "_ps")


def poll(
    log: DataFrame,
    cursor,
    batch_sizes,
    table_bound: int | None = None,
    max_batch: int = MAX_BATCH,
) -> DataFrame:
    """One poll for every table: the first ``batch_size`` published changes after the cursor.

    ``cursor`` and ``batch_sizes`` are frames or driver-side per-table values
    (``load_cursors`` / ``batch_size_values``); with values the cursor reaches
    the scan as pushed filters.  A table without a size has the default of 100.

    Order is ``(lsn, seq)`` within a table.  Rows tied on ``(lsn, seq)`` share a
    rank and are kept together, so a batch can run over its size at a tie.

    Two phases: the ranking runs on the key columns only (``poll_keys``); the
    full rows of the chosen keys are then read from a window of the log that
    ends at each table's last chosen LSN.  Adds ``batch_size`` and ``poll_rank``.
    """
    top = poll_keys([log], cursor, batch_sizes, table_bound, max_batch)
    last = last_lsns(top, table_bound) if table_bound is not None else None
    return polled_changes(log, cursor, top, table_bound, last)


def size_lookup(sizes: dict) -> Column:
    """Per-table batch size from driver-side values, as a literal map lookup."""
    kv = []
    for t, n in sorted(sizes.items()):
        kv += [F.lit(t), F.lit(int(n))]
    return F.element_at(F.create_map(*kv), F.col(TABLE_NAME)) if kv else F.lit(None).cast("int")

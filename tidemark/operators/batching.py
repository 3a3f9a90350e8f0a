"""Batch sizing and batching.

Sizing follows the sampled-bytes rule: take the newest ``sample_size`` rows of
each table (any operation code), JSON-encode each raw row, average the byte
lengths, and fit ``max_message_bytes / (avg * (1 + buffer_factor))`` records into
one message, clamped to ``[50, 1000]``; a table with no sample gets 100.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.decode import raw_record_json
from tidemark.operators.common import broadcast_bounded, collect_bounded, table_count, table_frame
from tidemark.operators.ordering import ranked_keys, with_ranked_keys
from tidemark.schema import (
    DEFAULT_BATCH,
    DEFAULT_BUFFER_FACTOR,
    DEFAULT_RESAMPLE_SECONDS,
    DEFAULT_SAMPLE_SIZE,
    MAX_BATCH,
    MIN_BATCH,
    OPERATION,
    SEQVAL,
    STANDARD_MESSAGE_BYTES,
    START_LSN,
    TABLE_NAME,
    q,
)


def sample_recent(
    log: DataFrame,
    sample_size: int = DEFAULT_SAMPLE_SIZE,
    table_bound: int | None = None,
    two_phase: bool = True,
) -> DataFrame:
    """Newest ``sample_size`` rows per table by ``(lsn, seq, operation)`` descending.

    Two phases, so wide rows are never sorted: the newest keys are picked from
    the four key columns only (the literal bound gives a ``WindowGroupLimit``
    that keeps ``sample_size`` keys per table and task before the shuffle),
    then the full rows are fetched by a join with those keys, which hold at most
    ``sample_size`` x tables rows and are broadcast when that bound is known.

    Copies of one change (same table, LSN, seq and code) come back as one row
    with ``sample_weight`` = the number of its copies inside the newest
    ``sample_size``; the copies are collapsed by a partial aggregate, so a key
    with millions of copies neither multiplies rows nor fills one task.  Adds
    ``sample_rank`` (the key's first position) and ``sample_weight``.
    """
    keys = [TABLE_NAME, START_LSN, SEQVAL, OPERATION]
    w = Window.partitionBy(TABLE_NAME).orderBy(
        F.col(START_LSN).desc(), F.col(SEQVAL).desc(), F.col(OPERATION).desc()
    )
    if not two_phase:
        return (
            log.withColumn("sample_rank", F.row_number().over(w))
            .where(F.col("sample_rank") <= F.lit(int(sample_size)))
            .withColumn("sample_rank", F.col("sample_rank").cast("long"))
            .withColumn("sample_weight", F.lit(1).cast("long"))
        )
    top = (
        log.select(*[F.col(q(k)) for k in keys])
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= F.lit(int(sample_size)))
        .groupBy(*[F.col(q(k)).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(F.min("_rn").cast("long").alias("sample_rank"), F.count(F.lit(1)).alias("sample_weight"))
    )
    bound = None if table_bound is None else table_bound * int(sample_size)
    top = broadcast_bounded(top, bound)
    cond = None
    for i, k in enumerate(keys):
        c = F.col(q(k)).eqNullSafe(F.col(f"_k{i}"))
        cond = c if cond is None else cond & c
    joined = log.join(top, cond, "inner")
    # one representative row per key: copies are the same change, so any copy will do
    # (and they collapse map-side in the partial aggregate)
    cols = log.columns
    rep = joined.groupBy(*[f"_k{i}" for i in range(len(keys))], "sample_rank", "sample_weight").agg(
        F.any_value(F.struct(*[F.col(q(c)) for c in cols])).alias("_rep")
    )
    return rep.select(*[F.col("_rep").getField(c).alias(c) for c in cols], "sample_rank", "sample_weight")


def recent_first_sample(
    log: DataFrame, tables, recent_from: bytes | dict[str, bytes], sample_size: int = DEFAULT_SAMPLE_SIZE
) -> DataFrame:
    """``sample_recent`` that reads history only for tables that need it.

    If a table has at least ``sample_size`` rows with ``lsn >= recent_from`` (one
    LSN, or one per table), its newest ``sample_size`` rows all lie there, so only
    that window is read (a pushed filter: row groups before it are skipped).  The
    other tables are sampled from their whole history, with ``table_name IN (...)``
    pruning the rest.  The per-table counts of the window are one row per configured
    table.
    """
    tables = sorted(set(tables))
    if isinstance(recent_from, dict):
        from tidemark.operators.cursor import from_floors

        window = from_floors(log, {t: recent_from[t] for t in tables if t in recent_from})
    else:
        window = log.where(F.col(START_LSN) >= F.lit(bytearray(recent_from)))
    counts = collect_bounded(window.groupBy(TABLE_NAME).count(), len(tables), "recent counts")
    full = sorted(r[0] for r in counts if r[1] >= sample_size)
    rest = sorted(set(tables) - set(full))
    parts = []
    if full:
        parts.append(sample_recent(window.where(F.col(TABLE_NAME).isin(full)), sample_size, len(full)))
    if rest:
        parts.append(sample_recent(log.where(F.col(TABLE_NAME).isin(rest)), sample_size, len(rest)))
    if not parts:
        return sample_recent(log.where(F.lit(False)), sample_size, 1)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_row_bytes(sample: DataFrame) -> DataFrame:
    """Byte length of each sampled raw row as JSON (``table_name`` and helper columns left out)."""
    raw = sample.drop("sample_rank", "sample_weight")
    return sample.select(
        TABLE_NAME,
        START_LSN,
        SEQVAL,
        OPERATION,
        "sample_rank",
        "sample_weight",
        F.octet_length(raw_record_json(raw)).alias("row_bytes"),
    )


def sample_stats(row_bytes: DataFrame, with_oldest: bool = False) -> DataFrame:
    """Per table: total bytes, rows sampled, average bytes per row (copies weighted).

    ``with_oldest`` adds the oldest LSN of the sample.
    """
    total = F.sum(F.col("row_bytes") * F.col("sample_weight"))
    rows = F.sum("sample_weight")
    return row_bytes.groupBy(TABLE_NAME).agg(
        total.alias("total_bytes"),
        rows.alias("sample_rows"),
        (total.cast("double") / rows).alias("avg_row_bytes"),
        *([F.min(START_LSN).alias("oldest_lsn")] if with_oldest else []),
    )


def size_from_average(
    avg_row_bytes,
    max_message_bytes: int = STANDARD_MESSAGE_BYTES,
    buffer_factor: float = DEFAULT_BUFFER_FACTOR,
):
    """Records per message for an average row size, clamped to ``[50, 1000]``."""
    fit = F.lit(float(max_message_bytes)) / (avg_row_bytes * F.lit(1.0 + buffer_factor))
    clamped = F.greatest(F.lit(MIN_BATCH), F.least(F.lit(MAX_BATCH), F.floor(fit))).cast("int")
    # greatest/least skip NULLs, so an empty sample must stay NULL explicitly
    return F.when(avg_row_bytes.isNotNull(), clamped)


def table_batch_sizes(
    spark: SparkSession,
    tables: Iterable[str] | DataFrame,
    logs: DataFrame | list[DataFrame],
    sample_size: int = DEFAULT_SAMPLE_SIZE,
    max_message_bytes: int = STANDARD_MESSAGE_BYTES,
    buffer_factor: float = DEFAULT_BUFFER_FACTOR,
    recent_from: bytes | None = None,
) -> DataFrame:
    """Batch size per configured table: ``(table_name, batch_size, sample_rows, avg_row_bytes)``.

    ``recent_from`` (an LSN, for example the highest saved cursor) lets the
    sampler read only ``lsn >= recent_from`` for tables with enough rows there;
    see ``recent_first_sample``.

    ``logs`` may be several change logs with different columns; each one is
    sampled and encoded with its own schema.  A configured table missing from
    every log (or with an empty sample) gets the default of 100, and a size
    that is not positive is read as 100.
    """
    logs = logs if isinstance(logs, list) else [logs]
    bound = table_count(tables)
    stats = None
    for lg in logs:
        if bound is not None:
            lg = lg.where(F.col(TABLE_NAME).isin(sorted(set(tables))))
        if recent_from is not None and bound is not None:
            sample = recent_first_sample(lg, tables, recent_from, sample_size)
        else:
            sample = sample_recent(lg, sample_size, bound)
        s = sample_stats(sample_row_bytes(sample))
        stats = s if stats is None else stats.unionByName(s)
    if len(logs) > 1:  # a table found in several logs is sampled in each
        total, rows = F.sum("total_bytes"), F.sum("sample_rows")
        stats = stats.groupBy(TABLE_NAME).agg(
            total.alias("total_bytes"), rows.alias("sample_rows"), (total.cast("double") / rows).alias("avg_row_bytes")
        )
    cfg = table_frame(spark, tables)
    st = broadcast_bounded(stats, table_count(tables))
    j = cfg.join(st, TABLE_NAME, "left")
    size = F.coalesce(size_from_average(F.col("avg_row_bytes"), max_message_bytes, buffer_factor), F.lit(DEFAULT_BATCH))
    size = F.when(size <= 0, F.lit(DEFAULT_BATCH)).otherwise(size)
    return j.select(
        TABLE_NAME,
        size.alias("batch_size"),
        F.coalesce(F.col("sample_rows"), F.lit(0)).alias("sample_rows"),
        F.col("avg_row_bytes"),
    )


def batch_metrics(
    sizes: DataFrame,
    sample_time,
    max_message_bytes: int = STANDARD_MESSAGE_BYTES,
    buffer_factor: float = DEFAULT_BUFFER_FACTOR,
) -> DataFrame:
    """Metrics record per table: size, sample time, rows sampled, truncated average, limit, buffer."""
    t = F.lit(sample_time) if not hasattr(sample_time, "alias") else sample_time
    return sizes.select(
        TABLE_NAME,
        F.col("batch_size").alias("current_batch_size"),
        t.cast(T.TimestampNTZType()).alias("last_sample_time"),
        F.col("sample_rows").cast("int").alias("last_sample_size"),
        F.col("avg_row_bytes").cast("int").alias("avg_row_size"),
        F.lit(int(max_message_bytes)).alias("max_message_size"),
        F.lit(float(buffer_factor)).alias("buffer_factor"),
    )


COPIES_PER_TASK = 10_000      # copies of one change that one task numbers


def with_batch_size(df: DataFrame, batch_sizes, table_bound: int | None = None) -> DataFrame:
    """Adds ``batch_size``; a table without a size has the default of 100.

    ``batch_sizes`` is a frame (``table_name``, ``batch_size``) or a driver-side dict.
    """
    if isinstance(batch_sizes, dict):
        from tidemark.operators.cursor import size_lookup

        return df.withColumn("batch_size", F.coalesce(size_lookup(batch_sizes), F.lit(DEFAULT_BATCH)))
    sizes = broadcast_bounded(batch_sizes.select(F.col(TABLE_NAME).alias("_st"), F.col("batch_size").alias("_bs")), table_bound)
    return df.join(sizes, F.col(TABLE_NAME) == F.col("_st"), "left").withColumn(
        "batch_size", F.coalesce("_bs", F.lit(DEFAULT_BATCH))
    ).drop("_st", "_bs")


def drain_batches(
    changes: DataFrame,
    batch_sizes: DataFrame | dict,
    table_bound: int | None = None,
    buckets: int | None = None,
    envelope_parts: bool = False,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Split every table's backlog into consecutive batches: ``batch_no = (rank - 1) div batch_size``.

    Equal to polling again and again when no two changes tie on ``(lsn, seq)``;
    tied changes share a batch.  Adds ``seq_rank``, ``batch_size`` and ``batch_no``.

    ``envelope_parts`` adds ``envelope_part`` for message building: rows of one
    ``(table, batch, part)`` are at most ``batch_size``.  Only the last key of a
    batch can run over it; its copies then fill parts of their own.  ``keys``
    takes ``ranked_keys`` of more than these changes (several logs together).
    """
    keys = ranked_keys(changes, buckets) if keys is None else keys
    ranked = with_ranked_keys(changes, keys).withColumn("seq_rank", F.col("key_rank").cast("long")).drop("key_rank")
    sized = with_batch_size(ranked, batch_sizes, table_bound)
    out = sized.withColumn("batch_no", F.floor((F.col("seq_rank") - 1) / F.col("batch_size")).cast("long"))
    if not envelope_parts:
        return out.drop("copies")
    over = (F.col("seq_rank") - 1) % F.col("batch_size") + F.col("copies") > F.col("batch_size")
    within = out.where(~over).withColumn("envelope_part", F.lit(0).cast("long"))
    ways = F.ceil(F.col("copies") / F.lit(COPIES_PER_TASK))
    # Numbers must not change if a lost task runs again, so rows are told apart by content: equal
    # rows are counted, then dealt out again in chunks, each with its number as part of its hash.
    key = (TABLE_NAME, START_LSN, SEQVAL)
    rows = out.where(over).select(*key, F.struct(*[q(c) for c in out.columns]).alias("_row")).withColumn("_content", F.sha2(F.to_json("_row"), 256))
    equal = rows.groupBy(*key, "_content").agg(F.first("_row").alias("_row"), F.count(F.lit(1)).alias("_n")).select("_row.*", "_content", "_n")
    chunks = equal.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / F.lit(COPIES_PER_TASK)))))
    first = F.col("_chunk") * COPIES_PER_TASK
    one = F.explode(F.sequence(first, F.least(first + COPIES_PER_TASK, "_n") - 1))
    dealt = chunks.repartition(*key, "_content", "_chunk").withColumn("_i", one)
    salted = dealt.withColumn("_salt", F.pmod(F.xxhash64("_content", "_i"), ways))
    number = F.row_number().over(Window.partitionBy(*key, "_salt").orderBy("_content", "_i"))
    part = F.lit(1) + F.col("_salt") + ways * F.floor((number - 1) / F.col("batch_size"))
    beyond = salted.withColumn("envelope_part", part.cast("long")).drop("_content", "_n", "_chunk", "_i", "_salt")
    return within.unionByName(beyond).drop("copies")


def batch_totals(keys: DataFrame, batch_sizes: DataFrame | dict, table_bound: int | None = None) -> DataFrame:
    """``(table_name, batch_no, n_changes, lsn, seq)`` of a drain's batches, from ``ranked_keys`` alone.

    A key's rank gives its batch and its copies the count, so no change is read again:
    one partial aggregate over the narrow keys, where they were ranked.
    """
    sized = with_batch_size(keys, batch_sizes, table_bound)
    numbered = sized.withColumn("batch_no", F.floor((F.col("key_rank") - 1) / F.col("batch_size")).cast("long"))
    last = F.max(F.struct(START_LSN, SEQVAL)).alias("_hw")
    t = numbered.groupBy(TABLE_NAME, "batch_no").agg(F.sum("copies").alias("n_changes"), last)
    return t.select(TABLE_NAME, "batch_no", "n_changes", F.col(f"_hw.`{START_LSN}`").alias("lsn"), F.col(f"_hw.`{SEQVAL}`").alias("seq"))


def batch_counts(batches: DataFrame) -> DataFrame:
    return batches.groupBy(TABLE_NAME, "batch_no").agg(F.count(F.lit(1)).alias("n_changes"))


def batch_high_water(batches: DataFrame) -> DataFrame:
    """Cursor after each batch: ``(lsn, seq)`` of its last change."""
    hw = batches.groupBy(TABLE_NAME, "batch_no").agg(F.max(F.struct(START_LSN, SEQVAL)).alias("_hw"))
    return hw.select(
        TABLE_NAME, "batch_no", F.col(f"_hw.`{START_LSN}`").alias("lsn"), F.col(f"_hw.`{SEQVAL}`").alias("seq")
    )


def table_high_water(changes: DataFrame) -> DataFrame:
    """Cursor after all given changes of each table: ``(table_name, lsn, seq)``."""
    hw = changes.groupBy(TABLE_NAME).agg(F.max(F.struct(START_LSN, SEQVAL)).alias("_hw"))
    return hw.select(TABLE_NAME, F.col(f"_hw.`{START_LSN}`").alias("lsn"), F.col(f"_hw.`{SEQVAL}`").alias("seq"))


def batch_size_values(sizes: DataFrame, table_bound: int) -> dict:
    """Batch sizes as driver-side values (one row per configured table; bound checked)."""
    return {r[0]: int(r[1]) for r in collect_bounded(sizes.select(TABLE_NAME, "batch_size"), table_bound, "batch sizes")}


class BatchSizer:
    """Batch sizes kept between cycles and re-estimated after an interval.

    Sizes are estimated at the first call and again once ``resample_seconds``
    have passed (default hourly), as a long-running feed does.  The values are
    one per configured table, so they live on the driver.

    With them each log's oldest sampled LSN per table is kept.  A log only grows, so
    the newest rows of the next sample lie at or behind it: a resample reads the rows
    from there on, not the history, and equals a sample of the whole log, also when
    rows came late.  A table that had fewer rows than the sample has no such LSN, and
    one whose rows were cleaned up since is sampled from all that is left of it.
    """

    def __init__(
        self,
        sample_size: int = DEFAULT_SAMPLE_SIZE,
        max_message_bytes: int = STANDARD_MESSAGE_BYTES,
        buffer_factor: float = DEFAULT_BUFFER_FACTOR,
        resample_seconds: float = DEFAULT_RESAMPLE_SECONDS,
    ):
        self.sample_size = sample_size
        self.max_message_bytes = max_message_bytes
        self.buffer_factor = buffer_factor
        self.resample_seconds = resample_seconds
        self.sizes: dict | None = None
        self.tables: tuple | None = None
        self.last_sample_time = None
        self.samples = 0
        self.floors: list[dict[str, bytes]] = []

    def due(self, tables, now) -> bool:
        if self.sizes is None or self.tables != tuple(sorted(set(tables))):
            return True
        return (now - self.last_sample_time).total_seconds() >= self.resample_seconds

    def get(self, spark: SparkSession, tables, logs, now, recent_from: bytes | None = None) -> dict:
        if self.due(tables, now):
            tables = sorted(set(tables))
            logs = logs if isinstance(logs, list) else [logs]
            if len(self.floors) != len(logs):  # the first sample, or other logs
                self.floors = [{} for _ in logs]
            totals: dict[str, list[int]] = {}
            for k, log in enumerate(logs):
                own = log.where(F.col(TABLE_NAME).isin(tables))
                start = self.floors[k] or ({t: recent_from for t in tables} if recent_from is not None else {})
                sample = recent_first_sample(own, tables, start, self.sample_size) if start else sample_recent(own, self.sample_size, len(tables))
                stats = collect_bounded(sample_stats(sample_row_bytes(sample), with_oldest=True), len(tables), "sample")
                self.floors[k] = {r[TABLE_NAME]: bytes(r["oldest_lsn"]) for r in stats if r["sample_rows"] >= self.sample_size and r["oldest_lsn"] is not None}
                for r in stats:
                    seen = totals.setdefault(r[TABLE_NAME], [0, 0])
                    seen[0] += r["total_bytes"]
                    seen[1] += r["sample_rows"]
            averages = spark.createDataFrame([(t, b / n if n else None) for t, (b, n) in totals.items()], "table_name string, avg_row_bytes double")
            size = size_from_average(F.col("avg_row_bytes"), self.max_message_bytes, self.buffer_factor)
            sized = {r[0]: r[1] for r in collect_bounded(averages.select(TABLE_NAME, size), len(tables), "batch sizes")}
            self.sizes = {t: sized[t] if sized.get(t) is not None and sized[t] > 0 else DEFAULT_BATCH for t in tables}
            self.tables = tuple(tables)
            self.last_sample_time = now
            self.samples += 1
        return self.sizes

"""Change logs derived from the driver's tables.

No change table ships with the test data, so two logs are derived from
``events`` and ``documents`` by a fixed rule (the same rule is written in the
DuckDB oracle):

* ``events`` -> narrow rows, one feed per ``event_type``, transactions of 4 ids,
  operation codes by ``event_id % 5``: 0 -> [1], 1 -> [3, 4], 2 -> [5], else [2];
  ``props`` is NULL on every 7th id.
* ``documents`` -> wide rows, one feed per ``lang``, transactions of 3 ids,
  codes by ``doc_id % 4``: 0 -> [1], 1 -> [3, 4], else [2].

LSN = id div txn + 1 and seq = id + 1, both as 10-byte big-endian binary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.decode import lsn_from_long
from tidemark.schema import OPERATION, SEQVAL, START_LSN, TABLE_NAME


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_change_log(events: DataFrame) -> DataFrame:
    ops = F.expr(
        "case event_id % 5 when 0 then array(1) when 1 then array(3, 4) "
        "when 2 then array(5) else array(2) end"
    )
    return events.select(
        F.col("event_type").alias(TABLE_NAME),
        lsn_from_long(F.expr("event_id div 4 + 1")).alias(START_LSN),
        lsn_from_long(F.col("event_id") + 1).alias(SEQVAL),
        F.explode(ops).alias(OPERATION),
        "event_id",
        "ts",
        "user_id",
        "value",
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("props")).alias("props"),
    )


def documents_change_log(documents: DataFrame) -> DataFrame:
    ops = F.expr("case doc_id % 4 when 0 then array(1) when 1 then array(3, 4) else array(2) end")
    return documents.select(
        F.col("lang").alias(TABLE_NAME),
        lsn_from_long(F.expr("doc_id div 3 + 1")).alias(START_LSN),
        lsn_from_long(F.col("doc_id") + 1).alias(SEQVAL),
        F.explode(ops).alias(OPERATION),
        "doc_id",
        "text",
        "source",
        "n_chars",
    )


def events_ct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_change_log(_table(spark, sf_dir, "events"))


def documents_ct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_change_log(_table(spark, sf_dir, "documents"))


def updated_documents_ct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of ``documents`` whose updates have before-images of their own.

    Keys as in ``documents_change_log``; codes by ``doc_id``: every fourth is an update
    (3, 4), of which ``doc_id % 16 = 5`` lost its before-image and ``9`` its
    after-image; the others are inserts.  Before an update ``n_chars`` is one less where
    3 divides the id, and ``source`` is NULL where 5 does.
    """
    ops = F.expr(
        "case when doc_id % 16 = 5 then array(4) when doc_id % 16 = 9 then array(3) "
        "when doc_id % 4 = 1 then array(3, 4) else array(2) end"
    )
    rows = _table(spark, sf_dir, "documents").select("*", F.explode(ops).alias(OPERATION))
    old = F.col(OPERATION) == 3
    return rows.select(
        F.col("lang").alias(TABLE_NAME),
        lsn_from_long(F.expr("doc_id div 3 + 1")).alias(START_LSN),
        lsn_from_long(F.col("doc_id") + 1).alias(SEQVAL),
        OPERATION,
        "doc_id",
        "text",
        F.when(~old | (F.col("doc_id") % 5 != 0), F.col("source")).alias("source"),
        F.when(old & (F.col("doc_id") % 3 == 0), F.col("n_chars") - 1).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def documents_schema_history(log: DataFrame) -> DataFrame:
    """Schema versions of every table of ``documents_ct``, at thirds of its transactions.

    First ``doc_id`` (int), ``source`` and ``text``; then ``doc_id`` is widened and
    ``n_chars`` (int) added; then ``n_chars`` becomes a decimal and ``source`` is dropped.
    """
    last = log.groupBy(TABLE_NAME).agg(F.conv(F.hex(F.max(START_LSN)), 16, 10).cast("long").alias("m"))
    versions = (
        ("0L", "doc_id int, source string, text string"),
        ("m div 3 + 1", "doc_id bigint, n_chars int, source string, text string"),
        ("2 * m div 3 + 1", "doc_id bigint, n_chars decimal(12,2), text string"),
    )
    parts = []
    for first, ddl in versions:
        cols = [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(ddl).fields]
        listed = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in cols])
        parts.append(F.struct(lsn_from_long(F.expr(first)).alias("from_lsn"), listed.alias("columns")))
    return last.select(TABLE_NAME, F.inline(F.array(*parts)))


# Configured feeds of the two derived logs.
EVENT_TABLES = ("click", "error", "purchase", "signup", "view")
DOCUMENT_TABLES = ("de", "en", "es", "fr")
FIXTURE_TIME = "2024-06-01 12:00:00"


def offsets_fixture(log: DataFrame, updated_at: str = FIXTURE_TIME) -> DataFrame:
    """Offsets rows derived from an events change log, one per resume case.

    * ``click``: inside a transaction, at the first change of the first LSN
      that holds two or more published click changes;
    * ``view``: at its newest published change (nothing left to read);
    * ``error``: the same LSN rule as ``click`` but ``last_seq`` NULL (backfilled);
    * ``purchase``: ``last_lsn`` NULL (reads nothing);
    * ``signup``: no row (replays from the zero cursor).
    """
    from tidemark.functions.decode import zero_cursor
    from tidemark.operators.cursor import op_filter

    # one pass: per (table, LSN) count, first and last seq; then one row per table
    per_lsn = op_filter(log).groupBy(TABLE_NAME, START_LSN).agg(
        F.count(F.lit(1)).alias("n"), F.min(SEQVAL).alias("first_seq"), F.max(SEQVAL).alias("last_seq")
    )
    lsn = F.col(START_LSN).alias("lsn")
    per_table = per_lsn.groupBy(TABLE_NAME).agg(
        F.min(F.when(F.col("n") >= 2, F.struct(lsn, F.col("first_seq").alias("seq")))).alias("inside"),
        F.max(F.struct(lsn, F.col("last_seq").alias("seq"))).alias("newest"),
    )
    t = F.col(TABLE_NAME)
    null = F.lit(None).cast("binary")
    rows = per_table.where(t.isin("view", "purchase") | (t.isin("click", "error") & F.col("inside").isNotNull()))
    return rows.select(
        TABLE_NAME,
        F.when(t == "view", F.col("newest.lsn")).when(t == "purchase", null).otherwise(F.col("inside.lsn")).alias("last_lsn"),
        F.lit(updated_at).cast("timestamp_ntz").alias("updated_at"),
        F.when(t == "view", F.col("newest.seq")).when(t == "purchase", zero_cursor()).when(t == "error", null).otherwise(F.col("inside.seq")).alias("last_seq"),
    )

"""Per-table ordering of changes by ``(lsn, seq)`` that scales past hot groups.

``rank() over (partition by table_name order by lsn, seq)`` puts each table in a
single task; a table holding a third of the log would then be sorted by one
core.  ``sequence_rank`` computes the same rank in steps, the same ones for
every input size:

1. Copies of one ``(table, lsn, seq)`` share a rank, so they are counted first
   (a partial aggregate); from here on every key is one narrow row.
2. The keys are dealt by range over ``(table, lsn, seq)``, so a hot table fills
   many partitions, and checkpointed, which fixes the ranges.
3. Within a range a window adds up the copies of the smaller keys; the totals of
   the ranges before it (one row per table and range) give the rest.
4. The ranks are joined back to the changes by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schema import SEQVAL, START_LSN, TABLE_NAME
from tidemark.session import checkpoint_dir

KEY = (TABLE_NAME, START_LSN, SEQVAL)


def _same(names: tuple[str, ...], prefix: str) -> Column:
    """Null-safe equality of key columns with their prefixed twins (still an equi-join)."""
    cond = None
    for n in names:
        c = F.col(n).eqNullSafe(F.col(f"{prefix}{n}"))
        cond = c if cond is None else cond & c
    return cond


def ranked_keys(df: DataFrame, buckets: int | None = None) -> DataFrame:
    """Every distinct ``(table_name, lsn, seq)`` with ``copies`` and ``key_rank``, narrow.

    ``key_rank`` is what ``rank()`` gives the key's rows: one more than the rows
    of the table with a smaller key (NULLs first).  ``buckets`` is the number of
    ranges (default: the session's shuffle partitions); it does not change the
    result.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"))
    dealt = keys.repartitionByRange(n, *KEY).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    inside = Window.partitionBy(TABLE_NAME, "_range").orderBy(START_LSN, SEQVAL).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy(TABLE_NAME).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(TABLE_NAME, "_range").agg(F.sum("copies").alias("_n"))
    before = totals.select(
        F.col(TABLE_NAME).alias(f"_b{TABLE_NAME}"), F.col("_range").alias("_brange"), F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before")
    )
    local = dealt.withColumn("_inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    j = local.join(before, _same((TABLE_NAME,), "_b") & (F.col("_range") == F.col("_brange")))
    return j.select(*KEY, "copies", (F.col("_before") + F.col("_inside") + 1).alias("key_rank"))


def with_ranked_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Joins ``copies`` and ``key_rank`` of ``ranked_keys`` to the changes.

    The copies of a hot key meet one row on the other side; AQE splits such a
    partition (``spark.sql.adaptive.skewJoin``).
    """
    k = keys.select(*[F.col(n).alias(f"_k{n}") for n in KEY], "copies", "key_rank")
    return df.join(k, _same(KEY, "_k")).drop(*[f"_k{n}" for n in KEY])


def sequence_rank(df: DataFrame, out: str = "seq_rank", buckets: int | None = None) -> DataFrame:
    """Add ``rank() over (partition by table_name order by lsn, seq)`` as ``out``."""
    ranked = with_ranked_keys(df, ranked_keys(df, buckets))
    return ranked.withColumn(out, F.col("key_rank").cast("long")).drop("copies", "key_rank")

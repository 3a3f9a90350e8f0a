"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import TABLE_NAME

# A side is broadcast only when its row count has a proven bound at or below this.
# Cursor, offsets and size frames hold one row per configured table, so their bound
# is the length of the table list; bucket offsets hold tables x buckets rows.
BROADCAST_MAX_ROWS = 200_000


def broadcast_bounded(df: DataFrame, row_bound: int | None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only for a side whose row count is known to be small.

    Without a bound (or above it) the join is left to the optimizer and AQE,
    which pick a shuffle join and can still switch at run time.
    """
    if row_bound is not None and row_bound <= max_rows:
        return F.broadcast(df)
    return df


def table_frame(spark: SparkSession, tables: Iterable[str] | DataFrame) -> DataFrame:
    """Configured tables as a one-column DataFrame (the list is a job argument)."""
    if isinstance(tables, DataFrame):
        return tables.select(TABLE_NAME)
    names = sorted(set(tables))
    schema = T.StructType([T.StructField(TABLE_NAME, T.StringType(), False)])
    return spark.createDataFrame([(n,) for n in names], schema)


def table_count(tables: Iterable[str] | DataFrame) -> int | None:
    """Row bound of a table list: its length when it is a driver-side list."""
    if isinstance(tables, DataFrame):
        return None
    return len(set(tables))


def collect_bounded(df: DataFrame, bound: int, what: str) -> list:
    """Collect a control frame known to hold at most ``bound`` rows (one per configured table).

    Raises instead of truncating when the bound does not hold.
    """
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what}: more than {bound} rows, expected at most one per configured table")
    return rows


def run_concurrently(*thunks: Callable):
    """Run independent actions (small control jobs) from separate threads.

    Spark schedules jobs submitted from different threads at the same time, so
    short jobs that each leave most cores idle overlap instead of queueing.
    """
    if len(thunks) == 1:
        return [thunks[0]()]
    with ThreadPoolExecutor(max_workers=len(thunks)) as pool:
        futures = [pool.submit(t) for t in thunks]
        return [f.result() for f in futures]


def default_parallelism(spark: SparkSession) -> int:
    """The cluster's default parallelism; the shuffle partition count where it is not visible."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except PySparkException:  # no SparkContext on the client (for example Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

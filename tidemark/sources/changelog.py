"""Readers for change logs.

A change log is one DataFrame (usually a Parquet dataset partitioned by
``table_name``) holding ``table_name``, the three system columns and the source
columns.  Tables with different columns live in separate logs; each log is
decoded on its own and the uniform results are unioned (see
``tidemark.plans.feed.multi_table_changes``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.common import default_parallelism
from tidemark.operators.cursor import BY_TABLE
from tidemark.schema import CAPTURE_PREFIX, OPERATION, SEQVAL, START_LSN, SYSTEM_COLUMNS, TABLE_NAME, q, source_columns


def read_change_log(
    spark: SparkSession,
    path: str,
    tables: Iterable[str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Read a Parquet change log, keeping only the configured tables.

    The ``table_name IN (...)`` filter prunes partitions when the log is
    partitioned by table, and is pushed to the scan otherwise.
    ``merge_schema`` picks up source columns added later in the log.
    """
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(path)
    if _has_table_folders(spark, path):
        df = df.withMetadata(TABLE_NAME, {BY_TABLE: True})
    return only_tables(df, tables)


def _has_table_folders(spark: SparkSession, path: str) -> bool:
    """True for a log with a folder per table (the folders are listed, not the files)."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:  # a client without a JVM: the readers then use one floor for all tables
        return False
    glob = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{TABLE_NAME}=*")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    return found is not None and len(found) > 0


def only_tables(df: DataFrame, tables: Iterable[str] | None) -> DataFrame:
    if tables is None:
        return df
    return df.where(F.col(TABLE_NAME).isin(list(tables)))


def discover_columns(df: DataFrame) -> list[str]:
    """Source columns of a log, from its own schema (not from the source table)."""
    return source_columns(df)


def catalog_columns(spark: SparkSession, table: str, database: str | None = None) -> list[str]:
    """Source columns of a change table registered in the catalog (or a view)."""
    names = [c.name for c in spark.catalog.listColumns(table, database)]
    return [n for n in names if n != TABLE_NAME and not n.startswith(CAPTURE_PREFIX)]


def scan_changes(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Project ``table_name``, the system columns and the source columns.

    Only the listed columns reach the Parquet ``ReadSchema``.
    """
    cols = columns if columns is not None else discover_columns(df)
    return df.select(TABLE_NAME, *[q(c) for c in SYSTEM_COLUMNS], *[q(c) for c in cols])


def with_system_names(df: DataFrame, lsn="start_lsn", seq="seqval", op="operation") -> DataFrame:
    """Rename plain system-column names to the change-table names."""
    return df.withColumnRenamed(lsn, START_LSN).withColumnRenamed(seq, SEQVAL).withColumnRenamed(op, OPERATION)


def change_log_schema(source: T.StructType) -> T.StructType:
    """Schema of a change log for a source table schema."""
    return T.StructType(
        [
            T.StructField(TABLE_NAME, T.StringType(), True),
            T.StructField(START_LSN, T.BinaryType(), True),
            T.StructField(SEQVAL, T.BinaryType(), True),
            T.StructField(OPERATION, T.IntegerType(), True),
            *source.fields,
        ]
    )


def read_change_log_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    table_name: str,
    lsn_ranges: list[tuple[str, str | None]],
    properties: dict | None = None,
) -> DataFrame:
    """Read one change table over JDBC, one partition per LSN range, as a change log of ``table_name``.

    A binary LSN cannot be a JDBC ``partitionColumn``, so the ranges are given as
    ``predicates`` (half-open ``[lo, hi)`` hex bounds; the last may be open).
    Untested here: no database server is available in the build environment.
    """
    df = spark.read.jdbc(url, table, predicates=lsn_range_predicates(lsn_ranges), properties=properties or {})
    return df.withColumn(TABLE_NAME, F.lit(table_name))


def lsn_range_predicates(lsn_ranges: list[tuple[str, str | None]]) -> list[str]:
    """One JDBC partition predicate per half-open hex LSN range ``[lo, hi)``; ``hi`` None is open.

    The ranges must not overlap, so every change is read by exactly one
    partition; the bounds are read as bytes, so nothing but hex reaches the SQL
    and letter case does not matter.
    """
    bounds = sorted(((bytes.fromhex(lo), None if hi is None else bytes.fromhex(hi)) for lo, hi in lsn_ranges), key=lambda r: r[0])
    out = []
    for lo, hi in bounds:
        if hi is not None and lo >= hi:
            raise ValueError(f"empty LSN range [{lo.hex()}, {hi.hex()})")
        end = "" if hi is None else f" AND [{START_LSN}] < 0x{hi.hex()}"
        out.append(f"[{START_LSN}] >= 0x{lo.hex()}{end}")
    for (a_lo, a_hi), (b_lo, _) in zip(bounds, bounds[1:]):
        if a_hi is None or b_lo < a_hi:
            raise ValueError(f"LSN ranges from {a_lo.hex()} and {b_lo.hex()} overlap")
    return out


def write_change_log(df: DataFrame, path: str, files_per_write: int | None = None, mode: str = "append") -> None:
    """Write changes in the layout the readers prune best.

    Partitioned by ``table_name`` (a ``table_name IN (...)`` filter prunes
    directories) and range-partitioned and sorted by ``(lsn, seq)`` within each
    write, so Parquet row-group min/max statistics on the LSN are tight and a
    pushed ``lsn >= cursor`` skips everything already published.  A hot table
    is spread over several files by the range partitioning.
    """
    n = files_per_write or default_parallelism(df.sparkSession)
    (
        # a row id breaks ties, so many copies of one change still spread over files
        df.withColumn("_tb", F.monotonically_increasing_id())
        .repartitionByRange(n, TABLE_NAME, START_LSN, SEQVAL, "_tb")
        .sortWithinPartitions(TABLE_NAME, START_LSN, SEQVAL, "_tb")
        .drop("_tb")
        .write.mode(mode)
        .partitionBy(TABLE_NAME)
        .parquet(path)
    )

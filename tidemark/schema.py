"""Column names, fixed values and target schemas of a change feed.

A change log holds the changes of many source tables in one DataFrame, keyed by
``table_name``.  Every change row carries three system columns followed by the
columns of its source table.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values of the change-capture format (must stay as they are) -------
# System columns of a change row.
START_LSN = "__$start_lsn"
SEQVAL = "__$seqval"
OPERATION = "__$operation"
CAPTURE_PREFIX = "__$"
SYSTEM_COLUMNS = (START_LSN, SEQVAL, OPERATION)
TABLE_NAME = "table_name"

# A cursor is 10 bytes of LSN and 10 bytes of sequence; the starting cursor is all zeros.
ZERO_CURSOR_HEX = "00000000000000000000"

# Operation codes: 1 delete, 2 insert, 3 update before-image, 4 update after-image.
OP_DELETE = 1
OP_INSERT = 2
OP_UPDATE_BEFORE = 3
OP_UPDATE_AFTER = 4
# Codes that are published; 3 (before-image) and unknown codes are not.
PUBLISHED_OPS = (1, 2, 4)
# Names given to the codes in the published metadata.
OP_NAMES = {1: "Delete", 2: "Insert", 3: "Update", 4: "Update"}

# Batch sizing.
DEFAULT_SAMPLE_SIZE = 100          # newest rows sampled per table
DEFAULT_BUFFER_FACTOR = 0.2        # 20 % safety margin on the average row
DEFAULT_RESAMPLE_SECONDS = 3600    # re-estimate hourly
STANDARD_MESSAGE_BYTES = 256 * 1024
PREMIUM_MESSAGE_BYTES = 1024 * 1024
MIN_BATCH = 50
MAX_BATCH = 1000
DEFAULT_BATCH = 100                # empty or unreadable sample
# --- end of fixed values -------------------------------------------------------

OFFSETS_SCHEMA = T.StructType(
    [
        T.StructField(TABLE_NAME, T.StringType(), False),
        T.StructField("last_lsn", T.BinaryType(), True),
        T.StructField("updated_at", T.TimestampNTZType(), True),
        T.StructField("last_seq", T.BinaryType(), True),
    ]
)

BATCH_STATS_SCHEMA = T.StructType(
    [
        T.StructField(TABLE_NAME, T.StringType(), False),
        T.StructField("current_batch_size", T.IntegerType(), False),
        T.StructField("last_sample_time", T.TimestampNTZType(), True),
        T.StructField("last_sample_size", T.IntegerType(), True),
        T.StructField("avg_row_size", T.IntegerType(), True),
        T.StructField("max_message_size", T.IntegerType(), False),
        T.StructField("buffer_factor", T.DoubleType(), False),
    ]
)


def source_columns(df_or_schema) -> list[str]:
    """Source-table columns of a change log: no ``table_name`` and no column of the capture itself.

    A change table may hold more capture columns than the three that are read
    (an end LSN, an update mask, a command id); all start with ``__$``.
    """
    schema = getattr(df_or_schema, "schema", df_or_schema)
    return [f.name for f in schema.fields if f.name != TABLE_NAME and not f.name.startswith(CAPTURE_PREFIX)]


def q(name: str) -> str:
    """Back-quote a column name for use in a SQL expression string."""
    return "`" + name.replace("`", "``") + "`"

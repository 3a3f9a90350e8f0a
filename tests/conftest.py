import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tidemark.schema import OPERATION, SEQVAL, START_LSN, TABLE_NAME  # noqa: E402
from tidemark.session import checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidemark-test-")


def b10(n: int) -> bytearray:
    """10-byte big-endian value."""
    return bytearray(n.to_bytes(10, "big"))


LOG_SCHEMA = T.StructType(
    [
        T.StructField(TABLE_NAME, T.StringType()),
        T.StructField(START_LSN, T.BinaryType()),
        T.StructField(SEQVAL, T.BinaryType()),
        T.StructField(OPERATION, T.IntegerType()),
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
    ]
)


def make_log(spark, rows):
    """rows: (table, lsn:int|bytes, seq:int|bytes, op, id, name)."""
    conv = lambda v: b10(v) if isinstance(v, int) else (bytearray(v) if v is not None else None)
    return spark.createDataFrame([(t, conv(l), conv(s), op, i, n) for t, l, s, op, i, n in rows], LOG_SCHEMA)


OFFSETS_ROWS_SCHEMA = "table_name string, last_lsn binary, updated_at timestamp_ntz, last_seq binary"

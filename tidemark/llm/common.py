"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Word separators of every word-based operator: space and the ASCII controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"


ARROW_BATCH = "8m"            # bytes of an Arrow batch, about


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Only a local-mode session without one (tests) gets a scratch folder.  Every
    operator passes here before it runs, so this also keeps Arrow batches of
    long texts small: buffers of the default size stay with the Python workers
    and the JVM after use.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        where = sc.getConf().get("spark.checkpoint.dir", None)
        if not where:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="tidemark-llm-")
        sc.setCheckpointDir(where)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


BROADCAST_ROWS = 200_000


def counted_broadcast(df: DataFrame) -> DataFrame:
    """Hints a broadcast of a narrow checkpointed table that is counted to be small; else leaves the join to AQE."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of plans that checkpoints have replaced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that this library wrote."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def trim_memory() -> None:
    """Gives a Python worker's freed memory back: Spark reuses workers, and they keep what a task once took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` whose workers give their memory back when a partition ends."""

    def trimmed(batches):
        try:
            yield from run(batches)
        finally:
            trim_memory()

    return df.mapInArrow(trimmed, schema)


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def remainder_of_id(doc_id: Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def sqrt_buckets(n_rows: Column, width: int = 16) -> Column:
    """Buckets to cut a key of ``n_rows`` rows into: the square root of n/width, at least one.

    Rows per bucket and buckets per key then both grow with the root of the
    key's rows, so neither level of a two-level scan meets a long group.
    """
    return F.greatest(F.lit(1), F.ceil(F.sqrt(n_rows / F.lit(float(width))))).cast("long")


def text_list(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; NULL becomes empty."""
    return [t or "" for t in column.to_pylist()]


def small_batches(batches, limit_bytes: int = 8 << 20, column: str = "text"):
    """Slices of Arrow batches that hold about ``limit_bytes`` of ``column`` each (one row at least)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0)).astype(np.int64)
        group = (np.cumsum(sizes) - sizes) // limit_bytes
        cuts = np.flatnonzero(np.diff(group)) + 1
        start = 0
        for end in [*cuts.tolist(), b.num_rows]:
            yield b.slice(start, end - start)
            start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public constants of SplitMix64) over a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (``TIDEMARK_TOKENIZERS`` overrides the installed folder)."""
    folder = os.environ.get("TIDEMARK_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def summed_blocks(parts: DataFrame, key: str) -> DataFrame:
    """Sums equal-length float64 vectors, kept as binary, by ``(key, block)``.

    ``parts`` has one row per task, key and block, so a group holds as many
    rows as there were tasks, whatever the data.
    """
    schema = T.StructType([T.StructField(key, field_type(parts, key)), T.StructField("block", T.IntegerType()), T.StructField("total", T.BinaryType())])

    def add(group: pa.Table) -> pa.Table:
        rows = sorted(group.column("total").to_pylist())  # an order of their own: reruns agree to the last bit
        total = np.sum([np.frombuffer(r, dtype=np.float64) for r in rows], axis=0)
        return pa.table([group.column(key).slice(0, 1), group.column("block").slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=schema.names)

    return parts.groupBy(key, "block").applyInArrow(add, schema)


def blocks_of(vector: np.ndarray, n_blocks: int) -> list[bytes]:
    return [np.ascontiguousarray(p, dtype=np.float64).tobytes() for p in np.split(vector, n_blocks)]

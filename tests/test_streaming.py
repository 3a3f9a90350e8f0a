import datetime as dt

from pyspark.sql import functions as F

from conftest import LOG_SCHEMA, OFFSETS_ROWS_SCHEMA, b10, make_log
from tidemark.operators.cursor import resume_cursor
from tidemark.streaming.stream import (
    published_high_water,
    published_stream,
    read_change_stream,
    save_stream_offsets,
    start_text_feed,
)

T0 = dt.datetime(2024, 1, 1)


def _write(spark, path, rows):
    make_log(spark, rows).coalesce(1).write.mode("append").parquet(path)


def _ids(spark, out):
    df = spark.read.text(out)
    return sorted(int(r.i) for r in df.select(F.get_json_object("value", "$.data.id").alias("i")).collect())


def _run(spark, src, out, ckpt, cursor=None, fmt="text"):
    s = read_change_stream(spark, src, LOG_SCHEMA, tables=["t"], max_files_per_trigger=1)
    q = start_text_feed(published_stream(s, cursor, 1), out, ckpt, fmt=fmt)
    q.awaitTermination(120)
    assert q.exception() is None


def test_available_now_then_incremental(spark, scratch):
    src, out, ckpt = f"{scratch}/log", f"{scratch}/out", f"{scratch}/ckpt"
    _write(spark, src, [("t", i, i, 2, i, "a") for i in range(1, 6)] + [("t", 6, 6, 3, 6, "before")])
    _write(spark, src, [("t", i, i, 2, i, "b") for i in range(6, 9)])
    _run(spark, src, out, ckpt)
    assert _ids(spark, out) == list(range(1, 9))
    _run(spark, src, out, ckpt)  # nothing new: nothing written again
    assert _ids(spark, out) == list(range(1, 9))
    _write(spark, src, [("t", 20, 20, 4, 20, "c")])
    _run(spark, src, out, ckpt)
    assert _ids(spark, out) == list(range(1, 9)) + [20]
    hw = published_high_water(spark, out).first()
    assert bytes(hw.lsn) == bytes(b10(20)) and bytes(hw.seq) == bytes(b10(20))


def test_strict_cursor_drops_late_rows(spark, scratch):
    src, out, ckpt = f"{scratch}/log", f"{scratch}/out", f"{scratch}/ckpt"
    _write(spark, src, [("t", i, i, 2, i, "a") for i in range(1, 11)])
    offs = spark.createDataFrame([("t", b10(7), T0, b10(7))], OFFSETS_ROWS_SCHEMA)
    static_log = spark.read.parquet(src)
    cur = resume_cursor(spark, ["t"], offs, static_log)
    _write(spark, src, [("t", 3, 3, 2, 103, "late"), ("t", 12, 12, 2, 12, "new")])
    _run(spark, src, out, ckpt, cursor=cur)
    assert _ids(spark, out) == [8, 9, 10, 12]
    merged = {r.table_name: r for r in save_stream_offsets(spark, out, offs, F.lit(T0)).collect()}
    assert bytes(merged["t"].last_lsn) == bytes(b10(12))


def test_parquet_feed_high_water_from_key_columns(spark, scratch):
    src, out, ckpt = f"{scratch}/log", f"{scratch}/out", f"{scratch}/ckpt"
    _write(spark, src, [("t", i, i, 2, i, "a") for i in range(1, 9)] + [("t", 9, 9, 3, 9, "before")])
    _run(spark, src, out, ckpt, fmt="parquet")
    pub = spark.read.parquet(out)
    assert sorted(pub.columns) == ["lsn", "operation", "seq", "table_name", "value"]
    assert pub.count() == 8
    hw = published_high_water(spark, out, "parquet").first()
    assert bytes(hw.lsn) == bytes(b10(8)) and bytes(hw.seq) == bytes(b10(8))


def test_failed_micro_batch_is_replayed(spark, scratch):
    from pyspark.sql import types as T

    from tidemark.schema import OPERATION, SEQVAL, START_LSN, TABLE_NAME

    schema = T.StructType([
        T.StructField(TABLE_NAME, T.StringType()), T.StructField(START_LSN, T.BinaryType()),
        T.StructField(SEQVAL, T.BinaryType()), T.StructField(OPERATION, T.IntegerType()),
        T.StructField("id", T.LongType()), T.StructField("amount", T.DoubleType()),
    ])
    src, ckpt, out = f"{scratch}/log", f"{scratch}/ckpt", f"{scratch}/out"
    rows = [("t", b10(i), b10(i), 2, i, 1.5) for i in range(1, 10)] + [("t", b10(10), b10(10), 2, 10, 1e40)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(src)

    def run(broken):
        p = published_stream(read_change_stream(spark, src, schema, tables=["t"]), None, 1)
        if broken:
            bad = F.get_json_object("value", "$.data.id") == "10"
            p = p.withColumn("value", F.when(bad, F.raise_error(F.lit("sink down")).cast("string")).otherwise(F.col("value")))
        q = start_text_feed(p, out, ckpt)
        try:
            q.awaitTermination(120)
        except Exception:
            pass
        return q

    # one row fails: the micro-batch fails and nothing is committed
    assert run(True).exception() is not None
    # the restarted query replays the same batch from the same source offsets
    assert run(False).exception() is None
    assert _ids(spark, out) == list(range(1, 11))


def test_micro_batch_handler_strict_drain_and_replay(spark, scratch):
    import pytest

    from tidemark.operators.offsets import OffsetStore
    from tidemark.plans.cycle import json_lines_publisher
    from tidemark.streaming.stream import micro_batch_handler

    store = OffsetStore(spark, f"{scratch}/offsets")
    out = f"{scratch}/out"
    handle = micro_batch_handler(["t", "u"], store, json_lines_publisher(out), mode="drain", buckets=2)
    # micro-batch 0: 120 wide rows of t (batch size 50) and 3 rows of u
    b0 = make_log(spark, [("t", i, i, 2, i, "x" * 9000) for i in range(1, 121)] + [("u", i, 500 + i, 2, i, "u") for i in range(1, 4)])
    handle(b0, 0)
    assert store.latest_version() == 1
    # micro-batch 1: a late row of t below its cursor (dropped) and new rows
    b1 = make_log(spark, [("t", 5, 5, 2, 1005, "late"), ("t", 200, 200, 2, 200, "new"), ("u", 9, 900, 2, 9, "u")])
    handle(b1, 1)
    ids = spark.read.text(out).select("table_name", F.get_json_object("value", "$.data.id").cast("int").alias("id"))
    got = sorted((r.table_name, r.id) for r in ids.collect())
    assert got == sorted([("t", i) for i in range(1, 121)] + [("t", 200)] + [("u", i) for i in (1, 2, 3, 9)])
    # a failing publish raises (the stream would replay) and leaves the offsets alone
    bad = micro_batch_handler(["t"], store, lambda df, i: False)
    with pytest.raises(RuntimeError):
        bad(make_log(spark, [("t", 300, 300, 2, 300, "x")]), 2)
    assert store.latest_version() == 2

import os
import subprocess
import sys

from pyspark.sql import functions as F

from conftest import make_log
from tidemark.sources.changelog import discover_columns, read_change_log

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_merge_schema_discovers_added_columns(spark, scratch):
    old = make_log(spark, [("t", 1, 1, 2, 1, "a")]).drop("name")
    new = make_log(spark, [("t", 2, 2, 2, 2, "b")])
    old.write.parquet(f"{scratch}/log/part=1")
    new.write.parquet(f"{scratch}/log/part=2")
    df = read_change_log(spark, f"{scratch}/log", ["t"], merge_schema=True)
    assert set(discover_columns(df)) >= {"id", "name"}
    assert df.where(F.col("name").isNull()).count() == 1


def test_job_poll_then_drain(spark, scratch):
    rows = [("t", i, i, 2, i, "x" * 9000) for i in range(1, 121)] + [("u", i, 500 + i, 1, i, None) for i in range(1, 8)]
    make_log(spark, rows).write.partitionBy("table_name").parquet(f"{scratch}/log")
    env = dict(os.environ, PYTHONPATH=REPO, BENCH_CPUS="2")
    base = [sys.executable, "-m", "tidemark"]
    args = ["--log", f"{scratch}/log", "--tables", "t,u", "--offsets", f"{scratch}/offsets", "--out", f"{scratch}/out"]
    subprocess.run(base + ["poll", *args, "--cycles", "1", "--poll-seconds", "0"], check=True, env=env, timeout=600, capture_output=True)
    subprocess.run(base + ["drain", *args], check=True, env=env, timeout=600, capture_output=True)
    out = spark.read.text(f"{scratch}/out")
    ids = out.select(F.col("table_name"), F.get_json_object("value", "$.data.id").cast("int").alias("id"))
    got = sorted((r.table_name, r.id) for r in ids.collect())
    assert got == sorted([("t", i) for i in range(1, 121)] + [("u", i) for i in range(1, 8)])


def test_written_log_skips_row_groups_before_the_cursor(spark, scratch):
    from tidemark.operators.cursor import changes_after
    from tidemark.sources.changelog import write_change_log

    rows = [("t", i, i, 2, i, "x") for i in range(1, 20001)]
    write_change_log(make_log(spark, rows), f"{scratch}/log", files_per_write=8)
    log = read_change_log(spark, f"{scratch}/log", ["t"])
    cur = {"t": ((19990).to_bytes(10, "big"), (19990).to_bytes(10, "big"))}
    after = changes_after(log, cur)
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "__$start_lsn" in plan
    assert after.count() == 10
    # the files hold disjoint, ordered LSN ranges, so most can be skipped by statistics
    files = sorted(log.inputFiles())
    assert len(files) == 8


def test_job_stream_parquet(spark, scratch):
    rows = [("t", i, i, 2, i, "x") for i in range(1, 30)] + [("t", 40, 40, 3, 40, "before")]
    make_log(spark, rows).write.parquet(f"{scratch}/log")
    env = dict(os.environ, PYTHONPATH=REPO, BENCH_CPUS="2")
    cmd = [sys.executable, "-m", "tidemark", "stream", "--log", f"{scratch}/log", "--tables", "t",
           "--out", f"{scratch}/out", "--checkpoint", f"{scratch}/ckpt", "--format", "parquet"]
    subprocess.run(cmd, check=True, env=env, timeout=600, capture_output=True)
    out = spark.read.parquet(f"{scratch}/out")
    assert out.count() == 29 and out.where(F.col("operation") == 3).count() == 0


def test_catalog_columns(spark):
    from tidemark.sources.changelog import catalog_columns

    make_log(spark, [("t", 1, 1, 2, 1, "a")]).createOrReplaceTempView("cdc_t_view")
    assert catalog_columns(spark, "cdc_t_view") == ["id", "name"]


def test_jdbc_lsn_range_predicates():
    import pytest

    from tidemark.sources.changelog import lsn_range_predicates

    p = lsn_range_predicates([("00000000000000000000", "00000000000000001000"), ("00000000000000001000", "ffffffffffffffffffff")])
    assert p == ["[__$start_lsn] >= 0x00000000000000000000 AND [__$start_lsn] < 0x00000000000000001000",
                 "[__$start_lsn] >= 0x00000000000000001000 AND [__$start_lsn] < 0xffffffffffffffffffff"]
    with pytest.raises(ValueError):
        lsn_range_predicates([("00", "10"), ("08", "20")])
    with pytest.raises(ValueError):
        lsn_range_predicates([("0x; DROP TABLE t", "10")])
    # bytes, not text, and an open end
    assert lsn_range_predicates([("0B", None), ("0a", "0b")]) == ["[__$start_lsn] >= 0x0a AND [__$start_lsn] < 0x0b", "[__$start_lsn] >= 0x0b"]
    with pytest.raises(ValueError):
        lsn_range_predicates([("0A", None), ("0b", "0c")])


def test_grouped_cursor_scans_on_a_partitioned_log(spark, scratch):
    from tidemark.operators.cursor import changes_after
    from tidemark.sources.changelog import write_change_log

    tables = [f"t{k}" for k in range(10)]
    rows = [(t, i, i, 2, i, "x") for t in tables for i in range(1, 201)]
    write_change_log(make_log(spark, rows), f"{scratch}/log", files_per_write=4)
    log = read_change_log(spark, f"{scratch}/log", tables)
    # t0 is quiet with an old cursor; the others are near the end
    cur = {t: ((190).to_bytes(10, "big"), (190).to_bytes(10, "big")) for t in tables}
    cur["t0"] = ((5).to_bytes(10, "big"), (5).to_bytes(10, "big"))
    after = changes_after(log, cur)
    assert after.count() == 195 + 9 * 10
    plan = after._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") >= 1


def _job(*args):
    env = dict(os.environ, PYTHONPATH=REPO, BENCH_CPUS="2")
    return subprocess.run([sys.executable, "-m", "tidemark", *args], env=env, timeout=600, capture_output=True, text=True)


def test_job_polls_past_idle_and_many_saves(spark, scratch):
    rows = [("t", i, i, 2, i, "x" * 9000) for i in range(1, 301)] + [("quiet", 1, 1, 2, 1, "q")]
    make_log(spark, rows).write.partitionBy("table_name").parquet(f"{scratch}/log")
    args = ["--log", f"{scratch}/log", "--tables", "t,quiet", "--offsets", f"{scratch}/offsets", "--out", f"{scratch}/out"]
    r = _job("poll", *args, "--cycles", "9", "--poll-seconds", "0")
    assert r.returncode == 0, r.stderr[-2000:]
    assert r.stderr.count("published rows=0") >= 2  # idle polls do not end the run
    out = spark.read.text(f"{scratch}/out").select("table_name", F.get_json_object("value", "$.data.id").cast("int").alias("id"))
    assert sorted((x.table_name, x.id) for x in out.collect()) == sorted([("t", i) for i in range(1, 301)] + [("quiet", 1)])


def test_job_ends_with_an_error_when_publishing_fails(spark, scratch):
    make_log(spark, [("t", 1, 1, 2, 1, "x")]).write.partitionBy("table_name").parquet(f"{scratch}/log")
    open(f"{scratch}/out", "w").write("a file where the output folder should be")
    r = _job("drain", "--log", f"{scratch}/log", "--tables", "t", "--offsets", f"{scratch}/offsets", "--out", f"{scratch}/out",
             "--poll-seconds", "0", "--retries", "2")
    assert r.returncode == 1 and "publishing 1 changes failed" in r.stderr
    assert not os.path.exists(f"{scratch}/offsets")


def test_job_stream_reads_every_log_after_the_saved_cursor(spark, scratch):
    from conftest import b10
    from tidemark.operators.offsets import OffsetStore

    make_log(spark, [("t", i, i, 2, i, "x") for i in range(1, 30)]).write.parquet(f"{scratch}/a/part=1")
    make_log(spark, [("t", 30, 30, 2, 30, "x")]).withColumn("added", F.lit("new")).write.parquet(f"{scratch}/a/part=2")
    make_log(spark, [("z", i, i, 2, i, "x") for i in range(1, 8)]).drop("name").write.parquet(f"{scratch}/b")
    store = OffsetStore(spark, f"{scratch}/offsets")
    store.write(spark.createDataFrame([("t", b10(20), None, b10(20))], "table_name string, last_lsn binary, updated_at timestamp_ntz, last_seq binary"))
    r = _job("stream", "--log", f"{scratch}/a", "--log", f"{scratch}/b", "--tables", "t,z", "--out", f"{scratch}/out",
             "--checkpoint", f"{scratch}/ckpt", "--offsets", f"{scratch}/offsets")
    assert r.returncode == 0, r.stderr[-2000:]
    out = spark.read.text(f"{scratch}/out").select("table_name", "value").collect()
    assert sorted(x.table_name for x in out) == ["t"] * 10 + ["z"] * 7
    assert sum('"added":"new"' in x.value for x in out) == 1
    assert {x.table_name: int.from_bytes(x.last_lsn, "big") for x in store.read().collect()} == {"t": 30, "z": 7}

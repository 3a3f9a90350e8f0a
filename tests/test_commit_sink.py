"""The sink that commits lines and offsets together."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import LOG_SCHEMA, make_log
from tidemark.plans.cycle import run_committed_cycle
from tidemark.schema import SEQVAL, START_LSN, TABLE_NAME
from tidemark.sources.commit_sink import FORMAT, CommittedFeed, FeedWriter, Staged
from tidemark.streaming.stream import published_stream, read_change_stream

LINE_COLUMNS = [TABLE_NAME, START_LSN, SEQVAL, "value"]


def _log(spark, rows=None):
    return make_log(spark, rows or [("t", i, i, 2, i, "x" * 9000) for i in range(1, 121)] + [("a/b=c", i, i, 2, 900 + i, "y") for i in range(1, 4)])


def _ids(spark, out):
    if not any(n.startswith("cycle=") for n in os.listdir(out)):
        return []
    return sorted(int(r.i) for r in spark.read.text(out).select(F.get_json_object("value", "$.data.id").alias("i")).collect())


def _ends(feed):
    return {r.table_name: int.from_bytes(r.last_lsn, "big") for r in feed.read().collect()}


def test_lines_and_offsets_are_one_commit(spark, scratch):
    out = f"{scratch}/out"
    log, tables = _log(spark), ["t", "a/b=c"]
    feed = CommittedFeed(spark, out)
    assert feed.latest_cycle() is None and feed.read().count() == 0
    r = run_committed_cycle(spark, [log], tables, out)  # 50 wide rows of t, 3 of the other
    assert r.published and r.rows == 53 and _ends(feed) == {"t": 50, "a/b=c": 3}
    assert run_committed_cycle(spark, [log], tables, out, mode="drain").rows == 70
    assert run_committed_cycle(spark, [log], tables, out).rows == 0
    assert _ids(spark, out) == [*range(1, 121), 901, 902, 903] and _ends(feed) == {"t": 120, "a/b=c": 3}
    assert {r[0] for r in spark.read.text(out).select(TABLE_NAME).distinct().collect()} == set(tables)
    first = [line for f in sorted(os.listdir(f"{out}/cycle=2/table_name=t")) for line in open(f"{out}/cycle=2/table_name=t/{f}")]
    assert len(first) == 70


def test_a_task_that_dies_in_the_middle_leaves_no_line(spark, scratch):
    out = f"{scratch}/out"
    feed = CommittedFeed(spark, out)
    lines = _log(spark).withColumn("value", F.concat(F.lit('{"data":{"id":"'), F.col("id"), F.lit('"}}')))
    feed.commit(lines.where("id <= 5").select(*LINE_COLUMNS), 1, feed.read())

    def die(batches):
        for k, b in enumerate(batches):
            yield b
            if k == 1:
                os._exit(9)  # the worker is gone, as with a lost executor

    dying = lines.select(*LINE_COLUMNS).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        with pytest.raises(Exception):
            feed.commit(dying.mapInArrow(die, dying.schema), 2, feed.read())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    bad = F.when(F.col("id") == 100, F.raise_error(F.lit("sink down")).cast("string")).otherwise(F.col("value"))
    with pytest.raises(Exception):
        feed.commit(lines.withColumn("value", bad).select(*LINE_COLUMNS), 2, feed.read())
    assert feed.latest_cycle() == 1 and _ids(spark, out) == [1, 2, 3, 4, 5] and _ends(feed) == {"t": 5}
    feed.sweep()  # tasks that outlived the abort may have left a hidden file
    assert sorted(os.listdir(out)) == ["cycle=1"]


def test_failed_cycle_is_published_once_when_it_succeeds(spark, scratch, monkeypatch):
    out, log = f"{scratch}/out", _log(spark)
    whole = CommittedFeed.commit
    monkeypatch.setattr(CommittedFeed, "commit", lambda self, lines, n, offs: whole(self, lines.withColumn("value", F.raise_error(F.lit("down")).cast("string")), n, offs))
    r = run_committed_cycle(spark, [log], ["t"], out, mode="drain")
    assert not r.published and r.rows == 120 and "down" in str(r.error)
    monkeypatch.undo()
    assert run_committed_cycle(spark, [log], ["t"], out, mode="drain").offsets_version == 1
    assert _ids(spark, out) == list(range(1, 121))


def test_a_committed_cycle_is_not_committed_again(spark, scratch):
    out = f"{scratch}/out"
    feed = CommittedFeed(spark, out)
    lines = make_log(spark, [("t", 1, 1, 2, 1, "x")]).withColumn("value", F.lit('{"data":{"id":"1"}}')).select(*LINE_COLUMNS)
    feed.commit(lines, 1, feed.read())
    with pytest.raises(Exception, match="committed already"):
        feed.commit(lines, 1, feed.read())
    assert _ids(spark, out) == [1]


def test_files_of_doubled_attempts_are_not_gathered(scratch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array(["a", "a", None, "b"]), pa.array([b"\1", b"\2", b"\3", b"\4"], pa.binary()), pa.array([b"\1", None, b"\1", b"\1"], pa.binary()), pa.array(["1", "2", "3", None])],
        names=LINE_COLUMNS,
    )
    w = FeedWriter({"path": scratch, "cycle": "7", "offsets": '{"quiet": [null, null], "b": ["ff", "00"]}'})
    w.write(iter([batch]))  # an attempt whose message never came
    w.commit([w.write(iter([batch, batch.slice(0, 2)])), None, Staged([], {}, 0)])
    lines = sorted(line for d, _, fs in os.walk(f"{scratch}/cycle=7") for f in fs if f.endswith(".txt") for line in open(f"{d}/{f}"))
    assert lines == ["1\n", "1\n", "2\n", "2\n", "3\n"]
    import json

    kept = json.load(open(f"{scratch}/cycle=7/_offsets.json"))
    assert kept == {"offsets": {"quiet": [None, None], "b": ["ff", "00"], "a": ["02", ""]}, "rows": 6}


def test_stream_batches_are_committed_once(spark, scratch):
    src, out, ckpt = f"{scratch}/log", f"{scratch}/out", f"{scratch}/ckpt"
    feed = CommittedFeed(spark, out)
    for low in (11, 1):
        make_log(spark, [("t", i, i, 2, i, "a") for i in range(low, low + 10)]).coalesce(1).write.mode("append").parquet(src)

    def run(checkpoint):
        s = published_stream(read_change_stream(spark, src, LOG_SCHEMA, ["t"], 1))
        lines = s.select(TABLE_NAME, F.unhex("lsn").alias(START_LSN), F.unhex("seq").alias(SEQVAL), "value")
        q = lines.writeStream.format(FORMAT).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        q.awaitTermination(120)
        assert q.exception() is None

    run(ckpt)
    assert _ids(spark, out) == list(range(1, 21)) and feed.latest_cycle() == 1
    run(f"{scratch}/other")  # the same batches once more, as after a crash before Spark noted them
    assert _ids(spark, out) == list(range(1, 21))


def test_job_with_atomic_sink(spark, scratch):
    from test_job import _job

    _log(spark).write.partitionBy(TABLE_NAME).parquet(f"{scratch}/log")
    r = _job("drain", "--log", f"{scratch}/log", "--tables", "t", "--out", f"{scratch}/out", "--atomic")
    assert r.returncode == 0, r.stderr[-2000:]
    assert _ids(spark, f"{scratch}/out") == list(range(1, 121))

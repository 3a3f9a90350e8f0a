import datetime as dt

from pyspark.sql import functions as F

from conftest import OFFSETS_ROWS_SCHEMA, b10, make_log
from tidemark.operators.offsets import OffsetStore, merge_offsets, upgrade_offsets
from tidemark.plans.cycle import cycle_changes, json_lines_publisher, run_cycle

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 2, 3, 4, 5)


def test_upgrade_adds_last_seq_and_keeps_values(spark):
    old = spark.createDataFrame([("t", b10(5), T0)], "table_name string, last_lsn binary, updated_at timestamp_ntz")
    up = upgrade_offsets(old)
    assert up.columns == ["table_name", "last_lsn", "updated_at", "last_seq"]
    r = up.first()
    assert r.last_seq is None and bytes(r.last_lsn) == bytes(b10(5)) and r.updated_at == T0


def test_merge_updates_inserts_and_keeps(spark):
    offs = spark.createDataFrame([("a", b10(1), T0, b10(1)), ("b", b10(2), T0, b10(2))], OFFSETS_ROWS_SCHEMA)
    upd = spark.createDataFrame([("a", b10(9), b10(9)), ("a", b10(9), b10(8)), ("c", b10(3), b10(3))],
                                "table_name string, lsn binary, seq binary")
    m = {r.table_name: r for r in merge_offsets(offs, upd, F.lit(T1)).collect()}
    assert set(m) == {"a", "b", "c"}
    assert bytes(m["a"].last_seq) == bytes(b10(9)) and m["a"].updated_at == T1
    assert m["b"].updated_at == T0 and bytes(m["b"].last_lsn) == bytes(b10(2))
    assert m["c"].updated_at == T1


def test_offset_store_versions(spark, scratch):
    store = OffsetStore(spark, f"{scratch}/offsets")
    assert store.read().count() == 0 and store.latest_version() is None
    old = spark.createDataFrame([("t", b10(5), T0)], "table_name string, last_lsn binary, updated_at timestamp_ntz")
    assert store.write(old) == 1
    r = store.read().collect()
    assert len(r) == 1 and r[0].last_seq is None
    new = spark.createDataFrame([("t", b10(6), T1, b10(6))], OFFSETS_ROWS_SCHEMA)
    assert store.write(new) == 2
    r = store.read().collect()
    assert len(r) == 1 and bytes(r[0].last_lsn) == bytes(b10(6))


def _log(spark):
    rows = [("t", i // 3 + 1, i, 2, i, f"n{i}") for i in range(1, 26)]
    rows += [("u", i + 1, 100 + i, 2 if i % 2 else 1, i, None) for i in range(7)]
    rows += [("t", 50, 500, 3, 99, "before-image")]
    return make_log(spark, rows)


def test_failed_publish_keeps_offsets_and_replays(spark, scratch):
    log = _log(spark)
    store = OffsetStore(spark, f"{scratch}/offsets")
    calls = []

    def failing(batch, cycle_id):
        calls.append(batch.count())
        raise RuntimeError("sink down")

    r = run_cycle(spark, [log], ["t", "u"], store, failing, cycle_id=1, sample_size=5)
    assert not r.published and r.offsets_version is None and store.latest_version() is None
    out = f"{scratch}/out"
    r2 = run_cycle(spark, [log], ["t", "u"], store, json_lines_publisher(out), cycle_id=2, now=T1)
    assert r2.published and r2.rows == calls[0] and r2.offsets_version == 1
    # everything was published in one poll (sizes are 1000); the next cycle reads nothing
    r3 = run_cycle(spark, [log], ["t", "u"], store, json_lines_publisher(out), cycle_id=3)
    assert r3.rows == 0
    lines = spark.read.text(out).where(F.col("cycle") == 2)
    assert lines.count() == 25 + 7


def test_poll_cycles_walk_the_backlog(spark, scratch):
    rows = [("t", i, i, 2, i, "x" * 9000) for i in range(1, 131)]  # wide rows -> batch size 50
    log = make_log(spark, rows)
    store = OffsetStore(spark, f"{scratch}/offsets")
    out = f"{scratch}/out"
    seen = []
    for c in range(4):
        r = run_cycle(spark, [log], ["t"], store, json_lines_publisher(out), cycle_id=c, now=T1)
        seen.append(r.rows)
    assert seen == [50, 50, 30, 0]
    ids = spark.read.text(out).select(F.get_json_object("value", "$.data.id").cast("int").alias("id"))
    assert sorted(r.id for r in ids.collect()) == list(range(1, 131))


def test_drain_mode_numbers_batches(spark):
    rows = [("t", i, i, 2, i, "x" * 9000) for i in range(1, 131)]
    offs = spark.createDataFrame([], OFFSETS_ROWS_SCHEMA)
    d = cycle_changes(spark, [make_log(spark, rows)], ["t"], offs, mode="drain", buckets=3)
    counts = sorted((r.batch_no, r["count"]) for r in d.groupBy("batch_no").count().collect())
    assert counts == [(0, 50), (1, 50), (2, 30)]


def test_offset_store_ignores_a_partial_version(spark, scratch):
    from pyspark.sql import functions as F

    store = OffsetStore(spark, f"{scratch}/offsets", slots=3)
    two = spark.createDataFrame([("t", b10(1), T0, b10(1)), ("u", b10(1), T0, b10(1))], OFFSETS_ROWS_SCHEMA)
    assert store.write(two) == 1
    assert store.write(two.withColumn("last_lsn", F.lit(bytearray(b10(2))))) == 2
    # a save of version 3 that crashed after writing one of its two rows
    partial = spark.createDataFrame([("t", b10(9), T1, b10(9))], OFFSETS_ROWS_SCHEMA)
    partial.withColumn("version", F.lit(3).cast("long")).withColumn("n_rows", F.lit(2).cast("long")) \
        .write.mode("overwrite").parquet(f"{scratch}/offsets/slot=0")
    assert store.latest_version() == 2
    assert {bytes(r.last_lsn) for r in store.read().collect()} == {bytes(b10(2))}
    # the next save takes version 3 again and replaces the partial one
    assert store.write(partial) == 3 and store.read().count() == 1


def test_offset_store_stays_bounded(spark, scratch):
    import os

    store = OffsetStore(spark, f"{scratch}/offsets", slots=3)
    for i in range(1, 8):
        store.write(spark.createDataFrame([("t", b10(i), T0, b10(i))], OFFSETS_ROWS_SCHEMA))
    assert store.latest_version() == 7 and bytes(store.read().first().last_lsn) == bytes(b10(7))
    assert sorted(d for d in os.listdir(f"{scratch}/offsets") if d.startswith("slot=")) == ["slot=0", "slot=1", "slot=2"]


def test_interleaved_saves_of_two_jobs_keep_both_tables(spark, scratch):
    """Each store saves from what it read before the other saved."""
    a, b = OffsetStore(spark, f"{scratch}/offsets"), OffsetStore(spark, f"{scratch}/offsets")
    for i in range(1, 26):
        frames = [(s, t, s.read()) for s, t in ((a, "t1"), (b, "t2"))]
        for s, t, before in frames:
            up = spark.createDataFrame([(t, b10(i), b10(i))], "table_name string, lsn binary, seq binary")
            s.write(merge_offsets(before, up, T1))
    got = {r.table_name: bytes(r.last_lsn) for r in OffsetStore(spark, f"{scratch}/offsets").read().collect()}
    assert got == {"t1": bytes(b10(25)), "t2": bytes(b10(25))}
    assert a.latest_version() == 50


def test_saves_at_the_same_time_take_different_versions(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    def job(t):
        store, versions = OffsetStore(spark, f"{scratch}/offsets"), []
        for i in range(1, 7):
            up = spark.createDataFrame([(t, b10(i), b10(i))], "table_name string, lsn binary, seq binary")
            versions.append(store.write(merge_offsets(store.read(), up, T1)))
        return versions

    tables = ["t1", "t2", "t3"]
    with ThreadPoolExecutor(3) as pool:
        versions = [v for vs in pool.map(job, tables) for v in vs]
    assert sorted(versions) == list(range(1, 19))
    store = OffsetStore(spark, f"{scratch}/offsets")
    assert {r.table_name: bytes(r.last_lsn) for r in store.read().collect()} == {t: bytes(b10(6)) for t in tables}


def test_a_save_that_comes_too_late_does_not_count(spark, scratch):
    from tidemark.sources.files import Folder

    store = OffsetStore(spark, f"{scratch}/offsets", slots=2)
    for i in (1, 2, 3):
        store.write(spark.createDataFrame([("t", b10(i), T0, b10(i))], OFFSETS_ROWS_SCHEMA))
    # version 1 came and went; a job that still holds it open may not take it
    assert not store._commit(Folder(spark, store.root), 1, [("late", b10(9), T0, b10(9))])
    assert store.latest_version() == 3 and {r.table_name for r in store.read().collect()} == {"t"}


def test_a_taken_version_is_not_replaced(spark, scratch):
    """The file of a version is published once, whoever comes second."""
    from tidemark.sources.files import Folder

    folder = Folder(spark, f"{scratch}/f")
    for k in (1, 2):
        spark.range(k).coalesce(1).write.parquet(f"{scratch}/f/_aside{k}")
    part = {k: next(n for n in folder.names(f"_aside{k}") if n.startswith("part-")) for k in (1, 2)}
    assert folder.publish(f"_aside1/{part[1]}", "x/v1") and not folder.publish(f"_aside2/{part[2]}", "x/v1")
    assert spark.read.parquet(f"{scratch}/f/x/v1").count() == 1 and folder.names("missing") == []


def test_batch_sizer_resamples_after_interval(spark, scratch):
    from tidemark.operators.batching import BatchSizer

    rows = [("t", i, i, 2, i, "x" * 9000) for i in range(1, 131)]
    log = make_log(spark, rows)
    store = OffsetStore(spark, f"{scratch}/offsets")
    sizer = BatchSizer(resample_seconds=3600)
    out = f"{scratch}/out"
    t = dt.datetime(2024, 1, 1, 0, 0, 0)
    r1 = run_cycle(spark, [log], ["t"], store, json_lines_publisher(out), 1, now=t, sizer=sizer)
    r2 = run_cycle(spark, [log], ["t"], store, json_lines_publisher(out), 2, now=t + dt.timedelta(minutes=30), sizer=sizer)
    assert (r1.rows, r2.rows, sizer.samples) == (50, 50, 1)
    run_cycle(spark, [log], ["t"], store, json_lines_publisher(out), 3, now=t + dt.timedelta(minutes=61), sizer=sizer)
    assert sizer.samples == 2 and sizer.sizes == {"t": 50}


def test_failed_read_keeps_offsets(spark, scratch):
    import pytest

    store = OffsetStore(spark, f"{scratch}/offsets")
    first = spark.createDataFrame([("t", b10(3), T0, b10(3))], OFFSETS_ROWS_SCHEMA)
    store.write(first)

    class Broken:
        def __getattr__(self, name):
            raise RuntimeError("change table unreadable")

    with pytest.raises(Exception):
        run_cycle(spark, [Broken()], ["t"], store, json_lines_publisher(f"{scratch}/out"), 1)
    assert store.latest_version() == 1 and bytes(store.read().first().last_lsn) == bytes(b10(3))
    # the next cycle resumes from the same cursor
    log = make_log(spark, [("t", i, i, 2, i, "x") for i in range(1, 6)])
    r = run_cycle(spark, [log], ["t"], store, json_lines_publisher(f"{scratch}/out"), 2, now=T1)
    assert r.rows == 2


def test_published_lines_keep_table_order(spark, scratch):
    import glob
    import json
    import random

    rnd = random.Random(2)
    rows = [("t" if i % 4 else "u", rnd.randrange(1, 500), i + 1, 2, i, "x") for i in range(800)]
    rnd.shuffle(rows)
    log = make_log(spark, rows).repartition(7)
    store = OffsetStore(spark, f"{scratch}/offsets")
    out = f"{scratch}/out"
    run_cycle(spark, [log], ["t", "u"], store, json_lines_publisher(out, files=5), 1, mode="drain", buckets=3)
    for t in ("t", "u"):
        keys = []
        for f in sorted(glob.glob(f"{out}/cycle=1/table_name={t}/part-*")):
            for line in open(f):
                m = json.loads(line)["metadata"]
                keys.append((m["LSN"], m["Seq"]))
        assert len(keys) == sum(1 for r in rows if r[0] == t)
        assert keys == sorted(keys)


def test_helpers_schema_and_keys(spark):
    from pyspark.sql import types as T

    from tidemark.functions.decode import change_struct, to_json_keep_nulls
    from tidemark.operators.batching import batch_metrics, table_batch_sizes
    from tidemark.operators.offsets import has_seq_column
    from tidemark.plans.cycle import published_keys
    from tidemark.plans.feed import decoded_changes, with_change_json
    from tidemark.schema import BATCH_STATS_SCHEMA, OPERATION, SEQVAL, START_LSN
    from tidemark.sources.changelog import change_log_schema, with_system_names

    log = make_log(spark, [("t", 1, 1, 2, 5, None), ("t", 2, 2, 4, 6, "b")])
    # metrics record follows the declared schema
    m = batch_metrics(table_batch_sizes(spark, ["t"], log), "2024-01-01 00:00:00")
    assert [(f.name, f.dataType) for f in m.schema.fields] == [(f.name, f.dataType) for f in BATCH_STATS_SCHEMA.fields]
    # offsets column check
    old = spark.createDataFrame([("t", b10(1), T0)], "table_name string, last_lsn binary, updated_at timestamp_ntz")
    assert not has_seq_column(old) and has_seq_column(upgrade_offsets(old))
    # envelope from the raw log equals the decoded path
    raw = sorted(r[0] for r in log.select(to_json_keep_nulls(change_struct(log))).collect())
    dec = sorted(r[0] for r in with_change_json(decoded_changes(log)).select("change_json").collect())
    assert raw == dec
    # plain system-column names and the declared log schema
    plain = log.withColumnRenamed(START_LSN, "start_lsn").withColumnRenamed(SEQVAL, "seqval").withColumnRenamed(OPERATION, "operation")
    assert with_system_names(plain).columns == log.columns
    src = T.StructType([f for f in log.schema.fields if f.name in ("id", "name")])
    assert [f.name for f in change_log_schema(src).fields] == log.columns
    # de-duplication keys of published rows
    k = published_keys(log).collect()
    assert k[0].lsn == "00000000000000000001" and k[0][OPERATION] == 2


def test_publisher_spreads_a_copy_group_over_files(spark, scratch):
    import glob

    rows = [("t", i, i, 2, i, "x") for i in range(1, 50)] + [("t", 25, 25, 2, 1000 + i, "copy") for i in range(3000)]
    store = OffsetStore(spark, f"{scratch}/offsets")
    out = f"{scratch}/out"
    r = run_cycle(spark, [make_log(spark, rows)], ["t"], store, json_lines_publisher(out, files=6), 1, mode="drain", buckets=3)
    assert r.rows == 49 + 3000
    sizes = [sum(1 for _ in open(f)) for f in glob.glob(f"{out}/cycle=1/table_name=t/part-*")]
    assert sum(sizes) == 3049 and max(sizes) < 3000


def test_envelope_cycles(spark, scratch):
    import glob
    import json

    import pytest

    from tidemark.plans.cycle import envelope_publisher

    rows = [("t", i, i, 2, i, "x" * 9000) for i in range(1, 131)] + [("u", i, 500 + i, 1, i, None) for i in range(1, 8)]
    store = OffsetStore(spark, f"{scratch}/offsets")
    out = f"{scratch}/out"
    log = make_log(spark, rows)
    r = run_cycle(spark, [log], ["t", "u"], store, envelope_publisher(out), 1, mode="drain", envelopes=True, buckets=2)
    assert r.published and r.rows == 137
    seen, sizes = [], []
    for f in sorted(glob.glob(f"{out}/cycle=1/table_name=*/part-*")):
        for line in open(f):
            env = json.loads(line)
            assert set(env) == {"table_name", "server_name", "changes", "metadata"}
            assert env["metadata"]["batch_size"] == len(env["changes"])
            sizes.append(len(env["changes"]))
            seen += [(c["table_name"], c["data"]["id"]) for c in env["changes"]]
    assert sorted(seen) == sorted([("t", str(i)) for i in range(1, 131)] + [("u", str(i)) for i in range(1, 8)])
    assert max(sizes) <= 50
    # offsets moved to the last enveloped change; the next cycle has nothing left
    assert run_cycle(spark, [log], ["t", "u"], store, envelope_publisher(out), 2, mode="drain", envelopes=True).rows == 0
    with pytest.raises(ValueError):
        run_cycle(spark, [log], ["t"], store, envelope_publisher(out), 3, mode="poll", envelopes=True)


def test_twenty_saves_with_a_quiet_table(spark, scratch):
    """The store takes saves without end; every change is published once."""
    rows = [("t", i, i, 2, i, "x" * 9000) for i in range(1, 1001)] + [("quiet", 1, 1, 2, 7, "q")]
    log = make_log(spark, rows).repartition(4)
    store = OffsetStore(spark, f"{scratch}/offsets")
    published = []

    def publish(batch, cycle_id):
        published.extend((r.table_name, r.id) for r in batch.select("table_name", F.get_json_object("change_json", "$.data.id").alias("id")).collect())
        return True

    for c in range(20):
        r = run_cycle(spark, [log], ["t", "quiet"], store, publish, cycle_id=c, now=T1)
        assert r.published and r.offsets_version == c + 1
    assert sorted(published) == sorted([("t", str(i)) for i in range(1, 1001)] + [("quiet", "7")])
    assert {r.table_name for r in store.read().collect()} == {"t", "quiet"}


def test_micro_batches_save_without_end(spark, scratch):
    from tidemark.streaming.stream import micro_batch_handler

    store = OffsetStore(spark, f"{scratch}/offsets")
    seen = []
    handle = micro_batch_handler(["t", "quiet"], store, lambda df, i: bool(seen.append(df.count()) or True), mode="drain", buckets=2)
    handle(make_log(spark, [("quiet", 1, 1, 2, 0, "q"), ("t", 1, 1, 2, 1, "x")]), 0)
    for i in range(1, 8):
        handle(make_log(spark, [("t", i + 1, i + 1, 2, i, "x")]), i)
    assert seen == [2] + [1] * 7 and store.latest_version() == 8


def test_one_table_in_two_logs_loses_nothing(spark, scratch):
    a = make_log(spark, [("t", i, 1, 2, i, "x" * 9000) for i in range(1, 200, 2)])
    b = make_log(spark, [("t", i, 1, 2, i, "x" * 9000) for i in range(2, 201, 2)]).withColumnRenamed("name", "other")
    for mode in ("poll", "drain"):
        store = OffsetStore(spark, f"{scratch}/offsets-{mode}")
        out = f"{scratch}/out-{mode}"
        for c in range(6):
            r = run_cycle(spark, [a, b], ["t"], store, json_lines_publisher(out), cycle_id=c, now=T1, mode=mode)
            if not r.rows:
                break
        ids = spark.read.text(out).select(F.get_json_object("value", "$.data.id").cast("int").alias("id"))
        assert sorted(r.id for r in ids.collect()) == list(range(1, 200))[:199] + [200]


def test_failure_keeps_its_cause(spark, scratch, caplog):
    def failing(batch, cycle_id):
        raise OSError("disk full")

    store = OffsetStore(spark, f"{scratch}/offsets")
    r = run_cycle(spark, [_log(spark)], ["t", "u"], store, failing)
    assert isinstance(r.error, OSError) and "disk full" in caplog.text


def test_cycles_checkpoint_keys_only(spark, scratch):
    import os

    rows = [("t", i, i, 2, i, os.urandom(6000).hex()) for i in range(1, 300)]
    log = make_log(spark, rows)
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")

    def used():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs)

    before = used()
    store = OffsetStore(spark, f"{scratch}/offsets")
    assert run_cycle(spark, [log], ["t"], store, json_lines_publisher(f"{scratch}/out"), mode="drain").rows == 299
    assert used() - before < 1_000_000  # the rows themselves are 3.6 MB


def test_capture_columns_stay_out_of_data(spark):
    from tidemark.functions.decode import raw_record_json
    from tidemark.plans.feed import decoded_changes

    log = make_log(spark, [("t", 1, 1, 2, 5, "a")])
    log = log.withColumn("__$end_lsn", F.lit(None).cast("binary")).withColumn("__$update_mask", F.lit(bytearray(b"\x07"))).withColumn("__$command_id", F.lit(1))
    assert decoded_changes(log).select("data.*").columns == ["id", "name"]
    assert "__$update_mask" in log.select(raw_record_json(log)).first()[0]


def test_odd_column_names_and_values(spark):
    import json

    from tidemark.plans.feed import decoded_changes, with_change_json

    log = make_log(spark, [("t", 1, 1, 2, 5, "a")]).withColumn("order.id", F.lit(1.23456)).withColumn("a`b", F.lit(float("nan")))
    log = log.withColumn("at", F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))
    saved = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        log = log.withColumn("moment", F.timestamp_seconds(F.lit(1704110400)))
        data = json.loads(with_change_json(decoded_changes(log)).select("change_json").first()[0])["data"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)
    assert data["order.id"] == "1.23456" and data["a`b"] == "NaN"
    assert data["moment"] == "2024-01-01T12:00:00Z" and data["at"] == "2024-01-01T12:00:00Z"

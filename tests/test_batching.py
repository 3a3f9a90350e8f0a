import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import b10, make_log
from tidemark.operators.batching import (
    batch_counts,
    batch_high_water,
    batch_totals,
    drain_batches,
    sample_recent,
    table_batch_sizes,
)
from tidemark.operators.ordering import ranked_keys, sequence_rank
from tidemark.schema import SEQVAL, START_LSN, TABLE_NAME


def sizes_of(spark, tables, logs, **kw):
    return {r.table_name: r.batch_size for r in table_batch_sizes(spark, tables, logs, **kw).collect()}


def test_missing_table_defaults_to_100(spark):
    log = make_log(spark, [("t", 1, 1, 2, 1, "a")])
    assert sizes_of(spark, ["t", "gone"], log)["gone"] == 100


def test_empty_log_defaults_to_100(spark):
    log = make_log(spark, [])
    assert sizes_of(spark, ["t"], log) == {"t": 100}


def test_tiny_rows_cap_at_1000(spark):
    log = make_log(spark, [("t", i, i, 2, i, "a") for i in range(1, 30)])
    assert sizes_of(spark, ["t"], log) == {"t": 1000}


def test_huge_rows_floor_at_50(spark):
    big = "x" * 10_000  # well above 262144 / 50 / 1.2 bytes per row
    log = make_log(spark, [("t", i, i, 2, i, big) for i in range(1, 5)])
    assert sizes_of(spark, ["t"], log) == {"t": 50}


def test_size_formula_mid_range(spark):
    text = "y" * 2_000
    log = make_log(spark, [("t", i, i, 2, i, text) for i in range(1, 5)])
    s = table_batch_sizes(spark, ["t"], log).first()
    assert s.batch_size == int(262144 / (s.avg_row_bytes * 1.2))
    assert 50 < s.batch_size < 1000


def test_sample_takes_newest_any_code(spark):
    rows = [("t", i, i, 3 if i % 2 else 2, i, "a") for i in range(1, 300)]
    got = sample_recent(make_log(spark, rows), 100).select("id").collect()
    assert sorted(r[0] for r in got) == list(range(200, 300))


def _random_log(spark, n_tables=4, n=600, tie_every=0, seed=3):
    rnd = random.Random(seed)
    rows, lsn = [], 1
    for i in range(n):
        t = f"t{rnd.randrange(n_tables)}" if rnd.random() > 0.4 else "t0"  # t0 is hot
        if rnd.random() < 0.5:
            lsn += 1
        seq = i + 1
        rows.append((t, lsn, seq, 2, i, "v"))
        if tie_every and i % tie_every == 0:
            rows.append((t, lsn, seq, 2, -i, "tie"))
    return make_log(spark, rows)


@pytest.mark.parametrize("buckets", [2, 5, 16])
@pytest.mark.parametrize("ties", [0, 7])
def test_bucketed_rank_equals_window_rank(spark, buckets, ties):
    log = _random_log(spark, tie_every=ties)
    w = Window.partitionBy(TABLE_NAME).orderBy(START_LSN, SEQVAL)
    want = sorted(tuple(r) for r in log.select("id", F.rank().over(w).alias("r")).collect())
    got = sorted(tuple(r) for r in sequence_rank(log, "r", buckets=buckets).select("id", "r").collect())
    assert got == want


def _simulate_polls(rows, size):
    """Successive polls: TOP(size) strictly after the cursor, cursor = last row."""
    batches, cur = [], (-1, -1)
    ordered = sorted(rows)
    while True:
        nxt = [r for r in ordered if r > cur][:size]
        if not nxt:
            return batches
        batches.append(nxt)
        cur = nxt[-1]


@pytest.mark.parametrize("buckets", [1, 6])
def test_drain_equals_successive_polls(spark, buckets):
    rnd = random.Random(11)
    tables = {"a": 137, "b": 60, "c": 3}
    rows, seq = [], 0
    for t, n in tables.items():
        for _ in range(n):
            seq += 1
            rows.append((t, rnd.randrange(1, 40), seq, 2, seq, "x"))
    log = make_log(spark, rows)
    sizes = spark.createDataFrame([("a", 50), ("b", 60), ("c", 100)], "table_name string, batch_size int")
    d = drain_batches(log, sizes, 3, buckets=buckets)
    got = {}
    for r in d.select(TABLE_NAME, START_LSN, SEQVAL, "batch_no").collect():
        got.setdefault((r[0], r[3]), []).append((int.from_bytes(r[1], "big"), int.from_bytes(r[2], "big")))
    for t, size in {"a": 50, "b": 60, "c": 100}.items():
        keys = [(l, s) for tt, l, s, *_ in rows if tt == t]
        for i, batch in enumerate(_simulate_polls(keys, size)):
            assert sorted(got[(t, i)]) == batch
    counts = {(r[0], r[1]): r[2] for r in batch_counts(d).collect()}
    assert counts[("a", 0)] == 50 and counts[("a", 2)] == 37 and counts[("c", 0)] == 3
    hw = {(r[0], r[1]): int.from_bytes(r[3], "big") for r in batch_high_water(d).collect()}
    assert hw[("a", 0)] == sorted((l, s) for tt, l, s, *_ in rows if tt == "a")[49][1]
    totals = batch_totals(ranked_keys(log, buckets), sizes, 3)
    assert {(r.table_name, r.batch_no): r.n_changes for r in totals.collect()} == counts
    assert {(r.table_name, r.batch_no): int.from_bytes(r.seq, "big") for r in totals.collect()} == hw


def test_drain_ties_share_a_batch(spark):
    rows = [("t", i, i, 2, i, "x") for i in range(1, 10)] + [("t", 10, 10, 2, 10, "x"), ("t", 10, 10, 2, 11, "y")]
    rows += [("t", 11, 11, 2, 12, "z")]
    sizes = spark.createDataFrame([("t", 10)], "table_name string, batch_size int")
    d = drain_batches(make_log(spark, rows), sizes, 1, buckets=3)
    by = {r.id: r.batch_no for r in d.select("id", "batch_no").collect()}
    assert by[10] == by[11] == 0 and by[12] == 1


@pytest.mark.parametrize("buckets", [4, 12])
def test_rank_with_a_huge_copy_group(spark, buckets):
    rnd = random.Random(5)
    rows = []
    for i in range(900):
        t = "t0" if i % 3 else "t1"
        rows.append((t, rnd.randrange(1, 300), i + 1, 2, i, "v"))
    rows += [("t0", 150, 5000, 2, 10_000 + i, "copy") for i in range(1200)]   # ~57 % of all rows
    rows += [("t1", 40, 6000, 2, 20_000 + i, "copy2") for i in range(300)]
    rows += [("t0", 7, 7, 2, 30_000 + i, "tie") for i in range(3)]            # a few light copies
    log = make_log(spark, rows)
    w = Window.partitionBy(TABLE_NAME).orderBy(START_LSN, SEQVAL)
    want = sorted(tuple(r) for r in log.select("id", F.rank().over(w).alias("r")).collect())
    got = sorted(tuple(r) for r in sequence_rank(log, "r", buckets=buckets).select("id", "r").collect())
    assert got == want


def test_envelopes_stay_small_with_a_copy_group(spark):
    from tidemark.plans.feed import batch_envelopes, decoded_changes

    rows = [("t", i, i, 2, i, "x") for i in range(1, 400)] + [("t", 200, 200, 2, 1000 + i, "copy") for i in range(2000)]
    log = make_log(spark, rows)
    d = decoded_changes(log)
    sizes = spark.createDataFrame([("t", 100)], "table_name string, batch_size int")
    b = drain_batches(d, sizes, 1, buckets=6, envelope_parts=True)
    env = batch_envelopes(b, "h", "5s").select("batch_no", "n_changes").collect()
    assert sum(r.n_changes for r in env) == 399 + 2000
    assert max(r.n_changes for r in env) <= 100
    # ranks are still exact
    w = Window.partitionBy(TABLE_NAME).orderBy(START_LSN, SEQVAL)
    want = sorted(tuple(r) for r in log.select("id", F.rank().over(w).alias("r")).collect())
    got = sorted(tuple(r) for r in b.select(F.col("data.id").cast("long").alias("id"), "seq_rank").collect())
    assert got == want


def test_recent_first_sample_equals_full_sample(spark):
    from tidemark.operators.batching import recent_first_sample, sample_recent

    rows = [("busy", i, i, 2 if i % 3 else 3, i, "b" * (i % 50)) for i in range(1, 600)]
    rows += [("quiet", i * 7, 10_000 + i, 2, i, "q" * i) for i in range(1, 40)]    # old and few
    rows += [("mid", 500 + i, 20_000 + i, 1, i, "m") for i in range(1, 150)]      # straddles the window
    log = make_log(spark, rows)
    tables = ["busy", "quiet", "mid", "none"]
    for recent in (450, 560, 10_000):
        got = sorted(tuple(r) for r in recent_first_sample(log, tables, bytes(b10(recent)), 100).select("id", "table_name", "sample_rank").collect())
        want = sorted(tuple(r) for r in sample_recent(log, 100, 4).select("id", "table_name", "sample_rank").collect())
        assert got == want
    a = {r.table_name: r.batch_size for r in table_batch_sizes(spark, tables, log, recent_from=bytes(b10(560))).collect()}
    b = {r.table_name: r.batch_size for r in table_batch_sizes(spark, tables, log).collect()}
    assert a == b


def test_sample_with_copies_is_weighted_not_multiplied(spark):
    from tidemark.operators.batching import sample_recent, sample_row_bytes, sample_stats

    rows = [("t", i, i, 2, i, "abc") for i in range(1, 200)] + [("t", 500, 500, 2, 7, "abc") for _ in range(5000)]
    log = make_log(spark, rows)
    s = sample_recent(log, 100, 1)
    assert s.count() == 1 + 0 and s.first().sample_weight == 100   # the copies fill the newest 100
    st = sample_stats(sample_row_bytes(s)).first()
    assert st.sample_rows == 100
    plain = sample_stats(sample_row_bytes(sample_recent(log, 100, 1, two_phase=False))).first()
    assert (st.total_bytes, st.sample_rows) == (plain.total_bytes, plain.sample_rows)


def test_ranges_never_change_ranks_or_envelopes(spark):
    """One range or many: the same ranks and envelope sizes, with NULL seqs, copies and a hot table."""
    from tidemark.plans.feed import batch_envelopes, decoded_changes

    rnd = random.Random(9)
    rows = [("hot" if i % 4 else "u", rnd.randrange(1, 60), None if i % 50 == 0 else rnd.randrange(1, 9), 2, i, "v") for i in range(600)]
    rows += [("hot", 30, 5, 2, 10_000 + i, "copy") for i in range(1500)]
    log = make_log(spark, rows)
    w = Window.partitionBy(TABLE_NAME).orderBy(START_LSN, SEQVAL)
    want = sorted(tuple(r) for r in log.select("id", F.rank().over(w).alias("r")).collect())
    seen = []
    for buckets in (1, 4, 11):
        d = drain_batches(decoded_changes(log), {"hot": 100, "u": 70}, 2, buckets=buckets, envelope_parts=True)
        assert sorted(tuple(r) for r in d.select(F.col("data.id").cast("long"), "seq_rank").collect()) == want
        env = batch_envelopes(d, "h", "5s").select(TABLE_NAME, "batch_no", "n_changes").collect()
        assert max(r.n_changes for r in env if r.table_name == "hot") <= 100
        assert max(r.n_changes for r in env if r.table_name == "u") <= 70
        seen.append(sorted(tuple(r) for r in env))
    assert seen[0] == seen[1] == seen[2]


def test_a_table_without_a_size_has_the_default(spark):
    log = make_log(spark, [("t", i, i, 2, i, "x") for i in range(1, 251)])
    for sizes in ({}, {"other": 7}, spark.createDataFrame([("other", 7)], "table_name string, batch_size int")):
        got = {r.batch_no: r["count"] for r in drain_batches(log, sizes, 1).groupBy("batch_no").count().collect()}
        assert got == {0: 100, 1: 100, 2: 50}


def test_resample_reads_from_the_last_sample_on_and_equals_a_full_one(spark, monkeypatch):
    """Over appends in any order, sizes equal those of the whole log; history is not read again."""
    import datetime as dt

    from tidemark.operators import batching
    from tidemark.operators.batching import BatchSizer, batch_size_values, table_batch_sizes

    tables = [f"t{k}" for k in range(6)]
    rows = [(t, i, i, 2, i, "x" * (300 * (k + 1))) for k, t in enumerate(tables) for i in range(1, 40)] + [("few", 1, 1, 2, 1, "y")]
    more = [
        [(t, i, i, 2, i, "x" * 9000) for t in tables[:3] for i in range(40, 47)],
        [("t4", 35, 500 + i, 2, i, "late" * 500) for i in range(5)] + [("few", i, i, 2, i, "z" * 7000) for i in range(2, 60)],
        [("t0", 1, 900, 2, 1, "too old to count" * 999)],
    ]
    sizer = BatchSizer(sample_size=10, resample_seconds=1)
    names, now = [*tables, "few", "missing"], dt.datetime(2024, 1, 1)
    read = []
    whole = batching.sample_recent
    monkeypatch.setattr(batching, "sample_recent", lambda log, *a, **k: read.append(log.count()) or whole(log, *a, **k))
    for step in [[], *more]:
        rows = rows + step
        log = make_log(spark, rows).repartition(3)
        read.clear()
        got = sizer.get(spark, names, [log], now)
        seen = sum(read)
        assert got == batch_size_values(table_batch_sizes(spark, names, [log], 10), len(names))
        if now > dt.datetime(2024, 1, 1):
            assert seen < len(rows) / 2  # ten rows a table and what is new
        now += dt.timedelta(hours=1)
    assert sizer.samples == 4 and set(sizer.floors[0]) == {*tables, "few"}

import datetime as dt

from pyspark.sql import functions as F

from conftest import OFFSETS_ROWS_SCHEMA, b10, make_log
from tidemark.functions.decode import lsn_hex
from tidemark.operators.batching import table_batch_sizes
from tidemark.operators.cursor import after_cursor, changes_after, poll, resume_cursor
from tidemark.plans.feed import decoded_changes, with_change_json
from tidemark.schema import OPERATION, SEQVAL, START_LSN, TABLE_NAME

T0 = dt.datetime(2024, 1, 1)


def offsets(spark, rows):
    return spark.createDataFrame(rows, OFFSETS_ROWS_SCHEMA)


def cursor_of(spark, tables, offs, log):
    rows = resume_cursor(spark, tables, offs, log).collect()
    return {r.table_name: (None if r.lsn is None else int.from_bytes(r.lsn, "big"),
                           None if r.seq is None else int.from_bytes(r.seq, "big")) for r in rows}


def seqs_after(spark, log, tables, offs):
    cur = resume_cursor(spark, tables, offs, log)
    got = changes_after(log, cur, len(tables)).select(TABLE_NAME, SEQVAL).collect()
    return sorted((r[0], int.from_bytes(r[1], "big")) for r in got)


def test_cursor_inside_transaction(spark):
    log = make_log(spark, [("t", 5, 1, 2, 1, "a"), ("t", 5, 2, 2, 2, "b"), ("t", 5, 3, 2, 3, "c"),
                           ("t", 6, 4, 2, 4, "d"), ("t", 4, 0, 2, 0, "z")])
    offs = offsets(spark, [("t", b10(5), T0, b10(2))])
    assert seqs_after(spark, log, ["t"], offs) == [("t", 3), ("t", 4)]


def test_unsigned_lsn_order(spark):
    hi = bytes([0x80]) + bytes(9)
    lo = bytes([0x7F]) + bytes([0xFF] * 9)
    log = make_log(spark, [("t", lo, 1, 2, 1, "lo"), ("t", hi, 2, 2, 2, "hi")])
    offs = offsets(spark, [("t", bytearray(lo), T0, b10(1))])
    assert seqs_after(spark, log, ["t"], offs) == [("t", 2)]


def test_no_offsets_row_replays_everything(spark):
    log = make_log(spark, [("t", 1, 1, 2, 1, "a"), ("t", 2, 2, 1, 2, "b"), ("u", 1, 3, 2, 3, "c")])
    offs = offsets(spark, [])
    assert cursor_of(spark, ["t"], offs, log) == {"t": (0, 0)}
    assert seqs_after(spark, log, ["t"], offs) == [("t", 1), ("t", 2)]


def test_backfill_smallest_seq_at_lsn(spark):
    log = make_log(spark, [("t", 7, 3, 3, 1, "before"), ("t", 7, 4, 2, 1, "a"), ("t", 7, 5, 2, 2, "b"),
                           ("t", 8, 6, 2, 3, "c")])
    offs = offsets(spark, [("t", b10(7), T0, None)])
    # code 3 is not a published code, so the smallest published seq is 4
    assert cursor_of(spark, ["t"], offs, log) == {"t": (7, 4)}
    # strict cursor: the first change of that LSN is skipped, the rest are read
    assert seqs_after(spark, log, ["t"], offs) == [("t", 5), ("t", 6)]


def test_backfill_lsn_absent_gives_zero_seq(spark):
    log = make_log(spark, [("t", 7, 3, 2, 1, "a"), ("t", 9, 4, 2, 1, "b")])
    offs = offsets(spark, [("t", b10(8), T0, None)])
    assert cursor_of(spark, ["t"], offs, log) == {"t": (8, 0)}
    assert seqs_after(spark, log, ["t"], offs) == [("t", 4)]


def test_null_lsn_reads_nothing(spark):
    log = make_log(spark, [("t", 1, 1, 2, 1, "a"), ("t", 2, 2, 2, 2, "b")])
    offs = offsets(spark, [("t", None, T0, b10(0))])
    assert cursor_of(spark, ["t"], offs, log) == {"t": (None, 0)}
    assert seqs_after(spark, log, ["t"], offs) == []


def test_codes_3_5_null_dropped(spark):
    log = make_log(spark, [("t", 1, 1, 1, 1, "del"), ("t", 2, 2, 2, 2, "ins"), ("t", 3, 3, 3, 3, "before"),
                           ("t", 3, 3, 4, 3, "after"), ("t", 4, 4, 5, 4, "odd"), ("t", 5, 5, None, 5, "null")])
    d = decoded_changes(log).select(OPERATION, "operation_type").collect()
    assert sorted((r[0], r[1]) for r in d) == [(1, "Delete"), (2, "Insert"), (4, "Update")]
    all_codes = decoded_changes(log, ops=None).select(OPERATION, "operation_type").collect()
    assert sorted((r[0], r[1]) for r in all_codes) == [(1, "Delete"), (2, "Insert"), (3, "Update"), (4, "Update")]


def test_null_data_column_is_json_null(spark):
    log = make_log(spark, [("t", 1, 1, 2, 7, None)])
    js = with_change_json(decoded_changes(log)).select("change_json").first()[0]
    assert js == ('{"data":{"id":"7","name":null},"metadata":{"LSN":"00000000000000000001",'
                  '"OperationID":2,"OperationType":"Insert","Seq":"00000000000000000001","TableName":"t"}}')


def test_keyset_literal_is_pushed_to_parquet(spark, scratch):
    log = make_log(spark, [("t", i, i, 2, i, "x") for i in range(1, 50)])
    log.write.parquet(f"{scratch}/log")
    df = spark.read.parquet(f"{scratch}/log").where(after_cursor(bytes(b10(10)), bytes(b10(10))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "Or(" in plan
    assert df.count() == 39


def test_poll_per_table_batch_and_ties(spark):
    rows = [("t", i, i, 2, i, "x") for i in range(1, 200)]
    rows += [("t", 300, 300, 2, 300, "tie1"), ("t", 300, 300, 2, 301, "tie2")]
    rows += [("u", i, i, 2, i, "y") for i in range(1, 20)]
    log = make_log(spark, rows)
    cur = resume_cursor(spark, ["t", "u"], offsets(spark, []), log)
    sizes = spark.createDataFrame([("t", 199), ("u", 100)], "table_name string, batch_size int")
    got = poll(log, cur, sizes, 2).groupBy(TABLE_NAME).count().collect()
    assert {r[0]: r[1] for r in got} == {"t": 199, "u": 19}
    sizes = spark.createDataFrame([("t", 200), ("u", 100)], "table_name string, batch_size int")
    got = poll(log, cur, sizes, 2).groupBy(TABLE_NAME).count().collect()
    # the two rows tied at rank 200 stay together
    assert {r[0]: r[1] for r in got} == {"t": 201, "u": 19}


def test_poll_plans_window_group_limit(spark):
    log = make_log(spark, [("t", i, i, 2, i, "x") for i in range(1, 50)])
    cur = resume_cursor(spark, ["t"], offsets(spark, []), log)
    sizes = table_batch_sizes(spark, ["t"], log)
    # the key ranking is checkpointed, so look at its plan, not at that of the join-back
    plans = []
    cls = type(log)
    saved = cls.checkpoint

    def spy(self, eager=True):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return saved(self, eager)

    cls.checkpoint = spy
    try:
        poll(log, cur, sizes, 1)
    finally:
        cls.checkpoint = saved
    assert any("WindowGroupLimit" in p for p in plans)


def test_loaded_cursors_equal_cursor_frame(spark):
    from tidemark.operators.cursor import load_cursors
    from tidemark.sources.fixtures import EVENT_TABLES, events_ct, offsets_fixture

    log = events_ct(spark, "/root/testdata/sf0.001")
    offs = offsets_fixture(log)
    frame = {r.table_name: (None if r.lsn is None else bytes(r.lsn), None if r.seq is None else bytes(r.seq))
             for r in resume_cursor(spark, EVENT_TABLES, offs, log).collect()}
    assert load_cursors(spark, EVENT_TABLES, offs, log) == frame


def test_many_tables_use_join_path(spark):
    from tidemark.operators import cursor as C

    rows = [(f"t{k}", i, i, 2, i, "x") for k in range(70) for i in range(1, 4)]
    log = make_log(spark, rows)
    cur = {f"t{k}": (bytes(b10(1)), bytes(b10(1))) for k in range(70)}
    cur["t0"] = (None, bytes(b10(0)))
    assert len(cur) > C.MAX_LITERAL_TABLES
    got = changes_after(log, cur).count()
    assert got == 69 * 2
    small = {t: cur[t] for t in list(cur)[:C.MAX_LITERAL_TABLES + 1]}
    assert changes_after(log, small).count() == C.MAX_LITERAL_TABLES * 2


def test_poll_with_a_huge_copy_group(spark):
    # 3000 copies of one change, then more changes: the copies share rank 1 and
    # form one (oversized) batch; the next keys rank after all of them.
    rows = [("t", 5, 5, 2, i, "copy") for i in range(3000)] + [("t", 6 + i, 6 + i, 2, 10_000 + i, "x") for i in range(20)]
    log = make_log(spark, rows)
    cur = resume_cursor(spark, ["t"], offsets(spark, []), log)
    sizes = spark.createDataFrame([("t", 10)], "table_name string, batch_size int")
    p = poll(log, cur, sizes, 1)
    got = {r.name: r["count"] for r in p.groupBy("name").count().collect()}
    assert got == {"copy": 3000}
    # a cursor placed on the copied change reads the next ten changes
    offs = offsets(spark, [("t", b10(5), T0, b10(5))])
    cur2 = resume_cursor(spark, ["t"], offs, log)
    p2 = poll(log, cur2, sizes, 1).select("poll_rank", "id").collect()
    assert sorted(r.poll_rank for r in p2) == list(range(1, 11))


def test_changes_after_matches_brute_force(spark):
    import random

    from tidemark.operators import cursor as C

    rnd = random.Random(23)
    for trial in range(6):
        n_tables = rnd.choice([1, 3, 7])
        tables = [f"t{k}" for k in range(n_tables)]
        rows = []
        for i in range(300):
            rows.append((rnd.choice(tables), rnd.randrange(0, 40), rnd.randrange(0, 40), rnd.choice([1, 2, 3, 4, 5]), i, "x"))
        log = make_log(spark, rows)
        cur = {}
        for t in tables:
            kind = rnd.random()
            if kind < 0.15:
                cur[t] = (None, bytes(b10(0)))                       # NULL LSN: reads nothing
            elif kind < 0.3:
                continue                                             # not configured here
            else:
                cur[t] = (bytes(b10(rnd.randrange(0, 40))), bytes(b10(rnd.randrange(0, 40))))
        want = sorted(
            i for t, l, s, op, i, _ in rows
            if t in cur and cur[t][0] is not None and op in (1, 2, 4)
            and (l > int.from_bytes(cur[t][0], "big")
                 or (l == int.from_bytes(cur[t][0], "big") and s > int.from_bytes(cur[t][1], "big")))
        )
        for limit in (0, 100):   # join path and literal path
            C.MAX_LITERAL_TABLES, saved = limit, C.MAX_LITERAL_TABLES
            try:
                got = sorted(r.id for r in changes_after(log, cur).select("id").collect())
            finally:
                C.MAX_LITERAL_TABLES = saved
            assert got == want, (trial, limit)


def test_poll_matches_brute_force(spark):
    import random

    rnd = random.Random(31)
    for trial in range(4):
        tables = ["a", "b", "c"]
        rows = [(rnd.choice(tables), rnd.randrange(0, 30), rnd.randrange(0, 5), rnd.choice([1, 2, 3, 4]), i, "x")
                for i in range(400)]
        log = make_log(spark, rows)
        cur = {t: (bytes(b10(rnd.randrange(0, 10))), bytes(b10(rnd.randrange(0, 5)))) for t in tables}
        sizes = {t: rnd.randrange(1, 60) for t in tables}
        want = set()
        for t in tables:
            cl, cs = (int.from_bytes(x, "big") for x in cur[t])
            after = sorted((l, s, i) for tt, l, s, op, i, _ in rows
                           if tt == t and op in (1, 2, 4) and (l > cl or (l == cl and s > cs)))
            keys = [(l, s) for l, s, _ in after]
            for l, s, i in after:
                rank = 1 + sum(1 for k in keys if k < (l, s))
                if rank <= sizes[t]:
                    want.add((i, rank))
        got = {(r.id, r.poll_rank) for r in poll(log, cur, sizes, 3).select("id", "poll_rank").collect()}
        assert got == want, trial


def test_null_seq_reads_the_same_in_both_paths(spark):
    """A NULL cursor seq matches later LSNs only, with 4 tables (literal path) as with 5 (join path)."""
    for n in (4, 5):
        tables = [f"t{k}" for k in range(n)]
        log = make_log(spark, [(t, l, 1, 2, l, "x") for t in tables for l in (5, 6)])
        got = changes_after(log, {t: (bytes(b10(5)), None) for t in tables})
        assert sorted((r.table_name, r.id) for r in got.collect()) == [(t, 6) for t in tables]


def test_poll_sizes_default_and_refusal(spark):
    import pytest

    log = make_log(spark, [("t", i, i, 2, i, "x") for i in range(1, 301)])
    cur = {"t": (bytes(b10(0)), bytes(b10(0)))}
    assert poll(log, cur, {}, 1).count() == 100
    with pytest.raises(ValueError):
        poll(log, cur, {"t": 2000}, 1)
    big = spark.createDataFrame([("t", 2000)], "table_name string, batch_size int")
    with pytest.raises(Exception, match="max_batch"):
        poll(log, cur, big, 1).count()


def test_a_poll_reads_a_bounded_window_of_wide_rows(spark, scratch):
    from tidemark.sources.changelog import read_change_log, write_change_log

    for n in (2, 300):
        tables = [f"t{k}" for k in range(n)]
        path = f"{scratch}/log{n}"
        write_change_log(make_log(spark, [(t, i, i, 2, i, "x") for t in tables for i in range(1, 9)]), path, files_per_write=2)
        log = read_change_log(spark, path, tables)
        cur = {t: (bytes(b10(2)), bytes(b10(2))) for t in tables}
        p = poll(log, cur, {t: 3 for t in tables}, n)
        assert p.count() == 3 * n
        spark.conf.set("spark.sql.maxMetadataStringLength", "20000")
        try:
            plan = poll(log, cur, {t: 3 for t in tables}, n)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.maxMetadataStringLength")
        scans = [x for x in plan.split("\n") if "FileScan" in x]
        assert scans and all("LessThanOrEqual(`__$start_lsn`" in x and "GreaterThan" in x for x in scans)
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan

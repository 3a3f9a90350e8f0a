"""Polls bounded by an LSN histogram."""

import random

from pyspark.sql import functions as F

from conftest import b10, make_log
from tidemark.operators.cursor import changes_after, poll_keys, up_to
from tidemark.operators.histogram import END, PollBounds, lsn_histogram
from tidemark.operators.offsets import OffsetStore
from tidemark.plans.cycle import json_lines_publisher, run_cycle

ZERO = (bytes(10), bytes(10))


def _n(b):
    return int.from_bytes(bytes(b), "big")


def test_cuts_count_rows_up_to_their_end(spark):
    rnd = random.Random(4)
    rows = [("t", rnd.randrange(1, 300), s, 2, s, "") for s in range(1000)] + [("t", 50, 5000, 2, 0, "copy")] * 40 + [("u", 1, 1, 2, 1, "")]
    h = lsn_histogram(make_log(spark, rows), 64, 5).collect()
    lsns = sorted(r[1] for r in rows if r[0] == "t")
    total = 0
    for r in sorted(h, key=lambda r: bytes(r["upto"])):
        total += r["rows"]
        assert r[0] == "t" and 64 <= r["rows"] <= 64 + 40 or r["rows"] <= 64
        assert sum(x <= _n(r["upto"]) for x in lsns) >= total
    assert 14 <= len(h) <= 17


def test_polls_read_keys_in_proportion_to_what_they_publish(spark, scratch):
    size, n = 20, 600
    rows = [("t", i, i, 2, i, "") for i in range(1, n + 1)] + [("few", i, i, 2, i, "") for i in range(1, 6)]
    log = make_log(spark, rows).repartition(3).persist()
    bounds = PollBounds(spark, f"{scratch}/hist", rows_per_cut=size, ranges=2)
    cursor, sizes = {"t": ZERO, "few": ZERO}, {"t": size, "few": size}
    scanned = published = 0
    for _ in range(12):
        uppers = bounds.bounds(log, cursor, sizes)
        keys = changes_after(up_to(log, uppers), cursor)
        scanned += keys.where("table_name = 't'").count()
        top = poll_keys([up_to(log, uppers)], cursor, sizes, 2).collect()
        got = [_n(r["_pl"]) for r in top if r["_pt"] == "t"]
        assert sorted(got) == list(range(published + 1, published + size + 1))  # as without bounds
        published += size
        cursor["t"] = (bytes(b10(published)), bytes(b10(published)))
        cursor["few"] = (bytes(b10(5)), bytes(b10(5)))
    assert scanned <= 3 * published  # without bounds: 12 polls of up to 600 keys
    log.unpersist()


def test_bounds_follow_a_growing_log(spark, scratch):
    bounds = PollBounds(spark, f"{scratch}/hist", rows_per_cut=10, ranges=2)
    sizes = {"t": 10, "gone": 10}
    cursor = {"t": ZERO, "gone": (None, None)}
    first = make_log(spark, [("t", i, i, 2, i, "") for i in range(1, 26)])
    assert _n(bounds.bounds(first, cursor, sizes)["t"]) == 20
    cursor["t"] = (bytes(b10(20)), bytes(b10(20)))
    assert bounds.bounds(first, cursor, sizes) == {"t": END, "gone": END}  # five rows are left
    later = make_log(spark, [("t", i, i, 2, i, "") for i in range(1, 71)] + [("t", 22, 900, 2, 1, "late")])
    upper = bounds.bounds(later, cursor, sizes)["t"]
    assert changes_after(up_to(later, {"t": upper}), {"t": cursor["t"]}).count() >= 10 and upper != END
    assert bounds.cuts().groupBy("table_name").agg(F.max("upto").alias("u")).first()["u"] <= b10(70)


def test_bounded_cycles_publish_the_backlog_once_and_in_order(spark, scratch):
    rows = [("t", i // 2 + 1, i, 2, i, "x" * 9000) for i in range(1, 181)] + [("u", i, i, 2, i, "u") for i in range(1, 4)]
    log = make_log(spark, rows).repartition(3)
    store, out = OffsetStore(spark, f"{scratch}/offsets"), f"{scratch}/out"
    bounds = PollBounds(spark, f"{scratch}/hist", rows_per_cut=30, ranges=2)
    for c in range(6):
        r = run_cycle(spark, [log], ["t", "u"], store, json_lines_publisher(out), cycle_id=c, poll_bounds=bounds)
        if not r.rows:
            break
    ids = spark.read.text(out).select("table_name", "cycle", F.get_json_object("value", "$.data.id").cast("int").alias("id")).collect()
    assert sorted((x.table_name, x.id) for x in ids) == sorted([("t", i) for i in range(1, 181)] + [("u", i) for i in (1, 2, 3)])
    first = sorted(x.id for x in ids if x.table_name == "t" and x.cycle == 0)
    assert first == list(range(1, len(first) + 1)) and 50 <= len(first) <= 51


def test_rows_that_are_gone_do_not_stop_the_feed(spark, scratch):
    bounds = PollBounds(spark, f"{scratch}/hist", rows_per_cut=10, ranges=2)
    store, out = OffsetStore(spark, f"{scratch}/offsets"), f"{scratch}/out"
    log = make_log(spark, [("t", i, i, 2, i, "") for i in range(1, 100)])
    bounds.extend(log, {"t": ZERO})
    left = log.where("id > 60")
    monkey = {"t": 10}
    assert bounds.uppers({"t": ZERO}, monkey)["t"] == bytes(b10(20))

    class Small(PollBounds):
        def bounds(self, keys, cursors, sizes):
            return super().bounds(keys, cursors, {t: 10 for t in sizes})

    small = Small(spark, f"{scratch}/hist", rows_per_cut=10, ranges=2)
    assert run_cycle(spark, [left], ["t"], store, json_lines_publisher(out), poll_bounds=small).rows == 39

"""Resumable streams: the low-water frontier, and replayed changes shown once."""

import datetime as dt
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import OFFSETS_ROWS_SCHEMA, b10, make_log
from tidemark.operators.offsets import OffsetStore
from tidemark.plans.cycle import json_lines_publisher
from tidemark.streaming.frontier import FrontierState, low_water
from tidemark.streaming.stream import micro_batch_handler, read_published_stream, run_feed, start_text_feed, without_replays

Z = bytes(10)


def _file(spark, path, rows):
    """One more log file; its time is later than those before."""
    time.sleep(0.05)
    make_log(spark, rows).coalesce(1).write.mode("append").parquet(path)


def _ids(spark, out, fmt="text"):
    pub = spark.read.format(fmt).load(out)
    return [int(r.i) for r in pub.select(F.get_json_object("value", "$.data.id").alias("i")).collect()]


def _after_batches(n):
    """Stops a query once it has committed ``n`` micro-batches of its own (or has none left)."""

    def wait(q):
        end = time.time() + 120
        while time.time() < end and q.isActive:
            done = [p for p in q.recentProgress if p.numInputRows > 0]
            if len(done) >= n or (q.lastProgress and not q.status["isTriggerActive"] and not q.status["isDataAvailable"] and q.lastProgress.numInputRows == 0):
                return
            time.sleep(0.05)

    return wait


def _saved(store):
    return {r.table_name: int.from_bytes(r.last_lsn, "big") for r in store.read().collect()}


@pytest.mark.parametrize("fmt", ["text", "parquet"])
def test_stream_stopped_after_any_batch_loses_nothing(spark, scratch, fmt):
    src, out, ckpt = f"{scratch}/log", f"{scratch}/out", f"{scratch}/ckpt"
    store = OffsetStore(spark, f"{scratch}/offsets")
    for low in (31, 21, 11, 1):  # the largest keys are in the oldest file
        _file(spark, src, [("t", i, i, 2, i, "a") for i in range(low, low + 10)] + [("u", low, low, 2, 1000 + low, "b")])
    stops = []
    for _ in range(4):
        run_feed(spark, [src], ["t", "u"], out, ckpt, store, fmt, 1, "0 seconds", _after_batches(1))
        stops.append((set(_ids(spark, out, fmt)), _saved(store).get("t", 0)))
        assert set(range(1, stops[-1][1] + 1)) <= stops[-1][0]  # the frontier has no gap below it
    assert stops[0][0] and stops[0][1] == 0  # 31 .. 40 are published, 1 .. 10 are not
    run_feed(spark, [src], ["t", "u"], out, ckpt, store, fmt, 1)
    assert sorted(set(_ids(spark, out, fmt))) == sorted([*range(1, 41), 1001, 1011, 1021, 1031])
    assert _saved(store) == {"t": 40, "u": 31}
    # a late row at the frontier or below is dropped, a newer one is published
    _file(spark, src, [("t", 7, 70, 2, 999, "late"), ("t", 41, 41, 2, 41, "new")])
    run_feed(spark, [src], ["t", "u"], out, ckpt, store, fmt, 1)
    assert 999 not in _ids(spark, out, fmt) and 41 in _ids(spark, out, fmt) and _saved(store)["t"] == 41


def test_stream_stopped_between_batches_starts_below_its_largest_key(spark, scratch):
    """One file of two is published, then the stream stops: the other is not taken for late."""
    src, out, ckpt = f"{scratch}/log", f"{scratch}/out", f"{scratch}/ckpt"
    store = OffsetStore(spark, f"{scratch}/offsets")
    store.write(spark.createDataFrame([("t", b10(2), dt.datetime(2024, 1, 1), b10(2))], OFFSETS_ROWS_SCHEMA))
    _file(spark, src, [("t", i, i, 2, i, "a") for i in range(6, 11)])
    _file(spark, src, [("t", i, i, 2, i, "a") for i in range(1, 6)])
    run_feed(spark, [src], ["t"], out, ckpt, store, "text", 1, "0 seconds", _after_batches(1))
    if sorted(_ids(spark, out)) == list(range(6, 11)):
        assert _saved(store) == {"t": 2}
    run_feed(spark, [src], ["t"], out, ckpt, store, "text", 1)
    assert sorted(_ids(spark, out)) == list(range(3, 11)) and _saved(store) == {"t": 10}


def test_sink_files_already_known_are_not_opened_again(spark, scratch, monkeypatch):
    from tidemark.streaming import frontier

    src, out, ckpt = f"{scratch}/log", f"{scratch}/out", f"{scratch}/ckpt"
    store = OffsetStore(spark, f"{scratch}/offsets")
    monkeypatch.setattr(frontier, "CLOCK_MARGIN_MS", 0)
    _file(spark, src, [("t", i, i, 2, i, "a") for i in range(1, 200)])
    run_feed(spark, [src], ["t"], out, ckpt, store)
    _, keys, known = FrontierState(spark, f"{ckpt}/frontier").load()
    assert keys.count() == 0 and known > 0
    later = frontier.sink_keys(spark, out, "text", known + 1)
    assert later.count() == 0
    _file(spark, src, [("t", 300, 300, 2, 300, "a")])
    run_feed(spark, [src], ["t"], out, ckpt, store)
    found = frontier.sink_keys(spark, out, "text", known + 1)
    assert found.count() == 1
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "file_modification_time" in scan and _saved(store) == {"t": 300}


def test_handler_takes_files_in_any_order(spark, scratch):
    rows = [("t", i, i, 2, i, "x") for i in range(1, 11)] + [("u", 3, 3, 2, 33, "u")]
    log = make_log(spark, rows)
    store, out = OffsetStore(spark, f"{scratch}/offsets"), f"{scratch}/out"

    def handler():  # a new one each time, as after a restart
        return micro_batch_handler(["t", "u"], store, json_lines_publisher(out), retained=lambda: [log], buckets=2)

    handler()(make_log(spark, [r for r in rows if r[1] > 5]), 0)
    assert _saved(store) == {}
    handler()(make_log(spark, [r for r in rows if r[1] > 5]), 0)  # replayed: published already
    handler()(make_log(spark, [r for r in rows if r[0] == "u"]), 1)
    assert _saved(store) == {"u": 3}
    handler()(make_log(spark, [r for r in rows if r[0] == "t" and r[1] <= 5]), 2)
    assert _saved(store) == {"t": 10, "u": 3}
    handler()(make_log(spark, [("t", 4, 40, 2, 400, "late"), ("t", 11, 11, 2, 11, "new")]), 3)
    assert sorted(_ids(spark, out)) == [*range(1, 12), 33]


def test_handler_without_the_log_publishes_files_read_later(spark, scratch):
    store, out = OffsetStore(spark, f"{scratch}/offsets"), f"{scratch}/out"
    for n, ids in enumerate((range(6, 11), range(1, 6))):
        handle = micro_batch_handler(["t"], store, json_lines_publisher(out), buckets=2)
        handle(make_log(spark, [("t", i, i, 2, i, "x") for i in ids]), n)
    assert sorted(_ids(spark, out)) == list(range(1, 11)) and _saved(store) == {"t": 10}


def brute_low_water(retained, committed, cursors):
    out = dict(cursors)
    for t, (l, s) in cursors.items():
        if l is None:
            continue
        after = lambda k: k[0] == t and (k[1], k[2]) > (l, s) and k[3] in (1, 2, 4)  # noqa: B023, E731
        gap = min(((k[1], k[2]) for k in retained if after(k) and k not in committed), default=None)
        done = [(k[1], k[2]) for k in committed if after(k) and (gap is None or (k[1], k[2]) < gap)]
        if done:
            out[t] = max(done)
    return out


KEYS = st.sets(st.tuples(st.sampled_from("ab"), st.integers(1, 6), st.integers(1, 3), st.sampled_from([1, 2, 3, 4])), max_size=14)


@settings(max_examples=15, deadline=None)
@given(KEYS, KEYS, st.tuples(st.integers(0, 3), st.integers(0, 2)))
def test_low_water_equals_brute_force(spark, kept, published, start):
    h = lambda n: int(n).to_bytes(10, "big")
    up = lambda ks: {(t, h(l), h(s), op) for t, l, s, op in ks}
    kept, published = up(kept), {k for k in up(published) if k[3] != 3}
    cursors = {"a": (h(start[0]), h(start[1])), "b": (None, None), "c": (Z, Z)}
    frame = lambda ks: make_log(spark, [(t, l, s, op, 0, "") for t, l, s, op in ks])
    assert low_water(frame(kept), frame(published), cursors) == brute_low_water(kept, published, cursors)


def test_a_state_that_was_cut_short_does_not_count(spark, scratch):
    state = FrontierState(spark, f"{scratch}/state")
    assert state.load() is None
    keys = make_log(spark, [("t", i, i, 2, i, "") for i in range(1, 6)])
    state.save({"t": (bytes(b10(2)), bytes(b10(2)))}, keys, 5)
    keys.write.parquet(f"{scratch}/state/state=2/keys")  # no cursors: the save did not end
    cursors, beyond, known = state.load()
    assert cursors == {"t": (bytes(b10(2)), bytes(b10(2)))} and beyond.count() == 3 and known == 5
    for i in (3, 4, 5):
        state.save({"t": (bytes(b10(i)), bytes(b10(i)))}, keys)
    assert state.load()[1].count() == 0 and len(state._versions()) == 2


# --- replayed changes --------------------------------------------------------------

def test_replay_after_a_failed_save_shows_each_key_once(spark, scratch):
    from tidemark.plans.cycle import run_cycle

    class Broken(OffsetStore):
        def write(self, offsets):
            raise OSError("no space")

    log = make_log(spark, [("t", i, i, 2, i, "x") for i in range(1, 21)] + [("t", 5, 5, 2, 5, "x")])
    out, once, ckpt = f"{scratch}/out", f"{scratch}/once", f"{scratch}/ckpt"
    with pytest.raises(OSError):
        run_cycle(spark, [log], ["t"], Broken(spark, f"{scratch}/offsets"), json_lines_publisher(out), cycle_id=1, mode="drain")

    def consume():
        q = start_text_feed(without_replays(read_published_stream(spark, out), "1 hour"), once, ckpt, fmt="parquet")
        q.awaitTermination(120)
        assert q.exception() is None

    consume()
    run_cycle(spark, [log], ["t"], OffsetStore(spark, f"{scratch}/offsets"), json_lines_publisher(out), cycle_id=2, mode="drain")
    consume()  # the replay is in a later file and a later run of the stream
    assert len(_ids(spark, out)) == 42 and sorted(_ids(spark, once, "parquet")) == list(range(1, 21))


def test_feed_drops_changes_that_its_log_repeats(spark, scratch):
    src, out, ckpt = f"{scratch}/log", f"{scratch}/out", f"{scratch}/ckpt"
    _file(spark, src, [("t", i, i, 2, i, "a") for i in range(1, 6)])
    _file(spark, src, [("t", i, i, 2, i, "a") for i in range(3, 9)] + [("t", 4, 4, 1, 4, "delete of the same key")])
    run_feed(spark, [src], ["t"], out, ckpt, replay_delay="1 hour")
    assert sorted(_ids(spark, out)) == sorted([*range(1, 9), 4])
    assert "file_time" not in spark.read.text(out).first().value

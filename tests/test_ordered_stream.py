"""Ordered stream output: slots of LSNs wait in state until the watermark passes them."""

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import make_log
from tidemark.streaming.ordered import lsn_slot, ordered_slots, read_ordered_feed, run_ordered_feed


def _write(spark, path, rows):
    make_log(spark, rows).coalesce(1).write.mode("append").parquet(path)


def _feed(spark, src, out, ckpt, width=10, lag=5):
    run_ordered_feed(spark, [src], ["a", "b"], out, ckpt, width, lag, max_files_per_trigger=1)


def _published(out):
    """``table -> [(slot, [(lsn, seq, id)], micro-batch)]`` in slot order, lines as they stand in the file."""
    batch, found = {}, {}
    for log in sorted(glob.glob(f"{out}/_spark_metadata/[0-9]*"), key=lambda p: int(os.path.basename(p).split(".")[0])):
        with open(log) as f:
            for line in f.read().splitlines()[1:]:
                batch.setdefault(os.path.basename(json.loads(line)["path"]), int(os.path.basename(log).split(".")[0]))
    for path in glob.glob(f"{out}/table_name=*/slot=*/*.txt"):
        table, slot = (part.split("=")[1] for part in path[len(out) + 1 :].split("/")[:2])
        with open(path) as f:
            lines = [json.loads(line) for line in f]
        found.setdefault(table, []).append((int(slot), [(x["metadata"]["LSN"], x["metadata"]["Seq"], int(x["data"]["id"])) for x in lines], batch[os.path.basename(path)]))
    return {t: sorted(s) for t, s in found.items()}


def test_lsn_slots_are_exact_over_eighty_bits(spark):
    cases = [(0, 7), (6, 7), (7, 7), ((1 << 40) - 1, 1 << 10), (1 << 40, 1 << 10), ((1 << 80) - 1, 1 << 38), ((3 << 61) + 12345, 1000003)]
    for lsn, width in cases:
        got = spark.range(1).select(lsn_slot(F.lit(f"{lsn:020x}"), width).alias("s")).first().s
        assert got == lsn // width


def test_files_in_any_order_come_out_ordered(spark, scratch):
    src, out, ckpt = f"{scratch}/log", f"{scratch}/out", f"{scratch}/ckpt"
    rnd = random.Random(3)
    rows = [("a" if i % 3 else "b", i, 1000 + i, 2, i, "x") for i in range(1, 161)]
    rows += [("a", 40, 1040 - k, 2, 1000 + k, "tie") for k in range(1, 4)] + [("a", 41, 1041, 2, 41, "x")]  # a transaction, and a copy
    rnd.shuffle(rows)
    # files of twenty LSNs, read in pairs the wrong way round
    files = [[r for r in rows if lo < r[1] <= lo + 20] for lo in range(0, 160, 20)]
    for k in range(0, len(files), 2):
        for part in (files[k + 1], files[k]):
            _write(spark, src, part)
    for _ in range(2):  # stopped and started again: nothing twice
        _feed(spark, src, out, ckpt)
    got = _published(out)
    for t in ("a", "b"):
        keys = [x[:2] for _, lines, _ in got[t] for x in lines]
        assert keys == sorted(keys)
        assert len({s for s, _, _ in got[t]}) == len(got[t])  # one file a slot
        batches = [b for _, _, b in got[t]]
        assert batches == sorted(batches) and len(set(batches)) > 1  # no slot is written before a smaller one
        done = max(s for s, _, _ in got[t])
        want = sorted((f"{r[1]:020x}", f"{r[2]:020x}", r[4]) for r in rows if r[0] == t and r[1] // 10 <= done)
        assert sorted(x for _, lines, _ in got[t] for x in lines) == want
        assert done == 10  # slots up to the largest one read (16) less the lag are closed
    # the rest waits in the state until larger LSNs come
    _write(spark, src, [("a", 400, 1400, 2, 400, "x")])
    _feed(spark, src, out, ckpt)
    ids = sorted(x[2] for t in "ab" for _, lines, _ in _published(out)[t] for x in lines)
    assert ids == sorted(r[4] for r in rows)
    assert read_ordered_feed(spark, out).count() == len(rows)


def test_a_change_behind_the_lag_is_late(spark, scratch):
    src, out, ckpt = f"{scratch}/log", f"{scratch}/out", f"{scratch}/ckpt"
    _write(spark, src, [("a", 5, 5, 2, 5, "x"), ("a", 200, 200, 2, 200, "x")])
    _feed(spark, src, out, ckpt)
    _write(spark, src, [("a", 6, 6, 2, 6, "late"), ("a", 190, 190, 2, 190, "x"), ("a", 500, 500, 3, 500, "before"), ("a", 500, 500, 4, 501, "x")])
    _feed(spark, src, out, ckpt)
    assert [x[2] for _, lines, _ in _published(out)["a"] for x in lines] == [5, 190, 200]


def test_batch_frames_and_odd_rows(spark):
    rows = [("a", None, "0" * 20, 2, "v0"), ("a", f"{12:020x}", None, 2, "v1"), ("a", f"{12:020x}", f"{3:020x}", 4, "v2"), (None, f"{12:020x}", "1", 2, "v3")]
    df = spark.createDataFrame(rows, "table_name string, lsn string, seq string, operation int, value string")
    got = {(r.table_name, r.slot): [c.value for c in r.changes] for r in ordered_slots(df, 10, 0).collect()}
    assert got == {("a", 1): ["v1", "v2"], (None, 1): ["v3"]}
    assert ordered_slots(df.limit(0), 10, 0).count() == 0
    with pytest.raises(ValueError):
        ordered_slots(df, 0, 1)

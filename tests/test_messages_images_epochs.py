"""Greedy byte cuts, before-images and schema epochs against brute force."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import b10, make_log
from tidemark.operators.epochs import HISTORY, epoch_data_json, schema_epochs
from tidemark.operators.images import all_changes, update_json, update_pairs
from tidemark.operators.messages import byte_cuts
from tidemark.plans.feed import byte_envelopes, decoded_changes
from tidemark.schema import OPERATION, SEQVAL, START_LSN, TABLE_NAME

SIZED = f"`{TABLE_NAME}` string, `{START_LSN}` binary, `{SEQVAL}` binary, `{OPERATION}` int, digest string, bytes long, room long"


def greedy(sizes, room):
    out, no, left = [], -1, 0
    for b in sizes:
        if no < 0 or b > left:
            no, left = no + 1, room
        left -= b
        out.append(no)
    return out


def _cuts(spark, tables, ranges=3, block_messages=2):
    rows, want = [], {}
    for t, (sizes, room) in tables.items():
        for i, (b, e) in enumerate(zip(sizes, greedy(sizes, room))):
            rows.append((t, b10(i // 2), b10(i), 2, f"d{i}", b, room))
            want[t, i] = e
    random.Random(1).shuffle(rows)
    got = byte_cuts(spark.createDataFrame(rows, SIZED), F.col("room"), ranges, block_messages).collect()
    assert len(got) == len(want)
    assert {(r[0], int.from_bytes(r[2], "big")): r["envelope_no"] for r in got} == want


def test_cuts_over_many_blocks(spark):
    rnd = random.Random(3)
    _cuts(
        spark,
        {
            "long": ([rnd.randrange(1, 40) for _ in range(900)], 50),
            "large changes": ([rnd.choice([1, 2, 3, 400, 1300]) for _ in range(120)], 20),
            "one": ([5], 3),
            "exact": ([10] * 60, 20),
            None: ([7, 9, 1, 30, 2, 2, 2], 10),
        },
    )


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(1, 90), min_size=1, max_size=80), st.integers(1, 60), st.integers(2, 5))
def test_cuts_equal_a_greedy_walk(spark, sizes, room, block_messages):
    _cuts(spark, {"t": (sizes, room)}, 2, block_messages)


def test_no_envelope_above_the_budget_but_single_changes(spark):
    rnd = random.Random(7)
    rows = [("t", i, i, 2, i, "é" * rnd.randrange(0, 300)) for i in range(1, 150)] + [("t", 500, 500, 2, 500, "x" * 5000), ("u", 1, 1, 1, 1, None)]
    log = make_log(spark, rows + rows[:9])  # copies of a change are one change
    got = byte_envelopes(decoded_changes(log), 'ser"ver', "5s", 2000, 3, 2).collect()
    seen = []
    for r in sorted(got, key=lambda r: (r["table_name"], r["envelope_no"])):
        e = json.loads(r["envelope_json"])
        assert r["envelope_bytes"] == len(r["envelope_json"].encode())
        assert r["envelope_bytes"] <= 2000 or r["n_changes"] == 1
        assert e["server_name"] == 'ser"ver' and e["metadata"] == {"batch_size": len(e["changes"]), "poll_interval": "5s"}
        seen += [(c["table_name"], int(c["data"]["id"])) for c in e["changes"]]
    assert seen == [("t", r[4]) for r in rows[:-1]] + [("u", 1)]
    assert byte_envelopes(decoded_changes(make_log(spark, [])), "s", "5s").count() == 0


# --- images -------------------------------------------------------------------------

def test_pairs_and_halves(spark):
    rows = [
        ("t", 1, 1, 3, 1, "old"), ("t", 1, 1, 4, 1, "new"),
        ("t", 1, 2, 3, 2, None), ("t", 1, 2, 4, 2, None),
        ("t", 1, 3, 3, 3, None), ("t", 1, 3, 4, 4, "x"),
        ("t", 2, 1, 3, 5, "lost its after"), ("u", 2, 1, 4, 5, "lost its before"),
        ("t", 3, 1, 2, 6, "insert"), ("t", 3, None, 3, 7, "a"), ("t", 3, None, 4, 7, "b"),
    ]
    got = {(r[0], int.from_bytes(r[1], "big"), r[2] and int.from_bytes(r[2], "big")): r for r in update_json(update_pairs(make_log(spark, rows + rows))).collect()}
    changed = {k: (r["images"], r["changed"]) for k, r in got.items()}
    assert changed == {
        ("t", 1, 1): ("pair", ["name"]), ("t", 1, 2): ("pair", []), ("t", 1, 3): ("pair", ["id", "name"]),
        ("t", 2, 1): ("before", None), ("u", 2, 1): ("after", None), ("t", 3, None): ("pair", ["name"]),
    }
    assert got["t", 1, 1]["before"] == '{"id":"1","name":"old"}' and got["t", 2, 1]["after"] is None
    assert json.loads(got["t", 1, 2]["after"]) == {"id": "2", "name": None}


def test_pairs_take_one_shuffle_and_no_join(spark):
    plan = update_pairs(make_log(spark, [("t", 1, 1, 3, 1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_change_function_row_filters(spark):
    log = make_log(spark, [("t", i, op, op, i, "") for i in (1, 2, 3) for op in (1, 2, 3, 4, 5)])
    count = lambda f: all_changes(log, bytes(b10(2)), bytes(b10(3)), f).groupBy(OPERATION).count().collect()
    assert {r[0]: r[1] for r in count("all")} == {1: 2, 2: 2, 4: 2}
    assert {r[0]: r[1] for r in count("all update old")} == {1: 2, 2: 2, 3: 2, 4: 2}
    with pytest.raises(ValueError):
        all_changes(log, b"", b"", "some")


# --- schema epochs ---------------------------------------------------------------------

def test_columns_added_dropped_and_widened(spark):
    schema = f"`{TABLE_NAME}` string, `{START_LSN}` binary, `{SEQVAL}` binary, `{OPERATION}` int, a decimal(20,4), b string, d timestamp_ntz"
    import datetime as dt
    from decimal import Decimal

    when = dt.datetime(2024, 1, 2, 3, 4, 5)
    rows = [(t, b10(i), b10(i), 2, Decimal(i * 1_000_000_000), None if i % 2 else f"b{i}", when) for t in ("t", "u", "v") for i in range(1, 8)]
    log = spark.createDataFrame(rows, schema)
    history = [
        ("t", b10(2), [("a", "int")]),
        ("t", b10(4), [("b", "string"), ("a", "decimal(12,1)"), ("gone", "int")]),
        ("t", b10(6), [("d", "timestamp_ntz"), ("a", "decimal(20,4)")]),
        ("u", b10(0), [("b", "string")]), ("u", b10(5), []), ("w", b10(1), [("a", "int")]),
    ]
    got = {(r[0], int.from_bytes(r[1], "big")): (r["epoch"], json.loads(r["data_json"])) for r in epoch_data_json(log, spark.createDataFrame(history, HISTORY)).collect()}
    every = lambda i: {"a": f"{i}000000000.0000", "b": None if i % 2 else f"b{i}", "d": "2024-01-02T03:04:05Z"}
    assert got["t", 1] == (None, every(1))  # before the first version
    assert got["t", 2] == (1, {"a": "2000000000"}) and got["t", 3] == (1, {"a": "3000000000.0000"})  # beyond an int: as it is
    assert got["t", 4] == (2, {"a": "4000000000.0", "b": "b4"}) and got["t", 5] == (2, {"a": "5000000000.0", "b": None})
    assert got["t", 6] == (3, {"a": "6000000000.0000", "d": "2024-01-02T03:04:05Z"}) and got["t", 7][0] == 3
    assert got["u", 4] == (1, {"b": "b4"}) and got["u", 5] == (2, {})
    assert got["v", 3] == (None, every(3)) and len(got) == 21
    keys = list(json.loads(epoch_data_json(log, spark.createDataFrame([], HISTORY)).first()["data_json"]))
    assert keys == ["a", "b", "d"]


def test_versions_at_one_lsn_are_one(spark):
    h = spark.createDataFrame([("t", b10(1), [("a", "int")]), ("t", b10(1), [("b", "int")]), ("t", b10(9), [("c", "int")])], HISTORY)
    rows = sorted(schema_epochs(h).collect(), key=lambda r: r["epoch"])
    assert [(r["epoch"], r["columns"][0]["name"], r["to_lsn"] and bytes(r["to_lsn"])) for r in rows] == [(1, "b", bytes(b10(9))), (2, "c", None)]


def test_the_history_is_broadcast_and_the_log_not_shuffled(spark):
    log = make_log(spark, [("t", 1, 1, 2, 1, "a")])
    h = spark.createDataFrame([("t", b10(1), [("id", "int")])], HISTORY)
    plan = epoch_data_json(log, h)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

"""Scans of composed functions against plain loops, with a hot key over many chunks and batches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowframe.operators.scan import CLAMPS, automaton, bounded_queue, prefix_compose, release_sequence


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def keyed_rows(n, values, seed):
    """Two thirds of the rows are of one key; null is a key as well."""
    draw = random.Random(seed)
    rows = [(draw.choice(["hot"] * 6 + ["a", "b", None]), i, draw.choice(values)) for i in range(n)]
    draw.shuffle(rows)
    return rows


def by_key(rows):
    out = {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        out.setdefault(k, []).append((i, v))
    return out


def test_functions_compose_in_any_grouping():
    draw = np.random.default_rng(1)
    for fn, own in ((automaton(3), np.concatenate([draw.integers(0, 3, (50, 3)), draw.integers(0, 2, (50, 3))], 1)),
                    (CLAMPS, np.stack([draw.integers(-3, 4, 50), np.zeros(50, int), draw.integers(1, 6, 50), np.arange(50)], 1))):
        first = np.zeros(50, bool)
        first[[0, 20, 21]] = True
        got = prefix_compose(own, first, fn)
        for i in range(50):
            start = max(k for k in (0, 20, 21) if k <= i)
            want = np.array([fn.identity])
            for k in range(start, i + 1):
                want = fn.compose(want, own[k:k + 1])
            assert (got[i] == want[0]).all()


@pytest.mark.parametrize("pattern", [["x"], ["x", "x"], ["x", "y", "x"], ["x", "x", "y", "x", "x"]])
def test_release_sequence(spark, small_batches, pattern):
    rows = keyed_rows(400, ["x", "x", "y", "z", None], len(pattern))
    want = {}
    for k, messages in by_key(rows).items():
        group, tail, mine = 0, [], []
        for i, v in messages:
            tail.append(v)
            mine.append((k, i, group))
            if tail[-len(pattern):] == pattern:
                group, tail = group + 1, []
        want |= {(a, i): (g, g < group) for a, i, g in mine}
    df = spark.createDataFrame(rows, "k string, at long, v string")
    got = release_sequence(df, ["k"], ["at"], "v", pattern, num_partitions=6).collect()
    assert {(r["k"], r["at"]): (r["group_no"], r["released"]) for r in got} == want and len(got) == 400


@pytest.mark.parametrize("capacity,waiting", [(3, 5), (1, 0), (2, 1)])
def test_bounded_queue(spark, small_batches, capacity, waiting):
    rows = keyed_rows(400, [True, True, False], capacity)
    want = {}
    for k, events in by_key(rows).items():
        held, before = 0, None
        for i, put in events:
            spent = max(held - capacity, 0) * (i - before) if before is not None else 0
            refused = put and held == capacity + waiting
            held = min(max(held + (1 if put else -1), 0), capacity + waiting)
            want[k, i] = (min(held, capacity), max(held - capacity, 0), refused, spent)
            before = i
    df = spark.createDataFrame(rows, "k string, at long, put boolean")
    got = bounded_queue(df, ["k"], ["at"], F.col("put"), F.col("at"), capacity, waiting, num_partitions=6).collect()
    assert {(r["k"], r["at"]): (r["depth"], r["blocked"], r["refused"], r["blocked_us"]) for r in got} == want


def test_a_hot_key_is_spread_over_chunks(spark, small_batches):
    rows = [("hot", i, "x" if i % 10 < 4 else "y") for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, at long, v string")
    out = release_sequence(df, ["k"], ["at"], "v", ["x"] * 4, num_partitions=8)
    assert out.agg(F.max("group_no")).first()[0] == 500
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan  # chunks are joined with what came before them, never sorted into one task


def test_empty(spark):
    df = spark.createDataFrame([], "k string, at long, v string")
    assert release_sequence(df, ["k"], ["at"], "v", ["x"]).collect() == []

"""Streaming operators over several micro-batches (one input file per batch)."""

import datetime as dt
import json
import os
import time

import pytest

from flowframe.functions.scalar import ntz_literal
from flowframe.streaming.delayer import delay_batch, stream_delayer
from flowframe.streaming.group_release import stream_group_release
from flowframe.streaming.jobs import copy_orders_batch, stream_accept_once, stream_tick_window
from flowframe.streaming.runner import read_batches, run_available_now

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "corr_id string, seq_no int, seq_size int, payload string, arrival_ts timestamp_ntz"


def _write_batches(spark, base, batches, schema):
    """One parquet file per batch, with increasing modification times so the
    file source takes them in order."""
    os.makedirs(base, exist_ok=True)
    now = time.time() - 1000
    for i, rows in enumerate(batches):
        tmp = f"{base}_tmp{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
        dst = f"{base}/b{i:03d}.parquet"
        os.rename(f"{tmp}/{part}", dst)
        os.utime(dst, (now + i * 10, now + i * 10))


def _at(s):
    return T0 + dt.timedelta(seconds=s)


def _cuts(batches):
    """The same rows one file per micro-batch, in the given and in the opposite order, and all at once."""
    return {"given": batches, "reversed": batches[::-1], "one": [[r for b in batches for r in b]]}


def _stream(spark, base, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(base)


@pytest.mark.parametrize("cut", ["given", "reversed", "one"])
def test_group_release_does_not_depend_on_the_cut(spark, tmp_path, cut):
    base = str(tmp_path / "in")
    _write_batches(spark, base, _cuts([
        [("A", 1, 3, "A1", _at(1)), ("B", 1, 1, "B1", _at(2)), ("E", 3, 2, "E3", _at(7200))],
        [("A", 2, 4, "A2", _at(3)), ("A", 3, 5, "A3", _at(4)), ("B", 2, 1, "B2", _at(5))],
        [("C", 1, 2, "C1", _at(100)), ("D", 1, 2, "D1", _at(9000)), (None, 1, 1, "N1", _at(3))],
        [("Z", 1, 5, "Z1", _at(10000)), ("A", 4, 9, "A4", _at(20000))],
        [("E", 1, 2, "E1", _at(1)), ("E", 2, 2, "E2", _at(2))],  # hours behind what came before
    ])[cut], SCHEMA)
    out = stream_group_release(_stream(spark, base, SCHEMA), str(tmp_path / "run"), "corr_id", ["arrival_ts", "seq_no"], "seq_size",
                               "payload", "arrival_ts", timeout_seconds=3, as_of=ntz_literal(_at(9002)))
    got = sorted((str(r["corr_id"]), r["outcome"], r["payloads"]) for r in out.collect())
    assert got == [("A", "late", "A4"), ("A", "released", "A1 A2 A3"), ("B", "late", "B2"), ("B", "released", "B1"),
                   ("C", "discarded", "C1"), ("D", "pending", "D1"), ("E", "late", "E3"), ("E", "released", "E1 E2"),
                   ("None", "released", "N1"), ("Z", "pending", "Z1")]


def test_a_timed_out_group_starts_again(spark, tmp_path):
    base = str(tmp_path / "in")
    _write_batches(spark, base, [[("T", i, 2, f"T{i}", _at(i * 10))] for i in range(3)] + [[("T", 9, 2, "T9", _at(21))]], SCHEMA)
    out = stream_group_release(_stream(spark, base, SCHEMA), str(tmp_path / "run"), "corr_id", ["arrival_ts"], "seq_size", "payload",
                               "arrival_ts", timeout_seconds=3)
    assert sorted((r["outcome"], r["payloads"]) for r in out.collect()) == [
        ("discarded", "T0"), ("discarded", "T1"), ("released", "T2 T9")]


def test_intake_goes_on_after_a_restart(spark, tmp_path):
    base, run = str(tmp_path / "in"), str(tmp_path / "run")
    args = ("corr_id", ["arrival_ts"], "seq_size", "payload", "arrival_ts")
    _write_batches(spark, base, [[("A", 1, 2, "A1", _at(1))]], SCHEMA)
    out = stream_group_release(_stream(spark, base, SCHEMA), run, *args)
    assert [r["outcome"] for r in out.collect()] == ["pending"]
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        spark.createDataFrame([("A", 2, 2, "A2", _at(9))], SCHEMA).coalesce(1).write.mode("append").parquet(base)
        out = stream_group_release(_stream(spark, base, SCHEMA), run, *args)
        assert [tuple(r) for r in out.collect()] == [("A", "released", 2, "A1 A2")]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


DELAYED = "id long, k string, ts timestamp_ntz, release_ts timestamp_ntz"


@pytest.mark.parametrize("cut", ["given", "reversed", "one"])
def test_every_delayed_message_leaves_once(spark, tmp_path, cut):
    base = str(tmp_path / "in")
    _write_batches(spark, base, _cuts([
        [(1, "a", _at(0), _at(3)), (2, "a", _at(1), _at(3)), (3, "b", _at(1), _at(50))],
        [(4, "a", _at(10), _at(12)), (5, "c", _at(100), _at(9999))],
        [(6, "d", _at(-500), _at(-400)), (7, "d", _at(-500), None)],
    ])[cut], DELAYED)
    out = stream_delayer(_stream(spark, base, DELAYED), str(tmp_path / "run"), "ts", "release_ts", as_of=ntz_literal(_at(1000)))
    assert sorted((r["id"], r["release_ts"]) for r in out.collect()) == [
        (1, _at(3)), (2, _at(3)), (3, _at(50)), (4, _at(12)), (6, _at(-400))]
    # without the closing time only the clock of the arrivals counts: 100 s
    out = stream_delayer(_stream(spark, base, DELAYED), str(tmp_path / "run"), "ts", "release_ts")
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 3, 4, 6]


def test_held_messages_are_written_once_and_past_slots_go(spark, tmp_path):
    base, run = str(tmp_path / "in"), str(tmp_path / "run")
    # one message a batch; message i is held for 250 s, that is over the next two batches, in slots of 100 s
    _write_batches(spark, base, [[(i, "a", _at(100 * i), _at(100 * i + 250))] for i in range(6)], DELAYED)
    out = stream_delayer(_stream(spark, base, DELAYED), run, "ts", "release_ts", slot_seconds=100)
    assert sorted(r["id"] for r in out.collect()) == [0, 1, 2]
    by_batch = read_batches(spark, run, "out", out.schema).collect()
    assert sorted((r["batch_id"], r["id"]) for r in by_batch) == [(3, 0), (4, 1), (5, 2)]
    held = spark.read.schema(f"{DELAYED}, _slot long, batch_id long").parquet(f"{run}/held").collect()
    assert sorted((r["id"], r["batch_id"]) for r in held) == [(2, 2), (3, 3), (4, 4), (5, 5)]  # slots up to 400 s are gone
    # a restart goes on at the clock, and what it releases has been held by the run before
    spark.createDataFrame([(9, "a", _at(640), _at(700))], DELAYED).coalesce(1).write.mode("append").parquet(base)
    out = stream_delayer(_stream(spark, base, DELAYED), run, "ts", "release_ts", slot_seconds=100)
    assert sorted(r["id"] for r in out.collect()) == [0, 1, 2, 3]
    out = stream_delayer(_stream(spark, base, DELAYED), run, "ts", "release_ts", as_of=ntz_literal(_at(740)), slot_seconds=100)
    assert sorted(r["id"] for r in out.collect()) == [0, 1, 2, 3, 4, 9]


def test_a_delayer_batch_that_runs_again_replaces_its_own_rows(spark, tmp_path):
    base = str(tmp_path)
    body = delay_batch(base, "ts", "release_ts", 100)
    first = spark.createDataFrame([(1, "a", _at(0), _at(150)), (2, "a", _at(0), None)], DELAYED)
    second = spark.createDataFrame([(3, "a", _at(160), _at(170)), (4, "a", _at(160), _at(100))], DELAYED)
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        body(batch, number)
    out = read_batches(spark, base, "out", first.schema).collect()
    assert sorted((r["batch_id"], r["id"]) for r in out) == [(1, 1), (1, 4)]
    held = spark.read.schema(f"{DELAYED}, _slot long, batch_id long").parquet(f"{base}/held").collect()
    assert sorted((r["id"], r["batch_id"]) for r in held) == [(1, 0), (2, 0), (3, 1)]


@pytest.mark.parametrize("cut", ["given", "reversed", "one"])
def test_windows_count_late_rows(spark, tmp_path, cut):
    base, schema = str(tmp_path / "in"), "id long, ts timestamp_ntz"
    _write_batches(spark, base, _cuts([[(1, _at(36000)), (2, _at(36001))], [(3, _at(10))], [(4, _at(36002)), (5, _at(3599))]])[cut], schema)
    out = stream_tick_window(_stream(spark, base, schema), str(tmp_path / "run"), "ts", "1 hour", "id")
    assert sorted(tuple(r) for r in out.collect()) == [(_at(3600), 2, 3, 5), (_at(39600), 3, 1, 4)]


@pytest.mark.parametrize("cut", ["given", "reversed", "one"])
def test_a_path_is_accepted_once_however_late(spark, tmp_path, cut):
    base, schema = str(tmp_path / "in"), "path string, ts timestamp_ntz"
    _write_batches(spark, base, _cuts([[("/a/x", _at(0)), ("/a/.hidden", _at(0))], [("/a/x", _at(40 * 86400)), ("/a/y", _at(1))],
                                       [("/a/x", _at(1)), ("/b/x", _at(2))]])[cut], schema)
    out = run_available_now(stream_accept_once(_stream(spark, base, schema), "path", "ts"), "once", base=str(tmp_path / "run"))
    assert sorted(r["path"] for r in out.collect()) == ["/a/x", "/a/y", "/b/x"]


def test_copy_job_claims_copies_and_deletes(spark, tmp_path):
    schema = "o_orderkey long, o_orderstatus string"
    base = str(tmp_path / "run")
    run = copy_orders_batch(spark, base, "o_orderkey", "o_orderstatus", "F", "C")
    first = spark.createDataFrame([(1, "F"), (2, "O"), (3, "F"), (5, "C")], schema)
    run(first, 0)
    run(first, 0)  # run again after a failure at the end
    second = spark.createDataFrame([(4, "F")], schema)
    spark.createDataFrame([(99, "F")], schema).write.parquet(f"{base}/claimed/batch_id=1")  # died after the first step
    run(second, 1)
    target = read_batches(spark, base, "target", spark.createDataFrame([], "order_id long").schema)
    source = read_batches(spark, base, "source", first.schema)
    assert sorted((r["batch_id"], r["order_id"]) for r in target.collect()) == [(0, 1), (0, 3), (1, 4)]
    assert sorted((r["o_orderkey"], r["o_orderstatus"]) for r in source.collect()) == [(2, "O"), (5, "C")]


# ------------------------------------------------------------------ groups as keyed state
GROUPS = "corr_id string, arrival_no long, seq_size long, payload string, arrival_ts timestamp"


def _group_run(spark, base, run, timeout_ms=3000, remember_ms=None):
    from pyspark.sql import functions as F

    from flowframe.streaming.group_state import group_state, run_group_state

    out = group_state(_stream(spark, base, GROUPS), "corr_id", "arrival_no", "seq_size", "payload", F.col("arrival_ts"),
                      "1 second", timeout_ms, remember_ms)
    return sorted((str(r["corr_id"]), r["outcome"], r["payloads"]) for r in run_group_state(out, run).collect())


def _ids(spark, run, closed):
    state = spark.read.format("statestore").option("stateVarName", "group").load(f"{run}/_checkpoint")
    return {r["key"]["corr_id"] for r in state.collect() if r["value"]["closed"] == closed}


def _messages(rows):
    return [(i, no, size, p, _at(s)) for i, no, size, p, s in rows]


FIRST = [_messages(b) for b in (
    [("A", 1, 3, "A1", 1), ("B", 2, 1, "B1", 2), ("A", 3, 9, "A2", 3)],
    [("A", 4, 9, "A3", 4), ("B", 5, 1, "B2", 5)],
    [("C", 6, 2, "C1", 100), (None, 7, 1, "N1", 101)],
    [("D", 8, 2, "D1", 102), ("A", 9, 3, "A4", 102)])]
LATER = [_messages(b) for b in (
    [("D", 10, 2, "D2", 104), ("E", 11, 2, "E1", 104)],
    [("E", 12, 3, "E2", 108)],  # over its timeout: gives E1 up itself
    [("F", 13, 5, "F1", 200)],
    [("Z", 14, 5, "Z1", 203)])]


def test_group_state_over_many_batches_and_a_restart(spark, tmp_path):
    base, run = str(tmp_path / "in"), str(tmp_path / "run")
    _write_batches(spark, base, FIRST, GROUPS)
    first = _group_run(spark, base, run)
    assert first == [("A", "late", "A4"), ("A", "released", "A1 A2 A3"), ("B", "late", "B2"), ("B", "released", "B1"),
                     ("None", "released", "N1")]
    assert _ids(spark, run, False) == {"C", "D"} and _ids(spark, run, True) == {"A", "B", None}
    for name in os.listdir(base):  # what was taken in is not read again
        os.truncate(f"{base}/{name}", 0)
    more = str(tmp_path / "more")
    _write_batches(spark, more, LATER, GROUPS)
    for name in os.listdir(more):
        os.rename(f"{more}/{name}", f"{base}/later-{name}")
    second = _group_run(spark, base, run)
    assert sorted(set(second) - set(first)) == [
        ("C", "discarded", "C1"), ("D", "released", "D1 D2"), ("E", "discarded", "E1"), ("E", "discarded", "E2")]
    assert _ids(spark, run, False) == {"F", "Z"}


def test_marks_of_closed_groups_are_forgotten(spark, tmp_path):
    base, run = str(tmp_path / "in"), str(tmp_path / "run")
    _write_batches(spark, base, [_messages(b) for b in (
        [("A", 1, 1, "A1", 1)], [("A", 2, 1, "A2", 3)], [("B", 3, 1, "B1", 100)], [("C", 4, 9, "C1", 101)], [("A", 5, 1, "A3", 102)])], GROUPS)
    assert _group_run(spark, base, run, None, 10_000) == [
        ("A", "late", "A2"), ("A", "released", "A1"), ("A", "released", "A3"), ("B", "released", "B1")]


def test_messages_behind_the_lateness_fail_the_run(spark, tmp_path):
    base = str(tmp_path / "in")
    _write_batches(spark, base, [_messages(b) for b in (
        [("A", 1, 2, "A1", 1000)], [("B", 2, 2, "B1", 2000)], [("A", 3, 2, "A2", 5)])], GROUPS)
    with pytest.raises(ValueError, match="further behind"):
        _group_run(spark, base, str(tmp_path / "run"))


def test_group_state_in_buckets_is_that_by_id(spark, tmp_path):
    """ids that share a bucket share one value and one timer, over batches and a restart, with the same outcomes."""
    from pyspark.sql import functions as F

    from flowframe.streaming.group_state import group_state, run_group_state

    def row(b, i):
        at = b * 10 + i % 9
        return (None if i % 40 == 39 else f"k{i * 7 % 40}", b * 100 + i, None if i % 11 == 3 else i % 4 + 1,
                None if i % 13 == 5 else f"p{b}-{i}", _at(at))

    base, more = str(tmp_path / "in"), str(tmp_path / "more")
    _write_batches(spark, base, [[row(b, i) for i in range(b, 90, 3)] for b in range(3)], GROUPS)
    _write_batches(spark, more, [[row(4, i) for i in range(0, 90, 5)], [("Z", 900, 5, "Z1", _at(75))], [("Y", 901, 2, "Y1", _at(76))]], GROUPS)

    def run(name, buckets):
        out = group_state(_stream(spark, base, GROUPS), "corr_id", "arrival_no", "seq_size", "payload", F.col("arrival_ts"),
                          "20 seconds", 12_000, 25_000, buckets)
        return sorted((tuple(r) for r in run_group_state(out, str(tmp_path / name)).collect()), key=str)

    first = run("ids", None), run("buckets", 3)
    for name in os.listdir(more):
        os.rename(f"{more}/{name}", f"{base}/later-{name}")
    second = run("ids", None), run("buckets", 3)
    assert first[0] == first[1] and second[0] == second[1] and len(second[0]) > len(first[0])
    assert {r[1] for r in second[0]} == {"released", "late", "discarded"}
    state = spark.read.format("statestore").option("stateVarName", "bucket").load(str(tmp_path / "buckets" / "_checkpoint"))
    assert state.count() <= 3
    # forgotten marks and given up groups leave their bucket too
    left = state.select("value.groups").collect()
    assert {g[0] for r in left for g in json.loads(r[0])} == _ids(spark, str(tmp_path / "ids"), False) | _ids(spark, str(tmp_path / "ids"), True)


# ------------------------------------------------------------------ lines and results as two streams
LINE = "id int, k int, at timestamp"


def _join_run(spark, tmp_path, lines, results, name):
    from pyspark.sql import functions as F

    from flowframe.streaming.status_join import run_status_join, split_late, status_join

    sides, late = [], []
    for side, batches in (("lines", lines), ("results", results)):
        base = str(tmp_path / f"{name}-{side}")
        _write_batches(spark, base, batches, LINE)
        kept, gone = split_late(_stream(spark, base, LINE), f"{base}-taken", F.col("at"), "10 seconds")
        sides.append(kept)
        late += sorted(r["id"] for r in gone.collect())
    out, held = run_status_join(status_join(*sides, "k", F.col("at"), F.col("at"), "5 seconds", "10 seconds"), str(tmp_path / f"{name}-run"))
    return sorted(((r["id"], r["result_id"]) for r in out.collect() if r["id"] < 900), key=str), late, held


@pytest.mark.parametrize("cut", ["given", "one"])
def test_status_join_in_any_cut(spark, tmp_path, cut):
    lines = [[(1, 1, _at(0)), (2, 2, _at(1))], [(3, 1, _at(6)), (4, None, _at(7))], [(5, 3, _at(30))], [(900, -1, _at(1000))]]
    results = [[(10, 1, _at(5)), (11, 2, _at(0))], [(12, 1, _at(11)), (13, 1, _at(12))], [(14, 3, _at(30)), (15, 3, _at(35))], [(901, -1, _at(1000))]]
    got, late, held = _join_run(spark, tmp_path, _cuts(lines)[cut], _cuts(results)[cut], cut)
    assert got == sorted([(1, 10), (2, None), (3, 12), (4, None), (5, 14), (5, 15)], key=str)
    assert late == [] and held <= 4  # what lies behind the watermark has left the state store


def test_late_lines_and_results_are_kept_aside(spark, tmp_path):
    lines = [[(1, 1, _at(100))], [(2, 1, _at(50)), (3, 1, _at(95))], [(900, -1, _at(1000))]]
    results = [[(10, 1, _at(101))], [(11, 1, _at(99)), (12, 1, _at(2)), (13, 1, None)], [(901, -1, _at(1000))]]
    got, late, _ = _join_run(spark, tmp_path, lines, results, "late")
    assert got == sorted([(1, 10), (3, 11)], key=str) and late == [2, 12, 13]


# ------------------------------------------------------------------ resequencing while messages come
SEQ = "corr_id string, seq_no int, seq_size int, line string"


@pytest.mark.parametrize("whole", [False, True])
def test_resequence_over_batches_and_a_restart(spark, tmp_path, whole):
    from flowframe.streaming.resequence import run_resequence, stream_resequence

    base, run = str(tmp_path / "in"), str(tmp_path / "run")

    def go():
        out = run_resequence(stream_resequence(_stream(spark, base, SEQ), "corr_id", "seq_no", "seq_size", "line", whole), run)
        return sorted((r["corr_id"], r["seq_no"], r["payload"]) for r in out.collect())

    rows = lambda key, size, *numbers: [(key, n, size, f"{key}{n}") for n in numbers]
    _write_batches(spark, base, [rows("A", 4, 3, 2), rows("B", 2, 2, 1) + rows("C", 3, 1, 3)], SEQ)
    first = go()
    assert first == ([("B", 1, "B1"), ("B", 2, "B2")] if whole else [("B", 1, "B1"), ("B", 2, "B2"), ("C", 1, "C1")])
    more = str(tmp_path / "more")
    _write_batches(spark, more, [rows("A", 4, 1, 2)[:1] + rows("D", 1, 1), rows("A", 4, 4)], SEQ)
    for name in os.listdir(more):
        os.rename(f"{more}/{name}", f"{base}/later-{name}")
    left = go()
    assert left == sorted([*first, *[("A", n, f"A{n}") for n in range(1, 5)], ("D", 1, "D1")])
    state = spark.read.format("statestore").option("stateVarName", "waiting").load(f"{run}/_checkpoint").collect()
    assert {(r["key"]["corr_id"], r["value"]["next"], tuple(r["value"]["numbers"])) for r in state} == {
        ("C", 1, (1, 3)) if whole else ("C", 2, (3,))}


@pytest.mark.parametrize("whole", [False, True])
def test_resequence_in_buckets_is_that_by_id(spark, tmp_path, whole):
    """groups that share a bucket share one value, and leave as they do by id."""
    from flowframe.streaming.resequence import run_resequence, stream_resequence

    rows = [(None if k == 5 else f"k{k}", n, k + 1, None if n == 2 else f"{k}-{n}") for k in range(12) for n in range(1, k + 2) if (k, n) != (9, 4)]
    rows.sort(key=lambda r: (r[1] * 7 + r[2] * 5) % 11)
    base = str(tmp_path / "in")
    _write_batches(spark, base, [rows[i::3] for i in range(3)], SEQ)

    def run(name, buckets):
        out = stream_resequence(_stream(spark, base, SEQ), "corr_id", "seq_no", "seq_size", "line", whole, buckets)
        return sorted((tuple(r) for r in run_resequence(out, str(tmp_path / name)).collect()), key=str)

    by_id = run("ids", None)
    assert run("buckets", 2) == by_id and len(by_id) == len(rows) - (9 if whole else 6)
    state = spark.read.format("statestore").option("stateVarName", "bucket").load(str(tmp_path / "buckets" / "_checkpoint")).collect()
    assert [g[:2] for r in state for g in json.loads(r["value"]["groups"])] == [["k9", 1 if whole else 4]]


@pytest.mark.parametrize("order", ["at", "same"])
def test_more_rows_make_larger_portions_not_more(spark, tmp_path, order):
    """The number of micro-batches does not grow with the rows, and portions keep the order, empty ones too."""
    from pyspark.sql import functions as F

    from flowframe.streaming.runner import batch_dir, read_batches, run_batches, stage_in_order

    df = spark.range(200).select("id", (F.col("id") * 37 % 200).alias("at"), F.lit(1).alias("same"))
    base = str(tmp_path)
    stream = stage_in_order(df, [order], base, files=4, rows_a_file=10)
    taken = []
    run_batches(stream, lambda batch, i: taken.append(i) or batch.write.parquet(batch_dir(base, "out", i)), f"{base}/run")
    assert len(taken) == 4
    out = read_batches(spark, base, "out", stream.schema).orderBy("arrival_no").collect()
    assert sorted(r["id"] for r in out) == [*range(200)]
    assert [r["batch_id"] for r in out] == sorted(r["batch_id"] for r in out)
    if order == "at":
        assert [r["at"] for r in out] == [*range(200)] and {r["batch_id"] for r in out} == {0, 1, 2, 3}


# ------------------------------------------------------------------ group outcomes at size
@pytest.mark.parametrize("timeout", [None, 3])
def test_outcomes_of_heavy_ids_are_those_of_light_ones(spark, monkeypatch, timeout):
    """ids that one task can hold are dealt once, so the plan has one exchange by id and writes no table."""
    from pyspark.sql import functions as F

    from flowframe.operators import sequence
    from flowframe.streaming import group_release

    df = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 400).alias("k"), F.col("id").alias("i"), (F.col("id") % 7 + 1).alias("size"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("p"), "id")).alias("p"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id div 400 * (id % 5))").alias("at"))
    staged = []
    real = group_release.keyed_scan
    monkeypatch.setattr(group_release, "keyed_scan", lambda *a, **o: staged.append(1) or real(*a, **o))

    def outcomes():
        out = group_release.group_outcomes(df, "k", ["at", "i"], "size", "p", "at", timeout, ntz_literal(_at(20)))
        return sorted((tuple(r) for r in out.collect()), key=str), out

    light, out = outcomes()
    assert not staged and out._jdf.queryExecution().sparkPlan().toString().count("Exchange") <= 1 and len({r[1] for r in light}) > 2 - (timeout is None)
    monkeypatch.setattr(sequence, "TASK_ROWS", 500)
    assert outcomes()[0] == light and staged


def test_a_staged_table_of_many_files_makes_few_micro_batches(spark, tmp_path):
    """the number of micro-batches does not grow with the files, and a bucket of the log is not cut by every task."""
    from flowframe.plans import streams

    df = spark.range(400).selectExpr("id % 4 as k", "id as i", "100L as size", "cast(id as string) as p").repartition(9)
    df.write.parquet(str(tmp_path / "in"))
    out = stream_group_release(streams._stream(df, str(tmp_path)), str(tmp_path / "run"), "k", ["i"], "size", "p", "i")
    assert out.filter("outcome = 'released'").count() == 4
    batches = os.listdir(tmp_path / "run" / "log")
    assert len([b for b in batches if b.startswith("batch_id=")]) <= streams.MICRO_BATCHES
    assert all(len([f for f in os.listdir(d.path) if f.endswith(".parquet")]) == 1
               for d in os.scandir(tmp_path / "run" / "log" / "batch_id=0") if d.is_dir())

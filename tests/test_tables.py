"""Keyed writes, paging and diffs on small tables with duplicate changes."""

import pytest
from pyspark.sql import functions as F

from flowframe.operators import tables as TB
from flowframe.operators.grouping import release_declared, release_predicate, release_sum
from flowframe.operators.retry import COMPOSITE_3_10S_FIXED5S, FIXED_5X2S, RetryPolicy, retry_status


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=str)


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([(1, 5, "a"), (2, 1, "b"), (3, 0, "c")], "id int, version int, v string")


def test_one_winner_per_version(spark, stored):
    changes = spark.createDataFrame([(1, 5, "x", 2), (1, 5, "y", 1), (1, 4, "z", 0), (2, 0, "q", 1), (9, 1, "n", 1)],
                                    "id int, expected int, new string, at int")
    out, snap = TB.versioned_update(stored, changes, "id", "version", "expected", {"v": "new"}, ["at"])
    assert rows(out, "id", "new", "outcome", "version", "affected") == sorted([
        (1, "y", "updated", 6, 1), (1, "x", "stale", 5, 0), (1, "z", "stale", 5, 0), (2, "q", "stale", 1, 0), (9, "n", "missing", None, 0)], key=str)
    assert snap.schema["version"].dataType == stored.schema["version"].dataType
    assert rows(snap) == [(1, 6, "y"), (2, 1, "b"), (3, 0, "c")]


def test_identical_changes_have_one_winner(spark, stored):
    changes = spark.createDataFrame([(2, 1, "same")] * 3, "id int, expected int, new string")
    out, snap = TB.versioned_update(stored, changes, "id", "version", "expected", {"v": "new"})
    assert sorted(r["outcome"] for r in out.collect()) == ["stale", "stale", "updated"]
    assert rows(snap) == [(1, 5, "a"), (2, 2, "same"), (3, 0, "c")]


def test_versioned_delete(spark, stored):
    changes = spark.createDataFrame([(1, 5), (1, 5), (2, 7), (8, 0)], "id int, expected int")
    out, snap = TB.versioned_delete(stored, changes, "id", "version", "expected")
    assert rows(out, "id", "outcome") == [(1, "deleted"), (1, "stale"), (2, "stale"), (8, "missing")]
    assert rows(snap) == [(2, 1, "b"), (3, 0, "c")]


def test_upsert_takes_the_last_change_of_a_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    changes = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (3, "n1", 5), (3, "n2", 5), (4, None, 1)], "id int, v string, at int")
    assert rows(TB.keyed_upsert(target, changes, "id", ["at"])) == [(1, "new"), (2, "b"), (3, "n2"), (4, None)]
    assert rows(TB.keyed_delete(target, changes, "id")) == [(2, "b")]


def test_append_takes_a_key_once(spark):
    new = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, v string")
    first = TB.table_append(None, new, ["id", "v"], key="id")
    assert rows(first) == [(1, "a"), (2, "c")]
    assert rows(TB.table_append(first, new, ["id", "v"], key="id")) == [(1, "a"), (2, "c")]


def test_pages(spark):
    df = spark.range(95).select((F.lit(94) - F.col("id")).alias("k"), F.lit("x").alias("v"))
    for page, want in ((0, range(0, 10)), (9, range(90, 95)), (10, range(0))):
        got = TB.page_with_total(df, ["k"], page, 10).orderBy("k").collect()
        assert [r["k"] for r in got] == list(want) and all(r["total"] == 95 for r in got)


def test_diff_counts_repeated_rows_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "[null]")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "y"), (2, "y"), (3, None)], "k int, v string")
    assert rows(TB.table_diff(a, b)) == sorted([(1, None, "expected"), (2, "x", "expected"), (2, "y", "actual"), (2, "y", "actual")], key=str)


def test_sheet_ends_at_the_first_blank(spark):
    sheet = spark.createDataFrame([(0, "head"), (1, "a"), (2, "b"), (3, " "), (4, "c")], "i int, name string")
    assert rows(TB.sheet_until_blank(sheet, "i", "name")) == [(1, "a"), (2, "b")]
    assert rows(TB.sheet_until_blank(sheet.filter("i < 3"), "i", "name")) == [(1, "a"), (2, "b")]


def test_select_by_id_version_raises_when_nothing_is_there(spark, stored):
    assert rows(TB.select_by_id_version(stored, "id", 1, "version", 5)) == [(1, 5, "a")]
    with pytest.raises(TB.NoResultError):
        TB.select_by_id_version(stored, "id", 1, "version", 6)


def test_side_of_each_row_null_keys_included(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(TB.semi_anti_side(df, keys, "k")) == [(1, "semi"), (2, "anti"), (None, "anti")]


def test_release_predicate_has_no_limit_and_restarts(spark):
    df = spark.range(11).select(F.lit("k").alias("k"), F.col("id"), F.col("id").cast("string").alias("p"))
    for predicate, lists in (("n >= 3", ["0 1 2", "3 4 5", "6 7 8"]), ("n * n > 50", ["0 1 2 3 4 5 6 7"]), ("n > 1000000000", [])):
        got = release_predicate(df, ["k"], ["id"], predicate, "p", sep=" ").orderBy("group_no").collect()
        assert [r["payloads"] for r in got] == lists


def test_declared_groups_start_again(spark):
    sizes = {"a": [3, 1, 9, 2, 5, 1, 4, 1, 1], "b": [2, 7], "c": [5, 1], "d": [0, None, 1], None: [1, 2, 2]}
    df = spark.createDataFrame([(k, i, s, f"{k}{i}") for k, v in sizes.items() for i, s in enumerate(v)], "k string, i int, size int, p string")
    got = rows(release_declared(df, "k", ["i"], "size", "p", sep=" "))
    assert got == sorted([("a", 0, 3, "a0 a1 a2"), ("a", 1, 2, "a3 a4"), ("a", 2, 1, "a5"), ("b", 0, 2, "b0 b1"),
                          ("d", 0, 1, "d0"), ("d", 1, 1, "d1"), ("d", 2, 1, "d2"), (None, 0, 1, "None0"), (None, 1, 2, "None1 None2")], key=str)
    long = spark.range(3000).select(F.lit("x").alias("k"), "id", F.lit(1).alias("size"), F.col("id").cast("string").alias("p"))
    assert release_declared(long, "k", ["id"], "size", "p", sep=" ").count() == 3000


def test_groups_are_released_by_their_sum(spark):
    values = {"a": [3, 0, 7, 10, 2, 2, 2, 2, 2, 9], "b": [9], "c": [0, 0, 10, None, 40], None: [5, 5, 5]}
    df = spark.createDataFrame([(k, i, v, f"{k}{i}") for k, vs in values.items() for i, v in enumerate(vs)], "k string, i int, v int, p string")
    assert rows(release_sum(df, "k", ["i"], "v", 10, "p", sep=" ")) == sorted([
        ("a", 0, 3, "a0 a1 a2"), ("a", 1, 1, "a3"), ("a", 2, 5, "a4 a5 a6 a7 a8"), ("c", 0, 3, "c0 c1 c2"), ("c", 1, 2, "c3 c4"),
        (None, 0, 2, "None0 None1")], key=str)
    assert rows(release_sum(df, "k", ["i"], "v", 0, "p", sep=" ").filter("k = 'a'").select("group_size")) == [(1,)] * 10


LOG = "m string, at int, ok boolean, error_class string, error_message string"


def status(spark, log, policy):
    df = spark.createDataFrame(log, LOG).withColumn("ts", F.expr("timestampadd(second, at, timestamp_ntz'2024-01-01 00:00:00')"))
    out = retry_status(df, "m", "ts", "ok", policy)
    second = lambda c: (F.expr(f"timestampdiff(second, timestamp_ntz'2024-01-01 00:00:00', {c})")).alias(c)
    return {r["m"]: tuple(r)[1:] for r in out.select(
        "m", "outcome", "attempts", second("first_at"), second("last_at"), second("next_attempt_at"), "last_error").collect()}


def test_status_ends_with_the_first_success(spark):
    log = [("s", 0, True, None, None), ("s", 60, False, "E", "after"), ("f", 0, False, "E", "e0"), ("f", 2, False, "E", "e1"),
           ("x", 0, False, "E", "x0"), ("x", 1, False, "E", "x1"), ("x", 2, False, "E", "x2"), ("x", 3, False, "E", "x3"),
           ("x", 4, False, "E", "x4"), ("x", 5, True, None, None)]
    assert status(spark, log, FIXED_5X2S) == {
        "s": ("succeeded", 1, 0, 0, None, None), "f": ("due", 2, 0, 2, 4, "e1"), "x": ("exhausted", 5, 0, 4, None, "x4")}


def test_status_reads_elapsed_time_from_the_log(spark):
    late = [("a", 0, False, "E", "e0"), ("a", 9, False, "E", "e1"), ("a", 12, True, None, None), ("b", 0, False, "E", "b0")]
    # 10 s at most and 5 s between: after the attempt at 9 s none may follow; the one at 12 s does not count
    assert status(spark, late, COMPOSITE_3_10S_FIXED5S) == {"a": ("exhausted", 2, 0, 9, None, "e1"), "b": ("due", 1, 0, 0, 5, "b0")}
    once = RetryPolicy("never", never=True)
    assert status(spark, late, once) == {"a": ("exhausted", 1, 0, 0, None, "e0"), "b": ("exhausted", 1, 0, 0, None, "b0")}


def test_groups_of_heavy_keys_are_those_of_light_ones(spark, monkeypatch):
    """keys that one task can hold are walked there without jumps; a key with many rows gives the same groups."""
    from pyspark.sql import functions as F

    from flowframe.operators import grouping, sequence

    df = spark.range(30_000).select(
        F.when(F.col("id") % 10 > 2, F.lit(1)).when(F.col("id") % 10 == 1, F.col("id")).alias("k"), F.col("id").alias("i"),
        (F.col("id") * 7 % 5).alias("v"), F.when(F.col("id") % 11 > 0, F.concat(F.lit("p"), "id")).alias("p"))
    jumps = []
    real = grouping._released_runs
    monkeypatch.setattr(grouping, "_released_runs", lambda *a: jumps.append(1) or real(*a))

    def both():
        return [rows(release_declared(df, "k", ["i"], "v", "p", sep=" ")), rows(release_sum(df, "k", ["i"], "v", 9, "p", sep=" "))]

    light = both()
    assert not jumps and all(len(x) > 3000 for x in light)
    monkeypatch.setattr(sequence, "TASK_ROWS", 1000)
    assert both() == light and len(jumps) == 2

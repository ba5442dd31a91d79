"""Replays of the reference's own test cases on small fixtures (FIXTURES.md)."""

import datetime as dt

from pyspark.sql import functions as F

from flowframe.operators import grouping as G
from flowframe.operators import split as X
from flowframe.operators import tables as TB

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _groups(spark, rows, extra=""):
    schema = "corr_id string, seq_no int, seq_size int, payload string, arrival_ts timestamp_ntz" + extra
    return spark.createDataFrame(rows, schema)


def test_first_size_wins(spark):
    # A1 (1,3), A2 (2,4), A3 (3,5) -> one list [A1, A2, A3] of size 3
    rows = [("A", i, s, f"A{i}", T0 + dt.timedelta(seconds=i)) for i, s in ((1, 3), (2, 4), (3, 5))]
    out = G.seq_size_aggregate(_groups(spark, rows), "corr_id", ["arrival_ts", "seq_no"], "seq_size", "payload").collect()
    assert len(out) == 1
    assert out[0]["payloads"] == ["A1", "A2", "A3"] and out[0]["group_size"] == 3


def test_late_message_after_completion_is_discarded(spark):
    # A1 (1,1) released; A2 (2,1) arrives after completion -> discard
    rows = [("A", 1, 1, "A1", T0), ("A", 2, 1, "A2", T0 + dt.timedelta(seconds=1))]
    df = _groups(spark, rows)
    rel = G.seq_size_aggregate(df, "corr_id", ["arrival_ts"], "seq_size", "payload").collect()
    late = G.late_discard(df, "corr_id", ["arrival_ts"], "seq_size", ).collect()
    assert [r["payloads"] for r in rel] == [["A1"]]
    assert [r["payload"] for r in late] == ["A2"]


def test_two_inputs_one_group(spark):
    # A1 by input 1, A2 by input 2, A3 by input 1 a second later -> [A1, A2, A3]
    a = _groups(spark, [("A", 1, 3, "A1", T0), ("A", 3, 3, "A3", T0 + dt.timedelta(seconds=2))])
    b = _groups(spark, [("A", 2, 3, "A2", T0 + dt.timedelta(seconds=1))])
    out = G.multi_input_aggregate([a, b], "corr_id", ["arrival_ts"], "seq_size", "payload").collect()
    assert out[0]["payloads"] == ["A1", "A2", "A3"]


def test_pending_group_is_not_released(spark):
    rows = [("B", 1, 3, "B1", T0), ("B", 2, 3, "B2", T0)]
    states = {r["payload"]: r["state"] for r in G.sequence_groups(_groups(spark, rows), "corr_id", ["seq_no"], "seq_size").collect()}
    assert states == {"B1": "pending", "B2": "pending"}


def test_count_aggregate_zundoko(spark):
    # a group of five equal to [zun x4, doko] matches; the group restarts after release
    words = ["zun", "zun", "zun", "zun", "doko", "zun", "doko", "zun", "zun", "zun", "zun", "doko"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, payload string")
    lists = G.count_aggregate(df, [], ["i"], 5, "payload")
    m = G.sequence_match(lists, "payloads", ["zun", "zun", "zun", "zun", "doko"]).orderBy("group_no").collect()
    assert [r["matched"] for r in m] == [True, False]  # third group (2 rows) is pending


def test_group_timeout_discards_incomplete(spark):
    rows = [("k", 1, 0, "a", T0), ("k", 2, 0, "b", T0 + dt.timedelta(seconds=1)), ("k", 3, 0, "c", T0 + dt.timedelta(seconds=2)),
            ("k", 4, 0, "d", T0 + dt.timedelta(seconds=10))]
    out = G.timeout_groups(_groups(spark, rows), ["corr_id"], "arrival_ts", ["arrival_ts"], 3, 2)
    got = {r["payload"]: r["outcome"] for r in out.collect()}
    assert got == {"a": "released", "b": "released", "c": "discarded", "d": "discarded"}


def test_role_lists(spark):
    # null -> [], "" -> [], "ROLE_USER" -> [ROLE_USER], "ROLE_USER,ROLE_ADMIN" -> both; Java split drops trailing empties
    cases = [(0, None, []), (1, "", []), (2, "ROLE_USER", ["ROLE_USER"]), (3, "ROLE_USER,ROLE_ADMIN", ["ROLE_USER", "ROLE_ADMIN"]),
             (4, ",A,", ["", "A"]), (5, "A,,", ["A"]), (6, ",,", []), (7, "　", [])]
    df = spark.createDataFrame([(i, r) for i, r, _ in cases], "i int, roles string")
    got = {r["i"]: r["l"] for r in df.select("i", X.role_list("roles").alias("l")).collect()}
    assert got == {i: want for i, _, want in cases}


def test_split_lines_semantics(spark):
    df = spark.createDataFrame([("f1", "a\nb\n"), ("f2", ""), ("f3", "\n"), ("f4", "x\r\ny")], "f string, t string")
    got = sorted((r["corr_id"], r["seq_no"], r["seq_size"], r["line"]) for r in X.split_lines(df, "t", "f").collect())
    assert got == [("f1", 1, 2, "a"), ("f1", 2, 2, "b"), ("f3", 1, 1, ""), ("f4", 1, 2, "x"), ("f4", 2, 2, "y")]


def test_sheet_load_matches_golden(spark):
    # two sheet rows -> user_info + user_role; compare chosen columns with the golden rows
    sheet = spark.createDataFrame([
        (0, "username", "password", "mail_address", "roles"),
        (1, "yota takahashi", "12345678", "yota.takahashi@test.co.jp", "ROLE_USER"),
        (2, "aoi inoue", "abcdefgh", "aoi.inoue@sample.com", "ROLE_ADMIN,ROLE_USER"),
        (3, "", "", "", ""),
        (4, "after blank", "x", "y", "ROLE_USER"),
    ], "row_idx int, username string, password string, mail_address string, roles string")
    rows = TB.sheet_until_blank(sheet, "row_idx", "username")
    users, roles = TB.master_detail_load(rows, None, dt.datetime(2024, 11, 30, 12), ["row_idx"])
    golden_users = spark.createDataFrame([("yota takahashi", "yota.takahashi@test.co.jp", 1, 0), ("aoi inoue", "aoi.inoue@sample.com", 1, 0)],
                                         "username string, mail_address string, enabled smallint, cnt_badcredentials smallint")
    diff = TB.table_diff(golden_users, users.select("username", "mail_address", "enabled", "cnt_badcredentials"))
    assert diff.count() == 0
    assert [r["role"] for r in roles.orderBy("user_id", "role_pos").collect()] == ["ROLE_USER", "ROLE_ADMIN", "ROLE_USER"]
    exp = users.select("expired_account", "expired_password").first()
    assert exp["expired_account"] == dt.datetime(2025, 2, 28, 12) and exp["expired_password"] == dt.datetime(2024, 12, 30, 12)


def test_null_token_in_diff(spark):
    a = spark.createDataFrame([(1, "[null]"), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    assert TB.table_diff(a, b).count() == 0


def test_versioned_update_and_stale(spark):
    target = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "id int, version int, v string")
    changes = spark.createDataFrame([(1, 1, "A"), (2, 4, "B"), (3, 1, "C")], "id int, expected int, nv string")
    out = {r["id"]: (r["outcome"], r["version"], r["v"]) for r in
           TB.versioned_update(target, changes, "id", "version", "expected", {"v": F.col("nv")})[0].collect()}
    assert out == {1: ("updated", 2, "A"), 2: ("stale", 5, "b"), 3: ("missing", None, None)}


def test_select_by_id_version_requires_a_row(spark):
    import pytest

    df = spark.createDataFrame([(1, 1), (1, 2)], "id long, version long")
    assert TB.select_by_id_version(df, "id", 1, "version", 2).count() == 1
    with pytest.raises(TB.NoResultError):
        TB.select_by_id_version(df, "id", 1, "version", 3)


def test_intake_limit_polls(spark):
    from flowframe.sources.records import intake_limit

    df = spark.createDataFrame([(i,) for i in range(12)], "i int")
    got = {r["i"]: r["poll_no"] for r in intake_limit(df, ["i"], 5).collect()}
    assert [got[i] for i in range(12)] == [0] * 5 + [1] * 5 + [2] * 2


def test_strict_validation_fails_the_job(spark):
    import pytest

    from flowframe.operators.transform import validate_strict

    df = spark.range(5)
    assert validate_strict(df, F.col("id") >= 0, "negative id").count() == 5
    for bad in (F.col("id") < 4, F.lit(None).cast("boolean")):
        with pytest.raises(Exception, match="not allowed"):
            validate_strict(df, bad, "not allowed").count()

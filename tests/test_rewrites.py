"""Pages by rank, optimistic changes, ticks by dyadic intervals, trees of checksums, polls against a ledger."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flowframe.operators import delay as D
from flowframe.operators import tables as TB
from flowframe.sources import files as SF

T0 = dt.datetime(2024, 1, 1)


def test_pages_by_rank(spark, monkeypatch):
    monkeypatch.setattr(TB, "RANK_SAMPLE", 40)
    draw = random.Random(1)
    rows = [(draw.choice([None, "a", "b", "c"]), i * 7 % 3000) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(7)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    for page, size in ((0, 10), (37, 17), (149, 20), (150, 20), (2, 1400), (0, 3000), (5, 0)):
        out = TB.page_with_total(df, ["g", "k"], page, size)
        assert [(r["g"], r["k"]) for r in out.collect()] == want[page * size:(page + 1) * size]
        assert {r["total"] for r in out.collect()} <= {3000}
    assert TB.page_with_total(df.limit(0), ["g", "k"], 0, 5).collect() == []
    skewed = spark.createDataFrame([(0 if i < 2900 else 1, i) for i in range(3000)], "g int, k int")
    assert [r["k"] for r in TB.page_with_total(skewed, ["g", "k"], 290, 10).collect()] == list(range(2900, 2910))


def test_pages_of_times(spark):
    rows = [(T0 + dt.timedelta(minutes=i), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, k int")
    assert [r["k"] for r in TB.page_with_total(df, ["ts"], 400, 10).collect()] == list(range(4000, 4010))


def test_of_equal_changes_one_wins(spark):
    stored = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 1, "c")], "id int, version int, v string")
    rows = [(1, 1, "x"), (1, 1, "x"), (1, 1, "w"), (2, 2, "y"), (9, 1, "z"), (None, 1, "n"), (3, None, "q")] + [(3, 1, None)] * 3
    changes = spark.createDataFrame(rows, "id int, expected int, new string")
    out, snap = TB.versioned_update(stored, changes, "id", "version", "expected", {"v": "new"})
    got = sorted((str(r["id"]), str(r["new"]), r["outcome"]) for r in out.collect())
    assert got == sorted([("1", "w", "updated"), ("1", "x", "stale"), ("1", "x", "stale"), ("2", "y", "stale"), ("9", "z", "missing"),
                          ("None", "n", "missing"), ("3", "q", "stale"), ("3", "None", "updated"), ("3", "None", "stale"), ("3", "None", "stale")])
    assert sorted(tuple(r) for r in snap.select("id", "version").collect()) == [(1, 2), (2, 1), (3, 2)]


def test_ticks_match_a_loop(spark):
    draw = random.Random(4)
    rows = []
    for i in range(200):
        a = draw.randrange(-4000, 4000)
        rows.append((i, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=a), dt.datetime(1970, 1, 1) + dt.timedelta(seconds=a + draw.randrange(0, 3000))))
    df = spark.createDataFrame(rows, "id int, arrival timestamp_ntz, release timestamp_ntz")
    want = {}
    for i, a, b in rows:
        t = dt.datetime(1970, 1, 1) - dt.timedelta(seconds=7200)
        while t < b:
            if t >= a:
                n, low = want.get(t, (0, i))
                want[t] = (n + 1, min(low, i))
            t += dt.timedelta(seconds=60)
    got = {r["tick"]: (r["n_held"], r["first_id"]) for r in D.held_at_tick(df, "arrival", "release", "id").collect()}
    assert got == want


def test_a_delay_of_a_year_is_a_few_intervals(spark):
    year = T0 + dt.timedelta(days=365)
    df = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=i), year) for i in range(50)], "id int, arrival timestamp_ntz, release timestamp_ntz")
    out = D.held_at_tick(df, "arrival", "release", "id", 3600)
    assert out.count() == 365 * 24 - 1 + 1 and out.agg(F.max("n_held"), F.min("first_id"), F.max("first_id")).first()[:] == (50, 0, 0)


def test_diff_by_checksums(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice(["x", "y", None, "[null]"]), draw.choice([None, 1.5, 2.5])) for i in range(3000)] * 2 + [(None, None, None)] * 3
    other = [*rows[:-2], (5, "new", 1.5), (5, "new", 1.5), (None, "x", None)]
    other[7] = (7, "changed", None)
    a, b = (spark.createDataFrame(r, "i int, s string, d double") for r in (rows, other))
    want = sorted(map(str, TB.table_diff(a, b).collect()))
    for bits in ((12, 12), (3, 2), (1,)):
        assert sorted(map(str, TB.table_diff_tree(a, b, level_bits=bits).collect())) == want
    assert TB.table_diff_tree(a, a.repartition(5)).collect() == [] and len(want) > 5


@pytest.mark.parametrize("accept", ["once", "changed", "create", "all"])
def test_polls_against_a_ledger(spark, tmp_path, accept):
    base, ledger = tmp_path / "in", str(tmp_path / "ledger")
    base.mkdir()

    def poll():  # every poll reads the ledger anew, as after a restart
        return sorted(r["file_path"].rsplit("/", 1)[1] for r in SF.intake_changed(spark, str(base), ledger, accept).collect())

    for name in ("a", "b", ".hidden"):
        (base / name).write_text(name)
    assert poll() == ["a", "b"]
    (base / "c").write_text("c")
    SF.touch(spark, str(base / "a"))
    assert poll() == {"once": ["c"], "changed": ["a", "c"], "create": ["c"], "all": ["a", "b", "c"]}[accept]
    (base / "b").rename(tmp_path / "b")
    assert poll() == (["a", "c"] if accept == "all" else [])
    (tmp_path / "b").rename(base / "b")
    assert poll() == {"once": [], "changed": [], "create": ["b"], "all": ["a", "b", "c"]}[accept]

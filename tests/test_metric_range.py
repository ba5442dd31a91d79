"""Range functions against a loop over every window."""

import datetime as dt
import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowframe.operators.metrics import group_left_join, metric_range

T0 = dt.datetime(2024, 1, 1)


def plain(samples, width, step, kind):
    """Every step's window by itself, with the extrapolation written out."""
    out, times = {}, [t for s in samples.values() for t, _ in s]
    for name, series in samples.items():
        series = sorted(series)
        for t in range(math.ceil(min(times) / step) * step, max(times) + 1, step):
            w = [(a, v) for a, v in series if t - width < a <= t]
            if len(w) < 2:
                continue
            grown = w[-1][1] - w[0][1]
            if kind != "delta":
                grown += sum(p for (_, p), (_, v) in zip(w, w[1:]) if v < p)
            inside, mean = w[-1][0] - w[0][0], (w[-1][0] - w[0][0]) / (len(w) - 1)
            before, after = w[0][0] - (t - width), t - w[-1][0]
            before = mean / 2 if before >= mean * 1.1 else before
            after = mean / 2 if after >= mean * 1.1 else after
            if kind != "delta" and grown > 0 and w[0][1] >= 0:
                before = min(before, inside * (w[0][1] / grown))
            x = grown * (inside + before + after) / inside
            out[name, t] = (x / width if kind == "rate" else x, len(w))
    return out


@pytest.mark.parametrize("kind", ["rate", "increase", "delta"])
@pytest.mark.parametrize("width,step", [(300, 15), (60, 60), (45, 100)])
def test_ranges(spark, kind, width, step):
    draw = random.Random(width)
    samples = {name: {draw.randrange(3000): float(draw.randrange(-5 if kind == "delta" else 0, 50)) for _ in range(n)}.items()
               for name, n in (("busy", 400), ("sparse", 20), ("one", 1))}
    rows = [(name, T0 + dt.timedelta(seconds=t), v) for name, s in samples.items() for t, v in s]
    rows += [("busy", None, 3.0), ("busy", T0, None)]
    df = spark.createDataFrame(rows, "metric string, ts timestamp_ntz, value double")
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    want = plain({k: [(base + t, v) for t, v in s] for k, s in samples.items()}, width, step, kind)
    got = {(r["metric"], int((r["step_ts"] - dt.datetime(1970, 1, 1)).total_seconds())): (r["value"], r["samples"])
           for r in metric_range(df, ["metric"], width, step, kind).collect()}
    assert got.keys() == want.keys() and len(got) > 5
    for k, (x, n) in want.items():
        assert got[k][1] == n and got[k][0] == pytest.approx(x, abs=1e-9)


def test_rows_do_not_grow_with_the_ranges(spark):
    rows = [("a", T0 + dt.timedelta(seconds=60 * i), float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "metric string, ts timestamp_ntz, value double")
    short, long = (metric_range(df, ["metric"], w, 60).count() for w in (120, 3000))
    assert short == long == 49


def test_repeated_right_labels_fail_a_match(spark):
    left = spark.createDataFrame([(1, 2.0)], "u int, value double")
    right = spark.createDataFrame([(1, 5.0), (2, 6.0)], "u int, w double")
    assert [r["value"] for r in group_left_join(left, right, ["u"], "value", "w").collect()] == [5.0]
    with pytest.raises(PySparkException, match="many-to-one"):
        group_left_join(left, right.union(right), ["u"], "value", "w").collect()
    other = spark.createDataFrame([(1, 5.0), (2, 6.0), (2, 7.0)], "u int, w double")  # no left sample asks for these
    assert group_left_join(left, other, ["u"], "value", "w").select(F.count("*")).first()[0] == 1

from pyspark.sql import functions as F

from flowframe.operators import delay as D
from flowframe.operators import retry as R


def _offsets(spark, policy):
    df = spark.range(1).withColumnRenamed("id", "m")
    return [r["offset_ms"] for r in R.retry_schedule(df, policy).orderBy("attempt_no").collect()]


def test_retry_schedules(spark):
    assert _offsets(spark, R.FIXED_5X2S) == [0, 2000, 4000, 6000, 8000]
    assert _offsets(spark, R.EXP_5) == [0, 2000, 6000, 14000, 24000]
    # timeout 45 s with 2,4,8,10,10... waits: tries at 0,2,6,14,24,34,44 s
    assert _offsets(spark, R.TIMEOUT_45S_EXP) == [0, 2000, 6000, 14000, 24000, 34000, 44000]
    # 3 tries or 10 s: with 1 s waits the count ends it, with 5 s waits the time does
    assert _offsets(spark, R.COMPOSITE_3_10S_FIXED1S) == [0, 1000, 2000]
    assert _offsets(spark, R.COMPOSITE_3_10S_FIXED5S) == [0, 5000]
    assert R.allowed_attempts(R.NO_RETRY) == 1
    assert R.allowed_attempts(R.BY_CLASS["java.nio.file.FileSystemNotFoundException"]) == 5


def test_delay_from_payload_default(spark):
    df = spark.createDataFrame([("3000",), ("abc",), ("",), (" 12 ",)], "payload string")
    got = [r["d"] for r in df.select(D.delay_ms_from("payload", 8000).alias("d")).collect()]
    assert got == [3000, 8000, 8000, 12]


def test_delay_loop_total(spark):
    assert spark.range(1).select(D.loop_total_ms(3000, 1000, 3).alias("t")).first()["t"] == 12000


def test_retry_status_outcomes(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [("m1", t, 1, False, "E", "x"), ("m1", t + dt.timedelta(seconds=2), 2, True, None, None),
            ("m2", t, 3, False, "E", "boom"), ("m3", t, 4, False, "E", "a"), ("m3", t, 5, False, "E", "b"), ("m3", t, 6, False, "E", "c")]
    df = spark.createDataFrame(rows, "message_id string, ts timestamp_ntz, event_id long, ok boolean, error_class string, error_message string")
    pol = R.RetryPolicy("three", max_attempts=3, backoff="fixed", period_ms=1000)
    got = {r["message_id"]: (r["outcome"], r["attempts"]) for r in R.retry_status(df, "message_id", "ts", "ok", pol, order=["ts", "event_id"]).collect()}
    assert got == {"m1": ("succeeded", 2), "m2": ("due", 1), "m3": ("exhausted", 3)}
    m2 = R.retry_status(df, "message_id", "ts", "ok", pol, order=["ts", "event_id"]).filter(F.col("message_id") == "m2").first()
    assert m2["next_attempt_at"] == t + dt.timedelta(seconds=1)


def test_held_at_tick_boundaries(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(1, t, t + dt.timedelta(minutes=2)),                                   # ticks 0:00, 0:01 (0:02 is release)
            (2, t + dt.timedelta(seconds=30), t + dt.timedelta(minutes=1, seconds=1)),  # tick 0:01 only
            (3, t + dt.timedelta(seconds=5), t + dt.timedelta(seconds=50))]        # spans no tick
    df = spark.createDataFrame(rows, "id long, arrival timestamp_ntz, release timestamp_ntz")
    got = sorted((r["tick"], r["n_held"]) for r in D.held_at_tick(df, "arrival", "release", "id").collect())
    assert got == [(t, 1), (t + dt.timedelta(minutes=1), 2)]

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowframe.operators.sequence import cut_chunks, keyed_scan


def _cmp(a, b, cols):
    ra = sorted(tuple(r[c] for c in cols) for r in a.collect())
    rb = sorted(tuple(r[c] for c in cols) for r in b.collect())
    assert ra == rb


def test_keyed_scan_matches_window(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    for keys in (["user_id"], ["event_type"], ["event_type", "user_id"]):
        got = keyed_scan(ev, keys, ["ts", "event_id"], lags=["ts", "value"], firsts=["event_id"],
                         sums={"run_value": "value"}, num_partitions=7)
        w = W.partitionBy(*keys).orderBy("ts", "event_id")
        want = ev.select(
            "*",
            F.row_number().over(w).alias("rn"),
            F.lag("ts").over(w).alias("prev_ts"),
            F.lag("value").over(w).alias("prev_value"),
            F.first("event_id").over(w).alias("first_event_id"),
            F.sum("value").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("run_value"),
        )
        got = got.withColumn("run_value", F.round("run_value", 6))
        want = want.withColumn("run_value", F.round("run_value", 6))
        _cmp(got, want, ["event_id", "rn", "prev_ts", "prev_value", "first_event_id", "run_value"])


def test_keyed_scan_single_hot_key_many_partitions(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", F.lit(1))
    got = keyed_scan(ev, ["k"], ["ts", "event_id"], num_partitions=16)
    want = ev.select("event_id", F.row_number().over(W.partitionBy("k").orderBy("ts", "event_id")).alias("rn"))
    _cmp(got, want, ["event_id", "rn"])


def test_keyed_scan_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4), (None, 5)], "k string, o int")
    got = {r["o"]: r["rn"] for r in keyed_scan(df, ["k"], ["o"], num_partitions=3).collect()}
    assert got == {1: 1, 2: 2, 5: 3, 3: 1, 4: 2}


def test_keyed_scan_gap_sessions(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    gap = 6 * 3600
    for keys, parts in ((["user_id"], 5), (["event_type"], 13)):
        got = keyed_scan(ev, keys, ["ts", "event_id"], gap=("ts", gap), num_partitions=parts)
        w = W.partitionBy(*keys).orderBy("ts", "event_id")
        flag = (F.lag("ts").over(w).isNull() | (F.col("ts") > F.lag("ts").over(w) + F.expr(f"interval {gap} seconds"))).cast("int")
        want = ev.withColumn("f", flag).withColumn("session_no", F.sum("f").over(w.rowsBetween(W.unboundedPreceding, 0)))
        want = want.withColumn("session_rn", F.row_number().over(W.partitionBy(*keys, "session_no").orderBy("ts", "event_id")))
        _cmp(got, want, ["event_id", "session_no", "session_rn"])


def _plain(ev):
    return ev.select("event_id", F.row_number().over(W.partitionBy("k").orderBy("ts", "event_id")).alias("rn"))


def test_numbers_do_not_depend_on_later_stages(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", F.lit("hot"))
    s = keyed_scan(ev, ["k"], ["ts", "event_id"], num_partitions=9)
    want = sorted(tuple(r) for r in _plain(ev).collect())
    rows = lambda df: sorted(tuple(r) for r in df.select("event_id", "rn").collect())
    assert rows(s.coalesce(1)) == want
    assert rows(s.repartition(3)) == want
    other = keyed_scan(ev, ["k"], ["ts", "event_id"], num_partitions=4)
    assert rows(s.unionByName(other)) == sorted(want + want)
    kept = s.persist()
    assert kept.count() == len(want)
    kept.unpersist()
    assert rows(s) == want


def test_far_dates_pass_through(spark):
    df = spark.sql("select id, timestamp'9999-12-31 23:59:59' as until, timestamp_ntz'0001-01-01 00:00:00' as since from range(20)")
    out = keyed_scan(df, [], ["id"], num_partitions=4).orderBy("id")
    assert [r["rn"] for r in out.collect()] == list(range(1, 21))
    assert out.filter("year(until) = 9999 and year(since) = 1").count() == 20


def test_rows_equal_on_all_but_the_last_order_column_are_spread(spark):
    n = 400_000
    df = spark.range(n).withColumns({"k": F.lit("hot"), "prio": F.lit(1), "day": F.lit(2)})
    s = keyed_scan(df, ["k"], ["prio", "day", "id"], num_partitions=8)
    assert s.filter("rn <> id + 1").count() == 0
    chunks = cut_chunks(df, ["k"], [F.col(c) for c in ("prio", "day", "id")], 8).groupBy("__chunk").count().collect()
    assert len(chunks) >= 7 and max(r["count"] for r in chunks) < n / 4


def test_sums_keep_whole_numbers(spark):
    df = spark.createDataFrame([(1, 2**53), (2, 1), (3, None), (4, 1)], "id int, v long")
    got = [r["total"] for r in keyed_scan(df, [], ["id"], sums={"total": "v"}, num_partitions=3).orderBy("id").collect()]
    assert got == [2**53, 2**53 + 1, 2**53 + 1, 2**53 + 2]

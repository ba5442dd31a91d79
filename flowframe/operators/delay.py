"""Delays as data: a delayed message is a row with a ``release_ts``.

Sleeping inside a task is wrong on Spark.  The batch form computes when
each message leaves; the streaming form (``flowframe.streaming.delayer``)
keeps the rows it holds as a table and writes those that are due.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.operators.sequence import keyed_scan
from flowframe.session import stage_table


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ms_interval(ms: Column | int) -> Column:
    """Milliseconds as a day-time interval (exact to the microsecond)."""
    m = F.lit(ms) if isinstance(ms, int) else ms
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (m.cast("decimal(20,3)") / F.lit(1000)).cast("decimal(18,6)"))


def delay_ms_from(value: Column | str, default_ms: int) -> Column:
    """Delay in ms read from a payload or header: a whole number of ms, else
    the default (non-numbers and blanks never fail the job; ANSI ``cast``
    would raise, so ``try_cast``)."""
    v = _c(value).cast("string")
    return F.coalesce(F.trim(v).try_cast("long"), F.lit(default_ms).cast("long"))


def delay_fixed(df: DataFrame, arrival: str, *delays_ms: int, out: str = "release_ts") -> DataFrame:
    """Chained fixed delays (e.g. 3000 then 6000 ms)."""
    return df.withColumn(out, F.col(arrival) + ms_interval(int(sum(delays_ms))))


def delay_from_payload(df: DataFrame, arrival: str, payload: str, default_ms: int, out: str = "release_ts") -> DataFrame:
    d = delay_ms_from(payload, default_ms)
    return df.withColumn("delay_ms", d).withColumn(out, F.col(arrival) + ms_interval(F.col("delay_ms")))


def delay_loop(df: DataFrame, arrival: str, init_ms: int = 3000, step_ms: int = 1000, rounds: int = 3) -> DataFrame:
    """Bounded loop with growing delay: wait ``init + count*step``, count+1,
    repeat while count < rounds.  One row per pass with its release time;
    the cumulative wait is a closed form, no iteration."""
    steps = df.withColumn("loop_count", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    steps = steps.withColumn("wait_ms", (F.lit(init_ms) + F.col("loop_count") * F.lit(step_ms)).cast("long"))
    # waits of passes 0..k: (k+1)*init + step*k*(k+1)/2
    k = F.col("loop_count")
    cum = (k + 1) * F.lit(init_ms) + F.lit(step_ms) * k * (k + 1) / 2
    return steps.withColumn("elapsed_ms", cum.cast("long")).withColumn("release_ts", F.col(arrival) + ms_interval(F.col("elapsed_ms")))


def loop_total_ms(init_ms: int = 3000, step_ms: int = 1000, rounds: int = 3) -> Column:
    """Total wait of the loop, as an ``aggregate`` over the pass numbers (12000 for 3000/1000/3)."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), F.lit(0).cast("long"),
                       lambda acc, c: acc + F.lit(init_ms) + c * F.lit(step_ms))


def tick_drain(df: DataFrame, ts: str, every: str, id_col: str) -> DataFrame:
    """Messages pile up in a queue and a consumer drains everything present
    every ``every``: one output batch per tumbling window."""
    return df.groupBy(F.window(ts, every).alias("w")).agg(
        F.count(F.lit(1)).alias("n_messages"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id")
    ).select(F.col("w.end").alias("drained_at"), "n_messages", "first_id", "last_id")


def held_at_tick(df: DataFrame, arrival: str, release: str, id_col: str, tick_seconds: int = 60) -> DataFrame:
    """Messages held by the delayer at each tick ``t`` (``arrival <= t < release``), ticks every ``tick_seconds``
    from the epoch: ``(tick, n_held, first_id)``; ticks that hold none have no row.

    A message held over many ticks is not copied into them.  The count of a
    tick is a running sum over the ticks where messages come and go.  For the
    smallest id a message's ticks are cut into dyadic intervals, at most two
    of each length, a minimum is kept for each of these, and a tick asks the
    intervals that hold it, one of each length.  Tick arithmetic is on
    wall-clock microseconds, independent of the session zone."""
    from flowframe.functions.scalar import ntz_micros

    step = int(tick_seconds) * 1_000_000
    first, after = (F.ceil(ntz_micros(c) / F.lit(step)).cast("long") for c in (arrival, release))
    spans = stage_table(df.select(F.col(id_col).alias("id"), first.alias("a"), (after - 1).alias("b")).filter("a <= b"), "spans")
    turns = spans.select(F.col("a").alias("p"), F.lit(1).cast("long").alias("d")).unionByName(
        spans.select((F.col("b") + 1).alias("p"), F.lit(-1).cast("long").alias("d"))).groupBy("p").agg(F.sum("d").alias("d"))
    steady = keyed_scan(turns, [], ["p"], lags=["p"], sums={"n": "d"}).select(
        F.col("prev_p").alias("a"), (F.col("p") - 1).alias("b"), (F.col("n") - F.col("d")).alias("n_held")).filter("n_held > 0")
    ticks = steady.select("n_held", F.explode(F.sequence("a", "b")).alias("t"))
    # what is left of [a, b] in intervals of 2^k ticks are those from lo to hi; an end that is not half of a longer one stays
    longest = F.floor(F.log2(F.col("b") - F.col("a") + 1)).cast("int")
    levels = spans.select("*", F.explode(F.sequence(F.lit(0), longest)).alias("k"))
    lo, hi = -F.expr("shiftright(-a, k)"), F.expr("shiftright(b + 1, k)") - 1
    ends = levels.select("id", "k", lo.alias("lo"), hi.alias("hi")).filter("lo <= hi").select("id", "k", F.explode(F.array_compact(F.array(
        F.when(F.pmod("lo", F.lit(2)) == 1, F.col("lo")), F.when(F.pmod("hi", F.lit(2)) == 0, F.col("hi"))))).alias("node"))
    nodes = stage_table(ends.groupBy("k", "node").agg(F.min("id").alias("id")), "dyadic")
    deepest = nodes.agg(F.coalesce(F.max("k"), F.lit(0))).scalar()
    asked = ticks.select("t", "n_held", F.explode(F.sequence(F.lit(0), deepest)).alias("k")).withColumn("node", F.expr("shiftright(t, k)"))
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return asked.join(nodes, ["k", "node"]).groupBy("t").agg(F.max("n_held").alias("n_held"), F.min("id").alias("first_id")).select(
        F.timestamp_add("MICROSECOND", F.col("t") * step, epoch).alias("tick"), "n_held", "first_id")

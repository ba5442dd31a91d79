"""Record sources: counters, inline lists, queue envelopes, switched sources
and per-poll intake limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators.sequence import keyed_scan


def counter_source(spark: SparkSession, n: int | None = None, *, streaming: bool = False,
                   rows_per_second: int = 1) -> DataFrame:
    """1, 2, 3 ...: ``spark.range`` in batch, the ``rate`` source when streaming."""
    if streaming:
        return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load().select(
            (F.col("value") + 1).alias("count"), F.col("timestamp").alias("arrival_ts"))
    return spark.range(1, int(n) + 1).withColumnRenamed("id", "count")


def number_messages(df: DataFrame, order: Sequence[str | Column], out: str = "count") -> DataFrame:
    """Counter values 1, 2, 3 ... assigned to a message stream in ``order``
    (two-phase global numbering, no single-task window)."""
    return keyed_scan(df, [], order, rn=out)


def inline_records(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A constant record list (small by construction)."""
    return spark.createDataFrame(rows, schema)


def envelope_unwrap(df: DataFrame, value: str, headers_schema: str, payload_schema: str,
                    expect_message: bool = True) -> DataFrame:
    """Queue envelope: with ``expect_message`` the stored envelope becomes
    header columns + payload columns; without it the whole envelope text is
    the payload."""
    if not expect_message:
        return df.withColumn("payload", F.col(value))
    env = F.from_json(F.col(value), f"headers struct<{headers_schema}>, payload struct<{payload_schema}>")
    return df.withColumn("_env", env).select(*[c for c in df.columns if c != value], "_env.headers.*", "_env.payload.*")


def envelope_wrap(df: DataFrame, headers: Sequence[str], payload: Sequence[str], out: str = "value") -> DataFrame:
    return df.withColumn(out, F.to_json(F.struct(F.struct(*headers).alias("headers"), F.struct(*payload).alias("payload"))))


def switched_source(df: DataFrame, ts: str, start, period_seconds: int = 5, initially_on: bool = True) -> DataFrame:
    """Clock form of a source switched on and off every ``period_seconds``:
    keep ticks while the flag is on (on during even periods when it starts on)."""
    elapsed = F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ '{start:%Y-%m-%d %H:%M:%S}', {ts})")
    on_phase = F.pmod(F.floor(elapsed / F.lit(period_seconds)), F.lit(2)) == (0 if initially_on else 1)
    return df.filter(on_phase)


def intake_limit(df: DataFrame, order: Sequence[str | Column], per_poll: int, out: str = "poll_no") -> DataFrame:
    """Batch form of "at most N messages per poll": the poll (0-based) each
    message is taken in, from a two-phase global numbering."""
    num = keyed_scan(df, [], order, rn="_seq")
    return num.withColumn(out, F.floor((F.col("_seq") - 1) / F.lit(per_poll)).cast("long")).drop("_seq")

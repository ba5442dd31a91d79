"""Streaming delayer (M4): hold each message until its release time.

The clock is event time: the latest arrival taken in so far.  A message that
is due when it arrives leaves at once.  Any other is written once, into the
folder of the slot of time its release falls into, and read again only by the
micro-batch whose clock passes it: a micro-batch reads the slots between the
clock before and its own clock, not all that is held, and slots that lie
wholly in the past are removed.  Which rows come in together changes when a
message leaves, never whether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType, TimestampNTZType

from flowframe.functions.scalar import ntz_micros
from flowframe.session import drop_path, shuffle_partitions
from flowframe.streaming.runner import batch_dir, child_names, last_batch_before, read_batches, run_batches

#: Width of a slot unless the caller says otherwise; about the delay of most messages is best.
SLOT_SECONDS = 3600


def _micros(df: DataFrame, name: str) -> Column:
    return ntz_micros(name) if isinstance(df.schema[name].dataType, TimestampNTZType) else F.unix_micros(F.col(name))


def _clock_before(spark: SparkSession, base: str, batch_id: int) -> int | None:
    """Microseconds of the clock the batch before left, one row in the shared folder."""
    before = last_batch_before(spark, base, "clock", batch_id)
    if before is None:
        return None
    return spark.read.schema("at long").parquet(batch_dir(base, "clock", before)).first()["at"]


def _held(spark: SparkSession, base: str, schema: StructType, first: int | None, last: int | None, before: int) -> DataFrame:
    """Rows of the slots first..last (null: open) that batches before ``before`` hold, with their release in microseconds."""
    full = StructType([*schema.fields]).add("_release", LongType()).add("_slot", LongType()).add("batch_id", LongType())
    # the default partition name: rows without a release time, which are never due
    slots = [int(s.split("=")[1]) for s in child_names(spark, f"{base}/held", "_slot=*") if "HIVE" not in s]
    paths = [f"{base}/held/_slot={s}" for s in slots if (first is None or s >= first) and (last is None or s <= last)]
    if not paths:
        return spark.createDataFrame([], full).drop("_slot", "batch_id")
    rows = spark.read.schema(full).option("basePath", f"{base}/held").parquet(*paths)
    return rows.filter(F.col("batch_id") < before).drop("_slot", "batch_id")


def delay_batch(base: str, arrival_ts: str, release_ts: str, slot_seconds: int = SLOT_SECONDS):
    """``foreachBatch`` body: rows that are due by the batch's clock go out, new ones that are not are held.

    A batch that is run again reads the same clock and the same slots: rows
    it has itself held are told by their batch, and a slot is removed only
    when the clock *before* the batch has passed its end.
    """
    width = slot_seconds * 1_000_000

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _clock_before(spark, base, batch_id)
        newest = batch.agg(F.max(_micros(batch, arrival_ts)).alias("at")).first()["at"]
        now = max((t for t in (before, newest) if t is not None), default=None)
        rows = batch.withColumn("_release", _micros(batch, release_ts))
        due = F.coalesce(F.col("_release") <= F.lit(now).cast("long"), F.lit(False))
        out = rows.filter(due)
        if now is not None:
            old = _held(spark, base, batch.schema, None if before is None else before // width, now // width, batch_id)
            past = F.lit(True) if before is None else F.col("_release") > before
            out = out.unionByName(old.filter(past & (F.col("_release") <= now)))
        out.drop("_release").write.mode("overwrite").parquet(batch_dir(base, "out", batch_id))
        # a range of release times is one task's: few slots a task, and a hot slot is split
        later = rows.filter(~due).withColumns({"_slot": F.floor(F.col("_release") / width), "batch_id": F.lit(batch_id).cast("long")})
        later.repartitionByRange(shuffle_partitions(spark), "_release").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("_slot", "batch_id").parquet(f"{base}/held")
        spark.range(1).select(F.lit(now).cast("long").alias("at")).coalesce(1).write.mode("overwrite").parquet(
            batch_dir(base, "clock", batch_id))
        if before is not None:
            for slot in child_names(spark, f"{base}/held", "_slot=*"):
                if "HIVE" not in slot and (int(slot.split("=")[1]) + 1) * width <= before:
                    drop_path(spark, f"{base}/held/{slot}")

    return body


def stream_delayer(stream: DataFrame, base: str, arrival_ts: str, release_ts: str, as_of: Column | None = None,
                   slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """Take in everything available; return the released messages.

    With ``as_of`` the messages still held whose release time is not after it
    leave as well (a finite input has no later arrival to move the clock).
    A restart under the same ``base`` must keep ``slot_seconds``.
    """
    spark, schema = stream.sparkSession, stream.schema
    run_batches(stream, delay_batch(base, arrival_ts, release_ts, slot_seconds), base)
    out = read_batches(spark, base, "out", schema).drop("batch_id")
    if as_of is None:
        return out
    clock = _clock_before(spark, base, 2**62)
    width = slot_seconds * 1_000_000
    held = _held(spark, base, schema, None if clock is None else clock // width, None, 2**62)
    left = F.lit(True) if clock is None else F.col("_release") > clock
    return out.unionByName(held.filter(left & (F.col(release_ts) <= as_of)).drop("_release"))

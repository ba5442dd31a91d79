"""Streaming jobs: drain windows, accept-once intake, claim-copy-delete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators.tables import conditional_delete, status_claim
from flowframe.streaming.runner import batch_dir, read_batches, run_batches


def stream_tick_window(stream: DataFrame, base: str, ts: str, every: str, id_col: str) -> DataFrame:
    """Tumbling drain windows: (drained_at, n_messages, first_id, last_id).

    Each micro-batch writes what its rows add to their windows; reading adds
    these up, so a row counts whenever it comes.
    """
    spark = stream.sparkSession
    end = F.window(F.col(ts), every)["end"]
    added = [F.count(F.lit(1)).alias("n_messages"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id")]
    shape = stream.groupBy(end.alias("drained_at")).agg(*added).schema

    def body(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy(end.alias("drained_at")).agg(*added).write.mode("overwrite").parquet(batch_dir(base, "parts", batch_id))

    run_batches(stream, body, base)
    return read_batches(spark, base, "parts", shape).groupBy("drained_at").agg(
        F.sum("n_messages").alias("n_messages"), F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"))


def stream_accept_once(stream: DataFrame, path: str, ts: str, forget_after: str | None = None) -> DataFrame:
    """Each path once, hidden names skipped.

    Accepted paths are remembered for good; with ``forget_after`` (an
    interval of event time) a path may be accepted again after that long.
    """
    s = stream.filter(~F.regexp_extract(F.col(path), r"([^/]*)$", 1).rlike(r"^[._]"))
    if forget_after is None:
        return s.select(path).dropDuplicates([path])
    from flowframe.functions.scalar import ntz_as_utc_instant
    from pyspark.sql.types import TimestampNTZType

    at = ntz_as_utc_instant(ts) if isinstance(stream.schema[ts].dataType, TimestampNTZType) else F.col(ts).cast("timestamp")
    return s.withColumn("_et", at).withWatermark("_et", forget_after).dropDuplicatesWithinWatermark([path]).select(path)


def copy_orders_batch(spark: SparkSession, base: str, key: str, status_col: str, new_value, claimed_value):
    """``foreachBatch`` body of the table-copy job: claim, copy, delete.

    Claim: rows in ``new_value`` move to ``claimed_value`` in the batch's
    snapshot.  Copy: claimed rows go to ``target``.  Delete: the snapshot
    without the rows that are claimed and copied is the next ``source``.
    Every step writes the batch's own ``batch_id=<n>`` directory with
    overwrite and reads the step before from its directory, so a micro-batch
    that is run again, after a failure at any step, replaces exactly its own
    rows.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        _claimed, snapshot = status_claim(batch, key, status_col, new_value, claimed_value)
        snapshot.write.mode("overwrite").parquet(batch_dir(base, "claimed", batch_id))
        taken = spark.read.schema(batch.schema).parquet(batch_dir(base, "claimed", batch_id))
        rows = taken.filter(F.col(status_col) == F.lit(claimed_value)).join(
            batch.filter(F.col(status_col) == F.lit(new_value)).select(key).distinct(), key, "left_semi")
        rows.select(F.col(key).alias("order_id")).write.mode("overwrite").parquet(batch_dir(base, "target", batch_id))
        copied = spark.read.parquet(batch_dir(base, "target", batch_id)).select(F.col("order_id").alias(key))
        conditional_delete(taken, copied, key, status_col, claimed_value).write.mode("overwrite").parquet(
            batch_dir(base, "source", batch_id))

    return run

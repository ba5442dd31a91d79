"""Lines and the results of their checks meet again as two streams.

A line that was sent for a check waits for its result; one whose result has
not come within the range goes on without it.  This is a left outer join of
two streams with a time range: both have a watermark, so the state store
holds a line until its range has passed and a result until no line can ask
for it any more.

What comes further behind than ``lateness`` must not vanish in the join.  So
each stream is first taken in by ``split_late``: rows behind the clock of the
batches before go to a ``late`` table, all others on to the join, whose
watermarks are never ahead of that clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.streaming.runner import batch_dir, read_batches, rocksdb_state, run_batches


def split_late(stream: DataFrame, base: str, at: Column, lateness: str) -> tuple[DataFrame, DataFrame]:
    """Take in everything available; return (a stream of the rows in time, the table of the late ones).

    A row is late when it lies more than ``lateness`` behind the newest row
    of the batches before its own; a row without a time is late."""
    spark = stream.sparkSession
    clock_schema = stream.select(F.max(at).alias("at")).schema

    def body(batch: DataFrame, batch_id: int) -> None:
        clock = read_batches(spark, base, "clock", clock_schema).filter(F.col("batch_id") < batch_id).agg(F.max("at")).first()[0]
        kept = batch.withColumn("_at", at)
        late = F.col("_at").isNull() if clock is None else F.col("_at").isNull() | (
            F.col("_at") < F.lit(clock).cast(clock_schema["at"].dataType) - F.expr(f"INTERVAL {lateness}"))
        kept.filter(late).drop("_at").write.mode("overwrite").parquet(batch_dir(base, "late", batch_id))
        kept.filter(~late).drop("_at").coalesce(1).write.mode("overwrite").parquet(batch_dir(base, "kept", batch_id))
        batch.agg(F.max(at).alias("at")).write.mode("overwrite").parquet(batch_dir(base, "clock", batch_id))

    run_batches(stream, body, base)
    in_time = spark.readStream.schema(stream.schema.add("batch_id", "long")).option("maxFilesPerTrigger", 1).parquet(f"{base}/kept").drop("batch_id")
    return in_time, read_batches(spark, base, "late", stream.schema).drop("batch_id")


def status_join(lines: DataFrame, results: DataFrame, key: str, line_at: Column, result_at: Column, within: str,
                lateness: str) -> DataFrame:
    """Every line with the results of its key that come from its time on until ``within`` later, or with none.

    Both frames are streams; ``line_at`` and ``result_at`` are timestamps of
    theirs, behind by ``lateness`` at most.  Columns of the results get the
    prefix ``result_``.  A line without a result comes out when the watermark
    has passed its range."""
    left = lines.withColumn("_line_at", line_at).withWatermark("_line_at", lateness)
    right = results.withColumn("_result_at", result_at).withWatermark("_result_at", lateness)
    right = right.select(*[F.col(c).alias(f"result_{c}") for c in results.columns], "_result_at")
    return left.join(right, (F.col(key) == F.col(f"result_{key}")) & (F.col("_result_at") >= F.col("_line_at"))
                     & (F.col("_result_at") <= F.col("_line_at") + F.expr(f"INTERVAL {within}")), "left_outer").drop("_line_at", "_result_at")


def run_status_join(joined: DataFrame, base: str) -> tuple[DataFrame, int]:
    """Process what is there; return all joined rows so far and the rows that the state store still holds."""
    spark = joined.sparkSession
    with rocksdb_state(spark):
        q = (joined.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/_checkpoint")
             .trigger(availableNow=True).start(f"{base}/out"))
        q.awaitTermination()
    states = [s for p in q.recentProgress for s in p["stateOperators"]]
    if sum(s["numRowsDroppedByWatermark"] for s in states):
        raise ValueError("rows came behind the watermark of the join")
    return spark.read.schema(joined.schema).parquet(f"{base}/out"), states[-1]["numRowsTotal"] if states else 0

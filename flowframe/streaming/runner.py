"""Streams as foreachBatch jobs over written tables.

A micro-batch is a unit of intake, never of meaning: which rows happen to
come in together must not decide any result.  So the jobs here keep what
they have taken in as rows of a table in the shared folder, one
``batch_id=<n>`` directory per micro-batch, and derive results from those
rows with the batch operators.  No row is behind any watermark; a
micro-batch that is run again after a failure replaces its own directories.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from flowframe.session import scratch_path

#: Parts of the intake log, or of keyed state, by key; fixed so that a restart finds every key again.
BUCKETS = 256


def run_batches(stream: DataFrame, body: Callable[[DataFrame, int], None], base: str) -> None:
    """Run ``body`` on everything available, in micro-batches remembered under ``base``."""
    q = (stream.writeStream.foreachBatch(body).option("checkpointLocation", f"{base}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def run_available_now(stream: DataFrame, name: str, output_mode: str = "append", base: str | None = None) -> DataFrame:
    """Process everything available, write it to a parquet table in the
    shared checkpoint folder and return that table."""
    spark = stream.sparkSession
    base = base or scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which timers and several values a key need."""
    key, value = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stage_in_order(df: DataFrame, order: Sequence[str], base: str, files: int = 8, rows_a_file: int = 1_000_000) -> DataFrame:
    """Write the rows under ``base`` as ``files`` portions that a stream takes one after another in ``order``.

    Adds ``arrival_no``, which grows along the order.  Portions are written
    one after another, since a file stream goes by modification times.  More
    rows than ``rows_a_file`` a portion make more files in each, written side
    by side and taken as one micro-batch, not more micro-batches.
    """
    spark = df.sparkSession
    each = df.count() // (files * rows_a_file) + 1
    cut = df.repartitionByRange(files * each, *order).sortWithinPartitions(*order).withColumns(
        {"arrival_no": F.monotonically_increasing_id(), "_cut": F.floor(F.spark_partition_id() / each).cast("int")})
    cut.write.partitionBy("_cut").parquet(f"{base}/cuts")
    schema = cut.drop("_cut").schema
    for k in range(files):
        part = spark.read.schema(cut.schema).parquet(f"{base}/cuts").filter(F.col("_cut") == k).drop("_cut")
        part = part.coalesce(1) if each == 1 else part.repartition(each)
        part.sortWithinPartitions("arrival_no").write.mode("append").parquet(f"{base}/in")
        # every portion has the same number of files, empty ones where its rows did not fill them
        for _ in range((k + 1) * each - len(child_names(spark, f"{base}/in", "*.parquet"))):
            spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", each).parquet(f"{base}/in")


def plain(column: pd.Series) -> list:
    """A column's values as Python's own, nulls as None and whole numbers as ints though pandas made them floats."""
    if column.dtype.kind == "f":
        return [None if v != v else int(v) for v in column.tolist()]
    return column.astype(object).where(column.notna(), None).tolist()


def batch_dir(base: str, table: str, batch_id: int) -> str:
    return f"{base}/{table}/batch_id={int(batch_id)}"


def read_batches(spark: SparkSession, base: str, table: str, schema: StructType) -> DataFrame:
    """All batches of a table with their ``batch_id``; empty when none was written."""
    full = StructType([*schema.fields]).add("batch_id", LongType())
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{table}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{base}/{table}").parquet(f"{base}/{table}")


def child_names(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Names in a folder of any file system Spark can reach; none where it does not exist."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [str(f.getPath().getName()) for f in found or []]


def last_batch_before(spark: SparkSession, base: str, table: str, batch_id: int) -> int | None:
    """The newest written batch of a table before ``batch_id``, from the directory names."""
    ids = [int(n.split("=")[1]) for n in child_names(spark, f"{base}/{table}", "batch_id=*")]
    return max((i for i in ids if i < batch_id), default=None)


def keyed_recompute(base: str, keys: Sequence[str], compute: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: log the rows, then derive anew the results of the keys they touch.

    ``compute`` gets all rows ever logged of the touched keys, so a key's
    newest result is what a batch job over all its rows gives, whatever the
    order and cut of intake.  Only log buckets with touched keys are read.
    """
    keys = list(keys)

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
        # a bucket is a file, or several where it is large: not one from every task
        batch.withColumn("_bucket", bucket).hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(
            batch_dir(base, "log", batch_id))
        own = read_batches(spark, base, "log", batch.schema.add("_bucket", IntegerType()))
        mine = own.filter(F.col("batch_id") == batch_id)
        parts = [r[0] for r in mine.select("_bucket").distinct().collect()]  # at most BUCKETS numbers
        mine.select(*keys).distinct().write.mode("overwrite").parquet(batch_dir(base, "touched", batch_id))
        key = F.struct(F.lit(0), *keys)
        seen = read_batches(spark, base, "touched", mine.select(*keys).schema).withColumn("_key", key)
        # the log before is looked up by the keys that come again; rows of this batch are all of touched keys
        again = seen.filter(F.col("batch_id") == batch_id).join(seen.filter(F.col("batch_id") < batch_id), "_key", "left_semi").select("_key")
        known = own.filter((F.col("batch_id") < batch_id) & F.col("_bucket").isin(parts)).withColumn("_key", key)
        rows = mine.select(*batch.columns).unionByName(known.join(again, "_key", "left_semi").select(*batch.columns))
        compute(rows).write.mode("overwrite").parquet(batch_dir(base, "out", batch_id))

    return body


def newest_results(spark: SparkSession, base: str, keys: Sequence[str], key_schema: StructType, schema: StructType) -> DataFrame:
    """Of every key the rows of its newest result."""
    touched = read_batches(spark, base, "touched", key_schema).withColumn("_key", F.struct(F.lit(0), *keys))
    newest = touched.groupBy("_key").agg(F.max("batch_id").alias("batch_id"))
    out = read_batches(spark, base, "out", schema).withColumn("_key", F.struct(F.lit(0), *keys))
    return out.join(newest, ["_key", "batch_id"], "left_semi").drop("_key", "batch_id")

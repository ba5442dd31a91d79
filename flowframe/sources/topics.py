"""Topic records in Kafka's column layout: ``(key, value, topic, partition, offset, timestamp)``.

The Kafka connector reads and writes this layout natively; where it is
absent, a directory of parquet rows in the same layout stands in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators.sequence import keyed_scan


def read_topic(spark: SparkSession, path_or_servers: str, topic: str, *, kafka: bool = False,
               streaming: bool = False, max_offsets_per_trigger: int | None = None) -> DataFrame:
    if kafka:
        r = (spark.readStream if streaming else spark.read).format("kafka").option("kafka.bootstrap.servers", path_or_servers)
        r = r.option("subscribe", topic)
        if streaming and max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        return r.load()
    return spark.read.parquet(path_or_servers).filter(F.col("topic") == topic)


def to_topic_layout(df: DataFrame, key: Column, value: Column, topic: Column, n_partitions: int,
                    partition_key: Column, ts: str, order: Sequence[str | Column]) -> DataFrame:
    """Records in topic layout: partition from the key, offsets numbered per
    partition in ``order`` (skew-safe keyed scan)."""
    recs = df.select(key.alias("key"), value.alias("value"), topic.alias("topic"),
                     F.pmod(partition_key, F.lit(n_partitions)).cast("int").alias("partition"),
                     F.col(ts).alias("timestamp"), *order)
    num = keyed_scan(recs, ["topic", "partition"], list(order), rn="_rn")
    return num.withColumn("offset", F.col("_rn") - 1).drop("_rn")


def consumer_share(records: DataFrame, n_consumers: int, out: str = "consumer") -> DataFrame:
    """Consumers of one group split the partitions; each record goes to one."""
    return records.withColumn(out, F.pmod(F.col("partition"), F.lit(n_consumers)).cast("int"))


def topic_route(df: DataFrame, header: str, default_topic: str) -> DataFrame:
    """Per-row topic: the header when set, else the default (the Kafka
    writer reads a ``topic`` column natively)."""
    return df.withColumn("topic", F.coalesce(F.col(header), F.lit(default_topic)))

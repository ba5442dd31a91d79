"""Ordered per-queue computations: dequeue order and queue depth.

Both are per-key running computations, done with :func:`keyed_scan` so a
queue holding most messages is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.operators.sequence import keyed_scan


def priority_order(df: DataFrame, queue: Sequence[str], priority: str, arrival: str, id_col: str,
                   out: str = "dequeue_no") -> DataFrame:
    """Dequeue order of a priority queue: higher priority first, messages
    without a priority last, then arrival, then id."""
    order = [F.col(priority).desc_nulls_last(), F.col(arrival).asc(), F.col(id_col).asc()]
    return keyed_scan(df, list(queue), order, rn=out)


def queue_depth(df: DataFrame, queue: Sequence[str], order: Sequence[str | Column], delta: Column,
                out: str = "depth") -> DataFrame:
    """Queue size after each enqueue (+1) / dequeue (-1) event."""
    d = df.withColumn("_delta", delta.cast("long"))
    s = keyed_scan(d, list(queue), order, sums={"_depth": "_delta"})
    return s.withColumn(out, F.col("_depth").cast("long")).drop("_delta", "_depth", "rn")

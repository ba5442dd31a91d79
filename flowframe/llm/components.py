"""Connected components of a link table, as joins and minimum aggregates.

Every node keeps a parent.  A round hangs each node and its parent under the
smallest grandparent seen across its links, and shortens every path by one
step (the hooking and shortcutting of Zhang, Azad and Hu, "FastSV", 2020).
The number of rounds grows with the logarithm of the longest path.  A hub
with very many links costs only its partial minima; the joins are plain
equi-joins, which adaptive execution splits when one key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import drop_staged, stage


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (src long, dst long) -> one row (node, component) per linked node.

    ``component`` is the smallest node reachable.  Self links and nulls are
    ignored, repeated links count once; no links give an empty result.
    """
    pairs = links.select(F.col("src").cast("long"), F.col("dst").cast("long")).where("src <> dst")
    both = stage(pairs.union(pairs.select("dst", "src")).distinct(), "links")
    parents = stage(
        both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low"))
        .select("node", F.least("node", "low").alias("parent"), F.lit(True).alias("moved")), "parents")
    while parents.where("moved").limit(1).count():
        following = stage(_round(both, parents.select("node", "parent")), "parents")
        drop_staged(parents)
        parents = following
    return parents.select("node", F.col("parent").alias("component"))


def _round(both: DataFrame, parents: DataFrame) -> DataFrame:
    above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
    known = parents.join(above, "parent").select("node", "parent", "grand")
    reached = (
        both.join(known.select(F.col("node").alias("dst"), F.col("grand").alias("seen")), "dst")
        .groupBy(F.col("src").alias("node")).agg(F.min("seen").alias("seen")))
    offers = known.join(reached, "node", "left").select(
        F.explode(F.array(
            F.struct(F.col("node"), F.least("grand", "seen").alias("offer")),
            F.struct(F.col("parent").alias("node"), F.least("grand", "seen").alias("offer")))).alias("o"))
    best = offers.groupBy(F.col("o.node").alias("node")).agg(F.min("o.offer").alias("offer"))
    return parents.join(best, "node", "left").select(
        "node", F.least("parent", "offer").alias("parent"),
        F.coalesce(F.col("offer") < F.col("parent"), F.lit(False)).alias("moved"))

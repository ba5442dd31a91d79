"""Resharding by minimum-cost flow: the fewest bytes move from an old layout to new capacities.

The old shards' sizes and the new capacities are one row a shard; between
them a minimum-cost flow says how many bytes go from which old shard to which
new one.  A byte that stays in its shard costs nothing, any other what
``price`` says (one, unless told otherwise).  A flow has at most one transfer
per old and new shard and works on sizes alone.

A transfer is carried out as a block: a range of its shard's documents in the
order of a 60-bit key.  Where the blocks end is found by radix selection:
bytes per leading 12 bits of the key, then per next 12 bits within the one bin
that an end falls into, until that bin is a single key.  Each step is one
aggregation with at most 4096 sums an end; no document is sorted or sent, and
a document's new shard is an expression over its own row.  Documents are not
cut, so a block ends within half a document of the flow's byte; a second flow
over the sizes so reached evens them out with the smallest documents there
are, those that have moved before the others.

Only shards with a transfer are rewritten.  Their rows are numbered and
written as Parquet below ``shard=<n>``; the others stay where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import stage
from flowframe.session import scratch_path

#: Bits of a key, and those told apart in one step.
KEY_BITS, STEP_BITS = 60, 12
#: Documents numbered together, on average.
NUMBERED = 5_000
#: Shards that the documents of the contract lie in before, by their source.
OLD_SHARDS = 12

Transfers = list[tuple[int, int, int]]


def min_cost_flow(supply: dict[int, int], room: dict[int, int], price: Callable[[int, int], int]) -> Transfers:
    """(from, to, amount) that bring all of ``supply`` into ``room`` at the least total price.

    Successive cheapest paths: each round finds the cheapest way to move more
    from a supplier that has some left to a place that has some left, taking
    back earlier transfers where that pays (Bellman and Ford's relaxation).
    """
    if sum(supply.values()) > sum(room.values()):
        raise ValueError("the new shards cannot hold the old ones")
    left, free, flow = dict(supply), dict(room), {}
    while any(left.values()):
        reach: dict[tuple[str, int], tuple[int, tuple[str, int] | None]] = {("from", i): (0, None) for i, x in left.items() if x}
        changed = True
        while changed:
            changed = False
            for i in supply:
                for j in room:
                    a, b = ("from", i), ("to", j)
                    if a in reach and (b not in reach or reach[a][0] + price(i, j) < reach[b][0]):
                        reach[b], changed = (reach[a][0] + price(i, j), a), True
                    if flow.get((i, j)) and b in reach and (a not in reach or reach[b][0] - price(i, j) < reach[a][0]):
                        reach[a], changed = (reach[b][0] - price(i, j), b), True
        end = min((j for j, x in free.items() if x and ("to", j) in reach), key=lambda j: (reach["to", j][0], j))
        path, node = [], ("to", end)
        while reach[node][1] is not None:
            path.append((reach[node][1], node))
            node = reach[node][1]
        amount = min([left[node[1]], free[end], *(flow[b[1], a[1]] for a, b in path if a[0] == "to")])
        for a, b in path:
            i, j, sign = (a[1], b[1], 1) if a[0] == "from" else (b[1], a[1], -1)
            flow[i, j] = flow.get((i, j), 0) + sign * amount
        left[node[1]] -= amount
        free[end] -= amount
    return sorted((i, j, x) for (i, j), x in flow.items() if x)


def even_capacities(total: int, shards: int) -> dict[int, int]:
    return {j: total // shards + (j < total % shards) for j in range(shards)}


def cheapest_moves(sizes: dict[int, int], room: dict[int, int], price: Callable[[int, int], int] | None = None) -> Transfers:
    """The transfers of a minimum-cost flow that leave their shard."""
    flow = min_cost_flow(sizes, room, price or (lambda i, j: int(i != j)))
    return [(i, j, x) for i, j, x in flow if i != j]


def block_ends(rows: DataFrame, moves: Transfers) -> list[tuple[int, int, int]]:
    """(shard, to, last key): the blocks of ``rows`` (shard, key, size) that carry the moves, in order of the key.

    A block holds the rows above the block before it up to its last key; the rows that end it are those within half
    their size of the wanted number of bytes.
    """
    ends = []  # shard, to, wanted bytes up to the end, bits known, bytes before them
    passed: dict[int, int] = {}
    for i, j, amount in moves:
        passed[i] = passed.get(i, 0) + amount
        ends.append({"shard": i, "to": j, "wanted": passed[i], "known": 0, "before": 0, "last": None})
    for shift in range(KEY_BITS - STEP_BITS, -1, -STEP_BITS):
        open_ = [e for e in ends if e["last"] is None]
        if not open_:
            break
        bins = {(e["shard"], e["known"]) for e in open_}
        prefix = F.shiftright("key", shift + STEP_BITS)
        inside = None
        for shard, known in sorted(bins):
            here = (F.col("shard") == shard) & (prefix == known)
            inside = here if inside is None else inside | here
        found: dict[tuple[int, int], list] = {b: [] for b in bins}
        for r in rows.where(inside).groupBy("shard", F.shiftright("key", shift).alias("bin")).agg(
                F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("key").alias("least"), F.max("key").alias("key")).collect():
            found[r["shard"], r["bin"] >> STEP_BITS].append((r["bin"], r["bytes"], r["least"], r["key"]))
        for e in open_:
            seen, e["known"] = sorted(found[e["shard"], e["known"]]), None
            for number, size, least, key in seen:
                if e["before"] + size >= e["wanted"] or number == seen[-1][0]:
                    if least == key:  # the bin is one key: its rows go together
                        e["last"] = key if 2 * (e["wanted"] - e["before"]) >= size else least - 1
                    e["known"] = number
                    break
                e["before"] += size
    return [(e["shard"], e["to"], e["last"]) for e in ends]


def placed(shard: Column, key: Column, ends: Sequence[tuple[int, int, int]]) -> Column:
    """The shard of a row once the blocks have moved."""
    out = None
    for i, j, last in ends:
        here = (shard == i) & (key <= last)
        out = F.when(here, j) if out is None else out.when(here, j)
    return shard if out is None else out.otherwise(shard)


def bytes_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def row_hash(id_col: str, text: Column) -> Column:
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(text, F.lit("")))


def scatter_key(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - KEY_BITS)


def even_out_key(h: Column, size: Column, moved: Column) -> Column:
    """Rows that have moved before the others, small ones first."""
    small = F.least(size, F.lit((1 << 27) - 1))
    return F.when(moved, 0).otherwise(1).cast("long") * F.lit(1 << 59) + small * F.lit(1 << 32) + F.shiftrightunsigned(h, 32)


def sums_by_shard(rows: DataFrame) -> dict[int, int]:
    """One row a shard goes to the driver."""
    return {r[0]: r[1] for r in rows.groupBy("shard").agg(F.sum("size")).collect()}


def moved(rows: DataFrame, first: Sequence[tuple[int, int, int]], second: Sequence[tuple[int, int, int]] = ()) -> DataFrame:
    """``rows`` (shard, size, h, ...) with ``now``, the shard after the blocks of both flows, and ``key``, its place there.

    Each step is a projection of its own: its value is used often and found once.
    """
    once = rows.withColumn("key", scatter_key(F.col("h"))).withColumn("now", placed(F.col("shard"), F.col("key"), first))
    keyed = once.withColumn("key", even_out_key(F.col("h"), F.col("size"), F.col("now") != F.col("shard")))
    return keyed.withColumn("now", placed(F.col("now"), F.col("key"), second)) if second else keyed


def plan(rows: DataFrame, shards: int, room: dict[int, int] | None = None,
         price: Callable[[int, int], int] | None = None) -> tuple[list, list, set[int]]:
    """``rows`` (shard, size, h) -> (blocks of the flow, blocks that even out, shards that change)."""
    sizes = sums_by_shard(rows)
    room = room or even_capacities(sum(sizes.values()), shards)
    moves = cheapest_moves(sizes, room, price)
    first = block_ends(rows.select("shard", scatter_key(F.col("h")).alias("key"), "size"), moves)
    reached = stage(moved(rows, first).select(F.col("now").alias("shard"), "key", "size"), "shards-reached")
    rest = cheapest_moves(sums_by_shard(reached), room, price)
    return first, block_ends(reached, rest), {s for i, j, _ in [*moves, *rest] for s in (i, j)}


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (shard, h, ...) with ``slot``: their place in their shard, gapless from 0, by hash.

    A shard is cut into ranges of the hash of about ``NUMBERED`` rows; ranges
    are numbered by their counts, rows inside their range.
    """
    total = rows.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    bits = max(0, (total // NUMBERED).bit_length())
    cut = rows.withColumn("__range", F.shiftrightunsigned("h", 64 - bits).cast("long") if bits else F.lit(0).cast("long"))
    before = Window.partitionBy("shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("shard", "__range").agg(F.count("*").alias("m")).select(
        "shard", "__range", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("shard", "__range").orderBy("h")
    return cut.withColumn("__place", F.row_number().over(inside)).join(starts, ["shard", "__range"]).withColumn(
        "slot", (F.col("__start") + F.col("__place") - 1).cast("long")).drop("__range", "__start", "__place")


def reshard(docs: DataFrame, old_shard: Column, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
            room: dict[int, int] | None = None, price: Callable[[int, int], int] | None = None,
            path: str | None = None) -> tuple[DataFrame, list[int]]:
    """Rewrite the shards that change; return the whole new layout and the numbers of the shards rewritten.

    The layout has the columns of ``docs`` between ``shard`` and ``slot``.  A
    null text is empty; a document counts its UTF-8 bytes and one more.
    ``room`` gives other capacities than equal ones; a null old shard is 0.  Rows that agree in id
    and text are one key and go to one shard; every other document is placed
    by itself.  A shard left without rows has no files; an empty table gives
    an empty layout.  Other columns are carried as they are.
    """
    spark = docs.sparkSession
    carried = [F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(docs.columns)]
    # a shard that is never null needs no check before a join, which would place every document once more
    own = docs.select(F.coalesce(old_shard.cast("int"), F.lit(0)).alias("shard"), bytes_of(F.col(text_col)).alias("size"),
                      row_hash(id_col, F.col(text_col)).alias("h"), *carried)
    first, second, touched = plan(stage(own.select("shard", "size", "h"), "shard-sizes"), shards, room, price)
    rows = moved(own, first, second).select(F.col("now").cast("int").alias("shard"), "h", *[f"c{n}" for n in range(len(carried))])
    slots = numbered(rows).drop("h")
    kept = [s for s in (room or range(shards)) if s not in touched]
    affected = sorted(s for s in touched if s in (room or range(shards)))
    path = path or scratch_path(spark, f"staged/layout-{uuid.uuid4().hex}")
    (slots.where(~F.col("shard").isin(kept)) if kept else slots).write.partitionBy("shard").parquet(path)
    layout = spark.read.schema(slots.schema).parquet(path).select(*slots.columns)
    if kept:
        layout = layout.unionByName(slots.where(F.col("shard").isin(kept)))
    named = layout.select("shard", "slot", F.struct(*[F.col(f"c{n}").alias(c) for n, c in enumerate(docs.columns)]).alias("document"))
    return named, affected


def by_source(shards: int = OLD_SHARDS) -> Column:
    """The layout that the contract's documents come in: a source's documents lie in one shard."""
    return (F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % shards).cast("int")


def shard_report(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The contract's rows, from the rewritten files.  The law that holds is ``bytes``."""
    layout, _ = reshard(docs.select("doc_id", "text", "source"), by_source(), shards)
    text = F.col("document.text")
    return layout.select(
        F.col("document.doc_id").alias("doc_id"), bytes_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Message-group operators: aggregate, release, timeout, late discard, resequence.

The reference's answers depend on arrival order, which Spark rows do not
have, so every operator takes an explicit total ``order`` inside a key.

Per-key numbering comes from :func:`keyed_scan`, which stays balanced when
one correlation id holds a large share of all rows.  Counts per key are
partial aggregates (map-side combine) joined back on the key; AQE splits a
skewed join partition at run time.  Lists are only built for released
groups, whose length is bounded by the group's declared size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructType

from flowframe.operators.sequence import keyed_scan, split_heavy
from flowframe.session import stage_table


def needed(df: DataFrame, *cols: str | Column | Sequence[str | Column]) -> DataFrame:
    """Only the named columns: a numbered frame is dealt out and written, so it carries no more than it must.

    An order given as an expression may use any column; then all stay."""
    flat = [c for x in cols for c in ([x] if isinstance(x, (str, Column)) else x)]
    return df.select(*dict.fromkeys(flat)) if all(isinstance(c, str) for c in flat) else df


# ------------------------------------------------------------------ A1 / A5 / A6
def sequence_groups(df: DataFrame, key: str, order: Sequence[str | Column], size_col: str) -> DataFrame:
    """Every row with its arrival rank ``rn`` in its group, the group size
    (``group_size``: size of the group's **first** message) and ``state``:

    * ``released``: rank <= size and the group reached its size;
    * ``pending``: rank <= size, group not yet complete;
    * ``late``: rank > size (arrived after the group was complete).
    """
    s = keyed_scan(df, [key], order, firsts=[size_col]).withColumnRenamed("first_" + size_col, "group_size")
    s = s.withColumn("group_size", F.col("group_size").cast("long"))
    complete = s.filter(F.col("rn") == F.col("group_size")).select(F.col(key).alias("_ck")).withColumn("_complete", F.lit(True))
    s = s.join(complete, s[key] == complete["_ck"], "left").drop("_ck")
    state = (F.when(F.col("rn") > F.col("group_size"), F.lit("late"))
             .when(F.coalesce(F.col("_complete"), F.lit(False)), F.lit("released"))
             .otherwise(F.lit("pending")))
    return s.withColumn("state", state).drop("_complete")


def seq_size_aggregate(df: DataFrame, key: str, order: Sequence[str | Column], size_col: str, payload: str,
                       sep: str | None = None) -> DataFrame:
    """A1: released groups as ``(key, group_size, payloads)`` in arrival order.

    One aggregate over the numbered rows: a group is complete when it holds
    ``group_size`` rows ranked within the size; only those rows enter the
    list, so every list is bounded by its group's declared size, and the
    partial (map-side) list of a hot key is bounded the same way."""
    s = keyed_scan(needed(df, key, order, size_col, payload), [key], order, firsts=[size_col]).withColumn(
        "group_size", F.col("first_" + size_col).cast("long"))
    inside = F.col("rn") <= F.col("group_size")
    agg = s.groupBy(key).agg(
        F.max("group_size").alias("group_size"),
        F.sum(inside.cast("long")).alias("_n_in"),
        F.collect_list(F.when(inside, F.struct(F.col("rn").alias("p"), F.col(payload).alias("v")))).alias("_items"),
    ).filter(F.col("_n_in") == F.col("group_size"))
    lst = F.transform(F.array_sort("_items"), lambda x: x["v"])
    return agg.select(key, "group_size", (F.concat_ws(sep, lst) if sep is not None else lst).alias("payloads"))


def late_discard(df: DataFrame, key: str, order: Sequence[str | Column], size_col: str) -> DataFrame:
    """A5: messages that arrive after their group completed (the discard
    output): rank beyond the group size implies the group was complete."""
    s = keyed_scan(df, [key], order, firsts=[size_col]).withColumn("group_size", F.col("first_" + size_col).cast("long"))
    return s.filter(F.col("rn") > F.col("group_size")).withColumn("state", F.lit("late"))


def multi_input_aggregate(inputs: Sequence[DataFrame], key: str, order: Sequence[str | Column], size_col: str,
                          payload: str, sep: str | None = None) -> DataFrame:
    """Several inputs feed one group store; a group still releases once."""
    u = inputs[0]
    for f in inputs[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return seq_size_aggregate(u, key, order, size_col, payload, sep=sep)


# ------------------------------------------------------------------ A2 / A3 / A8
def count_aggregate(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, payload: str,
                    sep: str | None = None) -> DataFrame:
    """A2: release every ``n`` messages per key, the group starting again
    after each release; the incomplete tail stays pending (not output).
    One aggregate per (key, group): lists hold at most ``n`` items."""
    s = keyed_scan(needed(df, keys, order, payload), list(keys), order)
    return _cut_lists(s, keys, F.lit(n), payload, sep)


def _cut_lists(s: DataFrame, keys: Sequence[str], n: Column, payload: str, sep: str | None) -> DataFrame:
    """Lists of every ``n`` numbered rows of a key; an incomplete tail gives none."""
    s = s.withColumn("_n", n).withColumn("group_no", F.floor((F.col("rn") - 1) / F.col("_n")).cast("long"))
    s = s.withColumn("group_pos", ((F.col("rn") - 1) % F.col("_n") + 1).cast("long")).withColumnRenamed("_n", "_size")
    agg = s.groupBy(*keys, "group_no").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_size").alias("_size"),
        F.collect_list(F.struct(F.col("group_pos").alias("p"), F.col(payload).alias("v"))).alias("_items"),
    ).filter(F.col("_n") == F.col("_size"))
    lst = F.transform(F.array_sort("_items"), lambda x: x["v"])
    return agg.select(*keys, "group_no", (F.concat_ws(sep, lst) if sep is not None else lst).alias("payloads"))


def release_predicate(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], predicate: str,
                      payload: str, sep: str | None = None) -> DataFrame:
    """A3: custom release strategy over the group's message count ``n`` (a SQL
    expression); the group restarts after each release.

    A predicate over ``n`` alone first holds at the same count in every
    group, so groups are cut at that period: the smallest of the counts that
    occur in the data for which it holds.  Where it holds for none of them,
    no key ever has enough messages and nothing is released."""
    s = keyed_scan(needed(df, keys, order, payload), list(keys), order)
    period = s.select(F.col("rn").alias("n")).filter(F.expr(predicate)).agg(F.min("n")).scalar()
    return _cut_lists(s.filter(period.isNotNull()), keys, period, payload, sep)


def release_declared(df: DataFrame, key: str, order: Sequence[str | Column], size_col: str, payload: str,
                     sep: str | None = None) -> DataFrame:
    """A1 with groups that start again: ``(key, group_no, group_size, payloads)``.

    A group holds as many messages as its first one declares (at least one);
    the next message opens the next group.  The incomplete last group is not
    output.  Keys whose rows one task can hold are walked there, in order;
    only the others, if any, go by jumps."""
    size = F.greatest(F.coalesce(F.col(size_col), F.lit(1)), F.lit(1)).cast("long")
    light, heavy = split_heavy(needed(df, key, order, size_col, payload), key)
    out = _walked_groups(light, key, order, F.lit(1).cast("long"), size, payload, sep)
    return out if heavy is None else out.unionByName(_declared_by_jumps(heavy, key, order, size_col, payload, sep))


def _declared_by_jumps(df: DataFrame, key: str, order: Sequence[str | Column], size_col: str, payload: str,
                       sep: str | None) -> DataFrame:
    s = stage_table(keyed_scan(needed(df, key, order, size_col, payload), [key], order).select(
        F.struct(F.lit(0), key).alias("k"), "rn", F.greatest(F.coalesce(F.col(size_col), F.lit(1)), F.lit(1)).cast("long").alias("size"),
        F.col(payload).alias("v")), "declared")
    return _released_runs(s, s.select("k", "rn", (F.col("rn") + F.col("size") - 1).alias("end")), key, sep)


def release_sum(df: DataFrame, key: str, order: Sequence[str | Column], value_col: str, least: float, payload: str,
                sep: str | None = None) -> DataFrame:
    """A3 over the messages' values: ``(key, group_no, group_size, payloads)``.

    A group is released by the message with which the sum of its values
    reaches ``least``; the next message opens the next group.  Values are
    not negative (null counts as 0).  Keys whose rows one task can hold are
    walked there, in order; only the others, if any, go by jumps."""
    light, heavy = split_heavy(needed(df, key, order, value_col, payload), key)
    out = _walked_groups(light, key, order, F.coalesce(F.col(value_col), F.lit(0)), F.lit(least), payload, sep)
    return out if heavy is None else out.unionByName(_sums_by_jumps(heavy, key, order, value_col, least, payload, sep))


def _sums_by_jumps(df: DataFrame, key: str, order: Sequence[str | Column], value_col: str, least: float, payload: str,
                   sep: str | None) -> DataFrame:
    """Running sums only grow, so where a group that starts at a row would end
    is an as-of question: the first row whose running sum is not below the sum
    before the start plus ``least``.  One ordered scan over sums and questions
    together answers it."""
    value = F.coalesce(F.col(value_col), F.lit(0))
    narrow = needed(df, key, order, value_col, payload).withColumn("_value", value)
    s = stage_table(keyed_scan(narrow, [key], order, sums={"total": "_value"}).select(
        F.struct(F.lit(0), key).alias("k"), "rn", "total", F.col("_value").alias("value"), F.col(payload).alias("v")), "sums")
    after = s.select("k", (F.col("rn") + 1).alias("rn"), F.col("total").alias("before"))
    start = s.select("k", "rn").join(after, ["k", "rn"], "left").select("k", "rn", F.coalesce("before", F.lit(0)).alias("before"))
    asked = start.select("k", "rn", (F.col("before") + F.lit(least)).alias("x"), F.lit(0).alias("point"))
    both = asked.unionByName(s.select("k", "rn", F.col("total").cast(asked.schema["x"].dataType).alias("x"), F.lit(1).alias("point")))
    below = keyed_scan(both, ["k"], ["x", "point", "rn"], rn="_", sums={"below": "point"}).filter("point = 0")
    # a group holds its first message even when nothing is asked of it
    return _released_runs(s, below.select("k", "rn", F.greatest("rn", F.col("below") + 1).alias("end")), key, sep)


def _walked_groups(df: DataFrame, key: str, order: Sequence[str | Column], adds: Column, wants: Column, payload: str,
                   sep: str | None) -> DataFrame:
    """Groups that follow one another in each key: a group is full when what its rows add reaches what its first row wants.

    Rows are dealt by key and sorted within tasks; a task walks them batch by
    batch and holds no more than the group that is still open."""
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    rows = df.select(F.col(key).alias("key"), adds.alias("adds"), wants.alias("wants"), F.col(payload).alias("v"),
                     *[c.alias(f"o{i}") for i, c in enumerate(by)])
    dealt = rows.repartition("key").sortWithinPartitions("key", *[f"o{i}" for i in range(len(by))]).select("key", "adds", "wants", "v")
    shape = StructType().add("key", dealt.schema["key"].dataType).add("group_no", LongType()).add("group_size", LongType()).add(
        "items", ArrayType(dealt.schema["v"].dataType))
    arrow = to_arrow_schema(shape)

    def walk(batches):
        key, open_, want, total, number, held, first = None, 0, None, 0, 0, [], True
        for b in batches:
            starts, sizes, numbers, kept, begun = [], [], [], np.zeros(open_ + b.num_rows, bool), 0
            at = open_
            for k, add, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if first or k != key:
                    key, want, number, begun, first = k, None, 0, at, False
                if want is None:
                    want, total, begun = wanted, 0, at
                total += add
                at += 1
                if total >= want:
                    starts.append(begun)
                    sizes.append(at - begun)
                    numbers.append(number)
                    kept[begun:at] = True
                    want, number, begun = None, number + 1, at
            table = pa.Table.from_batches([*held, b.select([0, 3])])
            if starts:
                values = table.column(1).filter(pa.array(kept)).combine_chunks()
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                found = pa.Table.from_arrays(
                    [table.column(0).take(pa.array(starts)).combine_chunks(), pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), values)], names=["key", "group_no", "group_size", "items"])
                yield from found.cast(arrow).to_batches()
            open_ = at - begun if want is not None else 0
            held = table.slice(at - open_).to_batches() if open_ else []

    found = dealt.mapInArrow(walk, shape)
    payloads = F.concat_ws(sep, "items") if sep is not None else F.col("items")
    return found.select(F.col("key").alias(key), "group_no", "group_size", payloads.alias("payloads"))


def _released_runs(s: DataFrame, ends: DataFrame, key: str, sep: str | None) -> DataFrame:
    """Groups that follow one another in each key, from where a group that starts at a row would end.

    ``s`` is a written table (k, rn, v), ``ends`` (k, rn, end) for every row.
    Where a group starts depends on all groups before it, a chain of jumps
    ``rn -> end + 1``.  The chain is followed by doubling: every round joins
    the jumps with themselves, so the number of rounds is the logarithm of
    the most groups of a key, and no task walks a key's rows one by one."""
    last = s.groupBy("k").agg(F.max("rn").alias("n"))
    ends = stage_table(ends.join(last, "k").filter(F.col("end") <= F.col("n")).drop("n"), "ends")
    jumps = ends.select("k", "rn", (F.col("end") + 1).alias("to"))
    starts, known = s.filter("rn = 1").select("k", "rn"), -1
    while True:
        starts = stage_table(starts, "starts")
        found = starts.count()
        if found == known:
            break
        known = found
        reached = starts.join(jumps, ["k", "rn"]).select("k", F.col("to").alias("rn"))
        starts = starts.union(reached).distinct()
        after = jumps.select("k", F.col("rn").alias("to"), F.col("to").alias("far"))
        jumps = stage_table(jumps.join(after, ["k", "to"]).select("k", "rn", F.col("far").alias("to")), "jumps")
    whole = keyed_scan(starts, ["k"], ["rn"], rn="g").join(ends, ["k", "rn"])
    # each group names the positions it holds, all within the key's rows
    places = whole.select("k", (F.col("g") - 1).alias("group_no"), (F.col("end") - F.col("rn") + 1).alias("size"),
                          F.explode(F.sequence("rn", "end")).alias("rn"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("rn", "v"))), lambda x: x["v"])
    return places.join(s.select("k", "rn", "v"), ["k", "rn"]).groupBy("k", "group_no", "size").agg(
        (F.concat_ws(sep, items) if sep is not None else items).alias("payloads")).select(
        F.col(f"k.{key}").alias(key), "group_no", F.col("size").alias("group_size"), "payloads")


def sequence_match(lists: DataFrame, list_col: str, pattern: Sequence[str], out: str = "matched") -> DataFrame:
    """Flag released lists equal to a fixed sequence."""
    return lists.withColumn(out, F.coalesce(F.col(list_col) == F.array(*[F.lit(x) for x in pattern]), F.lit(False)))


# ------------------------------------------------------------------ A4
def timeout_groups(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str | Column], gap_seconds: float,
                   size: int) -> DataFrame:
    """A4: group timeout with discard.

    A group's timer restarts with each message; if no message of the key
    comes within ``gap_seconds`` the pending group times out.  So messages
    form gap sessions; inside a session runs of ``size`` are released as
    they complete and the incomplete remainder is discarded at the timeout.
    Output: every row with ``session_no``, ``group_no`` and ``outcome``
    (``released`` / ``discarded``).
    """
    s = keyed_scan(df, list(keys), order, gap=(ts, gap_seconds))
    s = s.withColumn("group_no", F.floor((F.col("session_rn") - 1) / size).cast("long"))
    lens = s.groupBy(*[F.col(k).alias("_k_" + k) for k in keys], F.col("session_no").alias("_s")).agg(
        F.max("session_rn").alias("_len"))
    cond = [s[k].eqNullSafe(lens["_k_" + k]) for k in keys] + [s["session_no"] == lens["_s"]]
    s = s.join(lens, cond, "inner")
    released = F.col("group_no") < F.floor(F.col("_len") / size)
    return s.withColumn("outcome", F.when(released, F.lit("released")).otherwise(F.lit("discarded"))).drop(
        "_s", "_len", *["_k_" + k for k in keys])


# ------------------------------------------------------------------ A7 / A9
def resequence(df: DataFrame, key: str, seq_no: str, seq_size: str) -> DataFrame:
    """Complete groups only (``count == size``), rows in sequence order.

    Completeness is a partial aggregate per key joined back; the final
    ``orderBy`` is a range-partitioned sort, not a single task.  The rows are
    written once, so that what produced them is not evaluated for both."""
    df = stage_table(df, "resequence")
    stats = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"), F.min(seq_size).alias("_size"))
    done = stats.filter(F.col("_n") == F.col("_size")).select("_k")
    return df.join(done, df[key] == done["_k"], "left_semi").orderBy(key, seq_no)


def line_count(df: DataFrame, file_col: str) -> DataFrame:
    """Lines per file."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_lines"))

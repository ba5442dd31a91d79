"""Exact per-key scans of functions that compose, balanced when one key is hot.

Some running values are not sums: the state of an automaton, the depth of a
queue that is never below empty nor above full.  What a row does to such a
value is a function, and functions of a suitable kind compose into one of the
same kind, whatever the value was before.  So a key's rows are scanned in
chunks that know nothing of each other:

1. rows are range-partitioned on the keys and the whole order; a task walks
   its sorted rows and gives each the composed function of the rows of its key
   before it.  Every key but the first of a chunk starts there, from the
   initial value, and is settled;
2. what the chunks of the other keys compose to, at most one row a chunk,
   is composed per key along its chunks;
3. the rows of a chunk's first key get what came before their chunk.

A function is a row of long integers, a value the function that always gives
it; one vectorised ``compose`` is all that a use has to say.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructType

from flowframe.session import shuffle_partitions, stage_table

_KEY, _CHUNK, _POS, _OPEN, _BEFORE, _OWN = "__key", "__chunk", "__pos", "__open", "__before", "__own"


@dataclass(frozen=True)
class Functions:
    """Functions as rows of integers: ``compose(f, g)`` is first f, then g, row by row of (n, width) arrays."""

    identity: tuple[int, ...]
    initial: tuple[int, ...]
    compose: Callable[[np.ndarray, np.ndarray], np.ndarray]


def automaton(states: int) -> Functions:
    """Functions of (state, count): for every state the next one, then for every state what is added to the count."""

    def compose(f, g):
        ends, counts = f[:, :states], f[:, states:]
        return np.concatenate([np.take_along_axis(g[:, :states], ends, 1),
                               counts + np.take_along_axis(g[:, states:], ends, 1)], axis=1)

    return Functions((*range(states), *[0] * states), (0,) * (2 * states), compose)


#: Beyond any depth; two of them can be added.
FAR = 1 << 61


def _clamped(f, g):
    a, lo, hi = (g[:, k] for k in range(3))
    cut = lambda x: np.minimum(np.maximum(x + a, lo), hi)
    return np.stack([f[:, 0] + a, cut(f[:, 1]), cut(f[:, 2]), np.maximum(f[:, 3], g[:, 3])], axis=1)


#: Functions ``x -> min(max(x + a, lo), hi)`` as (a, lo, hi, latest time): queues with a floor and a ceiling.
CLAMPS = Functions((0, -FAR, FAR, -FAR), (0, 0, 0, -FAR), _clamped)


def prefix_compose(own: np.ndarray, first: np.ndarray, fn: Functions) -> np.ndarray:
    """The composed functions up to and with each row, of runs of rows that begin where ``first`` holds, by doubling."""
    out, n, d = own.copy(), len(own), 1
    begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while d < n:
        at = np.flatnonzero(np.arange(n) - d >= begin)
        if not len(at):
            break
        out[at] = fn.compose(out[at - d], out[at])
        d *= 2
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(values: np.ndarray) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.ravel()))


def composed_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], own: Column, fn: Functions,
                  out: str = "before", num_partitions: int | None = None) -> DataFrame:
    """Add ``out``: the value before each row, as integers, in the order given within each key.

    ``own`` is the row's function (an array of longs).  ``order`` has to be
    total inside a key.  Null keys group together; every row and column stays.
    """
    spark, width = df.sparkSession, len(fn.identity)
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    keyed = df.withColumns({_KEY: F.to_json(F.struct(*keys)), _OWN: own.cast("array<long>")})
    dealt = keyed.repartitionByRange(num_partitions or shuffle_partitions(spark), *[F.col(k) for k in keys], *by).sortWithinPartitions(
        *[F.col(k) for k in keys], *by)
    shape = StructType([*keyed.schema.fields]).add(_CHUNK, IntegerType()).add(_POS, LongType()).add(
        _OPEN, BooleanType()).add(_BEFORE, ArrayType(LongType()))
    arrow = to_arrow_schema(shape)

    def walk(batches):
        chunk, pos, key, carry, opening = TaskContext.get().partitionId(), 0, None, None, True
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            names = b.column(_KEY).to_numpy(zero_copy_only=False)
            first = np.concatenate([[names[0] != key], names[1:] != names[:-1]])
            if key is None:
                first[0] = True
            values = _matrix(b.column(_OWN), width)
            run = prefix_compose(values, first, fn)
            starts = np.flatnonzero(first)
            cut = int(starts[0]) if len(starts) else n  # rows that go on with the key of the batch before
            if cut:
                run[:cut] = fn.compose(np.repeat(carry[None], cut, 0), run[:cut])
            # a key that begins inside the chunk begins from the initial value
            settled = np.ones(n, bool)
            opens = key is None
            if opening:
                settled[:int(starts[1]) if opens and len(starts) > 1 else n if opens else cut] = False
                opening = not settled[-1]
            fresh = np.flatnonzero(settled)
            fresh = fresh[fresh >= cut]
            run[fresh] = fn.compose(np.repeat(np.array([fn.initial]), len(fresh), 0), run[fresh])
            before = np.concatenate([run[:1], run[:-1]])
            before[0] = carry if cut else fn.identity
            before[starts] = np.where(settled[starts][:, None], np.array([fn.initial]), np.array([fn.identity]))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(n, chunk, np.int32)), pa.array(np.arange(pos, pos + n)),
                 pa.array(~settled), _lists(before)], schema=arrow)
            pos, key, carry = pos + n, names[-1], run[-1]

    rows = stage_table(dealt.mapInArrow(walk, shape), "composed")
    # the keys that may have begun in an earlier chunk: one a chunk at most, so is what is broadcast below
    spanning = F.broadcast(rows.filter(_OPEN).select(_KEY).distinct())
    parts = rows.join(spanning, _KEY, "left_semi").groupBy(_KEY, _CHUNK).agg(
        F.max_by(F.struct(_BEFORE, _OWN, _OPEN), _POS).alias("last")).select(_KEY, _CHUNK, "last.*")
    carried = StructType().add(_KEY, StringType()).add(_CHUNK, IntegerType()).add("carry", ArrayType(LongType()))
    carried_arrow = to_arrow_schema(carried)

    def along(group: pa.Table) -> pa.Table:
        group = group.sort_by(_CHUNK).combine_chunks()
        f = fn.compose(_matrix(group.column(_BEFORE).combine_chunks(), width), _matrix(group.column(_OWN).combine_chunks(), width))
        value, found = np.array([fn.initial]), []
        for k, open_ in enumerate(group.column(_OPEN).to_pylist()):
            found.append(value)
            value = fn.compose(value, f[k:k + 1]) if open_ else f[k:k + 1]
        return pa.Table.from_arrays([group.column(_KEY), group.column(_CHUNK), _lists(np.concatenate(found))], schema=carried_arrow)

    carry = parts.groupBy(_KEY).applyInArrow(along, carried)
    kept = [*df.columns, _BEFORE]
    opened = rows.filter(_OPEN).join(F.broadcast(carry), [_KEY, _CHUNK]).select(*kept, "carry")

    def settle(batches):
        for b in batches:
            if b.num_rows:
                value = fn.compose(_matrix(b.column("carry"), width), _matrix(b.column(_BEFORE), width))
                yield pa.RecordBatch.from_arrays([*b.columns[:-2], _lists(value)], schema=settled_arrow)

    settled_shape = opened.drop("carry").schema
    settled_arrow = to_arrow_schema(settled_shape)
    closed = rows.filter(~F.col(_OPEN)).select(*kept)
    return closed.unionByName(opened.mapInArrow(settle, settled_shape)).withColumnRenamed(_BEFORE, out)


# ------------------------------------------------------------------ A3: release by the messages themselves
def sequence_functions(pattern: Sequence[str], payload: Column) -> Column:
    """What a message does to (letters of the pattern at the end of the group, groups released)."""
    m = len(pattern)

    def step(state: int, value: str | None) -> tuple[int, int]:
        seen = [*pattern[:state], value]
        if seen == list(pattern):
            return 0, 1
        return max(k for k in range(min(m - 1, len(seen)) + 1) if seen[len(seen) - k:] == list(pattern[:k])), 0

    def literal(value: str | None) -> Column:
        moves = [step(s, value) for s in range(m)]
        return F.array(*[F.lit(x).cast("long") for x in [*(a for a, _ in moves), *(b for _, b in moves)]])

    out = None
    for value in dict.fromkeys(pattern):
        out = F.when(payload == value, literal(value)) if out is None else out.when(payload == value, literal(value))
    return out.otherwise(literal(None))


def release_sequence(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], payload: str,
                     pattern: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """A3: a group is released by the message with which its last messages equal ``pattern``; then a new one begins.

    Adds ``group_no`` (from 0) and ``released`` (false: the group still
    waits).  No group is gathered: a group without an occurrence may be as
    long as its key.
    """
    m = len(pattern)
    s = composed_scan(df.withColumn("_own", sequence_functions(pattern, F.col(payload))), keys, order, F.col("_own"),
                      automaton(m), "_before", num_partitions)
    done = F.element_at("_own", (F.col("_before")[0] + m + 1).cast("int"))
    s = s.withColumns({"group_no": F.col("_before")[m], "_done": done}).drop("_own", "_before")
    k = F.struct(F.lit(0).alias("_"), *keys)
    ends = s.groupBy(k.alias("_k")).agg(F.max(F.col("group_no") + F.col("_done")).alias("_ends"))
    return s.withColumn("_k", k).join(ends, "_k").withColumn("released", F.col("group_no") < F.col("_ends")).drop("_k", "_done", "_ends")


# ------------------------------------------------------------------ W2: a queue that blocks its producer
def bounded_queue(df: DataFrame, queue: Sequence[str], order: Sequence[str | Column], put: Column, at_micros: Column,
                  capacity: int, waiting: int, num_partitions: int | None = None) -> DataFrame:
    """Depth of a queue of ``capacity`` whose producer waits with at most ``waiting`` messages while it is full.

    Every row puts a message or (``put`` false) takes one; a take from an
    empty queue takes nothing, and a message that finds the producer waiting
    with all it may hold is refused.  Adds ``depth`` and ``blocked`` (in the
    queue and waiting, after the row), ``refused``, and ``blocked_us``: the
    message time in microseconds spent waiting since the queue's row before.
    """
    most = capacity + waiting
    own = F.array(F.when(put, 1).otherwise(-1).cast("long"), F.lit(0).cast("long"), F.lit(most).cast("long"), at_micros.cast("long"))
    s = composed_scan(df.withColumn("_own", own), queue, order, F.col("_own"), CLAMPS, "_before", num_partitions)
    was, now = F.col("_before")[1], F.least(F.greatest(F.col("_before")[1] + F.col("_own")[0], F.lit(0)), F.lit(most))
    blocked = lambda x: F.greatest(x - capacity, F.lit(0))
    return s.withColumns({
        "depth": F.least(now, F.lit(capacity)).cast("long"), "blocked": blocked(now).cast("long"),
        "refused": (F.col("_own")[0] > 0) & (was == most),
        "blocked_us": F.when(blocked(was) > 0, blocked(was) * (F.col("_own")[3] - F.col("_before")[3])).otherwise(0).cast("long"),
    }).drop("_own", "_before")

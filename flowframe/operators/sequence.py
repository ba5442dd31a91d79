"""Exact per-key ordered scans that stay balanced when one key is hot.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one
task.  When one correlation id, queue or user holds a third of all rows
that task is the whole job.  ``keyed_scan`` gives the same numbers (row
number, running sums, previous-row and first-row values, gap sessions)
without that bottleneck and without Python:

1. the rows are range-partitioned on the keys and the whole order, and the
   number of its partition is written with each row as its *chunk*: a table
   in the shared folder, so a chunk is a fact about a row from then on and
   does not depend on how later stages are split, merged or retried;
2. windows run inside (key, chunk), which holds a chunk's share at most;
3. one row per (key, chunk) carries the chunk's count, sums and edge values;
   running sums over these few rows per key give what precedes each chunk;
4. an equi-join on (key, chunk) adds the two up.

A key that lies within one chunk, as nearly all do, has one such row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.session import shuffle_partitions, stage_table

_KEY, _CHUNK = "__key", "__chunk"


def cut_chunks(df: DataFrame, keys: Sequence[str], by: Sequence[Column], num_partitions: int | None = None) -> DataFrame:
    """The rows with the number of their range of (keys, order), written as a table.

    Range bounds cut on the whole order, so rows that agree on the keys and
    on all but the last order column still fall into many chunks.
    """
    cut = df.repartitionByRange(num_partitions or shuffle_partitions(df.sparkSession), *[F.col(k) for k in keys], *by)
    return stage_table(cut.withColumn(_CHUNK, F.spark_partition_id()), "scan")


def keyed_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    *,
    rn: str = "rn",
    lags: Sequence[str] = (),
    firsts: Sequence[str] = (),
    sums: dict[str, str] | None = None,
    gap: tuple[str, float] | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add per-key ``rn`` (1-based), ``prev_<c>``, ``first_<c>`` and running sums.

    ``order`` must be a total order inside each key (add tie-breakers);
    otherwise numbers among ties are arbitrary, as with ``row_number``.
    ``sums`` maps an output name to the summed column (nulls count as zero);
    the type is that of Spark's ``sum``.  With ``gap=(ts_col, seconds)`` it
    also adds ``session_no`` (1-based per key; a new session starts when the
    time since the previous row of the key exceeds the gap, or there is no
    previous time) and ``session_rn`` (1-based inside the session).  The
    result keeps every input row and column; null keys group together.  The
    cut rows are written once when the scan is built; everything else is
    lazy and reads that table.
    """
    keys, sums = list(keys), dict(sums or {})
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    rows = cut_chunks(df, keys, by, num_partitions)
    # a struct is never null itself, so null keys group and join like any other
    rows = rows.withColumn(_KEY, F.struct(F.lit(0).alias("_"), *[F.col(k) for k in keys]))
    seen = list(dict.fromkeys([*lags, *([gap[0]] if gap else [])]))
    chunk = Window.partitionBy(_KEY, _CHUNK).orderBy(*by)
    so_far = chunk.rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns(
        {"__n": F.row_number().over(chunk).cast("long")}
        | {f"__sum_{o}": F.sum(F.coalesce(F.col(c), F.lit(0))).over(so_far) for o, c in sums.items()}
        | {f"__lag_{c}": F.lag(c).over(chunk) for c in seen})
    # what each chunk of a key adds up to, and from these what precedes it
    whole = local if seen or firsts else rows.withColumn("__n", F.lit(1))
    totals = [F.count(F.lit(1)).alias("m")] + [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"t_{o}") for o, c in sums.items()]
    edges = ([F.max_by(F.struct(*[F.col(c) for c in seen]), "__n").alias("last")] if seen else []) + (
        [F.min_by(F.struct(*[F.col(c) for c in firsts]), "__n").alias("head")] if firsts else [])
    chunks = whole.groupBy(_KEY, _CHUNK).agg(*totals, *edges)
    along = Window.partitionBy(_KEY).orderBy(_CHUNK)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(
        _KEY, _CHUNK, F.coalesce(F.sum("m").over(before), F.lit(0)).alias("__m"),
        *[F.coalesce(F.sum(f"t_{o}").over(before), F.lit(0)).alias(f"__t_{o}") for o in sums],
        *([F.lag("last").over(along).alias("__last")] if seen else []),
        *([F.first("head").over(along).alias("__head")] if firsts else []))
    s = local.join(carried, [_KEY, _CHUNK])
    added = {rn: F.col("__m") + F.col("__n")}
    added |= {o: F.col(f"__t_{o}") + F.col(f"__sum_{o}") for o in sums}
    added |= {f"__prev_{c}": F.when(F.col("__n") == 1, F.col(f"__last.`{c}`")).otherwise(F.col(f"__lag_{c}")) for c in seen}
    added |= {f"first_{c}": F.col(f"__head.`{c}`") for c in firsts}
    s = s.withColumns(added)
    out = [*df.columns, rn, *sums, *[F.col(f"__prev_{c}").alias(f"prev_{c}") for c in lags], *[f"first_{c}" for c in firsts]]
    if gap is None:
        return s.select(*out)
    return _sessions(s, gap, rn, by).select(*out, "session_no", "session_rn")


def _sessions(s: DataFrame, gap: tuple[str, float], rn: str, by: list[Column]) -> DataFrame:
    """Number the runs of a key that no gap interrupts, from the previous time of each row."""
    ts, prev = F.col(gap[0]), F.col(f"__prev_{gap[0]}")
    far = F.coalesce(ts > prev + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap[1]).cast("decimal(18,6)")), F.lit(False))
    s = s.withColumn("__new", (prev.isNull() | far).cast("long"))
    started = F.when(F.col("__new") == 1, F.col(rn))
    chunks = s.groupBy(_KEY, _CHUNK).agg(F.sum("__new").alias("k"), F.max(started).alias("at"))
    before = Window.partitionBy(_KEY).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(_KEY, _CHUNK, F.coalesce(F.sum("k").over(before), F.lit(0)).alias("__k"),
                            F.coalesce(F.max("at").over(before), F.lit(0)).alias("__at"))
    so_far = Window.partitionBy(_KEY, _CHUNK).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    local = s.withColumns({"__k_here": F.sum("__new").over(so_far), "__at_here": F.max(started).over(so_far)})
    return local.join(carried, [_KEY, _CHUNK]).withColumns({
        "session_no": F.col("__k") + F.col("__k_here"),
        "session_rn": F.col(rn) - F.greatest("__at", F.coalesce("__at_here", F.lit(0))) + 1})


#: Rows of one hash bucket of keys that a single task may hold; the keys of fuller ones are cut into chunks.
TASK_ROWS = 200_000
_HASHES = 1 << 16


def split_heavy(df: DataFrame, key: str, task_rows: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of keys that one task can hold, rows of the others or None), by the row counts of hash buckets of the keys.

    One pass over the key counts the buckets; only the numbers of the full
    ones, at most one for every ``task_rows`` rows, come to the driver.  Where
    all buckets are fuller than that, a full one has 8 times the mean.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(_HASHES))
    counts = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    most = F.greatest(F.lit(task_rows or TASK_ROWS), 8 * F.col("all") / _HASHES)
    total = counts.agg(F.sum("n").alias("all"))
    full = [r["b"] for r in counts.crossJoin(F.broadcast(total)).filter(F.col("n") > most).select("b").collect()]
    if not full:
        return df, None
    return df.filter(~bucket.isin(full)), df.filter(bucket.isin(full))

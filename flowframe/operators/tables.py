"""Table polls, claims, keyed writes, optimistic updates, pages and diffs.

Parquet tables are immutable, so every "update" here returns the next
snapshot of the table; the caller writes it to a new path (never over the
path being read).  Keyed changes are joins on the key, so they partition
by key and AQE handles a hot key on the large side.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators.sequence import keyed_scan
from flowframe.session import stage_table


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ S7 / P12 / P13
def table_poll(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Rows of a table that satisfy the poll predicate (pushed into the scan)."""
    return df.filter(predicate if isinstance(predicate, Column) else F.expr(predicate))


def select_by_id(df: DataFrame, id_col: str, value) -> DataFrame:
    return df.filter(F.col(id_col) == F.lit(value))


class NoResultError(LookupError):
    """A select that must return a row found none."""


def select_by_id_version(df: DataFrame, id_col: str, id_value, version_col: str, version_value,
                         ensure_result: bool = True) -> DataFrame:
    """Point select on key and version; with ``ensure_result`` an empty
    result raises (checked with a one-row probe, not a count)."""
    out = df.filter((F.col(id_col) == F.lit(id_value)) & (F.col(version_col) == F.lit(version_value)))
    if ensure_result and not out.take(1):
        raise NoResultError(f"no row with {id_col}={id_value!r} and {version_col}={version_value!r}")
    return out


# ------------------------------------------------------------------ P14 / J2 / K4 / K5
def status_claim(df: DataFrame, key: str, status_col: str, from_value, to_value,
                 claimed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Claim rows: returns (claimed rows, next snapshot).

    Without ``claimed`` every row in ``from_value`` is claimed.  With it,
    only rows whose key is in ``claimed`` (and still in ``from_value``)
    change, as ``update ... where key in (:ids)`` does.
    """
    new = df.filter(F.col(status_col) == F.lit(from_value))
    if claimed is not None:
        new = new.join(claimed.select(key).distinct(), key, "left_semi")
        flag = claimed.select(key).distinct().withColumn("_claim", F.lit(True))
        snap = df.join(flag, key, "left")
        hit = F.coalesce(F.col("_claim"), F.lit(False)) & (F.col(status_col) == F.lit(from_value))
        snap = snap.withColumn(status_col, F.when(hit, F.lit(to_value)).otherwise(F.col(status_col))).drop("_claim")
    else:
        snap = df.withColumn(status_col, F.when(F.col(status_col) == F.lit(from_value), F.lit(to_value)).otherwise(F.col(status_col)))
    return new.withColumn(status_col, F.lit(to_value)), snap


def semi_anti(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is in ``keys``, rows whose key is not)."""
    return df.join(keys, on, "left_semi"), df.join(keys, on, "left_anti")


def semi_anti_side(df: DataFrame, keys: DataFrame, on: str | Sequence[str], side: str = "side") -> DataFrame:
    """Every row with the side it falls on (``semi`` / ``anti``): one join for both."""
    on = [on] if isinstance(on, str) else list(on)
    flag = keys.select(*on).distinct().withColumn("_in", F.lit(True))
    return df.join(flag, on, "left").withColumn(side, F.when(F.col("_in"), F.lit("semi")).otherwise(F.lit("anti"))).drop("_in")


def one_per_key(changes: DataFrame, key: Sequence[str], order: Sequence[str], last: bool = True) -> DataFrame:
    """The last (or first) change of each key by an explicit order; rows equal in the order are told apart by all columns.

    A map-side combined aggregate, so a key with very many changes costs no more than its partial results."""
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in changes.columns if c not in order])
    rest = [c for c in changes.columns if c not in key]
    pick = (F.max_by if last else F.min_by)(F.struct(F.lit(1).alias("_"), *rest), rank)
    out = changes.groupBy(*key).agg(pick.alias("_row"))
    return out.select(*[F.col(c) if c in key else F.col(f"_row.`{c}`").alias(c) for c in changes.columns])


def table_append(target: DataFrame | None, rows: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """Insert a column subset.  With ``key`` the insert is idempotent: a row
    already present by key, or twice among the new rows, is not inserted again
    (replays are harmless; of rows with one key the least one is taken)."""
    new = rows.select(*columns)
    if key is not None:
        new = one_per_key(new, [key], [], last=False) if len(columns) > 1 else new.distinct()
    if target is None:
        return new
    if key is not None:
        new = new.join(target.select(key), key, "left_anti")
    return target.select(*columns).unionByName(new)


def conditional_delete(df: DataFrame, ids: DataFrame, key: str, status_col: str, status_value) -> DataFrame:
    """``delete from t where key = :id and status = :s`` -> the keep-set."""
    flag = ids.select(key).distinct().withColumn("_del", F.lit(True))
    j = df.join(flag, key, "left")
    gone = F.coalesce(F.col("_del"), F.lit(False)) & F.coalesce(F.col(status_col) == F.lit(status_value), F.lit(False))
    return j.filter(~gone).drop("_del")


# ------------------------------------------------------------------ P15 / P16 / P17
def insert_generated_key(target: DataFrame, rows: DataFrame, id_col: str, order: Sequence[str | Column]) -> DataFrame:
    """New rows get ids ``max(existing) + 1, + 2, ...`` in ``order``.

    The maximum is a scalar subquery; the dense numbering is the global
    numbering of :func:`keyed_scan` (no single-task window)."""
    base = target.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    num = keyed_scan(rows, [], order, rn="_seq")
    return num.withColumn(id_col, (base + F.col("_seq")).cast("long")).drop("_seq")


def _versioned(target: DataFrame, changes: DataFrame, id_col: str, version_col: str, expected_col: str,
               order: Sequence[str], done: str, stored: Sequence[str] = ()) -> DataFrame:
    """Changes with the stored version ``_v``, the ``stored`` columns as ``_old_<c>`` and their outcome: one winner per id.

    Only the change whose expected version is the stored one applies, and of
    several such changes the first in ``order``; the others find the version
    already moved on and are ``stale``."""
    t = target.select(F.col(id_col).alias("_id"), F.col(version_col).alias("_v"), *[F.col(c).alias(f"_old_{c}") for c in stored])
    rank = F.struct(*order, *[c for c in changes.columns if c not in order])
    j = changes.join(t, changes[id_col] == t["_id"], "left").withColumn("_fits", F.coalesce(F.col("_v") == F.col(expected_col), F.lit(False)))
    best = j.filter("_fits").groupBy(F.col("_id").alias("_b")).agg(F.min(rank).alias("_best"))
    j = j.join(best, F.col("_id") == F.col("_b"), "left").withColumn(
        "_first", F.col("_fits") & F.coalesce(rank == F.col("_best"), rank.eqNullSafe(F.col("_best")))).drop("_b", "_best", "_fits")
    lost = F.when(F.col("_id").isNull(), F.lit("missing")).otherwise(F.lit("stale"))
    others = j.filter(~F.col("_first")).withColumn("outcome", lost)
    # changes that agree in every column are told apart by their number: one of them wins
    same = j.filter("_first").groupBy(*j.columns).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    firsts = same.withColumn("outcome", F.when(F.col("_turn") == 1, F.lit(done)).otherwise(F.lit("stale")))
    out = others.unionByName(firsts.drop("_n", "_turn"))
    return out.withColumn("affected", (F.col("outcome") == done).cast("int")).drop("_id", "_first")


def versioned_update(target: DataFrame, changes: DataFrame, id_col: str, version_col: str, expected_col: str,
                     set_cols: dict[str, Column | str], order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Optimistic update: (one row per change, next snapshot).

    A change applies when the stored version equals the version its writer
    read; the version then goes up by one, so a second change of the same
    version is ``stale``.  A change row has ``outcome`` (updated / stale /
    missing), the resulting ``version`` and set columns, and ``affected`` (1
    for updated)."""
    out = _versioned(target, changes.withColumns({f"_new_{c}": _c(v) for c, v in set_cols.items()}),
                     id_col, version_col, expected_col, order, "updated", list(set_cols))
    won = out.filter("affected = 1").select(F.col(id_col).alias("_id"), *[f"_new_{c}" for c in set_cols])
    snap = target.join(won, target[id_col] == won["_id"], "left")
    hit = F.col("_id").isNotNull()
    snap = snap.select(*[
        F.when(hit, F.col(f"_new_{c}").cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in set_cols
        else F.when(hit, F.col(c) + 1).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c) if c == version_col
        else F.col(c) for c in target.columns])
    after = {c: F.when(F.col("affected") == 1, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")) for c in set_cols}
    rows = out.withColumns({version_col: F.col("_v") + F.col("affected")} | after).drop(
        "_v", *[f"_new_{c}" for c in set_cols], *[f"_old_{c}" for c in set_cols])
    return rows, snap


def versioned_delete(target: DataFrame, changes: DataFrame, id_col: str, version_col: str, expected_col: str,
                     order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Optimistic delete: (one row per change with ``outcome`` deleted / stale / missing, next snapshot)."""
    out = _versioned(target, changes, id_col, version_col, expected_col, order, "deleted")
    gone = out.filter("affected = 1").select(id_col)
    return out.drop("_v"), target.join(gone, id_col, "left_anti")


def keyed_upsert(target: DataFrame, changes: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """Unversioned update/insert by key: changed rows replace, new rows append.

    Of several changes of one key the last by ``order`` (then by all columns) counts."""
    last = one_per_key(changes.select(*dict.fromkeys([*target.columns, *order])), [key], list(order)).select(*target.columns)
    return target.join(last.select(key), key, "left_anti").unionByName(last)


def keyed_delete(target: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``delete from t where key in (:ids)`` -> the keep-set."""
    return target.join(ids.select(key), key, "left_anti")


# ------------------------------------------------------------------ P18 / T2
#: Rows sampled to bracket a page, on average.
RANK_SAMPLE = 2000


def page_with_total(df: DataFrame, order: Sequence[str], page: int, size: int, with_total: bool = True) -> DataFrame:
    """Page ``page`` (0-based) of ``size`` rows in ``order`` (nulls first); ``total`` is the row count before paging.

    The page is found by rank selection.  A small sample of the order keys
    gives two keys between which the page's ranks should lie; one aggregate
    counts the rows below and between them exactly, and the bracket is widened
    until it holds the page.  Only the bracket is sorted, so a deep page costs
    no more than the first one."""
    kinds = {c: df.schema[c].dataType for c in order}
    key = F.struct(*order)
    total = df.count()
    first = min(page * size, total)
    last = min(first + size, total)
    keys = df.select(*order).sample(min(1.0, RANK_SAMPLE / max(total, 1)), seed=7).orderBy(*order).collect()  # about RANK_SAMPLE rows

    def bound(at: int):
        return F.struct(*[F.lit(keys[at][c]).cast(kinds[c]).alias(c) for c in order])

    margin = 3 * max(1, len(keys)) ** 0.5
    while True:
        lo, hi = int(first / max(total, 1) * len(keys) - margin), int(last / max(total, 1) * len(keys) + margin) + 1
        above = key >= bound(lo) if 0 <= lo < len(keys) else F.lit(True)
        under = key <= bound(hi) if 0 <= hi < len(keys) else F.lit(True)
        below, inside = df.agg(F.count(F.when(~above, 1)), F.count(F.when(above & under, 1))).first()
        if below <= first and last <= below + inside:
            break
        margin *= 4
    out = df.filter(above & under).orderBy(*order).offset(first - below).limit(last - first)
    return out.withColumn("total", F.lit(total).cast("long")) if with_total else out


def ordered_read(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order)


# ------------------------------------------------------------------ P19 / S11
def add_months_ts(ts: Column, months: int) -> Column:
    """Timestamp + n months, clipped at month end (30 Nov + 3 -> 28 Feb)."""
    return ts + F.expr(f"INTERVAL {int(months)} MONTHS")


def master_detail_load(sheet: DataFrame, users: DataFrame | None, now: _dt.datetime, order: Sequence[str],
                       roles_col: str = "roles") -> tuple[DataFrame, DataFrame]:
    """Sheet rows -> (user rows, role rows).

    Users get generated ids after the current maximum, ``enabled = 1``,
    ``cnt_badcredentials = 0``, account expiry now + 3 months, password
    expiry now + 1 month.  Each role of the comma list becomes a role row
    carrying the new user id (same row, so no join is needed)."""
    from flowframe.operators.split import role_list

    spark = sheet.sparkSession
    base_target = users if users is not None else spark.createDataFrame([], "user_id bigint")
    num = insert_generated_key(base_target, sheet, "user_id", order)
    from flowframe.functions.scalar import ntz_literal

    now_c = ntz_literal(now)
    user_rows = num.select(
        "user_id", "username", "password", "mail_address",
        F.lit(1).cast("smallint").alias("enabled"),
        F.lit(0).cast("smallint").alias("cnt_badcredentials"),
        add_months_ts(now_c, 3).alias("expired_account"),
        add_months_ts(now_c, 1).alias("expired_password"),
    )
    role_rows = num.select("user_id", F.posexplode_outer(role_list(roles_col)).alias("role_pos", "role")).filter(
        F.col("role_pos").isNotNull())
    return user_rows, role_rows


def sheet_until_blank(rows: DataFrame, row_idx: str, first_col: str, header_rows: int = 1) -> DataFrame:
    """Sheet rows after the header up to (not including) the first row whose
    first column is empty.  The stop row is one scalar ``min``; no global
    running window is needed."""
    body = rows.filter(F.col(row_idx) >= header_rows)
    blank = F.col(first_col).isNull() | (F.trim(F.col(first_col)) == "")
    stop = body.filter(blank).agg(F.min(row_idx)).scalar()
    return body.filter(stop.isNull() | (F.col(row_idx) < stop))


# ------------------------------------------------------------------ U2 / U3
NULL_TOKEN = "[null]"


def table_diff(expected: DataFrame, actual: DataFrame, include: Sequence[str] | None = None,
               exclude: Sequence[str] | None = None, null_token: str | None = NULL_TOKEN) -> DataFrame:
    """Rows present on one side only (multiset difference both ways) over the
    chosen columns; a string equal to the NULL token counts as NULL.
    Output: ``side`` ('expected' / 'actual') plus the compared columns."""
    cols = list(include) if include else [c for c in expected.columns if c not in set(exclude or ())]

    def prep(df):
        sel = []
        for c in cols:
            f = df.schema[c]
            if null_token is not None and f.dataType.simpleString() == "string":
                sel.append(F.when(F.col(c) == F.lit(null_token), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c))
            else:
                sel.append(F.col(c))
        return df.select(*sel)

    # one union of +1 and -1 and one aggregate; nulls group together
    both = prep(expected).withColumn("_n", F.lit(1)).unionByName(prep(actual).withColumn("_n", F.lit(-1)))
    left = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    side = F.when(F.col("_n") > 0, F.lit("expected")).otherwise(F.lit("actual"))
    return left.withColumn("side", side).withColumn("_n", F.explode(F.sequence(F.lit(1), F.abs("_n").cast("int")))).drop("_n")


def table_diff_tree(expected: DataFrame, actual: DataFrame, include: Sequence[str] | None = None,
                    exclude: Sequence[str] | None = None, null_token: str | None = NULL_TOKEN,
                    level_bits: Sequence[int] = (12, 12)) -> DataFrame:
    """:func:`table_diff` for large tables that differ little: only rows of unequal buckets are compared.

    A row's bucket is taken from a hash of its compared columns, so equal rows
    share one.  A bucket's checksum is its row count and the sums of two
    independent 64-bit hashes, which do not depend on the order of rows.  Each
    level looks at the buckets that differed on the level above, divided by
    the next bits of the hash; what crosses the network is a checksum a bucket
    and then the rows of the buckets that differ."""
    cols = list(include) if include else [c for c in expected.columns if c not in set(exclude or ())]

    def prep(df: DataFrame) -> DataFrame:
        sel = [F.when(F.col(c) == F.lit(null_token), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
               if null_token is not None and df.schema[c].dataType.simpleString() == "string" else F.col(c) for c in cols]
        # nulls leave a hash as it is, so which columns are null is hashed as well
        empty = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
        return df.select(*sel).withColumns({"_h": F.xxhash64(*cols, empty), "_g": F.xxhash64(F.lit(7), empty, *cols)})

    def halves(name: str, sign: int) -> list[Column]:
        c, n = F.col(name), F.lit(sign)
        return [F.sum(c.bitwiseAND(F.lit(0xFFFFFFFF)) * n), F.sum(F.shiftrightunsigned(c, 32) * n)]

    sides = [prep(expected), prep(actual)]
    known, depth = None, 0
    for bits in level_bits:
        if known is not None:  # the buckets that differ, of the level above: at most 2 ** depth numbers
            above = F.shiftrightunsigned("_h", 64 - depth)
            sides = [s.join(F.broadcast(known), above == F.col("_bucket"), "left_semi") for s in sides]
        depth += bits
        bucket = F.shiftrightunsigned("_h", 64 - depth).alias("_bucket")
        sums = [s.groupBy(bucket).agg(F.sum(F.lit(sign)).alias("n"), *[
            x.alias(f"s{k}") for k, x in enumerate([*halves("_h", sign), *halves("_g", sign)])]) for s, sign in zip(sides, (1, -1))]
        both = sums[0].unionByName(sums[1]).groupBy("_bucket").agg(*[F.sum(c).alias(c) for c in ("n", "s0", "s1", "s2", "s3")])
        known = stage_table(both.filter("n <> 0 or s0 <> 0 or s1 <> 0 or s2 <> 0 or s3 <> 0").select("_bucket"), "unequal")
    last = F.shiftrightunsigned("_h", 64 - depth)
    left, right = (s.join(known, last == F.col("_bucket"), "left_semi").drop("_h", "_g") for s in sides)
    return table_diff(left, right, null_token=None)


def fixture_load(spark: SparkSession, csv_dir: str, order: Sequence[str], schemas: dict[str, str],
                 out_dir: str, null_token: str = NULL_TOKEN) -> dict[str, DataFrame]:
    """Clean insert from a CSV directory: tables in ``order``, each target
    emptied first (overwrite), the NULL token read as NULL."""
    loaded = {}
    for name in order:
        df = spark.read.option("header", True).option("nullValue", null_token).schema(schemas[name]).csv(f"{csv_dir}/{name}.csv")
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
        loaded[name] = spark.read.parquet(f"{out_dir}/{name}")
    return loaded

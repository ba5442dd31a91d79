"""Projections, filters, routers and enrichers (row-local: no shuffle).

A message is a row.  Known headers are typed columns; free-form headers
live in a ``MAP<STRING,STRING>`` column (``headers`` by default).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- P1 / P2
def header_enrich(df: DataFrame, name: str, value: Column | str, overwrite: bool = False,
                  headers: str | None = None) -> DataFrame:
    """Set header ``name``.  Without ``overwrite`` an existing non-null value
    is kept; with it the value is replaced.  ``headers`` names a map column
    to enrich instead of a typed column."""
    v = _c(value) if not isinstance(value, str) or value in df.columns else F.lit(value)
    if headers is None:
        if name in df.columns and not overwrite:
            return df.withColumn(name, F.coalesce(F.col(name), v))
        return df.withColumn(name, v)
    h = F.coalesce(F.col(headers), F.create_map().cast("map<string,string>"))
    vs = v.cast("string")
    rest = F.map_filter(h, lambda k, _: k != F.lit(name))
    replaced = F.map_concat(rest, F.create_map(F.lit(name), vs))
    if overwrite:
        return df.withColumn(headers, replaced)
    return df.withColumn(headers, F.when(F.map_contains_key(h, name), h).otherwise(replaced))


def stash(df: DataFrame, column: str, as_header: str = "original_payload") -> DataFrame:
    """Keep a copy of a column before a transform changes it."""
    return df.withColumn(as_header, F.col(column))


def restore(df: DataFrame, column: str, from_header: str = "original_payload", drop: bool = True) -> DataFrame:
    out = df.withColumn(column, F.col(from_header))
    return out.drop(from_header) if drop else out


# ---------------------------------------------------------------- P3 / P4
def typed_transform(df: DataFrame, value: str, out: str = "payload") -> DataFrame:
    """int -> ``v*2`` -> string -> string + ``...`` (chained transforms)."""
    return df.withColumn(out, F.concat((F.col(value) * 2).cast("string"), F.lit("...")))


def record_build(df: DataFrame, count_col: str, names: Sequence[str], out: str = "value") -> DataFrame:
    """int -> ``struct(count, fullName)``; the name is a seeded pick from the
    count instead of a random one, so a rerun gives the same record."""
    from flowframe.functions.scalar import seeded_pick

    return df.withColumn(out, F.struct(F.col(count_col).cast("int").alias("count"),
                                       seeded_pick(count_col, names).alias("fullName")))


# ---------------------------------------------------------------- P5 / P6
def header_filter(df: DataFrame, required: Sequence[str], headers: str = "headers") -> DataFrame:
    """Keep rows whose header map holds every required key (others dropped silently)."""
    cond = F.lit(True)
    for k in required:
        cond = cond & F.coalesce(F.map_contains_key(F.col(headers), k), F.lit(False))
    return df.filter(cond)


def validate_split(df: DataFrame, valid: Column, message: Column | str) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejected); rejected rows carry ``error_message``.
    A null test counts as rejected."""
    ok = F.coalesce(valid, F.lit(False))
    msg = message if isinstance(message, Column) else F.lit(message)
    return df.filter(ok), df.filter(~ok).withColumn("error_message", msg)


def validate_strict(df: DataFrame, valid: Column, message: str) -> DataFrame:
    """Strict form: an invalid row fails the job.

    The check is a filter, which the optimizer cannot drop as it would an
    unused column."""
    return df.filter(F.when(F.coalesce(valid, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


# ---------------------------------------------------------------- P7 / P8 / P9
def two_way_route(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """(true branch, false branch); a null test goes to the false branch."""
    t = F.coalesce(cond, F.lit(False))
    return df.filter(t), df.filter(~t)


def route_tag(df: DataFrame, cond: Column, true_name: str, false_name: str, out: str = "route") -> DataFrame:
    return df.withColumn(out, F.when(F.coalesce(cond, F.lit(False)), F.lit(true_name)).otherwise(F.lit(false_name)))


def recipient_list(df: DataFrame, recipients: Sequence[tuple[str, Column]], default: str | None = "default",
                   out: str = "recipient") -> DataFrame:
    """Every recipient whose condition holds gets a copy (0..n rows per
    message); with ``default`` a message no recipient takes goes there."""
    tags = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in recipients]),
                    lambda x: x.isNotNull())
    if default is not None:
        tags = F.when(F.size(tags) == 0, F.array(F.lit(default))).otherwise(tags)
    return df.withColumn(out, F.explode(tags))


def wire_tap(df: DataFrame, taps: Sequence[tuple[str, Column | None]], main: str = "main",
             out: str = "sink") -> DataFrame:
    """Batch form of wire taps: the main flow plus one tagged copy per tap
    (a tap may filter with its condition).  Each sink then filters on ``out``."""
    return recipient_list(df, [(main, F.lit(True))] + [(n, c if c is not None else F.lit(True)) for n, c in taps],
                          default=None, out=out)


# ---------------------------------------------------------------- P10 / P11
def unwrap_result(df: DataFrame, is_error: str, evaluation_result: str, payload: str, out: str = "payload") -> DataFrame:
    """If the payload is a failure wrapper take its evaluated value, else the payload."""
    return df.withColumn(out, F.when(F.coalesce(F.col(is_error), F.lit(False)), F.col(evaluation_result)).otherwise(F.col(payload)))


def status_line(url: Column | str, status: Column | str) -> Column:
    """``url + "," + status``, where a missing status prints as ``null``."""
    return F.concat(_c(url), F.lit(","), F.coalesce(_c(status).cast("string"), F.lit("null")))


def status_attach(lines: DataFrame, results: DataFrame, url_col: str = "url", status_col: str = "status",
                  check: Column | None = None, out: str = "line") -> DataFrame:
    """Attach a looked-up status to each line (P11 + J4).

    Lines that pass ``check`` look their URL up in ``results`` (one row per
    URL: ``(url, status)``); others skip the lookup and print ``url,null``.
    A left join keeps every line; the result table is deduplicated by URL
    first so a line never multiplies.  The planner picks broadcast or
    shuffle from the measured size of ``results`` (AQE), so no unbounded
    side is forced into memory.
    """
    res = results.select(F.col(url_col).alias("_url"), F.col(status_col).alias("_status"))
    res = res.groupBy("_url").agg(F.max("_status").alias("_status"))
    joined = lines.join(res, lines[url_col] == res["_url"], "left")
    st = F.col("_status") if check is None else F.when(F.coalesce(check, F.lit(False)), F.col("_status"))
    return joined.withColumn("status", st).withColumn(out, status_line(url_col, "status")).drop("_url", "_status")


# ---------------------------------------------------------------- U1
def branch_union(*frames: DataFrame) -> DataFrame:
    """Merge of branches: columns matched by name, missing ones become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

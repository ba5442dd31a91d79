"""Scalar helpers (F1-F14): all built-in Spark expressions, no Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# F1 ---------------------------------------------------------------
def concat_null_as_text(*parts: Column | str, sep: str = "") -> Column:
    """Java string concatenation: a null operand prints as ``null``
    (plain ``concat`` would return null)."""
    cols = [F.coalesce(_c(p).cast("string"), F.lit("null")) for p in parts]
    return F.concat_ws(sep, *cols) if sep else F.concat(*cols)


# F2 ---------------------------------------------------------------
def starts_with(col: Column | str, prefix: str) -> Column:
    """Case-sensitive prefix test; null -> false."""
    return F.coalesce(_c(col).startswith(prefix), F.lit(False))


def ends_with(col: Column | str, suffix: str) -> Column:
    return F.coalesce(_c(col).endswith(suffix), F.lit(False))


# F3 ---------------------------------------------------------------
def fmt(pattern: str, *cols: Column | str) -> Column:
    """``String.format`` with %d / %s."""
    return F.format_string(pattern, *[_c(c) for c in cols])


# F4 ---------------------------------------------------------------
def chomp(col: Column | str) -> Column:
    """Drop one trailing line break (``\\r\\n``, ``\\r`` or ``\\n``).  ``\\z``,
    not ``$``: ``$`` also matches before a final break."""
    return F.regexp_replace(_c(col), r"(\r\n|\r|\n)\z", "")


# F7 / F8 ----------------------------------------------------------
def date_text(ts: Column | str) -> Column:
    """``uuuu/MM/dd HH:mm:ss`` (Spark spells the year ``yyyy``)."""
    return F.date_format(_c(ts), "yyyy/MM/dd HH:mm:ss")


def plus_months(ts: Column | str, n: int) -> Column:
    """Calendar months, clipped at month end."""
    return _c(ts) + F.expr(f"INTERVAL {int(n)} MONTHS")


def plus_millis(ts: Column | str, ms: Column | int) -> Column:
    from flowframe.operators.delay import ms_interval

    return _c(ts) + ms_interval(ms)


# F9 ---------------------------------------------------------------
def to_int_or_null(col: Column | str) -> Column:
    """String -> int; not a number -> null (never fails the job)."""
    return F.trim(_c(col).cast("string")).try_cast("int")


def clamp(col: Column | str, lo, hi) -> Column:
    return F.least(F.greatest(_c(col), F.lit(lo)), F.lit(hi))


# F10 --------------------------------------------------------------
def seeded_index(col: Column | str, n: int, seed: int = 12345) -> Column:
    """Deterministic stand-in for "random int in [0, n)": a linear
    congruential step of the row id, so reruns and other engines agree."""
    x = (_c(col).cast("long") * F.lit(1103515245) + F.lit(seed)) % F.lit(2147483648)
    return F.pmod(x, F.lit(n)).cast("int")


def seeded_pick(col: Column | str, choices: Sequence[str], seed: int = 12345) -> Column:
    arr = F.array(*[F.lit(c) for c in choices])
    return F.element_at(arr, seeded_index(col, len(choices), seed) + 1)


# F11 --------------------------------------------------------------
# F12 --------------------------------------------------------------
def map_get(m: Column | str, key: str) -> Column:
    """Missing key -> null (``getItem``; ANSI ``element_at`` would raise)."""
    return _c(m).getItem(key)


def map_put(m: Column | str, key: str, value: Column) -> Column:
    """Put, replacing an existing entry (no duplicate-key error)."""
    mm = F.coalesce(_c(m), F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(mm, lambda k, _: k != F.lit(key)), F.create_map(F.lit(key), value.cast("string")))


def map_has(m: Column | str, key: str) -> Column:
    return F.coalesce(F.map_contains_key(_c(m), key), F.lit(False))


# F14 --------------------------------------------------------------
def file_name(path: Column | str) -> Column:
    """Last path element (either separator)."""
    return F.regexp_extract(_c(path), r"([^/\\]*)$", 1)


def parent_dir(path: Column | str) -> Column:
    return F.regexp_extract(_c(path), r"^(.*)[/\\][^/\\]*$", 1)


def reroot(path: Column | str, new_dir: str) -> Column:
    """Same file name under another directory."""
    return F.concat(F.lit(new_dir.rstrip("/") + "/"), file_name(path))


def ntz_literal(value) -> Column:
    """A wall-clock timestamp literal (TIMESTAMP_NTZ) that does not depend on
    the session or machine time zone (``F.lit(datetime)`` would be
    zone-aware and shift when cast)."""
    return F.expr(f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S.%f}'")


_NTZ_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def ntz_micros(col: Column | str) -> Column:
    """Microseconds of a wall-clock timestamp since the epoch, read as UTC
    (zone-free arithmetic, unlike ``unix_micros(cast(ts as timestamp))``)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_NTZ_EPOCH), _c(col))


def ntz_as_utc_instant(col: Column | str) -> Column:
    """The instant whose UTC wall time is this NTZ value (streaming event
    time must be zone-aware; this keeps windows and timers zone-free)."""
    return F.timestamp_micros(ntz_micros(col))

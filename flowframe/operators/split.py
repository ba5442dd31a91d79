"""Splitters: one row in, many rows out, each with sequence details.

All three are generators over one row (``posexplode``), so they never
shuffle; the sequence size is the array size, known on the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def split_sequence(df: DataFrame, array_col: str, parent_id: str, payload: str = "payload",
                   keep: list[str] | tuple = ()) -> DataFrame:
    """One row per array element with ``corr_id`` (the parent id), 1-based
    ``seq_no`` and ``seq_size`` = array size.  Empty or null arrays emit nothing.

    ``posexplode_outer`` + a null filter instead of ``posexplode``: the plain
    generator makes the optimizer infer a ``size(array) > 0`` filter and push
    it into the scan, which evaluates an expensive array expression twice."""
    out = df.select(
        *keep,
        F.col(parent_id).alias("corr_id"),
        F.size(array_col).alias("seq_size"),
        F.posexplode_outer(array_col).alias("pos", payload),
    ).filter(F.col("pos").isNotNull())
    return out.select(*keep, "corr_id", (F.col("pos") + 1).alias("seq_no"), "seq_size", payload)


def text_lines(text: Column | str) -> Column:
    r"""Lines of a text as a line reader gives them: split on ``\n`` or
    ``\r\n``; one trailing line break ends the last line instead of
    starting an empty one; an empty text has no lines.  Texts without a
    ``\r`` take a literal split (no regex)."""
    t = F.col(text) if isinstance(text, str) else text
    n = F.length(t)
    body = (F.when(t.endswith("\r\n"), t.substr(F.lit(1), n - 2))
            .when(t.endswith("\n"), t.substr(F.lit(1), n - 1))
            .otherwise(t))
    lines = F.when(F.instr(body, "\r") > 0, F.split(body, r"\r?\n")).otherwise(F.split(body, "\n"))
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).otherwise(lines)


def split_lines(df: DataFrame, text_col: str, file_col: str, line: str = "line",
                keep: list[str] | tuple = (), partitions: int | None = None) -> DataFrame:
    """File line splitter: ``(file, seq_no, seq_size, line)``; the size is
    the line count of the file, set on every line.  ``partitions`` deals the
    texts out first, for a caller whose input is one unsplittable file."""
    src = df.select(*keep, file_col, text_col)
    src = src.repartition(partitions) if partitions else src
    arr = src.select(*keep, F.col(file_col).alias("corr_id"), text_lines(text_col).alias("_lines"))
    return split_sequence(arr, "_lines", "corr_id", payload=line, keep=keep)


# Java's String.split drops trailing empty strings; Spark's split keeps
# them.  A blank test must see full-width spaces too, hence (?U)\S.
def role_list(roles: Column | str) -> Column:
    """Comma list -> array: null or blank -> []; trailing empties dropped;
    ``",A,"`` -> ``['', 'A']``."""
    r = F.col(roles) if isinstance(roles, str) else roles
    stripped = F.regexp_replace(r, ",+$", "")
    return (
        F.when(r.isNull() | ~r.rlike(r"(?U)\S"), F.array().cast("array<string>"))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, ","))
    )


def split_roles(df: DataFrame, roles_col: str, keep: list[str] | tuple = (), role: str = "role") -> DataFrame:
    """One row per role with its 1-based position."""
    out = df.select(*keep, F.posexplode_outer(role_list(roles_col)).alias("pos", role)).filter(F.col("pos").isNotNull())
    return out.select(*keep, (F.col("pos") + 1).alias("role_no"), role)

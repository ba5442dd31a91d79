"""Message-group release over a stream (M3, M6): release at size, late discard, timeout.

The outcome of a correlation id is a function of its rows in arrival order;
``group_outcomes`` states it for a table, ``stream_group_release`` keeps it
up to date for a stream (see ``runner.keyed_recompute``).

* The first message of a group declares its size; the group is released as
  one list when it holds that many, and the id is complete from then on.
* With a timeout, a message that comes later than that after the previous
  one finds the pending group given up (its messages are ``discarded``) and
  opens a new one.
* Messages of a complete id are ``late``.
* A group that is still waiting is ``pending``, or ``discarded`` when
  ``as_of`` lies beyond its timeout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowframe.operators.sequence import keyed_scan, split_heavy
from flowframe.session import stage_table
from flowframe.streaming.runner import keyed_recompute, newest_results, run_batches

OUTCOME_SCHEMA = "corr_id string, outcome string, seq long, payloads string"


def group_outcomes(rows: DataFrame, key: str, order: Sequence[str | Column], size_col: str, payload: str, arrival_ts: str,
                   timeout_seconds: float | None = None, as_of: Column | None = None) -> DataFrame:
    """(corr_id, outcome, seq, payloads): a row per released list, and per late, discarded or pending message.

    Ids whose rows one task can hold are dealt by id once and settled there; only the others, if any, are cut into chunks.
    ``rows`` is read twice, first to count the ids' rows."""
    narrow = rows.select(
        # a null id is a group like any other
        F.struct(F.lit(0), F.col(key).cast("string").alias("corr_id")).alias("k"), F.col(payload).cast("string").alias("payload"),
        F.col(size_col).cast("long").alias("size"), F.col(arrival_ts).alias("arrival"),
        *[F.col(o).alias(f"o{i}") if isinstance(o, str) else o.alias(f"o{i}") for i, o in enumerate(order)])
    by = [f"o{i}" for i in range(len(order))]
    light, heavy = split_heavy(narrow, "k")
    out = _lists(_settled(light, by, timeout_seconds, as_of))
    return out if heavy is None else out.unionByName(_lists(_settled_chunks(heavy, by, timeout_seconds, as_of)))


def _gap(timeout_seconds: float) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(timeout_seconds).cast("decimal(18,6)"))


def _settled(s: DataFrame, by: list[str], timeout_seconds: float | None, as_of: Column | None) -> DataFrame:
    """The outcome of every row, each id's rows in one task: all windows lie on one exchange by id."""
    along = Window.partitionBy("k").orderBy(*by)
    s = s.withColumn("rn", F.row_number().over(along).cast("long"))
    if timeout_seconds is None:
        s = s.select("k", "payload", "size", "arrival", "rn", F.lit(1).cast("long").alias("session"))
    else:
        prev = F.lag("arrival").over(along)
        new = prev.isNull() | F.coalesce(F.col("arrival") > prev + _gap(timeout_seconds), F.lit(False))
        so_far = Window.partitionBy("k").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
        s = s.withColumn("new", new.cast("long")).select("k", "payload", "size", "arrival", "rn", F.sum("new").over(so_far).alias("session"))
    run = Window.partitionBy("k", "session")
    inside = run.orderBy("rn")
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumns({"pos": F.row_number().over(inside).cast("long"), "n": F.count(F.lit(1)).over(whole),
                       "wanted": F.first("size").over(whole), "last": F.max("arrival").over(whole)})
    ids = Window.partitionBy("k").orderBy("session", "rn").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumns({"done": F.min(F.when(F.col("n") >= F.col("wanted"), F.col("session"))).over(ids),
                       "newest": F.max("session").over(ids)})
    return s.select("k", "session", "pos", "wanted", "payload", _state(timeout_seconds, as_of).alias("outcome"))


def _settled_chunks(s: DataFrame, by: list[str], timeout_seconds: float | None, as_of: Column | None) -> DataFrame:
    """The same for ids with many rows: numbered in chunks, what a run and an id add up to is joined back."""
    if timeout_seconds is None:
        s = keyed_scan(s, ["k"], by, rn="pos").withColumn("session", F.lit(1).cast("long"))
    else:
        s = keyed_scan(s, ["k"], by, gap=("arrival", timeout_seconds)).withColumnsRenamed(
            {"session_no": "session", "session_rn": "pos"})
    # the numbers are written once, as three steps read them
    s = stage_table(s.select("k", "session", "pos", "size", "arrival", "payload"), "outcomes")
    runs = s.groupBy("k", "session").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("size", "pos").alias("wanted"), F.max("arrival").alias("last"))
    ids = runs.groupBy("k").agg(
        F.min(F.when(F.col("n") >= F.col("wanted"), F.col("session"))).alias("done"), F.max("session").alias("newest"))
    s = s.join(runs.select("k", "session", "wanted", "last"), ["k", "session"]).join(ids, "k")
    return s.select("k", "session", "pos", "wanted", "payload", _state(timeout_seconds, as_of).alias("outcome"))


def _state(timeout_seconds: float | None, as_of: Column | None) -> Column:
    inside = (F.col("session") == F.col("done")) & (F.col("pos") <= F.col("wanted"))
    given_up = F.col("done").isNull() & (F.col("session") < F.col("newest"))
    if timeout_seconds is not None and as_of is not None:
        given_up |= F.col("done").isNull() & (F.col("last") + _gap(timeout_seconds) < as_of)
    return (F.when(inside, F.lit("released")).when(F.col("session") < F.col("done"), F.lit("discarded"))
            .when(F.col("done").isNotNull(), F.lit("late")).when(given_up, F.lit("discarded")).otherwise(F.lit("pending")))


def _lists(s: DataFrame) -> DataFrame:
    """A row per released list and per other message: one aggregate, in which a message that is not released stands alone."""
    released = F.col("outcome") == "released"
    at = F.when(~released, F.struct("session", "pos"))
    items = F.array_sort(F.collect_list(F.struct("pos", "payload")))
    text = F.concat_ws(" ", F.transform("items", lambda x: F.coalesce(x["payload"], F.lit("None"))))
    return s.groupBy("k", "outcome", at.alias("at")).agg(F.max("wanted").alias("wanted"), items.alias("items")).select(
        F.col("k.corr_id").alias("corr_id"), "outcome", F.when(released, F.col("wanted")).alias("seq"),
        F.when(released, text).otherwise(F.col("items")[0]["payload"]).alias("payloads"))


def stream_group_release(stream: DataFrame, base: str, key: str, order: Sequence[str], size_col: str, payload: str,
                         arrival_ts: str, timeout_seconds: float | None = None, as_of: Column | None = None) -> DataFrame:
    """Take in everything available and return the newest outcome of every id under ``base``."""
    spark = stream.sparkSession
    src = stream.withColumn("corr_id", F.col(key).cast("string"))

    def compute(rows: DataFrame) -> DataFrame:
        return group_outcomes(rows, "corr_id", order, size_col, payload, arrival_ts, timeout_seconds, as_of)

    run_batches(src, keyed_recompute(base, ["corr_id"], compute), base)
    return newest_results(spark, base, ["corr_id"], StructType.fromDDL("corr_id string"), StructType.fromDDL(OUTCOME_SCHEMA))

"""Streaming queries (M2-M5, M8) run to completion; their batch SQL is the oracle."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from flowframe.operators import delay as D
from flowframe.plans.bindings import LINEITEM_ARRIVAL, events, grouped_messages
from flowframe.plans.flows import PAYLOAD_SQL
from flowframe.plans.groups import LINES_SQL, RANKED_SQL, RELEASE_TIMEOUT_SQL, SEQ_AGG_SQL, doc_lines
from flowframe.plans.io import LISTING_PATH_SQL, _listings
from flowframe.plans.registry import register, table
from flowframe.functions.scalar import date_text, ntz_as_utc_instant, ntz_literal
from flowframe.session import scratch_path
from flowframe.streaming.delayer import stream_delayer
from flowframe.streaming.group_release import stream_group_release
from flowframe.streaming.group_state import group_state, run_group_state
from flowframe.sources.files import file_poll_source
from flowframe.sources.queue import append_envelopes, read_envelopes
from flowframe.sources.records import envelope_unwrap, envelope_wrap
from flowframe.streaming.resequence import run_resequence, stream_resequence
from flowframe.streaming.status_join import run_status_join, split_late, status_join
from flowframe.streaming.jobs import copy_orders_batch, stream_accept_once, stream_tick_window
from flowframe.streaming.runner import BUCKETS, child_names, read_batches, run_available_now, run_batches, stage_in_order

#: After every release time of the test events.
AFTER_ALL = dt.datetime(2100, 1, 1)


def _stage(df, name):
    base = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(f"{base}/in")
    return base


#: Micro-batches that a staged table is taken in with; more rows make larger ones, not more.
MICRO_BATCHES = 8


def _stream(df, base):
    """The staged rows as a file stream, one file per micro-batch, or more where there are more files than ``MICRO_BATCHES``."""
    files = len(child_names(df.sparkSession, f"{base}/in", "*.parquet"))
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", max(1, -(-files // MICRO_BATCHES))).parquet(f"{base}/in")


@register("stream_group_release", f"""
select cast(corr_id as varchar) as corr_id, 'released' as outcome, group_size as seq, payloads from ({SEQ_AGG_SQL})
union all
select cast(corr_id as varchar), 'late', null, payload from ({RANKED_SQL}) where rn > group_size
""")
def q_stream_group_release(spark, d):
    src = grouped_messages(spark, d).select("corr_id", "seq_size", "payload", *LINEITEM_ARRIVAL)
    base = _stage(src, "grp")
    out = stream_group_release(_stream(src, base), f"{base}/run", "corr_id", LINEITEM_ARRIVAL, "seq_size", "payload", "l_shipdate")
    return out.filter("outcome <> 'pending'")


@register("stream_group_state", f"""
with o as ({RELEASE_TIMEOUT_SQL}),
a as (select cast(l_orderkey as varchar) as corr_id, max(l_shipdate) as last from lineitem group by l_orderkey),
c as (select max(l_shipdate) - interval 1 day as clock from lineitem)
select o.corr_id, case when outcome = 'pending' then 'discarded' else outcome end as outcome, seq, payloads
from o join a on a.corr_id = o.corr_id cross join c
where outcome <> 'pending' or a.last + interval 30 day <= c.clock
""")
def q_stream_group_state(spark, d):
    """The same groups as keyed state with timers, in the order in which the lines ship."""
    src = grouped_messages(spark, d).select("corr_id", "seq_size", "payload", *LINEITEM_ARRIVAL)
    base = scratch_path(spark, f"group-state-{uuid.uuid4().hex}")
    stream = stage_in_order(src, LINEITEM_ARRIVAL, base)
    out = group_state(stream, "corr_id", "arrival_no", "seq_size", "payload", ntz_as_utc_instant("l_shipdate"), "1 day",
                      timeout_ms=30 * 86_400_000, buckets=BUCKETS)
    return run_group_state(out, f"{base}/run")


@register("stream_status_join", """
with l as (select event_id, user_id, ts from events where event_type in ('view', 'click')),
r as (select event_id, user_id, ts from events where event_type in ('signup', 'purchase', 'error'))
select l.event_id as line_id, r.event_id as result_id
from l left join r on l.user_id = r.user_id and r.ts between l.ts and l.ts + interval 1 day
""")
def q_stream_status_join(spark, d):
    """Views and clicks as lines, the user's other events within a day as their results."""
    ev = events(spark, d).select("event_id", "user_id", "ts", "event_type")
    asks = F.col("event_type").isin("view", "click")
    base = scratch_path(spark, f"status-join-{uuid.uuid4().hex}")
    # a beat far behind the last event, of nobody, on both streams: lines at the end do not wait for another one
    # (not of a null user: such rows are filtered before the watermark sees them)
    beat = ev.agg((F.max("ts") + F.expr("INTERVAL 10 DAYS")).alias("ts")).select(
        F.lit(None).cast(ev.schema["event_id"].dataType).alias("event_id"), F.lit(-1).cast(ev.schema["user_id"].dataType).alias("user_id"),
        "ts", F.lit("beat").alias("event_type"))
    sides = []
    for name, rows in (("lines", ev.filter(asks)), ("results", ev.filter(~asks))):
        stream = stage_in_order(rows.unionByName(beat), ["ts", "event_id"], f"{base}/{name}", files=4)
        in_time, _ = split_late(stream.drop("event_type", "arrival_no"), f"{base}/{name}/taken", ntz_as_utc_instant("ts"), "1 day")
        sides.append(in_time)
    joined = status_join(*sides, "user_id", ntz_as_utc_instant("ts"), ntz_as_utc_instant("ts"), "1 day", "1 day")
    out, _ = run_status_join(joined, f"{base}/run")
    return out.filter(F.col("event_id").isNotNull()).select(F.col("event_id").alias("line_id"), F.col("result_event_id").alias("result_id"))


@register("stream_resequence", f"select corr_id::varchar as corr_id, seq_no, seq_size, line as payload from ({LINES_SQL}) where corr_id is not null")
def q_stream_resequence(spark, d):
    """Lines of documents that come in the order of a hash leave in the order of their numbers."""
    lines = doc_lines(spark, d).filter(F.col("corr_id").isNotNull()).withColumn("mixed", F.xxhash64("corr_id", "seq_no"))
    base = scratch_path(spark, f"resequence-{uuid.uuid4().hex}")
    stream = stage_in_order(lines, ["mixed"], base, files=4)
    return run_resequence(stream_resequence(stream, "corr_id", "seq_no", "seq_size", "line", buckets=4 * BUCKETS), f"{base}/run")


@register("file_poll_stream", "select event_type, count(*) as n_records, 6 as n_files from events group by event_type")
def q_file_poll_stream(spark, d):
    """A directory polled two files at a time, then again after a restart when more files have come."""
    base = scratch_path(spark, f"poll-{uuid.uuid4().hex}")
    ev = events(spark, d).select("event_type")
    for part in (0, 1):
        ev.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(6))).filter(
            (F.col("part") < 3) if part == 0 else (F.col("part") >= 3)).repartition(3).drop("part").write.mode("append").parquet(f"{base}/in")
        poll = file_poll_source(spark, f"{base}/in", "parquet", streaming=True, max_files_per_trigger=2, schema=ev.schema)
        taken = run_available_now(poll.select("event_type", "file_name"), "poll", base=f"{base}/run")
    files = taken.agg(F.countDistinct("file_name").cast("int")).scalar()
    return taken.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_records")).withColumn("n_files", files)


@register("datasource_envelopes", """
select event_id as id, strftime(ts, '%Y/%m/%d %H:%M:%S') as created, event_type, value, (event_id % 3)::bigint as append from events
""")
def q_datasource_envelopes(spark, d):
    """Events as envelopes of a queue, taken by a source of our own: two appends, a restart, the third."""
    ev = events(spark, d).select(F.col("event_id").alias("id"), date_text("ts").alias("created"), "event_type", "value")
    wrapped = envelope_wrap(ev, ["id", "created"], ["event_type", "value"])
    base = scratch_path(spark, f"queue-{uuid.uuid4().hex}")
    for part in (0, 1, 2):
        append_envelopes(wrapped.filter(F.pmod("id", F.lit(3)) == part), f"{base}/queue")
        if part:
            taken = run_available_now(read_envelopes(spark, f"{base}/queue", streaming=True), "queue", base=f"{base}/run")
    return envelope_unwrap(taken, "value", "id bigint, created string", "event_type string, value double")


@register("stream_delayer", f"""
select event_id as msg_id, cast(user_id as varchar) as key,
       ts + to_milliseconds(coalesce(try_cast(trim({PAYLOAD_SQL}) as bigint), 8000)) as release_ts
from events
""")
def q_stream_delayer(spark, d):
    ev = events(spark, d).withColumn("payload", F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.regexp_extract("props", r'"k": (\d+)', 1)))
    ev = D.delay_from_payload(ev, "ts", "payload", 8000).select("event_id", "user_id", "ts", "release_ts")
    base = _stage(ev, "delay")
    out = stream_delayer(_stream(ev, base), f"{base}/run", "ts", "release_ts", as_of=ntz_literal(AFTER_ALL))
    return out.select(F.col("event_id").alias("msg_id"), F.col("user_id").cast("string").alias("key"), "release_ts")


@register("stream_tick_window", """
select time_bucket(interval 1 hour, ts) + interval 1 hour as drained_at, count(*) as n_messages,
       min(event_id) as first_id, max(event_id) as last_id
from events group by time_bucket(interval 1 hour, ts)
""")
def q_stream_tick_window(spark, d):
    ev = events(spark, d).select("event_id", "ts")
    base = _stage(ev, "ticks")
    return stream_tick_window(_stream(ev, base), f"{base}/run", "ts", "1 hour", "event_id")


@register("stream_accept_once", f"""
select distinct {LISTING_PATH_SQL} as file_path from events where event_type <> 'error'
""")
def q_stream_accept_once(spark, d):
    lst = _listings(spark, d)
    base = _stage(lst, "listing")
    return run_available_now(stream_accept_once(_stream(lst, base), "file_path", "listing_ts"), "listing-out", base=f"{base}/run")


def _copied(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    base = _stage(o, "copy")
    run_batches(_stream(o, base), copy_orders_batch(spark, f"{base}/run", "o_orderkey", "o_orderstatus", "F", "C"), f"{base}/run")
    return o, f"{base}/run"


@register("stream_copy_orders", "select o_orderkey as order_id from orders where o_orderstatus = 'F'")
def q_stream_copy_orders(spark, d):
    o, base = _copied(spark, d)
    return read_batches(spark, base, "target", o.select(F.col("o_orderkey").alias("order_id")).schema).select("order_id")


@register("stream_copy_remaining", "select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'F'")
def q_stream_copy_remaining(spark, d):
    """The source table after the job: what was claimed and copied is deleted."""
    o, base = _copied(spark, d)
    return read_batches(spark, base, "source", o.schema).drop("batch_id")

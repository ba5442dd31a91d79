"""Delay, retry, window and as-of queries (D1-D5, R1-R10, W1-W4, J3) on the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from flowframe.functions.scalar import ntz_literal, ntz_micros
from flowframe.operators import delay as D
from flowframe.operators import retry as R
from flowframe.operators.joins import asof_gate
from flowframe.operators.scan import bounded_queue
from flowframe.operators.windows import priority_order, queue_depth
from flowframe.plans.bindings import EVENT_ORDER, events
from flowframe.plans.registry import register, table

# Error classes assigned to failed attempts (by event_id mod 3)
# and the alert mail of the error channel.
ERROR_CLASSES = (
    "java.nio.file.FileSystemAlreadyExistsException",
    "java.nio.file.FileSystemNotFoundException",
    "java.lang.IllegalStateException",
)
ERRORMAIL_TO = "alert@test.co.jp"
ERRORMAIL_SUBJECT = "エラーが発生しました"
REPLAY_NOW = dt.datetime(2024, 1, 15, 0, 0, 0)

K_SQL = "regexp_extract(props, '\"k\": (\\d+)', 1)"
CLASS_SQL = "case event_id % 3 " + " ".join(f"when {i} then '{c}'" for i, c in enumerate(ERROR_CLASSES)) + " end"


def _k(col="props"):
    return F.regexp_extract(col, r'"k": (\d+)', 1)


def _error_class():
    idx = F.pmod(F.col("event_id"), F.lit(3))
    return F.when(idx == 0, ERROR_CLASSES[0]).when(idx == 1, ERROR_CLASSES[1]).otherwise(ERROR_CLASSES[2])


# ------------------------------------------------------------------ delays
@register("delay_fixed", "select event_id, ts + interval 9 second as release_ts from events")
def q_delay_fixed(spark, d):
    return D.delay_fixed(events(spark, d), "ts", 3000, 6000).select("event_id", "release_ts")


PAYLOAD_SQL = f"case when event_type = 'error' then props else {K_SQL} end"


@register("delay_from_payload", f"""
with p as (select event_id, ts, coalesce(try_cast(trim({PAYLOAD_SQL}) as bigint), 8000) as delay_ms from events)
select event_id, delay_ms, ts + to_milliseconds(delay_ms) as release_ts from p
""")
def q_delay_from_payload(spark, d):
    ev = events(spark, d).withColumn("payload", F.when(F.col("event_type") == "error", F.col("props")).otherwise(_k()))
    return D.delay_from_payload(ev, "ts", "payload", 8000).select("event_id", "delay_ms", "release_ts")


@register("delay_from_header", f"""
with p as (select event_id, ts,
                  coalesce(case when event_type in ('view', 'click') then try_cast(cast(cast({K_SQL} as bigint) * 100 as varchar) as bigint) end, 2000) as delay_ms
           from events)
select event_id, delay_ms, ts + to_milliseconds(delay_ms) as release_ts from p
""")
def q_delay_from_header(spark, d):
    ev = events(spark, d)
    hdr = F.when(F.col("event_type").isin("view", "click"),
                 F.create_map(F.lit("delay"), (_k().cast("long") * 100).cast("string"))).otherwise(
        F.create_map().cast("map<string,string>"))
    ev = ev.withColumn("headers", hdr)
    return D.delay_from_payload(ev, "ts", F.col("headers").getItem("delay"), 2000).select("event_id", "delay_ms", "release_ts")


@register("delay_loop", """
select event_id, c as loop_count, 3000 + c * 1000 as wait_ms,
       (c + 1) * 3000 + 1000 * c * (c + 1) // 2 as elapsed_ms,
       ts + to_milliseconds((c + 1) * 3000 + 1000 * c * (c + 1) // 2) as release_ts
from events cross join range(0, 3) t(c)
""")
def q_delay_loop(spark, d):
    out = D.delay_loop(events(spark, d), "ts", 3000, 1000, 3)
    return out.select("event_id", "loop_count", "wait_ms", "elapsed_ms", "release_ts")


@register("tick_drain", """
select time_bucket(interval 1 hour, ts) + interval 1 hour as drained_at, count(*) as n_messages,
       min(event_id) as first_id, max(event_id) as last_id
from events group by time_bucket(interval 1 hour, ts)
""")
def q_tick_drain(spark, d):
    # the reference drains every 5 s what a 1 s producer piled up; the event
    # stream here is sparser, so the drain tick is one hour
    return D.tick_drain(events(spark, d), "ts", "1 hour", "event_id")


@register("held_at_tick", """
with m as (select event_id, ts, ts + to_milliseconds(cast(round(value * 1000) as bigint)) as release_ts from events),
f as (select *, case when date_trunc('minute', ts) = ts then ts else date_trunc('minute', ts) + interval 1 minute end as first_tick from m),
t as (select event_id, release_ts, unnest(generate_series(first_tick, release_ts, interval 1 minute)) as tick from f where first_tick < release_ts)
select tick, count(*) as n_held, min(event_id) as first_id from t where tick < release_ts group by tick
""")
def q_held_at_tick(spark, d):
    ev = events(spark, d).select("event_id", "ts", "value").withColumn("release_ts", F.col("ts") + D.ms_interval(F.round(F.col("value") * 1000).cast("long")))
    return D.held_at_tick(ev, "ts", "release_ts", "event_id")


# ------------------------------------------------------------------ windows
@register("priority_order", """
select o_orderstatus, o_orderkey,
       row_number() over (partition by o_orderstatus
                          order by 6 - cast(substr(o_orderpriority, 1, 1) as integer) desc nulls last, o_orderdate, o_orderkey) as dequeue_no
from orders
""")
def q_priority_order(spark, d):
    # only the columns the dequeue order needs cross into the numbering pass
    o = table(spark, d, "orders").select(
        "o_orderstatus", "o_orderkey", "o_orderdate", (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("priority"))
    return priority_order(o, ["o_orderstatus"], "priority", "o_orderdate", "o_orderkey").select("o_orderstatus", "o_orderkey", "dequeue_no")


@register("queue_depth", """
select event_id, user_id,
       sum(case when event_type in ('signup', 'view', 'click') then 1 else -1 end)
         over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as depth
from events
""")
def q_queue_depth(spark, d):
    delta = F.when(F.col("event_type").isin("signup", "view", "click"), 1).otherwise(-1)
    return queue_depth(events(spark, d).select("event_id", "user_id", "event_type", "ts"), ["user_id"], EVENT_ORDER, delta).select("event_id", "user_id", "depth")


# The capacity of the queue and the messages its producer takes up at once.
QUEUE_CAPACITY, POLLED = 3, 5


@register("bounded_queue_wait", f"""
with recursive r as (
  select user_id % 8 as queue, event_id, ts, case when event_type in ('signup', 'view', 'click') then 1 else -1 end as delta,
         row_number() over (partition by user_id % 8 order by ts, event_id) as rn from events),
g as (
  select queue, event_id, rn, ts, greatest(delta, 0) as held, false as refused, 0::bigint as blocked_us from r where rn = 1
  union all
  select r.queue, r.event_id, r.rn, r.ts, least(greatest(g.held + r.delta, 0), {QUEUE_CAPACITY + POLLED}),
         r.delta = 1 and g.held = {QUEUE_CAPACITY + POLLED},
         greatest(g.held - {QUEUE_CAPACITY}, 0) * (epoch_us(r.ts) - epoch_us(g.ts))
  from g join r on r.queue = g.queue and r.rn = g.rn + 1)
select queue, event_id, least(held, {QUEUE_CAPACITY})::bigint as depth, greatest(held - {QUEUE_CAPACITY}, 0)::bigint as blocked, refused, blocked_us
from g
""")
def q_bounded_queue_wait(spark, d):
    ev = events(spark, d).select((F.col("user_id") % 8).alias("queue"), "event_id", "event_type", "ts")
    out = bounded_queue(ev, ["queue"], EVENT_ORDER, F.col("event_type").isin("signup", "view", "click"), ntz_micros("ts"),
                        QUEUE_CAPACITY, POLLED)
    return out.select("queue", "event_id", "depth", "blocked", "refused", "blocked_us")


@register("attempt_number", """
select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) - 1 as retry_count
from events where event_type = 'error'
""")
def q_attempt_number(spark, d):
    err = events(spark, d).filter(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    return R.attempt_number(err, ["user_id"], EVENT_ORDER).select("event_id", "user_id", "retry_count")


@register("asof_gate", """
with c as (select user_id, ts, event_type = 'signup' as on_flag from events where event_type in ('signup', 'error')),
e as (select * from events where event_type in ('view', 'click', 'purchase'))
select e.event_id, e.user_id, e.event_type, e.ts
from e asof left join c on e.user_id = c.user_id and e.ts >= c.ts
where coalesce(c.on_flag, true)
""")
def q_asof_gate(spark, d):
    ev = events(spark, d)
    ctl = ev.filter(F.col("event_type").isin("signup", "error")).select("user_id", "ts", (F.col("event_type") == "signup").alias("on_flag"))
    msgs = ev.filter(F.col("event_type").isin("view", "click", "purchase")).select("event_id", "user_id", "event_type", "ts")
    return asof_gate(msgs, ctl, ["user_id"], "ts", "on_flag", on_value=True, initial_on=True, id_col="event_id")


# ------------------------------------------------------------------ retry schedules
def _schedule_sql(policy: R.RetryPolicy, tag: bool = False) -> str:
    n = policy.attempt_bound()
    if policy.backoff == "fixed":
        w = f"{policy.period_ms}"
    else:
        w = f"least({policy.initial_ms} * pow({policy.multiplier}, k - 2), {policy.max_interval_ms})"
    conds = []
    if policy.max_attempts is not None:
        conds.append(f"k <= {policy.max_attempts}")
    if policy.timeout_ms is not None:
        conds.append(f"offset_ms < {policy.timeout_ms}")
    where = " and ".join(conds) or "true"
    name = f"'{policy.name}' as policy, " if tag else ""
    return f"""
select e.event_id, {name}s.k as attempt_no, s.offset_ms, s.wait_before_ms, e.ts + to_milliseconds(s.offset_ms) as attempt_at
from (select * from events where event_type = 'error') e
cross join (
  select k, cast(w as bigint) as wait_before_ms, cast(sum(w) over (order by k) as bigint) as offset_ms
  from (select k, case when k = 1 then 0 else {w} end as w from range(1, {n + 1}) t(k))
) s
where {where}
"""


def _schedule(spark, d, policy, tag=False):
    err = events(spark, d).filter(F.col("event_type") == "error").select("event_id", "ts")
    s = R.retry_schedule(err, policy, start="ts")
    cols = ["event_id"] + ([F.lit(policy.name).alias("policy")] if tag else []) + ["attempt_no", "offset_ms", "wait_before_ms", "attempt_at"]
    return s.select(*cols)


@register("retry_schedule_fixed", _schedule_sql(R.FIXED_5X2S))
def q_retry_schedule_fixed(spark, d):
    return _schedule(spark, d, R.FIXED_5X2S)


@register("retry_schedule_exp", _schedule_sql(R.EXP_5))
def q_retry_schedule_exp(spark, d):
    return _schedule(spark, d, R.EXP_5)


@register("retry_timeout", _schedule_sql(R.TIMEOUT_45S_EXP))
def q_retry_timeout(spark, d):
    return _schedule(spark, d, R.TIMEOUT_45S_EXP)


@register("retry_composite", _schedule_sql(R.COMPOSITE_3_10S_FIXED1S, True) + " union all " + _schedule_sql(R.COMPOSITE_3_10S_FIXED5S, True))
def q_retry_composite(spark, d):
    return _schedule(spark, d, R.COMPOSITE_3_10S_FIXED1S, True).unionByName(_schedule(spark, d, R.COMPOSITE_3_10S_FIXED5S, True))


# The oracle says the policies in its own numbers: back-offs of 2, 4, 8, 10, 10 ... s start attempts at 0, 2, 6, 14,
# 24, 34, 44 and 54 s, eight of them within 60 s; the other class may try five times, any other class once.
BY_CLASS_SQL = f"""
with a as (select event_id, {CLASS_SQL} as error_class from events where event_type = 'error')
select event_id, error_class,
       case error_class when 'java.nio.file.FileSystemAlreadyExistsException' then 'timeout60s_exp'
                        when 'java.nio.file.FileSystemNotFoundException' then 'simple5_exp' else 'never' end as policy,
       case error_class when 'java.nio.file.FileSystemAlreadyExistsException' then 8
                        when 'java.nio.file.FileSystemNotFoundException' then 5 else 1 end as allowed_attempts
from a
"""


@register("retry_by_class", BY_CLASS_SQL)
def q_retry_by_class(spark, d):
    err = events(spark, d).filter(F.col("event_type") == "error").select("event_id", _error_class().alias("error_class"))
    return R.retry_by_class(err, "error_class", R.BY_CLASS).select("event_id", "error_class", "policy", "allowed_attempts")


# ------------------------------------------------------------------ attempt-log evaluation
def _attempts(spark, d):
    ev = events(spark, d).filter(F.col("event_type").isin("error", "purchase"))
    return ev.select(
        F.concat(F.col("user_id").cast("string"), F.lit("@"), F.date_format("ts", "yyyy-MM-dd")).alias("message_id"),
        "ts", "event_id", (F.col("event_type") == "purchase").alias("ok"),
        _error_class().alias("error_class"), F.col("props").alias("error_message"))


STATUS_POLICY = R.FIXED_5X2S

# at most five attempts, two seconds between them
STATUS_SQL = f"""
with a as (select cast(user_id as varchar) || '@' || strftime(ts, '%Y-%m-%d') as message_id, ts, event_id,
                  event_type = 'purchase' as ok, {CLASS_SQL} as error_class, props as error_message
           from events where event_type in ('error', 'purchase')),
n as (select *, row_number() over (partition by message_id order by ts, event_id) as attempt_no from a),
k as (select *, min(case when ok and attempt_no <= 5 then attempt_no end) over (partition by message_id) as first_ok from n),
c as (select * from k where attempt_no <= 5 and (first_ok is null or attempt_no <= first_ok)),
g as (select message_id, any_value(first_ok) as first_ok, count(*) as attempts, min(ts) as first_at, max(ts) as last_at,
             arg_max(error_class, attempt_no) as lec, arg_max(error_message, attempt_no) as lem
      from c group by message_id)
select message_id, case when first_ok is not null then 'succeeded' when attempts = 5 then 'exhausted' else 'due' end as outcome,
       attempts, first_at, last_at,
       case when first_ok is null and attempts < 5 then last_at + interval 2 second end as next_attempt_at,
       case when first_ok is null then lec end as last_error_class,
       case when first_ok is null then lem end as last_error
from g
"""


def _status(spark, d):
    return R.retry_status(_attempts(spark, d), "message_id", "ts", "ok", STATUS_POLICY, order=["ts", "event_id"])


@register("retry_status", STATUS_SQL)
def q_retry_status(spark, d):
    return _status(spark, d)


@register("recover_value", f"""
with s as ({STATUS_SQL})
select message_id, outcome, case when outcome = 'exhausted' then last_error else message_id end as payload,
       outcome = 'exhausted' as recovered
from s
""")
def q_recover_value(spark, d):
    s = _status(spark, d).withColumn("payload", F.col("message_id"))
    return R.recover_value(s, "payload").select("message_id", "outcome", "payload", "recovered")


@register("outcome_messages", f"""
select event_id, case when event_type <> 'error' then 'success' else 'failure' end as channel,
       case when event_type <> 'error' then event_type || '#' || cast(event_id as varchar) || '{R.SUCCESS_SUFFIX}'
            else event_type || '#' || cast(event_id as varchar) || '{R.FAILURE_INFIX}' || {CLASS_SQL} || ', ' || props || ' )' end as text
from events
""")
def q_outcome_messages(spark, d):
    ev = events(spark, d).select(
        "event_id", (F.col("event_type") != "error").alias("ok"),
        F.concat(F.col("event_type"), F.lit("#"), F.col("event_id").cast("string")).alias("payload"),
        _error_class().alias("error_class"), F.col("props").alias("error_message"))
    return R.outcome_messages(ev, "ok", "payload", "error_class", "error_message").select("event_id", "channel", "text")


@register("retry_then_route", f"""
with s as ({STATUS_SQL})
select message_id, case when outcome = 'succeeded' then 'success' else 'failure' end as channel,
       case when outcome = 'succeeded' then message_id || '{R.SUCCESS_SUFFIX}'
            else message_id || '{R.FAILURE_INFIX}' || coalesce(last_error_class, 'null') || ', ' || coalesce(last_error, 'null') || ' )' end as text
from s where outcome in ('succeeded', 'exhausted')
""")
def q_retry_then_route(spark, d):
    s = _status(spark, d).filter(F.col("outcome").isin("succeeded", "exhausted"))
    s = s.withColumn("ok", F.col("outcome") == "succeeded")
    return R.outcome_messages(s, "ok", "message_id", "last_error_class", "last_error").select("message_id", "channel", "text")


@register("dead_letter", f"""
with s as ({STATUS_SQL})
select message_id, outcome, last_error_class, last_error, next_attempt_at,
       '{ERRORMAIL_TO}' as mail_to, '{ERRORMAIL_SUBJECT}' as subject,
       outcome = 'due' and coalesce(next_attempt_at <= timestamp '{REPLAY_NOW:%Y-%m-%d %H:%M:%S}', false) as replay_due
from s where outcome <> 'succeeded'
""")
def q_dead_letter(spark, d):
    now = ntz_literal(REPLAY_NOW)
    return R.dead_letter(_status(spark, d), "message_id", now, ERRORMAIL_TO, ERRORMAIL_SUBJECT)

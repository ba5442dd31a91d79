"""Splitter and message-group queries (X1-X3, P7, P11, A1-A9) on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators import grouping as G
from flowframe.operators import split as X
from flowframe.operators.scan import release_sequence
from flowframe.operators.transform import route_tag, status_attach
from flowframe.plans.bindings import (
    EVENT_ORDER,
    LINEITEM_ARRIVAL,
    LINEITEM_ARRIVAL_SQL,
    URL_STATUS_SQL,
    events,
    grouped_messages,
    url_lines,
    url_status,
)
from flowframe.plans.registry import register, table
from flowframe.streaming.group_release import group_outcomes

# ----------------------------------------------------------------- splitters
LINES_SQL = r"""
with a as (
  select doc_id,
         case when text is null or text = '' then []::varchar[]
              else regexp_split_to_array(regexp_replace(text, '\r?\n\z', ''), '\r?\n') end as arr
  from documents),
b as (select doc_id, arr, len(arr) as seq_size, unnest(generate_series(1, len(arr))) as seq_no from a)
select doc_id as corr_id, seq_no, seq_size, arr[seq_no] as line from b
"""


def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    return X.split_lines(table(spark, d, "documents"), "text", "doc_id")


@register("split_lines", LINES_SQL)
def q_split_lines(spark, d):
    return doc_lines(spark, d).select("corr_id", "seq_no", "seq_size", "line")


@register("split_sequence", """
with a as (select conv_id * 1000 + turn as parent_id, string_split(text, ' ') as arr from conversations),
b as (select parent_id, arr, len(arr) as seq_size, unnest(generate_series(1, len(arr))) as seq_no from a)
select parent_id as corr_id, seq_no, seq_size, arr[seq_no] as payload from b
""")
def q_split_sequence(spark, d):
    c = table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("parent_id"), F.split("text", " ").alias("words"))
    return X.split_sequence(c, "words", "parent_id")


@register("split_roles", r"""
with a as (
  select conv_id, turn,
         case when text is null or not regexp_matches(text, '\S') then []::varchar[]
              when regexp_replace(text, ',+$', '') = '' then []::varchar[]
              else string_split(regexp_replace(text, ',+$', ''), ',') end as arr
  from conversations),
b as (select conv_id, turn, arr, unnest(generate_series(1, len(arr))) as role_no from a)
select conv_id, turn, role_no, arr[role_no] as role from b
""")
def q_split_roles(spark, d):
    return X.split_roles(table(spark, d, "conversations"), "text", keep=["conv_id", "turn"])


@register("line_count", f"""
with l as ({LINES_SQL}) select corr_id as doc_id, count(*) as n_lines from l group by corr_id
""")
def q_line_count(spark, d):
    return G.line_count(doc_lines(spark, d).withColumnRenamed("corr_id", "doc_id"), "doc_id")


# ----------------------------------------------------------------- routing
@register("two_way_route", """
select page_id, url, case when url like 'http://%' then 'check' else 'write' end as route from pages
""")
def q_two_way_route(spark, d):
    return route_tag(table(spark, d, "pages").select("page_id", "url"), F.col("url").startswith("http://"), "check", "write")


@register("status_attach", f"""
with st as (select url, max(status) as status from ({URL_STATUS_SQL}) group by url)
select p.page_id, p.url || ',' || coalesce(case when p.url like 'http://%' then st.status end, 'null') as line
from pages p left join st on p.url = st.url
""")
def q_status_attach(spark, d):
    lines = url_lines(spark, d)
    return status_attach(lines, url_status(spark, d), check=F.col("url").startswith("http://")).select("page_id", "line")


# ----------------------------------------------------------------- sequence-size groups (lineitem)
RANKED_SQL = f"""
select l_orderkey as corr_id, cast(l_partkey as varchar) as payload, l_linestatus,
       row_number() over (partition by l_orderkey order by {LINEITEM_ARRIVAL_SQL}) as rn,
       first_value(l_linenumber) over (partition by l_orderkey order by {LINEITEM_ARRIVAL_SQL}) as group_size
from lineitem
"""

SEQ_AGG_SQL = f"""
with r as ({RANKED_SQL}),
c as (select corr_id from r where rn = group_size)
select corr_id, max(group_size) as group_size, string_agg(payload, ' ' order by rn) as payloads
from r where rn <= group_size and corr_id in (select corr_id from c)
group by corr_id
"""


def _seq_agg(df: DataFrame) -> DataFrame:
    out = G.seq_size_aggregate(df, "corr_id", LINEITEM_ARRIVAL, "seq_size", "payload", sep=" ")
    return out.select("corr_id", "group_size", "payloads")


@register("seq_size_aggregate", SEQ_AGG_SQL)
def q_seq_size_aggregate(spark, d):
    return _seq_agg(grouped_messages(spark, d))


@register("multi_input_aggregate", SEQ_AGG_SQL)
def q_multi_input_aggregate(spark, d):
    m = grouped_messages(spark, d)
    # two flows feed one group store: open lines by one input, finished lines by the other
    a = m.filter(F.col("l_linestatus") == "O")
    b = m.filter(~F.col("l_linestatus").eqNullSafe("O"))
    out = G.multi_input_aggregate([a, b], "corr_id", LINEITEM_ARRIVAL, "seq_size", "payload", sep=" ")
    return out.select("corr_id", "group_size", "payloads")


@register("late_discard", f"""
with r as ({RANKED_SQL}) select corr_id, rn, group_size, payload from r where rn > group_size
""")
def q_late_discard(spark, d):
    return G.late_discard(grouped_messages(spark, d).select("corr_id", "seq_size", "payload", *LINEITEM_ARRIVAL), "corr_id", LINEITEM_ARRIVAL, "seq_size").select(
        "corr_id", "rn", "group_size", "payload")


@register("resequence", f"""
with l as ({LINES_SQL}),
c as (select corr_id from l group by corr_id having count(*) = min(seq_size))
select corr_id, seq_no, seq_size, line from l where corr_id in (select corr_id from c)
""")
def q_resequence(spark, d):
    # lines arrive shuffled (hash order); resequence restores file order
    lines = doc_lines(spark, d).repartition(F.xxhash64("line", "seq_no"))
    return G.resequence(lines, "corr_id", "seq_no", "seq_size").select("corr_id", "seq_no", "seq_size", "line")


# ----------------------------------------------------------------- count groups (events by user)
COUNT_GROUPS_SQL = """
with r as (select user_id, event_type,
                  row_number() over (partition by user_id order by ts, event_id) as rn from events),
g as (select user_id, (rn - 1) // {n} as group_no, rn, event_type from r)
select user_id, group_no, string_agg(event_type, ' ' order by rn) as payloads
from g group by user_id, group_no having count(*) = {n}
"""


@register("count_aggregate", COUNT_GROUPS_SQL.format(n=5))
def q_count_aggregate(spark, d):
    return G.count_aggregate(events(spark, d), ["user_id"], EVENT_ORDER, 5, "event_type", sep=" ").select(
        "user_id", "group_no", "payloads")


@register("release_predicate", COUNT_GROUPS_SQL.format(n=1))
def q_release_predicate(spark, d):
    # the reference's fixed strategy: release is always allowed, so each message leaves alone
    return G.release_predicate(events(spark, d), ["user_id"], EVENT_ORDER, "n >= 1", "event_type", sep=" ").select(
        "user_id", "group_no", "payloads")


@register("release_predicate_period", COUNT_GROUPS_SQL.format(n=3))
def q_release_predicate_period(spark, d):
    # first holds at three messages, then not for a while: only the first time counts, as the group starts again
    return G.release_predicate(events(spark, d), ["user_id"], EVENT_ORDER, "n = 3 or n > 40", "event_type", sep=" ").select(
        "user_id", "group_no", "payloads")


@register("release_declared", f"""
with recursive r as (
  select l_orderkey as corr_id, cast(l_partkey as varchar) as payload, l_linenumber as size,
         row_number() over (partition by l_orderkey order by {LINEITEM_ARRIVAL_SQL}) as rn from lineitem),
g as (
  select corr_id, 0 as group_no, rn, size from r where rn = 1
  union all
  select r.corr_id, g.group_no + 1, r.rn, r.size from g join r on r.corr_id = g.corr_id and r.rn = g.rn + g.size)
select g.corr_id, g.group_no, g.size as group_size, string_agg(r.payload, ' ' order by r.rn) as payloads
from g join r on r.corr_id = g.corr_id and r.rn between g.rn and g.rn + g.size - 1
group by g.corr_id, g.group_no, g.size having count(*) = g.size
""")
def q_release_declared(spark, d):
    # released when as many came as the group's first message declares; then the group starts again
    return G.release_declared(grouped_messages(spark, d), "corr_id", LINEITEM_ARRIVAL, "seq_size", "payload", sep=" ")


@register("release_sum", """
with recursive r as (
  select user_id, event_type, cast(floor(value) as bigint) as v, row_number() over (partition by user_id order by ts, event_id) as rn from events),
g as (
  select user_id, rn, event_type, v, 0 as group_no, v as total from r where rn = 1
  union all
  select r.user_id, r.rn, r.event_type, r.v, case when g.total >= 100 then g.group_no + 1 else g.group_no end,
         case when g.total >= 100 then r.v else g.total + r.v end
  from g join r on r.user_id = g.user_id and r.rn = g.rn + 1)
select user_id, group_no, count(*) as group_size, string_agg(event_type, ' ' order by rn) as payloads
from g group by user_id, group_no having max(total) >= 100
""")
def q_release_sum(spark, d):
    # released by the message with which the group's values reach 100
    ev = events(spark, d).select("user_id", "ts", "event_id", "event_type", F.floor("value").alias("v"))
    return G.release_sum(ev, "user_id", EVENT_ORDER, "v", 100, "event_type", sep=" ")


# The sequence the released five-message list is compared with.
MATCH_PATTERN = ["view", "view", "view", "view", "click"]


@register("sequence_match", f"""
with c as ({COUNT_GROUPS_SQL.format(n=5)})
select user_id, group_no, payloads, payloads = '{' '.join(MATCH_PATTERN)}' as matched from c
""")
def q_sequence_match(spark, d):
    lists = G.count_aggregate(events(spark, d), ["user_id"], EVENT_ORDER, 5, "event_type")
    m = G.sequence_match(lists, "payloads", MATCH_PATTERN)
    return m.select("user_id", "group_no", F.concat_ws(" ", "payloads").alias("payloads"), "matched")


@register("release_sequence", f"""
with recursive r as (
  select user_id % 8 as shard, event_id, event_type,
         row_number() over (partition by user_id % 8 order by ts, event_id) as rn from events),
g as (
  select shard, event_id, rn, 0::bigint as group_no, event_type as tail from r where rn = 1
  union all
  select r.shard, r.event_id, r.rn, case when g.tail = '{' '.join(MATCH_PATTERN)}' then g.group_no + 1 else g.group_no end,
         case when g.tail = '{' '.join(MATCH_PATTERN)}' then r.event_type
              when len(string_split(g.tail, ' ')) < {len(MATCH_PATTERN)} then g.tail || ' ' || r.event_type
              else array_to_string(string_split(g.tail, ' ')[2:], ' ') || ' ' || r.event_type end
  from g join r on r.shard = g.shard and r.rn = g.rn + 1),
e as (select shard, max(case when tail = '{' '.join(MATCH_PATTERN)}' then group_no + 1 else group_no end) as ends from g group by shard)
select g.shard, g.event_id, g.group_no, g.group_no < e.ends as released from g join e on g.shard = e.shard
""")
def q_release_sequence(spark, d):
    # a group waits until the sequence has come in its last messages; then the next one begins
    ev = events(spark, d).select((F.col("user_id") % 8).alias("shard"), "ts", "event_id", "event_type")
    return release_sequence(ev, ["shard"], EVENT_ORDER, "event_type", MATCH_PATTERN).select("shard", "event_id", "group_no", "released")


# ----------------------------------------------------------------- declared size and timeout together
RELEASE_TIMEOUT_SQL = f"""
with l as (select l_orderkey as corr_id, cast(l_partkey as varchar) as payload, l_linenumber as size, l_shipdate as arrived,
                  row_number() over (partition by l_orderkey order by {LINEITEM_ARRIVAL_SQL}) as rn from lineitem),
f as (select *, lag(arrived) over (partition by corr_id order by rn) as prev from l),
s as (select *, sum(case when prev is null or arrived > prev + interval 30 day then 1 else 0 end)
                over (partition by corr_id order by rn rows between unbounded preceding and current row) as session from f),
r as (select *, row_number() over (partition by corr_id, session order by rn) as pos,
             count(*) over (partition by corr_id, session) as n,
             first_value(size) over (partition by corr_id, session order by rn) as wanted from s),
d as (select *, min(case when n >= wanted then session end) over (partition by corr_id) as done,
             max(session) over (partition by corr_id) as newest from r),
o as (select *, case when session = done and pos <= wanted then 'released' when session < done then 'discarded'
                     when done is not null then 'late' when session < newest then 'discarded' else 'pending' end as outcome from d)
select cast(corr_id as varchar) as corr_id, outcome, max(wanted)::bigint as seq, string_agg(payload, ' ' order by pos) as payloads
from o where outcome = 'released' group by corr_id, outcome
union all select cast(corr_id as varchar), outcome, null, payload from o where outcome <> 'released'
"""


@register("group_release_timeout", RELEASE_TIMEOUT_SQL)
def q_group_release_timeout(spark, d):
    # 30 days of silence give a waiting group up; released at the size its first message declares
    return group_outcomes(grouped_messages(spark, d), "corr_id", LINEITEM_ARRIVAL, "seq_size", "payload", "l_shipdate",
                          timeout_seconds=30 * 86400)


# ----------------------------------------------------------------- timeout (gap sessions)
@register("group_timeout", """
with l as (select *, lag(ts) over (partition by user_id order by ts, event_id) as prev_ts from events),
f as (select *, case when prev_ts is null or ts > prev_ts + interval 6 hour then 1 else 0 end as new_s from l),
s as (select *, sum(new_s) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as session_no from f),
r as (select *, row_number() over (partition by user_id, session_no order by ts, event_id) as session_rn,
             count(*) over (partition by user_id, session_no) as slen from s)
select event_id, user_id, session_no, (session_rn - 1) // 2 as group_no,
       case when (session_rn - 1) // 2 < slen // 2 then 'released' else 'discarded' end as outcome
from r
""")
def q_group_timeout(spark, d):
    out = G.timeout_groups(events(spark, d).select("event_id", "user_id", "ts"), ["user_id"], "ts", EVENT_ORDER, 6 * 3600, 2)
    return out.select("event_id", "user_id", "session_no", "group_no", "outcome")

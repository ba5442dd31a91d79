"""Metric-series queries (A10-A14, T1, J1, F5, F6) on ``events``.

Series: metric = event_type, label ``user_id``, sample time ``ts``, value ``value``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flowframe.operators import metrics as M
from flowframe.plans.registry import register, table


def samples(spark: SparkSession, d: str):
    return table(spark, d, "events").select(F.col("event_type").alias("metric"), "user_id", "ts", "value", "event_id", "props")


@register("metric_sum", "select event_type as metric, round(sum(value), 4) as value from events group by event_type")
def q_metric_sum(spark, d):
    return M.metric_sum(samples(spark, d), ["metric"]).withColumn("value", F.round("value", 4))


@register("metric_max_by", "select event_type as metric, user_id, max(value) as value from events group by event_type, user_id")
def q_metric_max_by(spark, d):
    return M.metric_max_by(samples(spark, d), ["metric", "user_id"])


INSTANT_ALL_SQL = "select event_type as metric, user_id, max(ts) as ts, arg_max(value, ts) as value from events group by event_type, user_id"


@register("metric_instant", """
select event_type as metric, user_id, max(ts) as ts, arg_max(value, ts) as value from events
where event_type = 'purchase' and regexp_full_match(cast(user_id as varchar), '1.*')
group by event_type, user_id
""")
def q_metric_instant(spark, d):
    return M.metric_instant(samples(spark, d), ["metric", "user_id"], equals={"metric": "purchase"}, matches={"user_id": "1.*"})


@register("metric_topk", f"""
select * from ({INSTANT_ALL_SQL}) order by value desc, metric, user_id limit 50
""")
def q_metric_topk(spark, d):
    inst = M.metric_instant(samples(spark, d), ["metric", "user_id"])
    return M.metric_topk(inst, 50, tie=["metric", "user_id"])


@register("metric_delta", """
select event_type as metric, user_id, date_trunc('day', ts) as bucket_start,
       round(arg_max(value, ts) - arg_min(value, ts), 4) as delta, count(*) as samples
from events group by event_type, user_id, date_trunc('day', ts)
""")
def q_metric_delta(spark, d):
    out = M.metric_delta(samples(spark, d), ["metric", "user_id"], "1 day")
    return out.withColumn("delta", F.round("delta", 4))


@register("metric_rate", """
with b as (select event_type, user_id, time_bucket(interval 6 hour, ts) as bucket_start, ts, value from events),
l as (select *, lag(value) over (partition by event_type, user_id, bucket_start order by ts) as prev from b),
s as (select event_type, user_id, bucket_start,
             sum(case when prev is null then 0 when value < prev then value else value - prev end) / 21600.0 as rate
      from l group by event_type, user_id, bucket_start)
select event_type as metric, bucket_start, round(sum(rate), 9) as rate from s group by event_type, bucket_start
""")
def q_metric_rate(spark, d):
    out = M.metric_rate(samples(spark, d), ["metric", "user_id"], 6 * 3600, sum_by=["metric"])
    return out.withColumn("rate", F.round("rate", 9))


# Five-minute ranges at steps of fifteen seconds.
RANGE, STEP = 300, 15

RANGE_SQL = """
with s as (select event_type as metric, epoch_us(ts) as tm, value as v, row_number() over w as n,
                  lag(value) over w as pv from events window w as (partition by event_type order by ts)),
c as (select *, sum(case when pv is null then 0 when {reset} then v else v - pv end)
                over (partition by metric order by tm rows unbounded preceding) as grown from s),
e as (select min(tm) as lo, max(tm) as hi from s),
t as (select unnest(generate_series((ceil(lo / {step}e6) * {step}e6)::bigint, hi, {step}000000)) as step from e),
g as (select metric, step from t cross join (select distinct metric from s)),
l as (select g.metric, g.step, c.n, c.tm, c.v, c.grown from g asof join c on g.metric = c.metric and g.step >= c.tm),
f as (select l.*, c.n as fn, c.tm as fat, c.v as fv, c.grown as fgrown from l asof join c on l.metric = c.metric and l.step - {range}000000 < c.tm),
d as (select *, (tm - fat)::double as inside, (tm - fat)::double / (n - fn) as mean, (fat - (step - {range}000000))::double as b0,
             (step - tm)::double as a0, {grown} as x from f where n > fn),
h as (select *, case when b0 >= mean * 1.1 then mean / 2 else b0 end as b1, case when a0 >= mean * 1.1 then mean / 2 else a0 end as a1 from d),
z as (select *, case when {counter} and x > 0 and fv >= 0 and inside * (fv / x) < b1 then inside * (fv / x) else b1 end as b2 from h)
select metric, make_timestamp(step) as step_ts, round(x * ((inside + b2 + a1) / inside) / {per}, 6) as value, (n - fn + 1)::bigint as samples from z
"""


@register("metric_rate_range", RANGE_SQL.format(reset="v < pv", step=STEP, range=RANGE, grown="grown - fgrown", counter="true", per=float(RANGE)))
def q_metric_rate_range(spark, d):
    out = M.metric_range(samples(spark, d), ["metric"], RANGE, STEP)
    return out.withColumn("value", F.round("value", 6))


@register("metric_delta_range", RANGE_SQL.format(reset="false", step=60, range=3600, grown="v - fv", counter="false", per=1.0))
def q_metric_delta_range(spark, d):
    out = M.metric_range(samples(spark, d), ["metric"], 3600, 60, kind="delta")
    return out.withColumn("value", F.round("value", 6))


@register("group_left_join", f"""
with l as ({INSTANT_ALL_SQL})
select l.metric, round(sum(l.value * 0 + c.c_acctbal), 4) as value
from l join customer c on l.user_id = c.c_custkey group by l.metric
""")
def q_group_left_join(spark, d):
    left = M.metric_instant(samples(spark, d), ["metric", "user_id"])
    right = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    return M.group_left_join(left, right, ["user_id"], "value", "c_acctbal", sum_by=["metric"]).withColumn("value", F.round("value", 4))


@register("label_capture", """
select event_id, regexp_extract(props, '"k": (\\d+)', 1) as k from events
""")
def q_label_capture(spark, d):
    return table(spark, d, "events").select("event_id", M.label_capture("props", r'"k": (\d+)').alias("k"))


# Sample JMX object names, one per relabel rule plus one that
# no rule matches; {t} is filled with the event type and {u} with the user id.
JMX_NAME_TEMPLATES = (
    "kafka.server<type=FetcherLagMetrics, name=ConsumerLag, clientId=client{u}, topic={t}, partition={u}><>Value",
    "kafka.server<type=FetcherMetrics, name=Fetch{t}, clientId=client{u}, brokerHost=host{u}, brokerPort=9092><>Value",
    "kafka.coordinator.group<type=GroupMetadataManager, name=Num{t}><>Value",
    "kafka.network<type=RequestMetrics, name=RequestsPerSec, request={t}, version={u}><>Count",
    "kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec, topic={t}><>Count",
    "kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec><>Count",
    "kafka.log<type=Log, name=Size, topic={t}, partition={u}><>Value",
    "kafka.controller<type=KafkaController, name={t}Count, broker={u}><>Value",
    "kafka.server<type=ReplicaManager, name={t}Count><>Value",
    "kafka.network<type=RequestMetrics, name=TotalTimeMs, request={t}, error=E{u}><>Count",
    "kafka.network<type=RequestMetrics, name=TotalTimeMs, request={t}, error=E{u}><>99thPercentile",
    "kafka.server<type=DelayedOperationPurgatory, name=Size, delayedOperation={t}><>Count",
    "kafka.server<type=Request, name=QueueTimeMs, request={t}><>50thPercentile",
    "kafka.server<type=SessionExpire, name={t}><>Count",
    "kafka.server<type=Produce, name={t}><>75thPercentile",
    "java.lang<type=Memory, name={t}><>HeapMemoryUsage",
)


# What the rules make of these names, read off the rule texts by hand: rule number, name, type, labels.
EXPECTED_RELABELS = (
    (1, "kafka_server_fetcherlagmetrics_consumerlag", "GAUGE", "clientId=client{u};partition={u};topic={t}"),
    (2, "kafka_server_fetchermetrics_fetch{t}", "GAUGE", "broker=host{u}:9092;clientId=client{u}"),
    (3, "kafka_coordinator_group_groupmetadatamanager_num{t}", "GAUGE", ""),
    (4, "kafka_network_requestmetrics_requests_total", "COUNTER", "request={t};version={u}"),
    (5, "kafka_server_brokertopicmetrics_messagesin_total", "COUNTER", "topic={t}"),
    (6, "kafka_server_brokertopicmetrics_bytesin_total", "COUNTER", ""),
    (7, "kafka_log_log_size", "GAUGE", "partition={u};topic={t}"),
    (8, "kafka_controller_kafkacontroller_{t}count", "GAUGE", "broker={u}"),
    (9, "kafka_server_replicamanager_{t}count", "GAUGE", ""),
    (10, "kafka_network_requestmetrics_totaltimems_count", "COUNTER", "error=E{u};request={t}"),
    (11, "kafka_network_requestmetrics_totaltimems", "GAUGE", "error=E{u};quantile=0.99;request={t}"),
    (12, "kafka_server_delayedoperationpurgatory_size_count", "COUNTER", "delayedOperation={t}"),
    (13, "kafka_server_request_queuetimems", "GAUGE", "quantile=0.50;request={t}"),
    (14, "kafka_server_sessionexpire_{t}_count", "COUNTER", ""),
    (15, "kafka_server_produce_{t}", "GAUGE", "quantile=0.75"),
)


def _relabel_sql() -> str:
    fill = "replace(replace({}, '{{t}}', event_type), '{{u}}', cast(user_id as varchar))".format
    rows = ", ".join(f"({i}, '{raw}', " + (", ".join([str(e[0]), *(f"'{x}'" for x in e[1:])]) if e else "null, null, null, null") + ")"
                     for i, (raw, e) in enumerate(zip(JMX_NAME_TEMPLATES, [*EXPECTED_RELABELS, None])))
    return f"""
select e.event_id, {fill('r.raw')} as raw, r.rule_no, {fill('r.name')} as name, r.type, {fill('r.labels')} as labels
from events e join (values {rows}) r(k, raw, rule_no, name, type, labels) on e.event_id % {len(JMX_NAME_TEMPLATES)} = r.k
"""


@register("metric_relabel", _relabel_sql())
def q_metric_relabel(spark, d):
    ev = table(spark, d, "events")
    n = len(JMX_NAME_TEMPLATES)
    idx = F.pmod(F.col("event_id"), F.lit(n))
    raw = F.lit(None).cast("string")
    for i in range(n - 1, -1, -1):
        t = F.lit(JMX_NAME_TEMPLATES[i])
        filled = F.replace(F.replace(t, F.lit("{t}"), F.col("event_type")), F.lit("{u}"), F.col("user_id").cast("string"))
        raw = F.when(idx == i, filled).otherwise(raw)
    # the sample names here embed the user id, so nearly every sample has its
    # own name and relabelling distinct names first would not save work
    out = M.metric_relabel(ev.select("event_id", raw.alias("raw")), "raw", distinct_first=False)
    lab = F.array_join(F.array_sort(F.transform(F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return out.select("event_id", "raw", "rule_no", "name", "type", lab.alias("labels"))

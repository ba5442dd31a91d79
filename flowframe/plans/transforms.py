"""Row-local transforms and scalar functions (P1-P6, P8-P10, U1, F1-F14) on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowframe.functions import scalar as S
from flowframe.operators import transform as T
from flowframe.plans.bindings import URL_STATUS_SQL, events, url_lines, url_status
from flowframe.plans.registry import register, table

# The three names the counter records are given.
FULL_NAMES = ("田中　太郎", "鈴木　花子", "木村　さくら")
LCG_SQL = "((({c}) * 1103515245 + 12345) % 2147483648) % {n}"
ROUND_MS_SQL = "cast(round(value * 1000) as bigint)"


@register("header_enrich", f"""
select event_id, 'events' as h_source, cast({ROUND_MS_SQL} as varchar) as h_delay,
       cast(user_id as varchar) as h_user, 3 as n_headers
from events
""")
def q_header_enrich(spark, d):
    ev = events(spark, d).withColumn("headers", F.create_map(F.lit("user"), F.col("user_id").cast("string")))
    ev = T.header_enrich(ev, "source", F.lit("events"), headers="headers")  # literal, kept if present
    ev = T.header_enrich(ev, "delay", F.round(F.col("value") * 1000).cast("long"), overwrite=True, headers="headers")
    ev = T.header_enrich(ev, "user", F.lit("someone-else"), overwrite=False, headers="headers")  # existing kept
    h = F.col("headers")
    return ev.select("event_id", h.getItem("source").alias("h_source"), h.getItem("delay").alias("h_delay"),
                     h.getItem("user").alias("h_user"), F.size(h).alias("n_headers"))


@register("stash_restore", "select event_id, event_type as payload, length(props) as transformed from events")
def q_stash_restore(spark, d):
    ev = events(spark, d).withColumn("payload", F.col("event_type"))
    ev = T.stash(ev, "payload")
    ev = ev.withColumn("payload", F.length("props"))  # type change: string -> int
    ev = ev.withColumn("transformed", F.col("payload"))
    return T.restore(ev, "payload").select("event_id", "payload", "transformed")


@register("typed_transform", "select event_id, cast(user_id * 2 as varchar) || '...' as payload from events")
def q_typed_transform(spark, d):
    return T.typed_transform(events(spark, d), "user_id").select("event_id", "payload")


@register("record_build", f"""
select event_id as count,
       case {LCG_SQL.format(c='event_id', n=3)} {" ".join(f"when {i} then '{n}'" for i, n in enumerate(FULL_NAMES))} end as fullName
from events
""")
def q_record_build(spark, d):
    out = T.record_build(events(spark, d), "event_id", FULL_NAMES)
    return out.select(F.col("value.count").alias("count"), F.col("value.fullName").alias("fullName"))


@register("header_filter", """
select event_id from events where event_type <> 'view' and value > 10
""")
def q_header_filter(spark, d):
    ev = events(spark, d)
    h = F.map_filter(F.create_map(
        F.lit("from"), F.concat(F.lit("user"), F.col("user_id").cast("string")),
        F.lit("to"), F.when(F.col("event_type") != "view", F.lit("ops")),
        F.lit("subject"), F.when(F.col("value") > 10, F.col("event_type")),
    ), lambda k, v: v.isNotNull())
    return T.header_filter(ev.withColumn("headers", h), ["from", "to", "subject"]).select("event_id")


FILE_NAME_SQL = "'doc_' || cast(doc_id as varchar) || case lang when 'en' then '.xlsx' when 'fr' then '.XLSX' else '.csv' end"


@register("validate_split", f"""
select doc_id, {FILE_NAME_SQL} as file_name, ends_with({FILE_NAME_SQL}, '.xlsx') as valid,
       case when ends_with({FILE_NAME_SQL}, '.xlsx') then null else 'not an .xlsx file: ' || {FILE_NAME_SQL} end as error_message
from documents
""")
def q_validate_split(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.concat(
        F.lit("doc_"), F.col("doc_id").cast("string"),
        F.when(F.col("lang") == "en", ".xlsx").when(F.col("lang") == "fr", ".XLSX").otherwise(".csv")).alias("file_name"))
    ok, bad = T.validate_split(docs, S.ends_with("file_name", ".xlsx"), F.concat(F.lit("not an .xlsx file: "), F.col("file_name")))
    return T.branch_union(ok.withColumn("valid", F.lit(True)), bad.withColumn("valid", F.lit(False))).select(
        "doc_id", "file_name", "valid", "error_message")


@register("recipient_list", """
with r as (
  select event_id, 'small' as recipient from events where value < 10
  union all select event_id, 'errors' from events where event_type = 'error'
  union all select event_id, 'big_click' from events where event_type = 'click' and value > 100)
select * from r
union all
select event_id, 'default' from events where event_id not in (select event_id from r)
""")
def q_recipient_list(spark, d):
    ev = events(spark, d)
    out = T.recipient_list(ev, [
        ("small", F.col("value") < 10),
        ("errors", F.col("event_type") == "error"),
        ("big_click", (F.col("event_type") == "click") & (F.col("value") > 100)),
    ])
    return out.select("event_id", "recipient")


@register("wire_tap", """
select event_id, 'main' as sink from events
union all select event_id, 'audit' from events
union all select event_id, 'errors' from events where event_type = 'error'
""")
def q_wire_tap(spark, d):
    return T.wire_tap(events(spark, d), [("audit", None), ("errors", F.col("event_type") == "error")]).select("event_id", "sink")


@register("unwrap_result", "select event_id, case when event_type = 'error' then props else event_type end as payload from events")
def q_unwrap_result(spark, d):
    ev = events(spark, d).withColumn("is_error", F.col("event_type") == "error")
    return T.unwrap_result(ev, "is_error", "props", "event_type").select("event_id", "payload")


@register("branch_union", f"""
with st as (select url, max(status) as status from ({URL_STATUS_SQL}) group by url)
select p.page_id, p.url, 'check' as route, st.status from pages p left join st on p.url = st.url where p.url like 'http://%'
union all
select page_id, url, 'write' as route, null as status from pages where not (url like 'http://%')
""")
def q_branch_union(spark, d):
    lines = url_lines(spark, d)
    checked, direct = T.two_way_route(lines, F.col("url").startswith("http://"))
    checked = T.status_attach(checked, url_status(spark, d)).withColumn("route", F.lit("check"))
    direct = direct.withColumn("route", F.lit("write"))
    return T.branch_union(checked.select("page_id", "url", "route", "status"), direct.select("page_id", "url", "route"))


# ------------------------------------------------------------------ scalar functions
CHOMP_INPUT_SQL = ("event_type || case event_id % 4 when 0 then chr(13) || chr(10) when 1 then chr(10) "
                   "when 2 then chr(10) || chr(10) else '' end")


@register("scalar_strings", f"""
select event_id,
       event_type || ',' || coalesce(case when event_type = 'error' then null else props end, 'null') as joined,
       starts_with(props, '{{"k": 1') as sw, ends_with(props, '9}}') as ew,
       printf('A%d', event_id) as a_id, printf('%d は %s です', user_id, event_type) as sentence,
       regexp_replace({CHOMP_INPUT_SQL}, '(\\r\\n|\\r|\\n)\\z', '') as chomped
from events
""")
def q_scalar_strings(spark, d):
    ev = events(spark, d)
    idx = F.pmod(F.col("event_id"), F.lit(4))
    raw = F.concat(F.col("event_type"), F.when(idx == 0, "\r\n").when(idx == 1, "\n").when(idx == 2, "\n\n").otherwise(""))
    return ev.select(
        "event_id",
        S.concat_null_as_text("event_type", F.lit(","), F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("props"))).alias("joined"),
        S.starts_with("props", '{"k": 1').alias("sw"),
        S.ends_with("props", "9}").alias("ew"),
        S.fmt("A%d", "event_id").alias("a_id"),
        S.fmt("%d は %s です", "user_id", "event_type").alias("sentence"),
        S.chomp(raw).alias("chomped"),
    )


@register("scalar_dates", """
select event_id, strftime(ts, '%Y/%m/%d %H:%M:%S') as ts_text, ts + interval 3 month as plus_3m,
       ts + interval 1 month as plus_1m, ts + to_milliseconds(1500) as plus_ms
from events
""")
def q_scalar_dates(spark, d):
    ev = events(spark, d)
    return ev.select("event_id", S.date_text("ts").alias("ts_text"), S.plus_months("ts", 3).alias("plus_3m"),
                     S.plus_months("ts", 1).alias("plus_1m"), S.plus_millis("ts", 1500).alias("plus_ms"))


K_TEXT_SQL = "case when event_type = 'error' then 'x' || regexp_extract(props, '\"k\": (\\d+)', 1) else regexp_extract(props, '\"k\": (\\d+)', 1) end"


@register("scalar_math", f"""
with k as (select event_id, value, try_cast(trim({K_TEXT_SQL}) as integer) as k from events)
select event_id, k * 2 as doubled, k + 1 as plus_one, least(greatest(round(value, 2), 10.0), 100.0) as clamped,
       cast(k * 2 as varchar) as as_text
from k
""")
def q_scalar_math(spark, d):
    ev = events(spark, d)
    kt = F.regexp_extract("props", r'"k": (\d+)', 1)
    kt = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), kt)).otherwise(kt)
    k = S.to_int_or_null(kt)
    return ev.select("event_id", (k * 2).alias("doubled"), (k + 1).alias("plus_one"),
                     S.clamp(F.round("value", 2), 10.0, 100.0).alias("clamped"), (k * 2).cast("string").alias("as_text"))


@register("seeded_pick", f"""
select event_id, {LCG_SQL.format(c='event_id', n=5)} as idx,
       case {LCG_SQL.format(c='event_id', n=2)} when 0 then 'zun' else 'doko' end as word
from events
""")
def q_seeded_pick(spark, d):
    ev = events(spark, d)
    return ev.select("event_id", S.seeded_index("event_id", 5).alias("idx"), S.seeded_pick("event_id", ["zun", "doko"]).alias("word"))


@register("scalar_arrays", """
select event_id, 2 as n, [event_type, cast(user_id as varchar)] = ['view', cast(user_id as varchar)] as is_view,
       array_to_string([event_type, cast(user_id as varchar)], '|') as joined
from events
""")
def q_scalar_arrays(spark, d):
    ev = events(spark, d)
    arr = F.array(F.col("event_type"), F.col("user_id").cast("string"))
    return ev.select("event_id", F.size(arr).alias("n"),
                     F.coalesce(arr == F.array(F.lit("view"), F.col("user_id").cast("string")), F.lit(False)).alias("is_view"),
                     F.array_join(arr, "|").alias("joined"))


@register("scalar_maps", """
select event_id, event_type as got, true as has_user, false as has_missing, 'X' as put_type,
       cast(user_id as varchar) as put_user, 2 as n_entries
from events
""")
def q_scalar_maps(spark, d):
    ev = events(spark, d)
    m = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("type"), F.col("event_type"))
    put = S.map_put(m, "type", F.lit("X"))
    return ev.select("event_id", S.map_get(m, "type").alias("got"), S.map_has(m, "user").alias("has_user"),
                     S.map_has(m, "missing").alias("has_missing"), S.map_get(put, "type").alias("put_type"),
                     S.map_get(put, "user").alias("put_user"), F.size(F.map_entries(put)).alias("n_entries"))


@register("message_json", """
select event_id, event_type as payload, cast(user_id as varchar) as user,
       '{"payload":"' || event_type || '","headers":{"user":"' || cast(user_id as varchar) || '"}}' as json
from events
""")
def q_message_json(spark, d):
    ev = events(spark, d)
    msg = F.struct(F.col("event_type").alias("payload"),
                   F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("headers"))
    j = ev.select("event_id", F.to_json(msg).alias("json"))
    back = j.withColumn("m", F.from_json("json", "payload string, headers map<string,string>"))
    return back.select("event_id", F.col("m.payload").alias("payload"), F.col("m.headers").getItem("user").alias("user"), "json")


PATH_SQL = "'/data/in/' || source || '/doc_' || cast(doc_id as varchar) || '.txt'"


@register("path_parts", f"""
select doc_id, {PATH_SQL} as path, 'doc_' || cast(doc_id as varchar) || '.txt' as name,
       '/data/in/' || source as parent, '/data/error/doc_' || cast(doc_id as varchar) || '.txt' as moved
from documents
""")
def q_path_parts(spark, d):
    docs = table(spark, d, "documents")
    path = F.concat(F.lit("/data/in/"), F.col("source"), F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    p = docs.select("doc_id", path.alias("path"))
    return p.select("doc_id", "path", S.file_name("path").alias("name"), S.parent_dir("path").alias("parent"),
                    S.reroot("path", "/data/error").alias("moved"))

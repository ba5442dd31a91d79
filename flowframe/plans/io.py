"""Source and sink queries (S1-S6, S8-S10, S12-S15, K1-K3, K6-K11) on the test tables.

Sources that poll directories read the test-data directory itself or
tables Spark first writes (derived from the test tables) under the shared
checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.functions.scalar import date_text, ends_with, seeded_pick
from flowframe.operators.sequence import keyed_scan
from flowframe.plans.bindings import EVENT_ORDER, events, url_lines, url_status
from flowframe.plans.registry import register, table
from flowframe.plans.transforms import FULL_NAMES, LCG_SQL
from flowframe.plans.url_flow import URL_FLOW_SQL, url_flow
from flowframe.session import scratch_path, stage_table
from flowframe.sinks import files as SK
from flowframe.sinks.files import path_exists
from flowframe.sinks.mail import mail_outbox
from flowframe.sources import files as SF
from flowframe.sources import mail as SM
from flowframe.sources import records as SR
from flowframe.sources import topics as ST


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ------------------------------------------------------------------ directory sources
@register("file_poll_source", "select 'events.parquet' as file_name, count(*) as n_records from events")
def q_file_poll_source(spark, d):
    rows = SF.file_poll_source(spark, f"{d}/events.parquet", "parquet")
    return SF.file_messages(rows, ["file_name"])


@register("file_pattern_scan", """
select 'customer.parquet' as file_name, count(*) as n_records from customer
union all select 'conversations.parquet', count(*) from conversations
""")
def q_file_pattern_scan(spark, d):
    # the whole test-data directory, filtered by name pattern
    rows = SF.file_poll_source(spark, d, "parquet", glob="c*.parquet", schema="dummy int")
    return SF.file_messages(rows, ["file_name"])


LISTING_PATH_SQL = "case when event_type = 'error' then '/in/.tmp_user_' else '/in/user_' end || cast(user_id as varchar) || '.txt'"


def _listings(spark, d):
    ev = events(spark, d)
    path = F.concat(F.when(F.col("event_type") == "error", F.lit("/in/.tmp_user_")).otherwise(F.lit("/in/user_")),
                    F.col("user_id").cast("string"), F.lit(".txt"))
    return ev.select(path.alias("file_path"), F.col("ts").alias("listing_ts"))


@register("file_listing_dedupe", f"""
select {LISTING_PATH_SQL} as file_path, min(ts) as listing_ts from events
where event_type <> 'error' group by {LISTING_PATH_SQL}
""")
def q_file_listing_dedupe(spark, d):
    return SF.accept_once(_listings(spark, d))


def _tree(spark, d):
    """The documents as a directory tree, one file for each source and language."""
    base = _scratch(spark, "tree")
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    docs.repartition("source", "lang").write.partitionBy("source", "lang").parquet(base)
    return base


def _part(name):
    return F.regexp_extract("file_path", rf"/{name}=([^/]+)/", 1).alias(name)


@register("first_object", "select source, lang from documents order by source, lang limit 1")
def q_first_object(spark, d):
    listing = SF.accept_all(SF.file_listing(spark, _tree(spark, d), glob="*.parquet", recursive=True))
    return SF.first_object(listing.select("file_path")).select(_part("source"), _part("lang"))


@register("recursive_scan", "select source, count(distinct lang) as n_files, count(*) as n_rows from documents group by source")
def q_recursive_scan(spark, d):
    base = _tree(spark, d)
    files = SF.file_listing(spark, base, glob="*.parquet", recursive=True).groupBy(_part("source")).agg(F.count(F.lit(1)).alias("n_files"))
    rows = SF.file_poll_source(spark, base, "parquet", recursive=True, schema="doc_id long").groupBy(_part("source")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    return files.join(rows, "source")


@register("sync_source_intake", "select event_id, event_type from events")
def q_sync_source_intake(spark, d):
    base = _scratch(spark, "sync")
    ev = events(spark, d).select("event_id", "event_type", "ts")
    # the remote store: several files (one per hour bucket of arrival)
    ev.repartition(F.date_trunc("hour", "ts")).write.parquet(f"{base}/remote")
    stream = SF.sync_source_intake(spark, f"{base}/remote", "parquet", ev.schema, max_files_per_trigger=2)
    q = (stream.select("event_id", "event_type").writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


# ------------------------------------------------------------------ record sources
@register("counter_source", "select event_id, row_number() over (order by ts, event_id) as count from events")
def q_counter_source(spark, d):
    return SR.number_messages(events(spark, d).select("event_id", "ts"), EVENT_ORDER).select("event_id", "count")


# The inline person list.
PERSONS = [(0, "tanaka", 35), (1, "suzuki", 28), (2, "kimura", 41)]


@register("inline_records", "select e.event_id, p.name, p.age from events e join (values " +
          ", ".join(f"({i}, '{n}', {a})" for i, n, a in PERSONS) + ") p(idx, name, age) on e.user_id % 3 = p.idx")
def q_inline_records(spark, d):
    persons = SR.inline_records(spark, PERSONS, "idx int, name string, age int")
    ev = events(spark, d).withColumn("idx", F.pmod(F.col("user_id"), F.lit(3)).cast("int"))
    # the inline list has a fixed, configured size: broadcasting it is safe
    return ev.join(F.broadcast(persons), "idx").select("event_id", "name", "age")


@register("envelope_unwrap", """
select event_id, event_id as id, strftime(ts, '%Y/%m/%d %H:%M:%S') as created, event_type, value from events
""")
def q_envelope_unwrap(spark, d):
    ev = events(spark, d).select("event_id", F.col("event_id").alias("id"), date_text("ts").alias("created"), "event_type", "value")
    wrapped = SR.envelope_wrap(ev, ["id", "created"], ["event_type", "value"]).select("event_id", "value")
    return SR.envelope_unwrap(wrapped, "value", "id bigint, created string", "event_type string, value double")


SWITCH_START = dt.datetime(2024, 1, 1, 0, 0, 0)


@register("switched_source", f"""
select event_id from events where (date_diff('second', timestamp '{SWITCH_START:%Y-%m-%d %H:%M:%S}', ts) // 5) % 2 = 0
""")
def q_switched_source(spark, d):
    return SR.switched_source(events(spark, d), "ts", SWITCH_START, 5).select("event_id")


@register("intake_limit", "select event_id, (row_number() over (order by ts, event_id) - 1) // 5 as poll_no from events")
def q_intake_limit(spark, d):
    return SR.intake_limit(events(spark, d).select("event_id", "ts"), EVENT_ORDER, 5).select("event_id", "poll_no")


# ------------------------------------------------------------------ topics
@register("topic_consume", f"""
with r as (select 'Topic1' as topic, user_id % 6 as partition, event_id as count,
                  case {LCG_SQL.format(c='event_id', n=3)} {" ".join(f"when {i} then '{n}'" for i, n in enumerate(FULL_NAMES))} end as fullName,
                  ts, event_id from events)
select topic, partition, row_number() over (partition by topic, partition order by ts, event_id) - 1 as "offset",
       partition % 3 as consumer, count, fullName from r
""")
def q_topic_consume(spark, d):
    ev = events(spark, d)
    value = F.struct(F.col("event_id").cast("int").alias("count"), seeded_pick("event_id", FULL_NAMES).alias("fullName"))
    recs = ST.to_topic_layout(ev, F.lit(None).cast("int"), value, F.lit("Topic1"), 6, F.col("user_id"), "ts", EVENT_ORDER)
    out = ST.consumer_share(recs, 3)
    return out.select("topic", "partition", "offset", "consumer", F.col("value.count").alias("count"),
                      F.col("value.fullName").alias("fullName"))


@register("topic_route_sink", """
select event_id, coalesce(case when event_type = 'error' then 'Errors' end, 'Topic1') as topic from events
""")
def q_topic_route_sink(spark, d):
    ev = events(spark, d).withColumn("kafka_topic", F.when(F.col("event_type") == "error", F.lit("Errors")))
    return ST.topic_route(ev, "kafka_topic", "Topic1").select("event_id", "topic")


# ------------------------------------------------------------------ mail
def _mime(spark, d):
    c = table(spark, d, "conversations")
    crlf = "\r\n"
    head = F.concat(F.lit("Subject: conv "), F.col("conv_id").cast("string"), F.lit(" turn "), F.col("turn").cast("string"), F.lit(crlf),
                    F.lit("MIME-Version: 1.0" + crlf + 'Content-Type: multipart/mixed; boundary="b1"' + crlf + crlf))
    text_part = "--{b}" + crlf + "Content-Type: text/plain; charset=utf-8" + crlf + "Content-Transfer-Encoding: 8bit" + crlf + crlf
    body = F.concat(
        head,
        F.lit(text_part.format(b="b1")), F.col("role"), F.lit(crlf),
        F.lit("--b1" + crlf + 'Content-Type: multipart/alternative; boundary="b2"' + crlf + crlf),
        F.lit(text_part.format(b="b2")), F.col("text"), F.lit(crlf),
        F.lit("--b2--" + crlf),
        F.lit("--b1" + crlf + "Content-Type: application/xml" + crlf + 'Content-Disposition: attachment; filename="a.xml"' + crlf + crlf
              + "<a/>" + crlf + "--b1--" + crlf),
    )
    return c.select(F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("mail_id"),
                    F.encode(body, "UTF-8").alias("content"))


@register("mail_bodies", """
select cast(conv_id as varchar) || '-' || cast(turn as varchar) as mail_id,
       'conv ' || cast(conv_id as varchar) || ' turn ' || cast(turn as varchar) as subject,
       role || replace(text, chr(13), '') as body
from conversations
""")
def q_mail_bodies(spark, d):
    out = SM.mail_bodies(_mime(spark, d))
    return out.withColumn("body", F.regexp_replace("body", r"\r", ""))


# ------------------------------------------------------------------ sinks
@register("per_file_sink", f"""
with u as ({URL_FLOW_SQL}) select file_name, line, row_number() over (partition by file_name order by seq_no) as line_no from u
""")
def q_per_file_sink(spark, d):
    base = _scratch(spark, "perfile")
    SK.per_file_sink(url_flow(url_lines(spark, d), url_status(spark, d)), base, "file_name", "seq_no", "line")
    # the lines as a reader finds them: part files in name order, lines in file order
    back = spark.read.text(base).select(
        "file_name", F.col("value").alias("line"), F.col("_metadata.file_path").alias("part"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    return keyed_scan(back, ["file_name"], ["part", "start", "at"], rn="line_no").select("file_name", "line", "line_no")


@register("compose_document", """
select 'event_' || cast(event_id as varchar) || '.txt' as file_name,
       'To: user' || cast(user_id as varchar) || '@example.com' || chr(13) || chr(10) || 'Subject: ' || event_type
       || chr(13) || chr(10) || chr(13) || chr(10) || props as document
from events
""")
def q_compose_document(spark, d):
    ev = events(spark, d)
    doc = SK.compose_document(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")), F.col("event_type"), F.col("props"))
    composed = ev.select(F.concat(F.lit("event_"), F.col("event_id").cast("string"), F.lit(".txt")).alias("file_name"), doc.alias("document"))
    return SK.write_documents(composed, _scratch(spark, "documents"), "file_name", "document")


@register("gated_publish", "select n_nationkey, n_name, true as first_run, false as second_run from nation")
def q_gated_publish(spark, d):
    base = _scratch(spark, "publish")
    parts = {"nation": table(spark, d, "nation"), "region": table(spark, d, "region")}
    first = SK.gated_publish(spark, base, parts)
    second = SK.gated_publish(spark, base, parts)  # marker present: no-op
    return spark.read.parquet(f"{base}/nation").select("n_nationkey", "n_name", F.lit(first).alias("first_run"), F.lit(second).alias("second_run"))


@register("null_sink", "select count(*) as n_rows from events")
def q_null_sink(spark, d):
    n = SK.null_sink(events(spark, d))
    return spark.range(1).select(F.lit(n).cast("long").alias("n_rows"))


@register("log_tap", """
select event_id, 'WARN' as log_level, 'WARN ' || cast(event_id as varchar) || ':' || event_type as log_line from events
""")
def q_log_tap(spark, d):
    ev = events(spark, d)
    out = SK.log_tap(ev, "WARN", F.format_string("%d:%s", F.col("event_id"), F.col("event_type")))
    return out.select("event_id", "log_level", "log_line")


# Sender and recipients of the error mail.
MAIL_FROM = "system@sample.com"
MAIL_TO = "alert@test.co.jp,ops@sample.com"


@register("mail_outbox", f"""
select event_id, '{MAIL_FROM}' as mail_from, unnest(string_split('{MAIL_TO}', ',')) as mail_to, event_type as subject, props as body
from events where event_type = 'error'
""")
def q_mail_outbox(spark, d):
    ev = events(spark, d).filter(F.col("event_type") == "error")
    out = mail_outbox(ev, F.lit(MAIL_FROM), F.lit(MAIL_TO), F.col("event_type"), F.col("props"))
    return out.select("event_id", "mail_from", "mail_to", "subject", "body")


DOC_PATH_SQL = "'/in/doc_' || cast(doc_id as varchar) || case lang when 'en' then '.xlsx' else '.csv' end"


def _doc_paths(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.concat(F.lit("/in/doc_"), F.col("doc_id").cast("string"),
                                          F.when(F.col("lang") == "en", ".xlsx").otherwise(".csv")).alias("file_path"))


@register("disposition", f"""
select doc_id, {DOC_PATH_SQL} as file_path,
       case when ends_with({DOC_PATH_SQL}, '.xlsx') then 'delete' else 'move_error' end as outcome,
       case when ends_with({DOC_PATH_SQL}, '.xlsx') then null else '/error/' || regexp_extract({DOC_PATH_SQL}, '([^/]*)$', 1) end as target_path
from documents
""")
def q_disposition(spark, d):
    p = _doc_paths(spark, d)
    return SK.disposition(p, "file_path", ends_with("file_path", ".xlsx"), "/error").select("doc_id", "file_path", "outcome", "target_path")


@register("disposition_applied", """
select source, lang, case when lang = 'en' then 'deleted' else 'error' end as place from (select distinct source, lang from documents)
""")
def q_disposition_applied(spark, d):
    """The files of a poll after their post-processing: handled ones are deleted, failed ones moved."""
    base, error = _tree(spark, d), _scratch(spark, "error")
    rows = SF.file_poll_source(spark, base, "parquet", recursive=True, schema="doc_id long").select(
        "doc_id", "file_path", _part("source"), _part("lang"))
    listing = SF.file_listing(spark, base, glob="*.parquet", recursive=True).select("file_path", _part("source"), _part("lang"))
    # a listing's paths are as the file system names them, a row's are URIs
    decided = stage_table(SK.disposition(listing.withColumn("file_path", F.regexp_replace("file_path", "^file:/+", "file:///")),
                                         "file_path", F.col("lang") == "en", error), "decided")
    rows = rows.withColumn("file_path", F.regexp_replace("file_path", "^file:/+", "file:///"))
    SK.apply_disposition(rows, decided, "file_path", base, error, ["source", "lang"])
    moved = SF.file_listing(spark, error, glob="*.parquet", recursive=True).select(_part("source"), _part("lang")).distinct()
    left = decided.filter(F.lit(path_exists(spark, base))).select("source", "lang")
    places = moved.withColumn("place", F.lit("error")).unionByName(left.withColumn("place", F.lit("left")))
    return decided.select("source", "lang").join(places, ["source", "lang"], "left").withColumn(
        "place", F.coalesce("place", F.lit("deleted")))


@register("intake_changed", """
with f as (select distinct source, lang from documents),
r as (select source, lang, row_number() over (order by source, lang) as n from f)
select 'once' as accept, 1 as poll, source, lang from f
union all select 'once', 2, 'new', 'xx'
union all select 'changed', 1, source, lang from f
union all select 'changed', 2, source, lang from r where n = 1 union all select 'changed', 2, 'new', 'xx'
union all select 'create', 1, source, lang from f
union all select 'create', 2, 'new', 'xx'
union all select 'all', 1, source, lang from f
union all select 'all', 2, source, lang from f union all select 'all', 2, 'new', 'xx'
""")
def q_intake_changed(spark, d):
    """Two polls of a directory; between them one file changes and one is new."""
    base, ledgers = _tree(spark, d), _scratch(spark, "ledger")
    kinds = ("once", "changed", "create", "all")

    def poll(n):
        return [SF.intake_changed(spark, base, f"{ledgers}/{a}", a, glob="*.parquet").select(
            F.lit(a).alias("accept"), F.lit(n).alias("poll"), _part("source"), _part("lang")) for a in kinds]

    first = poll(1)
    listing = SF.file_listing(spark, base, glob="*.parquet", recursive=True).withColumns({"s": _part("source"), "l": _part("lang")})
    SF.touch(spark, listing.orderBy("s", "l").first()["file_path"])
    spark.range(1).select(F.col("id").alias("doc_id")).coalesce(1).write.parquet(f"{base}/source=new/lang=xx")
    return functools.reduce(DataFrame.unionByName, [*first, *poll(2)])


# The stage directories an upload passes through.
STAGES = ("upload", "uploading", "sent")


@register("stage_progress", f"""
select doc_id, s.stage_no, s.stage, s.stage || '/' || regexp_extract({DOC_PATH_SQL}, '([^/]*)$', 1) as stage_path
from documents cross join (values {", ".join(f"({i}, '{s}')" for i, s in enumerate(STAGES))}) s(stage_no, stage)
""")
def q_stage_progress(spark, d):
    return SK.stage_progress(_doc_paths(spark, d), "file_path", STAGES).select("doc_id", "stage_no", "stage", "stage_path")

"""Table-movement queries (S7, S11, P12-P19, K4, K5, J2, T2, U2, U3) on the test tables.

``orders.o_orderstatus`` plays the claim status: F = new, O = claimed, P = done.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from flowframe.operators import tables as TB
from flowframe.plans.registry import register, table
from flowframe.session import scratch_path

NEW, CLAIMED, DONE = "F", "O", "P"
# The clock used by the master/detail load (a 30 Nov date, so
# that +3 months clips to the end of February).
LOAD_NOW = dt.datetime(2024, 11, 30, 12, 0, 0)


@register("table_poll", f"select * from orders where o_orderstatus = '{NEW}'")
def q_table_poll(spark, d):
    return TB.table_poll(table(spark, d, "orders"), F.col("o_orderstatus") == NEW)


@register("select_by_id", "select * from customer where c_custkey = 7")
def q_select_by_id(spark, d):
    return TB.select_by_id(table(spark, d, "customer"), "c_custkey", 7)


@register("select_by_id_version", """
with k as (select l_orderkey as id from lineitem order by l_orderkey desc limit 1)
select * from lineitem where l_orderkey = (select id from k)
  and l_linenumber = (select max(l_linenumber) from lineitem where l_orderkey = (select id from k))
""")
def q_select_by_id_version(spark, d):
    # the (id, version) the caller holds: the last order and its highest line
    li = table(spark, d, "lineitem")
    last = li.agg(F.max(F.struct("l_orderkey", "l_linenumber")).alias("k"))
    return TB.select_by_id_version(li, "l_orderkey", last.select("k.l_orderkey").scalar(), "l_linenumber",
                                   last.select("k.l_linenumber").scalar(), ensure_result=False)


@register("status_claim", f"""
select o_orderkey, case when o_orderstatus = '{NEW}' then '{CLAIMED}' else o_orderstatus end as o_orderstatus from orders
""")
def q_status_claim(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    polled = o.filter(F.col("o_orderstatus") == NEW).select("o_orderkey")
    _, snap = TB.status_claim(o, "o_orderkey", "o_orderstatus", NEW, CLAIMED, claimed=polled)
    return snap


@register("semi_anti_claim", f"""
select l_orderkey, l_linenumber, 'semi' as side from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = '{CLAIMED}')
union all
select l_orderkey, l_linenumber, 'anti' as side from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = '{CLAIMED}')
""")
def q_semi_anti_claim(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    keys = table(spark, d, "orders").filter(F.col("o_orderstatus") == CLAIMED).select(F.col("o_orderkey").alias("l_orderkey"))
    return TB.semi_anti_side(li, keys, "l_orderkey")


@register("table_append", f"""
select o_orderkey as order_id from orders where o_orderstatus = '{CLAIMED}'
""")
def q_table_append(spark, d):
    o = table(spark, d, "orders")
    claimed = o.filter(F.col("o_orderstatus") == CLAIMED).select(F.col("o_orderkey").alias("order_id"))
    # a batch that holds rows twice, and a replay of it, must not duplicate rows
    first = TB.table_append(None, claimed.unionByName(claimed.filter("order_id % 3 = 0")), ["order_id"], key="order_id")
    return TB.table_append(first, claimed, ["order_id"], key="order_id")


@register("conditional_delete", f"""
select * from orders where not (o_orderstatus = '{CLAIMED}' and o_orderkey in (select l_orderkey from lineitem where l_linenumber = 1 and l_returnflag = 'R'))
""")
def q_conditional_delete(spark, d):
    o = table(spark, d, "orders")
    copied = table(spark, d, "lineitem").filter((F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "R")).select(
        F.col("l_orderkey").alias("o_orderkey"))
    return TB.conditional_delete(o, copied, "o_orderkey", "o_orderstatus", CLAIMED)


@register("insert_generated_key", """
select (select max(c_custkey) from customer) + row_number() over (order by s_suppkey) as c_custkey,
       s_name as c_name, s_nationkey as c_nationkey
from supplier
""")
def q_insert_generated_key(spark, d):
    rows = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"))
    out = TB.insert_generated_key(table(spark, d, "customer"), rows, "c_custkey", ["s_suppkey"])
    return out.select("c_custkey", "c_name", "c_nationkey")


# each line is a change of its part: it expects its line number to be the stored version (p_size), and of
# several changes that expect it the one with the smallest order and price wins
VERSIONED_SQL = """
with ch as (select l_partkey as p_partkey, l_linenumber as expected_version, l_orderkey, l_extendedprice, l_quantity,
                   row_number() over (partition by l_partkey, l_linenumber
                                      order by l_orderkey, l_extendedprice, l_quantity) as turn
            from lineitem),
j as (select ch.*, p.p_partkey as t_id, p.p_size as t_v from ch left join part p on ch.p_partkey = p.p_partkey),
o as (select *, case when t_id is null then 'missing' when t_v = expected_version and turn = 1 then '{done}' else 'stale' end as outcome from j)
"""
UPDATED_SQL, DELETED_SQL = VERSIONED_SQL.format(done="updated"), VERSIONED_SQL.format(done="deleted")


def _line_changes(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_linenumber").alias("expected_version"),
                                              "l_orderkey", "l_extendedprice", "l_quantity")


def _parts(spark, d):
    return table(spark, d, "part").select("p_partkey", F.col("p_size").alias("version"), "p_retailprice")


CHANGE_ORDER = ["l_orderkey", "l_extendedprice", "l_quantity"]


@register("versioned_update", UPDATED_SQL + """
select p_partkey, expected_version, l_orderkey, l_extendedprice, outcome,
       case when outcome = 'updated' then t_v + 1 else t_v end as version, case when outcome = 'updated' then 1 else 0 end as affected
from o
""")
def q_versioned_update(spark, d):
    rows, _ = TB.versioned_update(_parts(spark, d), _line_changes(spark, d), "p_partkey", "version", "expected_version",
                                  {"p_retailprice": "l_extendedprice"}, CHANGE_ORDER)
    return rows.select("p_partkey", "expected_version", "l_orderkey", "l_extendedprice", "outcome", "version", "affected")


@register("versioned_update_snapshot", UPDATED_SQL + """
select p.p_partkey, case when o.p_partkey is null then p.p_size else p.p_size + 1 end as version,
       coalesce(o.l_extendedprice, p.p_retailprice) as p_retailprice
from part p left join (select * from o where outcome = 'updated') o on p.p_partkey = o.p_partkey
""")
def q_versioned_update_snapshot(spark, d):
    return TB.versioned_update(_parts(spark, d), _line_changes(spark, d), "p_partkey", "version", "expected_version",
                               {"p_retailprice": "l_extendedprice"}, CHANGE_ORDER)[1]


@register("versioned_delete", DELETED_SQL + """
select p_partkey, 'change' as kind, outcome, count(*) as n from o group by p_partkey, outcome
union all
select p_partkey, 'row', 'kept', 1 from part where p_partkey not in (select p_partkey from o where outcome = 'deleted')
""")
def q_versioned_delete(spark, d):
    rows, snap = TB.versioned_delete(_parts(spark, d), _line_changes(spark, d), "p_partkey", "version", "expected_version", CHANGE_ORDER)
    changes = rows.groupBy("p_partkey", "outcome").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("change"))
    kept = snap.select("p_partkey", F.lit("kept").alias("outcome"), F.lit(1).cast("long").alias("n"), F.lit("row").alias("kind"))
    return changes.unionByName(kept).select("p_partkey", "kind", "outcome", "n")


@register("keyed_upsert", """
with ch as (select o_custkey as c_custkey, o_totalprice as c_acctbal,
                   row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as turn from orders)
select c_custkey, c_acctbal from customer where c_custkey not in (select c_custkey from ch)
union all select c_custkey, c_acctbal from ch where turn = 1
""")
def q_keyed_upsert(spark, d):
    # every order is a change of its customer; the newest one counts
    cust = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    ch = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"),
                                          "o_orderdate", "o_orderkey")
    return TB.keyed_upsert(cust, ch, "c_custkey", ["o_orderdate", "o_orderkey"])


@register("keyed_delete", "select c_custkey, c_acctbal from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def q_keyed_delete(spark, d):
    gone = table(spark, d, "orders").filter(F.col("o_orderstatus") == DONE).select(F.col("o_custkey").alias("c_custkey"))
    return TB.keyed_delete(table(spark, d, "customer").select("c_custkey", "c_acctbal"), gone, "c_custkey")


@register("page_with_total", """
select *, (select count(*) from orders) as total from orders order by o_orderkey limit 20 offset 60
""")
def q_page_with_total(spark, d):
    return TB.page_with_total(table(spark, d, "orders"), ["o_orderkey"], page=3, size=20)


@register("ordered_read", "select c_nationkey, c_custkey, c_name from customer order by c_nationkey, c_custkey")
def q_ordered_read(spark, d):
    return TB.ordered_read(table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name"), ["c_nationkey", "c_custkey"])


def _sheet(spark, d):
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("row_idx"),
        F.col("c_name").alias("username"),
        F.col("c_mktsegment").alias("password"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("mail_address"),
        F.concat(F.lit("ROLE_"), F.col("c_mktsegment"), F.lit(",ROLE_USER")).alias("roles"),
    )


@register("master_detail_load", f"""
with s as (select c_custkey as row_idx, c_name as username,
                  'ROLE_' || c_mktsegment || ',ROLE_USER' as roles from customer),
u as (select row_number() over (order by row_idx) as user_id, username, roles from s),
r as (select user_id, username, unnest(string_split(roles, ',')) as role, unnest(generate_series(1, len(string_split(roles, ',')))) as role_pos from u)
select r.user_id, r.username, r.role_pos, r.role, cast(1 as smallint) as enabled, cast(0 as smallint) as cnt_badcredentials,
       timestamp '{LOAD_NOW:%Y-%m-%d %H:%M:%S}' + interval 3 month as expired_account,
       timestamp '{LOAD_NOW:%Y-%m-%d %H:%M:%S}' + interval 1 month as expired_password
from r
""")
def q_master_detail_load(spark, d):
    users, roles = TB.master_detail_load(_sheet(spark, d), None, LOAD_NOW, ["row_idx"])
    return roles.join(users, "user_id").select(
        "user_id", "username", (F.col("role_pos") + 1).alias("role_pos"), "role", "enabled", "cnt_badcredentials",
        "expired_account", "expired_password")


@register("sheet_until_blank", """
with b as (select min(conv_id * 1000 + turn) as stop from conversations where text is null or trim(text) = '')
select conv_id * 1000 + turn as row_idx, role, text from conversations, b
where conv_id * 1000 + turn >= 1 and (b.stop is null or conv_id * 1000 + turn < b.stop)
""")
def q_sheet_until_blank(spark, d):
    rows = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("row_idx"), "role", "text")
    return TB.sheet_until_blank(rows, "row_idx", "text", header_rows=1)


TABLE_DIFF_SQL = f"""
with after as (select o_orderkey, case when o_orderstatus = '{NEW}' then '{CLAIMED}' else o_orderstatus end as o_orderstatus from orders),
before as (select o_orderkey, o_orderstatus from orders)
select *, 'expected' as side from (select * from before except all select * from after)
union all
select *, 'actual' as side from (select * from after except all select * from before)
"""


@register("table_diff", TABLE_DIFF_SQL)
def q_table_diff(spark, d):
    o = table(spark, d, "orders")
    _, after = TB.status_claim(o, "o_orderkey", "o_orderstatus", NEW, CLAIMED)
    return TB.table_diff(o, after, include=["o_orderkey", "o_orderstatus"])


@register("table_diff_tree", TABLE_DIFF_SQL)
def q_table_diff_tree(spark, d):
    o = table(spark, d, "orders")
    _, after = TB.status_claim(o, "o_orderkey", "o_orderstatus", NEW, CLAIMED)
    return TB.table_diff_tree(o, after, include=["o_orderkey", "o_orderstatus"])


@register("fixture_load", """
select 'region' as tbl, r_regionkey as k, r_name as name from region
union all select 'nation', n_nationkey, n_name from nation
""")
def q_fixture_load(spark, d):
    import uuid

    base = scratch_path(spark, f"fixture-{uuid.uuid4().hex}")
    # write the fixture CSVs from the tables (NULL written as the token), then clean-load them
    for name in ("region", "nation"):
        table(spark, d, name).write.option("header", True).option("nullValue", TB.NULL_TOKEN).csv(f"{base}/csv/{name}.csv")
    loaded = TB.fixture_load(
        spark, f"{base}/csv", ["region", "nation"],
        {"region": "r_regionkey int, r_name string", "nation": "n_nationkey int, n_name string, n_regionkey int"},
        f"{base}/tables")
    return loaded["region"].select(F.lit("region").alias("tbl"), F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")).unionByName(
        loaded["nation"].select(F.lit("nation").alias("tbl"), F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")))

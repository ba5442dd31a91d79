"""How the logical inputs of the flows map onto the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.plans.registry import table

# Arrival order of the correlated-group stream (lineitem),
# a total order up to fully identical rows.
LINEITEM_ARRIVAL = ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINEITEM_ARRIVAL_SQL = ", ".join(LINEITEM_ARRIVAL)

# Message stream order (events): ts is unique, event_id breaks any tie.
EVENT_ORDER = ["ts", "event_id"]


def grouped_messages(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as correlated messages: corr_id = order, declared size = line number."""
    return table(spark, d, "lineitem").select(
        "*",
        F.col("l_orderkey").alias("corr_id"),
        F.col("l_linenumber").alias("seq_size"),
        F.col("l_partkey").cast("string").alias("payload"),
    )


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


# URL-list files: each page URL is one line of the file of its language path.
URL_FILE_SQL = "'urls_' || regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) || '.txt'"


def url_lines(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").select("page_id", "url")
    return p.withColumn(
        "file_name", F.concat(F.lit("urls_"), F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1), F.lit(".txt")))


def url_status(spark: SparkSession, d: str) -> DataFrame:
    """Lookup results (url, status).  The HTTP call itself is not built; a
    fetched page with a body counts as 200, an empty one as 404."""
    p = table(spark, d, "pages")
    return p.select("url", F.when(F.col("html").isNull() | (F.col("html") == ""), F.lit("404")).otherwise(F.lit("200")).alias("status"))


URL_STATUS_SQL = "select url, case when html is null or html = '' then '404' else '200' end as status from pages"

"""Entry flow 1: URL-list files -> lines -> route -> status -> resequence -> per-file output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.operators.grouping import resequence
from flowframe.operators.sequence import keyed_scan
from flowframe.operators.transform import status_attach
from flowframe.plans.bindings import URL_FILE_SQL, URL_STATUS_SQL, url_lines, url_status
from flowframe.plans.registry import register

URL_FLOW_SQL = f"""
with lines as (select {URL_FILE_SQL} as file_name, page_id, url from pages),
num as (
  select file_name, page_id, url,
         row_number() over (partition by file_name order by page_id) as seq_no,
         count(*) over (partition by file_name) as seq_size
  from lines),
st as (select url, max(status) as status from ({URL_STATUS_SQL}) group by url)
select n.file_name, n.seq_no, n.seq_size,
       n.url || ',' || coalesce(case when n.url like 'http://%' then st.status end, 'null') as line
from num n left join st on n.url = st.url
"""


def url_flow(lines: DataFrame, results: DataFrame) -> DataFrame:
    """Number lines per file (skew-safe), set the size, check http:// lines
    against the results, keep complete files in line order."""
    num = keyed_scan(lines, ["file_name"], ["page_id"], rn="seq_no")
    sizes = lines.groupBy(F.col("file_name").alias("_f")).agg(F.count(F.lit(1)).alias("seq_size"))
    num = num.join(sizes, num["file_name"] == sizes["_f"]).drop("_f")
    checked = status_attach(num, results, check=F.col("url").startswith("http://"))
    return resequence(checked, "file_name", "seq_no", "seq_size").select("file_name", "seq_no", "seq_size", "line")


@register("url_flow", URL_FLOW_SQL)
def q_url_flow(spark: SparkSession, d: str) -> DataFrame:
    return url_flow(url_lines(spark, d), url_status(spark, d))

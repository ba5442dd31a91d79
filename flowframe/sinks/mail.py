"""Mail outbox: messages become outgoing mail rows (sending is a transport concern)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mail_outbox(df: DataFrame, mail_from: Column, mail_to: Column, subject: Column, body: Column) -> DataFrame:
    """One outbox row per recipient; the ``to`` list is split on ``,``."""
    rows = df.select("*", mail_from.alias("mail_from"), F.split(mail_to, ",").alias("_to"), subject.alias("subject"), body.alias("body"))
    return rows.withColumn("mail_to", F.explode("_to")).drop("_to").filter(F.trim(F.col("mail_to")) != "")

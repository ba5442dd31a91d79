"""Mailbox source: text bodies from raw MIME messages.

Mail arrives as ``(mail_id, content BINARY)`` rows, e.g. from
``spark.read.format("binaryFile")`` over ``.eml`` files.  Parsing MIME is
per-message Python (the standard ``email`` package), run in Arrow batches
with ``mapInPandas``; Spark partitions the messages.
"""

from __future__ import annotations

from email import message_from_bytes
from email.header import decode_header, make_header

import pandas as pd
from pyspark.sql import DataFrame

_OUT = "mail_id string, subject string, body string"


def _decoded(part) -> str:
    raw = part.get_payload(decode=True) or b""
    return raw.decode(part.get_content_charset() or "utf-8", errors="replace")


def _text_body(msg) -> str:
    """Plain mail: the body as is.  Multipart: every text/plain part in
    order, descending into nested multiparts; other parts (attachments of
    other types) ignored."""
    if not msg.is_multipart():
        return _decoded(msg) if msg.get_content_type() == "text/plain" else ""
    out = []
    for part in msg.get_payload():
        if part.is_multipart():
            out.append(_text_body(part))
        elif part.get_content_type() == "text/plain" and (part.get("Content-Disposition") or "").split(";")[0].strip().lower() != "attachment":
            out.append(_decoded(part))
    return "".join(out)


def _subject(msg):
    s = msg["Subject"]
    return None if s is None else str(make_header(decode_header(s)))


def _parse(batches):
    for pdf in batches:
        subjects, bodies = [], []
        for raw in pdf["content"]:
            if raw is None:
                subjects.append(None)
                bodies.append(None)
                continue
            m = message_from_bytes(bytes(raw))
            subjects.append(_subject(m))
            bodies.append(_text_body(m))
        yield pd.DataFrame({"mail_id": pdf["mail_id"], "subject": subjects, "body": bodies})


def mail_bodies(df: DataFrame, id_col: str = "mail_id", content_col: str = "content") -> DataFrame:
    """``(mail_id, subject, body)`` per message."""
    src = df.select(df[id_col].cast("string").alias("mail_id"), df[content_col].alias("content"))
    return src.mapInPandas(_parse, _OUT)

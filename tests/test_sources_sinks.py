import os

from pyspark.sql import functions as F

from flowframe.operators import transform as T
from flowframe.sinks import files as SK
from flowframe.sources import files as SF
from flowframe.sources import mail as SM
from flowframe.sources import records as SR


def test_per_file_sink_keeps_line_order(spark, tmp_path):
    rows = [("big.txt", i, f"line{i}") for i in range(1, 2001)] + [("small.txt", 1, "only")]
    df = spark.createDataFrame(rows, "file_name string, seq_no int, line string").repartition(5)
    out = str(tmp_path / "out")
    SK.per_file_sink(df, out, "file_name", "seq_no", "line", num_partitions=4)
    big = os.path.join(out, "file_name=big.txt")
    parts = sorted(p for p in os.listdir(big) if p.startswith("part-"))
    assert len(parts) > 1  # a large file is written by several tasks
    lines = [ln.rstrip("\n") for p in parts for ln in open(os.path.join(big, p), encoding="utf-8")]
    assert lines == [f"line{i}" for i in range(1, 2001)]


def test_gated_publish_runs_once(spark, tmp_path):
    target = str(tmp_path / "pub")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert SK.gated_publish(spark, target, {"data": df}) is True
    assert SK.gated_publish(spark, target, {"data": df.limit(0)}) is False
    assert spark.read.parquet(f"{target}/data").count() == 1


def test_mail_bodies_nested_multipart(spark):
    crlf = "\r\n"
    plain = "Subject: hi" + crlf + "Content-Type: text/plain" + crlf + crlf + "just text" + crlf
    nested = crlf.join([
        "Subject: nested", 'Content-Type: multipart/mixed; boundary="a"', "", "--a",
        "Content-Type: text/plain", "", "one", "--a", 'Content-Type: multipart/alternative; boundary="b"', "",
        "--b", "Content-Type: text/plain", "", "two", "--b", "Content-Type: text/html", "", "<p>x</p>", "--b--",
        "--a", "Content-Type: application/xml", 'Content-Disposition: attachment; filename="x.xml"', "", "<x/>", "--a--", ""])
    df = spark.createDataFrame([("m1", bytearray(plain.encode())), ("m2", bytearray(nested.encode()))], "mail_id string, content binary")
    got = {r["mail_id"]: (r["subject"], r["body"].replace("\r", "")) for r in SM.mail_bodies(df).collect()}
    assert got["m1"] == ("hi", "just text\n")
    assert got["m2"] == ("nested", "onetwo")


def test_header_enrich_keep_and_overwrite(spark):
    df = spark.createDataFrame([({"a": "1"},), ({},)], "headers map<string,string>")
    kept = T.header_enrich(df, "a", F.lit("new"), overwrite=False, headers="headers")
    over = T.header_enrich(df, "a", F.lit("new"), overwrite=True, headers="headers")
    assert [r["headers"]["a"] for r in kept.collect()] == ["1", "new"]
    assert [r["headers"]["a"] for r in over.collect()] == ["new", "new"]


def test_recipient_list_default(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 50.0)], "id int, v double")
    out = T.recipient_list(df, [("small", F.col("v") < 10), ("tiny", F.col("v") < 6)])
    got = sorted((r["id"], r["recipient"]) for r in out.collect())
    assert got == [(1, "small"), (1, "tiny"), (2, "default")]


def test_accept_once_and_hidden_files(spark):
    df = spark.createDataFrame([("/in/a.txt", 3), ("/in/a.txt", 1), ("/in/.b.txt", 0), ("/in/_c", 0)], "file_path string, listing_ts int")
    got = sorted((r["file_path"], r["listing_ts"]) for r in SF.accept_once(df).collect())
    assert got == [("/in/a.txt", 1)]
    assert SF.accept_all(df).count() == 2


def test_envelope_unwrap_modes(spark):
    df = spark.createDataFrame([('{"headers": {"id": 7}, "payload": {"msg": "x"}}',)], "value string")
    unwrapped = SR.envelope_unwrap(df, "value", "id bigint", "msg string").first()
    assert (unwrapped["id"], unwrapped["msg"]) == (7, "x")
    whole = SR.envelope_unwrap(df, "value", "id bigint", "msg string", expect_message=False).first()
    assert whole["payload"].startswith('{"headers"')

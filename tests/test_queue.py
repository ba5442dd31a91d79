"""A queue of envelopes as a Python data source, in batch and as a stream over restarts."""

import os

from flowframe.sources.queue import append_envelopes, read_envelopes
from flowframe.streaming.runner import run_available_now


def _values(*values):
    return [(v,) for v in values]


def test_a_stream_goes_on_at_its_offset(spark, tmp_path):
    queue, run = str(tmp_path / "queue"), str(tmp_path / "run")
    frame = lambda *v: spark.createDataFrame(_values(*v), "value string")
    taken = lambda: sorted(((r["append"], r["value"]) for r in run_available_now(
        read_envelopes(spark, queue, streaming=True), "q", base=run).collect()), key=str)
    assert read_envelopes(spark, queue).collect() == []
    append_envelopes(frame("a", None, "b"), queue)
    append_envelopes(frame(), queue)
    assert taken() == [(0, "a"), (0, "b"), (0, None)]
    # an append without its marker is not there yet
    append_envelopes(frame("c", "a"), queue)
    os.rename(f"{queue}/append=000000002/_SUCCESS", f"{queue}/append=000000002/_later")
    assert len(taken()) == 3 and read_envelopes(spark, queue).count() == 3
    os.rename(f"{queue}/append=000000002/_later", f"{queue}/append=000000002/_SUCCESS")
    assert taken() == [(0, "a"), (0, "b"), (0, None), (2, "a"), (2, "c")]
    assert read_envelopes(spark, queue).count() == 5


def test_an_append_that_failed_is_written_again(spark, tmp_path):
    queue = str(tmp_path / "queue")
    spark.range(20_000).selectExpr("cast(id as string) as value").write.parquet(f"{queue}/append=000000000")
    os.remove(f"{queue}/append=000000000/_SUCCESS")
    assert append_envelopes(spark.range(30_000).selectExpr("cast(id as string) as value").repartition(3), queue) == 0
    got = read_envelopes(spark, queue)
    assert got.rdd.getNumPartitions() == 3 and got.selectExpr("count(distinct value)").first()[0] == 30_000

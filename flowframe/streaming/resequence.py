"""Resequencing while messages come (A7): keyed state of the next number and of what waits behind a gap.

A group's messages come in any order.  The state of a group is the number it
waits for and the messages that lie beyond it; as soon as that number comes,
it and all that follow it without a gap leave in order (``whole=False``), or
the whole group leaves with its last message (``whole=True``).  A group whose
messages have all left has no state.

With ``buckets`` the groups of a hash bucket share one value of the state
store, read and written once a micro-batch (see ``group_state``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from flowframe.streaming.runner import plain, rocksdb_state

ORDERED = "corr_id string, seq_no long, seq_size long, payload string"
WAITING = "next long, numbers array<long>, payloads array<string>"


BUCKET = "groups string"


def released(known: Sequence | None, messages: Sequence[tuple], whole: bool) -> tuple[tuple | None, list[tuple]]:
    """A group's state (``WAITING``, or None when all has left) after its messages (number, size, payload), and what leaves."""
    wanted, size = (known[0] if known else 1), None
    waiting = dict(zip(known[1], known[2])) if known else {}
    for number, size, payload in messages:
        if number >= wanted:  # a number that has left already does not leave again
            waiting.setdefault(number, payload)
    out = []
    if not whole or len(waiting) == size:
        while wanted in waiting:
            out.append((wanted, size, waiting.pop(wanted)))
            wanted += 1
    if size is not None and wanted > size:
        return None, out
    numbers = sorted(waiting)
    return (wanted, numbers, [waiting[n] for n in numbers]), out


class Resequencer(StatefulProcessor):
    def __init__(self, whole: bool):
        self.whole = whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("waiting", WAITING)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        left, out = released(self.state.get(), [(r["seq_no"], r["seq_size"], r["payload"]) for r in rows], self.whole)
        yield from (Row(corr_id=key[0], seq_no=number, seq_size=size, payload=payload) for number, size, payload in out)
        if left is None:
            self.state.clear()
        else:
            self.state.update(left)

    def close(self) -> None:
        pass


class BucketResequencer(StatefulProcessor):
    """The groups of a hash bucket together; the state is what waits in them, as JSON."""

    def __init__(self, whole: bool):
        self.whole = whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("bucket", BUCKET)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        messages: dict = {}
        for frame in rows:
            for corr_id, *message in zip(*(plain(frame[c]) for c in ("corr_id", "seq_no", "seq_size", "payload"))):
                messages.setdefault(corr_id, []).append(message)
        known = self.state.get()
        groups = {g[0]: g[1:] for g in json.loads(known[0])} if known else {}
        out = []
        for corr_id, of_id in messages.items():
            left, gone = released(groups.pop(corr_id, None), of_id, self.whole)
            if left is not None:
                groups[corr_id] = left
            out += [(corr_id, *g) for g in gone]
        if groups:
            self.state.update((json.dumps([[i, *g] for i, g in groups.items()]),))
        else:
            self.state.clear()
        if out:
            yield pd.DataFrame(out, columns=["corr_id", "seq_no", "seq_size", "payload"], dtype=object)

    def close(self) -> None:
        pass


def stream_resequence(stream: DataFrame, key: str, seq_no: str, seq_size: str, payload: str, whole: bool = False,
                      buckets: int | None = None) -> DataFrame:
    """Messages numbered from 1 to their group's size, in order within each group; each number comes once.

    State is kept by group, or with ``buckets`` by so many hash buckets of groups; a restart must name the same number."""
    rows = stream.select(F.col(key).cast("string").alias("corr_id"), F.col(seq_no).cast("long").alias("seq_no"),
                         F.col(seq_size).cast("long").alias("seq_size"), F.col(payload).cast("string").alias("payload"))
    if buckets is not None:
        dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("corr_id"), F.lit(buckets)))
        return dealt.groupBy("bucket").transformWithStateInPandas(BucketResequencer(whole), ORDERED, "append", "none")
    return rows.groupBy("corr_id").transformWithState(Resequencer(whole), ORDERED, "append", "none")


def run_resequence(out: DataFrame, base: str) -> DataFrame:
    """Process what is there, from where the last run under ``base`` ended; return what has left so far."""
    spark = out.sparkSession
    with rocksdb_state(spark):
        q = (out.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start(f"{base}/out"))
        q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")

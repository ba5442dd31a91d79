"""Message groups as keyed state (M3, A4, A5): released at size, given up by a timer, late ones discarded.

Each correlation id has one value in the state store: the group that is
waiting (its declared size, its last arrival, its payloads) or, closed and
empty, the mark of an id whose group was released.  A micro-batch touches
the state of the ids it brings and nothing else: no earlier input is read, and
what is kept is the groups that are open and, until ``remember`` runs out, the
marks.  Timers are in event time, so a group without further messages is
given up when the watermark passes its last arrival by the timeout, and a mark
is forgotten in the same way.  A message that finds its group over the timeout
gives it up itself, so the outcome does not hang on when a timer fires.

The order of arrival is the stream's: batches one after another, and within a
batch the ``order`` column.  Rows behind the watermark would be dropped by the
engine; ``run_group_state`` raises when one was.

A call to the state store is a message to the JVM and back, so a value an id
costs several of these a message.  With ``buckets`` the ids of a hash bucket
share one value and one timer: a bucket is read and written once a
micro-batch, whatever the number of ids in it, and its messages come as pandas
frames.  The outcomes are the same.  The state of an untouched id of a touched
bucket is then read and written too, so this is for streams whose micro-batches
touch most ids, and for few micro-batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from flowframe.streaming.runner import plain, rocksdb_state

OUTCOME = "corr_id string, outcome string, seq long, payloads string"
GROUP = "closed boolean, size long, last long, payloads array<string>"
BUCKET = "timer long, groups string"
#: Stands for a null size, which no group reaches.
NEVER = 2**63 - 1


def settled(known: Sequence | None, messages: Sequence[tuple], timeout: int | None) -> tuple[tuple, list[tuple]]:
    """An id's state (a ``GROUP``) after its messages, and their outcomes without the id.

    ``messages`` are (size, at, payload) in the order of arrival."""
    if known and known[0]:
        return tuple(known), [("late", None, p) for _, _, p in messages]
    group, out = [known[1], known[2], list(known[3])] if known else None, []
    for n, (size, at, payload) in enumerate(messages):
        if group and timeout is not None and at > group[1] + timeout:
            out += given_up(group[2])
            group = None
        if group is None:
            group = [size, at, []]
        group[1] = at
        group[2].append(payload)
        if group[0] is not None and len(group[2]) >= group[0]:
            out.append(("released", group[0], " ".join("None" if p is None else p for p in group[2])))
            out += [("late", None, p) for _, _, p in messages[n + 1:]]
            return (True, group[0], at, []), out
    return (False, *group), out


def given_up(payloads: Sequence) -> list[tuple]:
    return [("discarded", None, p) for p in payloads]


def _rows(corr_id: str | None, outcomes: list[tuple]) -> Iterator[Row]:
    return (Row(corr_id=corr_id, outcome=what, seq=size, payloads=p) for what, size, p in outcomes)


class GroupProcessor(StatefulProcessor):
    """One id's messages against its state; times in milliseconds.

    An id has one timer at most: set when its state begins, and moved on when it fires early.
    """

    def __init__(self, timeout_ms: int | None = None, remember_ms: int | None = None):
        self.timeout, self.remember = timeout_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("group", GROUP)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.state.get()
        # of an id only the messages of one micro-batch are in hand
        messages = [(r["size"], r["at"], r["payload"]) for r in sorted(rows, key=lambda r: r["order"])]
        group, outcomes = settled(known, messages, self.timeout)
        yield from _rows(key[0], outcomes)
        if known and known[0]:
            return
        self.state.update(group)
        if group[0]:
            if self.remember is not None:
                self.handle.registerTimer(group[2] + self.remember)
        elif self.timeout is not None and not known:
            self.handle.registerTimer(group[2] + self.timeout)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.state.get()
        if not known:
            return
        wait = self.remember if known[0] else self.timeout
        if wait is None:
            return
        if known[2] + wait > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(known[2] + wait)
            return
        yield from _rows(key[0], given_up(known[3]))
        self.state.clear()

    def close(self) -> None:
        pass


class BucketProcessor(StatefulProcessor):
    """The messages of a hash bucket of ids against the bucket's state: its groups as JSON and the time of its one timer."""

    def __init__(self, timeout_ms: int | None = None, remember_ms: int | None = None):
        self.timeout, self.remember = timeout_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("bucket", BUCKET)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # of a bucket only the messages of one micro-batch are in hand
        frame = pd.concat(list(rows)).sort_values("order", kind="stable")
        messages: dict = {}
        for corr_id, *message in zip(*(plain(frame[c]) for c in ("corr_id", "size", "at", "payload"))):
            messages.setdefault(corr_id, []).append(message)
        timer, groups = self._known()
        out = []
        for corr_id, of_id in messages.items():
            groups[corr_id], outcomes = settled(groups.get(corr_id), of_id, self.timeout)
            out += [(corr_id, *o) for o in outcomes]
        self._keep(groups, timer)
        yield from _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, groups = self._known()
        clock, out = timerValues.getCurrentWatermarkInMs(), []
        for corr_id, group in [*groups.items()]:
            due = self._due(group)
            if due is not None and due <= clock:
                out += [(corr_id, *o) for o in given_up(groups.pop(corr_id)[3])]
        self._keep(groups, None)  # the engine removes the timer that fired
        yield from _frame(out)

    def close(self) -> None:
        pass

    def _known(self) -> tuple[int | None, dict]:
        known = self.state.get()
        return (known[0], {g[0]: g[1:] for g in json.loads(known[1])}) if known else (None, {})

    def _due(self, group: Sequence) -> int | None:
        wait = self.remember if group[0] else self.timeout
        return None if wait is None else group[2] + wait

    def _keep(self, groups: dict, timer: int | None) -> None:
        due = min((d for d in map(self._due, groups.values()) if d is not None), default=None)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if groups:
            self.state.update((due, json.dumps([[i, *g] for i, g in groups.items()])))
        else:
            self.state.clear()


def _frame(outcomes: list[tuple]) -> Iterator[pd.DataFrame]:
    if outcomes:
        yield pd.DataFrame(outcomes, columns=["corr_id", "outcome", "seq", "payloads"], dtype=object)


def group_state(stream: DataFrame, key: str, order: str, size_col: str, payload: str, arrival: Column,
                lateness: str, timeout_ms: int | None = None, remember_ms: int | None = None,
                buckets: int | None = None) -> DataFrame:
    """The outcomes of a stream of messages: a row per released list and per late or discarded message.

    ``arrival`` is a timestamp; messages come at most ``lateness`` behind the
    latest seen.  A null id is a group, a null size never releases.
    State is kept by id, or with ``buckets`` by so many hash buckets of ids; a
    restart must name the same number.
    """
    at = stream.select(
        F.col(key).cast("string").alias("corr_id"), F.col(order).alias("order"), F.col(size_col).cast("long").alias("size"),
        F.col(payload).cast("string").alias("payload"), arrival.alias("arrived"), F.unix_millis(arrival).alias("at"))
    at = at.withWatermark("arrived", lateness)
    if buckets is not None:
        dealt = at.withColumns({"bucket": F.pmod(F.xxhash64("corr_id"), F.lit(buckets)), "size": F.coalesce("size", F.lit(NEVER))})
        return dealt.groupBy("bucket").transformWithStateInPandas(BucketProcessor(timeout_ms, remember_ms), OUTCOME, "append", "eventTime")
    return at.groupBy("corr_id").transformWithState(
        GroupProcessor(timeout_ms, remember_ms), OUTCOME, "append", "eventTime")


def run_group_state(out: DataFrame, base: str) -> DataFrame:
    """Process what is there, from where the last run under ``base`` ended; return all outcomes so far."""
    spark = out.sparkSession
    with rocksdb_state(spark):
        q = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/_checkpoint")
             .trigger(availableNow=True).start(f"{base}/out"))
        q.awaitTermination()
    lost = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    if lost:
        raise ValueError(f"{lost} messages came further behind than the stream's lateness allows")
    return spark.read.schema(out.schema).parquet(f"{base}/out")

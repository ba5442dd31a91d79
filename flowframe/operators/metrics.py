"""Queries over labelled metric series: ``(metric, labels..., ts, value)``.

Every aggregate is a ``groupBy`` with map-side partial aggregation, so a
series or label value holding a large share of samples still combines
locally before the shuffle.  Latest-sample selection uses ``max_by``
(an aggregate), not a per-series window.  Counter steps need the previous
sample of the series; that comes from :func:`keyed_scan`, which stays
balanced when one series is hot.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.operators.sequence import keyed_scan
from flowframe.session import stage_table


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ A10 / A11
def metric_sum(df: DataFrame, by: Sequence[str] = (), value: str = "value", out: str = "value") -> DataFrame:
    """``sum(x) [by (...)]``."""
    return df.groupBy(*by).agg(F.sum(value).alias(out))


def metric_max_by(df: DataFrame, by: Sequence[str], value: str = "value", out: str = "value") -> DataFrame:
    """``max(x) by (...)``."""
    return df.groupBy(*by).agg(F.max(value).alias(out))


# ------------------------------------------------------------------ A14 / T1
def metric_instant(df: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value",
                   equals: dict[str, object] | None = None, matches: dict[str, str] | None = None,
                   at: object | None = None) -> DataFrame:
    """Latest sample per series (at or before ``at``) under label equality and
    fully anchored regex matches (``label=~"re"``)."""
    cond = F.lit(True)
    for k, v in (equals or {}).items():
        cond = cond & (F.col(k) == F.lit(v))
    for k, rx in (matches or {}).items():
        cond = cond & F.coalesce(F.col(k).cast("string").rlike(f"^(?:{rx})$"), F.lit(False))
    if at is not None:
        from flowframe.functions.scalar import ntz_literal

        cond = cond & (F.col(ts) <= (ntz_literal(at) if hasattr(at, "strftime") else F.lit(at)))
    sel = df.filter(cond)
    return sel.groupBy(*series).agg(
        F.max(ts).alias(ts),
        F.max_by(F.col(value), F.col(ts)).alias(value),
    )


def metric_topk(df: DataFrame, k: int, value: str = "value", tie: Sequence[str] = ()) -> DataFrame:
    """``topk(k, x)``: the k largest samples (ties broken by ``tie``); planned
    as TakeOrderedAndProject (per-partition top-k, then a k-row merge)."""
    return df.orderBy(F.col(value).desc(), *[F.col(t) for t in tie]).limit(k)


# ------------------------------------------------------------------ A12 / A13
def metric_delta(df: DataFrame, series: Sequence[str], range_: str, ts: str = "ts", value: str = "value") -> DataFrame:
    """``delta(x[range])`` per series and range bucket: last minus first
    sample in the bucket (no extrapolation to the bucket edges)."""
    return df.groupBy(*series, F.window(ts, range_).alias("w")).agg(
        (F.max_by(F.col(value), F.col(ts)) - F.min_by(F.col(value), F.col(ts))).alias("delta"),
        F.count(F.lit(1)).alias("samples"),
    ).select(*series, F.col("w.start").alias("bucket_start"), "delta", "samples")


def metric_rate(df: DataFrame, series: Sequence[str], range_seconds: int, ts: str = "ts", value: str = "value",
                sum_by: Sequence[str] | None = None) -> DataFrame:
    """``rate(x[range])`` per series and range bucket, counter-reset aware:
    each step is ``v - prev`` or ``v`` when the counter went down; the rate
    is the sum of steps over the range length (no extrapolation).  With
    ``sum_by`` the per-series rates are then summed by those labels."""
    b = df.select(*dict.fromkeys([*series, ts, value])).withColumn("bucket_start", F.window(ts, f"{int(range_seconds)} seconds").start)
    s = keyed_scan(b, list(series) + ["bucket_start"], [ts], lags=[value])
    prev = F.col("prev_" + value)
    step = F.when(prev.isNull(), F.lit(0.0)).when(F.col(value) < prev, F.col(value)).otherwise(F.col(value) - prev)
    per_series = s.groupBy(*series, "bucket_start").agg((F.sum(step) / F.lit(float(range_seconds))).alias("rate"))
    if sum_by is None:
        return per_series
    return per_series.groupBy(*sum_by, "bucket_start").agg(F.sum("rate").alias("rate"))


def metric_range(df: DataFrame, series: Sequence[str], range_seconds: int, step_seconds: int, kind: str = "rate",
                 ts: str = "ts", value: str = "value", start: Column | None = None, end: Column | None = None) -> DataFrame:
    """``rate``, ``increase`` or ``delta`` of ``x[range]`` at every step, extrapolated to the edges of the range:
    ``(series, step_ts, value, samples)``.

    Steps are the whole multiples of ``step_seconds`` from the epoch between
    ``start`` and ``end`` (the first and last sample); the range of a step is
    left-open, ``(step - range, step]``.  A step with fewer than two samples
    has no row.  Counter kinds count a fall of the value as a reset.

    Ranges overlap, yet no sample is copied into the steps that see it.  A
    step belongs to the last sample at or before it, so each result row comes
    of one sample, from its own time to the next sample's, as long as the
    sample before it is in range too.  What lies between the first and the
    last sample of a range is a difference of two prefix sums, and which
    sample is the first is an as-of question for ``step - range``: one ordered
    scan over samples and questions together counts the samples up to it.
    """
    from flowframe.functions.scalar import ntz_micros

    width, step = int(range_seconds) * 1_000_000, int(step_seconds) * 1_000_000
    counter = kind in ("rate", "increase")
    k = F.struct(F.lit(0).alias("_"), *series)
    flat = df.filter(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(
        k.alias("k"), ntz_micros(ts).alias("at"), F.col(value).cast("double").alias("v"))
    once = flat.groupBy("k", "at").agg(F.max("v").alias("v"))  # a series has one sample at a time
    edges = once.agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    lo = ntz_micros(start) if start is not None else edges.select("lo").scalar()
    hi = ntz_micros(end) if end is not None else edges.select("hi").scalar()
    s = keyed_scan(once, ["k"], ["at"], rn="n", lags=["at", "v"])
    moved = F.when(F.col("prev_v").isNull(), F.lit(0.0)).when(
        F.lit(counter) & (F.col("v") < F.col("prev_v")), F.col("v")).otherwise(F.col("v") - F.col("prev_v"))
    s = keyed_scan(s.withColumn("moved", moved), ["k"], ["at"], rn="_", sums={"grown": "moved"}).drop("_", "moved", "prev_v")
    s = stage_table(s, "samples")
    following = s.select("k", (F.col("n") - 1).alias("n"), F.col("at").alias("next_at"))
    first_step = F.ceil(F.greatest(F.col("at"), lo) / F.lit(step)) * step
    until = F.least(F.coalesce(F.col("next_at"), hi + 1), F.col("prev_at") + width, hi + 1)  # not at this time any more
    last_step = (F.ceil(until / F.lit(step)) - 1) * step
    seen = s.join(following, ["k", "n"], "left").filter(F.col("at") - F.col("prev_at") < width).withColumns(
        {"_a": first_step.cast("long"), "_b": last_step.cast("long")}).filter(F.col("_a") <= F.col("_b"))
    asked = seen.select("k", "n", "at", "grown", "v", F.explode(F.sequence("_a", "_b", F.lit(step).cast("long"))).alias("step"))
    both = asked.select("k", (F.col("step") - width).alias("x"), F.lit(0).alias("sample"), "n", "at", "grown", "v", "step").unionByName(
        s.select("k", F.col("at").alias("x"), F.lit(1).alias("sample"), F.lit(None).cast("int").alias("n"),
                 F.lit(None).cast("long").alias("at"), F.lit(None).cast("double").alias("grown"), F.lit(None).cast("double").alias("v"),
                 F.lit(None).cast("long").alias("step")))
    # the range is left-open: a sample at its very start is counted out, so samples go before questions
    counted = keyed_scan(both, ["k"], ["x", F.col("sample").desc()], rn="_", sums={"out": "sample"}).filter("sample = 0")
    head = s.select("k", F.col("n").alias("first_n"), F.col("at").alias("first_at"), F.col("v").alias("first_v"), F.col("grown").alias("first_grown"))
    w = counted.withColumn("first_n", (F.col("out") + 1).cast("long")).join(head.withColumn("first_n", F.col("first_n").cast("long")), ["k", "first_n"])
    grown = F.col("grown") - F.col("first_grown") if counter else F.col("v") - F.col("first_v")
    inside = (F.col("at") - F.col("first_at")).cast("double")
    mean = inside / (F.col("n") - F.col("first_n"))
    before = (F.col("first_at") - (F.col("step") - width)).cast("double")
    before = F.when(before >= mean * 1.1, mean / 2).otherwise(before)
    if counter:  # a counter cannot have been below zero
        to_zero = inside * (F.col("first_v") / F.col("_grown"))
        before = F.when((F.col("_grown") > 0) & (F.col("first_v") >= 0) & (to_zero < before), to_zero).otherwise(before)
    after = (F.col("step") - F.col("at")).cast("double")
    after = F.when(after >= mean * 1.1, mean / 2).otherwise(after)
    factor = (inside + before + after) / inside
    result = F.col("_grown") * factor / (F.lit(float(range_seconds)) if kind == "rate" else F.lit(1.0))
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return w.withColumn("_grown", grown).select(
        *[F.col(f"k.{c}").alias(c) for c in series], F.timestamp_add("MICROSECOND", F.col("step"), epoch).alias("step_ts"),
        result.alias("value"), (F.col("n") - F.col("first_n") + 1).cast("long").alias("samples"))


# ------------------------------------------------------------------ J1
def group_left_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_value: str, right_value: str,
                    sum_by: Sequence[str] = ()) -> DataFrame:
    """Many-to-one vector match: ``sum(left * 0 + on(labels) group_left right)``.

    Each left sample takes the value of the one right sample with the same
    labels; right labels that occur twice fail the query when a left sample
    matches them.  The join is left to the planner: AQE broadcasts the right
    side only when its measured size is under the broadcast threshold, and
    otherwise shuffles both sides on the labels."""
    again = F.concat(F.lit("many-to-one match: several right samples of "), F.to_json(F.struct(*on)))
    r = right.groupBy(*on).agg(F.max(right_value).alias("_rv"), F.count(F.lit(1)).alias("_many")).select(
        *on, F.when(F.col("_many") == 1, F.col("_rv")).otherwise(F.raise_error(again).cast(right.schema[right_value].dataType)).alias("_rv"))
    j = left.join(r, list(on), "inner")
    v = j.withColumn("value", F.col(left_value) * 0 + F.col("_rv"))
    return v.groupBy(*sum_by).agg(F.sum("value").alias("value"))


# ------------------------------------------------------------------ F5 / F6
def label_capture(col: Column | str, pattern: str, group: int = 1) -> Column:
    """Regex capture from label text (legend templates)."""
    return F.regexp_extract(_c(col), pattern, group)


@dataclass(frozen=True)
class RelabelRule:
    pattern: str
    name: str
    type: str
    labels: tuple[tuple[str, str], ...] = ()


# The JMX-to-metric relabel rules, in rule order (first match
# wins; the whole name must match; output names are lower-cased).
KAFKA_RELABEL_RULES: tuple[RelabelRule, ...] = (
    RelabelRule(r"kafka.server<type=(.+), name=(.+), clientId=(.+), topic=(.+), partition=(.*)><>Value",
                "kafka_server_$1_$2", "GAUGE", (("clientId", "$3"), ("topic", "$4"), ("partition", "$5"))),
    RelabelRule(r"kafka.server<type=(.+), name=(.+), clientId=(.+), brokerHost=(.+), brokerPort=(.+)><>Value",
                "kafka_server_$1_$2", "GAUGE", (("clientId", "$3"), ("broker", "$4:$5"))),
    RelabelRule(r"kafka.coordinator.(\w+)<type=(.+), name=(.+)><>Value", "kafka_coordinator_$1_$2_$3", "GAUGE"),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+)PerSec\w*, (.+)=(.+), (.+)=(.+)><>Count",
                "kafka_$1_$2_$3_total", "COUNTER", (("$4", "$5"), ("$6", "$7"))),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+)PerSec\w*, (.+)=(.+)><>Count", "kafka_$1_$2_$3_total", "COUNTER",
                (("$4", "$5"),)),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+)PerSec\w*><>Count", "kafka_$1_$2_$3_total", "COUNTER"),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.+), (.+)=(.+)><>Value", "kafka_$1_$2_$3", "GAUGE",
                (("$4", "$5"), ("$6", "$7"))),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.+)><>Value", "kafka_$1_$2_$3", "GAUGE", (("$4", "$5"),)),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+)><>Value", "kafka_$1_$2_$3", "GAUGE"),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.+), (.+)=(.+)><>Count", "kafka_$1_$2_$3_count", "COUNTER",
                (("$4", "$5"), ("$6", "$7"))),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.*), (.+)=(.+)><>(\d+)thPercentile", "kafka_$1_$2_$3", "GAUGE",
                (("$4", "$5"), ("$6", "$7"), ("quantile", "0.$8"))),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.+)><>Count", "kafka_$1_$2_$3_count", "COUNTER", (("$4", "$5"),)),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+), (.+)=(.*)><>(\d+)thPercentile", "kafka_$1_$2_$3", "GAUGE",
                (("$4", "$5"), ("quantile", "0.$6"))),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+)><>Count", "kafka_$1_$2_$3_count", "COUNTER"),
    RelabelRule(r"kafka.(\w+)<type=(.+), name=(.+)><>(\d+)thPercentile", "kafka_$1_$2_$3", "GAUGE", (("quantile", "0.$4"),)),
)


def metric_relabel(df: DataFrame, raw: str, rules: Sequence[RelabelRule] = KAFKA_RELABEL_RULES,
                   lowercase_name: bool = True, distinct_first: bool = True) -> DataFrame:
    """Apply the first matching rule: adds ``rule_no`` (1-based, null if none),
    ``name``, ``type`` and ``labels`` (map).  Templates use ``$n`` group
    references, applied with ``regexp_replace`` on the anchored pattern, so
    everything stays inside the JVM.

    The patterns backtrack heavily, and the distinct raw names are bounded
    by the metric catalog, not by the number of samples; so by default the
    rules run once per distinct name and the result is joined back (the
    planner broadcasts the small name table when its measured size allows)."""
    if not distinct_first:
        return _relabel(df, raw, rules, lowercase_name)
    names = _relabel(df.select(raw).distinct(), raw, rules, lowercase_name)
    return df.join(names, raw, "left")


def _relabel(df: DataFrame, raw: str, rules: Sequence[RelabelRule], lowercase_name: bool) -> DataFrame:
    r = F.col(raw)
    anchored = [f"^(?:{x.pattern})$" for x in rules]
    # a pattern that ends in plain text is tried only where that text ends the name
    ends = [re.search(r"[\w<>]*$", x.pattern)[0] for x in rules]
    rule_no = F.coalesce(*[F.when(r.endswith(e) & r.rlike(a) if e else r.rlike(a), F.lit(i + 1))
                           for i, (a, e) in enumerate(zip(anchored, ends))], F.lit(None).cast("int"))
    out = df.withColumn("rule_no", rule_no)

    def pick(fn):
        expr = F.lit(None).cast("string")
        for i in range(len(rules) - 1, -1, -1):
            expr = F.when(F.col("rule_no") == i + 1, fn(i)).otherwise(expr)
        return expr

    name = pick(lambda i: F.regexp_replace(r, anchored[i], rules[i].name))
    out = out.withColumn("name", F.lower(name) if lowercase_name else name)
    out = out.withColumn("type", pick(lambda i: F.lit(rules[i].type)))

    def labels(i):
        ls = rules[i].labels
        if not ls:
            return F.create_map().cast("map<string,string>")
        keys = F.array(*[F.regexp_replace(r, anchored[i], k) for k, _ in ls])
        vals = F.array(*[F.regexp_replace(r, anchored[i], v) for _, v in ls])
        return F.map_from_arrays(keys, vals)

    lab = F.lit(None).cast("map<string,string>")
    for i in range(len(rules) - 1, -1, -1):
        lab = F.when(F.col("rule_no") == i + 1, labels(i)).otherwise(lab)
    return out.withColumn("labels", lab)

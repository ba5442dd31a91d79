"""Joins the flows need beyond plain equi-joins: the as-of gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.operators.sequence import keyed_scan


def asof_gate(events: DataFrame, controls: DataFrame, keys: Sequence[str], ts: str, flag: str,
              on_value: object = True, initial_on: bool = True, id_col: str | None = None) -> DataFrame:
    """Keep an event when the latest control row of its key at or before it
    says "on" (a control at the same instant applies).  Keys with no
    control yet use ``initial_on``.

    As-of without a range join: controls and events are merged in one
    ordered per-key scan; the running count of controls gives each event
    the sequence number of the control in force, and an equi-join on
    (key, control number) fetches its flag.  A control followed by a huge
    run of events is a skewed join key, which AQE splits.
    """
    keys = list(keys)
    ev_cols = [x for x in events.columns]
    pre = {x: "_e_" + x for x in ev_cols}
    c = controls.select(*keys, F.col(ts).alias("_ts"), F.col(flag).alias("_flag")).withColumn("_is_ctl", F.lit(1))
    e = events.select(*keys, F.col(ts).alias("_ts"), *[F.col(x).alias(pre[x]) for x in ev_cols]).withColumn("_is_ctl", F.lit(0))
    u = c.unionByName(e, allowMissingColumns=True)
    # controls sort before events at the same instant
    order = [F.col("_ts"), F.col("_is_ctl").desc()] + ([F.col(pre[id_col])] if id_col else []) + [F.col("_flag")]
    s = keyed_scan(u, keys, order, sums={"_ctl_no": "_is_ctl"})
    ctl = s.filter(F.col("_is_ctl") == 1).select(*[F.col(k).alias("_k_" + k) for k in keys], F.col("_ctl_no").alias("_n"), "_flag")
    ev = s.filter(F.col("_is_ctl") == 0).select(*keys, "_ctl_no", *pre.values())
    cond = [ev[k].eqNullSafe(ctl["_k_" + k]) for k in keys] + [ev["_ctl_no"] == ctl["_n"]]
    j = ev.join(ctl, cond, "left")
    on = F.when(F.col("_ctl_no") == 0, F.lit(initial_on)).otherwise(F.coalesce(F.col("_flag") == F.lit(on_value), F.lit(False)))
    return j.filter(on).select(*[F.col(pre[x]).alias(x) for x in ev_cols])

"""Retry, recovery and error routing with attempts as rows and policy as data.

A retry template sleeps between tries; a Spark job must not.  Here a
policy describes which attempts are allowed and when; a schedule is the
exploded list of allowed attempts; an attempt log is evaluated per
message into succeeded / due (with ``next_attempt_at``) / exhausted, and a
replay job picks what is due.

Attempt ``k`` (1-based) of a policy happens at ideal offset ``T_k`` (sum
of the back-offs before it).  It is allowed when ``k <= max_attempts``
(the count includes the first try) and ``T_k < timeout`` (strict: real
work takes time, so reaching the limit exactly already ends it).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.operators.delay import ms_interval
from flowframe.operators.sequence import keyed_scan


@dataclass(frozen=True)
class RetryPolicy:
    name: str
    max_attempts: int | None = None  # simple policy (includes the first try)
    timeout_ms: int | None = None  # timeout policy
    backoff: str = "fixed"  # fixed | exponential | none
    period_ms: int = 1000
    initial_ms: int = 100
    max_interval_ms: int = 30000
    multiplier: float = 2.0
    never: bool = False  # no retry: one attempt only

    def wait_before(self, k: Column) -> Column:
        """Back-off slept after attempt ``k`` (1-based) fails."""
        if self.backoff == "none":
            return F.lit(0).cast("long")
        if self.backoff == "fixed":
            return F.lit(self.period_ms).cast("long")
        raw = F.lit(float(self.initial_ms)) * F.pow(F.lit(float(self.multiplier)), k - 1)
        return F.least(raw, F.lit(float(self.max_interval_ms))).cast("long")

    def offset(self, k: Column) -> Column:
        """Ideal offset of attempt ``k`` from the first try (ms)."""
        # sequence(1, k) is ascending for k >= 1; back-offs of attempts 1..k-1
        return F.aggregate(F.sequence(F.lit(1), k), F.lit(0).cast("long"),
                           lambda acc, j: acc + F.when(j < k, self.wait_before(j)).otherwise(F.lit(0).cast("long")))

    def allowed(self, k: Column, offset: Column) -> Column:
        if self.never:
            return k <= 1
        cond = F.lit(True)
        if self.max_attempts is not None:
            cond = cond & (k <= F.lit(self.max_attempts))
        if self.timeout_ms is not None:
            cond = cond & (offset < F.lit(self.timeout_ms))
        return cond

    def attempt_bound(self) -> int:
        """An upper bound on allowed attempts, to size the schedule."""
        if self.never:
            return 1
        bounds = []
        if self.max_attempts is not None:
            bounds.append(self.max_attempts)
        if self.timeout_ms is not None:
            smallest = {"fixed": self.period_ms, "exponential": self.initial_ms, "none": 0}[self.backoff]
            if smallest <= 0:
                raise ValueError("a timeout-only policy needs a positive back-off")
            bounds.append(self.timeout_ms // smallest + 1)
        if not bounds:
            raise ValueError(f"policy {self.name} allows unbounded attempts")
        return int(min(bounds))


# The retry policies of the reference flows.
FIXED_5X2S = RetryPolicy("simple5_fixed2s", max_attempts=5, backoff="fixed", period_ms=2000)
EXP_2_10 = dict(backoff="exponential", initial_ms=2000, max_interval_ms=10000, multiplier=2.0)
EXP_5 = RetryPolicy("simple5_exp", max_attempts=5, **EXP_2_10)
TIMEOUT_45S_EXP = RetryPolicy("timeout45s_exp", timeout_ms=45000, **EXP_2_10)
COMPOSITE_3_10S_FIXED1S = RetryPolicy("simple3_timeout10s_fixed1s", max_attempts=3, timeout_ms=10000, backoff="fixed", period_ms=1000)
COMPOSITE_3_10S_FIXED5S = RetryPolicy("simple3_timeout10s_fixed5s", max_attempts=3, timeout_ms=10000, backoff="fixed", period_ms=5000)
BY_CLASS = {
    "java.nio.file.FileSystemAlreadyExistsException": RetryPolicy("timeout60s_exp", timeout_ms=60000, **EXP_2_10),
    "java.nio.file.FileSystemNotFoundException": RetryPolicy("simple5_exp", max_attempts=5, **EXP_2_10),
}
NO_RETRY = RetryPolicy("never", never=True)


def retry_schedule(df: DataFrame, policy: RetryPolicy, start: str | None = None) -> DataFrame:
    """One row per allowed attempt: ``attempt_no`` (1-based), ``offset_ms``
    from the first try, ``wait_before_ms``; with ``start`` also ``attempt_at``."""
    n = policy.attempt_bound()
    s = df.withColumn("attempt_no", F.explode(F.sequence(F.lit(1), F.lit(n))))
    s = s.withColumn("offset_ms", policy.offset(F.col("attempt_no")))
    s = s.filter(policy.allowed(F.col("attempt_no"), F.col("offset_ms")))
    s = s.withColumn("wait_before_ms", F.when(F.col("attempt_no") == 1, F.lit(0)).otherwise(policy.wait_before(F.col("attempt_no") - 1)).cast("long"))
    if start is not None:
        s = s.withColumn("attempt_at", F.col(start) + ms_interval(F.col("offset_ms")))
    return s


def allowed_attempts(policy: RetryPolicy) -> int:
    """How many attempts the policy allows in total (closed form on the driver)."""
    total, k, t = 0, 1, 0
    bound = policy.attempt_bound()
    while k <= bound:
        if policy.never and k > 1:
            break
        if policy.max_attempts is not None and k > policy.max_attempts:
            break
        if policy.timeout_ms is not None and t >= policy.timeout_ms:
            break
        total += 1
        if policy.backoff == "fixed":
            t += policy.period_ms
        elif policy.backoff == "exponential":
            t += int(min(policy.initial_ms * policy.multiplier ** (k - 1), policy.max_interval_ms))
        k += 1
    return total


def policy_table(spark, by_class: dict[str, RetryPolicy], default: RetryPolicy = NO_RETRY) -> DataFrame:
    """``(error_class, policy, allowed_attempts, first_wait_ms)``; the
    default policy is keyed by a null class."""
    rows = [(c, p.name, allowed_attempts(p)) for c, p in by_class.items()]
    rows.append((None, default.name, allowed_attempts(default)))
    return spark.createDataFrame(rows, "error_class string, policy string, allowed_attempts int")


def retry_by_class(attempts: DataFrame, class_col: str, by_class: dict[str, RetryPolicy],
                   default: RetryPolicy = NO_RETRY) -> DataFrame:
    """Attach the policy of each attempt's error class (unlisted -> default).

    The policy table has one row per listed class, a size fixed by the
    configuration (not by the data), so broadcasting it is safe."""
    pol = policy_table(attempts.sparkSession, by_class, default)
    listed = pol.filter(F.col("error_class").isNotNull())
    j = attempts.join(F.broadcast(listed.withColumnRenamed("error_class", "_cls")), F.col(class_col) == F.col("_cls"), "left").drop("_cls")
    return j.withColumn("policy", F.coalesce(F.col("policy"), F.lit(default.name))).withColumn(
        "allowed_attempts", F.coalesce(F.col("allowed_attempts"), F.lit(allowed_attempts(default))))


def attempt_number(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "retry_count") -> DataFrame:
    """Retry count 0, 1, 2 ... per message in attempt order (skew-safe)."""
    return keyed_scan(df, list(keys), order, rn="_rn").withColumn(out, F.col("_rn") - 1).drop("_rn")


def retry_status(attempts: DataFrame, key: str, ts: str, ok_col: str, policy: RetryPolicy,
                 order: Sequence[str] | None = None) -> DataFrame:
    """Evaluate an attempt log per message.

    An attempt counts when the policy allowed it: by its number, and by the
    time the log shows between the first attempt and it.  Attempts after the
    first success do not count.  Result per message: ``outcome`` (succeeded /
    exhausted / due), ``attempts`` used, ``first_at`` and ``last_at`` of the
    counted attempts, ``last_error`` / ``last_error_class`` of the last
    counted failure, and ``next_attempt_at`` for due messages.  A message is
    exhausted when the policy allows no next attempt: none left, or the next
    one would start at the time limit or later.  Everything is a per-key
    aggregate (map-side combined) on the numbered log.
    """
    num = keyed_scan(attempts, [key], list(order or [ts]), rn="attempt_no", firsts=[ts])
    most = 1 if policy.never else policy.max_attempts
    counts = F.lit(True)
    if most is not None:
        counts &= F.col("attempt_no") <= F.lit(most)
    if policy.timeout_ms is not None and not policy.never:
        counts &= F.col(ts) < F.col(f"first_{ts}") + ms_interval(F.lit(policy.timeout_ms))
    agg = num.filter(counts).groupBy(key).agg(
        F.min(F.when(F.col(ok_col), F.col("attempt_no"))).alias("first_ok"),
        F.max("attempt_no").alias("n_seen"),
        F.min_by(ts, "attempt_no").alias("first_at"),
        F.min_by(ts, F.when(F.col(ok_col), F.col("attempt_no"))).alias("_ok_at"),
        F.max_by(ts, "attempt_no").alias("_seen_at"),
        F.max_by(F.struct("error_class", "error_message"), F.when(~F.col(ok_col), F.col("attempt_no"))).alias("_last_err"),
    )
    out = agg.withColumn("attempts", F.coalesce("first_ok", "n_seen").cast("long")).withColumn(
        "last_at", F.coalesce("_ok_at", "_seen_at"))
    out = out.withColumn("_next", F.col("last_at") + ms_interval(policy.wait_before(F.col("attempts"))))
    ended = F.lit(False)
    if most is not None:
        ended |= F.col("n_seen") >= F.lit(most)
    if policy.timeout_ms is not None and not policy.never:
        ended |= F.col("_next") >= F.col("first_at") + ms_interval(F.lit(policy.timeout_ms))
    outcome = F.when(F.col("first_ok").isNotNull(), F.lit("succeeded")).when(ended, F.lit("exhausted")).otherwise(F.lit("due"))
    out = out.withColumn("outcome", outcome).withColumn("next_attempt_at", F.when(F.col("outcome") == "due", F.col("_next")))
    return out.select(key, "outcome", "attempts", "first_at", "last_at", "next_attempt_at",
                      F.when(F.col("outcome") != "succeeded", F.col("_last_err.error_class")).alias("last_error_class"),
                      F.when(F.col("outcome") != "succeeded", F.col("_last_err.error_message")).alias("last_error"))


def recover_value(status: DataFrame, payload: str, out: str = "payload", flag: str = "recovered") -> DataFrame:
    """When retries are exhausted the payload becomes the error text and a
    flag column is set (the error route then picks flagged rows)."""
    ex = F.col("outcome") == "exhausted"
    return status.withColumn(out, F.when(ex, F.col("last_error")).otherwise(F.col(payload))).withColumn(flag, ex)


# The success and failure texts of the outcome advice.
SUCCESS_SUFFIX = " の処理に成功しました。"
FAILURE_INFIX = " の処理に失敗しました ( "


def outcome_messages(df: DataFrame, ok_col: str, payload: str, error_class: str, error_message: str) -> DataFrame:
    """Success / failure expressions: ``channel`` and ``text`` per message.
    Success: ``<payload> の処理に成功しました。``; failure:
    ``<payload> の処理に失敗しました ( <class>, <cause message> )``."""
    ok = F.coalesce(F.col(ok_col), F.lit(False))
    p = F.col(payload).cast("string")
    fail = F.concat(p, F.lit(FAILURE_INFIX), F.coalesce(F.col(error_class), F.lit("null")), F.lit(", "),
                    F.coalesce(F.col(error_message), F.lit("null")), F.lit(" )"))
    return df.withColumn("channel", F.when(ok, F.lit("success")).otherwise(F.lit("failure"))).withColumn(
        "text", F.when(ok, F.concat(p, F.lit(SUCCESS_SUFFIX))).otherwise(fail))


def dead_letter(status: DataFrame, key: str, now: Column, alert_to: str, subject: str) -> DataFrame:
    """Dead-letter rows for messages that did not succeed: error text, alert
    recipient and subject; ``replay_due`` marks rows a replay job takes now."""
    dl = status.filter(F.col("outcome") != "succeeded")
    return dl.select(
        key, "outcome", "last_error_class", "last_error", "next_attempt_at",
        F.lit(alert_to).alias("mail_to"), F.lit(subject).alias("subject"),
        ((F.col("outcome") == "due") & F.coalesce(F.col("next_attempt_at") <= now, F.lit(False))).alias("replay_due"),
    )

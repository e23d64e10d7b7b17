"""Retry plans, throttled dispatch and idempotent submission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.backoff import POLICY_ATTEMPTS, policy_offsets_minutes
from orderloom.operators.scan import Chunks, greedy_spacing

RETENTION_SECONDS = 2 * 86400
THROTTLE_GAP_SECONDS = 2
_MICROS = 1_000_000


def retry_schedule(first_failures: DataFrame, attempts: int = POLICY_ATTEMPTS) -> DataFrame:
    """All attempt times of a task under the retry policy, from ``first_failure_time``.

    The policy is a constant, so its offsets are literals: no window and no shuffle.
    """
    offsets = policy_offsets_minutes(attempts)
    plan = F.array(*[F.lit(m) for m in offsets])
    last = len(offsets) - 1
    return (
        first_failures
        .select("*", F.posexplode(plan).alias("_k", "offset_minutes"))
        .withColumn("attempt", F.col("_k") + 1)
        .withColumn("attempt_at", F.timestamp_micros(
            F.unix_micros("first_failure_time") + F.col("offset_minutes").cast("long") * 60 * _MICROS))
        .withColumn("next_state", F.when(F.col("_k") == last, "paused").otherwise("retry"))
        .drop("_k")
    )


def throttle_schedule(requests: DataFrame, key: str | None = None, gap_seconds: int = THROTTLE_GAP_SECONDS,
                      arrival: str = "submitted_at", tie: str = "seq", width: int | None = None) -> DataFrame:
    """Dispatch time when requests of a key (or all of them) pass one by one, ``gap`` apart.

    d_i = max(arrival_i, d_{i-1}) + gap unrolls to gap*(n+1) + max over j<=n of (arrival_j - gap*j),
    a running count and a running maximum, which chunks combine without a serial pass.
    """
    gap = gap_seconds * _MICROS
    keys = [key] if key else []
    ch = Chunks(requests.withColumn("_at", F.unix_micros(arrival)), keys, ["_at", tie], width)
    numbered = ch.rows.withColumn("_n", F.row_number().over(ch.window()).cast("long") - 1)
    slack = numbered.withColumn("_slack", F.col("_at") - F.lit(gap) * F.col("_n"))
    local = slack.withColumn("_most", F.max("_slack").over(ch.so_far()))

    carried = (ch.summaries(slack, rows=F.count(F.lit(1)), most=F.max("_slack"))
               .withColumn("_c", F.coalesce(F.sum("rows").over(ch.earlier()), F.lit(0)))
               .withColumn("_m", F.max(F.col("most") - F.lit(gap) * F.col("_c")).over(ch.earlier()))
               .drop("rows", "most"))
    before = F.coalesce("_c", F.lit(0))
    dispatch = (F.lit(gap) * (before + F.col("_n") + 1)
                + F.greatest(F.col("_m"), F.col("_most") - F.lit(gap) * before))
    return (ch.attach(local, carried)
            .withColumn("dispatch_at", F.timestamp_micros(dispatch))
            .select(*requests.columns, "dispatch_at"))


def idempotent_requests(requests: DataFrame, retention_seconds: int = RETENTION_SECONDS,
                        id_col: str = "task_id", at: str = "submitted_at", tie: str = "seq") -> DataFrame:
    """Drop a request whose id was accepted less than ``retention`` before.

    Retention counts from the last accepted submission. Requests without an id all stay out:
    they are rejected before this step.
    """
    stamped = requests.where(F.col(id_col).isNotNull()).withColumn("_at", F.unix_micros(at))
    accepted = greedy_spacing(stamped, [id_col], "_at", retention_seconds * _MICROS)
    kept = stamped.join(accepted, [id_col, "_at"], "left_semi")  # before whole rows are aggregated
    return (kept.groupBy(id_col, "_at").agg(F.min_by(F.struct(*requests.columns), F.col(tie)).alias("_row"))
            .select("_row.*"))


# --- task state from the attempts log ---------------------------------------------------------

def _weight(manual: str | None) -> Column:
    """A failed attempt counts once, and once more if it was started by hand."""
    return F.lit(1) if manual is None else F.when(F.col(manual), 2).otherwise(1)


def retry_count(attempts: DataFrame, task: str = "task_id", at: str = "attempt_at", tie: str = "seq",
                manual: str | None = None, width: int | None = None) -> DataFrame:
    """Per attempt: failures of the task since its last success, this attempt included.

    ``attempts`` carries ``success BOOLEAN``. With a running failure total T this is T minus the
    largest T seen at a success, so it needs one running sum and one running maximum.
    """
    ch = Chunks(attempts, [task], [at, tie], width)
    failed = F.when(F.col("success"), 0).otherwise(_weight(manual)).cast("long")
    total = ch.rows.withColumn("_t", F.sum(failed).over(ch.so_far()))
    at_success = F.when(F.col("success"), F.col("_t"))
    local = total.withColumn("_base", F.max(at_success).over(ch.so_far()))
    carried = (ch.summaries(total, fails=F.sum(failed), base=F.max(at_success))
               .withColumn("_c", F.coalesce(F.sum("fails").over(ch.earlier()), F.lit(0)))
               .withColumn("_b", F.max(F.col("base") + F.col("_c")).over(ch.earlier()))
               .drop("fails", "base"))
    before = F.coalesce("_c", F.lit(0))
    base = F.coalesce(F.greatest(F.col("_b"), F.col("_base") + before), F.lit(0))
    return (ch.attach(local, carried)
            .withColumn("retry_count", before + F.col("_t") - base)
            .select(*attempts.columns, "retry_count"))


def task_status(attempts: DataFrame, task: str = "task_id", at: str = "attempt_at", tie: str = "seq",
                manual: str | None = None) -> DataFrame:
    """Current state of tasks that still fail: count since the last success and the last reply.

    A task whose last attempt succeeded has no state. Aggregations combine before the shuffle.
    """
    order = F.struct(at, tie)
    successes = (attempts.where("success").groupBy(F.col(task).alias("_task"))
                 .agg(F.max(order).alias("_cleared")))
    reply = F.struct(F.col(at).alias("last_attempt_at"), "status_code", "body", "error")
    return (
        attempts.where(~F.col("success"))
        .join(successes, F.col(task) == F.col("_task"), "left")
        .where(F.col("_cleared").isNull() | (order > F.col("_cleared")))
        .groupBy(task)
        .agg(F.lit("needs_retry").alias("detail"), F.sum(_weight(manual)).cast("long").alias("retry_count"),
             F.max_by(reply, order).alias("_last"))
        .select(task, "detail", "retry_count", "_last.*")
    )

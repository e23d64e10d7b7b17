"""Stateful operators on unbounded input.

Everything runs on event time: rows of a key are taken in time order and timers fire between
them, so one large micro-batch and many small ones give the same result for input that arrives in
order. Rows older than the watermark take no part; the jobs below up to the digests return them with ``late`` set, and
``run_available`` keeps them apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.backoff import (
    CONSTANT_SECONDS, EXPONENTIAL_BASE_SECONDS, EXPONENTIAL_CAP_SECONDS, EXPONENTIAL_MAX_POWER, POLICY_ATTEMPTS,
    POLICY_CAP_MINUTES, POLICY_FACTOR, POLICY_FIRST_MINUTES,
)
from orderloom.operators import ledger as L
from orderloom.operators import replies as R
from orderloom.operators.digest import DIGEST_DELAY_SECONDS
from orderloom.operators.schedule import RETENTION_SECONDS
from orderloom.schema import LINE_KEY
from orderloom.session import fresh_path, materialize
from orderloom.streaming.processors import MICROS, Accept, Daily, Debounce, Expire, Fold, Retry, Totals
from orderloom.streaming.sinks import BATCH, LATE, BucketedTable, exists, run_available, run_batches, version_path, versions


def _fold(rows: DataFrame, key: str, at: str, lateness: str, columns: dict[str, Column], processor: Fold, out: str) -> DataFrame:
    """A processor over the rows of each key. The time goes in as a number, so that the processor sees late rows too."""
    return (rows.withWatermark(at, lateness)
            .select(key, F.unix_micros(at).alias("us"), *[c.alias(n) for n, c in columns.items()])
            .groupBy(key).transformWithStateInPandas(processor, f"{out}, {LATE} boolean", "append", "EventTime"))


# --- idempotent submission --------------------------------------------------------------------

def stream_idempotent(requests: DataFrame, retention_seconds: int = RETENTION_SECONDS,
                      lateness: str = "0 seconds", exact: bool = True) -> DataFrame:
    """Drop requests whose id was accepted less than the retention before.

    ``requests``: seq, task_id, submitted_at. ``exact=False`` uses the built-in deduplication,
    which stays in the JVM but forgets an id only when the watermark says so, and doesn't return late rows.
    """
    marked = requests.where("task_id IS NOT NULL")
    if not exact:
        return (marked.withWatermark("submitted_at", f"{retention_seconds} seconds")
                .dropDuplicatesWithinWatermark(["task_id"]))
    return (_fold(marked, "task_id", "submitted_at", lateness, {"seq": F.col("seq")}, Accept(retention_seconds * MICROS),
                  "task_id string, seq long, us long")
            .select("task_id", "seq", F.timestamp_micros("us").alias("submitted_at"), LATE))


# --- retry state ------------------------------------------------------------------------------

def _delay_seconds(count: int, mode: str) -> int | None:
    """Seconds to the next retry after ``count`` failures; None when the policy pauses the task."""
    if mode == "constant":
        return CONSTANT_SECONDS
    if mode == "policy":
        if count >= POLICY_ATTEMPTS:
            return None
        doublings = min(count - 1, POLICY_CAP_MINUTES.bit_length())
        return 60 * min(POLICY_CAP_MINUTES, POLICY_FIRST_MINUTES * POLICY_FACTOR ** doublings)
    return min(EXPONENTIAL_CAP_SECONDS, EXPONENTIAL_BASE_SECONDS * 2 ** min(count, EXPONENTIAL_MAX_POWER))


def stream_retry_state(attempts: DataFrame, mode: str = "exponential", lateness: str = "0 seconds") -> DataFrame:
    """Per attempt the task's new state; a ``retry_due`` row when a retry falls due unanswered.

    ``attempts``: task_id, attempt_at, attempt_no, success, and, where the log has it, ``event``: ``submitted`` makes a task
    ``pending``, ``started`` makes it ``running``, ``finished`` (or NULL) is an attempt's end. ``mode``: exponential, constant, or
    policy: doubling delays up to a day, and ``paused`` after the last attempt that the policy allows. A late attempt has no state.
    """
    if "event" not in attempts.columns:
        attempts = attempts.withColumn("event", F.lit("finished"))
    columns = {c: F.col(c) for c in ("attempt_no", "event", "success")}
    return (_fold(attempts, "task_id", "attempt_at", lateness, columns, Retry(partial(_delay_seconds, mode=mode)),
                  "task_id string, attempt_no long, state string, us long, retry_count long, next_us long")
            .select("task_id", "attempt_no", "state", F.timestamp_micros("us").alias("at"), "retry_count",
                    F.timestamp_micros("next_us").alias("next_retry_at"), LATE))


# --- digests ----------------------------------------------------------------------------------

def _thin(minute_micros: int = 60 * MICROS):
    """First and last sighting of a code per key and minute, combined before the shuffle.

    A digest is sent at most once in a minute, so the first stands for all sightings before the
    send and the last for all after it. A hot key shrinks to its distinct codes. ``n``: sightings that a row stands for.
    """
    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if rows.empty:
                continue
            slots = rows.groupby(["key", "code", rows["us"] // minute_micros], sort=False, dropna=False)["us"]
            ends = slots.agg(["idxmin", "idxmax", "size"])
            two = ends["idxmin"] != ends["idxmax"]
            first, last = rows.loc[ends["idxmin"]], rows.loc[ends["idxmax"][two]]
            yield pd.concat([first.assign(n=ends["size"].where(~two, 1).to_numpy()), last.assign(n=ends["size"][two].to_numpy() - 1)])
    return combine


def stream_daily_digest(events: DataFrame, delay_seconds: int = DIGEST_DELAY_SECONDS,
                        lateness: str = "0 seconds") -> DataFrame:
    """One digest a day per key, ``delay`` after the day's first codes; one row per code.

    ``events``: key, ts, codes. Unlike the batch form a window may run past midnight, with the
    consequences that has: codes of the new day go out with the old timer, and the new day's own
    timer can then send again. ``delay`` counts in whole minutes. A late row has its own time as
    ``send_at`` and as ``n_codes`` the sightings of the code in its minute that it stands for.
    """
    if delay_seconds % 60:
        raise ValueError("the digest delay must be whole minutes")
    seen = (events
            .select("key", "ts", F.unix_micros("ts").alias("us"), F.unix_date(F.to_date("ts")).alias("day"), F.explode("codes").alias("code"))
            .select("key", "us", "day", "code", "ts")
            .mapInPandas(_thin(), "key string, us long, day int, code string, ts timestamp, n long"))
    return (_fold(seen, "key", "ts", lateness, {c: F.col(c) for c in ("code", "day", "n")}, Daily(delay_seconds * MICROS),
                  "key string, day int, us long, n_codes long, code string")
            .select("key", F.date_from_unix_date("day").alias("digest_date"), F.timestamp_micros("us").alias("send_at"),
                    "n_codes", "code", LATE))


def stream_debounced_digest(events: DataFrame, delay_seconds: int, lateness: str = "0 seconds") -> DataFrame:
    """Submits open windows, codes wait for the end of one. One row per sent code.

    ``events``: key, ts, tie, code; a NULL code is a submit. A late event has its own time as ``send_at`` and no position.
    """
    return (_fold(events, "key", "ts", lateness, {"tie": F.col("tie"), "code": F.col("code")}, Debounce(delay_seconds * MICROS),
                  "key string, us long, position long, code string")
            .select("key", F.timestamp_micros("us").alias("send_at"), "position", "code", LATE))


# --- tables kept up to date -------------------------------------------------------------------

def _parts_of_days(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per day of a batch of rows, before the shuffle."""
    for rows in batches:
        if not rows.empty:
            yield rows.groupby(["day", "day_end"], as_index=False).agg(
                completed=("completed", "sum"), failed=("failed", "sum"), last=("last", "max"), n=("last", "size"), at=("at", "max"))


def stream_daily_stats(attempts: DataFrame, at: str = "attempt_at", lateness: str = "2 days") -> DataFrame:
    """Running daily statistics, a row whenever a day changes; run in update mode. Attempts without a time are left out.

    ``n`` counts the attempts in a row. Those of a day that was over by the watermark don't count; their rows have ``late`` set.
    """
    day, yes = F.to_date(at), F.col("success")
    parts = (attempts.where(F.col(at).isNotNull())
             .select(F.unix_date(day).alias("day"), F.unix_micros(F.date_add(day, 1).cast("timestamp")).alias("day_end"),
                     F.coalesce(yes, F.lit(False)).cast("int").alias("completed"), F.coalesce(~yes, F.lit(False)).cast("int").alias("failed"),
                     F.unix_micros(at).alias("last"), F.col(at).alias("at"))
             .mapInPandas(_parts_of_days, "day int, day_end long, completed long, failed long, last long, n long, at timestamp"))
    return (parts.withWatermark("at", lateness).drop("at").groupBy("day")
            .transformWithStateInPandas(Totals(), f"day int, completed long, failed long, last long, n long, {LATE} boolean", "update", "EventTime")
            .select(F.date_from_unix_date("day").alias("stat_date"), F.col("completed").alias("completed_tasks"),
                    F.col("failed").alias("failed_tasks"), F.timestamp_micros("last").alias("last_updated"), "n", LATE))


def run_daily_stats(attempts: DataFrame, root: str | None = None) -> DataFrame:
    """Runs the statistics over all input at hand; the last word per date stands.

    The result's attribute ``late`` has, per date, the attempts that came after its day was closed: stat_date, completed_tasks,
    failed_tasks, last_updated, n.
    """
    root = root or fresh_path(attempts.sparkSession, "daily-stats")
    stats = stream_daily_stats(attempts)
    run_batches(stats, root, lambda batch, batch_id: batch.write.mode("overwrite").parquet(version_path(root, batch_id)), mode="update")
    spark = attempts.sparkSession
    schema = T.StructType([*stats.schema.fields, T.StructField(BATCH, T.LongType())])
    if exists(spark, versions(root)):
        # one read of a table partitioned by batch, however many batches there were
        every = spark.read.schema(schema).option("basePath", versions(root)).parquet(versions(root))
    else:
        every = spark.createDataFrame([], schema)
    kept = ("completed_tasks", "failed_tasks", "last_updated")
    result = (every.where(~F.col(LATE)).groupBy("stat_date").agg(F.max_by(F.struct(*kept), BATCH).alias("_s")).select("stat_date", "_s.*"))
    result.late = (every.where(LATE).groupBy("stat_date")
                   .agg(*[F.sum(c).alias(c) for c in kept[:2]], F.max("last_updated").alias("last_updated"), F.sum("n").alias("n")))
    return result


#: What tells a ledger line apart, but for its time: equal lines expire together.
_LINE = [*LINE_KEY, "line_hash"]
#: Time in a key of the retention's state, and how many keys share it.
SLOT_MICROS, SHARDS = 86_400 * MICROS, 16


def _with_line(orders: DataFrame) -> DataFrame:
    return orders.withColumn("line_hash", F.xxhash64(*orders.columns)).withColumn("us", F.unix_micros("updated_at"))


def _last_tick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        if not rows.empty:
            yield rows[rows["clock"] == rows["clock"].max()].head(1)


def stream_retention(lines: DataFrame, ticks: DataFrame, days: int = L.RETENTION_DAYS) -> DataFrame:
    """The ledger lines whose retention ends, as it ends: order_id, product_code, imei, line_hash, us.

    ``lines``: ledger rows as they come. ``ticks`` carry the current time in ``now``; nothing else moves the clock. Retrying lines wait in the
    state store until their time to live is over, so expiry reads and rewrites no table. Lines of one day and one of ``SHARDS``
    share a key of the state, so that its timers grow with the days and not with the lines.
    """
    names = [*_LINE, "us"]
    # no number here is null: a null among them would turn them into floats on the way
    waiting = (_with_line(lines.where("status = 'needs_retry' AND updated_at IS NOT NULL"))
               .select(F.timestamp_micros(F.lit(0)).alias("clock"), F.floor(F.col("us") / SLOT_MICROS).cast("long").alias("slot"),
                       F.pmod("line_hash", F.lit(SHARDS)).cast("int").alias("shard"), *names))
    clock = ticks.where("now IS NOT NULL").select(
        F.col("now").cast("timestamp").alias("clock"), F.lit(0).cast("long").alias("slot"), F.lit(SHARDS).alias("shard"),
        *[F.lit(None).cast("string").alias(c) for c in LINE_KEY], *[F.lit(0).cast("long").alias(c) for c in ("line_hash", "us")])
    both = waiting.unionByName(clock.mapInPandas(_last_tick, clock.schema))
    return (both.withWatermark("clock", "0 seconds").drop("clock").groupBy("slot", "shard")  # without the clock no line counts as late
            .transformWithStateInPandas(Expire(days * 86_400 * MICROS, names, SHARDS),
                                        ", ".join(f"{c} string" for c in LINE_KEY) + ", line_hash long, us long", "append", "EventTime"))


def run_retention(lines: DataFrame, ticks: DataFrame, orders: DataFrame, days: int = L.RETENTION_DAYS, root: str | None = None) -> DataFrame:
    """``orders`` without the lines that expired by the last tick. ``lines`` is the stream of its rows. The expired lines are appended to a
    table of their own under ``root``, which the result leaves out when it is read; they are in its attribute ``expired``."""
    expired = run_available(stream_retention(lines, ticks, days), "retention", root=root)
    gone = expired.select(*[F.col(c).alias(f"_{c}") for c in (*_LINE, "us")]).distinct()
    same = F.lit(True)
    for c in (*_LINE, "us"):
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    result = _with_line(orders).join(gone, same & (F.col("status") == "needs_retry"), "left_anti").select(*orders.columns)
    result.expired = expired
    return result


def _stale(table: BucketedTable, now, days: int, batch_id: int) -> DataFrame:
    """The orders that stood before the batch with expired lines."""
    return table.read(batch_id).where(L.expired_rows(now, days)).select("order_id").distinct()


def run_ledger(attempts: DataFrame, flatten: Callable[[DataFrame], DataFrame], orders: DataFrame,
               retention_days: int | None = None, root: str | None = None) -> DataFrame:
    """Keeps the ledger over a stream of attempts and returns its last version.

    Each micro-batch replays its failures and deliveries on the rows of its own orders and writes
    those only; a repeated batch overwrites its own files. ``attempts``: task_id, attempt_at,
    attempt_no, status_code, body, error. ``flatten`` turns failing attempts into ledger lines
    with ``attempt_no`` and ``pos``. With ``retention_days`` every batch also drops rows that
    expired by its latest attempt. ``orders`` is where the ledger starts, if ``root`` has none yet.
    """
    root = root or fresh_path(attempts.sparkSession, "ledger")
    table = BucketedTable(root, orders, "order_id")

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch = materialize(batch, "ledger-batch")
        changed = batch.select(F.col("task_id").alias("order_id")).distinct()
        if retention_days is not None:
            latest = F.lit(batch.agg(F.max("attempt_at")).first()[0])
            changed = materialize(changed.unionByName(_stale(table, latest, retention_days, batch_id)).distinct(), "ledger-changed")
        failed = R.classify_http("status_code")
        deliveries = batch.where(~failed).select(F.col("task_id").alias("order_id"), "attempt_at", "attempt_no")
        failing = L.after_last_delivery(batch.where(failed), deliveries)
        rows = L.ledger_replay(flatten(failing), deliveries, table.read(batch_id, changed)).select(*orders.columns)
        if retention_days is not None:
            rows = L.cleanup_expired(rows, latest, retention_days)
        table.write(rows, changed, batch_id)

    run_batches(attempts, root, step)
    return table.read()


def run_cleanup(ticks: DataFrame, orders: DataFrame, days: int = L.RETENTION_DAYS, root: str | None = None) -> DataFrame:
    """Drops expired rows on every tick of a stream that carries the current time in ``now``; only the orders that lose rows are written."""
    root = root or fresh_path(ticks.sparkSession, "cleanup")
    table = BucketedTable(root, orders, "order_id")

    def step(batch: DataFrame, batch_id: int) -> None:
        latest = batch.agg(F.max("now")).first()[0]
        if latest is not None:
            stale = materialize(_stale(table, F.lit(latest), days, batch_id), "stale")
            if not stale.isEmpty():
                table.write(L.cleanup_expired(table.read(batch_id, stale), F.lit(latest), days), stale, batch_id)

    run_batches(ticks, root, step)
    return table.read()

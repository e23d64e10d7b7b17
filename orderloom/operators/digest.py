"""Digests of missing codes, one row per (digest, code) so that no digest is one huge value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.scan import greedy_spacing, next_mark, row_numbers, running_sum
from orderloom.session import materialize

DIGEST_DELAY_SECONDS = 20 * 60
_MICROS = 1_000_000


def daily_digest(events: DataFrame, delay_seconds: int = DIGEST_DELAY_SECONDS) -> DataFrame:
    """The day's first codes open a window; at its end all distinct codes seen so far go out.

    ``events``: key, ts, codes. Later codes of the day are not sent. A window is cut at midnight.
    First sightings are aggregated per code before anything else meets.
    """
    seen = (events.select("key", "ts", F.to_date("ts").alias("digest_date"), F.explode("codes").alias("code"))
            .groupBy("key", "digest_date", "code").agg(F.min("ts").alias("first_seen")))
    seen = materialize(seen, "first-seen")  # read three times below
    opened = seen.groupBy("key", "digest_date").agg(F.min("first_seen").alias("_opened"))
    send_at = F.timestamp_micros(F.unix_micros("_opened") + F.lit(delay_seconds * _MICROS))
    sent = (seen.join(opened, ["key", "digest_date"]).withColumn("send_at", send_at)
            .where("first_seen < send_at").select("key", "digest_date", "send_at", "code"))
    sizes = sent.groupBy("key", "digest_date").agg(F.count(F.lit(1)).alias("n_codes"))
    return (sent.join(sizes, ["key", "digest_date"])
            .select("key", "digest_date", "send_at", "n_codes", "code"))


def digest_event_status(events: DataFrame, delay_seconds: int = DIGEST_DELAY_SECONDS,
                        tie: str = "event_id") -> DataFrame:
    """What each event was answered: no_codes, scheduled, accumulating or accumulated_no_email.

    With the running number of distinct codes held; it restarts after the day's digest went out.
    """
    events = events.withColumn("_day", F.to_date("ts"))
    filled = events.where(F.size("codes") > 0)
    opened = (filled.groupBy("key", "_day").agg(F.min(F.struct("ts", tie)).alias("_open")))
    sent = F.unix_micros("ts") >= F.unix_micros("_open.ts") + F.lit(delay_seconds * _MICROS)
    phased = (filled.join(opened, ["key", "_day"])
              .withColumn("_after", sent.cast("int"))
              .withColumn("status", F.when(F.col("_after") == 1, "accumulated_no_email")
                          .when(F.col(tie) == F.col(f"_open.{tie}"), "scheduled").otherwise("accumulating")))
    firsts = (phased.select("key", "_day", "_after", "ts", tie, F.explode("codes").alias("_code"))
              .groupBy("key", "_day", "_after", "_code").agg(F.min(F.struct("ts", tie)).alias("_f"))
              .groupBy("key", F.col(f"_f.{tie}").alias(tie)).agg(F.count(F.lit(1)).alias("_new")))
    counted = running_sum(phased.join(firsts, ["key", tie], "left"), ["key", "_day", "_after"], ["ts", tie],
                          F.coalesce("_new", F.lit(0)), "accumulated_count")
    answer = counted.select("key", "ts", tie, "status", "accumulated_count")
    silent = events.where(~(F.size("codes") > 0) | F.col("codes").isNull()).select(
        "key", "ts", tie, F.lit("no_codes").alias("status"), F.lit(0).cast("long").alias("accumulated_count"))
    return answer.unionByName(silent)


def debounced_digest(submits: DataFrame, codes: DataFrame, delay_seconds: int) -> DataFrame:
    """A submit opens a window unless one is open; at its end all codes so far go out, first seen first.

    ``submits``: key, ts. ``codes``: key, ts, tie, code. Codes that no window end follows stay unsent.
    """
    delay = delay_seconds * _MICROS
    opened = greedy_spacing(submits.select("key", F.unix_micros("ts").alias("_at")), ["key"], "_at", delay)
    ends = opened.select("key", (F.col("_at") + F.lit(delay)).alias("_at"))
    seen = codes.select("key", F.unix_micros("ts").alias("_at"), "tie", "code")
    sent = next_mark(seen, ends, ["key"], "_at", "_end", inclusive=False).where("_end IS NOT NULL")
    firsts = (sent.groupBy("key", "_end", "code").agg(F.min(F.struct("_at", "tie")).alias("_f"))
              .select("key", "_end", "code", F.col("_f._at").alias("_seen"), F.col("_f.tie").alias("_tie")))
    placed = row_numbers(firsts, ["key", "_end"], ["_seen", "_tie", "code"], "position")
    return placed.select("key", F.timestamp_micros("_end").alias("send_at"), "position", "code",
                         F.timestamp_micros("_seen").alias("first_seen"))

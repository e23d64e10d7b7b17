"""Retry delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operating constants of the delivery service (fixed values).
EXPONENTIAL_BASE_SECONDS = 5
EXPONENTIAL_CAP_SECONDS = 300
EXPONENTIAL_MAX_POWER = 6
CONSTANT_SECONDS = 300
POLICY_FIRST_MINUTES = 15
POLICY_FACTOR = 2
POLICY_CAP_MINUTES = 24 * 60
POLICY_ATTEMPTS = 100


def backoff_seconds(n, mode: str = "exponential") -> Column:
    n = F.col(n) if isinstance(n, str) else n
    if mode == "constant":
        return F.lit(CONSTANT_SECONDS).cast("long") + n * 0
    if mode != "exponential":
        raise ValueError(f"unknown backoff mode {mode!r}")
    power = F.least(n, F.lit(EXPONENTIAL_MAX_POWER)).cast("int")
    return F.least(
        F.lit(EXPONENTIAL_CAP_SECONDS).cast("long"),
        F.lit(EXPONENTIAL_BASE_SECONDS).cast("long") * F.pow(F.lit(2.0), power).cast("long"),
    )


def policy_offsets_minutes(attempts: int = POLICY_ATTEMPTS) -> list[int]:
    """Minutes from the first call to attempt 1..n under the capped doubling policy."""
    offsets, gap = [0], POLICY_FIRST_MINUTES
    while len(offsets) < attempts:
        offsets.append(offsets[-1] + gap)
        gap = min(gap * POLICY_FACTOR, POLICY_CAP_MINUTES)
    return offsets

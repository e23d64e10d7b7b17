"""Shuffle rows into shards with a Feistel permutation over row numbers.

Row numbers 0..n-1 (by doc_id, then text) are permuted by an alternating Feistel network on the
product of two ranges, both about the root of n; a value outside 0..n-1 goes through the network again
(cycle walking), so the map is a permutation of 0..n-1. Permuted place p lies in shard ``p mod shards`` at
slot ``p div shards``: sizes differ by one row at most and slots have no gaps. Anyone who knows n, the
seed and a row number can compute its shard and slot, and from these the row number (``row_number_at``), without a shuffle.

Only DataFrame functions are used. Defined results: a null text has size 1 and the crc of no bytes; rows with a null
doc_id are numbered first; equal rows are numbered in any order, which changes nothing that can be seen but
their shards; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.workspace import Workspace, positions

ROUNDS = 6


def grid(n: int) -> tuple[int, int]:
    """Two range sizes near the root of ``n`` whose product is at least ``n`` and as little above it as can be."""
    root = max(1, math.isqrt(n))
    left = np.arange(max(1, root // 2), 2 * root + 1, dtype=np.int64)
    slack = -n % left
    best = int(left[np.argmin(slack)])
    return best, max(1, -(-n // best))


def _mix(half: Column, round_no: int, seed: int, modulus: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed).cast("long"), F.lit(round_no), half), F.lit(modulus).cast("long"))


def _round(i: int, left: int, right: int, seed: int):
    def step(h: Column) -> Column:
        l, r = h["l"], h["r"]
        if i % 2:
            return F.struct(l.alias("l"), ((r + _mix(l, i, seed, right)) % right).alias("r"))
        return F.struct(((l + _mix(r, i, seed, left)) % left).alias("l"), r.alias("r"))
    return step


def network(value: Column, left: int, right: int, seed: int, rounds: int = ROUNDS) -> Column:
    """One pass over 0..left*right-1: rounds in turn add a hash of one half to the other half."""
    halves = F.struct((value % left).alias("l"), F.floor(value / left).cast("long").alias("r"))
    for i in range(rounds):
        halves = F.transform(F.array(halves), _round(i, left, right, seed))[0]
    return F.transform(F.array(halves), lambda h: h["l"] + h["r"] * left)[0]


def _back(i: int, left: int, right: int, seed: int):
    def step(h: Column) -> Column:
        l, r = h["l"], h["r"]
        if i % 2:
            return F.struct(l.alias("l"), F.pmod(r - _mix(l, i, seed, right), F.lit(right).cast("long")).alias("r"))
        return F.struct(F.pmod(l - _mix(r, i, seed, left), F.lit(left).cast("long")).alias("l"), r.alias("r"))
    return step


def network_back(value: Column, left: int, right: int, seed: int, rounds: int = ROUNDS) -> Column:
    """The value that one pass takes to ``value``: the rounds backwards, each subtracting what it added."""
    halves = F.struct((value % left).alias("l"), F.floor(value / left).cast("long").alias("r"))
    for i in reversed(range(rounds)):
        halves = F.transform(F.array(halves), _back(i, left, right, seed))[0]
    return F.transform(F.array(halves), lambda h: h["l"] + h["r"] * left)[0]


def permuted(row_number: Column, n: int, seed: int = 0) -> Column:
    """The place of a row number under the permutation of 0..n-1.

    The values outside 0..n-1 that one walk can meet are all different, so it ends within as many
    steps as the grid has such values; ``grid`` keeps them very few.
    """
    left, right = grid(n)
    steps = F.sequence(F.lit(0), F.lit(left * right - n))
    return F.aggregate(steps, network(row_number, left, right, seed),
                       lambda at, _: F.when(at < n, at).otherwise(network(at, left, right, seed)))


def row_number_at(shard: Column, slot: Column, n: int, shards: int, seed: int = 0) -> Column:
    """The row number that ``permuted`` puts at a shard and slot: the same walk backwards."""
    left, right = grid(n)
    steps = F.sequence(F.lit(0), F.lit(left * right - n))
    place = slot.cast("long") * shards + shard
    return F.aggregate(steps, network_back(place, left, right, seed),
                       lambda at, _: F.when(at < n, at).otherwise(network_back(at, left, right, seed)))


def shard_rows(rows: DataFrame, order: list[str], shards: int, seed: int = 0, ws: Workspace | None = None) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``; ``order`` fixes the row numbers."""
    ws = ws or Workspace(rows.sparkSession, "sharding")
    numbered = positions(ws, rows, order, "_row", "numbered")
    n = rows.sparkSession.read.parquet(numbered.stored_at).count()
    at = permuted(F.col("_row"), max(1, n), seed)
    return (numbered.withColumn("_place", at).withColumn("shard", (F.col("_place") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("_place") / shards).cast("long")).drop("_row", "_place"))


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: not a law of this method) per document.

    Only these few columns are shuffled, not the texts: doc_id decides the row number and, where it repeats, size and crc.
    """
    slim = docs.select(F.col("doc_id").cast("long"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return shard_rows(slim, ["doc_id", "size", "text_crc32"], shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

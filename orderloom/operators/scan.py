"""Running values and greedy chains over ordered keys, safe for hot keys.

A plain ``Window.partitionBy(key)`` puts all rows of one key into one task. Here the rows are
range-partitioned on (key, order) instead, so a hot key spreads over many chunks. Each chunk is
scanned on its own; what it hands to later chunks of the same key is one summary row. A key can
only span chunks across a chunk border, so the summaries that matter are at most two per border,
which is the proven bound that allows broadcasting them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from orderloom.session import materialize, shuffle_width

CHUNK = "_chunk"


class Chunks:
    """Rows split into ordered chunks. ``order`` must end in columns that break ties."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], width: int | None = None):
        self.keys, self.order = list(keys), list(order)
        width = width or shuffle_width(df.sparkSession)
        ranged = df.repartitionByRange(width, *self.keys, *self.order)
        # Written out because range borders are sampled: the chunk of a row must not change
        # between the two reads below or after a lost executor.
        self.rows = materialize(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")

    def window(self) -> WindowSpec:
        return Window.partitionBy(CHUNK, *self.keys).orderBy(*self.order)

    def so_far(self) -> WindowSpec:
        return self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def before(self) -> WindowSpec:
        return self.window().rowsBetween(Window.unboundedPreceding, -1)

    def onward(self) -> WindowSpec:
        """The current row and all after it, as a running frame over the reverse order.

        A frame that ends at the last row would be evaluated anew for every row; this one grows row by row.
        """
        back = [F.col(c).desc() for c in self.order]
        return Window.partitionBy(CHUNK, *self.keys).orderBy(*back).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def summaries(self, scanned: DataFrame, **aggs: Column) -> DataFrame:
        """One row per (chunk, key) for keys that cross a chunk border; few rows by construction."""
        per_chunk = scanned.groupBy(CHUNK, *self.keys).agg(*[c.alias(n) for n, c in aggs.items()])
        everywhere = Window.partitionBy(*self.keys) if self.keys else Window.partitionBy(F.lit(0))
        return (per_chunk.withColumn("_spread", F.count(F.lit(1)).over(everywhere))
                .where("_spread > 1").drop("_spread"))

    def earlier(self) -> WindowSpec:
        return self._across().rowsBetween(Window.unboundedPreceding, -1)

    def later(self) -> WindowSpec:
        return self._across().rowsBetween(1, Window.unboundedFollowing)

    def _across(self) -> WindowSpec:
        spec = Window.partitionBy(*self.keys) if self.keys else Window.partitionBy(F.lit(0))
        return spec.orderBy(CHUNK)

    def attach(self, scanned: DataFrame, carried: DataFrame) -> DataFrame:
        """Bring the carried values to the rows; NULL where the key starts in this chunk."""
        renamed = carried.select(
            F.col(CHUNK).alias("_cc"), *[F.col(k).alias(f"_k_{k}") for k in self.keys],
            *[c for c in carried.columns if c != CHUNK and c not in self.keys])
        match = F.col(CHUNK) == F.col("_cc")
        for k in self.keys:
            match &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return (scanned.join(F.broadcast(renamed), match, "left")
                .drop("_cc", *[f"_k_{k}" for k in self.keys]))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str,
                width: int | None = None) -> DataFrame:
    """``sum(value)`` over all rows of the key up to and including the current one."""
    ch = Chunks(df.withColumn("_v", value.cast("long")), keys, order, width)
    local = ch.rows.withColumn("_local", F.sum("_v").over(ch.so_far()))
    carried = ch.summaries(ch.rows, total=F.sum("_v"))
    carried = carried.withColumn("_carry", F.sum("total").over(ch.earlier())).drop("total")
    return (ch.attach(local, carried)
            .withColumn(name, F.col("_local") + F.coalesce("_carry", F.lit(0)))
            .drop("_v", "_local", "_carry", CHUNK))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
                width: int | None = None) -> DataFrame:
    return running_sum(df, keys, order, F.lit(1), name, width)


def next_mark(events: DataFrame, marks: DataFrame, keys: Sequence[str], at: str, name: str,
              inclusive: bool = True, width: int | None = None) -> DataFrame:
    """For each event the earliest mark of its key at or after (or strictly after) it.

    ``at`` is a LONG instant in both inputs; event columns other than keys and ``at`` are kept.
    """
    rest = [c for c in events.columns if c not in (*keys, at)]
    tagged = events.select(*keys, at, F.lit(0 if inclusive else 1).alias("_side"), F.lit(True).alias("_event"),
                           F.struct(*rest).alias("_rest") if rest else F.lit(0).alias("_rest"))
    others = marks.select(*keys, at, F.lit(1 if inclusive else 0).alias("_side"), F.lit(False).alias("_event"))
    both = tagged.unionByName(others, allowMissingColumns=True)
    tie = ["_rest"] if rest else []
    ch = Chunks(both, keys, [at, "_side", *tie], width)
    mark = F.when(~F.col("_event"), F.col(at))
    local = ch.rows.withColumn("_near", F.min(mark).over(ch.onward()))
    carried = ch.summaries(ch.rows, first=F.min(mark))
    carried = carried.withColumn("_far", F.min("first").over(ch.later())).drop("first")
    return (ch.attach(local, carried).where("_event")
            .select(*keys, at, *[F.col(f"_rest.{c}").alias(c) for c in rest],
                    F.coalesce("_near", "_far").alias(name)))


def greedy_spacing(points: DataFrame, keys: Sequence[str], at: str, gap: int,
                   width: int | None = None) -> DataFrame:
    """Instants that stay when each kept one hides the key's instants in the next ``gap``.

    ``at`` is a LONG instant. The rule is sequential per key (keep the first; then keep the first
    at or after last kept + gap; ...), so it is solved by pointer doubling: every instant points
    to the one kept next if it were kept itself. An instant with nothing in the ``gap`` before it
    is kept in any case and starts a chain; chains are followed in log2(length) joins on
    (key, instant), unique on one side, so a hot key spreads over its instants.
    """
    keys = list(keys)
    both = points.select(*keys, at).distinct().select(*keys, F.inline(F.array(
        F.struct((F.col(at) + F.lit(gap)).alias(at), F.lit(0).alias("_side")),
        F.struct(F.col(at).alias(at), F.lit(1).alias("_side")))))
    ch = Chunks(both, keys, [at, "_side"], width)
    mark = F.when(F.col("_side") == 1, F.col(at))
    local = (ch.rows
             .withColumn("_prev", F.max(mark).over(ch.before()))
             .withColumn("_next", F.min(mark).over(ch.onward())))
    carried = ch.summaries(ch.rows, first=F.min(mark), last=F.max(mark))
    carried = carried.select(
        CHUNK, *keys, F.max("last").over(ch.earlier()).alias("_prev0"), F.min("first").over(ch.later()).alias("_next0"))
    scanned = ch.attach(local, carried).select(
        *keys, at, "_side", F.coalesce("_prev", "_prev0").alias("_prev"), F.coalesce("_next", "_next0").alias("_next"))
    scanned = materialize(scanned, "neighbours")

    chain_start = F.col("_prev").isNull() | (F.col(at) - F.col("_prev") >= gap)
    kept = scanned.where((F.col("_side") == 1) & chain_start).select(*keys, at)

    # A pointer to a chain start is dropped: that start is in the result already.
    hop_needed = F.col("_next").isNotNull() & (F.col("_next") - F.col("_prev") < gap)
    hop = materialize(
        scanned.where((F.col("_side") == 0) & hop_needed)
        .select(*keys, (F.col(at) - F.lit(gap)).alias(at), F.col("_next").alias("_to")), "hops")
    hops = []
    while not hop.isEmpty():
        hops.append(hop)
        onward = hop.select(*keys, F.col(at).alias("_to"), F.col("_to").alias("_to2"))
        hop = materialize(
            hop.join(onward, [*keys, "_to"]).select(*keys, at, F.col("_to2").alias("_to")), "hops")
    for hop in reversed(hops):
        kept = (kept.join(hop, [*keys, at], "left")
                .select(*keys, F.explode(F.array_compact(F.array(at, "_to"))).alias(at)))
    return kept.distinct()

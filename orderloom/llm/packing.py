"""Pack documents into as few sequences of a fixed token capacity as the method can.

Lengths are whole numbers from 1 to the capacity, so an instance of any size is its histogram, of at
most ``capacity`` rows. That histogram alone comes to the driver, where the packing is worked out
for whole runs of equal pieces: first Martello-Toth dominance reduction fixes small sets, then best fit
(longest first) places what is left. The plan says, for runs of ranks within a length, which
sequences they go to and where; the plan grows with the capacity and not with the documents. Each piece
then finds its place from its rank among the pieces of its length.

Defined results: a null or empty text is one piece with the end id; only documents over the capacity are
cut, the first piece takes the remainder and all others are full; rows with equal or null ``doc_id``
are documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.encoding import encoder, text_groups
from orderloom.llm.workspace import Workspace, positions

CAPACITY = 1024
END_ID = 2


@dataclass(frozen=True)
class Run:
    """Pieces of ``length`` with ranks from ``rank``: ``each`` of them go to each of ``bins`` sequences from
    ``sequence`` on, from place ``offset``."""

    length: int
    rank: int
    bins: int
    each: int
    sequence: int
    offset: int


class _Plan:
    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {n: c for n, c in histogram.items() if c}
        self.sizes = sorted(self.left)
        self.taken = dict.fromkeys(histogram, 0)
        self.runs: list[Run] = []
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges of sequences (first, count)
        self.rooms: list[int] = []

    def place(self, length: int, bins: int, each: int, sequence: int, offset: int) -> None:
        self.runs.append(Run(length, self.taken[length], bins, each, sequence, offset))
        self.taken[length] += bins * each
        self.left[length] -= bins * each
        if not self.left[length]:
            self.sizes.remove(length)

    def fix(self, pair: tuple[int, ...], bins: int) -> None:
        """Close ``bins`` sequences, each holding this set."""
        offset = 0
        for length in pair:
            self.place(length, bins, 1, self.sequences, offset)
            offset += length
        self.sequences += bins

    def reduce(self) -> int:
        """Fix sets that dominate every other set with their longest piece; returns how many sequences they close.

        With j a piece left, longest first, and r the room beside it: {j} if nothing but itself fits; {j, k} with k the longest
        that fits if k fills the room exactly, or if no two pieces fit (then any other choice is one piece no
        longer than k). An exchange argument shows some best packing holds such a set.
        """
        start = self.sequences
        open_sizes = sorted(self.sizes, reverse=True)
        for j in open_sizes:
            while self.left.get(j):
                room, count = self.capacity - j, self.left[j]
                fitting = bisect.bisect_right(self.sizes, room)
                alone = fitting == 1 and self.sizes[0] == j and count == 1
                if not fitting or alone:
                    self.fix((j,), 1 if alone else count)
                    continue
                k = self.sizes[fitting - 1]
                if k == j and count == 1:
                    k = self.sizes[fitting - 2]
                smallest = self.sizes[0]
                second = smallest if self.left[smallest] - (smallest == j) > 1 else (
                    self.sizes[1] if len(self.sizes) > 1 else room + 1)
                if k == room or smallest + second > room:
                    self.fix((j, k), count // 2 if k == j else min(count, self.left[k]))
                    continue
                break  # j stays for best fit; a shorter one may still be fixed with its exact complement
        return self.sequences - start

    def _keep(self, room: int, first: int, count: int) -> None:
        if room and count:
            if room not in self.open:
                self.open[room] = []
                bisect.insort(self.rooms, room)
            self.open[room].append((first, count))

    def best_fit(self) -> None:
        for length in sorted(self.sizes, reverse=True):
            while self.left[length]:
                at = bisect.bisect_left(self.rooms, length)
                if at < len(self.rooms):
                    room = self.rooms[at]
                    first, bins = self.open[room].pop()
                    if not self.open[room]:
                        del self.open[room], self.rooms[at]
                else:
                    room, first, bins = self.capacity, self.sequences, self.left[length]
                each = min(room // length, self.left[length])
                full = min(bins, self.left[length] // each)
                if room == self.capacity:
                    self.sequences += full
                else:
                    self._keep(room, first + full, bins - full)
                self.place(length, full, each, first, self.capacity - room)
                self._keep(room - each * length, first, full)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int, int]:
    """Runs, number of sequences, and how many of them the reduction closed."""
    plan = _Plan(histogram, capacity)
    fixed = plan.reduce()
    plan.best_fit()
    return plan.runs, plan.sequences, fixed


def pack(pieces: DataFrame, capacity: int = CAPACITY, ws: Workspace | None = None) -> DataFrame:
    """``pieces`` (doc_id, piece, length, and more columns) with ``sequence_id`` and ``offset``."""
    ws = ws or Workspace(pieces.sparkSession, "packing")
    order = ["length", *[c for c in ("doc_id", "piece") if c in pieces.columns]]
    numbered = positions(ws, pieces, order, "_at_all", "by-length")
    histogram = {r["length"]: r["n"] for r in numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _, _ = plan_packing(histogram, capacity)
    starts, before = {}, 0
    for length in sorted(histogram):
        starts[length] = before
        before += histogram[length]
    # By first global position: pieces are numbered by length, and runs of a length follow each other.
    runs = sorted(runs, key=lambda r: (r.length, r.rank))
    table = np.array([(starts[r.length] + r.rank, r.each, r.sequence, r.offset) for r in runs], np.int64).reshape(-1, 4)
    kept = [f for f in numbered.schema.fields if f.name not in ("_at_all", "_at", "_p", "_before")]
    out = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    plan = pieces.sparkSession.sparkContext.broadcast(table)

    def placed(batches):
        plan_rows = plan.value
        for batch in batches:
            at = batch.column("_at_all").to_numpy()
            run = plan_rows[np.searchsorted(plan_rows[:, 0], at, side="right") - 1]
            step = at - run[:, 0]
            length = batch.column("length").to_numpy()
            columns = {f.name: batch.column(f.name) for f in kept}
            columns["sequence_id"] = pa.array(run[:, 2] + step // run[:, 1])
            columns["offset"] = pa.array(run[:, 3] + (step % run[:, 1]) * length)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return numbered.mapInArrow(placed, out)


PIECE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def cut_lengths(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: the first takes the remainder."""
    first = n % capacity or capacity
    yield 0, min(first, n)
    for start in range(first, n, capacity):
        yield start, capacity


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Encode every text, add the end id and cut: doc_id, piece, start, length, ids_crc32."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(PIECE)

    def pieces(batches):
        ids_of, end = encoder(tokenizer), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in text_groups(texts):
                made = [[], [], [], [], []]
                for doc_id, ids in zip(doc_ids[a:b], ids_of.encode(texts[a:b])):
                    ids = memoryview(ids + end)
                    for i, (start, length) in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        for column, value in zip(made, (doc_id, i, start, length,
                                                        zlib.crc32(ids[start * 4:(start + length) * 4]))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECE)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents, in pieces, with their sequence and their place in it."""
    ws = Workspace(docs.sparkSession, "packing")
    # stored first: ranging samples its input, which would encode everything a second time
    return pack(ws.store(token_pieces(docs, tokenizer, capacity), "pieces"), capacity, ws)

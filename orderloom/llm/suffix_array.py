"""Remove byte strings that occur anywhere else, by suffix arrays with two-stage sorting.

Windows of ``width`` bytes travel as runs that share a minimizer (``sequences``); equal windows meet in one minimizer's
bucket. Equal runs collapse to one text with a flag for whether it is there more than once, since all its windows repeat then. The
texts of each bucket that holds different runs go, bucket by bucket, into blocks. A block's suffixes are sorted in two stages:
only suffixes smaller than their successor are sorted directly, the rest is induced by one scan over the
buckets of first bytes. Neighbours in the order with a common prefix of ``width`` bytes or more are repeats.

A bucket with very many different runs would be more than one block. Its runs are cut into shorter ones of neighbouring
windows, bucketed anew by the bytes that all of these share, which are nearly a whole window; equal ones collapse again. What is left
of such a bucket that is still too large (the edges of a passage that very many documents have) is counted window by window.

Defined results: null and empty texts, and texts under ``width`` bytes, lose nothing. Rows with equal or null doc_id are
documents of their own, so of two equal rows both lose all they have, if they are long enough. An empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.debruijn import RUNS, run_batches
from orderloom.llm.sequences import Hashes, all_runs, byte_values, mix
from orderloom.llm.workspace import Workspace, unused

WIDTH = 400
K = 64
#: Bytes that 51 words have at least in 99 of 100 places of the four languages: repeats of this length are reported as passages.
PASSAGE, PASSAGE_K = 240, 48
#: Different runs of one minimizer up to which they are sorted in one block.
CROWD = 1024
#: Windows at most in a shorter run of a crowded bucket.
STEP = 32
#: Bytes of text in a block, unless one bucket has more.
BLOCK = 1 << 19
#: Stands for a null doc_id in joins.
NO_ID = -(1 << 63)


def ascending(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one counts as smaller."""
    n = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    at = np.searchsorted(differs, np.arange(n))
    up = np.ones(n, bool)
    known = at < len(differs)
    turn = differs[at[known]]
    up[known] = text[turn] < text[turn + 1]
    return up


class Prefixes:
    """Common prefixes of suffixes of ``text`` up to ``depth``, by hashes and binary search. A zero ends a suffix."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth = depth
        values = mix(text.astype(np.uint64) + np.uint64(1))
        self._hash = Hashes(values)
        zeros = np.flatnonzero(text == 0)
        self.room = zeros[np.searchsorted(zeros, np.arange(len(text)))] - np.arange(len(text))

    def common(self, a: np.ndarray, b: np.ndarray, known: np.ndarray | int = 0) -> np.ndarray:
        low = np.zeros(len(a), np.int64) + known
        high = np.minimum(np.minimum(self.room[a], self.room[b]), self.depth)
        low = np.minimum(low, high)
        full = self._hash.at(a, a + high) == self._hash.at(b, b + high)
        low[full] = high[full]
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_] + 1) // 2
            same = self._hash.at(a[open_], a[open_] + middle) == self._hash.at(b[open_], b[open_] + middle)
            low[open_[same]] = middle[same]
            high[open_[~same]] = middle[~same] - 1
        return low


def sort_directly(text: np.ndarray, at: np.ndarray, prefixes: Prefixes) -> np.ndarray:
    """Suffixes ``at`` ordered by their first ``depth`` symbols; equal ones stand in any order.

    Groups that are still equal are split again and again by six symbols after the prefix that the whole group shares,
    which is found by hash, so long repeats cost a few rounds and not one for each symbol.
    """
    padded = np.concatenate((text, np.zeros(8, text.dtype))).astype(np.uint64)

    def symbols(place: np.ndarray) -> np.ndarray:
        packed, alive = np.zeros(len(place), np.uint64), np.ones(len(place), np.uint64)
        for i in range(6):
            s = padded[place + i] * alive
            alive = (s != 0).astype(np.uint64)
            packed = packed << np.uint64(9) | s
        return packed

    order = np.array(at, np.int64)
    first = symbols(order)
    by = np.argsort(first, kind="stable")
    order, group = order[by], np.cumsum(np.concatenate(([0], first[by][1:] != first[by][:-1])))
    slots = np.arange(len(order))  # places in the order that are not settled yet
    while True:
        size = np.bincount(group)
        open_ = size[group] > 1
        slots, group = slots[open_], group[open_]
        if not len(slots):
            return order
        group = np.cumsum(np.concatenate(([0], group[1:] != group[:-1])))
        heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        here = order[slots]
        shared = np.minimum.reduceat(prefixes.common(here, here[heads][group]), heads)[group]
        # a group is done when it is equal to the full depth, or when all its suffixes end
        goes_on = np.maximum.reduceat((prefixes.room[here] > shared).astype(np.int8), heads)[group] > 0
        live = goes_on & (shared < prefixes.depth)
        slots, group, here, shared = slots[live], group[live], here[live], shared[live]
        if not len(slots):
            return order
        group = np.cumsum(np.concatenate(([0], group[1:] != group[:-1])))
        key = symbols(here + shared)
        by = np.lexsort((key, group))
        order[slots] = here[by]
        key = key[by]
        group = np.cumsum(np.concatenate(([0], (group[1:] != group[:-1]) | (key[1:] != key[:-1]))))


def two_stage_order(text: np.ndarray, wanted: np.ndarray, prefixes: Prefixes) -> np.ndarray:
    """The suffixes marked in ``wanted`` in order of their first ``depth`` symbols.

    ``wanted`` must hold, with each place, the places after it up to the next suffix that is smaller than its successor.
    """
    up = ascending(text)
    direct = sort_directly(text, np.flatnonzero(wanted & up), prefixes)
    induced = wanted & ~up
    symbols = np.unique(text[wanted])
    bounds = np.searchsorted(text[direct], symbols, side="left"), np.searchsorted(text[direct], symbols, side="right")
    waiting: dict[int, list[np.ndarray]] = {int(s): [] for s in symbols}
    out = []

    def before(scan: np.ndarray) -> np.ndarray:
        previous = scan[scan > 0] - 1
        return previous[induced[previous]]

    for s, low, high in zip(symbols.tolist(), *bounds):
        larger = waiting.pop(s)
        wave = np.concatenate(larger) if larger else np.zeros(0, np.int64)
        larger = [wave]
        while len(wave):  # a run of one symbol goes on in its own bucket
            wave = before(wave)
            wave = wave[text[wave] == s]
            larger.append(wave)
        scan = np.concatenate((*larger, direct[low:high]))
        out.append(scan)
        previous = before(scan)
        into = text[previous]
        previous, into = previous[into > s], into[into > s]
        by = np.argsort(into, kind="stable")
        previous, into = previous[by], into[by]
        cuts = np.flatnonzero(np.concatenate(([True], into[1:] != into[:-1]))) if len(into) else []
        for a, b in zip(cuts, [*cuts[1:], len(into)]):
            waiting[int(into[a])].append(previous[a:b])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_windows(texts: list[bytes], windows: list[int], known: list[bool], width: int) -> list[np.ndarray]:
    """For each text, which of its first ``windows`` windows also start elsewhere in these texts.

    ``known``: texts that stand for several equal ones.
    """
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    text = np.zeros(int(sizes.sum()) + len(texts), np.uint16)
    window = np.zeros(len(text), bool)
    for start, t, n in zip(starts, texts, windows):
        text[start:start + len(t)] = np.frombuffer(t, np.uint8)
        text[start:start + len(t)] += 1
        window[start:start + n] = True
    # with each window the places up to the next directly sorted suffix, from which it is induced
    up = ascending(text)
    direct = np.flatnonzero(up)
    wanted = window.copy()
    last = starts + np.array(windows) - 1
    for a, b in zip(last, direct[np.searchsorted(direct, last)]):
        wanted[a:b + 1] = True
    prefixes = Prefixes(text, width)
    order = two_stage_order(text, wanted, prefixes)
    common = prefixes.common(order[:-1], order[1:]) if len(order) > 1 else np.zeros(0, np.int64)
    hit = np.zeros(len(text), bool)
    near = np.flatnonzero(common >= width)
    hit[order[near]] = True
    hit[order[near + 1]] = True
    return [np.ones(n, bool) if k else hit[start:start + n] for start, n, k in zip(starts, windows, known)]


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist()))


PIECES = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("src", T.LongType()), T.StructField("src_tag", T.LongType()),
    T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("many", T.BooleanType()),
    T.StructField("crowded", T.BooleanType()), T.StructField("text", T.BinaryType())])
SUBRUNS = T.StructType([
    *PIECES.fields[:6], T.StructField("text", T.BinaryType()), T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())])
WINDOWS = T.StructType([
    T.StructField("src", T.LongType()), T.StructField("src_tag", T.LongType()), T.StructField("at", T.IntegerType()),
    T.StructField("j", T.IntegerType()), T.StructField("m", T.IntegerType())])
DIGESTS = T.StructType([*WINDOWS.fields[:4], T.StructField("many", T.BooleanType()),
                        T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())])
_ARROW = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary(),
          T.StringType(): pa.string()}


def _batch(schema: T.StructType, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema.fields]
    return pa.RecordBatch.from_arrays([pa.array(list(c), _ARROW[f.dataType]) for c, f in zip(columns, schema.fields)],
                                      names=schema.names)


def _cut(width: int):
    def batches(stream):
        for batch in stream:
            rows = []
            for doc_id, tag, text, asked in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(a["key"], doc_id, tag, a["at"], a["n"], a["many"], a["crowded"],
                          text[a["at"]:a["at"] + a["n"] + width - 1]) for a in asked]
                if len(rows) > 5000:
                    yield _batch(PIECES, rows)
                    rows = []
            yield _batch(PIECES, rows)
    return batches


def _sorted_blocks(width: int):
    """Pieces, all of a key in a row, to ranges of repeated windows."""
    def block(rows):
        found = repeated_windows([r[6] for r in rows], [r[4] for r in rows], [r[5] for r in rows], width)
        return _batch(WINDOWS, [(*r[1:4], j, m) for r, f in zip(rows, found) if not r[5] for j, m in _ranges(f)])

    def batches(stream):
        rows, bucket, size = [], [], 0
        for batch in stream:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "src", "src_tag", "at", "n", "many", "text"))):
                if bucket and bucket[0][0] != row[0]:
                    rows += bucket
                    bucket = []
                    if size >= BLOCK:
                        yield block(rows)
                        rows, size = [], 0
                bucket.append(row)
                size += len(row[6])
        if rows or bucket:
            yield block(rows + bucket)
    return batches


def _subruns(width: int, k: int):
    """Pieces to shorter runs: neighbouring windows whose distance to the minimizer falls in one step of STEP."""
    def batches(stream):
        for batch in stream:
            pieces = list(zip(*(batch.column(c).to_pylist() for c in ("src", "src_tag", "at", "n", "many", "text"))))
            off = np.zeros(len(pieces), np.int64)
            for r in all_runs([_symbols(p[5]) for p in pieces], width, k):  # one run each
                off[r["doc"]] = r["off"]
            rows = []
            for (src, tag, at, n, many, text), a in zip(pieces, off.tolist()):
                j = 0
                while j < n:
                    low = (a - j) // STEP * STEP
                    more = min(n - j, a - j - low + 1)
                    core = text[a - low:a - low - STEP + 1 + width]  # in every window of the step, here or elsewhere
                    part = text[j:j + more + width - 1]
                    key = _long(b"%d " % low + core)
                    rows.append((key[0], src, tag, at + j, more, many, part, *_long(b"%d " % (a - j) + part)))
                    j += more
            yield _batch(SUBRUNS, rows)
    return batches


def _long(data: bytes) -> tuple[int, int]:
    d = np.frombuffer(hashlib.blake2b(data, digest_size=16).digest(), "<i8")
    return int(d[0]), int(d[1])


def _window_digests(width: int):
    def batches(stream):
        for batch in stream:
            rows = []
            for src, tag, at, n, many, text in zip(*(batch.column(c).to_pylist() for c in ("src", "src_tag", "at", "n", "many", "text"))):
                for j in range(n):
                    rows.append((src, tag, at, j, many, *_long(text[j:j + width])))
                if len(rows) > 20000:
                    yield _batch(DIGESTS, rows)
                    rows = []
            yield _batch(DIGESTS, rows)
    return batches


def tagged(docs: DataFrame) -> DataFrame:
    """doc_id (null: a stand-in), a hash of the text that tells rows with one doc_id apart, and the text's bytes."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def _symbols(text: bytes) -> np.ndarray:
    return byte_values()[np.frombuffer(text, np.uint8)]


def repeated_bytes(ws: Workspace, texts: DataFrame, width: int = WIDTH, k: int = K, crowd: int = CROWD) -> DataFrame:
    """Per text (doc_id, tag, text) with repeats: doc_id, tag, spans (start, n windows)."""
    runs = ws.store(texts.mapInArrow(run_batches(_symbols, width, k), RUNS), "runs")
    shared = runs.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
    # Stored, so that the join below deals both sides anew: Spark splits a hot key's part of a join, but not that of a sum.
    shared = ws.store(shared, "shared")
    repeated = ws.store(runs.join(shared, "key", "left_semi"), "repeated")
    ws.drop(runs)

    pieces = repeated.groupBy("key", "c1", "c2").agg(
        F.min(F.struct("doc_id", "tag", "start")).alias("s"), F.max("n").alias("n"), (F.count(F.lit(1)) > 1).alias("many"))
    pieces = ws.store(pieces.select("key", "c1", "c2", "n", "many", F.col("s.doc_id").alias("src"), F.col("s.tag").alias("src_tag"),
                                    F.col("s.start").alias("at")), "pieces")
    mixed = ws.store(pieces.groupBy("key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1"), "mixed")
    asked = (pieces.join(mixed, "key").withColumn("crowded", F.col("_m") > crowd)
             .groupBy(F.col("src").alias("doc_id"), F.col("src_tag").alias("tag"))
             .agg(F.collect_list(F.struct("key", "at", "n", "many", "crowded")).alias("asked")))
    # rows that are equal in doc_id and text are one source
    cut = texts.join(asked, ["doc_id", "tag"]).select("doc_id", "tag", "text", "asked").mapInArrow(_cut(width), PIECES)
    cut = ws.store(cut, "texts")
    one = ["key", "src", "src_tag", "at"]

    def in_blocks(pieces: DataFrame) -> DataFrame:
        return pieces.repartition("key").sortWithinPartitions(*one).mapInArrow(_sorted_blocks(width), WINDOWS)

    short = ws.store(cut.where("crowded").repartition(*one).mapInArrow(_subruns(width, k), SUBRUNS).distinct(), "short-runs")
    same = short.groupBy("key", "d1", "d2").agg(
        F.min(F.struct("src", "src_tag", "at")).alias("s"), (F.max("many") | (F.count(F.lit(1)) > 1)).alias("many"))
    same = ws.store(same.select("key", "d1", "d2", "many", "s.*"), "short-pieces")
    repeats = same.where("many").select("key", "d1", "d2")
    copied = short.where("NOT many").join(repeats, ["key", "d1", "d2"]).select("src", "src_tag", "at", F.lit(0).alias("j"), F.col("n").alias("m"))
    sizes = ws.store(same.groupBy("key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1"), "short-mixed")
    apart = short.drop("many").join(same.join(sizes, "key").select(*one, "many", "_m"), one)
    again_sorted = in_blocks(apart.where(F.col("_m") <= crowd))
    digests = apart.where(F.col("_m") > crowd).mapInArrow(_window_digests(width), DIGESTS)
    again = digests.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("_n"), F.max("many").alias("_many")).where("_n > 1 OR _many")
    counted = digests.where("NOT many").join(again, ["d1", "d2"]).select("src", "src_tag", "at", "j", F.lit(1).alias("m"))
    found = in_blocks(cut.where("NOT crowded")).unionByName(copied).unionByName(again_sorted).unionByName(counted)
    found = ws.store(found.distinct(), "windows")

    copies = pieces.where("many").select("key", "c1", "c2")
    whole = repeated.join(copies, ["key", "c1", "c2"]).select("doc_id", "tag", "start", "n")
    part = found.select(F.col("src").alias("doc_id"), F.col("src_tag").alias("tag"), (F.col("at") + F.col("j")).alias("start"),
                        F.col("m").alias("n"))
    return (whole.unionByName(part).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "n")).alias("spans")))


def removed_ranges(spans: list[dict] | None, width: int) -> list[tuple[int, int]]:
    """Maximal byte ranges that the spans' windows cover."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["start"] + s["n"] + width - 1) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def kept_bytes(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for start, end in ranges:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])


STRETCHES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("at", T.LongType()),
                          T.StructField("text", T.BinaryType())])


def _stretches(passage: int, width: int):
    """The parts of each text that repeats of ``passage`` bytes cover, where they have ``width`` bytes or more."""
    def batches(stream):
        for batch in stream:
            rows = []
            for doc_id, tag, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(doc_id, tag, a, text[a:b]) for a, b in removed_ranges(spans, passage) if b - a >= width]
            yield _batch(STRETCHES, rows)
    return batches


def repeated_within(ws: Workspace, texts: DataFrame, near: DataFrame, passage: int, width: int = WIDTH, k: int = K, crowd: int = CROWD) -> DataFrame:
    """``repeated_bytes`` of ``width``, given those of the shorter ``passage``.

    All parts of a repeat are repeats, so it lies in a stretch that shorter ones cover; only these stretches are searched again.
    """
    cut = texts.join(near, ["doc_id", "tag"]).select("doc_id", "tag", "text", "spans").mapInArrow(_stretches(passage, width), STRETCHES)
    cut = ws.store(cut.withColumn("part", F.xxhash64("tag", "at")), "stretches")
    found = repeated_bytes(ws, cut.select("doc_id", F.col("part").alias("tag"), "text"), width, k, crowd).withColumnRenamed("tag", "part")
    moved = F.transform("spans", lambda s: F.struct((s["start"] + F.col("at")).alias("start"), s["n"].alias("n")))
    return (found.join(cut.select("doc_id", "part", "tag", "at").distinct(), ["doc_id", "part"])
            .groupBy("doc_id", "tag").agg(F.flatten(F.collect_list(moved)).alias("spans")))


KEPT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("n_passages", T.LongType())])


def suffix_dedup(docs: DataFrame, width: int = WIDTH, k: int = K, crowd: int = CROWD, passage: int = PASSAGE, passage_k: int = PASSAGE_K) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages.

    ``n_passages`` counts the maximal stretches that repeats of ``passage`` bytes (``width``, if that is less) cover. They are reported; only what repeats
    over ``width`` bytes is removed.
    """
    if passage >= width:
        passage, passage_k = width, k
    ws = Workspace(docs.sparkSession, "suffixes")
    texts = tagged(docs)
    near = ws.store(repeated_bytes(ws, texts, passage, passage_k, crowd), "passages")
    far = repeated_within(ws, texts, near, passage, width, k, crowd) if passage < width else near
    spans = ws.store(near.withColumnRenamed("spans", "near").join(far.withColumnRenamed("spans", "far"), ["doc_id", "tag"], "left"), "removals")

    def kept(stream):
        for batch in stream:
            rows = []
            for doc_id, text, s, p in zip(*(c.to_pylist() for c in batch.columns)):
                ranges = removed_ranges(s, width)
                rest = kept_bytes(text, ranges)
                rows.append((None if doc_id == NO_ID else doc_id, len(text), len(text) - len(rest), len(ranges), hashlib.sha256(rest).hexdigest(),
                             len(removed_ranges(p, passage))))
            yield _batch(KEPT, rows)

    return tagged(docs).join(spans, ["doc_id", "tag"], "left").select("doc_id", "text", "far", "near").mapInArrow(kept, KEPT)


def without_repeats(docs: DataFrame, width: int = WIDTH, k: int = K, crowd: int = CROWD) -> DataFrame:
    """The rows of ``docs``, all columns, with the text that is left; ``n_chars``, where there is one, follows it.

    Characters of which only some bytes go, at the edges of a removed stretch, go whole. A null text stays null.
    """
    ws = Workspace(docs.sparkSession, "suffixes")
    spans = ws.store(repeated_bytes(ws, tagged(docs), width, k, crowd), "removals")
    id_, tag, found, left = (unused(docs, n) for n in ("_id", "_tag", "_spans", "_rest"))
    spans = spans.select(F.col("doc_id").alias(id_), F.col("tag").alias(tag), F.col("spans").alias(found))

    @F.pandas_udf("string")
    def rest(texts: pd.Series, spans_: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else kept_bytes(t.encode(), removed_ranges(list(s), width)).decode("utf-8", "ignore")
                          for t, s in zip(texts, spans_)], dtype=object)

    match = ((F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col(id_))
             & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(tag)))
    changed = F.col(found).isNotNull()
    joined = docs.join(spans, match, "left").withColumn(left, rest(F.when(changed, F.col("text")), F.when(changed, F.col(found))))
    new = {"text": F.when(changed, F.col(left)).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(left)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])

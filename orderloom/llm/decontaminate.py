"""Find benchmark passages in documents, also with words substituted, by spaced-seed hashing.

A passage counts as leaked where ``width`` neighbouring words of an item stand in a document, in order, with ``mismatches``
of them replaced at most (items of 5 to ``width - 1`` words: whole, with one replaced at most; shorter ones are no evidence). Three masks of
five positions each look at any such stretch: whichever two of its ten words are replaced, one mask at one place sees
only unchanged words. For each length of shorter items that the benchmark has, three masks leave out a third of the item each.
So equal mask hashes of item and document find every leak, and the words around each hit are compared.

Words are runs of characters other than ASCII white space and punctuation, in lower case.

Scale: one pass over the texts tests each place's mask hashes against a bitmap of the items' hashes. Its size is fixed (4 MB)
whatever the size of the benchmark; what passes is joined with the items' hashes by equality. A document then meets
the items that may be in it in a sorted stream, one row for each pair, so neither long documents nor many hits are gathered.

Defined results: null, empty and short texts have no leak; rows with equal doc_id are checked each; rows of equal or
null item_id are items of their own texts; an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.sequences import mix, word_values
from orderloom.llm.workspace import Workspace, unused

WIDTH = 10
MISMATCHES = 2
#: Words replaced at most in an item shorter than the width.
SHORT_MISMATCHES = 1
#: Together these see every stretch of ten words with two replaced (found by search over all 45 pairs of places).
MASKS = ((0, 1, 2, 4, 5), (0, 2, 6, 7, 8), (0, 1, 3, 4, 9))
#: Per length of a shorter item: each place is left out by one of the masks.
SHORT_MASKS = {n: tuple(tuple(i for i in range(n) if i * 3 // n != third) for third in range(3)) for n in range(5, WIDTH)}
SHORTEST = 5
BITS = 25

_BREAKS = bytes(0x20 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256))


def normalized(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_BREAKS)


def mask_hashes(words: np.ndarray, mask: tuple[int, ...], which: int) -> np.ndarray:
    """A hash per place of the words that the mask looks at, as signed longs."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, which + 1, np.uint64)
    for offset in mask:
        h = (h ^ words[offset:offset + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return mix(h).view(np.int64)


SEEDS = T.StructType([T.StructField("id", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("hash", T.LongType()),
                      T.StructField("place", T.IntegerType())])


def _seeds(masks: list[tuple[int, tuple[int, ...]]], items: bool, bitmap=None):
    """(id, tag, text) to the hashes of every place by each mask (with its items' length), or of those that the bitmap lets through."""
    def batches(stream):
        bits = bitmap.value if bitmap is not None else None
        for batch in stream:
            out = [[], [], [], []]
            for id_, tag, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = word_values(normalized(text))
                for which, (length, mask) in enumerate(masks):
                    if items and min(len(words), WIDTH) != length:
                        continue
                    h = mask_hashes(words, mask, which)
                    at = np.arange(len(h), dtype=np.int32)
                    if bits is not None:
                        slot = h.view(np.uint64) >> np.uint64(64 - BITS)
                        at = np.flatnonzero((bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1).astype(np.int32)
                    if len(at):
                        out[0].append(np.full(len(at), NO_ID if id_ is None else id_, np.int64))
                        out[1].append(np.full(len(at), tag, np.int64))
                        out[2].append(h[at])
                        out[3].append(at)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=SEEDS.names)
    return batches


#: Stands for a null id in joins.
NO_ID = -(1 << 63)


def _lengths(stream):
    """Word counts of the items shorter than the width."""
    for batch in stream:
        of = {len(word_values(normalized(t))) for t in batch.column(0).to_pylist()}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(of & SHORT_MASKS.keys()), pa.int32())], names=["length"])


def _keyed(table: DataFrame, id_column: str) -> DataFrame:
    return table.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"), "text")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """One bit per slot of the hashes' top bits; at most 2**BITS bits whatever the number of seeds."""
    slot = F.shiftrightunsigned("hash", 64 - BITS)
    rows = (seeds.groupBy(F.bitmap_bucket_number(slot + 1).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1)).alias("bits")).collect())
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        start = (r["bucket"] - 1) * len(part)
        bits[start:start + len(part)] = part
    return bits


LEAKS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("doc_word", T.IntegerType()),
    T.StructField("item_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()), T.StructField("n_equal", T.IntegerType())])


def aligned_leaks(doc: np.ndarray, item: np.ndarray, shift: int) -> list[tuple[int, int, int, int]]:
    """Leaked stretches on one alignment (document word = item word + shift): doc word, item word, words, equal words."""
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    width = min(WIDTH, len(item))
    if high - low < width or width < SHORTEST:
        return []
    equal = (item[low:high] == doc[low + shift:high + shift]).astype(np.int64)
    sums = np.concatenate(([0], np.cumsum(equal)))
    good = sums[width:] - sums[:-width] >= width - (MISMATCHES if len(item) >= WIDTH else SHORT_MISMATCHES)
    cover = np.zeros(len(equal) + 1, np.int64)
    at = np.flatnonzero(good)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    inside = (np.cumsum(cover[:-1]) > 0).astype(np.int8)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside, [0]))))
    out = []
    for a, b in zip(edge[::2], edge[1::2]):
        hits = np.flatnonzero(equal[a:b])
        a, b = a + hits[0], a + hits[-1] + 1
        out.append((int(low + a + shift), int(low + a), int(b - a), int(sums[b] - sums[a])))
    return out


FOUND = T.StructType([T.StructField("id", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("item", T.LongType()), *LEAKS.fields[2:]])


def _verified(stream):
    """A document's text comes before the items that may be in it, each with its alignments."""
    doc_key = doc = None
    for batch in stream:
        rows = []
        for id_, tag, item_id, shifts, text in zip(*(c.to_pylist() for c in batch.columns)):
            if shifts is None:
                if (id_, tag) != doc_key:
                    doc_key, doc = (id_, tag), word_values(normalized(text))
                continue
            item = word_values(normalized(text))
            rows += [(id_, tag, item_id, *leak) for shift in shifts for leak in aligned_leaks(doc, item, shift)]
        columns = list(zip(*rows)) if rows else [()] * len(FOUND)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (*(pa.int64(),) * 3, *(pa.int32(),) * 4))], names=FOUND.names)


def find(ws: Workspace, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Leaked stretches by id (null: a stand-in) and tag of the document. No join broadcasts a side, however small it looks when stored."""
    texts, items = _keyed(docs, "doc_id"), _keyed(benchmark, "item_id").dropDuplicates(["id", "tag"])
    lengths = [r["length"] for r in items.select("text").mapInArrow(_lengths, "length int").distinct().collect()]  # five at most
    masks = [(WIDTH, m) for m in MASKS] + [(n, m) for n in sorted(lengths) for m in SHORT_MASKS[n]]
    index = ws.store(items.mapInArrow(_seeds(masks, True), SEEDS), "index")
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(index))
    found = texts.mapInArrow(_seeds(masks, False, bitmap), SEEDS)
    side = index.select("hash", F.col("id").alias("item"), F.col("tag").alias("item_tag"), F.col("place").alias("item_place"))
    places = found.join(side.hint("merge"), "hash").select("id", "tag", "item", "item_tag", (F.col("place") - F.col("item_place")).alias("shift"))
    # At most as many alignments of one item as the document and the item have words.
    pairs = ws.store(places.groupBy("id", "tag", "item", "item_tag").agg(F.sort_array(F.collect_set("shift")).alias("shifts")), "pairs")
    named = items.select(F.col("id").alias("item"), F.col("tag").alias("item_tag"), "text")
    asked = pairs.join(named.hint("merge"), ["item", "item_tag"]).select("id", "tag", "item", "shifts", "text")
    mine = (texts.join(pairs.select("id", "tag").distinct().hint("merge"), ["id", "tag"], "left_semi")
            .select("id", "tag", F.lit(None).cast("long").alias("item"), F.lit(None).cast("array<int>").alias("shifts"), "text"))
    both = mine.unionByName(asked).repartition("id", "tag").sortWithinPartitions("id", "tag", F.col("shifts").isNotNull())
    return both.mapInArrow(_verified, FOUND).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per leaked stretch: doc_id, item_id, doc_word, item_word, n_words, n_equal."""
    found = find(Workspace(docs.sparkSession, "decontaminate"), docs, benchmark)
    return found.select(F.nullif(F.col("id"), F.lit(NO_ID)).alias("doc_id"), F.nullif(F.col("item"), F.lit(NO_ID)).alias("item_id"),
                        *LEAKS.names[2:])


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without a leaked stretch."""
    ws = Workspace(docs.sparkSession, "decontaminate")
    id_, tag = unused(docs, "_id"), unused(docs, "_tag")
    found = ws.store(find(ws, docs, benchmark).select(F.col("id").alias(id_), F.col("tag").alias(tag)).distinct(), "leaky")
    match = ((F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col(id_))
             & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(tag)))
    return docs.join(found.hint("merge"), match, "left_anti")

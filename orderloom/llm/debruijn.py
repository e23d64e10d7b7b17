"""Remove long word passages that an earlier document has, on a compacted de Bruijn graph.

The edges are k-mers of ``width`` words. They are never listed one by one: k-mers in a row that share a minimizer travel as
one run with a 128-bit hash (``sequences``), and runs are bucketed by minimizer.

1. Runs whose minimizer is in one document only hold no repeat and go.
2. Equal runs collapse to one labelled path piece with the coordinates of its first source (smallest doc_id, then place).
3. Pieces that continue one another at the source, with no branch between them, are compacted into paths by joins; each
   document's occurrences of a path merge into one long span with source coordinates.
4. One pass over the source texts gives a digest of every source span, and the k-mers of pieces whose bucket also
   holds other pieces (passage ends, where runs differ in part). Their first documents come from an aggregate over k-mers.
5. The last pass checks each long span of a document against its source's digest and removes what it covers.

Defined results: null, empty and short texts (under ``width`` words) lose nothing; the words of an empty text joined are the empty
string. Rows with equal doc_id are one document, so they don't remove each other's words. A null doc_id is
smaller or larger than none: its row loses nothing and makes nothing go. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.sequences import all_runs, grouped, word_values
from orderloom.llm.workspace import Workspace

WIDTH = 50
K = 16

RUNS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("start", T.IntegerType()),
    T.StructField("n", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("c1", T.LongType()),
    T.StructField("c2", T.LongType())])


def tagged(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text that tells rows with one doc_id apart, and the text's bytes."""
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def run_batches(values, width: int, k: int):
    """A ``mapInArrow`` function from (doc_id, tag, text) to runs; ``values`` makes a text's symbols."""
    def batches(stream):
        for batch in stream:
            ids, tags = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
            texts = batch.column(2).to_pylist()
            for a, b in grouped([len(t) for t in texts]):  # symbols take eight times a text's bytes
                for r in all_runs([values(t) for t in texts[a:b]], width, k):
                    doc = r["doc"] + a
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[doc]), pa.array(tags[doc]), pa.array(r["start"].astype(np.int32)),
                        pa.array(r["n"].astype(np.int32)), *(pa.array(r[c].view(np.int64)) for c in ("key", "c1", "c2"))],
                        names=RUNS.names)
    return batches


def _digest(words: list[bytes]) -> tuple[int, int]:
    both = np.frombuffer(hashlib.blake2b(b" ".join(words), digest_size=16).digest(), "<i8")
    return int(both[0]), int(both[1])


SOURCE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("start", T.IntegerType()),
    T.StructField("n", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("d1", T.LongType()),
    T.StructField("d2", T.LongType())])


def _sources(width: int):
    """(doc_id, tag, text, asked) to digests: one per span (j null), or one per k-mer of a piece (``each``)."""
    def batches(stream):
        for batch in stream:
            made = [[] for _ in SOURCE.names]
            for doc_id, tag, text, asked in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.split()
                for a in asked:
                    start, n = a["start"], a["n"]
                    if a["each"]:
                        rows = [(start, n, j, *_digest(words[start + j:start + j + width])) for j in range(n)]
                    else:
                        rows = [(start, n, None, *_digest(words[start:start + n + width - 1]))]
                    for row in rows:
                        for column, value in zip(made, (doc_id, tag, *row)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(made, (
                pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=SOURCE.names)
    return batches


KEPT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("kept_sha256", T.StringType())])


def kept_words(text: bytes, spans: list[dict] | None, width: int) -> tuple[list[bytes], int]:
    """The words that stay and the number of all; spans with a digest count only if the text has it there."""
    words = text.split()
    if not spans:
        return words, len(words)
    gone = np.zeros(len(words), bool)
    for s in spans:
        end = s["start"] + s["n"] + width - 1
        if s["d1"] is None or (s["d1"], s["d2"]) == _digest(words[s["start"]:end]):
            gone[s["start"]:end] = True
    return [words[i] for i in np.flatnonzero(~gone)], len(words)


def repeated_spans(ws: Workspace, docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """Per document with repeats: doc_id, tag, spans (start, n k-mers, digest of the source or null)."""
    texts = tagged(docs)
    runs = ws.store(texts.where("doc_id IS NOT NULL").mapInArrow(run_batches(word_values, width, k), RUNS), "runs")
    shared = (runs.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
              .where("lo < hi").select("key"))
    # Stored, so that the join below deals both sides anew: Spark splits a hot key's part of a join, but not that of a sum.
    shared = ws.store(shared, "shared")
    repeated = ws.store(runs.join(shared, "key", "left_semi"), "repeated")
    ws.drop(runs)

    source = F.min(F.struct("doc_id", "tag", "start"))
    pieces = repeated.groupBy("key", "c1", "c2").agg(source.alias("s"), F.max("n").alias("n"))
    pieces = ws.store(pieces.select("key", "c1", "c2", "n", F.col("s.doc_id").alias("src"), F.col("s.tag").alias("src_tag"),
                                    F.col("s.start").alias("at")), "pieces")
    where = ["src", "src_tag", "at"]

    # A piece goes on the path of the one that ends where it begins; coordinates are unique, so paths don't branch.
    before = pieces.select("src", "src_tag", (F.col("at") + F.col("n")).alias("at"), F.lit(True).alias("goes_on"))
    heads = pieces.join(before, where, "left")
    along = Window.partitionBy("src", "src_tag").orderBy("at")
    paths = heads.select("key", "c1", "c2", *where, F.max(F.when(F.col("goes_on").isNull(), F.col("at"))).over(along).alias("path"))
    occurrences = repeated.join(paths, ["key", "c1", "c2"])
    occurrences = ws.store(occurrences.select(
        "doc_id", "tag", "start", "n", *where, "path"), "occurrences")
    ws.drop(repeated)

    later = occurrences.where("doc_id > src").withColumn("shift", F.col("start") - F.col("at"))
    step = Window.partitionBy("doc_id", "tag", "src", "src_tag", "path", "shift").orderBy("start")
    broken = F.coalesce(F.col("start") != F.lag(F.col("start") + F.col("n")).over(step), F.lit(True))
    spans = (later.withColumn("_new", broken.cast("int")).withColumn("_span", F.sum("_new").over(step))
             .groupBy("doc_id", "tag", "src", "src_tag", "path", "shift", "_span")
             .agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n")))
    spans = ws.store(spans.select("doc_id", "tag", "src", "src_tag", "start", "n", (F.col("start") - F.col("shift")).alias("at")), "spans")

    mixed = ws.store(pieces.groupBy("key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1").select("key"), "mixed")
    partial = pieces.join(mixed, "key", "left_semi").select(*where, "n", F.lit(True).alias("each"))
    wanted = (spans.select(*where, "n", F.lit(False).alias("each")).distinct().unionByName(partial)
              .groupBy(F.col("src").alias("doc_id"), F.col("src_tag").alias("tag"))
              .agg(F.collect_list(F.struct(F.col("at").alias("start"), "n", "each")).alias("asked")))
    asked = texts.join(wanted, ["doc_id", "tag"]).select("doc_id", "tag", "text", "asked")
    digests = ws.store(asked.mapInArrow(_sources(width), SOURCE), "digests")

    whole = digests.where("j IS NULL").select(
        F.col("doc_id").alias("src"), F.col("tag").alias("src_tag"), F.col("start").alias("at"), "n", "d1", "d2").distinct()
    long = spans.join(whole, [*where, "n"]).select("doc_id", "tag", "start", "n", "d1", "d2")

    kmers = digests.where("j IS NOT NULL")
    first = (kmers.groupBy("d1", "d2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
             .select("d1", "d2", "lo"))
    inner = (kmers.join(first, ["d1", "d2"]).where("doc_id > lo")
             .select(F.col("doc_id").alias("src"), F.col("tag").alias("src_tag"), F.col("start").alias("at"), "j").distinct())
    own = occurrences.where("doc_id = src").select("doc_id", "tag", "start", *where).join(inner, where)
    short = own.select("doc_id", "tag", (F.col("start") + F.col("j")).cast("int").alias("start"), F.lit(1).alias("n"),
                       F.lit(None).cast("long").alias("d1"), F.lit(None).cast("long").alias("d2"))
    return (long.unionByName(short).groupBy("doc_id", "tag")
            .agg(F.collect_list(F.struct("start", "n", "d1", "d2")).alias("spans")))


def substring_dedup(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    ws = Workspace(docs.sparkSession, "debruijn")
    spans = ws.store(repeated_spans(ws, docs, width, k), "removals")

    def kept(stream):
        for batch in stream:
            rows = [[], [], []]
            for text, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words, n = kept_words(text, s, width)
                for column, value in zip(rows, (n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(
                rows, (pa.int64(), pa.int64(), pa.string())))], names=KEPT.names)

    return (tagged(docs).join(spans, ["doc_id", "tag"], "left").select("doc_id", "text", "spans").mapInArrow(kept, KEPT))

"""Near duplicates by SimHash fingerprints and deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Fingerprints that differ in two bits or
fewer have a segment in which they differ in one bit at most, so they share a segment variant in which
one bit is a wildcard. Variants are indexed, joined by equality, and the full distance is verified.

Documents with one fingerprint are one node. Segment values that very many fingerprints share
would meet in all pairs; those fingerprints, and those one bit beside them, are linked in another exact way:
fingerprints within two bits of each other have a common value at most one bit from each. A value has 65 such
neighbours, so these groups are bounded.

Defined results: a null or empty text, or one of separators only, has fingerprint zero and is linked like
any other. Rows with equal ``doc_id`` are fingerprinted each. A null ``doc_id`` is never a component id unless its
component has no other. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.components import components
from orderloom.llm.workspace import Workspace, unused

SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Members of one segment value from which its pairs are not listed any more.
CROWD = 64
_BITS = 1 << 16

FINGERPRINTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("tag", T.LongType()), T.StructField("fp", T.LongType())])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is set if it is set in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()  # on bytes: A-Z only, and exactly space and \x09-\x0D
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BITS):
        part = hashes[at:at + _BITS].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tag (a hash of the text) and fp, the fingerprint as a signed long."""
    def prints(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=FINGERPRINTS.names)

    return docs.select(F.col("doc_id").cast("long"), _tag(), F.col("text").cast("binary")).mapInArrow(prints, FINGERPRINTS)


def _tag() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag")


def _far(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(ws: Workspace, fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints whose links connect all that differ in two bits or fewer.

    Outside crowds every such pair is listed; within one, links to each neighbourhood's smallest member stand for its pairs.
    """
    low = F.col("fp").bitwiseAND(0xFFFFFFFF)
    segments = fps.select("fp", F.posexplode(F.array(low, F.shiftrightunsigned("fp", 32))).alias("seg", "value"))
    crowded = ws.store(segments.groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > crowd).select("seg", "value"), "crowded")
    plain = segments.join(crowded, ["seg", "value"], "left_anti")

    # One wildcard: the variant leaves out bit `wild`; a pair differs there, so one side has it set.
    variants = plain.select("seg", "fp", "value", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("wild"))
    bit = F.expr("shiftleft(1L, wild)")
    variants = variants.select(
        F.col("value").bitwiseAND(F.bitwise_not(bit)).bitwiseOR(F.expr("shiftleft(cast(seg * 32 + wild as bigint), 32)")).alias("variant"),
        (F.col("value").bitwiseAND(bit) != 0).alias("set"), "fp")
    one = variants.where("NOT set").select("variant", F.col("fp").alias("a"))
    other = variants.where("set").select("variant", F.col("fp").alias("b"))
    # Sizes are estimated before rows unfold, so Spark would broadcast what is 32 times larger than it looks.
    differing = one.join(other.hint("merge"), "variant").where(_far("a", "b") <= DISTANCE).select("a", "b")

    left, right = plain.withColumnRenamed("fp", "a"), plain.withColumnRenamed("fp", "b")
    equal = left.join(right, ["seg", "value"]).where((F.col("a") < F.col("b")) & (_far("a", "b") <= DISTANCE)).select("a", "b")

    beside = crowded.select("seg", F.explode(F.concat(F.array("value"), F.transform(
        F.sequence(F.lit(0), F.lit(31)), lambda i: F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))).alias("value"))
    dense = segments.join(beside.distinct(), ["seg", "value"], "left_semi").select("fp").distinct()
    around = dense.repartition("fp").select("fp", F.explode(F.concat(F.array("fp"), F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))).alias("centre"))
    balls = around.groupBy("centre").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    through = balls.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return differing.unionByName(equal).unionByName(through).distinct()


def classes(ws: Workspace, docs: DataFrame, shingle: int = SHINGLE, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, tag, fp), and the component's ``root`` of every fp; both stored."""
    rows = ws.store(fingerprints(docs, shingle), "fingerprints")
    nodes = ws.store(rows.select("fp").distinct(), "nodes")
    found = components(ws, links(ws, nodes, crowd))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return rows, ws.store(rooted, "classes")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, crowd: int = CROWD) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that its links reach."""
    ws = Workspace(docs.sparkSession, "simhash")
    rows, rooted = classes(ws, docs, shingle, crowd)
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first")).join(rooted, "fp")
    first = ws.store(first, "first")
    named = first.groupBy("root").agg(F.min("first").alias("component_id"))
    named = ws.store(first.join(named, "root").select("fp", "component_id"), "components")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, crowd: int = CROWD) -> DataFrame:
    """The rows of ``docs``, all columns: of each component the one with the smallest doc_id (rows without come last; of rows with one
    doc_id the one with the smallest hash of its text; of equal rows one)."""
    ws = Workspace(docs.sparkSession, "simhash")
    rows, rooted = classes(ws, docs, shingle, crowd)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tag"))
    by_fp = rows.groupBy("fp").agg(best.alias("best"))
    kept = by_fp.join(rooted, "fp").groupBy("root").agg(F.min("best").alias("best"))
    id_, tag = unused(docs, "_id"), unused(docs, "_tag")
    keys = ws.store(kept.select(F.col("best.doc_id").alias(id_), F.col("best.tag").alias(tag)), "kept")
    match = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(tag))
    staying = docs.join(keys, match, "left_semi")
    again = rows.groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = again.join(keys, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col("tag") == F.col(tag)), "left_semi")
    return staying if again.isEmpty() else staying.dropDuplicates(["doc_id", "text"])

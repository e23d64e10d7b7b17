"""Token ids of all documents as compressed planes, and reading them back.

File format: a Parquet table with one row per block of ``block_ids`` ids (the last block of a part may
be shorter). A part is a range of documents in ``doc_id`` order. A block's ids, as 32-bit numbers,
are transposed: byte plane k holds byte k of every id, bit plane k holds bit k of every id, eight to a
byte. High planes are all but constant, so each plane is compressed on its own with zstandard.
The chunk index stands in columns of its own beside the planes and can be read without them.

Columns: part, block, first (the part's ids before the block), n (ids in it), planes (compressed),
docs (one entry per piece of a document in the block: row in the part, doc_id, offset
in the block, length, and whether the piece is the whole document).

Defined results: a null text is empty, an empty text has the end id only, a text of any length may
run over many blocks. Rows with a null ``doc_id`` come first. Rows with equal ``doc_id`` are documents
of their own, in the order of a hash of their texts. An empty table gives an empty file. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.encoding import encoder, text_groups
from orderloom.llm.workspace import Workspace

END_ID = 2
BLOCK_IDS = 1 << 16

SEGMENT = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("offset", T.IntegerType()), T.StructField("length", T.IntegerType()), T.StructField("whole", T.BooleanType())])
BLOCK = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("first", T.LongType()),
    T.StructField("n", T.IntegerType()), T.StructField("kind", T.StringType()),
    T.StructField("planes", T.ArrayType(T.BinaryType())), T.StructField("docs", T.ArrayType(SEGMENT))])


def to_planes(ids: np.ndarray, kind: str, level: int = 3) -> list[bytes]:
    """Byte (4) or bit (32) planes of the ids, each compressed."""
    import zstandard

    compressor = zstandard.ZstdCompressor(level=level)
    rows = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        bits = np.unpackbits(rows, axis=1, bitorder="little")
        planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(rows.T)
    return [compressor.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    width = (n + 7) // 8 if kind == "bit" else n
    stack = np.frombuffer(b"".join(decompressor.decompress(p, max_output_size=max(1, width)) for p in planes), np.uint8)
    stack = stack.reshape(len(planes), width)
    if kind == "bit":
        stack = np.packbits(np.unpackbits(stack, axis=1, count=n, bitorder="little"), axis=0, bitorder="little")
    return np.ascontiguousarray(stack.T).view("<u4").reshape(-1)


class _Blocks:
    """Fills blocks of one part with documents in order."""

    def __init__(self, part: int, block_ids: int, kind: str):
        self.part, self.block_ids, self.kind = part, block_ids, kind
        self.block = self.first = self.row = 0
        self.buffer, self.docs, self.size = [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, self.block_ids - self.size)
            self.docs.append({"row": self.row, "doc_id": doc_id, "offset": self.size, "length": take,
                              "whole": take == len(ids)})
            self.buffer.append(ids[at:at + take])
            at += take
            self.size += take
            if self.size == self.block_ids:
                yield self.flush()
        self.row += 1

    def flush(self) -> dict:
        ids = np.concatenate(self.buffer)
        made = {"part": self.part, "block": self.block, "first": self.first, "n": self.size, "kind": self.kind,
                "planes": to_planes(ids, self.kind), "docs": self.docs}
        self.block += 1
        self.first += self.size
        self.buffer, self.docs, self.size = [], [], 0
        return made


def write_tokens(docs: DataFrame, path: str, tokenizer: str, block_ids: int = BLOCK_IDS, kind: str = "byte") -> None:
    """Encode ``docs`` (doc_id, text) and write the file format above to ``path``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(BLOCK)

    def blocks(batches):
        from pyspark import TaskContext

        ids_of, filling = encoder(tokenizer), _Blocks(TaskContext.get().partitionId(), block_ids, kind)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, stop in text_groups(texts):
                made = []
                for doc_id, ids in zip(doc_ids[start:stop], ids_of.encode(texts[start:stop])):
                    made += filling.add(doc_id, np.frombuffer(ids + end, "<u4"))
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema)
        if filling.size:
            yield pa.RecordBatch.from_pylist([filling.flush()], schema)

    # by a hash of the text, not the text: the range borders come from a sample of keys on the driver
    order = ["doc_id", F.xxhash64("text")]
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(blocks, BLOCK).write.option("compression", "none").parquet(path)


def read_blocks(spark, path: str, each, schema: T.StructType) -> DataFrame:
    """``each(block, ids)`` gives the rows that a block and its ids, read back from the planes, are worth."""
    def blocks(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                rows = each(block, from_planes(block["planes"], block["n"], block["kind"]))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), to_arrow_schema(schema).types)],
                                                 names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    return spark.read.schema(BLOCK).parquet(path).mapInArrow(blocks, schema)


SEGMENTS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
                         T.StructField("first", T.LongType()), T.StructField("whole", T.BooleanType()), T.StructField("ids", T.BinaryType())])
DIGESTS = T.StructType([*SEGMENTS.fields[:5], T.StructField("n", T.LongType()), T.StructField("crc", T.LongType())])


def read_segments(spark, path: str) -> DataFrame:
    """Every piece of every document: part, row, doc_id, first (the part's ids before it), whole, ids."""
    return read_blocks(spark, path, lambda b, ids: [
        (b["part"], d["row"], d["doc_id"], b["first"] + d["offset"], d["whole"], ids[d["offset"]:d["offset"] + d["length"]].tobytes())
        for d in b["docs"]], SEGMENTS)


def _digests(b: dict, ids: np.ndarray) -> list[tuple]:
    return [(b["part"], d["row"], d["doc_id"], b["first"] + d["offset"], d["whole"], d["length"],
             zlib.crc32(ids[d["offset"]:d["offset"] + d["length"]])) for d in b["docs"]]


def _times(matrix: tuple[int, ...], vector: int) -> int:
    total, i = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[i]
        vector >>= 1
        i += 1
    return total


@lru_cache(maxsize=64)
def _zeros(power: int) -> tuple[int, ...]:
    """What 2**power zero bits do to the 32-bit state, as a matrix over bits; by squaring."""
    if not power:
        return (0xEDB88320, *(1 << i for i in range(31)))
    half = _zeros(power - 1)
    return tuple(_times(half, row) for row in half)


def crc32_join(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two byte strings put together, from the crc32 of each and the second's length."""
    bits, power = second_bytes * 8, 0
    while bits:
        if bits & 1:
            first = _times(_zeros(power), first)
        bits >>= 1
        power += 1
    return first ^ second


def token_digest(ws: Workspace, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Parts are ordered ranges, so a document's start is its place in its part plus the sizes of the parts before:
    one row per part, which is all that is broadcast.
    """
    @F.pandas_udf("long")
    def joined(pieces: pd.Series) -> pd.Series:
        def one(rows):
            crc = rows[0]["crc"]
            for r in rows[1:]:
                crc = crc32_join(crc, r["crc"], r["n"] * 4)
            return crc
        return pieces.map(one)

    spark = ws.spark
    pieces = ws.store(read_blocks(spark, path, _digests, DIGESTS), "digests")  # the files are read once
    whole = pieces.where("whole").select("part", "doc_id", "first", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    split = pieces.where("NOT whole").groupBy("part", "row").agg(  # at most one document goes on over a block's end
        F.max("doc_id").alias("doc_id"), F.min("first").alias("first"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("first", "n", "crc"))).alias("_pieces"))
    every = whole.unionByName(split.select("part", "doc_id", "first", "n_tokens", joined("_pieces").alias("ids_crc32")))
    sizes = spark.read.schema(BLOCK).parquet(path).groupBy(F.col("part").alias("_part")).agg(F.sum("n").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (every.join(F.broadcast(offsets), F.col("part") == F.col("_part"))
            .select("doc_id", (F.col("first") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32"))


def encode_documents(docs: DataFrame, tokenizer: str, block_ids: int = BLOCK_IDS, kind: str = "byte") -> tuple[str, DataFrame]:
    """Write all documents and return the folder and the digest read back from it."""
    ws = Workspace(docs.sparkSession, "tokens")
    path = ws.path("planes")
    write_tokens(docs, path, tokenizer, block_ids, kind)
    return path, token_digest(ws, path)

"""Nearest neighbours by cosine with a permutation index.

Equal vectors are one entry of the index, with their ``k`` + 1 smallest ids: no more of them can be among a query's best. A vector
stands for the order of its ``prefix`` nearest pivots. Vectors are dealt out over shards of bounded size; in a shard, each
pivot's inverted file lists the vectors that have it among their nearest, with its rank. A query adds up, over
its own pivots' files, how much the ranks agree, which is the footrule distance read off the postings: with ranks
beyond the prefix counted as ``prefix``, footrule = const - 2 * sum over shared pivots of (prefix - the larger rank). The
``rerank`` share of the shard that is nearest by footrule, and all that are as near as the last of it, are ranked again by exact
cosine in double precision; the shards' best are merged. Every vector is in the index; pivots are a bounded sample of it.

Both sides are dealt in blocks (at most ``shard_rows`` vectors, ``query_rows`` queries), so a task's memory is bounded and no task sees all of
either side. Recall against brute force is checked in the tests and recorded in the README.

Defined results: vectors that are null, of zero length, or hold a null or non-finite component take no part, as query or as
candidate, nor do rows with a null id. Vectors of different dimension are never compared. Rows with equal id are one another's "own row" and not candidates
of each other; an id with several vectors counts with its nearest. Ties in score go to the smaller id. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.workspace import Workspace

PIVOTS = 256
PREFIX = 64
RERANK = 0.12
#: Least number of candidates that a shard ranks again for a query.
LEAST = 1024
SHARD_ROWS = 8192
QUERY_ROWS = 2048

FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and v (array of double) of the vectors that take part."""
    v = F.col(vector_column).cast("array<double>")
    whole = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(
        "id IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    return whole.where("exists(v, x -> x <> 0)")


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Each vector's ``prefix`` nearest pivots, nearest first; ties to the smaller number."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix]


class Shard:
    """Inverted files of a block of vectors: for each pivot, the vectors that list it, and at which rank."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, prefix: int):
        self.prefix = min(prefix, len(pivots))
        order = nearest_pivots(vectors, pivots, self.prefix)
        flat = order.reshape(-1)
        by = np.argsort(flat, kind="stable")
        self.rows = by // self.prefix
        self.ranks = (by % self.prefix).astype(np.int64)
        self.bounds = np.searchsorted(flat[by], np.arange(len(pivots) + 1))
        self.n = len(vectors)

    def agreement(self, pivots: np.ndarray) -> np.ndarray:
        """Of every vector with a query's pivots: larger means a smaller footrule distance."""
        total = np.zeros(self.n, np.int64)
        for rank, p in enumerate(pivots):
            a, b = self.bounds[p], self.bounds[p + 1]
            total[self.rows[a:b]] += self.prefix - np.maximum(self.ranks[a:b], rank)
        return total


def collapse(rows: DataFrame, most: int) -> DataFrame:
    """dim, v and ids (the ``most`` smallest, ascending) of each different vector. The limit also holds before the shuffle, per task."""
    place = F.row_number().over(Window.partitionBy("dim", "v").orderBy("id"))
    return rows.withColumn("place", place).where(F.col("place") <= most).groupBy("dim", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def search_shard(ids: list[np.ndarray], vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray, k: int,
                 prefix: int, rerank: float, least: int):
    """Best ``k`` ids of the shard for each query, by cosine among those nearest by footrule."""
    vectors, queries, pivots = unit(vectors), unit(queries), unit(pivots)
    shard = Shard(vectors, pivots, prefix)
    n = len(ids)
    flat, lengths = np.concatenate(ids), np.array([len(i) for i in ids])
    starts = np.cumsum(lengths) - lengths
    size = min(n, max(int(np.ceil(rerank * n)), least + k))
    for query_id, q, near in zip(query_ids, queries, nearest_pivots(queries, pivots, shard.prefix)):
        agreement = shard.agreement(near)
        picked = np.flatnonzero(agreement >= np.partition(agreement, n - size)[n - size]) if size < n else np.arange(n)
        score = np.einsum("ij,j->i", vectors[picked], q)
        many = lengths[picked]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        found, score = flat[np.repeat(starts[picked], many) + within], np.repeat(score, many)
        order = np.lexsort((found, -score))
        order = order[found[order] != query_id]
        first = np.sort(np.unique(found[order], return_index=True)[1])[:k]
        yield query_id, found[order[first]], score[order[first]]


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
            pivots: int = PIVOTS, prefix: int = PREFIX, rerank: float = RERANK, least: int = LEAST,
            shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    ws = Workspace(spark, "permutation")
    rows = ws.store(usable(vectors, id_column, vector_column).withColumn("dim", F.size("v")).distinct(), "vectors")
    entries = ws.store(collapse(rows, k + 1), "entries")
    asked = rows.where(F.col("id") % every == 0)
    queries = {r["dim"]: r["q"] for r in asked.groupBy("dim").agg(F.count(F.lit(1)).alias("q")).collect()}
    sizes = {r["dim"]: (r["n"], queries.get(r["dim"], 0)) for r in entries.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = F.col("ids")[0]
    sample = {dim: np.array([r["v"] for r in entries.where(F.col("dim") == dim).orderBy(F.xxhash64(first), first, "v").limit(pivots).collect()], np.float64)
              for dim in sizes}
    shared = spark.sparkContext.broadcast(sample)
    blocks = spark.createDataFrame([(dim, -(-n // shard_rows), max(1, -(-q // query_rows))) for dim, (n, q) in sizes.items()],
                                   "dim int, shards int, parts int")
    shard = F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int")
    one = entries.join(F.broadcast(blocks), "dim").select(  # one row per dimension
        "dim", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "ids", "v")
    other = asked.join(F.broadcast(blocks), "dim").select(
        F.col("dim").alias("q_dim"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("q_shard"), part.alias("q_part"),
        F.col("id").alias("query_id"), F.col("v").alias("query"))

    def search(key, candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(asked):
            found = search_shard(list(candidates["ids"]), np.stack(candidates["v"]), asked["query_id"].to_numpy(), np.stack(asked["query"]),
                                 shared.value[key[0]], k, prefix, rerank, least)
            out = [pd.DataFrame({"query_id": q, "vec_id": i, "score": s}) for q, i, s in found]
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = one.groupBy("dim", "shard", "part").cogroup(other.groupBy("q_dim", "q_shard", "q_part")).applyInPandas(search, FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)

"""Running a stream to its end and keeping its output as tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamWriter

from orderloom.operators.orders import likely_answered
from orderloom.session import DEFAULTS, fresh_path

#: Set in rows that came behind the watermark.
LATE = "late"


def is_folder(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def read_stream(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """One table's files as a stream. ``name`` is a parquet file or a folder of parquet files, whatever it is called.

    All files at hand make one micro-batch, so their number and order don't matter. ``files_per_batch``
    bounds a micro-batch; rows that then come after the watermark has passed them are late.
    """
    path = os.path.join(sf_dir, name)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", name).parquet(sf_dir)


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _to_end(writer: DataStreamWriter, root: str) -> None:
    """Run the stream over all input at hand. Its state is in RocksDB, which the processors need, whatever the session's setting."""
    conf = SparkSession.active().conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, DEFAULTS[PROVIDER])
    try:
        query = writer.option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()  # takes a copy of the settings
    finally:
        conf.unset(PROVIDER) if before is None else conf.set(PROVIDER, before)
    query.awaitTermination()


def run_available(stream: DataFrame, label: str, mode: str = "append", root: str | None = None) -> DataFrame:
    """Process all input at hand and return what was written. For append-mode queries.

    ``root`` names the folder of output and progress; given again, the stream goes on where it stopped. Rows of ``out`` there with
    ``late`` set came behind the watermark: they are not in the result, but in its attribute ``late``.
    """
    spark = stream.sparkSession
    root = root or fresh_path(spark, label)
    _to_end(stream.writeStream.format("parquet").outputMode(mode).option("path", f"{root}/out"), root)
    written = spark.read.schema(stream.schema).parquet(f"{root}/out")
    if LATE not in stream.columns:
        return written
    behind = F.coalesce(F.col(LATE), F.lit(False))
    result = written.where(~behind).drop(LATE)
    result.late = written.where(behind).drop(LATE)
    return result


def run_batches(stream: DataFrame, root: str, step, mode: str = "append") -> None:
    """Call ``step(batch_df, batch_id)`` per micro-batch; with the same ``root`` again, from where it stopped."""
    def each(batch: DataFrame, batch_id: int) -> None:
        step(batch, batch_id)

    _to_end(stream.writeStream.outputMode(mode).foreachBatch(each), root)


BATCH = "batch_id"
BUCKET = "_bucket"
#: Changes that a bucket may hold, however small its base is.
LEAST_CHANGES = 1_000


def versions(root: str) -> str:
    return os.path.join(root, "versions")


def version_path(root: str, batch_id: int) -> str:
    """A batch's folder, in the form of a partition of the table of all batches."""
    return os.path.join(versions(root), f"{BATCH}={batch_id}")


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


class BucketedTable:
    """A table in hash buckets of a key, as base files and the changes since.

    A batch writes the rows of the keys that it changes and the list of these keys; what was written last for a key stands. When a
    bucket's changes have more rows than its base, the batch that brings them writes its base anew. The number of buckets
    follows the rows: about ``bucket_rows`` in each; when there are twice as many, one batch writes all with twice the buckets.

    A batch that runs again after a stop reads what stood before it and writes its own files anew; the log, written last, says
    what counts. What is collected of the log has a row per bucket and batch since the bucket's base.
    """

    def __init__(self, root: str, start: DataFrame, key: str, bucket_rows: int = 1_000_000):
        self.spark, self.root, self.key, self.bucket_rows, self.schema = start.sparkSession, root, key, bucket_rows, start.schema
        if not exists(self.spark, self._folder("written")):
            self._write_base(start, -1, max(1, -(-start.count() // bucket_rows)))

    def _folder(self, kind: str, batch_id: int | None = None, bucket: int | None = None) -> str:
        path = os.path.join(self.root, kind)
        if batch_id is not None:
            path = os.path.join(path, f"{BATCH}={batch_id}")
        return path if bucket is None else os.path.join(path, f"{BUCKET}={bucket}")

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _put(self, kind: str, rows: DataFrame, batch_id: int, buckets: int) -> dict[int, int]:
        """Write rows bucket by bucket; returns how many there are in each."""
        path = self._folder(kind, batch_id)
        (rows.withColumn(BUCKET, self._bucket(buckets)).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path))
        if not exists(self.spark, path):
            return {}
        written = self.spark.read.schema(T.StructType([T.StructField(BUCKET, T.IntegerType())])).parquet(path)
        return {r[BUCKET]: r["n"] for r in written.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}

    def _log(self, batch_id: int, entries: list[tuple[int, bool, int, int]], buckets: int) -> None:
        """``entries``: bucket, whether this is its base, rows, and keys that changed."""
        rows = [(b, base, n, keys, buckets) for b, base, n, keys in entries]
        (self.spark.createDataFrame(rows, f"{BUCKET} int, base boolean, n long, n_keys long, buckets int").coalesce(1)
         .write.mode("overwrite").parquet(self._folder("written", batch_id)))

    def _write_base(self, rows: DataFrame, batch_id: int, buckets: int) -> None:
        sizes = self._put("base", rows, batch_id, buckets)
        self._log(batch_id, [(b, True, sizes.get(b, 0), 0) for b in range(buckets)], buckets)

    def _standing(self, before: int | None) -> tuple[int, dict[int, list]]:
        """Number of buckets, and per bucket its log from its base on: (batch, rows, keys)."""
        log = self.spark.read.parquet(self._folder("written"))
        if before is not None:
            log = log.where(F.col(BATCH) < before)
        based = log.where("base").groupBy(BUCKET).agg(F.max(F.struct(BATCH, "buckets")).alias("b"))
        last = based.agg(F.max("b.buckets")).first()[0]
        entries: dict[int, list] = {b: [] for b in range(last)}
        since = log.join(based.where(F.col("b.buckets") == last), BUCKET).where(F.col(BATCH) >= F.col(f"b.{BATCH}")).orderBy(BATCH)
        for r in since.collect():
            entries[r[BUCKET]].append((r[BATCH], r["n"], r["n_keys"]))
        return last, entries

    def _files(self, kind: str, parts: list[tuple[int, int]], schema: T.StructType) -> DataFrame:
        """Rows of (batch, bucket) folders, with their batch."""
        schema = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        if not parts:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", self._folder(kind))
                .parquet(*[self._folder(kind, batch, b) for batch, b in parts]).select(*schema.names))

    def _rows(self, entries: dict[int, list], only: set[int]) -> DataFrame:
        mine = {b: log for b, log in entries.items() if b in only}
        base = self._files("base", [(log[0][0], b) for b, log in mine.items() if log[0][1]], self.schema).drop(BATCH)
        changes = [(batch, b, n) for b, log in mine.items() for batch, n, _ in log[1:]]
        if not changes:
            return base
        key = T.StructType([self.schema[self.key]])
        keys = self._files("keys", [(batch, b) for batch, b, _ in changes], key)
        changed = self._files("changes", [(batch, b) for batch, b, n in changes if n], self.schema)
        # Most rows of other keys stand without being shuffled: only those whose key may have changed meet the changed keys.
        untouched = likely_answered(base, keys, self.key, "left_anti").unionByName(
            likely_answered(base, keys, self.key).join(keys.select(F.col(self.key).alias("_key")), F.col(self.key) == F.col("_key"), "left_anti"))
        if len({batch for batch, _, _ in changes}) == 1:  # nothing was written later
            return untouched.unionByName(changed.where(F.col(self.key).isNotNull()).drop(BATCH))
        last = keys.groupBy(F.col(self.key).alias("_key")).agg(F.max(BATCH).alias("_last"))
        stands = (F.col(self.key) == F.col("_key")) & (F.col(BATCH) == F.col("_last"))
        return untouched.unionByName(changed.join(last, stands, "left_semi").drop(BATCH))

    def read(self, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The table as it stood before a batch, or now; only the rows of some ``keys`` (a column named as the key), from their buckets."""
        buckets, entries = self._standing(before)
        if keys is None:
            return self._rows(entries, set(entries))
        only = {r["_b"] for r in keys.select(self._bucket(buckets).alias("_b")).distinct().collect()}
        rows = likely_answered(self._rows(entries, only), keys, self.key)
        return rows.join(keys.select(self.key).distinct(), self.key, "left_semi").select(*self.schema.names)

    def write(self, rows: DataFrame, keys: DataFrame, batch_id: int) -> None:
        """Replace all rows of the ``keys`` by ``rows``, all of which belong to these keys."""
        buckets, entries = self._standing(batch_id)
        keys = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        sizes = self._put("changes", rows.select(*self.schema.names), batch_id, buckets)
        touched = self._put("keys", keys, batch_id, buckets)
        total = sum(n for log in entries.values() for _, n, _ in log) + sum(sizes.values())
        new = self._files("changes", [(batch_id, b) for b in sizes], self.schema).drop(BATCH)
        known = self._files("keys", [(batch_id, b) for b in touched], T.StructType([self.schema[self.key]])).drop(BATCH)

        def anew(only: set[int]) -> DataFrame:
            here = new.where(self._bucket(buckets).isin(*only)) if len(only) < buckets else new
            return self._rows(entries, only).join(known, self.key, "left_anti").select(*self.schema.names).unionByName(here)

        if total > 2 * buckets * self.bucket_rows:
            self._write_base(anew(set(entries)), batch_id, 2 * buckets)
            return
        heavy = {b for b, log in entries.items() if b in touched
                 and sum(n + k for _, n, k in log[1:]) + sizes.get(b, 0) + touched[b] > max(log[0][1], LEAST_CHANGES)}
        based = self._put("base", anew(heavy), batch_id, buckets) if heavy else {}
        self._log(batch_id, [(b, b in heavy, based.get(b, 0) if b in heavy else sizes.get(b, 0), touched[b]) for b in sorted(touched)], buckets)

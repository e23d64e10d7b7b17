"""Intermediate tables of one operator call, and row positions over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.session import fresh_path


class Workspace:
    """Tables in the shared folder that can be dropped one by one, as soon as a later one replaces them."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = fresh_path(spark, label)
        self._made = 0

    def path(self, label: str) -> str:
        self._made += 1
        return f"{self.root}/{self._made:03d}-{label}"

    def store(self, df: DataFrame, label: str) -> DataFrame:
        """Write once and read back: cuts the lineage without tying rows to one executor."""
        path = self.path(label)
        df.write.option("compression", "zstd").parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored.stored_at = path
        return stored

    def drop(self, *stored: DataFrame | None) -> None:
        """Delete stored tables that no result still reads."""
        for df in stored:
            if df is not None:
                self.drop_path(df.stored_at)

    def drop_path(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def positions(ws: Workspace, df: DataFrame, order: Sequence[str | Column], name: str, label: str) -> DataFrame:
    """``df`` stored in ``order`` with ``name``: the row's number from 0 over the whole table.

    Rows are range-partitioned, so no task sees more than its range, also if one value holds most
    rows and ``order`` goes on with other columns. Equal rows are numbered in any order. What is
    broadcast has one row per partition.
    """
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id()))
    stored = ws.store(ranged, label)
    part = F.shiftrightunsigned("_at", 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = (stored.join(F.broadcast(offsets), part == F.col("_p"))
           .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
           .drop("_at", "_p", "_before"))
    out.stored_at = stored.stored_at
    return out

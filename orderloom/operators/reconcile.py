"""Comparing two tables by columns, keys, values and key frequencies.

Keys are compared as text and NULL keys never match. Set questions tag both sides, union them and
aggregate once, so a key that fills a third of the rows shrinks before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Preferred key headers, in order (fixed values).
KEY_HEADERS = ("Số điện thoại", "Phone", "ID", "Code", "Mã")


def choose_key(left: Sequence[str], right: Sequence[str]) -> str | None:
    shared = [c for c in left if c in set(right)]
    return next((k for k in KEY_HEADERS if k in shared), shared[0] if shared else None)


def _q(name: str):
    return F.col(f"`{name}`")


def _text(name: str):
    return _q(name).cast("string")


def _sides(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Row counts of every key (NULL included) on both sides."""
    tag = lambda df, l, r: df.select(_text(key).alias("key"), F.lit(l).alias("l"), F.lit(r).alias("r"))
    return (tag(a, 1, 0).unionAll(tag(b, 0, 1)).groupBy("key")
            .agg(F.sum("l").alias("left_count"), F.sum("r").alias("right_count")))


def column_profile(a: DataFrame, b: DataFrame) -> DataFrame:
    """Shape of both tables and where each column name occurs."""
    spark = a.sparkSession
    shape = lambda df, side: df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("shape").alias("kind"), F.lit(side).alias("name"), "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_cols"))
    left, right = set(a.columns), set(b.columns)
    where = [("shared", c) for c in a.columns if c in right]
    where += [("left_only", c) for c in a.columns if c not in right]
    where += [("right_only", c) for c in b.columns if c not in left]
    names = spark.createDataFrame([(k, n, None, None) for k, n in where],
                                  "kind string, name string, n_rows long, n_cols long")
    return shape(a, "left").unionByName(shape(b, "right")).unionByName(names)


def summary(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    column_differences = len(set(a.columns) ^ set(b.columns))
    one_sided = F.col("key").isNotNull() & ((F.col("left_count") == 0) | (F.col("right_count") == 0))
    return _sides(a, b, key).agg(
        F.coalesce(F.sum("left_count"), F.lit(0)).alias("left_rows"),
        F.lit(len(a.columns)).cast("long").alias("left_cols"),
        F.coalesce(F.sum("right_count"), F.lit(0)).alias("right_rows"),
        F.lit(len(b.columns)).cast("long").alias("right_cols"),
        F.lit(column_differences).cast("long").alias("column_differences"),
        F.count_if(one_sided).alias("key_differences"),
    )


def keys_only_left(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key is not NULL and has no partner in ``b``."""
    others = b.select(_text(key).alias("_key")).where("_key IS NOT NULL").distinct()
    return (a.where(_q(key).isNotNull()).withColumn("_key", _text(key))
            .join(others, "_key", "left_anti").select(*[_q(c) for c in a.columns]))


def keys_only_right(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return keys_only_left(b, a, key)


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return (_sides(a, b, key).where("key IS NOT NULL AND left_count > 0 AND right_count > 0").select("key"))


def key_set_ops(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Union, both differences and the intersection of the two key sets, one row per (op, key)."""
    in_left, in_right = F.col("left_count") > 0, F.col("right_count") > 0
    ops = F.array_compact(F.array(
        F.lit("union"),
        F.when(in_left & ~in_right, "left_minus_right"),
        F.when(in_right & ~in_left, "right_minus_left"),
        F.when(in_left & in_right, "intersect")))
    return _sides(a, b, key).where("key IS NOT NULL").select(F.explode(ops).alias("op"), "key")


def value_differences(a: DataFrame, b: DataFrame, key: str, limit: int | None = None,
                      left_name: str = "left", right_name: str = "right") -> DataFrame:
    """One row per shared column whose values differ, for keys that occur once on each side.

    ``limit`` looks only at the first n such keys in key order.
    """
    shared = [c for c in a.columns if c in set(b.columns) and c != key]

    def singles(df: DataFrame, name: str) -> DataFrame:
        values = F.struct(*[_text(c).alias(f"c{i}") for i, c in enumerate(shared)])
        return (df.where(_q(key).isNotNull()).groupBy(_text(key).alias("Key"))
                .agg(F.count(F.lit(1)).alias("n"), F.first(values).alias(name))
                .where("n = 1").drop("n"))

    pairs = singles(a, "_l").join(singles(b, "_r"), "Key")
    if limit is not None:
        pairs = pairs.orderBy("Key").limit(limit)
    cells = F.array(*[F.struct(F.lit(c).alias("Column"), F.col(f"_l.c{i}").alias("l"), F.col(f"_r.c{i}").alias("r"))
                      for i, c in enumerate(shared)])
    differing = F.filter(cells, lambda x: ~x["l"].eqNullSafe(x["r"]))
    return pairs.select("Key", F.explode(differing).alias("_d")).select(
        "Key", "_d.Column", F.col("_d.l").alias(f"{left_name}_Value"), F.col("_d.r").alias(f"{right_name}_Value"))


def frequency_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return (_sides(a, b, key).where("key IS NOT NULL AND left_count <> right_count")
            .withColumn("difference", F.col("left_count") - F.col("right_count")))


def frequency_top(a: DataFrame, b: DataFrame, key: str, n: int | None = None) -> DataFrame:
    ranked = frequency_differences(a, b, key).orderBy(F.abs("difference").desc(), "key")
    return ranked if n is None else ranked.limit(n)


def value_counts(df: DataFrame, key: str) -> DataFrame:
    return (df.where(_q(key).isNotNull()).groupBy(_text(key).alias("key"))
            .agg(F.count(F.lit(1)).alias("n")))


def distinct_key_count(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.countDistinct(_text(key)).alias("n_keys"))


#: Registers of a sketch, as a power of two.
SKETCH_BITS = 12


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """Relative standard error of a sketched count."""
    return 1.04 / 2 ** (bits / 2)


def key_sketches(df: DataFrame, key: str, by: Sequence[str] = (), bits: int = SKETCH_BITS) -> DataFrame:
    """Per group one sketch of its different keys (about 2**bits bytes): stored, it can be merged with later ones. NULL keys don't count."""
    return df.groupBy(*[_q(c) for c in by]).agg(F.hll_sketch_agg(_text(key), F.lit(bits)).alias("sketch"))


def sketched_key_count(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Approximate number of different keys per group of sketches, within ``sketch_error`` (about 2 in 3 counts; three times it: nearly all)."""
    return sketches.groupBy(*[_q(c) for c in by]).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_keys"))


def null_profile(df: DataFrame, key: str) -> DataFrame:
    """Wholly NULL rows and NULL keys. NaN counts as NULL, as in a data frame of floats."""
    floats = (T.DoubleType, T.FloatType)
    empty = F.lit(True)
    for f in df.schema.fields:
        gone = _q(f.name).isNull()
        empty &= (gone | F.isnan(_q(f.name))) if isinstance(f.dataType, floats) else gone
    return df.agg(F.count_if(empty).alias("empty_rows"), F.count_if(_q(key).isNull()).alias("null_keys"))


def sample_keys(a: DataFrame, b: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` keys in order that occur on one side only."""
    sides = _sides(a, b, key).where("key IS NOT NULL")
    pick = lambda cond, side: (sides.where(cond).orderBy("key").limit(n)
                               .select(F.lit(side).alias("side"), "key"))
    return pick("right_count = 0", "left").unionByName(pick("left_count = 0", "right"))


def preview(a: DataFrame, b: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """First ``n`` rows of both tables, with their ``side``; NULLs come last. A column that only one has is NULL in the other."""
    side = lambda df, name: (df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
                             .select(F.lit(name).alias("side"), *df.columns))
    return side(a, "left").unionByName(side(b, "right"), allowMissingColumns=True)

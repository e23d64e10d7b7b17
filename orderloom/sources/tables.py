"""Reading and writing plain tables, and finding columns by header."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.text import ACCENTED, PLAIN


def _format_of(path: str, fmt: str | None) -> str:
    return fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")


# Cells may hold line breaks, commas and quotes; a cell with one of these is quoted, and quotes in it are written double.
_CELLS = {"multiLine": True, "escape": '"'}


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files as text, in ``record``, but for each file's header; a file of any size feeds many tasks.

    Spark deals out a file's lines by splits. Whether a line starts a record depends on whether the quotes before it, in the whole file, are
    even: each split's quotes are counted, the counts are added up split by split, and so each split knows how its first
    line stands. Lines that belong to one record are put together; all others pass as they are. Windows see one split each, or one
    row per split. ``place`` orders the records as they stand: file, split, line.
    """
    lines = (spark.read.text(path, lineSep="\n")
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("at"), "value"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = (lines.groupBy("file", "split").agg((F.sum(quotes) % 2).alias("_odd"))
              .select("file", "split", (F.coalesce(F.sum("_odd").over(in_file), F.lit(0)) % 2).alias("_open")))
    here = Window.partitionBy("file", "split").orderBy("at")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    placed = (lines.join(splits, ["file", "split"])
              .withColumn("_starts", (F.col("_open") + F.coalesce(F.sum(quotes).over(before), F.lit(0))) % 2 == 0)
              .withColumn("_start", F.last(F.when(F.col("_starts"), F.col("at")), ignorenulls=True).over(
                  here.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
              .withColumn("_ends", (F.col("_open") + F.sum(quotes).over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow))) % 2 == 0)
              .select("file", "split", "at", "value", "_starts", "_ends", "_start"))
    # Lines before the first start of a split belong to the last start of an earlier one.
    lasts = placed.groupBy("file", "split").agg(F.max("_start").alias("_last"))
    carried = lasts.select("file", "split", F.max(F.when(F.col("_last").isNotNull(), F.struct("split", F.col("_last").alias("at")))).over(in_file).alias("_from"))
    header = lines.groupBy("file").agg(F.min(F.struct("split", "at")).alias("_head"))
    mine = F.coalesce(F.when(F.col("_start").isNotNull(), F.struct("split", F.col("_start").alias("at"))), F.col("_from"))
    named = (placed.join(carried, ["file", "split"]).withColumn("_record", mine).join(header, "file").where("_record <> _head"))
    place = F.struct("file", F.col("_record.split").alias("split"), F.col("_record.at").alias("line")).alias("place")
    whole = named.where("_starts AND _ends").select(F.col("value").alias("record"), place)
    several = (named.where("NOT (_starts AND _ends)").groupBy("file", "_record")
               .agg(F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("_l"))
               .select(F.array_join(F.transform("_l", lambda l: l["value"]), "\n").alias("record"), place))
    return whole.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")


def _csv_columns(spark: SparkSession, path: str) -> list[str]:
    return [c.removesuffix("\r") for c in spark.read.csv(path, header=True, inferSchema=False, **_CELLS).columns]


def _parsed(records: DataFrame, schema: T.StructType, place: str | None) -> DataFrame:
    # a name may be empty or repeated in the file, so fields go by place
    plain = T.StructType([T.StructField(f"_{i}", f.dataType) for i, f in enumerate(schema.fields)])
    row = F.from_csv("record", plain.simpleString()[len("struct<"):-1].replace(":", " "), {k: str(v).lower() for k, v in _CELLS.items()})
    return records.select(row.alias("_row"), "place").select(
        *[F.col(f"_row._{i}").alias(f.name) for i, f in enumerate(schema.fields)], *([F.col("place").alias(place)] if place else []))


def read_string_table(spark: SparkSession, path: str, fill_blank: bool = False, fmt: str | None = None, place: str | None = None) -> DataFrame:
    """Every column as text; ``fill_blank`` turns NULL into "" (the mapping table's reading).

    Many tasks read a CSV file, so its rows come in no order; ``place`` names a further column that orders them as they stand.
    """
    if _format_of(path, fmt) == "csv":
        schema = T.StructType([T.StructField(c, T.StringType()) for c in _csv_columns(spark, path)])
        df = _parsed(csv_records(spark, path), schema, place)
    else:
        raw = spark.read.parquet(path)
        df = raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns])
    return df.fillna("") if fill_blank else df


def _inferred(df: DataFrame) -> T.StructType:
    """Per column the first of whole number, long, double, date, timestamp and boolean that all its values are; else text."""
    kinds = [T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(), T.TimestampType(), T.BooleanType()]
    date = r"^\s*\d{4}-\d{2}-\d{2}\s*$"
    fits = []
    for i, name in enumerate(df.columns):
        c = F.col(f"`{name}`")
        for j, kind in enumerate(kinds):
            ok = c.try_cast(kind).isNotNull()
            if isinstance(kind, (T.IntegerType, T.LongType)):
                ok &= c.rlike(r"^[+-]?\d+$")
            if isinstance(kind, T.DateType):
                ok &= c.rlike(date)
            if isinstance(kind, T.TimestampType):
                ok &= c.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:")
            if isinstance(kind, T.BooleanType):
                ok &= F.lower(c).isin("true", "false")
            fits.append(F.bool_and(F.when(c.isNotNull(), ok)).alias(f"{i}_{j}"))
    found = df.agg(*fits).first() if fits else {}
    chosen = lambda i: next((k for j, k in enumerate(kinds) if found[f"{i}_{j}"]), T.StringType())
    return T.StructType([T.StructField(name, chosen(i)) for i, name in enumerate(df.columns)])


def read_inferred_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Header and inferred types; parquet brings its own types. CSV is read twice, once for the types."""
    if _format_of(path, fmt) == "csv":
        text = read_string_table(spark, path, fmt="csv")
        schema = _inferred(text)
        return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("error").csv(path, header=True, escape=_CELLS["escape"])
    return path


def write_diffs(only_left: DataFrame, only_right: DataFrame, differences: DataFrame, path: str) -> dict[str, str]:
    """The three reconciliation results as CSV, one directory each."""
    parts = {"only_left": only_left, "only_right": only_right, "value_differences": differences}
    return {name: write_csv(df, os.path.join(path, f"{name}.csv")) for name, df in parts.items()}


def write_mapped(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    if fmt == "csv":
        return write_csv(df, path)
    df.write.mode("error").format(fmt).save(path)
    return path


# --- columns by header ------------------------------------------------------------------------

# Header patterns of the mapping and data tables (fixed values).
OLD_CODE = (r"mã\s*gốc", r"ma\s*goc", r"old.*code", r"code.*old", r"mã\s*cũ", r"ma\s*cu")
OLD_NAME = (r"tên\s*gốc", r"ten\s*goc", r"old.*name", r"name.*old", r"tên\s*cũ", r"ten\s*cu")
NEW_CODE = (r"mã\s*mới", r"ma\s*moi", r"new.*code", r"code.*new", r"mã\s*thay", r"ma\s*thay")
NEW_NAME = (r"tên\s*mới", r"ten\s*moi", r"new.*name", r"name.*new", r"tên\s*thay", r"ten\s*thay")
DATA_CODE = OLD_CODE + ("ma.*hang", "code")
DATA_NAME = OLD_NAME + ("ten.*hang", "name")
CODE_HEADER, NAME_HEADER = "Mã hàng", "Tên hàng"
MAPPING_PATTERNS = {"old_code": OLD_CODE, "old_name": OLD_NAME, "new_code": NEW_CODE, "new_name": NEW_NAME}

_STRIP_ACCENTS = str.maketrans(ACCENTED, PLAIN)


def normalize_name(name: str) -> str:
    return re.sub("[^a-z0-9]", "", name.lower().translate(_STRIP_ACCENTS))


def find_column(names: Sequence[str], patterns: Sequence[str]) -> str | None:
    """First pattern that hits a normalised header, else first one literally inside a raw header."""
    # On equal normalised headers the last one stands for both, at the place of the first.
    by_plain = {normalize_name(n): n for n in names}
    hits = (n for p in patterns for plain, n in by_plain.items() if re.search(p.lower(), plain))
    literal = (n for p in patterns for n in names if p.lower() in n.lower())
    return next(hits, None) or next(literal, None)


def resolve_columns(names: Sequence[str], patterns: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Role -> header for every role; an unmatched role is an error."""
    found = {role: find_column(names, pats) for role, pats in patterns.items()}
    missing = [role for role, name in found.items() if not name]
    if missing:
        raise ValueError(f"no column found for {', '.join(missing)} among: {', '.join(names)}")
    return found


def as_mapping(df: DataFrame, row_no: str = "row_no") -> DataFrame:
    """(row_no, old_code, old_name, new_code, new_name) from a mapping table under free headers."""
    roles = resolve_columns([c for c in df.columns if c != row_no], MAPPING_PATTERNS)
    return df.select(row_no, *[F.coalesce(F.col(f"`{h}`").cast("string"), F.lit("")).alias(r)
                               for r, h in roles.items()])


def as_data(df: DataFrame) -> DataFrame:
    """The data table with its code (required) and name (optional) under their standard headers."""
    if CODE_HEADER not in df.columns:
        code = find_column(df.columns, DATA_CODE)
        if not code:
            raise ValueError(f"no column '{CODE_HEADER}' or similar among: {', '.join(df.columns)}")
        df = df.withColumnRenamed(code, CODE_HEADER)
    if NAME_HEADER not in df.columns:
        name = find_column(df.columns, DATA_NAME)
        if name:
            df = df.withColumnRenamed(name, NAME_HEADER)
    return df

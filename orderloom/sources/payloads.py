"""Order requests: JSON payload text to typed nested columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schema import PAYLOAD

REQUEST = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("submitted_at", T.TimestampType()),
    T.StructField("payload", T.StringType()),
])
_BAD = "_corrupt_record"


def parse_payloads(requests: DataFrame) -> DataFrame:
    """Adds ``doc`` (typed payload, NULL when malformed) and the flag ``_corrupt``.

    Works on a batch table and on a stream alike.
    """
    schema = T.StructType([*PAYLOAD.fields, T.StructField(_BAD, T.StringType())])
    raw = F.from_json("payload", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    # Through a one-element explode: filters on the document then stay above the parser, while
    # through a projection each of them would be pushed down with a copy of it.
    parsed = requests.select("*", F.explode(F.array(raw)).alias("_raw"))
    bad = F.col("_raw").isNull() | F.col(f"_raw.{_BAD}").isNotNull()
    doc = F.when(~bad, F.struct(*[F.col(f"_raw.{f}").alias(f) for f in PAYLOAD.names]))
    return parsed.withColumn("doc", doc).withColumn("_corrupt", bad).drop("_raw")


def read_request_stream(spark: SparkSession, path: str) -> DataFrame:
    """New request files under ``path``, one JSON request per line."""
    return spark.readStream.schema(REQUEST).json(path)

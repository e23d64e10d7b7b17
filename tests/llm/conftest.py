import random

import pytest
from pyspark.sql import types as T

CLASHING = ("tag", "key", "id", "_id", "_tag", "_spans", "start", "score", "fp", "sequence_id", "length")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       *(T.StructField(c, T.StringType()) for c in CLASHING)])


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def make(spark, pairs):
    return spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), *(None,) * len(CLASHING)) for i, t in pairs], SCHEMA)


@pytest.fixture(scope="session")
def odd_pairs():
    """Nulls, empty and long texts, repeated rows, repeated and null ids, copies, near copies, shared passages."""
    rng = random.Random(7)
    base, passage = words(rng, 120), words(rng, 90)
    near = base.split()
    near[60] = "changed"
    pairs = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "Two words"), (5, base), (6, base), (7, " ".join(near)), (7, " ".join(near)),
             (8, words(rng, 30) + " " + passage + " " + words(rng, 40)), (9, passage + "\n" + words(rng, 60)), (10, passage),
             (11, words(rng, 20_000)), (12, "é" * 3000 + " ü ñ"), (13, "ab" * 2000), (None, base), (None, None), (14, "x" * 399), (15, "x" * 399),
             (16, "Tab\tand  two spaces\n\nend. "), (17, words(rng, 49)), (18, words(rng, 50))]
    pairs += [(100 + i, words(rng, rng.randrange(1, 300))) for i in range(20)]
    pairs += [(-5, pairs[-1][1]), (200, pairs[-2][1] + " tail")]
    return pairs


@pytest.fixture(scope="session")
def odd(spark, odd_pairs):
    return make(spark, odd_pairs).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return make(spark, [])


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)

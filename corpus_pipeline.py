"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before it kept, works on all of them and returns those that stay, with
the columns of ``documents``; the last returns the packed pieces. ``run`` calls them one after another and stores each result, so a
stage starts from a table and not from the plans before it.

1. toxicity: documents that the field predicts as toxic go.
2. simhash: one document of each group of near duplicates stays, the one with the smallest doc_id.
3. suffix_array: bytes of 240-byte strings that occur anywhere else go from the texts; a document may be left with no text.
   240 bytes are what 51 words have at least in 99 of 100 places of the four languages, so a passage of over 50 words goes, whatever its words.
4. decontamination: documents with a benchmark passage go.
5. packing: the texts' token ids are packed into sequences of 1024.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import decontaminate, packing, simhash, suffix_array, toxicity
from orderloom.llm.queries import table, tokenizer_path
from orderloom.llm.workspace import Workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


#: Bytes of a repeat that the third stage cuts, and of the pieces that its search starts from.
REPEAT_BYTES, REPEAT_SEED = 240, 48


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_array.without_repeats(docs, REPEAT_BYTES, REPEAT_SEED)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("suffix_array", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: Trained scores, byte-level suffix sorting and tokenization have no SQL form; tests/llm runs the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all that the stages keep of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    ws = Workspace(spark, "pipeline")
    for name, stage in STAGES:
        stored = ws.store(stage(spark, docs, sf_dir), name)
        if docs is not None and hasattr(docs, "stored_at"):
            ws.drop(docs)
        docs = stored
    return docs

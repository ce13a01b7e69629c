"""The corpus pipeline: documents without toxicity and near duplicates, mixed
to target weights and encoded.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a frame, which is written as Parquet and reread as the next one's
``docs``. All but the last return the columns of ``documents``. ``run`` applies
them to the whole table under ``sf_dir``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from argent.llm.bpe import digests
from argent.llm.common import landed, table
from argent.llm.lshforest import one_of_each
from argent.llm.mixing import repeated
from argent.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier trained on ``labels`` doesn't reject."""
    return without_toxic(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (the smallest doc_id)."""
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: number of tokens and digests of the ids and the decoded text."""
    return digests(docs, "text", ["doc_id", "source"], public_tokenizers.path("byte_bpe_50k.json"),
                   public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("mix", mix), ("encode", encode)]

#: Trained weights, hashes and BPE have no SQL form; the stages are tested one
#: by one against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs

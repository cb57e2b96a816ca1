"""The corpus pipeline: language ID, quality rules, near-duplicates, packing.

Each stage works on all rows that the one before kept, written as Parquet and read again.  The first
three return the columns of documents as they are, the last one the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from talentgrid.llm import langid, packing, quality, simhash
from talentgrid.llm.frames import new_folder, table

#: SimHash: words of a shingle are the operator's; bits in which linked documents may differ.
MOST_BITS = 4
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SEQUENCE_TOKENS = 2048
#: Words that a worker remembers in packing: workers also hold what earlier stages left.
REMEMBERED = 50_000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a language that the labels name; null texts and texts without letters go.

    The model learns from text and lang of the rows given; without any label it rejects all.
    """
    return langid.accepted(docs, langid.train(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules; the target is taken from the folder's labels."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest doc_id."""
    return simhash.one_of_each(docs, MOST_BITS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences."""
    return packing.pack(docs, TOKENIZER, SEQUENCE_TOKENS, remembered=REMEMBERED)


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("near_duplicates", without_near_copies),
    ("packing", packed),
]

#: SQL can't express language ID and packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed sequences, in stages that each call one operator of `orderlake.llm`.

Every stage but the last returns the columns of `documents`, with whole texts and only fewer rows.
"""

from pyspark.sql import DataFrame, SparkSession

from orderlake.llm.decontamination import decontaminate
from orderlake.llm.language import in_known_language
from orderlake.llm.packing import pack_documents
from orderlake.llm.queries import WORD_BPE, table
from orderlake.llm.scratch import stage
from orderlake.llm.simhash import one_of_each
from orderlake.llm.toxicity import without_toxic


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents predicted toxic."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in no learnt language."""
    return in_known_language(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by the fingerprints and the two bits of `op6_simhash`."""
    return one_of_each(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold benchmark passages."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packing plan of all documents that are left."""
    return pack_documents(docs, WORD_BPE)


STAGES = [
    ("toxicity", not_toxic),
    ("language", known_language),
    ("near duplicates", distinct),
    ("decontamination", not_in_benchmark),
    ("packing", packed),
]

# Trained models, fingerprints and tokenizers are not SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

"""The operators as queries over the given tables, with SQL where SQL can express them."""

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderlake.llm import licenses, ranked_search

QUERIES = {}
ORACLES = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
UNIGRAM = public_tokenizers.path("piece_bpe_32k.model")


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing plan of all documents into sequences of 2048 ids."""
    from orderlake.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the token files and back."""
    from orderlake.llm.token_files import token_table

    return token_table(spark, table(spark, sf_dir, "documents"), WORD_BPE)


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    from orderlake.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under the unigram base and under the class model."""
    from orderlake.llm.class_lm import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


@query
def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    from orderlake.llm.decontamination import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in documents: on lines and blocks of their own, and anywhere in the text."""
    from orderlake.llm.licenses import embedded_licenses, scan_licenses

    docs = table(spark, sf_dir, "documents")
    return scan_licenses(docs).union(embedded_licenses(docs))


ORACLES["op9_license_scan"] = licenses.oracle_sql()


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    from orderlake.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    from orderlake.llm.language import predict_language

    return predict_language(table(spark, sf_dir, "documents"))


@query
def op7_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    from orderlake.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the unigram vocabulary."""
    from orderlake.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), UNIGRAM)


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations and their cheapest repair."""
    from orderlake.llm.conversations import repaired_conversations

    return repaired_conversations(table(spark, sf_dir, "conversations"))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_ranked_search"] = ranked_search.oracle_sql()


@query
def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from orderlake.llm.main_text import with_main_text

    return with_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")

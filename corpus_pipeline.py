"""Corpus pipeline: quality rules, exact dedup, near dedup, mixing, tokens.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.  Every
stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barsmith.llm import entropy_mix, line_quality, minhash_forest, piece_dropout, trie_dedup
from barsmith.llm.queries import tokenizer_path
from barsmith.llm.runtime import read_documents
from barsmith.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; lines over a host's limit are cut from the others."""
    return line_quality.apply(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row stays."""
    return trie_dedup.dedup(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest doc_id stays."""
    return minhash_forest.dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is repeated as often as the mix takes it; some go."""
    return entropy_mix.apply(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become merge-dropout piece ids; the copies of a document are cut each in its own way."""
    return piece_dropout.encode_copies(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding", sentencepiece),
]

#: SQL cannot express MinHash recall, Newton steps or BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Training corpus from raw documents: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and read again for the next stage.  All but the last return
the columns of ``documents``.  Rows with null or empty texts pass the copies and
benchmark stages as their operators define, but have no language and go first.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.llm import bpe, decontam, dedup_exact, langid, ngram_join
from docspark.llm.common import load, materialise, prepare


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go (all, if no label is learned from); labels of the held-out fifth are not learned from.

    Which language is found rejects no row: text in a language that was never learned stays.
    """
    prepare(spark)
    samples = langid.sample(docs.where(~langid.held_out("doc_id")).select("text", "lang"))
    known = langid.identify(docs, samples).where(F.col("lang_pred") != langid.UNKNOWN)
    return known.drop("lang_pred", "score").toDF(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    prepare(spark)
    return dedup_exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    prepare(spark)
    return ngram_join.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or nearly one, go."""
    return decontam.remove(docs, load(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether decoding them gives the text back."""
    prepare(spark)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.encode(docs, path, pattern, verify=True).select("doc_id", "lang", "source", "n_tokens", "token_ids", "round_trip")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("byte_bpe", tokenise),
]

# Language models, edit distances and token ids are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs

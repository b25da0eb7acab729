"""The corpus pipeline: quality, exact and near copies, benchmark passages, then token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltworks.llm import bpe, decontaminate, grace, jaccard, quality
from siltworks.session import stage

#: The rank file of the last stage, and the least quality score that stays.
RANKS = "byte_bpe_multi_50k.tiktoken"
LEAST_SCORE = quality.THRESHOLD
#: Documents are similar if their sets of shingles of so many words share so much of their union.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on ``labels``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels), threshold=LEAST_SCORE)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return grace.keep_best(docs)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similar shingles join."""
    return jaccard.keep_one(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of what is left; ids are packed as little-endian 32-bit integers."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path(RANKS))


STAGES = [("quality", good), ("exact_dedup", distinct), ("near_dedup", dissimilar),
          ("decontamination", uncontaminated), ("tokens", tokens)]

#: A trained classifier and a tokenizer can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

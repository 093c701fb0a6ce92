"""The corpus pipeline: quality, near-duplicates, personal data, mixture, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logroll.llm import mixing, near_dup, packing, pii, quality
from logroll.llm.common import freeze, prepare, table, tidy_driver


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the co-trained classifier rejects go."""
    prepare(spark)
    return quality.accepted(spark, docs, sf_dir)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays (five-word shingles, similarity 0.8 or more)."""
    prepare(spark)
    return near_dup.keep_one(docs, percent=80, k=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data get keyed surrogates."""
    prepare(spark)
    tidy_driver(spark)
    return pii.replace_personal_data(docs, count=None)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of each source near its target; a row per document and pass with the words taken."""
    prepare(spark)
    tidy_driver(spark)
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their token ids; every row of the mixture is a document."""
    import public_tokenizers
    prepare(spark)
    tidy_driver(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [("quality_classifier", quality_classifier), ("near_dedup", near_dedup), ("personal_data", personal_data),
          ("source_mixture", source_mixture), ("packing", packed)]

#: No SQL: the model, the hashes and the draws of the stages have no SQL form (see tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir), name)
    return docs

"""Corpus pipeline over ``documents``: five stages, each an operator of cartwheel.llm.

Every stage works on all that its predecessor kept and its decisions take
effect; all but the last return the columns of ``documents``. Stages are
written as Parquet to the shared folder and read again, so a lost executor costs
the running stage at most. Empty input gives empty output; nulls, repeated rows
and extra columns follow the operators' docstrings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import exact_dedup, minhash_dedup, mixing, quality, sentencepiece_codec
from cartwheel.llm.common import documents, importable, stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, quality.fit(docs, quality.training_fold(labels)))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8."""
    importable(spark)
    return minhash_dedup.deduplicate(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs, F.array("source"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of what is left, one row per row."""
    importable(spark)
    return sentencepiece_codec.digests(sentencepiece_codec.recode(docs))


STAGES = [("quality", quality_filter), ("exact_dedup", exact_duplicates), ("minhash_dedup", near_duplicates),
          ("source_mix", source_mix), ("sentencepiece", sentencepiece)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

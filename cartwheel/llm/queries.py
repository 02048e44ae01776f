"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import (collocations, embedding_dedup, exact_dedup, lm_score, minhash_dedup, mixing, packing, quality,
                           sentencepiece_codec, suffix_dedup, token_output, toxicity, turn_repair)
from cartwheel.llm.common import documents, fold, importable, scratch

UP, LO = exact_dedup.UPPER, exact_dedup.LOWER


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_output.write_token_files(documents(spark, sf_dir), path)
    return token_output.read_digests(spark, path)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.deduplicate(documents(spark, sf_dir)))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(documents(spark, sf_dir))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(documents(spark, sf_dir), fold("doc_id", 7) == 2)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.taken(documents(spark, sf_dir), F.array("source"))
    own = F.col("by_source")[0]
    return got.select("doc_id", "size", own["source_size"].alias("source_size"), own["target"].alias("target"), "taken")


def op6_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return embedding_dedup.links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir), shingle=2, percent=80)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades 0 to 2; toxic when a grade above 0 is likelier than not."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, toxicity.weak_grades(docs, labels))
    p = F.col("p_grades")
    return toxicity.score(docs, model).select(
        "doc_id", "expected_severity", (F.lit(1.0) - p[0]).alias("p_toxic"),
        (F.array_position(p, F.array_max(p)) - 1).cast("int").alias("grade"), (p[0] < 0.5).alias("toxic"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, quality.training_fold(labels))
    return quality.score(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(sentencepiece_codec.recode(documents(spark, sf_dir)))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(documents(spark, sf_dir)))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    turns = turn_repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return turn_repair.digests(turn_repair.repair(turns, present=F.col("present")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_output, op2_suffix_dedup, op3_exact_dedup, op4_lm_score, op5_source_mix, op6_embedding_links, op7_minhash, op8_toxicity, op9_quality_rules, op10_sentencepiece,
                               op11_collocations, op12_packing, op13_turn_repair)}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UP}', '{LO}') AS norm FROM documents),
             g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM d JOIN g USING (norm)""",
}

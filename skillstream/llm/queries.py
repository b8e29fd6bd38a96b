"""The queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, extract, infill, mixing, neardup, negatives, pieces, quality, rules, sharding, toxicity, vectors, warc
from .common import table


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_counts(table(spark, sf_dir, "documents"))


def op7_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_mix, op2_near_duplicates, op3_shards, op4_quality_rules, op5_byte_bpe, op6_token_counts, op7_quality_score, op8_main_text,
    op9_toxicity, op10_near_vectors, op11_warc,
    op12_hard_negatives, op13_fill_in_middle)}

#: DuckDB SQL of the queries that SQL can express. The others are tested against brute force, round trips or held-out rows.
ORACLE_SQL = {"op1_mix": mixing.MIX_SQL, "op4_quality_rules": rules.RULES_SQL, "op11_warc": warc.WARC_SQL,
              "op12_hard_negatives": negatives.NEGATIVES_SQL,
              "op13_fill_in_middle": infill.INFILL_SQL}

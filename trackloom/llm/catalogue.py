"""The registered queries of the training-data operators, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import ann, hard_negatives, language_id, minhash, mixing, packing, quality, secrets, simhash, token_ids, tokens, toxicity, url_filter, whitening
from trackloom.sources.tables import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.read(*token_ids.write(table(spark, sf_dir, "documents"), tokens.default_path()))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokens.default_path())


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.held_out_labels(table(spark, sf_dir, "documents"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))[1]


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.turned_labels(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_ids": op2_token_ids,
    "op3_packing": op3_packing,
    "op4_language_id": op4_language_id,
    "op5_ann": op5_ann,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_url_filter": op10_url_filter,
    "op11_whitening": op11_whitening,
    "op12_minhash": op12_minhash,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE_SQL: dict[str, str] = {
    "op6_mixing": mixing.ORACLE_SQL,
    "op10_url_filter": url_filter.ORACLE_SQL,
    "op12_minhash": minhash.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}

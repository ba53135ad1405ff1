"""The thin registered queries: each runs its operator with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glossa.llm import ball_codes, bpe_tables, chat_format, decontaminate, exact_dedup, group_matrix, language_id, periodic_runs, pivot_simhash, suffix_dedup, toxicity, url_filter, warc_derive
from glossa.llm.common import Queries, documents


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digest(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(documents(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.chat_digest(chat_format.with_probe(spark, documents(spark, sf_dir, "conversations")))


def op7_bpe_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tables.encode_documents(documents(spark, sf_dir))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(documents(spark, sf_dir, "pages"))


def op9_warc_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_derive.derivative_digest(documents(spark, sf_dir, "pages"))


def op10_group_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_matrix.jaccard_components(documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(periodic_runs.plant_runs(documents(spark, sf_dir)))


def op12_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_simhash.simhash_components(documents(spark, sf_dir))


def op13_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_codes.code_digest(documents(spark, sf_dir, "embeddings"))


QUERIES: Queries = {f.__name__: f for f in (
    op1_suffix_dedup, op2_language_id, op3_exact_dedup, op4_decontaminate, op5_toxicity, op6_chat_format, op7_bpe_tables, op8_url_filter, op9_warc_derive,
    op10_group_matrix, op11_periodic_runs, op12_pivot_simhash, op13_ball_codes)}

ORACLE = {"op3_exact_dedup": exact_dedup.ORACLE, "op4_decontaminate": decontaminate.ORACLE,
          "op6_chat_format": chat_format.ORACLE, "op8_url_filter": url_filter.ORACLE,
          "op9_warc_derive": warc_derive.ORACLE, "op13_ball_codes": ball_codes.ORACLE}

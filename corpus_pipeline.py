"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage works on all documents that the one before it kept, and its decisions take effect:

1. ``language_id``  drops documents whose language can't be told (no letters, or a score under ``LEAST_SCORE``);
2. ``exact_dedup``  keeps one document of each exact text;
3. ``near_dedup``   keeps the document with the smallest id (then text key) of each component of the n-gram Jaccard join;
4. ``decontaminate``  drops documents that overlap with a benchmark item;
5. ``bpe``          returns the ids of every remaining text, with counts and digests.

All stages but the last return the columns of documents.  Documents are told apart by id and text, so repeated rows count as copies.
Defined results: rows without an id are told apart by text alone; null and empty texts have no letters and are dropped by the first stage; an empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm import bpe_tables, decontaminate, exact_dedup, group_matrix, language_id
from glossa.llm.common import discard, documents, internal_id, scratch, staged, unused, without

LEAST_SCORE = 0.5


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _without(docs: DataFrame, dropped: DataFrame, text_key: Column, rows: int) -> DataFrame:
    """``docs`` without the rows whose id and text key are in ``dropped`` (``doc_id, text_key``): broadcast if few, else Spark shuffles."""
    dropped = staged(dropped.select(internal_id().alias("_id"), "text_key").distinct(), "pipeline-dropped", rows)
    return without(docs, dropped, {"_id": internal_id(), "text_key": text_key})


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    told = language_id.language_id(docs)
    rejected = told.where((F.col("lang_pred") == language_id.UNDETERMINED) | (F.col("score") < LEAST_SCORE))
    return _without(docs, rejected, _text_key(F.col("text")), docs.count())


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    told = exact_dedup.exact_dedup(docs)
    text = F.sha2(exact_dedup.normalised(F.col("text")), 256)
    dropped = told.groupBy("doc_id", F.col("text_sha256").alias("text_key")).agg(F.max("kept").alias("kept")).where("NOT kept")
    kept = _without(docs, dropped, text, docs.count())
    if not told.where("kept = false AND keep_id <=> doc_id").limit(1).count():
        return kept
    key = unused(docs.columns, "_text")
    return kept.withColumn(key, text).dropDuplicates(["doc_id", key]).drop(key)  # the kept row itself is repeated


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    told = group_matrix.with_first(docs)
    first = F.col("component_id").eqNullSafe(F.col("doc_id")) & (F.col("component_key") == F.col("text_key"))
    return _without(docs, told.where(~first), _text_key(F.col("text")), docs.count())


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_only(docs, documents(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe_tables.encode_texts(docs)
    return encoded.select("doc_id", "n_tokens", F.transform(F.filter(F.split("ids", " "), lambda i: i != ""), lambda i: i.cast("int")).alias("ids"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage), ("bpe", bpe_stage)]

#: Language identification and the tokenizer can't be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written in the shared folder and read again.

    When a stage's result is written, the tables it made on the way and the result before it are deleted.
    """
    docs, results = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        with scratch(results):
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
            results.append(docs)
        for done in results[:-1]:
            discard(done)
        results = results[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)

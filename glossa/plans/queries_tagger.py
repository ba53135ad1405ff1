"""Registered queries: the Spark ML token tagger, its predictions, argmax and evaluation."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions.text import explode_rows
from glossa.operators import agreement as A
from glossa.operators import tagger as TG
from glossa.operators.entities import entities_from_long
from glossa.operators.lookup import materialise
from glossa.operators.tokens import tokenize
from glossa.plans import sql as S
from glossa.operators import windows as W
from glossa.plans.queries import _round, register, row_labels, word_label_wide, word_wide
from glossa.plans.queries_lm import RATIO
from glossa.artifacts import artifact
from glossa.sources.corpus import line_source

def split_texts(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    """``(doc_id, toks, labels, upto)``: the texts that the split has tokens of, with their ``auto`` heuristic labels; a text's first ``upto`` tokens are train (the token stream cut at 90 %)."""
    _, cut_doc, cut_pos = W.split_point(word_wide(spark, sf_dir), RATIO)  # no labels are made to count tokens
    texts, n = word_label_wide(spark, sf_dir, "l0"), F.size("toks")
    if cut_doc is None:
        return texts.withColumn("upto", n).where(F.lit(split == "train"))
    before, here = F.coalesce(F.col("doc_id") < F.lit(cut_doc), F.lit(False)), F.coalesce(F.col("doc_id") == F.lit(cut_doc), F.lit(False))
    # By document: a condition on the tokens would cut the texts into words once more.
    return texts.where(before | here if split == "train" else ~before).withColumn(
        "upto", F.when(before, n).when(here, F.least(n, F.lit(cut_pos))).otherwise(0))


def tagger_path(spark: SparkSession, sf_dir: str) -> str:
    """Where the tagger for the input lies; fitted on the whole train split and saved first if no application has."""
    def fit(path: str) -> None:
        model, history = TG.tagger_fit(split_texts(spark, sf_dir, "train"))
        history.write.mode("overwrite").parquet(f"{path}/history")
        model.write().overwrite().save(f"{path}/model")

    return artifact(spark, "tagger", sf_dir, fit)


def fitted_tagger(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return PipelineModel.load(f"{tagger_path(spark, sf_dir)}/model")


@register("tagger_fit")
def q_tagger_fit(spark, sf_dir):
    return spark.read.parquet(f"{tagger_path(spark, sf_dir)}/history")


@register("tagger_predict")
def q_tagger_predict(spark, sf_dir):
    """Every line of every document -> tokens -> predicted labels -> entities per line (the ``ner`` command)."""
    from glossa.sources.corpus import read_documents
    model = fitted_tagger(spark, sf_dir)
    keep = ("doc_id", "line_no")
    lines = line_source(read_documents(spark, sf_dir))
    wide = tokenize(lines, "word", text="line", keep=keep)
    pred = TG.tagger_predict(model, wide, keep=keep)
    return entities_from_long(pred, "pred", sep=" ", keep=keep)


@register("tagger_eval")
def q_tagger_eval(spark, sf_dir):
    """Tagger predictions against the ``auto`` heuristic labels on the validation split, which the fit didn't see."""
    model = fitted_tagger(spark, sf_dir)
    texts = TG.label_texts(model, split_texts(spark, sf_dir, "val"))
    z = F.arrays_zip(F.col("labels").alias("l_auto"), F.col("pred").alias("l_tagger"))
    # Written once (two small numbers a token): the matrix and the recalls read it.
    scored = materialise(explode_rows(texts, z, ("upto",), "z", "pos").where(F.col("pos") >= F.col("upto")).select("z.l_auto", "z.l_tagger"))
    k = A.cohen_kappa(scored, "l_auto", "l_tagger").crossJoin(TG.recalls(scored, "l_auto", "l_tagger"))  # one row each
    return _round(k, ["po", "pe", "kappa", "recall_0", "recall_1", "recall_2"])


@register("argmax_label", f"""{S.labels_ctes()},
sc AS (SELECT token, l1 AS label, count(*) AS score FROM lab GROUP BY token, l1)
SELECT token, CAST(label AS INTEGER) AS label, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY token ORDER BY score DESC, label) AS r FROM sc) WHERE r = 1""")
def q_argmax_label(spark, sf_dir):
    """Most frequent H1 label per token type (a count score table); tie -> lowest label."""
    scores = row_labels(spark, sf_dir, "l1").groupBy("token", "label").agg(F.count(F.lit(1)).cast("bigint").alias("score"))
    return TG.argmax_label(scores, ("token",))


@register("pred_align")
def q_pred_align(spark, sf_dir):
    """Tokens with the tagger's predictions: columns of one row, so no join (``label_align`` is for labels that come apart)."""
    return TG.tagger_predict(fitted_tagger(spark, sf_dir), word_wide(spark, sf_dir)).select("doc_id", "pos", "token", "pred")

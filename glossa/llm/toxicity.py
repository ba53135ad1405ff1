"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text (``FEATURES``): densities of two learned lexicons, how close their words stand to second-person words, rates of
capitals, punctuation and obfuscated words, and lengths.  The lexicons are learned: words that occur in clearly more toxic than other texts
of the first part of the sample.  An obfuscated word counts as the lexicon word it stands for (look-alike characters, one masked
letter, stretched letters).

Learning takes a sample of labelled rows with texts of about ``SAMPLE_ROWS`` rows at most, chosen by a hash of the id: 40 % for the lexicons, 40 % for the
trees, 20 % for the calibration.  Scoring covers every document and needs no shuffle.

Defined results: null and empty texts have features of zero and get a score; without labelled rows of both kinds, the score is the share of
toxic rows (0 if there are none); a null ``doc_id`` counts as the empty string for the fold, has no label and is returned as null; repeated rows are
scored each; repeated labels count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import bounded_batches, fold, staged

SAMPLE_ROWS = 20_000
LEXICON_WORDS = 400
#: A lexicon word is in at least so many toxic texts; its share of toxic texts (lower bound) is at least STRONG or WEAK.
LEAST_TEXTS, STRONG, WEAK = 3, 0.6, 0.25
NEAR = 5
TREES, DEPTH = 20, 3

SECOND_PERSON = frozenset("you your yours yourself u du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
LOOKALIKE = str.maketrans("013457@$!|", "oieastasil")
FEATURES = ("strong", "weak", "strong_log", "weak_log", "near_you", "near_you_log", "you", "capitals", "shouted", "marks", "exclaimed", "masked", "masked_hits", "digits", "words_log")

_TOKEN = re.compile(r"[^\s.,;:!?\"'()\[\]{}<>]+")
_STRETCHED = re.compile(r"(.)\1{2,}")


@dataclass
class Lexicon:
    strong: frozenset[str]
    weak: frozenset[str]
    masked: frozenset[str]  # lexicon words with one letter left out

    @staticmethod
    def of(strong: list[str], weak: list[str]) -> Lexicon:
        out = {w[:i] + w[i + 1 :] for w in strong if len(w) >= 5 for i in range(1, len(w) - 1)}
        return Lexicon(frozenset(strong), frozenset(weak), frozenset(out - set(strong)))


def _unmasked(token: str, lexicon: Lexicon) -> bool:
    """Whether an odd token stands for a lexicon word."""
    plain = "".join(c for c in token.translate(LOOKALIKE) if c.isalpha())
    if plain in lexicon.strong:
        return True
    if len(plain) < len(token) and "".join(c for c in token if c.isalpha()) in lexicon.masked:
        return True
    short = _STRETCHED.sub(r"\1", plain)
    return short != plain and (short in lexicon.strong or _STRETCHED.sub(r"\1\1", plain) in lexicon.strong)


def features_of(text: str | None, lexicon: Lexicon) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    tokens = _TOKEN.findall(text)
    n = max(1, len(tokens))
    lower = [t.lower() for t in tokens]
    strong = [i for i, t in enumerate(lower) if t in lexicon.strong]
    weak = sum(1 for t in lower if t in lexicon.weak)
    odd = [i for i, t in enumerate(lower) if not t.isalpha()]
    masked = [i for i in odd if _unmasked(lower[i], lexicon)]
    odd = [i for i in odd if any(c.isalpha() for c in lower[i])]
    hits = sorted({*strong, *masked})
    you = [i for i, t in enumerate(lower) if t in SECOND_PERSON]
    near = 0
    if hits and you:
        at = np.searchsorted(you, hits)
        below, above = np.array(you)[np.maximum(at - 1, 0)], np.array(you)[np.minimum(at, len(you) - 1)]
        near = int((np.minimum(np.abs(np.array(hits) - below), np.abs(above - np.array(hits))) <= NEAR).sum())
    count = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    capitals, letters = int(count[65:91].sum()), int(count[65:91].sum() + count[97:123].sum() + count[195:].sum())
    marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
    shouted = sum(1 for t in tokens if len(t) > 2 and t.isupper())
    return [len(strong) / n, weak / n, math.log1p(len(strong)), math.log1p(weak), near / n, math.log1p(near), len(you) / n,
            capitals / max(1, letters), shouted / n, marks / len(text), int(count[33] + count[63]) / n, len(odd) / n, math.log1p(len(masked)),
            int(count[48:58].sum()) / len(text), math.log1p(len(tokens))]


def with_features(docs: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``features`` (array) of every row with ``text``."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [features_of(t.as_py(), shared.value) for t in b["text"]]
            yield pa.record_batch([*[b[k] for k in keep], pa.array(values, pa.list_(pa.float64()))], [*keep, "features"])

    kinds = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*[f"{k} {kinds[k]}" for k in keep], "features array<double>"]))


def _share(key: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(key, F.lit(2024)), F.lit(1_000_000)) / 1_000_000


def sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``part, toxic, text`` of about ``rows`` labelled rows at most; only the sample's ids are broadcast."""
    chosen = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    share = min(1.0, rows / max(1, chosen.count()))
    chosen = chosen.where(_share(F.col("doc_id")) < share)
    part = _share(F.concat(F.col("doc_id").cast("string"), F.lit("part")))
    part = F.when(part < 0.4, 0).when(part < 0.8, 1).otherwise(2)
    rows_with_text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return staged(rows_with_text.select("doc_id", part.alias("part"), "toxic", "text"), "toxic-sample")


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Words by the lower bound of the share of toxic texts among the texts that hold them."""
    toxic = rows.agg(F.avg("toxic")).first()[0] or 0.0
    words = rows.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{2,}"), F.lit(0)))).alias("word"))
    counts = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).where(F.col("t") >= LEAST_TEXTS)
    bound = (F.col("t") - F.sqrt("t")) / F.col("n")
    top = (counts.select("word", bound.alias("bound"), "t").where(F.col("bound") >= F.lit(max(WEAK, 2 * toxic)))
           .orderBy(F.desc(F.col("bound") * F.sqrt("t")), "word").limit(2 * LEXICON_WORDS).collect())
    strong = [r["word"] for r in top if r["bound"] >= max(STRONG, (1 + toxic) / 2 if toxic > STRONG else STRONG)]
    return Lexicon.of(strong[:LEXICON_WORDS], [r["word"] for r in top if r["word"] not in set(strong[:LEXICON_WORDS])][:LEXICON_WORDS])


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float


def _margin() -> Column:
    return vector_to_array("rawPrediction")[1]


def _ready(rows: DataFrame, lexicon: Lexicon, part: int) -> DataFrame:
    rows = with_features(rows.where(F.col("part") == part), lexicon, ["doc_id", "toxic"])
    return staged(rows, "toxic-features", SAMPLE_ROWS).select("toxic", array_to_vector("features").alias("features")).cache()


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    chosen = sample(docs, labels, rows)
    counts = {(r["part"], r["toxic"]): r["n"] for r in chosen.groupBy("part", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    share = sum(n for (_, toxic), n in counts.items() if toxic) / total if total else 0.0
    lexicon = learn_lexicon(chosen.where("part = 0"))
    if not all(counts.get((1, toxic)) for toxic in (0, 1)):
        return Model(lexicon, None, None, share)
    train = _ready(chosen, lexicon, 1)
    trees = GBTClassifier(labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7, checkpointInterval=-1, maxBins=32).fit(train)
    train.unpersist()
    calibration = None
    if all(counts.get((2, toxic)) for toxic in (0, 1)):
        held = trees.transform(_ready(chosen, lexicon, 2)).select(_margin().alias("margin"), F.col("toxic").cast("double").alias("toxic"))
        calibration = IsotonicRegression(featuresCol="margin", labelCol="toxic").fit(held)
    return Model(lexicon, trees, calibration, share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    rows = docs.select("doc_id", (fold(5) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    if model.trees is None:
        out = rows.select("doc_id", "held_out", F.lit(float(model.share)).alias("score"))
    else:
        made = with_features(rows, model.lexicon, ["doc_id", "held_out"]).withColumn("features", array_to_vector("features"))
        made = model.trees.setPredictionCol("tree").transform(made)
        if model.calibration is None:
            out = made.select("doc_id", "held_out", vector_to_array("probability")[1].alias("score"))
        else:
            made = model.calibration.transform(made.select("doc_id", "held_out", _margin().alias("margin")))
            out = made.select("doc_id", "held_out", F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled rows that are not held out, score all documents."""
    return score(docs, fit(docs, labels.where(fold(5) != 0)))

"""Language identification by words first, backing off to character n-grams.

Learning: Spark counts (lang, word) over every labelled training text, and character n-grams of each length up to five
over all distinct (lang, word) (``^`` and ``$`` mark a word's ends); each task adds up its own before the shuffle.
The model holds the log frequencies of about ``max_words`` words and of about ``max_grams`` n-grams of each length.  Every language
has an equal share of both for what is most frequent in it, however small it is beside the others; what a language doesn't use goes to the others.
Both bounds are parameters, so the broadcast model has a fixed largest size (about 50 MB with the defaults), however large the corpus is.

Scoring: a known word adds its log frequency per language.  An unseen word is scored by the longest
n-grams of which any is known: first those of five characters, then four, down to one; the mean log
frequency of the known ones counts.  A word of which no character is known adds nothing.
The score is the softmax of the sums at the predicted language.

Defined results: null text, or text without letters, gives ``und`` with score 0; text of which nothing is known gives
the first language in order with score 1 / languages; ties go to the first language in order; an untrained
model (no labelled text) gives ``und`` everywhere; a null ``doc_id`` counts as the empty string for the fold; repeated rows are scored
each; an empty table gives no rows; other columns are ignored.  Words longer than
``MAX_WORD`` letters are never stored as known words, but their n-grams are learned and scored.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import bounded_batches, fold, release, staged

WORD = re.compile(r"[^\W\d_]+")
#: The pattern also takes superscripts, fractions, circled numbers and numerals; they are no letters.
NUMBERS = re.compile("[" + "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("No", "Nl")) + "]+")
MAX_WORD = 40
MAX_ORDER = 5
MAX_WORDS = 200_000
MAX_GRAMS = 20_000
SMOOTH = 0.5
#: Distinct (lang, word) pairs that a task holds before it passes them on.
FLUSH = 200_000
#: Unseen words that a task keeps scored.
KEEP = 40_000
UNDETERMINED = "und"
#: New words that a text may bring, for the number of files of the word counts.
WORDS_PER_TEXT = 8


def words_of(text: str) -> list[str]:
    found = WORD.findall(text.lower())
    return found if all(map(str.isalpha, found)) else [part for w in found for part in NUMBERS.split(w) if part]


def grams_of(word: str, order: int) -> list[str]:
    marked = f"^{word}$" if order > 1 else word
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


def _pairs(counts: dict[str, Counter], key: str) -> pa.RecordBatch:
    langs, keys, ns = [], [], []
    for lang, c in counts.items():
        langs += [lang] * len(c)
        keys += c.keys()
        ns += c.values()
    return pa.record_batch([pa.array(langs, pa.string()), pa.array(keys, pa.string()), pa.array(ns, pa.int64())], ["lang", key, "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for b in batches:
        for lang, text in zip(b["lang"], b["text"]):
            counts.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
            if sum(map(len, counts.values())) > FLUSH:
                yield _pairs(counts, "word")
                counts = {}
    yield _pairs(counts, "word")
    del counts
    release()


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of a language counts once: unseen words are like rare ones."""
    counts: dict[str, Counter] = {}
    for b in batches:
        for lang, word in zip(b["lang"], b["word"]):
            c, w = counts.setdefault(lang.as_py(), Counter()), word.as_py()
            for order in range(1, MAX_ORDER + 1):
                c.update(grams_of(w, order))
            if sum(map(len, counts.values())) > FLUSH:
                yield _pairs(counts, "gram")
                counts = {}
    yield _pairs(counts, "gram")
    del counts
    release()


@dataclass
class Model:
    """Row numbers of words and n-grams in tables of log frequencies (rows x languages)."""

    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray


def word_counts(train: DataFrame) -> DataFrame:
    """``lang, word, n`` over all rows with text and lang; summed in each task before the shuffle."""
    bounded_batches(train.sparkSession)
    rows = train.select("lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return rows.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _logs(counts: dict[str, list[int]], totals: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
    """Row numbers and smoothed log frequencies per language."""
    n = np.array(list(counts.values()), float).reshape(len(counts), len(totals))
    return {key: i for i, key in enumerate(counts)}, np.log((n + SMOOTH) / (totals + SMOOTH * max(1, len(counts))))


def _shares(sizes: dict[str, int], limit: int) -> dict[str, int]:
    """``limit`` in equal shares; what a language has no use for is left to the larger ones."""
    out, left = {}, limit
    for i, lang in enumerate(sorted(sizes, key=lambda x: (sizes[x], x))):
        out[lang] = min(sizes[lang], left // (len(sizes) - i))
        left -= out[lang]
    return out


def _known(counts: DataFrame, langs: list[str], limit: int) -> tuple[dict[int, dict[str, list[int]]], dict[int, np.ndarray]]:
    """By kind: ``key -> count per language`` of each language's most frequent keys, and the totals per language of all keys; ``counts`` has ``lang, key, kind, n``.

    A language's keys are taken by whole classes of frequency (an eighth of a power of two wide), and of the class that fits in part by a hash.
    The driver gets a row per class and about ``limit`` keys of each kind; no task sorts or keeps the top rows.
    """
    spark = counts.sparkSession
    counts = counts.withColumn("class", F.floor(F.log2(F.col("n").cast("double")) * 8))
    classes = counts.groupBy("kind", "lang", "class").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).orderBy("kind", F.desc("class")).collect()
    totals: dict[int, np.ndarray] = {}
    bounds = []
    for kind in sorted({r["kind"] for r in classes}):
        mine = [r for r in classes if r["kind"] == kind]
        totals[kind] = np.array([float(sum(r["n"] for r in mine if r["lang"] == lang)) for lang in langs])
        left = _shares({lang: sum(r["rows"] for r in mine if r["lang"] == lang) for lang in langs}, limit)
        for r in mine:
            take = min(r["rows"], left[r["lang"]])
            left[r["lang"]] -= take
            bounds.append((kind, r["lang"], r["class"], take / r["rows"]))
    if not bounds:
        return {}, totals
    taken = spark.createDataFrame(bounds, "kind int, lang string, class long, part double")
    marked = counts.join(F.broadcast(taken), ["kind", "lang", "class"])
    in_part = F.pmod(F.xxhash64("key", F.lit(17)), F.lit(1 << 20)) < F.col("part") * (1 << 20)
    wide = marked.groupBy("kind", "key").agg(
        F.max(in_part).alias("known"), *[F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"_{i}") for i, lang in enumerate(langs)])
    rows = wide.where("known").toArrow()
    columns = [rows[f"_{i}"].to_pylist() for i in range(len(langs))]
    out: dict[int, dict[str, list[int]]] = {kind: {} for kind in totals}
    for kind, key, *ns in sorted(zip(rows["kind"].to_pylist(), rows["key"].to_pylist(), *columns)):
        out[kind][key] = ns
    return out, totals


def fit(train: DataFrame, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    counts = staged(word_counts(train), "lang-words", WORDS_PER_TEXT * train.count())
    totals = {r["lang"]: float(r["n"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Model([], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))
    known, _ = _known(counts.where(F.length("word") <= MAX_WORD).select("lang", F.col("word").alias("key"), F.lit(0).alias("kind"), "n"), langs, max_words)
    words, word_logs = _logs(known.get(0, {}), np.array([totals[lang] for lang in langs]))
    grams = staged(counts.select("lang", "word").mapInArrow(_count_grams, "lang string, gram string, n long")
                   .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-grams", counts.count())
    known, by_order = _known(grams.select("lang", F.col("gram").alias("key"), F.length("gram").alias("kind"), "n"), langs, max_grams)
    rows: dict[str, int] = {}
    logs = [np.zeros((0, len(langs)))]
    for order, found in known.items():
        index, part = _logs(found, by_order[order])
        rows |= {g: i + len(rows) for g, i in index.items()}
        logs.append(part)
    return Model(langs, words, word_logs, rows, np.concatenate(logs))


def backoff(word: str, model: Model) -> np.ndarray | None:
    for order in range(MAX_ORDER, 0, -1):
        at = [i for g in grams_of(word, order) if (i := model.grams.get(g)) is not None]
        if at:
            return model.gram_logs[at].mean(axis=0)
    return None


def score_text(text: str | None, model: Model, cache: dict[str, np.ndarray | None]) -> tuple[str, float]:
    words = words_of(text) if text else []
    if not words or not model.langs:
        return UNDETERMINED, 0.0
    sums = np.zeros(len(model.langs))
    at, ns = [], []
    for word, n in Counter(words).items():
        i = model.words.get(word)
        if i is not None:
            at.append(i)
            ns.append(n)
            continue
        if word not in cache:
            cache[word] = backoff(word, model)
        if cache[word] is not None:
            sums += n * cache[word]
    if at:
        sums += np.array(ns) @ model.word_logs[at]
    best = int(sums.argmax())
    return model.langs[best], float(1 / np.exp(sums - sums[best]).sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, text_key`` (a hash of the text, to tell rows with one id apart) of every document; the model is broadcast once."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = shared.value, {}
        for b in batches:
            found = []
            for t in b["text"]:
                found.append(score_text(t.as_py(), m, cache))
                if len(cache) > KEEP:
                    cache.clear()
            yield pa.record_batch([b["doc_id"], b["held_out"], pa.array([x for x, _ in found], pa.string()),
                                   pa.array([s for _, s in found], pa.float64()), b["text_key"]],
                                  ["doc_id", "held_out", "lang_pred", "score", "text_key"])
        del m, cache
        release()

    rows = docs.select("doc_id", (fold(4) == 2).alias("held_out"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, text_key long")


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict all rows."""
    return predict(docs, fit(docs.where(fold(4) != 2)))

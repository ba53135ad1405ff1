"""Token grains, vocabularies, adjacent pairs and corpus statistics.

Two shapes are used throughout:

* wide  ``(doc_id, toks ARRAY<STRING>)`` - one row per document; positional
  rules run here with array lambdas, row-local, no shuffle;
* long  ``(doc_id, pos INT, token STRING, ...)`` - produced by ``posexplode``
  only when a result is needed per token or an aggregate follows.

Document order never crosses ``doc_id``: no pair, lag or window spans two
documents, and position 0 of each document is a sentence start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.operators.lookup import DEFAULT_BROADCAST_ROWS, bounded, salted_left_join

from glossa.functions.text import (
    char_tokens, explode_rows, first_place, is_capitalised, segment_tokens, vocab_pretty as _pretty, word_tokens,
)

GRAINS = {"word": word_tokens, "char": char_tokens, "segment": segment_tokens}


def tokenize(docs: DataFrame, grain: str = "word", text: str = "text",
             keep: tuple[str, ...] = ("doc_id",), out: str = "toks") -> DataFrame:
    """Wide token table: ``keep`` columns plus ``out`` ARRAY<STRING>."""
    return docs.select(*keep, GRAINS[grain](text).alias(out))


def explode_tokens(wide: DataFrame, toks: str = "toks", keep: tuple[str, ...] = ("doc_id",),
                   token: str = "token") -> DataFrame:
    """Long token table ``keep + (pos INT, token)``; the array itself is not carried per row."""
    return explode_rows(wide, toks, keep, token, "pos")


def word_tokenize(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return explode_tokens(tokenize(docs, "word", keep=keep), keep=keep)


def char_tokenize(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return explode_tokens(tokenize(docs, "char", keep=keep), keep=keep)


def char_vocab(docs: DataFrame, text: str = "text") -> DataFrame:
    """Sorted distinct characters -> ``vocab(token_id INT, token STRING)``.

    The distinct set is bounded by the Unicode code space, so the single
    ordered pass after ``distinct`` is over at most ~1.1 M rows.
    """
    chars = explode_rows(docs, char_tokens(text), (), "token").distinct()
    w = Window.orderBy("token")
    return chars.select((F.row_number().over(w) - 1).cast("int").alias("token_id"), "token")


def _vocab_join(rows: DataFrame, vocab: DataFrame, key: str, vocab_key: str,
                max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    vocab, small = bounded(vocab, max_rows)
    if small:
        return rows.join(F.broadcast(vocab), rows[key] == vocab[vocab_key], "left")
    return salted_left_join(rows, vocab, key, vocab_key, rows.columns)


def oov_map(tokens: DataFrame, vocab: DataFrame, token: str = "token", unk_id: int | None = 0) -> DataFrame:
    """Attach ``token_id``; characters outside the vocabulary get ``unk_id`` (0, as in the source).

    A vocabulary that is small (counted) is broadcast and the token side never
    shuffles; a larger one meets salted tokens.  With ``unk_id=None`` an
    unknown character keeps a NULL id (for vocabularies with their own ``<unk>``).
    """
    v = vocab.select(F.col("token").alias("_vt"), F.col("token_id").alias("_vid"))
    return (_vocab_join(tokens, v, token, "_vt")
            .withColumn("token_id", F.coalesce(F.col("_vid"), F.lit(unk_id)).cast("int"))
            .drop("_vt", "_vid"))


def vocab_lookup_safe(ids: DataFrame, vocab: DataFrame, id_col: str = "token_id",
                      out: str = "token") -> DataFrame:
    """id -> token string; an id with no entry reads as '' (never NULL)."""
    v = vocab.select(F.col("token_id").alias("_vid"), F.col("token").alias("_vt"))
    return (_vocab_join(ids, v, id_col, "_vid")
            .withColumn(out, F.coalesce(F.col("_vt"), F.lit("")))
            .drop("_vid", "_vt"))


def vocab_pretty(vocab: DataFrame) -> DataFrame:
    return vocab.select("token_id", _pretty("token").alias("pretty"))


def capitalised_vocab(vocab: DataFrame) -> DataFrame:
    """Vocabulary entries that are capitalised words of more than one character, apart from a segment's leading blank."""
    word = F.ltrim("token")
    return vocab.filter(is_capitalised(word) & (F.length(word) > 1))


def vocab_coverage_by_size(vocab: DataFrame, sizes: list[int]) -> DataFrame:
    """Capitalised multi-character tokens available within the first ``size`` ids.

    Merges are prefix-stable (a vocabulary of size n is the first n ids of any
    larger one), so one conditional count per size answers every size at once.
    """
    word = F.ltrim("token")
    flag = (is_capitalised(word) & (F.length(word) > 1)).cast("int")
    aggs = [F.sum(F.when(F.col("token_id") < s, flag).otherwise(0)).cast("bigint").alias(f"s{s}")
            for s in sizes]
    wide = vocab.agg(*aggs)
    stack = ", ".join(f"{s}, s{s}" for s in sizes)
    return wide.selectExpr(f"stack({len(sizes)}, {stack}) as (vocab_size, n_capitalised)") \
        .select(F.col("vocab_size").cast("int"), F.col("n_capitalised").cast("bigint"))


def corpus_stats(docs: DataFrame, by: tuple[str, ...] = (), grain: str = "word") -> DataFrame:
    """Documents, characters, tokens and distinct tokens, optionally per group.

    Per-document figures are computed row-locally; the distinct count is an
    exact two-level aggregate (group, token) -> group, each with a map-side
    partial step, so a hot token is combined before it is shuffled.
    """
    toks = GRAINS[grain]("text")
    per_doc = docs.select(*by, F.length("text").alias("_chars"), F.size(toks).alias("_ntok"))
    totals = per_doc.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_docs"),
        F.sum("_chars").cast("bigint").alias("n_chars"),
        F.sum("_ntok").cast("bigint").alias("n_tokens"),
    )
    distinct_toks = (explode_rows(docs, toks, by, "_t").distinct()
                     .groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("n_distinct")))
    if by:
        return totals.join(distinct_toks, list(by), "left").fillna(0, ["n_distinct"])
    return _attach_scalar(totals, distinct_toks)


def _attach_scalar(one_row: DataFrame, other_one_row: DataFrame) -> DataFrame:
    """Put two single-row aggregates side by side (equi-join on a constant key)."""
    a = one_row.withColumn("_k", F.lit(1))
    b = other_one_row.withColumn("_k", F.lit(1))
    return a.join(b, "_k", "left").drop("_k")


def adjacent_pairs(wide: DataFrame, toks: str = "toks", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Overlapping adjacent pairs ``(keep, pos, left, right)``; ``aaa`` yields (a,a) twice."""
    a = F.col(toks)
    n = F.size(a)
    zipped = F.arrays_zip(F.slice(a, 1, F.greatest(n - 1, F.lit(0))).alias("left"),
                          F.slice(a, 2, F.greatest(n - 1, F.lit(0))).alias("right"))
    pairs = F.when(n >= 2, zipped).otherwise(F.array().cast("array<struct<left:string,right:string>>"))
    return (explode_rows(wide, pairs, keep, "p", "pos")
            .select(*keep, "pos", F.col("p.left").alias("left"), F.col("p.right").alias("right")))


def pair_count(wide: DataFrame, toks: str = "toks", weight: str | None = None,
               order: str = "doc_id") -> DataFrame:
    """Adjacent pair counts with the first occurrence ``(first_ord, first_pos)``.

    ``weight`` lets a table of distinct pieces stand for all its occurrences.
    Partial aggregation combines a hot pair on the map side before the shuffle.
    """
    keep = (order,) + ((weight,) if weight else ())
    p = adjacent_pairs(wide, toks, keep=keep)
    w = F.col(weight) if weight else F.lit(1)
    return p.groupBy("left", "right").agg(
        F.sum(w).cast("bigint").alias("pair_count"),
        first_place(p, order, "pos").alias("_first"),
    ).select("left", "right", "pair_count",
             F.col("_first.o").alias("first_ord"), F.col("_first.p").cast("int").alias("first_pos"))

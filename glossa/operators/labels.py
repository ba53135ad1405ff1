"""Capitalisation labellers: ``auto`` (len > 1), ``h1`` (len >= 1), ``h2`` (len >= 4, recurring).

A token is a candidate when its first character is uppercase, it is all
letters, it is long enough, and it does not start a sentence (position 0 or
the previous token ends in ``.`` ``!`` ``?`` or a newline).  A candidate
after a candidate is ``I`` (2), otherwise ``B`` (1); everything else ``O`` (0).

``auto`` and ``h1`` are row-local on the wide token array.  ``h2`` also
requires the token to occur capitalised at least ``min_freq`` times, a global
fact looked up with ``glossa.operators.lookup``.  Its scope is the input itself or,
with a given frequency table (``cap_freq`` of a wider corpus, saved by
``cap_freq_save``), that corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions.text import bio_from_candidates, candidate_flags, ends_sentence, explode_rows, is_capitalised, label_name
from glossa.operators.lookup import DEFAULT_BROADCAST_ROWS, DEFAULT_SALT_BUCKETS, bounded, salted_left_join

# Minimum token length per labeller (auto: more than one character).
MIN_LEN = {"auto": 2, "h1": 1}


def token_facts(toks: str = "toks"):
    """ARRAY<STRUCT<cap, st, n>>: capitalised word, sentence start, length - one regex per token."""
    a = F.col(toks)
    return F.transform(a, lambda t, i: F.struct(
        is_capitalised(t).alias("cap"),
        F.when(i == 0, F.lit(True)).otherwise(ends_sentence(a[i - 1])).alias("st"),
        F.length(t).alias("n")))


def _cand(x, min_len: int):
    return x["cap"] & ~x["st"] & (x["n"] >= min_len)


def _bio(facts, x, i, min_len: int):
    c = _cand(x, min_len)
    return F.when(~c, F.lit(0)).when(i == 0, F.lit(1)) \
        .when(_cand(facts[i - 1], min_len), F.lit(2)).otherwise(F.lit(1))


def label_arrays(wide: DataFrame, toks: str = "toks", h2_min_len: int = 4) -> DataFrame:
    """Add ``lab`` ARRAY<STRUCT<token, l0, l1, pre, prev, prev_pre>> (``pre``: H2 before the frequency test)."""
    facts = F.col("_facts")
    a = F.col(toks)

    def per_token(x, i):
        first = i == 0
        return F.struct(
            a[i].alias("token"),
            _bio(facts, x, i, MIN_LEN["auto"]).alias("l0"),
            _bio(facts, x, i, MIN_LEN["h1"]).alias("l1"),
            _cand(x, h2_min_len).alias("pre"),
            F.when(~first, a[i - 1]).alias("prev"),
            F.when(first, F.lit(False)).otherwise(_cand(facts[i - 1], h2_min_len)).alias("prev_pre"),
        )

    return (wide.withColumn("_facts", token_facts(toks))
            .withColumn("lab", F.transform(facts, per_token)).drop("_facts"))


def label_array(wide: DataFrame, which: str, toks: str = "toks", out: str = "labels") -> DataFrame:
    """Add ``out`` ARRAY<INT>: one row-local labelling (``which``: ``auto`` or ``h1``) alone, without what ``label_arrays`` prepares for H2."""
    return (wide.withColumn("_cand", candidate_flags(toks, MIN_LEN[which]))
            .withColumn(out, bio_from_candidates("_cand")).drop("_cand"))


def cap_freq(long_tokens: DataFrame, min_len: int = 1, token: str = "token") -> DataFrame:
    """Occurrences of each capitalised token of at least ``min_len`` characters: ``(token, cap_freq)``."""
    t = F.col(token)
    return (long_tokens.filter(is_capitalised(t) & (F.length(t) >= min_len))
            .groupBy(t.alias("token")).agg(F.count(F.lit(1)).cast("bigint").alias("cap_freq")))


def cap_freq_save(freq: DataFrame, path: str) -> None:
    """A corpus's frequency table, kept for the labelling of other texts."""
    freq.select("token", "cap_freq").write.mode("overwrite").parquet(path)


def cap_freq_load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("token string, cap_freq bigint").parquet(path)


def heuristic_labels(wide: DataFrame, keep: tuple[str, ...] = ("doc_id",), toks: str = "toks",
                     h2_min_len: int = 4, h2_min_freq: int = 2,
                     broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                     salt_buckets: int = DEFAULT_SALT_BUCKETS, freq: DataFrame | None = None) -> DataFrame:
    """Long table ``keep + (pos, token, l0, l1, l2)``: auto, H1 and H2 labels per token.

    ``freq`` (``token, cap_freq``) makes the corpus it was counted on the scope of H2's frequency; without it the input is.
    A token that the corpus doesn't hold counts zero there, however often the input has it.
    """
    long = (explode_rows(label_arrays(wide, toks, h2_min_len), "lab", keep, "z", "pos")
            .select(*keep, F.col("pos").cast("int").alias("pos"), "z.token",
                    F.col("z.l0").cast("int").alias("l0"), F.col("z.l1").cast("int").alias("l1"),
                    "z.pre", "z.prev", "z.prev_pre"))

    # Tokens that could ever pass H2: capitalised, long enough, seen >= min_freq times
    # in the scope.  The input's are counted straight from the token arrays (partial aggregation per task).
    counted = freq if freq is not None else cap_freq(explode_rows(wide, toks, (), "token"), h2_min_len)
    recurring = (counted.filter((F.col("cap_freq") >= h2_min_freq) & (F.length("token") >= h2_min_len))
                 .select(F.col("token").alias("_rt")))
    recurring, small = bounded(recurring, broadcast_rows)

    def finish(df: DataFrame, cur_hit, prev_hit) -> DataFrame:
        cand = F.col("pre") & cur_hit
        prev_cand = F.col("prev_pre") & prev_hit
        l2 = F.when(~cand, 0).when(prev_cand, 2).otherwise(1).cast("int")
        return df.select(*keep, "pos", "token", "l0", "l1", l2.alias("l2"))

    if small:
        cur = F.broadcast(recurring.select(F.col("_rt").alias("_cur")))
        prv = F.broadcast(recurring.select(F.col("_rt").alias("_prv")))
        j = (long.join(cur, F.when(F.col("pre"), F.col("token")) == F.col("_cur"), "left")
                 .join(prv, F.when(F.col("pre") & F.col("prev_pre"), F.col("prev")) == F.col("_prv"), "left"))
        return finish(j, F.col("_cur").isNotNull(), F.col("_prv").isNotNull())

    # Large dimension: only H2 pre-candidates (a small share of tokens) are shuffled,
    # salted by position so that one frequent name is spread over many tasks.
    spread = list(keep) + ["pos"]
    s = long.filter(F.col("pre"))
    s = salted_left_join(s, recurring.select(F.col("_rt").alias("_cur")), "token", "_cur", spread, salt_buckets)
    s = salted_left_join(s, recurring.select(F.col("_rt").alias("_prv")), "prev", "_prv", spread, salt_buckets)
    hits = finish(s, F.col("_cur").isNotNull(), F.col("_prv").isNotNull())
    rest = finish(long.filter(~F.col("pre")), F.lit(False), F.lit(False))
    return rest.unionByName(hits)


def sentence_start(wide: DataFrame, keep: tuple[str, ...] = ("doc_id",), toks: str = "toks") -> DataFrame:
    """Long ``(keep, pos, token, is_start)``."""
    from glossa.functions.text import sentence_start_flags
    z = F.arrays_zip(F.col(toks).alias("token"), sentence_start_flags(toks).alias("is_start"))
    return (explode_rows(wide, z, keep, "z", "pos")
            .select(*keep, F.col("pos").cast("int").alias("pos"), "z.token", "z.is_start"))


def label_distribution(labelled: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Count per label name, every name listed (zero counts included), plus entity share.

    One partial/final aggregate with a conditional count per label; the three
    names are then unpivoted, so labels that never occur still appear.
    """
    lab = F.col(label)
    g = labelled.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("_n"),
        F.count_if(lab != 0).cast("bigint").alias("_ent"),
        *[F.count_if(lab == i).cast("bigint").alias(f"_c{i}") for i in range(3)],
    )
    out = g.selectExpr(*by, "_n", "_ent", "stack(3, 0, _c0, 1, _c1, 2, _c2) as (label, n)")
    return out.select(
        *by, F.col("label").cast("int").alias("label"), label_name("label").alias("label_name"),
        F.col("n").cast("bigint").alias("n"),
        F.col("_ent").alias("n_entity"),
        F.round(F.try_divide(100.0 * F.col("_ent"), F.col("_n")), 6).alias("pct_entity"),
    )


def cap_freq_lookup(long_tokens: DataFrame, freq: DataFrame, token: str = "token",
                    spread: tuple[str, ...] = ("doc_id", "pos"),
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Attach ``cap_freq`` to every token (0 when the token is not a counted capital).

    Only capitalised tokens can have a count, so only they take part in the
    lookup; the rest get 0 without moving.
    """
    dim = freq.select(F.col("token").alias("_cft"), F.col("cap_freq").alias("_cf"))
    dim, small = bounded(dim, broadcast_rows)
    if small:
        j = long_tokens.join(F.broadcast(dim), long_tokens[token] == F.col("_cft"), "left")
        return j.withColumn("cap_freq", F.coalesce(F.col("_cf"), F.lit(0)).cast("bigint")).drop("_cft", "_cf")
    caps = is_capitalised(F.col(token))
    hit = salted_left_join(long_tokens.filter(caps), dim, token, "_cft", list(spread), salt_buckets)
    hit = hit.withColumn("cap_freq", F.coalesce(F.col("_cf"), F.lit(0)).cast("bigint")).drop("_cft", "_cf")
    rest = long_tokens.filter(~caps).withColumn("cap_freq", F.lit(0).cast("bigint"))
    return rest.unionByName(hit)

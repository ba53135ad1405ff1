"""Registered queries: corpus order, split, windows, batches and the count-based next-token model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions import text as X
from glossa.operators import lm as M
from glossa.operators import windows as W
from glossa.operators.lookup import materialise
from glossa.plans import sql as S
from glossa.plans.queries import _round, register, word_wide
from glossa.artifacts import artifact
from glossa.sources.corpus import read_documents

RATIO = 0.9      # train share of the token stream (the source's default)
WIN = 16         # window length for the registered window queries
BATCH = 64       # samples per batch (the source's language-model default)
SEED = 0
K = 1            # n-gram order of the registered model queries
ALPHA = 1000.0   # smoothing weight of the registered model queries
TEMP = 0.8       # sampling temperature (the source's default)
STEPS = 10       # generated tokens per prompt
PROMPT_TOKENS = 3  # context shown before a sweep run's sample (the longest order used)


# --- shared plan fragments -------------------------------------------------------------

def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(split, doc_id, start_pos, toks)``: the word stream cut at ``int(0.9 N)`` before windowing."""
    return W.train_val_split(word_wide(spark, sf_dir), RATIO)


def fitted(spark: SparkSession, sf_dir: str, orders: tuple[int, ...] = (K,)) -> M.NgramModel:
    """The model for the input; fitted and saved first if no application has."""
    def fit(path: str) -> None:
        rows = split_rows(spark, sf_dir)
        M.ngram_save(M.ngram_fit(rows.filter(F.col("split") == "train"), list(orders), path=path), path)

    return M.ngram_load(spark, artifact(spark, "ngram" + "-".join(map(str, orders)), sf_dir, fit))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark text, whole, is a prompt; generation continues from its end."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    from glossa.operators.tokens import tokenize
    return tokenize(bench, "word", keep=("item_id",)).select(F.col("item_id").alias("prompt_id"),
                                                             F.col("toks").alias("prompt"))


# DuckDB: word tokens -> global position -> split -> row-local position.
SPLIT_SQL = f"""WITH {S.word_tokens_cte()},
g AS (SELECT doc_id, pos, token, row_number() OVER (ORDER BY doc_id, pos) - 1 AS gp FROM tok),
nt AS (SELECT count(*) AS n FROM tok),
sp AS (SELECT CASE WHEN gp < floor({RATIO} * n) THEN 'train' ELSE 'val' END AS split, doc_id, pos, token FROM g, nt),
sr AS (SELECT split, doc_id, pos, CAST(pos - min(pos) OVER (PARTITION BY split, doc_id) AS INTEGER) AS lpos, token FROM sp)"""

SR_LISTS = """srl AS (SELECT split, doc_id, CAST(min(pos) AS INTEGER) AS start_pos, list(token ORDER BY pos) AS t
  FROM sr GROUP BY split, doc_id)"""

MODEL_SQL = f"""{SPLIT_SQL},
ev AS (SELECT split, doc_id, lpos, lag(token) OVER (PARTITION BY split, doc_id ORDER BY lpos) AS ctx, token FROM sr),
ev1 AS (SELECT * FROM ev WHERE lpos >= {K}),
cnt AS (SELECT ctx, token, count(*) AS c FROM ev1 WHERE split = 'train' GROUP BY ctx, token),
ct AS (SELECT ctx, sum(c) AS cc FROM cnt GROUP BY ctx),
uni AS (SELECT token, count(*) AS c1 FROM sr WHERE split = 'train' GROUP BY token),
st AS (SELECT sum(c1) AS n1, count(*) AS v FROM uni),
sc AS (
  SELECT ev1.split, ev1.doc_id, ev1.lpos, ev1.ctx, ev1.token,
    CASE WHEN ct.cc IS NOT NULL
      THEN (coalesce(cnt.c, 0) + {ALPHA} * (coalesce(uni.c1, 0) + 1) / (st.n1 + st.v + 1)) / (ct.cc + {ALPHA})
      ELSE (coalesce(uni.c1, 0) + 1) / (st.n1 + st.v + 1) END AS p
  FROM ev1 LEFT JOIN cnt ON ev1.ctx = cnt.ctx AND ev1.token = cnt.token
  LEFT JOIN ct ON ev1.ctx = ct.ctx LEFT JOIN uni ON ev1.token = uni.token, st)"""


# --- 2.5 positions, split, windows, batches ----------------------------------------------

@register("global_position", f"""WITH {S.word_tokens_cte()}
SELECT doc_id, pos, token, CAST(row_number() OVER (ORDER BY doc_id, pos) - 1 AS BIGINT) AS global_pos FROM tok""")
def q_global_position(spark, sf_dir):
    return W.global_position(word_wide(spark, sf_dir))


@register("train_val_split", f"""{SPLIT_SQL}
SELECT split, doc_id, CAST(min(pos) AS INTEGER) AS start_pos, CAST(count(*) AS INTEGER) AS n_tokens
FROM sp GROUP BY split, doc_id""")
def q_train_val_split(spark, sf_dir):
    r = split_rows(spark, sf_dir)
    return r.filter(F.size("toks") > 0).select(
        "split", "doc_id", F.col("start_pos").cast("int"), F.size("toks").cast("int").alias("n_tokens"))


@register("shift_target", f"""WITH {S.word_tokens_cte()}
SELECT * FROM (SELECT doc_id, pos, token, lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS target FROM tok)
WHERE target IS NOT NULL""")
def q_shift_target(spark, sf_dir):
    wide = word_wide(spark, sf_dir)
    a = F.col("toks")
    pairs = F.arrays_zip(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))).alias("token"),
                         F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))).alias("target"))
    pairs = F.when(F.size(a) >= 2, pairs).otherwise(F.array().cast("array<struct<token:string,target:string>>"))
    return (X.explode_rows(wide, pairs, ("doc_id",), "z", "pos")
            .select("doc_id", F.col("pos").cast("int").alias("pos"), "z.token", "z.target"))


@register("context_tail", f"""WITH {S.word_tokens_cte()},
l AS (SELECT doc_id, list(token ORDER BY pos) AS t FROM tok GROUP BY doc_id)
SELECT doc_id, array_to_string(t[greatest(len(t) - 8, 0) + 1:], ' ') AS tail FROM l""")
def q_context_tail(spark, sf_dir):
    wide = word_wide(spark, sf_dir).filter(F.size("toks") > 0)
    return wide.select("doc_id", F.array_join(X.context_tail("toks", 8), " ").alias("tail"))


@register("lm_windows", f"""{SPLIT_SQL}, {SR_LISTS}
SELECT split, doc_id, CAST(start_pos + i AS INTEGER) AS start,
  array_to_string(t[i + 1:i + {WIN}], ' ') AS x, array_to_string(t[i + 2:i + {WIN + 1}], ' ') AS y
FROM (SELECT *, unnest(range(0, len(t) - {WIN})) AS i FROM srl)""")
def q_lm_windows(spark, sf_dir):
    r = split_rows(spark, sf_dir)
    w = W.windows(r, WIN, 1, toks="toks", shift=True, keep=("split", "doc_id", "start_pos"))
    return w.select("split", "doc_id", (F.col("start_pos") + F.col("start")).cast("int").alias("start"),
                    F.array_join("x", " ").alias("x"), F.array_join("y", " ").alias("y"))


@register("tagger_windows", f"""{S.labels_ctes()},
l AS (SELECT doc_id, list(token ORDER BY pos) AS t, list(l0 ORDER BY pos) AS y FROM lab GROUP BY doc_id)
SELECT doc_id, CAST(i AS INTEGER) AS start, array_to_string(t[i + 1:i + {WIN}], ' ') AS x,
  array_to_string(y[i + 1:i + {WIN}], ',') AS y
FROM (SELECT *, unnest(range(0, len(t) - {WIN})) AS i FROM l)""")
def q_tagger_windows(spark, sf_dir):
    from glossa.plans.queries import word_label_wide
    wide = word_label_wide(spark, sf_dir, "l0")
    w = W.windows(wide, WIN, 1, toks="toks", shift=False)
    return w.select("doc_id", "start", F.array_join("x", " ").alias("x"),
                    F.array_join(F.col("y").cast("array<string>"), ",").alias("y"))


def batched_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of both splits with ``batch_id``: train shuffled (seeded md5), validation in order.

    The places of the windows need the rows' sizes only: these are written, so that the texts aren't cut into words again for each count and split.
    """
    sizes = materialise(split_rows(spark, sf_dir).select("split", "doc_id", "start_pos", F.size("toks").alias("n_tokens")))
    sizes = sizes.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "split", "doc_id")  # a small table, from which many rows are made
    w = W.window_starts(sizes, WIN, 1, size="n_tokens", keep=("split", "doc_id", "start_pos"))
    w = w.select("split", "doc_id", "start", (F.col("start_pos") + F.col("start")).cast("int").alias("gstart"))
    of = lambda split: w.filter(F.col("split") == split).drop("split")
    tr = W.shuffled_batches(of("train"), BATCH, SEED, key=("doc_id", "gstart"))
    va = W.shuffled_batches(of("val"), BATCH, SEED, key=("doc_id", "gstart"), shuffle=False)
    return tr.withColumn("split", F.lit("train")).unionByName(va.withColumn("split", F.lit("val")))


@register("shuffled_batches", f"""{SPLIT_SQL}, {SR_LISTS},
w AS (SELECT split, doc_id, CAST(start_pos + i AS INTEGER) AS start FROM (
  SELECT *, unnest(range(0, len(t) - {WIN})) AS i FROM srl)),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY split ORDER BY
  CASE WHEN split = 'train' THEN md5('{SEED}:' || doc_id || ':' || start) ELSE '' END, doc_id, start) - 1 AS BIGINT) AS sample_no
  FROM w)
SELECT split, doc_id, start, sample_no, CAST(floor(sample_no / {BATCH}) AS BIGINT) AS batch_id FROM o""")
def q_shuffled_batches(spark, sf_dir):
    b = batched_windows(spark, sf_dir)
    return b.select("split", "doc_id", F.col("gstart").alias("start"), "sample_no", "batch_id")


# --- 2.8 next-token model ---------------------------------------------------------------------

@register("ngram_fit", f"""{MODEL_SQL}
SELECT cnt.ctx, cnt.token, CAST(cnt.c AS BIGINT) AS cnt, CAST(ct.cc AS BIGINT) AS ctx_cnt,
  round((cnt.c + {ALPHA} * (coalesce(uni.c1, 0) + 1) / (st.n1 + st.v + 1)) / (ct.cc + {ALPHA}), 6) AS prob
FROM cnt JOIN ct USING (ctx) LEFT JOIN uni USING (token), st""")
def q_ngram_fit(spark, sf_dir):
    m = fitted(spark, sf_dir)
    return m.counts.select(F.array_join("ctx", " ").alias("ctx"), "token", "cnt", "ctx_cnt",
                    F.round(M.prob(m, ALPHA), 6).alias("prob"))


@register("token_loss", f"""{MODEL_SQL}
SELECT split, CAST(count(*) AS BIGINT) AS n_scored, round(avg(-ln(p)), 6) AS loss FROM sc GROUP BY split""")
def q_token_loss(spark, sf_dir):
    m = fitted(spark, sf_dir)
    st = M.settings_table(spark, [{"setting": "base", "k": K, "a": ALPHA}])
    out = M.token_loss(split_rows(spark, sf_dir), m, st, fitted_on="train")
    return _round(out.select("split", "n_scored", "loss"), ["loss"])


@register("perplexity", f"""{MODEL_SQL}
SELECT split, doc_id, CAST(count(*) AS BIGINT) AS n_scored, round(avg(-ln(p)), 6) AS loss,
  round(exp(avg(-ln(p))), 6) AS perplexity FROM sc GROUP BY split, doc_id""")
def q_perplexity(spark, sf_dir):
    m = fitted(spark, sf_dir)
    st = M.settings_table(spark, [{"setting": "base", "k": K, "a": ALPHA}])
    out = M.token_loss(split_rows(spark, sf_dir), m, st, by=("split", "doc_id"))
    return _round(out.select("split", "doc_id", "n_scored", "loss", "perplexity"), ["loss", "perplexity"])


@register("mean_batch_loss", f"""{MODEL_SQL}, {SR_LISTS},
w AS (SELECT split, doc_id, CAST(start_pos + i AS INTEGER) AS start, i AS lstart FROM (
  SELECT *, unnest(range(0, len(t) - {WIN})) AS i FROM srl)),
o AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY split ORDER BY
  CASE WHEN split = 'train' THEN md5('{SEED}:' || doc_id || ':' || start) ELSE '' END, doc_id, start) - 1) / {BATCH}) AS BIGINT)
  AS batch_id FROM w),
bl AS (SELECT o.split, o.batch_id, avg(-ln(sc.p)) AS batch_loss FROM o JOIN sc
  ON sc.split = o.split AND sc.doc_id = o.doc_id AND sc.lpos BETWEEN o.lstart + 1 AND o.lstart + {WIN}
  GROUP BY o.split, o.batch_id)
SELECT split, round(avg(batch_loss), 6) AS epoch_loss, CAST(count(*) AS BIGINT) AS n_batches FROM bl GROUP BY split""")
def q_mean_batch_loss(spark, sf_dir):
    m = fitted(spark, sf_dir)
    rows = split_rows(spark, sf_dir)
    nll = M.token_nll(rows, m, K, ALPHA)
    b = batched_windows(spark, sf_dir).select("split", "doc_id", "start", "batch_id")
    out = M.mean_batch_loss(nll, b, WIN)
    return _round(out, ["epoch_loss"])


@register("softmax_temperature", f"""{MODEL_SQL},
q AS (SELECT cnt.ctx, cnt.token, cnt.c / ct.cc AS prob, pow(cnt.c / ct.cc, 1.0 / {TEMP}) AS qq FROM cnt JOIN ct USING (ctx))
SELECT ctx, token, round(prob, 6) AS prob, round(qq / sum(qq) OVER (PARTITION BY ctx), 6) AS prob_t FROM q""")
def q_softmax_temperature(spark, sf_dir):
    m = fitted(spark, sf_dir)
    s = M.softmax_temperature(m, K, TEMP)
    return _round(s.select(F.array_join("ctx", " ").alias("ctx"), "token", "prob", "prob_t"), ["prob", "prob_t"])


GREEDY_SQL = f"""{MODEL_SQL},
top AS (SELECT ctx, token AS nxt FROM (
  SELECT ctx, token, row_number() OVER (PARTITION BY ctx ORDER BY c DESC, token) AS rn FROM cnt) WHERE rn = 1),
utop AS (SELECT token AS nxt FROM uni ORDER BY c1 DESC, token LIMIT 1),
bt AS (SELECT item_id, regexp_extract_all(text, {S.q(S.WORD_RE)}) AS t FROM benchmark),
pr AS (SELECT item_id AS prompt_id, t AS prompt FROM bt),
gen AS (
  SELECT prompt_id, 0 AS step, CASE WHEN len(prompt) >= {K} THEN prompt[len(prompt)] ELSE NULL END AS last,
    CAST([] AS VARCHAR[]) AS out FROM pr
  UNION ALL
  SELECT gen.prompt_id, gen.step + 1, coalesce(top.nxt, (SELECT nxt FROM utop)),
    list_append(gen.out, coalesce(top.nxt, (SELECT nxt FROM utop)))
  FROM gen LEFT JOIN top ON top.ctx = gen.last WHERE gen.step < {STEPS})"""


@register("generate_greedy", "WITH RECURSIVE" + f"""{GREEDY_SQL}""".removeprefix("WITH") + f"""
SELECT pr.prompt_id, array_to_string(pr.prompt, ' ') AS prompt, array_to_string(gen.out, ' ') AS generated
FROM gen JOIN pr USING (prompt_id) WHERE gen.step = {STEPS}""")
def q_generate_greedy(spark, sf_dir):
    m = fitted(spark, sf_dir)
    g = M.generate_greedy(prompts(spark, sf_dir), m, K, STEPS)
    return g.select("prompt_id", F.array_join("prompt", " ").alias("prompt"),
                    F.array_join("generated", " ").alias("generated"))


# Alias tables as in ``alias_table``: whole units, running sums of what light entries lack and heavy ones have too much.
SAMPLE_SQL = GREEDY_SQL[:GREEDY_SQL.index("top AS")] + f"""q0 AS (
  SELECT cnt.ctx, cnt.token, pow(cnt.c / ct.cc, 1.0 / {TEMP}) AS q FROM cnt JOIN ct USING (ctx)
  UNION ALL SELECT '', token, pow(c1 / n1, 1.0 / {TEMP}) FROM uni, st),
q1 AS (SELECT ctx, token, greatest(1, CAST(floor(q / sum(q) OVER (PARTITION BY ctx) * {float(1 << 36)}) AS BIGINT)) AS w FROM q0),
q2 AS (SELECT ctx, token, w, row_number() OVER (PARTITION BY ctx ORDER BY token) - 1 AS slot, count(*) OVER (PARTITION BY ctx) AS n,
  CAST(sum(w) OVER (PARTITION BY ctx) AS BIGINT) AS units FROM q1),
q3 AS MATERIALIZED (SELECT *, w * n - units AS over,
  CAST(sum(greatest(units - w * n, 0)) OVER (PARTITION BY ctx ORDER BY slot) AS BIGINT) AS lack,
  CAST(sum(greatest(w * n - units, 0)) OVER (PARTITION BY ctx ORDER BY slot) AS BIGINT) AS much FROM q2),
heavy AS MATERIALIZED (SELECT ctx, token, slot, much, lead(token) OVER (PARTITION BY ctx ORDER BY slot) AS following FROM q3 WHERE over > 0),
light AS MATERIALIZED (SELECT ctx, token, slot, lack, lack + over AS start FROM q3 WHERE over < 0),
filled AS (SELECT l.ctx, l.slot, h.token AS alt FROM light l ASOF LEFT JOIN heavy h ON l.ctx = h.ctx AND l.start < h.much),
overdrawn AS (SELECT h.ctx, h.slot, l.lack - h.much AS by_units, h.following FROM heavy h ASOF LEFT JOIN light l ON h.ctx = l.ctx AND h.much <= l.lack),
alias AS MATERIALIZED (
  SELECT q3.ctx, q3.slot, q3.token, q3.n, q3.units,
    CASE WHEN over < 0 THEN coalesce(filled.alt, q3.token) WHEN over > 0 THEN coalesce(following, q3.token) ELSE q3.token END AS alt,
    CASE WHEN over < 0 THEN w * n WHEN over > 0 THEN units - by_units ELSE units END AS cut
  FROM q3 LEFT JOIN filled USING (ctx, slot) LEFT JOIN overdrawn USING (ctx, slot)),
heads AS MATERIALIZED (SELECT DISTINCT ctx, n FROM alias),
bt AS (SELECT item_id, regexp_extract_all(text, {S.q(S.WORD_RE)}) AS t FROM benchmark),
pr AS (SELECT item_id AS prompt_id, t AS prompt FROM bt),
us AS MATERIALIZED (SELECT prompt_id, s AS step, CAST('0x' || substr(md5('{SEED}:' || prompt_id || ':' || s), 1, 13) AS BIGINT) / {float(1 << 52)} AS u
  FROM pr, range({STEPS}) r(s)),
gen AS (
  SELECT prompt_id, 0 AS step, CASE WHEN len(prompt) >= {K} THEN prompt[len(prompt)] ELSE '' END AS last, CAST([] AS VARCHAR[]) AS out FROM pr
  UNION ALL
  SELECT prompt_id, step + 1, nxt, list_append(out, nxt) FROM (
    SELECT g.prompt_id, g.step, g.out, CASE WHEN (g.u * a.n - a.slot) * a.units < a.cut THEN a.token ELSE a.alt END AS nxt
    FROM (SELECT gen.prompt_id, gen.step, gen.out, us.u, CASE WHEN heads.n IS NULL THEN '' ELSE gen.last END AS c,
        coalesce(heads.n, (SELECT n FROM heads WHERE ctx = '')) AS n
      FROM gen JOIN us ON us.prompt_id = gen.prompt_id AND us.step = gen.step LEFT JOIN heads ON heads.ctx = gen.last WHERE gen.step < {STEPS}) g
    JOIN alias a ON a.ctx = g.c AND a.slot = least(CAST(floor(g.u * g.n) AS BIGINT), g.n - 1)))"""


@register("generate_sample", "WITH RECURSIVE" + SAMPLE_SQL.removeprefix("WITH") + f"""
SELECT pr.prompt_id, array_to_string(pr.prompt, ' ') AS prompt, array_to_string(gen.out, ' ') AS generated
FROM gen JOIN pr USING (prompt_id) WHERE gen.step = {STEPS}""")
def q_generate_sample(spark, sf_dir):
    m = fitted(spark, sf_dir)
    g = M.generate_sample(prompts(spark, sf_dir), m, K, STEPS, TEMP, SEED)
    return g.select("prompt_id", F.array_join("prompt", " ").alias("prompt"),
                    F.array_join("generated", " ").alias("generated"))

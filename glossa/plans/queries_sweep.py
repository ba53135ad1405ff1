"""Registered queries: parameter sweep, run records and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.operators import sweep as SW
from glossa.plans import sql as S
from glossa.plans.queries import _round, register
from glossa.artifacts import artifact
from glossa.session import artifact_path
from glossa.plans.queries_lm import PROMPT_TOKENS, SPLIT_SQL, SR_LISTS, split_rows

SAMPLE_STEPS = 10  # generated tokens per run

def first_prompt(spark: SparkSession, sf_dir: str) -> list[str]:
    """The context at the end of the first benchmark text: its last tokens (one short row reaches the driver)."""
    from glossa.functions.text import context_tail
    from glossa.operators.tokens import tokenize
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    row = (tokenize(bench, "word", keep=("item_id",)).orderBy("item_id")
           .select(context_tail("toks", PROMPT_TOKENS).alias("p")).first())
    return list(row["p"]) if row else []


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run records of the input; the sweep runs first if no application has saved them."""
    save = lambda path: SW.runs_sink(SW.sweep_runs(split_rows(spark, sf_dir), first_prompt(spark, sf_dir), steps=SAMPLE_STEPS), path)
    return SW.runs_source(spark, artifact(spark, "runs", sf_dir, save, ("documents", "benchmark")))


def _values() -> str:
    rows = []
    for exp, rs in SW.EXPERIMENTS:
        for i, (label, k, a, m) in enumerate(rs):
            rows.append(f"('{exp}', {i}, '{label}', {k}, {a}, {m})")
    return ", ".join(rows)


# DuckDB: contexts of orders 1..3 as strings (word tokens hold no blank), counts on train,
# every run scored at orders 1..k with its own smoothing and pruning.
SWEEP_SQL = f"""{SPLIT_SQL}, {SR_LISTS},
ks AS (SELECT unnest([1, 2, 3]) AS k),
ev0 AS (SELECT split, doc_id, t, k, unnest(range(k, len(t))) AS i FROM srl, ks),
ev AS (SELECT split, k, array_to_string(t[i - k + 1:i], ' ') AS ctx, t[i + 1] AS token FROM ev0),
cnt AS (SELECT k, ctx, token, count(*) AS c FROM ev WHERE split = 'train' GROUP BY k, ctx, token),
ct AS (SELECT k, ctx, sum(c) AS cc FROM cnt GROUP BY k, ctx),
uni AS (SELECT token, count(*) AS c1 FROM sr WHERE split = 'train' GROUP BY token),
st AS (SELECT sum(c1) AS n1, count(*) AS v FROM uni),
cfg AS (SELECT * FROM (VALUES {_values()}) v(exp, ord, label, k, a, min_ctx)),
hist AS (SELECT exp, ord, label, CAST(j AS INTEGER) AS epoch, a, min_ctx FROM cfg, range(1, cfg.k + 1) r(j)),
mm AS (SELECT split, k, ctx, token, count(*) AS m FROM ev GROUP BY split, k, ctx, token),
sc AS (
  SELECT hist.exp, hist.ord, hist.epoch, mm.split, mm.m,
    CASE WHEN ct.cc IS NOT NULL AND ct.cc >= hist.min_ctx
      THEN (coalesce(cnt.c, 0) + hist.a * (coalesce(uni.c1, 0) + 1) / (st.n1 + st.v + 1)) / (ct.cc + hist.a)
      ELSE (coalesce(uni.c1, 0) + 1) / (st.n1 + st.v + 1) END AS p
  FROM mm JOIN hist ON mm.k = hist.epoch
  LEFT JOIN cnt ON mm.k = cnt.k AND mm.ctx = cnt.ctx AND mm.token = cnt.token
  LEFT JOIN ct ON mm.k = ct.k AND mm.ctx = ct.ctx
  LEFT JOIN uni ON mm.token = uni.token, st),
hl AS (SELECT exp, ord, epoch,
  sum(m * -ln(p)) FILTER (WHERE split = 'train') / sum(m) FILTER (WHERE split = 'train') AS train,
  sum(m * -ln(p)) FILTER (WHERE split = 'val') / sum(m) FILTER (WHERE split = 'val') AS val
  FROM sc GROUP BY exp, ord, epoch),
np AS (SELECT cfg.exp, cfg.ord, count(*) AS n_params FROM cnt JOIN ct ON cnt.k = ct.k AND cnt.ctx = ct.ctx
  JOIN cfg ON cnt.k = cfg.k AND ct.cc >= cfg.min_ctx GROUP BY cfg.exp, cfg.ord),
rn AS (SELECT cfg.*, CAST(np.n_params AS BIGINT) AS n_params, hl.train AS final_train_loss, hl.val AS final_val_loss
  FROM cfg JOIN hl ON hl.exp = cfg.exp AND hl.ord = cfg.ord AND hl.epoch = cfg.k
  LEFT JOIN np ON np.exp = cfg.exp AND np.ord = cfg.ord)"""


@register("sweep_runs", f"""{SWEEP_SQL}
SELECT exp, CAST(ord AS INTEGER) AS ord, label, CAST(k AS INTEGER) AS k, CAST(a AS DOUBLE) AS a,
  CAST(min_ctx AS INTEGER) AS min_ctx, n_params,
  round(final_train_loss, 6) AS final_train_loss, round(final_val_loss, 6) AS final_val_loss FROM rn""")
def q_sweep_runs(spark, sf_dir):
    r = runs(spark, sf_dir).select("exp", "ord", "label", "k", "a", "min_ctx", "n_params",
                                   "final_train_loss", "final_val_loss")
    return _round(r, ["final_train_loss", "final_val_loss"])


@register("loss_table", f"""{SWEEP_SQL}
SELECT hl.exp, CAST(hl.ord AS INTEGER) AS ord, any_value(cfg.label) AS label,
  round(max(train) FILTER (WHERE epoch = 1), 6) AS train_1, round(max(val) FILTER (WHERE epoch = 1), 6) AS val_1,
  round(max(train) FILTER (WHERE epoch = 2), 6) AS train_2, round(max(val) FILTER (WHERE epoch = 2), 6) AS val_2,
  round(max(train) FILTER (WHERE epoch = 3), 6) AS train_3, round(max(val) FILTER (WHERE epoch = 3), 6) AS val_3,
  round(max(val) FILTER (WHERE epoch = cfg.k), 6) AS final_val_loss
FROM hl JOIN cfg ON hl.exp = cfg.exp AND hl.ord = cfg.ord GROUP BY hl.exp, hl.ord""")
def q_loss_table(spark, sf_dir):
    t = SW.loss_table(runs(spark, sf_dir))
    return _round(t, [c for c in t.columns if c.startswith(("train_", "val_"))] + ["final_val_loss"])


@register("best_config", f"""{SWEEP_SQL}
SELECT exp, CAST(ord AS INTEGER) AS ord, label, round(final_val_loss, 6) AS final_val_loss
FROM rn ORDER BY final_val_loss, exp, ord LIMIT 1""")
def q_best_config(spark, sf_dir):
    b = SW.best_config(runs(spark, sf_dir), by=())
    return _round(b.select("exp", "ord", "label", "final_val_loss"), ["final_val_loss"])


@register("sweep_summary", f"""{SWEEP_SQL}
SELECT exp, label AS best_label, round(final_val_loss, 6) AS final_val_loss,
  CASE WHEN exp = 'exp2_smoothing' THEN NULL ELSE n_params END AS n_params
FROM (SELECT *, row_number() OVER (PARTITION BY exp ORDER BY final_val_loss, ord) AS r FROM rn) WHERE r = 1""")
def q_sweep_summary(spark, sf_dir):
    return _round(SW.sweep_summary(runs(spark, sf_dir)), ["final_val_loss"])


# Greedy continuation of the first benchmark text's last tokens under every run's order and pruning.
BOX_SQL = "WITH RECURSIVE" + SWEEP_SQL.removeprefix("WITH") + f""",
topc AS MATERIALIZED (SELECT k, ctx, token AS nxt, cc FROM (
  SELECT cnt.k, cnt.ctx, cnt.token, ct.cc, row_number() OVER (PARTITION BY cnt.k, cnt.ctx ORDER BY c DESC, cnt.token) AS r
  FROM cnt JOIN ct ON cnt.k = ct.k AND cnt.ctx = ct.ctx) WHERE r = 1),
utop AS MATERIALIZED (SELECT token FROM uni ORDER BY c1 DESC, token LIMIT 1),
fp AS (SELECT t[greatest(len(t) - {PROMPT_TOKENS}, 0) + 1:] AS p FROM (
  SELECT regexp_extract_all(text, {S.q(S.WORD_RE)}) AS t FROM benchmark ORDER BY item_id LIMIT 1)),
gen AS (
  SELECT exp, ord, k, min_ctx, 0 AS step, p AS toks FROM cfg, fp
  UNION ALL
  SELECT gen.exp, gen.ord, gen.k, gen.min_ctx, gen.step + 1,
    list_append(gen.toks, CASE WHEN topc.cc >= gen.min_ctx THEN topc.nxt ELSE (SELECT token FROM utop) END)
  FROM gen LEFT JOIN topc ON topc.k = gen.k AND topc.ctx = array_to_string(gen.toks[greatest(len(gen.toks) - gen.k, 0) + 1:], ' ')
  WHERE gen.step < {SAMPLE_STEPS}),
box AS (SELECT exp, ord, array_to_string(toks, ' ') AS sample FROM gen WHERE step = {SAMPLE_STEPS})"""

HISTORY_SQL = "CAST(hl.epoch AS INTEGER) AS epoch, round(hl.train, 6) AS train, round(hl.val, 6) AS val"


@register("sample_box", f"""{BOX_SQL}
SELECT rn.exp, CAST(rn.ord AS INTEGER) AS ord, rn.label, round(final_val_loss, 6) AS final_val_loss, box.sample
FROM rn JOIN box ON box.exp = rn.exp AND box.ord = rn.ord""")
def q_sample_box(spark, sf_dir):
    r = runs(spark, sf_dir)
    return _round(r.select("exp", "ord", "label", "final_val_loss", "sample"), ["final_val_loss"])


@register("runs_sink", f"""{BOX_SQL}
SELECT rn.exp, CAST(rn.ord AS BIGINT) AS ord, rn.label, CAST(rn.k AS BIGINT) AS k, CAST(rn.a AS DOUBLE) AS a, CAST(rn.min_ctx AS BIGINT) AS min_ctx, n_params,
  round(final_train_loss, 6) AS final_train_loss, round(final_val_loss, 6) AS final_val_loss, box.sample,
  CAST(hl.epoch AS BIGINT) AS epoch, round(hl.train, 6) AS train, round(hl.val, 6) AS val
FROM rn JOIN box ON box.exp = rn.exp AND box.ord = rn.ord JOIN hl ON hl.exp = rn.exp AND hl.ord = rn.ord""")
def q_runs_sink(spark, sf_dir):
    """Every field of the written file, one row per step of a run's history."""
    path = artifact_path(spark, "runs-copy", sf_dir)
    SW.runs_sink(runs(spark, sf_dir), path)
    back = spark.read.json(path)
    flat = back.select(*[c for c in SW.RUNS_SCHEMA.fieldNames() if c != "history"], F.inline("history"))
    return _round(flat, ["final_train_loss", "final_val_loss", "train", "val"])


@register("runs_source", f"""{SWEEP_SQL}
SELECT hl.exp, CAST(hl.ord AS INTEGER) AS ord, cfg.label, {HISTORY_SQL} FROM hl JOIN cfg ON hl.exp = cfg.exp AND hl.ord = cfg.ord""")
def q_runs_source(spark, sf_dir):
    return _round(runs(spark, sf_dir).select("exp", "ord", "label", F.inline("history")), ["train", "val"])

"""Registered queries: one per inventory ID, each with its DuckDB oracle SQL when SQL can say it.

Every query reads the given tables (or data Spark derives from them) in full;
the only limits are the ones that are the feature (top-k, prefix).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions import text as X
from glossa.operators import agreement as A
from glossa.operators import labels as L
from glossa.operators import tokens as T
from glossa.plans import sql as S
from glossa.artifacts import artifact
from glossa.session import artifact_path
from glossa.sources.corpus import read_documents

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- shared plan fragments ----------------------------------------------------

def word_wide(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    docs = read_documents(spark, sf_dir, columns=tuple(dict.fromkeys(keep + ("text",))))
    return T.tokenize(docs, "word", keep=keep)


def word_labels(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return L.heuristic_labels(word_wide(spark, sf_dir, keep), keep=keep)


def row_labels(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Long ``(doc_id, pos, token, label)`` of one row-local labeller: no H2 count, no join."""
    z = F.arrays_zip(F.col("toks").alias("token"), F.col("labels").alias("label"))
    return X.explode_rows(word_label_wide(spark, sf_dir, which), z, ("doc_id",), "z", "pos").select(
        "doc_id", F.col("pos").cast("int").alias("pos"), "z.token", F.col("z.label").cast("int").alias("label"))


LAB = S.labels_ctes()
LAB_LANG = S.labels_ctes("lang")
LAB_SRC = S.labels_ctes("lang, source")


# --- 2.2 tokens and predicates ------------------------------------------------

@register("word_tokenize", f"WITH {S.word_tokens_cte()} SELECT doc_id, pos, token FROM tok")
def q_word_tokenize(spark, sf_dir):
    return T.explode_tokens(word_wide(spark, sf_dir)).select("doc_id", F.col("pos").cast("int"), "token")


@register("char_tokenize", """
SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM (
  SELECT doc_id, unnest(string_split(text, '')) AS token, unnest(range(length(text))) AS pos
  FROM documents WHERE length(text) > 0)""")
def q_char_tokenize(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    return T.char_tokenize(docs).select("doc_id", F.col("pos").cast("int"), "token")


@register("sentence_start_flag", f"""WITH {S.word_tokens_cte()}
SELECT doc_id, pos, token,
  coalesce(regexp_matches(lag(token) OVER (PARTITION BY doc_id ORDER BY pos), {S.q(r'[.!?\n]\z')}), true) AS is_start
FROM tok""")
def q_sentence_start(spark, sf_dir):
    return L.sentence_start(word_wide(spark, sf_dir))


@register("entity_candidate", f"""{LAB}
SELECT doc_id, pos, token, l0 > 0 AS cand_auto, l1 > 0 AS cand_h1, l2 > 0 AS cand_h2 FROM lab""")
def q_entity_candidate(spark, sf_dir):
    lab = word_labels(spark, sf_dir)
    return lab.select("doc_id", "pos", "token", (F.col("l0") > 0).alias("cand_auto"),
                      (F.col("l1") > 0).alias("cand_h1"), (F.col("l2") > 0).alias("cand_h2"))


@register("label_name", f"""{LAB}
SELECT doc_id, pos, {S.label_name_sql('l0')} AS name_auto, {S.label_name_sql('l1')} AS name_h1,
  {S.label_name_sql('l2')} AS name_h2 FROM lab""")
def q_label_name(spark, sf_dir):
    lab = word_labels(spark, sf_dir)
    return lab.select("doc_id", "pos", X.label_name("l0").alias("name_auto"),
                      X.label_name("l1").alias("name_h1"), X.label_name("l2").alias("name_h2"))


# --- 2.5 labellers ------------------------------------------------------------------

@register("auto_label", f"{LAB} SELECT doc_id, pos, token, l0 AS label FROM lab")
def q_auto_label(spark, sf_dir):
    return row_labels(spark, sf_dir, "l0")


@register("label_h1", f"{LAB} SELECT doc_id, pos, token, l1 AS label FROM lab")
def q_label_h1(spark, sf_dir):
    return row_labels(spark, sf_dir, "l1")


@register("label_h2", f"{LAB} SELECT doc_id, pos, token, l2 AS label FROM lab")
def q_label_h2(spark, sf_dir):
    return word_labels(spark, sf_dir).select("doc_id", "pos", "token", F.col("l2").alias("label"))


def corpus_cap_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequency table of ``documents``; counted and saved first if no application has."""
    save = lambda path: L.cap_freq_save(L.cap_freq(T.explode_tokens(word_wide(spark, sf_dir))), path)
    return L.cap_freq_load(spark, artifact(spark, "cap-freq", sf_dir, save))


@register("label_h2_corpus", f"""{S.labels_ctes(table="(SELECT item_id AS doc_id, text FROM benchmark)", scope="documents")}
SELECT doc_id AS item_id, pos, token, CAST(cf AS BIGINT) AS cap_freq, l2 AS label FROM lab""")
def q_label_h2_corpus(spark, sf_dir):
    """Texts of another table labelled by the frequencies of the wider corpus, and those frequencies."""
    freq = corpus_cap_freq(spark, sf_dir)
    wide = T.tokenize(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "word", keep=("item_id",))
    lab = L.heuristic_labels(wide, keep=("item_id",), freq=freq)
    return L.cap_freq_lookup(lab, freq, spread=("item_id", "pos")).select("item_id", "pos", "token", "cap_freq", F.col("l2").alias("label"))


# --- 2.3 / 2.4 aggregates and lookups ----------------------------------------------

@register("cap_freq", f"""WITH {S.word_tokens_cte()}
SELECT token, count(*) AS cap_freq FROM tok
WHERE regexp_matches(token, {S.q(r'^\p{Lu}')}) AND regexp_matches(token, {S.q(r'\A\p{L}+\z')})
GROUP BY token""")
def q_cap_freq(spark, sf_dir):
    return L.cap_freq(T.explode_tokens(word_wide(spark, sf_dir)))


@register("cap_freq_lookup", f"""WITH {S.word_tokens_cte()},
capf AS (SELECT token AS t, count(*) AS cf FROM tok
  WHERE regexp_matches(token, {S.q(r'^\p{Lu}')}) AND regexp_matches(token, {S.q(r'\A\p{L}+\z')}) GROUP BY token)
SELECT doc_id, pos, token, coalesce(cf, 0) AS cap_freq FROM tok LEFT JOIN capf ON tok.token = capf.t""")
def q_cap_freq_lookup(spark, sf_dir):
    long = T.explode_tokens(word_wide(spark, sf_dir))
    return L.cap_freq_lookup(long, L.cap_freq(long)).select(
        "doc_id", F.col("pos").cast("int"), "token", "cap_freq")


@register("label_distribution", f"""{LAB},
cnt AS (
  SELECT 'auto' AS labeler, l0 AS label FROM lab UNION ALL
  SELECT 'h1', l1 FROM lab UNION ALL SELECT 'h2', l2 FROM lab
),
g AS (SELECT labeler, count(*) AS tot, count(*) FILTER (WHERE label <> 0) AS ent FROM cnt GROUP BY labeler),
dims AS (SELECT labeler, CAST(lbl AS INTEGER) AS label FROM g, range(3) r(lbl))
SELECT dims.labeler, dims.label, {S.label_name_sql('dims.label')} AS label_name,
  CAST(count(cnt.label) AS BIGINT) AS n, any_value(g.ent) AS n_entity,
  round(100.0 * any_value(g.ent) / any_value(g.tot), 6) AS pct_entity
FROM dims JOIN g USING (labeler)
LEFT JOIN cnt ON cnt.labeler = dims.labeler AND cnt.label = dims.label
GROUP BY dims.labeler, dims.label""")
def q_label_distribution(spark, sf_dir):
    lab = word_labels(spark, sf_dir)
    stacked = lab.selectExpr("stack(3, 'auto', l0, 'h1', l1, 'h2', l2) as (labeler, label)")
    return L.label_distribution(stacked, "label", by=("labeler",))


@register("label_align", f"{LAB} SELECT doc_id, pos, l1, l2 FROM lab")
def q_label_align(spark, sf_dir):
    # Both labels are columns of one token table; ``label_align`` is for labels that come apart.
    return word_labels(spark, sf_dir).select("doc_id", "pos", "l1", "l2")


@register("confusion_matrix", f"{LAB} SELECT l1, l2, count(*) AS n FROM lab GROUP BY l1, l2")
def q_confusion(spark, sf_dir):
    return A.confusion_matrix(word_labels(spark, sf_dir))


@register("cohen_kappa", f"""{LAB}, conf AS (SELECT l1, l2, count(*) AS n FROM lab GROUP BY l1, l2)
SELECT n, round(po, 6) AS po, round(pe, 6) AS pe, round(kappa, 6) AS kappa,
  {S.interpretation_sql('kappa')} AS interpretation FROM ({S.kappa_select()})""")
def q_cohen_kappa(spark, sf_dir):
    k = A.cohen_kappa(word_labels(spark, sf_dir))
    return _round(k, ["po", "pe", "kappa"])


@register("kappa_by_lang", f"""{LAB_LANG}, conf AS (SELECT lang, l1, l2, count(*) AS n FROM lab GROUP BY lang, l1, l2)
SELECT lang, n, round(po, 6) AS po, round(pe, 6) AS pe, round(kappa, 6) AS kappa,
  {S.interpretation_sql('kappa')} AS interpretation FROM ({S.kappa_select('lang')})""")
def q_kappa_by_lang(spark, sf_dir):
    lab = word_labels(spark, sf_dir, keep=("doc_id", "lang"))
    return _round(A.cohen_kappa(lab, by=("lang",)), ["po", "pe", "kappa"])


@register("kappa_interpretation", f"""{LAB_SRC}, conf AS (SELECT lang, source, l1, l2, count(*) AS n FROM lab GROUP BY ALL)
SELECT lang, source, round(kappa, 6) AS kappa, {S.interpretation_sql('kappa')} AS interpretation
FROM ({S.kappa_select('lang, source')})""")
def q_kappa_interpretation(spark, sf_dir):
    lab = word_labels(spark, sf_dir, keep=("doc_id", "lang", "source"))
    k = A.cohen_kappa(lab, by=("lang", "source"))
    return _round(k, ["kappa"]).select("lang", "source", "kappa", "interpretation")


@register("disagreement_rate", f"""{LAB}
SELECT count(*) AS n, count(*) FILTER (WHERE l1 <> l2) AS n_disagree,
  round(100.0 * count(*) FILTER (WHERE l1 <> l2) / count(*), 2) AS pct_disagree FROM lab""")
def q_disagreement(spark, sf_dir):
    return A.disagreement_rate(word_labels(spark, sf_dir))


@register("h1_not_h2", f"{LAB} SELECT doc_id, pos, token FROM lab WHERE l1 = 1 AND l2 = 0")
def q_h1_not_h2(spark, sf_dir):
    return A.h1_not_h2(word_labels(spark, sf_dir)).select("doc_id", "pos", "token")


@register("top_disagreements", f"""{LAB},
d AS (SELECT token, doc_id, pos FROM lab WHERE l1 = 1 AND l2 = 0),
g AS (SELECT token, count(*) AS n FROM d GROUP BY token),
fst AS (SELECT token, doc_id AS first_doc_id, pos AS first_pos FROM (
  SELECT *, row_number() OVER (PARTITION BY token ORDER BY doc_id, pos) AS rn FROM d) WHERE rn = 1)
SELECT g.token, g.n, first_doc_id, first_pos FROM g JOIN fst USING (token)
ORDER BY n DESC, first_doc_id, first_pos LIMIT 10""")
def q_top_disagreements(spark, sf_dir):
    return A.top_disagreements(word_labels(spark, sf_dir), 10)


def _round(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), digits))
    return df


# --- 2.5 / entities -------------------------------------------------------------------

def word_label_wide(spark: SparkSession, sf_dir: str, which: str = "l0") -> DataFrame:
    """Wide ``(doc_id, toks, labels)`` with one heuristic label array (no H2: row-local only)."""
    wide = L.label_array(word_wide(spark, sf_dir), {"l0": "auto", "l1": "h1"}[which])
    return wide.select("doc_id", "toks", "labels")


ISLANDS = f"""{LAB},
isl0 AS (SELECT *, sum(CASE WHEN l0 <> 2 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos
  ROWS UNBOUNDED PRECEDING) AS grp FROM lab),
isl AS (SELECT doc_id, grp, CAST(min(pos) AS INTEGER) AS start_pos, CAST(max(pos) AS INTEGER) AS end_pos,
  string_agg(token, ' ' ORDER BY pos) AS entity, arg_min(l0, pos) AS first_label
  FROM isl0 WHERE grp > 0 GROUP BY doc_id, grp),
ent AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start_pos) - 1 AS INTEGER) AS ent_no,
  start_pos, end_pos, entity FROM isl WHERE first_label = 1)"""


@register("extract_entities", f"{ISLANDS} SELECT * FROM ent")
def q_extract_entities(spark, sf_dir):
    from glossa.operators.entities import extract_entities
    return extract_entities(word_label_wide(spark, sf_dir), sep=" ")


@register("extract_entities_chunked", f"{ISLANDS} SELECT * FROM ent")
def q_extract_entities_chunked(spark, sf_dir):
    from glossa.operators.entities import extract_entities_chunked
    from glossa.operators.windows import context_chunks
    chunks = context_chunks(word_label_wide(spark, sf_dir), 64, labels="labels")
    e = extract_entities_chunked(chunks, toks="chunk", sep=" ")
    return e.select("doc_id", F.col("ent_no").cast("int").alias("ent_no"), "start_pos", "end_pos", "entity")


@register("ordered_distinct", f"""{ISLANDS}
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first_no) - 1 AS INTEGER) AS idx, entity
FROM (SELECT doc_id, entity, min(ent_no) AS first_no FROM ent GROUP BY doc_id, entity)""")
def q_ordered_distinct(spark, sf_dir):
    from glossa.operators.entities import ordered_distinct
    return ordered_distinct(word_label_wide(spark, sf_dir), sep=" ")


@register("context_chunks", f"""WITH {S.word_tokens_cte()}
SELECT doc_id, CAST(pos // 64 AS INTEGER) AS chunk_id, CAST(min(pos) AS INTEGER) AS start,
  CAST(count(*) AS INTEGER) AS n_tokens, string_agg(token, ' ' ORDER BY pos) AS chunk_text
FROM tok GROUP BY doc_id, pos // 64""")
def q_context_chunks(spark, sf_dir):
    from glossa.operators.windows import context_chunks
    c = context_chunks(word_wide(spark, sf_dir), 64)
    return c.select("doc_id", "chunk_id", "start", F.size("chunk").cast("int").alias("n_tokens"),
                    F.array_join("chunk", " ").alias("chunk_text"))


# --- 2.1 sources and sinks ---------------------------------------------------------------

from glossa.functions.patterns import LINE_RE, STRIP_RE  # noqa: E402
from glossa.sources import corpus as C  # noqa: E402
from glossa.sources import sinks as K  # noqa: E402

LINES = f"""lines0 AS (
  SELECT doc_id, text, list_filter(list_transform(string_split_regex(text, {S.q(LINE_RE)}),
    lambda x: regexp_replace(x, {S.q(STRIP_RE)}, '', 'g')), lambda x: length(x) > 0) AS ls FROM documents),
lines AS (
  SELECT doc_id, unnest(ls2) AS line, CAST(unnest(range(len(ls2))) AS INTEGER) AS line_no
  FROM (SELECT doc_id, CASE WHEN len(ls) = 0 THEN [text] ELSE ls END AS ls2 FROM lines0))"""


@register("line_source", f"WITH {LINES} SELECT doc_id, line_no, line FROM lines")
def q_line_source(spark, sf_dir):
    return C.line_source(read_documents(spark, sf_dir))


@register("truncate_display", f"""WITH {LINES}
SELECT doc_id, line_no, CASE WHEN length(line) > 80 THEN left(line, 80) || '...' ELSE line END AS display,
  left(text_full, 120) AS preview
FROM lines JOIN (SELECT doc_id, text AS text_full FROM documents) USING (doc_id)""")
def q_truncate_display(spark, sf_dir):
    docs = read_documents(spark, sf_dir).withColumn("preview", X.truncate_display("text", 120, ellipsis=False))
    return C.line_source(docs, keep=("doc_id", "preview")).select(
        "doc_id", "line_no", X.truncate_display("line", 80).alias("display"), "preview")


@register("corpus_load", """SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS doc_no,
  CAST(length(text) AS BIGINT) AS n_chars FROM documents""")
def q_corpus_load(spark, sf_dir):
    from glossa.operators.windows import global_row_number
    docs = read_documents(spark, sf_dir)
    return global_row_number(docs.select("doc_id", F.length("text").cast("bigint").alias("n_chars")),
                             ["doc_id"], "doc_no")


@register("corpus_concat", """SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text,
  count(*) AS n_parts FROM conversations GROUP BY conv_id""")
def q_corpus_concat(spark, sf_dir):
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return C.corpus_concat(conv, "conv_id", "turn")


@register("corpus_preferred_source", """SELECT conv_id, priority, turn, text FROM (
  SELECT conv_id, CAST(CASE WHEN role = 'assistant' THEN 0 ELSE 1 END AS INTEGER) AS priority, turn, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN role = 'assistant' THEN 0 ELSE 1 END, turn) AS rn
  FROM conversations) WHERE rn = 1""")
def q_corpus_preferred_source(spark, sf_dir):
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    cand = conv.withColumn("priority", F.when(F.col("role") == "assistant", 0).otherwise(1).cast("int"))
    return C.corpus_preferred_source(cand, "conv_id", "priority", tie=("turn",))


@register("corpus_prefix", """SELECT doc_id, char_offset, left(text, CAST(least(len, 60000 - char_offset) AS INTEGER)) AS text
FROM (SELECT doc_id, text, length(text) AS len,
  CAST(coalesce(sum(length(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_offset
  FROM documents) WHERE char_offset < 60000""")
def q_corpus_prefix(spark, sf_dir):
    return C.corpus_prefix(read_documents(spark, sf_dir), 60_000)


@register("corpus_union", """SELECT 'documents' AS src, doc_id, 0 AS part, text FROM documents
UNION ALL SELECT 'conversations', conv_id, CAST(turn AS INTEGER), text FROM conversations
UNION ALL SELECT 'benchmark', item_id, 0, text FROM benchmark""")
def q_corpus_union(spark, sf_dir):
    return C.corpus_union(spark, sf_dir)


@register("tsv_escape", f"""WITH {S.word_tokens_cte()}
SELECT doc_id, pos, replace(replace(token, chr(10), '\\n'), chr(9), '\\t') AS token FROM tok""")
def q_tsv_escape(spark, sf_dir):
    long = T.explode_tokens(word_wide(spark, sf_dir))
    return long.select("doc_id", "pos", X.tsv_escape("token").alias("token"))


@register("annotated_tsv_sink", f"""{LAB}
SELECT doc_id, pos AS token_id, replace(replace(token, chr(10), '\\n'), chr(9), '\\t') AS token,
  {S.label_name_sql('l1')} AS etiqueta_H1, {S.label_name_sql('l2')} AS etiqueta_H2 FROM lab""")
def q_annotated_tsv(spark, sf_dir):
    return K.annotated_tsv_rows(word_labels(spark, sf_dir))


@register("annotation_metadata_sink", f"""{LAB}, conf AS (SELECT l1, l2, count(*) AS n FROM lab GROUP BY l1, l2),
k AS ({S.kappa_select()}),
tot AS (SELECT count(*) AS tokens_totales, count(*) FILTER (WHERE l1 <> l2) AS tokens_en_desacuerdo,
  count(*) FILTER (WHERE l1 > 0) AS H1_tokens_entidad, count(*) FILTER (WHERE l1 = 0) AS H1_O,
  count(*) FILTER (WHERE l1 = 1) AS H1_B_ENT, count(*) FILTER (WHERE l1 = 2) AS H1_I_ENT,
  count(*) FILTER (WHERE l2 > 0) AS H2_tokens_entidad, count(*) FILTER (WHERE l2 = 0) AS H2_O,
  count(*) FILTER (WHERE l2 = 1) AS H2_B_ENT, count(*) FILTER (WHERE l2 = 2) AS H2_I_ENT FROM lab)
SELECT '' AS proyecto, '' AS grupo, 'documents' AS fuente, tot.*, round(k.kappa, 4) AS kappa_cohen,
  'acuerdo ' || {S.interpretation_sql('k.kappa')} AS interpretacion,
  round(100.0 * tokens_en_desacuerdo / tokens_totales, 2) AS porcentaje_desacuerdo
FROM tot, k""")
def q_annotation_metadata(spark, sf_dir):
    return K.annotation_metadata_rows(word_labels(spark, sf_dir), source="documents")


# --- 2.2 character grain and vocabulary ---------------------------------------------------

CHAR_VOCAB = """cv AS (SELECT CAST(row_number() OVER (ORDER BY token) - 1 AS INTEGER) AS token_id, token
  FROM (SELECT DISTINCT unnest(string_split(text, '')) AS token FROM documents WHERE length(text) > 0))"""
CONV_CHARS = """cc AS (SELECT conv_id, turn, CAST(unnest(range(length(text))) AS INTEGER) AS pos,
  unnest(string_split(text, '')) AS token FROM conversations WHERE length(text) > 0)"""


def conv_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return T.explode_tokens(T.tokenize(conv, "char", keep=("conv_id", "turn")), keep=("conv_id", "turn")) \
        .select("conv_id", "turn", F.col("pos").cast("int"), "token")


@register("char_vocab", f"WITH {CHAR_VOCAB} SELECT token_id, token FROM cv")
def q_char_vocab(spark, sf_dir):
    return T.char_vocab(read_documents(spark, sf_dir))


@register("oov_map", f"""WITH {CHAR_VOCAB}, {CONV_CHARS}
SELECT conv_id, turn, pos, cc.token, coalesce(cv.token_id, 0) AS token_id FROM cc LEFT JOIN cv USING (token)""")
def q_oov_map(spark, sf_dir):
    vocab = T.char_vocab(read_documents(spark, sf_dir))
    return T.oov_map(conv_chars(spark, sf_dir), vocab)


@register("vocab_lookup_safe", f"""WITH {CHAR_VOCAB}, {CONV_CHARS}
SELECT conv_id, turn, pos, CAST(unicode(cc.token) - 32 AS INTEGER) AS token_id, coalesce(cv.token, '') AS token
FROM cc LEFT JOIN cv ON cv.token_id = unicode(cc.token) - 32""")
def q_vocab_lookup_safe(spark, sf_dir):
    vocab = T.char_vocab(read_documents(spark, sf_dir))
    ids = conv_chars(spark, sf_dir).select("conv_id", "turn", "pos",
                                           (F.ascii("token") - 32).cast("int").alias("token_id"))
    return T.vocab_lookup_safe(ids, vocab)


@register("vocab_pretty", f"""WITH {CHAR_VOCAB}
SELECT token_id, replace(replace(token, chr(10), '\\n'), ' ', '▁') AS pretty FROM cv""")
def q_vocab_pretty(spark, sf_dir):
    return T.vocab_pretty(T.char_vocab(read_documents(spark, sf_dir)))


@register("corpus_stats", f"""WITH {S.word_tokens_cte('lang')},
d AS (SELECT lang, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars,
  CAST(sum(len(regexp_extract_all(text, {S.q(S.WORD_RE)}))) AS BIGINT) AS n_tokens FROM documents GROUP BY lang),
u AS (SELECT lang, count(DISTINCT token) AS n_distinct FROM tok GROUP BY lang)
SELECT d.*, coalesce(u.n_distinct, 0) AS n_distinct FROM d LEFT JOIN u USING (lang)""")
def q_corpus_stats(spark, sf_dir):
    return T.corpus_stats(read_documents(spark, sf_dir, columns=("doc_id", "lang", "text")), by=("lang",))


@register("pair_count", """WITH ch AS (
  SELECT doc_id, unnest(c) AS token, CAST(unnest(range(len(c))) AS INTEGER) AS pos
  FROM (SELECT doc_id, string_split(text, '') AS c FROM documents WHERE length(text) > 0)),
p AS (SELECT doc_id, pos, token AS "left", lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS "right" FROM ch)
SELECT "left", "right", count(*) AS pair_count, arg_min(doc_id, (doc_id, pos)) AS first_ord,
  arg_min(pos, (doc_id, pos)) AS first_pos
FROM p WHERE "right" IS NOT NULL GROUP BY "left", "right"
""")
def q_pair_count(spark, sf_dir):
    return T.pair_count(T.tokenize(read_documents(spark, sf_dir), "char"))


# --- 2.4 BPE ---------------------------------------------------------------------------------

from glossa.functions.patterns import SEG_RE  # noqa: E402
from glossa.operators import bpe as B  # noqa: E402

VOCAB_SIZE = 300  # the source's two sizes
LARGE_VOCAB = 1000


def trained(spark: SparkSession, sf_dir: str, vocab_size: int = VOCAB_SIZE):
    """The tokenizer for the input and size."""
    return B.Tokenizer.load(*K.tokenizer_load(spark, trained_path(spark, sf_dir, vocab_size))[:2])


def trained_path(spark: SparkSession, sf_dir: str, vocab_size: int = VOCAB_SIZE) -> str:
    """Where the tokenizer lies; trained and saved first if no application has."""
    def train(path: str) -> None:
        tok = B.train(read_documents(spark, sf_dir), vocab_size)
        K.tokenizer_save(tok.vocab_df(spark), tok.merges_df(spark), path)

    return artifact(spark, f"tokenizer{vocab_size}", sf_dir, train)


BPE = S.bpe_ctes(VOCAB_SIZE)
CAPITAL = "regexp_matches(ltrim(token, ' '), '" + S.CAPWORD_RE + "') AND length(ltrim(token, ' ')) > 1"


@register("bpe_train", f"{BPE} SELECT * FROM merges")
def q_bpe_train(spark, sf_dir):
    return trained(spark, sf_dir).merges_df(spark)


@register("apply_merge", f"""WITH seg AS (
  SELECT doc_id, unnest(s) AS piece, unnest(range(len(s))) AS seg_no
  FROM (SELECT doc_id, regexp_extract_all(text, {S.q(SEG_RE)}) AS s FROM documents)),
ch AS (SELECT doc_id, seg_no, unnest(string_split(piece, '')) AS c, unnest(range(length(piece))) AS i FROM seg),
pr AS (SELECT doc_id, seg_no, i, c AS l, lead(c) OVER (PARTITION BY doc_id, seg_no ORDER BY i) AS r FROM ch),
best AS (SELECT l, r FROM pr WHERE r IS NOT NULL GROUP BY l, r
  ORDER BY count(*) DESC, min({{'d': doc_id, 's': seg_no, 'i': i}}) LIMIT 1),
pcs AS (SELECT DISTINCT piece FROM seg),
m AS (SELECT piece, l || r AS lr, string_split(replace(piece, l || r, chr(57344)), '') AS t FROM pcs, best)
SELECT piece, CAST(tok_no AS INTEGER) AS tok_no, CASE WHEN tok = chr(57344) THEN lr ELSE tok END AS token
FROM (SELECT piece, lr, unnest(t) AS tok, unnest(range(len(t))) AS tok_no FROM m)""")
def q_apply_merge(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    pcs = B.pieces(docs)
    alphabet = B.base_alphabet(pcs)
    one = B.train(docs, len(alphabet) + 1)
    a, b, _, _ = one.merges[0]
    return B.apply_merge_once(pcs.select("piece"), alphabet, alphabet[a], alphabet[b]) \
        .select("piece", F.col("tok_no").cast("int"), "token")


@register("bpe_encode", f"{BPE} SELECT doc_id, pos, token_id FROM btok")
def q_bpe_encode(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    tok = trained(spark, sf_dir)
    enc = B.encode(docs, tok)
    from glossa.functions.text import explode_rows
    return explode_rows(enc, "ids", ("doc_id",), "token_id", "pos").select(
        "doc_id", F.col("pos").cast("int"), "token_id")


@register("bpe_decode", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, true AS roundtrip FROM documents")
def q_bpe_decode(spark, sf_dir):
    docs = read_documents(spark, sf_dir)
    tok = trained(spark, sf_dir)
    dec = B.decode(B.encode(docs, tok, keep=("doc_id", "text")).withColumnRenamed("text", "orig"), tok)
    return dec.select("doc_id", F.length("text").cast("int").alias("n_chars"),
                      (F.col("text") == F.col("orig")).alias("roundtrip"))


@register("tokenizer_save", f"{BPE} SELECT * FROM merges")
def q_tokenizer_save(spark, sf_dir):
    tok = trained(spark, sf_dir)
    path = artifact_path(spark, "tokenizer-copy", sf_dir)
    K.tokenizer_save(tok.vocab_df(spark), tok.merges_df(spark), path)
    return spark.read.parquet(f"{path}/merges")


@register("tokenizer_load", f"{BPE} SELECT token_id, token, (SELECT count(*) FROM vocab) AS vocab_size FROM vocab")
def q_tokenizer_load(spark, sf_dir):
    vocab, _, size = K.tokenizer_load(spark, trained_path(spark, sf_dir))
    return vocab.withColumn("vocab_size", F.lit(size).cast("bigint"))


@register("capitalised_vocab", f"{S.bpe_ctes(LARGE_VOCAB)} SELECT token_id, token FROM vocab WHERE {CAPITAL}")
def q_capitalised_vocab(spark, sf_dir):
    """At the larger size; segments carry their leading blank, which is stripped for the test."""
    return T.capitalised_vocab(trained(spark, sf_dir, LARGE_VOCAB).vocab_df(spark))


@register("vocab_coverage_by_size", f"""{S.bpe_ctes(LARGE_VOCAB)}
SELECT CAST(s AS INTEGER) AS vocab_size, (SELECT count(*) FROM vocab WHERE token_id < s AND {CAPITAL}) AS n_capitalised
FROM (SELECT unnest([{VOCAB_SIZE}, {LARGE_VOCAB}]) AS s)""")
def q_vocab_coverage(spark, sf_dir):
    return T.vocab_coverage_by_size(trained(spark, sf_dir, LARGE_VOCAB).vocab_df(spark), [VOCAB_SIZE, LARGE_VOCAB])


def bpe_labels(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The three labellers on the BPE grain (the source's own setting)."""
    docs = read_documents(spark, sf_dir, columns=tuple(dict.fromkeys(keep + ("text",))))
    tok = trained(spark, sf_dir)
    enc = B.encode(docs, tok, keep=keep)
    wide = B.id_tokens(enc, tok).drop("ids")
    return L.heuristic_labels(wide, keep=keep)


@register("bpe_kappa", BPE + ", tok AS (SELECT doc_id, pos, token FROM btok JOIN vocab USING (token_id))"
          + LAB.removeprefix("WITH " + S.word_tokens_cte()) + ", conf AS (SELECT l1, l2, count(*) AS n FROM lab GROUP BY l1, l2), "
          + f"k AS ({S.kappa_select()}) SELECT n, round(po, 6) AS po, round(pe, 6) AS pe, round(kappa, 6) AS kappa, "
          + S.interpretation_sql("kappa") + " AS interpretation FROM k")
def q_bpe_kappa(spark, sf_dir):
    lab = bpe_labels(spark, sf_dir)
    return _round(A.cohen_kappa(lab), ["po", "pe", "kappa"])

"""DuckDB building blocks for the oracle SQL.

The oracle is written the straightforward way (unnest + window ``lag`` +
joins), independently of the Spark plans, so that agreement between the two
is evidence of correctness.  Patterns are the same fixed values.
"""

from __future__ import annotations

from glossa.functions.patterns import ALPHA_RE, BOUNDARY_RE, CAPWORD_RE, SEG_RE, UPPER_RE, WORD_RE


def q(pattern: str) -> str:
    """A SQL string literal (DuckDB keeps backslashes as written)."""
    return "'" + pattern.replace("'", "''") + "'"


def word_tokens_cte(extra: str = "", table: str = "documents", pattern: str = WORD_RE) -> str:
    cols = f", {extra}" if extra else ""
    return f"""tok AS (
  SELECT doc_id{cols}, unnest(t) AS token, CAST(unnest(range(len(t))) AS INTEGER) AS pos
  FROM (SELECT doc_id{cols}, regexp_extract_all(text, {q(pattern)}) AS t FROM {table})
)"""


def labels_ctes(extra: str = "", table: str = "documents", pattern: str = WORD_RE, scope: str = "") -> str:
    """``tok`` -> ``lab(doc_id, [extra,] pos, token, l0, l1, l2, cf)`` with the reference rules; ``scope``: the table that H2's frequency is counted on."""
    cols = f", {extra}" if extra else ""
    wider = f"wider AS (SELECT unnest(regexp_extract_all(text, {q(pattern)})) AS token FROM {scope}),\n" if scope else ""
    return f"""WITH {word_tokens_cte(extra, table, pattern)},
{wider}capf AS (
  SELECT token AS cf_token, count(*) AS cap_freq FROM {"wider" if scope else "tok"}
  WHERE regexp_matches(token, {q(UPPER_RE)}) GROUP BY token
),
f AS (
  SELECT tok.*,
    regexp_matches(token, {q(UPPER_RE)}) AND regexp_matches(token, {q(ALPHA_RE)}) AS cap,
    coalesce(regexp_matches(lag(token) OVER (PARTITION BY doc_id ORDER BY pos), {q(BOUNDARY_RE)}), true) AS st,
    coalesce(capf.cap_freq, 0) AS cf
  FROM tok LEFT JOIN capf ON tok.token = capf.cf_token
),
c AS (
  SELECT doc_id{cols}, pos, token, cf,
    cap AND length(token) > 1 AND NOT st AS c0,
    cap AND length(token) >= 1 AND NOT st AS c1,
    cap AND length(token) >= 4 AND NOT st AND cf >= 2 AS c2
  FROM f
),
lab AS (
  SELECT doc_id{cols}, pos, token, CASE WHEN regexp_matches(token, {q(UPPER_RE)}) AND regexp_matches(token, {q(ALPHA_RE)}) THEN cf ELSE 0 END AS cf,
    CAST(CASE WHEN NOT c0 THEN 0 WHEN coalesce(lag(c0) OVER w, false) THEN 2 ELSE 1 END AS INTEGER) AS l0,
    CAST(CASE WHEN NOT c1 THEN 0 WHEN coalesce(lag(c1) OVER w, false) THEN 2 ELSE 1 END AS INTEGER) AS l1,
    CAST(CASE WHEN NOT c2 THEN 0 WHEN coalesce(lag(c2) OVER w, false) THEN 2 ELSE 1 END AS INTEGER) AS l2
  FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
)"""


def label_name_sql(col: str) -> str:
    return f"(['O', 'B-ENT', 'I-ENT'])[{col} + 1]"


def kappa_select(by: str = "", src: str = "conf") -> str:
    """Kappa from a confusion table ``src(by..., l1, l2, n)``."""
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    marg = ", ".join(
        f"sum(CASE WHEN l1 = {c} THEN n ELSE 0 END)::DOUBLE AS a{c}, "
        f"sum(CASE WHEN l2 = {c} THEN n ELSE 0 END)::DOUBLE AS b{c}" for c in range(3))
    pe = " + ".join(f"(a{c} / n) * (b{c} / n)" for c in range(3))
    return f"""SELECT {g}n, po, pe,
  CASE WHEN abs(1 - pe) < 1e-10 THEN 1.0 ELSE (po - pe) / (1 - pe) END AS kappa
FROM (
  SELECT {g}n, agree / n AS po, {pe} AS pe FROM (
    SELECT {g}CAST(sum(n) AS BIGINT) AS n,
      sum(CASE WHEN l1 = l2 THEN n ELSE 0 END)::DOUBLE AS agree, {marg}
    FROM {src} {grp}
  )
)"""


def interpretation_sql(col: str) -> str:
    return (f"CASE WHEN {col} > 0.8 THEN 'excelente' WHEN {col} > 0.6 THEN 'bueno' "
            f"WHEN {col} > 0.4 THEN 'moderado' ELSE 'débil' END")


def bpe_ctes(size: int) -> str:
    """``seg`` (doc_id, piece, seg_no), ``pcs`` (piece, w, n), ``st`` (one row per merge) and ``fin`` (the last state).

    Training as a recursive query: the state is one row that holds all packed
    pieces; a step takes the best pair and replaces it everywhere.
    """
    return f"""WITH RECURSIVE seg AS (
  SELECT doc_id, unnest(s) AS piece, CAST(unnest(range(len(s))) AS INTEGER) AS seg_no
  FROM (SELECT doc_id, regexp_extract_all(text, {q(SEG_RE)}) AS s FROM documents)),
pcs AS (SELECT piece, count(*) AS w, row_number() OVER (ORDER BY min((doc_id, seg_no))) AS n FROM seg GROUP BY piece),
alpha AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS id FROM (SELECT DISTINCT unnest(string_split(piece, '')) AS c FROM pcs)),
al AS (SELECT count(*) AS n0, list(c ORDER BY id) AS v, string_agg(c, '' ORDER BY id) AS cs,
  string_agg(chr((57344 + id)::INTEGER), '' ORDER BY id) AS ids FROM alpha),
st(k, l, w, v, lt, rt, cnt) AS (
  SELECT n0, (SELECT list(translate(piece, cs, ids) ORDER BY n) FROM pcs), (SELECT list(w ORDER BY n) FROM pcs), v,
    NULL::INTEGER, NULL::INTEGER, NULL::BIGINT FROM al
  UNION ALL
  SELECT k + 1, list_transform(l, lambda x : replace(x, b.pair, chr((57344 + k)::INTEGER))), w,
    list_append(v, v[unicode(b.pair[1]) - 57343] || v[unicode(b.pair[2]) - 57343]),
    unicode(b.pair[1]) - 57344, unicode(b.pair[2]) - 57344, b.c
  FROM (SELECT k, l, w, v, (
    SELECT arg_max({{'pair': pair, 'c': c}}, (c, -f)) FROM (
      SELECT pair, sum(wt)::BIGINT AS c, min(n * 1048576 + j) AS f FROM (
        SELECT p[j:j+1] AS pair, wt, n, j FROM (
          SELECT p, wt, n, unnest(range(1, length(p))) AS j
          FROM (SELECT unnest(l) AS p, unnest(w) AS wt, unnest(range(len(l))) AS n)))
      GROUP BY pair)) AS b FROM st WHERE k < {size})
  WHERE b IS NOT NULL),
fin AS (SELECT * FROM st ORDER BY k DESC LIMIT 1),
vocab AS (SELECT CAST(unnest(range(len(v))) AS INTEGER) AS token_id, unnest(v) AS token FROM fin),
merges AS (SELECT CAST(k - 1 - (SELECT n0 FROM al) AS INTEGER) AS rank, lt AS left_id, rt AS right_id,
  CAST(k - 1 AS INTEGER) AS new_id, cnt AS pair_count FROM st WHERE lt IS NOT NULL),
enc AS (SELECT piece, p FROM (SELECT unnest(l) AS p, unnest(range(1, len(l) + 1)) AS n FROM fin) JOIN pcs USING (n)),
btok AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY seg_no, i) - 1 AS INTEGER) AS pos,
    CAST(unicode(c) - 57344 AS INTEGER) AS token_id
  FROM (SELECT doc_id, seg_no, unnest(string_split(p, '')) AS c, unnest(range(length(p))) AS i FROM seg JOIN enc USING (piece)))"""


__all__ = ["q", "bpe_ctes", "word_tokens_cte", "labels_ctes", "label_name_sql", "kappa_select", "interpretation_sql",
           "CAPWORD_RE", "SEG_RE", "WORD_RE"]

"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen (or, for the array lambdas, inside the JVM).
Positional rules work on a per-document token array with index lambdas: the
previous token is ``toks[i-1]`` in the same row, so no window shuffle is needed.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from glossa.functions.patterns import (
    BOUNDARY_CHARS, CAPWORD_RE, KAPPA_BANDS, KAPPA_FLOOR, LABEL_NAMES, PRETTY_SPACE,
    SEG_RE, WORD_RE, WS_CHARS,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- tokenisation ---------------------------------------------------------

def word_tokens(text) -> Column:
    """Words, numbers, newlines and single marks, in text order (ARRAY<STRING>)."""
    return F.regexp_extract_all(_col(text), F.lit(WORD_RE), 0)


def segment_tokens(text) -> Column:
    """BPE pieces: they concatenate back to the exact text."""
    return F.regexp_extract_all(_col(text), F.lit(SEG_RE), 0)


def char_tokens(text) -> Column:
    """Code points of the text; an empty text gives an empty array."""
    t = _col(text)
    return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(F.split(t, "", -1))


# --- scalar predicates ----------------------------------------------------

def is_capitalised(tok) -> Column:
    """Uppercase first character and letters only."""
    return _col(tok).rlike(CAPWORD_RE)


def ends_sentence(tok) -> Column:
    """Last character is . ! ? or a newline (a lookup, no regex)."""
    return F.substring(_col(tok), -1, 1).isin(*BOUNDARY_CHARS)


def sentence_start_flags(toks) -> Column:
    """ARRAY<BOOLEAN>: position 0, or the previous token ends in . ! ? or newline."""
    a = _col(toks)
    return F.transform(a, lambda t, i: F.when(i == 0, F.lit(True)).otherwise(ends_sentence(a[i - 1])))


def candidate_flags(toks, min_len: int = 1) -> Column:
    """ARRAY<BOOLEAN>: capitalised, alphabetic, long enough, and not a sentence start."""
    a = _col(toks)
    return F.transform(
        a,
        lambda t, i: (F.length(t) >= min_len) & is_capitalised(t)
        & F.when(i == 0, F.lit(False)).otherwise(~ends_sentence(a[i - 1])),
    )


def bio_from_candidates(cand) -> Column:
    """ARRAY<INT>: 1 where a candidate run starts, 2 inside the run, 0 elsewhere."""
    c = _col(cand)
    return F.transform(
        c,
        lambda x, i: F.when(~x, F.lit(0)).when(i == 0, F.lit(1))
        .when(c[i - 1], F.lit(2)).otherwise(F.lit(1)),
    )


# --- labels and display ---------------------------------------------------

def label_name(label) -> Column:
    names = F.array(*[F.lit(n) for n in LABEL_NAMES])
    return F.element_at(names, _col(label).cast("int") + 1)


def tsv_escape(tok) -> Column:
    return F.replace(F.replace(_col(tok), F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))


def truncate_display(c, n: int, ellipsis: bool = True) -> Column:
    """Cut at n characters; with ``ellipsis`` add '...' only when the text was longer."""
    s = _col(c)
    cut = F.substring(s, 1, n)
    if not ellipsis:
        return cut
    return F.when(F.length(s) > n, F.concat(cut, F.lit("..."))).otherwise(s)


def vocab_pretty(tok) -> Column:
    return F.replace(F.replace(_col(tok), F.lit("\n"), F.lit("\\n")), F.lit(" "), F.lit(PRETTY_SPACE))


def strip_ws(c) -> Column:
    """Strip Unicode blanks at both ends (Spark's ``trim`` only strips spaces): a pattern would go through the whole text, and look at each run of blanks again from each of its places."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def kappa_interpretation(k) -> Column:
    kc = _col(k)
    expr = F.when(kc.isNull(), F.lit(None))  # no rows, no reading
    for bound, word in KAPPA_BANDS:
        expr = expr.when(kc > bound, F.lit(word))
    return expr.otherwise(F.lit(KAPPA_FLOOR))


# --- arrays ---------------------------------------------------------------

def span(arr, start, n) -> Column:
    """``n`` (1 or more) elements from the 0-based ``start`` on, all of which the array has: ``slice`` reads the whole array for each part that it cuts."""
    a = _col(arr)
    return F.transform(F.sequence(start, start + n - 1), lambda i: F.get(a, i))


def context_tail(arr, n: int) -> Column:
    """Last n elements (all of them when shorter).  ``slice(a, -n, n)`` would give []."""
    a = _col(arr)
    return F.slice(a, F.greatest(F.size(a) - n, F.lit(0)) + 1, F.lit(n))


def uniform_from_key(key) -> Column:
    """Repeatable number in [0, 1) from a string key (first 52 bits of its md5, as many as a double holds)."""
    return F.conv(F.substring(F.md5(_col(key)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


# --- places ----------------------------------------------------------------

#: Places in a row; positions are ints.
PLACES = Decimal(1 << 32)
#: Below every bigint: a null order comes first, as in a struct.
NO_ORDER = Decimal(-(1 << 63) - 1)


def first_place(df, order: str, pos: str) -> Column:
    """Aggregate: the first ``(order, pos)`` of the rows, as ``min(struct(order, pos))``.

    Spark aggregates by hash only what has a fixed width; the minimum of a struct makes it sort all rows, with spills, before they are
    combined.  A whole number and a position make one decimal that sorts alike.  Orders of another type are left to the struct.
    """
    kind = df.schema[order].dataType
    if not isinstance(kind, IntegralType):
        return F.min(F.struct(F.col(order).alias("o"), F.col(pos).cast("int").alias("p")))
    at = F.min(F.coalesce(F.col(order).cast("decimal(20,0)"), F.lit(NO_ORDER)) * F.lit(PLACES) + F.col(pos).cast("decimal(10,0)"))
    place = F.pmod(at, F.lit(PLACES))
    found = F.when(at >= F.lit(PLACES * (NO_ORDER + 1)), ((at - place) / F.lit(PLACES)).cast(kind))
    return F.when(at.isNotNull(), F.struct(found.alias("o"), place.cast("int").alias("p")))


# --- generators -------------------------------------------------------------

def explode_rows(df, arr, keep, alias: str, with_pos: str | None = None):
    """Rows of an array column, ``keep`` columns carried along.

    Uses the ``_outer`` generators plus a NULL filter on their output: for
    plain ``explode`` Catalyst infers ``size(arr) > 0`` and pushes it below the
    projection, re-evaluating (inlining) the whole array expression there,
    which doubles tokenisation and makes indexed lambdas quadratic.
    """
    pos = with_pos or "_pos"
    out = df.select(*keep, F.posexplode_outer(_col(arr)).alias(pos, alias)).filter(F.col(pos).isNotNull())
    return out if with_pos else out.drop(pos)

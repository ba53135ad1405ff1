"""Benchmark decontamination with spaced seeds, with DataFrame functions only.

Texts become tokens: lower-cased runs of letters and digits.  A *mask* fixes which of a few tokens in a row count; the others
are free, so one changed word can't break all seeds that cover it.  Every place of every benchmark item and of every document is hashed under each mask.
Equal hashes join a document's place with an item's place.  Each hit is then verified: along the hit's diagonal, over
``WINDOW`` tokens of the item around it (the whole item if shorter), at least ``LEAST`` of the tokens must be equal, wherever the substitutions are.

Short items have few places, so they get further masks (``SHORT_MASKS``); documents are hashed under those only if the benchmark has such items.  Of all ways to
change as many tokens as ``LEAST`` allows, this finds: 7 to 11 tokens: all; 12: 0.98; 13 and 14: all; 15: 0.95; 16: 0.92; 17: 0.96; 18 and 19: 0.97 and more; 20: 0.96
(counted in the tests).  Items of ``SHORTEST`` to 6 tokens are found word for word.  Texts under ``SHORTEST`` tokens are no passages and aren't looked for.

The benchmark's seeds are broadcast if they are few enough (counted), else Spark shuffles both sides of the join.  Only alignments with equal seeds
leave the scan; the texts of those documents are then read again for the verification.

Defined results: null or empty texts have no hits; equal items all count, items with one id as one, those without an id together as one (``first_item`` is null
if there is no other); a null ``doc_id`` comes back as null; repeated rows each get a result; an empty documents table gives no rows, an empty benchmark
no hits; other columns are ignored, whatever their names, and ``clean_only`` returns them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import external_id, if_small, internal_id, staged, without

#: Of ten tokens, seven count in each mask.
MASKS = ("1101011011", "1011100111", "1110011101")
SPAN = 10
WINDOW = 20
LEAST = 0.8
SHORTEST = 3
#: (mask, fewest and most tokens of the items that it is for)
SHORT_MASKS = (("11011101", 12, 15), ("1001011", 7, 11), ("110101", 7, 11), *(("1" * n, n, n) for n in range(SHORTEST, 7)))
NO_LIMIT = (1 << 31) - 1
ALL_MASKS = (*((m, SPAN, NO_LIMIT) for m in MASKS), *SHORT_MASKS)
Masks = tuple[tuple[str, int, int], ...]


def tokens_of(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")


def masks_for(items: DataFrame) -> Masks:
    """The masks that some item has the length for; at most as many short lengths reach the driver as there are."""
    longest = max(most for _, _, most in SHORT_MASKS)
    sizes = {r["size"] for r in items.where(F.size("tokens") <= longest).select(F.size("tokens").alias("size")).distinct().collect()}
    return tuple(m for m in ALL_MASKS if m[2] == NO_LIMIT or any(m[1] <= n <= m[2] for n in sizes))


def seeded(tokens: DataFrame, keep: list[str], masks: Masks, as_items: bool = False) -> DataFrame:
    """``keep``, ``at`` and ``seed`` of every place and mask (of items: the masks for their length); the tokens aren't kept, so that no row copies them.

    ``explode_outer``: for ``explode``, Spark would compute the tokens a second time to filter by their number.
    """
    size, shortest = F.size("tokens"), min(len(mask) for mask, _, _ in masks)
    places = F.when(size >= shortest, F.sequence(F.lit(0), size - shortest))
    at = tokens.select(*keep, "tokens", F.explode_outer(places).alias("at"))
    seeds = []
    for mask, fewest, most in masks:
        seed = F.xxhash64(*[F.get("tokens", F.col("at") + k) for k, bit in enumerate(mask) if bit == "1"], F.lit(mask))
        fits = F.col("at") + len(mask) <= size
        seeds.append(F.when(fits & size.between(fewest, most) if as_items else fits, seed))
    return at.select(*keep, "at", F.explode(F.array(*seeds)).alias("seed")).where("at IS NOT NULL AND seed IS NOT NULL")


def candidates(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``_id, _text, _item, shift, lo``: distinct alignments of documents with items that share a seed.

    ``shift`` is the document's place less the item's, ``lo`` the first token of the item's window around the hit.
    """
    masks = masks_for(items)
    seeds = staged(seeded(items.withColumn("size", F.size("tokens")), ["_item", "size"], masks, True).withColumnRenamed("at", "item_at"), "decon-seeds", 1)
    found = seeded(docs, ["_id", "_text"], masks).join(if_small(seeds), "seed")
    lo = F.greatest(F.lit(0), F.least(F.col("item_at") - (WINDOW - SPAN) // 2, F.col("size") - F.least(F.col("size"), F.lit(WINDOW))))
    return found.select("_id", "_text", "_item", (F.col("at") - F.col("item_at")).alias("shift"), lo.alias("lo")).distinct()


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``_id, _text, item_id, matched, compared`` of every alignment that passes the verification; ``docs`` has ``_id, _text, text``.

    Items are told apart by a hash of id and text, so those without an id are found as well.
    """
    name = F.xxhash64(F.col("item_id").isNull(), F.col("item_id"), F.coalesce("text", F.lit("")))
    items = benchmark.select(name.alias("_item"), "item_id", tokens_of(F.col("text")).alias("tokens"))
    rows = docs.select("_id", "_text", tokens_of(F.col("text")).alias("tokens"))
    found = staged(candidates(rows, items.select("_item", "tokens")), "decon-candidates")
    ids = if_small(found.select("_id", "_text").distinct())
    texts = docs.join(ids, ["_id", "_text"], "left_semi").select("_id", "_text", tokens_of(F.col("text")).alias("tokens")).distinct()
    both = (found.join(texts, ["_id", "_text"])
            .join(if_small(items.select("_item", "item_id", F.col("tokens").alias("item")).distinct()), "_item"))
    compared = F.least(F.size("item"), F.lit(WINDOW))
    equal = F.filter(F.sequence(F.col("lo"), F.col("lo") + compared - 1),
                     lambda k: (F.col("shift") + k >= 0) & (F.get(F.col("tokens"), F.col("shift") + k) == F.get(F.col("item"), k)))
    both = both.select("_id", "_text", "item_id", F.size(equal).alias("matched"), compared.alias("compared"))
    return both.where(F.col("matched") >= F.ceil(F.col("compared") * LEAST))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(internal_id().alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"), "text")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``_id, _text`` (hash), ``n_items, first_item, best`` of the documents with verified overlaps."""
    return (hits(keyed(docs), benchmark).groupBy("_id", "_text", "item_id").agg(F.max(F.col("matched") / F.col("compared")).alias("best"))
            .groupBy("_id", "_text").agg(F.count(F.lit(1)).alias("n_items"), F.min("item_id").alias("first_item"), F.max("best").alias("best")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, n_items, first_item, best`` of every document."""
    found = contaminated(docs, benchmark)
    every = keyed(docs).select("_id", "_text")
    return every.join(found, ["_id", "_text"], "left").select(
        external_id("_id").alias("doc_id"), F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "first_item", F.coalesce("best", F.lit(0.0)).alias("best"))


def clean_only(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without overlaps, with all their columns."""
    found = staged(contaminated(docs, benchmark).select("_id", "_text"), "decon-found", 1)
    return without(docs, found, {"_id": internal_id(), "_text": F.xxhash64(F.coalesce("text", F.lit("")))})


def _sql_tokens(table: str, key: str) -> str:
    return rf"SELECT {key}, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM {table}"


def _sql_seeds(source: str, key: str, as_items: bool = False) -> str:
    parts = []
    for m, (mask, fewest, most) in enumerate(ALL_MASKS):
        words = " || ' ' || ".join(f"w[pos + {k + 1}]" for k, bit in enumerate(mask) if bit == "1")
        fits = f"len(w) BETWEEN {fewest} AND {most}" if as_items else f"len(w) >= {len(mask)}"
        parts.append(f"SELECT {key}, w, pos, {m} AS mask, {words} AS seed FROM (SELECT {key}, w, unnest(range(len(w) - {len(mask) - 1})) AS pos FROM {source} WHERE {fits})")
    return " UNION ALL ".join(parts)


ORACLE = f"""
WITH d AS ({_sql_tokens('documents', 'doc_id')}), b AS ({_sql_tokens('benchmark', 'item_id')}),
ds AS ({_sql_seeds('d', 'doc_id')}), bs AS ({_sql_seeds('b', 'item_id', True)}),
h AS (
  SELECT doc_id, item_id, ds.w AS dw, bs.w AS bw, ds.pos - bs.pos AS shift, least(len(bs.w), {WINDOW}) AS n,
         greatest(0, least(bs.pos - {(WINDOW - SPAN) // 2}, len(bs.w) - least(len(bs.w), {WINDOW}))) AS lo
  FROM ds JOIN bs USING (mask, seed)
),
m AS (SELECT DISTINCT doc_id, item_id, n, dw, bw, shift, lo FROM h),
v AS (
  SELECT doc_id, item_id, n,
    len(list_filter(range(lo, lo + n), lambda k : shift + k >= 0 AND coalesce(dw[shift + k + 1] = bw[k + 1], false))) AS matched
  FROM m
),
o AS (SELECT doc_id, item_id, max(matched / n) AS best FROM v WHERE matched >= ceil(n * {LEAST}) GROUP BY ALL),
g AS (SELECT doc_id, count(*) AS n_items, min(item_id) AS first_item, max(best) AS best FROM o GROUP BY doc_id)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, first_item, coalesce(best, 0.0)::DOUBLE AS best
FROM documents LEFT JOIN g USING (doc_id)
"""

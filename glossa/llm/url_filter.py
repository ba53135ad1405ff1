"""URL rules through Bloom filter cascades, with DataFrame functions only.

A rule is a host and a path prefix, written ``host/path``.  A url's *keys* are
the suffixes of its host joined with the prefixes of its path, for as many
labels and for those prefix lengths that occur among the rules, so a rule fits
a url exactly if it is one of its keys.

The cascade makes that membership exact without a join.  Level 1 holds the
listed keys.  The keys of the corpus that pass it by mistake go into level 2,
the listed keys that pass level 2 by mistake into level 3, and so on until a
level lets no wrong key through.  A key of the corpus is listed if the first level
that refuses it has an even number.  Built over the corpus's complete set of
keys, it can't err on any of them.

Size: level 1's error rate is chosen so that level 2 gets about as many keys as are listed;
all levels together take about ``1.44 * listed * (log2(corpus keys / listed) + 3)`` bits.
They depend on the list, not on the corpus (but for the logarithm), and travel as literals of the plan.

Defined results: a null url, or one without ``://``, has empty host and path and no rule; of several rules the
longest string wins; equal lengths: the first in order; an empty table gives no rows; repeated rows are judged each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import staged

#: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

DEFAULT_VERDICT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Level:
    bits: int
    hashes: int
    words: list[int]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def url_keys(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """All keys of a url that a rule could equal."""
    labels = F.split(host, r"\.", -1)
    most = max((h.count(".") + 1 for h, _, _ in rules), default=1)
    lengths = sorted({len(p) for _, p, _ in rules})
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))),
                           lambda n: F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n)))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]),
                        lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def _places(key: Column, number: int, level: Level) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number * 64 + i)), F.lit(level.bits)) for i in range(level.hashes)]


def _passes(key: Column, number: int, level: Level) -> Column:
    words = F.array(*[F.lit(w).cast("long") for w in level.words])
    tests = [F.getbit(F.element_at(words, F.floor(p / 64).cast("int") + 1), F.pmod(p, F.lit(64)).cast("int")) == 1
             for p in _places(key, number, level)]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _level(keys: DataFrame, number: int, n: int, rate: float) -> Level:
    """The bits of one level, OR-ed map-side and then over the tasks; at most ``bits / 64`` words reach the driver."""
    hashes = max(1, math.ceil(-math.log2(rate)))
    level = Level(64 * max(1, math.ceil(n * hashes * 1.4427 / 64)), hashes, [])
    at = keys.select(F.explode(F.array(*_places(F.col("key"), number, level))).alias("at"))
    words = (at.groupBy(F.floor(F.col("at") / 64).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(pmod(at, 64) AS INT))")).alias("bits")).collect())
    level.words = [0] * (level.bits // 64)
    for r in words:
        level.words[r["word"]] = r["bits"]
    return level


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels over ``listed`` (key) that are exact for every key of ``universe`` (key, distinct)."""
    n_listed = listed.count()
    if not n_listed:
        return []
    others = staged(universe.join(listed, "key", "left_anti"), "cascade-others")
    n_others = others.count()
    levels = []
    rate = min(0.5, math.sqrt(0.5) * n_listed / max(1, n_others))
    inside, n_inside, outside = listed, n_listed, others
    while n_inside:
        level = _level(inside, len(levels) + 1, n_inside, rate)
        levels.append(level)
        wrong = staged(outside.where(_passes(F.col("key"), len(levels), level)), "cascade-wrong")
        inside, n_inside, outside, rate = wrong, wrong.count(), inside, 0.5
    return levels


def member(key: Column, levels: list[Level]) -> Column:
    """Exact membership of a corpus key: the nesting of level 1 and not (level 2 and not (level 3 ...))."""
    out = None
    for number in range(len(levels), 0, -1):
        test = _passes(key, number, levels[number - 1])
        out = test if out is None else test & ~out
    return F.lit(False) if out is None else out


def _fitting(levels: list[Level], verdict: str) -> Column:
    """The url's keys that the cascade holds, as (n, rule, verdict)."""
    return F.transform(F.filter(F.col("keys"), lambda k: member(k, levels)),
                       lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"), F.lit(verdict).alias("verdict")))


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page; ``verdict`` is the rule's, else ``allow``."""
    rules = RULES if rules is None else rules
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("keys", url_keys(F.col("host"), F.col("path"), rules))
    universe = staged(urls.select(F.explode("keys").alias("key")).distinct(), "cascade-universe")
    fits = {}
    for verdict in ("block", "allow"):
        keys = [h + p for h, p, v in rules if v == verdict]
        listed = spark.range(1).select(F.explode(F.array(*map(F.lit, keys)) if keys else F.array().cast("array<string>")).alias("key"))
        fits[verdict] = _fitting(build_cascade(listed, universe), verdict)
    ranked = F.array_sort(F.concat(*fits.values()),
                          lambda a, b: F.when(a["n"] != b["n"], b["n"] - a["n"]).when(a["rule"] < b["rule"], -1).when(a["rule"] > b["rule"], 1).otherwise(0))
    best = F.get(ranked, F.lit(0))
    return urls.select("page_id", "host", "path", best["rule"].alias("rule"),
                       F.coalesce(best["verdict"], F.lit(DEFAULT_VERDICT)).alias("verdict"))


ORACLE = r"""
WITH r(h, p, rule, verdict) AS (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
                                       ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
s AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM u
),
m AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM s JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT s.page_id, host, path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM s LEFT JOIN m USING (page_id)
"""

"""op8: rules against brute force, and cascades over many keys."""

import random
import re

from glossa.llm import url_filter

RULES = {"net/": ("net", "/", "block"), "example.net/en/": ("example.net", "/en/", "allow"), "example.com/de/": ("example.com", "/de/", "block"), "org/fr/": ("org", "/fr/", "allow")}


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
        path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    fits = [(len(r), r, v) for r, (h, p, v) in RULES.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


URLS = ["http://a.example.net/en/x", "HTTPS://EXAMPLE.NET/EN/", "https://example.net/en", "x://net/", "x://net", "x://net?a/", "ftp://b.org/fr/?q", "x://org/fr/#a", "x://notexample.net/",
        "x://example.com/de/1", "x://aexample.com/de/", "", None, "no scheme", "://", "://net/en/", "x://y://z.net/", "x://.net/", "x://net./", "x://ÄÖ.net/é", "x://a b.org/fr/\nx", "x://u@h.org:80/fr/",
        "x://" + "a." * 3000 + "net/" + "p" * 50_000]


def test_against_brute_force(spark):
    rows = [(i if i else None, u) for i, u in enumerate(URLS * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS keys", "'x' AS host", "'y' AS key").repartition(3)
    out = sorted(map(tuple, url_filter.url_filter(df).collect()), key=str)
    assert out == sorted([(i, *brute(u)) for i, u in rows], key=str)


def test_cascade_is_exact(spark):
    rng = random.Random(8)
    names = [f"host{rng.randrange(10**9)}.net/" for _ in range(4000)]
    universe = spark.createDataFrame([(n,) for n in sorted(set(names))], "key string")
    listed = spark.createDataFrame([(n,) for n in sorted(set(names[:300]))], "key string")
    levels = url_filter.build_cascade(listed, universe)
    assert len(levels) > 2
    got = {r["key"] for r in universe.where(url_filter.member(universe["key"], levels)).collect()}
    assert got == set(names[:300])
    assert sum(level.bits for level in levels) < 40 * 300


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.url_filter(none).count() == 0
    one = spark.createDataFrame([(1, "x://net/")], "page_id long, url string")
    assert url_filter.url_filter(one, []).first()["verdict"] == "allow"

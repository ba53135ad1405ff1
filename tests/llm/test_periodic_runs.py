import hashlib
import random
import zlib
from fractions import Fraction

from glossa.llm import periodic_runs
from glossa.llm.internal_matching import WaveletTree, runs


def by_definition(words):
    """Every run, from all periods at all places."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            stop = start
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            length = stop + q - start
            smaller = any(all(words[start + x] == words[start + x + p] for x in range(length - p)) for p in range(1, q))
            if stop > start and length >= max(6, 4 * q) and not smaller:
                out.append((start, length, q))
            start = stop + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, kinds = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 5])
    words = [str(rng.randrange(kinds)) for _ in range(n)]
    for _ in range(rng.randint(0, 2) if n else 0):
        unit = [str(rng.randrange(kinds)) for _ in range(rng.randint(1, 12))]
        a = rng.randrange(n)
        b = rng.randint(a, n)
        words[a:b] = [unit[i % len(unit)] for i in range(b - a)]
    return words


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(words):
    found = by_definition(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest())


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_search_equals_the_definition():
    rng = random.Random(3)
    for _ in range(800):
        texts = [some_words(rng) for _ in range(rng.randint(1, 4))]
        got = list(periodic_runs._search([" ".join(t).encode() for t in texts]))
        for words, (n, found, _) in zip(texts, got):
            assert (n, found) == (len(words), by_definition(words))


def test_wavelet_tree_neighbours():
    import numpy as np
    rng = np.random.default_rng(5)
    for n in (1, 2, 63, 64, 65, 500):
        values = rng.permutation(n)
        tree = WaveletTree(values)
        lo = rng.integers(0, n, 200)
        hi = np.array([rng.integers(a + 1, n + 1) for a in lo])
        x = np.array([values[rng.integers(a, b)] for a, b in zip(lo, hi)])
        before, after = tree.neighbours(lo, hi, x)
        for a, b, v, p, s in zip(lo, hi, x, before, after):
            inside = values[a:b]
            assert p == max(inside[inside < v], default=-1) and s == min(inside[inside > v], default=-1)


def test_long_runs_of_one_word():
    import numpy as np
    assert runs(np.append(np.zeros(50_000, np.int64), 1), 50_000) == [(0, 50_000, 1)]
    text = np.append(np.tile(np.arange(1_000), 20), 1_000)
    assert runs(text, 20_000) == [(0, 20_000, 1_000)]


def test_query_on_random_documents(table, by_id):
    rng = random.Random(7)
    rows = [(i, rng.choice([" ", "\n", "\t \x0b"]).join(some_words(rng))) for i in range(400)]
    got = by_id(periodic_runs.run_digest(periodic_runs.plant_runs(table(rows))))
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 20
    for i, text in rows:
        assert tuple(got[i][c] for c in COLUMNS) == expected(planted(i, text.split())), i


def test_odd_rows(table):
    long = "x " * 30_000
    rows = [(None, None), (None, "a a a a a a"), (1, ""), (2, " \n\t"), (3, "é é " * 7), (3, "é é " * 7), (4, "A a A a A a A a"), (5, long), (6, "w" * 300_000)]
    out = {(r["doc_id"], r["n_words"]): r for r in periodic_runs.find_runs(table(rows)).collect()}
    assert sum(1 for _ in periodic_runs.find_runs(table(rows)).collect()) == len(rows)
    assert out[(None, 0)]["runs"] == [] and out[(None, 0)]["collapsed"] == ""
    assert [tuple(r) for r in out[(None, 6)]["runs"]] == [(0, 6, 1)] and out[(None, 6)]["collapsed"] == "a"
    assert out[(1, 0)]["collapsed"] == out[(2, 0)]["collapsed"] == ""
    assert [tuple(r) for r in out[(3, 7)]["runs"]] == [(0, 7, 1)]  # a no-break space is part of a word
    assert [tuple(r) for r in out[(4, 8)]["runs"]] == [(0, 8, 2)] and out[(4, 8)]["collapsed"] == "A a"
    assert [tuple(r) for r in out[(5, 30_000)]["runs"]] == [(0, 30_000, 1)]
    assert out[(6, 1)]["collapsed"] == "w" * 300_000
    assert periodic_runs.run_digest(periodic_runs.plant_runs(table(rows[:1]).limit(0))).count() == 0


def test_clashing_columns(table):
    docs = table([(1, "b b b b b b c")])
    for name in ("g", "w", "runs", "best", "collapsed", "n_words"):
        docs = docs.withColumn(name, docs["word"])
    assert periodic_runs.run_digest(periodic_runs.plant_runs(docs)).first()["n_runs"] == 1

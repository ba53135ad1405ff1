"""op10: components against all pairs; the parts against plain sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from glossa.llm import blocks, group_matrix
from glossa.llm.components import components
from glossa.llm.shingles import shingle_sets, text_bytes

INF = 2**63 - 1
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    ids = [INF if i is None else i for i, _ in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                label[find(a)] = find(b)
    least = {}
    for x, i in enumerate(ids):
        least[find(x)] = min(i, least.get(find(x), INF))
    return sorted([(rows[x][0], len(sets[x]), None if least[find(x)] == INF else least[find(x)]) for x in range(len(rows))], key=str)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("group, block", [(3, 7), (96, 2048)])
def test_against_all_pairs(table, monkeypatch, group, block):
    monkeypatch.setattr(group_matrix, "GROUP_SETS", group)
    monkeypatch.setattr(group_matrix, "QUERY_SETS", 2 * group)
    monkeypatch.setattr(group_matrix, "BIN_TOKENS", 500)
    monkeypatch.setattr(blocks, "BLOCK_DOCS", block)
    rng = random.Random(group)
    vocabulary = [f"w{i}" for i in range(3000)]
    common = rng.choices(vocabulary, k=30)
    rows = []
    for f in range(12):
        base = rng.choices(vocabulary, k=rng.choice([3, 6, 20, 60, 200]))
        for c in range(rng.choice([1, 2, 5, 25])):
            text = edited(rng, base, rng.randint(0, max(1, len(base) // 40)))
            if rng.random() < 0.3:
                text = text + common
            rows.append((len(rows), " ".join(text)))
    rows += [(500, None), (501, ""), (502, " \t "), (503, "One"), (504, "one"), (505, "one two"), (None, rows[3][1]), (2, rows[2][1]), (506, "ÄB äb İ"), (507, "äb Äb i̇")]
    out = sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in group_matrix.jaccard_components(table(rows)).collect()], key=str)
    assert out == brute(rows)


def test_short_pairs_alone(table):
    """Two linked texts of which all shared shingles may lie in the half that the screen doesn't look at, with nothing else shared in their block."""
    rng = random.Random(8)
    pairs, hidden = [], []
    while len(hidden) < 3 or len(pairs) < 1:
        words = [f"v{rng.randrange(10**6)}" for _ in range(8)]
        pair = [" ".join(words[:7]), " ".join(words)]
        a, _ = shingle_sets(*text_bytes(pa.array(pair, pa.string())))
        if (a >= group_matrix._HALF).all():
            hidden.append(pair)
        elif not pairs:
            pairs.append(pair)
    for pair in pairs + hidden:
        rows = list(enumerate(pair))
        out = sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in group_matrix.jaccard_components(table(rows)).collect()], key=str)
        assert out == brute(rows) == [(0, 3, 0), (1, 4, 0)]


def test_shingles_are_sets_of_words():
    rng = random.Random(2)
    for _ in range(60):
        texts = ["".join(rng.choice("aBbA  \tcé\n") for _ in range(rng.choice([0, 1, 3, 10, 100, 400]))) for _ in range(rng.randint(0, 9))]
        found = {}
        for t, s in zip(texts, shingle_sets(*text_bytes(pa.array(texts, pa.string())))):
            assert len(s) == len(shingles(t))
            found.setdefault(frozenset(shingles(t)), set()).add(s.tobytes())
        assert all(len(v) == 1 for v in found.values()) and len({x for v in found.values() for x in v}) == len(found)


def test_long_text_in_pieces():
    long = " ".join(f"w{i % 977}" for i in range(200_000)) + " " + "z" * 700_000 + " end"
    (s,) = shingle_sets(*text_bytes(pa.array([long], pa.string())))
    assert len(s) == len(shingles(long))


def test_components(spark):
    rng = random.Random(6)
    pairs = [(i, i + 1) for i in range(100, 200)] + [(0, i) for i in range(1, 50)] + [(7, 7), (3, 2), (2, 3)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    near = {}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got[start] == min(seen)
    assert set(got) == set(near)


def test_packing():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 1000):
        v = np.sort(rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        assert (blocks.unpack(blocks.pack(v)) == v).all()
        v >>= np.uint64(30)
        assert (blocks.unpack(blocks.pack(v)) == v).all()


def test_empty(spark):
    assert group_matrix.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bins_carry_only_their_own_sets():
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(1)
    n, size = 400, 60
    sets = pa.record_batch([pa.array([rng.integers(-2**63, 2**63, size) for _ in range(n)], pa.list_(pa.int64())), *[pa.array(np.arange(n))] * 4],
                           ["tokens", "node", "gid", "label", "pure"])
    sent = {bins: [x.nbytes for x in group_matrix._to_bins(bins)([sets])][0] for bins in (1, 50, 1000)}
    assert sent[1000] < 48 * n * size and sent[1000] < 4 * sent[50]

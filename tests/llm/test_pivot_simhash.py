import random

import numpy as np
import pytest
import xxhash

from glossa.llm import pivot_simhash as P
from glossa.llm.components import components


def simple_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(keys):
    """Smallest member reachable over pairs at three bits or fewer, from all pairs."""
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            if (keys[i] ^ keys[j]).bit_count() <= 3:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(keys))]


def flipped(rng, key, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        key ^= 1 << b
    return key


def clustered(rng, n, seeds, most=5):
    base = [rng.getrandbits(64) for _ in range(seeds)]
    return sorted({flipped(rng, rng.choice(base), most) for _ in range(n)})


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_references_tell_all_parts_apart():
    matrix = np.array([[1 - 2 * (r >> b & 1) for b in range(64)] for r in P.REFERENCES])
    frees = {(1 << 64) - 1}
    for level in range(P.LEVELS):
        masks = P.level_masks(level)
        assert sum(masks) == (1 << 64) - 1 and all(m.bit_count() == 16 for m in masks)
        for part in {m & f for m in masks for f in frees if m & f}:
            bits = [b for b in range(64) if part >> b & 1]
            assert np.linalg.matrix_rank(matrix[:, bits]) == len(bits)
        frees = {f & ~m for m in masks for f in frees}
    assert max(f.bit_count() for f in frees) == 18


def test_close_pairs_join_all_links():
    rng = random.Random(2)
    keys = clustered(rng, 500, 12)
    bucket = np.zeros(len(keys), np.int64)
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = P.close_pairs(bucket, np.array(keys, np.uint64))
    assert len(links) < len(keys) and all((a ^ b).bit_count() <= 3 for a, b in links)
    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    want = grouped(keys)
    assert len({find(k) for k in keys}) == len(set(want))


@pytest.mark.parametrize("bucket", [P.BUCKET, 4])
def test_links_at_all_levels(spark, bucket):
    rng = random.Random(4)
    keys = clustered(rng, 400, 8, most=6)
    common = rng.getrandbits(16)
    keys = sorted(set(keys) | {(rng.getrandbits(48) << 16) | common for _ in range(200)} | {(common << 48) | flipped(rng, 0, 4) for _ in range(100)})
    nodes = spark.createDataFrame([(signed(k),) for k in keys], "fp long")
    labels = {r["node"]: r["label"] for r in components(P.near_links(nodes, bucket)).collect()}
    got = [labels.get(signed(k), signed(k)) for k in keys]
    want = grouped(keys)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_query_equals_all_pairs(table, by_id):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(240):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 400))]
        if i % 3 and texts:
            words = rng.choice(texts).split()
            for _ in range(rng.randint(0, 2)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary).upper()
        texts.append(" ".join(words))
    ids = rng.sample(range(10_000), len(texts))
    got = by_id(P.simhash_components(table(zip(ids, texts))))
    keys = [simple_fingerprint(t) for t in texts]
    want = grouped(keys)
    least = {}
    for i, g in zip(ids, want):
        least[g] = min(i, least.get(g, i))
    assert len(set(want)) < 200
    for i, key, g in zip(ids, keys, want):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{key:016x}", least[g])


def test_odd_rows(table):
    long = "Word " * 150_000 + "end"
    rows = [(None, None), (None, "a b"), (4, ""), (7, " \n"), (9, "A B"), (9, "a\tb"), (2, "x"), (5, long), (6, long.lower())]
    out = P.simhash_components(table(rows)).collect()
    assert len(out) == len(rows)
    pairs = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in out}
    assert pairs[(None, "0" * 16)] == pairs[(4, "0" * 16)] == pairs[(7, "0" * 16)] == 4
    short = f"{simple_fingerprint('a b'):016x}"
    assert pairs[(None, short)] == pairs[(9, short)] == 9
    both = f"{simple_fingerprint(long):016x}"
    assert pairs[(5, both)] == pairs[(6, both)] == 5
    assert P.simhash_components(table(rows[:1]).limit(0)).count() == 0
    alone = P.simhash_components(table([(None, "q")])).first()
    assert alone["doc_id"] is None and alone["component_id"] is None


def test_clashing_columns(table):
    docs = table([(1, "b c d e"), (2, "b c d e")])
    for name in ("fp", "key", "free", "label", "first", "_id", "_salt"):
        docs = docs.withColumn(name, docs["word"])
    assert {r["component_id"] for r in P.simhash_components(docs).collect()} == {1}

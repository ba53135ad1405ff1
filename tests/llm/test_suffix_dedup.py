"""op1: against brute force over all windows, and the suffix array against sorting."""

import hashlib
import random

import numpy as np
import pytest

from glossa.llm import blocks, suffix_dedup
from glossa.llm.suffix_array import suffix_array

INF = 2**63 - 1


def brute(rows):
    first = {}
    for i, t in rows:
        raw, k = (t or "").encode(), INF if i is None else i
        for j in range(len(raw) - 49):
            first[raw[j : j + 50]] = min(k, first.get(raw[j : j + 50], INF))
    out = []
    for i, t in rows:
        raw, k = (t or "").encode(), INF if i is None else i
        gone = bytearray(len(raw))
        for j in range(len(raw) - 49):
            if first[raw[j : j + 50]] < k:
                gone[j : j + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = sum(1 for x in range(len(gone)) if gone[x] and (x == 0 or not gone[x - 1]))
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, suffix_dedup.repeat_digest(df).collect()), key=str)


def test_suffix_array_sorts():
    rng = random.Random(3)
    for _ in range(1500):
        s = [rng.randint(0, rng.randint(1, 4)) for _ in range(rng.randint(0, 40))]
        assert suffix_array(np.array(s, np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("block", [5, 2048])
def test_against_brute_force(table, monkeypatch, block):
    monkeypatch.setattr(blocks, "BLOCK_DOCS", block)
    rng = random.Random(block)
    parts = ["".join(rng.choice("ab cdé") for _ in range(rng.randint(30, 200))) for _ in range(6)] + ["-" * 120, "ab" * 70, "\0" * 60]
    rows = []
    for i in range(60):
        t = "".join(rng.choice(parts) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 80))) for _ in range(rng.randint(0, 5)))
        if rows and rng.random() < 0.3 and (old := rows[rng.randrange(len(rows))][1]):
            k = rng.randrange(len(old))
            t = old[:k] + "X" + old[k + 1 :]
        rows.append((rng.choice([i, i, i // 2, None]), None if rng.random() < 0.05 else t))
    assert got(table(rows)) == brute(rows)


def test_edges(table, spark):
    long = "".join(random.Random(1).choice("abcdefghij ") for _ in range(400_000))
    same = "x" * 10 + "0123456789" * 5
    rows = [(1, long), (2, long[100_000:300_000]), (3, same[:50]), (4, same[1:]), (5, same[:49]), (6, ""), (7, None), (3, same[:50]), (None, same)]
    assert got(table(rows)) == brute(rows)
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []


def test_spans_and_bytes(table):
    text = "Ein Satz über Bäume, der lang genug ist, um zweimal vorzukommen. "
    r = {x["doc_id"]: x for x in suffix_dedup.remove_repeats(table([(1, text), (2, "vorher " + text + "nachher")])).collect()}
    assert r[1]["spans"] == [] and bytes(r[2]["kept"]) == b"vorher nachher"
    assert [tuple(s) for s in r[2]["spans"]] == [(7, 7 + len(text.encode()))]

import hashlib
import math

import duckdb
import numpy as np
import pytest

from glossa.llm import ball_codes as B
from glossa.llm.common import documents

FIELDS = "vec_id long, embedding array<float>, label int, codes string, ints string, sums string, n long, at string, of string"


def table(spark, rows):
    return spark.createDataFrame([(i, e, l, "c", "i", "s", 1, "a", "o") for i, e, l in rows], FIELDS).repartition(3)


def lloyd(rows, entries=B.ENTRIES, rounds=B.ROUNDS):
    """(code, error) by vec_id and the codebooks, one distance at a time."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))
    size = len(rows[0][1])
    ints = [[math.floor(float(np.float32(x)) * 1024) for x in r[1]] for r in rows if len(r[1]) == size]
    width = size // 4
    parts = [[v[p * width : (p + 1) * width] for v in ints] for p in range(4)]
    books = [part[:entries] for part in parts]

    def assign():
        out = []
        for part, book in zip(parts, books):
            out.append([min((sum((a - b) ** 2 for a, b in zip(y, e)), i) for i, e in enumerate(book)) for y in part])
        return out

    for _ in range(rounds):
        for p, found in enumerate(assign()):
            for i in range(len(books[p])):
                mine = [y for y, (_, at) in zip(parts[p], found) if at == i]
                if mine:
                    books[p][i] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    return rows, ["".join(f"{f[n][1]:02x}" for f in found) for n in range(len(ints))], [sum(f[n][0] for f in found) for n in range(len(ints))], books


def check(spark, rows, **how):
    kept, codes, errors, books = lloyd(rows, **how)
    got, entries = B.compress(table(spark, rows), **how)
    assert sorted(((r["vec_id"], r["label"], r["codes"].hex(), r["error"]) for r in got.collect()), key=str) == sorted(
        ((r[0], None if r[2] is None else str(r[2]), c, e) for r, c, e in zip(kept, codes, errors)), key=str)
    assert entries.tolist() == books


@pytest.mark.parametrize("scale", [0.3, 0.004, 3000.0])
def test_equals_plain_rounds(spark, scale):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 8)) * scale
    rows = [(int(i), (centres[i % 12] + rng.normal(size=8) * scale / 9).astype(np.float32).tolist(), int(i % 5) or None) for i in rng.permutation(300)]
    check(spark, rows, entries=20, rounds=3)
    check(spark, rows[:9], entries=20, rounds=2)


def test_balls_skip_work():
    rng = np.random.default_rng(2)
    centres = rng.integers(-900, 900, size=(30, 16))
    x = centres[rng.integers(0, 30, 5000)] + rng.integers(-20, 20, size=(5000, 16))
    book = B.Book(centres)
    code, error, stable = book.reassign(x, B.nearest(x, centres)[0])
    assert stable == 5000 and np.array_equal(error, B.nearest(x, centres)[1])
    code, error, stable = book.reassign(x, rng.integers(0, 30, 5000))
    want = B.nearest(x, centres)
    assert np.array_equal(code, want[0]) and np.array_equal(error, want[1]) and stable < 1000


def test_ties_and_equal_entries(spark):
    rows = [(i, [float(v)] * 4, None) for i, v in enumerate([0, 2, 0, 1, 1, 3, 3, 2, 0])]
    check(spark, rows, entries=4, rounds=1)
    check(spark, rows, entries=4)


def test_given_table_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = sorted(duckdb.sql(B.ORACLE).fetchall())
    got = sorted(map(tuple, B.code_digest(documents(spark, folder, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()))
    assert got == want


def test_odd_rows(spark):
    good = [[0.5, -0.25, 1e-9, -1e-9], [-3.0, 2.0, 0.0, 1.0]]
    rows = [(3, good[0], 1), (None, good[1], None), (None, good[0], None), (5, None, 1), (6, [None, 0.0, 0.0, 0.0], 1), (7, [float("nan")] * 4, 2),
            (8, [float("inf"), 0.0, 0.0, 0.0], 2), (9, [1.0, 2.0], 1), (10, [], 1), (3, good[0], 1), (3, good[1], 4)]
    out = B.code_digest(table(spark, rows)).collect()
    assert sorted((r["vec_id"] for r in out), key=str) == [3, 3, 3, None, None]
    assert {r["error"] for r in out} == {0}
    assert B.code_digest(table(spark, rows).limit(0)).count() == 0
    assert B.code_digest(table(spark, rows[3:7])).count() == 0
    huge = B.code_digest(table(spark, [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [65536.0] * 8, 1)])).collect()
    assert {r["vec_id"]: r["code"] for r in huge}[1] == {r["vec_id"]: r["code"] for r in huge}[3] and all(r["error"] == 0 for r in huge)
    flat = B.code_digest(table(spark, [(1, [1.0, 2.0], 1), (2, [3.0, 4.0], 1)])).collect()  # too short for four parts
    assert {(r["code"], r["error"], r["codebooks_sha256"]) for r in flat} == {("00000000", 0, hashlib.sha256(b"").hexdigest())}
    odd = B.code_digest(table(spark, [(1, [1.0] * 5, 1), (2, [1.0] * 4 + [9.0], 1)])).collect()  # the fifth component is ignored
    assert {r["code"] for r in odd} == {"00000000"}

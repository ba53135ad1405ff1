"""op3: the filter, and groups against brute force, with digests that collide on purpose."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.llm import exact_dedup

INF = 2**63 - 1


def test_filter_has_no_false_negatives():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 70_000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64))
        built = exact_dedup.build_filter(keys)
        if n:
            assert exact_dedup.filter_contains(keys, *built).all()
        others = rng.integers(0, 2**63, 20_000, dtype=np.int64).astype(np.uint64) | np.uint64(1 << 63)
        assert exact_dedup.filter_contains(others, *built).mean() < 0.02 or n <= 3


def brute(rows):
    groups = {}
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        groups.setdefault(norm, []).append(INF if i is None else i)
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        keep = min(groups[norm])
        out.append((i, None if keep == INF else keep, len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [64, 5])
def test_against_brute_force(table, bits):
    rng = random.Random(bits)
    texts = ["a b", "a  b", "a\tb", " a b", "", " ", "\n", None, "ä\u00a0b", "ä b", "x" * 200_000, "y\x0b\x0cz"] + [f"text {i}" for i in range(40)]
    rows = [(rng.choice([i, i, i, None]), rng.choice(texts)) for i in range(150)] + [(0, "a b"), (0, "a b")]
    out = exact_dedup.exact_dedup(table(rows), bits).collect()
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out], key=str) == brute(rows)
    kept = [r["text_sha256"] for r in out if r["kept"]]
    assert len(kept) == len(set(kept)) == len({b[3] for b in brute(rows)})
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


def test_rows_of_one_large_group_are_dealt_over_tasks(table, spark, monkeypatch):
    """A third of the rows share one text, half of those have no id: the same rows by the split join, and no task gets them all."""
    rows = [(None if i % 6 == 0 else i, "copy" if i % 3 == 0 else f"text {i % 900}") for i in range(3000)]
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    monkeypatch.setattr(exact_dedup, "GROUPS_BROADCAST", 0)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = exact_dedup.exact_dedup(table(rows))
        got = out.withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == brute(rows)
    assert sum(r["kept"] for r in got) == len({b[3] for b in brute(rows)})
    parts = Counter(r["part"] for r in got if r["group_size"] >= 1000)
    assert len(parts) > 4 and max(parts.values()) < 400


def test_empty(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0

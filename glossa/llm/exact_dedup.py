"""Exact dedup with static binary-fuse filters over immutable snapshots.

A snapshot is a finished set of documents.  It consists of *exact buckets* (one
row per distinct text: digest, SHA-256, smallest id, number of rows) and of one
static binary-fuse filter per digest shard.  A new batch is first grouped by
itself (its own duplicates meet there, combined map-side).  One digest per
group is then screened against the filter of its shard; only positives are
joined with the exact buckets, and only their texts are fetched and compared
byte by byte.  False positives of a filter find no bucket row and digest
collisions fail the byte check, so the result is exact.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` became one space.

Defined results: null text counts as the empty text; a null ``doc_id`` sorts
after every other id and is returned as null; of repeated rows (same id, same
text) each counts in ``group_size`` and exactly one can be ``kept``; an empty table gives an
empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import FILE_ROWS, external_id, if_small, internal_id, staged
from glossa.operators.lookup import skew_join

#: Digests per filter shard: a filter then takes about 75 KB, at any number of documents.
SHARD_ROWS = 65_536
#: Distinct texts (about 100 bytes each) up to which the groups are broadcast to the rows; beyond, both are shuffled and large groups split.
GROUPS_BROADCAST = 50_000

FILTER_SCHEMA = "shard long, seed long, seg_len long, seg_count long, slots binary"


# -- the filter ---------------------------------------------------------------------------------------------------

def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64(seed)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _places(h: np.ndarray, seg_len: int, seg_count: int) -> np.ndarray:
    """The three slots of each key: neighbouring segments, one slot in each."""
    first = ((h >> np.uint64(32)) * np.uint64(seg_count * seg_len)) >> np.uint64(32)
    mask = np.uint64(seg_len - 1)
    second = (first + np.uint64(seg_len)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * seg_len)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _mark(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Binary-fuse filter (8-bit marks, 3 slots a key) of distinct uint64 keys: (seed, seg_len, seg_count, slots).

    Peels all keys that are alone in a slot, round by round, and fills the slots in reverse order.  A seed whose
    keys don't peel is replaced by the next one.
    """
    n = len(keys)
    if not n:
        return 0, 4, 1, bytes(12)
    seg_len = 1 << min(18, max(2, math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    for attempt in range(1, 200):
        seg_count = max(1, math.ceil(n * (factor + 0.02 * (attempt // 8)) / seg_len) - 2)
        seed = attempt * 0x9E3779B97F4A7C15 % (1 << 63)
        h = _mix(keys, seed)
        at = _places(h, seg_len, seg_count)
        size = (seg_count + 2) * seg_len
        count = np.bincount(at.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # xor of the keys' numbers in a slot: the number itself once it is alone
        number = np.arange(n)
        for row in at:
            np.bitwise_xor.at(owner, row, number)
        rounds = []
        alone = np.flatnonzero(count == 1)
        left = n
        while alone.size:
            key, where = np.unique(owner[alone], return_index=True)
            rounds.append((key, alone[where]))
            left -= key.size
            for row in at[:, key]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(owner, row, key)
            touched = np.unique(at[:, key])
            alone = touched[count[touched] == 1]
        if left:
            continue
        slots = np.zeros(size, np.uint8)
        mark = _mark(h)
        for key, own in reversed(rounds):
            a, b, c = at[:, key]
            slots[own] = 0
            slots[own] = mark[key] ^ slots[a] ^ slots[b] ^ slots[c]
        return seed, seg_len, seg_count, slots.tobytes()
    raise ValueError("the keys of a filter must be distinct")


def filter_contains(keys: np.ndarray, seed: int, seg_len: int, seg_count: int, slots: bytes) -> np.ndarray:
    h = _mix(keys, seed)
    a, b, c = _places(h, seg_len, seg_count)
    s = np.frombuffer(slots, np.uint8)
    return _mark(h) == s[a] ^ s[b] ^ s[c]


# -- Spark side ---------------------------------------------------------------------------------------------------

def normalised(text: Column) -> Column:
    """Runs of ``[\\x20\\x09-\\x0D]`` as one space; a run that is one space already needs no replacement."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def keyed(docs: DataFrame, digest_bits: int = 64) -> DataFrame:
    """One small row per document: ``_id, digest, sha``.  ``digest_bits`` below 64 forces collisions in tests."""
    norm = docs.select(internal_id().alias("_id"), normalised(F.col("text")).alias("norm"))
    digest = F.xxhash64("norm")
    return norm.select("_id", (F.shiftrightunsigned(digest, 64 - digest_bits) if digest_bits < 64 else digest).alias("digest"),
                       F.sha2("norm", 256).alias("sha"))


def grouped(keys: DataFrame) -> DataFrame:
    """The distinct texts of a batch, each with its smallest id, one row (``_row``) that has it, and its number of rows.

    A plain aggregate, so copies are combined before the shuffle.  Where rows repeat an id, any of them may be the one; writing the result settles which.
    """
    return keys.groupBy("digest", "sha").agg(F.min("_id").alias("first_id"), F.min_by("_row", "_id").alias("first_row"), F.count(F.lit(1)).alias("n"))


@dataclass
class Snapshot:
    """Immutable: ``buckets`` (digest, sha, first_id, first_row, n) and ``filters`` (one row per shard), both written tables."""

    buckets: DataFrame
    filters: DataFrame
    shards: int


def shard_of(digest: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.col(digest), F.lit(7)), F.lit(shards))


def build_snapshot(keys: DataFrame) -> Snapshot:
    n = keys.count()
    buckets = staged(grouped(keys), "exact-buckets", n)
    shards = max(1, math.ceil(n / SHARD_ROWS))

    def make(table: pa.Table) -> pa.Table:
        digests = np.unique(table["digest"].to_numpy().astype(np.int64).view(np.uint64))
        seed, seg_len, seg_count, slots = build_filter(digests)
        return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int64()), "seed": pa.array([seed], pa.int64()),
                         "seg_len": pa.array([seg_len], pa.int64()), "seg_count": pa.array([seg_count], pa.int64()),
                         "slots": pa.array([slots], pa.binary())})

    filters = (buckets.select("digest").distinct().withColumn("shard", shard_of("digest", shards))
               .groupBy("shard").applyInArrow(make, FILTER_SCHEMA))
    return Snapshot(buckets, staged(filters, "fuse-filters", n), shards)


def screen(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The batch's digests that the snapshot's filters let through (all true members, about 1 in 256 others)."""

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"digest": pa.array([], pa.int64())})
        digests = left["digest"].to_numpy().astype(np.int64)
        hit = np.zeros(len(digests), bool)
        for r in right.to_pylist():
            hit |= filter_contains(digests.view(np.uint64), r["seed"], r["seg_len"], r["seg_count"], r["slots"])
        return pa.table({"digest": pa.array(digests[hit], pa.int64())})

    left = batch.select("digest").distinct().withColumn("shard", shard_of("digest", snapshot.shards))
    return (left.groupBy("shard").cogroup(snapshot.filters.groupBy("shard")).applyInArrow(probe, "digest long"))


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``_id, sha, norm`` for the wanted (_id, sha); the join broadcasts the ids when few, else Spark shuffles."""
    ids = if_small(wanted.select("_id").distinct())
    rows = docs.select(internal_id().alias("_id"), "text").join(ids, "_id", "left_semi")
    return (rows.select("_id", normalised(F.col("text")).alias("norm"))
            .withColumn("sha", F.sha2("norm", 256)))


def match_batch(batch: DataFrame, snapshot: Snapshot, batch_docs: DataFrame, snapshot_docs: DataFrame) -> DataFrame:
    """Groups of the batch whose text the snapshot holds: ``digest, sha, old_id, old_row, old_n``, after the byte check."""
    hits = screen(batch, snapshot)
    pairs = (batch.join(hits, "digest", "left_semi")
             .join(snapshot.buckets.select("digest", F.col("sha").alias("old_sha"), F.col("first_id").alias("old_id"),
                                           F.col("first_row").alias("old_row"), F.col("n").alias("old_n")), "digest"))
    pairs = staged(pairs, "exact-pairs", batch.count())
    new = texts_of(batch_docs, pairs.select(F.col("first_id").alias("_id")))
    old = texts_of(snapshot_docs, pairs.select(F.col("old_id").alias("_id")))
    new = new.select(F.col("_id").alias("first_id"), "sha", F.col("norm").alias("new_norm"))
    old = old.select(F.col("_id").alias("old_id"), F.col("sha").alias("old_sha"), F.col("norm").alias("old_norm"))
    checked = pairs.join(new, ["first_id", "sha"]).join(old, ["old_id", "old_sha"])
    return (checked.where(F.col("new_norm") == F.col("old_norm"))
            .select("digest", "sha", "old_id", "old_row", "old_n").distinct())


def exact_dedup(docs: DataFrame, digest_bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The lower half of the id range is taken as the stored snapshot and the upper half as the incoming batch.
    """
    rows = docs.count()
    keys = keyed(docs, digest_bits).repartition(max(1, math.ceil(rows / FILE_ROWS)))
    keys = staged(keys.withColumn("_row", F.monotonically_increasing_id()), "exact-keys")
    lo, hi = keys.where(F.col("_id") < F.lit(2**62)).agg(F.min("_id"), F.max("_id")).first()
    middle = 0 if lo is None else (lo + hi) // 2
    is_old, is_old_doc = F.col("_id") <= middle, internal_id() <= middle
    snapshot = build_snapshot(keys.where(is_old))
    batch = staged(grouped(keys.where(~is_old)), "exact-batch", rows)
    seen = match_batch(batch, snapshot, docs.where(~is_old_doc), docs.where(is_old_doc))
    merged = batch.join(seen, ["digest", "sha"], "left").select(
        "digest", "sha", F.coalesce("old_id", "first_id").alias("keep"), F.coalesce("old_row", "first_row").alias("row"), (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("size"))
    groups = (snapshot.buckets.select("digest", "sha", F.col("first_id").alias("keep"), F.col("first_row").alias("row"), F.col("n").alias("size"))
              .unionByName(merged).groupBy("digest", "sha")
              .agg(F.min("keep").alias("keep"), F.min_by("row", "keep").alias("row"), F.max("size").alias("size")))
    groups = staged(groups, "exact-groups", rows)
    # A text that a third of all rows repeat would be one task's: its size is known, so its rows are dealt over parts.
    return skew_join(keys, groups, ["digest", "sha"], "size", ["_row"], "inner", max_rows=GROUPS_BROADCAST).select(
        external_id("_id").alias("doc_id"), external_id("keep").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("_row") == F.col("row")).alias("kept"), F.col("sha").alias("text_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

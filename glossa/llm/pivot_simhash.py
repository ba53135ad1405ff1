"""SimHash near-dedup through pivot distance tables.

1. *Fingerprints.*  A text's 3-word shingles, repeats included, vote on 64 bits with their XXH64; equal fingerprints are one node from here on, so groups
   of copies shrink to one.
2. *Tables.*  The Hamming distances of every fingerprint to ``len(REFERENCES)`` reference fingerprints are computed once per part of the bits:
   a distance to a reference is the sum of the distances of the parts.
3. *Candidates.*  Linked fingerprints differ in at most three bits.  Of four parts one has no differing bit, so there all of its distances agree.  Fingerprints
   meet in a bucket for each part, by that part's row of distances.  (The references are independent on every part, so a row of distances determines the part: the
   buckets let nothing through by chance.)  A bucket with more than ``BUCKET`` members is split again: the bits outside the part are cut into four, of which one agrees again, and
   so on.  Nothing is dropped; a bucket that stays large after the last level has at most 18 bits left to differ in.
4. *Discarding.*  In a bucket only pairs are looked at whose distances to the first reference differ by three at most (a range, as members are sorted by it).  By the triangle
   inequality no distance of linked fingerprints differs by more, so a pair goes with the first coordinate that does: the maximum difference decides.  Survivors are verified bit by bit.
5. Components over the links.  A task only returns links that join what it had not joined yet, so a dense bucket returns fewer links than members.

Defined results: null and blank texts have the fingerprint zero, linked like any other; a null ``doc_id`` sorts after all others and is
returned as null; repeated rows have equal fingerprints; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import bounded_batches, external_id, internal_id, release, staged
from glossa.llm.components import components
from glossa.llm.shingles import mix
from glossa.operators.lookup import skew_join

SIZE = 3
BITS = 3
#: Members of a bucket that are compared; larger ones are split.
BUCKET = 2048
#: Rows of buckets that one task compares, on average.
TASK_ROWS = 100_000
#: Words of a text whose shingles are held at once.
PIECE_WORDS = 1 << 16
#: Candidate pairs held at once.
PAIRS = 1 << 20

_U = np.uint64
#: The reference fingerprints, by rule.
REFERENCES = [int(x) for x in mix(np.arange(1, 25, dtype=_U))]

_hash = partial(xxhash.xxh64_intdigest, seed=42)


#: Weights of a bit's three base-4 digits, as elements of the field of four: any three levels are independent.
LEVEL_WEIGHTS = ((1, 0, 0), (0, 1, 0), (0, 0, 1), (1, 1, 1), (1, 2, 3), (1, 3, 2))
LEVELS = len(LEVEL_WEIGHTS)


def level_masks(level: int) -> list[int]:
    """Four masks that share out all 64 bits; those of different levels cut across one another."""
    def times(x: int, y: int) -> int:
        return (x + y - 2) % 3 + 1 if x and y else 0

    def part(bit: int) -> int:
        digits = (bit >> 4, bit >> 2 & 3, bit & 3)
        x, y, z = (times(w, d) for w, d in zip(LEVEL_WEIGHTS[level], digits))
        return x ^ y ^ z

    return [sum(1 << bit for bit in range(64) if part(bit) == p) for p in range(4)]


# -- fingerprints -------------------------------------------------------------------------------------------------

def fingerprint(text: bytes) -> int:
    """SimHash of a text's word shingles: a bit is set if it is set in over half of the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SIZE:
        return _hash(b" ".join(words))
    votes, total = np.zeros(64, np.int64), len(words) - SIZE + 1
    for lo in range(0, total, PIECE_WORDS):
        w = words[lo : lo + PIECE_WORDS + SIZE - 1]
        hashes = np.fromiter(map(_hash, map(b" ".join, zip(*(w[k:] for k in range(SIZE))))), _U, len(w) - SIZE + 1)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > total, bitorder="little").view(_U)[0])


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = np.array([fingerprint(t.as_py() or b"") for t in b["text"]], _U)
        yield pa.record_batch([b["_id"], pa.array(found.view(np.int64))], ["_id", "fp"])
    release()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``_id, fp`` (the fingerprint's 64 bits as a long) of every row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(internal_id().alias("_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprint_rows, "_id long, fp long")


# -- buckets ------------------------------------------------------------------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _part_key(mask: Column) -> Column:
    """A hash of the distances to all references over the bits of a mask; with the mask, so that parts don't meet."""
    return F.xxhash64(mask, *[F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(r))).bitwiseAND(mask)).cast("byte") for r in REFERENCES])


def into_parts(rows: DataFrame, level: int) -> DataFrame:
    """``key, free, fp``: every row once for each part of the bits still free, in the bucket of the part's distances."""
    masks = F.array(*[F.lit(_signed(m)) for m in level_masks(level)])
    cut = rows.withColumn("level_mask", F.explode(masks)).withColumn("mask", F.col("level_mask").bitwiseAND(F.col("free")))
    return cut.select(F.xxhash64("key", _part_key(F.col("mask"))).alias("key"), F.col("free").bitwiseAND(F.bitwise_not(F.col("level_mask"))).alias("free"), "fp")


class _Joined:
    """What a task has joined so far: the root of every member, as an array."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        ends = np.stack([self.root[a], self.root[b]])
        roots, at = np.unique(ends, axis=1, return_index=True)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while x in parent:
                if parent[x] in parent:
                    parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y, link in zip(*roots.tolist(), zip(a[at].tolist(), b[at].tolist())):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.links.append(link)
        for x in list(parent):
            self.root[x] = find(x)
        while True:
            up = self.root[self.root]
            if np.array_equal(up, self.root):
                return
            self.root = up


def close_pairs(key: np.ndarray, fp: np.ndarray, free: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links, spanning, of the rows with equal keys whose fingerprints differ in at most ``BITS`` bits.  (Rows of one fingerprint are one node.)"""
    nodes, node = np.unique(fp, return_inverse=True)
    tables = np.stack([np.bitwise_count(nodes ^ _U(r)) for r in REFERENCES], axis=1).astype(np.int8)
    _, bucket = np.unique(key, return_inverse=True)
    place = bucket * 256 + tables[node, 0]
    order = np.argsort(place, kind="stable")
    place, node = place[order], node[order]
    count = np.searchsorted(place, place + BITS, "right") - np.arange(len(place)) - 1
    done, joined, lo = np.concatenate([[0], np.cumsum(count)]), _Joined(len(nodes)), 0
    while lo < len(place):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + PAIRS, "right")) - 1)
        left = np.repeat(np.arange(lo, hi), count[lo:hi])
        right = left + 1 + np.arange(len(left)) - np.repeat(done[lo:hi] - done[lo], count[lo:hi])
        a, b = node[left], node[right]
        apart = joined.root[a] != joined.root[b]
        a, b = a[apart], b[apart]
        for coordinate in tables.T[1:]:
            near = np.abs(coordinate[a] - coordinate[b]) <= BITS
            a, b = a[near], b[near]
        linked = np.bitwise_count(nodes[a] ^ nodes[b]) <= BITS
        joined.add(a[linked], b[linked])
        lo = hi
    return [(int(nodes[x]), int(nodes[y])) for x, y in joined.links]


def _compare(table: pa.Table) -> pa.Table:
    links = np.array(close_pairs(table["key"].to_numpy(), table["fp"].to_numpy().view(_U)), _U).reshape(-1, 2).view(np.int64)
    return pa.table({"a": pa.array(links[:, 0]), "b": pa.array(links[:, 1])})


def near_links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links that join all distinct fingerprints ``fp`` which differ in at most ``BITS`` bits."""
    rows = nodes.select(F.lit(0).cast("long").alias("key"), F.lit(-1).cast("long").alias("free"), "fp")
    out = None
    for level in range(LEVELS):
        rows = into_parts(rows, level)
        sizes = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "pivot-sizes")
        small, large, buckets = sizes.agg(F.sum(F.expr(f"if(n <= {bucket}, n, 0)")), F.sum(F.expr(f"if(n > {bucket}, n, 0)")), F.count(F.lit(1))).first()
        if not buckets:
            break
        held = skew_join(rows, sizes, ["key"], "n", ["fp"], "inner")
        if large:
            held = staged(held, "pivot-rows")
        last = level == LEVELS - 1
        tasks = max(1, math.ceil((small + (large if last else 0)) / TASK_ROWS))
        fits = held if last else held.where(F.col("n") <= bucket)
        found = fits.groupBy(F.pmod("key", F.lit(tasks)).alias("task")).applyInArrow(_compare, "a long, b long")
        out = found if out is None else out.unionByName(found)
        if last or not large:
            break
        rows = held.where(F.col("n") > bucket).drop("n")
    return nodes.sparkSession.createDataFrame([], "a long, b long") if out is None else out


# -- the operator -------------------------------------------------------------------------------------------------

def simhash_components(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; ``component_id`` is the smallest id reachable by links, its own included."""
    marked = staged(fingerprints(docs), "pivot-fingerprints")
    nodes = staged(marked.groupBy("fp").agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("n")), "pivot-nodes")
    labels = components(staged(near_links(nodes.select("fp"), bucket), "pivot-links"))
    known = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    known = staged(known, "pivot-known")
    least = staged(known.groupBy("label").agg(F.min("first").alias("component"), F.count(F.lit(1)).alias("members")), "pivot-least")
    named = skew_join(known, least, ["label"], "members", ["fp"]).select("fp", "n", "component")
    out = skew_join(marked, staged(named, "pivot-named"), ["fp"], "n", ["_id"])
    return out.select(external_id("_id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), external_id("component").alias("component_id"))

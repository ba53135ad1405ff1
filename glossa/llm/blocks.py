"""Blocks of documents, and the screen that tells which hashes more than one document holds.

Used by the operators that look for shared content.  Documents are dealt into blocks of bounded size by a hash of
their id.  A block sends its distinct hashes, sorted and packed, to range bins; a bin answers each block with those of
its hashes that are shared.  A block sends a hash once, however many of its documents hold it, so a passage
that a third of all documents share costs a bin one entry per block, not one per document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents per block: about 7 MB of ordinary text.
BLOCK_DOCS = 2048
#: Bits of a hash that the screen compares.  A wrong match only lets something through that the exact steps refuse later.
SCREEN_BITS = 48

_U = np.uint64


def with_block(docs: DataFrame, n_blocks: int) -> DataFrame:
    return docs.withColumn("block", F.pmod(F.xxhash64(F.col("_id"), F.lit(11)), F.lit(n_blocks)))


def block_count(rows: int) -> int:
    return max(1, math.ceil(rows / BLOCK_DOCS))


def pack(values: np.ndarray) -> bytes:
    """Sorted uint64 values as a start and 32-bit steps, or 64-bit steps where one is too wide."""
    if not len(values):
        return b""
    steps = np.diff(values)
    narrow = not len(steps) or int(steps.max()) < 1 << 32
    return (b"\x04" if narrow else b"\x08") + values[:1].tobytes() + steps.astype(np.uint32 if narrow else _U).tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, _U)
    steps = np.frombuffer(data, np.uint32 if data[0] == 4 else _U, offset=9).astype(_U)
    return np.cumsum(np.concatenate([np.frombuffer(data, _U, 1, 1), steps]), dtype=_U)


ENTRY_SCHEMA = "bin long, block long, hashes binary, again binary"


def entries(block: int, hashes: np.ndarray, again: np.ndarray, bins: int, bits: int = SCREEN_BITS) -> pa.Table:
    """A block's sorted distinct ``hashes`` (below ``2**bits``), cut by range into bins; ``again`` marks those held by two of its documents."""
    width = -(-(1 << bits) // bins)
    cuts = np.searchsorted(hashes, (np.arange(bins + 1, dtype=object) * width).clip(0, (1 << bits)).astype(_U))
    rows = [(b, x, y) for b, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if y > x]
    return pa.table({"bin": pa.array([r[0] for r in rows], pa.int64()), "block": pa.array([block] * len(rows), pa.int64()),
                     "hashes": pa.array([pack(hashes[x:y]) for _, x, y in rows], pa.binary()),
                     "again": pa.array([np.packbits(again[x:y]).tobytes() for _, x, y in rows], pa.binary())})


def _answer(table: pa.Table) -> pa.Table:
    rows = [unpack(h) for h in table["hashes"].to_pylist()]
    again = [np.unpackbits(np.frombuffer(a, np.uint8), count=len(r)).astype(bool) for a, r in zip(table["again"].to_pylist(), rows)]
    merged = np.sort(np.concatenate(rows))
    twice = np.concatenate([merged[1:][merged[1:] == merged[:-1]], *[r[a] for r, a in zip(rows, again)]])
    shared = np.unique(twice)
    del merged, twice
    found = []
    for r in rows:
        at = np.searchsorted(shared, r)
        at[at == len(shared)] = 0
        found.append(pack(r[shared[at] == r]) if len(shared) else b"")
    return pa.table({"block": table["block"], "hashes": pa.array(found, pa.binary())})


def shared_hashes(sent: DataFrame) -> DataFrame:
    """``block, hashes``: from every bin, the hashes of a block that another document, there or elsewhere, holds too."""
    return sent.groupBy("bin").applyInArrow(_answer, "block long, hashes binary").where(F.length("hashes") > 0)


def gathered(parts: Iterator[bytes]) -> np.ndarray:
    """The bins' answers to one block as one sorted array."""
    arrays = [unpack(p) for p in parts if p]
    return np.sort(np.concatenate(arrays)) if arrays else np.zeros(0, _U)


def held(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values

"""Encoding by lowest-rank merges and decoding through the vocabulary, in Arrow batches.

Texts are never shuffled: a task encodes each distinct piece of its batches once, remembers up to ``REMEMBERED`` of them, and puts the ids together by
position.  The merge table and the vocabulary travel with the task; both are bounded by the packed ids (``PACK_LIMIT``), whatever the corpus.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Encoded pieces that a task keeps; beyond, it starts anew.
REMEMBERED = 500_000
#: Pieces of rows that are encoded, and ids of rows that are decoded at once.
BLOCK_PIECES = 1 << 18
BLOCK_IDS = 1 << 20

Ranks = dict[tuple[int, int], tuple[int, int]]  # pair -> (rank, new id)


def lowest_rank(ids: list[int], ranks: Ranks) -> list[int]:
    """Merge the adjacent pair of the lowest rank, leftmost first, until none is left: ``n log n`` in the length, whatever the number of merges.

    The same as all merges one after the other in rank order: a merge makes pairs with its new id only, and those rank behind it.
    """
    n = len(ids)
    if n < 2:
        return ids
    ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r[0], i) for i in range(n - 1) if (r := ranks.get((ids[i], ids[i + 1])))]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if ids[i] < 0 or j >= n or (found := ranks.get((ids[i], ids[j]))) is None or found[0] != rank:
            continue  # one of the two has been merged since
        ids[i], ids[j] = found[1], -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if r := ranks.get((ids[i], ids[k])):
                heapq.heappush(heap, (r[0], i))
        if (h := before[i]) >= 0 and (r := ranks.get((ids[h], ids[i]))):
            heapq.heappush(heap, (r[0], h))
    return [x for x in ids if x >= 0]


class Encoder:
    def __init__(self, alphabet: list[str], merges: list[tuple[int, int, int, int]], remembered: int = REMEMBERED):
        self.ids = {c: i for i, c in enumerate(alphabet)}
        self.ranks: Ranks = {}
        for rank, (a, b, new, _) in enumerate(merges):
            self.ranks.setdefault((a, b), (rank, new))
        self.remembered, self.known = remembered, {}

    def piece(self, text: str) -> list[int]:
        """A character outside the alphabet counts as id 0."""
        if not self.ids:
            return []
        return lowest_rank([self.ids.get(c, 0) for c in text], self.ranks)

    def batch(self, rows: pa.ListArray) -> pa.ListArray:
        """The ids of every row of pieces; null counts as no pieces."""
        flat = rows.flatten().dictionary_encode()
        known, codes = [], flat.dictionary.to_pylist()
        for p in codes:
            ids = self.known.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(self.known) >= self.remembered:
                    self.known.clear()
                self.known[p] = ids
            known.append(ids)
        lengths = np.fromiter(map(len, known), np.int64, len(known))
        table = np.fromiter((x for ids in known for x in ids), np.int32, int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        at = flat.indices.to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, np.int64)
        size = lengths[at] if len(at) else np.zeros(0, np.int64)
        stop = np.concatenate([[0], np.cumsum(size)])
        places = np.arange(int(stop[-1])) + np.repeat(starts[at] - stop[:-1], size) if len(at) else np.zeros(0, np.int64)
        pieces = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False))])
        return pa.ListArray.from_arrays(pa.array(stop[pieces].astype(np.int32)), pa.array(table[places], pa.int32()))


def blocks(whole: pa.RecordBatch, at: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in blocks whose lists in column ``at`` have ``most`` elements together, unless one row has more."""
    lo = 0
    sizes = np.cumsum(pc.fill_null(pc.list_value_length(whole.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) if whole.num_rows else []
    while lo < whole.num_rows:
        done = int(sizes[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield whole.slice(lo, hi - lo)
        lo = hi


def encoded(alphabet: list[str], merges: list[tuple[int, int, int, int]], remembered: int):
    """A pass over batches whose last column holds the pieces.

    The places of all ids are numbers of eight bytes, several times: a batch has as many rows as Spark sends, however long, so it is encoded in blocks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(alphabet, merges, remembered)
        for whole in batches:
            for b in blocks(whole, whole.num_columns - 1, BLOCK_PIECES):
                yield pa.record_batch([*b.columns[:-1], encoder.batch(b.column(b.num_columns - 1))], [*b.schema.names[:-1], "ids"])

    return run


def looked_up(vocab: list[str], at: int, name: str, joined: bool, safe: bool):
    """A pass that adds the strings of the ids in column ``at``, joined or as a list; an id outside the vocabulary is '' if ``safe``, else an error."""
    def strings(ids: pa.ListArray, pieces: pa.Array) -> pa.Array:
        flat = ids.flatten()
        outside = pc.or_kleene(pc.less(flat, 0), pc.greater_equal(flat, len(vocab)))
        outside = pc.fill_null(outside, True)
        if not safe and pc.any(outside).as_py():
            raise ValueError(f"token id out of vocabulary: {flat.filter(outside)[0].as_py()}")
        found = pc.take(pieces, pc.if_else(outside, len(vocab), flat))
        bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))]).astype(np.int32)
        rows = pa.ListArray.from_arrays(pa.array(bounds), found, mask=pc.is_null(ids))
        return pc.binary_join(rows, "") if joined else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array([*vocab, ""], pa.string())
        for whole in batches:
            for b in blocks(whole, at, BLOCK_IDS):  # decoded texts are longer than ids
                yield pa.record_batch([*b.columns, strings(b.column(at), pieces)], [*b.schema.names, name])

    return run

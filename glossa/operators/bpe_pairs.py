"""Pair counts of packed pieces that are kept up to date by deltas.

A partition of the piece table is held as one flat array of symbols with a separator between pieces.  Merging a pair touches its occurrences and their
neighbours only; ``Pieces.merge`` returns what that changes: minus the pairs that stood there, plus the new ones.  Summed over all partitions these
are the exact changes of the pair counts, so a merge never recounts anything.  The driver keeps a bounded table of the most frequent pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs of the ranking that the driver holds.  All others count no more than the last of them, and counts of existing pairs only fall.
TABLE_PAIRS = 65_536
SEPARATOR = 10  # no packed id

Merge = tuple[int, int, int]  # left symbol, right symbol, new symbol
At = tuple  # where a pair occurs first
Counted = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # pairs, weights, piece and character of the first occurrence


def at_of(row) -> At:
    """Document, segment and character of a first occurrence, to be compared; a null document comes first."""
    d, s, i = row
    return (d is not None, 0 if d is None else d, s, i)


def pair_key(a: int, b: int) -> int:
    return a << 32 | b


class Pieces:
    """The pieces of a partition as flat arrays, each in a span of its own that ends with a separator; what merges free at a span's end is filled with separators.

    A merge looks through the symbols once and moves only the pieces that hold the pair.
    """

    def __init__(self, packed: list[str], weights: np.ndarray, lengths: dict[int, int]):
        self.symbols = np.frombuffer(("\n".join(packed) + "\n").encode("utf-32-le"), np.int32).copy()
        self.ends = self.symbols == SEPARATOR
        stop = np.flatnonzero(self.ends)
        self.start = np.concatenate([[0], stop[:-1] + 1])
        self.live = stop - self.start  # symbols of each piece
        self.piece = np.repeat(np.arange(len(stop), dtype=np.int32), self.live + 1)
        self.weights = weights
        length = np.ones(max([int(self.symbols.max()), *lengths]) + 1, np.int64)
        length[SEPARATOR] = 0
        length[list(lengths)] = list(lengths.values())
        size = length[self.symbols]
        before = np.cumsum(size) - size
        self.offset = before - before[self.start][self.piece]  # characters before a symbol in its piece

    def _pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair, place) of the places in ``at`` where a pair starts."""
        at = at[(at >= 0) & (at + 1 < len(self.symbols))]
        a, b = self.symbols[at], self.symbols[at + 1]
        inside = (a != SEPARATOR) & (b != SEPARATOR)
        return (a[inside].astype(np.int64) << 32) | b[inside], at[inside]

    def _summed(self, pair: np.ndarray, at: np.ndarray) -> Counted:
        """Distinct pairs, their weights, and the pieces and characters where they come first."""
        order = np.lexsort((at, pair))
        pair, at = pair[order], at[order]
        starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
        n = np.add.reduceat(self.weights[self.piece[at]], starts) if len(starts) else np.zeros(0, np.int64)
        return pair[starts], n, self.piece[at[starts]], self.offset[at[starts]]

    def counts(self) -> Counted:
        return self._summed(*self._pairs(np.arange(len(self.symbols))))

    def firsts(self, wanted: np.ndarray) -> Counted:
        pair, at = self._pairs(np.arange(len(self.symbols)))
        keep = np.isin(pair, wanted)
        return self._summed(pair[keep], at[keep])

    def merge(self, a: int, b: int, new: int, changes: bool = True) -> tuple[Counted, Counted] | None:
        """Replace the pair left to right without overlap; (what goes, what comes) if ``changes`` are asked for."""
        s = self.symbols
        at = np.flatnonzero(s[:-1] == a)
        at = at[s[at + 1] == b]
        if a == b and len(at):  # in a row of equal symbols every other place
            run = np.concatenate([[True], np.diff(at) > 1])
            index = np.arange(len(at))
            at = at[(index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 0]
        gone = self._summed(*self._pairs(np.unique(np.concatenate([at - 1, at, at + 1])))) if changes else None
        held, first, n = np.unique(self.piece[at], return_index=True, return_counts=True)
        live = self.live[held]
        old = np.repeat(self.start[held] - np.cumsum(live) + live, live) + np.arange(int(live.sum()))
        keep = np.ones(len(old), bool)
        keep[np.searchsorted(old, at + 1)] = False
        s[at] = new
        left = live - n
        place = np.repeat(self.start[held] - np.cumsum(left) + left, left) + np.arange(int(left.sum()))
        symbols, offset = s[old[keep]], self.offset[old[keep]]
        s[old] = SEPARATOR
        s[place], self.offset[place], self.live[held] = symbols, offset, left
        if not changes:
            return None
        moved = at - (np.arange(len(at)) - np.repeat(first, n))
        return gone, self._summed(*self._pairs(np.unique(np.concatenate([moved - 1, moved]))))

    def packed(self) -> list[str]:
        return self.symbols[(self.symbols != SEPARATOR) | self.ends].tobytes().decode("utf-32-le").split("\n")[:-1]


def _held(batches: Iterator[pa.RecordBatch], done: list[Merge], lengths: dict[int, int]) -> tuple[Pieces, pa.Table] | None:
    """A task's pieces (they come by first occurrence), with the merges since the table was written."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return None
    table = pa.Table.from_batches(held)
    pieces = Pieces(table["p"].to_pylist(), table["w"].to_numpy(), lengths)
    for a, b, new in done:
        pieces.merge(a, b, new, changes=False)
    return pieces, table


@dataclass
class PairTable:
    """The training state: pieces in Spark (``p, w, d, s``, in each partition by ``d, s``), the ranking of their most frequent pairs on the driver."""
    state: DataFrame
    lengths: dict[int, int] = field(default_factory=dict)  # characters of merged symbols
    done: list[Merge] = field(default_factory=list)  # merges since the state was written
    count: dict[int, int] = field(default_factory=dict)
    at: dict[int, At] = field(default_factory=dict)  # where known
    rest: int = 0  # no pair outside the table counts more
    heap: list[tuple[int, int]] = field(default_factory=list)

    def _rows(self, work: Callable[[Pieces], Iterator[tuple]]) -> DataFrame:
        """``step, pair, n, at`` of what ``work`` yields for every partition, added up."""
        done, kind = list(self.done), dict(self.state.dtypes)
        inner = {c: n for c, n in self.lengths.items() if c not in {m[2] for m in done}}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _held(batches, done, inner)
            if found is None:
                return
            pieces, table = found
            for step, pair, n, row, offset in work(pieces):
                if row is None:
                    first = pa.nulls(len(pair), table.schema.field("d").type), pa.nulls(len(pair), pa.int32()), pa.nulls(len(pair), pa.int64())
                else:
                    first = (*(table[c].take(pa.array(row)).combine_chunks() for c in ("d", "s")), pa.array(offset))
                yield pa.record_batch([pa.array(np.full(len(pair), step, np.int32)), pa.array(pair), pa.array(n), *first], ["step", "pair", "n", "d", "s", "i"])

        rows = self.state.mapInArrow(run, f"step int, pair long, n long, d {kind['d']}, s int, i long")
        at = F.min(F.when(F.col("s").isNotNull(), F.struct("d", "s", "i")))
        return rows.groupBy("step", "pair").agg(F.sum("n").alias("n"), at.alias("at"))

    def _set(self, pair: int, n: int) -> None:
        if n > 0:
            self.count[pair] = n
            heapq.heappush(self.heap, (-n, pair))
        else:
            self.count.pop(pair, None)

    def recount(self) -> None:
        """The ranking from a full count: the most frequent pairs of the present state."""
        def work(pieces: Pieces):
            yield 0, *pieces.counts()

        rows = self._rows(work).orderBy(F.desc("n"), "pair").limit(TABLE_PAIRS + 1).collect()
        self.rest = rows.pop()["n"] if len(rows) > TABLE_PAIRS else 0
        self.heap = []
        self.count, self.at = {}, {}
        for r in rows:
            self._set(r["pair"], r["n"])
            self.at[r["pair"]] = at_of(r["at"])

    def top(self, limit: int) -> list[tuple[int, int]]:
        """The ``limit`` most frequent pairs and all that count as much as the last of them, as (pair, count); ties in any order."""
        out, seen = [], set()
        while self.heap and (len(out) < limit or -self.heap[0][0] == out[-1][1]):
            n, pair = heapq.heappop(self.heap)
            if self.count.get(pair) == -n and pair not in seen:
                seen.add(pair)
                out.append((pair, -n))
        for pair, n in out:
            heapq.heappush(self.heap, (-n, pair))
        return out

    def ranked(self, limit: int) -> list[tuple[int, int]]:
        """The pairs that come next by count, then first occurrence, as far as the table tells; none if it has to be counted again.

        First occurrences are looked up only for pairs that tie for the first place; the list ends before a tie that isn't known.
        """
        top = [(p, n) for p, n in self.top(limit) if n > self.rest]
        if not top:
            return []
        ties = [p for p, n in top if n == top[0][1]]
        unknown = [p for p in ties if p not in self.at] if len(ties) > 1 else []
        if unknown:
            wanted = np.array(sorted(unknown), np.int64)

            def work(pieces: Pieces):
                yield 0, *pieces.firsts(wanted)

            for r in self._rows(work).collect():
                self.at[r["pair"]] = at_of(r["at"])
        out: list[tuple[int, int]] = []
        for i, (pair, n) in enumerate(top):
            tied = (i and top[i - 1][1] == n) or (i + 1 < len(top) and top[i + 1][1] == n)
            if tied and pair not in self.at:
                out = [x for x in out if x[1] != n]
                break
            out.append((pair, n))
        return sorted(out, key=lambda x: (-x[1], self.at[x[0]] if x[0] in self.at else ()))[:limit]

    def is_next(self, pair: int) -> bool:
        """Whether a pair certainly is the next to merge."""
        top = self.top(1)
        n = self.count.get(pair, 0)
        if not top or n != top[0][1] or n <= self.rest:
            return False
        ties = [p for p, _ in top]
        return len(ties) == 1 or (all(p in self.at for p in ties) and min(ties, key=self.at.__getitem__) == pair)

    def changes(self, plan: list[Merge]) -> list[list]:
        """Per merge of ``plan`` the rows (pair, change, first place of a new pair), if all merges before it are made."""
        def work(pieces: Pieces):
            for step, (a, b, new) in enumerate(plan):
                gone, come = pieces.merge(a, b, new)
                yield step, gone[0], -gone[1], None, None
                yield step, *come

        out: list[list] = [[] for _ in plan]
        for r in self._rows(work).collect():
            out[r["step"]].append(r)
        return out

    def apply(self, merge: Merge, length: int, rows: list) -> None:
        """Take a merge and its changes into the ranking."""
        self.done.append(merge)
        self.lengths[merge[2]] = length
        for r in rows:
            pair, n = r["pair"], r["n"]
            new = pair >> 32 == merge[2] or pair & 0xFFFFFFFF == merge[2]
            if new:
                if n > self.rest:
                    self.at[pair] = at_of(r["at"])
                    self._set(pair, n)
            elif n and pair in self.count:
                self.at.pop(pair, None)
                self._set(pair, self.count[pair] + n)

    def rewrite(self, write: Callable[[DataFrame], DataFrame]) -> None:
        """The state with the merges so far, written; pieces of one symbol are done and leave."""
        done, kind = list(self.done), dict(self.state.dtypes)
        inner = {c: n for c, n in self.lengths.items() if c not in {m[2] for m in done}}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _held(batches, done, inner)
            if found is None:
                return
            pieces, table = found
            packed = pieces.packed()
            keep = pa.array([len(p) > 1 for p in packed])
            yield from table.set_column(table.schema.get_field_index("p"), "p", pa.array(packed)).filter(keep).to_batches()

        self.state = write(self.state.mapInArrow(run, f"p string, w long, d {kind['d']}, s int"))
        self.done = []


"""Word shingles as 64-bit hashes, with numpy over whole batches of texts.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z; a shingle is five words in a row, and a text with
fewer words is one shingle of all its words.  Everything works on UTF-8 bytes, in pieces that end at white space,
so memory doesn't grow with the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SIZE = 5
PIECE = 1 << 18

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1B54A32D192ED03))
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = mix(np.arange(101, 101 + SIZE, dtype=_U)) | _U(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(PIECE, 1 << (n - 1).bit_length())
    if size not in _powers:
        with np.errstate(over="ignore"):
            up, down = (np.cumprod(np.concatenate([np.ones(1, _U), np.full(size, b, _U)])) for b in (_BASE, _BACK))
        if size > PIECE:  # a single very long word: not worth keeping
            return up, down
        _powers[size] = up, down
    return _powers[size]


def _hash_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of a piece."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    start, stop = edge[::2], edge[1::2]
    up, down = _power_tables(len(data))
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTE[data] * up[: len(data)])])
        return start, mix((total[stop] - total[start]) * down[start] + (stop - start).astype(_U))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts ``data[bounds[i]:bounds[i+1]]``, and each text's first word number (n + 1 numbers).

    ``data`` is uint8.  Words never reach over a bound, as each bound becomes a piece's end.
    """
    starts, hashes = [], []
    lo, n = int(bounds[0]), int(bounds[-1])
    inner = bounds[1:-1]
    while lo < n:
        hi = min(n, lo + PIECE)
        if hi < n:  # end at the last white space or bound, or else reach to the next one
            gaps = np.flatnonzero(_SPACE[data[lo:hi]])
            cut = int(gaps[-1]) + lo + 1 if gaps.size else lo
            at = int(np.searchsorted(inner, hi, "right"))
            if at and lo < inner[at - 1]:
                cut = max(cut, int(inner[at - 1]))
            while cut <= lo and hi < n:
                top = min(n, hi + PIECE)
                gaps = np.flatnonzero(_SPACE[data[hi:top]])
                after = int(np.searchsorted(inner, hi, "right"))
                ends = ([int(gaps[0]) + hi + 1] if gaps.size else []) + ([int(inner[after])] if after < len(inner) and inner[after] <= top else [])
                cut, hi = (min(ends), hi) if ends else (lo, top)
            hi = cut if cut > lo else n
        piece = data[lo:hi]
        inside = inner[np.searchsorted(inner, lo, "right"): np.searchsorted(inner, hi, "left")] - lo
        if inside.size:  # a blank before each bound, so that words end there
            piece = np.insert(piece, inside, 32)
            start, h = _hash_piece(piece)
            start = start - np.searchsorted(inside + np.arange(len(inside)), start)
        else:
            start, h = _hash_piece(piece)
        starts.append(start + lo)
        hashes.append(h)
        lo = hi
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    h = np.concatenate(hashes) if hashes else np.zeros(0, _U)
    return h, np.searchsorted(start, bounds)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int = SIZE) -> list[np.ndarray]:
    """Per text the sorted distinct shingle hashes; empty for a text without words."""
    h, first = word_hashes(data, bounds)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(h) - size + 1), _U)
        for k in range(size):
            rolled += h[k : k + len(rolled)] * _PLACE[k]
        rolled = mix(rolled + _U(size))
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(rolled[a : b - size + 1]))
            elif b > a:
                out.append(mix(np.sum(h[a:b] * _PLACE[: b - a], keepdims=True) + _U(b - a)))
            else:
                out.append(np.zeros(0, _U))
    return out


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as (uint8 data, bounds); null counts as empty.  Without a copy where it is one chunk."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    if array.null_count:
        array = array.fill_null("")
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]

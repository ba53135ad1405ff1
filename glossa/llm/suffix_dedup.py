"""Removal of repeated byte strings with suffix arrays.

Every byte covered by a string of ``MIN_BYTES`` (50) bytes that also starts in a document with a smaller id is removed; matches
lie within one document, and all strings are judged on the input.

A text of this size can't be sorted in one place, so the strings are brought together by content:

1. Every window of 50 bytes has an anchor: the 24 bytes within it with the smallest hash (the first, if equal).  Equal windows
   have equal anchors.  The screen in ``blocks.py`` finds the anchors that more than one document holds.
2. Around each such anchor a document has a context: the bytes of all windows that the anchor stands for (50 to 76).
   Blocks send a hash of each different context (its *form*) and the smallest id that holds it to the bin of the anchor.  A bin that
   gets one form of an anchor knows all: the windows of that form are held by the same documents.  Of several forms, those that agree
   with no other on 13 bytes left or right of the anchor (any shared window does) share no window either.
3. Blocks send the bytes of the other forms.  A bin joins what follows the anchors, and what precedes them read backwards, into one text of
   8-byte symbols.  Its suffix array (``suffix_array.py``) puts the suffixes that begin at equal anchors side by side, ordered by what follows.
   Neighbours with enough common bytes form runs; windows with j bytes left of the anchor are equal where both the runs of j common bytes to
   the left and of ``26 - j`` to the right agree, which gives the smallest id of each window.
4. Blocks get the smallest ids back per form and remove bytes.

The shuffled text is the same for steps 1 to 4, so Spark reuses one exchange.  A passage in a third of all documents reaches
a bin once per block and form, never once per document.

Defined results: null text counts as empty; texts under 50 bytes stay whole; a null ``doc_id`` is larger than all others and comes
back as null; rows with the same id don't repeat each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm import blocks as B
from glossa.llm.common import bounded_batches, external_id, internal_id
from glossa.llm.shingles import mix, text_bytes
from glossa.llm.suffix_array import suffix_array

MIN_BYTES = 50
ANCHOR = 24
#: Anchor places in a window, so also the most windows of a context.
PLACES = MIN_BYTES - ANCHOR + 1
WIDTH = 80  # of a context's row: 76 bytes, and up to a multiple of 8
#: Of the bytes of a window outside its anchor, one side has at least half.
SIDE = (PLACES - 1) // 2
STEP = 1 << 17

_U = np.uint64
_M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9)


def _slide(a: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        a = pick(a[:-span], a[span:])
        span *= 2
    return pick(a[: len(a) - (width - span)], a[width - span :]) if span < width else a


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes from each place."""
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    n = len(data) - ANCHOR + 1
    h = np.zeros(n, _U)
    with np.errstate(over="ignore"):
        for at in range(0, ANCHOR, 8):
            h += words[at : at + n]
            h *= _M1
            h ^= h >> _U(29)
        h *= _M2
        h ^= h >> _U(32)
    return h


#: Low bits of a key that hold a place within a step.
_PLACE_BITS = 18
_PLACE = _U((1 << _PLACE_BITS) - 1)


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, re-mixed hash, first window, last window) of all anchors of the texts, in order.

    Works in steps; an anchor whose windows reach over a step's end is cut there and joined again at the end.
    """
    n = len(data)
    edges = np.zeros(n + 1, np.int8)
    long = np.flatnonzero(np.diff(bounds) >= MIN_BYTES)
    edges[bounds[long]] = 1
    edges[bounds[long + 1] - MIN_BYTES + 1] = -1
    valid = np.cumsum(edges[:n], dtype=np.int8).view(bool)
    out: list[list[np.ndarray]] = [[], [], [], []]
    for lo in range(0, n - MIN_BYTES + 1, STEP):  # windows that start in lo..hi
        hi = min(n - MIN_BYTES + 1, lo + STEP)
        h = _anchor_hashes(data[lo : hi + MIN_BYTES - 1])
        key = (h & ~_PLACE) | np.arange(len(h), dtype=_U)
        at = (_slide(key, PLACES, np.minimum) & _PLACE).astype(np.int64)  # by window
        ok = valid[lo:hi]
        turn = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (ok[1:] != ok[:-1])]))
        last = np.append(turn[1:], len(at)) - 1
        turn, last = turn[ok[turn]], last[ok[turn]]
        for column, values in zip(out, (at[turn] + lo, h[at[turn]], turn + lo, last + lo)):
            column.append(values)
    place, h, first, last = (np.concatenate(c) if c else np.zeros(0, _U if i == 1 else np.int64) for i, c in enumerate(out))
    again = np.flatnonzero((place[1:] == place[:-1]) & (first[1:] == last[:-1] + 1)) + 1
    last[again - 1] = last[again]
    place, h, first, last = (np.delete(c, again) for c in (place, h, first, last))
    return place, mix(h), first, last


def contexts(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The contexts as rows of ``WIDTH`` bytes, zero after their end."""
    out = np.zeros((len(first), WIDTH), np.uint8)
    offsets = np.arange(WIDTH)
    for lo in range(0, len(first), 8192):
        f = first[lo : lo + 8192, None]
        size = last[lo : lo + 8192, None] + MIN_BYTES - f
        rows = data[np.minimum(f + offsets, len(data) - 1)]
        out[lo : lo + 8192] = np.where(offsets < size, rows, 0)
    return out


def context_ids(rows: np.ndarray, anchor: np.ndarray, size: np.ndarray) -> np.ndarray:
    h = anchor + size.astype(_U)
    with np.errstate(over="ignore"):
        for word in np.ascontiguousarray(rows).view("<u8").T:
            h = mix((h ^ word) * _M1 + _M2)
    return h


def _screened(hashes: np.ndarray) -> np.ndarray:
    return hashes >> _U(64 - B.SCREEN_BITS)


_LONG, _BYTES = pa.int64(), pa.binary()
#: Arrays travel as binary cells, one per block and bin.
FORMS = {"bin": _LONG, "block": _LONG, "anchor": _BYTES, "form": _BYTES, "left": _BYTES, "right": _BYTES, "least": _BYTES, "more": _BYTES}
#: ``ask``: the form's bytes are wanted; ``count`` smallest ids per form, one if all its windows have the same.
FOUND = {"block": _LONG, "ask": pa.bool_(), "anchor": _BYTES, "form": _BYTES, "count": _BYTES, "least": _BYTES}
TEXTS = {"bin": _LONG, "block": _LONG, "anchor": _BYTES, "form": _BYTES, "side": _BYTES, "size": _BYTES, "least": _BYTES, "bytes": _BYTES}


def _ddl(schema: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{k} {({_LONG: 'long', _BYTES: 'binary'}.get(t, 'boolean'))}" for k, t in schema.items())


def _bins_of(anchor: np.ndarray, bins: int) -> list[tuple[int, int, int]]:
    """(bin, from, to) of sorted anchors."""
    cuts = np.searchsorted(((anchor >> _U(32)) * _U(bins)) >> _U(32), np.arange(bins + 1, dtype=_U))
    return [(i, x, y) for i, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if y > x]


def _cells(values: np.ndarray, parts: list[tuple[int, int, int]]) -> pa.Array:
    return pa.array([values[x:y].tobytes() for _, x, y in parts], _BYTES)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Marks the first of each run of equal rows."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _nothing(schema: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({k: pa.array([], t) for k, t in schema.items()})


_ENTRIES = {"bin": _LONG, "block": _LONG, "hashes": _BYTES, "again": _BYTES}


def _send_anchors(bins: int):
    def send(docs: pa.Table) -> pa.Table:
        data, bounds = text_bytes(docs["text"])
        place, h, _, _ = anchors(data, bounds)
        if not len(h):
            return _nothing(_ENTRIES)
        doc = np.unique(docs["_id"].to_numpy(), return_inverse=True)[1][np.searchsorted(bounds, place, "right") - 1]
        h = _screened(h)
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        starts = np.flatnonzero(_starts(h))
        again = doc[starts] != doc[np.append(starts[1:], len(h)) - 1]
        return B.entries(docs["block"][0].as_py(), h[starts], again, bins)

    return send


def _sides(rows: np.ndarray, side: np.ndarray, size: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-bit hashes of the anchor with ``SIDE`` bytes to its left and to its right; 0 where there are fewer."""
    reach = np.arange(16)
    left = np.take_along_axis(rows, np.maximum(side[:, None] - 1 - reach, 0), 1) * (reach < SIDE)
    right = np.take_along_axis(rows, np.minimum(side[:, None] + ANCHOR + reach, WIDTH - 1), 1) * (reach < SIDE)
    out = []
    for part, enough in ((left, side >= SIDE), (right, size - side - ANCHOR >= SIDE)):
        key = h.copy()
        with np.errstate(over="ignore"):
            for word in np.ascontiguousarray(part.astype(np.uint8)).view("<u8").T:
                key = mix((key ^ word) * _M1 + _M2)
        out.append(np.where(enough, (key >> _U(48)) | _U(1), _U(0)).astype(np.uint16))
    return out[0], out[1]


def _forms_in(docs: pa.Table, wanted) -> tuple:
    """The anchors of a block that ``wanted`` (hashes -> marks) picks: data, bounds, ids, hash, first, last, side, context rows, sizes, forms."""
    data, bounds = text_bytes(docs["text"])
    place, h, first, last = anchors(data, bounds)
    keep = wanted(h)
    place, h, first, last = (x[keep] for x in (place, h, first, last))
    doc = docs["_id"].to_numpy()[np.searchsorted(bounds, place, "right") - 1]
    size = last + MIN_BYTES - first
    rows = contexts(data, first, last)
    return data, bounds, doc, h, first, last, place - first, rows, size, context_ids(rows, h, size)


def _send_forms(bins: int):
    def send(docs: pa.Table, notes: pa.Table) -> pa.Table:
        shared = B.gathered(iter(notes["hashes"].to_pylist())) if docs.num_rows else ()
        if not len(shared):
            return _nothing(FORMS)
        _, _, doc, h, _, _, side, rows, size, form = _forms_in(docs, lambda h: B.held(_screened(h), shared))
        if not len(h):
            return _nothing(FORMS)
        order = np.lexsort((doc, form, h))
        starts = np.flatnonzero(_starts(h[order], form[order]))
        stops = np.append(starts[1:], len(h))
        one = order[starts]
        more = (doc[one] != doc[order[stops - 1]]).astype(np.uint8)
        left, right = _sides(rows[one], side[one], size[one], h[one])
        parts = _bins_of(h[one], bins)
        return pa.table({"bin": pa.array([i for i, _, _ in parts], _LONG), "block": pa.array([docs["block"][0].as_py()] * len(parts), _LONG),
                         "anchor": pa.array([B.pack(h[one][x:y]) for _, x, y in parts], _BYTES),
                         **{k: _cells(v, parts) for k, v in (("form", form[one]), ("left", left), ("right", right), ("least", doc[one]), ("more", more))}})

    return send


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _alike(key: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Which rows have a (non-zero) key that another row has with the same anchor."""
    out = np.zeros(len(key), bool)
    enough = np.flatnonzero(key)
    with np.errstate(over="ignore"):
        both = mix(anchor[enough] * _M1 + key[enough].astype(_U))
    _, inverse, n = np.unique(both, return_inverse=True, return_counts=True)
    out[enough] = n[inverse] > 1
    return out


def _settle(table: pa.Table) -> pa.Table:
    """One bin: the smallest id of each form that shares windows only as a whole; the other forms are asked for."""
    cells = [B.unpack(x) for x in table["anchor"].to_pylist()]
    anchor, form, least = np.concatenate(cells), _column(table, "form", _U), _column(table, "least", np.int64)
    left, right, more = _column(table, "left", np.uint16), _column(table, "right", np.uint16), _column(table, "more", np.uint8)
    order = np.lexsort((least, form, anchor))
    new = _starts(anchor[order], form[order])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1  # form number by row
    one = order[new]  # the row of each form with its smallest id
    _, inverse, n = np.unique(anchor[one], return_inverse=True, return_counts=True)
    several = np.flatnonzero(n[inverse] > 1)
    ask = np.zeros(len(one), bool)
    a = anchor[one[several]]
    ask[several] = _alike(left[one[several]], a) | _alike(right[one[several]], a ^ _M2)
    lowest = least[one][which]
    ask = ask[which]
    useful = ~ask & ((lowest < least) | (more > 0))
    out: dict[str, list] = {k: [] for k in FOUND}
    lo = 0
    for block, c in zip(table["block"].to_pylist(), map(len, cells)):
        for asked, marks in ((False, useful), (True, ask)):
            rows = np.flatnonzero(marks[lo : lo + c]) + lo
            if len(rows):
                values = (block, asked, B.pack(anchor[rows]), form[rows].tobytes(), np.ones(len(rows), np.uint8).tobytes(), lowest[rows].tobytes())
                for k, v in zip(FOUND, values):
                    out[k].append(v)
        lo += c
    return pa.table({k: pa.array(v, FOUND[k]) for k, v in out.items()})


def _told(found: pa.Table) -> tuple[np.ndarray, ...]:
    """(sorted anchors, sorted forms, count, first value by form, values) of what bins told a block."""
    anchor = np.sort(np.concatenate([B.unpack(x) for x in found["anchor"].to_pylist()])) if found.num_rows else np.zeros(0, _U)
    form, count = _column(found, "form", _U), _column(found, "count", np.uint8).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(count)])[:-1]
    order = np.argsort(form)
    return anchor, form[order], count[order], begin[order], _column(found, "least", np.int64)


def _send_texts(bins: int):
    def send(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows or not found.num_rows:
            return _nothing(TEXTS)
        anchor, told, _, begin, least = _told(found)
        _, _, _, h, _, _, side, rows, size, form = _forms_in(docs, lambda h: B.held(h, anchor))
        order = np.lexsort((form, h))
        order = order[_starts(h[order], form[order]) & B.held(form[order], told)]
        h, form, rows, side, size = h[order], form[order], rows[order], side[order].astype(np.uint8), size[order].astype(np.uint8)
        least = least[begin[np.searchsorted(told, form)]]
        parts = _bins_of(h, bins)
        inside = np.arange(WIDTH) < size[:, None]
        return pa.table({"bin": pa.array([i for i, _, _ in parts], _LONG), "block": pa.array([docs["block"][0].as_py()] * len(parts), _LONG),
                         "anchor": pa.array([B.pack(h[x:y]) for _, x, y in parts], _BYTES),
                         **{k: _cells(v, parts) for k, v in (("form", form), ("side", side), ("size", size), ("least", least))},
                         "bytes": pa.array([rows[x:y][inside[x:y]].tobytes() for _, x, y in parts], _BYTES)})

    return send


def _runs(anchor: np.ndarray, sides: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of ``sides`` (rows of bytes that lead away from equal anchors): every row's rank, and the bytes that it has in common with the one before.

    One suffix array over all rows of all sides, as 8-byte symbols behind a symbol for side and anchor.
    """
    n, width = len(anchor), sides[0].shape[1] // 8
    names = np.unique(anchor, return_inverse=True)[1]
    words = np.unique(np.concatenate([np.ascontiguousarray(s).view(">u8").astype(_U) for s in sides]), return_inverse=True)[1].reshape(-1, width)
    heads = np.concatenate([names + k * n for k in range(len(sides))])  # symbols of their own, before all others
    text = np.concatenate([heads[:, None], words + len(sides) * n], axis=1).ravel()
    order = suffix_array(text)
    order = order[order % (width + 1) == 0] // (width + 1)
    out = []
    for k, side in enumerate(sides):
        mine = order[order // n == k] - k * n
        rows, heads = side[mine], names[mine]
        differ = rows[1:] != rows[:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        common = np.concatenate([[-1], np.where(heads[1:] == heads[:-1], common, -1)])
        rank = np.empty(n, np.int64)
        rank[mine] = np.arange(n)
        out.append((rank, common))
    return out


def window_minima(anchor: np.ndarray, rows: np.ndarray, side: np.ndarray, size: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For contexts (padded rows): the smallest ``least`` over all equal windows, flat by context and window, and each context's first window."""
    reach = np.arange(32)
    after = side + ANCHOR
    right = np.where(reach < (size - after)[:, None], np.take_along_axis(rows, np.minimum(after[:, None] + reach, WIDTH - 1), 1), 0).astype(np.uint8)
    left = np.where(reach < side[:, None], np.take_along_axis(rows, np.maximum(side[:, None] - 1 - reach, 0), 1), 0).astype(np.uint8)
    (rank_l, common_l), (rank_r, common_r) = _runs(anchor, [left, right])
    begin = np.concatenate([[0], np.cumsum(size - MIN_BYTES + 1)])
    out = np.zeros(begin[-1], np.int64)
    for j in range(PLACES):
        which = np.flatnonzero((side >= j) & (size - after >= PLACES - 1 - j))
        run_l, run_r = np.cumsum(common_l < j)[rank_l[which]], np.cumsum(common_r < PLACES - 1 - j)[rank_r[which]]
        if not len(which):
            continue
        _, same = np.unique(run_l * (len(rows) + 1) + run_r, return_inverse=True)
        lowest = np.full(same.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(lowest, same, least[which])
        out[begin[which] + side[which] - j] = lowest[same]
    return out, begin


def _match(table: pa.Table) -> pa.Table:
    """One bin: the smallest id of every window of the forms that were asked for, to each block that holds them."""
    cells = [B.unpack(x) for x in table["anchor"].to_pylist()]
    form, size, least = _column(table, "form", _U), _column(table, "size", np.uint8).astype(np.int64), _column(table, "least", np.int64)
    flat = _column(table, "bytes", np.uint8)
    _, one, which = np.unique(form, return_index=True, return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(size)])[:-1][one]
    n = size[one]
    rows = np.where(np.arange(WIDTH) < n[:, None], flat[np.minimum(starts[:, None] + np.arange(WIDTH), len(flat) - 1)], 0).astype(np.uint8)
    side = _column(table, "side", np.uint8).astype(np.int64)[one]
    minima, begin = window_minima(np.concatenate(cells)[one], rows, side, n, least[one])
    lowest, highest = np.minimum.reduceat(minima, begin[:-1]), np.maximum.reduceat(minima, begin[:-1])
    count = np.where(lowest == highest, 1, np.diff(begin))
    values = [minima[x : x + c] for x, c in zip(begin[:-1].tolist(), count.tolist())]
    out: dict[str, list] = {k: [] for k in FOUND}
    lo = 0
    for block, cell in zip(table["block"].to_pylist(), cells):
        mine = which[lo : lo + len(cell)]
        told = (block, False, B.pack(cell), form[lo : lo + len(cell)].tobytes(), count[mine].astype(np.uint8).tobytes(),
                np.concatenate([values[i] for i in mine.tolist()]).tobytes())
        for k, v in zip(FOUND, told):
            out[k].append(v)
        lo += len(cell)
    return pa.table({k: pa.array(v, FOUND[k]) for k, v in out.items()})


RESULT = "_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"


def _remove(docs: pa.Table, found: pa.Table) -> pa.Table:
    """One block: mark the bytes of all windows that a smaller id holds, and cut them out."""
    data, bounds = text_bytes(docs["text"])
    ids = docs["_id"].to_numpy()
    edges = np.zeros(len(data) + 1, np.int32)
    if docs.num_rows and found.num_rows:
        anchor, told, count, begin, least = _told(found)
        _, _, doc, _, first, last, _, _, _, form = _forms_in(docs, lambda h: B.held(h, anchor))
        keep = B.held(form, told)
        doc, first, last, at = doc[keep], first[keep], last[keep], np.searchsorted(told, form[keep])
        whole = (count[at] == 1) & (least[begin[at]] < doc)
        np.add.at(edges, first[whole], 1)
        np.subtract.at(edges, last[whole] + MIN_BYTES, 1)
        parts = np.flatnonzero(count[at] > 1)
        if len(parts):
            n = count[at[parts]]
            row = np.repeat(parts, n)
            step = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n)
            hit = least[begin[at[row]] + step] < doc[row]
            np.add.at(edges, (first[row] + step)[hit], 1)
            np.subtract.at(edges, (first[row] + step)[hit] + MIN_BYTES, 1)
    gone = np.cumsum(edges[:-1], dtype=np.int32) > 0
    raw = data.tobytes()
    spans, kept = [], []
    for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        part = gone[x:y]
        if not part.any():
            spans.append([])
            kept.append(raw[x:y])
            continue
        turn = np.flatnonzero(np.diff(np.concatenate([[False], part, [False]])))
        spans.append([{"start": s, "stop": e} for s, e in zip(turn[::2].tolist(), turn[1::2].tolist())])
        kept.append(data[x:y][~part].tobytes())
    return pa.table({"_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(np.diff(bounds), pa.int64()),
                     "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), "kept": pa.array(kept, pa.binary())})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every document: the removed runs of bytes and the bytes that are left."""
    bounded_batches(docs.sparkSession)
    rows = docs.count()
    n = B.block_count(rows)
    dealt = B.with_block(docs.select(internal_id().alias("_id"), F.col("text").cast("string").alias("text")), n)
    shared = B.shared_hashes(dealt.groupBy("block").applyInArrow(_send_anchors(n), B.ENTRY_SCHEMA))
    forms = dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_send_forms(n), _ddl(FORMS))
    settled = forms.groupBy("bin").applyInArrow(_settle, _ddl(FOUND))
    texts = dealt.groupBy("block").cogroup(settled.where("ask").groupBy("block")).applyInArrow(_send_texts(n), _ddl(TEXTS))
    matched = texts.groupBy("bin").applyInArrow(_match, _ddl(FOUND))
    found = settled.where("NOT ask").unionByName(matched)
    cut = dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_remove, RESULT)
    return cut.select(external_id("_id").alias("doc_id"), "n_bytes", "spans", "kept")


def repeat_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` from the operator's spans and bytes."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

"""Periodic run detection over words, and texts with the repeated periods of runs left out.

A run is a stretch of words with smallest period q and a length of at least ``max(6, 4 q)`` that no neighbouring word extends.  The work
is done by internal pattern matching (``internal_matching``).  Documents travel once, from the scan to a Python worker, and are
never shuffled.  A worker joins the documents of a batch, up to ``PIECE_WORDS`` words, with separators that occur once, so
nothing matches across documents.  A document that is longer by itself is one piece; it takes about 150 bytes of memory a word.

Defined results: null and blank texts have no words and no runs; a null id stays null (and is never planted); repeated rows and ties
give equal rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import WS_RUN, bounded_batches, release
from glossa.llm.internal_matching import runs

#: Words of documents that are searched together.
PIECE_WORDS = 1 << 17

RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, collapsed binary"


def without_repeats(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    step = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:n]) == 0


def _search(texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(number of words, runs, collapsed text) of every text."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    parts, sizes = [], []
    for text in texts:
        words = text.split()  # at 09-0D and 20, as bytes do
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        sizes.append(len(words))
    fresh = len(numbers)
    del numbers
    joined = np.concatenate([x for i, p in enumerate(parts) for x in (p, np.array([fresh + i], np.int64))]) if parts else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs(joined, max(sizes, default=0)):
        doc = int(np.searchsorted(bounds, start, "right")) - 1
        found[doc].append((start - int(bounds[doc]), length, period))
    for text, n, mine in zip(texts, sizes, found):
        words = text.split()
        if mine:
            keep = without_repeats(n, mine)
            words = [w for w, k in zip(words, keep.tolist()) if k]
        yield n, mine, b" ".join(words)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.binary())])

    def piece(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        rows = list(_search(texts))
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
                                pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r[1]] for r in rows], schema.field("runs").type),
                                pa.array([r[2] for r in rows], pa.binary())], schema=schema)

    for b in batches:
        ids, texts, words = [], [], 0
        for i, value in zip(b["doc_id"], b["text"]):
            text = value.as_py() or b""
            about = len(text) // 6 + 1
            if texts and words + about > PIECE_WORDS:
                yield piece(ids, texts)
                ids, texts, words = [], [], 0
            ids.append(i.as_py())
            texts.append(text)
            words += about
        if texts:
            yield piece(ids, texts)
    release()


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: the runs of every text by start and period, and its kept words joined by one blank."""
    bounded_batches(docs.sparkSession)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(_find, SCHEMA)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def plant_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where a tenth of the documents, by a hash of the id, end in a planted run.

    With ``h = crc32(decimal doc_id)`` and ``g = floor(h / 10)``: if ``h % 10 = 0``, the n words from ``a = g % n`` on are the p words there, repeated,
    with ``p = 1 + floor((n - a) / (3 + g % 8))``.  Null ids and texts without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(chosen, F.filter(F.split("text", WS_RUN), lambda w: w != ""))
    cut = docs.select(F.col("doc_id"), F.col("text"), F.floor(h / 10).alias("g"), words.alias("w"))
    n = F.size("w")
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice("w", a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice("w", F.lit(1), a), again), F.lit(1), n), " ")
    return cut.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def strongest(runs: str | Column = "runs") -> Column:
    """The run of the greatest length per period; of equals the first by start, then period.  Null without runs."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def run_digest(docs: DataFrame) -> DataFrame:
    """Per document: number of runs, the strongest run, and digests of all runs and of the collapsed text."""
    found = find_runs(docs)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", strongest())
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))

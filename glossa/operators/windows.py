"""Corpus order: global row numbers and offsets, split, windows, batches.

Spark has no implicit row order, so every ordered operation names its key.
A global ordinal is never computed with an un-partitioned window (that would
pull every row into one task).  Instead rows are range-partitioned on the key,
each partition numbers (or sums) its own rows in order, and a table with one
row per partition - bounded by the partition count - turns those into global
values through a broadcast join.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa.functions.text import explode_rows, span, uniform_from_key
from glossa.operators.lookup import materialise


def _ranged(df: DataFrame, order: list[str], partitions: int | None) -> DataFrame:
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn("_pid", F.spark_partition_id()))


def _partition_offsets(ranged: DataFrame, total: str) -> DataFrame:
    """Exclusive running total of ``total`` over partition ids (one row per partition)."""
    per = ranged.groupBy("_pid").agg(F.sum(total).alias("_tot"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(per.select("_pid", F.coalesce(F.sum("_tot").over(w), F.lit(0)).alias("_off")))


def global_row_number(df: DataFrame, order: list[str], out: str = "row_no",
                      partitions: int | None = None) -> DataFrame:
    """0-based ordinal of each row in ``order`` (which must be a total order).

    The range-partitioned, locally numbered rows are written once (reliable
    checkpoint) before the per-partition counts are taken, so the counts and
    the rows they offset come from the same partitioning even if a stage is
    recomputed after an executor loss (range bounds come from sampling).
    """
    r = _ranged(df, order, partitions)
    r = r.withColumn("_idx", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    r = materialise(r)
    offs = _partition_offsets(r.withColumn("_one", F.lit(1)), "_one")
    return r.join(offs, "_pid").withColumn(out, (F.col("_off") + F.col("_idx")).cast("bigint")) \
        .drop("_pid", "_idx", "_off")


def global_exclusive_sum(df: DataFrame, order: list[str], value: str, out: str = "offset",
                         partitions: int | None = None) -> DataFrame:
    """Sum of ``value`` over all rows strictly before each row in ``order``.

    Inside a partition the running sum is a pandas ``cumsum`` over the
    partition's Arrow batches (the partition is already sorted); the result
    is written once, then partition totals become offsets through a bounded
    broadcast (one row per partition).
    """
    r = _ranged(df, order, partitions)
    whole = not isinstance(r.schema[value].dataType, (T.DoubleType, T.FloatType))
    kind, numbers = ("bigint", "int64") if whole else ("double", "float64")
    schema = T.StructType(r.schema.fields + [T.StructField("_local", T.LongType() if whole else T.DoubleType())])

    def local_cumsum(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = 0
        for b in batches:
            v = b[value].fillna(0).astype(numbers)
            b = b.assign(_local=(v.cumsum().shift(fill_value=0) + carry).astype(numbers))
            carry += v.sum()
            yield b

    local = materialise(r.mapInPandas(local_cumsum, schema))
    offs = _partition_offsets(local, value)
    return (local.join(offs, "_pid").withColumn(out, (F.col("_off") + F.col("_local")).cast(kind))
            .drop("_pid", "_local", "_off"))


def doc_offsets(wide: DataFrame, toks: str = "toks", order: str = "doc_id") -> DataFrame:
    """One row per document: ``(doc_id, n_tokens, offset)`` in document order."""
    per_doc = wide.select(order, F.size(toks).cast("bigint").alias("n_tokens"))
    return global_exclusive_sum(per_doc, [order], "n_tokens", "offset")


def global_position(wide: DataFrame, toks: str = "toks", order: str = "doc_id") -> DataFrame:
    """Long ``(doc_id, pos, token, global_pos)``: index of each token in the ordered corpus stream."""
    offs = doc_offsets(wide, toks, order).select(order, "offset")
    return (explode_rows(wide.join(offs, order), toks, (order, "offset"), "token", "pos")
            .select(order, F.col("pos").cast("int").alias("pos"), "token",
                    (F.col("offset") + F.col("pos")).alias("global_pos")))


def split_point(wide: DataFrame, ratio: float = 0.9, toks: str = "toks", order: str = "doc_id"):
    """The first validation token: ``(n_total, cut_doc, cut_pos)``; ``int(ratio * N)`` tokens are train.

    Only one row (the document that contains the cut) reaches the driver.
    """
    offs = doc_offsets(wide, toks, order)
    tot = offs.agg(F.sum("n_tokens").cast("bigint").alias("n")).first()["n"] or 0
    cut = int(ratio * tot)
    row = (offs.filter((F.col("offset") <= cut) & (F.col("offset") + F.col("n_tokens") > cut))
           .orderBy(order).select(order, "offset").first())
    if row is None:  # every token is train (cut == N)
        return tot, None, None
    return tot, row[order], cut - row["offset"]


def split_label(doc: str, pos: str, cut_doc, cut_pos):
    """Column 'train' / 'val' from the cut found by ``split_point``."""
    if cut_doc is None:
        return F.lit("train")
    before = (F.col(doc) < F.lit(cut_doc)) | ((F.col(doc) == F.lit(cut_doc)) & (F.col(pos) < F.lit(cut_pos)))
    return F.when(before, F.lit("train")).otherwise(F.lit("val"))


def train_val_split(wide: DataFrame, ratio: float = 0.9, toks: str = "toks", order: str = "doc_id") -> DataFrame:
    """Wide table cut into ``(split, doc_id, toks)`` rows; the crossing document gives two rows.

    The split happens before any windowing, so no window crosses it.
    """
    _, cut_doc, cut_pos = split_point(wide, ratio, toks, order)
    a = F.col(toks)
    if cut_doc is None:
        return wide.select(F.lit("train").alias("split"), order, a.alias(toks))
    d = F.col(order)
    head = F.when(d < cut_doc, a).when(d == cut_doc, F.slice(a, 1, F.lit(cut_pos)) if cut_pos > 0
                                       else F.array().cast(wide.schema[toks].dataType))
    tail = F.when(d > cut_doc, a).when(d == cut_doc, F.slice(a, cut_pos + 1, F.size(a)))
    parts = F.array(F.struct(F.lit("train").alias("split"), F.lit(0).alias("start"), head.alias("t")),
                    F.struct(F.lit("val").alias("split"),
                              F.when(d == cut_doc, F.lit(cut_pos)).otherwise(F.lit(0)).alias("start"),
                              tail.alias("t")))
    return (explode_rows(wide, parts, (order,), "p")
            .filter(F.col("p.t").isNotNull())
            .select("p.split", order, F.col("p.start").alias("start_pos"), F.col("p.t").alias(toks)))


#: Windows of a block, or as many as a window has tokens, if more: a row is cut into blocks first.
BLOCK_WINDOWS = 32


def window_starts(wide: DataFrame, length: int, stride: int = 1, toks: str = "ids",
                  keep: tuple[str, ...] = ("doc_id",), size: str | None = None) -> DataFrame:
    """``(keep, start)`` of the windows, without their tokens.  ``size``: a column with the number of tokens, for rows that haven't the tokens themselves."""
    n = F.col(size) if size else F.size(toks)
    starts = F.when(n > length, F.sequence(F.lit(0), n - length - 1, F.lit(stride)))
    return (explode_rows(wide, F.coalesce(starts, F.array().cast("array<int>")), keep, "start", "_w")
            .select(*keep, F.col("start").cast("int").alias("start")))


def windows(wide: DataFrame, length: int, stride: int = 1, toks: str = "ids", shift: bool = True,
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Sliding windows inside each row: ``(keep, start, x, y)``.

    ``shift`` (language model): y is x moved one token left, N - L samples.
    Without it (tagger): ``y`` is taken from a parallel ``labels`` array, also N - L samples.
    Rows with N <= L give nothing.  The windows are cut inside the row, no self-join.
    A row is first cut into blocks, each of which is read once (``span``).  Windows are slices of their block and made one
    by one in compiled code, not in a lambda, which would read the whole block for each slice: so a window costs as much in a long row as in a short one.
    """
    n = F.size(toks)
    reach = max(BLOCK_WINDOWS, length) * stride
    firsts = F.when(n > length, F.sequence(F.lit(0), n - length - 1, F.lit(reach))) \
        .otherwise(F.array().cast("array<int>"))
    cut = lambda c, s: span(c, s, F.least(F.lit(reach + length), n - s))
    block = lambda s: F.struct(s.alias("first"), cut(toks, s).alias("t"), *([] if shift else [cut("labels", s).alias("l")]))
    blocks = explode_rows(wide, F.transform(firsts, block), keep, "b")
    starts = F.sequence(F.lit(0), F.least(F.size("b.t") - length - 1, F.lit(reach - stride)), F.lit(stride))
    at = explode_rows(blocks, starts, (*keep, "b"), "_s")
    x = F.slice("b.t", F.col("_s") + 1, F.lit(length))
    y = F.slice("b.t", F.col("_s") + 2, F.lit(length)) if shift else F.slice("b.l", F.col("_s") + 1, F.lit(length))
    return at.select(*keep, (F.col("b.first") + F.col("_s")).cast("int").alias("start"), x.alias("x"), y.alias("y"))


#: Hex digits of a hash that name a range of the shuffled order; more once a range would hold more than ``RANGE_ROWS`` rows.
RANGE_DIGITS = (4, 6)
RANGE_ROWS = 2_000_000


def _range_counts(samples: DataFrame, range_of: Column) -> DataFrame:
    return samples.groupBy(range_of.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))


def _numbered_by_ranges(samples: DataFrame, range_of: Column, counts: DataFrame, order: list[str], out: str, few: bool) -> DataFrame:
    """0-based ordinal in ``order``, for rows whose ranges (``range_of``, in order) are fixed beforehand and counted (``counts``).

    A count of each range gives its first number; a row's number is that and its place in the range.  Only the counts are written, the
    rows are shuffled once, by range, and a recomputed task gets the same rows again, as no bound comes from sampling.
    The first numbers are joined when the rows have been numbered, so they aren't shuffled and sorted with them.
    """
    first = global_exclusive_sum(counts, ["_range"], "_n", "_first").select("_range", "_first")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    s = samples.withColumn("_range", range_of).withColumn("_place", place)
    return (s.join(F.broadcast(first) if few else first, "_range")
            .withColumn(out, (F.col("_first") + F.col("_place") - 1).cast("bigint")).drop("_range", "_first", "_place"))


def shuffled_batches(samples: DataFrame, batch_size: int, seed: int = 0,
                     key: tuple[str, ...] = ("doc_id", "start"), shuffle: bool = True) -> DataFrame:
    """Assign ``batch_id``: samples in a seeded md5 order (or key order), ``batch_size`` per batch.

    The last batch may be short.  The md5's first digits are ranges of nearly equal size, known without sampling; in key
    order the first key (the document) is the range.  The md5 is taken as its 16 bytes, which sort as the digits do.
    ``samples`` are gone through twice, to count the ranges and to number them, so they should be cheap to make.
    """
    if shuffle:
        s = samples.withColumn("_u", F.unhex(F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))))
        for digits in RANGE_DIGITS:
            range_of = F.conv(F.hex(F.substring("_u", 1, digits // 2)), 16, 10).cast("int")
            counts = materialise(_range_counts(s, range_of))
            if (counts.agg(F.sum("_n")).first()[0] or 0) <= RANGE_ROWS * 16 ** digits:
                break
        numbered = _numbered_by_ranges(s, range_of, counts, ["_u", *key], "sample_no", digits == RANGE_DIGITS[0]).drop("_u")
    else:
        range_of = F.col(key[0])
        numbered = _numbered_by_ranges(samples, range_of, _range_counts(samples, range_of), list(key), "sample_no", False)
    return numbered.withColumn("batch_id", F.floor(F.col("sample_no") / batch_size).cast("bigint"))


def context_chunks(wide: DataFrame, length: int, toks: str = "toks", keep: tuple[str, ...] = ("doc_id",), labels: str | None = None) -> DataFrame:
    """Consecutive non-overlapping chunks of ``length`` tokens; the last may be shorter.  ``labels``: a parallel array that is cut alike."""
    a = F.col(toks)
    n = F.size(a)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(length))).otherwise(F.array().cast("array<int>"))
    more = [labels] if labels else []
    chunk = lambda s: F.struct(s.alias("start"), F.slice(a, s + 1, F.lit(length)).alias("chunk"),
                               *[F.slice(c, s + 1, F.lit(length)).alias(c) for c in more])
    return (explode_rows(wide, F.transform(starts, chunk), keep, "c", "chunk_id")
            .select(*keep, F.col("chunk_id").cast("int").alias("chunk_id"),
                    F.col("c.start").cast("int").alias("start"), "c.chunk", *[f"c.{m}" for m in more]))


__all__ = [
    "global_row_number", "global_exclusive_sum", "doc_offsets", "global_position", "split_point",
    "split_label", "train_val_split", "window_starts", "windows", "shuffled_batches", "context_chunks", "uniform_from_key",
]

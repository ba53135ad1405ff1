"""Helpers shared by the corpus operators: staged tables, size-checked broadcast, id sentinels."""

from __future__ import annotations

import ctypes
import gc
import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.session import ensure_checkpoint_dir, read_table, workers_find_package

#: Stands in for a null id inside an operator, so that null ids join, group and sort last; turned back on output.
NULL_ID = 9223372036854775807

#: Rows that a size-checked broadcast may hold (two bigints a row: under 50 MB).
BROADCAST_ROWS = 1_000_000

WS_RUN = r"[\x20\x09-\x0D]+"

Queries = dict[str, Callable[[SparkSession, str], DataFrame]]


#: Rows of small tables that go to one file of a staged table.
FILE_ROWS = 65_536


def staged(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back: lineage ends here.

    ``rows``: about how many (small) rows to expect; they then go to files of ``FILE_ROWS`` instead of one per task.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, math.ceil(rows / FILE_ROWS)))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    if _scratch:
        _scratch[-1].append(table)
    return table


def discard(table: DataFrame) -> None:
    """Delete the files of a ``staged`` table that nothing reads any more; whatever was made from it has been written."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.staged_at)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: What the ``scratch`` blocks under way have staged, the innermost last.
_scratch: list[list[DataFrame]] = []


@contextmanager
def scratch(kept: list[DataFrame]) -> Iterator[None]:
    """Tables staged within, apart from those put into ``kept``, are deleted at the end: their results have been written."""
    _scratch.append([])
    try:
        yield
    finally:
        made = _scratch.pop()
    for table in made:
        if not any(table is k for k in kept):
            discard(table)


#: Bytes of texts that go to a Python worker at once.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's bound on Arrow batches to ``BATCH_BYTES``: ten thousand long texts make one large batch otherwise."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(key)).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def release() -> None:
    """Give memory that a task has freed back to the system: a worker process lives on and serves other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no glibc
        pass


def internal_id(col: str | Column = "doc_id") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(NULL_ID)).cast("long")


def external_id(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(c, F.lit(NULL_ID))


def if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint when ``df`` (staged before, so that counting is cheap) has few enough rows; else ``df`` as it is."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def unused(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, dropped: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``docs`` without the rows whose ``keys`` (column of ``dropped``: expression over ``docs``) are in ``dropped``, a staged table: broadcast if few, else Spark shuffles.

    The columns of ``docs`` may have any names.
    """
    names = {k: unused(docs.columns, k) for k in keys}
    marked = docs.select("*", *[e.alias(names[k]) for k, e in keys.items()])
    other = dropped.select(*[F.col(k).alias(names[k]) for k in keys])
    return marked.join(if_small(other), list(names.values()), "left_anti").select(*[marked[c] for c in docs.columns])


def fold(modulus: int, col: str = "doc_id") -> Column:
    """``crc32(doc_id as text) mod modulus``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % modulus


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of the folder.  Workers find this package also where it isn't installed, if they see the same files."""
    workers_find_package(spark)
    return read_table(spark, sf_dir, name)


def most_frequent(counts: DataFrame, limit: int, n: str = "n") -> DataFrame:
    """The rows of the largest ``n``: as many whole classes of frequency (an eighth of a power of two wide) as fit in ``limit``.

    The driver gets one row per class, and every task filters by the bound found; no task sorts or keeps the top rows.
    """
    scale = F.floor(F.log2(F.col(n).cast("double")) * 8)
    classes = counts.groupBy(scale.alias("c")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("c")).collect()
    bound, total = None, 0
    for r in classes:
        total += r["rows"]
        if total > limit:
            break
        bound = r["c"]
    return counts.where(F.lit(False)) if bound is None else counts.where(scale >= bound)

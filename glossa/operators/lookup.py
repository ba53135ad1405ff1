"""Dimension lookups that stay safe when one key holds a large share of rows.

Token tables are heavily skewed (a handful of words make up a large part of
any corpus), so a lookup keyed by token must never send all rows of one key to
one task.  Two plans, chosen by a size check on the dimension side:

* the dimension is written once (``materialise``) and counted;
  if it has at most ``max_rows`` rows it is broadcast and the fact side is
  never shuffled;
* otherwise the fact side is spread by a salt derived from its row identity
  and the dimension is replicated once per salt value, so a hot key is split
  over ``buckets`` tasks; ``skew_join`` does so for hot keys only, in parts by
  their weight.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.session import ensure_checkpoint_dir

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_SALT_BUCKETS = 32


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes in here remove their shuffle files when they end: otherwise these stay until the driver collects its garbage, beside the tables written from them."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, path: str | None = None, more: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Cut lineage: ``df`` written once as Parquet at ``path`` (else in the session's shared checkpoint folder), and read from there.

    ``more``: frames of the same columns that are written to it one after the other, so that only one of them has its shuffle files at a time.  A checkpoint of the rows would be serialised Java objects, several times the size of these compressed columns.
    """
    path = path or f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
        for other in more:
            other.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_key(df: DataFrame, keys: list[str], out: str = "_key") -> DataFrame:
    """``df`` with a 64-bit hash of ``keys``, to go before them in a sort, join or grouping: rows are told apart by one number then, arrays and strings
    are compared where it is equal only.  The keys themselves stay part of the comparison, so a collision mixes nothing up."""
    return df.withColumn(out, F.xxhash64(*keys))


def bounded(dim: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """Materialise ``dim`` and report whether it fits the broadcast bound."""
    dim = materialise(dim)
    return dim, dim.count() <= max_rows


def salted_left_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                     spread: list[str], buckets: int = DEFAULT_SALT_BUCKETS,
                     salt_col: str = "_salt") -> DataFrame:
    """``facts LEFT JOIN dim ON fact_key = dim_key`` with the fact side salted by ``spread``."""
    f = facts.withColumn(salt_col, F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int"))
    d = dim.withColumn(salt_col, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    cond = (f[fact_key] == d[dim_key]) & (f[salt_col] == d[salt_col])
    return f.join(d, cond, "left").drop(d[salt_col]).drop(f[salt_col])


#: Shares that the facts of a ``skew_join`` are thought of as; a key with more than one share is split into as many parts.
SHARES = 4096
#: Dimension rows that a ``skew_join`` broadcasts instead.
BROADCAST_ROWS = DEFAULT_BROADCAST_ROWS // 8


def skew_join(facts: DataFrame, dim: DataFrame, keys: list[str], weight: str, spread: list[str], how: str = "left",
              max_rows: int = BROADCAST_ROWS, shares: int = SHARES) -> DataFrame:
    """``facts JOIN dim USING keys`` in one pass over ``facts``, for a ``dim`` with unique keys whose ``weight`` is (about) the number of facts of each.

    A small ``dim`` (counted) is broadcast.  Otherwise a key that holds more than one of ``shares`` equal shares of the weight is hot.  There are fewer
    than ``shares`` such keys whatever the data, so their list is broadcast.  It marks the facts on their way to the one shuffle: those of a hot
    key go to as many parts as the key has shares, by a hash of the ``spread`` columns, and only the hot rows of ``dim`` are repeated, once for each part
    (fewer than twice ``shares`` copies altogether).  Facts with a null key match nothing and are spread as well.  ``how`` is ``left`` or ``inner``; ``dim`` should
    be written before, as it is counted.
    """
    n, total = dim.agg(F.count(F.lit(1)), F.sum(weight)).first()
    if n <= max_rows:
        return facts.join(F.broadcast(dim), keys, how)
    parts = F.ceil(F.col(weight) * F.lit(shares / max(total or 0, 1))).cast("int")
    hot = dim.where(parts > 1).select(*keys, parts.alias("_parts"))
    no_key = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1
    salt = F.when(F.col("_parts").isNotNull() | no_key, F.pmod(F.xxhash64(*spread), F.coalesce("_parts", F.lit(shares)))).otherwise(0).cast("int")
    marked = facts.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_parts")
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return with_key(marked, keys).join(with_key(copies, keys), ["_key", *keys, "_salt"], how).drop("_salt", "_key")


def hot_keys(sizes: DataFrame, keys: list[str], weight: str, shares: int = SHARES) -> DataFrame:
    """The ``keys`` that hold more than one of ``shares`` equal shares of the weight: fewer than ``shares``, whatever the data."""
    total = sizes.agg(F.sum(weight)).first()[0] or 0
    return sizes.where(F.col(weight) > F.lit(total / shares)).select(*keys)


#: Rows of a bucket, about.
BUCKET_ROWS = 1_000_000


def bucketed(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``df`` written as a bucketed and sorted table in the shared folder: joins on ``keys`` don't shuffle it again, however often they come.

    ``rows`` is about its number of rows; there are as many buckets as shuffle partitions, or more for large tables.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))
    name = f"glossa_{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        (df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).sortBy(*keys)
         .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    return spark.table(name)

"""Vector code compression: a codebook for each part of the vectors, learned by ball k-means in whole numbers.

A vector's components become ``floor(1024 x)``; vectors are cut into equal consecutive parts.  Each part position has its own codebook, which starts as that part
of the vectors with the smallest ids and is moved for ``ROUNDS`` rounds; a code names the nearest entry of each part.

A round is one pass over the written state (components and codes of the last round), ball by ball in batches:

* a part's *ball* is its entry of the last round; the members' greatest distance to the entry's new place is the ball's radius;
* *neighbour entries* are those closer than twice the radius: no other entry can be nearest to a member;
* members closer to their entry than half the way to its nearest neighbour are the *stable core*: they keep their entry, nothing is computed for them;
* the others lie in *annular rings* around the entry, between half the distances of one neighbour and the next.  A part in the l-th ring is compared with the first l
  neighbours and its own entry, exactly.

Radii are taken over a batch's members of a ball.  The rule holds for any set of members, so no pass is needed for radii alone.  The first round has no balls yet and compares
with all entries.  All sums and squares are whole numbers (as doubles only while they are under 2**53), so results don't depend on how rows are dealt.  A task adds up its
members by entry and writes one row of sums beside its state; Spark adds those up, and the driver gets a codebook: ``parts x entries x width`` numbers.  State tables are in the shared
folder; one is deleted when the next is complete.

Defined results: vectors that are null or hold null or non-finite components are left out, and so are vectors of another length than that of the smallest kept id; components that
don't fill equal parts (the last ``length mod parts``) are ignored; components beyond +-65,536 count as that; a null id sorts last and stays null; repeated rows get equal codes (both count,
and among equal ids the smaller vector comes first); fewer vectors than entries make a smaller codebook; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import bounded_batches, discard, release, staged
from glossa.operators.lookup import skew_join

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BOUND = 1 << 26
#: Vectors handled at once, and vectors that are compared with all entries at once.
BATCH_ROWS = 32_768
FULL_ROWS = 4096
#: Double arithmetic is exact for components under this size.
EXACT = 1 << 20

STATE = "vec_id long, label string, ints binary, codes binary, sums array<long>"
_STATE = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("ints", pa.binary()), ("codes", pa.binary()), ("sums", pa.list_(pa.int64()))])


def whole(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -BOUND, BOUND).astype(np.int64)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries, exact."""
    if not x.size or max(int(np.abs(x).max()), int(np.abs(entries).max())) < EXACT:
        x, entries = x.astype(np.float64), entries.astype(np.float64)
        return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], axis=1)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry; ties go to the lower index."""
    code, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for lo in range(0, len(x), FULL_ROWS):
        d = squared(x[lo : lo + FULL_ROWS], entries)
        at = d.argmin(axis=1)
        code[lo : lo + FULL_ROWS], error[lo : lo + FULL_ROWS] = at, d[np.arange(len(d)), at]
    return code, error


@dataclass
class Book:
    """The entries of one part position, and for each of them the others by distance."""
    entries: np.ndarray

    def __post_init__(self) -> None:
        k = len(self.entries)
        apart = squared(self.entries, self.entries).astype(np.int64)
        apart[np.arange(k), np.arange(k)] = -1  # first in the order, then taken off
        self.others = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.others, axis=1)

    def reassign(self, x: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(code, squared distance) of rows that were in the balls ``code``, and how many rows were in stable cores."""
        own = ((x - self.entries[code]) ** 2).sum(1)
        out, error, stable = code.copy(), own.copy(), 0
        order = np.argsort(code, kind="stable")
        balls, starts = np.unique(code[order], return_index=True)
        for ball, lo, hi in zip(balls.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)]):
            members = order[lo:hi]
            radius = int(own[members].max())
            neighbours = self.apart[ball][: np.searchsorted(self.apart[ball], 4 * radius, "right")]
            ring = np.searchsorted(neighbours, 4 * own[members], "right")
            stable += int((ring == 0).sum())
            band = 0
            while band < len(neighbours):  # rings in bands of doubling width, each compared with the neighbours up to its outer one
                outer = min(len(neighbours), max(8, 2 * band))
                mine = members[(ring > band) & (ring <= outer)]
                if len(mine):
                    near = np.sort(np.append(self.others[ball][:outer], ball))
                    at, d = nearest(x[mine], self.entries[near])
                    out[mine], error[mine] = near[at], d
                band = outer
        return out, error, stable


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), PARTS, width).astype(np.int64)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= BATCH_ROWS:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _assigned(table: pa.Table, books: list[Book], width: int, first: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(components, codes, squared distances) of a batch: against all entries in the first round, ball by ball later."""
    if first:
        x = whole(pa.concat_arrays([c.flatten() for c in table["embedding"].chunks]).to_numpy(zero_copy_only=False))
        n = table.num_rows
        x = np.ascontiguousarray(x.reshape(n, len(x) // n)[:, : PARTS * width]).reshape(n, PARTS, width)
        found = [nearest(x[:, p], books[p].entries) for p in range(PARTS)]
    else:
        x = _matrix(table["ints"], width)
        before = np.frombuffer(b"".join(table["codes"].to_pylist()), np.uint8).reshape(-1, PARTS).astype(np.int64)
        found = [books[p].reassign(x[:, p], before[:, p])[:2] for p in range(PARTS)]
    return x, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _rows_of(values: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in values]


def _round(entries: np.ndarray, first: bool):
    """A round's pass: rows with their new codes, and at the end of a task one row of its sums."""
    k, width = entries.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Book(e) for e in entries]
        sums = np.zeros((PARTS, k, width + 1), np.int64)
        for table in _grouped(batches):
            x, codes, _ = _assigned(table, books, width, first)
            for p in range(PARTS):
                order = np.argsort(codes[:, p], kind="stable")
                used, starts = np.unique(codes[order, p], return_index=True)
                sums[p, used, :width] += np.add.reduceat(x[order, p], starts, axis=0)
                sums[p, used, width] += np.diff(np.append(starts, len(order)))
            n = table.num_rows
            yield pa.record_batch([table["vec_id"].combine_chunks(), table["label"].combine_chunks(), pa.array(_rows_of(x.reshape(n, PARTS * width).astype(np.int32)), pa.binary()),
                                   pa.array(_rows_of(codes.astype(np.uint8)), pa.binary()), pa.nulls(n, pa.list_(pa.int64()))], schema=_STATE)
        if sums[:, :, width].any():
            yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                                   pa.array([sums.ravel()], pa.list_(pa.int64()))], schema=_STATE)
        release()

    return run


def _last(entries: np.ndarray, first: bool):
    """The last pass: codes and errors."""
    width = entries.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Book(e) for e in entries]
        for table in _grouped(batches):
            _, codes, error = _assigned(table, books, width, first)
            yield pa.record_batch([table["vec_id"].combine_chunks(), table["label"].combine_chunks(), pa.array(_rows_of(codes.astype(np.uint8)), pa.binary()),
                                   pa.array(error.sum(axis=1))], ["vec_id", "label", "codes", "error"])
        release()

    return run


def _moved(state: DataFrame, entries: np.ndarray) -> np.ndarray:
    """The codebooks after a round: each entry is the floor of its members' mean; entries without members stay."""
    k, width = entries.shape[1:]
    total = np.zeros(entries.shape[0] * k * (width + 1), np.int64)
    added = state.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    for r in added.collect():  # as many rows as the codebooks have numbers
        total[r["at"]] = r["value"]
    total = total.reshape(entries.shape[0], k, width + 1)
    count = total[:, :, width:]
    return np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), entries)


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding, label`` (as text) of the vectors without null and non-finite components."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label"))


def compress(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(``vec_id, label, codes, error`` of every kept vector, the codebooks as an array by part, entry and position)."""
    bounded_batches(vectors.sparkSession)
    kept = kept_vectors(vectors)
    by = (F.col("vec_id").asc_nulls_last(), "embedding")
    top = kept.orderBy(*by).limit(1).collect()
    size = len(top[0]["embedding"]) if top else 0
    kept = kept.where(F.size("embedding") == size)
    seeds = [r["embedding"] for r in kept.orderBy(*by).limit(entries).collect()]
    width = size // PARTS
    books = whole(np.array(seeds, np.float64).reshape(len(seeds), size)[:, : PARTS * width]).reshape(len(seeds), PARTS, width).transpose(1, 0, 2)
    if not top:
        return vectors.sparkSession.createDataFrame([], "vec_id long, label string, codes binary, error long"), books
    rows, state = kept, None
    for n in range(rounds):
        after = staged(rows.mapInArrow(_round(books, n == 0), STATE), "ball-state")
        if state is not None:
            discard(state)
        state, rows = after, after.where("sums IS NULL").drop("sums")
        books = _moved(state, books)
    out = staged(rows.mapInArrow(_last(books, state is None), "vec_id long, label string, codes binary, error long"), "ball-codes")
    if state is not None:
        discard(state)
    return out, books


def code_digest(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept vector."""
    codes, books = compress(vectors)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    keyed = codes.withColumn("of", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    totals = staged(keyed.groupBy("of").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "ball-labels", 1)
    return skew_join(keyed, totals, ["of"], "n", ["vec_id", "codes"]).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    steps = [f"""WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
t AS MATERIALIZED (SELECT vec_id, p, x[CAST(p * (len(x) // {PARTS}) + 1 AS BIGINT):CAST((p + 1) * (len(x) // {PARTS}) AS BIGINT)] AS y FROM v, range({PARTS}) r(p)),
b0 AS MATERIALIZED (SELECT t.p, f.i, t.y FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM v ORDER BY vec_id LIMIT {ENTRIES}) f JOIN t USING (vec_id))"""]
    near = """SELECT t.vec_id, t.p, min({{'d': CAST(list_sum(list_transform(list_zip(t.y, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 'i': b.i}}) AS m
  FROM t JOIN b{r} b USING (p) GROUP BY t.vec_id, t.p"""
    for r in range(ROUNDS):
        steps.append(f"a{r} AS MATERIALIZED ({near.format(r=r)})")
        steps.append(f"""s{r} AS (SELECT p, i, j, CAST(sum(c) AS BIGINT) AS s, count(*) AS n FROM (
  SELECT t.p, a.m.i AS i, unnest(range(1, len(t.y) + 1)) AS j, unnest(t.y) AS c FROM t JOIN a{r} a USING (vec_id, p)) GROUP BY p, i, j)""")
        steps.append(f"""b{r + 1} AS MATERIALIZED (SELECT b.p, b.i, coalesce(n.y, b.y) AS y FROM b{r} b LEFT JOIN (
  SELECT p, i, list((s - ((s % n) + n) % n) // n ORDER BY j) AS y FROM s{r} GROUP BY p, i) n USING (p, i))""")
    steps.append(f"f AS MATERIALIZED ({near.format(r=ROUNDS)})")
    steps.append("""o AS (SELECT vec_id, string_agg(printf('%02x', CAST(m.i AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM f GROUP BY vec_id)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, i)) FROM b{ROUNDS}) AS codebooks_sha256 FROM o JOIN v USING (vec_id)"""


ORACLE = _oracle()

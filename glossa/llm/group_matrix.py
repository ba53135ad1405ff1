"""N-gram Jaccard join with a token-group matrix.

Two documents are linked when their sets of five-word shingles satisfy ``100 * |A & B| >= 75 * |A | B|``; the result is the
components of the links.  Exact, up to the 64-bit hashes that stand for shingles and sets.

1. *Sets.*  Documents with equal sets are one node from here on, so groups of copies shrink to one set each.
2. *Screen.*  A linked set of n shingles has at most ``n - ceil(0.75 n)`` shingles that no other set holds.  Half of the
   shingles (by hash) are checked for being shared (``blocks.py``); sets with too many unshared ones among them can have no partner.
3. *Groups.*  The remaining sets are partitioned by the smallest of their re-hashed shingles, which similar sets mostly have
   in common; large partitions are cut into groups of bounded size.  Inside a group all pairs are
   compared.  A second such partition, and a pivot that all groups of one partition share, join most of what belongs together.
4. *Token-group matrix.*  The token unions of the groups are stored as (token, group) in token bins.  First the bins tell each set which of its
   shingles sets of another component hold; with fewer than ``ceil(0.75 n)`` of them it has no partner left to find.  The others look up their
   rarest shingles, as many as a partner can't miss all of, and get the groups that they could have a partner in.
   The set's overlap with such a group's union bounds its overlap with any member; only groups that reach the bound are opened and compared.
   Groups that are wholly in the set's own component needn't be opened, so a family of near copies isn't compared pair by pair.
5. Components over all links give the result.

Steps 3's partitions only save work: every pair from different components that could be linked is found by step 4.

Defined results: null or blank text has an empty set, no links and its own component; a null ``doc_id`` sorts after all
others and is returned as null; repeated rows have equal sets and so one component; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm import blocks as B
from glossa.llm.common import FILE_ROWS, bounded_batches, external_id, internal_id, release, staged
from glossa.llm.components import components
from glossa.llm.shingles import mix, shingle_sets, text_bytes

PERCENT = 75
#: Sets per group, and sets that one task compares with a group at once.
GROUP_SETS = 96
QUERY_SETS = 512
#: Shingles per token bin, on average.
BIN_TOKENS = 1_000_000

_U = np.uint64
#: The half of the hash range that the screen uses.
_HALF = _U(1 << 63)


def needed(n: int) -> int:
    """Shingles that a set of ``n`` must share with a partner."""
    return -(-PERCENT * n // 100)


def node_of(tokens: np.ndarray) -> int:
    """A set's identity: 63 bits of an order-free hash of its shingles."""
    with np.errstate(over="ignore"):
        total = np.array([mix(tokens ^ _U(0x5DEECE66D)).sum(dtype=_U) + _U(len(tokens))], _U)
    return int(mix(total)[0] >> _U(1))


def least_hashes(tokens: np.ndarray) -> list[int]:
    """The smallest re-hashed shingle under two hash functions."""
    return [int(mix(tokens ^ _U(seed)).min() >> _U(1)) for seed in (0x1F83D9AB, 0x9B05688C)]


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 512):
            b = whole.slice(lo, 512)
            sets = shingle_sets(*text_bytes(b["text"]))
            yield pa.record_batch([b["_id"], b["_text"], pa.array([len(s) for s in sets], pa.int64()),
                                   pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())], ["_id", "_text", "n", "node"])
            del sets
    release()


def _block_sets(docs: pa.Table, copies: pa.Table) -> dict[int, np.ndarray]:
    """The sets of a block by node, without those that another row stands for."""
    skip = set(zip(copies["_id"].to_pylist(), copies["node"].to_pylist()))
    out: dict[int, np.ndarray] = {}
    for i, s in zip(docs["_id"].to_pylist(), shingle_sets(*text_bytes(docs["text"]))):
        if len(s):
            node = node_of(s)
            if (i, node) not in skip:
                out[node] = s
    return out


def _screened(s: np.ndarray) -> np.ndarray:
    return s[: np.searchsorted(s, _HALF)] >> _U(63 - B.SCREEN_BITS)


def screen(docs: DataFrame, keys: DataFrame, rows: int) -> DataFrame:
    """``node, n, m1, m2, tokens`` of the sets that may have a partner."""
    n_blocks = B.block_count(rows)
    dealt = B.with_block(docs, n_blocks)
    first = keys.where("node IS NOT NULL").groupBy("node").agg(F.min("_id").alias("first"))
    copies = B.with_block(keys.join(first, "node").where(F.col("_id") != F.col("first")).select("_id", "node"), n_blocks)

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({k: pa.array([], t) for k, t in zip(("bin", "block", "hashes", "again"), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))})
        sets = [_screened(s) for s in _block_sets(left, right).values()]
        values, n = np.unique(np.concatenate([np.unique(s) for s in sets]) if sets else np.zeros(0, _U), return_counts=True)
        return B.entries(left["block"][0].as_py(), values, n > 1, n_blocks)

    shared = B.shared_hashes(dealt.groupBy("block").cogroup(copies.groupBy("block")).applyInArrow(send, B.ENTRY_SCHEMA))
    none = F.lit(None)
    notes = (shared.select("block", none.cast("long").alias("_id"), none.cast("long").alias("node"), "hashes")
             .unionByName(copies.select("block", "_id", "node", none.cast("binary").alias("hashes"))))

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            shared_here = B.gathered(iter(right["hashes"].to_pylist()))
            mine = right.filter(pa.compute.is_valid(right["_id"]))
            for node, s in _block_sets(left, mine).items():
                alone = int((~B.held(_screened(s), shared_here)).sum())
                if alone <= len(s) - needed(len(s)):
                    rows.append((node, len(s), *least_hashes(s), s.view(np.int64)))
        cols = list(zip(*rows)) if rows else [()] * 5
        return pa.table({"node": pa.array(cols[0], pa.int64()), "n": pa.array(cols[1], pa.int64()), "m1": pa.array(cols[2], pa.int64()),
                         "m2": pa.array(cols[3], pa.int64()), "tokens": pa.array(cols[4], pa.list_(pa.int64()))})

    return dealt.groupBy("block").cogroup(notes.groupBy("block")).applyInArrow(keep, "node long, n long, m1 long, m2 long, tokens array<long>")


# -- comparing sets inside one task -------------------------------------------------------------------------------

def _rows_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, all tokens, bounds) of a table with a list column."""
    lists = table["tokens"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    n = np.diff(lists.offsets.to_numpy())
    return table["node"].to_numpy(), lists.flatten().to_numpy().view(_U), np.concatenate([[0], np.cumsum(n)])


def links_between(queries: pa.Table, members: pa.Table, same: bool) -> list[tuple[int, int]]:
    """A spanning set of the verified links of queries with members (of all pairs with ``same``: one table).

    First the bound: the number of a query's tokens in the members' union.  Only queries that reach it are compared.
    """
    mn, mt, mb = _rows_of(members)
    union, place = np.unique(mt, return_inverse=True)
    sizes = np.diff(mb)
    out = []
    parent = list(range(len(mn) + (0 if same else queries.num_rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    qn, qt, qb = (mn, mt, mb) if same else _rows_of(queries)
    present = np.zeros(len(union) + 1, bool)
    for i, node in enumerate(qn.tolist()):
        tokens = qt[qb[i] : qb[i + 1]]
        at = place[qb[i] : qb[i + 1]] if same else np.searchsorted(union, tokens)
        if not same:
            at = at[union[np.minimum(at, len(union) - 1)] == tokens]
        if len(at) < needed(len(tokens)):
            continue
        present[at] = True
        both = np.add.reduceat(present[place], mb[:-1])
        present[at] = False
        hit = np.flatnonzero(100 * both >= PERCENT * (sizes + len(tokens) - both))
        for j in hit.tolist():
            x, y = find(i if same else len(mn) + i), find(j)
            if x != y:
                parent[x] = y
                if node != int(mn[j]):
                    out.append((node, int(mn[j])))
    return out


def _link_table(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def in_groups(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``node, gid`` of the first partition, links found inside the groups of both partitions)."""
    long = sets.select("node", F.explode(F.array(F.struct(F.lit(1).alias("k"), F.col("m1").alias("m")), F.struct(F.lit(2).alias("k"), F.col("m2").alias("m")))).alias("x"))
    long = long.select("node", "x.k", "x.m")
    sizes = long.groupBy("k", "m").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot"))
    pieces = F.ceil(F.col("size") / GROUP_SETS)
    placed = long.join(sizes, ["k", "m"]).withColumn("piece", F.pmod(F.xxhash64("node", F.lit(3)), pieces))
    placed = staged(placed.select("node", "k", "size", "pivot", "piece", F.xxhash64("k", "m", "piece").alias("gid")), "matrix-groups")
    pivots = placed.where((F.col("size") > GROUP_SETS) & (F.col("node") != F.col("pivot"))).select(F.col("pivot").alias("node"), "gid").distinct()
    members = placed.where("size > 1").select("node", "gid").unionByName(pivots).distinct()

    def compare(table: pa.Table) -> pa.Table:
        return _link_table(links_between(table, table, True))

    links = members.join(sets.select("node", "tokens"), "node").select("gid", "node", "tokens").groupBy("gid").applyInArrow(compare, "a long, b long")
    return placed.where("k = 1").select("node", "gid"), links


_ENTRIES = "bin long, token array<long>, at array<int>, node array<long>, gid array<long>, label array<long>, pure array<long>"


def _to_bins(bins: int):
    """A batch of sets as one row per token bin: its tokens in order, the set of each, and the columns of the sets that have tokens there."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = b["tokens"].flatten().to_numpy().view(_U)
            at = np.repeat(np.arange(b.num_rows, dtype=np.int32), np.diff(b["tokens"].offsets.to_numpy()))
            order = np.argsort(tokens, kind="stable")
            tokens, at = tokens[order], at[order]
            cuts = np.searchsorted(((tokens >> _U(32)) * _U(bins)) >> _U(32), np.arange(bins + 1, dtype=_U))
            parts = [(i, x, y, *np.unique(at[x:y], return_inverse=True)) for i, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if y > x]
            columns = [b[k].to_numpy() for k in ("node", "gid", "label", "pure")]
            yield pa.record_batch(
                [pa.array([p[0] for p in parts], pa.int64()), pa.array([tokens[p[1] : p[2]].view(np.int64) for p in parts], pa.list_(pa.int64())),
                 pa.array([p[4].astype(np.int32) for p in parts], pa.list_(pa.int32())),
                 *[pa.array([c[p[3]] for p in parts], pa.list_(pa.int64())) for c in columns]],
                ["bin", "token", "at", "node", "gid", "label", "pure"])

    return send


def _bin_entries(table: pa.Table) -> tuple[np.ndarray, ...]:
    """token, node, gid, label, pure of a bin's entries, by token and group, and the first entry of each token."""
    cols = {k: [x.values.to_numpy() for x in table[k]] for k in ("token", "at", "node", "gid", "label", "pure")}
    token = np.concatenate(cols["token"])
    node, gid, label, pure = (np.concatenate([v[at] for v, at in zip(cols[k], cols["at"])]) for k in ("node", "gid", "label", "pure"))
    order = np.lexsort((gid, token))
    token, node, gid, label, pure = (x[order] for x in (token, node, gid, label, pure))
    return token, node, gid, label, pure, np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))


def _foreign_tokens(table: pa.Table) -> pa.Table:
    """Per set of a bin: its tokens that another component holds too, with the number of sets that hold them."""
    token, node, _, label, _, starts = _bin_entries(table)
    n = np.diff(np.append(starts, len(token)))
    keep = np.repeat(np.minimum.reduceat(label, starts) != np.maximum.reduceat(label, starts), n)
    token, node, df = token[keep], node[keep], np.repeat(n, n)[keep]
    order = np.argsort(node, kind="stable")
    token, node, df = token[order], node[order], df[order]
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(first, len(node)), pa.int32())
    return pa.table({"node": node[first], "token": pa.ListArray.from_arrays(offsets, pa.array(token, pa.int64())),
                     "df": pa.ListArray.from_arrays(offsets, pa.array(df, pa.int64()))})


def _groups_to_open(table: pa.Table) -> pa.Table:
    """Distinct (set, group of higher number: one at least as large) that share a token of the bin and aren't in one component."""
    token, node, gid, label, pure, starts = _bin_entries(table)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def distinct() -> tuple[np.ndarray, np.ndarray]:
        q, g = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (0, 1))
        order = np.lexsort((g, q))
        q, g = q[order], g[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (g[1:] != g[:-1])
        return q[new], g[new]

    for s, e in zip(starts.tolist(), np.append(starts[1:], len(token)).tolist()):
        if e - s < 2:
            continue
        g, where = np.unique(gid[s:e], return_index=True)
        p = pure[s:e][where]
        for x in range(s, e, 1024):
            y = min(e, x + 1024)
            a, b = np.nonzero((gid[x:y, None] < g[None, :]) & (label[x:y, None] != p[None, :]))
            if len(a):
                parts.append((node[x:y][a], g[b]))
                size += len(a)
        if size > 4_000_000:
            parts = [distinct()]
            size = len(parts[0][0]) // 2
    q, g = distinct()
    return pa.table({"node": pa.array(q, pa.int64()), "gid": pa.array(g, pa.int64())})


def matrix_links(sets: DataFrame, groups: DataFrame, labels: DataFrame, n_tokens: int) -> DataFrame:
    """Links between sets of different groups and components, through the token-group matrix."""
    known = groups.join(labels, "node", "left").select("node", "gid", F.coalesce("label", "node").alias("label"))
    # Groups are numbered by size first: the sets of the smaller one of two groups ask for the larger one.
    number = F.shiftleft(F.least(F.count(F.lit(1)), F.lit(65_535)), 47).bitwiseOR(F.col("gid").bitwiseAND(F.lit((1 << 47) - 1)))
    pure = known.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), number.alias("number")).select(
        "gid", "number", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.lit(-1)).alias("pure"))
    known = known.join(pure, "gid").join(sets.select("node", "n"), "node").select("node", F.col("number").alias("gid"), "label", "pure", "n")
    known = staged(known, "matrix-known", n_tokens // 100)
    bins = max(1, math.ceil(n_tokens / BIN_TOKENS))
    send = _to_bins(bins)

    rows = sets.select("node", "tokens").join(known, "node")
    foreign = rows.mapInArrow(send, _ENTRIES).groupBy("bin").applyInArrow(_foreign_tokens, "node long, token array<long>, df array<long>")
    foreign = foreign.groupBy("node").agg(F.array_sort(F.flatten(F.collect_list(F.arrays_zip("df", "token")))).alias("t"))
    needs = F.expr(f"(n * {PERCENT} + 99) div 100").cast("int")
    asking = foreign.join(known, "node").where(F.size("t") >= needs)
    asking = staged(asking.select("node", "gid", "label", "pure", F.transform(F.slice("t", F.lit(1), F.size("t") - needs + 1), lambda x: x["token"]).alias("tokens")),
                    "matrix-asking")
    asked = asking.mapInArrow(send, _ENTRIES).groupBy("bin").applyInArrow(_groups_to_open, "node long, gid long").distinct()
    asked = staged(asked, "matrix-asked")
    load = asked.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / QUERY_SETS).alias("parts"))
    queries = (asked.join(load, "gid").withColumn("part", F.pmod(F.xxhash64("node", F.lit(5)), F.col("parts")))
               .join(sets.select("node", "tokens"), "node").select("gid", "part", "node", "tokens"))
    opened = (asking.select("node", "gid").join(load, "gid").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
              .join(sets.select("node", "tokens"), "node").select(*[F.col(c).alias(c) for c in ("gid", "part", "node", "tokens")]))

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        return _link_table(links_between(left, right, False) if left.num_rows and right.num_rows else [])

    return queries.groupBy("gid", "part").cogroup(opened.groupBy("gid", "part")).applyInArrow(verify, "a long, b long")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_key`` (a hash of the text, to tell rows with one id apart) of every document."""
    return with_first(docs).drop("component_key")


def with_first(docs: DataFrame) -> DataFrame:
    """As ``jaccard_components``, with ``component_key``: (``component_id, component_key``) are id and text key of the component's smallest row."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(internal_id().alias("_id"), "text")
    rows = docs.count()
    hashed = docs.withColumn("_text", F.xxhash64(F.coalesce("text", F.lit(""))))
    keys = staged(hashed.mapInArrow(_key_rows, "_id long, _text long, n long, node long").repartition(max(1, math.ceil(rows / FILE_ROWS))), "matrix-keys")
    sets = staged(screen(docs, keys, rows), "matrix-sets")
    n_tokens = sets.agg(F.sum("n")).first()[0] or 0
    groups, near = in_groups(sets)
    near = staged(near, "matrix-near")
    labels = components(near)
    far = matrix_links(sets, groups, labels, n_tokens)
    labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(far))
    nodes = keys.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("_id", "_text")).alias("first"))
    nodes = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = nodes.groupBy("label").agg(F.min("first").alias("component"))
    named = nodes.join(least, "label").select("node", "component")
    every = keys.join(named, "node", "left").withColumn("component", F.coalesce("component", F.struct("_id", "_text")))
    return every.select(external_id("_id").alias("doc_id"), F.col("n").alias("n_shingles"), external_id(F.col("component._id")).alias("component_id"),
                        F.col("_text").alias("text_key"), F.col("component._text").alias("component_key"))

"""Byte-pair-style vocabulary over characters: train, apply a merge, encode, decode.

Semantics (as in the source): the initial vocabulary is the sorted set of
characters; each round takes the most frequent adjacent pair (overlapping
count; ties go to the pair seen first in the text), gives it the next id and
replaces it everywhere left to right without overlap; rounds continue until
``vocab_size`` ids exist (or no pair is left).

Spark form
----------
* Text is cut into pieces (``segment="word"``: the blank-aware segment
  pattern, merges never cross pieces; ``segment="document"``: whole texts).
  Identical pieces are counted once with a weight and their first
  occurrence ``(doc_id, seg_no)``, so work scales with distinct pieces.
* Token id ``i`` is stored as the i-th private-use code point ("packed"), so a
  merge is one built-in ``replace`` and a pair is two characters.  There are
  137,468 of them (``PACK_LIMIT``): alphabet plus merges may not exceed that.
* Pairs are counted once.  After that a merge only returns the changes at its
  occurrences (``bpe_pairs``), and several merges are tried in one round: those
  that turn out to be what one-merge-per-round training takes next are kept.
  The pieces are written (reliable ``checkpoint``) after a bounded number of
  merges; a task makes the merges since then again.
* Encoding merges the pair of the lowest rank first (``bpe_codec``): its cost
  goes with the length of a piece, not with the number of merges.  Texts aren't shuffled, and neither
  merges nor vocabulary stand in the plan as literals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from glossa.functions.patterns import PACK_RANGES
from glossa.functions.text import char_tokens, explode_rows, first_place, segment_tokens
from glossa.operators.bpe_codec import REMEMBERED, encoded, looked_up
from glossa.operators.bpe_pairs import PairTable, pair_key
from glossa.operators.lookup import materialise
from glossa.session import workers_find_package

CHECKPOINT_MERGES = 64  # merges made on the piece table between reliable checkpoints
ROWS_PER_PARTITION = 250_000  # distinct pieces per task in the training loop, at most,
SYMBOLS_PER_PARTITION = 1 << 20  # and characters of them: a task holds several numbers for each
PACK_LIMIT = sum(hi - lo + 1 for lo, hi in PACK_RANGES)
PACKED = "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in PACK_RANGES)  # for a regex class


@dataclass
class Tokenizer:
    """Trained vocabulary: ``vocab[i]`` is the string of id i; ``merges`` in rank order."""
    vocab: list[str]
    merges: list[tuple[int, int, int, int]]  # (left_id, right_id, new_id, pair_count)
    n_base: int

    @staticmethod
    def load(vocab: DataFrame, merges: DataFrame) -> "Tokenizer":
        """From saved tables (as many rows as the vocabulary has)."""
        tokens = [r["token"] for r in vocab.orderBy("token_id").collect()]
        rules = [(r["left_id"], r["right_id"], r["new_id"], r["pair_count"]) for r in merges.orderBy("rank").collect()]
        return Tokenizer(tokens, rules, len(tokens) - len(rules))

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.vocab)), "token_id int, token string")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(r, a, b, n, c) for r, (a, b, n, c) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left_id int, right_id int, new_id int, pair_count bigint")


def pack(i: int) -> str:
    for lo, hi in PACK_RANGES:
        if i <= hi - lo:
            return chr(lo + i)
        i -= hi - lo + 1
    raise ValueError(f"ids end at {PACK_LIMIT}")


def packed_id(ch: str) -> int:
    """Inverse of ``pack``."""
    before = 0
    for lo, hi in PACK_RANGES:
        if ord(ch) <= hi:
            return before + ord(ch) - lo
        before += hi - lo + 1
    raise ValueError(f"{ch!r} is no packed id")


def packed_id_column(ch: Column) -> Column:
    code, before, out = F.ascii(ch), 0, None
    for lo, hi in PACK_RANGES:
        value = code - lo + before
        out = F.when(code <= hi, value) if out is None else out.when(code <= hi, value)
        before += hi - lo + 1
    return out.cast("int")


def pieces(docs: DataFrame, segment: str = "word", text: str = "text", doc: str = "doc_id") -> DataFrame:
    """Distinct pieces ``(piece, weight, first STRUCT<d, s>)``."""
    if segment == "word":
        occ = explode_rows(docs, segment_tokens(text), (doc,), "piece", "seg_no")
    elif segment == "document":
        occ = docs.select(doc, F.lit(0).alias("seg_no"), F.col(text).alias("piece"))
    else:
        raise ValueError(f"unknown segment mode {segment!r}")
    return (occ.filter(F.length("piece") > 0).groupBy("piece").agg(
        F.count(F.lit(1)).cast("bigint").alias("weight"), first_place(occ, doc, "seg_no").alias("_first"))
        .select("piece", "weight", F.struct(F.col("_first.o").alias("d"), F.col("_first.p").alias("s")).alias("first")))


def base_alphabet(pcs: DataFrame) -> list[str]:
    """Sorted distinct characters (bounded by Unicode; refused beyond the packed id space)."""
    chars = explode_rows(pcs, char_tokens("piece"), (), "c").distinct()
    n = chars.count()
    if n > PACK_LIMIT:
        raise ValueError(f"{n} distinct characters exceed the {PACK_LIMIT} packed ids")
    return sorted(r["c"] for r in chars.collect())


def pack_column(c: Column, alphabet: list[str], unk_id: int = 0) -> Column:
    """Characters -> packed ids; characters outside the alphabet become id ``unk_id``."""
    if not alphabet:
        return F.lit("")
    # Private-use characters of the text itself: only those of the alphabet may be read as characters.
    own = "".join(f"\\x{{{ord(ch):X}}}" for ch in alphabet if is_packed(ch))
    foreign = f"[{PACKED}&&[^{own}]]" if own else f"[{PACKED}]"
    known = F.regexp_replace(c, foreign, _quoted(alphabet[unk_id]))
    packed = F.translate(known, "".join(alphabet), "".join(pack(i) for i in range(len(alphabet))))
    return F.regexp_replace(packed, f"[^{PACKED}]", pack(unk_id))


def is_packed(ch: str) -> bool:
    return any(lo <= ord(ch) <= hi for lo, hi in PACK_RANGES)


def _quoted(replacement: str) -> str:
    return "\\" + replacement if replacement in "\\$" else replacement


def loop_partitions(n_pieces: int, n_symbols: int) -> int:
    """Tasks that hold no more of the piece table than a Python worker can: pieces of any length."""
    return max(n_pieces // ROWS_PER_PARTITION, n_symbols // SYMBOLS_PER_PARTITION) + 1


def train(docs: DataFrame, vocab_size: int = 300, segment: str = "word", text: str = "text",
          doc: str = "doc_id", batch: int = 64) -> Tokenizer:
    """Learn merges until ``vocab_size`` ids exist; stops early when no pair is left.

    A round sends up to ``batch`` merges, in the order of the present ranking, to the partitions and gets back what each
    would change if all before it are made.  The driver takes them one by one while the next is
    the first of the ranking as it stands after those before; the rest is forgotten.  ``batch=1`` is
    the plain one-merge-per-round loop.
    """
    workers_find_package(docs.sparkSession)
    pcs = materialise(pieces(docs, segment, text, doc))
    alphabet = base_alphabet(pcs)
    if vocab_size > PACK_LIMIT:
        raise ValueError(f"vocab_size {vocab_size} exceeds {PACK_LIMIT}")
    vocab = list(alphabet)
    # Size the loop's partitions by the piece table itself: a few large
    # partitions per core locally, thousands on a cluster with 1e8+ pieces.
    sized = pcs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("piece")).alias("symbols")).first()
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, loop_partitions(sized["n"], sized["symbols"] or 0))
    state = pcs.select(pack_column(F.col("piece"), alphabet).alias("p"), F.col("weight").alias("w"), "first.d", "first.s")
    state = state.filter(F.length("p") >= 2).repartition(parts, "p").sortWithinPartitions("d", "s")
    table = PairTable(materialise(state))
    merges: list[tuple[int, int, int, int]] = []
    table.recount()
    length = batch  # of the next plan: twice what the last one was good for
    while len(vocab) < vocab_size:
        ranked = table.ranked(min(length, vocab_size - len(vocab)))
        if not ranked:
            if not table.rest:
                break
            table.recount()
            continue
        plan = [(pair >> 32, pair & 0xFFFFFFFF, ord(pack(len(vocab) + j))) for j, (pair, _) in enumerate(ranked)]
        taken = 0
        for merge, rows in zip(plan, table.changes(plan)):
            pair = pair_key(*merge[:2])
            if not table.is_next(pair):
                break
            a, b = packed_id(chr(merge[0])), packed_id(chr(merge[1]))
            merges.append((a, b, len(vocab), table.count[pair]))
            vocab.append(vocab[a] + vocab[b])
            table.apply(merge, len(vocab[-1]), rows)
            taken += 1
        length = min(batch, 2 * taken + 4)
        if len(table.done) >= CHECKPOINT_MERGES:
            table.rewrite(materialise)
    return Tokenizer(vocab, merges, len(alphabet))


def encode(docs: DataFrame, tok: Tokenizer, segment: str = "word", text: str = "text",
           keep: tuple[str, ...] = ("doc_id",), remembered: int = REMEMBERED) -> DataFrame:
    """``keep + ids ARRAY<INT>`` per row, without a shuffle: a task encodes each distinct piece of its rows once.

    Null and empty texts have no ids; ``remembered`` bounds the pieces a task keeps and changes no result.
    """
    workers_find_package(docs.sparkSession)
    segs = segment_tokens(text) if segment == "word" else F.array(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(*keep, segs.alias("_segs"))
    schema = StructType([*rows.drop("_segs").schema.fields, StructField("ids", ArrayType(IntegerType()))])
    return rows.mapInArrow(encoded(tok.vocab[:tok.n_base], tok.merges, remembered), schema)


def _looked_up(ids: DataFrame, tok: Tokenizer, col: str, out: str, joined: bool, safe: bool) -> DataFrame:
    workers_find_package(ids.sparkSession)
    rows = ids.drop(out) if out != col else ids.withColumnRenamed(col, "_ids")
    at = rows.columns.index(col if out != col else "_ids")
    kind = StringType() if joined else ArrayType(StringType())
    found = rows.mapInArrow(looked_up(tok.vocab, at, out, joined, safe), StructType([*rows.schema.fields, StructField(out, kind)]))
    return found.drop("_ids") if out == col else found


def decode(ids: DataFrame, tok: Tokenizer, col: str = "ids", out: str = "text") -> DataFrame:
    """ids -> text; an id outside the vocabulary raises an error, as in the source."""
    return _looked_up(ids, tok, col, out, joined=True, safe=False)


def id_tokens(ids: DataFrame, tok: Tokenizer, col: str = "ids", out: str = "toks") -> DataFrame:
    """ids -> token strings as an array; an id outside the vocabulary reads as '' (the labellers' rule)."""
    return _looked_up(ids, tok, col, out, joined=False, safe=True)


def apply_merge_once(pcs: DataFrame, alphabet: list[str], left: str, right: str) -> DataFrame:
    """One merge (left,right) on every piece: ``(piece, tok_no, token)`` rows, plain strings."""
    a, b = alphabet.index(left), alphabet.index(right)
    new = pack(len(alphabet))
    merged = F.replace(pack_column(F.col("piece"), alphabet), F.lit(pack(a) + pack(b)), F.lit(new))
    toks = F.transform(char_tokens(merged), lambda ch: F.when(ch == new, F.lit(left + right))
                       .otherwise(F.element_at(F.array(*[F.lit(x) for x in alphabet]), packed_id_column(ch) + 1)))
    return explode_rows(pcs, toks, ("piece",), "token", "tok_no")

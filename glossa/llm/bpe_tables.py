"""Encoding with a public BPE vocabulary through a table of distinct words; decoding through an id-to-piece join.

Words are the runs between ASCII white space.  The vocabulary's normaliser and splitter never look across white space,
so the ids of a text are the ids of its words in order.

1. Spark splits the texts into words and counts them.  The words that occur more than once are encoded once, by the tokenizers library, into the
   table of distinct words: a 128-bit digest of the word, its ids, and its decoded text, for which the ids are joined with the id-to-piece
   table (``decode_ids``; it has as many rows as the vocabulary).
2. The ids come back by position: the table is broadcast, the words of a chunk of texts are numbered, each distinct one is looked up once, and its ids
   and pieces are taken at every position where it stands.  The table's size has a bound (``MAX_WORDS`` rows of about 50 bytes):
   if more words repeat, those of the lowest frequencies are left out.
3. A word outside the table is encoded where it stands.  With a table that holds all repeated words, every distinct word of the corpus is
   encoded once; else a word left out is encoded once in each chunk that has it.
   (Joining the rare words by a shuffle gives the same ids; see the README for its figures.)

Defined results: null text counts as empty (no ids, empty decoded text); repeated rows give repeated results; a null ``doc_id`` stays
null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.llm.common import WS_RUN, bounded_batches, most_frequent, release, staged

MAX_WORDS = 700_000
#: Repeated words that a text may bring, for the number of files of the word counts.
WORDS_PER_TEXT = 8
#: Bytes of words that a task resolves at a time (one longer text is taken by itself).
CHUNK_BYTES = 1_000_000
#: Words that the library encodes at a time: what it returns of a word takes several hundred bytes, besides the ids.
ENCODE_WORDS = 2_048


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(1)
def _load(path: str):
    """The tokenizer, once per worker process."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's threads would each keep memory of their own
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def split_words(text: Column) -> Column:
    """The runs between ASCII white space (0x09-0x0D, 0x20), with empty strings at the ends; other white space stays inside for the library to treat."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), WS_RUN, -1)


def _digests(words: list[str]) -> list[bytes]:
    return [xxhash.xxh3_128_digest(w) for w in words]


def _ids(words: list[str], tokenizer) -> list[list[int]]:
    return [e.ids for lo in range(0, len(words), ENCODE_WORDS) for e in tokenizer.encode_batch(words[lo:lo + ENCODE_WORDS], add_special_tokens=False)]


def word_table(words: DataFrame, pieces: DataFrame, path: str, max_words: int, texts: int) -> DataFrame:
    """``digest, n, ids, decoded`` of the words (``words``: arrays) that occur more than once, each encoded once; the most frequent if there are more than ``max_words``.

    ``n`` is the number of ids, and ``ids`` are decimal numbers with one space between.
    """
    counts = words.select(F.explode("words").alias("word")).where("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = staged(counts.where("n > 1"), "bpe-words", WORDS_PER_TEXT * texts)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _load(path)
        for b in batches:
            chosen = b["word"].to_pylist()
            yield pa.record_batch([pa.array(_digests(chosen), pa.binary()), pa.array(_ids(chosen, tokenizer), pa.list_(pa.int32()))], ["digest", "ids"])
        release()

    encoded = most_frequent(counts, max_words).select("word").mapInArrow(encode, "digest binary, ids array<int>")
    entry = F.struct("digest", F.size("ids").alias("n"), F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))
    return decode_ids(encoded.select(entry.alias("entry"), "ids"), pieces, "entry").select("entry.*", "decoded")


def id_to_piece(spark: SparkSession, path: str) -> DataFrame:
    """``id, piece`` of the vocabulary and its special tokens: one row per id, read in a task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            vocab = _load(path).get_vocab(with_added_tokens=True)
            yield pa.record_batch([pa.array(vocab.values(), pa.int32()), pa.array(vocab.keys(), pa.string())], ["id", "piece"])

    return spark.range(0, 1, 1, 1).mapInArrow(read, "id int, piece string")


def decode_ids(encoded: DataFrame, pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, decoded`` of rows ``key, ids`` (array): the ids joined with their pieces, in order, one space between; no ids give an empty text."""
    at = encoded.select(key, F.posexplode_outer("ids").alias("pos", "id")).join(F.broadcast(pieces), "id", "left")
    at = at.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("p"))
    return at.select(key, F.coalesce(F.array_join(F.transform("p", lambda p: p["piece"]), " "), F.lit("")).alias("decoded"))


class Table:
    """The broadcast table of distinct words, sorted by digest, and the pieces by id for words outside of it."""

    def __init__(self, words: pa.Table, pieces: pa.Table) -> None:
        digests = words["digest"].cast(pa.binary(16)).combine_chunks()
        keys = np.frombuffer(digests.buffers()[1], np.uint64)[2 * digests.offset:][:2 * len(digests)].reshape(-1, 2) if len(digests) else np.zeros((0, 2), np.uint64)
        order = np.argsort(keys[:, 0], kind="stable")
        self.high, self.low = keys[order, 0], keys[order, 1]
        self.n = words["n"].to_numpy()[order].astype(np.int64)
        self.ids = words["ids"].combine_chunks().take(pa.array(order)).cast(pa.large_string())
        self.decoded = words["decoded"].combine_chunks().take(pa.array(order)).cast(pa.large_string())
        self.pieces = [""] * (1 + max(pieces["id"].to_pylist(), default=0))
        for i, piece in zip(pieces["id"].to_pylist(), pieces["piece"].to_pylist()):
            self.pieces[i] = piece

    def find(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The row of each word, and whether there is one: both halves of the digest must agree."""
        if not len(self.high) or not words:
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        wanted = np.frombuffer(b"".join(_digests(words)), np.uint64).reshape(-1, 2)
        at = np.minimum(np.searchsorted(self.high, wanted[:, 0]), len(self.high) - 1)
        return at, (self.high[at] == wanted[:, 0]) & (self.low[at] == wanted[:, 1])


def resolve(words: list[str], table: Table, tokenizer) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of ids, ids as text and decoded text of distinct words (of the empty string: none): from the table, else encoded here."""
    at, known = table.find(words)
    rest = [words[i] for i in np.flatnonzero(~known).tolist()]
    encoded = _ids(rest, tokenizer)
    n = np.zeros(len(words), np.int64)
    n[known], n[~known] = table.n[at[known]], [len(e) for e in encoded]
    ids = pa.array([" ".join(map(str, e)) for e in encoded], pa.large_string())
    decoded = pa.array([" ".join([table.pieces[i] for i in e]) for e in encoded], pa.large_string())
    rows = pa.array(at[known])
    order = pa.array(np.argsort(np.concatenate([np.flatnonzero(known), np.flatnonzero(~known)])))  # back to the words' order
    take = lambda a, b: pa.concat_arrays([a.take(rows), b]).take(order)  # of the table, its rows for these words only are copied
    return n, take(table.ids, ids), take(table.decoded, decoded)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lo = size = 0
    for i, n in enumerate(batch["size"].to_pylist()):
        if i > lo and size + n > CHUNK_BYTES:
            yield batch.slice(lo, i - lo)
            lo, size = i, 0
        size += n
    if lo < batch.num_rows:
        yield batch.slice(lo)


def _encoded(words: pa.ListArray, table: Table, tokenizer) -> tuple[pa.Array, pa.Array, pa.Array]:
    """``n_tokens, ids, decoded`` of texts given as arrays of words."""
    coded = words.flatten().dictionary_encode()
    at = coded.indices.to_numpy()
    n, ids, decoded = resolve(coded.dictionary.to_pylist(), table, tokenizer)
    ends = words.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    counts = n[at]
    upto = lambda a: np.concatenate([[0], np.cumsum(a, dtype=np.int64)])[ends]
    used = counts > 0  # words without ids leave nothing, not even a space
    places, bounds = pa.array(at[used]), pa.array(upto(used))
    joined = lambda a: pc.binary_join(pa.LargeListArray.from_arrays(bounds, a.take(places)), pa.scalar(" ", pa.large_string()))
    return pa.array(np.diff(upto(counts))), joined(ids), joined(decoded)


def encode_texts(docs: DataFrame, path: str | None = None, max_words: int = MAX_WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every document; ``ids`` are decimal numbers with one space between."""
    path = path or word_bpe_path()
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.count()
    docs = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"), split_words(F.col("text")).alias("words"))
    pieces = staged(id_to_piece(spark, path), "bpe-pieces")
    words = staged(word_table(docs, pieces, path, max_words, texts), "bpe-table", min(max_words, WORDS_PER_TEXT * texts))
    shared = spark.sparkContext.broadcast(Table(words.toArrow(), pieces.toArrow()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tokenizer = shared.value, _load(path)
        for whole in batches:
            for b in _chunks(whole):
                n, ids, decoded = _encoded(b["words"], table, tokenizer)
                yield pa.record_batch([b["doc_id"], n, ids.cast(pa.string()), decoded.cast(pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])
        del table
        release()

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids string, decoded string")


def encode_documents(docs: DataFrame, path: str | None = None, max_words: int = MAX_WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    return encode_texts(docs, path, max_words).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

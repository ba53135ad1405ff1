"""op7: ids and decoded text equal the library's, with and without a table of words."""

import hashlib

import pyarrow as pa
import pytest

from glossa.llm import bpe_tables
from glossa.llm.common import documents

TEXTS = ["Hello world, it's the year 2024!", "", None, " \t\n ", "<|startoftext|>a b<|endoftext|>", "İstanbul ΑΣ straße ﬁn", "e\u0301 é \u00a0x\u2003y\u0085z", "a\x1cb\x1fc",
         "naïve😀👍🏽 日本語テキスト", "I'll you've x's 'S 's", "###***$$$ -- ??", "word " * 3000, "x" * 5000, "\u0301 start", "<|endoftext|", "a\u0300\u0301b", "同じ 同じ"]


COUNTED = pa.proxy_memory_pool(pa.default_memory_pool())  # outlives what is taken from it


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_tables.word_bpe_path())


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False))]
    return len(ids), *sha


@pytest.mark.parametrize("max_words", [2_000_000, 8, 0])
def test_equals_library(table, max_words):
    rows = [(i if i else None, t) for i, t in enumerate(TEXTS * 2)]
    tokenizer = library()
    out = bpe_tables.encode_documents(table(rows), max_words=max_words).collect()
    assert sorted([tuple(r) for r in out], key=str) == sorted([(i, *expected(tokenizer, t)) for i, t in rows], key=str)


def test_given_table(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    tokenizer = library()
    out = {r["doc_id"]: tuple(r)[1:] for r in bpe_tables.encode_documents(docs).collect()}
    assert out == {r["doc_id"]: expected(tokenizer, r["text"]) for r in docs.collect()}


def test_decode_join(spark):
    tokenizer = library()
    ids = {1: tokenizer.encode("some plain words", add_special_tokens=False).ids, 2: [], 3: [49407, 0]}
    rows = spark.createDataFrame(list(ids.items()), "doc_id long, ids array<int>")
    out = {r["doc_id"]: r["decoded"] for r in bpe_tables.decode_ids(rows, bpe_tables.id_to_piece(spark, bpe_tables.word_bpe_path())).collect()}
    assert out == {k: tokenizer.decode(v, skip_special_tokens=False) for k, v in ids.items()}


def test_empty(spark):
    assert bpe_tables.encode_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_word_is_known_by_both_halves_of_its_digest():
    words = ["alpha", "beta", "gamma"]
    digests = bpe_tables._digests(words)
    digests[1] = digests[0][:8] + digests[1][8:]  # the first half of another word's digest
    text = pa.array(["1", "2", "3"])
    rows = pa.table({"digest": pa.array(digests, pa.binary()), "n": pa.array([1, 1, 1], pa.int32()), "ids": text, "decoded": text})
    pieces = pa.table({"id": pa.array([0], pa.int32()), "piece": ["p"]})
    table = bpe_tables.Table(rows, pieces)
    at, known = table.find(["gamma", "beta", "delta"])
    assert known.tolist() == [True, False, False] and table.ids[int(at[0])].as_py() == "3"


def test_repeated_words_are_encoded_once(table, spark):
    """The table holds each word that occurs twice or more, one row each, with its decoded text from the join."""
    tokenizer = library()
    docs = table([(0, "aa bb aa  cc"), (1, "\tbb dd"), (2, None), (3, "\u0301 \u0301")])
    pieces = bpe_tables.id_to_piece(spark, bpe_tables.word_bpe_path())
    words = docs.select(bpe_tables.split_words(docs["text"]).alias("words"))
    got = {bytes(r["digest"]): (r["n"], r["ids"], r["decoded"]) for r in bpe_tables.word_table(words, pieces, bpe_tables.word_bpe_path(), 100, 4).collect()}
    want = {w: tokenizer.encode(w, add_special_tokens=False).ids for w in ("aa", "bb", "\u0301")}
    assert got == {bpe_tables._digests([w])[0]: (len(i), " ".join(map(str, i)), tokenizer.decode(i, skip_special_tokens=False)) for w, i in want.items()}


def test_a_chunk_copies_its_own_rows_of_the_table_only():
    """What a chunk of texts takes doesn't grow with the table, and the library is given a bounded number of words at a time."""
    n = 50_000
    words = [f"w{i}" for i in range(n)]
    text = pa.array([f"{i} " * 20 for i in range(n)])
    rows = pa.table({"digest": pa.array(bpe_tables._digests(words), pa.binary()), "n": pa.array([20] * n, pa.int32()), "ids": text, "decoded": text})
    table = bpe_tables.Table(rows, pa.table({"id": pa.array([0, 1], pa.int32()), "piece": ["p", "q"]}))
    sizes = []

    class Encoding:
        ids = [1, 0]

    class Library:
        def encode_batch(self, given, add_special_tokens):
            sizes.append(len(given))
            return [Encoding()] * len(given)

    chosen = ["w7", "new", "w49999", "", *[f"x{i}" for i in range(5000)]]
    usual = pa.default_memory_pool()
    pa.set_memory_pool(COUNTED)
    try:
        n, ids, decoded = [x.tolist() for x in bpe_tables.resolve(chosen, table, Library())]
        most = COUNTED.max_memory()
    finally:
        pa.set_memory_pool(usual)
    assert n == [20, 2, 20, *[2] * 5001]
    assert ids[:4] == ["7 " * 20, "1 0", "49999 " * 20, "1 0"] and decoded[:4] == ["7 " * 20, "q p", "49999 " * 20, "q p"]
    assert most < 2_000_000 < 2 * table.ids.nbytes and max(sizes) <= 4096

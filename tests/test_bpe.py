"""BPE: merge semantics, training against brute force, encode/decode round trip."""

import os
import random

import pytest
from pyspark.sql import functions as F

from glossa.operators import bpe as B
from glossa.operators import bpe_pairs
from glossa.operators.bpe_codec import lowest_rank
from tests import brute

SF = os.path.join(os.sep, "root", "testdata", "sf0.01", "documents.parquet")


def test_merge_non_overlapping(spark):
    df = spark.createDataFrame([("aaaaa",)], "piece string")
    r = df.select(F.replace("piece", F.lit("aa"), F.lit("X")).alias("m")).first()
    assert r["m"] == "XXa"
    assert brute.merge([0] * 5, 0, 0, 9) == [9, 9, 0]


def test_first_places_are_aggregated_by_hash(spark):
    """The first occurrence is found without sorting all occurrences, for extreme and null document numbers alike."""
    from glossa.operators.tokens import pair_count, tokenize
    rows = [(5, "abab ab"), (-7, "zz ab"), ((1 << 63) - 1, "ma q"), (-(1 << 63), "yy zz"), (0, "q"), (-(1 << 63), "yy"), (None, "n zz n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    low = lambda places: min(places, key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
    pairs, segs = {}, {}
    for d, t in rows:
        for i in range(len(t) - 1):
            pairs.setdefault((t[i], t[i + 1]), []).append((d, i))
        for i, piece in enumerate(brute.segments(t)):
            segs.setdefault(piece, []).append((d, i))
    got = pair_count(tokenize(docs, "char"))
    assert {(r["left"], r["right"]): (r["pair_count"], (r["first_ord"], r["first_pos"])) for r in got.collect()} == {k: (len(v), low(v)) for k, v in pairs.items()}
    pcs = B.pieces(docs)
    assert {r["piece"]: (r["weight"], tuple(r["first"])) for r in pcs.collect()} == {k: (len(v), low(v)) for k, v in segs.items()}
    for df in (got, pcs):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan
    named = pair_count(tokenize(spark.createDataFrame([("b", "xy"), ("a", "xyxy")], "doc_id string, text string"), "char"))
    assert sorted(map(tuple, named.collect())) == [("x", "y", 3, "a", 0), ("y", "x", 1, "a", 1)]


def test_pair_count_overlapping(spark):
    from glossa.operators.tokens import pair_count, tokenize
    docs = spark.createDataFrame([(0, "aaaaa")], "doc_id long, text string")
    r = pair_count(tokenize(docs, "char")).first()
    assert (r["left"], r["right"], r["pair_count"]) == ("a", "a", 4)


TEXTS = [
    "aaaa bbb aaab abab. Abba aab\n\nbaaa",
    "the cat and the hat; the bat sat on that mat",
    "ab ab ab ba ba ba aab aba bab  \t  x",
    "",
    "zzzz zz z",
]


def test_train_matches_brute(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    pieces = [p for t in TEXTS for p in brute.segments(t)]
    size = len(set("".join(pieces))) + 30
    vocab, merges = brute.bpe_train(pieces, size)
    for batch in (1, 64):
        tok = B.train(docs, size, batch=batch)
        assert tok.vocab == vocab
        assert tok.merges == merges


def test_encode_decode_round_trip(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    pieces = [p for t in TEXTS for p in brute.segments(t)]
    size = len(set("".join(pieces))) + 20
    tok = B.train(docs, size)
    enc = B.encode(docs, tok, keep=("doc_id", "text"))
    rows = {r["doc_id"]: r for r in B.decode(enc.withColumnRenamed("text", "orig"), tok).collect()}
    for d, t in enumerate(TEXTS):
        exp = brute.bpe_encode(brute.segments(t), tok.vocab, tok.merges, tok.n_base)
        assert list(rows[d]["ids"]) == exp
        assert rows[d]["text"] == t


def test_vocabulary_of_1000_in_a_cold_session(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").limit(40)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    tok = B.train(docs, 1000)
    assert len(tok.vocab) == 1000
    back = B.decode(B.encode(docs, tok), tok).collect()
    assert {r["doc_id"]: r["text"] for r in back} == rows
    for d in list(rows)[:10]:
        ids = next(r["ids"] for r in back if r["doc_id"] == d)
        assert list(ids) == brute.bpe_encode(brute.segments(rows[d]), tok.vocab, tok.merges, tok.n_base)


def test_more_characters_than_the_basic_private_area(spark):
    han = [chr(0x4E00 + i) for i in range(7200)] + ["\U0001F600", "\uE001", "\U000F0001"]
    text = "".join(han) + " " + han[7100] + han[7101] + " " + han[7100] + han[7101] + han[7102]
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    vocab, merges = brute.bpe_train(brute.segments(text), len(set(text)) + 3)
    tok = B.train(docs, len(set(text)) + 3)
    assert tok.vocab == vocab and tok.merges == merges
    row = B.decode(B.encode(docs, tok), tok).first()
    assert row["text"] == text
    assert list(row["ids"]) == brute.bpe_encode(brute.segments(text), vocab, merges, tok.n_base)


def test_whole_documents_as_pieces(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    vocab, merges = brute.bpe_train([t for t in TEXTS if t], 40)
    tok = B.train(docs, 40, segment="document")
    assert tok.vocab == vocab and tok.merges == merges
    got = {r["doc_id"]: list(r["ids"]) for r in B.encode(docs, tok, segment="document").collect()}
    assert got == {d: brute.bpe_encode([t], vocab, merges, tok.n_base) for d, t in enumerate(TEXTS)}


def test_forgetful_tasks_give_the_same_ids(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    tok = B.train(docs, 40)
    known = {r["doc_id"]: r["ids"] for r in B.encode(docs, tok).collect()}
    assert known == {r["doc_id"]: r["ids"] for r in B.encode(docs, tok, remembered=1).collect()}


def test_nulls_and_ids_outside_the_vocabulary(spark):
    docs = spark.createDataFrame([(0, "ab ab"), (1, None), (None, "")], "doc_id long, text string")
    tok = B.train(docs, 4)
    assert {r["doc_id"]: len(r["ids"]) for r in B.encode(docs, tok).collect()} == {0: 3, 1: 0, None: 0}
    ids = spark.createDataFrame([(0, [0, 1, -1, 99]), (1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["toks"] for r in B.id_tokens(ids, tok).collect()} == {0: [tok.vocab[0], tok.vocab[1], "", ""], 1: None, 2: []}
    assert {r["doc_id"]: r["text"] for r in B.decode(ids.where("doc_id > 0"), tok).collect()} == {1: None, 2: ""}
    with pytest.raises(Exception, match="out of vocabulary: -1"):
        B.decode(ids, tok).collect()


def test_lowest_rank_equals_all_merges_in_order():
    rng = random.Random(1)
    for _ in range(300):
        n, merges, known = 4, [], set()
        for _ in range(rng.randint(0, 25)):
            pair = rng.randrange(n), rng.randrange(n)
            if pair not in known:
                known.add(pair)
                merges.append((*pair, n, 1))
                n += 1
        ids = [rng.randrange(4) for _ in range(rng.randint(0, 60))]
        want = ids
        for a, b, new, _ in merges:
            want = brute.merge(want, a, b, new)
        assert lowest_rank(ids, {(a, b): (r, new) for r, (a, b, new, _) in enumerate(merges)}) == want


def test_thirty_thousand_merges(spark):
    """A vocabulary made of the corpus's own words, built up from the left: every prefix of a word is a token."""
    docs = spark.read.parquet(SF).select("doc_id", "text")
    words = [r["w"] for r in docs.select(F.explode(F.split("text", r"(?=\s)")).alias("w")).groupBy("w").count().orderBy(F.desc("count"), "w").limit(40_000).collect()]
    alphabet = sorted({r["c"] for r in docs.select(F.explode(F.split("text", "")).alias("c")).distinct().collect()})
    ids, merges = {c: i for i, c in enumerate(alphabet)}, []
    for w in words:
        for n in range(2, len(w) + 1):
            if w[:n] not in ids and w[: n - 1] in ids and w[n - 1] in ids:
                merges.append((ids[w[: n - 1]], ids[w[n - 1]], len(ids), 1))
                ids[w[:n]] = len(ids)
    tok = B.Tokenizer(list(ids), merges, len(alphabet))
    assert len(merges) > 30_000
    enc = B.encode(docs, tok, keep=("doc_id", "text"))
    assert "LocalTableScan" not in enc._jdf.queryExecution().toString() and "Exchange" not in enc._jdf.queryExecution().toString()
    back = B.decode(enc.withColumnRenamed("text", "orig"), tok)
    row = back.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("text") == F.col("orig")).cast("int")).alias("same"), F.sum(F.size("ids")).alias("ids"),
                   F.sum(F.length("text")).alias("chars")).first()
    assert row["n"] == row["same"] and row["ids"] < 0.45 * row["chars"]
    some = docs.orderBy("doc_id").limit(2).collect()
    got = {r["doc_id"]: list(r["ids"]) for r in B.encode(spark.createDataFrame(some), tok).collect()}
    for r in some:
        merged = []
        for piece in brute.segments(r["text"][:300]):
            symbols = [ids.get(c, 0) for c in piece]
            for a, b, new, _ in merges:
                if a in symbols and b in symbols:
                    symbols = brute.merge(symbols, a, b, new)
            merged += symbols
        keep = len(merged) - 12  # the cut may end inside a piece
        assert got[r["doc_id"]][:keep] == merged[:keep]


def test_ties_and_interacting_merges_match_brute(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab c") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    pieces = [p for t in texts for p in brute.segments(t)]
    vocab, merges = brute.bpe_train(pieces, len(set("".join(pieces))) + 60)
    tok = B.train(docs, len(set("".join(pieces))) + 60)
    assert tok.vocab == vocab and tok.merges == merges


def test_small_ranking_table_is_counted_again(spark, monkeypatch):
    monkeypatch.setattr(bpe_pairs, "TABLE_PAIRS", 5)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    pieces = [p for t in TEXTS for p in brute.segments(t)]
    size = len(set("".join(pieces))) + 12
    vocab, merges = brute.bpe_train(pieces, size)
    tok = B.train(docs, size)
    assert tok.vocab == vocab and tok.merges == merges


def test_unknown_character_maps_to_zero(spark):
    docs = spark.createDataFrame([(0, "abc")], "doc_id long, text string")
    tok = B.train(docs, 3)
    other = spark.createDataFrame([(1, "aQc")], "doc_id long, text string")
    assert list(B.encode(other, tok).first()["ids"]) == [0, 0, 2]


def test_vocab_smaller_than_alphabet_has_no_merge(spark):
    docs = spark.createDataFrame([(0, "abcabc")], "doc_id long, text string")
    tok = B.train(docs, 2)
    assert tok.merges == [] and tok.vocab == ["a", "b", "c"]


def test_batches_are_encoded_in_blocks(monkeypatch):
    import pyarrow as pa

    from glossa.operators import bpe_codec as C
    rows = [["ab", "ba"], None, [], ["abab"] * 5, ["b", "zz"], [], ["a"]]
    batch = pa.record_batch([pa.array(range(len(rows))), pa.array(rows, pa.list_(pa.string()))], ["doc_id", "_segs"])
    run = C.encoded(["a", "b"], [(0, 1, 2, 3)], 10)
    whole = pa.Table.from_batches(list(run(iter([batch]))))
    monkeypatch.setattr(C, "BLOCK_PIECES", 3)
    parts = list(run(iter([batch, batch.slice(2, 3), batch.slice(0, 0)])))
    assert max(p.num_rows for p in parts) <= 4 and len(parts) >= 5
    got = pa.Table.from_batches(parts)
    assert got.slice(0, len(rows)).to_pylist() == whole.to_pylist() and got.slice(len(rows)).to_pylist() == whole.slice(2, 3).to_pylist()
    assert whole["ids"].to_pylist() == [[2, 1, 0], [], [], [2, 2] * 5, [1, 0, 0], [], [0]]


def test_long_pieces_get_more_training_tasks(spark, monkeypatch):
    from glossa.operators import bpe as B
    assert B.loop_partitions(10, 10) == 1 and B.loop_partitions(10, 50 << 20) == 51 and B.loop_partitions(1_000_000, 0) == 5
    docs = spark.createDataFrame([(0, "abcabcabc abcab"), (1, "cabcabc" * 3)], "doc_id long, text string")
    plain = B.train(docs, 8)
    monkeypatch.setattr(B, "SYMBOLS_PER_PARTITION", 4)
    assert B.train(docs, 8) == plain

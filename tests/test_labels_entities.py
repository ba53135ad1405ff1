"""Labellers and BIO decoding against plain-Python brute force."""

import random

import pytest
from pyspark.sql import functions as F

from glossa.operators import labels as L
from glossa.operators.entities import extract_entities, extract_entities_chunked, ordered_distinct
from glossa.operators.tokens import tokenize
from glossa.operators.windows import context_chunks
from tests import brute

SENTENCES = [
    "Alice looked at the White Rabbit nervously.",
    "The Queen of Hearts was shouting at everyone.",
    "Humpty Dumpty sat on a wall near Wonderland.",
    "Alice and the Cheshire Cat had a strange conversation.",
]


def test_demo_sentences(spark):
    docs = spark.createDataFrame(list(enumerate(SENTENCES)), "doc_id long, text string")
    wide = L.label_arrays(tokenize(docs, "word"))
    wide = wide.select("doc_id", "toks", F.transform("lab", lambda x: x["l0"]).alias("labels"))
    got = {r["doc_id"]: r["entities"] for r in
           extract_entities(wide, sep=" ").groupBy("doc_id").agg(
               F.array_sort(F.collect_list(F.struct("ent_no", "entity"))).alias("e"))
           .select("doc_id", F.transform("e", lambda x: x["entity"]).alias("entities")).collect()}
    assert got == {0: ["White Rabbit"], 1: ["Queen", "Hearts"], 2: ["Dumpty", "Wonderland"], 3: ["Cheshire Cat"]}


@pytest.mark.parametrize("toks,labels,expected", [
    (["a", "b", "c"], [1, 2, 0], ["ab"]),
    (["a", "b"], [2, 2], []),
    (["a", "b", "c"], [1, 1, 2], ["a", "bc"]),
    (["a", "b", "a"], [1, 0, 1], ["a"]),
    ([], [], []),
])
def test_entity_fixtures(spark, toks, labels, expected):
    df = spark.createDataFrame([(0, toks, labels)], "doc_id long, toks array<string>, labels array<int>")
    got = [r["entity"] for r in ordered_distinct(df).orderBy("idx").collect()]
    assert got == expected


def test_entities_random_vs_brute(spark):
    rng = random.Random(7)
    rows = []
    for d in range(200):
        n = rng.randint(0, 12)
        rows.append((d, [rng.choice("abc") for _ in range(n)], [rng.choice([0, 1, 2, 2]) for _ in range(n)]))
    df = spark.createDataFrame(rows, "doc_id long, toks array<string>, labels array<int>")
    got = {}
    for r in extract_entities(df).collect():
        got.setdefault(r["doc_id"], []).append((r["ent_no"], r["start_pos"], r["end_pos"], r["entity"]))
    for d, toks, labels in rows:
        exp = brute.bio_entities(toks, labels)
        assert [g[1:] for g in sorted(got.get(d, []))] == [tuple(e) for e in exp], (toks, labels)


@pytest.mark.parametrize("length,block", [(1, 1), (1, 3), (2, 2), (3, 1), (5, 4), (64, 1024)])
def test_entities_by_chunks_equal_whole_documents(spark, length, block):
    rng = random.Random(length * 100 + block)
    rows = [(None, ["a", "b", "c"], [1, 2, 2]), (-1, [], []), (-2, ["x"] * 40, [1] + [2] * 39), (-3, ["x"] * 40, [2] * 40)]
    for d in range(150):
        n = rng.randint(0, 30)
        rows.append((d, [rng.choice("abc") for _ in range(n)], [rng.choice([0, 1, 2, 2, 2, 2]) for _ in range(n)]))
    df = spark.createDataFrame(rows, "doc_id long, toks array<string>, labels array<int>")
    chunks = context_chunks(df, length, labels="labels").withColumnRenamed("chunk", "toks").repartition(5)
    got = extract_entities_chunked(chunks, sep="+", block_chunks=block)
    cols = ["doc_id", "ent_no", "start_pos", "end_pos", "entity"]
    want = extract_entities(df, sep="+")
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, want.select(cols).collect()), key=str)


def test_chunks_of_uneven_length_hand_on_their_state(spark):
    rows = [(0, 0, 0, ["a", "b"], [0, 1]), (0, 1, 2, [], []), (0, 2, 2, ["c"], [2]), (0, 3, 3, ["d", "e", "f"], [2, 0, 2]), (0, 4, 6, ["g"], [2]), (0, 5, 7, ["h"], [1])]
    df = spark.createDataFrame(rows, "doc_id long, chunk_id int, start long, toks array<string>, labels array<int>")
    got = sorted(map(tuple, extract_entities_chunked(df, block_chunks=2).collect()))
    assert got == [(0, 0, 1, 3, "bcd"), (0, 1, 7, 7, "h")]
    none = extract_entities_chunked(df.where("doc_id > 0"))
    assert none.count() == 0


def test_heuristics_vs_brute(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    lab = L.heuristic_labels(tokenize(docs, "word"))
    got = {}
    for r in lab.collect():
        got.setdefault(r["doc_id"], {})[r["pos"]] = (r["l0"], r["l1"], r["l2"])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    all_toks = {d: brute.words(t) for d, t in texts.items()}
    cap = {}
    for toks in all_toks.values():
        for t in toks:
            if t[:1].isupper() and t.isalpha() and len(t) >= 4:
                cap[t] = cap.get(t, 0) + 1
    for d, toks in all_toks.items():
        l0 = brute.heuristic(toks, 1, strict_gt=True)
        l1 = brute.heuristic(toks, 1)
        l2 = brute.heuristic(toks, 4, cap_freq=cap, min_freq=2)
        g = got.get(d, {})
        assert [g[i] for i in range(len(toks))] == list(zip(l0, l1, l2))


def test_h2_entity_implies_h1_entity(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    lab = L.heuristic_labels(tokenize(docs, "word"))
    assert lab.filter((F.col("l2") > 0) & (F.col("l1") == 0)).count() == 0
    # every I follows a B or an I
    w = lab.select("doc_id", "pos", "l1").alias("a").join(
        lab.select("doc_id", F.col("pos").alias("p2"), F.col("l1").alias("prev")).alias("b"),
        (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("p2") == F.col("pos") - 1), "left")
    assert w.filter((F.col("l1") == 2) & ~(F.coalesce(F.col("prev"), F.lit(0)) > 0)).count() == 0


def test_one_labelling_is_that_of_the_label_arrays(spark):
    from glossa.operators import labels as L
    toks = ["Ana", "Mar", "fue", "A", "Bo", "C", "El", ".", "Luz", "Sol", "x1", "É", "Él"]
    wide = spark.createDataFrame([(0, toks), (1, []), (2, None), (3, toks[::-1])], "doc_id long, toks array<string>")
    both = {r["doc_id"]: r["lab"] for r in L.label_arrays(wide).select("doc_id", "lab").collect()}
    for which, field in (("auto", "l0"), ("h1", "l1")):
        for r in L.label_array(wide, which).collect():
            lab = both[r["doc_id"]]
            assert r["labels"] == (None if lab is None else [x[field] for x in lab])


def test_lines_are_cut_once(spark):
    import re

    from glossa.functions.patterns import LINE_RE, STRIP_RE
    from glossa.sources.corpus import line_source
    blanks = "\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"
    texts = ["a\r\n b \r\r\n\nc d\u2028e", "", " \n ", blanks, f"{blanks}x{blanks}y\u200b{blanks}", "plain", None, "\r\n", "é\x85\xa0ñ"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df = line_source(docs)
    python = lambda p: re.sub(r"\\x\{([0-9A-Fa-f]+)\}", r"\\u\1", p).replace(r"\z", r"\Z")
    want = []
    for i, t in enumerate(texts):
        if t is not None:
            lines = [x for x in (re.sub(python(STRIP_RE), "", x) for x in re.split(python(LINE_RE), t)) if x]
            want += [(i, n, x) for n, x in enumerate(lines or [t])]
    assert sorted(tuple(r) for r in df.collect()) == want
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1

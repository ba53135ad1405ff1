"""Operators that write and read: folders of text, annotation files, tokenizer, n-gram model, tagger, run records."""

import json
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from glossa.operators import agreement as A
from glossa.operators import bpe as B
from glossa.operators import labels as L
from glossa.operators import lm as M
from glossa.operators import sweep as SW
from glossa.operators import tagger as TG
from glossa.operators.entities import entities_from_long, extract_entities
from glossa.operators.alias import UNITS, alias_table
from glossa.operators.lookup import materialise, skew_join
from glossa.operators.tokens import tokenize
from glossa.sources import corpus as C
from glossa.sources import sinks as K

TEXTS = ["Then Alice saw the White Rabbit. He ran\tto the Queen of Hearts.", "The cat\nand the Cheshire Cat met Alice again.", "Once more the White Rabbit ran."]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_folder_of_texts(spark, docs, tmp_path):
    for i, t in enumerate(TEXTS):
        (tmp_path / f"{i}.txt").write_text(t, encoding="utf-8")
    (tmp_path / "note.md").write_text("no text file")
    rows = C.corpus_load(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"]) for r in rows] == list(enumerate(TEXTS))
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        C.corpus_load(spark, str(tmp_path / "none"))


def test_annotation_files(spark, docs, tmp_path):
    labelled = L.heuristic_labels(tokenize(docs, "word"))
    rows = K.annotated_tsv_rows(labelled)
    K.write_annotated_tsv(rows, str(tmp_path / "tsv"))
    back = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("escape", "").csv(str(tmp_path / "tsv"))
    as_text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, as_text.collect()))
    people = [{"id": "H1", "nombre": "wide", "descripcion": "d", "fecha": "2024-01-01", "responsable": "me"}, {"id": "H2", "nombre": "strict"}]
    K.write_annotation_metadata(K.annotation_metadata_rows(labelled, "p", "g", "s"), people, str(tmp_path / "json"))
    (line,) = [x for f in (tmp_path / "json").glob("part-*.json") for x in f.read_text().splitlines()]
    data = json.loads(line)
    assert data["anotadores"][0]["fecha"] == "2024-01-01" and data["anotadores"][1] == {"id": "H2", "nombre": "strict"}
    assert data["corpus"]["tokens_totales"] == labelled.count()
    assert set(data["corpus"]["H1"]["distribucion"]) == {"O", "B-ENT", "I-ENT"}


def test_tokenizer_tables(spark, docs, tmp_path):
    tok = B.train(docs, 40)
    K.tokenizer_save(tok.vocab_df(spark), tok.merges_df(spark), str(tmp_path / "tok"))
    vocab, merges, size = K.tokenizer_load(spark, str(tmp_path / "tok"))
    again = B.Tokenizer.load(vocab, merges)
    assert again == tok and size == len(tok.vocab)
    assert [r["ids"] for r in B.encode(docs, again).orderBy("doc_id").collect()] == [r["ids"] for r in B.encode(docs, tok).orderBy("doc_id").collect()]


def rows_of(docs):
    return tokenize(docs, "word").withColumn("split", F.lit("train"))


def test_saved_model_generates_the_same(spark, docs, tmp_path):
    model = M.ngram_fit(rows_of(docs), [1, 2])
    M.ngram_save(model, str(tmp_path / "ngram"))
    loaded = M.ngram_load(spark, str(tmp_path / "ngram"))
    assert (loaded.n1, loaded.vocab) == (model.n1, model.vocab)
    prompts = spark.createDataFrame([(1, ["the", "White"]), (2, ["nothing", "known"]), (3, [])], "prompt_id long, prompt array<string>")
    for make in (lambda m: M.generate_greedy(prompts, m, 1, 4), lambda m: M.generate_sample(prompts, m, 1, 4, seed=3)):
        assert sorted(map(str, make(model).collect())) == sorted(map(str, make(loaded).collect()))


def test_generation_broadcasts_its_state(spark, docs):
    model = M.ngram_fit(rows_of(docs), [1])
    prompts = spark.createDataFrame([(1, ["the"])], "prompt_id long, prompt array<string>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.generate_greedy(prompts, model, 1, 1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "RightOuter" not in plan


def test_parts_of_files_are_the_files(spark, tmp_path):
    texts = {"a.txt": "", "b.txt": "one\r\ntwo\n\n\nthree", "c.txt": "\n", "d.txt": "x", "e.txt": "".join(f"línea {i} ñ😀\n" for i in range(400)),
             "f.txt": "ü" * 5000 + "\n" + "short\n" + "y" * 3000, "g.txt": "end\n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "other.csv").write_text("no")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
        rows = C.corpus_load_parts(spark, str(tmp_path), 200).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    whole = {r["path"].split("/")[-1]: r["doc_id"] for r in C.corpus_load(spark, str(tmp_path)).collect()}
    for name, text in texts.items():
        mine = sorted((r for r in rows if r["path"].endswith(name)), key=lambda r: r["part"])
        assert "".join(r["text"] for r in mine) == text, name
        assert [r["part"] for r in mine] == list(range(len(mine))) and {r["doc_id"] for r in mine} == ({whole[name]} if text else set())
        assert all(len(r["text"].encode()) <= 2 * 2 * 200 for r in mine)
    assert sum(r["path"].endswith("e.txt") for r in rows) > 20
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        C.corpus_load_parts(spark, str(tmp_path / "none"))


def shares(rows):
    """The share of every token in a list's alias rows, in exact units."""
    out = {}
    for r in rows:
        out[r["token"]] = out.get(r["token"], 0) + r["cut"]
        out[r["alt"]] = out.get(r["alt"], 0) + r["units"] - r["cut"]
    return out


def test_alias_tables_hold_every_weight(spark):
    rng = random.Random(3)
    lists = {i: [rng.choice([1, 1, 2, 5, 100, 10 ** 6]) * rng.random() for _ in range(rng.choice([1, 2, 3, 17, 400]))] for i in range(30)}
    lists[30], lists[31] = [1.0] * 8, [1e-30, 1.0, 1e-30]
    entries = spark.createDataFrame([(i, f"t{j:03d}", q) for i, qs in lists.items() for j, q in enumerate(qs)], "ctx int, token string, q double")
    table = alias_table(entries, ["ctx"], "token", "q").collect()
    for i, qs in lists.items():
        rows = sorted((r for r in table if r["ctx"] == i), key=lambda r: r["slot"])
        n = len(qs)
        assert [r["slot"] for r in rows] == list(range(n)) and all(0 < r["cut"] <= r["units"] and r["n"] == n for r in rows)
        weights = [max(1, int(q / sum(qs) * UNITS)) for q in qs]
        got = shares(rows)
        assert all(abs(got[f"t{j:03d}"] - w * n) <= n * n for j, w in enumerate(weights)) and sum(got.values()) == n * rows[0]["units"]


def test_rare_token_stays_reachable(spark):
    counts = spark.createDataFrame([(1, ["x"], t, c, 20_000_000_000_003, c) for t, c in (("a", 1), ("b", 20_000_000_000_000), ("c", 1), ("d", 1))],
                                   "k int, ctx array<string>, token string, cnt bigint, ctx_cnt bigint, c1 bigint")
    model = M.NgramModel(counts, counts.select("k", "ctx", "ctx_cnt"), counts.select("token", "c1"), 20_000_000_000_003, 4)
    rows = M.sampling_table(model, 1, 1.0).collect()
    for ctx in ([], ["x"]):
        mine = shares([r for r in rows if r["ctx"] == ctx])
        assert sorted(mine) == ["a", "b", "c", "d"] and all(mine.values())


def test_a_step_of_sampling_reads_one_slot_and_shuffles_no_table(spark, docs):
    model = M.ngram_fit(rows_of(docs), [1])
    prompts = spark.createDataFrame([(1, ["the"]), (2, []), (3, ["never seen"])], "prompt_id long, prompt array<string>")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
            spark.conf.set(k, v)
        plan = M.generate_greedy(prompts, model, 1, 1, broadcast_rows=0)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SelectedBucketsCount" in plan
        scan = plan[plan.index("SelectedBucketsCount") - 2000 : plan.index("SelectedBucketsCount")]
        assert "Exchange" not in scan.split("SortMergeJoin")[-1].split("Exchange hashpartitioning(prompt_id")[0].rsplit("Sort [ctx", 1)[-1]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    few = M.generate_sample(prompts, model, 1, 3, seed=1, broadcast_rows=0).orderBy("prompt_id").collect()
    assert few == M.generate_sample(prompts, model, 1, 3, seed=1).orderBy("prompt_id").collect()
    known = {r["token"] for r in model.unigram.collect()}
    assert all(len(r["generated"]) == 3 and set(r["generated"]) <= known for r in few)


def test_lookup_of_weighted_keys_equals_plain_join(spark):
    facts = spark.createDataFrame([(i, f"k{min(i % 50, 9)}") for i in range(500)], "i int, key string")
    dim = spark.createDataFrame([(f"k{j}", 10 ** j) for j in range(8)], "key string, w bigint")
    plain = sorted(map(tuple, facts.join(dim, "key", "left").select("key", "i", "w").collect()), key=str)
    dim = materialise(dim)
    for shares in (1, 2, 100):
        got = skew_join(facts, dim, ["key"], "w", ["i"], max_rows=0, shares=shares).select("key", "i", "w").collect()
        assert sorted(map(tuple, got), key=str) == plain


def test_salted_labels_equal_broadcast_labels(docs):
    wide = tokenize(docs, "word")
    assert sorted(map(tuple, L.heuristic_labels(wide).collect())) == sorted(map(tuple, L.heuristic_labels(wide, broadcast_rows=0).collect()))


def test_labels_from_two_tables(spark):
    a = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (2, 0, 2)], "doc_id long, pos int, l1 int")
    b = spark.createDataFrame([(1, 0, 1), (2, 0, 0), (3, 0, 0)], "doc_id long, pos int, l2 int")
    assert sorted(map(tuple, A.label_align(a, b).collect())) == [(1, 0, 1, 1), (2, 0, 2, 0)]


def test_no_rows_have_no_kappa_reading(spark):
    none = spark.createDataFrame([], "l1 int, l2 int")
    row = A.cohen_kappa(none).first()
    assert row is None or (row["kappa"] is None and row["interpretation"] is None)


def test_saved_tagger_extracts_the_same(spark, docs, tmp_path):
    lab = L.label_arrays(tokenize(docs, "word"))
    wide = lab.select("doc_id", "toks", F.transform("lab", lambda x: x["l0"]).alias("labels"))
    rows = TG.feature_rows(wide)
    model, history = TG.tagger_fit(rows, max_iter=5, num_features=1 << 10)
    assert 1 < history.count() <= 6
    model.write().overwrite().save(str(tmp_path / "tagger"))
    loaded = PipelineModel.load(str(tmp_path / "tagger"))
    found = [sorted(map(tuple, entities_from_long(TG.tagger_predict(m, rows), "pred", sep=" ").collect())) for m in (model, loaded)]
    assert found[0] == found[1]


def test_entities_from_long_equal_arrays(spark):
    wide = spark.createDataFrame([(0, list("abcdefg"), [1, 2, 0, 2, 1, 1, 2]), (1, list("ab"), [0, 0]), (2, ["x"], [1])],
                                 "doc_id long, toks array<string>, labels array<int>")
    long = wide.select("doc_id", F.posexplode(F.arrays_zip("toks", "labels")).alias("pos", "z")).select("doc_id", "pos", F.col("z.toks").alias("token"), F.col("z.labels").alias("label"))
    a, b = extract_entities(wide), entities_from_long(long, "label")
    assert sorted(map(tuple, a.select(*sorted(a.columns)).collect())) == sorted(map(tuple, b.select(*sorted(a.columns)).collect()))


def test_sweep_of_order_four(spark, docs, tmp_path):
    runs = SW.sweep_runs(rows_of(docs), ["the"], [("deep", [("k1", 1, 10.0, 1), ("k4", 4, 10.0, 1)])], steps=2)
    SW.runs_sink(runs, str(tmp_path / "runs"))
    back = SW.runs_source(spark, str(tmp_path / "runs"))
    table = SW.loss_table(back)
    assert {f"train_{j}" for j in range(1, 5)} | {f"val_{j}" for j in range(1, 5)} <= set(table.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, runs.collect()))

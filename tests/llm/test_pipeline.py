"""Every stage on its own input, and the driver contract of the optional queries."""

import __spark_entry__ as E
import corpus_pipeline as P
from glossa.llm import exact_dedup, group_matrix, language_id
from glossa.llm.common import documents

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    ids = {r["doc_id"] for r in docs.collect()}
    told = {r["doc_id"]: r for r in language_id.language_id(docs).collect()}
    kept = P.language_stage(spark, docs, SF)
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in ids if told[i]["lang_pred"] != "und" and told[i]["score"] >= P.LEAST_SCORE}
    exact = P.exact_stage(spark, docs, SF)
    assert {r["doc_id"] for r in exact.collect()} == {r["doc_id"] for r in exact_dedup.exact_dedup(docs).collect() if r["kept"]}
    near = P.near_stage(spark, docs, SF)
    assert {r["doc_id"] for r in near.collect()} == {r["component_id"] for r in group_matrix.jaccard_components(docs).collect()}
    clean = P.benchmark_stage(spark, docs, SF)
    assert exact.columns == near.columns == clean.columns == columns
    bench = [r["text"] for r in documents(spark, SF, "benchmark").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = {r["doc_id"] for r in clean.collect()}
    assert all(not any(b in texts[i] for b in bench) for i in left)
    assert len(left) > 0.9 * len(ids)
    assert P.bpe_stage(spark, clean, SF).count() == len(left)


def test_odd_rows(spark, table):
    text = "the of and to in that is was for it with as his on be at by this had not " * 3
    docs = table([(1, text), (1, text), (2, text + " more"), (3, None), (4, ""), (None, text), (None, ""), (5, "12 34")])
    kept = P.exact_stage(spark, docs, SF)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [1, 2, 3, 5]
    kept = P.language_stage(spark, docs, SF)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 1, 2]
    kept = P.near_stage(spark, table([(1, text), (None, text + " x"), (None, "some other words here now"), (None, ""), (7, "")]), SF)
    assert sorted(((r["doc_id"] or 0), (r["text"] or "")[:4]) for r in kept.collect()) == [(0, ""), (0, "some"), (1, "the "), (7, "")]
    empty = docs.where("false")
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_near_copies_without_own_ids(spark, table):
    text = "the of and to in that is was for it with as his on be at by this had not"
    other = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text), (None, text + " x"), (3, other), (3, other + " y"), (3, "some other words here now"), (None, "a fourth text of few words")]
    kept = [(r["doc_id"], r["text"].split()[0]) for r in P.near_stage(spark, table(rows), SF).collect()]
    assert sorted(kept, key=str) == sorted([(None, "the"), (3, "w0"), (3, "some"), (None, "a")], key=str)


def test_run(spark):
    docs = documents(spark, SF)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    a = sorted((r["doc_id"], r["ids_sha256"]) for r in docs.collect())
    assert a == sorted((r["doc_id"], r["ids_sha256"]) for r in P.run(spark, SF).collect())


def test_any_column_names(spark, table):
    text = "the of and to in that is was for it with as his on be at by this had not "
    docs = table([(1, text * 3), (1, text * 3), (2, text * 2 + "but some of the words are new here"), (None, None), (4, "one two three")])
    for name in ("_id", "_text", "_dropped", "_dropped_text", "text_key", "_TEXT_", "ids"):
        docs = docs.withColumn(name, docs["word"])
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns and {r["_dropped"] for r in kept.collect()} == {"w"}, name
    assert P.STAGES[-1][1](spark, docs, SF).count() == 5


def test_finished_tables_are_deleted(spark):
    import os

    from glossa.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    P.run(spark, SF).count()
    left = [d for d in set(os.listdir(folder)) - before if not d.startswith("rdd-")]
    assert sum(d.startswith("pipeline-") for d in left) == 1 and len(left) < 8


def test_registered():
    names = {n.split("_")[0] for n in E.queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in E.queries()
    assert set(E.oracle_sql()) <= set(E.queries())

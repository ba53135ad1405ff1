"""op5: held-out ranking on the given table, obfuscated words, and edge cases."""

import zlib

from glossa.llm import toxicity
from glossa.llm.common import documents

SF = "/root/testdata/sf0.1"


def test_held_out_ranking(spark):
    docs, labels = documents(spark, SF), documents(spark, SF, "labels")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    toxic, clean = [s for s, t in held if t], [s for s, t in held if not t]
    auc = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.95
    assert sum(r["predicted"] for r in rows if truth.get(r["doc_id"]) == 0) < 0.03 * len(truth)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_features():
    lexicon = toxicity.Lexicon.of(["stupid", "idiot"], ["weak"])
    f = dict(zip(toxicity.FEATURES, toxicity.features_of("You are a st*pid 1d10t, stuuupid! GO AWAY idiot", lexicon)))
    assert f["masked_hits"] > 1 and f["strong"] > 0 and f["near_you"] > 0 and f["shouted"] > 0 and f["masked"] > 0
    assert toxicity.features_of("", lexicon) == toxicity.features_of(None, lexicon) == [0.0] * len(toxicity.FEATURES)
    assert dict(zip(toxicity.FEATURES, toxicity.features_of("plain words 12 3", lexicon)))["masked_hits"] == 0


def test_edges(table, spark):
    rows = [(0, None), (1, ""), (2, "word " * 100_000), (3, "text"), (3, "text"), (None, "text")]
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(table(rows), empty).collect()
    assert len(out) == len(rows) and {r["score"] for r in out} == {0.0}
    odd = spark.createDataFrame([(3, 1, None), (None, 1, 1), (2, 0, 1), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert len(toxicity.toxicity(table(rows), odd).collect()) == len(rows)
    assert toxicity.toxicity(spark.createDataFrame([], "doc_id long, text string"), empty).count() == 0

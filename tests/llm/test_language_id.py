"""op2: held-out accuracy on the given table, back-off and edge cases."""

import re
import zlib

from glossa.llm import language_id
from glossa.llm.common import documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = documents(spark, SF)
    truth = {r["doc_id"]: r for r in docs.select("doc_id", "lang", "text").collect()}
    rows = language_id.language_id(docs).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    right = [r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held if re.search(r"[^\W\d_]", truth[r["doc_id"]]["text"] or "")]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_unseen_words_back_off(table):
    train = table([(i, "the thing that", "en") for i in range(20)] + [(100 + i, "straße größe übung", "de") for i in range(20)])
    model = language_id.fit(train)
    assert language_id.score_text("größte", model, {})[0] == "de"
    assert language_id.score_text("thang thath", model, {})[0] == "en"
    assert language_id.backoff("größ", model) is not None and language_id.backoff("漢字", model) is None
    lang, score = language_id.score_text("漢字", model, {})
    assert (lang, score) == ("de", 0.5)


def test_small_language_keeps_its_share(table):
    """A large language with more words than the bound doesn't displace a small one's, and n-grams come from all words."""
    letters = "abcdefghij"
    many = [" ".join(f"{a}{b}{c}{d}" for d in letters) for a in letters for b in letters for c in letters]
    rows = [(i, f"{text} {text} {text}", "en") for i, text in enumerate(many)] + [(5000, "zwölf öfen müßig größe", "de"), (5001, "k" * 60 + "ß", "de")]
    model = language_id.fit(table(rows), max_words=400, max_grams=60)
    assert {"zwölf", "öfen", "müßig", "größe"} <= set(model.words) and 300 < len(model.words) < 500
    assert {"zwö", "größ", "müßig"} <= set(model.grams) and {"kkkkk", "kkkß$"} <= set(model.grams)
    assert all(20 < sum(len(g) == order for g in model.grams) < 100 for order in range(2, 6))
    assert language_id.score_text("zwölf größe", model, {})[0] == "de"


def test_n_grams_of_unknown_words(table):
    train = table([(i, "der die das " * 40, "de") for i in range(5)] + [(50, "straße größe", "de")] + [(60 + i, "the of and " * 40, "en") for i in range(5)])
    model = language_id.fit(train, max_words=6)
    assert len(model.words) == 6 and "straße" not in model.words
    assert "traße" in model.grams and language_id.score_text("straßen", model, {})[0] == "de"


def test_edges(table, spark):
    rows = [(0, "the word " * 50_000), (1, None), (2, ""), (3, "123 ... 456"), (4, "the word"), (4, "the word"), (None, "the word"), (5, "Wort und Wort", "de"),
            (6, "the word", None), (7, "die Wort und", "de"), (8, "x" * 100_000)]
    out = language_id.language_id(table(rows)).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert by[1]["lang_pred"] == by[2]["lang_pred"] == by[3]["lang_pred"] == "und" and by[3]["score"] == 0.0
    assert by[4]["lang_pred"] == by[6]["lang_pred"] == by[None]["lang_pred"] == "en"
    assert language_id.language_id(table([(1, "text", None)])).first()["lang_pred"] == "und"
    assert language_id.language_id(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_numbers_are_no_letters():
    assert language_id.words_of("² ½ ① Ⅷ 12 _ 〇") == []
    assert language_id.words_of("x² Ünï½cödé ß-ǅ 日本 ªº") == ["x", "ünï", "cödé", "ß", "ǆ", "日本", "ªº"]
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x30000)]))
    assert "".join(language_id.words_of(every)) == "".join(c for c in every.lower() if c.isalpha())

"""op9: links between records, digests, and files that come back record by record."""

import hashlib

from glossa.llm import warc_derive

HTML = "<html><head><title>A &amp; B</title><script>var x='<p>';</script></head><body><nav><a href=\"/x\">X</a></nav><!-- gone --><p>One &lt;two&gt;</p><br>three\n\n  four</body></html>"
ROWS = [(1, "http://a/b", HTML), (2, None, None), (3, "http://c/\r\nEvil: 1", "plain"), (4, "http://d", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"), (5, "http://e", "ü" * 100_000),
        (5, "http://e", "ü" * 100_000), (None, "http://f", "<p>unclosed <b")]


def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "'x' AS block", "'y' AS type", "'z' AS record_id").repartition(2)


def test_records(spark):
    records = warc_derive.derive(warc_derive.responses(pages(spark))).collect()
    assert len(records) == 2 * len(ROWS)
    by = {(r["page_id"], r["type"]): r for r in records}
    text = by[1, "conversion"]
    assert text["block"] == "X\nOne <two>\nthree\nfour"
    assert text["source_digest"] == "sha256:" + hashlib.sha256(HTML.encode()).hexdigest()
    meta = by[1, "metadata"]
    assert meta["refers_to"] == text["refers_to"] and meta["other_id"] == text["record_id"] and text["other_id"] == meta["record_id"]
    assert '"title":"A & B"' in meta["block"] and '"links":["/x"]' in meta["block"] and meta["refers_to"] in meta["block"]
    assert by[2, "conversion"]["block"] == "" and by[3, "metadata"]["target_uri"] == "http://c/%0D%0AEvil: 1"
    assert len({r["refers_to"] for r in records}) == len(ROWS) - 1


def test_digests_read_back(spark):
    rows = warc_derive.derivative_digest(pages(spark)).collect()
    assert len(rows) == 2 * len(ROWS) and all(r["intact"] for r in rows)


def test_files_round_trip(spark, tmp_path):
    records = warc_derive.record_text(warc_derive.derive(warc_derive.responses(pages(spark))))
    for kind in ("gzip", "none"):
        path = str(tmp_path / kind)
        warc_derive.write_warc(records, path, kind)
        back = warc_derive.read_warc(spark, path)
        assert sorted(r["record"] for r in back.collect()) == sorted(r["record"] for r in records.collect())
        parsed = warc_derive.parsed(back.selectExpr("file AS page_id", "record")).collect()
        assert all(hashlib.sha256(r["block"].encode()).hexdigest() == r["block_digest"][7:] for r in parsed)


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_derive.derivative_digest(none).count() == 0

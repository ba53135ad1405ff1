"""WARC derivatives: linked metadata and plain-text conversion records from response records.

Every response gives two records.  *Metadata* holds, as JSON, the source's headers, its digests and what its HTML says about itself
(title, links); *conversion* holds the plain text.  Both carry their own record id, ``WARC-Refers-To`` with the response's id,
``WARC-Refers-To-Target-URI`` and ``-Date``, the response's payload digest, and the digest of their own block; the metadata also names the
conversion (``WARC-Concurrent-To``), and the conversion the metadata.  Record ids of derivatives are UUIDs from a hash of the response's id and the type, so a
lost and repeated task writes the same records.

All row by row, without a shuffle.  ``write_warc`` lets Spark's text writer end each record with the two line ends that WARC asks for;
``read_warc`` reads files by their ``Content-Length``, whatever the blocks hold.

Defined results: null html or url counts as empty; line ends in a url are percent-encoded; unclosed comments, scripts and tags are kept as text up to
what closes them; a null key stays null, and its response id comes from url and html alone; repeated rows give repeated records with equal ids; an
empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
VERSION = "WARC/1.1"
END = "\r\n\r\n"

#: (pattern, replacement) in order; patterns mean the same in Java and RE2.
CLEANING = [
    (r"(?s)<!--.*?-->", " "),
    (r"(?is)<script\b[^>]*>.*?</script\s*>", " "),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", " "),
    (r"(?is)<head\b[^>]*>.*?</head\s*>", " "),
    (r"(?i)<(?:/?(?:p|div|br|li|ul|ol|h[1-6]|article|section|nav|header|footer|table|tr|td|body|html)\b)[^>]*>", "\n"),
    (r"<[!/a-zA-Z][^>]*>", ""),
]
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
SPACES = [(r"[ \t\r\f]+", " "), (r" ?\n[ \n]*", "\n")]
TITLE = r"(?is)<title\b[^>]*>(.*?)</title"
LINK = r'(?i)<a\s[^>]*href="([^"]*)"'


def _entities(text: Column) -> Column:
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def plain_text(html: Column) -> Column:
    for pattern, to in CLEANING:
        html = F.regexp_replace(html, pattern, to)
    html = _entities(html)
    for pattern, to in SPACES:
        html = F.regexp_replace(html, pattern, to)
    return F.trim(html, F.lit(" \n"))


def _uuid(key: Column) -> Column:
    h = F.sha2(key, 256)
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame, key: str = "page_id", date: str = DATE) -> DataFrame:
    """``key`` and a response's ``record_id, target_uri, date, http_headers`` (ordered text), ``payload`` and digests from crawled pages."""
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    uri = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html), F.lit("\r\n"))
    return (pages.select(key, uri.alias("target_uri"), F.lit(date).alias("date"), headers.alias("http_headers"), html.alias("payload"))
            .withColumn("payload_digest", _digest(F.col("payload")))
            .withColumn("block_digest", _digest(F.concat("http_headers", F.lit("\r\n"), "payload")))
            .withColumn("record_id", _uuid(F.concat_ws("\n", F.col(key).cast("string"), "target_uri", "block_digest"))))


def derive(source: DataFrame, key: str = "page_id") -> DataFrame:
    """Two records per response: ``key, type, record_id, refers_to, other_id, target_uri, date, content_type, source_digest, block``."""
    ids = {t: _uuid(F.concat("record_id", F.lit("\n" + t))) for t in ("metadata", "conversion")}
    about = F.to_json(F.struct(
        F.col("record_id").alias("refers_to"), "target_uri", "date", "http_headers", "payload_digest", "block_digest",
        F.octet_length("payload").alias("payload_length"), F.trim(_entities(F.regexp_extract("payload", TITLE, 1)), F.lit(" \n")).alias("title"),
        F.regexp_extract_all("payload", F.lit(LINK), F.lit(1)).alias("links")))

    def record(kind: str, other: str, content: str, block: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), ids[kind].alias("record_id"), F.col("record_id").alias("refers_to"), ids[other].alias("other_id"),
                        "target_uri", "date", F.lit(content).alias("content_type"), F.col("payload_digest").alias("source_digest"), block.alias("block"))

    both = F.array(record("metadata", "conversion", "application/json", about), record("conversion", "metadata", "text/plain; charset=utf-8", plain_text(F.col("payload"))))
    return source.select(key, F.explode(both).alias("r")).select(key, "r.*")


def record_text(records: DataFrame, key: str = "page_id") -> DataFrame:
    """``key, type, record``: a record's text without its last two line ends."""
    fields = [("WARC-Type", F.col("type")), ("WARC-Record-ID", F.col("record_id")), ("WARC-Date", F.col("date")), ("WARC-Target-URI", F.col("target_uri")),
              ("WARC-Refers-To", F.col("refers_to")), ("WARC-Refers-To-Target-URI", F.col("target_uri")), ("WARC-Refers-To-Date", F.col("date")),
              ("WARC-Concurrent-To", F.col("other_id")), ("WARC-Payload-Digest", F.col("source_digest")), ("WARC-Block-Digest", _digest(F.col("block"))),
              ("Content-Type", F.col("content_type")), ("Content-Length", F.octet_length("block").cast("string"))]
    head = F.concat(F.lit(VERSION + "\r\n"), *[F.concat(F.lit(name + ": "), value, F.lit("\r\n")) for name, value in fields])
    return records.select(key, "type", F.concat(head, F.lit("\r\n"), "block").alias("record"))


def parsed(records: DataFrame, key: str = "page_id") -> DataFrame:
    """``key`` and the fields and block of ``record`` texts."""
    at = F.instr("record", END)
    head = F.substr("record", F.lit(1), at + 1)

    def field(name: str) -> Column:
        return F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)", 1)

    return records.select(
        key, field("WARC-Type").alias("type"), field("WARC-Record-ID").alias("record_id"), field("WARC-Refers-To").alias("refers_to"),
        field("WARC-Concurrent-To").alias("other_id"), field("WARC-Refers-To-Target-URI").alias("target_uri"), field("WARC-Payload-Digest").alias("source_digest"),
        field("WARC-Block-Digest").alias("block_digest"), field("Content-Length").cast("long").alias("content_length"), F.substr("record", at + 4).alias("block"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip", rows_per_file: int = 20_000) -> None:
    """WARC files in a folder: each record, then two line ends."""
    (records.select("record").write.option("lineSep", END).option("compression", compression)
     .option("maxRecordsPerFile", rows_per_file).text(path))


def _records_in(data: bytes) -> Iterator[bytes]:
    at = 0
    while (at := data.find(VERSION.encode(), at)) >= 0:
        stop = data.index(END.encode(), at) + 4
        length = next(int(line.split(b":", 1)[1]) for line in data[at:stop].split(b"\r\n") if line.lower().startswith(b"content-length:"))
        yield data[at : stop + length]
        at = stop + length


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``file, record`` of all records of the files of a folder, cut by their ``Content-Length``; a task holds one file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b["path"].to_pylist(), b["content"]):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                found = [r.decode() for r in _records_in(data)]
                yield pa.record_batch([pa.array([name] * len(found), pa.string()), pa.array(found, pa.string())], ["file", "record"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, record string")


def derivative_digest(pages: DataFrame) -> DataFrame:
    """Per derivative, read back from the record's text: its links and digests, and whether its block has the digest and length it states."""
    back = parsed(record_text(derive(responses(pages))))
    return back.select("page_id", "type", "record_id", "refers_to", "other_id", "target_uri", "source_digest", "block_digest", "content_length",
                       ((_digest(F.col("block")) == F.col("block_digest")) & (F.octet_length("block") == F.col("content_length"))).alias("intact"))


def _sql_replace(expr: str, steps: list[tuple[str, str]], regex: bool) -> str:
    for a, b in steps:
        a, b = a.replace("'", "''"), "chr(10)" if b == "\n" else "'" + b.replace("'", "''") + "'"
        expr = f"regexp_replace({expr}, '{a}', {b}, 'g')" if regex else f"replace({expr}, '{a}', {b})"
    return expr


_SQL_TEXT = "trim(" + _sql_replace(_sql_replace(_sql_replace("html", CLEANING, True), ENTITIES, False), SPACES, True) + ", ' ' || chr(10))"
_SQL_TITLE = "trim(" + _sql_replace(f"regexp_extract(html, '{TITLE}', 1)", ENTITIES, False) + ", ' ' || chr(10))"


def _sql_uuid(key: str) -> str:
    h = f"sha256({key})"
    return f"'<urn:uuid:' || concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), substr({h}, 17, 4), substr({h}, 21, 12)) || '>'"


ORACLE = f"""
WITH p AS (
  SELECT page_id, replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS uri, coalesce(html, '') AS html FROM pages
),
h AS (
  SELECT *, 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
    || 'Content-Length: ' || octet_length(encode(html)) || chr(13) || chr(10) AS headers, 'sha256:' || sha256(html) AS payload_digest FROM p
),
b AS (SELECT *, 'sha256:' || sha256(headers || chr(13) || chr(10) || html) AS bd FROM h),
i AS (SELECT *, {_sql_uuid("concat_ws(chr(10), page_id::VARCHAR, uri, bd)")} AS rid FROM b),
d AS (
  SELECT *, {_sql_uuid("rid || chr(10) || 'metadata'")} AS mid, {_sql_uuid("rid || chr(10) || 'conversion'")} AS cid,
    {_SQL_TEXT} AS plain,
    to_json(struct_pack(refers_to := rid, target_uri := uri, date := '{DATE}', http_headers := headers, payload_digest := payload_digest, block_digest := bd,
      payload_length := octet_length(encode(html)), title := {_SQL_TITLE}, links := regexp_extract_all(html, '{LINK}', 1)))::VARCHAR AS meta
  FROM i
),
r AS (
  SELECT page_id, 'metadata' AS type, mid AS record_id, rid AS refers_to, cid AS other_id, uri AS target_uri, payload_digest AS source_digest, meta AS block FROM d
  UNION ALL SELECT page_id, 'conversion', cid, rid, mid, uri, payload_digest, plain FROM d
)
SELECT page_id, type, record_id, refers_to, other_id, target_uri, source_digest, 'sha256:' || sha256(block) AS block_digest,
  octet_length(encode(block)) AS content_length, true AS intact
FROM r
"""

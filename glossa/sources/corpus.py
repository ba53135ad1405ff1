"""Corpus readers: documents, text folders, concatenation, preferred source, prefix, union, lines.

The source project holds its corpus as one Python string.  Here a corpus is
a DataFrame with one row per document; nothing is ever joined into one
corpus-wide string.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossa.functions.patterns import LINE_BREAK
from glossa.functions.text import explode_rows, strip_ws
from glossa.operators.lookup import materialise
from glossa.operators.windows import global_exclusive_sum, global_row_number

DOC_SEP = "\n\n"


def ensure_parallelism(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Spread a scan that arrived in fewer partitions than task slots.

    Large inputs are already split by the file reader, so this is a no-op at
    scale; small files with few row groups get a hash repartition by ``key``.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots, key)
    return df


def read_documents(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = ("doc_id", "text"),
                   spread: bool = True) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).select(*columns)
    return ensure_parallelism(df) if spread else df


def corpus_load(spark: SparkSession, path: str) -> DataFrame:
    """Read every ``*.txt`` file of a folder: ``(doc_id, path, text)``, doc_id in path order.

    Raises when no file matches, as the source does.
    """
    raw = (spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", False).text(path, wholetext=True)
           .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))
    if raw.isEmpty():
        raise FileNotFoundError(f"no .txt files found in {path}")
    return global_row_number(raw, ["path"], "doc_id").select("doc_id", "path", "text")


PART_BYTES = 1 << 20  # of a text that one row holds, about


def corpus_load_parts(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Every ``*.txt`` file of a folder in parts: ``(doc_id, path, part, text)``, doc_id as in ``corpus_load``.

    Spark plans the files as byte ranges and reads them line by line, so a file of any size is read by many tasks and no row holds more than
    about ``part_bytes``: lines of a range are joined up to that size, a longer line is cut between characters.  The parts of a file, in order, are the
    file again, line ends included (apart from a byte order mark).  An empty file has no parts.
    """
    def reader():
        return spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", False)

    # Lists them; no content is read.  Empty files are no documents, as in ``corpus_load``.
    files = reader().format("binaryFile").load(path).select("path", "length").where("length > 0")
    if files.isEmpty():
        raise FileNotFoundError(f"no .txt files found in {path}")
    docs = materialise(global_row_number(files, ["path"], "doc_id"))
    lines = reader().option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("i"),
        F.concat("value", F.lit("\n")).alias("line"))
    before = Window.partitionBy("path", "start").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length("line")
    chunk = F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / part_bytes).alias("chunk")
    pieces = F.when(size <= part_bytes, F.array("line")).otherwise(F.regexp_extract_all("line", F.lit(f"(?s).{{1,{part_bytes}}}"), 0))
    cut = lines.select("path", "start", "i", chunk, F.posexplode(pieces).alias("piece", "text"))
    # The window has dealt the lines by range already; grouping by range and more keeps them there.
    parts = cut.groupBy("path", "start", "chunk", "piece").agg(F.array_sort(F.collect_list(F.struct("i", "text"))).alias("t"))
    parts = materialise(parts.select("path", "start", "chunk", "piece", F.array_join(F.transform("t", lambda x: x["text"]), "").alias("text")))
    of = Window.partitionBy("path")
    order = of.orderBy("start", "chunk", "piece")
    bounds = parts.select("path", "start", "chunk", "piece", F.octet_length("text").alias("bytes")).select(
        "path", "start", "chunk", "piece", (F.row_number().over(order) - 1).alias("part"), F.sum("bytes").over(of).alias("all"),
        F.lead("chunk").over(order).isNull().alias("last"))
    out = parts.join(bounds, ["path", "start", "chunk", "piece"]).join(docs, "path")
    # A last line without a line end has been given one above.
    text = F.when(F.col("last") & (F.col("all") > F.col("length")), F.regexp_replace("text", "\n\\z", "")).otherwise(F.col("text"))
    return out.select("doc_id", "path", "part", text.alias("text")).where("text != ''")


def corpus_concat(parts: DataFrame, key: str = "conv_id", order: str = "turn", text: str = "text",
                  sep: str = DOC_SEP) -> DataFrame:
    """Join the texts of each group with ``sep`` in ``order``.

    Only for naturally bounded groups (a conversation); a whole-corpus string
    is never built.  Partial aggregation collects per task before the shuffle.
    """
    pieces = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return parts.groupBy(key).agg(
        F.array_join(F.transform(pieces, lambda x: x["t"]), sep).alias("text"),
        F.count(F.lit(1)).cast("bigint").alias("n_parts"))


def corpus_preferred_source(candidates: DataFrame, key: str, priority: str,
                            tie: tuple[str, ...] = (), value: str = "text") -> DataFrame:
    """Per key, the candidate with the smallest ``(priority, tie...)``.

    ``min_by`` over a struct is a partial/final aggregate: a key with many
    candidates is reduced on the map side, never gathered in one task.
    """
    ordering = F.struct(F.col(priority).alias("p"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie)])
    best = F.min_by(F.struct(F.col(priority).alias("_p"), *[F.col(c) for c in tie], F.col(value).alias("_v")),
                    ordering)
    return (candidates.groupBy(key).agg(best.alias("_b"))
            .select(key, F.col("_b._p").alias(priority), *[F.col(f"_b.{c}").alias(c) for c in tie],
                    F.col("_b._v").alias(value)))


def corpus_prefix(docs: DataFrame, n_chars: int, order: str = "doc_id", text: str = "text") -> DataFrame:
    """The first ``n_chars`` characters of the corpus in ``order``: whole documents, then a cut one.

    The character offset of each document is a global exclusive sum (range
    partitions + one row per partition), never an un-partitioned window.  Only
    the lengths take part in it; the texts of the few kept documents are joined.
    """
    sized = docs.select(order, F.length(text).cast("bigint").alias("_len"))
    off = global_exclusive_sum(sized, [order], "_len", "char_offset")
    kept = docs.select(order, text).join(off.filter(F.col("char_offset") < n_chars), order)
    take = F.least(F.col("_len"), F.lit(n_chars) - F.col("char_offset")).cast("int")
    return kept.select(order, "char_offset", F.substring(F.col(text), 1, take).alias(text))


def corpus_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, conversation turns and benchmark items as one bag of texts ``(src, doc_id, part, text)``."""
    rd = lambda n: spark.read.parquet(os.path.join(sf_dir, f"{n}.parquet"))
    zero = F.lit(0).alias("part")
    docs = rd("documents").select(F.lit("documents").alias("src"), F.col("doc_id"), zero, "text")
    conv = rd("conversations").select(F.lit("conversations").alias("src"), F.col("conv_id").alias("doc_id"),
                                      F.col("turn").cast("int").alias("part"), "text")
    bench = rd("benchmark").select(F.lit("benchmark").alias("src"), F.col("item_id").alias("doc_id"), zero, "text")
    return docs.unionByName(conv).unionByName(bench)


def line_source(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Non-empty stripped lines ``(keep, line_no, line)``; a text with none is kept whole as one line.

    The lines are a column of their own, so that they are cut once.  A text is cut at single characters: between those of a two-character
    line end lies an empty line, which goes with the others.
    """
    lines = F.filter(F.transform(F.split(F.col(text), LINE_BREAK, -1), strip_ws), lambda x: x != "")
    cut = docs.select(*dict.fromkeys((*keep, text)), lines.alias("_lines"))
    chosen = F.when(F.size("_lines") == 0, F.array(F.col(text))).otherwise(F.col("_lines"))
    return (explode_rows(cut, chosen, keep, "line", "line_no")
            .select(*keep, F.col("line_no").cast("int").alias("line_no"), "line"))

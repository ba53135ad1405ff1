"""Writers: annotated TSV, annotation metadata JSON, tokenizer tables.

Each writer has a pure projection (``*_rows``) that the registered queries
return, and a ``write_*`` that persists it with Spark's own file sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa.functions.text import kappa_interpretation, label_name, tsv_escape
from glossa.functions.patterns import KAPPA_PREFIX, LABEL_NAMES
from glossa.operators.agreement import cohen_kappa

def annotated_tsv_rows(labelled: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep, token_id (the position), token (escaped), etiqueta_H1, etiqueta_H2``."""
    return labelled.select(*keep, F.col("pos").cast("int").alias("token_id"),
                           tsv_escape("token").alias("token"),
                           label_name("l1").alias("etiqueta_H1"), label_name("l2").alias("etiqueta_H2"))


def write_annotated_tsv(rows: DataFrame, path: str) -> None:
    """Tab-separated text with a header, sorted by position inside each file, no quoting."""
    (rows.sortWithinPartitions("doc_id", "token_id").write.mode("overwrite")
     .option("sep", "\t").option("header", True).option("quote", "").option("escape", "")
     .csv(path))


def annotation_metadata_rows(labelled: DataFrame, project: str = "", group: str = "",
                             source: str = "") -> DataFrame:
    """One row: token total, per-labeler entity count and distribution, kappa block."""
    n = F.count(F.lit(1)).cast("bigint")
    dist = []
    for lab, name in (("l1", "H1"), ("l2", "H2")):
        dist.append(F.count_if(F.col(lab) > 0).cast("bigint").alias(f"{name}_tokens_entidad"))
        for i, ln in enumerate(LABEL_NAMES):
            dist.append(F.count_if(F.col(lab) == i).cast("bigint").alias(f"{name}_{ln.replace('-', '_')}"))
    counts = labelled.agg(n.alias("tokens_totales"),
                          F.count_if(F.col("l1") != F.col("l2")).cast("bigint").alias("tokens_en_desacuerdo"),
                          *dist)
    k = cohen_kappa(labelled).select(F.col("kappa"))
    one = counts.withColumn("_k", F.lit(1)).join(k.withColumn("_k", F.lit(1)), "_k", "left").drop("_k")
    return one.select(
        F.lit(project).alias("proyecto"), F.lit(group).alias("grupo"), F.lit(source).alias("fuente"),
        "*",
        F.round("kappa", 4).alias("kappa_cohen"),
        F.concat(F.lit(KAPPA_PREFIX), kappa_interpretation(F.col("kappa"))).alias("interpretacion"),
        F.round(F.try_divide(100.0 * F.col("tokens_en_desacuerdo"), F.col("tokens_totales")), 2)
        .alias("porcentaje_desacuerdo"),
    ).drop("kappa")


ANNOTATOR_FIELDS = ("id", "nombre", "descripcion", "fecha", "responsable")


def annotation_metadata_struct(flat: DataFrame, annotators: list[dict[str, str]]) -> DataFrame:
    """Nest the flat row into the published JSON layout (one row, one struct column per block).

    ``annotators``: the texts that describe each labeler, by ``ANNOTATOR_FIELDS``; a missing one is null.
    """
    ann = F.array(*[F.struct(*[F.lit(a.get(f)).cast("string").alias(f) for f in ANNOTATOR_FIELDS]) for a in annotators])

    def block(name):
        return F.struct(F.col(f"{name}_tokens_entidad").alias("tokens_entidad"),
                        F.struct(*[F.col(f"{name}_{ln.replace('-', '_')}").alias(ln) for ln in LABEL_NAMES])
                        .alias("distribucion"))

    return flat.select(
        "proyecto", "grupo", ann.alias("anotadores"),
        F.struct(F.col("fuente"), F.col("tokens_totales"), block("H1").alias("H1"), block("H2").alias("H2"))
        .alias("corpus"),
        F.array(*[F.lit(x) for x in LABEL_NAMES]).alias("esquema_etiquetas"),
        F.struct("kappa_cohen", "interpretacion", "tokens_en_desacuerdo", "porcentaje_desacuerdo")
        .alias("acuerdo_inter_anotador"),
    )


def write_annotation_metadata(flat: DataFrame, annotators: list[dict[str, str]], path: str) -> None:
    annotation_metadata_struct(flat, annotators).coalesce(1).write.mode("overwrite").json(path)


# --- tokenizer tables -----------------------------------------------------------

VOCAB_SCHEMA = T.StructType([T.StructField("token_id", T.IntegerType()), T.StructField("token", T.StringType())])
MERGES_SCHEMA = T.StructType([
    T.StructField("rank", T.IntegerType()), T.StructField("left_id", T.IntegerType()),
    T.StructField("right_id", T.IntegerType()), T.StructField("new_id", T.IntegerType()),
    T.StructField("pair_count", T.LongType()),
])


def tokenizer_save(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    vocab.select("token_id", "token").write.mode("overwrite").parquet(f"{path}/vocab")
    merges.select(*MERGES_SCHEMA.fieldNames()).write.mode("overwrite").parquet(f"{path}/merges")


def tokenizer_load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, int]:
    """Vocabulary, merges and the restored ``vocab_size`` (= number of vocabulary rows)."""
    vocab = spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocab")
    merges = spark.read.schema(MERGES_SCHEMA).parquet(f"{path}/merges")
    return vocab, merges, vocab.count()

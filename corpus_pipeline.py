"""From raw documents to encoded training text, stage by stage.

Each stage gets the documents that its predecessor kept, written as Parquet and read again, and all
but the last return the columns of documents. In every stage but the last, a NULL doc_id, an empty
text or a repeated row is treated as the stage's operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repovitals.llm.language_id import fit_languages, held_out, identify
from repovitals.llm.line_dedup import dedup_lines
from repovitals.llm.mixture import mix_to_weights
from repovitals.llm.piece_nbest import encode_nbest
from repovitals.llm.queries import mix_levels, mix_weights
from repovitals.llm.set_join import jaccard_groups
from repovitals.llm.storage import stored, workspace

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Share of the tokens that the mixture keeps, in percent.
MIX_PERCENT = 75


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the models know; those that they reject go."""
    known = identify(docs, fit_languages(docs.where(~held_out())))
    return known.where("accepted").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of documents before them; one that only had such lines goes."""
    kept = dedup_lines(docs)
    gone = (F.col("n_dropped") > 0) & (F.col("n_dropped") == F.col("n_lines"))
    return kept.where(~gone).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document of least id, once.

    A row is told from others by doc_id and text together: of rows of one doc_id only those whose texts are in
    a group of an earlier one go, and rows without id are in groups like all others, after those with one.
    """
    folder = workspace(spark)
    keyed = docs.select(*COLUMNS).withColumn("row_key", F.xxhash64("doc_id", "text"))
    groups = jaccard_groups(keyed.select(F.col("row_key").alias("doc_id"), "text"), k=5, percent=80)
    groups = groups.select(F.col("doc_id").alias("row_key"), F.col("component_id").alias("group")).distinct()
    ids = keyed.select("row_key", "doc_id").distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    first = ids.join(stored(groups, f"{folder}/groups"), "row_key").groupBy("group").agg(F.min_by("row_key", order).alias("row_key"))
    kept = stored(first.select("row_key"), f"{folder}/kept")
    return keyed.join(kept, "row_key", "left_semi").dropDuplicates(["row_key"]).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the target weights, none twice."""
    return mix_to_weights(docs, mix_levels(), mix_weights(), percent=MIX_PERCENT).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document's best segmentation, and the scores of its four best."""
    return encode_nbest(docs, n=4).select("doc_id", "lang", "source", "piece_ids", "n_pieces", "scores")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("pieces", pieces),
]

#: Language models and the search for segmentations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"{folder}/{name}")
    return docs

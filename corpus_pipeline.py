"""Five stages that make a training set of the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last keep the columns of documents (doc_id, text, lang, source, n_chars).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, mixing, neardup, pieces, pii, quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learnt from the labels, doesn't reject."""
    rules = quality.train(docs, common.read(spark, sf_dir, "labels"), quality.held_out(F.col("doc_id")))
    return quality.score(docs, rules).where(F.col("score") >= quality.CUT).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return neardup.one_of_each(docs).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken (documents without words, which weigh nothing, once at most)."""
    sized = common.settle(docs.withColumn("size", mixing.words(F.col("text"))).withColumn("u", mixing.draw(F.col("doc_id"), F.col("text"))).select("doc_id", "source", "size", "u"), "sizes")
    copies = mixing.mix(sized).groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size")).agg(F.max("copies").alias("copies"))
    sizes = docs.withColumn("size", mixing.words(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    taken = sizes.join(copies.where("copies > 0"), same)
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each text, its source, and whether they decode to it."""
    both = pieces.round_trip(docs.select("doc_id", "source", "text"))
    return both.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_pieces"), F.col("text").eqNullSafe(F.col("decoded")).alias("lossless"))


STAGES = [
    ("quality", select_quality),
    ("near_copies", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("mix", mix_sources),
    ("pieces", encode_pieces),
]

#: No stage but the mix can be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.settle(stage(spark, docs, sf_dir), name)
    return docs

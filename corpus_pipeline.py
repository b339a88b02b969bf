"""A corpus from raw documents to packed sequences: toxicity, near duplicates, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of documents, except the last, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyflow.llm import chosen_path, mixing, packing, secret_scan, toxicity
from canopyflow.llm._common import Scratch

_KEY = "__text_key"


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_KEY, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def _once(docs: DataFrame, *by: str) -> DataFrame:
    """docs without rows that repeat these columns; shuffled only if there are any."""
    return docs if docs.groupBy(*by).count().where("count > 1").isEmpty() else docs.dropDuplicates(list(by))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_documents(docs, model, name="__score").where("__score < 0.5").drop("__score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of the n-gram Jaccard join the document with the least id stays."""
    kept = chosen_path.jaccard_join(docs).where("kept").select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).distinct()
    keyed = _once(_with_key(docs), "doc_id", _KEY)
    return keyed.join(kept, keyed.doc_id.eqNullSafe(F.col("__doc")) & (F.col(_KEY) == F.col("__hash")), "left_semi").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in the text; every document stays."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it: its row is repeated, or goes."""
    mixed = mixing.mix_sources(docs, prefix="__mix_").where("__mix_copies > 0")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_copies")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, each with its place in a sequence of at most 2048."""
    return packing.pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("jaccard_join", drop_near_copies), ("secret_scan", redact_secrets), ("mixing", mix), ("packing", pack)]
#: No stage before the last can be told in SQL: a fitted model, sketches and a genetic algorithm decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each written as Parquet and read again as the next one's docs."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs

"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayscope.llm import bytebpe, pieces
from stayscope.llm.mixture import mix_documents
from stayscope.llm.pieces import encode_pieces
from stayscope.llm.probminhash import one_per_class
from stayscope.llm.quality import keep_good
from stayscope.llm.toxicity import drop_toxic
from stayscope.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_class(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs, bytebpe.vocabulary_path(), exact=True)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_pieces(docs, pieces.vocabulary_path())


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("near-duplicates", near_duplicates),
    ("mixture", mixture),
    ("sentence pieces", sentence_pieces),
]

#: Learned scores, sketches and piece paths have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every stage but the last is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

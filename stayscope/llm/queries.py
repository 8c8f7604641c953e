"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.llm import bytebpe, pieces
from stayscope.llm.edits import cleaned_counts
from stayscope.llm.forest import nearest
from stayscope.llm.hilbert import shard_documents
from stayscope.llm.hosts import judge_urls
from stayscope.llm.idfiles import id_file_round
from stayscope.llm.infill import infill_table
from stayscope.llm.mixture import mixture_table
from stayscope.llm.oracles import ORACLES
from stayscope.llm.pieces import encode_pieces
from stayscope.llm.prefixtrie import prefix_trie
from stayscope.llm.probminhash import near_duplicate_classes
from stayscope.llm.quality import quality_table
from stayscope.llm.repeats import without_repeats
from stayscope.llm.toxicity import toxicity_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def forest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after its cleaning edits."""
    docs = table(spark, sf_dir, "documents")
    return cleaned_counts(docs, bytebpe.vocabulary_path()).drop("leaf_chars", "tree")


def probability_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode_pieces(docs, pieces.vocabulary_path()).drop("ids")


def raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_table(table(spark, sf_dir, "documents"), bytebpe.vocabulary_path(), exact=True)


def ranked_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_file_round(table(spark, sf_dir, "documents"), bytebpe.vocabulary_path())


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_table(table(spark, sf_dir, "documents"))


def page_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the quality labels of the documents that the pages became."""
    outcomes = table(spark, sf_dir, "labels").filter(F.col("quality").isNotNull()).select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad")
    )
    return judge_urls(table(spark, sf_dir, "pages"), outcomes)


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what is left of every document without its repeated passages."""
    return without_repeats(table(spark, sf_dir, "documents")).drop("spans")


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def infilled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's output and of the text rebuilt from it."""
    return infill_table(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity_instances": toxicity_scores,
    "op2_prefix_forest": forest_neighbours,
    "op3_edit_token_counts": edited_token_counts,
    "op4_probminhash_classes": probability_minhash,
    "op5_hilbert_shards": hilbert_shards,
    "op6_aho_viterbi_pieces": piece_ids,
    "op7_raked_mixture": raked_mixture,
    "op8_ranked_id_files": ranked_id_files,
    "op9_quality_rules": quality_rules,
    "op10_host_reputation": page_verdicts,
    "op11_merged_bwt_repeats": repeated_passages,
    "op12_parenthesis_trie": conversation_trie,
    "op13_secondary_sort_infill": infilled_texts,
}

__all__ = ["ORACLES", "QUERIES"]

"""The training corpus in five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmill.llm import linedup, mixing, ngramjoin, packing, perplexity
from newsmill.session import apply_runtime_conf, materialize


ROW = "_row"


def with_row(docs: DataFrame) -> DataFrame:
    """``docs`` with an identity of every row: its id (null ids last) and a digest of all columns.  Rows of one identity are
    copies of each other; rows without an id, and different texts under one id, are rows of their own."""
    return docs.withColumn(ROW, F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64(*docs.columns).alias("digest")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the perplexity band of their language."""
    rows = with_row(docs)
    return perplexity.keep_quality(rows, perplexity.quality_rules(rows, ROW, symbols="characters"), ROW).drop(ROW)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines; those of which no word is left go."""
    cut = linedup.delete_repeated_lines(with_row(docs), key=ROW)
    cut = cut.where((F.col("removed_lines") == 0) | F.col("text").rlike(linedup.WORD))
    return cut.withColumn("n_chars", F.when(F.col("removed_lines") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near duplicates: the one with the smallest id, by its digest where ids tie or are null."""
    rows = with_row(docs)
    return ngramjoin.one_per_component(rows, ngramjoin.ngram_jaccard(rows, ROW), ROW).drop(ROW)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their target weights."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in length buckets and batches."""
    return packing.pack(packing.word_lengths(docs))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("ngram_jaccard", ngram_jaccard),
          ("mix_sources", mix_sources), ("pack", pack)]

ORACLE_SQL = None  # n-gram models and the reachability of near duplicates are no SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    apply_runtime_conf(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs

"""Registered queries of the training-data operators, over the driver tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from newsmill.llm import (chat, grading, licenses, linedup, mixing, ngramjoin, packing, perplexity, repair, substrings, vectorcodes, vectorjoin,
                          warc)
from newsmill.session import apply_runtime_conf, materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_runtime_conf(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures, base verdict and the verdict of the perplexity bands for every document."""
    out = perplexity.quality_rules(_table(spark, sf_dir, "documents"), symbols="characters")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "lang", "log_perplexity", "lowest", "highest")


def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to seekable bundles and read back from them."""
    folder = warc.bundle_folder(spark)
    index = warc.write_bundles(_table(spark, sf_dir, "pages"), folder)
    return warc.read_bundles(spark, folder, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.95."""
    return vectorjoin.near_vectors(_table(spark, sf_dir, "embeddings"), 0.95)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines of later repeated runs deleted."""
    return linedup.delete_repeated_lines(_table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document at Jaccard 0.75 on five-word shingles."""
    return ngramjoin.ngram_jaccard(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of sentences that earlier documents or places have, and the spans cut out of it."""
    out = substrings.remove_repeated_units(_table(spark, sf_dir, "documents"))
    span = F.transform("removed", lambda s: F.concat_ws(":", *[s[c].cast("string") for c in ("start", "end", "kept_doc_id", "kept_start")]))
    return out.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), F.array_join(span, " ").alias("removed_spans"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every piece of every document."""
    return packing.pack(packing.word_lengths(_table(spark, sf_dir, "documents")))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from every formatted conversation, and from one that holds control strings."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", chat.CONTROL_TEXT), (-1, 1, "assistant", chat.CONTROL_TEXT)], rows.schema)
    return chat.conversation_digests(chat.format_conversations(rows.unionByName(probe)))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, probability of the best grade and selection for every document."""
    labels = grading.grades(_table(spark, sf_dir, "labels"))
    return grading.grade_documents(_table(spark, sf_dir, "documents"), labels)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document when sources are mixed 3 : 1 : 2 in turn, to 150 % of all words, at most twice."""
    out = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest audit and digest of the repaired rows of every conversation after known damage."""
    rows = repair.damage(_table(spark, sf_dir, "conversations"))
    return repair.audit_digests(repair.repair_conversations(rows, present="present"))


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases, licence labels and score of every document."""
    out = licenses.license_labels(licenses.scan_licenses(_table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and error of every clean vector, with the digest of the codebooks fitted on all of them."""
    vectors = _table(spark, sf_dir, "embeddings")
    books = vectorcodes.fit_codebooks(vectors)
    coded = materialize(vectorcodes.encode(vectors, books, keep=("label",)))
    return vectorcodes.label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(vectorcodes.codebook_digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules, "op2_warc_bundles": op2_warc_bundles, "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_line_dedup": op4_line_dedup, "op5_ngram_jaccard": op5_ngram_jaccard, "op6_substring_dedup": op6_substring_dedup,
    "op7_packing": op7_packing, "op8_chat_formatting": op8_chat_formatting, "op9_quality_classifier": op9_quality_classifier,
    "op10_mixing": op10_mixing, "op11_conversation_repair": op11_conversation_repair, "op12_license_scans": op12_license_scans,
    "op13_vector_codes": op13_vector_codes, "pipeline": corpus_pipeline.run}

ORACLES: dict[str, str] = {"op2_warc_bundles": warc.WARC_SQL, "op8_chat_formatting": chat.CHAT_SQL, "op10_mixing": mixing.MIX_SQL,
                           "op11_conversation_repair": repair.REPAIR_SQL, "op13_vector_codes": vectorcodes.CODES_SQL}

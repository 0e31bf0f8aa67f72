"""Optimal length buckets and token-budget batches.

The lengths of all pieces form one histogram (bounded by ``max_length`` entries); dynamic programming over it finds the
bucket bounds with the least padding; batches of ``token_budget`` tokens form inside each bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from newsmill.llm.textarrays import chunks
from newsmill.session import materialize

ROWS_PER_BLOCK = 50_000


def best_bounds(lengths: np.ndarray, counts: np.ndarray, n_buckets: int) -> list[int]:
    """Upper bounds of at most ``n_buckets`` buckets with the least total padding, each row padded to its bound.

    ``lengths`` ascending and distinct.  best[k][j] is the least cost of the first j lengths in k buckets; the cost of
    a bucket i..j is bound * rows - tokens, from two running sums."""
    m = len(lengths)
    if m == 0:
        return []
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(float)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(float)
    n_buckets = min(n_buckets, m)
    best = np.full(m + 1, np.inf)
    best[0] = 0.0
    choice = np.zeros((n_buckets + 1, m + 1), np.int32)
    for k in range(1, n_buckets + 1):
        now = np.full(m + 1, np.inf)
        for j in range(k, m + 1):
            cost = best[k - 1:j] + lengths[j - 1] * (rows[j] - rows[k - 1:j]) - (tokens[j] - tokens[k - 1:j])
            i = int(np.argmin(cost))
            now[j], choice[k, j] = cost[i], i + k - 1
        best = now
    out, j = [], m
    for k in range(n_buckets, 0, -1):
        out.append(int(lengths[j - 1]))
        j = choice[k, j]
    return out[::-1]


def _word_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            n = np.concatenate([c.n_words for c in chunks(b.column(1))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])


def word_lengths(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens): words of each whole text."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _word_lengths, f"doc_id {kind}, n_tokens long")


def pieces(lengths: DataFrame, max_length: int) -> DataFrame:
    """Cut documents longer than ``max_length`` into consecutive pieces; nothing is dropped."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.lit(max_length).cast("long"))
    p = lengths.where("n_tokens > 0").select("doc_id", "n_tokens", F.posexplode(starts).alias("piece", "start"))
    return p.select("doc_id", F.col("piece").cast("long"), "start",
                    F.least(F.lit(max_length), F.col("n_tokens") - F.col("start")).cast("long").alias("length"))


def bucket_of(length: str, bounds: list[int]) -> Column:
    """Index of the first bound that holds the length (``bounds`` has at most n_buckets entries)."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col(length))).cast("long")


def pack(lengths: DataFrame, n_buckets: int = 16, max_length: int = 4096, token_budget: int = 65_536,
         seed: int = 11) -> DataFrame:
    """Assign every piece of every document to a bucket and a batch.

    ``lengths`` has (doc_id, n_tokens).  Returns (doc_id, piece, start, length, bucket, padded_length, batch_id, slot):
    tokens ``start : start + length`` of the document, padded to ``padded_length``; a batch of bucket b has at most
    max(1, token_budget // padded_length) pieces, in a seeded order, and only the last batch of a bucket may be short.
    The driver sees the histogram only, at most ``max_length`` rows.

    Places inside a bucket are numbered in blocks of about ROWS_PER_BLOCK rows whose counts are carried forward, so no
    task holds a bucket.  Documents without tokens (null or empty texts) have no piece; repeated rows and null keys are
    packed like others; an empty table gives an empty result."""
    p = materialize(pieces(lengths, max_length))
    histogram = sorted((r["length"], r["n"]) for r in p.groupBy("length").agg(F.count("*").alias("n")).collect())
    bounds = best_bounds(np.array([x for x, _ in histogram], np.int64), np.array([n for _, n in histogram], np.int64), n_buckets) or [max_length]
    blocks = -(-sum(n for _, n in histogram) // ROWS_PER_BLOCK) or 1
    order = F.xxhash64(F.lit(seed), "doc_id", "piece")
    p = p.withColumn("bucket", bucket_of("length", bounds)).withColumn("_order", order)
    p = p.withColumn("_block", F.pmod(F.shiftright("_order", 20), F.lit(blocks)))
    counts = p.groupBy("bucket", "_block").agg(F.count("*").alias("_n"))
    before = W.partitionBy("bucket").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = W.partitionBy("bucket", "_block").orderBy("_order", "doc_id", "piece", "length")
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    p = p.join(counts, ["bucket", "_block"]).withColumn("_place", F.col("_before") + F.row_number().over(inside) - 1)
    p = p.withColumn("padded_length", F.element_at(table, (F.col("bucket") + 1).cast("int")))
    per = F.greatest(F.lit(1).cast("long"), F.expr(f"{token_budget}L div padded_length"))
    p = p.withColumn("_per", per).withColumn("_batch", F.expr("_place div _per"))
    return p.select("doc_id", "piece", "start", "length", "bucket", "padded_length",
                    F.format_string("b%02d-%08d", "bucket", "_batch").alias("batch_id"), F.expr("_place % _per").alias("slot"))

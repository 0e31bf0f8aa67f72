"""Mixing sources to target weights by capped water-filling.

Each source has a weight and may be repeated at most ``max_epochs`` times.  Where a proportional share exceeds that,
it is clamped and the excess goes to the others by weight, until none is above.  The result of that iteration has a
closed form: with sources ordered by cap / weight the clamped ones are a prefix, so one running sum decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from newsmill.session import materialize

ROWS_PER_BLOCK = 5_000


def word_count(text: str | Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, source: str, weights: list[float]) -> DataFrame:
    """Give the sources, ordered by code point with null last, the weights in turn.  ``sources`` has a row per source;
    the numbering is one sorted pass over that small dimension."""
    n = F.row_number().over(W.orderBy(F.col(source).asc_nulls_last())) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.element_at(table, (n % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, size: str, weight: str, budget_share: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to a table with a row per source: shares of ``budget_share`` times the total size, in proportion
    to the weights, none above ``max_epochs`` times the source's size.  Sources of size 0 get 0.  When the budget
    exceeds what all sources can give, every source is at its cap."""
    cap = F.col(size) * F.lit(float(max_epochs))
    order = W.orderBy("_ratio", "_cap", weight)
    upto, whole = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = sources.withColumn("_cap", cap).withColumn("_ratio", F.col("_cap") / F.col(weight))
    # the level that would be left if all sources before this one were clamped
    s = (s.withColumn("_budget", F.sum(size).over(whole) * F.lit(float(budget_share)))
         .withColumn("_left", F.col("_budget") - (F.sum("_cap").over(upto) - F.col("_cap")))
         .withColumn("_weights", F.sum(weight).over(whole) - (F.sum(weight).over(upto) - F.col(weight)))
         .withColumn("_level", F.col("_left") / F.col("_weights"))
         .withColumn("_clamped", F.col("_ratio") <= F.col("_level")))
    s = s.withColumn("_fill", F.max(F.when(~F.col("_clamped"), F.col("_level"))).over(whole))
    level = F.coalesce(F.least(F.col("_cap"), F.col(weight) * F.col("_fill")), F.col("_cap"))
    return s.withColumn("target", level).drop(*[c for c in s.columns if c.startswith("_")])


def seeded_rank(key: Column, text: Column, seed: int) -> Column:
    """A text that orders rows pseudo-randomly and equally in every run, rows without a key too: it follows from key and text."""
    whole = F.md5(F.coalesce(text, F.lit("")))
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|"), whole, F.lit(f"|{seed}")))


def mix_sources(docs: DataFrame, weights: list[float] = (3.0, 1.0, 2.0), budget_share: float = 1.5,
                max_epochs: float = 2.0, seed: int = 7, key: str = "doc_id", text: str = "text",
                source: str = "source", row: str | None = None) -> DataFrame:
    """How often each document goes into the mix.

    Returns (key, source, size, source_size, target, epochs, copies, taken), and the column ``row`` if one is named.  A source wanted ``e`` times gives every document
    floor(e) times, and the documents that come first in a seeded order once more, until the fraction is reached (the
    one at the edge is in when more than half of it fits), so a source misses its target by half a document at most
    and no document is taken more than ceil(e) <= max_epochs times.

    The seeded order of a source is cut into blocks by the first bits of the hash; block totals are summed first and
    carried forward, so a source holding a third of all rows is spread over as many tasks as its rows need.

    Null or empty texts have size 0 and are taken 0 times over; null sources are one source, last; rows without a key, of a shared key and repeated rows are ranked
    like others, by key and text (rows that agree in both are interchangeable; the sums stay exact).  Texts are read once.
    Columns beyond the named ones are ignored; an empty table gives an empty result."""
    own = [F.col(row).alias("_row")] if row else []
    d = materialize(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                                seeded_rank(F.col(key), F.col(text), seed).alias("_order"), *own))
    sources = water_fill(cyclic_weights(d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")),
                                        "source", list(weights)), "source_size", "weight", budget_share, max_epochs)
    sources = (sources.withColumn("epochs", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
               .withColumn("_whole", F.floor("epochs"))
               .withColumn("_goal", F.col("target") - F.col("_whole") * F.col("source_size"))
               .withColumn("_blocks", F.ceil(F.col("n_docs") / ROWS_PER_BLOCK))
               .select("source", "source_size", "target", "epochs", "_whole", "_goal", "_blocks"))
    d = d.join(sources, d.source.eqNullSafe(sources.source)).drop(sources.source)
    # seven hex digits as a fraction of 16^7 choose the block, so blocks follow the order
    place = F.conv(F.substring("_order", 1, 7), 16, 10).cast("long")
    d = d.withColumn("_block", F.floor(place * F.col("_blocks") / F.lit(16**7)))
    sums = d.groupBy("source", "_block").agg(F.sum("size").alias("_in"))
    w = W.partitionBy("source").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("_s"), F.col("_block").alias("_b"),
                       F.coalesce(F.sum("_in").over(w), F.lit(0)).alias("_before"))
    d = d.join(sums, d.source.eqNullSafe(sums._s) & (d._block == sums._b))
    inside = W.partitionBy("source", "_block").orderBy("_order", "size").rowsBetween(W.unboundedPreceding, 0)
    end = F.col("_before") + F.sum("size").over(inside)
    extra = F.col("_goal") - (end - F.col("size")) > F.col("size") / 2
    copies = (F.col("_whole") + extra.cast("long")).cast("long")
    return d.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.col("_whole").cast("long"))).select(
        "doc_id", "source", "size", "source_size", "target", "epochs", "copies", (F.col("size") * F.col("copies")).alias("taken"),
        *[F.col("_row").alias(row) for _ in own])


def apply_mix(docs: DataFrame, mix: DataFrame, key: str = "doc_id") -> DataFrame:
    """Repeat each row as often as the mix says; rows taken 0 times go.  ``key`` names the rows of ``docs`` and is doc_id in ``mix``, or the row column of both; rows that share
    it are repeated alike, by the largest of their numbers, so pass a row number where ids are missing or shared."""
    own = mix.select(F.col(key if key in mix.columns else "doc_id").alias("_key"), F.col("copies").alias("_copies")).groupBy("_key").agg(F.max("_copies").alias("_copies")).where("_copies > 0")
    rows = docs.join(own, F.col(key).eqNullSafe(F.col("_key")))
    return rows.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each repeated or left out by its own number, whatever its id.  The options are those of :func:`mix_sources`."""
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()))
    return apply_mix(rows, mix_sources(rows, row="_row", **options), "_row").drop("_row")


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  md5(COALESCE(CAST(doc_id AS VARCHAR), '') || '|' || md5(COALESCE(text, '')) || '|7') AS ord FROM documents),
s0 AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
              [3.0, 1.0, 2.0][CAST((ROW_NUMBER() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS INTEGER) + 1]::DOUBLE AS weight
       FROM d GROUP BY source),
-- pour in turns: a source leaves the pool once its cap is below its share at the level of those that remain
s1 AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio FROM s0),
s2 AS (SELECT *, (1.5::DOUBLE * (SELECT SUM(source_size) FROM s1)
                  - COALESCE((SELECT SUM(b.cap) FROM s1 b WHERE b.ratio < a.ratio), 0))
               / (SELECT SUM(b.weight) FROM s1 b WHERE b.ratio >= a.ratio) AS level FROM s1 a),
s3 AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE LEAST(cap, weight * COALESCE(
                  (SELECT MAX(level) FROM s2 c WHERE c.ratio > c.level), 1e300)) END AS target FROM s2),
s4 AS (SELECT *, CASE WHEN source_size > 0 THEN FLOOR(target / source_size) ELSE 0 END AS whole FROM s3),
r AS (SELECT d.doc_id, d.size, s4.source_size, s4.target, s4.whole, s4.target - s4.whole * s4.source_size AS goal,
             SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before
      FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source)
SELECT doc_id, size, source_size, ROUND(target, 4) AS target,
       CAST(size * (whole + CASE WHEN goal - before > size / 2.0 THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""

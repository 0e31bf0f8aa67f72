"""Line deduplication by windows of lines, with DataFrame functions only.

A text is its sequence of lines that hold a word.  A window is a stretch of lines with at least ``min_words`` words that is
the smallest such stretch ending at its last line, or the smallest one starting at its first line.  Shrink a run of at
least ``min_words`` words around one of its lines as far as the words allow, and a window is left; so every run is the union
of the windows inside it, its first and last lines included.  Whether a stretch is a window follows from its lines alone,
so equal stretches are windows alike: a window repeats an earlier stretch just when the earliest window of the same content
lies elsewhere.  The lines of all such windows are deleted; no match has to be extended."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from newsmill.session import materialize

WORD = r"[^\x20\x09-\x0D]+"


def text_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line_no, pos, hash, words, upto): the lines that hold a word.  ``line_no`` counts all lines of the text,
    ``pos`` these lines only, ``upto`` the words up to and with the line."""
    rows = docs.select(F.col(key).alias("doc_id"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))
    rows = rows.select("doc_id", "line_no", F.xxhash64("line").alias("hash"), F.regexp_count("line", F.lit(WORD)).alias("words")).where("words > 0")
    rows = rows.repartition("doc_id").distinct()
    w = W.partitionBy("doc_id").orderBy("line_no", "hash").rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("pos", F.count("*").over(w)).withColumn("upto", F.sum("words").over(w))


def line_windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, first, last, content): every window once, with a hash of its lines in order."""
    lines = lines.withColumn("start", F.col("upto") - F.col("words"))
    ends = W.partitionBy("doc_id").orderBy("upto")
    # lines whose end is less than min_words words back: one line fewer would be too short
    back = ends.rangeBetween(-(min_words - 1), 0)
    ahead = W.partitionBy("doc_id").orderBy("start").rangeBetween(0, min_words - 1)
    out = lines.select("doc_id", "pos", "start", "upto",
                       F.struct(F.min("pos").over(back).alias("first"), F.col("pos").alias("last"),
                                F.xxhash64(F.collect_list("hash").over(back)).alias("content")).alias("ending"),
                       F.struct(F.col("pos").alias("first"), F.max("pos").over(ahead).alias("last"),
                                F.xxhash64(F.collect_list("hash").over(ahead)).alias("content")).alias("starting"),
                       F.max("upto").over(ahead).alias("reach"))
    ending = F.when(F.col("upto") >= min_words, F.col("ending"))
    # without its first line still long enough: the smallest from its start on, but no smallest to its end
    starting = F.when(F.col("reach") - F.col("upto") >= min_words, F.col("starting"))
    return out.select("doc_id", F.explode(F.array(ending, starting)).alias("w")).where("w IS NOT NULL").select("doc_id", "w.*")


def repeated_runs(lines: DataFrame, min_words: int = 50) -> DataFrame:
    """(doc_id, first, last): stretches of lines whose windows repeat an earlier place, by (doc_id, position).  ``lines``
    comes from :func:`text_lines`."""
    windows = materialize(line_windows(lines, min_words))
    earliest = windows.groupBy("content").agg(F.min(F.struct("doc_id", "first")).alias("at"), F.count("*").alias("n")).where("n > 1")
    later = windows.join(earliest.drop("n"), "content").where(~F.struct("doc_id", "first").eqNullSafe(F.col("at")))
    # windows that overlap or touch are one stretch
    before = W.partitionBy("doc_id").orderBy("first", "last").rowsBetween(W.unboundedPreceding, -1)
    opens = F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True)).cast("int")
    sofar = W.partitionBy("doc_id").orderBy("first", "last").rowsBetween(W.unboundedPreceding, 0)
    marked = later.select("doc_id", "first", "last", opens.alias("opens")).withColumn("stretch", F.sum("opens").over(sofar))
    return marked.groupBy("doc_id", "stretch").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("stretch")


def delete_repeated_lines(docs: DataFrame, min_words: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines of later repeated runs deleted, and ``removed_lines`` (long).

    A run is a stretch of consecutive lines (lines without words are passed over and never deleted) with at least
    ``min_words`` words that equals a stretch starting earlier: in a document with a smaller key, or before it in the
    same document.  Every line of such a run goes.  Documents are told apart by ``key`` and a hash of the text, and ranked so, null keys
    last: rows without a key and different texts of one key are documents of their own; rows that agree in both are one document and come back alike.  Null and empty texts come back as they are, with 0; so do texts under
    ``min_words`` words.  Extra columns are kept; ``removed_lines`` and names starting with ``_`` must be free; an empty
    table gives an empty result."""
    docs = docs.withColumn("_doc", F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), F.xxhash64(text).alias("digest")))
    lines = materialize(text_lines(docs, "_doc", text))
    runs = repeated_runs(lines, min_words)
    places = runs.select("doc_id", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
    gone = (places.join(lines.select("doc_id", "pos", "line_no"), ["doc_id", "pos"]).groupBy(F.col("doc_id").alias("_gone_key"))
            .agg(F.collect_set("line_no").alias("_gone")))
    rows = docs.join(gone, F.col("_doc") == F.col("_gone_key"), "left").drop("_gone_key", "_doc")
    own = F.split(F.col(text), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col("_gone"))
    cut = F.array_join(F.transform(left, lambda i: F.get(own, i)), "\n")
    return (rows.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(cut))
            .withColumn("removed_lines", F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long")).drop("_gone"))

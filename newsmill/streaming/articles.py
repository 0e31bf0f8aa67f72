"""Structured Streaming versions of the polling jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from newsmill.functions import text as X
from newsmill.operators.merge import append_new, merge_into_table, replace_partitions
from newsmill.plans.news import is_breaking
from newsmill.session import materialize


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int = 1000, **options) -> DataFrame:
    """Landing folder as a stream; ``max_files`` bounds one micro-batch."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files).options(**options).load(path)


def stream_dedup(articles: DataFrame, key="url", ts: str = "published_on", delay: str = "2 hours") -> DataFrame:
    """Drop re-sent articles (``key``: a column or a list of them); state is kept only for the watermark span, rows later than it are dropped too.  Lasting uniqueness belongs to the
    table (:func:`upsert_sink`)."""
    return articles.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key] if isinstance(key, str) else list(key))


CLOSING = "closing"


def closing_row(rows: DataFrame, ts: str = "published_on", width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """One row behind all others of a finite stream, so far that the watermark passes the end of every window they are in; ``closing`` marks it,
    and nothing counts it.  An endless stream needs none: its next rows close its windows."""
    last = rows.agg((F.max(ts) + F.expr(f"INTERVAL {width}") + F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 SECOND")).alias(ts))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name not in (ts, CLOSING)]
    return last.select(ts, *blank, F.lit(True).alias(CLOSING)).select(*[c for c in rows.columns if c != CLOSING], CLOSING)


def _counted(articles: DataFrame):
    return F.count(F.when(~F.coalesce(F.col(CLOSING), F.lit(False)), 1)) if CLOSING in articles.columns else F.count(F.lit(1))


def stream_counts(articles: DataFrame, ts: str = "published_on", width: str = "1 hour", slide: str | None = None,
                  delay: str = "2 hours", by=()) -> DataFrame:
    """Tumbling (or sliding) window counts, for append mode: a window is emitted once, when the watermark has passed its end, and its state goes.

    Rows of closed windows are too late; :func:`late_sink` counts them.  Rows marked ``closing`` move the watermark and are not counted."""
    win = F.window(ts, width, slide) if slide else F.window(ts, width)
    out = articles.withWatermark(ts, delay).groupBy(win.alias("w"), *by).agg(_counted(articles).alias("articles")).select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "articles")
    return out.filter("articles > 0") if CLOSING in articles.columns else out


def stream_breaking(articles: DataFrame, ts: str = "published_on", delay: str = "2 hours") -> DataFrame:
    """Breaking articles per UTC day."""
    wanted = is_breaking("tags", ts)
    if CLOSING in articles.columns:
        wanted = wanted | F.coalesce(F.col(CLOSING), F.lit(False))
    return stream_counts(articles.filter(wanted), ts, "1 day", None, delay)


def stream_enrich(articles: DataFrame, sources: DataFrame | None = None, **maps) -> DataFrame:
    """Stateless per-article enrichment; ``sources`` is an optional static dimension (source_name, ...)."""
    out = articles.withColumns({
        "entities": X.map_entities("categories", "title", "body", **maps),
        "event_type": X.classify_event("categories", "title"),
        "source_tier": X.source_tier("source_name"),
    })
    return out if sources is None else out.join(sources, "source_name", "left")


def upsert_sink(stream: DataFrame, path: str, keys: list, order, partition: str, checkpoint: str, mode: str = "update"):
    """Micro-batches merged into a partitioned table; a replayed batch gives the same table."""
    def merge(batch: DataFrame, _: int) -> None:
        if mode == "ignore":
            append_new(path, batch, keys, order, partition)
        else:
            merge_into_table(path, batch, keys, order, partition)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_sink(stream: DataFrame, path: str, checkpoint: str):
    """Exactly-once file sink."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(
        "append").trigger(availableNow=True).start()


def late_sink(articles: DataFrame, path: str, checkpoint: str, ts: str = "published_on", width: str = "1 hour", slide: str | None = None,
              delay: str = "2 hours", by=()):
    """Counts of rows per window that was closed when they came: (start, end, by, late), a folder ``batch=<number>`` per micro-batch that has any.

    A batch is late against the watermark that the batch before it closed windows with: the latest time up to the last batch but one, less ``delay``, as for
    the windows themselves.  That time is carried from batch to batch as one value beside the counts, so a repeated batch writes the same folders again."""
    spark = articles.sparkSession
    marks = f"{path}-marks"
    win = F.window(ts, width, slide) if slide else F.window(ts, width)

    def save(batch: DataFrame, number: int) -> None:
        latest = lambda back: spark.read.schema("latest timestamp").parquet(f"{marks}/batch={number - back}").first()["latest"] if number >= back else None
        batch.agg(F.greatest(F.max(ts), F.lit(latest(1)).cast("timestamp")).alias("latest")).write.mode("overwrite").parquet(f"{marks}/batch={number}")
        mark = latest(2)
        before = F.lit(mark).cast("timestamp")
        if mark is not None:
            kept = batch.filter(~F.coalesce(F.col(CLOSING), F.lit(False))) if CLOSING in batch.columns else batch
            closed = kept.select(win.alias("w"), *by).filter(F.col("w.end") <= before - F.expr(f"INTERVAL {delay}"))
            counts = closed.groupBy("w", *by).agg(F.count(F.lit(1)).alias("late")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "late")
            counts.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return articles.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def complete_sink(stream: DataFrame, path: str, checkpoint: str):
    """Aggregate results rewritten after every micro-batch (works without waiting for the watermark)."""
    def save(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    return stream.writeStream.foreachBatch(save).outputMode("complete").option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()


def touched_intervals(changed: DataFrame, keys: list, partition: str = "date", before: int = 0, after: int = 0) -> DataFrame:
    """(keys, lo, hi): days from ``before`` days before a changed day to ``after`` days after it, per key, overlapping or adjoining ones as one interval."""
    spans = changed.select(*keys, F.date_sub(partition, before).alias("lo"), F.date_add(partition, after).alias("hi")).filter("lo IS NOT NULL").distinct()
    by = W.partitionBy(*keys).orderBy("lo", "hi")
    opens = F.coalesce(F.col("lo") > F.date_add(F.max("hi").over(by.rowsBetween(W.unboundedPreceding, -1)), 1), F.lit(True))
    islands = spans.withColumn("__opens", opens.cast("int"))
    islands = islands.withColumn("__island", F.sum("__opens").over(by.rowsBetween(W.unboundedPreceding, 0)))
    return islands.groupBy(*keys, "__island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__island")


def incremental_refresh(changed: DataFrame, history, build, path: str, checkpoint: str, keys: list,
                        partition: str = "date", lookback_days: int = 30, lookahead_days: int | None = None):
    """Recompute only what a micro-batch of changed (keys, day) touches: each changed day and the ``lookahead_days`` after it (default: the
    look-back, as those days read the changed one), per key.

    ``build(rows)`` turns history rows into output rows with the same ``keys`` and day; ``history`` is a frame, or a function that gives the present one.  A batch's days become intervals
    per key, and only rows of a key in its intervals, widened by ``lookback_days``, are read: one old day does not make the days since it be read, nor other keys'.  What the
    table has for the touched (key, day) is replaced, so rows that history no longer supports disappear; the rest of those days stays."""
    reach = lookback_days if lookahead_days is None else lookahead_days
    on = [*keys, partition]

    def days_of(batch: DataFrame, before: int) -> DataFrame:
        spans = touched_intervals(batch, keys, partition, before, reach)
        return spans.select(*keys, F.explode(F.sequence("lo", "hi")).alias(partition))

    def refresh(batch: DataFrame, _: int) -> None:
        batch = materialize(batch.select(*on).distinct())
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        touched, read = materialize(days_of(batch, 0)), days_of(batch, lookback_days)
        rows = (history() if callable(history) else history).join(read, on, "left_semi")
        table = spark.read.parquet(path)
        schema = table.schema
        days = touched.select(partition).distinct()
        out = build(rows).join(touched, on, "left_semi").select(*schema.names)
        rest = table.join(days, partition, "left_semi").join(touched, on, "left_anti").select(*schema.names)
        replace_partitions(path, rest.unionByName(out), partition, days, schema)

    return changed.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

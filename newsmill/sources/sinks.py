"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmill.operators.merge import valid_keys

ARTICLE_CSV_COLUMNS = [
    "id", "title", "published_on", "source", "url", "categories", "tags", "lang", "source_name", "body",
    "body_length", "has_image", "imageurl", "upvotes", "downvotes",
]


def article_csv_frame(articles: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    special = {
        "published_on": F.date_format("published_on", "yyyy-MM-dd HH:mm:ss").alias("published_on"),
        "body_length": F.length(F.coalesce("body", F.lit(""))).alias("body_length"),
        "has_image": F.when(F.coalesce(F.col("imageurl") != "", F.lit(False)), "Yes").otherwise("No").alias("has_image"),
        "id": F.col("id"), "upvotes": F.coalesce("upvotes", F.lit(0)).alias("upvotes"),
        "downvotes": F.coalesce("downvotes", F.lit(0)).alias("downvotes"),
    }
    return articles.select(*[special.get(c, None) if c in special else text(c) for c in ARTICLE_CSV_COLUMNS])


def write_articles_csv(articles: DataFrame, path: str) -> None:
    article_csv_frame(articles).write.mode("overwrite").option("header", True).option("quote", '"').option(
        "escape", '"').option("emptyValue", "").csv(path)


def feed_json_frame(articles: DataFrame) -> DataFrame:
    """Nested record per article, as feeds deliver it."""
    s = lambda c: F.col(c).cast("string")
    return articles.select(
        s("id").alias("id"), F.unix_timestamp("published_on").alias("published_on"), "imageurl", "title", "url", "body",
        "tags", "lang", s("upvotes").alias("upvotes"), s("downvotes").alias("downvotes"), "categories",
        F.struct(F.col("source_name").alias("name"), F.lit(None).cast("string").alias("img"), F.col("lang").alias("lang")).alias("source_info"),
        "source")


def write_feed_json(articles: DataFrame, path: str) -> None:
    """One JSON page per output line, each with a one-article ``Data`` array: files split and re-read in
    parallel, unlike one object holding everything."""
    page = F.struct(F.lit(100).alias("Type"), F.lit("ok").alias("Message"), F.array(F.struct("*")).alias("Data"))
    feed_json_frame(articles).select(page.alias("p")).select("p.*").write.mode("overwrite").json(path)


def append(df: DataFrame, path: str, partition: str | None = None) -> None:
    w = df.write.mode("append")
    (w.partitionBy(partition) if partition else w).parquet(path)


def guarded_write(df: DataFrame, path: str, key: str) -> DataFrame:
    """Write rows with a valid 64-bit key; returns written / dropped counts."""
    good = valid_keys(df, key)
    good.write.mode("overwrite").parquet(path)
    ok = F.expr(f"try_cast({key} AS bigint)").isNotNull()
    return df.agg(F.count_if(ok).alias("written"), F.count_if(~ok).alias("dropped"))


def refresh_view(spark: SparkSession, build, path: str, partition: str = "date") -> int:
    """Rebuild a materialised matrix and return its row count (from file metadata, not from a recompute)."""
    build().hint("rebalance", partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy(partition).parquet(path)
    return spark.read.parquet(path).count()


def flatten_articles(records: DataFrame, body_chars: int | None = None) -> DataFrame:
    """Nested article export: category names joined, source fields lifted, the whole body (or its first ``body_chars`` characters)."""
    names = F.array_join(F.transform("CATEGORY_DATA", lambda c: c["NAME"]), ", ")
    return records.select(
        "ID", "TITLE", F.col("SOURCE_DATA.SOURCE_KEY").alias("SOURCE_KEY"), F.col("SOURCE_DATA.NAME").alias("SOURCE_NAME"),
        F.coalesce(names, F.lit("")).alias("CATEGORIES"), (F.substring("BODY", 1, body_chars) if body_chars else F.col("BODY")).alias("BODY"),
        F.length(F.coalesce("BODY", F.lit(""))).alias("BODY_LENGTH"))


def flatten_categories(records: DataFrame) -> DataFrame:
    joined = lambda c: F.coalesce(F.array_join(f"FILTER.{c}", ", "), F.lit(""))
    return records.select("ID", "NAME", "STATUS", joined("INCLUDED_WORDS").alias("INCLUDED_WORDS"),
                          joined("INCLUDED_PHRASES").alias("INCLUDED_PHRASES"))

"""Readers: article CSV, nested feed JSON, tables and time ranges.  Schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from newsmill.functions import text as X
from newsmill.operators.keys import first_per_nonnull_key

ARTICLE_SCHEMA = (
    "id bigint, title string, published_on timestamp, fetched_at timestamp, created_at timestamp, source string, "
    "source_name string, url string, body string, body_length int, categories string, tags string, lang string, "
    "has_image boolean, imageurl string, upvotes int, downvotes int")

ARTICLE_CSV_SCHEMA = (
    "id bigint, title string, published_on timestamp, source string, url string, categories string, tags string, "
    "lang string, source_name string, body string, body_length int, has_image string, imageurl string, "
    "upvotes int, downvotes int")

FEED_SCHEMA = (
    "Type int, Message string, Response string, Err string, "
    "Data array<struct<id:string,guid:string,published_on:bigint,imageurl:string,title:string,url:string,body:string,"
    "tags:string,lang:string,upvotes:string,downvotes:string,categories:string,"
    "source_info:struct<name:string,img:string,lang:string>,source:string>>, "
    "fetch_params struct<hours_back:int,timestamp_threshold:bigint,time_range_start:string,time_range_end:string>")

BARS_SCHEMA = (
    "entity string, ts timestamp, open double, high double, low double, close double, volume double, market_cap double")

CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "timestampFormat": "yyyy-MM-dd HH:mm:ss"}


def utc_columns(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become instants once, at the edge."""
    return df.withColumns({
        f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)})


def read_articles_csv(spark: SparkSession, path) -> DataFrame:
    """Headered article CSV with quoted multi-line bodies; ``has_image`` Yes/No becomes boolean.

    Multi-line quoting makes each file one task: land many moderate files rather than one large one."""
    rows = spark.read.schema(ARTICLE_CSV_SCHEMA).options(**CSV_OPTIONS).csv(path)
    return rows.withColumn("has_image", F.col("has_image") == "Yes")


def read_feed_json(spark: SparkSession, path, page_per_line: bool = False) -> DataFrame:
    """One row per feed page: a file each, or a line each, so that files are split among tasks."""
    return spark.read.schema(FEED_SCHEMA).option("multiLine", not page_per_line).option("mode", "PERMISSIVE").json(path)


def is_feed_error():
    return (F.col("Response") == "Error") | F.col("Err").isNotNull()


def feed_error_rows(pages: DataFrame) -> DataFrame:
    """Pages to quarantine."""
    return pages.filter(F.coalesce(is_feed_error(), F.lit(False)))


def feed_articles(pages: DataFrame) -> DataFrame:
    """Article rows of all good pages (`Data` may be empty)."""
    good = pages.filter(~F.coalesce(is_feed_error(), F.lit(False)))
    a = good.select(F.explode("Data").alias("a"))
    text = lambda f: F.coalesce(F.col(f"a.{f}"), F.lit(""))
    number = lambda f: F.coalesce(F.expr(f"try_cast(a.{f} AS int)"), F.lit(0))
    return a.select(
        F.expr("try_cast(a.id AS bigint)").alias("id"), text("title").alias("title"),
        F.timestamp_seconds("a.published_on").alias("published_on"), text("source").alias("source"),
        F.coalesce(F.col("a.source_info.name"), F.lit("")).alias("source_name"), text("url").alias("url"),
        text("body").alias("body"), F.length(text("body")).alias("body_length"), text("categories").alias("categories"),
        text("tags").alias("tags"), text("lang").alias("lang"), (text("imageurl") != "").alias("has_image"),
        text("imageurl").alias("imageurl"), number("upvotes").alias("upvotes"), number("downvotes").alias("downvotes"))


def latest_snapshot(df: DataFrame, by: str = "file_modification_time") -> DataFrame:
    """Rows of the newest snapshot of a file-based frame: by file metadata (``file_modification_time``, or a
    timestamped ``file_name``), or by a partition column taken from timestamped folder names.

    The newest value is a scalar subquery over metadata only."""
    value = F.col(by) if by in df.columns else F.col(f"_metadata.{by}")
    return df.filter(value == df.agg(F.max(value)).scalar())


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return utc_columns(spark.read.format(fmt).load(f"{root}/{name}"))


def read_tables(spark: SparkSession, catalogs: dict, names: dict, **options) -> dict:
    """Several storage roots in one plan.  ``catalogs`` maps catalog -> root folder, or -> dict of JDBC
    options; ``names`` maps logical name -> (catalog, table)."""
    out = {}
    for logical, (catalog, table) in names.items():
        where = catalogs[catalog]
        if isinstance(where, dict):
            out[logical] = spark.read.format("jdbc").options(dbtable=table, **where, **options).load()
        else:
            out[logical] = read_table(spark, where, table)
    return out


def read_table_range(df: DataFrame, ts: str, start, end, lookback_days: int = 0, lookahead_days: int = 0,
                     date: str | None = None) -> DataFrame:
    """Time range widened for windows that look back or ahead.  Bounds are literals, so they reach the scan;
    give ``date`` when the table is partitioned by day to prune partitions as well."""
    lo = F.date_sub(F.lit(start).cast("date"), lookback_days)
    hi = F.date_add(F.lit(end).cast("date"), lookahead_days)
    rows = df.filter((F.col(ts) >= lo.cast("timestamp")) & (F.col(ts) < F.date_add(hi, 1).cast("timestamp")))
    return rows if date is None else rows.filter(F.col(date).between(lo, hi))


def load_feature_tables(spark: SparkSession, root: str, tables: dict, keys: list) -> dict:
    """Feature tables by name with only the requested columns; a missing table gives None (null columns
    later, see FeatureTable)."""
    from pyspark.errors import AnalysisException

    out = {}
    for name, cols in tables.items():
        try:
            df = read_table(spark, root, name)
        except AnalysisException:
            out[name] = None
            continue
        have = set(df.columns)
        out[name] = df.select(
            *keys, *[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in cols])
    return out


def feed_pages_to_articles(items: DataFrame, limit: int | None = None, link: str = "link",
                           order=("feed_rank", "page", "pos")) -> DataFrame:
    """Deduplicate paged feed items by link, first seen first; the primary feed (lowest rank) leads and
    fallback feeds top it up to ``limit``.  Items without a link are dropped."""
    rows = first_per_nonnull_key(items.filter(F.coalesce(F.col(link), F.lit("")) != ""), link, list(order))
    return rows if limit is None else rows.orderBy(*order).limit(limit)


def normalize_articles(items: DataFrame) -> DataFrame:
    """Feed items (link, title, pubDate, sourceKey, source, category, lang, image, imageurl, body) as article rows."""
    text = lambda c, d="": F.coalesce(F.col(c), F.lit(d))
    image = F.coalesce(F.nullif(F.col("image"), F.lit("")), F.nullif(F.col("imageurl"), F.lit("")))
    return items.select(
        X.url_id("link").alias("id"), text("title").alias("title"), F.col("pubDate").cast("timestamp").alias("published_on"),
        F.coalesce(F.nullif(F.col("sourceKey"), F.lit("")), text("source")).alias("source"),
        text("source").alias("source_name"), text("link").alias("url"), text("category").alias("categories"),
        F.lit("").alias("tags"), text("lang", "EN").alias("lang"), text("body").alias("body"),
        F.length(text("body")).alias("body_length"), image.isNotNull().alias("has_image"), text("image").alias("imageurl"),
        F.lit(0).alias("upvotes"), F.lit(0).alias("downvotes"))


def missing_attribute(records: dict, attribute: str, id_="ID", name="NAME") -> DataFrame:
    """Records of several kinds that lack an attribute, or hold null in it."""
    out = None
    for kind, df in records.items():
        rows = df if attribute not in df.columns else df.filter(F.col(attribute).isNull())
        part = rows.select(F.lit(kind).alias("kind"), F.col(id_).cast("string").alias("id"), F.col(name).alias("name"))
        out = part if out is None else out.unionByName(part)
    return out


def headlines(articles: DataFrame, title: str = "title") -> DataFrame:
    return articles.select(title, F.current_timestamp().alias("loaded_at"))


def article_metadata(articles: DataFrame, text_cols=("title", "summary"), image="imageurl") -> DataFrame:
    return articles.withColumns({
        "word_count": X.word_count(*text_cols), "has_image": F.coalesce(F.col(image) != "", F.lit(False))})

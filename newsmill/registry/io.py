"""Sources and sinks: every query writes the whole derived table and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.operators import merge
from newsmill.plans import matrix
from newsmill.registry import query
from newsmill.session import scratch_path
from newsmill.sources import readers, sinks

PUB = "strftime(published_on, '%Y-%m-%d %H:%M:%S') AS published_on"


@query("read_articles_csv", f"""
    SELECT id, title, {PUB}, source, url, coalesce(categories, '') AS categories, coalesce(tags, '') AS tags, lang, source_name, length(body) AS body_length, md5(body) AS body_md5,
           CAST(imageurl <> '' AS BIGINT) AS has_image, imageurl, upvotes, downvotes FROM v_articles""")
def _(v):
    """Article CSV round trip with quotes, commas and line breaks in the body."""
    path = scratch_path(v.spark, "articles-csv")
    # a file is one task when it is read again, so files follow the rows
    sinks.write_articles_csv(v.articles.repartition(max(16, -(-v.articles.count() // 100_000)), "id"), path)
    rows = readers.read_articles_csv(v.spark, path)
    text = ["categories", "tags", "imageurl", "body"]
    return rows.withColumns({c: F.coalesce(c, F.lit("")) for c in text}).withColumn("body_md5", F.md5("body")).drop("body")


@query("read_feed_json", f"""
    SELECT id, title, {PUB}, source, source_name, url, body_length, coalesce(categories, '') AS categories, coalesce(tags, '') AS tags, lang, CAST(imageurl <> '' AS BIGINT) AS has_image, upvotes, downvotes FROM v_articles""")
def _(v):
    """Nested feed pages, written and parsed again (one page per line, so files split)."""
    path = scratch_path(v.spark, "feed-json")
    sinks.write_feed_json(v.articles, path)
    pages = readers.read_feed_json(v.spark, path, page_per_line=True)
    return readers.feed_articles(pages).drop("body", "imageurl")


@query("feed_error_rows", "SELECT 'rate limit' AS message, count(*) AS n FROM documents WHERE n_chars < 200")
def _(v):
    """Error pages are set apart before the articles are exploded."""
    good = sinks.feed_json_frame(v.articles).select(F.lit("ok").alias("Message"), F.lit(None).cast("string").alias("Response"), F.lit(None).cast("string").alias("Err"))
    bad = v.table("documents").filter("n_chars < 200").select(F.lit("rate limit").alias("Message"), F.lit("Error").alias("Response"), F.lit(None).cast("string").alias("Err"))
    return readers.feed_error_rows(good.unionByName(bad)).groupBy(F.col("Message").alias("message")).agg(F.count(F.lit(1)).alias("n"))


@query("latest_snapshot", "SELECT lang, count(*) AS n FROM v_articles WHERE lang <> 'EN' GROUP BY lang")
def _(v):
    """Two timestamped snapshots; only the newest is read."""
    root = scratch_path(v.spark, "snapshots")
    for stamp, cond in (("20240101_000000", "lang = 'EN'"), ("20240102_000000", "lang <> 'EN'")):
        v.articles.filter(cond).select("id", "lang").write.parquet(f"{root}/snap={stamp}")
    return readers.latest_snapshot(v.spark.read.parquet(root), "snap").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("read_tables", "SELECT r_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY r_name")
def _(v):
    """Tables of two storage roots joined in one plan."""
    t = readers.read_tables(v.spark, {"main": v.dir, "dims": v.dir}, {
        "supplier": ("main", "supplier.parquet"), "nation": ("dims", "nation.parquet"), "region": ("dims", "region.parquet")})
    rows = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("r_regionkey") == F.col("n_regionkey"))
    return rows.groupBy("r_name").agg(F.count(F.lit(1)).alias("suppliers"))


@query("load_feature_tables", """
    SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CAST(NULL AS DOUBLE) AS no_such_column, CAST(NULL AS DOUBLE) AS gone FROM orders""")
def _(v):
    """Metadata-driven scan; a missing column and a missing table become nulls."""
    t = readers.load_feature_tables(v.spark, v.dir, {"orders.parquet": ["o_totalprice", "no_such_column"], "absent.parquet": ["gone"]}, ["o_orderkey"])
    rows = t["orders.parquet"]
    if t["absent.parquet"] is None:
        rows = rows.withColumn("gone", F.lit(None).cast("double"))
    return rows.withColumn("o_totalprice", F.round("o_totalprice", 2))


def _by_day(v):
    return v.articles.select("id", "url", "upvotes", F.to_date("published_on").alias("date"))


@query("upsert_update", """
    SELECT id, CAST(CASE WHEN id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN upvotes + 100 ELSE upvotes END AS BIGINT) AS upvotes, CAST(CAST(published_on AS DATE) AS VARCHAR) AS date FROM v_articles""")
def _(v):
    """Partitioned table: only touched days are rewritten; running the merge twice changes nothing."""
    path = scratch_path(v.spark, "upsert")
    rows = _by_day(v).select("id", "upvotes", "date")
    rows.write.partitionBy("date").parquet(path)
    changed = rows.join(v.table("labels").filter("quality = 1").select(F.col("doc_id").alias("id")), "id", "left_semi").withColumn("upvotes", F.col("upvotes") + 100)
    for _ in range(2):
        merge.merge_into_table(path, changed, ["id", "date"], ["id"], "date")
    return v.spark.read.parquet(path)


@query("upsert_ignore", """
    WITH a AS (SELECT url, id, CAST(published_on AS DATE) AS date, lang FROM v_articles), t AS (SELECT url, date, min(id) AS id FROM a WHERE lang = 'EN' GROUP BY ALL)
    SELECT url, CAST(date AS VARCHAR) AS date, id FROM t UNION ALL SELECT url, CAST(date AS VARCHAR), min(id) FROM a WHERE (url, date) NOT IN (SELECT (url, date) FROM t) GROUP BY url, date""")
def _(v):
    path = scratch_path(v.spark, "ignore")
    rows = v.articles.select("url", "id", "lang", F.to_date("published_on").alias("date"))
    rows.filter("lang = 'EN'").groupBy("url", "date").agg(F.min("id").alias("id")).write.partitionBy("date").parquet(path)
    merge.append_new(path, rows.drop("lang"), ["url", "date"], ["id"], "date")
    return v.spark.read.parquet(path)


@query("append", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY event_type")
def _(v):
    path = scratch_path(v.spark, "append")
    rows = v.table("events").select("event_id", "event_type")
    sinks.append(rows, path, "event_type")
    sinks.append(rows, path, "event_type")
    return v.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("guarded_write", "SELECT count(*) FILTER (WHERE lang <> 'FR') AS written, count(*) FILTER (WHERE lang = 'FR') AS dropped FROM v_articles")
def _(v):
    """Rows whose id is no 64-bit integer are dropped and counted."""
    bad = F.when(F.col("lang") == "FR", F.concat(F.lit("x"), F.col("id").cast("string"))).otherwise(F.col("id").cast("string"))
    return sinks.guarded_write(v.articles.select(bad.alias("id"), "title"), scratch_path(v.spark, "guarded"), "id")


@query("refresh_view", "SELECT CAST(date AS VARCHAR) AS date, count(*) AS n, count(DISTINCT entity) AS entities FROM v_daily_bars GROUP BY date")
def _(v):
    """Materialised view partitioned by month, rebuilt and read back."""
    path = scratch_path(v.spark, "view")
    build = lambda: matrix.date_scaffold(v.bars).withColumn("month", F.date_format("date", "yyyy-MM"))
    n = sinks.refresh_view(v.spark, build, path, "month")
    assert n > 0
    return v.spark.read.parquet(path).groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("entity").alias("entities"))


@query("remap_column", "SELECT id, CASE WHEN lang = 'EN' THEN 'bitcoin|ethereum' ELSE 'none' END AS entities FROM v_articles")
def _(v):
    """Recompute an array column; only rows whose set changed are merged."""
    path = scratch_path(v.spark, "remap")
    one = lambda *x: F.array(*[F.lit(i) for i in x])
    old = v.articles.select("id", "lang", one("none").alias("entities"), F.to_date("published_on").alias("date"))
    old.write.partitionBy("date").parquet(path)
    recomputed = v.spark.read.parquet(path).withColumn("fresh", F.when(F.col("lang") == "EN", one("bitcoin", "ethereum")).otherwise(one("none", "none")))
    changed = merge.changed_sets(recomputed, "entities", "fresh").select("id", "lang", F.col("fresh").alias("entities"), "date")
    merge.merge_into_table(path, changed, ["id", "date"], ["id"], "date")
    return v.spark.read.parquet(path).select("id", "entities")


@query("flatten_articles", """
    SELECT id AS "ID", title AS "TITLE", source AS "SOURCE_KEY", source_name AS "SOURCE_NAME", coalesce(replace(categories, '|', ', '), '') AS "CATEGORIES", body AS "BODY", length(body) AS "BODY_LENGTH" FROM v_articles""")
def _(v):
    from newsmill.functions.text import split_labels
    records = v.articles.select(
        F.col("id").alias("ID"), F.col("title").alias("TITLE"), F.struct(F.col("source").alias("SOURCE_KEY"), F.col("source_name").alias("NAME")).alias("SOURCE_DATA"),
        F.transform(split_labels("categories"), lambda c: F.struct(c.alias("NAME"))).alias("CATEGORY_DATA"), F.col("body").alias("BODY"))
    return sinks.flatten_articles(records)


@query("flatten_categories", """
    SELECT p_partkey AS "ID", p_name AS "NAME", 'ACTIVE' AS "STATUS", replace(p_name, ' ', ', ') AS "INCLUDED_WORDS", p_brand AS "INCLUDED_PHRASES" FROM part""")
def _(v):
    records = v.table("part").select(F.col("p_partkey").alias("ID"), F.col("p_name").alias("NAME"), F.lit("ACTIVE").alias("STATUS"),
        F.struct(F.split("p_name", " ").alias("INCLUDED_WORDS"), F.array("p_brand").alias("INCLUDED_PHRASES")).alias("FILTER"))
    return sinks.flatten_categories(records)


@query("headlines", "SELECT title, count(*) AS n FROM v_articles GROUP BY title")
def _(v):
    return readers.headlines(v.articles).groupBy("title").agg(F.count("loaded_at").alias("n"))


@query("json_columns", "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, props AS again FROM events")
def _(v):
    """JSON text to struct and back."""
    rows = v.table("events").withColumn("p", F.from_json("props", "k bigint"))
    return rows.select("event_id", F.col("p.k").alias("k"), F.regexp_replace(F.to_json("p"), ":", ": ").alias("again"))


@query("embedding_daily_mean", """
    SELECT label, pos, round(avg(x), 6) + 0.0 AS mean FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY ALL""")
def _(v):
    """Element-wise mean of vectors per group."""
    rows = v.table("embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    return rows.groupBy("label", "pos").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))

"""Reporting and data-quality queries over the article table.  ``now`` is a parameter, so a report can be
rebuilt for any point in time; it defaults to the current time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from newsmill.functions import text as X
from newsmill.operators.keys import missing_hours
from newsmill.plans.market import DAY


def _now(now):
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


def per_source(articles: DataFrame, min_count: int | None = None) -> DataFrame:
    out = articles.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("articles"), F.round(F.avg("body_length"), 4).alias("avg_length"),
        F.min("body_length").alias("min_length"), F.max("body_length").alias("max_length"))
    return out if min_count is None else out.filter(F.col("articles") >= min_count)


def per_hour(articles: DataFrame, now=None, hours: int | None = None) -> DataFrame:
    rows = articles if hours is None else articles.filter(
        F.col("published_on") >= _now(now) - F.expr(f"INTERVAL {hours} HOURS"))
    return rows.groupBy(F.date_trunc("hour", "published_on").alias("hour")).agg(
        F.count(F.lit(1)).alias("articles"), F.round(F.avg("body_length"), 4).alias("avg_length"))


def per_day(articles: DataFrame) -> DataFrame:
    return articles.groupBy(F.to_date("published_on").alias(DAY)).agg(
        F.count(F.lit(1)).alias("articles"), F.countDistinct("source_name").alias("sources"),
        F.round(F.avg("body_length"), 4).alias("avg_length"))


def category_frequency(articles: DataFrame, now=None, hours: int | None = None, top: int | None = None) -> DataFrame:
    rows = articles if hours is None else articles.filter(
        F.col("published_on") >= _now(now) - F.expr(f"INTERVAL {hours} HOURS"))
    out = rows.select(F.explode(X.split_labels("categories")).alias("category")).groupBy("category").agg(
        F.count(F.lit(1)).alias("frequency"))
    return out if top is None else out.orderBy(F.desc("frequency"), "category").limit(top)


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Count and share per value; the window runs over the aggregated rows only."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("articles"))
    return n.withColumn("percentage", F.round(100.0 * F.col("articles") / F.sum("articles").over(W.partitionBy()), 2))


def search(articles: DataFrame, word: str, title: bool = True, body: bool = True) -> DataFrame:
    """Case-insensitive containment in title and/or body with the place of the first hit; ``%`` and ``_`` stand for
    themselves."""
    part = F.lower(F.lit(word))
    in_title, in_body = F.lower("title").contains(part), F.lower("body").contains(part)
    cond = (in_title | in_body) if title and body else (in_title if title else in_body)
    return articles.filter(cond).withColumn(
        "found_in", F.when(in_title, "title").when(in_body, "body").otherwise("both"))


def without_body(articles: DataFrame) -> DataFrame:
    return articles.filter(F.col("body").isNull() | (F.col("body") == "") | (F.col("body_length") == 0))


def net_votes(articles: DataFrame, k: int = 10) -> DataFrame:
    rows = articles.filter("upvotes > 0 or downvotes > 0").withColumn("net_votes", F.col("upvotes") - F.col("downvotes"))
    return rows.orderBy(F.desc("net_votes"), "id").limit(k)


def missing_fields(articles: DataFrame, now=None) -> DataFrame:
    """All issue counters from a single pass."""
    empty = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) == ""))
    wide = articles.agg(
        empty("title").alias("Missing Title"), empty("url").alias("Missing URL"), empty("source").alias("Missing Source"),
        F.count_if(F.col("published_on") > _now(now)).alias("Future Published Date"))
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("issue"), F.col(f"`{c}`").alias("count")) for c in wide.columns])))


def fetch_gaps(articles: DataFrame, newest: int | None = 20, until=None) -> DataFrame:
    gaps = missing_hours(articles, "fetched_at", None if until is None else F.lit(until).cast("timestamp"))
    gaps = gaps.withColumn("status", F.lit("No data"))
    return gaps if newest is None else gaps.orderBy(F.desc("hour")).limit(newest)


def source_activity(articles: DataFrame, today) -> DataFrame:
    """Per source: today against yesterday.  One pass with two conditional counts gives what a full outer
    join of the two day aggregates would."""
    today = F.lit(today).cast("date")
    d = F.to_date("published_on")
    rows = articles.filter(d >= F.date_sub(today, 1))
    now_n, before_n = F.count_if(d >= today), F.count_if(d < today)
    return rows.groupBy(F.col("source_name").alias("source")).agg(
        before_n.alias("yesterday"), now_n.alias("today"), (now_n - before_n).alias("change"))


def full_outer_change(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Generic two-table form: value on both sides (0 when absent) and the difference."""
    l, r = left.select(key, F.col(value).alias("before")), right.select(key, F.col(value).alias("after"))
    out = l.join(r, key, "full_outer").select(
        key, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return out.withColumn("change", F.col("after") - F.col("before"))


def hourly_distinct(articles: DataFrame) -> DataFrame:
    return articles.groupBy(F.date_trunc("hour", "published_on").alias("hour")).agg(F.countDistinct("url").alias("urls"))


def rate_columns(urls) -> list:
    return [F.count(urls).alias("hours"), F.coalesce(F.sum(urls), F.lit(0)).alias("total"),
            F.coalesce(F.round(F.avg(urls), 1), F.lit(0.0)).alias("avg_per_hour"), F.coalesce(F.max(urls), F.lit(0)).alias("max_per_hour")]


def rate_summary(articles: DataFrame, where) -> DataFrame:
    """Hours covered, total, average and maximum of distinct urls per hour for the rows of a condition."""
    return hourly_distinct(articles.filter(where)).agg(*rate_columns(F.col("urls")))


def ingest_rate(articles: DataFrame, now, cutover) -> DataFrame:
    """Last 24 h, live rate since the cut-over, and the baseline before it, as labelled rows."""
    now_, cut = _now(now), F.lit(cutover).cast("timestamp")
    live = (F.col("fetched_at") >= cut) & (F.col("published_on") >= F.date_trunc("day", now_))
    parts = {
        "last_24h": F.col("fetched_at") >= now_ - F.expr("INTERVAL 24 HOURS"),
        "live": live, "baseline": F.col("fetched_at") < cut,
    }
    periods = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in parts.items()]))
    hours = articles.select("published_on", "url", F.explode(periods).alias("period")).groupBy(
        "period", F.date_trunc("hour", "published_on").alias("hour")).agg(F.countDistinct("url").alias("urls"))
    row = {name: rate_columns(F.when(F.col("period") == name, F.col("urls"))) for name in parts}
    # one global aggregate: a period without rows keeps its row of zeros
    wide = hours.agg(*[F.struct(F.lit(name).alias("period"), *cols).alias(name) for name, cols in row.items()])
    return wide.select(F.inline(F.array(*parts)))


def last_day_stats(articles: DataFrame, now=None, long_body: int = 300) -> DataFrame:
    long = F.count_if(F.col("body_length") >= long_body)
    n = F.count(F.lit(1))
    return articles.filter(F.col("fetched_at") >= _now(now) - F.expr("INTERVAL 24 HOURS")).agg(
        n.alias("articles"), F.countDistinct("source_name").alias("sources"), long.alias("long_bodies"),
        F.coalesce(F.floor(F.try_divide(100 * long, n)), F.lit(0)).cast("bigint").alias("long_pct"),
        F.coalesce(F.round(F.avg("body_length"), 0), F.lit(0.0)).alias("avg_length"))


def hour_bars(articles: DataFrame, where=None, width: int = 45) -> DataFrame:
    """Distinct urls per hour with a text bar."""
    rows = articles if where is None else articles.filter(where)
    return hourly_distinct(rows).select(
        F.date_format("hour", "yyyy-MM-dd HH:00").alias("hour"), "urls",
        F.expr(f"repeat('#', cast(least({width}, urls) as int))").alias("bar"))


def latest_rows(df: DataFrame, date: str = DAY) -> DataFrame:
    """Rows of the newest day (scalar subquery)."""
    return df.filter(F.col(date) == df.agg(F.max(date)).scalar())


def latest_signal(signals: DataFrame, entity_value, entity="entity") -> DataFrame:
    return signals.filter(F.col(entity) == entity_value).orderBy(F.desc(DAY)).limit(1)

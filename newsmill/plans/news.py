"""Articles -> scores -> daily signals per entity.

Articles are reduced to one row per (entity, day) by partial aggregation before any window runs, so an
entity that holds a large share of all articles costs one row per day downstream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from newsmill.functions import rules, text as X
from newsmill.operators.keys import unprocessed
from newsmill.plans.market import DAY, day_number, time_range


def score_articles(articles: DataFrame, probs: DataFrame, done: DataFrame | None, model_version: str,
                   min_body: int = rules.MIN_BODY_LENGTH, **maps) -> DataFrame:
    """Score rows for articles this model version has not seen.

    ``probs`` holds class probabilities per article id (title_pos/neg/neu, body_pos/neg/neu), from a table
    or from :func:`newsmill.plans.signals.score_batches`."""
    rows = articles.filter(F.col("body_length") >= min_body)
    if done is not None:
        rows = unprocessed(rows, done, "id", "news_id", model_version)
    rows = rows.join(probs, "id").withColumns({
        "t": X.polarity_score("title_pos", "title_neg", "title_neu"),
        "b": X.polarity_score("body_pos", "body_neg", "body_neu"),
    })
    return rows.select(
        F.col("id").alias("news_id"), "published_on",
        F.col("t.score").alias("title_score"), F.col("b.score").alias("body_score"),
        X.composite_score(F.col("t.score"), F.col("b.score")).alias("composite_score"),
        F.col("b.confidence").alias("confidence"),
        X.classify_event("categories", "title").alias("event_type"),
        X.source_tier(F.coalesce(F.col("source_name"), F.lit(""))).cast("short").alias("source_tier"),
        X.map_entities("categories", "title", "body", **maps).alias("entities"),
        F.lit(model_version).alias("model_version"),
    )


def is_breaking(tags="tags", ts="published_on", breaking=None, hours: int = rules.BREAKING_HOURS):
    """Tagged as breaking and published in the last hours of its UTC day."""
    words = rules.BREAKING_TAGS if breaking is None else breaking
    tagged = X.contains_any(F.lower(F.coalesce(F.col(tags), F.lit(""))), words)
    return tagged & (F.hour(ts) >= 24 - hours)


def entity_days(scores: DataFrame, articles: DataFrame) -> DataFrame:
    """Per (entity, day): weighted sums over all scores, and the same-day part that also needs the article
    (tags), which is an inner join on the article id.  Scores without entities are a row with a null entity."""
    tags = articles.select(F.col("id").alias("news_id"), "tags", F.lit(True).alias("known"))
    rows = scores.join(tags, "news_id", "left").withColumns({
        DAY: F.to_date("published_on"), "w": X.tier_weight("source_tier"),
        "known": F.coalesce("known", F.lit(False)), "breaking": is_breaking(),
        "tier": F.coalesce(F.nullif(F.col("source_tier").cast("int"), F.lit(0)), F.lit(2)),
    })
    rows = rows.withColumn("entity", F.explode_outer("entities"))
    seen = lambda cond: F.coalesce(F.bool_or(F.col("known") & cond), F.lit(False)).cast("int")
    return rows.groupBy("entity", DAY).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.sum("w").alias("w_all"), F.sum(F.col("w") * F.col("composite_score")).alias("ws_all"),
        F.count_if("known").alias("n_day"),
        F.sum(F.when(F.col("known"), F.col("w"))).alias("w_day"),
        F.sum(F.when(F.col("known"), F.col("w") * F.col("composite_score"))).alias("ws_day"),
        *[F.count_if(F.col("known") & (F.col("tier") == t)).alias(f"tier{t}") for t in (1, 2, 3)],
        seen(F.col("breaking")).alias("breaking"),
        *[seen(F.col("event_type") == e).alias(e) for e in ("REGULATION", "HACK_EXPLOIT", "ADOPTION_PARTNERSHIP")],
    )


def news_signals(scores: DataFrame, articles: DataFrame, start=None, end=None,
                 baseline_days: int = rules.NEWS_BASELINE_DAYS) -> DataFrame:
    """Daily news features per entity, for days with at least one article and entities with a score in the
    last eight calendar days.  For a range of days the scores, and articles that have ``published_on`` as their scores do, are read from
    ``baseline_days`` earlier on.  Articles are joined once."""
    scores = time_range(scores, "published_on", start, end, max(baseline_days, 7))
    if "published_on" in articles.columns:
        articles = time_range(articles, "published_on", start, end, max(baseline_days, 7))
    all_days = entity_days(scores, articles)
    days = all_days.filter(F.col("entity").isNotNull())
    # days with at least one score that has its article
    processed = all_days.filter("n_day > 0").select(DAY).distinct()
    # every (entity, processed day) inside the eight days after an active day; other days of the entity
    # stay as history rows for the frames
    reach = days.select("entity", F.explode(F.sequence(F.col(DAY), F.date_add(DAY, 7))).alias(DAY)).distinct()
    spine = reach.join(processed.withColumn("processed", F.lit(True)), DAY, "left")
    rows = spine.join(days, ["entity", DAY], "left").filter("processed or n_all is not null")
    rows = rows.withColumn("dn", day_number(DAY))
    by = W.partitionBy("entity").orderBy("dn")
    last3, last7 = by.rangeBetween(-3, 0), by.rangeBetween(-7, 0)
    base = by.rangeBetween(-baseline_days, -1)
    mean = lambda ws, w: F.round(F.coalesce(F.try_divide(ws, w), F.lit(0.0)), 6)
    over = lambda c, w: F.sum(c).over(w)
    known = F.count("n_all").over(base)
    rows = rows.withColumns({
        "news_sentiment_1d": mean(F.col("ws_day"), F.col("w_day")),
        "news_sentiment_3d": mean(over("ws_all", last3), over("w_all", last3)),
        "news_sentiment_7d": mean(over("ws_all", last7), over("w_all", last7)),
        "news_volume_1d": F.coalesce("n_day", F.lit(0)),
        "news_volume_3d": F.coalesce(over("n_all", last3), F.lit(0)),
        "base_mean": F.coalesce(F.avg("n_all").over(base), F.lit(0.0)),
        "base_std": F.when(known > 1, F.greatest(F.stddev_samp("n_all").over(base), F.lit(0.01))).otherwise(F.lit(1.0)),
    })
    keep = F.coalesce("processed", F.lit(False))
    if start is not None:
        keep = keep & (F.col(DAY) >= F.lit(start).cast("date"))
    if end is not None:
        keep = keep & (F.col(DAY) <= F.lit(end).cast("date"))
    zero = lambda c, name: F.coalesce(F.col(c), F.lit(0)).cast("int").alias(name)
    return rows.filter(keep).select(
        "entity", DAY,
        "news_sentiment_1d", "news_sentiment_3d", "news_sentiment_7d",
        F.round(F.col("news_sentiment_1d") - F.col("news_sentiment_7d"), 6).alias("news_sentiment_momentum"),
        "news_volume_1d", "news_volume_3d",
        F.round((F.col("news_volume_1d") - F.col("base_mean")) / F.col("base_std"), 4).alias("news_volume_zscore_1d"),
        zero("breaking", "news_breaking_flag"), zero("REGULATION", "news_regulation_flag"),
        zero("HACK_EXPLOIT", "news_security_flag"), zero("ADOPTION_PARTNERSHIP", "news_adoption_flag"),
        F.col("news_sentiment_1d").alias("news_source_quality"),
        *[zero(f"tier{t}", f"news_tier{t}_count_1d") for t in (1, 2, 3)],
    )


def news_events(scores: DataFrame, start=None, end=None, lookback: int = 30) -> DataFrame:
    """Event type of the day, recency of every event group, volume surprise and share of the day's news for
    every (entity, day with any news).

    For a range of days the entities are those with news up to ``end``, and the grid of entities and days begins at ``start``.  What lies before it is one aggregate: a
    row per entity with the last time of every group, and the counts of the last ``lookback`` days that have any."""
    rows = time_range(scores, "published_on", None, end).select(
        "published_on", F.explode("entities").alias("entity"), X.event_group("event_type").alias("grp")).withColumn(DAY, F.to_date("published_on"))
    by_group = rows.groupBy("entity", DAY, "grp").agg(
        F.count(F.lit(1)).alias("n"), F.max("published_on").alias("last_ts"))
    # mode with ties to the alphabetically smallest group
    best = F.max_by("grp", F.struct(F.when(F.col("grp").isNotNull(), F.col("n")), F.col("ord")))
    groups = sorted(set(rules.RECENCY_GROUPS))
    order = F.lit(0)
    for i, g in enumerate(groups):
        order = F.when(F.col("grp") == g, -i).otherwise(order)
    daily = by_group.withColumn("ord", order).groupBy("entity", DAY).agg(
        F.sum("n").alias("n"), best.alias("event_type"),
        *[F.max(F.when(F.col("grp") == g, F.col("last_ts"))).alias(f"last_{g}") for g in rules.RECENCY_GROUPS],
    )
    first = None if start is None else F.lit(start).cast("date")
    shown = daily if first is None else daily.filter(F.col(DAY) >= first)
    totals = shown.groupBy(DAY).agg(F.sum("n").alias("day_total"))
    # every entity on every shown day with any news (the output itself): the calendar comes from a scalar
    # subquery, the days without news drop out in the equi-join
    span = totals.agg(F.struct(F.min(DAY).alias("lo"), F.max(DAY).alias("hi"))).scalar()
    spine = (
        daily.select("entity").distinct().withColumn("span", span)
        .select("entity", F.explode(F.sequence("span.lo", "span.hi")).alias(DAY))
        .join(totals, DAY)
    )
    grid = spine.join(shown, ["entity", DAY], "left")
    if first is not None:
        last = [f"last_{g}" for g in rules.RECENCY_GROUPS]
        seed = daily.filter(F.col(DAY) < first).groupBy("entity").agg(*[F.max(c).alias(c) for c in last]).withColumn(DAY, F.date_sub(first, lookback + 1))
        recent = daily.filter((F.col(DAY) < first) & (F.col(DAY) >= F.date_sub(first, lookback))).select("entity", DAY, "n")
        grid = grid.unionByName(seed, allowMissingColumns=True).unionByName(recent, allowMissingColumns=True)
    grid = grid.withColumns({"dn": day_number(DAY), "count_24h": F.coalesce("n", F.lit(0)).cast("int")})
    by = W.partitionBy("entity").orderBy("dn")
    past, frame = by.rowsBetween(W.unboundedPreceding, 0), by.rangeBetween(-lookback, -1)
    day_end = F.unix_timestamp(F.col(DAY).cast("timestamp")) + 86399
    hours = lambda g: F.greatest(
        F.round((day_end - F.unix_micros(F.max(f"last_{g}").over(past)) / 1e6) / 3600, 2), F.lit(0.0))
    mean = F.coalesce(F.sum("count_24h").over(frame), F.lit(0)) / float(lookback)
    square = F.coalesce(F.sum(F.col("count_24h") * F.col("count_24h")).over(frame), F.lit(0)) / float(lookback)
    std = F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))
    out = grid.withColumns({
        **{f"hours_since_{g}": F.when(F.max(f"last_{g}").over(past).isNotNull(), hours(g)) for g in rules.RECENCY_GROUPS},
        "magnitude_est": X.event_magnitude("event_type"),
        "news_surprise": F.round((F.col("count_24h") - mean) / F.greatest(std, F.lit(0.1)), 4),
        "cross_news_ratio": F.round(F.col("count_24h") / F.greatest(F.col("day_total"), F.lit(1)), 4),
    })
    # rows that only carry history have no day total
    return out.filter(F.col("day_total").isNotNull()).select(
        "entity", DAY, "event_type", *[f"hours_since_{g}" for g in rules.RECENCY_GROUPS],
        "magnitude_est", F.col("count_24h").alias("event_count_24h"), "news_surprise", "cross_news_ratio",
    )

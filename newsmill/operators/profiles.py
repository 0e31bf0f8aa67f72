"""Dataset profiles in long form: (section, key, value) rows from one-pass aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from newsmill.functions import rules, text as X
from newsmill.session import materialize


def metrics(df: DataFrame, section: str, **aggs: Column) -> DataFrame:
    """All aggregates in one pass, turned into (section, key, value) rows."""
    wide = df.agg(*[a.cast("double").alias(k) for k, a in aggs.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in aggs])
    return wide.select(F.lit(section).alias("section"), F.inline(pairs))


def counts(df: DataFrame, section: str, key, top: int | None = None, min_count: int | None = None) -> DataFrame:
    """Frequency rows of one column or expression, optionally only the most frequent (ties by key)."""
    key = F.col(key) if isinstance(key, str) else key
    out = df.select(key.cast("string").alias("key")).groupBy("key").agg(F.count(F.lit(1)).cast("double").alias("value"))
    if min_count is not None:
        out = out.filter(F.col("value") >= min_count)
    if top is not None:
        out = out.orderBy(F.desc("value"), "key").limit(top)
    return out.select(F.lit(section).alias("section"), "key", "value")


def union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pct(cond: Column) -> Column:
    return F.round(100.0 * F.count_if(cond) / F.nullif(F.count(F.lit(1)), F.lit(0)), 2)


def present(col: str) -> Column:
    return F.coalesce(F.col(col) != "", F.lit(False))


def table_stats(articles: DataFrame) -> DataFrame:
    span = F.max("published_on").cast("long") - F.min("published_on").cast("long")
    return articles.agg(
        F.count(F.lit(1)).alias("articles"), F.countDistinct("source_name").alias("sources"),
        F.min("published_on").alias("oldest"), F.max("published_on").alias("newest"), span.alias("span_seconds"))


ALL = "*"  # the section of a pass that every row is in


def one_pass(df: DataFrame, sections: dict, values: dict | None = None) -> DataFrame:
    """(section, key, of, n, <value>_n, _sum, _min, _max): one scan of ``df`` for any number of frequency sections and totals.

    ``sections`` maps a name to an array column of keys, or of structs (key, of) to count pairs; every row is tagged with all of them, and with the section
    ALL.  ``values`` are numbers that are added up per key.  Tagged rows are counted in the map tasks; the counts are written once, and the parts of a profile read them."""
    values = values or {}

    def tags(name, keys):
        pairs = keys if isinstance(df.select(keys.alias("k")).schema["k"].dataType.elementType, T.StructType) else F.transform(
            keys, lambda k: F.struct(k.cast("string").alias("key"), F.lit(None).cast("string").alias("of")))
        return F.transform(pairs, lambda p: F.struct(F.lit(name).alias("section"), p["key"].cast("string").alias("key"), p["of"].cast("string").alias("of")))

    nothing = F.lit(None).cast("string")
    everything = F.array(F.struct(F.lit(ALL).alias("section"), nothing.alias("key"), nothing.alias("of")))
    none = F.array().cast("array<struct<section:string,key:string,of:string>>")
    rows = df.select(F.explode(F.concat(everything, *[F.coalesce(tags(n, k), none) for n, k in sections.items()])).alias("tag"), *[c.alias(v) for v, c in values.items()])
    aggs = [f(v).alias(f"{v}_{n}") for v in values for n, f in (("n", F.count), ("sum", F.sum), ("min", F.min), ("max", F.max))]
    return materialize(rows.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), *aggs).select("tag.*", "n", *[f"{v}_{x}" for v in values for x in ("n", "sum", "min", "max")]))


def pass_totals(passed: DataFrame, section: str, of_all: dict, counted: dict | None = None) -> DataFrame:
    """(section, key, value) rows: ``of_all`` are expressions over the counts of the row of all rows, ``counted`` conditions that keys are counted by."""
    whole = F.col("section") == ALL
    row = passed.agg(F.coalesce(F.max(F.when(whole, F.col("n"))), F.lit(0)).alias("n"),
                     *[F.max(F.when(whole, F.col(c))).alias(c) for c in passed.columns[4:]],
                     *[F.count_if(c).alias(f"__{k}") for k, c in (counted or {}).items()])
    pairs = {**of_all, **{k: F.col(f"__{k}") for k in counted or {}}}
    return row.select(F.lit(section).alias("section"), F.inline(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("double").alias("value")) for k, v in pairs.items()])))


def pass_counts(passed: DataFrame, name: str, section: str, top: int | None = None) -> DataFrame:
    """Frequency rows of one section of a pass, optionally only the most frequent (ties by key)."""
    out = passed.filter(F.col("section") == name).select(F.lit(section).alias("section"), "key", F.col("n").cast("double").alias("value"))
    return out.orderBy(F.desc("value"), "key").limit(top) if top is not None else out


def _in(name: str) -> Column:
    return (F.col("section") == name) & F.col("key").isNotNull()


def article_profile(articles: DataFrame) -> DataFrame:
    """Volume, body, image, time-span statistics and the most frequent sources, categories and tags; one scan."""
    p = one_pass(articles, {"source": F.array(F.coalesce("source", F.lit(""))), "name": F.array(F.coalesce("source_name", F.lit(""))),
                            "category": X.split_labels("categories"), "tag": X.split_labels("tags")},
                 {"length": F.length(F.coalesce("body", F.lit(""))), "image": present("imageurl").cast("int"), "ts": F.unix_timestamp("published_on")})
    return union(
        pass_totals(p, "totals", {"total_articles": F.col("n"), "avg_length": F.round(F.try_divide("length_sum", "length_n"), 2), "min_length": F.col("length_min"),
                                  "max_length": F.col("length_max"), "image_percentage": F.round(F.try_divide(100.0 * F.col("image_sum"), F.col("n")), 2),
                                  "time_span_minutes": F.round((F.col("ts_max") - F.col("ts_min")) / 60, 2)},
                    {"unique_sources": _in("source"), "unique_categories": _in("category"), "unique_tags": _in("tag")}),
        pass_counts(p, "name", "top_sources", 10), pass_counts(p, "category", "top_categories", 15), pass_counts(p, "tag", "top_tags", 15))


def score_bucket(score: Column) -> Column:
    out = F
    for low, name in rules.SOURCE_SCORE_BUCKETS:
        out = out.when(score >= low, name)
    return out.otherwise("below_average")


def source_profile(sources: DataFrame, top: int = 10) -> DataFrame:
    """Status, score buckets, types, languages and the best-scored sources of a source dimension."""
    rows = sources.withColumn("score", F.coalesce(F.expr("try_cast(BENCHMARK_SCORE AS int)"), F.lit(0)))
    best = rows.orderBy(F.desc("score"), "SOURCE_KEY").limit(top).select(
        F.lit("top_sources").alias("section"), F.col("NAME").alias("key"), F.col("score").cast("double").alias("value"))
    return union(
        metrics(rows, "totals", total_sources=F.count(F.lit(1)), active_sources=F.count_if(F.col("STATUS") == "ACTIVE"),
                avg_score=F.round(F.avg("score"), 4), max_score=F.max("score"), min_score=F.min("score")),
        counts(rows, "score_distribution", score_bucket(F.col("score"))),
        counts(rows, "source_types", "SOURCE_TYPE"), counts(rows, "languages", "LANG"), best)


def category_profile(categories: DataFrame, top: int = 10) -> DataFrame:
    """Counts, first-match name class and the categories with the longest filters."""
    words, phrases = (F.coalesce(F.col(c), F.lit("")) for c in ("INCLUDED_WORDS", "INCLUDED_PHRASES"))
    rows = categories.withColumns({
        "complexity": F.length(words) + F.length(phrases),
        "cls": X.first_class(F.lower(F.coalesce("NAME", F.lit(""))), rules.CATEGORY_NAME_CLASSES)})
    best = rows.orderBy(F.desc("complexity"), "NAME").limit(top).select(
        F.lit("top_by_complexity").alias("section"), F.col("NAME").alias("key"),
        F.col("complexity").cast("double").alias("value"))
    return union(
        metrics(rows, "totals", total_categories=F.count(F.lit(1)), active_categories=F.count_if(F.col("STATUS") == "ACTIVE"),
                with_words=F.count_if(words != ""), with_phrases=F.count_if(phrases != "")),
        counts(rows.filter("cls is not null"), "category_types", "cls"), best)


def content_profile(articles: DataFrame) -> DataFrame:
    """Sentiment, source, category, author, keyword and status distributions of an article export; one scan."""
    value = lambda c, d: F.array(F.coalesce(F.col(c), F.lit(d)))
    items = lambda c, sep: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), sep), lambda t: F.trim(t)), lambda t: t != "")
    p = one_pass(articles, {"author": items("AUTHORS", ","), "sentiment": value("SENTIMENT", "UNKNOWN"), "source": value("SOURCE_KEY", "unknown"),
                            "category": items("CATEGORIES", ", "), "keyword": items("KEYWORDS", "[|]"), "status": value("STATUS", "UNKNOWN")},
                 {"length": F.expr("try_cast(BODY_LENGTH AS bigint)"), "image": present("IMAGE_URL").cast("int")})
    return union(
        pass_totals(p, "totals", {"total_articles": F.col("n"), "avg_body_length": F.round(F.try_divide("length_sum", "length_n"), 4), "max_body_length": F.col("length_max"),
                                  "min_body_length": F.col("length_min"), "image_percentage": F.round(F.try_divide(100.0 * F.col("image_sum"), F.col("n")), 2)},
                    {"unique_authors": _in("author")}),
        pass_counts(p, "sentiment", "sentiment"), pass_counts(p, "source", "source"), pass_counts(p, "category", "top_categories", 15),
        pass_counts(p, "keyword", "top_keywords", 15), pass_counts(p, "status", "status"))


def category_groups(categories: DataFrame, name="name", id_="id") -> DataFrame:
    """Multi-label keyword groups, presence flags and the most frequent name terms."""
    text = F.lower(F.concat_ws(" ", F.coalesce(F.col(name), F.lit("")), F.coalesce(F.col(id_).cast("string"), F.lit(""))))
    lname = F.lower(F.coalesce(F.col(name), F.lit("")))
    groups = categories.select(F.explode(X.matching_classes(text, rules.CATEGORY_TOPIC_CLASSES)).alias("v"))
    terms = categories.select(F.explode(F.split(F.trim(lname), r"\s+")).alias("v")).filter(F.length("v") > 2)
    flags = {f"has_{w}": F.coalesce(F.bool_or(lname.contains(w)), F.lit(False)).cast("int") for w in rules.CATEGORY_PRESENCE}
    return union(
        metrics(categories, "insights", total_categories=F.count(F.lit(1)), **flags),
        counts(groups, "classification", "v"), counts(terms, "top_terms", "v", 5))


def source_groups(sources: DataFrame, name="name", id_="id") -> DataFrame:
    lname, lid = (F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in (name, id_))
    return metrics(
        sources, "sources", total_sources=F.count(F.lit(1)),
        **{f"has_{w}": F.coalesce(F.bool_or(lid.contains(w)), F.lit(False)).cast("int") for w in rules.SOURCE_PRESENCE},
        **{f"n_{g}": F.count_if(X.contains_any(lname, words)) for g, words in rules.SOURCE_GROUPS.items()})


def feed_edges(feeds: DataFrame) -> DataFrame:
    return feeds.select("source", F.explode("categories").alias("category")).distinct()


def feed_coverage(feeds: DataFrame) -> DataFrame:
    """Breadth of each feed and the reach of each category (ties: alphabetically first); one scan."""
    n = F.size("categories")
    covers = {t: F.exists(F.transform("categories", F.lower), lambda c: X.contains_any(c, words)).cast("int") for t, words in rules.COVERAGE_TOPICS.items()}
    edge = F.transform("categories", lambda c: F.struct(c.alias("key"), F.col("source").alias("of")))
    p = one_pass(feeds, {"source": F.array("source"), "edge": edge}, {"width": n, "single": (n == 1).cast("int"), **covers})
    source = _in("source")
    # pairs are distinct already: a category's feeds are its rows
    edges = p.filter(F.col("section") == "edge").groupBy("key").agg(F.count("of").cast("double").alias("value"))
    widest = p.filter(source).orderBy(F.desc("width_max"), "key").limit(1).select(
        F.lit("most_versatile_source").alias("section"), "key", F.col("width_max").cast("double").alias("value"))
    return union(
        pass_totals(p, "totals", {"total_feeds": F.col("n"), "avg_categories": F.round(F.try_divide("width_sum", "width_n"), 4), "max_categories": F.col("width_max"),
                                  "min_categories": F.col("width_min")},
                    {"multi_category_sources": source & (F.col("width_max") > 1), "single_category_sources": source & (F.col("single_sum") > 0),
                     "unique_sources": source & (F.col("width_max") > 0), **{f"covering_{t}": source & (F.col(f"{t}_max") > 0) for t in covers}}),
        edges.agg(F.lit("totals").alias("section"), F.lit("unique_categories").alias("key"), F.count("key").cast("double").alias("value")),
        edges.orderBy(F.desc("value"), "key").limit(1).select(F.lit("most_covered_category").alias("section"), "key", "value"), widest)


def numbered_categories(feeds: DataFrame) -> DataFrame:
    """(category, no): categories in order, from 0; the numbering is one sorted pass over that dimension."""
    return feed_edges(feeds).select("category").distinct().withColumn("no", F.row_number().over(W.orderBy("category")).cast("long") - 1)


def coverage_bitmaps(feeds: DataFrame) -> DataFrame:
    """(source, bucket, bits): the numbers of a source's categories as bitmaps, one per 32,768 numbers."""
    # bit positions and buckets of the bitmap functions count from 1
    edges = feed_edges(feeds).join(numbered_categories(feeds), "category").withColumn("at", F.col("no") + 1)
    return edges.groupBy("source", F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))


def coverage(feeds: DataFrame) -> DataFrame:
    """(source, covered, missing, shared): per source its categories, those it lacks, and those that every source has.  Bitmaps are ORed and ANDed; no
    pair of source and category that is not covered is made."""
    bits = materialize(coverage_bitmaps(feeds))
    known = bits.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("known"), F.bitmap_and_agg("bits").alias("common"),
                                       F.count(F.lit(1)).alias("sources"))
    n_sources = bits.select("source").distinct().agg(F.count(F.lit(1)).alias("c")).scalar()
    totals = known.agg(F.sum("known").alias("known"), F.sum(F.when(F.col("sources") == n_sources, F.bitmap_count("common")).otherwise(0)).alias("shared"))
    per_source = bits.groupBy("source").agg(F.sum(F.bitmap_count("bits")).alias("covered"))
    return per_source.select("source", "covered", (totals.select("known").scalar() - F.col("covered")).alias("missing"), totals.select("shared").scalar().alias("shared"))


def coverage_matrix(feeds: DataFrame) -> DataFrame:
    """Every (source, category) with a flag: the whole grid, for an explicit report; :func:`coverage` needs none.  Sources meet the numbers of
    the categories, not a list of them, and the grid takes names and flags by equi-joins."""
    edges, names = feed_edges(feeds), numbered_categories(feeds)
    last = names.agg(F.max("no").alias("m")).scalar()
    grid = feeds.select("source").distinct().select("source", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("no")).join(names, "no")
    return grid.join(edges.withColumn("covers", F.lit(True)), ["source", "category"], "left").select(
        "source", "category", F.coalesce("covers", F.lit(False)).alias("covers"))


def dataset_quality(datasets: dict, articles: DataFrame, failed=()) -> DataFrame:
    """Completeness per dataset, word counts, freshness and load success rate; one scan of each dataset and one of the articles."""
    completeness = materialize(union(*[metrics(d, "completeness", **{n: F.count(F.lit(1))}) for n, d in datasets.items()]))
    issues = completeness.filter("value = 0").select(F.lit("issue_empty").alias("section"), "key", "value")
    total = len(datasets) + len(failed)
    words = X.word_count("title", "body")
    rate = 100.0 * len(datasets) / total if total else 0.0
    ok = completeness.agg(F.lit("operations").alias("section"), F.lit("success_rate").alias("key"), (F.lit(rate) + 0 * F.count(F.lit(1))).alias("value"))
    return union(
        completeness, issues, ok,
        metrics(articles, "content", total_articles=F.count(F.lit(1)), avg_word_count=F.round(F.avg(words), 4),
                max_word_count=F.max(words), min_word_count=F.min(words), image_percentage=pct(F.col("has_image")),
                newest=F.max(F.unix_timestamp("published_on")), oldest=F.min(F.unix_timestamp("published_on"))))


HLL_BITS = 14   # 2^14 registers: a standard error of 0.8 % of a distinct count
KLL_SIZE = 800  # ranks of quantiles within about 0.4 %


def day_sketches(df: DataFrame, ts: str, distinct: list, quantile: list) -> DataFrame:
    """(date, n, d_<column>, q_<column>): one mergeable sketch a day for the distinct values and the quantiles of columns; kept as a table, a day is
    added without reading others."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(
        F.count(F.lit(1)).alias("n"), *[F.hll_sketch_agg(F.col(c), F.lit(HLL_BITS)).alias(f"d_{c}") for c in distinct],
        *[F.kll_sketch_agg_bigint(F.col(c).cast("bigint"), KLL_SIZE).alias(f"q_{c}") for c in quantile])


def sketched_profile(days: DataFrame, start=None, end=None, ranks=(0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """(section, key, value) of a range of days from their sketches: rows, distinct counts, quantiles (null without rows)."""
    if start is not None:
        days = days.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        days = days.filter(F.col("date") <= F.lit(end).cast("date"))
    distinct, quantile = ([c for c in days.columns if c.startswith(p)] for p in ("d_", "q_"))
    row = days.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in distinct],
                   *[F.kll_merge_agg_bigint(c).alias(c) for c in quantile])
    pairs = [("rows", "rows", F.col("n")), *[("distinct", c[2:], F.col(c)) for c in distinct],
             *[(f"quantile_{r}", c[2:], F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint(c, F.lit(r).cast("double")))) for c in quantile for r in ranks]]
    return row.select(F.inline(F.array(*[F.struct(F.lit(s).alias("section"), F.lit(k).alias("key"), v.cast("double").alias("value")) for s, k, v in pairs])))


def _length_aggs(long_body: int) -> list:
    n, long = F.count(F.lit(1)), F.count_if(F.col("len") >= long_body)
    return [
        n.alias("n"), F.countDistinct("source_name").alias("sources"),
        F.floor(100 * long / n).alias("long_pct_floor"), F.round(100.0 * long / n, 1).alias("long_pct"),
        F.floor(F.avg("len")).alias("body_mean"), F.max("len").alias("body_max"),
        F.to_date(F.min("published_on")).alias("date_min"), F.to_date(F.max("published_on")).alias("date_max")]


def _length_medians(base: DataFrame, by: list) -> DataFrame:
    """Exact lower and upper medians from counts per distinct length: no list of all lengths is collected."""
    per_len = base.groupBy(*by, "len").agg(F.count(F.lit(1)).alias("c"))
    run = W.partitionBy(*by).orderBy("len").rowsBetween(W.unboundedPreceding, 0)
    ranked = per_len.select(*by, "len", F.sum("c").over(run).alias("upto"), F.sum("c").over(W.partitionBy(*by)).alias("n"))
    at = lambda pos: F.min(F.when(F.col("upto") > pos, F.col("len")))
    return ranked.groupBy(*by).agg(
        at(F.floor(F.col("n") / 2)).alias("upper_median"), at(F.floor((F.col("n") - 1) / 2)).alias("lower_median"))


def _with_length(articles: DataFrame) -> DataFrame:
    return articles.withColumn("len", F.coalesce(F.col("body_length"), F.lit(0)).cast("bigint"))


def batch_body_metrics(articles: DataFrame, long_body: int = rules.MIN_BODY_LENGTH) -> DataFrame:
    """Counts, floor-percentage of long bodies, upper median and maximum length, date range of one batch."""
    base = _with_length(articles)
    upper = _length_medians(base, []).select("upper_median").scalar()
    return base.agg(*_length_aggs(long_body)).drop("body_mean").withColumn("upper_median", upper)


def length_stats(articles: DataFrame, long_body: int = rules.MIN_BODY_LENGTH) -> DataFrame:
    """Body statistics per ``dataset`` value with exact medians."""
    base = _with_length(articles)
    stats = base.groupBy("dataset").agg(*_length_aggs(long_body))
    return stats.join(_length_medians(base, ["dataset"]), "dataset").withColumn(
        "body_median", F.floor((F.col("lower_median") + F.col("upper_median")) / 2)).drop("lower_median")


def compare_batches(articles: DataFrame, left: str, right: str) -> DataFrame:
    """The statistics of two datasets side by side, one row per metric."""
    stats = length_stats(articles)
    names = ["n", "sources", "long_pct", "body_median", "body_mean", "body_max"]
    rows = stats.select("dataset", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names])))
    pick = lambda d: F.max(F.when(F.col("dataset") == d, F.col("value")))
    return rows.groupBy("metric").agg(pick(left).alias("left_value"), pick(right).alias("right_value"))


def compare_profiles(old: DataFrame, new: DataFrame, changed_by: float = 10.0) -> DataFrame:
    """Deltas of two article profiles plus rule-based insight rows."""
    keep = F.col("section").isin("totals", "top_sources", "top_categories")
    a = old.filter(keep).withColumnRenamed("value", "old_value")
    b = new.filter(keep).withColumnRenamed("value", "new_value")
    both = a.join(b, ["section", "key"], "full_outer")
    total = F.col("section") == "totals"
    delta = F.coalesce("new_value", F.lit(0.0)) - F.coalesce("old_value", F.lit(0.0))
    change = F.round(F.try_divide(delta, F.col("old_value")) * 100, 2)
    named = lambda k: total & (F.col("key") == k)
    insight = (
        F.when(named("total_articles") & (delta > 0), "VOLUME_INCREASE")
        .when(named("total_articles") & (delta < 0), "VOLUME_DECREASE")
        .when(named("unique_sources") & (delta > 0), "DIVERSITY_INCREASE")
        .when(named("unique_sources") & (delta < 0), "DIVERSITY_DECREASE")
        .when(named("avg_length") & (F.abs(change) > changed_by), "CONTENT_LENGTH_CHANGE")
        .when((F.col("section") == "top_categories") & F.col("old_value").isNull(), "NEW_TOPICS")
    )
    presence = F.when(F.col("old_value").isNull(), "new").when(F.col("new_value").isNull(), "gone").otherwise("common")
    return both.select("section", "key", "old_value", "new_value", F.round(delta, 4).alias("delta"),
                       change.alias("change_pct"), presence.alias("presence"), insight.alias("insight"))


def data_profile(df: DataFrame, entity: str, ts: str, enums=(), top: int = 20, approximate: bool = False) -> DataFrame:
    """Row count, time range, distinct entities; per column of ``enums`` the ``top`` most frequent values (a top-n
    section) and the number of distinct values."""
    distinct = F.approx_count_distinct(entity, 0.01) if approximate else F.countDistinct(entity)
    base = metrics(df, "table", rows=F.count(F.lit(1)), entities=distinct,
                   first=F.unix_timestamp(F.min(ts)), last=F.unix_timestamp(F.max(ts)))
    parts = [base]
    for c in enums:
        values = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("key")).agg(
            F.count(F.lit(1)).cast("double").alias("value"))
        parts.append(values.orderBy(F.desc("value"), "key").limit(top).select(F.lit(f"enum_{c}").alias("section"), "key", "value"))
    if enums:
        count = (lambda c: F.approx_count_distinct(c, 0.01)) if approximate else F.countDistinct
        parts.append(metrics(df, "distinct", **{c: count(c) for c in enums}))
    return union(*parts)

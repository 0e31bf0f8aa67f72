"""Queries over articles: enrichment, news features, reports, profiles, relational operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.functions import rules, text as X
from newsmill.operators import keys as K, merge, profiles as P
from newsmill.plans import news, reports as Rp
from newsmill.registry import query
from newsmill.registry.views import with_views
from newsmill.session import materialize
from newsmill.sources import readers

NOW = "2024-01-20 12:00:00"
TS = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
PUB = TS.format("published_on")
WORD = "[^\\p{L}\\p{N}_]"


# ---- enrichment ----------------------------------------------------------------------------------

def names_sql(names, text):
    """Entities whose name occurs as a whole word in ``text``, in table order."""
    hits = ", ".join(
        f"CASE WHEN regexp_matches({text}, '(^|{WORD}){n.replace('.', chr(92) + '.')}($|{WORD})') THEN '{e}' END" for n, e in names.items() if len(n) > 3)
    return f"list_filter([{hits}], lambda x: x IS NOT NULL)"


def event_sql(patterns, text="lower(title)"):
    """WHEN branches of ordered whole-word patterns."""
    return " ".join(f"WHEN regexp_matches({text}, '(^|{WORD})({p.replace(chr(92) + 'w', '[' + chr(92) + 'p{L}' + chr(92) + 'p{N}_]')})($|{WORD})') THEN '{n}'" for n, p in patterns)


TOKENS_SQL = f"""
    tok AS (SELECT id, upper(trim(t)) AS t, pos FROM (SELECT id, unnest(string_split(coalesce(categories, ''), '|')) AS t,
            generate_subscripts(string_split(coalesce(categories, ''), '|'), 1) AS pos FROM v_articles)),
    ent AS (SELECT id, CASE t WHEN 'BTC' THEN 'bitcoin' WHEN 'ETH' THEN 'ethereum' WHEN 'SOL' THEN 'solana' WHEN 'XRP' THEN 'ripple' END AS e, pos FROM tok),
    ents AS (SELECT id, list(e ORDER BY pos) AS tl FROM ent WHERE e IS NOT NULL GROUP BY id),
    nm AS (SELECT id, {names_sql(rules.NAME_ENTITIES, "lower(title || ' ' || body)")} AS nl FROM v_articles),
    both_lists AS (SELECT a.id, list_concat(coalesce(tl, []), list_filter(nl, lambda x: NOT list_contains(coalesce(tl, []), x))) AS l FROM v_articles a LEFT JOIN ents e ON e.id = a.id JOIN nm ON nm.id = a.id),
    mapped AS (SELECT id, CASE WHEN len(l) > 0 THEN array_to_string(l, '|') WHEN EXISTS (SELECT 1 FROM tok WHERE tok.id = b.id AND t IN ('MARKET', 'TRADING')) THEN 'bitcoin' ELSE '' END AS entities FROM both_lists b)"""


@query("map_entities", f"WITH {TOKENS_SQL} SELECT id, entities FROM mapped")
def _(v):
    return v.articles.select("id", X.map_entities("categories", "title", "body").alias("entities"))


NAMES = {"the": "the-entity", "ring": "ring-entity", "elle": "elle-entity", "ouaux": "x1", "tion": "tion-entity"}


@query("map_names", f"""
    SELECT id, array_to_string({names_sql(NAMES, "t")}, '|') AS entities FROM (SELECT id, lower(title || ' ' || body) AS t FROM v_articles)""")
def _(v):
    """Whole-word names in title and body, overlapping and with marks; names of three letters or fewer are skipped."""
    return v.articles.select("id", X.map_entities("categories", "title", "body", tokens={"": ""}, names=NAMES, proxy=None).alias("entities"))


@query("source_tier", """
    SELECT source_name, CASE WHEN source_name IN ('CoinDesk', 'Reuters') THEN 1 WHEN source_name = 'Bitcoin World' THEN 3 ELSE 2 END AS tier, count(*) AS n FROM v_articles GROUP BY ALL""")
def _(v):
    return v.articles.groupBy("source_name", X.source_tier("source_name").alias("tier")).agg(F.count(F.lit(1)).alias("n"))


PATTERNS = [("SHORT_WORDS", r"de|la"), ("NUMBERS", r"\d+"), ("STEM", r"ther|wh"), ("LONG", r"the\s+\w+")]


@query("classify_event", f"""
    SELECT id, CASE WHEN categories LIKE 'REGULATION%' THEN 'REGULATION' WHEN categories = 'FIAT' THEN 'MACRO' {event_sql(PATTERNS)} ELSE 'OTHER' END AS event_type FROM v_articles""")
def _(v):
    """Category rule first, then ordered whole-word title patterns."""
    return v.articles.select("id", X.classify_event("categories", "title", title_events=PATTERNS).alias("event_type"))


EVENT_TYPE_SQL = f"CASE WHEN categories LIKE 'REGULATION%' THEN 'REGULATION' WHEN categories = 'FIAT' THEN 'MACRO' {event_sql(rules.TITLE_EVENTS)} ELSE 'OTHER' END"


@query("classify_event_default", f"SELECT {EVENT_TYPE_SQL} AS event_type, count(*) AS n FROM v_articles GROUP BY ALL")
def _(v):
    return v.articles.groupBy(X.classify_event("categories", "title").alias("event_type")).agg(F.count(F.lit(1)).alias("n"))


def _probs(v):
    u = lambda salt: (F.pmod(F.col("id") * salt, F.lit(97)) + 1) / 100.0
    return v.articles.select("id", *[u(s).alias(f"{part}_{c}") for s, part, c in (
        (3, "title", "pos"), (5, "title", "neg"), (7, "title", "neu"), (11, "body", "pos"), (13, "body", "neg"), (17, "body", "neu"))])


@query("score_articles", f"""
    WITH {TOKENS_SQL}, p AS (SELECT id, {", ".join(f"(id * {s} % 97 + 1) / 100.0 AS {n}" for s, n in ((3, "tp"), (5, "tn"), (7, "tu"), (11, "bp"), (13, "bn"), (17, "bu")))} FROM v_articles)
    SELECT a.id AS news_id, {PUB}, CAST(round(tp - tn, 6) AS DOUBLE) + 0.0 AS title_score, CAST(round(bp - bn, 6) AS DOUBLE) + 0.0 AS body_score,
           CAST(round(CAST(0.4 AS DOUBLE) * round(tp - tn, 6) + CAST(0.6 AS DOUBLE) * round(bp - bn, 6), 6) AS DOUBLE) + 0.0 AS composite_score, CAST(round(greatest(bp, bn, bu), 6) AS DOUBLE) AS confidence,
           {EVENT_TYPE_SQL} AS event_type,
           CASE WHEN source_name IN ('CoinDesk', 'Reuters') THEN 1 WHEN source_name = 'Bitcoin World' THEN 3 ELSE 2 END AS source_tier, entities, 'm1' AS model_version
    FROM v_articles a JOIN p ON p.id = a.id JOIN mapped m ON m.id = a.id
    WHERE body_length >= 300 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = a.id AND l.quality = 1)""")
def _(v):
    """Articles without a row of this model version in the score table (here: the quality labels)."""
    done = v.table("labels").select(F.col("doc_id").alias("news_id"), F.when(F.col("quality") == 1, "m1").otherwise("m0").alias("model_version"))
    return news.score_articles(v.articles, _probs(v), done, "m1")


@query("unscored_batch", f"""
    SELECT id, {PUB} FROM v_articles a WHERE body_length >= 300 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = a.id)
    ORDER BY published_on, id LIMIT 64""")
def _(v):
    """Oldest unscored articles, one work unit."""
    done = v.table("labels").select(F.col("doc_id").alias("news_id"), F.lit("m1").alias("model_version"))
    rows = K.unprocessed(v.articles.filter("body_length >= 300"), done, "id", "news_id", "m1")
    return K.oldest_batch(rows.select("id", "published_on"), ["published_on", "id"], 64)


@query("url_id", """
    SELECT id, url, CAST(CASE WHEN h >= 9223372036854775808::HUGEINT THEN h - 18446744073709551616::HUGEINT ELSE h END AS BIGINT) AS url_id
    FROM (SELECT id, url, CAST(CAST('0x' || left(sha1(url), 16) AS UBIGINT) AS HUGEINT) AS h FROM v_articles)""")
def _(v):
    return v.articles.select("id", "url", X.url_id("url").alias("url_id"))


@query("model_text", """
    SELECT id, CASE WHEN trim(body) = '' THEN 'neutral market news' ELSE body END AS text FROM v_articles""")
def _(v):
    return v.articles.select("id", X.model_text("body").alias("text"))


@query("article_metadata", """
    SELECT id, CAST(len(list_filter(regexp_split_to_array(title || ' ' || body, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '')) AS BIGINT) AS word_count, CAST(imageurl <> '' AS BIGINT) AS has_image FROM v_articles""")
def _(v):
    return readers.article_metadata(v.articles, ("title", "body")).select("id", "word_count", "has_image")


@query("event_magnitude", """
    SELECT event_id, grp, CASE grp WHEN 'listing' THEN 0.08::DOUBLE WHEN 'hack_exploit' THEN -0.15 WHEN 'regulatory' THEN -0.05 WHEN 'partnership' THEN 0.04 ELSE 0 END AS magnitude
    FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'hack_exploit' WHEN 'purchase' THEN 'listing' WHEN 'click' THEN 'regulatory' WHEN 'signup' THEN 'partnership' END AS grp FROM events)""")
def _(v):
    rows = v.scores.select(F.col("news_id").alias("event_id"), X.event_group("event_type").alias("grp"))
    return rows.withColumn("magnitude", X.event_magnitude("grp"))


SIGNALS_SQL = """
    WITH x AS (SELECT news_id, composite_score AS s, event_type, source_tier, published_on, CAST(published_on AS DATE) AS date, unnest(entities) AS entity,
                      CASE source_tier WHEN 1 THEN 2.0 WHEN 3 THEN 0.4 ELSE 1.0 END::DOUBLE AS w FROM v_scores),
    j AS (SELECT x.*, a.tags FROM x JOIN v_event_articles a ON a.id = x.news_id),
    days AS (SELECT DISTINCT CAST(published_on AS DATE) AS date FROM v_scores s JOIN v_event_articles a ON a.id = s.news_id),
    spine AS (SELECT DISTINCT x.entity, d.date FROM days d JOIN x ON x.date BETWEEN d.date - 7 AND d.date),
    cnt AS (SELECT entity, date, count(*) AS n FROM x GROUP BY ALL),
    one AS (SELECT entity, date, sum(s * w) / sum(w) AS s1, count(*) AS n1, bool_or(contains(lower(coalesce(tags, '')), 'breaking') AND hour(published_on) >= 20) AS brk,
                   bool_or(event_type = 'REGULATION') AS reg, bool_or(event_type = 'HACK_EXPLOIT') AS sec, bool_or(event_type = 'ADOPTION_PARTNERSHIP') AS ado,
                   count(*) FILTER (WHERE source_tier = 1) AS t1, count(*) FILTER (WHERE coalesce(source_tier, 2) = 2) AS t2, count(*) FILTER (WHERE source_tier = 3) AS t3 FROM j GROUP BY ALL),
    r3 AS (SELECT p.entity, p.date, sum(s * w) / sum(w) AS s3, count(*) AS n3 FROM spine p JOIN x ON x.entity = p.entity AND x.date BETWEEN p.date - 3 AND p.date GROUP BY ALL),
    r7 AS (SELECT p.entity, p.date, sum(s * w) / sum(w) AS s7 FROM spine p JOIN x ON x.entity = p.entity AND x.date BETWEEN p.date - 7 AND p.date GROUP BY ALL),
    bl AS (SELECT p.entity, p.date, avg(n) AS m, CASE WHEN count(n) > 1 THEN greatest(stddev_samp(n), 0.01) ELSE 1 END AS sd FROM spine p LEFT JOIN cnt c ON c.entity = p.entity AND c.date BETWEEN p.date - 30 AND p.date - 1 GROUP BY ALL)
    SELECT p.entity, CAST(p.date AS VARCHAR) AS date, round(coalesce(s1, 0), 6) AS news_sentiment_1d, round(coalesce(s3, 0), 6) AS news_sentiment_3d, round(s7, 6) AS news_sentiment_7d,
        round(round(coalesce(s1, 0), 6) - round(s7, 6), 6) + 0.0 AS news_sentiment_momentum, coalesce(n1, 0) AS news_volume_1d, coalesce(n3, 0) AS news_volume_3d,
        round((coalesce(n1, 0) - coalesce(m, 0)) / sd, 4) + 0.0 AS news_volume_zscore_1d, CAST(coalesce(brk, false) AS BIGINT) AS news_breaking_flag, CAST(coalesce(reg, false) AS BIGINT) AS news_regulation_flag,
        CAST(coalesce(sec, false) AS BIGINT) AS news_security_flag, CAST(coalesce(ado, false) AS BIGINT) AS news_adoption_flag, round(coalesce(s1, 0), 6) AS news_source_quality,
        coalesce(t1, 0) AS news_tier1_count_1d, coalesce(t2, 0) AS news_tier2_count_1d, coalesce(t3, 0) AS news_tier3_count_1d
    FROM spine p LEFT JOIN one USING (entity, date) LEFT JOIN r3 USING (entity, date) LEFT JOIN r7 USING (entity, date) LEFT JOIN bl USING (entity, date)"""
FROM_DAY, TO_DAY = "2024-01-11", "2024-01-24"


def days_of(statement, name):
    """A registered statement cut to the days of the ranged queries."""
    return f"SELECT * FROM ({with_views(statement)}) {name} WHERE date BETWEEN '{FROM_DAY}' AND '{TO_DAY}'"


@query("news_signals", SIGNALS_SQL)
def _(v):
    return news.news_signals(v.scores, v.event_articles)


@query("news_signals_range", days_of(SIGNALS_SQL, "whole"))
def _(v):
    """Two weeks, from no more than their look-back."""
    return news.news_signals(v.scores, v.event_articles, FROM_DAY, TO_DAY)


HOURS = [("listing", "ADOPTION_PARTNERSHIP"), ("hack_exploit", "HACK_EXPLOIT"), ("regulatory", "REGULATION"),
         ("partnership", "ETF_INSTITUTIONAL"), ("tokenomics", "WHALE_MOVEMENT"), ("macro", "MACRO")]
GRP_CASE = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{g}'" for g, e in HOURS) + " END"


EVENTS_SQL = f"""
    WITH x AS (SELECT CAST(published_on AS DATE) AS date, published_on, unnest(entities) AS entity, {GRP_CASE} AS grp FROM v_scores),
    days AS (SELECT date, count(*) AS total FROM x GROUP BY date),
    spine AS (SELECT entity, date, total FROM (SELECT DISTINCT entity FROM x) CROSS JOIN days),
    cnt AS (SELECT entity, date, count(*) AS n FROM x GROUP BY ALL),
    dom AS (SELECT entity, date, grp AS event_type FROM (SELECT entity, date, grp, row_number() OVER (PARTITION BY entity, date ORDER BY count(*) DESC, grp) AS rn FROM x WHERE grp IS NOT NULL GROUP BY entity, date, grp) WHERE rn = 1),
    rec AS (SELECT p.entity, p.date, {", ".join(f"max(published_on) FILTER (WHERE grp = '{g}') AS l_{g}" for g, _ in HOURS)} FROM spine p LEFT JOIN x ON x.entity = p.entity AND x.date <= p.date GROUP BY ALL),
    bl AS (SELECT p.entity, p.date, coalesce(sum(c.n), 0) / 30.0 AS m, coalesce(sum(c.n * c.n), 0) / 30.0 AS q FROM spine p LEFT JOIN cnt c ON c.entity = p.entity AND c.date BETWEEN p.date - 30 AND p.date - 1 GROUP BY ALL)
    SELECT p.entity, CAST(p.date AS VARCHAR) AS date, event_type,
        {", ".join(f"CASE WHEN l_{g} IS NOT NULL THEN greatest(0, round((epoch(CAST(p.date AS TIMESTAMP)) + 86399 - epoch_us(l_{g}) / 1e6) / 3600, 2)) END AS hours_since_{g}" for g, _ in HOURS)},
        CASE event_type WHEN 'listing' THEN 0.08 WHEN 'hack_exploit' THEN -0.15 WHEN 'regulatory' THEN -0.05 WHEN 'partnership' THEN 0.04 ELSE 0 END::DOUBLE AS magnitude_est,
        coalesce(n, 0) AS event_count_24h, round((coalesce(n, 0) - m) / greatest(sqrt(greatest(q - m * m, 0)), 0.1), 4) + 0.0 AS news_surprise, round(coalesce(n, 0) / total, 4) AS cross_news_ratio
    FROM spine p LEFT JOIN cnt USING (entity, date) LEFT JOIN dom USING (entity, date) LEFT JOIN rec USING (entity, date) LEFT JOIN bl USING (entity, date)"""


@query("news_events", EVENTS_SQL)
def _(v):
    return news.news_events(v.scores)


@query("news_events_range", days_of(EVENTS_SQL, "whole"))
def _(v):
    """Two weeks, with what lies before them as a seed."""
    return news.news_events(v.scores, FROM_DAY, TO_DAY)


@query("dominant_event", """
    SELECT CAST(date AS VARCHAR) AS date, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY n DESC, event_type) AS rn
        FROM (SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n FROM events GROUP BY ALL)) WHERE rn = 1""")
def _(v):
    n = v.table("events").groupBy(F.to_date("ts").alias("date"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return K.first_per_key(n, "date", [F.desc("n"), F.col("event_type")])


# ---- predicates, search, top-k -------------------------------------------------------------------

@query("exclude_sources", """
    SELECT count(*) FILTER (WHERE source NOT IN ('src3', 'src4')) AS kept, count(*) FILTER (WHERE source IN ('src3', 'src4')) AS removed FROM v_articles""")
def _(v):
    return K.exclude_with_counts(v.articles, "source", ["src3", "src4"])


@query("window_filter", f"""
    SELECT id, {PUB} FROM v_articles WHERE published_on BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-06 12:00:00'""")
def _(v):
    return K.window_filter(v.articles.select("id", "published_on"), "published_on", "2024-01-05 00:00:00", "2024-01-06 12:00:00")


@query("within_hours", f"SELECT id, {PUB} FROM v_articles WHERE published_on >= TIMESTAMP '{NOW}' - INTERVAL 36 HOUR")
def _(v):
    return K.within_hours(v.articles.select("id", "published_on"), "published_on", 36, F.lit(NOW).cast("timestamp"))


@query("category_contains", "SELECT id, categories FROM v_articles WHERE categories LIKE '%MARKET%' AND categories LIKE '%TRADING%'")
def _(v):
    c = F.col("categories")
    return v.articles.select("id", "categories").filter(c.contains("MARKET") & c.contains("TRADING"))


@query("search_articles", f"""
    SELECT id, {PUB}, source_name, CASE WHEN title ILIKE '%there%' THEN 'title' WHEN body ILIKE '%there%' THEN 'body' ELSE 'both' END AS found_in, left(body, 200) AS preview
    FROM v_articles WHERE title ILIKE '%there%' OR body ILIKE '%there%'""")
def _(v):
    return Rp.search(v.articles, "there").select("id", "published_on", "source_name", "found_in", F.left("body", F.lit(200)).alias("preview"))


@query("without_body", "SELECT id, source_name, url FROM v_articles WHERE body IS NULL OR body = '' OR body_length = 0")
def _(v):
    return Rp.without_body(v.articles).select("id", "source_name", "url")


@query("entity_mentions", "SELECT count(*) AS n, round(avg(composite_score), 8) AS avg_score FROM v_scores WHERE list_contains(entities, 'c3')")
def _(v):
    rows = v.scores.filter(F.array_contains("entities", "c3"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("composite_score"), 8).alias("avg_score"))


@query("universe_filter", "SELECT entity, count(*) AS n FROM v_daily_bars WHERE entity IN ('s01', 's05', 's07') GROUP BY entity")
def _(v):
    return v.daily_bars.filter(F.col("entity").isin("s01", "s05", "s07")).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))


@query("latest_articles", f"SELECT id, {PUB} FROM v_articles ORDER BY published_on DESC, id LIMIT 10")
def _(v):
    return K.top_k(v.articles.select("id", "published_on"), [F.desc("published_on"), "id"], 10)


@query("longest_articles", "SELECT id, source_name, body_length FROM v_articles ORDER BY body_length DESC, id LIMIT 10")
def _(v):
    return K.top_k(v.articles.select("id", "source_name", "body_length"), [F.desc("body_length"), "id"], 10)


@query("net_votes", "SELECT id, upvotes, downvotes, upvotes - downvotes AS net_votes FROM v_articles WHERE upvotes > 0 OR downvotes > 0 ORDER BY net_votes DESC, id LIMIT 10")
def _(v):
    return Rp.net_votes(v.articles).select("id", "upvotes", "downvotes", "net_votes")


@query("latest_day_rows", "SELECT entity, CAST(date AS VARCHAR) AS date, round(close, 8) AS close FROM v_daily_bars WHERE date = (SELECT max(date) FROM v_daily_bars)")
def _(v):
    return Rp.latest_rows(v.daily_bars).select("entity", "date", F.round("close", 8).alias("close"))


# ---- joins and set operations --------------------------------------------------------------------

@query("score_article_join", "SELECT tags, count(*) AS n, round(avg(composite_score), 8) AS avg_score FROM v_scores s JOIN v_event_articles a ON a.id = s.news_id GROUP BY tags")
def _(v):
    rows = v.scores.join(v.event_articles.withColumnRenamed("id", "news_id"), "news_id")
    return rows.groupBy("tags").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("composite_score"), 8).alias("avg_score"))


@query("duplicate_urls", "SELECT url, count(*) AS duplicate_count FROM v_articles GROUP BY url HAVING count(*) > 1")
def _(v):
    return K.duplicate_groups(v.articles, "url")


@query("duplicate_title_pairs", """
    SELECT a.id AS id1, b.id AS id2, a.url AS url1, b.url AS url2 FROM v_articles a JOIN v_articles b ON a.title = b.title
    WHERE a.id < b.id AND a.id = (SELECT min(c.id) FROM v_articles c WHERE c.title = b.title)""")
def _(v):
    """Linear in the duplicates: every repeat is paired with the first article of its title."""
    return K.duplicate_pairs(v.articles, "title", "id", ["url"]).select("id1", "id2", "url1", "url2")


@query("duplicate_title_members", """
    SELECT a.id, g.first_id, g.group_size FROM v_articles a JOIN (SELECT title, min(id) AS first_id, count(*) AS group_size FROM v_articles GROUP BY title HAVING count(*) > 1) g ON g.title = a.title""")
def _(v):
    return K.duplicate_members(v.articles.select("id", "title"), "title", "id").select("id", "first_id", "group_size")


@query("unscored_anti_join", "SELECT id FROM v_articles a WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = a.id AND l.toxic = 0)")
def _(v):
    done = v.table("labels").select(F.col("doc_id").alias("news_id"), F.col("toxic").cast("string").alias("model_version"))
    return K.unprocessed(v.articles.select("id"), done, "id", "news_id", "0")


@query("fetch_gaps", """
    WITH h AS (SELECT DISTINCT date_trunc('hour', fetched_at) AS hour FROM v_articles),
    s AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM h)
    SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, 'No data' AS status FROM s WHERE hour NOT IN (SELECT hour FROM h)""")
def _(v):
    return Rp.fetch_gaps(v.articles, None)


@query("fetch_gaps_newest", """
    WITH h AS (SELECT DISTINCT date_trunc('hour', fetched_at) AS hour FROM v_articles),
    s AS (SELECT unnest(generate_series(min(hour), TIMESTAMP '2024-02-02 05:00:00', INTERVAL 1 HOUR)) AS hour FROM h)
    SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, 'No data' AS status FROM (SELECT hour FROM s EXCEPT SELECT hour FROM h) ORDER BY hour DESC LIMIT 20""")
def _(v):
    return Rp.fetch_gaps(v.articles, 20, "2024-02-02 05:00:00")


@query("hours_except", """
    SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour FROM (SELECT date_trunc('hour', ts) AS hour FROM events WHERE event_type = 'view' EXCEPT SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'error')""")
def _(v):
    hours = lambda t: v.table("events").filter(F.col("event_type") == t).select(F.date_trunc("hour", "ts").alias("hour"))
    return hours("view").subtract(hours("error"))


@query("source_activity", f"""
    SELECT source, before AS yesterday, n - before AS today, n - 2 * before AS change
    FROM (SELECT source_name AS source, count(*) AS n, count(*) FILTER (published_on < DATE '2024-01-20') AS before FROM v_articles WHERE published_on >= DATE '2024-01-19' GROUP BY ALL)""")
def _(v):
    return Rp.source_activity(v.articles, "2024-01-20")


@query("full_outer_change", """
    WITH a AS (SELECT source_name, count(*) AS n FROM v_articles WHERE lang = 'EN' GROUP BY 1), b AS (SELECT source_name, count(*) AS n FROM v_articles WHERE lang = 'FR' GROUP BY 1)
    SELECT coalesce(a.source_name, b.source_name) AS source_name, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS after, coalesce(b.n, 0) - coalesce(a.n, 0) AS change
    FROM a FULL OUTER JOIN b ON a.source_name = b.source_name""")
def _(v):
    side = lambda lang: v.articles.filter(F.col("lang") == lang).groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))
    return Rp.full_outer_change(side("EN"), side("FR"), "source_name", "n")


@query("known_urls", "SELECT id FROM v_articles WHERE url IN (SELECT url FROM v_articles WHERE lang = 'FR')")
def _(v):
    known = v.articles.filter("lang = 'FR'").select("url")
    return v.articles.select("id", "url").join(known, "url", "left_semi").select("id")


@query("key_set_coverage", """
    WITH l AS (SELECT DISTINCT doc_id AS id FROM documents), r AS (SELECT DISTINCT doc_id + 50 AS id FROM labels)
    SELECT (SELECT count(*) FROM (SELECT * FROM l INTERSECT SELECT * FROM r)) AS in_both, (SELECT count(*) FROM (SELECT * FROM l EXCEPT SELECT * FROM r)) AS only_left,
           (SELECT count(*) FROM (SELECT * FROM r EXCEPT SELECT * FROM l)) AS only_right,
           round(100.0 * (SELECT count(*) FROM (SELECT * FROM l INTERSECT SELECT * FROM r)) / (SELECT count(*) FROM l), 4) AS coverage_pct""")
def _(v):
    left = v.table("documents").select(F.col("doc_id").alias("id"))
    return K.key_set_coverage(left, v.table("labels").select((F.col("doc_id") + 50).alias("id")), "id")


@query("union_of_keys", "SELECT DISTINCT e AS entity FROM (SELECT unnest(entities) AS e FROM v_scores UNION SELECT event_type FROM events)")
def _(v):
    a = v.scores.select(F.explode("entities").alias("entity"))
    return a.unionByName(v.table("events").select(F.col("event_type").alias("entity"))).distinct()


@query("news_days", "SELECT DISTINCT CAST(CAST(published_on AS DATE) AS VARCHAR) AS date FROM v_scores")
def _(v):
    return v.scores.select(F.to_date("published_on").alias("date")).distinct()


# ---- aggregations and reports --------------------------------------------------------------------

@query("table_stats", """
    SELECT count(*) AS articles, count(DISTINCT source_name) AS sources, strftime(min(published_on), '%Y-%m-%d %H:%M:%S') AS oldest, strftime(max(published_on), '%Y-%m-%d %H:%M:%S') AS newest,
           CAST(epoch(max(published_on)) - epoch(min(published_on)) AS BIGINT) AS span_seconds FROM v_articles""")
def _(v):
    return P.table_stats(v.articles)


@query("articles_per_source", """
    SELECT source_name, count(*) AS articles, round(avg(body_length), 4) AS avg_length, min(body_length) AS min_length, max(body_length) AS max_length FROM v_articles GROUP BY source_name""")
def _(v):
    return Rp.per_source(v.articles)


@query("sources_having", "SELECT source_name, count(*) AS articles FROM v_articles GROUP BY source_name HAVING count(*) >= 10")
def _(v):
    return Rp.per_source(v.articles, 10).select("source_name", "articles")


@query("top_sources", "SELECT source_name, count(*) AS articles FROM v_articles GROUP BY source_name ORDER BY articles DESC, source_name LIMIT 5")
def _(v):
    return K.top_k(Rp.per_source(v.articles).select("source_name", "articles"), [F.desc("articles"), "source_name"], 5)


@query("articles_per_hour", "SELECT strftime(date_trunc('hour', published_on), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS articles, round(avg(body_length), 4) AS avg_length FROM v_articles GROUP BY 1")
def _(v):
    return Rp.per_hour(v.articles)


@query("hourly_trend_48h", f"SELECT strftime(date_trunc('hour', published_on), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS articles, round(avg(body_length), 4) AS avg_length FROM v_articles WHERE published_on >= TIMESTAMP '{NOW}' - INTERVAL 48 HOUR GROUP BY 1")
def _(v):
    return Rp.per_hour(v.articles, NOW, 48)


@query("articles_per_day", "SELECT CAST(CAST(published_on AS DATE) AS VARCHAR) AS date, count(*) AS articles, count(DISTINCT source_name) AS sources, round(avg(body_length), 4) AS avg_length FROM v_articles GROUP BY 1")
def _(v):
    return Rp.per_day(v.articles)


@query("category_frequency", "SELECT category, count(*) AS frequency FROM (SELECT unnest(string_split(categories, '|')) AS category FROM v_articles WHERE categories IS NOT NULL AND categories <> '') GROUP BY category")
def _(v):
    return Rp.category_frequency(v.articles)


@query("trending_categories", f"""
    SELECT category, count(*) AS frequency FROM (SELECT unnest(string_split(categories, '|')) AS category FROM v_articles WHERE categories <> '' AND published_on >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR)
    GROUP BY category ORDER BY frequency DESC, category LIMIT 15""")
def _(v):
    return Rp.category_frequency(v.articles, NOW, 24, 15)


@query("share_of_total", "SELECT CAST(has_image AS BIGINT) AS has_image, count(*) AS articles, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percentage FROM v_articles GROUP BY has_image")
def _(v):
    return Rp.share_of_total(v.articles, "has_image")


@query("last_day_stats", f"""
    SELECT count(*) AS articles, count(DISTINCT source_name) AS sources, count(*) FILTER (WHERE body_length >= 300) AS long_bodies,
           CAST(coalesce(floor(100 * count(*) FILTER (WHERE body_length >= 300) / nullif(count(*), 0)), 0) AS BIGINT) AS long_pct, coalesce(round(avg(body_length), 0), 0) AS avg_length
    FROM v_articles WHERE fetched_at >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR""")
def _(v):
    return Rp.last_day_stats(v.articles, NOW)


RATE = """SELECT '{0}' AS period, count(*) AS hours, CAST(coalesce(sum(c), 0) AS BIGINT) AS total, coalesce(round(avg(c), 1), 0) AS avg_per_hour, coalesce(max(c), 0) AS max_per_hour
    FROM (SELECT date_trunc('hour', published_on) AS h, count(DISTINCT url) AS c FROM v_articles WHERE {1} GROUP BY 1)"""
CUT = "TIMESTAMP '2024-01-15 00:00:00'"


@query("ingest_rate", " UNION ALL ".join(RATE.format(n, c) for n, c in (
    ("last_24h", f"fetched_at >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR"),
    ("live", f"fetched_at >= {CUT} AND published_on >= TIMESTAMP '2024-01-20'"), ("baseline", f"fetched_at < {CUT}"))))
def _(v):
    return Rp.ingest_rate(v.articles, NOW, "2024-01-15 00:00:00")


@query("hour_bars", "SELECT strftime(h, '%Y-%m-%d %H:00') AS hour, c AS urls, repeat('#', CAST(least(45, c) AS INT)) AS bar FROM (SELECT date_trunc('hour', published_on) AS h, count(DISTINCT url) AS c FROM v_articles GROUP BY 1)")
def _(v):
    return Rp.hour_bars(v.articles)


@query("missing_fields", f"""
    UNPIVOT (SELECT count(*) - count(nullif(title, '')) AS "Missing Title", count(*) - count(nullif(url, '')) AS "Missing URL", count(*) - count(nullif(source, '')) AS "Missing Source",
        count(*) FILTER (published_on > TIMESTAMP '{NOW}') AS "Future Published Date" FROM v_articles) ON COLUMNS(*) INTO NAME issue VALUE count""")
def _(v):
    return Rp.missing_fields(v.articles, NOW)


# ---- profiles ------------------------------------------------------------------------------------

def long_sql(section, frm, **aggs):
    """Oracle helper: one row per aggregate."""
    return " UNION ALL ".join(f"SELECT '{section}' AS section, '{k}' AS key, CAST(({a}) AS DOUBLE) AS value FROM {frm}" for k, a in aggs.items())


def top_sql(section, key, frm, n=None):
    lim = f"ORDER BY value DESC, key LIMIT {n}" if n else ""
    return f"SELECT * FROM (SELECT '{section}' AS section, {key} AS key, CAST(count(*) AS DOUBLE) AS value FROM {frm} GROUP BY ALL {lim})"


CATS = "(SELECT unnest(string_split(categories, '|')) AS v FROM {0} WHERE categories <> '')"
TAGS = "(SELECT unnest(string_split(tags, '|')) AS v FROM {0} WHERE tags <> '')"


def profile_sql(frm):
    return " UNION ALL ".join([
        long_sql("totals", frm, total_articles="count(*)", unique_sources="count(DISTINCT coalesce(source, ''))", avg_length="round(avg(length(body)), 2)",
                 min_length="min(length(body))", max_length="max(length(body))", image_percentage="round(100.0 * count(*) FILTER (WHERE imageurl <> '') / count(*), 2)",
                 time_span_minutes="round((epoch(max(published_on)) - epoch(min(published_on))) / 60, 2)"),
        long_sql("totals", CATS.format(frm), unique_categories="count(DISTINCT v)"), long_sql("totals", TAGS.format(frm), unique_tags="count(DISTINCT v)"),
        top_sql("top_sources", "source_name", frm, 10), top_sql("top_categories", "v", CATS.format(frm), 15), top_sql("top_tags", "v", TAGS.format(frm), 15)])


@query("article_profile", profile_sql("v_articles"))
def _(v):
    return P.article_profile(v.articles)


@query("compare_profiles", f"""
    WITH o AS (SELECT * FROM ({profile_sql("(SELECT * FROM v_articles WHERE lang = 'EN')")}) WHERE section <> 'top_tags'),
         n AS (SELECT * FROM ({profile_sql("(SELECT * FROM v_articles WHERE lang = 'FR')")}) WHERE section <> 'top_tags'),
         b AS (SELECT coalesce(o.section, n.section) AS section, coalesce(o.key, n.key) AS key, o.value AS old_value, n.value AS new_value, coalesce(n.value, 0) - coalesce(o.value, 0) AS d
               FROM o FULL OUTER JOIN n ON o.section = n.section AND o.key = n.key)
    SELECT section, key, old_value, new_value, round(d, 4) + 0.0 AS delta, round(d / nullif(old_value, 0) * 100, 2) + 0.0 AS change_pct,
        CASE WHEN old_value IS NULL THEN 'new' WHEN new_value IS NULL THEN 'gone' ELSE 'common' END AS presence,
        CASE WHEN section = 'totals' AND key = 'total_articles' AND d > 0 THEN 'VOLUME_INCREASE' WHEN section = 'totals' AND key = 'total_articles' AND d < 0 THEN 'VOLUME_DECREASE'
             WHEN section = 'totals' AND key = 'unique_sources' AND d > 0 THEN 'DIVERSITY_INCREASE' WHEN section = 'totals' AND key = 'unique_sources' AND d < 0 THEN 'DIVERSITY_DECREASE'
             WHEN section = 'totals' AND key = 'avg_length' AND abs(round(d / nullif(old_value, 0) * 100, 2)) > 10 THEN 'CONTENT_LENGTH_CHANGE' WHEN section = 'top_categories' AND old_value IS NULL THEN 'NEW_TOPICS' END AS insight
    FROM b""")
def _(v):
    side = lambda lang: P.article_profile(v.articles.filter(F.col("lang") == lang))
    return P.compare_profiles(side("EN"), side("FR"))


def _sources(v):
    return v.table("supplier").select(
        F.col("s_suppkey").alias("ID"), F.col("s_name").alias("NAME"), F.col("s_name").alias("SOURCE_KEY"),
        F.floor("s_acctbal").cast("string").alias("BENCHMARK_SCORE"), F.when(F.col("s_nationkey") > 4, "ACTIVE").otherwise("INACTIVE").alias("STATUS"),
        F.when(F.col("s_acctbal") > 5000, "RSS").otherwise("API").alias("SOURCE_TYPE"), F.concat(F.lit("L"), F.col("s_nationkey").cast("string")).alias("LANG"))


SRC = "(SELECT *, CAST(floor(s_acctbal) AS BIGINT) AS sc FROM supplier)"


@query("source_profile", " UNION ALL ".join([
    long_sql("totals", SRC, total_sources="count(*)", active_sources="count(*) FILTER (WHERE s_nationkey > 4)", avg_score="round(avg(sc), 4)", max_score="max(sc)", min_score="min(sc)"),
    top_sql("score_distribution", "CASE WHEN sc >= 70 THEN 'excellent' WHEN sc >= 60 THEN 'good' WHEN sc >= 50 THEN 'average' ELSE 'below_average' END", SRC),
    top_sql("source_types", "CASE WHEN s_acctbal > 5000 THEN 'RSS' ELSE 'API' END", SRC), top_sql("languages", "'L' || s_nationkey", SRC),
    f"SELECT * FROM (SELECT 'top_sources' AS section, s_name AS key, CAST(sc AS DOUBLE) AS value FROM {SRC} ORDER BY sc DESC, s_name LIMIT 10)"]))
def _(v):
    return P.source_profile(_sources(v))


def _categories(v):
    return v.table("part").select(
        F.col("p_partkey").alias("ID"), F.col("p_name").alias("NAME"), F.when(F.col("p_size") > 10, "ACTIVE").otherwise("OLD").alias("STATUS"),
        F.when(F.col("p_size") % 3 == 0, F.repeat(F.lit("w,"), "p_size")).alias("INCLUDED_WORDS"), F.when(F.col("p_size") % 5 == 0, F.col("p_brand")).alias("INCLUDED_PHRASES"))


@query("category_profile", " UNION ALL ".join([
    long_sql("totals", "part", total_categories="count(*)", active_categories="count(*) FILTER (WHERE p_size > 10)", with_words="count(*) FILTER (WHERE p_size % 3 = 0 AND p_size > 0)", with_phrases="count(*) FILTER (WHERE p_size % 5 = 0)"),
    """SELECT * FROM (SELECT 'top_by_complexity' AS section, p_name AS key, CAST(CASE WHEN p_size % 3 = 0 THEN 2 * p_size ELSE 0 END + CASE WHEN p_size % 5 = 0 THEN length(p_brand) ELSE 0 END AS DOUBLE) AS value FROM part ORDER BY 3 DESC, p_name LIMIT 10)""",
    """SELECT 'category_types' AS section, c AS key, CAST(count(*) AS DOUBLE) AS value FROM (SELECT CASE WHEN regexp_matches(lower(p_name), 'btc|eth|ada|sol|xrp|doge|matic') THEN 'tokens' WHEN regexp_matches(lower(p_name), 'defi|nft|market|trading|policy|regulation') THEN 'topics'
       WHEN regexp_matches(lower(p_name), 'airdrop|launch|upgrade|fork|hack') THEN 'events' END AS c FROM part) WHERE c IS NOT NULL GROUP BY c"""]))
def _(v):
    return P.category_profile(_categories(v))


def _content(v):
    return v.articles.select(
        F.when(F.col("upvotes") > 6, "POSITIVE").when(F.col("upvotes") > 3, "NEUTRAL").alias("SENTIMENT"), F.col("source").alias("SOURCE_KEY"),
        F.regexp_replace("categories", "[|]", ", ").alias("CATEGORIES"), F.concat_ws(",", "source_name", F.lit(" staff ")).alias("AUTHORS"),
        F.col("tags").alias("KEYWORDS"), F.col("imageurl").alias("IMAGE_URL"), F.col("body_length").cast("string").alias("BODY_LENGTH"), F.lit("ACTIVE").alias("STATUS"))


@query("content_profile", " UNION ALL ".join([
    long_sql("totals", "v_articles", total_articles="count(*)", avg_body_length="round(avg(body_length), 4)", max_body_length="max(body_length)", min_body_length="min(body_length)", image_percentage="round(100.0 * count(*) FILTER (WHERE imageurl <> '') / count(*), 2)"),
    long_sql("totals", "v_articles", unique_authors="count(DISTINCT source_name) + 1"),
    top_sql("sentiment", "CASE WHEN upvotes > 6 THEN 'POSITIVE' WHEN upvotes > 3 THEN 'NEUTRAL' ELSE 'UNKNOWN' END", "v_articles"), top_sql("source", "source", "v_articles"),
    top_sql("top_categories", "trim(v)", CATS.format("v_articles"), 15), top_sql("top_keywords", "v", TAGS.format("v_articles"), 15), top_sql("status", "'ACTIVE'", "v_articles")]))
def _(v):
    return P.content_profile(_content(v))


GROUPS_CASE = [("trading_related", "markets|trading|price|analysis|technical"), ("tech_related", "tech|technology|blockchain|defi|nft|web3"),
               ("policy_related", "policy|regulation|legal|government|sec"), ("business_related", "business|finance|corporate|investment|funding")]


@query("category_groups", " UNION ALL ".join([
    long_sql("insights", "part", total_categories="count(*)", **{f"has_{w}": f"max(CAST(contains(lower(p_name), '{w}') AS INT))" for w in ("market", "defi", "policy", "nft")}),
    f"""SELECT 'classification' AS section, v AS key, CAST(count(*) AS DOUBLE) AS value FROM (SELECT unnest(CASE WHEN len(c) = 0 THEN ['other'] ELSE c END) AS v FROM
        (SELECT list_filter([{", ".join(f"CASE WHEN regexp_matches(lower(p_name || ' ' || p_type), '{p}') THEN '{n}' END" for n, p in GROUPS_CASE)}], lambda x: x IS NOT NULL) AS c FROM part)) GROUP BY v""",
    "SELECT * FROM (SELECT 'top_terms' AS section, v AS key, CAST(count(*) AS DOUBLE) AS value FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS v FROM part) WHERE length(v) > 2 GROUP BY v ORDER BY 3 DESC, v LIMIT 5)"]))
def _(v):
    return P.category_groups(v.table("part"), "p_name", "p_type")


@query("source_groups", long_sql("sources", "v_articles", total_sources="count(*)", has_coindesk="max(CAST(contains(lower(source_name), 'coindesk') AS INT))", has_reuters="max(CAST(contains(lower(source_name), 'reuters') AS INT))",
                                 has_bloomberg="max(CAST(contains(lower(source_name), 'bloomberg') AS INT))", n_crypto_specific="count(*) FILTER (WHERE regexp_matches(lower(source_name), 'crypto|coin|bitcoin|blockchain'))",
                                 n_mainstream="count(*) FILTER (WHERE regexp_matches(lower(source_name), 'reuters|bloomberg|wall street|financial times'))"))
def _(v):
    return P.source_groups(v.articles, "source_name", "source_name")


def _feeds(v):
    return v.articles.select(F.col("source_name").alias("source"), F.explode(X.label_tokens("categories")).alias("c")).groupBy("source").agg(
        F.array_sort(F.collect_set("c")).alias("categories"))


FEEDS_SQL = "edges AS (SELECT DISTINCT source_name AS source, upper(trim(c)) AS category FROM (SELECT source_name, unnest(string_split(categories, '|')) AS c FROM v_articles WHERE categories <> '')), feeds AS (SELECT source, count(*) AS n FROM edges GROUP BY source)"


@query("feed_coverage", f"WITH {FEEDS_SQL} " + " UNION ALL ".join([
    long_sql("totals", "feeds", total_feeds="count(*)", avg_categories="round(avg(n), 4)", max_categories="max(n)", min_categories="min(n)", multi_category_sources="count(*) FILTER (WHERE n > 1)", single_category_sources="count(*) FILTER (WHERE n = 1)"),
    long_sql("totals", "edges", unique_sources="count(DISTINCT source)", unique_categories="count(DISTINCT category)", covering_markets="count(DISTINCT source) FILTER (WHERE contains(lower(category), 'market'))",
             covering_policy="count(DISTINCT source) FILTER (WHERE contains(lower(category), 'policy') OR contains(lower(category), 'regulation'))", covering_tech="count(DISTINCT source) FILTER (WHERE regexp_matches(lower(category), 'tech|defi|nft'))"),
    top_sql("most_covered_category", "category", "edges", 1),
    "SELECT * FROM (SELECT 'most_versatile_source' AS section, source AS key, CAST(n AS DOUBLE) AS value FROM feeds ORDER BY n DESC, source LIMIT 1)"]))
def _(v):
    return P.feed_coverage(_feeds(v))


@query("coverage_matrix", f"""WITH {FEEDS_SQL}
    SELECT s.source, c.category, CAST(e.source IS NOT NULL AS BIGINT) AS covers FROM (SELECT DISTINCT source FROM edges) s CROSS JOIN (SELECT DISTINCT category FROM edges) c LEFT JOIN edges e ON e.source = s.source AND e.category = c.category""")
def _(v):
    return P.coverage_matrix(_feeds(v))


@query("coverage", f"""WITH {FEEDS_SQL}, k AS (SELECT count(DISTINCT category) AS known FROM edges),
    sh AS (SELECT count(*) AS shared FROM (SELECT category FROM edges GROUP BY category HAVING count(*) = (SELECT count(*) FROM feeds)))
    SELECT source, n AS covered, known - n AS missing, shared FROM feeds, k, sh""")
def _(v):
    return P.coverage(_feeds(v))


RANKS = (0.25, 0.5, 0.75, 0.95)


@query("approximate_profile", """
    SELECT unnest(['rows', 'distinct url', 'distinct body_length', 'quantile_0.25', 'quantile_0.5', 'quantile_0.75', 'quantile_0.95']) AS metric,
        unnest([count(*), count(DISTINCT url), count(DISTINCT body_length), NULL, NULL, NULL, NULL]) AS exact, 1 AS within FROM v_articles""")
def _(v):
    """Sketches per day, merged over all days, against the exact figures: distinct counts within 3 %, quantiles within 2 % of their rank (three standard
    errors and more)."""
    rows = v.articles.select("url", "body_length", "published_on")
    found = materialize(P.sketched_profile(P.day_sketches(rows, "published_on", ["url", "body_length"], ["body_length"]), ranks=RANKS))
    estimate = lambda section, key: found.filter((F.col("section") == section) & (F.col("key") == key)).select("value").scalar()
    n, length = F.count(F.lit(1)), F.col("body_length")
    checks = [("rows", n, n == estimate("rows", "rows"))]
    for c in ("url", "body_length"):
        exact = F.countDistinct(c)
        checks.append((f"distinct {c}", exact, F.abs(estimate("distinct", c) - exact) <= 0.03 * exact))
    for r in RANKS:
        value = estimate(f"quantile_{r}", "body_length")
        inside = (F.count_if(length < value) / n <= r + 0.02) & (F.count_if(length <= value) / n >= r - 0.02)
        checks.append((f"quantile_{r}", F.lit(None).cast("long"), inside))
    wide = rows.agg(*[c.alias(f"{p}{i}") for i, (_, exact, near) in enumerate(checks) for p, c in (("e", exact), ("w", near.cast("int")))])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"e{i}").alias("exact"), F.col(f"w{i}").alias("within"))
                                          for i, (m, _, _) in enumerate(checks)])))


@query("dataset_quality", " UNION ALL ".join([
    *[long_sql("completeness", t, **{t: "count(*)"}) for t in ("supplier", "part", "documents")],
    long_sql("completeness", "documents WHERE doc_id < 0", empty="count(*)"), "SELECT 'issue_empty' AS section, 'empty' AS key, CAST(0 AS DOUBLE) AS value", "SELECT 'operations' AS section, 'success_rate' AS key, CAST(80 AS DOUBLE) AS value",
    long_sql("content", "(SELECT *, len(list_filter(regexp_split_to_array(title || ' ' || body, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '')) AS w FROM v_articles)", total_articles="count(*)", avg_word_count="round(avg(w), 4)", max_word_count="max(w)", min_word_count="min(w)",
             image_percentage="round(100.0 * count(*) FILTER (WHERE has_image) / count(*), 2)", newest="epoch(max(published_on))", oldest="epoch(min(published_on))")]))
def _(v):
    sets = {t: v.table(t) for t in ("supplier", "part", "documents")}
    sets["empty"] = v.table("documents").filter("doc_id < 0")
    return P.dataset_quality(sets, v.articles, failed=["feeds"])


LEN = "v_articles"


@query("batch_body_metrics", """
    SELECT count(*) AS n, count(DISTINCT source_name) AS sources, CAST(floor(100 * count(*) FILTER (WHERE body_length >= 300) / count(*)) AS BIGINT) AS long_pct_floor, round(100.0 * count(*) FILTER (WHERE body_length >= 300) / count(*), 1) AS long_pct,
        max(body_length) AS body_max, CAST(CAST(min(published_on) AS DATE) AS VARCHAR) AS date_min, CAST(CAST(max(published_on) AS DATE) AS VARCHAR) AS date_max, list_sort(list(body_length))[count(*) // 2 + 1] AS upper_median FROM v_articles""")
def _(v):
    return P.batch_body_metrics(v.articles)


@query("compare_batches", """
    WITH s AS (SELECT lang, count(*) AS n, count(DISTINCT source_name) AS sources, round(100.0 * count(*) FILTER (WHERE body_length >= 300) / count(*), 1) AS long_pct, floor(median(body_length)) AS body_median, floor(avg(body_length)) AS body_mean, max(body_length) AS body_max FROM v_articles GROUP BY lang),
    u AS (SELECT lang, unnest(['n', 'sources', 'long_pct', 'body_median', 'body_mean', 'body_max']) AS metric, unnest([CAST(n AS DOUBLE), sources, long_pct, body_median, body_mean, body_max]) AS value FROM s)
    SELECT metric, max(value) FILTER (WHERE lang = 'EN') AS left_value, max(value) FILTER (WHERE lang = 'FR') AS right_value FROM u GROUP BY metric""")
def _(v):
    return P.compare_batches(v.articles.withColumn("dataset", F.col("lang")), "EN", "FR")


@query("data_profile", " UNION ALL ".join([
    long_sql("table", "orders", rows="count(*)", entities="count(DISTINCT o_custkey)", first="epoch(min(o_orderdate))", last="epoch(max(o_orderdate))"),
    top_sql("enum_o_orderstatus", "o_orderstatus", "orders"), top_sql("enum_o_orderpriority", "o_orderpriority", "orders"),
    top_sql("enum_o_custkey", "CAST(o_custkey AS VARCHAR)", "orders", 20),
    long_sql("distinct", "orders", o_orderstatus="count(DISTINCT o_orderstatus)", o_orderpriority="count(DISTINCT o_orderpriority)", o_custkey="count(DISTINCT o_custkey)")]))
def _(v):
    return P.data_profile(v.table("orders"), "o_custkey", "o_orderdate", ["o_orderstatus", "o_orderpriority", "o_custkey"])


# ---- upserts on frames ---------------------------------------------------------------------------

@query("merge_update", """
    WITH i AS (SELECT doc_id, arg_max(quality, toxic * 10 + quality) + 10 AS q FROM labels GROUP BY doc_id)
    SELECT doc_id, q FROM i UNION ALL SELECT doc_id, CAST(n_chars % 7 AS BIGINT) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM i)""")
def _(v):
    target = v.table("documents").select("doc_id", (F.col("n_chars") % 7).alias("q"))
    incoming = v.table("labels").select("doc_id", (F.col("quality") + 10).cast("bigint").alias("q"), (F.col("toxic") * 10 + F.col("quality")).alias("o"))
    fresh = K.first_per_key(incoming, "doc_id", F.desc("o")).drop("o")
    return merge.merge_update(target, fresh, ["doc_id"], ["q"])


@query("merge_ignore", """
    WITH t AS (SELECT url, min(id) AS id FROM v_articles WHERE lang = 'EN' GROUP BY url)
    SELECT url, id FROM t UNION ALL SELECT url, min(id) FROM v_articles WHERE url NOT IN (SELECT url FROM t) GROUP BY url""")
def _(v):
    target = v.articles.filter("lang = 'EN'").groupBy("url").agg(F.min("id").alias("id"))
    return merge.merge_ignore(target, v.articles.select("url", "id"), ["url"], ["id"])


@query("merge_counts", """
    SELECT count(DISTINCT url) FILTER (WHERE url NOT IN (SELECT url FROM v_articles WHERE lang = 'EN')) AS inserted,
           count(*) - count(DISTINCT url) FILTER (WHERE url NOT IN (SELECT url FROM v_articles WHERE lang = 'EN')) AS duplicates, 0 AS errors FROM v_articles""")
def _(v):
    return merge.merge_counts(v.articles.filter("lang = 'EN'"), v.articles, ["url"])


@query("valid_keys", "SELECT CAST(o_orderpriority[1] AS BIGINT) AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def _(v):
    key = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(F.left("o_orderpriority", F.lit(1)))
    return merge.valid_keys(v.table("orders").select(key.alias("k")), "k").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("remap_report", """
    WITH s AS (SELECT news_id, entities AS o, list_transform(entities, lambda x: CASE WHEN x = 'c9' THEN 'c1' ELSE x END) AS n FROM v_scores)
    SELECT 'changed_rows' AS metric, count(*) FILTER (WHERE list_sort(list_distinct(o)) <> list_sort(list_distinct(n))) AS value FROM s
    UNION ALL SELECT 'distinct_before', count(DISTINCT e) FROM (SELECT unnest(o) AS e FROM s) UNION ALL SELECT 'distinct_after', count(DISTINCT e) FROM (SELECT unnest(n) AS e FROM s)""")
def _(v):
    rows = v.scores.withColumn("n", F.transform("entities", lambda x: F.when(x == "c9", "c1").otherwise(x)))
    return merge.remap_report(rows, "entities", "n")


# ---- feeds ---------------------------------------------------------------------------------------

def _items(v):
    a = v.articles
    return a.select(
        F.col("url").alias("link"), "title", F.date_format("published_on", "yyyy-MM-dd HH:mm:ss").alias("pubDate"),
        F.when(F.col("upvotes") > 5, F.col("source")).otherwise("").alias("sourceKey"), F.col("source_name").alias("source"), F.col("categories").alias("category"),
        F.when(F.col("lang") != "EN", F.col("lang")).alias("lang"), F.col("imageurl").alias("image"), F.lit(None).cast("string").alias("imageurl"), "body",
        (F.col("upvotes") % 2).alias("feed_rank"), F.floor(F.col("id") / 50).alias("page"), F.col("id").alias("pos"))


@query("feed_pages_to_articles", """
    SELECT link, pos FROM (SELECT url AS link, id AS pos, upvotes % 2 AS r, row_number() OVER (PARTITION BY url ORDER BY upvotes % 2, id // 50, id) AS rn FROM v_articles) WHERE rn = 1 ORDER BY r, pos LIMIT 100""")
def _(v):
    return readers.feed_pages_to_articles(_items(v), 100).select("link", "pos")


@query("normalize_articles", f"""
    SELECT url, {PUB}, CASE WHEN upvotes > 5 THEN source ELSE source_name END AS source, source_name, coalesce(categories, '') AS categories, '' AS tags, CASE WHEN lang <> 'EN' THEN lang ELSE 'EN' END AS lang,
           body_length, CAST(imageurl <> '' AS BIGINT) AS has_image, imageurl FROM v_articles""")
def _(v):
    return readers.normalize_articles(_items(v)).select("url", "published_on", "source", "source_name", "categories", "tags", "lang", "body_length", "has_image", "imageurl")


@query("missing_attribute", """
    SELECT 'source' AS kind, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name FROM supplier WHERE s_acctbal < 0 UNION ALL SELECT 'category', CAST(p_partkey AS VARCHAR), p_name FROM part""")
def _(v):
    s = v.table("supplier").select(F.col("s_suppkey").alias("ID"), F.col("s_name").alias("NAME"), F.when(F.col("s_acctbal") >= 0, "x").alias("ENDPOINT"))
    p = v.table("part").select(F.col("p_partkey").alias("ID"), F.col("p_name").alias("NAME"))
    return readers.missing_attribute({"source": s, "category": p}, "ENDPOINT")

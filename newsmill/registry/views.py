"""Article, bar, signal and ledger views over the driver tables, in Spark and (for the oracles) in SQL.

Entities are mapped from keys so that every row of a table takes part; nothing is filtered or sampled."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmill.plans import market
from newsmill.sources.readers import utc_columns

SQL_VIEWS = {
    "v_daily_bars": """
        SELECT entity, date, CAST(date AS TIMESTAMP) + INTERVAL 86399 SECOND AS ts, open, high, low, close, volume, market_cap, discount
        FROM (SELECT 's' || lpad(CAST(l_suppkey % 20 AS VARCHAR), 2, '0') AS entity, CAST(l_shipdate AS DATE) AS date,
              arg_min(l_extendedprice / l_quantity, l_orderkey * 10 + l_linenumber) AS open,
              max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
              arg_max(l_extendedprice / l_quantity, l_orderkey * 10 + l_linenumber) AS close,
              sum(l_quantity) AS volume, sum(l_extendedprice) AS market_cap, avg(l_discount) AS discount
              FROM lineitem GROUP BY ALL)""",
    "v_hourly_bars": """
        SELECT event_type AS entity, date_trunc('hour', ts) AS ts, 100 + arg_min(value, event_id) AS open, 100 + max(value) AS high,
               100 + min(value) AS low, 100 + arg_max(value, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume
        FROM events GROUP BY ALL""",
    "v_articles": """
        SELECT doc_id AS id, split_part(text, '.', 1) AS title,
               TIMESTAMP '2024-01-01' + (doc_id % 720) * INTERVAL 1 HOUR + (doc_id % 60) * INTERVAL 1 MINUTE AS published_on,
               TIMESTAMP '2024-01-01' + ((doc_id % 720) // 3 * 3 + 3) * INTERVAL 1 HOUR AS fetched_at,
               source, CASE source WHEN 'src0' THEN 'CoinDesk' WHEN 'src1' THEN 'Reuters' WHEN 'src2' THEN 'Bitcoin World' ELSE source END AS source_name,
               'https://x/' || source || '/' || md5(text) AS url,
               CASE WHEN n_chars < 100 THEN '' ELSE text END AS body,
               CASE WHEN n_chars < 100 THEN 0 ELSE length(text) END AS body_length,
               CASE doc_id % 8 WHEN 0 THEN 'BTC|MARKET' WHEN 1 THEN 'ETH|SOL' WHEN 2 THEN 'MARKET|TRADING' WHEN 3 THEN 'REGULATION|BTC'
                    WHEN 4 THEN 'FIAT' WHEN 5 THEN '' WHEN 6 THEN NULL ELSE 'xrp | ETH|OTHER' END AS categories,
               CASE n_chars % 3 WHEN 0 THEN 'Breaking News|alert' WHEN 1 THEN NULL ELSE 'daily' END AS tags,
               upper(lang) AS lang, n_chars % 2 = 0 AS has_image,
               CASE WHEN n_chars % 2 = 0 THEN 'https://img/' || doc_id ELSE '' END AS imageurl,
               n_chars % 13 AS upvotes, n_chars % 5 AS downvotes
        FROM documents""",
    "v_scores": """
        SELECT event_id AS news_id, ts AS published_on, value / (value + 20) * 2 - 1 AS composite_score,
               CASE event_type WHEN 'error' THEN 'HACK_EXPLOIT' WHEN 'purchase' THEN 'ADOPTION_PARTNERSHIP'
                    WHEN 'click' THEN 'REGULATION' WHEN 'signup' THEN 'ETF_INSTITUTIONAL' ELSE NULL END AS event_type,
               nullif(k % 4, 0) AS source_tier,
               CASE WHEN k < 3 THEN NULL WHEN user_id % 10 = user_id % 7 THEN ['c' || (user_id % 10)]
                    ELSE ['c' || (user_id % 10), 'c' || (user_id % 7)] END AS entities
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)""",
    "v_event_articles": """
        SELECT event_id AS id, CASE WHEN k >= 70 THEN 'Alert|Breaking News' WHEN k < 10 THEN NULL ELSE 'daily' END AS tags
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) WHERE value > 1.0""",
    "v_labels": """
        SELECT entity, date, close, r1, r3, r7, r14,
            CASE WHEN r1 > 0.03 THEN 1 WHEN r1 < -0.03 THEN -1 WHEN r1 IS NOT NULL THEN 0 END AS label_1d,
            CASE WHEN r3 > 0.05 THEN 1 WHEN r3 < -0.05 THEN -1 WHEN r3 IS NOT NULL THEN 0 END AS label_3d,
            CASE WHEN r7 > 0.07 THEN 1 WHEN r7 < -0.07 THEN -1 WHEN r7 IS NOT NULL THEN 0 END AS label_7d,
            CASE WHEN r14 > 0.10 THEN 1 WHEN r14 < -0.10 THEN -1 WHEN r14 IS NOT NULL THEN 0 END AS label_14d
        FROM (SELECT a.entity, a.date, a.close,
              (coalesce(b1.close, b2.close, b3.close) - a.close) / a.close AS r1,
              (coalesce(b3.close, b4.close, b5.close) - a.close) / a.close AS r3,
              (coalesce(b7.close, b8.close, b9.close) - a.close) / a.close AS r7,
              (coalesce(b14.close, b15.close, b16.close) - a.close) / a.close AS r14
              FROM v_daily_bars a """ + "\n".join(
        f"LEFT JOIN v_daily_bars b{k} ON b{k}.entity = a.entity AND b{k}.date = a.date + {k}"
        for k in (1, 2, 3, 4, 5, 7, 8, 9, 14, 15, 16)) + ")",
    "v_signals": """
        SELECT b.entity, b.date, round(b.discount - 0.05, 6) + 0.0 AS signal_score, 1 AS model_id,
               l.r1 AS forward_ret_1d, l.r3 AS forward_ret_3d, l.r7 AS forward_ret_7d, l.label_3d,
               CASE WHEN round(b.discount - 0.05, 6) > 0.01 THEN 1 WHEN round(b.discount - 0.05, 6) < -0.01 THEN -1 ELSE 0 END AS pred
        FROM v_daily_bars b JOIN v_labels l ON l.entity = b.entity AND l.date = b.date""",
    "v_market_index": """
        SELECT date, CAST(date_diff('day', DATE '1970-01-01', date) % 101 AS DOUBLE) AS market_index
        FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)""",
    "v_trades": """
        SELECT o_orderkey AS id, c_mktsegment AS entity, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'industry' ELSE 'consumer' END AS category,
               upper(left(c_mktsegment, 4)) AS symbol, CASE WHEN o_orderkey % 2 = 0 THEN 'BUY' ELSE 'SHORT' END AS direction,
               o_totalprice / 1000 AS entry_price, o_totalprice / 1000 * (1 + (o_orderkey % 37 - 18) / 173.0) AS exit_price,
               1000000 / o_totalprice AS quantity, CAST(1000 + (o_custkey % 5) * 100 AS DOUBLE) AS usdt_size,
               (o_custkey % 21 - 10) / 100.0 AS signal_score,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'bull_trend' WHEN '2' THEN 'bear_trend' WHEN '3' THEN 'range_bound' ELSE 'high_vol' END AS regime_state,
               CASE WHEN o_orderstatus = 'P' THEN 'OPEN' ELSE 'CLOSED' END AS status, o_orderdate AS entry_time,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + (o_orderkey % 5) * INTERVAL 1 DAY END AS exit_time,
               round(o_totalprice % 200 - 100, 2) AS pnl_usdt, (o_orderkey % 37 - 18) / 173.0 AS pnl_pct,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'take_profit' WHEN '2' THEN 'stop_loss' WHEN '3' THEN 'expiry_3d' WHEN '4' THEN 'trailing_stop' ELSE 'account_reset' END AS notes
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "v_closed": "SELECT * FROM v_trades WHERE status = 'CLOSED'",
}


def with_views(body: str) -> str:
    """Prefix the CTEs a statement refers to, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_[a-z_]+\b", text):
            if name in SQL_VIEWS and name not in order:
                visit(SQL_VIEWS[name])
                if name not in order:
                    order.append(name)

    visit(body)
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n].strip()})" for n in order)
    body = body.strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


# the same views with events alone: entities c0 .. c9 that have bars, scores and an index on the same days
COIN_VIEWS = {
    "v_daily_bars": """
        SELECT entity, date, CAST(date AS TIMESTAMP) + INTERVAL 86399 SECOND AS ts, open, high, low, close, volume, market_cap, discount
        FROM (SELECT 'c' || (user_id % 10) AS entity, CAST(ts AS DATE) AS date, 100 + arg_min(value, event_id) AS open, 100 + max(value) AS high,
              100 + min(value) AS low, 100 + arg_max(value, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume, sum(value) AS market_cap,
              avg(value) / 1000 AS discount FROM events GROUP BY ALL)""",
    "v_hourly_bars": """
        SELECT 'c' || (user_id % 10) AS entity, date_trunc('hour', ts) AS ts, 100 + arg_min(value, event_id) AS open, 100 + max(value) AS high,
               100 + min(value) AS low, 100 + arg_max(value, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume
        FROM events GROUP BY ALL""",
    "v_market_index": """
        SELECT date, CAST(date_diff('day', DATE '1970-01-01', date) % 101 AS DOUBLE) AS market_index FROM (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events)""",
}


def coin_sql(statement: str) -> str:
    """A registered statement over COIN_VIEWS, with c0 as the benchmark."""
    for name, sql in COIN_VIEWS.items():
        statement = statement.replace(SQL_VIEWS[name].strip(), sql.strip())
    return statement.replace("entity <> 'view'", "entity <> 'c0'").replace("entity = 'view'", "entity = 'c0'").replace("entity = 's00'", "entity = 'c0'")


class Views:
    """Lazily built frames over one data folder."""

    bench_daily, bench_hourly = "s00", "view"

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return utc_columns(self.spark.read.parquet(f"{self.dir}/{name}.parquet"))

    @cached_property
    def daily_bars(self) -> DataFrame:
        price = F.col("l_extendedprice") / F.col("l_quantity")
        pos = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        bars = self.table("lineitem").groupBy(
            F.concat(F.lit("s"), F.lpad((F.col("l_suppkey") % 20).cast("string"), 2, "0")).alias("entity"),
            F.to_date("l_shipdate").alias("date"),
        ).agg(
            F.min_by(price, pos).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
            F.max_by(price, pos).alias("close"), F.sum("l_quantity").alias("volume"),
            F.sum("l_extendedprice").alias("market_cap"), F.avg("l_discount").alias("discount"))
        return bars.withColumn("ts", F.col("date").cast("timestamp") + F.expr("INTERVAL 86399 SECONDS"))

    @property
    def bars(self) -> DataFrame:
        """Daily bars without the derived day column."""
        return self.daily_bars.drop("date")

    @cached_property
    def hourly_bars(self) -> DataFrame:
        return self.table("events").groupBy(
            F.col("event_type").alias("entity"), F.date_trunc("hour", "ts").alias("ts")).agg(
            (100 + F.min_by("value", "event_id")).alias("open"), (100 + F.max("value")).alias("high"),
            (100 + F.min("value")).alias("low"), (100 + F.max_by("value", "event_id")).alias("close"), F.count(F.lit(1)).cast("double").alias("volume"))

    @cached_property
    def articles(self) -> DataFrame:
        d, n = F.col("doc_id"), F.col("n_chars")
        epoch = F.unix_timestamp(F.lit("2024-01-01").cast("timestamp"))
        at = lambda seconds: F.timestamp_seconds(epoch + seconds)
        short = n < 100
        m8, m3 = d % 8, n % 3
        return self.table("documents").select(
            d.alias("id"), F.substring_index("text", ".", 1).alias("title"),
            at((d % 720) * 3600 + (d % 60) * 60).alias("published_on"),
            at((F.floor((d % 720) / 3) * 3 + 3) * 3600).alias("fetched_at"),
            "source",
            F.when(F.col("source") == "src0", "CoinDesk").when(F.col("source") == "src1", "Reuters")
            .when(F.col("source") == "src2", "Bitcoin World").otherwise(F.col("source")).alias("source_name"),
            F.concat(F.lit("https://x/"), "source", F.lit("/"), F.md5("text")).alias("url"),
            F.when(short, "").otherwise(F.col("text")).alias("body"),
            F.when(short, 0).otherwise(F.length("text")).alias("body_length"),
            F.when(m8 == 0, "BTC|MARKET").when(m8 == 1, "ETH|SOL").when(m8 == 2, "MARKET|TRADING").when(m8 == 3, "REGULATION|BTC")
            .when(m8 == 4, "FIAT").when(m8 == 5, "").when(m8 == 7, "xrp | ETH|OTHER").alias("categories"),
            F.when(m3 == 0, "Breaking News|alert").when(m3 == 2, "daily").alias("tags"),
            F.upper("lang").alias("lang"), (n % 2 == 0).alias("has_image"),
            F.when(n % 2 == 0, F.concat(F.lit("https://img/"), d.cast("string"))).otherwise("").alias("imageurl"),
            (n % 13).alias("upvotes"), (n % 5).alias("downvotes"))

    @cached_property
    def _events(self) -> DataFrame:
        return self.table("events").withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))

    @cached_property
    def scores(self) -> DataFrame:
        u, kind = F.col("user_id"), F.col("event_type")
        one, two = F.concat(F.lit("c"), (u % 10).cast("string")), F.concat(F.lit("c"), (u % 7).cast("string"))
        return self._events.select(
            F.col("event_id").alias("news_id"), F.col("ts").alias("published_on"),
            (F.col("value") / (F.col("value") + 20) * 2 - 1).alias("composite_score"),
            F.when(kind == "error", "HACK_EXPLOIT").when(kind == "purchase", "ADOPTION_PARTNERSHIP")
            .when(kind == "click", "REGULATION").when(kind == "signup", "ETF_INSTITUTIONAL").alias("event_type"),
            F.nullif(F.col("k") % 4, F.lit(0)).alias("source_tier"),
            F.when(F.col("k") >= 3, F.array_distinct(F.array(one, two))).alias("entities"))

    @cached_property
    def event_articles(self) -> DataFrame:
        k = F.col("k")
        return self._events.filter("value > 1.0").select(
            F.col("event_id").alias("id"),
            F.when(k >= 70, "Alert|Breaking News").when(k >= 10, "daily").alias("tags"))

    @cached_property
    def labels(self) -> DataFrame:
        return market.forward_labels(self.bars)

    @cached_property
    def signals(self) -> DataFrame:
        """Signals with unrounded forward returns, one row per (entity, day)."""
        daily = self.daily_bars.withColumn("dn", market.day_number("date"))
        ret = lambda h: (market.forward_value("close", h) - F.col("close")) / F.col("close")
        score = F.round(F.col("discount") - 0.05, 6)
        rows = daily.select(
            "entity", "date", score.alias("signal_score"), F.lit(1).alias("model_id"),
            *[ret(h).alias(f"forward_ret_{h}d") for h in (1, 3, 7)])
        return rows.withColumns({
            "label_3d": market.M.direction_label("forward_ret_3d", 0.05),
            "pred": F.when(F.col("signal_score") > 0.01, 1).when(F.col("signal_score") < -0.01, -1).otherwise(0)})

    @cached_property
    def market_index(self) -> DataFrame:
        days = self.table("lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
        return days.select("date", (market.day_number("date") % 101).cast("double").alias("market_index"))

    @cached_property
    def trades(self) -> DataFrame:
        o, c = F.col("o_orderkey"), F.col("o_custkey")
        first = F.left("o_orderpriority", F.lit(1))
        pct = (o % 37 - 18) / 173.0
        rows = self.table("orders").join(self.table("customer").select("c_custkey", "c_mktsegment"), F.col("c_custkey") == c)
        return rows.select(
            o.alias("id"), F.col("c_mktsegment").alias("entity"),
            F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "industry").otherwise("consumer").alias("category"),
            F.upper(F.left("c_mktsegment", F.lit(4))).alias("symbol"), F.when(o % 2 == 0, "BUY").otherwise("SHORT").alias("direction"),
            (F.col("o_totalprice") / 1000).alias("entry_price"), (F.col("o_totalprice") / 1000 * (1 + pct)).alias("exit_price"),
            (1000000 / F.col("o_totalprice")).alias("quantity"), (1000.0 + (c % 5) * 100).alias("usdt_size"),
            ((c % 21 - 10) / 100.0).alias("signal_score"),
            F.when(first == "1", "bull_trend").when(first == "2", "bear_trend").when(first == "3", "range_bound")
            .otherwise("high_vol").alias("regime_state"),
            F.when(F.col("o_orderstatus") == "P", "OPEN").otherwise("CLOSED").alias("status"),
            F.col("o_orderdate").alias("entry_time"),
            F.when(F.col("o_orderstatus") != "P", F.timestamp_seconds(F.unix_timestamp("o_orderdate") + (o % 5) * 86400)).alias("exit_time"),
            F.round(F.col("o_totalprice") % 200 - 100, 2).alias("pnl_usdt"), pct.alias("pnl_pct"),
            F.when(first == "1", "take_profit").when(first == "2", "stop_loss").when(first == "3", "expiry_3d")
            .when(first == "4", "trailing_stop").otherwise("account_reset").alias("notes"))

    @cached_property
    def closed_trades(self) -> DataFrame:
        return self.trades.filter("status = 'CLOSED'")


class CoinViews(Views):
    """COIN_VIEWS as frames."""

    bench_daily = bench_hourly = "c0"

    def _bars(self, *when) -> DataFrame:
        entity = F.concat(F.lit("c"), (F.col("user_id") % 10).cast("string")).alias("entity")
        return self.table("events").groupBy(entity, *when).agg(
            (100 + F.min_by("value", "event_id")).alias("open"), (100 + F.max("value")).alias("high"), (100 + F.min("value")).alias("low"),
            (100 + F.max_by("value", "event_id")).alias("close"), F.count(F.lit(1)).cast("double").alias("volume"),
            F.sum("value").alias("market_cap"), (F.avg("value") / 1000).alias("discount"))

    @cached_property
    def daily_bars(self) -> DataFrame:
        return self._bars(F.to_date("ts").alias("date")).withColumn("ts", F.col("date").cast("timestamp") + F.expr("INTERVAL 86399 SECONDS"))

    @cached_property
    def hourly_bars(self) -> DataFrame:
        return self._bars(F.date_trunc("hour", "ts").alias("ts")).drop("market_cap", "discount")

    @cached_property
    def market_index(self) -> DataFrame:
        days = self.table("events").select(F.to_date("ts").alias("date")).distinct()
        return days.select("date", (market.day_number("date") % 101).cast("double").alias("market_index"))

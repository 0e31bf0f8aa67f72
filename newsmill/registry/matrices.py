"""The whole feature matrix: labels or price rows with every feature table of the library, over entities that have bars and news."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsmill.functions import market as M
from newsmill.operators.rolling import full_window, lag_value
from newsmill.plans import matrix
from newsmill.registry import QUERIES, query
from newsmill.registry.views import CoinViews, coin_sql, with_views

# table -> its columns in the matrix; the registered query of that name makes it
ENTITY_TABLES = {
    "news_signals": ["news_sentiment_1d", "news_sentiment_3d", "news_sentiment_7d", "news_sentiment_momentum", "news_volume_1d", "news_volume_zscore_1d",
                     "news_breaking_flag", "news_regulation_flag", "news_security_flag", "news_adoption_flag", "news_source_quality", "news_tier1_count_1d"],
    "news_events": ["event_type", "hours_since_hack_exploit", "hours_since_regulatory", "magnitude_est", "news_surprise", "cross_news_ratio"],
    "daily_residuals": ["beta", "residual_1d", "residual_vol_ratio"],
    "residual_features": ["res_momentum_3d", "res_momentum_7d", "res_momentum_14d", "res_zscore_30d", "res_vol_regime", "res_autocorr_7d", "res_autocorr_14d",
                          "res_volume_interaction"],
    "cross_section": ["ret_rank_1d", "ret_rank_7d", "vol_rank_1d", "cap_momentum", "breadth_20d", "advance_decline", "dispersion", "hhi_volume"],
}
DAY_TABLES = {
    "regime_daily": ["regime_state", "score", "long_mult", "short_mult"],
    "benchmark_context": ["bench_momentum_24h", "bench_vol_7d"],
}
LABELS = ["forward_ret_1d", "forward_ret_3d", "forward_ret_7d", "forward_ret_14d", "label_1d", "label_3d", "label_7d", "label_14d", "volatility_7d", "volatility_30d"]
PRICE = {"price": ["pct_1d", "pct_7d"], "trend": ["above_sma_9", "above_sma_18"], "activity": ["volume", "volume_ratio_7"]}


def _as_table(frame: DataFrame, cols: list, market_wide: bool = False) -> matrix.FeatureTable:
    keys = [] if market_wide else ["entity"]
    return matrix.FeatureTable(frame.select(*keys, F.col("date").cast("timestamp").alias("__ts"), *cols), cols, ts="__ts", market_wide=market_wide)


def _price_tables(v: CoinViews) -> list:
    lag = lambda c, k: lag_value(c, "entity", "ts", k)
    mean = lambda c, n: full_window(F.avg, c, "entity", "ts", n)
    bars = v.daily_bars
    above = lambda n: F.when(mean("close", n).isNotNull(), F.signum(F.round(F.col("close") - mean("close", n), 8)).cast("int"))
    price = bars.select("entity", "date", *[F.round(M.relative_change("close", lag("close", k)), 8).alias(f"pct_{k}d") for k in (1, 7)])
    trend = bars.select("entity", "date", *[above(n).alias(f"above_sma_{n}") for n in (9, 18)])
    activity = bars.select("entity", "date", "volume", F.round(F.col("volume") / mean("volume", 7), 8).alias("volume_ratio_7"))
    return [_as_table(f, cols) for f, cols in zip((price, trend, activity), PRICE.values())]


def _all_tables(v: CoinViews) -> list:
    made = {name: QUERIES[name][0](v) for name in [*ENTITY_TABLES, *DAY_TABLES]}
    return [*_price_tables(v), *[_as_table(made[n], cols) for n, cols in ENTITY_TABLES.items()],
            *[_as_table(made[n], cols, True) for n, cols in DAY_TABLES.items()], _as_table(v.market_index, ["market_index"], True)]


def _full_sql(anchor: str, anchor_cols: list) -> str:
    statement = lambda name: coin_sql(QUERIES[name][1])
    bars = coin_sql(with_views("SELECT * FROM v_daily_bars"))
    tables = {"price": f"""SELECT entity, CAST(date AS VARCHAR) AS date, round(close / lag(close) OVER w - 1, 8) + 0.0 AS pct_1d, round(close / lag(close, 7) OVER w - 1, 8) + 0.0 AS pct_7d
            FROM ({bars}) WINDOW w AS (PARTITION BY entity ORDER BY date)""",
              "trend": f"""SELECT entity, CAST(date AS VARCHAR) AS date, CASE WHEN count(*) OVER w9 = 9 THEN CAST(sign(round(close - avg(close) OVER w9, 8)) AS BIGINT) END AS above_sma_9,
                CASE WHEN count(*) OVER w18 = 18 THEN CAST(sign(round(close - avg(close) OVER w18, 8)) AS BIGINT) END AS above_sma_18
            FROM ({bars}) WINDOW w9 AS (PARTITION BY entity ORDER BY date ROWS 8 PRECEDING), w18 AS (PARTITION BY entity ORDER BY date ROWS 17 PRECEDING)""",
              "activity": f"""SELECT entity, CAST(date AS VARCHAR) AS date, volume, CASE WHEN count(*) OVER w = 7 THEN round(volume / avg(volume) OVER w, 8) END AS volume_ratio_7
            FROM ({bars}) WINDOW w AS (PARTITION BY entity ORDER BY date ROWS 6 PRECEDING)""",
              **{n: statement(n) for n in [*ENTITY_TABLES, *DAY_TABLES]},
              "fear": f"SELECT CAST(date AS VARCHAR) AS date, market_index FROM ({coin_sql(with_views('SELECT * FROM v_market_index'))})"}
    columns = PRICE | ENTITY_TABLES | DAY_TABLES | {"fear": ["market_index"]}
    ctes = ", ".join(f"t_{n} AS MATERIALIZED ({sql})" for n, sql in tables.items())
    joins = " ".join(f"LEFT JOIN t_{n} ON t_{n}.date = a.date" + ("" if n in DAY_TABLES or n == "fear" else f" AND t_{n}.entity = a.entity") for n in tables)
    picked = ", ".join(f"t_{n}.{c}" for n, cols in columns.items() for c in cols)
    own = "".join(f", a.{c}" for c in anchor_cols)
    return f"WITH {ctes}, a AS ({anchor.format(**{n: sql for n, sql in tables.items()}, labels=statement('forward_labels'))}) SELECT a.entity, a.date{own}, {picked} FROM a {joins}"


@query("training_matrix_full", _full_sql("{labels}", LABELS))
def _(v):
    """Labels with eleven feature tables: prices, trend, activity, news signals, events, residuals, residual features, cross-section, regime, benchmark, index."""
    coin = CoinViews(v.spark, v.dir)
    return matrix.union_matrix(_as_table(QUERIES["forward_labels"][0](coin), LABELS), _all_tables(coin))


@query("inference_matrix_full", _full_sql("SELECT entity, date FROM t_price", []))
def _(v):
    """The same tables on every price row, labels known or not."""
    coin = CoinViews(v.spark, v.dir)
    tables = _all_tables(coin)
    return matrix.union_matrix(tables[0], tables[1:])

"""Queries over price bars: labels, residuals, cross-section, regime, matrices."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from newsmill.functions import market as M
from newsmill.operators import rolling
from newsmill.operators.keys import latest_per_key_day, top_per_group
from newsmill.operators.ordering import pct_rank
from newsmill.plans import market, matrix
from newsmill.registry import query
from newsmill.sources.readers import read_table_range

R = lambda c, d: F.round(c, d).alias(c)
BENCH_D, BENCH_H = "s00", "view"
# odd lengths: a mean of values with 8 decimals then never falls on a rounding tie
FRAMES = market.ResidualFrames(13, 25, 49, 97, 193, {"day": 6, "short": 8, "week": 14, "fortnight": 27, "month": 45, "volume": 11})


def rounded(df, digits=6, **special):
    """Round every double column (oracle comparisons)."""
    return df.select(*[
        F.round(f.name, special.get(f.name, digits)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema.fields])


# ---- labels and per-entity windows ---------------------------------------------------------------

@query("forward_labels", """
    SELECT l.entity, CAST(l.date AS VARCHAR) AS date, round(l.close, 8) AS close_price,
           round(r1, 8) AS forward_ret_1d, round(r3, 8) AS forward_ret_3d, round(r7, 8) AS forward_ret_7d, round(r14, 8) AS forward_ret_14d,
           CAST(label_1d AS BIGINT) AS label_1d, CAST(label_3d AS BIGINT) AS label_3d, CAST(label_7d AS BIGINT) AS label_7d, CAST(label_14d AS BIGINT) AS label_14d,
           round(v7, 8) AS volatility_7d, round(v30, 8) AS volatility_30d
    FROM v_labels l JOIN (
        SELECT entity, date,
            CASE WHEN count(ret) OVER w7 >= 3 THEN stddev_samp(ret) OVER w7 END AS v7,
            CASE WHEN count(ret) OVER w30 >= 3 THEN stddev_samp(ret) OVER w30 END AS v30
        FROM (SELECT entity, date, close / lag(close) OVER (PARTITION BY entity ORDER BY date) - 1 AS ret FROM v_daily_bars)
        WINDOW w7 AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
               w30 AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)) v
      ON v.entity = l.entity AND v.date = l.date""")
def _(v):
    return rounded(v.labels.drop("ts"), 8)


@query("forward_labels_range", """
    SELECT * FROM (SELECT l.entity, CAST(l.date AS VARCHAR) AS date, round(r3, 8) AS forward_ret_3d, round(r14, 8) AS forward_ret_14d, CAST(label_7d AS BIGINT) AS label_7d, round(v30, 8) AS volatility_30d
    FROM v_labels l JOIN (
        SELECT entity, date, CASE WHEN count(ret) OVER w30 >= 3 THEN stddev_samp(ret) OVER w30 END AS v30
        FROM (SELECT entity, date, close / lag(close) OVER (PARTITION BY entity ORDER BY date) - 1 AS ret FROM v_daily_bars)
        WINDOW w30 AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)) v
      ON v.entity = l.entity AND v.date = l.date) WHERE date BETWEEN '1996-03-01' AND '1996-06-30'""")
def _(v):
    """A quarter of labels, from the bars that its frames reach."""
    out = market.forward_labels(v.bars, "1996-03-01", "1996-06-30")
    return rounded(out.select("entity", "date", "forward_ret_3d", "forward_ret_14d", "label_7d", "volatility_30d"), 8)


@query("forward_asof", """
    SELECT a.entity, CAST(a.date AS VARCHAR) AS date, round(arg_min(b.close, b.date), 8) AS close_in_5
    FROM v_daily_bars a LEFT JOIN v_daily_bars b ON b.entity = a.entity AND b.date BETWEEN a.date + 5 AND a.date + 8
    GROUP BY a.entity, a.date""")
def _(v):
    """First close on day d+5 .. d+8."""
    rows = v.daily_bars.withColumn("dn", market.day_number("date"))
    return rows.select("entity", "date", F.round(market.forward_value("close", 5, 3), 8).alias("close_in_5"))


@query("prior_volatility", """
    SELECT entity, CAST(date AS VARCHAR) AS date, CASE WHEN count(ret) OVER w >= 5 THEN round(stddev_samp(ret) OVER w, 6) END AS vol
    FROM (SELECT entity, date, close / lag(close) OVER (PARTITION BY entity ORDER BY date) - 1 AS ret FROM v_daily_bars)
    WINDOW w AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)""")
def _(v):
    rows = v.daily_bars.withColumn("dn", market.day_number("date"))
    rows = rows.withColumn("ret", M.relative_change("close", rolling.lag_value("close", "entity", "dn")))
    return rows.select("entity", "date", F.round(market.strict_prior_volatility("ret", 14, min_count=5), 6).alias("vol"))


@query("lag_returns", """
    SELECT entity, CAST(date AS VARCHAR) AS date, round(close / lag(close) OVER w - 1, 6) AS ret_1,
           round(close / lag(close, 3) OVER w - 1, 6) AS ret_3, round(close / lag(close, 7) OVER w - 1, 6) AS ret_7
    FROM v_daily_bars WINDOW w AS (PARTITION BY entity ORDER BY date)""")
def _(v):
    ret = lambda k: F.round(M.relative_change("close", rolling.lag_value("close", "entity", "ts", k)), 6).alias(f"ret_{k}")
    return v.daily_bars.select("entity", "date", ret(1), ret(3), ret(7))


@query("moving_average", """
    SELECT entity, CAST(date AS VARCHAR) AS date,
           round(avg(close) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS sma_20,
           CASE WHEN count(*) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) = 30
                THEN round(stddev_samp(close) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) END AS std_30_full
    FROM v_daily_bars""")
def _(v):
    w = W.partitionBy("entity").orderBy("ts").rowsBetween(-19, 0)
    return v.daily_bars.select(
        "entity", "date", F.round(F.avg("close").over(w), 6).alias("sma_20"),
        F.round(rolling.full_window(F.stddev_samp, "close", "entity", "ts", 30), 6).alias("std_30_full"))


@query("rolling_stats", """
    SELECT entity, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(avg(ln(close)) OVER w, 6) AS mean_48, round(stddev_samp(ln(close)) OVER w, 6) AS std_48,
           CASE WHEN stddev_samp(volume) OVER w > 0 THEN round((volume - avg(volume) OVER w) / stddev_samp(volume) OVER w, 6) END AS volume_z
    FROM v_hourly_bars WINDOW w AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 47 PRECEDING AND CURRENT ROW)""")
def _(v):
    roll = rolling.Rolling(v.hourly_bars.withColumn("close", F.ln("close")), "entity", "ts")
    f = (-47, 0)
    z = M.ratio(F.col("volume") - roll.mean("volume", *f), roll.std("volume", *f))
    roll.df = roll.df.withColumns({
        "mean_48": F.round(roll.mean("close", *f), 6), "std_48": F.round(roll.std("close", *f), 6), "volume_z": F.round(z, 6)})
    return roll.df.select("entity", "ts", "mean_48", "std_48", "volume_z")


@query("avg_tie_pct_rank", """
    SELECT entity, CAST(date AS VARCHAR) AS date, round((rank() OVER (PARTITION BY date ORDER BY discount)
           + (count(*) OVER (PARTITION BY date, discount) - 1) / 2.0) / count(*) OVER (PARTITION BY date), 6) AS pct_rank
    FROM (SELECT entity, date, round(discount, 4) AS discount FROM v_daily_bars)""")
def _(v):
    rows = v.daily_bars.withColumn("discount", F.round("discount", 4))
    return rows.select("entity", "date", F.round(pct_rank("discount", "date"), 6).alias("pct_rank"))


@query("date_position_lag", """
    WITH d AS (SELECT DISTINCT date FROM v_daily_bars), p AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS pos FROM d),
         b AS (SELECT * FROM v_daily_bars JOIN p USING (date))
    SELECT a.entity, CAST(a.date AS VARCHAR) AS date, CAST(a.pos AS BIGINT) AS pos, round(b.close, 8) AS close_7_dates_ago
    FROM b a LEFT JOIN b ON b.entity = a.entity AND b.pos = a.pos - 7""")
def _(v):
    rows = market.with_date_position(v.daily_bars)
    w = W.partitionBy("entity").orderBy("pos").rangeBetween(-7, -7)
    return rows.select("entity", "date", "pos", F.round(F.max("close").over(w), 8).alias("close_7_dates_ago"))


@query("sequence_window", """
    SELECT entity, CAST(date AS VARCHAR) AS date, round(s, 4) AS checksum FROM (
        SELECT entity, date, count(*) OVER w AS n, sum(close) OVER w + sum(volume) OVER w AS s
        FROM v_daily_bars WINDOW w AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) WHERE n = 10""")
def _(v):
    """Full windows of 10 rows x 2 columns (reduced to a sum for comparison)."""
    rows = rolling.sequence_window(v.daily_bars, ["close", "volume"], 10, "entity", "ts")
    flat = F.aggregate(F.flatten("sequence"), F.lit(0.0), lambda a, x: a + x)
    return rows.select("entity", "date", F.round(flat, 4).alias("checksum"))


@query("channel_normalise", """
    SELECT entity, CAST(date AS VARCHAR) AS date,
           round(greatest(-10, least(10, coalesce((volume - avg(volume) OVER w) / nullif(stddev_pop(volume) OVER w, 0), 0))), 6) AS volume
    FROM v_daily_bars WINDOW w AS (PARTITION BY entity)""")
def _(v):
    return rolling.channel_normalise(v.daily_bars, ["volume"], "entity").select("entity", "date", R("volume", 6))


# ---- composite features --------------------------------------------------------------------------

RESIDUALS_SQL = """
    pairs AS (SELECT a.entity, a.ts, a.close, b.close AS bench FROM v_hourly_bars a JOIN v_hourly_bars b ON b.ts = a.ts AND b.entity = 'view' WHERE a.entity <> 'view'),
    rets AS (SELECT entity, ts, coalesce(close / lag(close) OVER w - 1, 0) AS y, coalesce(bench / lag(bench) OVER w - 1, 0) AS x, row_number() OVER w AS rn
             FROM pairs WINDOW w AS (PARTITION BY entity ORDER BY ts)),
    fit AS (SELECT entity, ts, x, y, rn, covar_samp(y, x) OVER w / var_samp(x) OVER w AS beta, avg(y) OVER w AS my, avg(x) OVER w AS mx,
                   stddev_samp(y) OVER (PARTITION BY entity ORDER BY ts ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS total_std
            FROM rets WINDOW w AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING)),
    res AS (SELECT entity, ts, beta, my - beta * mx AS alpha, y - (my - beta * mx + beta * x) AS residual, total_std FROM fit WHERE rn > 48 AND beta IS NOT NULL),
    residuals AS (SELECT entity, ts, round(beta, 6) AS beta, round(alpha, 8) AS alpha, round(residual, 8) AS residual,
                         CASE WHEN count(*) OVER w >= 10 THEN round(least(stddev_samp(residual) OVER w / total_std, 1), 6) END AS ratio
                  FROM res WINDOW w AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 47 PRECEDING AND CURRENT ROW))"""


def _residuals(v):
    return market.beta_residuals(v.hourly_bars, v.bench_hourly, 48)


@query("beta_residuals", f"""
    WITH {RESIDUALS_SQL}
    SELECT entity, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, beta, alpha, residual, ratio AS residual_vol_ratio FROM residuals""")
def _(v):
    return _residuals(v)


@query("rolling_ols", f"""
    WITH {RESIDUALS_SQL}
    SELECT entity, count(*) AS n, round(avg(beta), 10) AS avg_beta, round(sum(residual), 8) AS sum_residual FROM residuals GROUP BY entity""")
def _(v):
    return _residuals(v).groupBy("entity").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("beta"), 10).alias("avg_beta"), F.round(F.sum("residual"), 8).alias("sum_residual"))


@query("daily_residuals", f"""
    WITH {RESIDUALS_SQL}
    SELECT entity, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, round(avg(beta), 10) AS beta, round(avg(alpha), 12) AS alpha,
           round(sum(residual), 8) AS residual_1d, round(avg(ratio), 10) AS residual_vol_ratio FROM residuals GROUP BY ALL""")
def _(v):
    return rounded(market.daily_residuals(_residuals(v)), 10, alpha=12, residual_1d=8)


@query("residual_features", f"""
    WITH {RESIDUALS_SQL},
    s AS (SELECT r.entity, r.ts, r.residual AS r, b.volume AS v, row_number() OVER w - 1 AS i, lag(r.residual) OVER w AS p
          FROM residuals r LEFT JOIN v_hourly_bars b ON b.entity = r.entity AND b.ts = r.ts WINDOW w AS (PARTITION BY r.entity ORDER BY r.ts)),
    z AS (SELECT *, r * CASE WHEN i >= 193 AND count(v) OVER w > 10 AND stddev_samp(v) OVER w > 0 THEN (v - avg(v) OVER w) / stddev_samp(v) OVER w END AS rv
          FROM s WINDOW w AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 193 PRECEDING AND 1 PRECEDING)),
    f AS (SELECT entity, CAST(ts AS DATE) AS date, ts, i,
        avg(r) OVER w24 AS m3, avg(r) OVER w48 AS m7, CASE WHEN i >= 97 THEN avg(r) OVER w96 END AS m14,
        CASE WHEN i >= 193 THEN (avg(r) OVER w12 - avg(r) OVER w192) / stddev_samp(r) OVER w192 END AS zs,
        CASE WHEN i >= 193 THEN stddev_samp(r) OVER w48 / stddev_samp(r) OVER w192 END AS vr,
        corr(p, r) OVER p47 AS a7, CASE WHEN i >= 97 THEN corr(p, r) OVER p95 END AS a14,
        CASE WHEN count(rv) OVER w12 >= 6 THEN avg(rv) OVER w12 END AS vi
        FROM z WINDOW w12 AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 12 PRECEDING AND CURRENT ROW),
            w24 AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 24 PRECEDING AND CURRENT ROW), w48 AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 48 PRECEDING AND CURRENT ROW),
            w96 AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 96 PRECEDING AND CURRENT ROW), w192 AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 192 PRECEDING AND CURRENT ROW),
            p47 AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 47 PRECEDING AND CURRENT ROW), p95 AS (PARTITION BY entity ORDER BY ts ROWS BETWEEN 95 PRECEDING AND CURRENT ROW))
    SELECT entity, CAST(date AS VARCHAR) AS date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(m3, 8) AS res_momentum_3d, round(m7, 8) AS res_momentum_7d, round(m14, 8) AS res_momentum_14d,
        round(zs, 6) AS res_zscore_30d, round(vr, 6) AS res_vol_regime, round(a7, 6) AS res_autocorr_7d, round(a14, 6) AS res_autocorr_14d, round(vi, 8) AS res_volume_interaction
    FROM f WHERE i >= 49 QUALIFY row_number() OVER (PARTITION BY entity, date ORDER BY ts DESC) = 1""")
def _(v):
    return market.residual_features(_residuals(v), v.hourly_bars, FRAMES)


CROSS_SQL = """
    d AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS pos FROM (SELECT DISTINCT date FROM v_daily_bars)),
    b AS (SELECT entity, date, pos, close, volume, market_cap, (rank() OVER (PARTITION BY date ORDER BY market_cap)
            + (count(*) OVER (PARTITION BY date, market_cap) - 1) / 2.0) / count(*) OVER (PARTITION BY date) AS cap_rank FROM v_daily_bars JOIN d USING (date)),
    x AS (SELECT b.*, b.close / p1.close - 1 AS r1, b.close / p7.close - 1 AS r7, b.cap_rank - p7.cap_rank AS cm,
            b.volume / avg(b.volume) OVER (PARTITION BY b.entity ORDER BY b.pos RANGE BETWEEN 20 PRECEDING AND 1 PRECEDING) AS vr,
            avg(b.close) OVER (PARTITION BY b.entity ORDER BY b.pos RANGE BETWEEN 19 PRECEDING AND CURRENT ROW) AS sma
          FROM b LEFT JOIN b p1 ON p1.entity = b.entity AND p1.pos = b.pos - 1 LEFT JOIN b p7 ON p7.entity = b.entity AND p7.pos = b.pos - 7),
    g AS (SELECT *, count(r1) OVER w AS n1, count(r7) OVER w AS n7, count(vr) OVER w AS nv, count(*) OVER w AS n,
            count(*) FILTER (WHERE r1 > 0) OVER w AS adv, count(*) FILTER (WHERE r1 < 0) OVER w AS dec, stddev_samp(r1) OVER w AS disp,
            count(*) FILTER (WHERE close > sma) OVER w AS above, sum(volume * volume) OVER w / (sum(volume) OVER w * sum(volume) OVER w) AS hhi,
            (rank() OVER (PARTITION BY date ORDER BY r1 NULLS LAST) + (count(*) OVER (PARTITION BY date, r1) - 1) / 2.0) AS k1,
            (rank() OVER (PARTITION BY date ORDER BY r7 NULLS LAST) + (count(*) OVER (PARTITION BY date, r7) - 1) / 2.0) AS k7,
            (rank() OVER (PARTITION BY date ORDER BY vr NULLS LAST) + (count(*) OVER (PARTITION BY date, vr) - 1) / 2.0) AS kv
          FROM x WINDOW w AS (PARTITION BY date)),
    cross_rows AS (SELECT entity, date, CASE WHEN n1 >= 10 AND r1 IS NOT NULL THEN round(k1 / n1, 6) END AS ret_rank_1d,
        CASE WHEN n7 >= 10 AND r7 IS NOT NULL THEN round(k7 / n7, 6) END AS ret_rank_7d, CASE WHEN nv >= 10 AND vr IS NOT NULL THEN round(kv / nv, 6) END AS vol_rank_1d,
        round(cm, 6) + 0.0 AS cap_momentum, round(above / n, 6) AS breadth_20d,
        round(CASE WHEN dec > 0 THEN CASE WHEN adv > 0 THEN greatest(-3.0, least(3.0, ln(adv / dec))) ELSE -3.0 END WHEN adv > 0 THEN 3.0 ELSE 0.0 END, 6) + 0.0 AS advance_decline,
        CASE WHEN n1 >= 10 THEN round(disp, 8) END AS dispersion, CASE WHEN n >= 10 THEN round(hhi + 1e-13, 8) END AS hhi_volume
        FROM g WHERE pos >= 20 AND n >= 10)"""


@query("cross_section", f"""
    WITH {CROSS_SQL}
    SELECT entity, CAST(date AS VARCHAR) AS date, ret_rank_1d, ret_rank_7d, vol_rank_1d, cap_momentum, breadth_20d, advance_decline, dispersion, hhi_volume FROM cross_rows""")
def _(v):
    return market.cross_section(v.bars)


@query("cross_section_range", f"""
    WITH {CROSS_SQL}
    SELECT entity, CAST(date AS VARCHAR) AS date, ret_rank_1d, ret_rank_7d, vol_rank_1d, cap_momentum, breadth_20d, advance_decline, dispersion, hhi_volume FROM cross_rows
    WHERE date BETWEEN DATE '1996-03-01' AND DATE '1996-06-30'""")
def _(v):
    """A quarter, from the bars of its look-back."""
    return market.cross_section(v.bars, "1996-03-01", "1996-06-30")


@query("market_wide_daily", f"""
    WITH {CROSS_SQL}
    SELECT CAST(date AS VARCHAR) AS date, max(breadth_20d) AS breadth_20d, max(advance_decline) AS advance_decline, max(dispersion) AS dispersion, max(hhi_volume) AS hhi_volume
    FROM cross_rows GROUP BY date""")
def _(v):
    """Dispersion, concentration, breadth and advance/decline as one row per day."""
    cols = ["breadth_20d", "advance_decline", "dispersion", "hhi_volume"]
    return (market.cross_section(v.bars).groupBy("date").agg(*[F.max(c).alias(c) for c in cols]))


BREADTH_SQL = """
    m AS (SELECT *, avg(close) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS sma FROM v_daily_bars),
    breadth AS (SELECT date, count(*) FILTER (WHERE close > sma) / count(*) AS breadth FROM
        (SELECT *, row_number() OVER (PARTITION BY date ORDER BY market_cap DESC, entity) AS rn FROM m) WHERE rn <= 12 GROUP BY date)"""


@query("market_breadth", f"WITH {BREADTH_SQL} SELECT CAST(date AS VARCHAR) AS date, round(breadth, 6) AS breadth FROM breadth")
def _(v):
    return rounded(market.market_breadth(v.bars, 12))


@query("breadth_all", f"""WITH {BREADTH_SQL} SELECT CAST(date AS VARCHAR) AS date, round(count(*) FILTER (WHERE close > sma) / count(*), 6) AS breadth FROM m GROUP BY date""")
def _(v):
    return rounded(market.breadth_all(v.bars))


BENCH_SQL = """
    bq AS (SELECT date, close, volume, close / lag(close) OVER w - 1 AS mom_1d, close / lag(close, 3) OVER w - 1 AS mom_3d, close / lag(close, 7) OVER w - 1 AS mom_7d
          FROM v_daily_bars WHERE entity = 's00' WINDOW w AS (ORDER BY date)),
    bench AS (SELECT *, CASE WHEN count(mom_1d) OVER w7 = 7 THEN stddev_samp(mom_1d) OVER w7 END AS vol_7d,
                 CASE WHEN count(mom_1d) OVER w30 = 30 THEN stddev_samp(mom_1d) OVER w30 END AS vol_30d,
                 CASE WHEN count(close) OVER w7 = 7 THEN avg(close) OVER w7 END AS sma_7, CASE WHEN count(close) OVER w20 = 20 THEN avg(close) OVER w20 END AS sma_20
              FROM bq WINDOW w7 AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), w30 AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
                            w20 AS (ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""
REGIME_SQL = f"""{BENCH_SQL}, {BREADTH_SQL},
    rs AS (SELECT q.*, CASE WHEN vol_30d > 0 THEN vol_7d / vol_30d ELSE 1 END AS vr, coalesce(i.market_index, 50) AS fg, coalesce(breadth.breadth, 0.5) AS br
           FROM bench q LEFT JOIN v_market_index i ON i.date = q.date LEFT JOIN breadth ON breadth.date = q.date WHERE mom_3d IS NOT NULL AND vol_7d IS NOT NULL),
    rc AS (SELECT *, round(0.35 * greatest(-1, least(1, mom_3d * 20)) + 0.20 * greatest(-1, least(1, 1.5 - vr)) + 0.20 * greatest(-1, least(1, (50 - fg) / 50.0)) + 0.25 * greatest(-1, least(1, (br - 0.5) * 4)), 4) AS score FROM rs),
    regime AS (SELECT date, score, CASE WHEN vr > 2 THEN 'high_vol' WHEN score > 0.15 THEN 'bull_trend' WHEN score < -0.15 THEN 'bear_trend' ELSE 'range_bound' END AS regime_state,
        round(CASE WHEN score > 0.2 THEN least(1 + score, 1.5) WHEN score > -0.1 THEN 0.7 ELSE 0 END, 3) AS long_mult,
        round(CASE WHEN score < -0.2 THEN least(1 - score, 1.5) WHEN score < 0.1 THEN 0.7 ELSE 0 END, 3) AS short_mult, round(least(abs(score) * 2, 1), 3) AS confidence FROM rc)"""


def _regime(v):
    return market.regime_daily(v.bars, v.bench_daily, v.market_index, market.market_breadth(v.bars, 12))


@query("regime_daily", f"""WITH {REGIME_SQL}
    SELECT CAST(date AS VARCHAR) AS date, regime_state, round(score, 4) AS score, CAST(long_mult > 0 AS BIGINT) AS allow_long, CAST(short_mult > 0 AS BIGINT) AS allow_short, long_mult, short_mult, confidence FROM regime""")
def _(v):
    return _regime(v)


@query("regime_shifts", f"""WITH {REGIME_SQL}
    SELECT CAST(date AS VARCHAR) AS date, previous, regime_state AS current FROM (SELECT *, lag(regime_state) OVER (ORDER BY date) AS previous FROM regime) WHERE previous <> regime_state""")
def _(v):
    from newsmill.plans.ledger import state_shifts
    return state_shifts(_regime(v))


@query("benchmark_context", f"""WITH {BENCH_SQL} SELECT CAST(date AS VARCHAR) AS date, round(mom_1d, 6) AS bench_momentum_24h, round(vol_7d, 6) AS bench_vol_7d FROM bench""")
def _(v):
    return rounded(market.benchmark_context(v.bars, v.bench_daily))


@query("benchmark_return", """
    SELECT round((arg_max(close, date) - arg_min(close, date)) / arg_min(close, date) * 100, 2) AS return_pct FROM v_daily_bars
    WHERE entity = 's00' AND date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def _(v):
    return market.benchmark_return(v.bars, BENCH_D, "1996-01-01", "1999-12-31 23:59:59")


@query("universe_by_average", """
    SELECT entity, round(avg(market_cap), 4) AS average FROM v_daily_bars GROUP BY entity HAVING avg(market_cap) > 40000""")
def _(v):
    return rounded(market.universe_by_average(v.bars, "market_cap", 40000.0), 4)


@query("hourly_candle_features", f"""
    WITH {RESIDUALS_SQL}
    SELECT b.entity, strftime(b.ts, '%Y-%m-%d %H:%M:%S') AS ts, r.residual AS residual, round(coalesce(b.volume / lag(b.volume) OVER w - 1, 0), 6) AS volume_change,
        round((high - low) / nullif(b.close, 0), 6) AS price_spread, CAST(sign(b.close - open) AS DOUBLE) AS close_open_dir,
        CASE WHEN stddev_samp(b.volume) OVER w168 > 0 THEN round((b.volume - avg(b.volume) OVER w168) / stddev_samp(b.volume) OVER w168, 6) END AS volume_zscore_7d,
        round(sin(2 * pi() * hour(b.ts) / 24), 6) + 0.0 AS hour_sin, round(cos(2 * pi() * hour(b.ts) / 24), 6) + 0.0 AS hour_cos,
        CASE WHEN count(r.residual) OVER w24 > 1 THEN round(stddev_samp(r.residual) OVER w24, 6) END AS residual_vol_24h
    FROM v_hourly_bars b LEFT JOIN residuals r ON r.entity = b.entity AND r.ts = b.ts
    WINDOW w AS (PARTITION BY b.entity ORDER BY b.ts), w168 AS (PARTITION BY b.entity ORDER BY b.ts ROWS BETWEEN 167 PRECEDING AND CURRENT ROW),
           w24 AS (PARTITION BY b.entity ORDER BY b.ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""")
def _(v):
    return rounded(market.hourly_candle_features(v.hourly_bars, _residuals(v)), 6, residual=8)


@query("daily_sequence_features", f"""
    WITH {RESIDUALS_SQL},
    dr AS (SELECT entity, CAST(ts AS DATE) AS date, sum(residual) AS residual_1d FROM residuals GROUP BY ALL),
    hb AS (SELECT entity, CAST(ts AS DATE) AS date, arg_max(close, ts) AS close, arg_max(volume, ts) AS volume, arg_max(high, ts) AS high, arg_max(low, ts) AS low FROM v_hourly_bars GROUP BY ALL)
    SELECT entity, CAST(date AS VARCHAR) AS date, round(residual_1d, 8) AS residual_1d, round(coalesce(close / lag(close) OVER w - 1, 0), 6) AS close_ret, round((high - low) / nullif(close, 0), 6) AS daily_range,
        CASE WHEN count(volume) OVER w30 = 30 THEN round((volume - avg(volume) OVER w30) / nullif(stddev_samp(volume) OVER w30, 0), 6) END AS volume_zscore,
        CASE WHEN count(residual_1d) OVER w7 = 7 THEN round(stddev_samp(residual_1d) OVER w7, 6) END AS residual_vol_7d,
        CASE WHEN count(residual_1d) OVER w14 = 14 THEN round(stddev_samp(residual_1d) OVER w14, 6) END AS residual_vol_14d,
        round(coalesce(volume / lag(volume) OVER w - 1, 0), 6) AS residual_volume_1d, CAST(0.5 AS DOUBLE) AS momentum_rank, CAST(0 AS DOUBLE) AS news_sentiment_1d, CAST(0 AS DOUBLE) AS news_volume_1d,
        coalesce(market_index, CAST(50 AS DOUBLE)) AS market_index, CAST(0.5 AS DOUBLE) AS market_breadth
    FROM dr LEFT JOIN hb USING (entity, date) LEFT JOIN v_market_index USING (date)
    WINDOW w AS (PARTITION BY entity ORDER BY date), w7 AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
        w14 AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW), w30 AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def _(v):
    return rounded(market.daily_sequence_features(v.hourly_bars, market.daily_residuals(_residuals(v)), v.market_index), 6, residual_1d=8)


@query("residual_decomposition", f"""
    WITH {RESIDUALS_SQL},
    hr AS (SELECT entity, CAST(ts AS DATE) AS date, arg_max(close, ts) AS close FROM v_hourly_bars GROUP BY ALL),
    rt AS (SELECT entity, date, close / lag(close) OVER (PARTITION BY entity ORDER BY date) - 1 AS ret FROM hr),
    dr AS (SELECT CAST(ts AS DATE) AS date, avg(residual) AS residual, avg(beta) AS beta FROM residuals WHERE entity = 'click' GROUP BY ALL)
    SELECT CAST(a.date AS VARCHAR) AS date, round(b.ret * 100, 2) AS bench_ret, round(a.ret * 100, 2) AS entity_ret, round(dr.residual * 100, 2) AS residual, round(dr.beta, 2) AS beta
    FROM rt a JOIN rt b ON b.date = a.date AND b.entity = 'view' JOIN dr ON dr.date = a.date WHERE a.entity = 'click' AND a.ret IS NOT NULL AND b.ret IS NOT NULL ORDER BY a.date DESC LIMIT 20""")
def _(v):
    daily = market.daily_values(v.hourly_bars, ["close"]).withColumn("ts", F.col("date").cast("timestamp"))
    return market.residual_decomposition(daily, _residuals(v), "click", BENCH_H, 20)


@query("cycle_phase", """
    SELECT CAST(date AS VARCHAR) AS date, round(d, 6) AS cycle_days, round(sin(2 * pi() * d / 29.53058770576), 6) + 0.0 AS cycle_sin, round(cos(2 * pi() * d / 29.53058770576), 6) + 0.0 AS cycle_cos
    FROM (SELECT date, x - floor(x / 29.53058770576) * 29.53058770576 AS d FROM (SELECT date, date_diff('second', TIMESTAMP '2000-01-06 18:14:00', CAST(date AS TIMESTAMP)) / 86400.0 AS x FROM v_market_index))""")
def _(v):
    rows = v.market_index.withColumn("p", M.cycle_phase(F.col("date").cast("timestamp")))
    return rows.select("date", F.round(M.cycle_days(F.col("date").cast("timestamp")), 6).alias("cycle_days"),
                       F.col("p.sin").alias("cycle_sin"), F.col("p.cos").alias("cycle_cos"))


# ---- matrices ------------------------------------------------------------------------------------

def _feature_tables(v):
    lag = lambda c: rolling.lag_value(c, "entity", "ts")
    pct = v.bars.select("entity", "ts", F.round(M.relative_change("close", lag("close")), 6).alias("pct_1d"))
    # a table with two rows per (entity, day): only the newest may join
    doubled = v.bars.select("entity", "ts", F.round("volume", 4).alias("volume")).unionByName(
        v.bars.select("entity", (F.col("ts") - F.expr("INTERVAL 2 HOURS")).alias("ts"), F.lit(-1.0).alias("volume")))
    index = v.market_index.withColumn("ts", F.col("date").cast("timestamp")).drop("date")
    cross = market.cross_section(v.bars).withColumn("ts", F.col("date").cast("timestamp")).drop("date")
    T = matrix.FeatureTable
    return [T(pct, ["pct_1d"]), T(doubled, ["volume", "absent_column"]), T(cross, ["ret_rank_1d", "breadth_20d"]),
            T(index, ["market_index"], market_wide=True), T(None, ["missing_table_col"])]


MATRIX_SQL = f"""{CROSS_SQL}, pct AS (SELECT entity, date, round(close / lag(close) OVER (PARTITION BY entity ORDER BY date) - 1, 6) AS pct_1d, round(volume, 4) AS volume FROM v_daily_bars)"""


@query("training_matrix", f"""
    WITH {MATRIX_SQL}, u AS (SELECT entity FROM v_daily_bars GROUP BY entity HAVING avg(market_cap) > 40000)
    SELECT l.entity, CAST(l.date AS VARCHAR) AS date, CAST(label_3d AS BIGINT) AS label_3d, round(r3, 8) AS forward_ret_3d, pct_1d, volume, CAST(NULL AS DOUBLE) AS absent_column,
           ret_rank_1d, breadth_20d, market_index, CAST(NULL AS DOUBLE) AS missing_table_col
    FROM v_labels l LEFT JOIN pct USING (entity, date) LEFT JOIN cross_rows c USING (entity, date) LEFT JOIN v_market_index USING (date) WHERE l.entity IN (SELECT entity FROM u)""")
def _(v):
    labels = v.labels.select("entity", "date", "label_3d", "forward_ret_3d")
    return matrix.training_matrix(labels, _feature_tables(v), market.universe_by_average(v.bars, "market_cap", 40000.0))


@query("inference_matrix", f"""
    WITH {MATRIX_SQL}
    SELECT entity, CAST(date AS VARCHAR) AS date, pct_1d, volume, CAST(NULL AS DOUBLE) AS absent_column, ret_rank_1d, breadth_20d, market_index, CAST(NULL AS DOUBLE) AS missing_table_col
    FROM pct LEFT JOIN cross_rows c USING (entity, date) LEFT JOIN v_market_index USING (date)""")
def _(v):
    tables = _feature_tables(v)
    return matrix.inference_matrix(tables[0], tables[1:])


@query("null_report", f"""
    WITH {MATRIX_SQL}, m AS (SELECT pct_1d, ret_rank_1d, market_index, CAST(NULL AS DOUBLE) AS missing_table_col FROM pct LEFT JOIN cross_rows USING (entity, date) LEFT JOIN v_market_index USING (date)),
    n AS (SELECT unnest(['pct_1d', 'ret_rank_1d', 'market_index', 'missing_table_col']) AS feature,
        unnest([avg(CAST(pct_1d IS NULL AS INT)), avg(CAST(ret_rank_1d IS NULL AS INT)), avg(CAST(market_index IS NULL AS INT)), avg(CAST(missing_table_col IS NULL AS INT))]) AS p FROM m)
    SELECT feature, round(p * 100, 4) AS null_pct, CASE WHEN p > 0.5 THEN 'sparse' WHEN p > 0.05 THEN 'partial' ELSE 'filled' END AS bucket FROM n""")
def _(v):
    tables = _feature_tables(v)
    return matrix.null_report(matrix.inference_matrix(tables[0], tables[1:]), ["pct_1d", "ret_rank_1d", "market_index", "missing_table_col"])


@query("latest_per_key_day", """
    SELECT event_type AS entity, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, max(event_id) AS event_id, round(arg_max(value, event_id), 4) AS value FROM events GROUP BY ALL""")
def _(v):
    rows = latest_per_key_day(v.table("events"), "event_type", "ts", [F.desc("event_id")])
    return rows.select(F.col("event_type").alias("entity"), "date", "event_id", F.round("value", 4).alias("value"))


@query("date_scaffold", """
    SELECT DISTINCT entity, CAST(date AS VARCHAR) AS date FROM v_daily_bars WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'""")
def _(v):
    return matrix.date_scaffold(v.bars, "1997-01-01", "1998-12-31")


@query("read_table_range", """
    SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1996-11-30' AND l_shipdate < TIMESTAMP '1998-01-19' GROUP BY ALL""")
def _(v):
    rows = read_table_range(v.table("lineitem"), "l_shipdate", "1997-01-01", "1997-12-31", 32, 18)
    return rows.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


SPLIT_SQL = """
    sp AS (SELECT CAST(min(date) + 200 AS DATE) AS s, CAST(min(date) + 300 AS DATE) AS e FROM v_market_index),
    an AS (SELECT CAST(unnest(generate_series(CAST(s - CAST(dayofweek(s) AS INT) AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS anchor FROM sp),
    folds AS (SELECT anchor, 'train' AS role, greatest(anchor - 139, DATE '1995-04-01') AS date_from, anchor - 49 AS date_to FROM an
        UNION ALL SELECT anchor, 'val', anchor - 48, anchor - 28 FROM an UNION ALL SELECT anchor, 'test', anchor - 27, anchor - 14 FROM an)"""


def _folds(v):
    span = v.market_index.agg(F.date_add(F.min("date"), 200).alias("start"), F.date_add(F.min("date"), 300).alias("end"))
    return matrix.walkforward_folds(matrix.weekly_anchors(span), "1995-04-01", 3)


@query("walkforward_splits", f"WITH {SPLIT_SQL} SELECT CAST(anchor AS VARCHAR) AS anchor, role, CAST(date_from AS VARCHAR) AS date_from, CAST(date_to AS VARCHAR) AS date_to FROM folds")
def _(v):
    return _folds(v)


@query("walkforward_rows", f"""WITH {SPLIT_SQL} SELECT CAST(anchor AS VARCHAR) AS anchor, role, count(*) AS n, round(avg(close), 4) AS avg_close
    FROM v_daily_bars JOIN folds ON date BETWEEN date_from AND date_to GROUP BY ALL""")
def _(v):
    rows = matrix.assign_folds(v.daily_bars, _folds(v))
    return rows.groupBy("anchor", "role").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("close"), 4).alias("avg_close"))


@query("lookup_daily_default", """
    SELECT b.entity, CAST(b.date AS VARCHAR) AS date, coalesce(i.market_index, 50) AS market_index FROM v_daily_bars b
    LEFT JOIN (SELECT * FROM v_market_index WHERE market_index > 20) i ON i.date = b.date""")
def _(v):
    index = v.market_index.filter("market_index > 20")
    return market.lookup_daily(v.daily_bars.select("entity", "date"), index, "market_index", 50.0)


@query("inner_merge_suffixes", """
    SELECT a.entity, strftime(a.ts, '%Y-%m-%d %H:%M:%S') AS ts, round(a.close, 4) AS close_entity, round(b.close, 4) AS close_bench
    FROM v_hourly_bars a JOIN v_hourly_bars b ON b.ts = a.ts AND b.entity = 'view' WHERE a.entity <> 'view'""")
def _(v):
    bench = v.hourly_bars.filter(F.col("entity") == BENCH_H).select("ts", F.round("close", 4).alias("close_bench"))
    rows = v.hourly_bars.filter(F.col("entity") != BENCH_H).select("entity", "ts", F.round("close", 4).alias("close_entity"))
    return rows.join(bench, "ts")


@query("top_per_day", """
    SELECT entity, CAST(date AS VARCHAR) AS date, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY market_cap DESC NULLS LAST, entity) AS rank FROM v_daily_bars) WHERE rank <= 5""")
def _(v):
    return top_per_group(v.daily_bars, "date", [F.desc_nulls_last("market_cap"), F.col("entity")], 5).select("entity", "date", "rank")

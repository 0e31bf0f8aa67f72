"""Column builders for prices, regimes and signals."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from newsmill.functions import rules


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip(x, low: float, high: float) -> Column:
    return F.when(_c(x).isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), _c(x))))


def null_zero(x) -> Column:
    return F.nullif(_c(x), F.lit(0.0))


def ratio(num, den) -> Column:
    """Division where a null or zero denominator gives null."""
    return F.try_divide(_c(num), _c(den))


def relative_change(now, before) -> Column:
    return ratio(_c(now) - _c(before), _c(before))


def direction_label(ret, threshold: float) -> Column:
    """1 above, -1 below the threshold, 0 between, null for null."""
    r = _c(ret)
    return F.when(r > threshold, 1).when(r < -threshold, -1).when(r.isNotNull(), 0).cast("short")


def cycle_days(ts, epoch: str = rules.MONTH_EPOCH, period: float = rules.MONTH_DAYS) -> Column:
    """Days since the epoch modulo the period, in [0, period)."""
    seconds = F.unix_timestamp(_c(ts)) - F.unix_timestamp(F.lit(epoch).cast("timestamp"))
    return F.pmod(seconds / F.lit(86400.0), F.lit(period))


def cycle_phase(ts, epoch: str = rules.MONTH_EPOCH, period: float = rules.MONTH_DAYS) -> Column:
    angle = F.lit(2 * math.pi) * cycle_days(ts, epoch, period) / period
    return F.struct(F.round(F.sin(angle), 6).alias("sin"), F.round(F.cos(angle), 6).alias("cos"))


def hour_angle(ts) -> Column:
    angle = F.lit(2 * math.pi) * F.hour(_c(ts)) / 24
    return F.struct(F.sin(angle).alias("sin"), F.cos(angle).alias("cos"))


def candle_spread(high, low, close) -> Column:
    return ratio(_c(high) - _c(low), close)


def candle_direction(open_, close) -> Column:
    return F.coalesce(F.signum(_c(close) - _c(open_)), F.lit(0.0))


def vol_ratio(vol_short, vol_long) -> Column:
    """Short over long volatility; 1 when the long one is missing or not positive."""
    return F.when(_c(vol_long) > 0, _c(vol_short) / _c(vol_long)).otherwise(F.lit(1.0))


def regime_score(momentum, vol_short, vol_long, index, breadth) -> Column:
    """Weighted market score in [-1, 1], 4 dp."""
    return F.round(
        0.35 * clip(_c(momentum) * 20, -1, 1)
        + 0.20 * clip(1.5 - vol_ratio(vol_short, vol_long), -1, 1)
        + 0.20 * clip((50 - _c(index)) / 50.0, -1, 1)
        + 0.25 * clip((_c(breadth) - 0.5) * 4, -1, 1),
        4,
    )


def regime_state(score, volatility_ratio) -> Column:
    return (
        F.when(_c(volatility_ratio) > 2.0, "high_vol")
        .when(_c(score) > 0.15, "bull_trend")
        .when(_c(score) < -0.15, "bear_trend")
        .otherwise("range_bound")
    )


def side_size(score, sign: int) -> Column:
    """Size multiplier of one side (sign=1 long, -1 short); 0 means not allowed."""
    s = _c(score) * sign
    return F.round(
        F.when(s > 0.2, F.least(1.0 + F.abs(s), F.lit(1.5))).when(s > -0.1, F.lit(0.7)).otherwise(F.lit(0.0)), 3
    )


def regime_decision(score) -> Column:
    long_mult, short_mult = side_size(score, 1), side_size(score, -1)
    return F.struct(
        (long_mult > 0).alias("allow_long"),
        (short_mult > 0).alias("allow_short"),
        long_mult.alias("long_mult"),
        short_mult.alias("short_mult"),
        F.round(F.least(F.abs(_c(score)) * 2, F.lit(1.0)), 3).alias("confidence"),
    )


def regime_gate(score, state, confidence) -> Column:
    """Damp scores that disagree with the market state."""
    s, c = _c(score), _c(confidence)
    return (
        F.when(_c(state) == "bull_trend", F.when(s > 0, s).otherwise(s * (1 - c * 0.5)))
        .when(_c(state) == "bear_trend", F.when(s < 0, s).otherwise(s * (1 - c * 0.5)))
        .when(_c(state) == "range_bound", s * (1 - c * 0.3))
        .when(_c(state) == "high_vol", s * (1 + c * 0.2))
        .otherwise(s)
    )


def threshold_normalise(pred, threshold, max_leverage: float = 5.0) -> Column:
    p, t = _c(pred), _c(threshold)
    return F.when(F.abs(p) < t, F.lit(0.0)).otherwise(clip(ratio(p, t * max_leverage), -1, 1))


def fuse_scores(price_score, news_score, price_weight: float = 0.7, news_weight: float = 0.3) -> Column:
    """Price score with a missing news score counted as 0."""
    return _c(price_score) * price_weight + F.coalesce(_c(news_score), F.lit(0.0)) * news_weight


def leverage(score, max_leverage: float = 5.0) -> Column:
    return clip(F.abs(_c(score)) * max_leverage, 1.0, max_leverage)


def side_name(score) -> Column:
    return F.when(_c(score) > 0, "LONG").when(_c(score) < 0, "SHORT").otherwise("FLAT")


def trade_pnl_pct(direction, entry, exit_) -> Column:
    sign = F.when(_c(direction) == "SHORT", -1.0).otherwise(1.0)
    return ratio((_c(exit_) - _c(entry)) * sign, entry)


def trade_pnl(direction, entry, exit_, quantity) -> Column:
    sign = F.when(_c(direction) == "SHORT", -1.0).otherwise(1.0)
    return (_c(exit_) - _c(entry)) * sign * _c(quantity)


# ---- direction filters: struct(method, allow, mult) over one trade joined to its market context ----


def _verdict(method: str, allow, mult) -> Column:
    allow = F.lit(allow) if isinstance(allow, bool) else F.coalesce(allow, F.lit(False))
    mult = F.lit(float(mult)) if isinstance(mult, (int, float)) else mult
    return F.struct(
        F.lit(method).alias("method"), allow.alias("allow"), F.when(allow, mult).otherwise(F.lit(0.0)).alias("mult")
    )


def direction_filters(
    direction="direction", mom1="mom_1d", mom3="mom_3d", mom7="mom_7d", vol7="vol_7d", vol30="vol_30d",
    sma7="sma_7", sma20="sma_20", index="market_index", breadth="breadth", score="signal_score", market_day="market_day",
) -> Column:
    """The eleven published trade filters as one array column (explode it to compare them).

    ``market_day`` is null when the trade's day has no market row at all: then every market input takes
    its neutral default.  A market row whose history is too short leaves the composite filter undecided,
    which skips the trade."""
    buy = _c(direction) == "BUY"
    m1, m3, m7 = (F.coalesce(_c(c), F.lit(0.0)) for c in (mom1, mom3, mom7))
    raw_ratio = ratio(vol7, vol30)
    vr = F.coalesce(null_zero(raw_ratio), F.lit(1.0))
    idx = F.coalesce(_c(index), F.lit(50.0))
    br = F.coalesce(_c(breadth), F.lit(0.5))
    # the rule filter counts a breadth or index of exactly 0 as missing
    br0, idx0 = F.coalesce(null_zero(breadth), F.lit(0.5)), F.coalesce(null_zero(index), F.lit(50.0))
    sma_known = _c(sma7).isNotNull() & _c(sma20).isNotNull()
    up = _c(sma7) > _c(sma20)
    composite = (
        0.35 * clip(m3 * 20, -1, 1)
        + 0.20 * clip(1.5 - vr, -1, 1)
        + 0.20 * clip((50 - idx) / 50.0, -1, 1)
        + 0.25 * clip((br - 0.5) * 4, -1, 1)
    )
    undecided = _c(market_day).isNotNull() & (_c(mom3).isNull() | raw_ratio.isNull())
    side = F.when(~undecided, F.when(buy, composite).otherwise(-composite))
    sized = F.when(side > 0.2, F.least(1.0 + F.abs(side), F.lit(1.5))).otherwise(F.lit(0.7))
    breakout = (vr > 2.0) & (F.abs(m1) > 0.03)
    fear = F.when(buy, idx).otherwise(100 - idx)  # the short side mirrors the index
    by_index = (
        F.when(fear < 25, 1.3).when(fear < 40, 1.1).when(fear > 75, 0.5).when(fear > 60, 0.8).otherwise(1.0)
    )
    by_vol = F.when(raw_ratio > 2.0, 0.3).when(raw_ratio > 1.5, 0.6).when(raw_ratio > 1.2, 0.8).otherwise(1.0)
    trend_vol = F.when(vr > 2.0, 0.3).when(vr > 1.5, 0.6).otherwise(1.0)
    sc = _c(score)
    by_score = F.when(
        buy, F.when(sc > 0.03, 1.3).when(sc > 0.0, 1.0).when(sc > -0.02, 0.7)
    ).otherwise(F.when(sc < -0.05, 1.0).when(sc < -0.03, 0.7))
    return F.array(
        _verdict("0_no_filter", True, 1.0),
        _verdict("1_rules", breakout | ~((br0 < 0.35) | ((m3 < -0.05) & (idx0 < 30))), 1.0),
        _verdict("2_trend", ~sma_known | F.when(buy, up).otherwise(~up), 1.0),
        _verdict("3_momentum", _c(mom3).isNull() | F.when(buy, _c(mom3) > 0).otherwise(_c(mom3) < 0), 1.0),
        _verdict("4_vol_scaling", True, by_vol),
        _verdict("5_index", True, by_index),
        _verdict("6_composite", side > -0.1, sized),
        _verdict("7_long_only", buy, 1.0),
        _verdict("8_asymmetric", buy | ((m3 < -0.01) & (m7 < 0)), 1.0),
        _verdict(
            "9_trend_vol",
            ~sma_known | buy | ~up,
            F.when(~sma_known, F.lit(1.0)).when(buy & ~up, trend_vol * 0.5).otherwise(trend_vol),
        ),
        _verdict("10_score", sc.isNull() | by_score.isNotNull(), F.coalesce(by_score, F.lit(1.0))),
    )

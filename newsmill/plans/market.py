"""Features of entity time series: labels, benchmark residuals, cross-section, market regime.

Windows are partitioned by entity (length bounded by the calendar, after one row per entity and bar) or by
day (width bounded by the entity universe)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window as W, functions as F

from newsmill.functions import market as M, rules
from newsmill.operators.keys import first_per_key, top_per_group
from newsmill.operators.ordering import pct_rank
from newsmill.operators.rolling import Rolling, full_window, lag_value

DAY = "date"


def day_number(col):
    """Days since 1970-01-01, the axis of calendar frames."""
    return F.datediff(F.col(col), F.lit("1970-01-01").cast("date"))


def time_range(df: DataFrame, ts: str, start=None, end=None, lookback: int = 0, lookahead: int = 0) -> DataFrame:
    """Rows a computation for the days [start, end] needs.  The bounds are constants on the raw time column,
    so they reach the scan."""
    if start is not None:
        df = df.filter(F.col(ts) >= F.date_sub(F.lit(start).cast("date"), lookback).cast("timestamp"))
    if end is not None:
        df = df.filter(F.col(ts) < F.date_add(F.lit(end).cast("date"), lookahead + 1).cast("timestamp"))
    return df


def daily_values(bars: DataFrame, cols: list, entity="entity", ts="ts") -> DataFrame:
    """Last non-null value per (entity, day) of each column; fixed-width partial aggregates, no sort."""
    return bars.withColumn(DAY, F.to_date(ts)).groupBy(entity, DAY).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(c) for c in cols]
    )


def forward_value(col: str, horizon: int, tolerance: int = 2, entity="entity"):
    """First usable (non-null, non-zero) value on day d+h .. d+h+tolerance: a forward as-of lookup without a
    self join.  Needs a ``dn`` day-number column."""
    w = W.partitionBy(entity).orderBy("dn").rangeBetween(horizon, horizon + tolerance)
    return F.first(M.null_zero(col), ignorenulls=True).over(w)


def strict_prior_volatility(ret: str, n: int, entity="entity", min_count: int = 3):
    """Sample std of the returns on the last n available days before this one."""
    w = W.partitionBy(entity).orderBy("dn").rowsBetween(-n, -1)
    return F.when(F.count(ret).over(w) >= min_count, F.stddev_samp(ret).over(w))


def from_earlier_days(bars: DataFrame, ts: str, start, days: int, entity: str | None = None) -> DataFrame:
    """Bars from the ``days``-th last date before ``start`` on: of the table's calendar, or, with ``entity``, from the
    earliest such date of any entity.  The bound is a scalar subquery over the distinct dates, which keeps no more than
    ``days`` of them per group."""
    if start is None:
        return bars
    first = F.lit(start).cast("date")
    dates = bars.filter(F.col(ts) < first.cast("timestamp")).select(*([entity] if entity else []), F.to_date(ts).alias("__d")).distinct()
    if entity:
        newest = dates.withColumn("__k", F.row_number().over(W.partitionBy(entity).orderBy(F.desc("__d")))).filter(F.col("__k") <= days)
    else:
        newest = dates.orderBy(F.desc("__d")).limit(days)
    bound = F.coalesce(newest.agg(F.min("__d")).scalar(), first)
    return bars.filter(F.col(ts) >= bound.cast("timestamp"))


def forward_labels(bars: DataFrame, start=None, end=None, thresholds: dict | None = None,
                   entity="entity", ts="ts", close="close", lookback: int = 32, lookahead: int = 18) -> DataFrame:
    """Forward returns, direction labels and trailing volatility per (entity, day).

    For a range of days the bars are read from the day on which every entity has ``lookback`` earlier days with bars
    (31 days feed the longest frame, whatever gaps there are) to ``lookahead`` days after it."""
    thresholds = rules.LABEL_THRESHOLDS if thresholds is None else thresholds
    bars = from_earlier_days(time_range(bars, ts, None, end, 0, lookahead), ts, start, lookback, entity)
    daily = (
        bars.withColumn(DAY, F.to_date(ts)).groupBy(entity, DAY)
        .agg(F.max_by(close, ts).alias("close"), F.max(ts).alias("ts"))
        .withColumn("dn", day_number(DAY))
    )
    prev = lag_value("close", entity, "dn")
    out = daily.withColumns({
        **{f"__f{h}": forward_value("close", h, entity=entity) for h in thresholds},
        "__ret": M.relative_change("close", M.null_zero(prev)),
    })
    out = out.withColumns({
        **{f"__r{h}": M.relative_change(f"__f{h}", M.null_zero("close")) for h in thresholds},
        "volatility_7d": strict_prior_volatility("__ret", 7, entity),
        "volatility_30d": strict_prior_volatility("__ret", 30, entity),
    })
    if start is not None:
        out = out.filter(F.col(DAY) >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(F.col(DAY) <= F.lit(end).cast("date"))
    return out.filter(M.null_zero("close").isNotNull()).select(
        entity, DAY, "ts", F.col("close").alias("close_price"),
        *[F.round(f"__r{h}", 8).alias(f"forward_ret_{h}d") for h in thresholds],
        *[M.direction_label(f"__r{h}", t).alias(f"label_{h}d") for h, t in thresholds.items()],
        "volatility_7d", "volatility_30d",
    )


def beta_residuals(bars: DataFrame, benchmark: str, window: int = 720, entity="entity", ts="ts",
                   close="close", ratio_min: int = 10) -> DataFrame:
    """Rolling regression of entity returns on benchmark returns over the ``window`` previous bars."""
    bench = bars.filter(F.col(entity) == benchmark).select(ts, F.col(close).alias("__bench"))
    pairs = bars.filter(F.col(entity) != benchmark).select(entity, ts, F.col(close).alias("__close")).join(bench, ts)
    w = W.partitionBy(entity).orderBy(ts)
    change = lambda c: F.coalesce(M.relative_change(c, F.lag(c).over(w)), F.lit(0.0))
    roll = Rolling(pairs.withColumns({"y": change("__close"), "x": change("__bench")}), entity, ts).position()
    roll.prepare(window, ["x", "y"], [("x", "y")], past=True)
    prior = (-window, -1)
    usable = (F.col("position") >= window) & ~roll.flat("x", *prior)
    beta = F.when(usable, F.try_divide(roll.covariance("x", "y", *prior), roll.variance("x", *prior)))
    roll.df = roll.df.withColumns({
        "beta": beta,
        "__my": roll.mean("y", *prior), "__mx": roll.mean("x", *prior),
        "__total_std": F.when(roll.count("y", -(window - 1)) >= ratio_min, roll.std("y", -(window - 1))),
    })
    fitted = roll.drop_prepared().filter(F.col("beta").isNotNull())
    fitted = fitted.withColumn("alpha", F.col("__my") - F.col("beta") * F.col("__mx"))
    fitted = fitted.withColumn("residual", F.col("y") - (F.col("alpha") + F.col("beta") * F.col("x")))
    res = Rolling(fitted, entity, ts).prepare(window, ["residual"])
    frame = (-(window - 1), 0)
    res_std = F.when(res.count("residual", *frame) >= ratio_min, res.std("residual", *frame))
    res.df = res.df.withColumn("residual_vol_ratio", M.clip(M.ratio(res_std, "__total_std"), 0.0, 1.0))
    return res.df.select(
        entity, ts, F.round("beta", 6).alias("beta"), F.round("alpha", 8).alias("alpha"),
        F.round("residual", 8).alias("residual"), F.round("residual_vol_ratio", 6).alias("residual_vol_ratio"),
    )


def daily_residuals(residuals: DataFrame, entity="entity", ts="ts") -> DataFrame:
    """Hourly residual rows rolled up to days (the daily residual is the sum of the hourly ones)."""
    return residuals.groupBy(entity, F.to_date(ts).alias(DAY)).agg(
        F.avg("beta").alias("beta"), F.avg("alpha").alias("alpha"), F.sum("residual").alias("residual_1d"),
        F.avg("residual_vol_ratio").alias("residual_vol_ratio"),
    )


@dataclass(frozen=True)
class ResidualFrames:
    """Frame lengths in bars and the least number of usable values in each."""

    day: int = 24
    short: int = 72
    week: int = 168
    fortnight: int = 336
    month: int = 720
    least: dict = field(default_factory=lambda: {"day": 12, "short": 24, "week": 48, "fortnight": 96, "month": 168, "volume": 11})


def residual_features(residuals: DataFrame, volume: DataFrame | None, frames: ResidualFrames = ResidualFrames(),
                      entity="entity", ts="ts", value="residual") -> DataFrame:
    """Momentum, z-score, volatility regime, autocorrelation and volume interaction of residuals,
    one row per (entity, day): the day's last bar."""
    least = frames.least
    series = residuals.filter(F.col(value).isNotNull()).select(entity, ts, F.col(value).alias("r"))
    if volume is not None:
        series = series.join(volume.select(entity, ts, F.col("volume").alias("v")), [entity, ts], "left")
    else:
        series = series.withColumn("v", F.lit(None).cast("double"))
    w = W.partitionBy(entity).orderBy(ts)
    roll = Rolling(series.withColumn("lagged", F.lag("r").over(w)), entity, ts).position()
    pos = F.col("position")
    tail = lambda n: (-(n - 1), 0)
    prior = (-frames.month, -1)
    pair = [("lagged", "r")]
    roll.prepare(frames.month, ["r", "v"], past=True).prepare(frames.fortnight, ["r"]).prepare(frames.week, ["r"]).prepare(frames.short, ["r"])
    for n in (frames.week, frames.fortnight):  # n values give n - 1 neighbouring pairs
        roll.prepare(n - 1, ["lagged", "r"], pair)
    v_std = roll.std("v", *prior)
    vz = F.when(
        (pos >= frames.month) & (roll.count("v", *prior) >= least["volume"]) & (v_std > 0),
        (F.col("v") - roll.mean("v", *prior)) / v_std,
    )
    roll.df = roll.df.withColumns({"rv": F.col("r") * vz})

    def mean(n, least_n, guard=0):
        return F.when((pos >= guard) & (roll.count("r", *tail(n)) >= least_n), roll.mean("r", *tail(n)))

    def autocorr(n, least_n, guard=0):
        pairs = (-(n - 2), 0)
        den = roll.std("lagged", *pairs) * roll.std("r", *pairs)
        value_ = M.ratio(roll.covariance("lagged", "r", *pairs), den)
        return F.when((pos >= guard) & (roll.count("r", *tail(n)) >= F.lit(max(least_n, 10))), value_)

    long_ok = (pos >= frames.month) & (roll.count("r", *tail(frames.month)) >= least["month"])
    std_long = roll.std("r", *tail(frames.month))
    roll.df = roll.df.withColumns({
        "res_momentum_3d": F.round(mean(frames.short, least["short"]), 8),
        "res_momentum_7d": F.round(mean(frames.week, least["week"]), 8),
        "res_momentum_14d": F.round(mean(frames.fortnight, least["fortnight"], frames.fortnight), 8),
        "res_zscore_30d": F.round(F.when(
            long_ok & (roll.count("r", *tail(frames.day)) >= least["day"]) & (std_long > 0),
            (roll.mean("r", *tail(frames.day)) - roll.mean("r", *tail(frames.month))) / std_long), 6),
        "res_vol_regime": F.round(F.when(
            long_ok & (roll.count("r", *tail(frames.week)) >= least["week"]),
            M.ratio(roll.std("r", *tail(frames.week)), std_long)), 6),
        "res_autocorr_7d": F.round(autocorr(frames.week, least["week"]), 6),
        "res_autocorr_14d": F.round(autocorr(frames.fortnight, least["fortnight"], frames.fortnight), 6),
        "res_volume_interaction": F.round(
            F.when(roll.count("rv", *tail(frames.day)) >= least["day"], roll.mean("rv", *tail(frames.day))), 8),
    })
    out = roll.drop_prepared().withColumn(DAY, F.to_date(ts))
    return (
        first_per_key(out, [entity, DAY], F.desc(ts)).filter(F.col("position") >= frames.week)
        .drop("position", "r", "v", "lagged", "rv")
    )


def with_date_position(daily: DataFrame) -> DataFrame:
    """Add the position of the row's date among all dates of the table (a calendar-sized side)."""
    dates = daily.select(DAY).distinct()
    return daily.join(dates.withColumn("pos", F.row_number().over(W.orderBy(DAY)) - 1), DAY)


def cross_section(bars: DataFrame, start=None, end=None, entity="entity", ts="ts", lookback: int = 20,
                  group_min: int = 10) -> DataFrame:
    """Per-day ranks of each entity plus market-wide breadth, advance/decline, dispersion, concentration.
    Lags go by position in the table's calendar, not by the entity's own rows.  For a range of days the bars
    are read from ``lookback`` dates of the calendar earlier on; a day needs that many earlier dates."""
    bars = from_earlier_days(time_range(bars, ts, None, end), ts, start, lookback)
    daily = with_date_position(daily_values(bars, ["close", "volume", "market_cap"], entity, ts))
    by = W.partitionBy(entity).orderBy("pos")
    at = lambda c, k: F.max(c).over(by.rangeBetween(-k, -k))
    daily = daily.withColumn("cap_rank", pct_rank("market_cap", DAY))
    rows = daily.withColumns({
        "ret_1d": M.relative_change("close", at("close", 1)),
        "ret_7d": M.relative_change("close", at("close", 7)),
        "vol_ratio": M.ratio("volume", F.avg("volume").over(by.rangeBetween(-lookback, -1))),
        "cap_momentum": F.col("cap_rank") - at("cap_rank", 7),
        "sma": F.avg("close").over(by.rangeBetween(-(lookback - 1), 0)),
    })
    day = W.partitionBy(DAY)
    guarded = lambda c: F.when(F.count(c).over(day) >= group_min, pct_rank(c, DAY))
    adv = F.count_if(F.col("ret_1d") > 0).over(day)
    dec = F.count_if(F.col("ret_1d") < 0).over(day)
    vol = F.when(F.col("volume") > 0, F.col("volume"))
    total = F.sum(vol).over(day)
    rows = rows.withColumns({
        "ret_rank_1d": F.round(guarded("ret_1d"), 6),
        "ret_rank_7d": F.round(guarded("ret_7d"), 6),
        "vol_rank_1d": F.round(guarded("vol_ratio"), 6),
        "cap_momentum": F.round("cap_momentum", 6),
        "breadth_20d": F.round(
            F.count_if(F.col("close") > F.col("sma")).over(day) / F.nullif(F.count("close").over(day), F.lit(0)), 6),
        "advance_decline": F.round(
            F.when(dec > 0, F.when(adv > 0, M.clip(F.ln(adv / dec), -3.0, 3.0)).otherwise(F.lit(-3.0)))
            .otherwise(F.when(adv > 0, 3.0).otherwise(0.0)), 6),
        "dispersion": F.round(F.when(F.count("ret_1d").over(day) >= group_min, F.stddev_samp("ret_1d").over(day)), 8),
        "hhi_volume": F.round(
            F.when(F.count(vol).over(day) >= group_min, F.sum(vol * vol).over(day) / (total * total)), 8),
        "__n": F.count("close").over(day),
    })
    keep = F.col("close").isNotNull() & (F.col("pos") >= lookback) & (F.col("__n") >= group_min)
    if start is not None:
        keep = keep & (F.col(DAY) >= F.lit(start).cast("date"))
    if end is not None:
        keep = keep & (F.col(DAY) <= F.lit(end).cast("date"))
    return rows.filter(keep).select(
        entity, DAY, "ret_rank_1d", "ret_rank_7d", "vol_rank_1d", "cap_momentum",
        "breadth_20d", "advance_decline", "dispersion", "hhi_volume",
    )


def market_breadth(bars: DataFrame, top: int = 50, sma: int = 20, entity="entity", ts="ts") -> DataFrame:
    """Share of the day's largest entities that close above their moving average."""
    w = W.partitionBy(entity).orderBy(ts).rowsBetween(-(sma - 1), 0)
    rows = bars.withColumns({DAY: F.to_date(ts), "sma": F.avg("close").over(w)}).filter("market_cap is not null")
    ranked = top_per_group(rows, DAY, [F.desc_nulls_last("market_cap"), F.col(entity)], top)
    return ranked.groupBy(DAY).agg((F.count_if(F.col("close") > F.col("sma")) / F.count(F.lit(1))).alias("breadth"))


def breadth_all(bars: DataFrame, sma: int = 20, entity="entity", ts="ts") -> DataFrame:
    """Same share over every entity of the day."""
    w = W.partitionBy(entity).orderBy(ts).rowsBetween(-(sma - 1), 0)
    rows = bars.withColumns({DAY: F.to_date(ts), "sma": F.avg("close").over(w)})
    return rows.groupBy(DAY).agg(
        F.try_divide(F.count_if(F.col("close") > F.col("sma")), F.count("close")).alias("breadth"))


def benchmark_frame(bars: DataFrame, benchmark: str, entity="entity", ts="ts") -> DataFrame:
    """Momentum, volatility and moving averages of one series, null until each window is full."""
    one = bars.filter(F.col(entity) == benchmark).select(entity, ts, F.to_date(ts).alias(DAY), "close", "volume")
    change = lambda k: M.relative_change("close", lag_value("close", entity, ts, k))
    out = one.withColumns({"mom_1d": change(1), "mom_3d": change(3), "mom_7d": change(7)})
    mean = lambda c, n: full_window(F.avg, c, entity, ts, n)
    std = lambda c, n: full_window(F.stddev_samp, c, entity, ts, n)
    out = out.withColumns({
        "vol_7d": std("mom_1d", 7), "vol_30d": std("mom_1d", 30),
        "sma_7": mean("close", 7), "sma_20": mean("close", 20), "sma_50": mean("close", 50),
        "volume_ma_7": mean("volume", 7),
    })
    return out.withColumns({
        "vol_ratio": M.ratio("vol_7d", "vol_30d"), "volume_spike": M.ratio("volume", "volume_ma_7"),
    })


def benchmark_context(bars: DataFrame, benchmark: str, entity="entity", ts="ts") -> DataFrame:
    return benchmark_frame(bars, benchmark, entity, ts).select(
        DAY, F.col("mom_1d").alias("bench_momentum_24h"), F.col("vol_7d").alias("bench_vol_7d"))


def lookup_daily(left: DataFrame, right: DataFrame, col: str, default: float) -> DataFrame:
    """Left join of a per-day value with a default (the right side has one row per day)."""
    return left.join(right.select(DAY, col), DAY, "left").withColumn(col, F.coalesce(F.col(col), F.lit(default)))


def regime_daily(bars: DataFrame, benchmark: str, index: DataFrame, breadth: DataFrame,
                 entity="entity", ts="ts") -> DataFrame:
    """Market state, score and per-side size multipliers per day."""
    base = benchmark_frame(bars, benchmark, entity, ts).filter(
        "mom_3d is not null and vol_7d is not null and not (vol_30d <=> 0.0D)")
    base = lookup_daily(lookup_daily(base, index, "market_index", 50.0), breadth, "breadth", 0.5)
    scored = base.withColumn("score", M.regime_score("mom_3d", "vol_7d", "vol_30d", "market_index", "breadth"))
    scored = scored.withColumns({
        "regime_state": M.regime_state("score", M.vol_ratio("vol_7d", "vol_30d")),
        "d": M.regime_decision("score"),
    })
    return scored.select(DAY, "regime_state", "score", "d.*")


def hourly_candle_features(bars: DataFrame, residuals: DataFrame, entity="entity", ts="ts",
                           volume_frame: int = 168, residual_frame: int = 24) -> DataFrame:
    """Eight per-bar inputs of an hourly sequence model."""
    rows = bars.join(residuals.select(entity, ts, "residual"), [entity, ts], "left")
    roll = Rolling(rows, entity, ts)
    long, short = (-(volume_frame - 1), 0), (-(residual_frame - 1), 0)
    change = M.relative_change("volume", lag_value("volume", entity, ts))
    roll.df = roll.df.withColumns({
        "volume_change": F.coalesce(change, F.lit(0.0)),
        "price_spread": M.candle_spread("high", "low", "close"),
        "close_open_dir": M.candle_direction("open", "close"),
        "volume_zscore_7d": M.ratio(F.col("volume") - roll.mean("volume", *long), roll.std("volume", *long)),
        "angle": M.hour_angle(ts),
        "residual_vol_24h": roll.std("residual", *short),
    })
    return roll.df.select(
        entity, ts, "residual", "volume_change", "price_spread", "close_open_dir", "volume_zscore_7d",
        F.col("angle.sin").alias("hour_sin"), F.col("angle.cos").alias("hour_cos"), "residual_vol_24h",
    )


DAILY_SEQUENCE_COLS = [
    "residual_1d", "close_ret", "daily_range", "volume_zscore", "residual_vol_7d", "residual_vol_14d",
    "residual_volume_1d", "momentum_rank", "news_sentiment_1d", "news_volume_1d", "market_index", "market_breadth",
]


def daily_sequence_features(bars: DataFrame, residuals: DataFrame, index: DataFrame,
                            entity="entity", ts="ts") -> DataFrame:
    """Twelve per-day inputs of a daily sequence model (placeholder columns are constants)."""
    daily = daily_values(bars, ["close", "volume", "high", "low"], entity, ts)
    rows = residuals.select(entity, DAY, "residual_1d").join(daily, [entity, DAY], "left")
    rows = lookup_daily(rows, index, "market_index", 50.0)
    change = lambda c: F.coalesce(M.relative_change(c, lag_value(c, entity, DAY)), F.lit(0.0))
    mean_v = full_window(F.avg, "volume", entity, DAY, 30)
    std_v = full_window(F.stddev_samp, "volume", entity, DAY, 30)
    return rows.withColumns({
        "close_ret": change("close"),
        "daily_range": M.candle_spread("high", "low", "close"),
        "volume_zscore": M.ratio(F.col("volume") - mean_v, std_v),
        "residual_vol_7d": full_window(F.stddev_samp, "residual_1d", entity, DAY, 7),
        "residual_vol_14d": full_window(F.stddev_samp, "residual_1d", entity, DAY, 14),
        "residual_volume_1d": change("volume"),
        "momentum_rank": F.lit(0.5), "news_sentiment_1d": F.lit(0.0), "news_volume_1d": F.lit(0.0),
        "market_breadth": F.lit(0.5),
    }).select(entity, DAY, *DAILY_SEQUENCE_COLS)


def residual_decomposition(bars: DataFrame, residuals: DataFrame, entity_value: str, benchmark: str,
                           last: int = 60, entity="entity", ts="ts") -> DataFrame:
    """Entity and benchmark returns next to the entity's daily mean residual and beta, last complete days."""
    two = bars.filter(F.col(entity).isin(entity_value, benchmark)).withColumn(
        "ret", M.relative_change("close", lag_value("close", entity, ts)))
    side = lambda e, name: two.filter(F.col(entity) == e).select(F.to_date(ts).alias(DAY), F.col("ret").alias(name))
    res = residuals.filter((F.col(entity) == entity_value) & F.col("residual").isNotNull()).groupBy(
        F.to_date(ts).alias(DAY)).agg(F.avg("residual").alias("residual"), F.avg("beta").alias("beta"))
    rows = side(benchmark, "bench_ret").join(side(entity_value, "entity_ret"), DAY).join(res, DAY, "left").dropna()
    pct = lambda c: F.round(F.col(c) * 100, 2).alias(c)
    return rows.orderBy(F.desc(DAY)).limit(last).select(
        DAY, pct("bench_ret"), pct("entity_ret"), pct("residual"), F.round("beta", 2).alias("beta"))


def universe_by_average(bars: DataFrame, value: str, minimum: float, since=None, entity="entity", ts="ts") -> DataFrame:
    """Entities whose average value over the period exceeds the minimum, largest first."""
    rows = bars if since is None else bars.filter(F.col(ts) >= F.lit(since).cast("timestamp"))
    return (
        rows.filter(F.col(value).isNotNull()).groupBy(entity).agg(F.avg(value).alias("average"))
        .filter(F.col("average") > minimum).orderBy(F.desc("average"), entity)
    )


def benchmark_return(bars: DataFrame, benchmark: str, start=None, end=None, entity="entity", ts="ts") -> DataFrame:
    """First-to-last close change in per cent."""
    rows = bars.filter(F.col(entity) == benchmark)
    if start is not None:
        rows = rows.filter(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        rows = rows.filter(F.col(ts) <= F.lit(end).cast("timestamp"))
    first, last = F.min_by("close", ts), F.max_by("close", ts)
    return rows.agg(F.round(M.ratio(last - first, first) * 100, 2).alias("return_pct"))


def interval_bars(candidates: DataFrame, bars: DataFrame, hold_days: int, entity="entity", day="entry_date",
                  ts="ts") -> DataFrame:
    """Bars within [day, day + hold] of each candidate.  Candidates are expanded to one row per day of the
    interval, so the range condition becomes an equi-join on (entity, day)."""
    days = candidates.withColumn(DAY, F.explode(F.sequence(F.col(day), F.date_add(day, hold_days))))
    return days.join(bars.withColumn(DAY, F.to_date(ts)), [entity, DAY])

"""Signal evaluation: rank correlation, portfolios, classification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from newsmill.operators.ordering import avg_rank, block_count, block_of, quantile_bounds, ranks_of_counts, running_sums
from newsmill.plans.market import DAY
from newsmill.session import materialize


def spearman_by(pairs: DataFrame, group: list, least: int = 10) -> DataFrame:
    """Spearman correlation of the columns x and y per group, for few groups of any size.

    Ranks come from counted distinct values cut into ordered blocks, rows from counted distinct pairs, so
    neither ties nor the table size concentrate in one task; the rank joins are ordinary shuffle joins that
    AQE splits when one value dominates."""
    known = pairs.filter("x is not null and y is not null")
    counted = materialize(known.groupBy(*group, "x", "y").agg(F.count(F.lit(1)).alias("n")))
    bounds = dict(zip("xy", quantile_bounds(counted, "x", "y", blocks=block_count(counted))))

    def side(c):
        values = counted.groupBy(*group, c).agg(F.sum("n").alias("n")).withColumn("block", block_of(c, bounds[c]))
        return ranks_of_counts(values, c, "block", group).select(*group, c, F.col("centred").alias(f"r{c}"))

    n = F.col("n")
    m = counted.join(side("x"), [*group, "x"]).join(side("y"), [*group, "y"]).groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum(n * F.col("rx") * F.col("ry")).alias("xy"),
        F.sum(n * F.col("rx") * F.col("rx")).alias("xx"), F.sum(n * F.col("ry") * F.col("ry")).alias("yy"))
    ic = F.try_divide(F.col("xy"), F.sqrt(F.col("xx")) * F.sqrt(F.col("yy")))
    return m.select(*group, F.round(F.when(F.col("n") >= least, ic), 6).alias("ic"))


def spearman_ic(df: DataFrame, signal: str, ret: str, least: int = 10) -> DataFrame:
    """Spearman correlation of two whole columns."""
    return spearman_by(df.select(F.col(signal).cast("double").alias("x"), F.col(ret).cast("double").alias("y")), [], least)


def horizon_pairs(df: DataFrame, signal: str, rets: dict) -> DataFrame:
    """(horizon, x, y) rows for several return columns of one signal."""
    return df.select(F.col(signal).cast("double").alias("x"), F.inline(F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(c).cast("double").alias("y")) for h, c in rets.items()])))


def group_ic(df: DataFrame, group: list, signal: str, ret: str, least: int) -> DataFrame:
    """Spearman correlation per group; each group is one cross-section (or a few days of it)."""
    rows = df.filter(F.col(signal).isNotNull() & F.col(ret).isNotNull())
    ranked = rows.select(*group, avg_rank(signal, *group).alias("rx"), avg_rank(ret, *group).alias("ry"))
    # a constant side has no correlation: null, not a division error
    corr = F.try_divide(F.covar_pop("rx", "ry"), F.stddev_pop("rx") * F.stddev_pop("ry"))
    return ranked.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), corr.alias("ic")).filter(F.col("n") >= least)


def daily_ic(df: DataFrame, signal: str, ret: str, least: int = 5, day: str = DAY) -> DataFrame:
    return group_ic(df, [day], signal, ret, least)


def ic_summary(daily: DataFrame) -> DataFrame:
    mean, std = F.round(F.avg("ic"), 4), F.round(F.stddev_samp("ic"), 4)
    return daily.agg(
        F.count("ic").alias("days"), mean.alias("ic_mean"), std.alias("ic_std"),
        F.round(F.try_divide(mean, std), 4).alias("icir"),
        F.round(F.try_divide(100.0 * F.count_if(F.col("ic") > 1e-12), F.count("ic")), 4).alias("positive_pct"),
    )


def ic_by_month(daily: DataFrame, day: str = DAY) -> DataFrame:
    return daily.groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(
        F.round(F.avg("ic"), 6).alias("ic"), F.count(F.lit(1)).alias("days"))


def rolling_ic(df: DataFrame, signal: str, ret: str, window: int = 20, least: int = 10, day: str = DAY) -> DataFrame:
    """Pooled IC of each block of ``window`` consecutive dates, labelled by the date after the block.

    A row belongs to ``window`` blocks but is sent to two tasks at most: blocks that end within ``window`` dates of each other are one group, which holds the
    cross-sections of twice as many dates and ranks them block by block."""
    dates = df.select(day).distinct().select(
        day, (F.row_number().over(W.orderBy(day)) - 1).alias("pos"), F.count(F.lit(1)).over(W.partitionBy()).alias("total"))
    known = df.filter(F.col(signal).isNotNull() & F.col(ret).isNotNull())
    rows = known.select(day, F.col(signal).cast("double").alias("x"), F.col(ret).cast("double").alias("y")).join(dates, day)
    lo, hi = F.greatest(F.col("pos") + 1, F.lit(window)), F.least(F.col("pos") + window, F.col("total") - 1)
    near = rows.filter(lo <= hi).select("pos", "total", "x", "y", F.explode(F.sequence(F.floor(lo / window), F.floor(hi / window))).alias("group"))

    def blocks(table: pa.Table) -> pa.Table:
        pos, x, y = (table.column(c).to_numpy() for c in ("pos", "x", "y"))
        group, total = table.column("group")[0].as_py(), table.column("total")[0].as_py()
        order = np.argsort(pos, kind="stable")
        pos, x, y = pos[order], x[order], y[order]
        out = []
        for block in range(max(window, group * window), min(total, (group + 1) * window)):
            a, b = np.searchsorted(pos, [block - window, block])
            if b - a >= least:
                rx, ry = _average_ranks(x[a:b]), _average_ranks(y[a:b])
                spread = rx.std() * ry.std()
                out.append((block, b - a, ((rx - rx.mean()) * (ry - ry.mean())).mean() / spread if spread > 0 else None))
        names = list(zip(*out)) or [[], [], []]
        return pa.table({"block": pa.array(names[0], pa.int32()), "n": pa.array(names[1], pa.int64()), "ic": pa.array(names[2], pa.float64())})

    ic = near.groupBy("group").applyInArrow(blocks, "block int, n long, ic double")
    as_of = dates.select(F.col("pos").alias("block"), F.col(day).alias("as_of"))
    return ic.join(as_of, "block").select("as_of", "n", F.round("ic", 6).alias("ic"))


def _average_ranks(values: np.ndarray) -> np.ndarray:
    """Average-tie ranks from 1."""
    _, index, counts = np.unique(values, return_inverse=True, return_counts=True)
    return (np.cumsum(counts) - (counts - 1) / 2)[index]


def rolling_ic_summary(rolling: DataFrame) -> DataFrame:
    mean, std = F.avg("ic"), F.stddev_pop("ic")
    return rolling.agg(
        F.round(mean, 6).alias("ic_mean"), F.round(std, 6).alias("ic_std"),
        F.round(F.try_divide(mean, std), 4).alias("icir"))


def classification_report(df: DataFrame, truth: str, pred: str, positive: int = 1) -> DataFrame:
    rows = df.filter(F.col(truth).isNotNull())
    t, p = F.col(truth) == positive, F.col(pred) == positive
    tp, n_t, n_p = F.count_if(t & p), F.count_if(t), F.count_if(p)
    part = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return rows.agg(
        F.round(part(F.count_if(F.col(truth) == F.col(pred)), F.count(F.lit(1))), 4).alias("accuracy"),
        F.round(part(tp, n_p), 4).alias("precision_buy"),
        F.round(part(tp, n_t), 4).alias("recall_buy"),
        F.round(part(2 * tp, n_p + n_t), 4).alias("f1_buy"),
    )


def confusion_matrix(df: DataFrame, truth: str, pred: str, classes=(-1, 0, 1)) -> DataFrame:
    """One row per true class with one count column per predicted class."""
    names = {c: f"pred_{str(c).replace('-', 'm')}" for c in classes}
    return df.filter(F.col(truth).isNotNull()).groupBy(F.col(truth).cast("int").alias("truth")).agg(
        *[F.count_if(F.col(pred) == c).alias(n) for c, n in names.items()])


def roc_points(df: DataFrame, truth: str, score: str, positive: int = 1) -> DataFrame:
    """(threshold, tpr, fpr) at every distinct score, plus the running counts AUC is built from."""
    hit = F.col(truth) == positive
    counts = df.filter(F.col(truth).isNotNull() & F.col(score).isNotNull()).groupBy(
        F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")).withColumn("down", -F.col("threshold"))
    run = running_sums(counts, "down", None, {"pos": "tp", "neg": "fp"})
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    return run.withColumn("t", totals).select(
        "threshold", "pos", "neg", "tp", "fp", F.try_divide(F.col("tp"), F.col("t.p")).alias("tpr"),
        F.try_divide(F.col("fp"), F.col("t.n")).alias("fpr"))


def auc(roc: DataFrame) -> DataFrame:
    """Area under the curve from the ROC rows (ties count half)."""
    above = F.col("tp") - F.col("pos") + F.col("pos") / 2.0
    return roc.agg(F.round(
        F.try_divide(F.sum(F.col("neg") * above), F.sum("pos").cast("double") * F.sum("neg")), 4).alias("auc"))


def daily_top(df: DataFrame, signal: str, ret: str, n: int, day: str = DAY, entity="entity",
              full_only: bool = True) -> DataFrame:
    """Mean return of the day's n best signals.  ``full_only`` ranks rows with a known return and needs n of
    them; otherwise all rows are ranked and unknown returns drop out of the mean."""
    rows = df.filter(F.col(ret).isNotNull()) if full_only else df
    w = W.partitionBy(day).orderBy(F.desc_nulls_last(signal), F.col(entity))
    top = rows.select(day, ret, F.row_number().over(w).alias("rk")).filter(F.col("rk") <= n)
    out = top.groupBy(day).agg(F.avg(ret).alias("pnl"), F.count(F.lit(1)).alias("held"))
    return out.filter(F.col("held") == n) if full_only else out


def equity_curve(daily: DataFrame, day: str = DAY, pnl: str = "pnl") -> DataFrame:
    """Compounded equity and drawdown of one return per day (a calendar-sized table).

    Compounded as a sum of logarithms, so long series neither overflow nor vanish in ``log_equity`` and ``drawdown``.  A
    return of -1 or less loses everything: equity is 0 and drawdown -1 from that day on."""
    w = W.orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    r = F.coalesce(F.col(pnl), F.lit(0.0))
    alive = F.min(r).over(w) > -1
    curve = daily.withColumn("log_equity", F.when(alive, F.sum(F.when(r > -1, F.log1p(r))).over(w)))
    peak = F.max("log_equity").over(w)
    lost = F.col("log_equity").isNull()
    return curve.withColumn("equity", F.when(lost, 0.0).otherwise(F.exp("log_equity"))).withColumn(
        "drawdown", F.when(lost, -1.0).otherwise(F.exp(F.col("log_equity") - peak) - 1))


def topn_portfolio(df: DataFrame, signal: str, ret: str, n: int = 20, hold_days: int = 3, day: str = DAY,
                   entity="entity", least_days: int = 5) -> DataFrame:
    curve = equity_curve(daily_top(df, signal, ret, n, day, entity), day)
    ok = lambda c: F.when(F.count("pnl") >= least_days, c)
    std = F.stddev_pop("pnl")
    return curve.agg(
        F.round(ok(F.when(std > 0, F.avg("pnl") / std * F.sqrt(F.lit(252.0)))), 4).alias("sharpe"),
        F.round(ok(F.min("drawdown")), 4).alias("max_drawdown"),
        F.round(ok(F.max_by("equity", day) - 1), 4).alias("total_return"),
        F.round(ok(F.max_by("log_equity", day)), 4).alias("log_return"),
        F.round(ok(F.avg((F.col("pnl") > 0).cast("double"))), 4).alias("win_rate"),
        F.coalesce(ok(F.count("pnl") * n), F.lit(0)).cast("bigint").alias("total_trades"),
        F.lit(hold_days).alias("avg_holding_days"),
    )


def pearson_ic(df: DataFrame, signal: str, ret: str, by=(), least: int = 11) -> DataFrame:
    """Linear correlation of signal and return (per ``by``) over rows that have both; null below ``least`` rows."""
    rows = df.filter(F.col(signal).isNotNull() & F.col(ret).isNotNull())
    n = F.count(F.lit(1))
    # try_divide of the moments: a constant side gives null
    cov, sx, sy = F.covar_pop(signal, ret), F.stddev_pop(signal), F.stddev_pop(ret)
    ic = F.when((n >= least) & (sx > 0) & (sy > 0), F.try_divide(cov, sx * sy))
    return rows.groupBy(*by).agg(n.alias("n"), F.round(ic, 4).alias("pearson_ic"))


def return_stats(daily: DataFrame, day: str = DAY, pnl: str = "pnl") -> DataFrame:
    """Sharpe (sample std) and drawdown of a daily return series; unknown returns count 0 in the curve."""
    std = F.stddev_samp(pnl)
    return equity_curve(daily, day, pnl).agg(
        F.round(F.when((F.count(pnl) >= 2) & (std > 0), F.avg(pnl) / std * F.sqrt(F.lit(252.0))), 4).alias("sharpe"),
        F.round(F.min("drawdown"), 4).alias("max_drawdown"), F.count(pnl).alias("days"))


def hit_rate(df: DataFrame, signal: str, ret: str, n: int, day: str = DAY, entity="entity") -> DataFrame:
    """Share of days on which the top n beat the bottom n."""
    w = W.partitionBy(day).orderBy(F.desc_nulls_last(signal), F.col(entity))
    rows = df.select(day, ret, F.row_number().over(w).alias("rk"), F.count(F.lit(1)).over(W.partitionBy(day)).alias("n"))
    days = rows.filter(F.col("n") >= 2 * n).groupBy(day).agg(
        F.avg(F.when(F.col("rk") <= n, F.col(ret))).alias("top"),
        F.avg(F.when(F.col("rk") > F.col("n") - n, F.col(ret))).alias("bottom")).dropna()
    return days.agg(
        F.count(F.lit(1)).alias("days"),
        F.round(F.avg((F.col("top") > F.col("bottom")).cast("double")), 4).alias("hit_rate"))


def quartile_curve(df: DataFrame, signal: str, ret: str, least: int = 20, day: str = DAY, entity="entity") -> DataFrame:
    """Cumulated mean return (per cent) of the day's best and worst quarter by signal."""
    rows = df.filter(F.col(ret).isNotNull())
    w = W.partitionBy(day).orderBy(F.desc_nulls_last(signal), F.col(entity))
    rows = rows.select(day, ret, F.row_number().over(w).alias("rk"), F.count(F.lit(1)).over(W.partitionBy(day)).alias("n"))
    q = F.greatest(F.floor(F.col("n") / 4), F.lit(1))
    days = rows.filter(F.col("n") >= least).groupBy(day).agg(
        F.avg(F.when(F.col("rk") <= q, F.col(ret))).alias("top"),
        F.avg(F.when(F.col("rk") > F.col("n") - q, F.col(ret))).alias("bottom"))
    run = W.orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    long, short = F.sum(F.col("top") * 100).over(run), F.sum(-F.col("bottom") * 100).over(run)
    return days.select(day, F.round(long, 2).alias("long"), F.round(short, 2).alias("short"),
                       F.round(long + short, 2).alias("net"))


def ic_by_horizon(df: DataFrame, signal: str, rets: dict) -> DataFrame:
    """One IC per horizon; ``rets`` maps horizon name -> return column."""
    ic = spearman_by(horizon_pairs(df, signal, rets), ["horizon"], least=2)
    return ic.select("horizon", F.round("ic", 4).alias("ic"))


def signal_distribution(df: DataFrame, score: str, long_above: float = 0.0, short_below: float = 0.0) -> DataFrame:
    s = F.col(score)
    return df.agg(
        F.count(s).alias("n"), F.round(F.avg(s), 6).alias("mean"), F.round(F.stddev_samp(s), 6).alias("std"),
        F.round(F.min(s), 6).alias("min"), F.round(F.max(s), 6).alias("max"),
        F.count_if(s > long_above).alias("n_long"), F.count_if(s < short_below).alias("n_short"))


def long_form(metrics: DataFrame) -> DataFrame:
    """One-row metric frame -> (metric, value) rows."""
    return metrics.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metrics.columns
    ])).alias("m")).select("m.*")


def full_eval(df: DataFrame, signal: str, truth: str, pred: str, rets=("forward_ret_1d", "forward_ret_3d", "forward_ret_7d"),
              n: int = 20, day: str = DAY, entity="entity") -> DataFrame:
    """Every metric of a scored table as (metric, value) rows (the table is materialised once)."""
    df = materialize(df.select(*dict.fromkeys([entity, day, signal, truth, pred, *rets])))
    names = {f"ic_{r.split('_')[-1]}": r for r in rets}
    ics = spearman_by(horizon_pairs(df, signal, names), ["horizon"])
    parts = [ics.agg(*[F.max(F.when(F.col("horizon") == h, F.col("ic"))).alias(h) for h in names])]
    roll = rolling_ic_summary(rolling_ic(df, signal, rets[1], day=day))
    parts += [
        roll.select(F.col("ic_mean").alias("ic_3d_mean"), F.col("ic_std").alias("ic_3d_std"), "icir"),
        classification_report(df, truth, pred),
        topn_portfolio(df, signal, rets[1], n, day=day, entity=entity),
    ]
    out = long_form(parts[0])
    for p in parts[1:]:
        out = out.unionByName(long_form(p))
    return out

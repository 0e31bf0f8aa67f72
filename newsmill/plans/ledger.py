"""Trade-ledger analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from newsmill.functions import market as M, rules
from newsmill.operators.ordering import carry_forward, order_blocks
from newsmill.plans.market import DAY, interval_bars


def trade_outcomes(candidates: DataFrame, bars: DataFrame, exit_rules: dict | None = None,
                   entity="entity", ts="ts") -> DataFrame:
    """Exit return and reason of every candidate trade (entity, entry_date, direction, ...).

    The outcome depends on entity, day and side only, so it is computed once per distinct combination (at most
    two per entity and day, each with a few days of bars) and joined back to the candidates.  The running peak
    only grows, hence "the trailing stop is armed" is simply peak >= arm level at the checkpoint; the exit is
    the first checkpoint whose rule fires, in the order trailing stop, take-profit, stop-loss."""
    key = [entity, "entry_date", "direction"]
    r = rules.EXIT_RULES if exit_rules is None else exit_rules
    buy = F.col("direction") == "BUY"
    rows = interval_bars(candidates.select(*key).distinct(), bars, r["hold_days"], entity, ts=ts)
    w = W.partitionBy(*key).orderBy(ts)
    rows = rows.withColumns({
        "entry": F.first("open").over(w), "n": F.row_number().over(w),
        "total": F.count(F.lit(1)).over(W.partitionBy(*key)),
    }).filter("entry > 0")
    gain = lambda up, down: F.when(buy, (F.col(up) - F.col("entry")) / F.col("entry")).otherwise(
        (F.col("entry") - F.col(down)) / F.col("entry"))
    rows = rows.withColumns({"hp": gain("high", "low"), "lp": gain("low", "high"), "cp": gain("close", "close")})
    peak = F.greatest(F.max("hp").over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit(0.0))
    level = lambda what: F.when(buy, F.lit(r["BUY"][what])).otherwise(F.lit(r["SHORT"][what]))
    check = (F.col("n") % r["check_every"] == 0) | (F.col("n") == F.col("total"))
    rows = rows.withColumn("peak", peak)
    exit_ = (
        F.when((F.col("peak") >= level("arm")) & (F.col("cp") <= level("floor")),
               F.struct(F.lit("trailing_stop").alias("reason"), F.col("cp").alias("ret")))
        .when(F.col("hp") >= r["take_profit"], F.struct(F.lit("take_profit").alias("reason"), F.lit(r["take_profit"]).alias("ret")))
        .when(F.col("lp") <= r["stop_loss"], F.struct(F.lit("stop_loss").alias("reason"), F.lit(r["stop_loss"]).alias("ret")))
    )
    rows = rows.withColumn("hit", F.when(check, exit_))
    done = rows.groupBy(*key).agg(
        F.min_by("hit", F.when(F.col("hit").isNotNull(), F.col("n"))).alias("hit"),
        F.max_by("cp", "n").alias("last"), F.first("entry").alias("entry_price"))
    return candidates.join(done, key, "left").select(
        *candidates.columns, "entry_price",
        F.round(F.coalesce(F.col("hit.ret"), F.col("last"), F.lit(0.0)), 6).alias("pnl_pct"),
        F.coalesce(F.col("hit.reason"), F.when(F.col("last").isNotNull(), "expiry"), F.lit("no_data")).alias("exit_reason"))


def with_pnl(trades: DataFrame) -> DataFrame:
    """pnl_pct (6 dp) and pnl_usdt (4 dp) from entry and exit prices."""
    return trades.withColumns({
        "pnl_pct": F.round(M.trade_pnl_pct("direction", "entry_price", "exit_price"), 6),
        "pnl_usdt": F.round(M.trade_pnl("direction", "entry_price", "exit_price", "quantity"), 4),
    })


def ledger_equity(trades: DataFrame, capital: float, order="exit_time", key="id", pnl="pnl_usdt") -> DataFrame:
    """Equity and drawdown after every trade in exit order, computed block by block."""
    block = "__block"
    cut = order_blocks(trades.withColumn("__t", F.unix_micros(F.col(order).cast("timestamp"))), "__t", key, block)
    before = carry_forward(cut.groupBy(block).agg(F.sum(pnl).alias("s")), block, {"s": "__before"})
    within = W.partitionBy(block).orderBy("__t", key).rowsBetween(W.unboundedPreceding, 0)
    rows = cut.join(before, block).withColumn(
        "equity", F.lit(float(capital)) + F.col("__before") + F.sum(pnl).over(within))
    earlier = W.orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    peaks = rows.groupBy(block).agg(F.max("equity").alias("top")).select(
        block, F.greatest(F.coalesce(F.max("top").over(earlier), F.lit(float(capital))), F.lit(float(capital))).alias("__peak"))
    peak = F.greatest(F.col("__peak"), F.max("equity").over(within))
    return rows.join(peaks, block).withColumn(
        "drawdown", (peak - F.col("equity")) / peak).drop(block, "__t", "__before", "__peak")


def side_stats(win="pnl_usdt") -> list:
    """Aggregates shared by every breakdown."""
    pnl, out = F.col(win), []
    for name, side in (("long", "BUY"), ("short", "SHORT")):
        on = F.col("direction") == side
        out += [
            F.count_if(on).alias(f"{name}_trades"),
            F.round(F.coalesce(F.sum(F.when(on, pnl)), F.lit(0.0)), 2).alias(f"{name}_pnl"),
            F.round(F.coalesce(F.try_divide(100.0 * F.count_if(on & (pnl > 0)), F.count_if(on)), F.lit(0.0)), 1).alias(f"{name}_wr"),
        ]
    return out


def ledger_metrics(trades: DataFrame, capital: float, start, end, entity="entity", order="exit_time", key="id") -> DataFrame:
    """One row of performance metrics for a closed ledger over [start, end]."""
    pnl, ret = F.col("pnl_usdt"), F.col("pnl_pct")
    rows = ledger_equity(trades, capital, order, key)
    days = F.greatest(F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")), F.lit(1))
    n = F.count(F.lit(1))
    wins, losses = F.count_if(pnl > 0), F.count_if(pnl < 0)
    agg = rows.agg(
        n.alias("trades"), F.countDistinct(entity).alias("unique_entities"), F.sum(pnl).alias("pnl"),
        wins.alias("wins"), F.avg(ret).alias("mean_ret"),
        F.when(n > 1, F.stddev_samp(ret)).otherwise(F.lit(1.0)).alias("std"),
        F.when(F.count_if(ret < 0) > 1, F.stddev_samp(F.when(ret < 0, ret))).otherwise(F.lit(1.0)).alias("down_std"),
        F.coalesce(F.sum(F.when(pnl > 0, pnl)), F.lit(0.0)).alias("gross_win"),
        F.abs(F.coalesce(F.sum(F.when(pnl < 0, pnl)), F.lit(0.0))).alias("gross_loss"),
        F.coalesce(F.avg(F.when(pnl > 0, pnl)), F.lit(0.0)).alias("avg_win"),
        F.coalesce(F.avg(F.when(pnl < 0, pnl)), F.lit(0.0)).alias("avg_loss"),
        F.greatest(F.max("drawdown"), F.lit(0.0)).alias("max_dd"), *side_stats(),
    ).withColumn("days", days)
    per_year = F.sqrt(F.col("trades") / (F.col("days") / 252.0))
    total = F.col("pnl") / float(capital) * 100
    capped = lambda c: F.round(F.least(F.coalesce(c, F.lit(99.99)), F.lit(99.99)), 2)
    zero = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 2)
    return agg.select(
        F.round("pnl", 2).alias("pnl_usd"), F.round(total, 2).alias("return_pct"), "trades", "unique_entities",
        F.round(F.try_divide(100.0 * F.col("wins"), F.col("trades")), 1).alias("win_rate"),
        "long_trades", "short_trades", "long_pnl", "short_pnl", "long_wr", "short_wr",
        capped(F.try_divide(F.col("gross_win"), F.col("gross_loss"))).alias("profit_factor"),
        capped(F.abs(F.try_divide(F.col("avg_win"), F.col("avg_loss")))).alias("payoff_ratio"),
        zero(F.try_divide(F.col("mean_ret"), F.col("std")) * per_year).alias("sharpe"),
        zero(F.try_divide(F.col("mean_ret"), F.col("down_std")) * per_year).alias("sortino"),
        F.round(F.col("max_dd") * 100, 2).alias("max_drawdown_pct"),
        capped(F.try_divide(total * 252 / F.col("days"), F.col("max_dd") * 100)).alias("calmar"),
        F.round("avg_win", 2).alias("avg_win_usd"), F.round("avg_loss", 2).alias("avg_loss_usd"),
    )


def ledger_breakdown(trades: DataFrame, category="category", entity="entity") -> DataFrame:
    """Totals per (category, entity) and per category in one roll-up; ``level`` tells them apart."""
    pnl = F.col("pnl_usdt")
    out = trades.rollup(category, entity).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("total_trades"),
        F.countDistinct(F.col(entity)).alias("entities"), *side_stats(),
        F.round(F.sum(pnl), 2).alias("net_pnl"), F.round(F.avg(pnl), 4).alias("pnl_per_trade"))
    level = F.when(F.col("gid") == 0, "entity").when(F.col("gid") == 1, "category").otherwise("all")
    return out.withColumn("level", level).drop("gid")


def monthly_breakdown(trades: DataFrame, date="entry_time") -> DataFrame:
    pnl = F.col("pnl_usdt")
    return trades.groupBy(F.date_format(date, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("trades"), F.round(F.sum(pnl), 2).alias("pnl_usd"),
        F.round(100.0 * F.count_if(pnl > 0) / F.count(F.lit(1)), 1).alias("win_rate"), *side_stats())


def weekly_breakdown(trades: DataFrame, weeks: DataFrame, date="entry_time") -> DataFrame:
    """Totals per week of a (week, date_from, date_to) table, weeks without trades included.  Weeks are
    expanded to days, so the range condition is an equi-join."""
    days = weeks.select("week", F.explode(F.sequence("date_from", "date_to")).alias(DAY))
    pnl = F.col("pnl_usdt")
    per_day = trades.groupBy(F.to_date(date).alias(DAY)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(pnl).alias("s"), F.count_if(pnl > 0).alias("w"))
    per_week = days.join(per_day, DAY).groupBy("week").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("w").alias("w"))
    return weeks.join(per_week, "week", "left").select(
        "week", "date_from", "date_to", F.coalesce("n", F.lit(0)).alias("trades"),
        F.round(F.coalesce("s", F.lit(0.0)), 2).alias("pnl_usd"),
        F.round(F.coalesce(F.try_divide(100.0 * F.col("w"), F.col("n")), F.lit(0.0)), 1).alias("win_rate"))


def exit_breakdown(trades: DataFrame, reason="exit_reason") -> DataFrame:
    return trades.groupBy(reason).agg(F.count(F.lit(1)).alias("trades"), F.round(F.sum("pnl_usdt"), 2).alias("pnl_usd"))


def contributors(trades: DataFrame, n: int = 5, entity="entity") -> DataFrame:
    """Best and worst n entities by total pnl."""
    per = trades.groupBy(entity).agg(F.round(F.sum("pnl_usdt"), 2).alias("pnl_usd"), F.count(F.lit(1)).alias("trades"))
    best = per.orderBy(F.desc("pnl_usd"), entity).limit(n).withColumn("side", F.lit("top"))
    worst = per.orderBy(F.asc("pnl_usd"), entity).limit(n).withColumn("side", F.lit("bottom"))
    return best.unionByName(worst)


def filter_comparison(trades: DataFrame, context: DataFrame, noise: float = 0.01) -> DataFrame:
    """Every direction filter applied to every trade, for all trades and for those beyond the noise level,
    with the gain over taking everything.  One pass: trade -> verdicts -> partial aggregates per filter."""
    rows = trades.withColumn(DAY, F.to_date("entry_time")).join(context.withColumn("market_day", F.col(DAY)), DAY, "left")
    rows = rows.select("direction", "pnl_usdt", F.inline(M.direction_filters()))
    sets = F.when(F.abs("pnl_usdt") > noise, F.array(F.lit("all"), F.lit("meaningful"))).otherwise(F.array(F.lit("all")))
    rows = rows.select("*", F.explode(sets).alias("trade_set")).withColumn("adj", F.col("pnl_usdt") * F.col("mult"))
    take, adj = F.col("allow"), F.col("adj")
    side = lambda d: take & (F.col("direction") == d)
    total = lambda cond: F.coalesce(F.sum(F.when(cond, adj)), F.lit(0.0))
    rate = lambda cond: F.coalesce(
        F.try_divide(100.0 * F.count_if(cond & (adj > 0)), F.count_if(cond & (adj != 0))), F.lit(0.0))
    out = rows.groupBy("trade_set", "method").agg(
        total(take).alias("pnl"), F.count_if(take).alias("taken"), F.count_if(~take).alias("skipped"),
        F.round(rate(take), 2).alias("win_rate"),
        F.count_if(side("BUY")).alias("longs"), F.count_if(side("SHORT")).alias("shorts"),
        F.round(total(side("BUY")), 2).alias("pnl_long"), F.round(total(side("SHORT")), 2).alias("pnl_short"),
        F.round(rate(side("BUY")), 2).alias("win_rate_long"), F.round(rate(side("SHORT")), 2).alias("win_rate_short"))
    base = F.max(F.when(F.col("method") == "0_no_filter", F.col("pnl"))).over(W.partitionBy("trade_set"))
    return out.withColumn("delta", F.round(F.col("pnl") - base, 2)).withColumn("pnl", F.round("pnl", 2))


def closed(trades: DataFrame) -> DataFrame:
    return trades.filter(F.col("status") == "CLOSED")


def ledger_monitors(trades: DataFrame, now, take_profit_hours: int = 48, short_days: int = 7, floor: float = -50.0) -> DataFrame:
    """Alert inputs and today's scorecard in one pass over the closed trades."""
    now = F.lit(now).cast("timestamp")
    kept = ~F.col("notes").isin(rules.EXCLUDED_EXIT_NOTES)
    today = (F.to_date("exit_time") == F.to_date(now)) & kept
    pnl, note = F.col("pnl_usdt"), F.col("notes")
    week = (F.col("direction") == "SHORT") & (F.col("exit_time") >= now - F.expr(f"INTERVAL {short_days} DAYS")) & kept
    tp48 = F.count_if((note == "take_profit") & (F.col("exit_time") >= now - F.expr(f"INTERVAL {take_profit_hours} HOURS")))
    money = lambda cond: F.round(F.coalesce(F.sum(F.when(cond, pnl)), F.lit(0.0)), 2)
    return closed(trades).agg(
        tp48.alias("take_profits_48h"), (tp48 == 0).alias("alert_no_take_profit"),
        money(week).alias("short_pnl_7d"), (money(week) < floor).alias("alert_short_pnl"),
        F.count_if(today & (note == "take_profit")).alias("today_tp"),
        F.count_if(today & (note == "stop_loss")).alias("today_sl"),
        F.count_if(today & note.like("expiry%")).alias("today_exp"),
        money(today & (F.col("direction") == "BUY")).alias("today_long_pnl"),
        money(today & (F.col("direction") == "SHORT")).alias("today_short_pnl"))


def state_shifts(regime: DataFrame, state="regime_state", date=DAY) -> DataFrame:
    """Days whose state differs from the previous row (one row per day: calendar-sized)."""
    prev = F.lag(state).over(W.orderBy(date))
    return regime.select(date, prev.alias("previous"), F.col(state).alias("current")).filter("previous <> current")


def opened_since(trades: DataFrame, now, hours: int = 4) -> DataFrame:
    since = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    return trades.filter((F.col("entry_time") >= since) & (F.col("status") == "OPEN"))


def closed_since(trades: DataFrame, now, hours: int = 4) -> DataFrame:
    since = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    return closed(trades).filter(F.col("exit_time") >= since)


def ledger_totals(trades: DataFrame, key="id") -> DataFrame:
    """All-time count, wins, totals, and the best and worst trade."""
    pnl = F.col("pnl_usdt")
    order = lambda sign: F.struct(F.col("pnl_pct") * sign, -F.col(key))
    return closed(trades).agg(
        F.count(F.lit(1)).alias("trades"), F.count_if(pnl > 0).alias("wins"), F.round(F.sum(pnl), 2).alias("pnl"),
        F.round(F.avg("pnl_pct"), 6).alias("avg_pnl_pct"),
        F.max_by(key, order(1)).alias("best_id"), F.max_by(key, order(-1)).alias("worst_id"))


def consistency_by(trades: DataFrame, cols: list) -> DataFrame:
    """Counts, average pnl and size statistics per group, for checking a gating rule."""
    return trades.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("pnl_pct"), 4).alias("avg_pnl_pct"),
        F.round(F.sum("pnl_usdt"), 2).alias("total_pnl"), F.round(F.avg("usdt_size"), 2).alias("avg_size"),
        F.round(F.min("usdt_size"), 2).alias("min_size"), F.round(F.max("usdt_size"), 2).alias("max_size"))


def orphan_positions(trades: DataFrame, live: DataFrame, symbol="symbol") -> DataFrame:
    """Open ledger positions without an external (symbol, side) counterpart."""
    side = F.when(F.col("direction") == "SHORT", "SHORT").otherwise("LONG")
    return trades.filter("status = 'OPEN'").withColumn("side", side).join(live.select(symbol, "side"), [symbol, "side"], "left_anti")

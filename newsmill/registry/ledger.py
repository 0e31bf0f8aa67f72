"""Queries over the trade ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.plans import ledger as L, market
from newsmill.registry import query
from newsmill.registry.market import BENCH_D, BENCH_SQL, BREADTH_SQL

CAPITAL, START, END = 100000.0, "1995-01-01", "2001-12-31"

SIDES = """count(*) FILTER (WHERE direction = 'BUY') AS long_trades, round(coalesce(sum(pnl_usdt) FILTER (WHERE direction = 'BUY'), 0), 2) + 0.0 AS long_pnl,
    coalesce(round(100.0 * count(*) FILTER (WHERE direction = 'BUY' AND pnl_usdt > 0) / nullif(count(*) FILTER (WHERE direction = 'BUY'), 0), 1), 0) AS long_wr,
    count(*) FILTER (WHERE direction = 'SHORT') AS short_trades, round(coalesce(sum(pnl_usdt) FILTER (WHERE direction = 'SHORT'), 0), 2) + 0.0 AS short_pnl,
    coalesce(round(100.0 * count(*) FILTER (WHERE direction = 'SHORT' AND pnl_usdt > 0) / nullif(count(*) FILTER (WHERE direction = 'SHORT'), 0), 1), 0) AS short_wr"""


def _candidates(v):
    """One candidate per event of the first kind, on the event's day."""
    rows = v.table("events").select(F.col("event_id").alias("cand_id"), F.col("event_type").alias("entity"), F.to_date("ts").alias("entry_date"), "user_id")
    return rows.withColumn("direction", F.when(F.col("user_id") % 2 == 0, "BUY").otherwise("SHORT")).drop("user_id")


OUTCOMES = """
    cand AS (SELECT DISTINCT entity, entry_date, direction FROM (SELECT event_type AS entity, CAST(ts AS DATE) AS entry_date, CASE WHEN user_id % 2 = 0 THEN 'BUY' ELSE 'SHORT' END AS direction FROM events)),
    b AS (SELECT c.*, h.ts, h.open, h.high, h.low, h.close, first_value(h.open) OVER w AS e, row_number() OVER w AS n, count(*) OVER (PARTITION BY c.entity, c.entry_date, c.direction) AS total
          FROM cand c JOIN v_hourly_bars h ON h.entity = c.entity AND CAST(h.ts AS DATE) BETWEEN c.entry_date AND c.entry_date + 3 WINDOW w AS (PARTITION BY c.entity, c.entry_date, c.direction ORDER BY h.ts)),
    g AS (SELECT *, CASE direction WHEN 'BUY' THEN (high - e) / e ELSE (e - low) / e END AS hp, CASE direction WHEN 'BUY' THEN (low - e) / e ELSE (e - high) / e END AS lp, CASE direction WHEN 'BUY' THEN (close - e) / e ELSE (e - close) / e END AS cp FROM b),
    p AS (SELECT *, greatest(0, max(hp) OVER (PARTITION BY entity, entry_date, direction ORDER BY n)) AS peak FROM g),
    x AS (SELECT *, CASE WHEN n % 4 <> 0 AND n <> total THEN NULL WHEN peak >= CASE direction WHEN 'BUY' THEN 0.02 ELSE 0.015 END AND cp <= CASE direction WHEN 'BUY' THEN -0.015 ELSE -0.003 END THEN 'trailing_stop'
                 WHEN hp >= 0.045 THEN 'take_profit' WHEN lp <= -0.08 THEN 'stop_loss' END AS why FROM p),
    o AS (SELECT entity, entry_date, direction, min(e) AS e, arg_min(why, n) FILTER (WHERE why IS NOT NULL) AS why, arg_min(cp, n) FILTER (WHERE why IS NOT NULL) AS stop_at, arg_max(cp, n) AS last FROM x GROUP BY ALL)"""


@query("trade_outcomes", f"""WITH {OUTCOMES}
    SELECT event_id AS cand_id, o.entity, CAST(o.entry_date AS VARCHAR) AS entry_date, o.direction, round(e, 6) AS entry_price,
           round(CASE why WHEN 'trailing_stop' THEN stop_at WHEN 'take_profit' THEN 0.045 WHEN 'stop_loss' THEN -0.08 ELSE last END, 6) + 0.0 AS pnl_pct, coalesce(why, 'expiry') AS exit_reason
    FROM events v JOIN o ON o.entity = v.event_type AND o.entry_date = CAST(v.ts AS DATE) AND o.direction = CASE WHEN v.user_id % 2 = 0 THEN 'BUY' ELSE 'SHORT' END""")
def _(v):
    return L.trade_outcomes(_candidates(v), v.hourly_bars).withColumn("entry_price", F.round("entry_price", 6))


@query("interval_bars", """
    SELECT c.entity, CAST(c.d AS VARCHAR) AS entry_date, count(*) AS bars, round(max(high), 4) AS high FROM (SELECT DISTINCT event_type AS entity, CAST(ts AS DATE) AS d FROM events) c
    JOIN v_hourly_bars h ON h.entity = c.entity AND CAST(h.ts AS DATE) BETWEEN c.d AND c.d + 3 GROUP BY ALL""")
def _(v):
    cand = _candidates(v).select("entity", "entry_date").distinct()
    rows = market.interval_bars(cand, v.hourly_bars, 3)
    return rows.groupBy("entity", "entry_date").agg(F.count(F.lit(1)).alias("bars"), F.round(F.max("high"), 4).alias("high"))


@query("trade_pnl", """
    SELECT id, direction, round(s * (exit_price - entry_price) / entry_price + 1e-12 * sign(s * (exit_price - entry_price)), 6) + 0.0 AS pnl_pct, round(s * (exit_price - entry_price) * quantity, 4) + 0.0 AS pnl_usdt FROM (SELECT *, CASE direction WHEN 'SHORT' THEN -1 ELSE 1 END AS s FROM v_closed)""")
def _(v):
    rows = L.with_pnl(v.closed_trades.drop("pnl_pct", "pnl_usdt"))
    return rows.select("id", "direction", "pnl_pct", "pnl_usdt")


EQUITY = f"""
    eq AS (SELECT *, {CAPITAL} + sum(pnl_usdt) OVER (ORDER BY exit_time, id ROWS UNBOUNDED PRECEDING) AS equity FROM v_closed),
    pk AS (SELECT *, greatest({CAPITAL}, max(equity) OVER (ORDER BY exit_time, id ROWS UNBOUNDED PRECEDING)) AS peak FROM eq)"""


@query("ledger_equity", f"WITH {EQUITY} SELECT id, round(equity, 2) AS equity, round((peak - equity) / peak, 6) + 0.0 AS drawdown FROM pk")
def _(v):
    return L.ledger_equity(v.closed_trades, CAPITAL).select("id", F.round("equity", 2).alias("equity"), F.round("drawdown", 6).alias("drawdown"))


@query("ledger_metrics", f"""WITH {EQUITY},
    m AS (SELECT count(*) AS n, count(DISTINCT entity) AS u, sum(pnl_usdt) AS p, count(*) FILTER (WHERE pnl_usdt > 0) AS wins, avg(pnl_pct) AS mr, stddev_samp(pnl_pct) AS sd, stddev_samp(pnl_pct) FILTER (WHERE pnl_pct < 0) AS dsd,
        sum(pnl_usdt) FILTER (WHERE pnl_usdt > 0) AS gp, abs(sum(pnl_usdt) FILTER (WHERE pnl_usdt < 0)) AS gl, avg(pnl_usdt) FILTER (WHERE pnl_usdt > 0) AS aw, avg(pnl_usdt) FILTER (WHERE pnl_usdt < 0) AS al,
        max((peak - equity) / peak) AS dd, date_diff('day', DATE '{START}', DATE '{END}') AS days, {SIDES} FROM pk)
    SELECT round(p, 2) AS pnl_usd, round(p / {CAPITAL} * 100, 2) AS return_pct, n AS trades, u AS unique_entities, round(100.0 * wins / n, 1) AS win_rate, long_trades, short_trades, long_pnl, short_pnl, long_wr, short_wr,
        round(least(gp / gl, 99.99), 2) AS profit_factor, round(least(abs(aw / al), 99.99), 2) AS payoff_ratio, round(mr / sd * sqrt(n / (days / 252.0)), 2) AS sharpe, round(mr / dsd * sqrt(n / (days / 252.0)), 2) AS sortino,
        round(dd * 100, 2) AS max_drawdown_pct, round(least((p / {CAPITAL} * 100 * 252 / days) / (dd * 100), 99.99), 2) AS calmar, round(aw, 2) AS avg_win_usd, round(al, 2) AS avg_loss_usd FROM m""")
def _(v):
    return L.ledger_metrics(v.closed_trades, CAPITAL, START, END)


@query("ledger_breakdown", f"""
    SELECT category, entity, CASE WHEN grouping(entity) = 0 THEN 'entity' WHEN grouping(category) = 0 THEN 'category' ELSE 'all' END AS level, count(*) AS total_trades, count(DISTINCT entity) AS entities, {SIDES},
        round(sum(pnl_usdt), 2) + 0.0 AS net_pnl, round(avg(pnl_usdt), 4) + 0.0 AS pnl_per_trade FROM v_closed GROUP BY ROLLUP (category, entity)""")
def _(v):
    return L.ledger_breakdown(v.closed_trades)


@query("monthly_breakdown", f"""
    SELECT strftime(entry_time, '%Y-%m') AS month, count(*) AS trades, round(sum(pnl_usdt), 2) + 0.0 AS pnl_usd, round(100.0 * count(*) FILTER (WHERE pnl_usdt > 0) / count(*), 1) AS win_rate, {SIDES} FROM v_closed GROUP BY 1""")
def _(v):
    return L.monthly_breakdown(v.closed_trades)


def _weeks(v):
    span = v.trades.agg(F.to_date(F.min("entry_time")).alias("lo"), F.to_date(F.max("entry_time")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))).alias("date_from"))
    return days.select(F.datediff("date_from", F.lit("1970-01-01").cast("date")).alias("week"), "date_from", F.date_add("date_from", 6).alias("date_to"))


@query("weekly_breakdown", """
    WITH s AS (SELECT min(entry_time) AS lo, max(entry_time) AS hi FROM v_trades), wk AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS f FROM s)
    SELECT date_diff('day', DATE '1970-01-01', f) AS week, CAST(f AS VARCHAR) AS date_from, CAST(f + 6 AS VARCHAR) AS date_to, count(id) AS trades, round(coalesce(sum(pnl_usdt), 0), 2) + 0.0 AS pnl_usd,
        coalesce(round(100.0 * count(*) FILTER (WHERE pnl_usdt > 0) / nullif(count(id), 0), 1), 0) AS win_rate FROM wk LEFT JOIN v_closed ON CAST(entry_time AS DATE) BETWEEN f AND f + 6 GROUP BY f""")
def _(v):
    return L.weekly_breakdown(v.closed_trades, _weeks(v))


@query("exit_breakdown", "SELECT notes, count(*) AS trades, round(sum(pnl_usdt), 2) + 0.0 AS pnl_usd FROM v_closed GROUP BY notes")
def _(v):
    return L.exit_breakdown(v.closed_trades, "notes")


@query("contributors", """
    WITH c AS (SELECT 'c' || (o_custkey) AS entity, round(sum(round(o_totalprice % 200 - 100, 2)), 2) AS pnl_usd, count(*) AS trades FROM orders GROUP BY 1)
    SELECT *, 'top' AS side FROM (SELECT * FROM c ORDER BY pnl_usd DESC, entity LIMIT 5) UNION ALL SELECT *, 'bottom' FROM (SELECT * FROM c ORDER BY pnl_usd, entity LIMIT 5)""")
def _(v):
    rows = v.table("orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("entity"), F.round(F.col("o_totalprice") % 200 - 100, 2).alias("pnl_usdt"))
    return L.contributors(rows)


def _context(v):
    bench = market.benchmark_frame(v.bars, BENCH_D).select("date", "mom_1d", "mom_3d", "mom_7d", "vol_7d", "vol_30d", "sma_7", "sma_20")
    days = bench.join(v.market_index, "date", "full_outer").join(market.market_breadth(v.bars, 12), "date", "left")
    return days


@query("filter_comparison", f"""WITH {BENCH_SQL}, {BREADTH_SQL},
    ctx AS (SELECT i.date AS market_day, b.mom_1d AS m1, b.mom_3d AS m3, b.mom_7d AS m7, b.vol_7d / b.vol_30d AS vr, b.sma_7 AS s7, b.sma_20 AS s20, i.market_index AS ix, br.breadth AS bd FROM v_market_index i LEFT JOIN bench b USING (date) LEFT JOIN breadth br USING (date)),
    t AS (SELECT direction = 'BUY' AS buy, pnl_usdt, signal_score AS sc, ctx.*, coalesce(nullif(vr, 0), 1) AS r1, coalesce(m3, 0) AS m3z, coalesce(m7, 0) AS m7z, coalesce(ix, 50) AS f, coalesce(bd, 0.5) AS b FROM v_closed LEFT JOIN ctx ON market_day = CAST(entry_time AS DATE)),
    q AS (SELECT *, 0.35 * greatest(-1, least(1, m3z * 20)) + 0.2 * greatest(-1, least(1, 1.5 - r1)) + 0.2 * greatest(-1, least(1, (50 - f) / 50.0)) + 0.25 * greatest(-1, least(1, (b - 0.5) * 4)) AS comp, market_day IS NOT NULL AND (m3 IS NULL OR vr IS NULL) AS und FROM t),
    k AS (SELECT buy, pnl_usdt, unnest(['0_no_filter', '1_rules', '2_trend', '3_momentum', '4_vol_scaling', '5_index', '6_composite', '7_long_only', '8_asymmetric', '9_trend_vol', '10_score']) AS method, unnest([
        1.0,
        CASE WHEN r1 > 2 AND abs(coalesce(m1, 0)) > 0.03 THEN 1 WHEN coalesce(nullif(bd, 0), 0.5) < 0.35 THEN 0 WHEN m3z < -0.05 AND coalesce(nullif(ix, 0), 50) < 30 THEN 0 ELSE 1 END,
        CASE WHEN s7 IS NULL OR s20 IS NULL THEN 1 WHEN buy = (s7 > s20) THEN 1 ELSE 0 END,
        CASE WHEN m3 IS NULL THEN 1 WHEN buy AND m3 > 0 THEN 1 WHEN NOT buy AND m3 < 0 THEN 1 ELSE 0 END,
        CASE WHEN vr > 2 THEN 0.3 WHEN vr > 1.5 THEN 0.6 WHEN vr > 1.2 THEN 0.8 ELSE 1 END,
        CASE WHEN buy THEN CASE WHEN f < 25 THEN 1.3 WHEN f < 40 THEN 1.1 WHEN f > 75 THEN 0.5 WHEN f > 60 THEN 0.8 ELSE 1 END ELSE CASE WHEN f > 75 THEN 1.3 WHEN f > 60 THEN 1.1 WHEN f < 25 THEN 0.5 WHEN f < 40 THEN 0.8 ELSE 1 END END,
        CASE WHEN und THEN 0 WHEN buy THEN CASE WHEN comp > 0.2 THEN least(1 + comp, 1.5) WHEN comp > -0.1 THEN 0.7 ELSE 0 END ELSE CASE WHEN comp < -0.2 THEN least(1 + abs(comp), 1.5) WHEN comp < 0.1 THEN 0.7 ELSE 0 END END,
        CASE WHEN buy THEN 1 ELSE 0 END,
        CASE WHEN buy OR (m3z < -0.01 AND m7z < 0) THEN 1 ELSE 0 END,
        CASE WHEN s7 IS NULL OR s20 IS NULL THEN 1 WHEN buy AND s7 > s20 THEN CASE WHEN r1 > 2 THEN 0.3 WHEN r1 > 1.5 THEN 0.6 ELSE 1 END WHEN buy THEN 0.5 * CASE WHEN r1 > 2 THEN 0.3 WHEN r1 > 1.5 THEN 0.6 ELSE 1 END WHEN s7 > s20 THEN 0 ELSE CASE WHEN r1 > 2 THEN 0.3 WHEN r1 > 1.5 THEN 0.6 ELSE 1 END END,
        CASE WHEN buy THEN CASE WHEN sc > 0.03 THEN 1.3 WHEN sc > 0 THEN 1 WHEN sc > -0.02 THEN 0.7 ELSE 0 END ELSE CASE WHEN sc < -0.05 THEN 1 WHEN sc < -0.03 THEN 0.7 ELSE 0 END END]::DOUBLE[]) AS mult FROM q),
    a AS (SELECT s.trade_set, method, mult, buy, pnl_usdt * mult AS adj FROM k JOIN (VALUES ('all', 0.0), ('meaningful', 0.01)) s(trade_set, lim) ON s.trade_set = 'all' OR abs(pnl_usdt) > lim),
    z AS (SELECT trade_set, method, coalesce(sum(adj) FILTER (WHERE mult > 0), 0) AS pnl, count(*) FILTER (WHERE mult > 0) AS taken, count(*) FILTER (WHERE mult = 0) AS skipped,
        round(coalesce(100.0 * count(*) FILTER (WHERE adj > 0) / nullif(count(*) FILTER (WHERE adj <> 0), 0), 0), 2) AS win_rate, count(*) FILTER (WHERE mult > 0 AND buy) AS longs, count(*) FILTER (WHERE mult > 0 AND NOT buy) AS shorts,
        round(coalesce(sum(adj) FILTER (WHERE mult > 0 AND buy), 0), 2) + 0.0 AS pnl_long, round(coalesce(sum(adj) FILTER (WHERE mult > 0 AND NOT buy), 0), 2) + 0.0 AS pnl_short,
        round(coalesce(100.0 * count(*) FILTER (WHERE adj > 0 AND buy) / nullif(count(*) FILTER (WHERE adj <> 0 AND buy), 0), 0), 2) AS win_rate_long, round(coalesce(100.0 * count(*) FILTER (WHERE adj > 0 AND NOT buy) / nullif(count(*) FILTER (WHERE adj <> 0 AND NOT buy), 0), 0), 2) AS win_rate_short FROM a GROUP BY ALL)
    SELECT trade_set, method, round(pnl, 2) + 0.0 AS pnl, taken, skipped, win_rate, longs, shorts, pnl_long, pnl_short, win_rate_long, win_rate_short, round(pnl - max(pnl) FILTER (WHERE method = '0_no_filter') OVER (PARTITION BY trade_set), 2) + 0.0 AS delta FROM z""")
def _(v):
    return L.filter_comparison(v.closed_trades, _context(v))


NOW = "1998-06-15 12:00:00"


@query("ledger_monitors", f"""
    WITH c AS (SELECT *, TIMESTAMP '{NOW}' AS now, notes NOT IN ('account_reset', 'force_closed_migration_to_usdc_futures') AS kept FROM v_closed),
    m AS (SELECT count(*) FILTER (WHERE notes = 'take_profit' AND exit_time >= now - INTERVAL 48 HOUR) AS tp, coalesce(sum(pnl_usdt) FILTER (WHERE direction = 'SHORT' AND exit_time >= now - INTERVAL 7 DAY AND kept), 0) AS sp,
        count(*) FILTER (WHERE CAST(exit_time AS DATE) = CAST(now AS DATE) AND kept AND notes = 'take_profit') AS today_tp, count(*) FILTER (WHERE CAST(exit_time AS DATE) = CAST(now AS DATE) AND kept AND notes = 'stop_loss') AS today_sl,
        count(*) FILTER (WHERE CAST(exit_time AS DATE) = CAST(now AS DATE) AND kept AND notes LIKE 'expiry%') AS today_exp, coalesce(sum(pnl_usdt) FILTER (WHERE CAST(exit_time AS DATE) = CAST(now AS DATE) AND kept AND direction = 'BUY'), 0) AS lp,
        coalesce(sum(pnl_usdt) FILTER (WHERE CAST(exit_time AS DATE) = CAST(now AS DATE) AND kept AND direction = 'SHORT'), 0) AS shp FROM c)
    SELECT tp AS take_profits_48h, CAST(tp = 0 AS BIGINT) AS alert_no_take_profit, round(sp, 2) + 0.0 AS short_pnl_7d, CAST(round(sp, 2) < -50 AS BIGINT) AS alert_short_pnl, today_tp, today_sl, today_exp, round(lp, 2) + 0.0 AS today_long_pnl, round(shp, 2) + 0.0 AS today_short_pnl FROM m""")
def _(v):
    return L.ledger_monitors(v.trades, NOW)


@query("opened_since", f"SELECT id, entity, direction FROM v_trades WHERE status = 'OPEN' AND entry_time >= TIMESTAMP '{NOW}' - INTERVAL 4 HOUR")
def _(v):
    return L.opened_since(v.trades, NOW).select("id", "entity", "direction")


@query("closed_since", f"SELECT id, entity, direction, pnl_usdt, notes FROM v_closed WHERE exit_time >= TIMESTAMP '{NOW}' - INTERVAL 4 HOUR")
def _(v):
    return L.closed_since(v.trades, NOW).select("id", "entity", "direction", "pnl_usdt", "notes")


@query("ledger_totals", """
    SELECT count(*) AS trades, count(*) FILTER (WHERE pnl_usdt > 0) AS wins, round(sum(pnl_usdt), 2) AS pnl, round(avg(pnl_pct), 6) + 0.0 AS avg_pnl_pct,
        (SELECT id FROM v_closed ORDER BY pnl_pct DESC, id LIMIT 1) AS best_id, (SELECT id FROM v_closed ORDER BY pnl_pct, id LIMIT 1) AS worst_id FROM v_closed""")
def _(v):
    return L.ledger_totals(v.trades)


SIZES = "count(*) AS n, round(avg(pnl_pct), 4) + 0.0 AS avg_pnl_pct, round(sum(pnl_usdt), 2) + 0.0 AS total_pnl, round(avg(usdt_size), 2) AS avg_size, round(min(usdt_size), 2) AS min_size, round(max(usdt_size), 2) AS max_size"


@query("consistency_by_side", f"SELECT regime_state, direction, {SIZES} FROM v_trades GROUP BY regime_state, direction")
def _(v):
    return L.consistency_by(v.trades, ["regime_state", "direction"])


@query("consistency_by_day", f"SELECT CAST(CAST(entry_time AS DATE) AS VARCHAR) AS date, regime_state, {SIZES} FROM v_trades GROUP BY ALL")
def _(v):
    return L.consistency_by(v.trades.withColumn("date", F.to_date("entry_time")), ["date", "regime_state"])


@query("orphan_positions", """
    SELECT symbol, side, count(*) AS n FROM (SELECT *, CASE direction WHEN 'SHORT' THEN 'SHORT' ELSE 'LONG' END AS side FROM v_trades WHERE status = 'OPEN')
    WHERE NOT (symbol IN ('BUIL', 'MACH') AND side = 'LONG') GROUP BY ALL""")
def _(v):
    live = v.trades.filter("symbol in ('BUIL', 'MACH')").select("symbol", F.lit("LONG").alias("side")).distinct()
    return L.orphan_positions(v.trades, live).groupBy("symbol", "side").agg(F.count(F.lit(1)).alias("n"))

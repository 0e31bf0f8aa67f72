import datetime as dt
import random

import pytest

from newsmill.plans import ledger as L

T0 = dt.datetime(2024, 1, 1)


def exit_of(direction, bars):
    """Checkpointed exit, written as the loop a trader would describe."""
    entry = bars[0][1]
    arm, floor = (0.02, -0.015) if direction == "BUY" else (0.015, -0.003)
    armed, peak, cp = False, 0.0, 0.0
    for i, (_, o, h, lo, c) in enumerate(bars, 1):
        best, worst = (h, lo) if direction == "BUY" else (lo, h)
        sign = 1 if direction == "BUY" else -1
        hp, lp, cp = (sign * (x - entry) / entry for x in (best, worst, c))
        peak = max(peak, hp)
        if i % 4 and i != len(bars):
            continue
        armed = armed or peak >= arm
        if armed and cp <= floor:
            return cp, "trailing_stop"
        if hp >= 0.045:
            return 0.045, "take_profit"
        if lp <= -0.08:
            return -0.08, "stop_loss"
    return cp, "expiry"


def test_trade_outcomes(spark):
    rng = random.Random(1)
    bars, cands, k = [], [], 0
    for e in range(40):
        price, rows = 100.0, []
        for h in range(24 * 6):
            o = price
            price *= 1 + rng.gauss(0, 0.004 + 0.0004 * e)
            rows.append((T0 + dt.timedelta(hours=h), o, max(o, price) * 1.001, min(o, price) * 0.999, price))
        bars += [(f"e{e}", *r) for r in rows]
        for d in range(4):
            for side in ("BUY", "SHORT"):
                cands.append((k, f"e{e}", (T0 + dt.timedelta(days=d)).date(), side))
                k += 1
    cands.append((k, "none", T0.date(), "BUY"))
    out = L.trade_outcomes(
        spark.createDataFrame(cands, "cand_id int, entity string, entry_date date, direction string"),
        spark.createDataFrame(bars, "entity string, ts timestamp, open double, high double, low double, close double")).collect()
    seen = set()
    for r in out:
        if r["entity"] == "none":
            assert (r["pnl_pct"], r["exit_reason"]) == (0.0, "no_data")
            continue
        lo = dt.datetime.combine(r["entry_date"], dt.time())
        mine = [b[1:] for b in bars if b[0] == r["entity"] and lo <= b[1] < lo + dt.timedelta(days=4)]
        ret, why = exit_of(r["direction"], mine)
        seen.add(why)
        assert r["exit_reason"] == why and r["pnl_pct"] == pytest.approx(ret, abs=1e-6)
    assert len(out) == len(cands) and seen == {"trailing_stop", "take_profit", "stop_loss", "expiry"}


def ledger(n=900, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = T0 + dt.timedelta(days=30 if rng.random() < 0.35 else rng.randrange(60))  # a third exits at one moment
        pnl = round(rng.gauss(0.5, 20), 2)
        rows.append((i, rng.choice("abc"), rng.choice(["BUY", "SHORT"]), t - dt.timedelta(days=2), t, pnl, pnl / 1000))
    return rows


SCHEMA = "id int, entity string, direction string, entry_time timestamp, exit_time timestamp, pnl_usdt double, pnl_pct double"


def test_equity_and_metrics(spark):
    rows = ledger()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["id"]: r for r in L.ledger_equity(df, 1000.0).collect()}
    run, peak, worst = 1000.0, 1000.0, 0.0
    for r in sorted(rows, key=lambda r: (r[4], r[0])):
        run += r[5]
        peak = max(peak, run)
        worst = max(worst, (peak - run) / peak)
        assert got[r[0]]["equity"] == pytest.approx(run, abs=1e-6) and got[r[0]]["drawdown"] == pytest.approx((peak - run) / peak, abs=1e-9)
    m = L.ledger_metrics(df, 1000.0, "2024-01-01", "2024-03-01").first()
    assert m["max_drawdown_pct"] == pytest.approx(worst * 100, abs=0.01)
    gain, loss = sum(r[5] for r in rows if r[5] > 0), -sum(r[5] for r in rows if r[5] < 0)
    assert m["profit_factor"] == pytest.approx(gain / loss, abs=0.006) and m["trades"] == 900 and m["unique_entities"] == 3


def test_metrics_without_losses(spark):
    m = L.ledger_metrics(spark.createDataFrame([(1, "a", "BUY", T0, T0, 5.0, 0.1)], SCHEMA), 100.0, "2024-01-01", "2024-01-02").first()
    assert (m["profit_factor"], m["payoff_ratio"], m["calmar"], m["max_drawdown_pct"], m["win_rate"]) == (99.99, 99.99, 99.99, 0.0, 100.0)


def test_monitors_and_shifts(spark):
    now = dt.datetime(2024, 2, 1, 12)
    h = lambda n: now - dt.timedelta(hours=n)
    rows = [(1, "BUY", "CLOSED", h(1), 5.0, "take_profit"), (2, "SHORT", "CLOSED", h(30), -60.0, "stop_loss"), (3, "SHORT", "CLOSED", h(2), -9.0, "account_reset"),
            (4, "SHORT", "OPEN", None, None, None), (5, "BUY", "CLOSED", h(3), -1.0, "expiry_3d")]
    df = spark.createDataFrame(rows, "id int, direction string, status string, exit_time timestamp, pnl_usdt double, notes string")
    r = L.ledger_monitors(df, now.isoformat(sep=" ")).first()
    assert (r["take_profits_48h"], r["alert_no_take_profit"], r["short_pnl_7d"], r["alert_short_pnl"]) == (1, False, -60.0, True)
    assert (r["today_tp"], r["today_sl"], r["today_exp"], r["today_long_pnl"], r["today_short_pnl"]) == (1, 0, 1, 4.0, 0.0)
    reg = spark.createDataFrame([(dt.date(2024, 1, i), s) for i, s in ((1, "a"), (2, "a"), (3, "b"))], "date date, regime_state string")
    assert [tuple(x) for x in L.state_shifts(reg).collect()] == [(dt.date(2024, 1, 3), "a", "b")]


def test_direction_filters(spark):
    """Spot checks of the filters' edges."""
    base = dict(direction="SHORT", mom_1d=0.0, mom_3d=0.02, mom_7d=0.0, vol_7d=1.0, vol_30d=1.0, sma_7=2.0, sma_20=1.0, market_index=80.0, breadth=0.2, signal_score=-0.04, market_day="x")
    cases = [{}, {"direction": "BUY"}, {"mom_1d": 0.05, "vol_7d": 2.5}, {"mom_3d": None}, {"sma_7": None}, {"market_day": None, "mom_3d": None, "vol_7d": None}, {"signal_score": None}, {"breadth": 0.0}]
    names = list(base)
    types = ", ".join(f"{n} {'string' if n in ('direction', 'market_day') else 'double'}" for n in names)
    from newsmill.functions.market import direction_filters
    df = spark.createDataFrame([tuple({**base, **c}[n] for n in names) for c in cases], types)
    got = [{f["method"]: (f["allow"], round(f["mult"], 4)) for f in r[0]} for r in df.select(direction_filters()).collect()]
    assert got[0]["1_rules"] == (False, 0.0) and got[0]["2_trend"] == (False, 0.0) and got[0]["5_index"] == (True, 1.3)
    assert got[0]["7_long_only"] == (False, 0.0) and got[0]["10_score"] == (True, 0.7) and got[0]["9_trend_vol"] == (False, 0.0)
    assert got[1]["2_trend"] == (True, 1.0) and got[1]["5_index"] == (True, 0.5) and got[1]["10_score"] == (False, 0.0)
    assert got[2]["1_rules"] == (True, 1.0) and got[2]["4_vol_scaling"] == (True, 0.3)
    assert got[3]["3_momentum"] == (True, 1.0) and got[3]["6_composite"] == (False, 0.0)
    assert got[4]["2_trend"] == (True, 1.0)
    assert got[5]["6_composite"][0] is True  # no market row at all: neutral defaults
    assert got[6]["10_score"] == (True, 1.0)
    assert got[7]["1_rules"] == (True, 1.0)  # a breadth of exactly 0 counts as missing


def test_breakdowns(spark):
    rows = [(1, "a", "x", "BUY", 5.0), (2, "a", "x", "SHORT", -1.0), (3, "b", "y", "BUY", 2.0)]
    df = spark.createDataFrame(rows, "id int, entity string, category string, direction string, pnl_usdt double")
    got = {(r["level"], r["category"], r["entity"]): (r["total_trades"], r["net_pnl"], r["long_wr"]) for r in L.ledger_breakdown(df).collect()}
    assert got == {("entity", "x", "a"): (2, 4.0, 100.0), ("entity", "y", "b"): (1, 2.0, 100.0), ("category", "x", None): (2, 4.0, 100.0), ("category", "y", None): (1, 2.0, 100.0), ("all", None, None): (3, 6.0, 100.0)}
    live = spark.createDataFrame([("S", "LONG")], "symbol string, side string")
    open_ = spark.createDataFrame([(1, "S", "BUY", "OPEN"), (2, "S", "SHORT", "OPEN"), (3, "S", "SHORT", "CLOSED")], "id int, symbol string, direction string, status string")
    assert [r["id"] for r in L.orphan_positions(open_, live).collect()] == [2]

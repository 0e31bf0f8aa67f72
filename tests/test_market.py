"""Market operators against plain pandas/numpy statements of the same definitions."""

import datetime as dt
import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsmill.functions import market as M
from newsmill.operators.ordering import pct_rank
from newsmill.operators.rolling import Rolling, channel_normalise, sequence_window
from newsmill.plans import market

BASE = dt.datetime(2024, 1, 1)


def daily(n_entities=14, n_days=45, seed=0, gaps=0.1):
    rng = np.random.default_rng(seed)
    out = []
    for e in range(n_entities):
        price = 100.0
        for d in range(n_days):
            price = round(price * (1 + rng.normal(0, 0.05)), 2)
            if rng.random() < gaps:
                continue
            close = None if rng.random() < 0.02 else (0.0 if rng.random() < 0.02 else price)
            cap = None if rng.random() < 0.05 else float(rng.integers(1, 8)) * 1000
            out.append((f"e{e:02d}", BASE + dt.timedelta(days=d, hours=23), price, price, price, close, float(rng.integers(0, 6)), cap))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "entity string, ts timestamp, open double, high double, low double, close double, volume double, market_cap double")


def close_to(a, b, tol=1e-6):
    if a is None or b is None or (isinstance(b, float) and math.isnan(b)):
        return a is None and (b is None or math.isnan(b))
    return abs(a - b) <= tol


def test_forward_labels(spark):
    rows = daily(4, 60, 1, 0.3)
    rows += [(rows[0][0], rows[0][1] - dt.timedelta(hours=5), 1.0, 1.0, 1.0, 55.0, 1.0, 1.0)]  # earlier bar of a day loses
    got = {(r["entity"], r["date"]): r for r in market.forward_labels(frame(spark, rows)).collect()}
    for entity in {r[0] for r in rows}:
        series = {}
        for r in sorted((r for r in rows if r[0] == entity), key=lambda r: r[1]):
            series[r[1].date()] = r[5]
        dates = sorted(series)
        rets = {}
        for p, c in zip(dates, dates[1:]):
            if series[p] and series[c] is not None:
                rets[c] = (series[c] - series[p]) / series[p]
        for i, d in enumerate(dates):
            if not series[d]:
                assert (entity, d) not in got
                continue
            r = got[(entity, d)]
            for h, limit in ((1, .03), (3, .05), (7, .07), (14, .10)):
                nxt = next((series[x] for x in (d + dt.timedelta(days=h + k) for k in range(3)) if series.get(x)), None)
                ret = None if nxt is None else (nxt - series[d]) / series[d]
                assert close_to(r[f"forward_ret_{h}d"], ret, 1e-8)
                assert r[f"label_{h}d"] == (None if ret is None else 1 if ret > limit else -1 if ret < -limit else 0)
            for w in (7, 30):
                past = [rets[x] for x in dates[max(0, i - w):i] if x in rets]
                assert close_to(r[f"volatility_{w}d"], float(np.std(past, ddof=1)) if len(past) >= 3 else None)


def hourly(n=160, seed=3, beta=1.7):
    rng = np.random.default_rng(seed)
    b = rng.normal(0, 0.01, n)
    y = beta * b + rng.normal(0, 0.002, n)
    ts = [BASE + dt.timedelta(hours=i) for i in range(n)]
    price = lambda r: 100 * np.cumprod(1 + r)
    return ts, price(b), price(y)


def test_beta_residuals(spark):
    w = 40
    ts, bench, ent = hourly()
    rows = [("b", t, p) for t, p in zip(ts, bench)] + [("e", t, p) for t, p in zip(ts, ent)] + [("short", ts[i], 5.0 + i) for i in range(w)]
    flat = [("flatb", t, 7.0) for t in ts]
    bars = spark.createDataFrame([(e, t, float(p)) for e, t, p in rows + flat], "entity string, ts timestamp, close double")
    got = {(r["entity"], r["ts"]): r for r in market.beta_residuals(bars, "b", w).collect()}
    assert not [k for k in got if k[0] in ("short", "b")]
    x = pd.Series(bench).pct_change().fillna(0).values
    y = pd.Series(ent).pct_change().fillna(0).values
    res = []
    for i in range(w, len(ts)):
        px, py = x[i - w:i], y[i - w:i]
        beta = np.cov(px, py, ddof=1)[0, 1] / np.var(px, ddof=1)
        alpha = py.mean() - beta * px.mean()
        res.append(y[i] - (alpha + beta * x[i]))
        r = got[("e", ts[i])]
        assert abs(r["beta"] - beta) < 2e-6 and abs(r["alpha"] - alpha) < 2e-8 and abs(r["residual"] - res[-1]) < 2e-8
        ratio = None if len(res) < 10 else min(np.std(res[-w:], ddof=1) / np.std(y[max(0, i - w + 1):i + 1], ddof=1), 1.0)
        assert close_to(r["residual_vol_ratio"], ratio, 2e-6)
    assert abs(np.mean([got[("e", t)]["beta"] for t in ts[w:]]) - 1.7) < 0.3
    # a benchmark that never moves has no regression
    assert market.beta_residuals(bars, "flatb", w).count() == 0


def test_residual_features(spark):
    f = market.ResidualFrames(6, 12, 24, 48, 72, {"day": 3, "short": 4, "week": 8, "fortnight": 12, "month": 20, "volume": 11})
    rng = np.random.default_rng(5)
    ts = [BASE + dt.timedelta(hours=i) for i in range(200)]
    r = rng.normal(0, 0.01, 200)
    vol = [None if rng.random() < 0.1 else float(rng.integers(1, 50)) for _ in ts]
    res = spark.createDataFrame([("e", t, float(v)) for t, v in zip(ts, r)] + [("e", ts[-1] + dt.timedelta(hours=9), None)], "entity string, ts timestamp, residual double")
    volume = spark.createDataFrame([("e", t, v) for t, v in zip(ts, vol)], "entity string, ts timestamp, volume double")
    got = {x["ts"]: x for x in market.residual_features(res, volume, f).collect()}
    v = np.array([np.nan if x is None else x for x in vol])
    vz = np.full(200, np.nan)
    for i in range(72, 200):
        past = v[i - 72:i][~np.isnan(v[i - 72:i])]
        if len(past) > 10 and not np.isnan(v[i]) and past.std(ddof=1) > 0:
            vz[i] = (v[i] - past.mean()) / past.std(ddof=1)
    anchors = [i for i in range(200) if i == 199 or ts[i].date() != ts[i + 1].date()]
    assert set(got) == {ts[i] for i in anchors if i >= 24}
    auto = lambda a: np.corrcoef(a[:-1], a[1:])[0, 1]
    for i in (a for a in anchors if a >= 24):
        tail = lambda n: r[i - n + 1:i + 1]
        g = got[ts[i]]
        assert close_to(g["res_momentum_3d"], tail(12).mean(), 2e-8) and close_to(g["res_momentum_7d"], tail(24).mean(), 2e-8)
        assert close_to(g["res_momentum_14d"], tail(48).mean() if i >= 48 else None, 2e-8)
        assert close_to(g["res_zscore_30d"], (tail(6).mean() - tail(72).mean()) / tail(72).std(ddof=1) if i >= 72 else None, 2e-6)
        assert close_to(g["res_vol_regime"], tail(24).std(ddof=1) / tail(72).std(ddof=1) if i >= 72 else None, 2e-6)
        assert close_to(g["res_autocorr_7d"], auto(tail(24)), 2e-6)
        assert close_to(g["res_autocorr_14d"], auto(tail(48)) if i >= 48 else None, 2e-6)
        pairs = [a * b for a, b in zip(tail(6), vz[i - 5:i + 1]) if not np.isnan(b)]
        assert close_to(g["res_volume_interaction"], np.mean(pairs) if len(pairs) >= 3 else None, 2e-8)


def test_cross_section(spark):
    rows = daily(14, 40, 7)
    got = {(r["entity"], r["date"]): r for r in market.cross_section(frame(spark, rows)).collect()}
    df = pd.DataFrame(rows, columns=["entity", "ts", "o", "h", "l", "close", "volume", "cap"])
    df["date"] = df.ts.dt.date
    wide = lambda c: df.pivot_table(index="date", columns="entity", values=c, aggfunc="last")
    close, volume, cap = wide("close"), wide("volume"), wide("cap")
    dates, seen = sorted(set(df.date)), set()
    for i, d in enumerate(dates):
        today = close.loc[d].dropna()
        if i < 20 or len(today) < 10:
            continue
        div = lambda a, b: (a / b.replace(0, np.nan))
        r1 = (div(close.loc[d], close.loc[dates[i - 1]]) - 1).dropna()
        r7 = (div(close.loc[d], close.loc[dates[i - 7]]) - 1).dropna()
        vr = div(volume.loc[d], volume.loc[dates[i - 20:i]].mean()).dropna()
        cm = (cap.loc[d].dropna().rank(pct=True) - cap.loc[dates[i - 7]].dropna().rank(pct=True)).dropna()
        sma = close.loc[dates[i - 19:i + 1]].mean()
        adv, dec = (r1 > 0).sum(), (r1 < 0).sum()
        ad = max(-3, min(3, math.log(adv / dec))) if dec and adv else (-3.0 if dec else (3.0 if adv else 0.0))
        vv = volume.loc[d].dropna()
        vv = vv[vv > 0]
        for e in today.index:
            seen.add((e, d))
            g = got[(e, d)]
            pick = lambda s: float(s.rank(pct=True)[e]) if len(s) >= 10 and e in s.index else None
            assert close_to(g["ret_rank_1d"], pick(r1)) and close_to(g["ret_rank_7d"], pick(r7)) and close_to(g["vol_rank_1d"], pick(vr))
            assert close_to(g["cap_momentum"], float(cm[e]) if e in cm.index else None)
            assert close_to(g["breadth_20d"], (close.loc[d] > sma).sum() / len(today)) and close_to(g["advance_decline"], ad)
            assert close_to(g["dispersion"], r1.std(ddof=1) if len(r1) >= 10 else None)
            assert close_to(g["hhi_volume"], ((vv / vv.sum()) ** 2).sum() if len(vv) >= 10 else None)
    assert seen == set(got)


def test_pct_rank_matches_average_ties(spark):
    values = [3.0, 1.0, 3.0, None, 2.0, 3.0, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.select(pct_rank("v").alias("p"), "i").orderBy("i").collect()]
    want = pd.Series(values, dtype=float).rank(pct=True)
    assert all(close_to(g, w, 1e-12) for g, w in zip(got, want))


@pytest.mark.parametrize("lo,hi", [(-4, 0), (-5, -1), (-1, 0), (-30, -1)])
def test_rolling_totals(spark, lo, hi):
    rng = np.random.default_rng(11)
    x = [None if rng.random() < 0.2 else float(rng.integers(0, 3)) + 1e6 for _ in range(60)]
    roll = Rolling(spark.createDataFrame([("a", i, v) for i, v in enumerate(x)], "k string, i int, x double"), "k", "i")
    roll.df = roll.df.withColumns({"n": roll.count("x", lo, hi), "m": roll.mean("x", lo, hi), "s": roll.std("x", lo, hi), "t": roll.sum("x", lo, hi)})
    for r in roll.df.collect():
        part = [v for v in x[max(0, r["i"] + lo):max(0, r["i"] + hi + 1)] if v is not None]
        assert r["n"] == len(part)
        assert close_to(r["m"], np.mean(part) if part else None) and close_to(r["s"], np.std(part, ddof=1) if len(part) > 1 else None)
        if len(part) > 1 and len(set(part)) == 1:
            assert r["s"] == 0.0


def test_sequences_and_normalisation(spark):
    df = spark.createDataFrame([("a", i, float(i), None if i == 3 else 1.0) for i in range(6)] + [("b", 0, 1.0, 1.0)], "k string, i int, x double, y double")
    out = {r["i"]: r["sequence"] for r in sequence_window(df, ["x", "y"], 3, "k", "i").collect()}
    assert sorted(out) == [2, 3, 4, 5] and out[3] == [[1.0, 1.0], [2.0, 1.0], [3.0, 0.0]]
    prev = {r["i"]: r["sequence"] for r in sequence_window(df, ["x"], 3, "k", "i", exclude_current=True).collect()}
    assert prev[3] == [[0.0], [1.0], [2.0]]
    norm = [r["y"] for r in channel_normalise(df.filter("k = 'b'"), ["y"], "k").collect()]
    assert norm == [0.0]


def test_regime_columns(spark):
    df = spark.createDataFrame([(0.06, 0.01, 0.02, 20.0, 0.9), (-0.06, 0.05, 0.02, 80.0, 0.1), (0.0, 0.02, 0.0, 50.0, 0.5)], "m double, a double, b double, f double, br double")
    rows = df.withColumn("s", M.regime_score("m", "a", "b", "f", "br")).withColumns({"st": M.regime_state("s", M.vol_ratio("a", "b")), "d": M.regime_decision("s")}).collect()
    assert [r["s"] for r in rows] == [0.92, -0.92, 0.1]
    assert [r["st"] for r in rows] == ["bull_trend", "high_vol", "range_bound"]
    assert (rows[0]["d"]["long_mult"], rows[0]["d"]["short_mult"], rows[0]["d"]["confidence"]) == (1.5, 0.0, 1.0)
    assert (rows[2]["d"]["long_mult"], rows[2]["d"]["short_mult"], rows[2]["d"]["allow_short"]) == (0.7, 0.0, False)
    gate = spark.createDataFrame([(0.5, "bull_trend"), (-0.5, "bull_trend"), (0.5, "bear_trend"), (0.5, "range_bound"), (0.5, "high_vol"), (0.5, None)], "s double, st string")
    got = [r[0] for r in gate.select(M.regime_gate("s", "st", F.lit(0.4))).collect()]
    assert got == pytest.approx([0.5, -0.4, 0.4, 0.44, 0.54, 0.5])


def test_regime_daily_defaults(spark):
    """Rows without a full long window keep a volatility ratio of 1; missing index / breadth take defaults."""
    bars = spark.createDataFrame([("b", BASE + dt.timedelta(days=i), float(100 + i + (i % 3)), 1.0) for i in range(12)], "entity string, ts timestamp, close double, volume double")
    index = spark.createDataFrame([], "date date, market_index double")
    breadth = spark.createDataFrame([], "date date, breadth double")
    out = market.regime_daily(bars, "b", index, breadth).collect()
    assert len(out) == 5  # first seven rows lack a full week of returns
    closes = [100 + i + (i % 3) for i in range(12)]
    last = max(out, key=lambda r: r["date"])
    want = 0.35 * min(1, max(-1, (closes[11] / closes[8] - 1) * 20)) + 0.2 * 0.5
    assert last["score"] == pytest.approx(round(want, 4))


def test_cycle_phase(spark):
    df = spark.sql("SELECT timestamp'2000-01-06 18:14:00' AS t UNION ALL SELECT timestamp'2000-01-01 00:00:00'")
    a, b = df.select(M.cycle_days("t").alias("d"), M.cycle_phase("t").alias("p")).collect()
    assert a["d"] == 0.0 and a["p"]["cos"] == 1.0
    assert 0 <= b["d"] < 29.54 and b["d"] == pytest.approx(29.53058770576 - (5 + (18 * 60 + 14) / 1440))


def test_ranges_equal_full_runs(spark):
    """A day range computed from its own slice of the history gives the rows of a full run."""
    bars = frame(spark, [r[:5] + (r[2],) + r[6:] for r in daily(12, 90, 21, gaps=0.0)])
    inside = "date between '2024-02-20' and '2024-03-01'"
    for fn in (market.forward_labels, market.cross_section):
        full = {(r["entity"], r["date"]): r for r in fn(bars).filter(inside).collect()}
        part = {(r["entity"], r["date"]): r for r in fn(bars, "2024-02-20", "2024-03-01").collect()}
        assert full and set(full) == set(part)
        for k, r in full.items():
            for a, b in zip(r, part[k]):
                assert a == b or a == pytest.approx(b, abs=1e-9)


@pytest.mark.parametrize("values", [[1.0, 2.0, float("nan")] + [float(i % 5) for i in range(30)], [1e10] * 10 + [100.0 + i % 4 for i in range(40)]])
def test_rolling_forgets_what_left_the_frame(spark, values):
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "k string, i int, x double")
    roll = Rolling(rows, "k", "i")
    got = {r["i"]: r for r in roll.df.withColumns({"m": roll.mean("x", -4), "s": roll.std("x", -4)}).collect()}
    for i in range(len(values)):
        part = values[max(0, i - 4):i + 1]
        if not any(np.isnan(part)) and len(part) > 1:
            assert close_to(got[i]["m"], np.mean(part)) and close_to(got[i]["s"], np.std(part, ddof=1))


def test_ranged_calls_equal_the_whole_on_gappy_calendars(spark):
    import datetime as dt
    rng = np.random.default_rng(2)
    day0 = dt.datetime(2023, 1, 2)
    rows = [(f"e{e}", day0 + dt.timedelta(days=7 * w + d, hours=23), float(100 + rng.integers(0, 50)), float(rng.integers(1, 90)), 1e6 * (e + 1))
            for w in range(90) for d in (0, 3) for e in range(12) if e or w % 5 == 0]
    bars = spark.createDataFrame(rows, "entity string, ts timestamp, close double, volume double, market_cap double")
    lo, hi = "2024-06-03", "2024-07-15"
    for whole, part in ((market.forward_labels(bars), market.forward_labels(bars, lo, hi)), (market.cross_section(bars), market.cross_section(bars, lo, hi))):
        want = sorted(map(str, whole.where(f"date between '{lo}' and '{hi}'").collect()))
        assert want and sorted(map(str, part.collect())) == want


def plain(f, part, least=1):
    part = part[~pd.isna(part)] if part.dtype == object else part
    return f(np.array(part, float)) if len(part) >= least else None


@pytest.mark.parametrize("n", [33, 40, 64])
def test_long_frames_are_the_plain_ones(spark, monkeypatch, n):
    """Nulls, NaN, level drops, flat stretches, series shorter than the frame and tied times, for trailing and strictly earlier frames."""
    from newsmill.operators import rolling
    monkeypatch.setattr(rolling, "LONG_FRAME", 32)
    rng = np.random.default_rng(n)
    series = {"a": [1e10] * 10 + [100.0 + i % 4 for i in range(120)], "b": [1.0, 2.0, float("nan")] + rng.normal(size=200).tolist(),
              "c": [None if rng.random() < 0.3 else float(v) for v in rng.normal(size=150)], "d": [5.0] * 90 + [6.0] * 90, "e": [1.0, None], "f": [None] * 80}
    rows = [(k, i, v, None if i % 7 == 3 else float((i * i) % 11) + (v or 0.0)) for k, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, i int, x double, y double").repartition(3)
    roll = Rolling(df, "k", "i").prepare(n, ["x"], [("x", "y")], past=n != 40)
    for name, (lo, hi) in {"tail": (-(n - 1), 0), "past": (-n, -1), "older": (-n - 4, -5)}.items():
        roll.df = roll.df.withColumns({f"{name}_n": roll.count("x", lo, hi), f"{name}_m": roll.mean("x", lo, hi), f"{name}_v": roll.variance("x", lo, hi),
                                       f"{name}_flat": roll.flat("x", lo, hi), f"{name}_c": roll.covariance("x", "y", lo, hi), f"{name}_s": roll.sum("x", lo, hi)})
    got = {(r["k"], r["i"]): r for r in roll.drop_prepared().collect()}
    assert len(got) == len(rows) and not any(c.startswith("__") for c in roll.drop_prepared().columns)
    near = lambda a, b: (a is None and b is None) or (a is not None and b is not None and (math.isnan(a) and math.isnan(b) or a == pytest.approx(b, rel=1e-7, abs=1e-9)))
    other = {(k, i): y for k, i, _, y in rows}
    for k, x in series.items():
        for i in range(len(x)):
            for name, (lo, hi) in {"tail": (-(n - 1), 0), "past": (-n, -1), "older": (-n - 4, -5)}.items():
                span = range(max(0, i + lo), max(0, i + hi + 1))
                part = np.array([x[j] for j in span if x[j] is not None], float)
                r = got[k, i]
                assert r[f"{name}_n"] == len(part)
                assert near(r[f"{name}_m"], part.mean() if len(part) else None)
                assert near(r[f"{name}_s"], part.sum() if len(part) else 0.0)
                assert near(r[f"{name}_v"], part.var(ddof=1) if len(part) > 1 else None)
                if not np.isnan(part).any():
                    assert r[f"{name}_flat"] == (len(set(part)) <= 1)
                both = np.array([(x[j], other[k, j]) for j in span if x[j] is not None and other[k, j] is not None], float)
                assert near(r[f"{name}_c"], np.cov(both.T)[0, 1] if len(both) > 1 else None)


def test_cost_of_long_frames_does_not_follow_their_length(spark):
    """No sliding frame is left in the plan: running frames and lags only."""
    df = spark.range(10).selectExpr("id % 3 AS k", "id AS i", "double(id) AS x", "double(id) AS y")
    roll = Rolling(df, "k", "i").prepare(720, ["x"], [("x", "y")], past=True)
    out = roll.df.select(roll.std("x", -719), roll.mean("x", -720, -1), roll.covariance("x", "y", -719), roll.count("x", -719))
    text = out._jdf.queryExecution().executedPlan().toString()
    frames = set(re.findall(r"specifiedwindowframe\(RowFrame, ([^,]+), ([^)]+)\)", text))
    assert frames and all(a == b or a == "unboundedpreceding$()" for a, b in frames)
    assert text.count("Exchange hashpartitioning") == 1

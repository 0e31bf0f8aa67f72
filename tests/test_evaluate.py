import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsmill.operators import ordering as O
from newsmill.plans import evaluate as E, matrix, signals as S, walkforward

D0 = dt.date(2024, 1, 1)


def table(seed=0, n=600, ties=True):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        s = float(rng.integers(-5, 6)) / 10 if ties else float(rng.normal())
        s = 0.0 if rng.random() < 0.35 else s  # one value holds a third of all rows
        r = None if rng.random() < 0.05 else round(float(rng.normal()) + s, 3)
        rows.append((f"e{i % 12:02d}", D0 + dt.timedelta(days=i // 12), s, r))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "entity string, date date, s double, r double")


def spearman(a, b):
    return pd.Series(a).rank().corr(pd.Series(b).rank())


@pytest.mark.parametrize("ties", [True, False])
def test_spearman_over_blocks(spark, ties):
    rows = table(1, ties=ties)
    got = E.spearman_ic(frame(spark, rows), "s", "r").first()["ic"]
    known = [(s, r) for _, _, s, r in rows if r is not None]
    assert got == pytest.approx(spearman(*zip(*known)), abs=1e-6)
    assert E.spearman_ic(frame(spark, rows[:9]), "s", "r").first()["ic"] is None


def test_value_ranks(spark):
    rows = table(2)
    want = pd.Series([s for _, _, s, _ in rows]).rank()
    got = {r["s"]: r["rank"] for r in O.value_ranks(frame(spark, rows), "s").collect()}
    assert all(got[s] == w for (_, _, s, _), w in zip(rows, want))


def test_running_sums_split_a_hot_order_value(spark):
    rng = random.Random(3)
    rows = [(500 if rng.random() < 0.4 else rng.randrange(1000), i, rng.randrange(100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "t bigint, id bigint, x bigint")
    cut = O.order_blocks(df, "t", "id")
    assert cut.filter("t = 500").select("block").distinct().count() > 10
    got = {r["id"]: r["run"] for r in O.running_sums(df, "t", "id", {"x": "run"}).collect()}
    total = 0
    for t, i, x in sorted(rows):
        total += x
        assert got[i] == total


def test_daily_and_rolling_ic(spark):
    rows = table(4)
    df = frame(spark, rows)
    pdf = pd.DataFrame(rows, columns=["e", "d", "s", "r"]).dropna()
    daily = {r["date"]: r["ic"] for r in E.daily_ic(df, "s", "r").collect()}
    for d, g in pdf.groupby("d"):
        if len(g) >= 5:
            assert daily[d] == pytest.approx(spearman(g.s.values, g.r.values), abs=1e-9)
    dates = sorted({d for _, d, _, _ in rows})
    roll = {r["as_of"]: r["ic"] for r in E.rolling_ic(df, "s", "r", 20).collect()}
    assert set(roll) == set(dates[20:])
    for i in range(20, len(dates)):
        g = pdf[pdf.d.isin(dates[i - 20:i])]
        assert roll[dates[i]] == pytest.approx(spearman(g.s.values, g.r.values), abs=1e-6)
    stats = E.rolling_ic_summary(E.rolling_ic(df, "s", "r", 20)).first()
    assert stats["ic_std"] == pytest.approx(np.std(list(roll.values())), abs=1e-6)


def test_portfolio(spark):
    rows = table(5, ties=False)
    pdf = pd.DataFrame(rows, columns=["e", "d", "s", "r"])
    pdf["r"] = pdf.r / 50
    df = spark.createDataFrame([tuple(None if isinstance(x, float) and np.isnan(x) else x for x in t) for t in pdf.itertuples(index=False)], "entity string, date date, s double, r double")
    pnl = np.array([g.dropna().sort_values(["s", "e"], ascending=[False, True]).head(4).r.mean() for _, g in pdf.groupby("d") if len(g.dropna()) >= 4])
    got = E.topn_portfolio(df, "s", "r", 4).first()
    cum = np.cumprod(1 + pnl)
    peak = np.maximum.accumulate(cum)
    assert got["sharpe"] == pytest.approx(pnl.mean() / pnl.std() * np.sqrt(252), abs=1e-3)
    assert got["max_drawdown"] == pytest.approx(((cum - peak) / peak).min(), abs=1e-4)
    assert got["total_return"] == pytest.approx(cum[-1] - 1, abs=1e-4) and got["total_trades"] == 4 * len(pnl)
    few = E.topn_portfolio(df.filter("date < '2024-01-03'"), "s", "r", 4).first()
    assert few["sharpe"] is None and few["total_trades"] == 0


def test_classification_and_roc(spark):
    rng = random.Random(6)
    rows = [(rng.choice([-1, 0, 1, None]), rng.choice([-1, 0, 1]), rng.randrange(8) / 8) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, p int, s double")
    known = [r for r in rows if r[0] is not None]
    tp = sum(y == 1 == p for y, p, _ in known)
    rep = E.classification_report(df, "y", "p").first()
    assert rep["precision_buy"] == pytest.approx(tp / sum(p == 1 for _, p, _ in known), abs=1e-4)
    assert rep["recall_buy"] == pytest.approx(tp / sum(y == 1 for y, _, _ in known), abs=1e-4)
    assert E.classification_report(df.filter("y = 0 and p = 0"), "y", "p").first()["precision_buy"] == 0.0
    pos = [s for y, _, s in known if y == 1]
    neg = [s for y, _, s in known if y != 1]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert E.auc(E.roc_points(df, "y", "s")).first()["auc"] == pytest.approx(want, abs=1e-4)


def test_history_zscore(spark):
    rng = random.Random(7)
    rows = [("a", D0 + dt.timedelta(days=2 * i), 1, rng.random()) for i in range(45)] + [("flat", D0 + dt.timedelta(days=i), 1, 0.5) for i in range(20)]
    got = {(r["entity"], r["date"]): r for r in S.history_zscore(spark.createDataFrame(rows, "entity string, date date, model_id int, signal_score double")).collect()}
    a = [r for r in rows if r[0] == "a"]
    for i, r in enumerate(a):
        past = [x[3] for x in a[max(0, i - 30):i]]
        z = None if len(past) < 10 else (r[3] - np.mean(past)) / np.std(past, ddof=1)
        g = got[("a", r[1])]
        assert g["zscore_30d"] == (None if z is None else pytest.approx(z, abs=1e-6))
        assert g["direction_zscore"] == (None if z is None else 1 if z > 1.5 else -1 if z < -1.5 else 0)
    assert all(got[("flat", r[1])]["zscore_30d"] is None for r in rows if r[0] == "flat")


def test_walkforward(spark):
    span = spark.sql("SELECT date'2024-05-15' AS start, date'2024-05-27' AS end")
    anchors = [r[0] for r in matrix.weekly_anchors(span).orderBy("anchor").collect()]
    assert anchors == [dt.date(2024, 5, 12), dt.date(2024, 5, 19), dt.date(2024, 5, 26)]
    folds = {(r["anchor"], r["role"]): (r["date_from"], r["date_to"]) for r in matrix.walkforward_folds(matrix.weekly_anchors(span), "2024-01-01", 1).collect()}
    a = dt.date(2024, 5, 12)
    assert folds[(a, "test")] == (dt.date(2024, 4, 15), dt.date(2024, 4, 28))
    assert folds[(a, "val")] == (dt.date(2024, 3, 25), dt.date(2024, 4, 14))
    assert folds[(a, "train")] == (dt.date(2024, 2, 23), dt.date(2024, 3, 24))


def test_matrix_dedups_and_fills(spark):
    anchor = spark.createDataFrame([("a", D0), ("b", D0)], "entity string, date date")
    ts = dt.datetime(2024, 1, 1)
    side = spark.createDataFrame([("a", ts.replace(hour=3), 1.0), ("a", ts.replace(hour=9), 2.0), ("c", ts, 5.0)], "entity string, ts timestamp, x double")
    wide = spark.createDataFrame([(ts.replace(hour=1), 7.0), (ts.replace(hour=2), 8.0)], "ts timestamp, idx double")
    T = matrix.FeatureTable
    out = matrix.feature_matrix(anchor, [T(side, ["x", "gone"]), T(wide, ["idx"], market_wide=True), T(None, ["nothing"])])
    assert sorted(tuple(r) for r in out.select("entity", "x", "gone", "idx", "nothing").collect()) == [("a", 2.0, None, 8.0, None), ("b", None, None, 8.0, None)]


def test_model_fit_and_score(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        y = rng.choice([-1, 0, 1])
        rows.append((i, y + rng.gauss(0, 0.3), None if i % 17 == 0 else rng.random(), y))
    df = spark.createDataFrame(rows, "id int, f1 double, f2 double, y int")
    for kind in ("logistic", "forest"):
        out = S.predict_direction(S.fit_direction_model(df, ["f1", "f2"], "y", kind), df, ["f1", "f2"], ["id", "y"])
        hit = out.withColumn("d", F.expr("case when p_buy > p_hold and p_buy > p_sell then 1 when p_sell > p_hold then -1 else 0 end")).filter("d = y").count()
        assert hit > 240


def test_equity_survives_long_series_and_total_loss(spark):
    days = spark.range(5000).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                                    F.when(F.col("id") == 4000, -0.5).otherwise(1.5).alias("pnl"))
    rows = E.equity_curve(days).orderBy("date").collect()
    assert rows[4000]["drawdown"] == pytest.approx(-0.5) and rows[4001]["drawdown"] == 0.0
    assert rows[-1]["log_equity"] == pytest.approx(4999 * math.log(2.5) + math.log(0.5))
    lost = spark.createDataFrame([(1, 0.5), (2, -1.0), (3, 2.0)], "date int, pnl double")
    assert [(r["equity"], r["drawdown"]) for r in E.equity_curve(lost).orderBy("date").collect()] == [(pytest.approx(1.5), 0.0), (0.0, -1.0), (0.0, -1.0)]


def test_pearson_ic(spark):
    rows = [("a", float(i), 2.0 * i + (i % 3)) for i in range(12)] + [("b", 1.0, float(i)) for i in range(12)] + [("c", float(i), 1.0 * i) for i in range(5)]
    df = spark.createDataFrame(rows + [("a", None, 1.0), ("a", 1.0, None)], "g string, s double, r double")
    got = {r["g"]: (r["n"], r["pearson_ic"]) for r in E.pearson_ic(df, "s", "r", ["g"]).collect()}
    want = np.corrcoef([r[1] for r in rows[:12]], [r[2] for r in rows[:12]])[0, 1]
    assert got == {"a": (12, pytest.approx(want, abs=1e-4)), "b": (12, None), "c": (5, None)}


def test_feature_table_ties_follow_the_order(spark):
    anchor = spark.createDataFrame([("x", dt.date(2024, 1, 1))], "entity string, date date")
    side = spark.createDataFrame([("x", dt.datetime(2024, 1, 1, 5), 1.0, 9), ("x", dt.datetime(2024, 1, 1, 5), 7.0, 3)],
                                 "entity string, ts timestamp, v double, version int")
    T = matrix.FeatureTable
    assert matrix.feature_matrix(anchor, [T(side, ["v"], order=("version",))]).collect()[0]["v"] == 1.0
    assert matrix.feature_matrix(anchor, [T(side, ["v"])]).collect()[0]["v"] == 7.0


def test_walkforward_scores_only_rows_of_the_role(spark):
    first = dt.date(2024, 1, 1)
    rows = [("e%d" % (i % 3), first + dt.timedelta(days=i // 3), float(i % 7), (i % 4 + i % 3) % 3 - 1, 0.1 * (i % 5)) for i in range(900)]
    df = spark.createDataFrame(rows, "entity string, date date, f1 double, y int, ret double")
    anchors = spark.createDataFrame([(dt.date(2024, 1, 20),), (dt.date(2024, 8, 1),)], "anchor date")
    folds = matrix.walkforward_folds(anchors, "2020-01-01")
    scored = walkforward.walkforward_scores(df, folds, ["f1"], "y", ["entity", "date", "y", "ret"])
    got = scored.collect()
    # the first anchor has no train rows yet; the second scores the 14 days that end 14 days before it
    assert {r["anchor"] for r in got} == {dt.date(2024, 8, 1)} and len(got) == 14 * 3
    assert {r["date"] for r in got} == {dt.date(2024, 7, 5) + dt.timedelta(days=i) for i in range(14)}
    assert all(r["p_sell"] + r["p_hold"] + r["p_buy"] == pytest.approx(1) for r in got)
    report = walkforward.fold_report(scored, "y", "ret").collect()
    assert len(report) == 1 and report[0]["scored"] == 42 and 0 <= report[0]["accuracy"] <= 1
    both = walkforward.walkforward_scores(df, folds, ["f1"], "y", ["date"], ("val", "test"))
    assert {(r["role"], r["n"]) for r in both.groupBy("role").agg(F.count("*").alias("n")).collect()} == {("val", 63), ("test", 42)}


def test_weekly_walkforward_scores_every_day_after_the_first_train_rows(spark):
    from newsmill.registry import evaluation
    first, last = dt.date(2024, 1, 1), dt.date(2024, 2, 25)
    rows = [("e%d" % e, first + dt.timedelta(days=i), float((i + e) % 7), (i + e) % 3 - 1) for i in range(56) for e in range(3)]
    df = spark.createDataFrame(rows, "entity string, date date, f1 double, y int")
    folds = evaluation._weekly_folds(spark.createDataFrame([(first, last)], "start date, end date"))
    got = walkforward.walkforward_scores(df, folds, ["f1"], "y", ["entity", "date"]).select("anchor", "entity", "date").collect()
    tested = {r["date"] for r in got}
    assert max(tested) == last and tested == {min(tested) + dt.timedelta(days=i) for i in range(len(tested))}
    assert min(tested) <= first + dt.timedelta(days=22 + 6) and len(set(got)) == len(got)


@pytest.mark.parametrize("held", [1, 32 << 20])
def test_fold_models_are_ridge_regressions_on_the_train_rows(spark, monkeypatch, held):
    """Large levels, missing and constant features, unlabelled rows and train spans that begin anywhere, against least squares on the rows."""
    monkeypatch.setattr(walkforward, "HELD_BYTES", held)
    rng = np.random.default_rng(5)
    first, n = dt.date(2024, 1, 1), 1500
    day = rng.integers(0, 120, n)
    x = np.stack([1e9 + 1e3 * rng.normal(size=n), rng.normal(size=n) * 1e-6, np.full(n, 7.0), rng.normal(size=n)], 1)
    y = np.clip(np.rint(x[:, 3] + rng.normal(size=n)), -1, 1)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 2] = 7.0
    labelled = rng.random(n) < 0.9
    rows = [(first + dt.timedelta(days=int(d)), *[None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)], int(c) if ok else None)
            for d, r, c, ok in zip(day, x, y, labelled)]
    df = spark.createDataFrame(rows, "date date, a double, b double, c double, d double, y int").repartition(5)
    spans = {1: (10, 60), 2: (0, 119), 3: (30, 200), 4: (-50, 40), 5: (70, 60), 6: (300, 400)}
    folds = spark.createDataFrame([(k, "train", first + dt.timedelta(days=a), first + dt.timedelta(days=b)) for k, (a, b) in spans.items()],
                                  "anchor long, role string, date_from date, date_to date")
    got = {r["anchor"]: r for r in walkforward.fit_folds(df, folds, ["a", "b", "c", "d"], "y").collect()}
    assert set(got) == {1, 2, 3, 4}
    for k in got:
        own = labelled & (day >= spans[k][0]) & (day <= spans[k][1])
        train = x[own]
        mean = np.nanmean(train, 0)
        z = np.where(np.isnan(train), mean, train) - mean
        sd = np.where(z.std(0) > 0, z.std(0), 1)
        z /= sd
        one_hot = y[own][:, None] == np.array([-1, 0, 1])
        w = np.linalg.solve(z.T @ z / own.sum() + walkforward.RIDGE * np.eye(4), z.T @ one_hot / own.sum())
        scores = one_hot.mean(0) + (np.where(np.isnan(x), mean, x) - mean) / sd @ w
        fit = got[k]
        assert fit["train_rows"] == own.sum() and fit["means"] == pytest.approx(mean, rel=1e-9)
        ours = np.array(fit["weights"])
        filled = np.where(np.isnan(x), np.array(fit["means"]), x)
        assert ours[:, 0] + filled @ ours[:, 1:].T == pytest.approx(scores, abs=1e-5)


def test_folds_without_all_classes_have_no_model(spark):
    rows = [(dt.date(2024, 1, 1 + i % 20), float(i), 1 if i < 50 else 0) for i in range(60)] + [(None, 1.0, -1), (dt.date(2024, 1, 3), None, 5)]
    df = spark.createDataFrame(rows, "date date, a double, y int")
    folds = spark.createDataFrame([(1, "train", dt.date(2023, 1, 1), dt.date(2025, 1, 1))], "anchor int, role string, date_from date, date_to date")
    assert walkforward.fit_folds(df, folds, ["a"], "y").count() == 0
    fit = walkforward.fit_folds(df, folds, ["a"], "y", least_classes=1).collect()
    assert len(fit) == 1 and fit[0]["train_rows"] == 60 and fit[0]["weights"][0] == pytest.approx([0.0, 0.0])
    assert walkforward.fit_folds(df.where("false"), folds, ["a"], "y", least_classes=1).count() == 0


def matrix_tables(spark, rng, n=300):
    """Tables with several rows a day, ties in time, nulls and days of their own."""
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(rng.integers(0, 24 * 8)))
    value = lambda: None if rng.random() < 0.2 else float(rng.integers(0, 9))
    rows = lambda k: [(f"e{rng.integers(0, 4)}", at(), value(), value(), int(rng.integers(0, 3))) for _ in range(k)]
    make = lambda k: spark.createDataFrame(rows(k), "entity string, ts timestamp, a double, b double, seq int")
    T = matrix.FeatureTable
    anchor = T(make(n), ["a"], order=("seq", "a", "b"))
    tables = [T(make(n).withColumnRenamed("a", "x"), ["x", "absent"], order=("seq", "x", "b")), T(make(n).withColumnsRenamed({"a": "y", "b": "z"}), ["y", "z"]),
              T(make(40).withColumnRenamed("a", "day_a"), ["day_a"], market_wide=True, order=("entity", "seq", "day_a")), T(None, ["gone"]),
              T(make(0).withColumnRenamed("a", "none"), ["none"])]
    return anchor, tables


def test_union_matrix_has_the_rows_of_the_joins(spark):
    anchor, tables = matrix_tables(spark, np.random.default_rng(1))
    newest = anchor.frame.select("entity", "ts", F.to_date("ts").alias("date"), "a", "seq", "b").toPandas()
    want = {}
    for r in sorted(newest.itertuples(index=False), key=lambda r: (r.ts, r.seq, not math.isnan(r.a), r.a, not math.isnan(r.b), r.b)):
        want[r.entity, r.date] = None if math.isnan(r.a) else r.a
    base = spark.createDataFrame([(*k, v) for k, v in want.items()], "entity string, date date, a double")
    joined = matrix.feature_matrix(base, tables[:2] + tables[3:]).collect()
    out = matrix.union_matrix(anchor, tables)
    assert out.columns == ["entity", "date", "a", "x", "absent", "y", "z", "day_a", "gone", "none"]
    rows = out.collect()
    key = lambda r: (r["entity"], r["date"])
    assert len(rows) == len(want) and {key(r): (r["a"], r["x"], r["absent"], r["y"], r["z"], r["gone"], r["none"]) for r in rows} == {
        key(r): (r["a"], r["x"], r["absent"], r["y"], r["z"], r["gone"], r["none"]) for r in joined}
    days = {}
    for r in sorted(tables[2].frame.collect(), key=lambda r: (r["ts"], r["entity"], r["seq"], r["day_a"] is not None, r["day_a"] or 0)):
        days[r["ts"].date()] = r["day_a"]
    assert all(r["day_a"] == days.get(r["date"]) for r in rows)
    empty = matrix.FeatureTable(anchor.frame.where("false"), ["a"])
    assert matrix.union_matrix(empty, tables).count() == 0


def test_union_matrix_has_one_exchange_for_all_entity_tables(spark, tmp_path):
    anchor, tables = matrix_tables(spark, np.random.default_rng(2), 50)
    wide = tables[:2] * 4
    cols = [[f"{c}{i}" for c in t.cols] for i, t in enumerate(wide)]
    wide = [matrix.FeatureTable(t.frame.withColumnsRenamed(dict(zip(t.cols, names))), names) for t, names in zip(wide, cols)]
    text = matrix.union_matrix(anchor, [*wide, tables[2]])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(entity") == 1 and text.count("Exchange hashpartitioning(date") <= 2
    assert "SortMergeJoin" not in text or text.count("SortMergeJoin") == 1


def test_full_matrices_have_values_in_every_table(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.01"
    for name, width in (("training_matrix_full", 62), ("inference_matrix_full", 52)):
        out = entry.queries()[name](spark, sf)
        assert len(out.columns) == width
        counts = out.agg(*[F.count(c).alias(c) for c in out.columns]).first().asDict()
        assert [c for c, n in counts.items() if n == 0] == []


def test_rolling_ic_pools_every_block(spark):
    """Gaps in the calendar, ties, nulls, constant stretches and blocks with few rows, against a pooled rank correlation."""
    rng = np.random.default_rng(12)
    days = sorted(D0 + dt.timedelta(days=int(d)) for d in rng.choice(150, 70, replace=False))
    rows = [(d, f"e{e}", None if rng.random() < 0.1 else float(rng.integers(0, 6)) if d < days[50] else 1.0, None if rng.random() < 0.2 else float(rng.normal()))
            for i, d in enumerate(days) for e in range(1 if 25 < i < 40 else 6)]
    df = spark.createDataFrame(rows, "date date, entity string, s double, r double")
    for window, least in ((20, 10), (7, 12), (100, 10)):
        got = {r["as_of"]: (r["n"], r["ic"]) for r in E.rolling_ic(df, "s", "r", window, least).collect()}
        want = {}
        for p in range(window, len(days)):
            part = pd.DataFrame([(s, r) for d, _, s, r in rows if days[p - window] <= d < days[p] and s is not None and r is not None], columns=["s", "r"])
            if len(part) >= least:
                ic = part["s"].rank().corr(part["r"].rank())
                want[days[p]] = (len(part), None if math.isnan(ic) else pytest.approx(ic, abs=1e-6))
        assert got == want

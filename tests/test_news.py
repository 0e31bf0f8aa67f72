"""News aggregation against a plain Python statement of the definitions."""

import datetime as dt
import math
import random
import statistics

import pytest

from newsmill.functions import rules
from newsmill.plans import news, reports

BASE = dt.datetime(2024, 3, 1)
TYPES = ["REGULATION", "HACK_EXPLOIT", "ADOPTION_PARTNERSHIP", "ETF_INSTITUTIONAL", "LIQUIDATION", "MACRO", "WHALE_MOVEMENT", "OTHER", None]


def scores(n=150, seed=4, days=50):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        day = rng.choice([d for d in range(days) if d not in (10, 11, 12, 13, 14, 15, 16, 17, 18, 19)])
        ts = BASE + dt.timedelta(days=day, seconds=rng.randrange(86400))
        out.append((i, ts, round(rng.uniform(-1, 1), 6), rng.choice(TYPES), rng.choice([1, 2, 3, None]), rng.choice([["a"], ["a", "b"], ["c"], [], None])))
    out.append((n, BASE + dt.timedelta(days=5, hours=20), 0.5, "MACRO", 1, ["edge"]))
    out.append((n + 1, BASE + dt.timedelta(days=5, hours=19, minutes=59, seconds=59), 0.5, "MACRO", 1, ["early"]))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "news_id bigint, published_on timestamp, composite_score double, event_type string, source_tier int, entities array<string>")


def test_news_signals(spark):
    rows = scores()
    arts = [(r[0], ["Breaking", None, "daily", "x|BREAKING NEWS"][r[0] % 4]) for r in rows if r[0] % 7 and r[0] < 150] + [(150, "breaking"), (151, "breaking")]
    tags = dict(arts)
    got = {(r["entity"], r["date"]): r for r in news.news_signals(frame(spark, rows), spark.createDataFrame(arts, "id bigint, tags string")).collect()}
    day = lambda r: r[1].date()
    weight = lambda r: rules.TIER_WEIGHTS.get(r[4], 1.0)
    mean = lambda rs: sum(r[2] * weight(r) for r in rs) / sum(map(weight, rs)) if rs else 0.0
    want = set()
    for d in sorted({day(r) for r in rows if r[0] in tags}):
        for e in {e for r in rows for e in r[5] or []}:
            of = lambda a, b, only=False: [r for r in rows if e in (r[5] or []) and d - dt.timedelta(days=a) <= day(r) <= d - dt.timedelta(days=b) and (not only or r[0] in tags)]
            one, three, seven = of(0, 0, True), of(3, 0), of(7, 0)
            if not seven:
                continue
            want.add((e, d))
            g = got[(e, d)]
            assert g["news_sentiment_1d"] == pytest.approx(mean(one), abs=1e-6) and g["news_source_quality"] == g["news_sentiment_1d"]
            assert g["news_sentiment_3d"] == pytest.approx(mean(three), abs=1e-6) and g["news_sentiment_7d"] == pytest.approx(mean(seven), abs=1e-6)
            assert g["news_sentiment_momentum"] == pytest.approx(mean(one) - mean(seven), abs=2e-6)
            assert (g["news_volume_1d"], g["news_volume_3d"]) == (len(one), len(three))
            per_day = {}
            for r in of(30, 1):
                per_day[day(r)] = per_day.get(day(r), 0) + 1
            c = list(per_day.values())
            m = statistics.mean(c) if c else 0.0
            sd = max(statistics.stdev(c), 0.01) if len(c) > 1 else 1.0
            assert g["news_volume_zscore_1d"] == pytest.approx((len(one) - m) / sd, abs=1e-4)
            kinds = {r[3] for r in one}
            assert g["news_regulation_flag"] == ("REGULATION" in kinds) and g["news_security_flag"] == ("HACK_EXPLOIT" in kinds) and g["news_adoption_flag"] == ("ADOPTION_PARTNERSHIP" in kinds)
            assert g["news_breaking_flag"] == any("breaking" in (tags[r[0]] or "").lower() and r[1].hour >= 20 for r in one)
            assert [g[f"news_tier{t}_count_1d"] for t in (1, 2, 3)] == [sum((r[4] or 2) == t for r in one) for t in (1, 2, 3)]
    assert want == set(got)
    five = (BASE + dt.timedelta(days=5)).date()
    assert got[("edge", five)]["news_breaking_flag"] == 1 and got[("early", five)]["news_breaking_flag"] == 0


def test_news_events(spark):
    rows = scores(seed=9)
    got = {(r["entity"], r["date"]): r for r in news.news_events(frame(spark, rows)).collect()}
    flat = [(e, r[1], rules.EVENT_GROUPS.get(r[3] or "OTHER")) for r in rows for e in r[5] or []]
    days = sorted({ts.date() for _, ts, _ in flat})
    entities = {e for e, _, _ in flat}
    assert set(got) == {(e, d) for e in entities for d in days}
    for (e, d), g in got.items():
        mine = [(ts, k) for x, ts, k in flat if x == e]
        today = [k for ts, k in mine if ts.date() == d]
        named = [k for k in today if k]
        top = min(set(named), key=lambda k: (-named.count(k), k)) if named else None
        assert g["event_type"] == top and g["magnitude_est"] == rules.EVENT_MAGNITUDES.get(top, 0.0) and g["event_count_24h"] == len(today)
        end = dt.datetime.combine(d, dt.time(23, 59, 59))
        for k in rules.RECENCY_GROUPS:
            past = [ts for ts, kk in mine if kk == k and ts.date() <= d]
            hours = None if not past else max(0.0, round((end - max(past)).total_seconds() / 3600, 2))
            assert g[f"hours_since_{k}"] == (None if hours is None else pytest.approx(hours, abs=0.0101))
        counts = [sum(ts.date() == d - dt.timedelta(days=j) for ts, _ in mine) for j in range(1, 31)]
        m, sd = statistics.mean(counts), statistics.pstdev(counts)
        assert g["news_surprise"] == pytest.approx((len(today) - m) / max(sd, 0.1), abs=1e-4)
        total = sum(ts.date() == d for _, ts, _ in flat)
        assert g["cross_news_ratio"] == pytest.approx(len(today) / max(total, 1), abs=1e-4)


def test_news_events_start_keeps_history(spark):
    rows = scores(seed=2)
    start = (BASE + dt.timedelta(days=30)).date()
    full = {(r["entity"], r["date"]): r for r in news.news_events(frame(spark, rows)).collect() if r["date"] >= start}
    part = {(r["entity"], r["date"]): r for r in news.news_events(frame(spark, rows), start.isoformat()).collect()}
    assert full == part


def test_score_articles_skips_done_and_short(spark):
    arts = spark.createDataFrame(
        [(1, BASE, "Bitcoin up", "b" * 400, 400, "", "CoinDesk"), (2, BASE, "x", "b", 1, "", "y"), (3, BASE, "FED decides", "b" * 300, 300, None, None)],
        "id bigint, published_on timestamp, title string, body string, body_length int, categories string, source_name string")
    probs = spark.createDataFrame([(i, .7, .1, .2, .2, .3, .5) for i in (1, 2, 3)], "id bigint, title_pos double, title_neg double, title_neu double, body_pos double, body_neg double, body_neu double")
    done = spark.createDataFrame([(1, "old"), (3, "m")], "news_id bigint, model_version string")
    out = news.score_articles(arts, probs, done, "m").collect()
    assert [r["news_id"] for r in out] == [1]
    r = out[0]
    assert (r["title_score"], r["body_score"], r["composite_score"], r["confidence"], r["source_tier"], r["entities"]) == (0.6, -0.1, 0.18, 0.5, 1, ["bitcoin"])


def test_news_signals_range_equals_full_run(spark):
    rows = scores(seed=12)
    arts = spark.createDataFrame([(r[0], "daily") for r in rows], "id bigint, tags string")
    lo, hi = (BASE + dt.timedelta(days=d) for d in (32, 40))
    full = {(r["entity"], r["date"]): r for r in news.news_signals(frame(spark, rows), arts).collect() if lo.date() <= r["date"] <= hi.date()}
    part = {(r["entity"], r["date"]): r for r in news.news_signals(frame(spark, rows), arts, str(lo.date()), str(hi.date())).collect()}
    assert full and full == part


def test_search_takes_marks_literally(spark):
    df = spark.createDataFrame([(1, "50% up", "x"), (2, "500 up", "a_b"), (3, "none", "AXB")], "id int, title string, body string")
    assert [r["id"] for r in reports.search(df, "50%").collect()] == [1]
    assert [(r["id"], r["found_in"]) for r in reports.search(df, "A_B").collect()] == [(2, "body")]
    assert reports.search(df, "\\").count() == 0


def test_ingest_rate_keeps_empty_periods(spark):
    df = spark.createDataFrame([("u", "2024-01-01 01:10:00", "2024-01-01 02:00:00"), ("u", "2024-01-01 01:50:00", "2024-01-01 02:00:00"), ("w", "2024-01-01 03:00:00", "2024-01-01 04:00:00")],
                               "url string, published_on string, fetched_at string")
    df = df.selectExpr("url", "to_timestamp(published_on) AS published_on", "to_timestamp(fetched_at) AS fetched_at")
    got = {r["period"]: (r["hours"], r["total"], r["avg_per_hour"], r["max_per_hour"]) for r in reports.ingest_rate(df, "2024-02-01", "2024-01-15").collect()}
    assert got == {"last_24h": (0, 0, 0.0, 0), "live": (0, 0, 0.0, 0), "baseline": (2, 2, 1.0, 1)}
    assert reports.ingest_rate(df.limit(0), "2024-02-01", "2024-01-15").count() == 3

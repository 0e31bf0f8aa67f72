"""Queries over signals and their realised returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.functions import market as M
from newsmill.operators.keys import top_k
from newsmill.operators.ordering import running_sums, value_ranks
from newsmill.plans import evaluate as Ev, matrix, signals as S, walkforward
from newsmill.registry import query
from newsmill.registry.market import REGIME_SQL, _regime

AVG_RANK = "(rank() OVER ({p} ORDER BY {x}) + (count(*) OVER (PARTITION BY {g}{x}) - 1) / 2.0)"


def ranks(x, group=None):
    return AVG_RANK.format(x=x, p=f"PARTITION BY {group}" if group else "", g=f"{group}, " if group else "")


def ic_sql(ret, name="ic", digits=6, frm="v_signals"):
    return f"""SELECT CASE WHEN count(*) >= 10 THEN round(corr(rx, ry), {digits}) END AS {name} FROM (
        SELECT {ranks("signal_score")} AS rx, {ranks(ret)} AS ry FROM {frm} WHERE signal_score IS NOT NULL AND {ret} IS NOT NULL)"""


@query("spearman_ic", ic_sql("forward_ret_3d"))
def _(v):
    return Ev.spearman_ic(v.signals, "signal_score", "forward_ret_3d")


@query("whole_table_rank", f"SELECT signal_score, count(*) AS n, round(max(r), 1) AS rank FROM (SELECT signal_score, {ranks('signal_score')} AS r FROM v_signals) GROUP BY signal_score")
def _(v):
    """Average-tie rank of every distinct score over the whole table."""
    return value_ranks(v.signals, "signal_score").select("signal_score", "n", "rank")


@query("whole_table_running_sum", """
    SELECT o_orderkey, round(sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS running FROM orders""")
def _(v):
    rows = v.table("orders").select("o_orderkey", F.unix_timestamp("o_orderdate").alias("t"), "o_totalprice")
    return running_sums(rows, "t", "o_orderkey", {"o_totalprice": "running"}).select("o_orderkey", F.round("running", 2).alias("running"))


DAILY_IC = f"""
    dic AS (SELECT date, corr(rx, ry) AS ic, count(*) AS n FROM (SELECT date, {ranks("signal_score", "date")} AS rx, {ranks("forward_ret_3d", "date")} AS ry
            FROM v_signals WHERE signal_score IS NOT NULL AND forward_ret_3d IS NOT NULL) GROUP BY date HAVING count(*) >= 5),
    daily AS (SELECT date, n, CASE WHEN isnan(ic) THEN NULL ELSE ic END AS ic FROM dic)"""


@query("daily_ic", f"WITH {DAILY_IC} SELECT CAST(date AS VARCHAR) AS date, n, round(ic, 6) + 0.0 AS ic FROM daily")
def _(v):
    return Ev.daily_ic(v.signals, "signal_score", "forward_ret_3d").withColumn("ic", F.round("ic", 6))


@query("ic_summary", f"""WITH {DAILY_IC}
    SELECT count(ic) AS days, round(avg(ic), 4) AS ic_mean, round(stddev_samp(ic), 4) AS ic_std, round(round(avg(ic), 4) / round(stddev_samp(ic), 4), 4) AS icir, round(100.0 * count(*) FILTER (WHERE ic > 1e-12) / count(ic), 4) AS positive_pct FROM daily""")
def _(v):
    return Ev.ic_summary(Ev.daily_ic(v.signals, "signal_score", "forward_ret_3d"))


@query("ic_by_month", f"WITH {DAILY_IC} SELECT strftime(date, '%Y-%m') AS month, round(avg(ic), 6) + 0.0 AS ic, count(*) AS days FROM daily GROUP BY 1")
def _(v):
    return Ev.ic_by_month(Ev.daily_ic(v.signals, "signal_score", "forward_ret_3d"))


ROLLING = f"""
    d AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS pos, count(*) OVER () AS total FROM (SELECT DISTINCT date FROM v_signals)),
    blk AS (SELECT a.pos AS block, a.date AS as_of, b.date FROM d a JOIN d b ON b.pos BETWEEN a.pos - 20 AND a.pos - 1 WHERE a.pos >= 20),
    pool AS (SELECT block, as_of, signal_score, forward_ret_3d FROM blk JOIN v_signals USING (date) WHERE forward_ret_3d IS NOT NULL),
    roll AS (SELECT block, as_of, count(*) AS n, round(corr(rx, ry), 6) + 0.0 AS ic FROM (SELECT block, as_of, {ranks("signal_score", "block")} AS rx, {ranks("forward_ret_3d", "block")} AS ry FROM pool) GROUP BY ALL HAVING count(*) >= 10)"""


@query("rolling_ic", f"WITH {ROLLING} SELECT CAST(as_of AS VARCHAR) AS as_of, n, ic FROM roll")
def _(v):
    return Ev.rolling_ic(v.signals, "signal_score", "forward_ret_3d")


@query("rolling_ic_summary", f"WITH {ROLLING} SELECT round(avg(ic), 6) AS ic_mean, round(stddev_pop(ic), 6) AS ic_std, round(avg(ic) / stddev_pop(ic), 4) AS icir FROM roll")
def _(v):
    return Ev.rolling_ic_summary(Ev.rolling_ic(v.signals, "signal_score", "forward_ret_3d"))


CLF = """
    clf AS (SELECT round(count(*) FILTER (WHERE label_3d = pred) / count(*), 4) AS accuracy,
        coalesce(round(count(*) FILTER (WHERE label_3d = 1 AND pred = 1) / nullif(count(*) FILTER (WHERE pred = 1), 0), 4), 0) AS precision_buy,
        coalesce(round(count(*) FILTER (WHERE label_3d = 1 AND pred = 1) / nullif(count(*) FILTER (WHERE label_3d = 1), 0), 4), 0) AS recall_buy,
        coalesce(round(2 * count(*) FILTER (WHERE label_3d = 1 AND pred = 1) / nullif(count(*) FILTER (WHERE label_3d = 1) + count(*) FILTER (WHERE pred = 1), 0), 4), 0) AS f1_buy FROM v_signals WHERE label_3d IS NOT NULL)"""


@query("classification_report", f"WITH {CLF} SELECT * FROM clf")
def _(v):
    return Ev.classification_report(v.signals, "label_3d", "pred")


@query("confusion_matrix", """
    SELECT CAST(label_3d AS BIGINT) AS truth, count(*) FILTER (WHERE pred = -1) AS pred_m1, count(*) FILTER (WHERE pred = 0) AS pred_0, count(*) FILTER (WHERE pred = 1) AS pred_1 FROM v_signals WHERE label_3d IS NOT NULL GROUP BY 1""")
def _(v):
    return Ev.confusion_matrix(v.signals, "label_3d", "pred")


ROC = """
    cnt AS (SELECT signal_score AS threshold, count(*) FILTER (WHERE label_3d = 1) AS pos, count(*) FILTER (WHERE label_3d <> 1) AS neg FROM v_signals WHERE label_3d IS NOT NULL GROUP BY 1),
    roc AS (SELECT threshold, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp FROM cnt WINDOW w AS (ORDER BY threshold DESC)),
    tot AS (SELECT sum(pos) AS p, sum(neg) AS n FROM cnt)"""


@query("roc_points", f"WITH {ROC} SELECT threshold, pos, neg, tp, fp, round(tp / p, 6) AS tpr, round(fp / n, 6) AS fpr FROM roc, tot")
def _(v):
    roc = Ev.roc_points(v.signals, "label_3d", "signal_score")
    return roc.withColumns({"tpr": F.round("tpr", 6), "fpr": F.round("fpr", 6)})


@query("auc", f"WITH {ROC} SELECT round(sum(neg * (tp - pos + pos / 2.0)) / (max(p) * max(n)), 4) AS auc FROM roc, tot")
def _(v):
    return Ev.auc(Ev.roc_points(v.signals, "label_3d", "signal_score"))


TOP = """
    ranked AS (SELECT date, forward_ret_3d AS r, row_number() OVER (PARTITION BY date ORDER BY signal_score DESC, entity) AS rk FROM v_signals WHERE forward_ret_3d IS NOT NULL),
    day AS (SELECT date, avg(r) AS pnl FROM ranked WHERE rk <= 5 GROUP BY date HAVING count(*) = 5),
    curve AS (SELECT date, pnl, sum(ln(1 + pnl)) OVER (ORDER BY date) AS lg FROM day), dd AS (SELECT *, exp(lg - max(lg) OVER (ORDER BY date)) - 1 AS down FROM curve)"""


@query("topn_portfolio", f"""WITH {TOP}
    SELECT CASE WHEN count(*) >= 5 THEN round(avg(pnl) / stddev_pop(pnl) * sqrt(252), 4) END AS sharpe, CASE WHEN count(*) >= 5 THEN round(min(down), 4) + 0.0 END AS max_drawdown, CASE WHEN count(*) >= 5 THEN round(exp(arg_max(lg, date)) - 1, 4) END AS total_return, CASE WHEN count(*) >= 5 THEN round(arg_max(lg, date), 4) + 0.0 END AS log_return,
        CASE WHEN count(*) >= 5 THEN round(avg(CAST(pnl > 0 AS INT)), 4) END AS win_rate, CASE WHEN count(*) >= 5 THEN count(*) * 5 ELSE 0 END AS total_trades, 3 AS avg_holding_days FROM dd""")
def _(v):
    return Ev.topn_portfolio(v.signals, "signal_score", "forward_ret_3d", 5)


@query("equity_curve", f"WITH {TOP} SELECT CAST(date AS VARCHAR) AS date, round(pnl, 6) + 0.0 AS pnl, round(lg, 6) + 0.0 AS log_equity, round(down, 6) + 0.0 AS drawdown FROM dd")
def _(v):
    curve = Ev.equity_curve(Ev.daily_top(v.signals, "signal_score", "forward_ret_3d", 5))
    return curve.select("date", F.round("pnl", 6).alias("pnl"), F.round("log_equity", 6).alias("log_equity"), F.round("drawdown", 6).alias("drawdown"))


@query("return_stats", """
    WITH top AS (SELECT date, avg(r) AS pnl FROM (SELECT date, forward_ret_1d AS r, row_number() OVER (PARTITION BY date ORDER BY signal_score DESC, entity) AS rk FROM v_signals) WHERE rk <= 5 GROUP BY date),
    c AS (SELECT date, pnl, sum(ln(1 + coalesce(pnl, 0))) OVER (ORDER BY date) AS lg FROM top), d AS (SELECT *, exp(lg - max(lg) OVER (ORDER BY date)) - 1 AS down FROM c)
    SELECT round(avg(pnl) / stddev_samp(pnl) * sqrt(252), 4) AS sharpe, round(min(down), 4) + 0.0 AS max_drawdown, count(pnl) AS days FROM d""")
def _(v):
    return Ev.return_stats(Ev.daily_top(v.signals, "signal_score", "forward_ret_1d", 5, full_only=False))


@query("hit_rate", """
    WITH r AS (SELECT date, forward_ret_3d AS r, row_number() OVER (PARTITION BY date ORDER BY signal_score DESC, entity) AS rk, count(*) OVER (PARTITION BY date) AS n FROM v_signals),
    d AS (SELECT date, avg(r) FILTER (WHERE rk <= 3) AS t, avg(r) FILTER (WHERE rk > n - 3) AS b FROM r WHERE n >= 6 GROUP BY date)
    SELECT count(*) AS days, round(avg(CAST(t > b AS INT)), 4) AS hit_rate FROM d WHERE t IS NOT NULL AND b IS NOT NULL""")
def _(v):
    return Ev.hit_rate(v.signals, "signal_score", "forward_ret_3d", 3)


@query("quartile_curve", """
    WITH r AS (SELECT date, forward_ret_3d AS r, row_number() OVER (PARTITION BY date ORDER BY signal_score DESC, entity) AS rk, count(*) OVER (PARTITION BY date) AS n FROM v_signals WHERE forward_ret_3d IS NOT NULL),
    d AS (SELECT date, avg(r) FILTER (WHERE rk <= greatest(n // 4, 1)) AS t, avg(r) FILTER (WHERE rk > n - greatest(n // 4, 1)) AS b FROM r WHERE n >= 8 GROUP BY date)
    SELECT CAST(date AS VARCHAR) AS date, round(sum(t * 100) OVER w, 2) + 0.0 AS long, round(-sum(b * 100) OVER w, 2) + 0.0 AS short, round(sum(t * 100) OVER w - sum(b * 100) OVER w, 2) + 0.0 AS net FROM d WINDOW w AS (ORDER BY date)""")
def _(v):
    return Ev.quartile_curve(v.signals, "signal_score", "forward_ret_3d", 8)


@query("ic_by_horizon", " UNION ALL ".join(
    f"SELECT '{h}' AS horizon, round(ic, 4) AS ic FROM ({ic_sql(f'forward_ret_{h}')})" for h in ("1d", "3d", "7d")))
def _(v):
    return Ev.ic_by_horizon(v.signals, "signal_score", {h: f"forward_ret_{h}" for h in ("1d", "3d", "7d")})


@query("signal_distribution", """
    SELECT count(signal_score) AS n, round(avg(signal_score), 6) + 0.0 AS mean, round(stddev_samp(signal_score), 6) AS std, min(signal_score) AS min, max(signal_score) AS max,
        count(*) FILTER (WHERE signal_score > 0.02) AS n_long, count(*) FILTER (WHERE signal_score < -0.02) AS n_short FROM v_signals""")
def _(v):
    return Ev.signal_distribution(v.signals, "signal_score", 0.02, -0.02)


@query("full_eval", f"""
    WITH {CLF}, {ROLLING}, {TOP},
    i1 AS ({ic_sql("forward_ret_1d")}), i3 AS ({ic_sql("forward_ret_3d")}), i7 AS ({ic_sql("forward_ret_7d")}),
    rs AS (SELECT round(avg(ic), 6) AS m, round(stddev_pop(ic), 6) AS s, round(avg(ic) / stddev_pop(ic), 4) AS r FROM roll),
    pf AS (SELECT count(*) AS k, round(avg(pnl) / stddev_pop(pnl) * sqrt(252), 4) AS sharpe, round(min(down), 4) AS mdd, round(avg(CAST(pnl > 0 AS INT)), 4) AS wr, round(exp(arg_max(lg, date)) - 1, 4) AS tr, round(arg_max(lg, date), 4) AS lr FROM dd)
    SELECT unnest(['ic_1d', 'ic_3d', 'ic_7d', 'ic_3d_mean', 'ic_3d_std', 'icir', 'accuracy', 'precision_buy', 'recall_buy', 'f1_buy', 'sharpe', 'max_drawdown', 'total_return', 'log_return', 'win_rate', 'total_trades', 'avg_holding_days']) AS metric,
           unnest([i1.ic, i3.ic, i7.ic, m, s, r, accuracy, precision_buy, recall_buy, f1_buy, CASE WHEN k >= 5 THEN sharpe END, CASE WHEN k >= 5 THEN mdd END, CASE WHEN k >= 5 THEN tr END, CASE WHEN k >= 5 THEN lr END, CASE WHEN k >= 5 THEN wr END, CASE WHEN k >= 5 THEN CAST(k * 5 AS DOUBLE) ELSE 0 END, CAST(3 AS DOUBLE)]) AS value
    FROM i1, i3, i7, rs, clf, pf""")
def _(v):
    return Ev.full_eval(v.signals, "signal_score", "label_3d", "pred", n=5)


@query("pearson_ic", """
    SELECT entity, count(*) AS n, CASE WHEN count(*) >= 11 THEN round(corr(signal_score, forward_ret_3d), 4) + 0.0 END AS pearson_ic
    FROM v_signals WHERE signal_score IS NOT NULL AND forward_ret_3d IS NOT NULL GROUP BY entity""")
def _(v):
    return Ev.pearson_ic(v.signals, "signal_score", "forward_ret_3d", ["entity"])


# ---- signals -------------------------------------------------------------------------------------

ZS = """round(z, 6) + 0.0 AS zscore_30d, CASE WHEN z > 1.5 THEN 1 WHEN z < -1.5 THEN -1 WHEN z IS NOT NULL THEN 0 END AS direction_zscore
    FROM (SELECT *, CASE WHEN count({c}) OVER w >= 10 AND stddev_samp({c}) OVER w > 0 THEN ({c} - avg({c}) OVER w) / stddev_samp({c}) OVER w END AS z
          FROM {f} WINDOW w AS (PARTITION BY entity, model_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))"""


@query("history_zscore", f"SELECT entity, CAST(date AS VARCHAR) AS date, signal_score, {ZS.format(c='signal_score', f='v_signals')}")
def _(v):
    return S.history_zscore(v.signals.select("entity", "date", "model_id", "signal_score")).drop("model_id")


def _probs(v):
    s = F.col("signal_score")
    rows = v.signals.select("entity", "date", "model_id", (0.34 + 2.83 * F.sqrt(F.lit(2.0)) * s).alias("p_buy"), (0.33 - 2.12 * F.sqrt(F.lit(2.0)) * s).alias("p_sell"))
    return rows.withColumn("p_hold", 1 - F.col("p_buy") - F.col("p_sell"))


PROBS = """
    pr0 AS (SELECT entity, date, model_id, 0.34::DOUBLE + 2.83::DOUBLE * sqrt(2) * signal_score AS p_buy, 0.33::DOUBLE - 2.12::DOUBLE * sqrt(2) * signal_score AS p_sell FROM v_signals),
    pr AS (SELECT *, 1 - p_buy - p_sell AS p_hold FROM pr0)"""


@query("signal_table", f"""WITH {REGIME_SQL}, {PROBS},
    g AS (SELECT pr.entity, pr.date, pr.model_id, p_buy - p_sell AS raw, round(greatest(p_buy, p_sell, p_hold), 6) AS confidence,
            CASE WHEN p_sell >= p_hold AND p_sell >= p_buy THEN -1 WHEN p_hold >= p_buy THEN 0 ELSE 1 END AS direction, regime_state, coalesce(regime.confidence, 0) AS c FROM pr LEFT JOIN regime USING (date)),
    h AS (SELECT *, round(CASE WHEN regime_state = 'bull_trend' AND raw <= 0 THEN raw * (1 - c * 0.5) WHEN regime_state = 'bear_trend' AND raw >= 0 THEN raw * (1 - c * 0.5) WHEN regime_state = 'range_bound' THEN raw * (1 - c * 0.3)
            WHEN regime_state = 'high_vol' THEN raw * (1 + c * 0.2) ELSE raw END, 6) + 0.0 AS signal_score FROM g)
    SELECT entity, CAST(date AS VARCHAR) AS date, round(raw, 6) + 0.0 AS raw_score, direction, confidence, regime_state, signal_score, {ZS.format(c='signal_score', f='h')}""")
def _(v):
    return S.signal_table(_probs(v), _regime(v)).select(
        "entity", "date", "raw_score", "direction", "confidence", "regime_state", "signal_score", "zscore_30d", "direction_zscore")


CAND = """
    SELECT entity, CAST(date AS VARCHAR) AS date, signal_score, rank, 'BUY' AS direction FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY signal_score DESC, entity) AS rank FROM v_signals WHERE signal_score > 0.01 {w}) WHERE rank <= {n}
    UNION ALL SELECT entity, CAST(date AS VARCHAR), signal_score, rank, 'SHORT' FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY signal_score, entity) AS rank FROM v_signals WHERE signal_score < -0.01 {w}) WHERE rank <= {n}"""


@query("select_candidates", CAND.format(w="AND date = (SELECT max(date) FROM v_signals)", n=15))
def _(v):
    return S.select_candidates(v.signals, None, 0.01, -0.01).select("entity", "date", "signal_score", "rank", "direction")


@query("daily_candidates", CAND.format(w="AND entity <> 's03'", n=3))
def _(v):
    names = [f"s{i:02d}" for i in range(20) if i != 3]
    return S.select_candidates(v.signals, names, 0.01, -0.01, 3, latest_only=False).select("entity", "date", "signal_score", "rank", "direction")


@query("score_fusion", """
    SELECT entity, CAST(date AS VARCHAR) AS date, round(c, 8) + 0.0 AS combined, round(greatest(1, least(5, abs(c) * 5)), 8) AS leverage, CASE WHEN c > 0 THEN 'LONG' WHEN c < 0 THEN 'SHORT' ELSE 'FLAT' END AS side
    FROM (SELECT entity, date, 0.7::DOUBLE * CASE WHEN abs(signal_score) < 0.0195 THEN 0 ELSE greatest(-1, least(1, signal_score / 0.0975)) END + 0.3::DOUBLE * coalesce(round(market_index / 100.0, 2), 0) AS c
          FROM (SELECT entity, date, round(discount - 0.05, 6) + 0.0 AS signal_score FROM v_daily_bars) LEFT JOIN v_market_index USING (date))""")
def _(v):
    rows = v.signals.join(v.market_index, "date", "left")
    price = M.threshold_normalise("signal_score", F.lit(0.0195))
    rows = rows.withColumn("c", M.fuse_scores(price, F.round(F.col("market_index") / 100.0, 2)))
    return rows.select("entity", "date", F.round("c", 8).alias("combined"), F.round(M.leverage("c"), 8).alias("leverage"), M.side_name("c").alias("side"))


@query("top_features", """
    SELECT entity, CAST(date AS VARCHAR) AS date, array_to_string([x[2] FOR x IN list_slice(list_reverse_sort([(round(close, 2), 'close'), (round(high, 2), 'high'), (round(low, 2), 'low'), (round(volume, 2), 'volume')]), 1, 3)], '|') AS features FROM v_daily_bars""")
def _(v):
    rows = v.daily_bars.withColumns({c: F.round(c, 2) for c in ("close", "high", "low", "volume")})
    top = S.top_features(["close", "high", "low", "volume"], ["close", "high", "low", "volume"], 3)
    return rows.select("entity", "date", F.transform(top, lambda p: p["feature"]).alias("features"))


@query("label_encoding", "SELECT CAST(label_3d AS BIGINT) AS label, CAST(label_3d + 1 AS BIGINT) AS cls, count(*) AS n FROM v_signals WHERE label_3d IS NOT NULL GROUP BY ALL")
def _(v):
    rows = v.signals.filter("label_3d is not null").withColumn("cls", S.encode_label("label_3d"))
    return rows.groupBy(S.decode_label("cls").alias("label"), "cls").agg(F.count(F.lit(1)).alias("n"))


@query("latest_signal", "SELECT entity, CAST(date AS VARCHAR) AS date, signal_score FROM v_signals WHERE entity = 's05' ORDER BY date DESC LIMIT 1")
def _(v):
    from newsmill.plans.reports import latest_signal
    return latest_signal(v.signals.select("entity", "date", "signal_score"), "s05")


@query("signal_ranking", "SELECT entity, CAST(date AS VARCHAR) AS date, signal_score FROM v_signals WHERE date = (SELECT max(date) FROM v_signals) ORDER BY signal_score DESC, entity LIMIT 20")
def _(v):
    from newsmill.plans.reports import latest_rows
    return top_k(latest_rows(v.signals.select("entity", "date", "signal_score")), [F.desc("signal_score"), "entity"], 20)


# ---- models (rows only) --------------------------------------------------------------------------

def _lexicon():
    """A stand-in scoring model, loaded once per task."""
    def score(texts):
        out = []
        for t in texts:
            pos, neg = t.count("e") + 1, t.count("o") + 1
            total = pos + neg + 2
            out.append((pos / total, neg / total, 2 / total))
        return out
    return score


@query("score_batches", """
    WITH t AS (SELECT id, CASE WHEN trim(body) = '' THEN 'neutral market news' ELSE body END AS t FROM v_articles),
    x AS (SELECT id, substr(t, i * 2000 + 1, 2000) AS t FROM (SELECT id, t, unnest(range(0, (length(t) + 1999) // 2000)) AS i FROM t)),
    c AS (SELECT id, length(t) AS w, length(t) - length(replace(t, 'e', '')) + 1 AS p, length(t) - length(replace(t, 'o', '')) + 1 AS n FROM x)
    SELECT id, round(sum(w * p / (p + n + 2)) / sum(w), 6) AS pos, round(sum(w * n / (p + n + 2)) / sum(w), 6) AS neg, round(sum(w * 2 / (p + n + 2)) / sum(w), 6) AS neu
    FROM c GROUP BY id""")
def _(v):
    """Whole articles in pieces the model can read."""
    from newsmill.functions.text import model_text
    out = S.score_texts(v.articles.select("id", model_text("body").alias("text")), _lexicon, "text", "id")
    return out.select("id", *[F.round(c, 6).alias(c) for c in ("pos", "neg", "neu")])


@query("fit_direction_model")
def _(v):
    """Fit on the label table and score every row."""
    rows = v.daily_bars.join(v.signals.select("entity", "date", "signal_score", "label_3d"), ["entity", "date"])
    features = ["discount", "volume", "market_cap", "signal_score"]
    model = S.fit_direction_model(rows, features, "label_3d", kind="logistic")
    return S.predict_direction(model, rows, features, ["entity", "date"])


def _weekly_folds(span):
    """Weekly folds, as far past the end as test days lie before their anchor, so that the last days are scored too."""
    return matrix.walkforward_folds(matrix.weekly_anchors(span.select("start", F.date_add("end", 27).alias("end"))), "1990-01-01")


WALK_FEATURES = ["discount", "volume", "market_cap", "signal_score"]
WEEKLY_SQL = """
    SELECT anchor, role, date_from, date_to FROM (SELECT anchor, unnest([
        {'role': 'train', 'date_from': DATE '1990-01-01', 'date_to': anchor - 49}, {'role': 'val', 'date_from': anchor - 48, 'date_to': anchor - 28},
        {'role': 'test', 'date_from': anchor - 27, 'date_to': anchor - 14}], recursive := true) FROM (
        SELECT CAST(unnest(generate_series(CAST(s - CAST(dayofweek(s) AS INT) AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS anchor
        FROM (SELECT min(date) AS s, max(date) + 27 AS e FROM wf_raw)))"""


@query("walkforward_model", walkforward.walkforward_sql(
    "SELECT b.date, b.discount, b.volume, b.market_cap, s.signal_score, s.label_3d, s.forward_ret_3d FROM v_daily_bars b JOIN v_signals s ON s.entity = b.entity AND s.date = b.date",
    WALK_FEATURES, "label_3d", "forward_ret_3d", WEEKLY_SQL))
def _(v):
    """A fold every week: fit on all earlier train rows, score the fold's validation and test rows, report accuracy and linear IC."""
    rows = v.daily_bars.join(v.signals.select("entity", "date", "signal_score", "label_3d", "forward_ret_3d"), ["entity", "date"])
    span = rows.agg(F.min("date").alias("start"), F.max("date").alias("end"))
    scored = walkforward.walkforward_scores(rows, _weekly_folds(span), WALK_FEATURES, "label_3d", ["entity", "date", "label_3d", "forward_ret_3d"], ("val", "test"))
    return walkforward.fold_report(scored, "label_3d", "forward_ret_3d")

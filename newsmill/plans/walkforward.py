"""Walk-forward models over every fold at once, from sufficient statistics.

A linear model of class indicators needs only sums of products of its inputs.  They are added up once per day and carried
forward over the calendar, so the train rows of a fold are the difference of two running sums and every anchor
costs one small solve, however long its train span is.  No row is copied per anchor but into the folds it is scored in."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from newsmill.plans.evaluate import pearson_ic
from newsmill.plans.market import DAY
from newsmill.plans.matrix import assign_folds
from newsmill.session import materialize

CLASSES = (-1, 0, 1)
RIDGE = 1e-3           # added to the unit diagonal of the correlation matrix
HELD_BYTES = 32 << 20  # day sums a task holds before it sends them on


def _known(col: str):
    """The value as a double; NaN and infinities count as missing."""
    x = F.col(col).cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def feature_scale(rows: DataFrame, features: list) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every feature over all rows (0 and 1 where unknown or constant): products of scaled values keep their digits."""
    stats = rows.agg(*[f(_known(c)).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([stats[f"m{i}"] or 0.0 for i in range(len(features))])
    std = np.array([stats[f"s{i}"] or 0.0 for i in range(len(features))])
    return mean, np.where(std > 0, std, 1.0)


def _width(features: list) -> int:
    return 2 * len(features) + len(CLASSES)


def day_moments(rows: DataFrame, features: list, label: str, scale: tuple, day: str = DAY) -> DataFrame:
    """(day, pos, value): sums of products of labelled rows per day.  A row is the vector of its scaled features (missing: 0), of
    their presence and of its class; ``pos`` numbers the upper triangle of the products of that vector with itself.

    Each task multiplies matrices per day; sums of tasks are added by Spark."""
    mean, std = scale
    d, upper = len(features), np.triu_indices(_width(features))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            days = np.repeat(np.fromiter(held, np.int32, len(held)), len(upper[0]))
            value = np.concatenate([m[upper] for m in held.values()])
            pos = np.tile(np.arange(len(upper[0]), dtype=np.int32), len(held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(days), pa.array(pos), pa.array(value)], ["day", "pos", "value"])

        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns[2:]], 1)
            there = ~np.isnan(x)
            y = b.column(1).to_numpy(zero_copy_only=False)
            v = np.concatenate([np.where(there, (x - mean) / std, 0.0), there, y[:, None] == np.array(CLASSES)], 1, dtype=float)
            days = b.column(0).to_numpy(zero_copy_only=False)
            order = np.argsort(days, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], np.diff(days[order]) != 0, [True]]))
            for lo, hi in zip(edges, edges[1:]):
                own = v[order[lo:hi]]
                held[int(days[order[lo]])] = held.get(int(days[order[lo]]), 0) + own.T @ own
            if len(held) * 8 * _width(features) ** 2 > HELD_BYTES:
                yield flush()
        if held:
            yield flush()

    known = rows.filter(F.col(label).isin(*CLASSES) & F.col(day).isNotNull())
    sums = known.select(F.unix_date(F.col(day)).alias("day"), F.col(label).cast("int"), *[_known(c).alias(f"x{i}") for i, c in enumerate(features)])
    return sums.mapInArrow(run, "day int, pos int, value double").groupBy("day", "pos").agg(F.sum("value").alias("value"))


def fold_moments(moments: DataFrame, folds: DataFrame, n_pos: int, role: str = "train") -> DataFrame:
    """(anchor, moments): the sums over the days of each fold's span, as an array by ``pos``.

    Span ends are rows among the day sums of every ``pos``; a running sum over the days, per ``pos``, gives them what is up to their day."""
    spans = folds.filter((F.col("role") == role) & (F.col("date_from") <= F.col("date_to")))
    ends = spans.select("anchor", F.explode(F.array(F.struct(F.unix_date("date_to").alias("day"), F.lit(1).alias("sign")),
                                                    F.struct((F.unix_date("date_from") - 1).alias("day"), F.lit(-1).alias("sign")))).alias("end"))
    ends = ends.select("anchor", "end.*", F.explode(F.sequence(F.lit(0), F.lit(n_pos - 1))).alias("pos"))
    no_anchor = F.lit(None).cast(folds.schema["anchor"].dataType)
    events = (moments.select("pos", "day", F.lit(0).alias("sign"), no_anchor.alias("anchor"), "value")
              .unionByName(ends.select("pos", "day", "sign", "anchor", F.lit(0.0).alias("value"))))
    upto = F.sum("value").over(W.partitionBy("pos").orderBy("day").rangeBetween(W.unboundedPreceding, 0))
    sums = events.withColumn("upto", upto).filter("sign <> 0").groupBy("anchor", "pos").agg(F.sum(F.col("upto") * F.col("sign")).alias("value"))
    return sums.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "value"))), lambda p: p["value"]).alias("moments"))


def solve(products: np.ndarray, d: int, scale: tuple, ridge: float = RIDGE) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Train rows, classes seen, means that stand for missing features, and per class the weights (constant first) of a ridge regression of
    the class indicators on standardised features, in the features' own units."""
    u, b, y = slice(0, d), slice(d, 2 * d), slice(2 * d, None)
    counts = np.rint(np.diag(products)[y])
    n = counts.sum()
    there = np.diag(products[b, b])
    mean = np.divide(np.diag(products[u, b]), there, out=np.zeros(d), where=there > 0.5)
    cross = products[u, b]  # sums of a feature over the rows that have another
    centred = products[u, u] - mean[:, None] * cross.T - cross * mean[None, :] + np.outer(mean, mean) * products[b, b]
    spread = np.sqrt(np.maximum(np.diag(centred), 0) / n)
    flat = spread < 1e-9
    spread[flat] = 1.0
    to_class = products[u, y] - mean[:, None] * products[b, y]
    system = centred / n / np.outer(spread, spread)
    system[flat], system[:, flat] = 0.0, 0.0
    np.fill_diagonal(system, np.where(flat, 1.0, np.diag(system)) + ridge)
    weights = np.linalg.solve(system, np.where(flat[:, None], 0.0, to_class / n / spread[:, None])) / spread[:, None]
    own_mean, own_weights = scale[0] + scale[1] * mean, weights / scale[1][:, None]
    constant = counts / n - own_mean @ own_weights
    return int(n), int((counts > 0).sum()), own_mean, np.concatenate([constant[None], own_weights]).T


def fit_folds(rows: DataFrame, folds: DataFrame, features: list, label: str, day: str = DAY, ridge: float = RIDGE,
              least_classes: int = len(CLASSES)) -> DataFrame:
    """(anchor, train_rows, means, weights): the model of every anchor whose labelled train rows have ``least_classes`` classes.

    Missing features count as the train mean.  ``weights`` has one array per class -1, 0, 1: a constant and a weight per feature."""
    scale = feature_scale(rows, features)
    d, width = len(features), _width(features)
    upper = np.triu_indices(width)
    sums = fold_moments(day_moments(rows, features, label, scale, day), folds, len(upper[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, found = [], []
            for i, values in enumerate(b.column(1).to_pylist()):
                products = np.zeros((width, width))
                products[upper] = values
                products = products + np.triu(products, 1).T
                if np.rint(np.diag(products)[2 * d:]).sum() > 0:
                    fit = solve(products, d, scale, ridge)
                    if fit[1] >= least_classes:
                        keep.append(i)
                        found.append(fit)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[2].tolist() for f in found], pa.list_(pa.float64())),
                                              pa.array([f[3].tolist() for f in found], pa.list_(pa.list_(pa.float64())))],
                                             ["anchor", "train_rows", "means", "weights"])

    kind = folds.schema["anchor"].dataType.simpleString()
    return sums.mapInArrow(run, f"anchor {kind}, train_rows long, means array<double>, weights array<array<double>>")


def class_scores(features: list, means: str = "means", weights: str = "weights") -> dict:
    """p_sell, p_hold, p_buy: linear scores of the classes, none below 0, adding up to 1."""
    x = F.zip_with(F.array(*[_known(c) for c in features]), F.col(means), lambda own, mean: F.coalesce(own, mean))
    raw = [F.aggregate(F.zip_with(x, F.slice(w, 2, len(features)), lambda a, b: a * b), w[0], lambda acc, v: acc + v)
           for w in (F.col(weights)[i] for i in range(len(CLASSES)))]
    cut = [F.greatest(s, F.lit(0.0)) for s in raw]
    total = sum(cut[1:], cut[0])
    return {n: c / total for n, c in zip(("p_sell", "p_hold", "p_buy"), cut)}


def walkforward_scores(rows: DataFrame, folds: DataFrame, features: list, label: str, keys: list, roles=("test",), day: str = DAY,
                       ridge: float = RIDGE, least_classes: int = len(CLASSES)) -> DataFrame:
    """(anchor, role, train_rows, keys, p_sell, p_hold, p_buy): out-of-sample scores of the fold's rows by the model of its anchor.

    ``rows`` is written once, as it is read for the scale, the sums and the scores.  Rows meet their folds by day and the models, one row an anchor, by anchor.
    Anchors whose train rows lack a class, as early ones do, give no rows."""
    held = materialize(rows.select(*dict.fromkeys([*keys, day, label, *features])))
    fits = materialize(fit_folds(held, folds, features, label, day, ridge, least_classes))
    scored = assign_folds(held.withColumnRenamed(day, DAY), folds.filter(F.col("role").isin(*roles))).withColumnRenamed(DAY, day).join(fits, "anchor")
    return scored.withColumns(class_scores(features)).select("anchor", "role", "train_rows", *keys, "p_sell", "p_hold", "p_buy")


def fold_report(scored: DataFrame, label: str, ret: str, by=("anchor", "role")) -> DataFrame:
    """Per fold: train rows, scored rows, accuracy of the likeliest class over labelled rows, and the linear correlation of p_buy - p_sell with
    the return.  ``label`` and ``ret`` are among the keys of ``scored``."""
    best = F.when((F.col("p_buy") >= F.col("p_hold")) & (F.col("p_buy") >= F.col("p_sell")), 1).when(F.col("p_hold") >= F.col("p_sell"), 0).otherwise(-1)
    rows = scored.withColumn("__lean", F.col("p_buy") - F.col("p_sell"))
    counts = rows.groupBy(*by).agg(F.first("train_rows").alias("train_rows"), F.count(F.lit(1)).alias("scored"),
                                   F.round(F.avg((best == F.col(label)).cast("double")), 4).alias("accuracy"))
    return counts.join(pearson_ic(rows, "__lean", ret, list(by)).drop("n"), list(by), "left")


def walkforward_sql(source: str, features: list, label: str, ret: str, folds: str, least: int = 11) -> str:
    """CTEs wf_... and the report of :func:`fold_report`, for checks on small tables without missing features: ``source`` and ``folds`` are
    statements for the rows (date, features, label, ret) and the folds (anchor, role, date_from, date_to)."""
    d = len(features)
    xs = [f"x{i}" for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    cell = lambda i, j: f"a{min(i, j)}_{max(i, j)}"
    sums = ["count(*) AS n", *[f"count(*) FILTER (WHERE y = {c}) AS n{k}" for k, c in enumerate(CLASSES)], *[f"sum({x}) AS s{i}" for i, x in enumerate(xs)],
            *[f"sum(x{i} * x{j}) AS {cell(i, j)}" for i, j in pairs],
            *[f"coalesce(sum(x{i}) FILTER (WHERE y = {c}), 0) AS t{i}_{k}" for i in range(d) for k, c in enumerate(CLASSES)]]
    names = [s.rsplit(" AS ", 1)[1] for s in sums]
    steps = []
    # standardised system with a full matrix m and right sides r, solved by elimination
    spread = lambda i: f"sqrt(greatest({cell(i, i)} - s{i} * s{i} / n, 0) / n)"
    flat = lambda i: f"({spread(i)} < 1e-9)"
    sd = lambda i: f"CASE WHEN {flat(i)} THEN 1 ELSE {spread(i)} END"
    start = ["anchor", "n", *[f"n{k} / n AS c{k}" for k in range(3)], *[f"s{i} / n AS m{i}" for i in range(d)], *[f"{sd(i)} AS d{i}" for i in range(d)]]
    for i in range(d):
        for j in range(d):
            value = f"({cell(i, j)} - s{i} * s{j} / n) / n / ({sd(i)}) / ({sd(j)})"
            start.append(f"CASE WHEN {flat(i)} OR {flat(j)} THEN {1.0 if i == j else 0.0} ELSE {value} END + {RIDGE if i == j else 0.0} AS g0_{i}_{j}")
        start += [f"CASE WHEN {flat(i)} THEN 0 ELSE (t{i}_{k} - s{i} * n{k} / n) / n / ({sd(i)}) END AS h0_{i}_{k}" for k in range(3)]
    keep = ["anchor", "n", *[f"c{k}" for k in range(3)], *[f"m{i}" for i in range(d)], *[f"d{i}" for i in range(d)]]
    steps.append(f"wf_e0 AS MATERIALIZED (SELECT {', '.join(start)} FROM wf_train WHERE n0 > 0 AND n1 > 0 AND n2 > 0)")
    for p in range(d):
        cols = list(keep)
        for i in range(d):
            for kind, size in (("g", d), ("h", 3)):
                for j in range(size):
                    pivot = f"{kind}{p}_{p}_{j} / g{p}_{p}_{p}"
                    cols.append(f"{pivot} AS {kind}{p + 1}_{i}_{j}" if i == p else f"{kind}{p}_{i}_{j} - g{p}_{i}_{p} * ({pivot}) AS {kind}{p + 1}_{i}_{j}")
        steps.append(f"wf_e{p + 1} AS MATERIALIZED (SELECT {', '.join(cols)} FROM wf_e{p})")
    score = [f"greatest(c{k} + {' + '.join(f'h{d}_{i}_{k} * (x{i} - m{i}) / d{i}' for i in range(d))}, 0) AS q{k}" for k in range(3)]
    return f"""WITH wf_raw AS MATERIALIZED ({source}),
    wf_stat AS (SELECT {', '.join(f"avg({c}) AS mu{i}, stddev_pop({c}) AS sg{i}" for i, c in enumerate(features))} FROM wf_raw),
    wf_rows AS MATERIALIZED (SELECT date, {label} AS y, {ret} AS ret, {', '.join(f"({c} - mu{i}) / CASE WHEN sg{i} > 0 THEN sg{i} ELSE 1 END AS x{i}" for i, c in enumerate(features))}
        FROM wf_raw, wf_stat),
    wf_folds AS MATERIALIZED ({folds}),
    wf_day AS MATERIALIZED (SELECT date, {', '.join(sums)} FROM wf_rows WHERE y IS NOT NULL GROUP BY date),
    wf_train AS MATERIALIZED (SELECT anchor, {', '.join(f"sum({n}) AS {n}" for n in names)} FROM wf_folds JOIN wf_day ON date BETWEEN date_from AND date_to
        WHERE role = 'train' GROUP BY anchor),
    {", ".join(steps)},
    wf_scored AS (SELECT f.anchor, f.role, e.n, y, ret, {', '.join(score)} FROM wf_folds f JOIN wf_e{d} e ON e.anchor = f.anchor
        JOIN wf_rows r ON r.date BETWEEN f.date_from AND f.date_to WHERE f.role <> 'train'),
    wf_lean AS (SELECT *, (q2 - q0) / (q0 + q1 + q2) AS lean, CASE WHEN q2 >= q1 AND q2 >= q0 THEN 1 WHEN q1 >= q0 THEN 0 ELSE -1 END AS best FROM wf_scored)
    SELECT CAST(anchor AS VARCHAR) AS anchor, role, CAST(max(n) AS BIGINT) AS train_rows, count(*) AS scored, round(avg(CAST(best = y AS INT)), 4) AS accuracy,
        CASE WHEN count(ret) >= {least} AND stddev_pop(lean) FILTER (WHERE ret IS NOT NULL) > 0 AND stddev_pop(ret) > 0
            THEN round(covar_pop(lean, ret) / (stddev_pop(lean) FILTER (WHERE ret IS NOT NULL) * stddev_pop(ret)), 4) + 0.0 END AS pearson_ic
    FROM wf_lean GROUP BY ALL"""

"""Feature matrices: many (entity, day) tables joined on one key, and walk-forward folds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from newsmill.operators.keys import latest_per_key_day
from newsmill.plans.market import DAY, time_range


@dataclass
class FeatureTable:
    """A feature source.  ``frame=None`` stands for a table that does not exist: its columns become nulls."""

    frame: DataFrame | None
    cols: list
    ts: str = "ts"
    market_wide: bool = False
    order: tuple = ()  # further columns, largest first, that decide between rows of one time


def with_columns_or_null(df: DataFrame, keys: list, cols: list) -> DataFrame:
    """Keys plus the requested columns; columns the table lacks are null doubles."""
    have = set(df.columns)
    return df.select(*keys, *[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in cols])


def feature_matrix(anchor: DataFrame, tables: list[FeatureTable], entity="entity") -> DataFrame:
    """Left-join every feature table to the anchor on (entity, day); market-wide tables join on the day.

    Each side is reduced to its newest row per key first, which both prevents fan-out and leaves it
    hash-partitioned on the join key: the anchor is shuffled once for all of the joins."""
    out = anchor
    for table in tables:
        if table.frame is None:
            out = out.withColumns({c: F.lit(None).cast("double") for c in table.cols})
            continue
        if table.market_wide:
            side = table.frame.withColumn(DAY, F.to_date(table.ts)).groupBy(DAY).agg(
                *[F.max_by(c, F.struct(table.ts, *table.order)).alias(c) for c in table.cols])
            out = out.join(side, DAY, "left")
        else:
            side = with_columns_or_null(table.frame, [entity, table.ts, *[c for c in table.order if c not in table.cols]], table.cols)
            # without an order of its own a table's values decide, so reruns agree
            ties = [F.desc(c) for c in table.order or table.cols]
            side = latest_per_key_day(side, entity, table.ts, ties).select(entity, DAY, *table.cols)
            out = out.join(side, [entity, DAY], "left")
    return out


def _newest(tables: dict, keys: list):
    """One row a key: the newest row of every table as a struct column, null where it has none.

    The tables become one union in which each fills its own column, so that a single aggregate, with partial maxima in
    the map tasks, and a single exchange replace a join per table."""
    parts = []
    for name, (frame, ts, order, cols) in tables.items():
        have = set(frame.columns)
        value = F.struct(*[F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in cols])
        # without an order of its own a table's values decide, so reruns agree
        ties = [c for c in order or cols if c in have]
        parts.append(frame.select(*keys, F.struct(F.struct(ts, *ties).alias("by"), value.alias("value")).alias(name)))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return union.groupBy(*keys).agg(*[F.max_by(F.col(n)["value"], F.col(n)["by"]).alias(n) for n in tables])


def union_matrix(anchor: FeatureTable, tables: list[FeatureTable], entity="entity") -> DataFrame:
    """The (entity, day) rows of ``anchor`` with the columns of all ``tables``: same rows as :func:`feature_matrix` on the anchor's newest rows.

    However many tables there are, entity tables cost one exchange on (entity, day) in all, and market-wide ones one on the day; the day table,
    a row a day, is joined last.  A table's columns are null where it has no row; a table without a frame gives nulls only."""
    def rows(table: FeatureTable, keys: list):
        frame = table.frame.withColumn(DAY, F.to_date(table.ts))
        return frame, table.ts, table.order, table.cols

    by_entity = {"_0": rows(anchor, [entity, DAY])}
    by_day: dict = {}
    for i, table in enumerate(tables, 1):
        if table.frame is not None:
            (by_day if table.market_wide else by_entity)[f"_{i}"] = rows(table, [DAY] if table.market_wide else [entity, DAY])
    out = _newest(by_entity, [entity, DAY]).filter(F.col("_0").isNotNull())
    if by_day:
        out = out.join(_newest(by_day, [DAY]), DAY, "left")
    cols = [F.col(entity), F.col(DAY), *[F.col("_0")[c].alias(c) for c in anchor.cols]]
    for i, table in enumerate(tables, 1):
        cols += [F.lit(None).cast("double").alias(c) if table.frame is None else F.col(f"_{i}")[c].alias(c) for c in table.cols]
    return out.select(*cols)


def training_matrix(labels: DataFrame, tables: list[FeatureTable], universe: DataFrame | None = None,
                    entity="entity") -> DataFrame:
    """Label-anchored matrix, optionally restricted to a universe."""
    rows = labels if universe is None else labels.join(universe.select(entity), entity, "left_semi")
    return feature_matrix(rows, tables, entity)


def inference_matrix(anchor: FeatureTable, tables: list[FeatureTable], entity="entity") -> DataFrame:
    """Feature-anchored matrix without labels."""
    rows = latest_per_key_day(anchor.frame.select(entity, anchor.ts, *anchor.cols), entity, anchor.ts).drop(anchor.ts)
    return feature_matrix(rows, tables, entity)


def date_scaffold(bars: DataFrame, start=None, end=None, entity="entity", ts="ts") -> DataFrame:
    """Distinct (entity, day) of the bars in a date range."""
    return time_range(bars, ts, start, end).select(entity, F.to_date(ts).alias(DAY)).distinct()


def null_report(matrix: DataFrame, features: list) -> DataFrame:
    """Per cent of nulls per feature and its bucket, from one pass over the matrix."""
    wide = matrix.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in features])
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.round(F.col(c) * 100, 4).alias("null_pct")) for c in features
    ])).alias("r")).select("r.*")
    bucket = F.when(F.col("null_pct") > 50, "sparse").when(F.col("null_pct") > 5, "partial").otherwise("filled")
    return long.withColumn("bucket", bucket)


def split_dates(anchor, floor=None, train_days: int | None = None) -> dict:
    """Column expressions of one walk-forward split seen from ``anchor``: a 14-day test ending 14 days
    earlier, 21 days of validation before it, training up to the day before that."""
    a = F.col(anchor) if isinstance(anchor, str) else anchor
    train_to = F.date_sub(a, 14 + 13 + 1 + 20 + 1)
    start = F.lit(floor).cast("date")
    if train_days:
        start = F.greatest(F.date_sub(train_to, train_days), start)
    return {
        "train_from": start, "train_to": train_to,
        "val_from": F.date_sub(a, 14 + 13 + 1 + 20), "val_to": F.date_sub(a, 14 + 13 + 1),
        "test_from": F.date_sub(a, 14 + 13), "test_to": F.date_sub(a, 14),
    }


def weekly_anchors(span: DataFrame, start="start", end="end") -> DataFrame:
    """Sundays covering [start, end]; the first lies on or before start.  ``span`` is a one-row frame."""
    first = F.date_sub(F.col(start), F.dayofweek(start) - 1)
    return span.select(F.explode(F.sequence(first, F.col(end), F.expr("INTERVAL 7 DAYS"))).alias("anchor"))


def walkforward_folds(anchors: DataFrame, floor, train_months: int | None = None) -> DataFrame:
    """One row per (anchor, role) with its date range."""
    d = split_dates("anchor", floor, train_months * 30 if train_months else None)
    roles = F.array(*[
        F.struct(F.lit(r).alias("role"), d[f"{r}_from"].alias("date_from"), d[f"{r}_to"].alias("date_to"))
        for r in ("train", "val", "test")
    ])
    return anchors.select("anchor", F.inline(roles))


def assign_folds(matrix: DataFrame, folds: DataFrame) -> DataFrame:
    """Matrix rows per (anchor, role).  Fold ranges are expanded to days (a calendar-sized table), so this is
    an equi-join on the day."""
    days = folds.filter("date_from <= date_to").select(
        "anchor", "role", F.explode(F.sequence("date_from", "date_to")).alias(DAY))
    return matrix.join(days, DAY)

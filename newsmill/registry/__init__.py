"""Registered queries: each runs a library operator over the driver tables, most with an independent SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from newsmill.registry.views import Views, with_views
from newsmill.session import apply_runtime_conf

QUERIES: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(views) -> DataFrame`` and its oracle SQL (views are spliced in as CTEs)."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, with_views(sql) if sql else None)
        return fn
    return register


def present(df: DataFrame) -> DataFrame:
    """Plain result types: dates and times as text, flags and integers as bigint, floats as double."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        out.append(c.alias(f.name))
    return df.select(*out)


def load() -> None:
    """Import the query modules once."""
    from newsmill.registry import articles, evaluation, io, ledger, market, matrices, streams  # noqa: F401


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = QUERIES[name][0]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return present(fn(Views(spark, sf_dir)))

    run.__name__ = name
    run.__doc__ = fn.__doc__
    return run

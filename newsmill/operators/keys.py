"""Key-based relational operators: newest row per key and day, deduplication, set comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def _cols(names) -> list:
    return [F.col(n) if isinstance(n, str) else n for n in ([names] if isinstance(names, (str, Column)) else names)]


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Keep the first row of every key by ``order``.

    The ``row_number() = 1`` filter is planned with a partial WindowGroupLimit, so each map task ships at
    most one row per key and a key holding a large share of the rows does not overload one reducer."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = W.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def first_per_nonnull_key(df: DataFrame, keys, order) -> DataFrame:
    """As :func:`first_per_key`; rows with a null key never collide and are all kept."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return first_per_key(df.filter(known), keys, order).unionByName(df.filter(~known))


def latest_per_key_day(df: DataFrame, entity="entity", ts="ts", tie_break=()) -> DataFrame:
    """One row per (entity, day): the newest.  Adds ``date`` once so later joins share its partitioning."""
    return first_per_key(
        df.withColumn("date", F.to_date(ts)), [entity, "date"], [F.desc(ts), *_cols(tie_break)]
    )


def top_per_group(df: DataFrame, group, order, n: int, rank_name: str = "rank") -> DataFrame:
    """First n rows of every group (partial top-n per map task through WindowGroupLimit)."""
    group = [group] if isinstance(group, str) else list(group)
    w = W.partitionBy(*group).orderBy(*_cols(order))
    return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= n)


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    return df.orderBy(*_cols(order)).limit(k)


def exclude_values(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(~F.col(col).isin(values))


def exclude_with_counts(df: DataFrame, col: str, values: list) -> DataFrame:
    """kept / removed row counts of :func:`exclude_values` in one pass."""
    hit = F.col(col).isin(values)
    return df.agg(F.count_if(~hit).alias("kept"), F.count_if(hit).alias("removed"))


def within_hours(df: DataFrame, ts: str, hours: int, now: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    return df.filter(F.col(ts) >= now - F.expr(f"INTERVAL {hours} HOURS"))


def window_filter(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Inclusive time range."""
    return df.filter(F.col(ts).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def unprocessed(df: DataFrame, done: DataFrame, key: str, done_key: str, version: str,
                version_col: str = "model_version") -> DataFrame:
    """Rows whose key has no entry of this version yet (NOT EXISTS)."""
    seen = done.filter(F.col(version_col) == version).select(F.col(done_key).alias(key)).distinct()
    return df.join(seen, key, "left_anti")


def oldest_batch(df: DataFrame, order, n: int) -> DataFrame:
    """Work unit: the n oldest rows."""
    return df.orderBy(*_cols(order)).limit(n)


def key_set_comparison(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row per key with in_left / in_right; aggregated on map side before the single shuffle."""
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return tagged.groupBy(key).agg((F.max("l") == 1).alias("in_left"), (F.max("r") == 1).alias("in_right"))


def key_set_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Counts of common / one-sided keys and the share of left keys found on the right."""
    flags = key_set_comparison(left, right, key)
    both = F.count_if(F.col("in_left") & F.col("in_right"))
    n_left = F.count_if("in_left")
    return flags.agg(
        both.alias("in_both"),
        F.count_if(F.col("in_left") & ~F.col("in_right")).alias("only_left"),
        F.count_if(~F.col("in_left") & F.col("in_right")).alias("only_right"),
        F.round(F.coalesce(F.try_divide(100.0 * both, n_left), F.lit(0.0)), 4).alias("coverage_pct"),
    )


def duplicate_groups(df: DataFrame, keys) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).filter("duplicate_count > 1")


def duplicate_pairs(df: DataFrame, key: str, id_: str, cols: list) -> DataFrame:
    """Pairs (first row of a key, every further row of it): n - 1 pairs connect all n duplicates.

    Listing every pair would be quadratic in the largest group and says no more.  The first row comes from a
    partial aggregate; joining it back is a plain equi-join that AQE splits when one key is hot."""
    first = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.min_by(F.struct(F.col(id_).alias("id1"), *[F.col(c).alias(f"{c}1") for c in cols]), id_).alias("f"),
        F.count(F.lit(1)).alias("n")).filter("n > 1").select(key, "f.*")
    rest = df.select(key, F.col(id_).alias("id2"), *[F.col(c).alias(f"{c}2") for c in cols])
    return rest.join(first, key).filter("id1 < id2")


def duplicate_members(df: DataFrame, key: str, id_: str) -> DataFrame:
    """Each duplicated row with its group's first id and size."""
    groups = df.groupBy(key).agg(F.min(id_).alias("first_id"), F.count(F.lit(1)).alias("group_size"))
    return df.join(groups.filter("group_size > 1"), key)


def missing_hours(df: DataFrame, ts: str, until: Column | None = None) -> DataFrame:
    """Hours of the observed range in which no row falls."""
    hour = F.date_trunc("hour", ts)
    present = df.filter(F.col(ts).isNotNull()).select(hour.alias("hour")).distinct()
    span = df.agg(
        F.date_trunc("hour", F.min(ts)).alias("lo"),
        (F.date_trunc("hour", F.max(ts)) if until is None else F.date_trunc("hour", until)).alias("hi"),
    )
    expected = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    return expected.join(present, "hour", "left_anti")

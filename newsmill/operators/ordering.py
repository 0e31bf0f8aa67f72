"""Ranks and running totals.

Two regimes.  Inside one day's cross-section (at most one row per entity) plain windows are used.  Over a
whole table the order is cut into blocks at quantile bounds; each block is ordered on its own and the few
block totals are carried forward, so no task ever sees the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from newsmill.session import materialize

ROWS_PER_BLOCK, LEAST_BLOCKS = 2_000_000, 16


def pct_rank(x, *group) -> Column:
    """Average-tie rank divided by the number of non-null values of the group (null stays null)."""
    x = F.col(x) if isinstance(x, str) else x
    return avg_rank(x, *group) / F.count(x).over(W.partitionBy(*group))


def avg_rank(x, *group) -> Column:
    """Mean of the first and the last position of a value's ties; both share one partitioning and sort."""
    x = F.col(x) if isinstance(x, str) else x
    w = W.partitionBy(*group).orderBy(x.asc_nulls_last())
    upto = F.count(x).over(w.rangeBetween(W.unboundedPreceding, 0))
    return F.when(x.isNotNull(), (F.rank().over(w) + upto) / 2.0)


def block_count(df: DataFrame, rows_per_block: int | None = None) -> int:
    """Blocks for a materialised table: as many as its rows need."""
    return max(LEAST_BLOCKS, -(-df.count() // (rows_per_block or ROWS_PER_BLOCK)))


def quantile_bounds(df: DataFrame, *cols: str, blocks: int) -> list[list]:
    """Block bounds per numeric column.  They become literals of the plan, so every branch and every
    retried task cuts the rows identically; ``blocks - 1`` numbers per column, one for a few million rows, reach the driver."""
    steps = [i / blocks for i in range(1, blocks)]
    row = df.agg(*[F.percentile_approx(c, steps, 10 * blocks).alias(c) for c in cols]).first()
    return [sorted(set(row[c] or [])) for c in cols]


def block_of(x, bounds: list) -> Column:
    """Even numbers lie strictly between two bounds, odd numbers are rows equal to a bound: a heavily
    repeated value always has a block of its own, and nulls have the first."""
    x = F.col(x) if isinstance(x, str) else x
    if not bounds:
        return F.when(x.isNull(), -1).otherwise(0)
    cuts = F.array(*[F.lit(b) for b in bounds])
    below = F.size(F.filter(cuts, lambda b: b < x))
    return F.when(x.isNull(), -1).otherwise(below * 2 + F.array_contains(cuts, x).cast("int"))


def order_blocks(df: DataFrame, first: str, second: str | None = None, name: str = "block", rows_per_block: int | None = None) -> DataFrame:
    """Add a block number that follows the order (first, second).  Rows equal to a bound of ``first`` are
    cut further along ``second``, so one hot value of ``first`` is spread as well.

    Blocks grow in number with the rows.  The rows are materialised first: choosing the bounds and the branches that follow share one run of
    everything upstream."""
    df = materialize(df)
    blocks = block_count(df, rows_per_block)
    bounds = quantile_bounds(df, *[c for c in (first, second) if c], blocks=blocks)
    block = block_of(first, bounds[0])
    if second and bounds[1]:
        sub = F.when(block % 2 != 0, block_of(second, bounds[1])).otherwise(F.lit(0))
        block = block * (2 * len(bounds[1]) + 1) + sub
    return df.withColumn(name, block)


def carry_forward(blocks: DataFrame, name: str, sums: dict) -> DataFrame:
    """Totals of all earlier blocks.  ``blocks`` has one row per block (a few thousand at most)."""
    before = W.orderBy(name).rowsBetween(W.unboundedPreceding, -1)
    return blocks.select(name, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(out) for c, out in sums.items()])


def running_sums(df: DataFrame, first: str, second: str | None, sums: dict, block: str = "__block") -> DataFrame:
    """Whole-table running totals in the order (first, second); ``sums`` maps input -> output column."""
    cut = order_blocks(df, first, second, block)
    totals = cut.groupBy(block).agg(*[F.sum(c).alias(c) for c in sums])
    offsets = carry_forward(totals, block, {c: f"__before_{c}" for c in sums})
    within = W.partitionBy(block).orderBy(*[c for c in (first, second) if c]).rowsBetween(W.unboundedPreceding, 0)
    out = cut.join(offsets, block)
    for c, name in sums.items():
        out = out.withColumn(name, F.col(f"__before_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0)))
    return out.drop(block, *[f"__before_{c}" for c in sums])


def value_ranks(df: DataFrame, x: str, block: str = "__block") -> DataFrame:
    """Average-tie rank of every distinct non-null value of a whole column.

    Returns (x, n, rank, centred): equal values are counted before the first shuffle; ``centred`` is the
    rank minus the mean rank."""
    counts = df.filter(F.col(x).isNotNull()).groupBy(x).agg(F.count(F.lit(1)).alias("n"))
    return ranks_of_counts(order_blocks(counts, x, None, block), x, block)


def ranks_of_counts(cut: DataFrame, x: str, block: str, group: list | None = None) -> DataFrame:
    """As :func:`value_ranks`, from (group.., x, n, block) rows with one row per value of each group."""
    group = group or []
    totals = cut.groupBy(*group, block).agg(F.sum("n").alias("m"))
    before = W.partitionBy(*group).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *group, block, F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"),
        F.sum("m").over(W.partitionBy(*group)).alias("total"),
    )
    upto = F.sum("n").over(W.partitionBy(*group, block).orderBy(x).rowsBetween(W.unboundedPreceding, 0))
    rank = F.col("before") + upto - F.col("n") + (F.col("n") + 1) / 2.0
    return (
        cut.join(offsets, [*group, block])
        .withColumn("rank", rank)
        .select(*group, x, "n", "rank", (F.col("rank") - (F.col("total") + 1) / 2.0).alias("centred"))
    )

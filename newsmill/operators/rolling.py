"""Rolling statistics over row frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from newsmill.functions.market import clip


LONG_FRAME = 128  # frames of more rows are put together from two running statistics


class Rolling:
    """Statistics of one keyed, ordered series over frames ``[lo, hi]`` (row offsets, ``lo <= hi <= 0``).

    Short frames are plain aggregates over sliding row frames, which cost their length per row.  A long frame that :meth:`prepare` was told of costs
    the same whatever its length: the series is cut into chunks as long as the frame, running statistics go forward and backward
    through each chunk, and a frame is the end of one chunk (what is behind its first row) merged with the beginning of the next (what is before its last row).
    Means, squared deviations and products are merged by the formulas for two samples.  Either way a frame sees its own rows only, so a
    NaN or a change of level is gone once it has left the frame.  All statistics share one partitioning.  Nulls are ignored."""

    def __init__(self, df: DataFrame, by, order):
        self.by = [by] if isinstance(by, str) else list(by)
        self.order = [order] if isinstance(order, str) else list(order)
        self.w = W.partitionBy(*self.by).orderBy(*self.order)
        self.df = df
        self._singles: dict[int, list] = {}
        self._pairs: dict[int, list] = {}
        self._past: dict[int, bool] = {}

    def position(self, name: str = "position") -> "Rolling":
        self.df = self.df.withColumn(name, F.row_number().over(self.w) - 1)
        return self

    def prepare(self, n: int, cols=(), pairs=(), past: bool = False) -> "Rolling":
        """Make the running statistics that frames of ``n`` rows of ``cols``, and of the pairs of columns ``pairs``, are put together from, and the two parts of
        the frame that ends with each row (with ``past``, also of the one that ends before it); other frames look theirs up per use.  Frames of up to LONG_FRAME rows need none."""
        if n <= LONG_FRAME or n in self._singles:
            return self
        chunk, row, first, last = f"__chunk{n}", f"__row{n}", f"__before{n}", f"__behind{n}"
        df = self.df.withColumn(row, F.row_number().over(self.w)).withColumn(chunk, F.floor((F.col(row) - 1) / F.lit(n)))
        for name, order in ((first, F.col(row)), (last, F.desc(row))):
            run = W.partitionBy(*self.by, chunk).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
            fields = [F.col(chunk).alias("chunk")]
            for i, c in enumerate(cols):
                k = F.count(c).over(run)
                fields += [k.alias(f"n{i}"), F.avg(c).over(run).alias(f"m{i}"), (F.var_pop(c).over(run) * k).alias(f"q{i}"),
                           F.min(c).over(run).alias(f"lo{i}"), F.max(c).over(run).alias(f"hi{i}")]
            for i, (a, b) in enumerate(pairs):
                both = F.col(a).isNotNull() & F.col(b).isNotNull()
                k = F.count(F.when(both, 1)).over(run)
                fields += [k.alias(f"pn{i}"), F.avg(F.when(both, F.col(a))).over(run).alias(f"pa{i}"), F.avg(F.when(both, F.col(b))).over(run).alias(f"pb{i}"),
                           (F.covar_pop(a, b).over(run) * k).alias(f"pc{i}")]
            df = df.withColumn(name, F.struct(*fields))
        looked = {f"__head{n}": F.lag(last, n - 1).over(self.w)}
        if past:
            looked |= {f"__pasttail{n}": F.lag(first, 1).over(self.w), f"__pasthead{n}": F.lag(last, n).over(self.w)}
        self.df = df.withColumns(looked)
        self._singles[n], self._pairs[n], self._past[n] = list(cols), list(pairs), past
        return self

    def drop_prepared(self) -> DataFrame:
        """The series without the columns of :meth:`prepare`."""
        return self.df.drop(*[f"__{p}{n}" for n in self._singles for p in ("chunk", "row", "before", "behind", "head", "pasttail", "pasthead")])

    def _ends(self, n: int, lo: int, hi: int) -> tuple[Column, Column]:
        """Statistics of the frame's rows in the chunk of its last row, and of those in the chunk before (null if none)."""
        before, behind = F.col(f"__before{n}"), F.col(f"__behind{n}")
        if hi == 0:
            tail, head = before, F.col(f"__head{n}")
        elif hi == -1 and self._past[n]:
            tail, head = F.col(f"__pasttail{n}"), F.col(f"__pasthead{n}")
        else:
            tail, head = F.lag(before, -hi).over(self.w), F.lag(behind, -lo).over(self.w)
        return tail, F.when(head["chunk"] < tail["chunk"], head)

    def _merged(self, name: str, lo: int, hi: int, *keys: str):
        """Per key the two values to merge, of a prepared column; None for a frame that is none."""
        n = hi - lo + 1
        if name not in self._singles.get(n, []):
            return None
        tail, head = self._ends(n, lo, hi)
        i = self._singles[n].index(name)
        return [(tail[f"{k}{i}"], head[f"{k}{i}"]) for k in keys]

    def _over(self, value: Column, lo: int, hi: int) -> Column:
        return value.over(self.w.rowsBetween(lo, hi))

    def count(self, n: str, lo: int, hi: int = 0) -> Column:
        ends = self._merged(n, lo, hi, "n")
        return self._over(F.count(n), lo, hi) if ends is None else _plus(*ends[0])

    def sum(self, n: str, lo: int, hi: int = 0) -> Column:
        ends = self._merged(n, lo, hi, "n", "m")
        if ends is None:
            return F.coalesce(self._over(F.sum(n), lo, hi), F.lit(0.0))
        return F.coalesce(_mean(*ends) * _plus(*ends[0]), F.lit(0.0))

    def mean(self, n: str, lo: int, hi: int = 0) -> Column:
        ends = self._merged(n, lo, hi, "n", "m")
        return self._over(F.avg(n), lo, hi) if ends is None else _mean(*ends)

    def flat(self, n: str, lo: int, hi: int = 0) -> Column:
        """True when all non-null values of the frame are equal, or there are none."""
        ends = self._merged(n, lo, hi, "lo", "hi")
        low, high = (F.least(*ends[0]), F.greatest(*ends[1])) if ends else (self._over(F.min(n), lo, hi), self._over(F.max(n), lo, hi))
        return F.coalesce(low == high, F.lit(True))

    def variance(self, n: str, lo: int, hi: int = 0) -> Column:
        """Sample variance; exactly 0 for a flat frame, null below two values."""
        k = self.count(n, lo, hi)
        ends = self._merged(n, lo, hi, "n", "m", "q")
        var = self._over(F.var_samp(n), lo, hi) if ends is None else _products(ends[0], ends[1], ends[1], ends[2]) / (k - 1)
        return F.when(k >= 2, F.when(self.flat(n, lo, hi), 0.0).otherwise(var))

    def std(self, n: str, lo: int, hi: int = 0) -> Column:
        return F.sqrt(self.variance(n, lo, hi))

    def covariance(self, a: str, b: str, lo: int, hi: int = 0) -> Column:
        """Sample covariance of the rows where neither is null; null below two."""
        n = hi - lo + 1
        if (a, b) not in self._pairs.get(n, []):
            return self._over(F.covar_samp(a, b), lo, hi)
        tail, head = self._ends(n, lo, hi)
        i = self._pairs[n].index((a, b))
        count, left, right, products = ((tail[f"{k}{i}"], head[f"{k}{i}"]) for k in ("pn", "pa", "pb", "pc"))
        k = _plus(*count)
        return F.when(k >= 2, _products(count, left, right, products) / (k - 1))


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def _mean(count: tuple, mean: tuple) -> Column:
    """Mean of two samples; null without values."""
    both = (mean[0] + (mean[1] - mean[0]) * (count[1] / (count[0] + count[1])))
    return F.when(mean[0].isNull(), mean[1]).when(mean[1].isNull(), mean[0]).otherwise(both)


def _products(count: tuple, left: tuple, right: tuple, products: tuple) -> Column:
    """Sum of products of deviations of two samples."""
    apart = (left[1] - left[0]) * (right[1] - right[0]) * (count[0] * (count[1] / (count[0] + count[1])))
    return F.when(products[0].isNull(), products[1]).when(products[1].isNull(), products[0]).otherwise(products[0] + products[1] + apart)


def lag_value(col: str, by, order, k: int = 1) -> Column:
    return F.lag(col, k).over(W.partitionBy(by).orderBy(order))


def full_window(fn, col: str, by, order, n: int) -> Column:
    """``fn`` over the last n rows, null until n non-null values are there (short frames)."""
    w = W.partitionBy(by).orderBy(order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(col).over(w) == n, fn(col).over(w))


def sequence_window(df: DataFrame, cols: list, n: int, by: str, order: str, exclude_current: bool = False,
                    out: str = "sequence") -> DataFrame:
    """Last n rows of ``cols`` as an array of arrays (nulls -> 0); only full windows are emitted."""
    step = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    frame = (-n, -1) if exclude_current else (-(n - 1), 0)
    w = W.partitionBy(by).orderBy(order).rowsBetween(*frame)
    return df.withColumn(out, F.collect_list(step).over(w)).filter(F.size(out) == n)


def channel_normalise(df: DataFrame, cols: list, by: str, limit: float = 10.0) -> DataFrame:
    """(x - mean) / population std over the whole series of each key, clipped; flat series give 0.

    Moments are aggregated per key first (map-side partial sums) and joined back."""
    stats = df.groupBy(by).agg(
        *[f(c).alias(f"__{p}_{c}") for c in cols for p, f in (("m", F.avg), ("d", F.stddev_pop))]
    )
    out = df.join(stats, by)
    for c in cols:
        z = F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__d_{c}"))
        out = out.withColumn(c, F.coalesce(clip(z, -limit, limit), F.lit(0.0)))
    return out.drop(*[f"__{p}_{c}" for c in cols for p in ("m", "d")])

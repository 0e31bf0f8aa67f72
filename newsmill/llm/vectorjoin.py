"""Near-duplicate vectors by cosine: a pigeonhole join of two sides, in rounds.

Unit vectors at cosine >= c differ by a squared distance of at most 2 - 2 c.  After a seeded rotation the coordinates
are cut into low-dimensional blocks, and a vector deals that budget to its blocks: what is within the whole budget is
within the budget of one block at least.  The vectors are cut into chunks, and a task compares one chunk with some others.
It puts its own chunk into the cells of a grid in every block; a visitor meets the cells within its budget of the block.
A small chunk is one cell of one block, as then the cells cost more than they spare.  What is met is filtered by a part of the coordinates in single precision and verified with all components in double
precision.  A pair is counted in the first block whose cells it meets in.

Every vector meets every chunk, so the chunks are dealt in rounds of about 1.5 times the size of all vectors.  The files of a round's
shuffle go when it is done, so the disk holds the vectors a few times, however many rounds there are."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsmill.llm.graph import components
from newsmill.session import freed_shuffles, materialize, scratch_path

BLOCKS, GRID_DIMS, FILTER_DIMS, SEED = 8, 8, 20, 20240611
SIDE_BYTES, ROUND_BYTES, PIECE_BYTES = 64_000_000, 256_000_000, 16_000
GRID_ROWS, CELL_ROWS, VISITORS, PRODUCT, PAIRS, LINKED = 60_000, 64, 65_536, 400_000, 100_000, 200_000
SLACK = 1e-5  # of squared distances in single precision


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed + dim)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Subspaces:
    """Rotation and the whole squared distance of a pair for one dimension."""

    def __init__(self, dim: int, cosine: float):
        self.turn = rotation(dim)
        self.whole = max(0.0, 2 - 2 * cosine)

    def blocks(self, rows: int) -> list[slice]:
        """The coordinates of every block, for so many residents."""
        n = min(BLOCKS, len(self.turn)) if rows >= GRID_ROWS else 1
        cuts = np.linspace(0, len(self.turn), n + 1).astype(int)
        return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]

    def units(self, vectors: np.ndarray) -> np.ndarray:
        """Turned unit vectors in single precision, some thousand at a time."""
        out = np.empty(vectors.shape, np.float32)
        for lo in range(0, len(vectors), 8192):
            v = vectors[lo:lo + 8192].astype(np.float64)
            out[lo:lo + 8192] = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ self.turn
        return out


def usable(vectors: str):
    """Not null, no null or non-finite component, not zero, and not so small or large that its norm is."""
    v = F.col(vectors).cast("array<double>")
    square = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    return F.coalesce(F.forall(v, lambda x: x.isNotNull()) & (square > 0) & (square < float("inf")), F.lit(False))


class _Unit:
    """What a task compares: chunk ``own`` of the vectors of one dimension with the chunks ``first`` to ``last`` - 1, or itself among them."""

    def __init__(self, dim: int, own: int, first: int, last: int, size: float):
        self.dim, self.own, self.first, self.last = dim, own, first, last
        self.itself = first == own
        self.size = size * (1 + last - first - self.itself)


def _rounds(sizes: dict[int, int], item: int, tile: int | None) -> tuple[dict[int, int], list[list[_Unit]]]:
    """Number of chunks of every dimension, and the units of every round."""
    weigh = lambda dim: dim * item + 16
    limit = max(ROUND_BYTES, 1.5 * sum(n * weigh(dim) for dim, n in sizes.items()))
    chunks, rounds, held = {}, [], limit
    for dim, n in sorted(sizes.items()):
        if n < 2:
            continue
        chunks[dim] = k = max(1, -(-n // (tile or max(1, SIDE_BYTES // (dim * item)))), min(8, n // 2000))
        step = 1 if k <= 8 else 2
        for own, at in ((own, at) for own in range(k) for at in range(own, k, step)):
            unit = _Unit(dim, own, at, min(at + step, k), weigh(dim) * n / k)
            if held + unit.size > limit:
                rounds.append([])
                held = 0
            rounds[-1].append(unit)
            held += unit.size
    return chunks, rounds


def _deal(chunks: dict[int, int], units: list[_Unit], kind: type):
    """Send the vectors of each chunk to the units that compare it, as residents (role 0) or visitors (1), some to a row."""
    sends: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i, u in enumerate(units):
        sends.setdefault((u.dim, u.own), []).append((i, 0))
        for c in range(u.first, u.last):
            if c != u.own:
                sends.setdefault((u.dim, c), []).append((i, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            for dim, parts in waiting.items():
                own, rep, copies, vectors = (np.concatenate(p) for p in zip(*parts))
                order = np.argsort(own, kind="stable")
                cuts = np.searchsorted(own[order], np.arange(chunks[dim] + 1))
                step = max(1, PIECE_BYTES // (vectors.itemsize * dim + 16))
                for c in range(chunks[dim]):
                    pieces = [order[at:min(at + step, cuts[c + 1])] for at in range(cuts[c], cuts[c + 1], step)]
                    raw = pa.array([rep[p].tobytes() + copies[p].tobytes() + vectors[p].tobytes() for p in pieces], pa.binary())
                    for unit, role in sends.get((dim, c), []) if pieces else []:
                        full = lambda v: pa.array(np.full(len(pieces), v, np.int32))
                        yield pa.RecordBatch.from_arrays([full(unit), full(role), raw], ["unit", "role", "vectors"])
            waiting.clear()

        for b in batches:
            column = b.column(2)
            dims = column.value_lengths().to_numpy()
            for dim in np.unique(dims).tolist():
                if dim in chunks:
                    at = np.flatnonzero(dims == dim)
                    rep, copies = b.column(0).to_numpy()[at], b.column(1).to_numpy()[at]
                    own = (rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(chunks[dim])
                    mine = np.isin(own, np.array([c for d, c in sends if d == dim], np.uint64))
                    if not mine.any():
                        continue
                    vectors = column.take(pa.array(at[mine])).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(kind)
                    waiting.setdefault(dim, []).append((own[mine], rep[mine], copies[mine], vectors))
                    held += vectors.nbytes
            if held > 16_000_000:
                yield from out()
                held = 0
        yield from out()
    return run


class _Forest:
    """Union-find over the vectors of one unit."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, a: int) -> int:
        while self.up.setdefault(a, a) != a:
            self.up[a] = a = self.up[self.up[a]]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def join_all(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join many pairs; those of one tree already go first."""
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        roots = np.array([self.root(n) for n in nodes.tolist()])[at]
        a, b = roots[:len(a)], roots[len(a):]
        for x, y in np.unique(np.stack([a, b], 1)[a != b], axis=0).tolist():
            self.join(x, y)


class _Side:
    """Vectors of one side of a comparison."""

    def __init__(self, space: Subspaces, rep: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        self.rep, self.copies, self.vectors = rep, copies, vectors
        self.units = space.units(vectors)

    def slice(self, lo: int, hi: int) -> _Side:
        part = object.__new__(_Side)
        part.rep, part.copies, part.vectors, part.units = (x[lo:hi] for x in (self.rep, self.copies, self.vectors, self.units))
        return part

    def exact(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors in double precision and their norms."""
        v = self.vectors[at].astype(np.float64)
        return v, np.sqrt((v * v).sum(1))


def _away(x: np.ndarray, low, high) -> np.ndarray:
    """Squared distance of coordinates to intervals."""
    d = np.maximum(np.maximum(low - x, x - high), np.float32(0))
    return d * d


class _Grid:
    """The residents of a unit in the cells of one block.

    A cell is a part of every one of the first coordinates of the block; the parts follow the residents' quantiles, and there
    are as many as leave about CELL_ROWS residents to a cell.  Cells are numbered by their place in the first half of these
    coordinates, then by that in the second."""

    def __init__(self, units: np.ndarray, block: slice):
        self.cols = list(range(block.start, min(block.stop, block.start + GRID_DIMS)))
        parts = [1] * len(self.cols)
        while len(units) >= GRID_ROWS and min(parts) < 64 and np.prod(parts) * (min(parts) + 1) / min(parts) <= len(units) / CELL_ROWS:
            parts[parts.index(min(parts))] += 1
        ends = np.float32(np.inf)
        self.edges, self.part = [], np.zeros((len(self.cols), len(units)), np.uint8)
        for j, (col, p) in enumerate(zip(self.cols, parts)):
            x = units[:, col]
            inner = np.sort(x)[np.arange(1, p) * len(x) // p]
            self.edges.append(np.concatenate([[-ends], inner, [ends]]).astype(np.float32))
            self.part[j] = np.searchsorted(inner, x, "right")
        self.halves = [range(0, -(-len(parts) // 2)), range(-(-len(parts) // 2), len(parts))]
        self.places = [list(product(*(range(parts[j]) for j in half))) for half in self.halves]
        cell = np.zeros(len(units), np.int64)
        for j, p in enumerate(parts):
            cell = cell * p + self.part[j]
        self.order = np.argsort(cell, kind="stable").astype(np.int32)
        self.starts = np.searchsorted(cell[self.order], np.arange(np.prod(parts) + 1))

    def tables(self, units: np.ndarray) -> list[np.ndarray]:
        """Squared distances of visitors to the places of each half, one row a place."""
        out = []
        for half, places in zip(self.halves, self.places):
            near = {j: [_away(units[:, self.cols[j]], self.edges[j][p], self.edges[j][p + 1]) for p in range(len(self.edges[j]) - 1)] for j in half}
            table = np.zeros((len(places), len(units)), np.float32)
            for row, place in zip(table, places):
                for j, p in zip(half, place):
                    row += near[j][p]
            out.append(table)
        return out

    def met(self, units: np.ndarray, visitor: np.ndarray, resident: np.ndarray, budget: np.ndarray) -> np.ndarray:
        """Whether pairs meet here; the same sums in the same order as in the tables."""
        sums = []
        for half in self.halves:
            total = np.zeros(len(visitor), np.float32)
            for j in half:
                p = self.part[j][resident]
                total += _away(units[visitor, self.cols[j]], self.edges[j][p], self.edges[j][p + 1])
            sums.append(total)
        return sums[1] <= budget[visitor] - sums[0]


class _Residents:
    """A chunk of vectors with the grids of all blocks."""

    def __init__(self, space: Subspaces, cosine: float, side: _Side):
        self.space, self.cosine, self.side = space, cosine, side
        self.blocks = space.blocks(len(side.rep))
        self.grids = [_Grid(side.units, b) for b in self.blocks]
        sample = side.units[:100_000]  # only where the budget is better spent follows from it
        self.mean, self.scale = sample.mean(0), np.maximum(sample.std(0), 1e-6)
        self.product, self.low = np.empty(PRODUCT, np.float32), np.empty(PRODUCT, bool)

    def budgets(self, units: np.ndarray) -> np.ndarray:
        """A part of the whole budget for every block and visitor: more where the visitor is far out and meets few."""
        out = np.empty((len(self.blocks), len(units)), np.float64)
        for row, s in zip(out, self.blocks):
            far = (((units[:, s] - self.mean[s]) / self.scale[s]) ** 2).sum(1) / max(4, s.stop - s.start - 2)
            row[:] = np.exp(np.minimum(far, 8)) * (s.stop - s.start)
        return (self.space.whole * out / out.sum(0) + SLACK).astype(np.float32)

    def compare(self, visitors: _Side, first: int | None, add) -> None:
        """Pass the pairs at ``cosine`` to ``add``.  Where the visitors are residents, ``first`` is the number of the first
        and only pairs with residents before them count."""
        units, mine, dim = visitors.units, self.side.units, self.side.units.shape[1]
        budget = self.budgets(units)
        for block, grid in enumerate(self.grids):
            cols = (self.blocks[block].start + np.arange(min(dim, FILTER_DIMS))) % dim
            a, b = units.take(cols, 1), mine.take(cols, 1).take(grid.order, 0)
            limit = np.float32(self.space.whole + SLACK)
            # squared distance less the limit as one product
            a = np.ascontiguousarray(np.concatenate([-2 * a, (a * a).sum(1, keepdims=True) - limit, np.ones((len(a), 1), np.float32)], 1))
            b = np.ascontiguousarray(np.concatenate([b, np.ones((len(b), 1), np.float32), (b * b).sum(1, keepdims=True)], 1))
            left, right = grid.tables(units)
            starts, wait, held = grid.starts.tolist(), [], 0
            for i in range(len(left)):
                if starts[i * len(right)] == starts[(i + 1) * len(right)]:
                    continue
                near = np.flatnonzero(left[i] <= budget[block])
                touch = right[:, near] <= budget[block][near] - left[i][near]
                for j in range(len(right)):
                    lo, hi = starts[i * len(right) + j], starts[i * len(right) + j + 1]
                    if lo < hi:
                        for x, y in self._within(a, b, near.take(touch[j].nonzero()[0]), lo, hi):
                            wait.append((x, grid.order[y]))
                            held += len(x)
                            if held >= PAIRS:
                                self._verify(visitors, block, budget, first, wait, add)
                                held = 0
            self._verify(visitors, block, budget, first, wait, add)

    def _within(self, a: np.ndarray, b: np.ndarray, at: np.ndarray, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of the visitors ``at`` and the residents from ``lo`` to ``hi`` that the filter leaves, by products that fit the cache."""
        for left in range(lo, hi, 1024):
            width = min(left + 1024, hi) - left
            step = PRODUCT // width
            for go in range(0, len(at), step):
                some = at[go:go + step]
                n = len(some) * width
                np.matmul(a.take(some, 0, mode="clip"), b[left:left + width].T, out=self.product[:n].reshape(-1, width))
                hit = np.less_equal(self.product[:n], 0, out=self.low[:n]).nonzero()[0]
                if len(hit):
                    x, y = np.divmod(hit, width)
                    yield some[x], left + y

    def _verify(self, visitors: _Side, block: int, budget: np.ndarray, first: int | None, wait: list, add) -> None:
        pairs = [np.concatenate(p) for p in zip(*wait)] if wait else [np.zeros(0, int)] * 2
        wait.clear()
        for at in range(0, len(pairs[0]), PAIRS):
            x, y = (p[at:at + PAIRS] for p in pairs)
            if first is not None:
                x, y = x[y < x + first], y[y < x + first]
            for earlier in range(block):
                new = ~self.grids[earlier].met(visitors.units, x, y, budget[earlier])
                x, y = x[new], y[new]
            (v, nv), (w, nw) = visitors.exact(x), self.side.exact(y)
            good = (v * w).sum(1) / (nv * nw) >= self.cosine
            if good.any():
                add(visitors, self.side, x[good], y[good])


def _join(cosine: float, units: list[_Unit], kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by unit, residents first: residents are held, visitors pass some ten thousand at a time."""
        spaces: dict[int, Subspaces] = {}
        unit, rows, residents, links, forest, ready = None, [[], []], None, {}, _Forest(), []

        def add(a: _Side, b: _Side, x: np.ndarray, y: np.ndarray) -> None:
            for side, at, other, to in ((a, x, b, y), (b, y, a, x)):
                own, place = np.unique(at, return_inverse=True)
                n = np.zeros(len(own), np.int64)
                np.add.at(n, place, other.copies[to])
                for r, k in zip(side.rep[own].tolist(), n.tolist()):
                    links[r] = links.get(r, 0) + k
            forest.join_all(a.rep[x], b.rep[y])
            if len(links) > LINKED:
                end()

        def side(role: int) -> _Side:
            dim = units[unit].dim
            n = [len(r) // (dim * np.dtype(kind).itemsize + 16) for r in rows[role]]
            cut = [(np.frombuffer(r, np.int64, 2 * k).reshape(2, k), np.frombuffer(r, kind, offset=16 * k).reshape(k, dim)) for r, k in zip(rows[role], n)]
            rows[role].clear()
            (rep, copies), vectors = np.concatenate([c[0] for c in cut], 1), np.concatenate([c[1] for c in cut])
            if dim not in spaces:
                spaces[dim] = Subspaces(dim, cosine)
            return _Side(spaces[dim], rep, copies, vectors)

        def pass_by(all_came: bool) -> None:
            nonlocal residents
            if residents is None and rows[0]:
                own = side(0)
                residents = _Residents(spaces[units[unit].dim], cosine, own)
                if units[unit].itself:
                    for lo in range(0, len(own.rep), VISITORS):
                        residents.compare(own.slice(lo, lo + VISITORS), lo, add)
            if rows[1] and residents is not None:
                residents.compare(side(1), None, add)
            if all_came:
                residents = None
                rows[1].clear()

        def end() -> None:
            """Links so far; what is found later begins new trees, and the roots join them."""
            reps = list(links)
            ready.append(pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array([links[r] for r in reps], pa.int64()),
                                                     pa.array([forest.root(r) for r in reps], pa.int64())], ["rep", "links", "root"]))
            links.clear()
            forest.up.clear()

        held = 0
        for b in batches:
            for now, role, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if now != unit or held > VISITORS * (units[now].dim * np.dtype(kind).itemsize + 16):
                    pass_by(now != unit)
                    held = 0
                if now != unit and links:
                    end()
                yield from ready
                ready.clear()
                unit = now
                rows[role].append(raw)
                held += len(raw) * role
        pass_by(True)
        if links:
            end()
        yield from ready
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, key: str = "vec_id", column: str = "embedding", tile: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``.

    n_links counts the other vectors at cosine >= ``cosine`` (double precision, all components); component_id is the
    smallest vec_id reachable by links; kept means it is its own component_id.  Equal vectors are compared once and
    count with their number; they are told by two 64-bit hashes.  Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing, and so do vectors of different lengths.  Repeated rows are vectors of their own, linked with each other;
    null ids are never the smallest of a component that has others.  Other columns are ignored; an empty table gives an
    empty result.

    ``vectors`` is read twice, so pass a stored table.  A task holds one chunk (``tile`` vectors, at most SIDE_BYTES unless
    given) and passes visitors by.  A round's shuffle has 1.5 times the bytes of all vectors at most (ROUND_BYTES
    if that is more, and one unit at least)."""
    spark = vectors.sparkSession
    with freed_shuffles(spark):
        usual = vectors.select(F.col(key).alias("vec_id"), F.when(usable(column), F.col(column)).alias("v"))
        kind = np.float32 if usual.schema["v"].dataType.elementType.simpleString() == "float" else np.float64
        usual = usual.withColumn("v", F.col("v").cast("array<float>" if kind is np.float32 else "array<double>"))
        usual = usual.withColumns({f"h{i}": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(i), "v")) for i in range(2)})
        rows = materialize(usual.drop("v"))
        # the group's number: unique, though several groups may have one smallest vec_id
        groups = materialize(usual.where("v IS NOT NULL").groupBy("h0", "h1").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.any_value("v").alias("v"))
                             .withColumn("rep", F.monotonically_increasing_id()))
        reps = groups.select("rep", "copies", "v")
        sizes = {r["dim"]: r["count"] for r in reps.groupBy(F.size("v").alias("dim")).count().collect()}
        chunks, rounds = _rounds(sizes, np.dtype(kind).itemsize, tile)
        schema, store = "rep long, links long, root long", scratch_path(spark, "links")
        for units in rounds:
            dealt = reps.mapInArrow(_deal(chunks, units, kind), "unit int, role int, vectors binary")
            dealt = dealt.repartition(4 * len(units), "unit").sortWithinPartitions("unit", "role")
            dealt.mapInArrow(_join(cosine, units, kind), schema).write.mode("append").parquet(store)
        found = spark.read.schema(schema).parquet(store) if rounds else spark.createDataFrame([], schema)
        counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
        marked = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")), "u", "v")
        named = (groups.drop("v").join(counts, "rep", "left").join(marked.withColumnRenamed("node", "rep"), "rep", "left")
                 .withColumn("component", F.coalesce("component", "rep")))
        least = named.groupBy("component").agg(F.min("least").alias("component_id"))
        named = materialize(named.join(least, "component").select(F.col("h0").alias("_h0"), F.col("h1").alias("_h1"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    out = rows.select("vec_id", "h0", "h1").join(named, (F.col("h0") == F.col("_h0")) & (F.col("h1") == F.col("_h1")), "left")
    component = F.when(F.col("_h0").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

"""Vector code compression: product codes over integer vectors, with exact nearest entries by slicing and intersecting.

A vector's components become integers, the vector is cut into parts, and every part is replaced by the index of the nearest
entry of its position's codebook.  For the search the coordinates of a codebook are sorted in every dimension, and each
position of that order carries the mask of all entries before it.  The distance to one entry that is near in the widest
dimension is the initial radius; in each dimension the entries within the radius are a range of the order, so two prefix masks
give them, and the masks of all dimensions ANDed leave the candidates.  No entry within the radius is missing from them.

Codebooks (parts x entries x dimensions integers) are all that the driver and the tasks hold; sums over vectors are made by
Spark from one partial sum a task."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
MAX_ENTRIES = 256  # two hexadecimal digits an index
Codebooks = list[np.ndarray]  # one (entries, dimensions) array of int64 a part


class Slices:
    """The codebook of one part, sorted by dimension, with prefix masks of 64 entries a word."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, dims = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, 0).T.copy()
        self.order = order.T
        self.prefix = np.zeros((dims, n + 1, -(-n // 64)), np.uint64)
        for j in range(dims):
            for i, e in enumerate(self.order[j]):
                self.prefix[j, i + 1] = self.prefix[j, i]
                self.prefix[j, i + 1, e // 64] |= np.uint64(1 << int(e % 64))
        self.widest = int(np.argmax(self.sorted[:, -1] - self.sorted[:, 0])) if dims else 0

    def distance(self, x: np.ndarray, entry: np.ndarray | int) -> np.ndarray:
        away = x - self.entries[entry]
        return np.einsum("ij,ij->i", away, away)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Masks (rows, words) of a set of entries that holds all nearest ones."""
        n, dims = self.entries.shape
        if not dims:
            return np.broadcast_to(np.bitwise_or.reduce(np.uint64(1) << np.arange(min(n, 64), dtype=np.uint64)), (len(x), 1))
        line = self.sorted[self.widest]
        at = np.searchsorted(line, x[:, self.widest])
        left, right = np.maximum(at - 1, 0), np.minimum(at, n - 1)
        closer = np.where(x[:, self.widest] - line[left] <= line[right] - x[:, self.widest], left, right)
        seed = self.distance(x, self.order[self.widest][closer])
        radius = np.ceil(np.sqrt(seed.astype(float))).astype(np.int64) + 1  # the float root may be short by a rounding
        mask = None
        for j in range(dims):
            lo = np.searchsorted(self.sorted[j], x[:, j] - radius, "left")
            hi = np.searchsorted(self.sorted[j], x[:, j] + radius, "right")
            inside = self.prefix[j, hi] ^ self.prefix[j, lo]
            mask = inside if mask is None else mask & inside
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every row (ties to the lower index) and its squared distance."""
        mask = self.candidates(x)
        best = np.full(len(x), np.iinfo(np.int64).max)
        index = np.zeros(len(x), np.int64)
        for e in range(len(self.entries)):
            rows = np.flatnonzero((mask[:, e // 64] >> np.uint64(e % 64)) & np.uint64(1))
            if len(rows):
                d = self.distance(x[rows], e)
                won = d < best[rows]
                best[rows[won]] = d[won]
                index[rows[won]] = e
        return index, best


def part_bounds(width: int, parts: int = PARTS) -> list[int]:
    """Where the parts begin; equal parts where ``parts`` divides the width, else they differ by one component."""
    return [p * width // parts for p in range(parts + 1)]


def _limit(width: int) -> int:
    """Largest integer a component may have so that no squared distance leaves 64 bits."""
    return isqrt(2**62 // max(width, 1)) // 2


def _integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors of one width, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)
    limit = _limit(width)
    return np.clip(np.floor(flat * scale), -limit, limit).astype(np.int64)


def clean(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def usual_width(vectors: DataFrame, vector: str = "embedding") -> int | None:
    """The most frequent length of clean vectors, the longer one in a tie; None without any."""
    rows = vectors.where(clean(F.col(vector))).groupBy(F.size(vector).alias("width")).count()
    first = rows.orderBy(F.desc("count"), F.desc("width")).first()
    return first["width"] if first else None


def fit_codebooks(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
                  rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks after ``rounds`` rounds of assignment and averaging over all clean vectors of the usual width.

    They start as the parts of the rows with the ``entries`` smallest keys (null keys last, equal keys by their vectors; fewer rows
    give fewer entries).  A round sends every part to its nearest entry, and replaces an entry by the floor of its parts' mean; an entry without parts stays.
    Each round reads ``vectors`` once, so pass a stored table.  Without clean vectors there are no codebooks."""
    if not 1 <= entries <= MAX_ENTRIES:
        raise ValueError(f"1 to {MAX_ENTRIES} entries")
    width = usual_width(vectors, vector)
    if width is None:
        return []
    rows = vectors.where(clean(F.col(vector)) & (F.size(vector) == width)).select(F.col(key).alias("id"), F.col(vector).alias("v"))
    bounds = part_bounds(width, parts)
    start = _integers(pa.array([r["v"] for r in rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()],
                               pa.list_(pa.float64())), width, scale)
    books = [start[:, a:b].copy() for a, b in zip(bounds, bounds[1:])]
    for _ in range(rounds):
        for r in part_sums(rows.select("v"), books, width, scale).collect():
            books[r["part"]][r["entry"], r["pos"]] = int(r["total"]) // r["n"]
    return books


def part_sums(rows: DataFrame, books: Codebooks, width: int, scale: int = SCALE) -> DataFrame:
    """(part, entry, pos, n, total): component sums of the parts that are nearest to each entry.  ``rows`` has the vectors in
    its only column; a task sends one row for each component of the codebooks at most."""
    bounds = part_bounds(width, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        totals, counts = [np.zeros_like(b) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            if batch.num_rows:
                x = _integers(batch.column(0), width, scale)
                for p, s in enumerate(slices):
                    own = x[:, bounds[p]:bounds[p + 1]]
                    index, _ = s.nearest(own)
                    counts[p] += np.bincount(index, minlength=len(s.entries))
                    np.add.at(totals[p], index, own)
        for p, (total, n) in enumerate(zip(totals, counts)):
            e, j = (a.ravel() for a in np.indices(total.shape))
            used = n[e] > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.full(used.sum(), p, np.int32)), pa.array(e[used].astype(np.int32)), pa.array(j[used].astype(np.int32)),
                                              pa.array(n[e][used]), pa.array(total.ravel()[used])], ["part", "entry", "pos", "n", "total"])

    sums = rows.mapInArrow(run, "part int, entry int, pos int, n long, total long")
    return sums.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def encode(vectors: DataFrame, books: Codebooks, key: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = (),
           scale: int = SCALE) -> DataFrame:
    """(key, the columns of ``keep``, code, error): the code of every clean vector, two hexadecimal digits a part, and the sum of
    its parts' squared distances to their entries.

    Vectors that are null or hold a null or a non-finite component are left out; vectors of another width than the codebooks' have neither
    code nor error.  Components beyond the integers whose squared distances fit 64 bits (about 32,000 at 64 components) count as the bound.
    Rows of one key, and equal rows, are coded each; other columns are ignored, whatever their names; an empty table gives an empty result."""
    names = [key, *keep]
    kinds = ", ".join(f"`_{i}` {vectors.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    width = sum(b.shape[1] for b in books)
    bounds = part_bounds(width, len(books)) if books else []
    digits = np.array([f"{i:02x}" for i in range(MAX_ENTRIES)], "S2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        for batch in batches:
            column = batch.column(0)
            fits = np.asarray(column.value_lengths()) == width if books else np.zeros(batch.num_rows, bool)
            x = _integers(column.filter(pa.array(fits)), width, scale)
            codes, error = np.zeros((len(x), len(slices)), np.int64), np.zeros(len(x), np.int64)
            for p, s in enumerate(slices):
                codes[:, p], d = s.nearest(x[:, bounds[p]:bounds[p + 1]])
                error += d
            code = [bytes(row).decode() for row in digits[codes]]
            place = np.full(batch.num_rows, -1)
            place[fits] = np.arange(len(x))
            take = pa.array(place, mask=~fits)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(code, pa.string()).take(take), pa.array(error).take(take)],
                                             [*(f"_{i}" for i in range(len(names))), "code", "error"])

    rows = vectors.where(clean(F.col(vector))).select(F.col(vector), *(F.col(c).alias(f"_{i}") for i, c in enumerate(names)))
    return rows.mapInArrow(run, f"{kinds}, code string, error long").toDF(*names, "code", "error")


def decode(code: str, books: Codebooks) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([b[int(code[2 * p:2 * p + 2], 16)] for p, b in enumerate(books)])


def codebook_digest(books: Codebooks) -> str:
    """Hexadecimal SHA-256 of all components by part, entry and position, in decimals joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with label_error, the sum of the errors of its label; null labels count as one label.  Partial sums leave one row a
    label, whose join Spark broadcasts by its measured size or splits where a label is hot."""
    totals = coded.groupBy(F.col(label).alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(totals, F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")


def _round_sql(i: int) -> str:
    return f"""
n{i} AS MATERIALIZED (SELECT rn, part, min(d * {ENTRIES} + entry) AS best FROM (
    SELECT x.rn, x.part, c.entry, sum(CAST(x.val - c.val AS HUGEINT) * (x.val - c.val)) AS d
    FROM x JOIN c{i} c ON x.part = c.part AND x.pos = c.pos GROUP BY x.rn, x.part, c.entry) GROUP BY rn, part),
s{i} AS (SELECT n.part, CAST(n.best % {ENTRIES} AS BIGINT) AS entry, x.pos, sum(x.val) AS total, count(*) AS n
    FROM n{i} n JOIN x ON n.rn = x.rn AND n.part = x.part GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT c.part, c.entry, c.pos,
    CASE WHEN s.n IS NULL THEN c.val ELSE CAST((s.total - ((s.total % s.n) + s.n) % s.n) / s.n AS BIGINT) END AS val
    FROM c{i} c LEFT JOIN s{i} s ON c.part = s.part AND c.entry = s.entry AND c.pos = s.pos),"""


CODES_SQL = f"""
WITH v AS MATERIALIZED (SELECT vec_id, label, embedding, len(embedding) // {PARTS} AS dims, row_number() OVER (ORDER BY vec_id NULLS LAST) AS rn FROM embeddings
    WHERE embedding IS NOT NULL AND NOT list_bool_or([false] || [x IS NULL OR NOT isfinite(x) FOR x IN embedding])),
x AS MATERIALIZED (SELECT rn, (i - 1) // dims AS part, (i - 1) % dims AS pos, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS val
    FROM (SELECT rn, dims, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM v)),
c0 AS (SELECT part, rn - 1 AS entry, pos, val FROM x WHERE rn <= {ENTRIES}),""" + "".join(_round_sql(i) for i in range(ROUNDS)) + f"""
last AS MATERIALIZED (SELECT rn, part, min(d * {ENTRIES} + entry) AS best FROM (
    SELECT x.rn, x.part, c.entry, sum(CAST(x.val - c.val AS HUGEINT) * (x.val - c.val)) AS d
    FROM x JOIN c{ROUNDS} c ON x.part = c.part AND x.pos = c.pos GROUP BY x.rn, x.part, c.entry) GROUP BY rn, part),
coded AS (SELECT rn, string_agg(printf('%02x', CAST(best % {ENTRIES} AS BIGINT)), '' ORDER BY part) AS code,
    CAST(sum((best - best % {ENTRIES}) / {ENTRIES}) AS BIGINT) AS error FROM last GROUP BY rn)
SELECT v.vec_id, coded.code, coded.error, CAST(sum(coded.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{ROUNDS}) AS codebooks_sha256
FROM v JOIN coded ON v.rn = coded.rn
"""

"""Quality classifier: ordinal regression with a cumulative link on graded ratings.

Every text is a sparse vector of hashed features; one weight vector is shared by all grades and ordered thresholds cut
its score: P(grade <= k) = sigmoid(threshold_k - w . x).  The fit uses a bounded seeded sample of the rated documents;
all documents are scored, with their expected grade and the probability of the best grades."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsmill.llm.ngramjoin import ascii_lower
from newsmill.llm.textarrays import Chunk, _BYTE_VALUE, chunks, mix

DIMENSIONS = 1 << 16
MAX_RATED = 8_000     # rated documents used for the fit, at most
SEED, STEPS, RATE, RIDGE = 5, 200, 0.05, 1e-4
KEEP_PROBABILITY = 0.7
_U = np.uint64
_MARK = np.ones(256, bool)
_MARK[97:123] = _MARK[48:58] = False
_MARK[128:] = False
_MARK[list(b" \t\n\r\x0b\x0c.,")] = False


def chunk_features(c: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature numbers, values) of every text of a lower-cased chunk: distinct words and distinct mark patterns with
    values of unit length together, and the shares of marks and repeated words in tenths."""
    words = c.word_hashes()
    marks = np.concatenate([[_U(0)], np.cumsum(np.where(_MARK[c.data], _BYTE_VALUE[c.data], _U(0)), dtype=np.uint64)])
    pattern = marks[c.word_end] - marks[c.word_start]
    pattern = np.where(pattern == 0, _U(0), mix(pattern ^ _U(0xABCDEF)))
    for i in range(c.n):
        own = words[c.word_bounds[i]:c.word_bounds[i + 1]]
        if not len(own):
            yield np.zeros(0, np.int32), np.zeros(0, np.float32)
            continue
        shapes = pattern[c.word_bounds[i]:c.word_bounds[i + 1]]
        distinct = np.unique(own)
        shape = np.unique(shapes[shapes != 0])
        shares = np.array([(shapes != 0).mean(), 1 - len(distinct) / len(own)])
        extra = mix(np.array([1, 2], np.uint64) * _U(1000) + (shares * 10).astype(np.uint64))
        at = np.concatenate([distinct, shape, extra]) % _U(DIMENSIONS)
        value = np.concatenate([np.full(len(distinct) + len(shape), 1 / np.sqrt(len(distinct) + len(shape))), np.full(2, 0.5)])
        yield at.astype(np.int32), value.astype(np.float32)


def grades(labels: DataFrame, key: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 poor, 2 good.  Rows with a null rating or key don't count; of several ratings of a
    document the lowest does."""
    g = F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).otherwise(2)
    rated = labels.where(F.col(key).isNotNull() & F.col(toxic).isNotNull() & F.col(quality).isNotNull())
    return rated.groupBy(F.col(key).alias("doc_id")).agg(F.min(g).alias("grade"))


def sample_rated(rated: DataFrame, max_rated: int = MAX_RATED, seed: int = SEED) -> DataFrame:
    """A seeded sample of at most ``max_rated`` rated documents."""
    return rated.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_rated)


def fit_ordinal(rows: np.ndarray, at: np.ndarray, value: np.ndarray, grade: np.ndarray, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by full-batch adaptive steps on the penalised likelihood.  ``rows`` numbers the text of each
    feature; thresholds stay ordered as a first value and positive differences."""
    n = len(grade)
    share = np.cumsum(np.bincount(grade, minlength=n_grades))[:-1] + 0.5
    start = np.log(share / (n + 1.0 - share))
    base, gap = start[0], np.log(np.maximum(np.diff(start), 1e-2))
    params = np.concatenate([np.zeros(DIMENSIONS), [base], gap])
    m, v = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, STEPS + 1):
        w, theta = params[:DIMENSIONS], np.concatenate([[params[DIMENSIONS]], params[DIMENSIONS] + np.cumsum(np.exp(params[DIMENSIONS + 1:]))])
        eta = np.bincount(rows, w[at] * value, minlength=n)
        upper = np.concatenate([theta, [np.inf]])[grade] - eta
        lower = np.concatenate([[-np.inf], theta])[grade] - eta
        fu, fl = np.where(np.isinf(upper), 1.0, sigmoid(upper)), np.where(np.isinf(lower), 0.0, sigmoid(lower))
        p = np.maximum(fu - fl, 1e-12)
        du, dl = fu * (1 - fu) / p, fl * (1 - fl) / p  # derivatives of log p by either threshold
        g_eta = (du - dl) / n
        g_w = np.bincount(at, g_eta[rows] * value, minlength=DIMENSIONS) + RIDGE * w
        g_theta = -(np.bincount(grade, du, minlength=n_grades)[:-1] - np.bincount(grade, dl, minlength=n_grades)[1:]) / n
        later = np.cumsum(g_theta[::-1])[::-1]
        gradient = np.concatenate([g_w, [later[0]], later[1:] * np.exp(params[DIMENSIONS + 1:])])
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        params -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return params[:DIMENSIONS].astype(np.float32), np.concatenate([[params[DIMENSIONS]], params[DIMENSIONS] + np.cumsum(np.exp(params[DIMENSIONS + 1:]))])


def fit(docs: DataFrame, labels: DataFrame, n_grades: int = 3, max_rated: int = MAX_RATED, seed: int = SEED, key: str = "doc_id",
        text: str = "text") -> DataFrame:
    """One row (weights, thresholds).  The sampled ids, at most ``max_rated``, go to the scan of the documents; the
    features of the sample meet in one task."""
    picked = F.broadcast(sample_rated(labels, max_rated, seed).withColumnRenamed("doc_id", "_rated"))
    rows = docs.join(picked, F.col(key) == F.col("_rated")).select(F.col("_rated").alias("doc_id"), "grade", F.col(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [f for c in chunks(ascii_lower(b.column(2))) for f in chunk_features(c)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([a.tobytes() for a, _ in got], pa.binary()),
                                              pa.array([v.tobytes() for _, v in got], pa.binary())], ["doc_id", "grade", "at", "value"])

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("grade", "ascending"), ("at", "ascending")])
        at = [np.frombuffer(x, np.int32) for x in table.column("at").to_pylist()]
        value = np.frombuffer(b"".join(table.column("value").to_pylist()), np.float32).astype(float)
        rows = np.repeat(np.arange(len(at)), [len(x) for x in at])
        w, theta = fit_ordinal(rows, np.concatenate(at), value, table.column("grade").to_numpy().astype(int), n_grades)
        return pa.table({"weights": pa.array([w.tobytes()], pa.binary()), "thresholds": pa.array([theta.tolist()], pa.list_(pa.float64()))})

    encoded = rows.mapInArrow(encode, f"doc_id {docs.schema[key].dataType.simpleString()}, grade int, at binary, value binary")
    return encoded.groupBy(F.lit(1).alias("one")).applyInArrow(lambda t: solve(t.select(["doc_id", "grade", "at", "value"])), "weights binary, thresholds array<double>")


def grade_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", keep: float = KEEP_PROBABILITY,
                    n_grades: int = 3, max_rated: int = MAX_RATED, seed: int = SEED) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept): one row per row of ``docs``; ``labels`` is (doc_id, grade).

    tail_probability is that of the highest grade; kept means it is at least ``keep``.  Without any rated document all
    grades are equally likely and nothing is kept.  Null, empty and blank texts have no features: their grade follows
    from the thresholds alone and they are not kept.  Repeated rows are scored alike (rated ones weigh double in the fit);
    other columns are ignored; an empty table gives an empty result."""
    model = fit(docs, labels, n_grades, max_rated, seed, key, text).first()
    weights = np.frombuffer(model["weights"], np.float32) if model else np.zeros(DIMENSIONS, np.float32)
    theta = np.array(model["thresholds"]) if model else np.log(np.arange(1, n_grades) / np.arange(n_grades - 1, 0, -1))
    sent = docs.sparkSession.sparkContext.broadcast((weights, theta))  # 256 KB, whatever the corpus
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, cuts = sent.value
        for b in batches:
            eta, some = [], []
            for c in chunks(ascii_lower(b.column(1))):
                for at, value in chunk_features(c):
                    eta.append(float(w[at].astype(float) @ value))
                    some.append(len(at) > 0)
            below = 1 / (1 + np.exp(-np.clip(cuts[None, :] - np.array(eta)[:, None], -40, 40)))
            tail = 1 - below[:, -1] if len(eta) else np.zeros(0)
            expected = (1 - below).sum(1)  # sum of P(grade > k)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(expected), pa.array(tail), pa.array((tail >= keep) & np.array(some, bool))],
                                             ["doc_id", "expected_grade", "tail_probability", "kept"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, expected_grade double, tail_probability double, kept boolean")

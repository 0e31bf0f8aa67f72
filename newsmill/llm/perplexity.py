"""Quality rules with an n-gram perplexity band per language.

The queries take whole characters as symbols and score by :mod:`newsmill.llm.ngrammodel`.  The model in this module is a
small one: UTF-8 bytes folded to 32 classes (letters without case, space, digits, sentence marks, other marks, bytes of
longer characters; lead bytes are skipped).  Spark counts the 4-grams of every whole document per language; a modified
Kneser-Ney model is estimated from the counts and stored as sorted arrays of n-gram hashes with log probabilities and
back-off weights, or as counts from which a document is left out.  A document's perplexity must lie between two bounds,
which follow from the quartiles of all documents of its language and from the measured variance of its symbols."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsmill.llm import ngrammodel
from newsmill.llm.textarrays import Chunk, chunks, mix
from newsmill.session import materialize

CLASSES, ORDER, START = 32, 4, 31
CELLS = CLASSES**ORDER
MODEL_BYTES = 64 << 20  # models handed to the workers at once; more languages are scored in further passes
COUNTS_HELD = 2_000_000  # counts a counting task holds, 16 bytes each
MIN_WORDS, MAX_REPEAT_PERCENT, FENCE, LEAST_SPREAD = 10, 20, 3.0, 0.05
BAND_ROWS = 100_000  # languages whose bands (some 40 bytes each) are broadcast at once
QUARTILE = 0.6745  # of a standard normal
_SYMBOLS = b"#*$%&|<>"


def symbol_classes() -> np.ndarray:
    """Class of every byte; 255 is skipped."""
    table = np.full(256, 29, np.uint8)
    for i in range(26):
        table[[65 + i, 97 + i]] = 1 + i
    table[[9, 10, 11, 12, 13, 32]] = 0
    table[48:58] = 27
    table[list(b".,;:!?'\"()-")] = 28
    table[128:192] = 1 + np.arange(64) * 7 % 26  # bytes of longer characters share the letter classes
    table[192:] = 255
    return table


_CLASS = symbol_classes()


def chunk_keys(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram key that ends at every symbol, with three start symbols before each text, and the bounds per text."""
    sym = _CLASS[c.data]
    used = sym != 255
    bounds = np.concatenate([[0], np.cumsum(used)])[c.bounds]
    sym = sym[used].astype(np.int32)
    shift = np.repeat(3 * np.arange(1, c.n + 1), np.diff(bounds))
    stream = np.full(len(sym) + 3 * c.n, START, np.int32)
    at = np.arange(len(sym)) + shift
    stream[at] = sym
    key = stream.copy()
    for back in range(1, ORDER):
        key[back:] |= stream[:-back] << (5 * back)
    return key[at], bounds


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[edges], np.add.reduceat(n[order], edges) if len(edges) else n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts, held as sorted pairs of (language, 4-gram) and count, COUNTS_HELD of them at most, however many languages there are."""
    names: dict[str, int] = {}
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        own = list(names)
        for lo in range(0, len(keys[0]), 100_000):
            part, n = keys[0][lo:lo + 100_000], counts[0][lo:lo + 100_000]
            langs = pa.array(own).take(pa.array(part // CELLS))
            yield pa.RecordBatch.from_arrays([langs, pa.array((part % CELLS).astype(np.int32)), pa.array(n)], ["lang", "key", "n"])
        keys.clear()
        counts.clear()
        names.clear()

    for b in batches:
        langs = b.column(0).to_pylist()
        for c in chunks(b.column(1)):
            gram, bounds = chunk_keys(c)
            which = np.array([names.setdefault(x, len(names)) for x in langs[c.first:c.first + c.n]], np.int64)
            pairs = np.repeat(which, np.diff(bounds)) * CELLS + gram
            key, n = np.unique(pairs, return_counts=True)
            keys.append(key)
            counts.append(n.astype(np.int64))
            held += len(key)
            if held > COUNTS_HELD:
                merged = _added(keys, counts)
                keys[:], counts[:] = [merged[0]], [merged[1]]
                held = len(merged[0])
                if held > COUNTS_HELD // 2:
                    yield from flush()
                    held = 0
    if keys:
        merged = _added(keys, counts)
        keys[:], counts[:] = [merged[0]], [merged[1]]
        yield from flush()


def ngram_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, key, n): counts of the 4-grams over all documents of the language; each task adds its own texts up before the shuffle."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(_count, "lang string, key int, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _discounts(a: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
    """Discount of every count in ``of`` (default: ``a``) by modified Kneser-Ney from the counts ``a``; where counts of
    counts don't allow it, 0.5, 1 and 1.5."""
    of = a if of is None else of
    n = [float((a == i).sum()) for i in range(1, 5)]
    d = [0.5, 1.0, 1.5]
    if min(n) > 0:
        y = n[0] / (n[0] + 2 * n[1])
        got = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
        if all(0 < x < i for i, x in enumerate(got, 1)):
            d = got
    return np.array([0.0, *d])[np.minimum(of, 3).astype(int)]


def ngram_hash(order: int, key: np.ndarray) -> np.ndarray:
    return mix(key.astype(np.uint64) | np.uint64(order << 40))


def adjusted_counts(keys: np.ndarray, counts: np.ndarray) -> dict[int, np.ndarray]:
    """Highest order: counts; lower orders: number of different left neighbours (n-grams that begin a text keep counts)."""
    top = np.zeros(CELLS)
    top[keys] = counts
    adjusted = {ORDER: top}
    raw = top
    for k in range(ORDER - 1, 0, -1):
        upper = adjusted[k + 1].reshape(CLASSES, -1)
        raw = raw.reshape(CLASSES, -1).sum(0)
        a = (upper > 0).sum(0).astype(float)
        if k > 1:
            first = slice(START * CLASSES**(k - 1), (START + 1) * CLASSES**(k - 1))
            a[first] = raw[first]
        adjusted[k] = a
    return adjusted


def estimate(keys: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted hash arrays of one language: hash, logp (of n-grams) and backoff (of contexts)."""
    adjusted = adjusted_counts(keys, counts)
    lower = np.full(CLASSES, 1.0 / CLASSES)
    hashes, logp, backoff = [], [], []
    for k in range(1, ORDER + 1):
        a = adjusted[k].copy().reshape(-1, CLASSES)
        a[:, START] = 0  # the start symbol is never predicted
        d = _discounts(a)
        total = a.sum(1, keepdims=True)
        gamma = np.divide(d.sum(1, keepdims=True), total, out=np.ones_like(total), where=total > 0)
        below = np.tile(lower, (len(a) // max(1, len(lower) // CLASSES), 1)) if k == 1 else np.tile(lower.reshape(-1, CLASSES), (CLASSES, 1))[:len(a)]
        p = np.divide(a - d, total, out=np.zeros_like(a), where=total > 0) + gamma * below
        seen = np.flatnonzero(a.ravel() > 0)
        hashes.append(ngram_hash(k, seen))
        logp.append(np.log(p.ravel()[seen]))
        backoff.append(np.zeros(len(seen)))
        contexts = np.flatnonzero(total.ravel() > 0)
        hashes.append(ngram_hash(k - 1 + 8, contexts))  # contexts of the next symbol: order k - 1, under numbers of their own
        logp.append(np.zeros(len(contexts)))
        backoff.append(np.log(gamma.ravel()[contexts]))
        lower = p.ravel()
    h = np.concatenate(hashes)
    order = np.argsort(h)
    return {"hash": h[order], "logp": np.concatenate(logp)[order].astype(np.float32), "backoff": np.concatenate(backoff)[order].astype(np.float32)}


def resolve(model: dict[str, np.ndarray]) -> np.ndarray:
    """log p of every possible 4-gram by lookups in the sorted arrays with back-off; 4 MB a language, whatever the corpus."""
    def find(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(model["hash"], h), len(model["hash"]) - 1)
        return at, model["hash"][at] == h

    value = np.full(CLASSES, -np.log(CLASSES), np.float32)
    for k in range(1, ORDER + 1):
        grams = np.arange(CLASSES**k)
        at, hit = find(ngram_hash(k, grams))
        ctx_at, ctx_hit = find(ngram_hash(k - 1 + 8, np.arange(CLASSES**(k - 1))))
        weight = np.where(ctx_hit, model["backoff"][ctx_at], np.float32(0))
        below = np.tile(value, CLASSES) if k > 1 else value
        value = np.where(hit, model["logp"][at], np.repeat(weight, CLASSES) + below).astype(np.float32)
    return value


class Held:
    """Counts of one language, from which any document can be left out."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.count, self.discount, self.total, self.spare = adjusted_counts(keys, counts), {}, {}, {}
        for k, a in self.count.items():
            a = a.reshape(-1, CLASSES)
            a[:, START] = 0  # the start symbol is never predicted
            few = [(a == i).sum(1) for i in (1, 2)]
            self.discount[k] = np.array([0.0, *_discounts(a, np.arange(1, 4))])
            seen = (a > 0).sum(1)
            d = self.discount[k]
            self.total[k] = a.sum(1)
            self.spare[k] = d[1] * few[0] + d[2] * few[1] + d[3] * (seen - few[0] - few[1])
            self.count[k] = a.ravel()

    def without_own(self, pair: np.ndarray, times: np.ndarray) -> np.ndarray:
        """log p of every (document, 4-gram), as document * CELLS + key in order, from all documents but this one; ``times``
        are the document's own counts.  Discounts are those of all documents."""
        return np.log(self._probability(ORDER, pair, times.astype(float), times.astype(float)))

    def _probability(self, k: int, pair: np.ndarray, raw: np.ndarray, own: np.ndarray) -> np.ndarray:
        size, d = CLASSES**k, self.discount[k]
        gram = pair % size
        all_ = self.count[k][gram]
        rest = np.maximum(all_ - own, 0)
        less = lambda x: d[np.minimum(x, 3).astype(np.int64)]
        context = pair // CLASSES
        edge = np.concatenate([[True], context[1:] != context[:-1]])
        start, number = np.flatnonzero(edge), np.cumsum(edge) - 1
        at = context[start] % (size // CLASSES)
        total = (self.total[k][at] - np.add.reduceat(all_ - rest, start))[number]
        spare = (self.spare[k][at] - np.add.reduceat(less(all_) - less(rest), start))[number]
        if k == 1:
            below: np.ndarray | float = 1.0 / CLASSES
        else:
            short = size // CLASSES
            low, back = np.unique(pair // size * short + pair % short, return_inverse=True)
            low_raw = np.bincount(back, raw)
            low_own = np.bincount(back, (all_ > 0) & (rest == 0))  # left neighbours that only this document has
            if k > 2:
                low_own = np.where(low % short // CLASSES**(k - 2) == START, low_raw, low_own)
            below = self._probability(k - 1, low, low_raw, low_own)[back]
        known = total > 0.5
        return np.where(known, (rest - less(rest) + np.maximum(spare, 0) * below) / np.where(known, total, 1), below)


MODEL = "lang string, hash binary, logp binary, backoff binary"


def fit_models(counts: DataFrame) -> DataFrame:
    """One row per language with its sorted arrays (at most about 1.1 million n-grams: 17 MB a language)."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        m = estimate(pdf["key"].to_numpy(), pdf["n"].to_numpy())
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], **{k: [v.tobytes()] for k, v in m.items()}})
    return counts.groupBy("lang").applyInPandas(fit, MODEL)


def held_counts(counts: DataFrame) -> DataFrame:
    """One row per language with its 4-grams and counts (at most 2^20: 12 MB a language)."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "keys": [pdf["key"].to_numpy(np.int32).tobytes()], "counts": [pdf["n"].to_numpy(np.int64).tobytes()]})
    return counts.groupBy("lang").applyInPandas(pack, "lang string, keys binary, counts binary")


def _dup_lines(c: Chunk) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    breaks = np.flatnonzero(c.data == 10)
    inner = c.bounds[1:-1]
    start = np.unique(np.concatenate([c.bounds[:-1], breaks + 1]))
    start = start[start < len(c.data)]
    end = np.minimum.reduce([np.concatenate([breaks, [len(c.data)]])[np.searchsorted(breaks, start)],
                             np.concatenate([inner, [len(c.data)]])[np.searchsorted(inner, start, side="right")]])
    has_word = np.searchsorted(c.word_start, end) > np.searchsorted(c.word_start, start)
    start, end = start[has_word], end[has_word]
    doc = np.searchsorted(c.bounds, start, side="right") - 1
    h = mix(c.span_hashes(start, end) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(h, return_index=True)
    return np.bincount(doc, minlength=c.n) - np.bincount(doc[first], minlength=c.n)


def _repeat_words(c: Chunk) -> np.ndarray:
    """Words inside 5-word windows that occur twice or more in their text."""
    out = np.zeros(c.n, np.int64)
    h, bounds = c.shingles(5)
    for i in np.flatnonzero(c.n_words > 5):
        own = h[bounds[i]:bounds[i + 1]]
        ordered = np.sort(own)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            at = np.flatnonzero(np.isin(own, twice))
            edge = np.zeros(len(own) + 6, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + 5, -1)
            out[i] = (np.cumsum(edge) > 0).sum()
    return out


_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(_SYMBOLS)] = True


def base_measures(c: Chunk) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every text."""
    def per_text(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flag)])[c.bounds])
    chars = per_text(~c.space & ((c.data & 0xC0) != 0x80))
    return [c.n_words, chars, per_text(_IS_SYMBOL[c.data]), _dup_lines(c), _repeat_words(c)]


SCORES = "doc_id {key}, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_grams long, log_prob double, log_square double"
_resolved: dict[tuple[str, str], np.ndarray | Held] = {}


def score(docs: DataFrame, models: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """Base measures and log probability of every document under the model of its language.

    ``models`` come from :func:`fit_models`, or from :func:`held_counts`: then every document is scored by the others only.
    A model is at most 17 MB and its size is known before it is sent: languages are taken in groups whose models add up
    to at most MODEL_BYTES, each group scores its own documents in one pass."""
    arrays = models.columns[1:]
    sizes = models.select("lang", sum((F.octet_length(c) for c in arrays), F.lit(0)).alias("b")).orderBy("lang")
    groups: list[list[str]] = [[]]
    room = MODEL_BYTES
    for r in sizes.toLocalIterator():
        if r["b"] > room and groups[-1]:
            groups.append([])
            room = MODEL_BYTES
        groups[-1].append(r["lang"])
        room -= r["b"]
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(text).alias("text"))
    parts = []
    modelled = [x for g in groups for x in g]
    for i, names in enumerate(groups):
        # languages without a model go with the first group
        own = rows.where(F.col("lang").isin(names) | (~F.col("lang").isin(modelled) if i == 0 else F.lit(False))) if len(groups) > 1 else rows
        sent = {r["lang"]: {c: bytes(r[c]) for c in arrays} for r in models.where(F.col("lang").isin(names)).collect()}
        held = docs.sparkSession.sparkContext.broadcast(sent)
        parts.append(own.mapInArrow(_scorer(held, uuid.uuid4().hex), SCORES.format(key=kind)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _scorer(held, run_id: str):
    def table(name: str) -> np.ndarray | Held:
        if (run_id, name) not in _resolved:
            for old in [k for k in _resolved if k[0] != run_id]:
                del _resolved[old]
            raw = held.value.get(name)
            if raw is None:  # no n-gram in enough documents: every symbol is equally likely
                return np.full(CELLS, -np.log(CLASSES), np.float32)
            if "keys" in raw:
                _resolved[run_id, name] = Held(np.frombuffer(raw["keys"], np.int32), np.frombuffer(raw["counts"], np.int64))
                return _resolved[run_id, name]
            _resolved[run_id, name] = resolve({"hash": np.frombuffer(raw["hash"], np.uint64), "logp": np.frombuffer(raw["logp"], np.float32),
                                               "backoff": np.frombuffer(raw["backoff"], np.float32)})
        return _resolved[run_id, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from scored(batches)
        finally:
            _resolved.clear()  # a worker lives on: later stages need its memory more than the next task its tables

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            langs = b.column(1).to_pylist()
            found: list[list[np.ndarray]] = []
            for c in chunks(b.column(2)):
                keys, bounds = chunk_keys(c)
                own = langs[c.first:c.first + c.n]
                sums, squares = np.zeros(c.n), np.zeros(c.n)
                text_of = np.repeat(np.arange(c.n, dtype=np.int64), np.diff(bounds))
                names = sorted(set(own))
                which = np.array([names.index(x) for x in own])[text_of] if len(names) > 1 else np.zeros(len(keys), np.int64)
                for i, name in enumerate(names):
                    mine = which == i
                    if not mine.any():
                        continue
                    model = table(name)
                    pair, times = np.unique(text_of[mine] * CELLS + keys[mine], return_counts=True)
                    value = model.without_own(pair, times) if isinstance(model, Held) else model[pair % CELLS].astype(float)
                    sums += np.bincount(pair // CELLS, times * value, c.n)
                    squares += np.bincount(pair // CELLS, times * value * value, c.n)
                found.append([*base_measures(c), np.diff(bounds), sums, squares])
            columns = [np.concatenate(x) for x in zip(*found)]
            arrays = [b.column(0), b.column(1), *[pa.array(x.astype(np.int64)) for x in columns[:6]], pa.array(columns[6]), pa.array(columns[7])]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams", "log_prob", "log_square"])
    return run


def perplexity_bands(scored: DataFrame) -> DataFrame:
    """(lang, middle, below, above, variance) of the language's documents that pass the base rules: median log perplexity,
    standard deviations of documents on either side of it from the quartiles (LEAST_SPREAD at least, so a language of few
    or equal documents rejects none of them), and the median over the documents of the variance of a symbol's log p."""
    mean = F.col("log_prob") / F.col("n_grams")
    rows = scored.where("NOT base_failed AND n_grams > 0").withColumn("v", F.greatest(F.col("log_square") / F.col("n_grams") - mean * mean, F.lit(0.0)))
    q = rows.groupBy("lang").agg(F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10_000).alias("q"), F.percentile_approx("v", 0.5, 10_000).alias("variance"))
    side = lambda a, b: F.greatest((F.col("q")[b] - F.col("q")[a]) / QUARTILE, F.lit(LEAST_SPREAD))
    return q.select("lang", F.col("q")[1].alias("middle"), side(0, 1).alias("below"), side(1, 2).alias("above"), "variance")


def join_bands(scored: DataFrame, bands: DataFrame, most_rows: int = BAND_ROWS) -> DataFrame:
    """``scored`` with the bounds of its language.  At most ``most_rows`` bands (a few MB) are broadcast after counting
    them; more are joined by (language, salt) with as many salts as shuffle partitions, so that a frequent language is
    spread over all tasks."""
    bands = materialize(bands)
    if bands.count() <= most_rows:
        return scored.join(F.broadcast(bands), "lang", "left")
    salts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = bands.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "n_words", "log_prob"), F.lit(salts)).cast("int"))
    return salted.join(spread, ["lang", "_salt"], "left").drop("_salt")


def quality_rules(docs: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text", fence: float = FENCE,
                  min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, symbols: str = "classes") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    log_perplexity, lowest, highest, kept.

    Models and bands are made from all documents.  A document is kept when it passes the base rules and its perplexity
    lies inside the band of its language, bounds included; ``fence``
    standard deviations about the median, of the documents of the language and of the mean over the symbols of the text.  Null languages are one language, "".  Null and empty texts
    have no words: base_failed.  ``symbols``: whole characters under the sorted hash arrays of :mod:`ngrammodel` (the queries),
    or bytes folded to 32 classes (no query).  The model has the 4-grams of all documents, and
    every document is scored without its own counts.  Repeated rows are scored alike; other columns are ignored; an empty table gives an empty
    result."""
    if symbols == "characters":
        model, shards = ngrammodel.fit_model(ngrammodel.ngram_counts(docs, lang, text))
        scored = ngrammodel.score(docs, model, shards, base_measures, key, lang, text)
    elif symbols == "classes":
        models = materialize(held_counts(ngram_counts(docs, lang, text)))
        scored = score(docs, models, key, lang, text)
    else:
        raise ValueError(f"symbols are characters or classes, not {symbols!r}")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed).withColumn("log_perplexity", F.when(F.col("n_grams") > 0, -F.col("log_prob") / F.col("n_grams")))
    scored = materialize(scored)
    # a text of n symbols scatters by the spread of documents and by the error of a mean over n symbols
    error = F.try_divide(F.col("variance"), F.col("n_grams"))  # null without symbols: no perplexity to compare
    out = join_bands(scored, perplexity_bands(scored))
    for name, side, sign in (("lowest", "below", -1), ("highest", "above", 1)):
        out = out.withColumn(name, F.col("middle") + sign * fence * F.sqrt(F.col(side) * F.col(side) + error))
    out = out.drop("middle", "below", "above", "variance")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lowest"), F.col("highest")), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & inside).drop("n_grams", "log_prob", "log_square")


def keep_quality(docs: DataFrame, rules: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents whose key has a kept row."""
    return docs.join(rules.where("kept").select(F.col("doc_id").alias("_kept")).distinct(), F.col(key).eqNullSafe(F.col("_kept")), "left_semi")

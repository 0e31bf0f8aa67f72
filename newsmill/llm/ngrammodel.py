"""Character n-gram model in sorted hash arrays, and log probabilities of documents that are left out of it.

Symbols are whole code points, none folded or skipped.  Spark counts the 4-grams of every whole document per language and
derives by grouping what modified Kneser-Ney needs: adjusted counts of every order, sums of every context and counts of
counts.  The model is a table of these under 64-bit hashes, one row per range of hashes with its sorted arrays, and grows
with the corpus.  Texts are packed in blocks; the distinct hashes of a block go to their ranges, are looked up there and
come back, so no task or driver holds the model."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from newsmill.llm.textarrays import Chunk, blob, chunks, mix
from newsmill.session import materialize

ORDER, BITS = 4, 21
START = (1 << BITS) - 1  # before each text; greater than every code point
COUNTS_HELD = 2_000_000  # counts a counting task holds, some 40 bytes each
BLOCK_BYTES = 16 << 20  # text of a block; a longer text is a block of its own
SHARD_ENTRIES, LEAST_SHARDS = 1 << 16, 64  # entries of a range of hashes on average, 48 bytes each
SLOTS = 5  # of an entry: count as n-gram; as context: sum, n-grams seen once, twice, more often
LARGEST = 1 << 62  # numbers of (document, n-gram) below it are machine integers
_U = np.uint64
_STEP, _DISCOUNT = _U(0x9E3779B97F4A7C15), START + 1
_MASK = START


def code_points(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and the bounds per text."""
    lead = (c.data & 0xC0) != 0x80
    bounds = np.concatenate([[0], np.cumsum(lead)])[c.bounds]
    at = np.flatnonzero(lead)
    first = c.data[at]
    cp = first.astype(np.int32)
    long = np.flatnonzero(first >= 0xC0)
    if len(long):
        at, first = at[long], first[long]
        length = 2 + (first >= 0xE0) + (first >= 0xF0)
        value = np.where(length == 2, first & 31, np.where(length == 3, first & 15, first & 7)).astype(np.int32)
        for j in (1, 2, 3):
            more = c.data[np.minimum(at + j, len(c.data) - 1)] & 63
            value = np.where(length > j, value << 6 | more, value)
        cp[long] = np.minimum(value, START - 1)
    return cp, bounds


class Grams:
    """The 4-grams of a chunk: numbers in base ``size`` over the sorted alphabet of the chunk, whose last symbol is START."""

    def __init__(self, c: Chunk, langs: list[str]):
        cp, self.bounds = code_points(c)
        present = np.zeros(START + 1, bool)
        present[cp] = True
        present[START] = True
        self.alphabet = np.flatnonzero(present)
        self.size = len(self.alphabet)
        rank = np.zeros(START + 1, np.int32)
        rank[self.alphabet] = np.arange(self.size)
        exact = self.size**ORDER * (c.n + 1) < LARGEST  # Python's integers otherwise: tens of thousands of different symbols
        at = np.arange(len(cp)) + np.repeat((ORDER - 1) * np.arange(1, c.n + 1), np.diff(self.bounds))
        stream = np.full(len(cp) + (ORDER - 1) * c.n, self.size - 1, np.int64)
        stream[at] = rank[cp]
        stream = stream if exact else stream.astype(object)
        key = stream.copy()
        for back in range(1, ORDER):
            key[back:] += stream[:-back] * self.size**back
        self.text_of = np.repeat(np.arange(c.n), np.diff(self.bounds))
        self.names = sorted(set(langs))
        number = {x: i for i, x in enumerate(self.names)}
        self.lang_of = np.array([number[x] for x in langs], np.int64)
        self.key, self.kind = key[at], np.int64 if exact else object

    def tagged(self, tags: np.ndarray) -> np.ndarray:
        """(tag of the text, 4-gram) of every symbol."""
        return tags[self.text_of].astype(self.kind) * self.size**ORDER + self.key

    def symbol(self, gram: np.ndarray, back: int) -> np.ndarray:
        """Code point ``back`` places before the last of every n-gram."""
        return self.alphabet[(gram // self.size**back % self.size).astype(np.int64)]

    def hashes(self, seeds: np.ndarray, tagged: np.ndarray, k: int) -> np.ndarray:
        """Hash of every (number of the language, ``k``-gram)."""
        h = seeds[(tagged // self.size**k).astype(np.int64)]
        for back in reversed(range(k)):
            h = extended(h, self.symbol(tagged, back))
        return h


def seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def seeds_of(langs: list[str]) -> np.ndarray:
    return np.array([seed(x) for x in langs], np.uint64)


def extended(h: np.ndarray, symbol: np.ndarray | int) -> np.ndarray:
    """Hash of a string with one more symbol."""
    return mix((h ^ np.asarray(symbol).astype(np.uint64)) + _STEP)


# ------------------------------------------------------------------------------------------------ counts and model
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts, held under their hashes, COUNTS_HELD of them at most, however many languages there are."""
    names: dict[str, int] = {}
    parts: list[tuple[np.ndarray, ...]] = []  # hash, language, first symbol, other three, count
    held = 0

    def merge() -> None:
        h, lang, first, rest, n = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(h, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        one = order[edge]
        parts[:] = [(h[one], lang[one], first[one], rest[one], np.add.reduceat(n[order], edge))]

    def flush() -> Iterator[pa.RecordBatch]:
        own = pa.array(list(names), pa.string())
        h, lang, first, rest, n = parts[0]
        for lo in range(0, len(h), 100_000):
            cut = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays([own.take(pa.array(lang[cut])), pa.array(first[cut]), pa.array(rest[cut]), pa.array(n[cut])], ["lang", "first", "rest", "n"])
        parts.clear()
        names.clear()

    for b in batches:
        langs = b.column(0).to_pylist()
        for c in chunks(b.column(1)):
            g = Grams(c, langs[c.first:c.first + c.n])
            gram, n = np.unique(g.tagged(g.lang_of), return_counts=True)
            if not len(gram):
                continue
            which = (gram // g.size**ORDER).astype(np.int64)
            number = np.array([names.setdefault(x, len(names)) for x in g.names], np.int64)
            s = [g.symbol(gram, back) for back in range(ORDER)]
            parts.append((g.hashes(seeds_of(g.names), gram, ORDER), number[which], s[3].astype(np.int32), s[2] << 2 * BITS | s[1] << BITS | s[0], n.astype(np.int64)))
            held += len(gram)
            if held > COUNTS_HELD:
                merge()
                held = len(parts[0][0])
                if held > COUNTS_HELD // 2:
                    yield from flush()
                    held = 0
    if parts:
        merge()
        yield from flush()


def ngram_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, first, rest, n): counts of the 4-grams over all documents of the language, the last three symbols in one
    number of 21 bits each; each task adds its own texts up before the shuffle."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(_count, "lang string, first int, rest long, n long").groupBy("lang", "first", "rest").agg(F.sum("n").alias("n"))


def adjusted_counts(counts: DataFrame) -> DataFrame:
    """(lang, k, first, rest, n) of every n-gram of 1 to ORDER symbols.  Highest order: counts; lower orders: number of
    different left neighbours (n-grams that begin a text keep counts)."""
    out = counts.select("lang", F.lit(ORDER).alias("k"), "first", "rest", "n")
    upper = counts.withColumn("raw", F.col("n"))
    for k in range(ORDER - 1, 0, -1):
        short = F.col("rest").bitwiseAND(F.lit((1 << BITS * k) - 1))
        upper = upper.groupBy("lang", short.alias("rest")).agg(F.count(F.lit(1)).alias("n"), F.sum("raw").alias("raw"))
        if k > 1:
            upper = upper.withColumn("n", F.when(F.shiftright("rest", BITS * (k - 1)) == START, F.col("raw")).otherwise(F.col("n")))
        out = out.unionByName(upper.select("lang", F.lit(k).alias("k"), F.lit(0).alias("first"), "rest", "n"))
    return out


def discounts(grams: DataFrame) -> DataFrame:
    """(lang, k, d1, d2, d3): modified Kneser-Ney discounts of n-grams counted once, twice and more often, from the counts
    of counts; 0.5, 1 and 1.5 where those don't allow it."""
    few = grams.groupBy("lang", "k").agg(*[F.count_if(F.col("n") == i).cast("double").alias(f"n{i}") for i in range(1, 5)])
    y = "n1 / (n1 + 2 * n2)"
    got = [f"({i} - {i + 1} * ({y}) * n{i + 1} / n{i})" for i in (1, 2, 3)]
    fits = "least(n1, n2, n3, n4) > 0"
    known = few.select("lang", "k", *[F.expr(f"CASE WHEN {fits} THEN {x} END").alias(f"g{i}") for i, x in enumerate(got, 1)])
    usable = F.expr("coalesce(g1 > 0 AND g1 < 1 AND g2 > 0 AND g2 < 2 AND g3 > 0 AND g3 < 3, false)")
    return known.select("lang", "k", *[F.when(usable, F.col(f"g{i}")).otherwise(F.lit(i / 2)).alias(f"d{i}") for i in (1, 2, 3)])


def entries(grams: DataFrame) -> DataFrame:
    """(lang, length, first, rest, v0 .. v4): what the model says of every string.  Of an n-gram its count; of a context
    the sum of its n-grams and how many were seen once, twice and more often; of length -k the discounts of order k; the
    empty string counts the different symbols, and one for unseen ones."""
    zero = F.lit(0.0)
    none = F.lit(0).alias("first")

    def row(source: DataFrame, length, first, rest, *values) -> DataFrame:
        padded = [*values, *[zero] * (SLOTS - len(values))]
        return source.select("lang", length.cast("int").alias("length"), first, rest.cast("long").alias("rest"), *[v.cast("double").alias(f"v{i}") for i, v in enumerate(padded)])

    n = F.col("n")
    context = F.when(F.col("k") == ORDER, F.shiftleft(F.col("first").cast("long"), BITS * (ORDER - 2)).bitwiseOR(F.shiftright("rest", BITS))).otherwise(F.shiftright("rest", BITS))
    contexts = grams.groupBy("lang", "k", context.alias("rest")).agg(F.sum(n).alias("s"), F.count_if(n == 1).alias("n1"), F.count_if(n == 2).alias("n2"), F.count_if(n > 2).alias("n3"))
    symbols = grams.where("k = 1").groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("n"))
    return (row(grams, F.col("k"), F.col("first"), F.col("rest"), n)
            .unionByName(row(contexts, F.col("k") - 1, none, F.col("rest"), zero, *(F.col(x) for x in ("s", "n1", "n2", "n3"))))
            .unionByName(row(discounts(grams), -F.col("k"), none, F.lit(0), *(F.col(f"d{i}") for i in (1, 2, 3))))
            .unionByName(row(symbols, F.lit(0), none, F.lit(0), n)))


def entry_hashes(langs: list[str], length: np.ndarray, first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Hashes of strings as :func:`entries` writes them."""
    names = {x: i for i, x in enumerate(dict.fromkeys(langs))}
    h = seeds_of(list(names))[np.array([names[x] for x in langs], np.int64)]
    for k in range(1, ORDER + 1):
        h = np.where(length == -k, extended(h, _DISCOUNT + k), h)
    h = np.where(length == ORDER, extended(h, first), h)
    for back in range(ORDER - 2, -1, -1):
        h = np.where(length > back, extended(h, rest >> BITS * back & _MASK), h)
    return h


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Number of the range of every hash; ``shards`` is a power of two, at least 2."""
    return (h >> _U(64 - (shards.bit_length() - 1))).astype(np.int32)


_VALUES = [f"v{i}" for i in range(SLOTS)]
MODEL = "shard int, hash binary, " + ", ".join(f"{v} binary" for v in _VALUES)


def fit_model(counts: DataFrame) -> tuple[DataFrame, int]:
    """The model, one row per range of hashes: its sorted array of hashes and the arrays of their values; and the number of
    ranges, which follows the number of n-grams."""
    grams = materialize(adjusted_counts(materialize(counts)))
    shards = max(LEAST_SHARDS, 1 << max(0, grams.count() // SHARD_ENTRIES).bit_length())

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                h = entry_hashes(b.column(0).to_pylist(), *(b.column(i).to_numpy() for i in (1, 2, 3)))
                yield pa.RecordBatch.from_arrays([pa.array(shard_of(h, shards)), pa.array(h.view(np.int64)), *b.columns[4:]], ["shard", "hash", *_VALUES])

    def sorted_arrays(t: pa.Table) -> pa.Table:
        h = t["hash"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        edge = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))  # an n-gram that is a context, too
        arrays = [h[order][edge], *(np.add.reduceat(t[v].to_numpy()[order], edge) for v in _VALUES)]
        return pa.table([pa.array([t["shard"][0].as_py()], pa.int32()), *[pa.array([blob(a)]) for a in arrays]], names=["shard", "hash", *_VALUES])

    rows = entries(grams).mapInArrow(hashed, "shard int, hash long, " + ", ".join(f"{v} double" for v in _VALUES))
    return materialize(rows.groupBy("shard").applyInArrow(sorted_arrays, MODEL)), shards


# ------------------------------------------------------------------------------------------------ scoring
class Found:
    """What a model says of the strings of a block: sorted hashes and their values."""

    def __init__(self, hashes: np.ndarray, values: list[np.ndarray]):
        self.hash, self.values = hashes, values

    def get(self, h: np.ndarray, slots: range) -> list[np.ndarray]:
        if not len(self.hash):
            return [np.zeros(len(h)) for _ in slots]
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        hit = self.hash[at] == h
        return [np.where(hit, self.values[i][at], 0.0) for i in slots]


def wanted(texts, langs: list[str]) -> np.ndarray:
    """Sorted hashes of all strings by which the texts are scored: their n-grams and contexts, and the discounts."""
    parts = [np.zeros(0, np.uint64)]
    for c in chunks(texts):
        g = Grams(c, langs[c.first:c.first + c.n])
        seeds = seeds_of(g.names)
        tagged = np.unique(g.tagged(g.lang_of))
        for k in range(ORDER, 0, -1):
            parts.append(g.hashes(seeds, tagged, k))
            short = g.size**(k - 1)
            tagged = np.unique(np.concatenate([tagged // g.size, tagged // (short * g.size) * short + tagged % short]))
        parts += [seeds, *(extended(seeds, _DISCOUNT + k) for k in range(1, ORDER + 1))]
    return np.unique(np.concatenate(parts))


class LeftOut:
    """Log probabilities of the texts of a chunk from all documents but the text's own; discounts and the number of symbols
    are those of all documents."""

    def __init__(self, g: Grams, found: Found):
        self.g, self.found, self.seeds = g, found, seeds_of(g.names)
        self.discount = {k: np.stack([np.zeros(len(g.names)), *found.get(extended(self.seeds, _DISCOUNT + k), range(3))], 1) for k in range(1, ORDER + 1)}
        self.symbols = np.maximum(found.get(self.seeds, range(1))[0], 1)

    def log_p(self, pair: np.ndarray, times: np.ndarray) -> np.ndarray:
        """log p of every (text, 4-gram), in order; ``times`` are the text's own counts."""
        return np.log(self._probability(ORDER, pair, times.astype(float), times.astype(float)))

    def _values(self, k: int, text: np.ndarray, gram: np.ndarray, slots: range) -> list[np.ndarray]:
        tagged, back = np.unique(self.g.lang_of[text].astype(self.g.kind) * self.g.size**k + gram, return_inverse=True)
        return [v[back] for v in self.found.get(self.g.hashes(self.seeds, tagged, k), slots)]

    def _probability(self, k: int, pair: np.ndarray, raw: np.ndarray, own: np.ndarray) -> np.ndarray:
        base = self.g.size
        size, short = base**k, base**(k - 1)
        text = (pair // size).astype(np.int64)
        lang = self.g.lang_of[text]
        all_ = self._values(k, text, pair % size, range(1))[0]
        rest = np.maximum(all_ - own, 0)
        less = lambda x: self.discount[k][lang, np.minimum(x, 3).astype(np.int64)]
        context = pair // base
        edge = np.concatenate([[True], context[1:] != context[:-1]])
        start, number = np.flatnonzero(edge), np.cumsum(edge) - 1
        total, *few = self._values(k - 1, text[start], context[start] % short, range(1, SLOTS))
        spare = sum(self.discount[k][lang[start], i] * x for i, x in enumerate(few, 1))
        total = (total - np.add.reduceat(all_ - rest, start))[number]
        spare = (spare - np.add.reduceat(less(all_) - less(rest), start))[number]
        if k == 1:
            below = 1 / self.symbols[lang]
        else:
            low, back = np.unique(pair // size * short + pair % short, return_inverse=True)
            low_raw = np.bincount(back, raw)
            low_own = np.bincount(back, (all_ > 0) & (rest == 0))  # left neighbours that only this text has
            if k > 2:
                low_own = np.where(low % short // base**(k - 2) == base - 1, low_raw, low_own)
            below = self._probability(k - 1, low, low_raw, low_own)[back]
        known = total > 0.5
        return np.where(known, (rest - less(rest) + np.maximum(spare, 0) * below) / np.where(known, total, 1), below)


PIECES = "block string, shard int, data binary, " + ", ".join(f"{v} binary" for v in _VALUES)


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows (key, lang, text) in runs of at most ``limit`` bytes of text; a longer text is a run of its own."""
    held: list[pa.RecordBatch] = []
    room = limit
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < b.num_rows:
            before = size[lo - 1] if lo else 0
            hi = int(np.searchsorted(size, before + room, side="right"))
            if hi == lo and not held:
                hi = lo + 1
            if hi > lo:
                held.append(b.slice(lo, hi - lo))
                room -= size[hi - 1] - before
                lo = hi
            if lo < b.num_rows or room <= 0:
                yield pa.concat_batches(held)
                held, room = [], limit
    if held:
        yield pa.concat_batches(held)


def _packed(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A compressed row for every block of texts; its name follows from its place and content."""
        task = TaskContext.get().partitionId()
        for i, b in enumerate(blocks(batches, block_bytes)):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 9))) as out:
                out.write_batch(b)
            data = sink.getvalue().to_pybytes()
            name = f"{task}-{i}-{hashlib.blake2b(data, digest_size=16).hexdigest()}"
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data])], ["block", "data"])
    return run


def unpacked(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as source:
        return source.read_next_batch()


def nullable(a: pa.Array) -> pa.Array:
    """A column whose nested fields may all be null, as a schema written in words says."""
    if not pa.types.is_struct(a.type):
        return a
    fields = [nullable(x) for x in a.flatten()]
    return pa.StructArray.from_arrays(fields, fields=[pa.field(a.type.field(i).name, x.type) for i, x in enumerate(fields)], mask=a.is_null())


def _ask(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The hashes that every block wants, by range."""
        for row in batches:
            for i, name in enumerate(row.column(0).to_pylist()):
                b = unpacked(row.column(1)[i].as_py())
                h = wanted(b.column(2), b.column(1).to_pylist())
                of = shard_of(h, shards)
                edge = np.append(np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])), len(h))
                for lo in range(0, len(edge) - 1, 1000):
                    cut = edge[lo:lo + 1001]
                    data = [blob(h[x:y]) for x, y in zip(cut[:-1], cut[1:])]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(data)), pa.array(of[cut[:-1]]), pa.array(data), *[pa.nulls(len(data), pa.binary())] * SLOTS],
                                                     ["block", "shard", "data", *_VALUES])
    return run


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of the model, each followed by the hashes that blocks want of it: the hashes again and their values."""
    at, model = None, Found(np.zeros(0, np.uint64), [])
    for b in batches:
        out: list[tuple] = []
        for i, shard in enumerate(b.column(1).to_pylist()):
            h = np.frombuffer(b.column(2)[i].as_buffer(), np.uint64)
            if b.column(0)[i].as_py() == "":
                at, model = shard, Found(h, [np.frombuffer(b.column(3 + j)[i].as_buffer(), float) for j in range(SLOTS)])
                continue
            if at != shard:
                at, model = shard, Found(np.zeros(0, np.uint64), [])
            out.append((b.column(0)[i].as_py(), shard, blob(h), *(blob(v) for v in model.get(h, range(SLOTS)))))
        if out:
            block, shards, *values = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(shards, pa.int32()), *[pa.array(v, pa.binary()) for v in values]],
                                             ["block", "shard", "data", *_VALUES])


SCORES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams")


def _scored(measures: Callable[[Chunk], list[np.ndarray]]):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        (data,) = block["data"].to_pylist()
        b = unpacked(data)
        langs = b.column(1).to_pylist()
        answers = answers.sort_by("shard")  # ranges follow the order of the hashes
        if not answers.num_rows:  # blocks are named by their content
            raise RuntimeError("the documents changed between two reads")
        joined = lambda name, kind: np.frombuffer(b"".join(answers[name].to_pylist()), kind)
        found = Found(joined("data", np.uint64), [joined(v, float) for v in _VALUES])
        parts = []
        for c in chunks(b.column(2)):
            g = Grams(c, langs[c.first:c.first + c.n])
            sums, squares = np.zeros(c.n), np.zeros(c.n)
            if len(g.key):
                pair, times = np.unique(g.tagged(np.arange(c.n)), return_counts=True)
                value = LeftOut(g, found).log_p(pair, times)
                text = (pair // g.size**ORDER).astype(np.int64)
                sums, squares = np.bincount(text, times * value, c.n), np.bincount(text, times * value * value, c.n)
            parts.append([*measures(c), np.diff(g.bounds), sums, squares])
        columns = [np.concatenate(x) for x in zip(*parts)]
        arrays = [nullable(b.column(0)), b.column(1), *[pa.array(x.astype(np.int64)) for x in columns[:6]], pa.array(columns[6]), pa.array(columns[7])]
        return pa.table(arrays, names=["doc_id", "lang", *SCORES, "log_prob", "log_square"])
    return run


def score(docs: DataFrame, model: DataFrame, shards: int, measures: Callable[[Chunk], list[np.ndarray]], key: str = "doc_id", lang: str = "lang", text: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Measures and log probability of every document, by the model of its language without the document's own counts.

    ``model`` and ``shards`` come from :func:`fit_model` over the same documents.  The packed blocks are shuffled once and
    read twice from there, for what they want and to be scored with the answers."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(text).alias("text"))
    packed = rows.mapInArrow(_packed(block_bytes), "block string, data binary").repartition("block")
    ranges = model.select(F.lit("").alias("block"), "shard", F.col("hash").alias("data"), *_VALUES)
    asked = packed.mapInArrow(_ask(shards), PIECES).unionByName(ranges).repartition("shard").sortWithinPartitions("shard", "block")
    answers = asked.mapInArrow(_look_up, PIECES)
    columns = ", ".join(f"{x} long" for x in SCORES)
    both = packed.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(_scored(measures), f"doc_id {kind}, lang string, {columns}, log_prob double, log_square double")

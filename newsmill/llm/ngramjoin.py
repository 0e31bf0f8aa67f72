"""Jaccard join of documents on word n-grams as a blocked sparse matrix product.

The documents x n-grams incidence matrix is cut into blocks of n-gram hashes.  A block finds the n-grams that more than
one document has; only those can overlap.  Bounds from the set sizes discard the rest: a document needs at least
``share * n`` shared n-grams, and two documents can reach the share only if one of their ``n - ceil(share * n) + 1`` rarest
n-grams is common.  Pairs that survive the bounds accumulate their overlap over the shared n-grams, exactly.

Links are wanted as components, so pairs inside what is already one component are not made: first every document meets
a few leaders of its rare n-grams, in turns, then all pairs from different components do."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from newsmill.llm.graph import components
from newsmill.llm.textarrays import blob, chunks, mix, pack40, unpack40
from newsmill.session import materialize

SHINGLE, SHARE = 5, 75
BLOCK_ENTRIES = 1_000_000   # incidence entries a block (or a part of documents) is sized for
# per turn: how many ways a group's n-grams choose leaders, and how many each; then all pairs of components meet
LEADERS = ((4, 1), (1 << 30, 4), (1 << 30, 24))
FLUSH_ENTRIES = 600_000   # entries a map task holds before it sends its blocks
_U = np.uint64
_LOW = _U((1 << 40) - 1)
_KEY = "block int, sig binary, count binary, ids binary"


def ascii_lower(column) -> pa.Array:
    """Lower-case A-Z only, on the bytes (longer characters have no such bytes)."""
    flat = pa.array(column) if not isinstance(column, (pa.Array, pa.ChunkedArray)) else column
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    flat = flat.cast(pa.large_binary())
    raw = flat.buffers()[2]
    if raw is None or not raw.size:
        return flat
    data = np.frombuffer(raw, np.uint8)
    lowered = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    return pa.Array.from_buffers(pa.large_binary(), len(flat), [flat.buffers()[0], flat.buffers()[1], pa.py_buffer(lowered)], offset=flat.offset)


def document_sets(column, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes) of every text."""
    for c in chunks(ascii_lower(column)):
        h, bounds = c.shingles(k)
        for i in range(c.n):
            own = np.sort(h[bounds[i]:bounds[i + 1]])
            yield c.first + i, own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own


def signature(own: np.ndarray) -> int:
    """64 bits that identify a set together with its size."""
    total = mix(own ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(np.array([total + _U(len(own))], np.uint64)).view(np.int64)[0])


def set_sizes(docs: DataFrame, key: str, text: str, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, sig); sig is null for empty sets.  Equal sets have equal sigs."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(len(own), signature(own) if len(own) else None) for _, own in document_sets(b.column(1), k)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.int64())],
                                             ["doc_id", "n_shingles", "sig"])
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, n_shingles long, sig long")


def planes(values: np.ndarray) -> bytes:
    """Whole numbers below 2**31, all lowest bytes first: the other bytes are mostly 0 and compress."""
    return np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).reshape(-1).view("<i4")


def _packed(block: np.ndarray, doc: np.ndarray, sigs: np.ndarray, columns: list[np.ndarray], packers: list) -> Iterator[tuple]:
    """Entries (sorted by doc) cut by block: (block, sig, count, *columns) with one run per document."""
    order = np.argsort(block.astype(np.uint16) if block.max(initial=0) < 65536 else block, kind="stable")
    block, doc = block[order], doc[order]
    columns = [c[order] for c in columns]
    edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])) if len(block) else np.zeros(0, int)
    for lo, hi in zip(edges[:-1], edges[1:]):
        own = doc[lo:hi]
        runs = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        docs = own[runs]
        counts = np.diff(np.concatenate([runs, [hi - lo]]))
        yield (int(block[lo]), blob(sigs[docs]), planes(counts), *[p(c[lo:hi]) for p, c in zip(packers, columns)])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_INCIDENCE = pa.schema([("block", pa.int32()), ("sig", pa.binary()), ("count", pa.binary()), ("ids", pa.binary())])
_SHARED = pa.schema([*_INCIDENCE, ("df", pa.binary()), ("origin", pa.int32())])
_MATRIX = pa.schema([("sig", pa.int64()), ("n", pa.int64()), ("s", pa.int64()), ("ids", pa.binary()), ("rare", pa.list_(pa.int64()))])


def incidence(docs: DataFrame, text: str, n_blocks: int, k: int = SHINGLE) -> DataFrame:
    """The incidence matrix in blocks of n-gram hashes, equal sets of one task once.  Within a block an n-gram is its low
    40 bits, packed in five bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        sigs: list[int] = []

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in held])
            h = np.concatenate(held)
            rows = _packed(((h >> _U(40)) % _U(n_blocks)).astype(np.int64), np.repeat(np.arange(len(held)), sizes),
                           np.array(sigs, np.int64), [h & _LOW], [pack40])
            return _batch(list(rows), _INCIDENCE)

        size = 0
        for b in batches:
            for _, own in document_sets(b.column(0), k):
                if not len(own):
                    continue
                sig = signature(own)
                if sig in seen:
                    continue
                seen.add(sig)
                held.append(own)
                sigs.append(sig)
                size += len(own)
                if size >= FLUSH_ENTRIES:
                    yield flush()
                    held.clear()
                    sigs.clear()
                    size = 0
        if held:
            yield flush()
    return docs.select(F.col(text).alias("text")).mapInArrow(run, _KEY)


def _read(table: pa.Table, wide: bool) -> tuple[np.ndarray, ...]:
    """Entries of a group: distinct sigs, and per entry the index of its sig, its id (and df).  Runs of one
    sig that came from several tasks are equal in a block of n-grams; only the first is read there."""
    sig, count, ids, df = [], [], [], []
    for row in table.to_pylist():
        sig.append(np.frombuffer(row["sig"], np.int64))
        count.append(unplanes(row["count"]))
        ids.append(unpack40(row["ids"]))
        if wide:
            ids[-1] = ids[-1] | _U(row["origin"] << 40)
            df.append(unplanes(row["df"]))
    sig, count, ids = map(np.concatenate, (sig, count, ids))
    names, first, which = np.unique(sig, return_index=True, return_inverse=True)
    doc = np.repeat(which, count)
    if wide:
        return names, doc, ids, np.concatenate(df)
    fresh = np.zeros(len(sig), bool)
    fresh[first] = True
    use = np.repeat(fresh, count)
    return names, doc[use], ids[use]


def shared_entries(blocks: DataFrame, n_parts: int) -> DataFrame:
    """Entries of n-grams that at least two different sets have, with the number of sets, dealt anew by document."""
    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        names, doc, ids = _read(table, False)
        order = np.argsort(ids, kind="stable")
        ids, doc = ids[order], doc[order]
        edges = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        df = np.repeat(*[np.diff(np.concatenate([edges, [len(ids)]]))] * 2)
        keep = df > 1
        ids, doc, df = ids[keep], doc[keep], df[keep]
        by_doc = np.argsort(doc, kind="stable")
        ids, doc, df = ids[by_doc], doc[by_doc], df[by_doc]
        rows = [(*row, block) for row in _packed((names % n_parts)[doc], doc, names, [ids, df], [pack40, planes])]
        return pa.Table.from_batches([_batch(rows, _SHARED)] if rows else [], _SHARED)
    return blocks.groupBy("block").applyInArrow(run, _KEY + ", df binary, origin int")


def reduced_matrix(shared: DataFrame, sizes: DataFrame, n_parts: int, share: int = SHARE) -> DataFrame:
    """(sig, n, s, ids, rare): documents that have enough shared n-grams (s of n) to reach the share with anybody, their
    shared n-grams in order of their value, and the rarest of them, one of which every partner must have.  The set sizes
    come once per set from ``sizes`` instead of with every run of entries."""
    known = sizes.where("sig IS NOT NULL").select(F.pmod("sig", F.lit(n_parts)).cast("int").alias("block"), "sig", F.col("n_shingles").alias("n")).distinct()

    def run(table: pa.Table, own: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_batches([], _MATRIX)
        names, doc, ids, df = _read(table, True)
        own = own.sort_by("sig")
        n = own.column("n").to_numpy()[np.searchsorted(own.column("sig").to_numpy(), names)]
        s = np.bincount(doc, minlength=len(names))
        need = (share * n + 99) // 100
        alive = s >= need
        use = alive[doc]
        doc, ids, df = doc[use], ids[use], df[use]
        rarest = np.lexsort((ids, df, doc))
        plain = np.lexsort((ids, doc))
        ends = np.cumsum(np.where(alive, s, 0))
        rows = []
        for i in np.flatnonzero(alive):
            lo, hi = ends[i] - s[i], ends[i]
            rows.append((int(names[i]), int(n[i]), int(s[i]), blob(ids[plain[lo:hi]]),
                         ids[rarest[lo:lo + s[i] - need[i] + 1]].astype(np.int64)))
        return pa.Table.from_batches([_batch(rows, _MATRIX)] if rows else [], _MATRIX)
    return shared.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, "sig long, n long, s long, ids binary, rare array<long>")


def _can_reach(a: str, b: str, share: int) -> str:
    """Size bounds for two documents that meet at an n-gram: if it is the rarest that they share, what comes before it in
    either row cannot overlap, so the overlap is at most the smaller of what is left."""
    return (f"{100 + share} * least({a}.s - {a}.pos, {b}.s - {b}.pos) >= {share} * ({a}.n + {b}.n) "
            f"AND 100 * least({a}.n, {b}.n) >= {share} * greatest({a}.n, {b}.n)")


def accumulate(pairs: DataFrame, matrix: DataFrame, share: int = SHARE) -> DataFrame:
    """(u, v, overlap) of the pairs whose overlap over all shared n-grams reaches the share of their union."""
    rows = matrix.select("sig", "n", "ids")
    both = (pairs.join(rows.toDF("u", "u_n", "u_ids"), "u").join(rows.toDF("v", "v_n", "v_ids"), "v")
            .select("u", "v", "u_n", "v_n", "u_ids", "v_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            un, vn = b.column(2).to_numpy(), b.column(3).to_numpy()
            got = np.zeros(b.num_rows, np.int64)
            for i in range(b.num_rows):
                x = np.concatenate([np.frombuffer(b.column(c)[i].as_buffer(), np.uint64) for c in (4, 5)])
                x.sort(kind="stable")
                got[i] = (x[1:] == x[:-1]).sum()
            keep = pa.array((100 + share) * got >= share * (un + vn))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got)], ["u", "v", "overlap"]).filter(keep)
    return both.mapInArrow(run, "u long, v long, overlap long")


def ngram_jaccard(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``.

    Texts are lower-cased in A-Z and cut into words ``[^\\x20\\x09-\\x0D]+``; a document's set holds its distinct k-word
    shingles, with fewer words the whole sequence.  Two documents link when 100 * intersection >= share * union;
    component_id is the smallest doc_id reachable by links.  Copies count once in the matrix and follow their set.

    Null, empty and blank texts have an empty set and their own id as component; repeated rows are copies; null ids
    take part but are never the smallest (a component of null ids has a null id).  Other columns are ignored; an empty
    table gives an empty result.  N-grams are told apart by 64-bit hashes for the sizes, and by block and 40 bits (46 and
    more in all at corpus size) for overlaps."""
    sizes = materialize(set_sizes(docs, key, text, k))
    total = sizes.agg(F.sum("n_shingles")).first()[0] or 0
    n_blocks = max(12, -(-total // BLOCK_ENTRIES))
    matrix = materialize(reduced_matrix(shared_entries(incidence(docs, text, n_blocks, k), n_blocks), sizes, n_blocks, share))
    links, marked = _links(matrix, share)
    named = sizes.join(marked, sizes.sig == marked.node, "left").withColumn("_component", F.coalesce("component", "sig"))
    named = named.select("doc_id", "n_shingles", "_component")
    least = named.where("_component IS NOT NULL").groupBy("_component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "_component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("_component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _pairs(a: DataFrame, b: DataFrame, condition: str, share: int) -> DataFrame:
    """Distinct pairs (u, v) of two sides that meet at an n-gram and can reach the share."""
    met = a.alias("a").join(b.alias("b"), F.expr(f"a.id = b.id AND {condition} AND {_can_reach('a', 'b', share)}"))
    return met.select(F.greatest("a.sig", "b.sig").alias("u"), F.least("a.sig", "b.sig").alias("v")).distinct()


def _links(matrix: DataFrame, share: int) -> tuple[DataFrame, DataFrame]:
    """Verified links between sets and (node, component) of the sets that have any."""
    rare = matrix.select("sig", "n", "s", F.posexplode("rare").alias("pos", "id"))
    links, stars, tried = None, None, None
    r = materialize(rare.withColumn("component", F.col("sig")))
    for turn in range(len(LEADERS) + 1):
        # rare n-grams that documents of different components have
        mixed = r.groupBy("id").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("id", "lo")
        r = r.join(mixed, "id")
        if turn < len(LEADERS):
            # a few leaders for the n-grams of a group, more and others in every turn; once components have formed, they
            # come from the one with the smallest name, which the largest of a group mostly has, and meet the others
            lots, each = LEADERS[turn]
            lot = F.xxhash64("sig", F.lit(turn), F.pmod(F.col("id"), F.lit(lots)))
            best = F.row_number().over(W.partitionBy("id").orderBy(lot, "sig"))
            leader = (r if turn == 0 else r.where("component = lo")).withColumn("_best", best).where(f"_best <= {each}")
            pairs = _pairs(r, leader, "a.component <> b.component", share)
        else:
            pairs = _pairs(r, r, "a.component < b.component", share)
        if tried is not None:
            pairs = pairs.join(tried, ["u", "v"], "left_anti")
        pairs = materialize(pairs)
        found = materialize(accumulate(pairs, matrix, share))
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        edges = found.select("u", "v") if stars is None else stars.unionByName(found.select("u", "v"))
        marked = components(edges, "u", "v")
        stars = marked.select(F.col("node").alias("u"), F.col("component").alias("v"))
        if turn < len(LEADERS):
            r = materialize(r.drop("component", "lo").join(marked.withColumnRenamed("node", "sig"), "sig", "left")
                            .withColumn("component", F.coalesce("component", "sig")))
    return links, marked


def one_per_component(docs: DataFrame, classes: DataFrame, key: str = "doc_id") -> DataFrame:
    """The document with the smallest id of every component; a repeated row stays once."""
    kept = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, F.col(key).eqNullSafe(F.col("_kept")), "left_semi").dropDuplicates([key])


"""Document operators against brute force on whole small tables and on odd rows."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from newsmill.llm import grading, linedup, mixing, ngramjoin, packing, perplexity, substrings
from newsmill.llm.textarrays import chunks
import pyarrow as pa

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def table(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


# ------------------------------------------------------------------------------------------------ hashing of flat texts
def test_words_and_shingles_of_flat_texts():
    texts = ["a b  c", "", None, "one two three four five six", "\x1fnot\x85space here", "ab a b", "one two three four five", " x"]
    got_words, got = [], []
    for c in chunks(pa.array(texts), limit=9):
        h, b = c.shingles(5)
        w = c.word_hashes()
        for i in range(c.n):
            got.append(h[b[i]:b[i + 1]].tolist())
            got_words.append(w[c.word_bounds[i]:c.word_bounds[i + 1]].tolist())
    want = [WORD.findall(t or "") for t in texts]
    names = {}
    for hs, ws in zip(got_words, want):
        assert len(hs) == len(ws)
        for h, w in zip(hs, ws):
            assert names.setdefault(h, w) == w
    assert len(names) == len({w for ws in want for w in ws})
    assert [len(g) for g in got] == [len(w) - 4 if len(w) >= 5 else min(1, len(w)) for w in want]
    assert got[3][0] == got[6][0] and len({x for g in got for x in g}) == 7 - 1


# ------------------------------------------------------------------------------------------------ 1 quality rules
def base(text):
    ws = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    covered = {j for i in range(len(ws) - 4) if windows[tuple(ws[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered),
            len(ws) < 10 or 100 * len(covered) > 20 * len(ws))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_measures(spark, docs, odd_docs):
    for df in (docs, odd_docs):
        got = sorted(((r["doc_id"],) + tuple(r[c] for c in BASE) for r in perplexity.quality_rules(df).collect()), key=repr)
        assert got == sorted(((r["doc_id"],) + base(r["text"]) for r in df.collect()), key=repr)


def test_salted_bands_join_as_broadcast_ones(spark):
    rows = [(i, ["en", "fr", "xx"][i % 5 % 3], 10, float(i)) for i in range(60)] + [(None, "en", 0, None)] * 2
    scored = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, log_prob double")
    bands = spark.createDataFrame([("en", 1.0, 2.0), ("fr", 3.0, 4.0)], "lang string, lowest double, highest double")
    sent, salted = (perplexity.join_bands(scored, bands, n) for n in (100, 1))
    key = lambda df: sorted((tuple(r[c] for c in ("doc_id", "lang", "n_words", "log_prob", "lowest", "highest")) for r in df.collect()), key=repr)
    assert key(sent) == key(salted) and len(key(sent)) == 62


def test_model_is_a_distribution():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, perplexity.CELLS, 5000))
    keys = keys[keys % 32 != 31]
    table_ = perplexity.resolve(perplexity.estimate(keys, rng.integers(1, 9, len(keys))))
    total = np.exp(table_.astype(float)).reshape(-1, 32)[:, :31].sum(1)
    # the unigram shares 1/32 of its backed-off mass with the start symbol, which never comes
    assert (total <= 1 + 1e-4).all() and (total > 0.9).all()


def test_perplexity_rejects_foreign_noise(spark, docs):
    import random
    rng = random.Random(1)
    noise = [(10_000 + i, " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(80)), "en", "s", 1) for i in range(3)]
    got = table(perplexity.quality_rules(docs.unionByName(spark.createDataFrame(noise, docs.schema))), "base_failed", "kept")
    assert all(got[10_000 + i] == (False, False) for i in range(3))


def test_perplexity_from_all_counts_of_the_other_documents(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["lang"] == "fr"][:12] + [(-1, "only here: zq xj"), (-2, "x")]
    got = table(perplexity.quality_rules(docs.sparkSession.createDataFrame([(d, t, "fr") for d, t in rows], "doc_id long, text string, lang string")),
                "log_perplexity")
    keys = []
    for c in chunks(pa.array([t for _, t in rows])):
        k, b = perplexity.chunk_keys(c)
        keys += [k[b[i]:b[i + 1]] for i in range(c.n)]
    whole = perplexity.adjusted_counts(*np.unique(np.concatenate(keys), return_counts=True))
    d = {}
    for k, a in whole.items():
        a = a.reshape(-1, 32).copy()
        a[:, 31] = 0
        n = [(a == i).sum() for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        e = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)] if min(n) else []
        d[k] = [0, *(e if e and all(0 < x < i for i, x in enumerate(e, 1)) else [0.5, 1, 1.5])]
    assert d[4][1:] != [0.5, 1, 1.5]  # once-seen 4-grams are counted, so discounts come from the data at the top order
    for i, (doc, _) in enumerate(rows):
        others = perplexity.adjusted_counts(*np.unique(np.concatenate(keys[:i] + keys[i + 1:]), return_counts=True))
        p = 1 / 32
        for k in range(1, 5):
            a = others[k].reshape(-1, 32).copy()
            a[:, 31] = 0
            off = np.array(d[k])[np.minimum(a, 3).astype(int)]
            total, below = a.sum(1, keepdims=True), np.tile(np.reshape(p, (-1, 32)), (32, 1))[:len(a)] if k > 1 else p
            p = np.where(total > 0, (a - off + off.sum(1, keepdims=True) * below) / np.maximum(total, 1), below)
        assert got[doc][0] == pytest.approx(-np.log(p.ravel()[keys[i]]).mean(), rel=1e-6)


@pytest.mark.parametrize("held", [50, 2_000_000])
def test_counts_of_many_interleaved_languages(spark, monkeypatch, held):
    """Sixty languages in turn, with more counts than a task holds."""
    monkeypatch.setattr(perplexity, "COUNTS_HELD", held)
    rows = [(f"l{i % 60}", f"text {i % 7} of language {i % 60} " * (i % 4)) for i in range(400)] + [("l1", None), (None, "no language"), (None, "")]
    batch = pa.record_batch([pa.array([x or "" for x, _ in rows]), pa.array([t for _, t in rows])], ["lang", "text"])
    parts = list(perplexity._count(batch.slice(i, 20) for i in range(0, len(rows), 20)))
    got = Counter()
    for p in parts:
        for lang, key, n in zip(*(c.to_pylist() for c in p.columns)):
            got[lang, key] += n
    want = Counter()
    for lang, text in rows:
        for c in chunks(pa.array([text])):
            want.update((lang or "", int(k)) for k in perplexity.chunk_keys(c)[0])
    assert got == want and (len(parts) > 5) == (held == 50)


def test_a_language_of_one_document_has_a_model():
    keys, counts = np.unique(np.concatenate([perplexity.chunk_keys(c)[0] for c in chunks(pa.array(["the only text of the language"]))]), return_counts=True)
    held = perplexity.Held(keys, counts)
    assert np.allclose(np.exp(held.without_own(keys.astype(np.int64), counts)), 1 / 32)  # without itself nothing is known
    assert (held.without_own(keys.astype(np.int64), 0 * counts) > np.log(1 / 8)).all()


def test_perplexity_bands_reject_short_and_medium_junk(spark):
    import random
    rng = random.Random(3)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    clean = [r["text"] for r in docs.collect() if r["lang"] == "en" and r["text"]]
    piece = lambda n: " ".join(rng.choice(clean).split()[:n])
    letters = lambda n, of: " ".join("".join(rng.choice(of) for _ in range(rng.randrange(3, 9))) for _ in range(n))
    kinds = {"letters": lambda n: letters(n, "abcdefghijklmnopqrstuvwxyz"), "consonants": lambda n: letters(n, "bcdfghjklmnpqrstvwxz"),
             "backwards": lambda n: piece(n)[::-1], "shuffled": lambda n: "".join(rng.sample(x := piece(n), len(x))),
             "hex": lambda n: " ".join(f"{rng.getrandbits(32):08x}" for _ in range(n)),
             "one letter": lambda n: " ".join("a" * (3 + i) for i in range(n)),
             "one word": lambda n: " ".join("the" * (1 + i % 7) + "an" * (i // 7) for i in range(n)), "clean": piece}
    junk = [(kind, n, f(n)) for kind, f in kinds.items() for n in (12, 25, 80) for _ in range(30 if kind == "clean" else 3)]
    rows = spark.createDataFrame([(10**7 + i, t, "en", kind, n) for i, (kind, n, t) in enumerate(junk)], docs.schema)
    got = table(perplexity.quality_rules(docs.unionByName(rows)), "base_failed", "kept", "log_perplexity", "lowest", "highest")
    verdicts = defaultdict(list)
    for i, (kind, n, _) in enumerate(junk):
        failed, kept, *band = got[10**7 + i]
        if not failed:
            verdicts[kind, n].append((kept, *band))
    for kind in ("letters", "consonants", "backwards", "shuffled"):
        for n in (12, 25, 80):
            assert all(not kept and ppl > highest for kept, ppl, lowest, highest in verdicts[kind, n]), (kind, n)
    for kind, n in (("hex", 25), ("hex", 80)):
        assert verdicts[kind, n] and all(not kept and ppl > highest for kept, ppl, lowest, highest in verdicts[kind, n]), (kind, n)
    for kind, n in (("one letter", 12), ("one letter", 25), ("one letter", 80), ("one word", 80)):
        assert verdicts[kind, n] and all(not kept and ppl < lowest for kept, ppl, lowest, highest in verdicts[kind, n]), (kind, n)
    for n in (12, 25, 80):
        assert sum(v[0] for v in verdicts["clean", n]) >= 0.9 * len(verdicts["clean", n])


# ------------------------------------------------------------------------------------------------ 4 line dedup
def lines_of_repeated_runs(texts, min_words):
    """Line numbers, by rank, inside maximal equal runs of two places, all pairs of places compared, that have min_words words.  ``texts`` are
    (rank, text); equal ones count once."""
    texts = sorted({(d, t) for d, t in texts if t})
    own = [(d, i, x, len(WORD.findall(x))) for d, t in texts for i, x in enumerate(t.split("\n")) if WORD.search(x)]
    places = defaultdict(list)
    gone = defaultdict(set)
    for b, (d, _, x, _) in enumerate(own):
        for a in places[x]:
            if a and b and own[a - 1][2] == own[b - 1][2] and own[a - 1][0] == own[a][0] and own[b - 1][0] == d:
                continue  # the run begins earlier
            n = 0
            while b + n < len(own) and own[a + n][2] == own[b + n][2] and own[a + n][0] == own[a][0] and own[b + n][0] == d:
                n += 1
            if sum(w for _, _, _, w in own[b:b + n]) >= min_words:
                gone[d] |= {i for _, i, _, _ in own[b:b + n]}
        places[x].append(b)
    return gone


@pytest.mark.parametrize("min_words", [50, 12])
def test_line_dedup(spark, docs, odd_docs, min_words):
    for df in (docs, odd_docs):
        rows = df.selectExpr("*", "xxhash64(text) AS h").collect()
        rank = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["h"])
        gone = lines_of_repeated_runs([(rank(r), r["text"]) for r in rows], min_words)
        want = []
        for r in rows:
            cut = gone.get(rank(r), set()) if r["text"] else set()
            text = "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in cut) if cut else r["text"]
            want.append((r["doc_id"], text, len(cut)))
        got = [(r["doc_id"], r["text"], r["removed_lines"]) for r in linedup.delete_repeated_lines(df, min_words).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
        assert df.columns == linedup.delete_repeated_lines(df, min_words).columns[:-1]


def test_line_dedup_extends_over_short_lines(spark):
    shared = "\n".join(f"line {i} of the shared passage" for i in range(12))
    rows = [(1, f"alpha first\n{shared}\nomega first"), (2, f"{shared}\nother end"), (3, "line 3 of the shared passage\nalone"),
            (4, f"start\n\n{shared.replace('line 6', 'LINE 6')}")]
    got = {r["doc_id"]: r["text"] for r in linedup.delete_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()}
    assert got[1] == rows[0][1] and got[2] == "other end" and got[3] == rows[2][1]
    assert got[4] == "start\n\nLINE 6 of the shared passage"


def test_line_dedup_takes_whole_runs(spark):
    import random
    rng = random.Random(7)
    line = lambda n, name: " ".join(f"{name}{i}" for i in range(n))
    run = [line(30, "a"), line(80, "b"), line(30, "c")]
    block = [line(4, f"s{i}_") for i in range(10)] + [line(80, "p")]
    texts = ["\n".join(["one", *run, "end of one"]), "\n".join(["two", *run, "end of two"]),
             "\n".join(["three", *block, "end of three"]), "\n".join(["four", "", *block[:5], "", *block[5:], "end of four"]),
             # the first long line is found earlier without its short neighbour, and with it only in between
             "\n".join(["five", block[-1]]), "\n".join(["six", block[8], block[9], block[-1]])]
    pool = [line(n, f"q{n}_") for n in (1, 3, 7, 20, 30, 45, 60)]
    texts += ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    rows = list(enumerate(texts))
    gone = lines_of_repeated_runs(rows, 50)
    assert gone[1] == {1, 2, 3} and gone[3] == {2, 3, 4, 5, 6, *range(8, 14)}
    got = {r["doc_id"]: (r["text"], r["removed_lines"]) for r in linedup.delete_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: ("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]), len(gone[d])) for d, t in rows}


def test_line_dedup_by_row(spark):
    run = "\n".join(" ".join(f"r{i}_{j}" for j in range(40)) for i in range(2))
    rows = [(1, f"one\n{run}"), (2, f"two\n{run}\nend"), (2, "another text of the id"), (None, f"{run}\nnone"), (None, "no id\neither"), (None, f"x\n{run}\ny")]
    got = linedup.delete_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["text"], r["removed_lines"]) for r in got), key=repr) == sorted(
        [(*rows[0], 0), (2, "two\nend", 2), (*rows[2], 0), (None, "none", 2), (*rows[4], 0), (None, "x\ny", 2)], key=repr)


# ------------------------------------------------------------------------------------------------ 5 n-gram join
def jaccard_rows(rows, share=75):
    def shingles(t):
        ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset()
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)]


def jaccard_got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngramjoin.ngram_jaccard(df).collect()), key=repr)


def test_incidence_runs_carry_no_more_than_their_set_and_entries():
    """Where every entry is a run of its own, as in many blocks, a run takes some 14 bytes on its way, and numbers survive it."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    n = 4000
    rows = list(ngramjoin._packed(np.zeros(n, np.int64), np.arange(n), rng.integers(-2**63, 2**63, n), [rng.integers(0, 2**40, n).astype(np.uint64)], [ngramjoin.pack40]))
    sent = sum(len(pa.compress(x, "lz4_raw", asbytes=True)) for row in rows for x in row[1:])
    assert sent < 14 * n
    numbers = np.array([0, 1, 255, 256, 70_000, 2**31 - 1])
    assert ngramjoin.unplanes(ngramjoin.planes(numbers)).tolist() == numbers.tolist() and len(ngramjoin.unplanes(b"")) == 0


def test_ngram_jaccard(spark, docs, odd_docs):
    for df in (docs, odd_docs):
        assert jaccard_got(df) == sorted(jaccard_rows([(r["doc_id"], r["text"]) for r in df.collect()]), key=repr)


def test_ngram_jaccard_chains_and_common_passages(spark):
    import random
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for d in range(60):  # near copies at several distances: chains whose ends don't link
        ws = list(passage)
        for at in range(0, d % 12):
            ws[(at * 5 + d) % 60] = f"x{rng.randrange(9)}"
        rows.append((1000 - d, " ".join(ws)))
    for d in range(40):  # a passage that many share, without links
        rows.append((2000 + d, " ".join(passage + [f"u{d}_{i}" for i in range(rng.randrange(10, 40))])))
    rows += [(5, " ".join(passage).upper()), (6, "a b"), (7, "A B"), (8, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert jaccard_got(df) == sorted(jaccard_rows(rows), key=repr)


def test_one_per_component(spark, docs):
    classes = ngramjoin.ngram_jaccard(docs)
    kept = ngramjoin.one_per_component(docs.unionByName(docs.limit(20)), classes)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in classes.collect()})


# ------------------------------------------------------------------------------------------------ 6 substring dedup
def units_removed(rows, unit, min_words):
    """Per row the numbers, starts and ends of the units cut out; rows are ranked as they come."""
    first, out, own = {}, [], []
    for i, text in enumerate(rows):
        spans = [(s, e) for s, e in substrings.unit_spans(text or "", unit) if (text or "")[s:e].split()]
        own.append(spans)
        for s, e in spans:
            first.setdefault(substrings.normalise(text[s:e]), (i, s))
    for i, (text, spans) in enumerate(zip(rows, own)):
        again = [first[substrings.normalise(text[s:e])] != (i, s) for s, e in spans]
        gone, lo = [], 0
        while lo < len(spans):
            hi = lo
            while hi < len(spans) and again[hi]:
                hi += 1
            if sum(len(text[s:e].split()) for s, e in spans[lo:hi]) >= min_words:
                gone += spans[lo:hi]
            lo = hi + 1
        out.append(gone)
    return out


@pytest.mark.parametrize("unit,min_words", [("line", 1), ("line", 20), ("sentence", 25), ("sentence", 3), ("paragraph", 25)])
def test_substring_dedup(spark, docs, odd_docs, unit, min_words):
    for df in (docs, odd_docs):
        rows = df.collect()
        # rows of one id that differ are ranked by a hash of their text
        tie = {r["text"]: r["h"] for r in df.selectExpr("text", "xxhash64(text) AS h").collect()}
        rows = sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, tie[r["text"]]))
        want = Counter((r["doc_id"], r["text"], tuple(g)) for r, g in zip(rows, units_removed([r["text"] for r in rows], unit, min_words)))
        source = {(r["doc_id"], r["n_chars"], r["text"] is None): r["text"] for r in rows}
        texts = defaultdict(list)
        for r in rows:
            texts[r["doc_id"]].append(r["text"] or "")
        got = Counter()
        for r in substrings.remove_repeated_units(df, unit, min_words).collect():
            whole = source[r["doc_id"], r["n_chars"], r["text"] is None]
            got[r["doc_id"], whole, tuple((x["start"], x["end"]) for x in r["removed"])] += 1
            out, at = "", 0
            for x in r["removed"]:
                assert not out or at <= x["start"]
                out += whole[at:x["start"]]
                at = x["cut"]
                assert not whole[x["end"]:at].strip()
                own = substrings.normalise(whole[x["start"]:x["end"]])
                assert any(substrings.normalise(other[s:e]) == own for other in texts[x["kept_doc_id"]]
                           for s, e in substrings.unit_spans(other, unit) if s == x["kept_start"])
            if whole:
                out += whole[at:]
                assert r["text"] == (out[:-1] if r["removed"] and at == len(whole) and out.endswith("\n") else out)
        assert got == want


def test_substring_dedup_by_row(spark):
    sentences = [f"This is sentence number {i} of the shared passage." for i in range(6)]
    passage = " ".join(sentences)
    rows = [(None, f"x. {passage} y."), (None, f"x. {passage} y."), (2, f"Own start. {passage}\nOwn end."), (2, f"Other text.\n{passage}\nOther end."), (3, sentences[0]),
            (1, f"{sentences[3]} {sentences[4]}\n\n{sentences[5]} Mine.")]
    got = sorted(((r["doc_id"], r["text"], len(r["removed"])) for r in substrings.remove_repeated_units(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    first, second = "Own start. \nOwn end.", "Other text.\nOther end."
    assert got[0] == (1, rows[5][1], 0) and got[3] == (3, sentences[0], 0)
    # sentences 3 to 5 are those of the smaller id, the others stay in one of the two texts of id 2
    assert sorted(n for d, _, n in got if d == 2) == [3, 6] and {first, second} & {t for d, t, _ in got if d == 2}
    assert sorted(n for d, _, n in got if d is None) == [6, 8]


# ------------------------------------------------------------------------------------------------ 7 packing
def test_best_bounds_is_optimal():
    from itertools import combinations
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths = np.sort(rng.choice(40, rng.integers(1, 9), replace=False) + 1)
        counts = rng.integers(1, 20, len(lengths))
        k = int(rng.integers(1, 5))

        def padding(bounds):
            b = np.array(bounds)[np.searchsorted(bounds, lengths)]
            return ((b - lengths) * counts).sum()
        best = min(padding(sorted({*c, lengths[-1]})) for c in combinations(lengths.tolist(), min(k, len(lengths)) - 1))
        assert padding(packing.best_bounds(lengths, counts, k)) == best


@pytest.mark.parametrize("block", [7, 50_000])
def test_packing(spark, docs, odd_docs, monkeypatch, block):
    monkeypatch.setattr(packing, "ROWS_PER_BLOCK", block)
    for df in (docs, odd_docs):
        rows = packing.pack(packing.word_lengths(df), n_buckets=4, max_length=300, token_budget=1000).collect()
        want = Counter()
        for r in df.collect():
            n = len(WORD.findall(r["text"] or ""))
            want.update((r["doc_id"], s, min(300, n - s)) for s in range(0, n, 300))
        assert Counter((r["doc_id"], r["start"], r["length"]) for r in rows) == want
        bounds = sorted({r["padded_length"] for r in rows})
        assert len(bounds) <= 4 and all(r["padded_length"] == next(b for b in bounds if b >= r["length"]) for r in rows)
        batches = defaultdict(list)
        for r in rows:
            batches[r["bucket"], r["batch_id"]].append(r)
        short = Counter()
        for (bucket, _), own in batches.items():
            per = max(1, 1000 // own[0]["padded_length"])
            assert sorted(r["slot"] for r in own) == list(range(len(own))) and len(own) <= per
            short[bucket] += len(own) < per
        assert max(short.values()) <= 1


# ------------------------------------------------------------------------------------------------ 9 classifier
def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), grading.grades(spark.read.parquet(f"{sf}/labels.parquet"))
    held = labels.where("doc_id % 4 = 0")
    got = {r["doc_id"]: r for r in grading.grade_documents(docs, labels.where("doc_id % 4 <> 0")).collect()}
    rows = [(got[r["doc_id"]], r["grade"]) for r in held.collect()]
    assert all(0 <= g["tail_probability"] <= 1 and 0 <= g["expected_grade"] <= 2 for g, _ in rows)
    mean = lambda k: np.mean([g["expected_grade"] for g, y in rows if y == k])
    assert mean(0) < mean(2) and mean(1) < mean(2)
    good = [g["kept"] for g, y in rows if y == 2]
    assert sum(good) / len(good) > 0.9
    assert sum((g["tail_probability"] >= 0.5) == (y == 2) for g, y in rows) / len(rows) > max(0.75, np.mean([y == 2 for _, y in rows]))


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(2)
    n = 600
    word = rng.integers(0, 3, n)
    grade = np.where(rng.random(n) < 0.9, word, rng.integers(0, 3, n))
    w, theta = grading.fit_ordinal(np.arange(n), word + 10, np.ones(n), grade, 3)
    assert w[10] < w[11] < w[12] and theta[0] < theta[1]


def plain_ordinal(at, value, rows, grade, n_grades, monkeypatch):
    """Penalised negative mean log likelihood of weights and thresholds, text by text."""
    def loss(w, theta):
        total = 0.0
        for i, y in enumerate(grade):
            eta = sum(w[a] * v for a, v, r in zip(at, value, rows) if r == i)
            upper = 1.0 if y == n_grades - 1 else 1 / (1 + math.exp(-(theta[y] - eta)))
            lower = 0.0 if y == 0 else 1 / (1 + math.exp(-(theta[y - 1] - eta)))
            total -= math.log(upper - lower)
        return total / len(grade) + grading.RIDGE / 2 * float((w * w).sum())
    return loss


def test_ordinal_fit_is_at_the_minimum_of_the_likelihood(monkeypatch):
    monkeypatch.setattr(grading, "DIMENSIONS", 6)
    monkeypatch.setattr(grading, "STEPS", 4000)
    monkeypatch.setattr(grading, "RATE", 0.01)
    monkeypatch.setattr(grading, "RIDGE", 0.05)
    rng = np.random.default_rng(3)
    n = 40
    rows = np.repeat(np.arange(n), 2)
    at, value = rng.integers(0, 6, 2 * n), rng.normal(size=2 * n)
    true = np.bincount(rows, (np.arange(6) / 2.0)[at] * value, minlength=n)
    grade = np.digitize(true + rng.logistic(size=n), [-1.0, 1.0])
    w, theta = grading.fit_ordinal(rows, at, value, grade, 3)
    w = w.astype(float)
    loss = plain_ordinal(at, value, rows, grade, 3, monkeypatch)
    best = loss(w, theta)
    for j in range(6):  # finite differences in every direction: no step lowers the loss
        step = np.zeros(6)
        step[j] = 1e-4
        assert abs(loss(w + step, theta) - loss(w - step, theta)) / 2e-4 < 2e-3
        assert loss(w + 500 * step, theta) > best and loss(w - 500 * step, theta) > best
    for j in range(2):
        step = np.zeros(2)
        step[j] = 1e-4
        assert abs(loss(w, theta + step) - loss(w, theta - step)) / 2e-4 < 2e-3


def test_grades_follow_from_weights_and_thresholds(spark, docs):
    labels = grading.grades(spark.read.parquet(f"{SF}/labels.parquet"))
    model = grading.fit(docs, labels).first()
    w, theta = np.frombuffer(model["weights"], np.float32).astype(float), model["thresholds"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    features = {}
    for d, t in texts.items():
        (features[d],) = [f for c in chunks(grading.ascii_lower(pa.array([t]))) for f in grading.chunk_features(c)]
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    for r in grading.grade_documents(docs, labels).collect():
        at, value = features[r["doc_id"]]
        eta = sum(w[a] * float(v) for a, v in zip(at, value))
        below = [sigmoid(t - eta) for t in theta] + [1.0]
        chance = [b - a for a, b in zip([0.0, *below], below)]
        assert r["expected_grade"] == pytest.approx(sum(k * p for k, p in enumerate(chance)), abs=1e-6)
        assert r["tail_probability"] == pytest.approx(chance[-1], abs=1e-6)
        assert r["kept"] == (len(at) > 0 and r["tail_probability"] >= grading.KEEP_PROBABILITY)


def test_classifier_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(6, 1, 0), (9, 1, 0), (12, 0, 0), (13, 0, 1), (None, 1, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = grading.grade_documents(odd_docs, grading.grades(labels)).collect()
    assert len(got) == odd_docs.count() and not any(r["kept"] for r in got if r["doc_id"] in (0, 1, 2))
    none = grading.grade_documents(odd_docs, grading.grades(labels.where("false"))).collect()
    assert {round(r["tail_probability"], 6) for r in none} == {round(1 / 3, 6)} and not any(r["kept"] for r in none)


# ------------------------------------------------------------------------------------------------ 10 mixing
def targets(sizes, weights, budget=1.5, cap=2.0):
    free, out, left = set(sizes), {}, budget * sum(sizes.values())
    while free:
        level = left / sum(weights[s] for s in free)
        full = {s for s in free if cap * sizes[s] <= level * weights[s]}
        if not full:
            return out | {s: level * weights[s] for s in free}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= full
    return out


@pytest.mark.parametrize("block", [5, 50_000])
def test_mixing(spark, docs, odd_docs, monkeypatch, block):
    monkeypatch.setattr(mixing, "ROWS_PER_BLOCK", block)
    for df in (docs, odd_docs):
        rows = mixing.mix_sources(df).collect()
        size, largest = Counter(), Counter()
        for r in df.collect():
            n = len(WORD.findall(r["text"] or ""))
            size[r["source"]] += n
            largest[r["source"]] = max(n, largest[r["source"]])
        order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
        want = targets(size, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
        taken = Counter()
        for r in rows:
            assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == size[r["source"]]
            assert r["taken"] <= 2 * r["size"] and r["taken"] % max(1, r["size"]) == 0
            taken[r["source"]] += r["taken"]
        assert len(rows) == df.count()
        assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in size)
        again = Counter((r["doc_id"], r["size"], r["taken"]) for r in mixing.mix_sources(df.repartition(7)).collect())
        assert again == Counter((r["doc_id"], r["size"], r["taken"]) for r in rows)


def test_apply_mix(spark, docs):
    mix = mixing.mix_sources(docs)
    copies = table(mix, "copies")
    assert Counter(r["doc_id"] for r in mixing.apply_mix(docs, mix).collect()) == Counter({d: c for d, (c,) in copies.items() if c})


def test_mixing_without_ids_reaches_the_targets(spark):
    import random
    rng = random.Random(9)
    rows = [(None if i % 3 == 0 else i % 200, " ".join("w" for _ in range(rng.randrange(1, 30))) if i % 7 else "same text of many rows", f"src{i % 4}", "en", i) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n int")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    sizes = Counter()
    for _, t, s, _, _ in rows:
        sizes[s] += len(t.split())
    want = targets(sizes, dict(zip(sorted(sizes), (3, 1, 2, 3))))
    taken, copies = Counter(), Counter()
    for r in out.collect():
        taken[r["source"]] += len(r["text"].split())
        copies[r["n"]] += 1
    assert all(abs(taken[s] - want[s]) <= 15 + 1 for s in want) and max(copies.values()) <= 2
    again = Counter(tuple(r)[:4] for r in mixing.mixed(docs.repartition(5)).collect())
    assert again == Counter(tuple(r)[:4] for r in out.collect())


# ------------------------------------------------------------------------------------------------ pipeline
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, SF)
        rows = out.collect()
        if name != "pack":
            assert out.columns == docs.columns
        if name == "quality_rules":
            kept = {r["doc_id"] for r in rows}
            assert not any(base(r["text"])[5] for r in rows) and len(kept) > 0.6 * len(before)
        elif name == "line_dedup":
            assert len({r["doc_id"] for r in before}) == len(before)
            gone = lines_of_repeated_runs([(r["doc_id"], r["text"]) for r in before], 50)
            want = {r["doc_id"]: "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in gone[r["doc_id"]]) for r in before}
            assert {r["doc_id"]: r["text"] for r in rows} == {d: t for d, t in want.items() if WORD.search(t)}
        elif name == "ngram_jaccard":
            assert sorted(r["doc_id"] for r in rows) == sorted({c for _, _, c in jaccard_rows([(r["doc_id"], r["text"]) for r in before])})
        elif name == "pack":
            assert sum(r["length"] for r in rows) == sum(len(WORD.findall(r["text"])) for r in before)
        docs = spark.createDataFrame(rows, out.schema)
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_stages_decide_by_row(spark, docs):
    import random
    rng = random.Random(4)
    text = lambda n=60: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared, copy = text(), text()
    rows = [(None, text()), (None, text()), (None, copy), (None, copy), (1, copy), (2, text()), (2, text()), (3, shared), (3, shared)]
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted({(d, t) for d, t in rows if d is not None or t != copy}, key=repr)
    got = corpus_pipeline.ngram_jaccard(spark, df, SF)
    assert sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=repr) == want
    # one good row does not let junk of the same or no id through
    good = [r["text"] for r in corpus_pipeline.quality_rules(spark, docs, SF).where("lang = 'en'").limit(2).collect()]
    more = spark.createDataFrame([(d, t, "en", "s", 1) for d in (None, 10**6) for t in (*good, "too short", "same " * 40)], df.schema)
    out = corpus_pipeline.quality_rules(spark, docs.select(*df.columns).unionByName(more), SF).where("doc_id IS NULL OR doc_id = 1000000").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == sorted(((d, t) for d in (None, 10**6) for t in good), key=repr)
    # a row without id is compared, and two texts of one id are not mixed
    lines = [(1, "a1\n" + shared), (2, text() + "\nb2"), (2, "c2\n" + shared + "\nd2"), (None, "e\n" + shared)]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in lines], df.schema)
    assert sorted([(r["doc_id"], r["text"]) for r in corpus_pipeline.line_dedup(spark, df, SF).collect()], key=repr) == sorted(
        [lines[0], lines[1], (2, "c2\nd2"), (None, "e")], key=repr)


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    for df in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SF)
            assert out.count() <= 4 * df.count() + 40
            df = out if out.columns == df.columns else df


def test_empty_tables(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, grade int")
    for out in (perplexity.quality_rules(no_docs), linedup.delete_repeated_lines(no_docs), ngramjoin.ngram_jaccard(no_docs),
                substrings.remove_repeated_units(no_docs), packing.pack(packing.word_lengths(no_docs)), mixing.mix_sources(no_docs),
                grading.grade_documents(no_docs, labels)):
        assert out.count() == 0

"""The character model of the quality rules against brute force, and what it tells from clean text."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from newsmill.llm import ngrammodel, perplexity, queries
from newsmill.llm.textarrays import chunks

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BEGIN = -1


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, (t, lang) in enumerate(texts)], DOCS)


def table(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def grams(text):
    s = [BEGIN] * 3 + [ord(x) for x in text]
    return [tuple(s[i - 3:i + 1]) for i in range(3, len(s))]


def adjusted(counts):
    """By order: counts, below the number of left neighbours but for n-grams that begin a text."""
    out, raw = {4: dict(counts)}, dict(counts)
    for k in (3, 2, 1):
        left, shorter = Counter(), Counter()
        for g in out[k + 1]:
            left[g[1:]] += 1
        for g, n in raw.items():
            shorter[g[1:]] += n
        out[k] = {g: shorter[g] if k > 1 and g[0] == BEGIN else n for g, n in left.items()}
        raw = shorter
    return out


def brute_force(texts):
    """Mean -log p of every text from the others of its language; discounts and symbols from all."""
    out = []
    for i, (text, lang) in enumerate(texts):
        counts = {j: Counter(grams(t or "")) for j, (t, other) in enumerate(texts) if (other or "") == (lang or "")}
        whole = adjusted(sum(counts.values(), Counter()))
        others = adjusted(sum((c for j, c in counts.items() if j != i), Counter()))
        off = {}
        for k, a in whole.items():
            n = [sum(x == m for x in a.values()) for m in (1, 2, 3, 4)]
            e = [m - (m + 1) * n[0] / (n[0] + 2 * n[1]) * n[m] / n[m - 1] for m in (1, 2, 3)] if min(n) else []
            off[k] = [0, *(e if e and all(0 < x < m for m, x in enumerate(e, 1)) else [0.5, 1, 1.5])]
        contexts = {k: defaultdict(list) for k in others}
        for k, a in others.items():
            for g, n in a.items():
                contexts[k][g[:-1]].append(n)

        def p(g):
            if not g:
                return 1 / (len(whole[1]) + 1)
            seen, below = contexts[len(g)].get(g[:-1]), p(g[1:])
            if not seen:
                return below
            d = off[len(g)]
            n = others[len(g)].get(g, 0)
            return (n - d[min(n, 3)] + sum(d[min(x, 3)] for x in seen) * below) / sum(seen)

        own = grams(text or "")
        out.append(-sum(math.log(p(g)) for g in own) / len(own) if own else None)
    return out


def sentences(rng, n, of="The river Ran past 12 old Houses; nobody saw it, and Nobody asked why 7 boats were there.".split()):
    return " ".join(rng.choice(of) for _ in range(n))


def mixed_texts():
    rng = random.Random(5)
    texts = [(sentences(rng, n), "en") for n in (1, 9, 30, 60, 12)] + [("", "en"), (None, "en"), ("A", "en"), ("a\tb\nc", "en")]
    texts += [("Ärger übt 多くの 文字 в тексте 😀", x) for x in ("de", None, "")] + [("多くの人 多くの本 が в лесу 😀😀", "de"), ("only one", "xx")]
    return texts + [texts[2], texts[3]]


def test_log_perplexity_from_whole_characters_of_the_other_documents(spark):
    texts = mixed_texts()
    got = table(perplexity.quality_rules(rows_of(spark, texts).repartition(2), symbols="characters"), "log_perplexity")
    for i, want in enumerate(brute_force(texts)):
        assert got[i][0] == (pytest.approx(want, rel=1e-9) if want is not None else None), texts[i]


def test_small_blocks_and_many_ranges_score_alike(spark, monkeypatch):
    docs = rows_of(spark, mixed_texts()).repartition(2)
    counts = ngrammodel.ngram_counts(docs)
    got = []
    for entries, size in ((2, 100), (1 << 16, 1 << 20)):
        monkeypatch.setattr(ngrammodel, "SHARD_ENTRIES", entries)
        scored = ngrammodel.score(docs, *ngrammodel.fit_model(counts), perplexity.base_measures, block_bytes=size)
        got.append(sorted((r["doc_id"], r["n_grams"], r["log_prob"], r["log_square"]) for r in scored.collect()))
    assert got[0] == got[1] and len(got[0]) == len(mixed_texts())


def test_more_characters_than_machine_integers_hold(monkeypatch):
    texts = [t for t, _ in mixed_texts()]
    langs = [x or "" for _, x in mixed_texts()]
    got = []
    for largest in (1 << 62, 1):
        monkeypatch.setattr(ngrammodel, "LARGEST", largest)
        h = ngrammodel.wanted(pa.array(texts), langs)
        found = ngrammodel.Found(h, [(h % np.uint64(p)).astype(float) + 40 for p in (7, 11, 13, 17, 19)])
        (c,) = chunks(pa.array(texts))
        g = ngrammodel.Grams(c, langs)
        pair, times = np.unique(g.tagged(np.arange(c.n)), return_counts=True)
        got.append((h.tolist(), pair.tolist(), ngrammodel.LeftOut(g, found)._probability(4, pair, times.astype(float), times.astype(float)).tolist()))
        assert (g.kind is object) == (largest == 1)
    assert got[0] == got[1]


@pytest.mark.parametrize("held", [60, 2_000_000])
def test_counts_of_interleaved_languages(monkeypatch, held):
    monkeypatch.setattr(ngrammodel, "COUNTS_HELD", held)
    texts = [(x or "", t) for t, x in mixed_texts()] * 4
    batch = pa.record_batch([pa.array(x) for x in zip(*texts)], ["lang", "text"])
    parts = list(ngrammodel._count(batch.slice(i, 3) for i in range(0, len(texts), 3)))
    got, want = Counter(), Counter()
    for b in parts:
        for lang, first, rest, n in zip(*(c.to_pylist() for c in b.columns)):
            got[lang, tuple(BEGIN if s == ngrammodel.START else s for s in (first, rest >> 42, rest >> 21 & ngrammodel.START, rest & ngrammodel.START))] += n
    for lang, t in texts:
        want.update((lang, g) for g in grams(t or ""))
    assert got == want and (len(parts) > 3) == (held == 60)


def test_adjusted_counts_of_every_order(spark):
    rng = random.Random(6)
    texts = [sentences(rng, 80) for _ in range(12)]
    whole = adjusted(sum((Counter(grams(t)) for t in texts), Counter()))
    found = ngrammodel.adjusted_counts(ngrammodel.ngram_counts(rows_of(spark, [(t, "en") for t in texts])))
    got = defaultdict(dict)
    for r in found.collect():
        symbols = [r["rest"] >> 21 * i & ngrammodel.START for i in range(min(r["k"], 3))][::-1]
        symbols = [r["first"]] + symbols if r["k"] == 4 else symbols
        got[r["k"]][tuple(BEGIN if s == ngrammodel.START else s for s in symbols)] = r["n"]
    assert got == whole


def test_no_character_is_folded_or_skipped():
    texts = ["aA", "Éé", "1 2", ".;", "é", "", None, "多字", "߿ࠀ￿\U00010000\U0010ffff"]
    points, bounds = zip(*(ngrammodel.code_points(c) for c in chunks(pa.array(texts), limit=5)))
    got = [p[b[i]:b[i + 1]].tolist() for p, b in zip(points, bounds) for i in range(len(b) - 1)]
    assert got == [[ord(x) for x in t or ""] for t in texts]


def test_model_grows_with_the_corpus_and_its_ranges_are_sorted(spark):
    rng = random.Random(7)
    text = lambda: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3000))
    sizes = []
    for n in (1, 4):
        model, shards = ngrammodel.fit_model(ngrammodel.ngram_counts(rows_of(spark, [(text(), "zh") for _ in range(n)])))
        whole = [np.frombuffer(r["hash"], np.uint64) for r in model.orderBy("shard").collect()]
        assert shards & (shards - 1) == 0 and len(whole) <= shards
        flat = np.concatenate(whole)
        assert (flat[1:] > flat[:-1]).all()
        sizes.append(len(flat))
    assert sizes[1] > 3.5 * sizes[0]


def test_queries_tell_characters_apart_that_have_one_class(spark, tmp_path):
    """Upper case, other digits and other scripts cost as much as they are rare; by classes they all score alike."""
    rng = random.Random(8)
    clean = [sentences(rng, 60) for _ in range(60)]
    junk = [clean[0].upper(), clean[1].swapcase(), "".join(chr(ord(x) + 0x400) if x.isalpha() else x for x in clean[2])]
    docs = rows_of(spark, [(t, "en") for t in clean + junk])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = table(queries.QUERIES["op1_quality_rules"](spark, str(tmp_path)), "base_failed", "kept", "log_perplexity", "highest")
    for i in range(60, 63):
        failed, kept, ppl, highest = got[i]
        assert not failed and not kept and ppl > highest
    assert all(got[i][1] for i in range(60) if not got[i][0]) and sum(not got[i][0] for i in range(60)) > 30
    left = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()}
    assert left == {i for i, x in got.items() if x[1]}


def test_blocks_hold_all_rows_and_follow_the_bytes():
    texts = ["abc", None, "", "x" * 25, "defg", "hi", "x" * 11, "", "jkl"]
    batch = pa.record_batch([pa.array(range(9)), pa.array(["en"] * 9), pa.array(texts)], ["key", "lang", "text"])
    got = list(ngrammodel.blocks([batch.slice(0, 4), batch.slice(4, 0), batch.slice(4, 5)], 10))
    assert [x for b in got for x in b.column(0).to_pylist()] == list(range(9))
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column(2).to_pylist()) <= 10 for b in got)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    assert perplexity.quality_rules(no_docs, symbols="characters").count() == 0
    got = perplexity.quality_rules(odd_docs, symbols="characters")
    base = ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    key = lambda df: sorted((tuple(r) for r in df.select(*base).collect()), key=repr)
    assert key(got) == key(perplexity.quality_rules(odd_docs))
    with pytest.raises(ValueError, match="characters or classes"):
        perplexity.quality_rules(no_docs, symbols="words")

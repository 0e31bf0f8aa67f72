"""Conversation repair, licence scans and vector codes against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from newsmill.llm import licenses, queries, repair, vectorcodes

SF = "/root/testdata/sf0.001"

# ------------------------------------------------------------------------------------------------ 11 conversation repair
STEP = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
MADE = {"E": "u", "S": "u", "U": "a", "A": "u"}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = [c for c in text if c not in " \t\n\x0b\x0c\r"]
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def audits(rows, marks, i=0, state="E", inserts=0):
    """(cost, audit) of all edits with two inserts at most at one place."""
    if i == len(rows) and state in "EA":
        yield 0, ""
    if inserts < 2:
        for c, rest in audits(rows, marks, i, STEP[state, MADE[state]], inserts + 1):
            yield 5 + c, "I" + rest
    if i < len(rows):
        for c, rest in audits(rows, marks, i + 1, state):
            yield 2 + c, "D" + rest
        if marks[i] not in ("blank", "duplicate"):
            extra = 5 * (marks[i] == "truncated")
            own = rows[i][0][:1]
            if (state, own) in STEP:
                for c, rest in audits(rows, marks, i + 1, STEP[state, own]):
                    yield extra + c, "K" + rest
            for c, rest in audits(rows, marks, i + 1, STEP[state, MADE[state]]):
                yield 1 + extra + c, "R" + rest


def best_from_the_end(rows, marks):
    """Cheapest and least audit by a plain dynamic program over suffixes."""
    none = (10**9, "")
    after = {"E": (0, ""), "S": none, "U": none, "A": (0, "")}

    def with_inserts(t):
        for _ in range(3):
            t = {s: min(t[s], (5 + t[STEP[s, MADE[s]]][0], "I" + t[STEP[s, MADE[s]]][1])) for s in "ESUA"}
        return t

    after = with_inserts(after)
    for (role, _), mark in zip(reversed(rows), reversed(marks)):
        here = {}
        for s in "ESUA":
            found = [(2 + after[s][0], "D" + after[s][1])]
            if mark not in ("blank", "duplicate"):
                extra = 5 * (mark == "truncated")
                if (s, role[:1]) in STEP:
                    t = after[STEP[s, role[:1]]]
                    found.append((extra + t[0], "K" + t[1]))
                t = after[STEP[s, MADE[s]]]
                found.append((1 + extra + t[0], "R" + t[1]))
            here[s] = min(found)
        after = with_inserts(here)
    return after["E"]


def repaired(rows, audit):
    out, state, left = [], "E", iter(rows)
    for e in audit:
        if e == "I":
            state = STEP[state, MADE[state]]
            out.append(({"U": "user", "A": "assistant"}[state], ""))
            continue
        role, text = next(left)
        if e == "K":
            state = STEP[state, role[:1]]
            out.append((role, text))
        elif e == "R":
            state = STEP[state, MADE[state]]
            out.append(({"U": "user", "A": "assistant"}[state], text))
    assert state in "EA" and next(left, None) is None
    return out


def digest(rows, turns):
    marks = faults(rows)
    cost, audit = best_from_the_end(rows, marks)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[:1] for r, _ in rows]
    return (gaps, *(marks.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired(rows, audit)).encode()).hexdigest())


def some_rows(rng, n):
    return [(rng.choice(["user", "assistant", "assistant", "system", "tool", ""]), rng.choice(["", "a.", "b.", f"x{rng.random()}.", "cut", f"y{rng.random()}?", " \n"]))
            for _ in range(n)]


def plain_audit(rows, marks):
    a = repair.Audit()
    for (role, _), mark in zip(rows, marks):
        a.row(role[:1], mark in ("blank", "duplicate"), mark == "truncated")
    return a.finish()


def test_audits_are_the_cheapest_and_least_of_all():
    rng = random.Random(1)
    for _ in range(300):
        rows = some_rows(rng, rng.randrange(5))
        marks = faults(rows)
        want = min(audits(rows, marks))
        assert best_from_the_end(rows, marks) == want
        assert plain_audit(rows, marks) == want[1]


def test_settled_edits_and_colliding_hashes(monkeypatch):
    rng = random.Random(2)
    for modulus in (repair._MOD, 3):
        monkeypatch.setattr(repair, "_MOD", modulus)
        for n in (60, 700):
            rows = some_rows(rng, n)
            marks = faults(rows)
            a, parts = repair.Audit(), []
            for i, ((role, _), mark) in enumerate(zip(rows, marks)):
                a.row(role[:1], mark in ("blank", "duplicate"), mark == "truncated")
                if i % 7 == 0:
                    parts.append(a.settled())
            assert any(parts)
            assert "".join(parts) + a.finish() == best_from_the_end(rows, marks)[1]


TURNS = "text string, conv_id long, fault string, turn long, role string, cost int"


def test_repaired_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "HELD_ROWS", 5)
    rng = random.Random(3)
    rows = []
    for conv in [None, 0, 1, 2, 3, -4]:
        for i, (role, text) in enumerate(some_rows(rng, 0 if conv == 3 else 300 if conv is None else 12)):
            rows.append((None if rng.random() < 0.1 else text, conv, "f", None if i % 11 == 10 else i - i % 4, None if rng.random() < 0.1 else role, 1))
    rows += [rows[0], rows[0], ("long " * 300_000 + ".", 2, "f", 99, "user", 1), (None, 7, None, None, None, None)]
    df = spark.createDataFrame(rows, TURNS)
    edits = repair.repair_conversations(df)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.audit_digests(edits).collect()}
    want = {}
    for conv in {r[1] for r in rows}:
        own = sorted((r[3] is not None, r[3] or 0, " " if r[4] is None else r[4], " " if r[0] is None else r[0]) for r in rows if r[1] == conv)
        want[conv] = digest([(r, t) for _, _, r, t in own], [t if known else None for known, t, _, _ in own])
    assert got == want
    kept = edits.where("conv_id = 2 and role is not null").orderBy("step").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in kept))
    assert repair.audit_digests(repair.repair_conversations(df.where("false"))).count() == 0


def test_damage_and_conversations_without_rows(spark):
    rows = [(c, t, "assistant", f"Is it? {t}!") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            want += [(c, t, "user" if kind == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text))] * (2 if kind == 3 else 1)
    damaged = repair.damage(df)
    assert sorted(map(repr, (tuple(r)[:4] for r in damaged.where("present").collect()))) == sorted(map(repr, want))
    gone = df.where("conv_id = 1").withColumn("present", df.conv_id.isNull())
    out = repair.audit_digests(repair.repair_conversations(gone, present="present")).collect()
    assert [tuple(r) for r in out] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ------------------------------------------------------------------------------------------------ 12 licence scans
def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def all_matches(words, template, least):
    """Maximal equal stretches of at least ``least`` words: first and last word of the text, first of the template."""
    out = []
    for i in range(len(words)):
        for j in range(len(template)):
            if words[i] == template[j] and not (i and j and words[i - 1] == template[j - 1]):
                n = 0
                while i + n < len(words) and j + n < len(template) and words[i + n] == template[j + n]:
                    n += 1
                if n >= least:
                    out.append((i, i + n - 1, j))
    return sorted(out)


class Recorder(licenses.Scanner):
    def chain(self, template, matches):
        self.found.setdefault(template, []).extend(matches)
        return super().chain(template, matches)


@pytest.mark.parametrize("pool", [2, 3, 12])
def test_matches_are_all_maximal_stretches(pool):
    rng = random.Random(pool)
    for _ in range(40):
        sample = lambda n: " ".join(f"w{rng.randrange(pool)}" for _ in range(n))
        phrases = [("p", sample(2)), ("q", sample(3)), ("p", sample(2))]
        notices = [(f"n{i}", sample(rng.randrange(2, 20))) for i in range(5)]
        scanner = Recorder(phrases, notices, min_match=3, max_gap=rng.choice([0, 3, 50]))
        scanner.found = {}
        text = " ".join(rng.choice(notices)[1] if rng.random() < 0.3 else f"w{rng.randrange(pool + 1)}" for _ in range(40))
        words = text.split()
        n, places, spans = scanner.scan(text.encode())
        assert n == len(words)
        assert sorted(places) == sorted((t, i) for t, (_, p) in enumerate(phrases) for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
        for t, (_, p) in enumerate(notices, len(phrases)):
            assert sorted(scanner.found.get(t, [])) == all_matches(words, p.split(), min(3, len(p.split())))
        for s in spans:
            assert 0 < s.share <= 1 and s.covered <= s.last - s.first + 1 and s.label == f"n{s.template - len(phrases)}"


def test_spans_cover_changed_texts():
    scanner = licenses.Scanner()
    label = dict.fromkeys(lab for lab, _ in licenses.NOTICES)
    mit = next(t for lab, t in licenses.NOTICES if lab == "mit" and len(t.split()) > 50)
    w = mit.split()
    broken = " ".join(w[:20] + ["(c)", "2020", "Some", "One"] + w[24:60] + w[62:])
    found = scanner.scan(("intro of the software text. " + broken.upper() + " the end").encode())[2]
    assert [s.label for s in found] == ["mit"] and 0.8 <= found[0].share < 1 and found[0].first == 5
    assert scanner.scan((" ".join(w[:40])).encode())[2] == []
    twice = scanner.scan((mit + "\n" + "word " * 30 + mit).encode())[2]
    assert [s.label for s in twice] == ["mit", "mit"] and twice[0].last < twice[1].first
    for text, want in [("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}), ("GNU General Public License, version 3.", {"gpl-3.0"}),
                       ("GNU General Public License, version 1.", set()), ("Released under the MIT License.", {"mit"}), ("mit licence", set())]:
        assert {s.label for s in scanner.scan(text.encode())[2]} == want and want <= set(label)


def test_pieces_of_a_long_text(monkeypatch):
    monkeypatch.setattr(licenses, "PIECE", 7)
    rng = random.Random(5)
    text = " ".join(rng.choice(["cc by", "CC-BY 4.0", "all rights reserved", "mit license", "é x", "apache license version 2 0", "a" * 40]) for _ in range(200))
    cut = licenses.Scanner().scan(text.encode())
    monkeypatch.setattr(licenses, "PIECE", 1 << 16)
    assert cut == licenses.Scanner().scan(text.encode())


def test_license_rows(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    extra = spark.createDataFrame([(900, "All rights reserved. cc by cc by! MIT License"), (901, "x General  PUBLIC\nlicense")], "doc_id long, text string")
    for df in (docs.select("doc_id", "text").unionByName(extra), odd_docs):
        found = licenses.license_labels(licenses.scan_licenses(df)).collect()
        assert len(found) == df.count()
        want = []
        for r in df.collect():
            words = words_of(r["text"])
            places = [(i, lab) for lab, p in phrases.items() for i in range(len(words)) if words[i:i + len(p)] == p]
            at = [i for i, _ in places]
            want.append((r["doc_id"], len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({lab for _, lab in places}))))
        assert sorted(map(repr, (tuple(r)[:6] for r in found))) == sorted(map(repr, want))
        for r in found:
            assert r["labels"] == ",".join(sorted({s["label"] for s in r["spans"]} | set(filter(None, r["base_labels"].split(",")))))
            assert r["score"] == max([float(r["n_base"] > 0), *(s["share"] for s in r["spans"])])
    assert licenses.license_labels(licenses.scan_licenses(no_docs)).count() == 0


# ------------------------------------------------------------------------------------------------ 13 vector codes
def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Lloyd rounds and codes by full distances; rows are (id, vector of floats), ordered by id."""
    x = np.floor(4096 * np.array([v for _, v in rows], float)).astype(np.int64)
    w = x.shape[1] // parts
    x = x.reshape(len(rows), parts, w)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
        return d.argmin(-1), d.min(-1)

    for _ in range(rounds):
        near, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = x[near[:, p] == e, p]
                if len(own):
                    books[p, e] = [int(s) // len(own) for s in own.sum(0)]
    near, d = assign()
    return books, ["".join(f"{i:02x}" for i in r) for r in near], d.sum(1).tolist()


@pytest.mark.parametrize("n,dims", [(1, 3), (16, 8), (64, 5), (65, 4), (200, 2), (9, 0)])
def test_nearest_entries_are_exact(n, dims):
    rng = np.random.default_rng(n)
    for spread in (3, 1000):
        entries = rng.integers(-spread, spread, (n, dims))
        x = np.concatenate([rng.integers(-2 * spread, 2 * spread, (300, dims)), entries])
        s = vectorcodes.Slices(entries)
        full = ((x[:, None] - entries[None]) ** 2).sum(-1)
        index, d = s.nearest(x)
        assert (index == full.argmin(-1)).all() and (d == full.min(-1)).all()
    if dims > 2:
        mask = s.candidates(x)
        held = sum(np.bitwise_count(mask[:, j]).sum() for j in range(mask.shape[1]))
        assert held < 0.9 * n * len(x) or n == 1


def test_codes_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = sorted((r["vec_id"], r["embedding"]) for r in df.collect())
    books, codes, errors = plain_codes(rows)
    got = vectorcodes.fit_codebooks(df)
    assert all((a == b).all() for a, b in zip(got, books))
    out = sorted(tuple(r) for r in vectorcodes.encode(df, got).collect())
    assert out == [(i, c, e) for (i, _), c, e in zip(rows, codes, errors)]
    x = np.floor(4096 * np.array(rows[5][1])).astype(int)
    assert ((vectorcodes.decode(codes[5], got) - x) ** 2).sum() == errors[5]


def test_odd_vectors(spark):
    rng = random.Random(4)
    vec = lambda: [rng.choice([-1.0, 0.0, 0.5, rng.random()]) for _ in range(16)]
    good = [(i, vec(), [None, 1, 2][i % 3], "c", 0.5) for i in range(40)]
    twice = (5, good[5][1], good[5][2], "c", None)
    bad = [(50, None, 1, "c", 1.0), (51, [None] + [0.0] * 15, 1, "c", 1.0), (52, [float("nan")] * 16, 1, "c", 1.0), (-53, [float("inf")] + [0.0] * 15, None, "c", 1.0)]
    odd = [(60, [1.0, 2.0], 1, "c", 1.0), (61, [], None, "c", 1.0), (None, vec(), 1, "c", 1.0), (70, [1e300, -1e300] + [0.0] * 14, 7, "c", 1.0)]
    schema = "vec_id long, embedding array<double>, label int, code string, error double"
    df = spark.createDataFrame([*good, twice, *bad, *odd], schema)
    books = vectorcodes.fit_codebooks(df)
    out = vectorcodes.label_errors(vectorcodes.encode(df, books, keep=("label",))).collect()
    assert sorted(r["vec_id"] for r in out if r["vec_id"] is not None) == sorted([*range(40), 5, 60, 61, 70]) and len(out) == 45
    assert {r["vec_id"] for r in out if r["code"] is None} == {60, 61}
    for label in (None, 1, 2, 7):
        own = [r for r in out if r["label"] == label]
        assert {r["label_error"] for r in own} == {sum(r["error"] or 0 for r in own)}
    same = [r for r in out if r["vec_id"] == 5]
    assert same[0] == same[1]
    few = df.where("vec_id in (3, 4, 50)")
    books = vectorcodes.fit_codebooks(few)
    assert [b.shape for b in books] == [(2, 2)] * 8
    assert {r["error"] for r in vectorcodes.encode(few, books).collect()} == {0}
    empty = df.where("vec_id = 50")
    assert vectorcodes.fit_codebooks(empty) == [] and vectorcodes.encode(empty, []).count() == 0
    assert vectorcodes.codebook_digest([]) == hashlib.sha256(b"").hexdigest()


def test_queries_of_this_file(spark):
    for name, n in (("op11_conversation_repair", 20), ("op12_license_scans", 200), ("op13_vector_codes", 500)):
        rows = queries.QUERIES[name](spark, SF)
        assert rows.count() >= n or name.startswith("op11")

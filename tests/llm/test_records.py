"""Records, conversations and vectors: round trips and brute force."""

import hashlib
import io
import threading
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from newsmill.llm import chat, graph, vectorjoin, warc
from newsmill.llm import queries

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------------------------------------ 2 WARC
def test_bundle_round_trip():
    sink = io.BytesIO()
    writer = warc.BundleWriter(sink, frame_bytes=64)
    records = [bytes([i]) * n for i, n in enumerate([0, 10, 60, 1, 500, 64, 3])]
    places = [writer.add(r) for r in records]
    writer.close()
    raw = sink.getvalue()
    reader = warc.BundleReader(io.BytesIO(raw), len(raw))
    assert [reader.record(*p) for p in places] == records
    assert len(reader.frames) == max(p[0] for p in places) + 1
    import zstandard
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain == b"".join(records)  # any Zstandard reader passes over the seek table


PAGES = "page_id long, url string, html string, digest string, payload string"


def test_warc_pages(spark):
    big = "é<p>" * 60
    rows = [(5, "http://a", big), (3, "http://b\r\nX: y", big), (4, None, "small"), (2, "u", "small"), (9, "u", None), (None, None, ""), (7, "u", big + "!"),
            (8, "u", big + "!"), (8, "u", big + "!"), (None, "u", big), (11, "u", "x" * 3_000_000)]
    df = spark.createDataFrame([(*r, "d", "p") for r in rows], PAGES)
    folder = warc.bundle_folder(spark)
    index = warc.write_bundles(df, folder)
    got = sorted((tuple(r)[:5] for r in warc.read_bundles(spark, folder, index).collect()), key=repr)
    least = {5: 3, 8: 7}
    want = []
    for p, _, h in rows:
        b = (h or "").encode()
        refers = 3 if p is None and h == big else least.get(p)
        want.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if refers is not None else "response", refers))
    assert got == sorted(want, key=repr)
    records = index.collect()
    nameless = [r["record_id"] for r in records if warc.urn_page(r["record_id"]) is None]
    assert len(set(nameless)) == len(nameless) == sum(p is None for p, _, _ in rows)
    for r in records:
        head, payload = warc.read_record(folder, r["file"], r["frame"], r["offset"], r["length"])
        assert head["WARC-Record-ID"] == f"<{r['record_id']}>" and head["WARC-Date"].endswith("Z")
        if head["WARC-Type"] == "response" and warc.urn_page(r["record_id"]) is not None:
            assert payload == (next(h for p, _, h in rows if warc.page_urn(p) == r["record_id"]) or "").encode()
    empty = warc.write_bundles(df.where("false"), warc.bundle_folder(spark))
    assert empty.count() == 0 and warc.read_bundles(spark, folder, empty).count() == 0


# ------------------------------------------------------------------------------------------------ 8 chat
@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|im_start|>", "<\\\\||>", "<<|<\\<|", "plain < text | here", "<|" * 5, "\\<|\\"])
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unheader(chat.header(text + "\n%0A%")) == text + "\n%0A%" and "\n" not in chat.header(text + "\n")


def test_escape_random():
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.tuples(st.text(alphabet="<|\\a\n%0A>"), st.text(alphabet="<|\\a\n>im_startend"))))
    def check(turns):
        out, spans = chat.render(chat.compile_template(chat.CHATML), [{"role": r, "text": t} for r, t in turns])
        assert chat.read_back(out) == turns and [chat.unescape(out[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    check()


def shown(template, **scope):
    parts = []
    chat.compile_template(template)(scope, lambda t, g: parts.append(f"[{t}]" if g else t))
    return "".join(parts)


def test_template_language():
    rows = [{"role": "user", "n": 1}, {"role": "bot", "n": 2}]
    assert shown("{% for m in ms %}{{ loop.index }}{% if loop.first %}F{% elif loop.last %}L{% endif %}:{{ m['role'] | upper }};{% endfor %}", ms=rows) == "1F:USER;2L:BOT;"
    assert shown("{% set a = 'x' ~ 1 %}{{ a }}{# no #}{% if not b and a == 'x1' %}y{% else %}n{% endif %}") == "x1y"
    assert shown("a{% generation %}b{{ 'c' }}{% endgeneration %}d") == "a[bc]d"
    assert shown("{{ 'k' in d }}{{ d.k.q }}{{ 1 + 2 }}{{ ('a' or 'b') }}", d={"k": 1}) == "True3a"
    assert shown("{{ x.__class__ }}{{ x.upper }}", x="str") == ""
    for bad in ("{{ f() }}", "{{ 'a }}", "{% for x %}{% endfor %}", "{% if a %}", "{% endfor %}", "{{ a | exec }}", "{% else %}", "{{ a b }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


def test_folding():
    assert chat.fold(chat.parse("a{{ 'b' ~ 1 }}{% if 1 == 2 %}x{% elif true %}y{% else %}z{% endif %}")) == [
        ("out", ("const", "ab1")), ("if", [(("const", True), [("out", ("const", "y"))])])]
    assert chat.fold(chat.parse("{% if false %}x{% endif %}")) == []


def test_conversations(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a<|im_end|>"), (1, 3, None, None), (2, 1, "assistant", None), (2, 1, "assistant", None),
            (None, 1, "user", "q"), (3, None, "us\ner", "long " * 50_000), (4, 1, "assistant", "x<\\|y")]
    df = spark.createDataFrame([(*r, "f") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t if t is not None else -1, r or "", x or ""))
    assert got.keys() == groups.keys()
    for c, own in groups.items():
        own.sort()
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[c]["n_turns"] == len(own) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_conversations(df.where("false")).count() == 0


def test_conversation_query_has_the_probe(spark):
    r = queries.op8_chat_formatting(spark, SF).where("conv_id = -1").first()
    t = chat.CONTROL_TEXT
    assert r["n_turns"] == 2 and r["loss_chars"] == len(t) and r["loss_sha256"] == hashlib.sha256(t.encode()).hexdigest()


# ------------------------------------------------------------------------------------------------ 3 vectors
def brute_links(rows, cosine):
    ok = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    up, n = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if ok(a) and ok(b) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    n[i] += 1
                    n[j] += 1
                    up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)] += [d] if d is not None else []
    return sorted(((d, n[i], min(least[root(i)], default=None)) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("tile", [8192, 5])
def test_near_vectors(spark, tile):
    rng = np.random.default_rng(4)
    center = rng.standard_normal(64)
    vs = [(rng.standard_normal(64)).astype(np.float32).tolist() for _ in range(60)]
    vs += [(center + s * rng.standard_normal(64)).astype(np.float32).tolist() for s in np.linspace(0, 0.45, 60)]
    vs += [vs[3], vs[3], [2 * x for x in vs[3]], None, [0.0] * 64, [float("nan")] + vs[0][1:], [None] + vs[0][1:], [float("inf")] * 64, [],
           [1.0, 2.0, 3.0], [1.0, 2.0, 3.1], [1.0], [-1.0], [2.0]]
    rows = [(i * 7 % 997, v) for i, v in enumerate(vs)] + [(None, vs[3]), (5, vs[5]), (5, vs[5])]
    df = spark.createDataFrame([(d, v, 1, 2) for d, v in rows], "vec_id long, embedding array<float>, rep long, links int")
    got = vectorjoin.near_vectors(df, 0.95, tile=tile).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == brute_links(rows, 0.95)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    assert vectorjoin.near_vectors(df.where("false"), 0.95).count() == 0


def test_near_vectors_of_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.op3_embedding_near_dedup(spark, SF).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == brute_links(rows, 0.95)


@pytest.mark.parametrize("dim", [64, 5, 1])
def test_cells_meet_every_near_pair_once(monkeypatch, dim):
    for name, n in (("GRID_ROWS", 1), ("CELL_ROWS", 4), ("PRODUCT", 5_000), ("PAIRS", 50)):
        monkeypatch.setattr(vectorjoin, name, n)
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((12, dim))
    noise = np.linspace(0, 0.4, 700)[:, None]
    v = (np.where(noise % 0.1 < 0.05, centers[rng.integers(0, 12, 700)], rng.standard_normal((700, dim))) + noise * rng.standard_normal((700, dim))).astype(np.float32)
    x = v.astype(float)
    norm = np.sqrt((x * x).sum(1))
    near = {(a, b) for a, b in zip(*np.nonzero(x @ x.T / np.outer(norm, norm) >= 0.95)) if a < b}
    space, count = vectorjoin.Subspaces(dim, 0.95), np.ones(700, np.int64)
    side = vectorjoin._Side(space, np.arange(700), count, v)
    found = []

    def add(a, b, i, j):
        found.extend(tuple(sorted(p)) for p in zip(a.rep[i].tolist(), b.rep[j].tolist()))

    residents = vectorjoin._Residents(space, 0.95, side.slice(0, 400))
    assert dim < 5 or max(len(g.starts) for g in residents.grids) > 50
    for lo in (0, 150, 300):
        residents.compare(side.slice(lo, min(lo + 150, 400)), lo, add)
    residents.compare(side.slice(400, 700), None, add)
    assert len(found) == len(set(found)) and set(found) == {p for p in near if p[0] < 400}


def test_rounds_compare_every_two_chunks_once():
    sizes = {64: 15_000_000, 3: 1, 5: 7000}
    chunks, rounds = vectorjoin._rounds(sizes, 4, None)
    pairs = sorted((u.dim, u.own, c) for units in rounds for u in units for c in range(u.first, u.last))
    assert pairs == [(d, a, b) for d in (5, 64) for a in range(chunks[d]) for b in range(a, chunks[d])] and 3 not in chunks
    total = sum(n * (4 * d + 16) for d, n in sizes.items())
    assert all(sum(u.size for u in units) <= 1.5 * total for units in rounds)
    assert max(u.size for units in rounds for u in units) < 300_000_000


def test_shuffles_hold_the_vectors_a_few_times(spark, monkeypatch):
    """However many cells, tiles and rounds there are."""
    monkeypatch.setattr(vectorjoin, "ROUND_BYTES", 1, raising=False)
    rng = np.random.default_rng(6)
    v = rng.standard_normal((6000, 64)).astype(np.float32)
    v[3000:3100] = v[0] + 0.05 * rng.standard_normal((100, 64))
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<float>")
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())
    here = [str(f.getPath()) for f in folders]

    def held():
        total = 0
        for path in (p for f in here for p in Path(f).glob("*/shuffle_*")):
            try:
                total += path.stat().st_size
            except FileNotFoundError:
                pass
        return total

    before, most, ended = held(), [0], threading.Event()

    def watch():
        while not ended.wait(0.02):
            most[0] = max(most[0], held() - before)
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        got = {r["vec_id"]: r["n_links"] for r in vectorjoin.near_vectors(df, 0.95, tile=600).collect()}
    finally:
        ended.set()
        watcher.join()
    assert most[0] < 4 * v.nbytes
    x = v.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert [got[i] for i in range(6000)] == ((x @ x.T >= 0.95).sum(1) - 1).tolist()


# ------------------------------------------------------------------------------------------------ components
def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, x) for x in range(2, 40)] + [tuple(map(int, rng.integers(200, 260, 2))) for _ in range(40)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long"), "u", "v").collect()}
    up = {}

    def root(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}

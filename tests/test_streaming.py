import datetime as dt

from pyspark.sql import functions as F

from newsmill.streaming import articles as St
from newsmill.streaming.recency import STATE_STORE, stream_hours_since

T0 = dt.datetime(2024, 1, 1, 10)
SCHEMA = "id int, url string, published_on timestamp, tags string"


def land(spark, path, *files):
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(**kw):
    return T0 + dt.timedelta(**kw)


def finish(query):
    query.awaitTermination()


def test_dedup_across_batches(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    land(spark, path, [(1, "a", at(), None), (2, "b", at(minutes=1), None), (3, "a", at(minutes=2), None)], [(4, "a", at(minutes=30), None), (5, "c", at(minutes=31), None)])
    stream = St.stream_dedup(St.stream_files(spark, path, SCHEMA, max_files=1))
    finish(St.append_sink(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("url")) == [("a",), ("b",), ("c",)]
    # a second run over the same folder sees nothing new
    finish(St.append_sink(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_late_rows_beyond_the_watermark_are_dropped(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    land(spark, path, [(1, "a", at(), None)], [(2, "b", at(hours=9), None)], [(4, "d", at(hours=8), None)],
         [(3, "c", at(minutes=5), None)], [(5, "e", at(hours=20), None)])
    counts = St.stream_counts(St.stream_files(spark, path, SCHEMA, max_files=1))
    finish(St.append_sink(counts, str(tmp_path / "out"), str(tmp_path / "cp")))
    got = rows(spark.read.parquet(str(tmp_path / "out")).select("start", "articles"))
    assert (at(), 1) in got and (at(hours=8), 1) in got and (at(hours=9), 1) in got


def test_windows_equal_batch(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    land(spark, path, [(i, "u", at(minutes=17 * i), "Breaking" if i % 2 else None) for i in range(40)], [(i, "u", at(minutes=17 * i), "breaking news") for i in range(40, 80)])
    batch = spark.read.parquet(path)
    stream = lambda: St.stream_files(spark, path, SCHEMA, max_files=1)
    finish(St.complete_sink(St.stream_counts(stream(), width="24 hours", slide="1 hour"), str(tmp_path / "o1"), str(tmp_path / "c1")))
    want = batch.groupBy(F.window("published_on", "24 hours", "1 hour").alias("w")).count().select("w.start", "count")
    assert rows(spark.read.parquet(str(tmp_path / "o1")).select("start", "articles")) == rows(want)
    finish(St.complete_sink(St.stream_breaking(stream()), str(tmp_path / "o2"), str(tmp_path / "c2")))
    want = batch.filter("lower(tags) like '%breaking%' and hour(published_on) >= 20").count()
    assert spark.read.parquet(str(tmp_path / "o2")).agg(F.sum("articles")).first()[0] == want > 0


def test_upsert_sink_replay(spark, tmp_path, rows):
    path, table = str(tmp_path / "in"), str(tmp_path / "t")
    land(spark, path, [(1, "a", at(), "x"), (2, "b", at(), "x")], [(3, "a", at(hours=1), "y")])
    shape = lambda df: df.select("url", "id", F.to_date("published_on").alias("date"))
    shape(spark.read.parquet(path)).limit(0).write.partitionBy("date").parquet(table)
    spark.createDataFrame([("z", 0, T0.date())], "url string, id int, date date").write.mode("append").partitionBy("date").parquet(table)
    for attempt in ("c1", "c2"):  # a lost checkpoint replays everything
        finish(St.upsert_sink(shape(St.stream_files(spark, path, SCHEMA, max_files=1)), table, ["url", "date"], [F.desc("id")], "date", str(tmp_path / attempt)))
        got = dict(rows(spark.read.parquet(table).select("url", "id")))
        assert set(got) == {"z", "a", "b"} and got["b"] == 2 and spark.read.parquet(table).count() == 3


def test_enrich(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([(1, "ETF news", "b", "BTC", "CoinDesk")], "id int, title string, body string, categories string, source_name string").write.parquet(path)
    stream = St.stream_files(spark, path, "id int, title string, body string, categories string, source_name string")
    finish(St.append_sink(St.stream_enrich(stream), str(tmp_path / "out"), str(tmp_path / "cp")))
    r = spark.read.parquet(str(tmp_path / "out")).first()
    assert (r["entities"], r["event_type"], r["source_tier"]) == (["bitcoin"], "ETF_INSTITUTIONAL", 1)


def test_hours_since_state(spark, tmp_path):
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "entity string, ts timestamp, grp string"
    for rows in ([("e", at(), "macro"), ("e", at(hours=1), "listing")], [("e", at(hours=5), "listing"), ("f", at(), "macro")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    hours = stream_hours_since(St.stream_files(spark, path, schema, max_files=1))
    q = hours.writeStream.foreachBatch(lambda b, _: b.write.mode("append").parquet(out)).outputMode("update").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    last = {(r["entity"], r["grp"]): r["hours_since"] for r in spark.read.parquet(out).orderBy("ts").collect()}
    assert last == {("e", "macro"): 5.0, ("e", "listing"): 0.0, ("f", "macro"): 0.0}


def test_closed_windows_leave_the_state_and_late_rows_are_counted(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    shape = SCHEMA + ", closing boolean"
    many = [(i, "u", at(minutes=10 * i), None, False) for i in range(600)]
    for i in range(0, 600, 100):
        spark.createDataFrame(many[i:i + 100], shape).coalesce(1).write.mode("append").parquet(path)
    closing = St.closing_row(spark.createDataFrame(many, shape))
    assert [tuple(r) for r in closing.collect()] == [(None, None, at(minutes=5990) + dt.timedelta(hours=3, seconds=1), None, True)]
    for more in (closing, closing, spark.createDataFrame(many[:30] + [(0, None, at(hours=200), None, False)], shape)):
        more.coalesce(1).write.mode("append").parquet(path)
    stream = lambda: St.stream_files(spark, path, shape, max_files=1)
    q = St.append_sink(St.stream_counts(stream()), str(tmp_path / "out"), str(tmp_path / "cp"))
    finish(q)
    held = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    assert max(held) < 25  # a batch spans 17 hours, the delay two more; all 100 windows are never held together
    got = {r["start"]: r["articles"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {at(hours=h): 6 for h in range(100)}
    finish(St.late_sink(stream(), str(tmp_path / "late"), str(tmp_path / "cp2")))
    late = spark.read.parquet(str(tmp_path / "late"))
    assert {r["start"]: r["late"] for r in late.collect()} == {at(hours=h): 6 for h in range(5)}
    assert sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"]) >= 5


def test_touched_intervals_are_merged_per_key(spark, rows):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    df = spark.createDataFrame([("a", day(0)), ("a", day(4)), ("a", day(8)), ("a", day(0)), ("b", day(4)), (None, day(1)), ("a", None)], "k string, date date")
    got = rows(St.touched_intervals(df, ["k"], "date", 1, 2))
    assert sorted(got, key=repr) == sorted([("a", day(-1), day(10)), ("b", day(3), day(6)), (None, day(0), day(3))], key=repr)
    apart = rows(St.touched_intervals(df.where("k = 'a'"), ["k"], "date", 0, 1))
    assert sorted(apart) == [("a", day(0), day(1)), ("a", day(4), day(5)), ("a", day(8), day(9))]


def test_refresh_reads_only_what_depends_on_the_changed_days(spark, tmp_path, rows):
    from pyspark.sql import Window as W
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    past = [(k, day(n), 1) for k in "ab" for n in range(60)]
    seen = []

    def build(history):
        seen.append({(r["k"], r["date"]) for r in history.collect()})
        w = W.partitionBy("k").orderBy(F.unix_date("date")).rangeBetween(-2, 0)
        return history.groupBy("k", "date").agg(F.sum("n").alias("n")).select("k", F.sum("n").over(w).alias("total"), "date")

    frame = lambda rs: spark.createDataFrame(rs, "k string, date date, n int")
    table = str(tmp_path / "t")
    build(frame(past)).write.partitionBy("date").parquet(table)
    now = [*past, ("a", day(10), 5), ("c", dt.date(1970, 1, 1), 7)]
    now.remove(("a", day(40), 1))
    changes = str(tmp_path / "in")
    frame([("a", day(10), 0), ("c", dt.date(1970, 1, 1), 0), ("a", day(40), 0)]).select("k", "date").write.parquet(changes)
    seen.clear()
    St.incremental_refresh(St.stream_files(spark, changes, "k string, date date"), frame(now), build, table, str(tmp_path / "cp"), ["k"], lookback_days=2).awaitTermination()
    read = seen[0]
    want_days = {*range(8, 13), *range(38, 43)} - {40}
    assert read == {("a", day(n)) for n in want_days} | {("c", dt.date(1970, 1, 1))}
    fresh = sorted(rows(build(frame(now)).select("k", "date", "total")))
    assert sorted(rows(spark.read.parquet(table).select("k", "date", "total"))) == fresh


class _V:
    def __init__(self, spark):
        self.spark = spark


def _landing(stream):
    """Rows of every landed file in the order in which the stream takes them."""
    import glob
    import os

    import pyarrow.parquet as pq
    files = glob.glob(f"{stream}/*.parquet")
    return [pq.read_table(f).to_pylist() for f in sorted(files, key=os.path.getmtime)]


def _paths(monkeypatch):
    from newsmill.registry import streams as R
    paths, make = {}, R.scratch_path

    def kept(spark, name):
        paths[name] = make(spark, name)
        return paths[name]
    monkeypatch.setattr(R, "scratch_path", kept)
    return R, paths


def test_rows_are_dealt_to_files_by_time_in_one_shuffle(spark, monkeypatch):
    """No task reads the whole table: every landed file is read from its own range, and rows of one time may share several."""
    R, paths = _paths(monkeypatch)
    monkeypatch.setattr(R, "ROWS_PER_FILE", 50)
    rows = spark.createDataFrame([(i, at(minutes=i // 300 * 60)) for i in range(600)] + [(-1, None)], "id int, published_on timestamp").repartition(5)
    late = spark.createDataFrame([(i, at()) for i in range(100)], "id int, published_on timestamp")
    R._landed_in_time(_V(spark), rows, "published_on", rows.limit(1), R._in_files(late))
    files = [f for f in _landing(paths["landing"]) if f]
    own, behind = files[:-5], files[-4:]
    assert sorted(r["id"] for f in own for r in f) == [-1, *range(600)] and max(map(len, own)) < 150 and len(files[-5]) == 1
    times = [sorted(r["published_on"] is not None and r["published_on"].replace(tzinfo=None) or T0 for r in f) for f in own]
    assert all(a[-1] <= b[0] for a, b in zip(times, times[1:]))
    assert sorted(r["id"] for f in behind for r in f) == list(range(100))


def test_files_follow_the_size_of_texts(spark, monkeypatch):
    R, paths = _paths(monkeypatch)
    monkeypatch.setattr(R, "BYTES_PER_FILE", 10_000)
    rows = spark.createDataFrame([(i, "x" * 1000, None) for i in range(200)], "id int, body string, none string")
    R._landed(_V(spark), rows)
    files = _landing(paths["landing"])
    assert len(files) >= 20 and sum(map(len, files)) == 200 and max(map(len, files)) <= 20


def test_stream_dedup_counts_every_url_once(spark, monkeypatch):
    """A url that comes again after the watermark span is one url; a missing url and a missing time are rows like others."""
    from newsmill import registry
    R, _ = _paths(monkeypatch)
    v = _V(spark)
    v.articles = spark.createDataFrame([("a", at()), ("a", at()), ("a", at(days=3)), ("b", at(days=1)), ("c", None), (None, at(hours=5)), (None, at(days=9))],
                                       "url string, published_on timestamp")
    sent = []
    monkeypatch.setattr(R, "_run", lambda v, start, run=R._run: sent.append(run(v, start)) or sent[-1])
    got = registry.QUERIES["stream_dedup"][0](v).collect()
    assert sorted((r["url"] or "", r["urls"]) for r in got) == [("", 4), ("a", 4), ("b", 4), ("c", 4)]
    # the stream itself drops what is sent twice within the span, and the late copy of everything
    assert sent[0].filter("NOT closing").count() == 6

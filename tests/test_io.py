import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newsmill.operators import keys as K, merge, profiles as P
from newsmill.plans import reports as R
from newsmill.sources import readers, sinks

D = lambda n: dt.date(2024, 1, n)


def table(spark, path, rows, schema="k int, v string, d date"):
    spark.createDataFrame(rows, schema).write.partitionBy("d").parquet(path)


def test_merge_update_is_idempotent_and_touches_only_its_days(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    table(spark, path, [(1, "a", D(1)), (2, "b", D(1)), (3, "c", D(2))])
    untouched = {p.name for p in (tmp_path / "t" / "d=2024-01-02").iterdir()}
    inc = spark.createDataFrame([(2, "B2", D(1), 1), (2, "B1", D(1), 0), (4, "n", D(3), 0)], "k int, v string, d date, o int")
    for _ in range(2):
        merge.merge_into_table(path, K.first_per_key(inc, "k", "o").drop("o"), ["k", "d"], ["v"], "d")
        assert rows(spark.read.parquet(path).select("k", "v")) == [(1, "a"), (2, "B1"), (3, "c"), (4, "n")]
    assert {p.name for p in (tmp_path / "t" / "d=2024-01-02").iterdir()} == untouched


def test_insert_ignore(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    table(spark, path, [(1, "a", D(1))])
    inc = spark.createDataFrame([(1, "x", D(1)), (5, "first", D(1)), (5, "second", D(1)), (None, "n1", D(1)), (None, "n2", D(1))], "k int, v string, d date")
    target = spark.read.parquet(path)
    assert rows(merge.merge_counts(target, inc, ["k"])) == [(1, 2, 2)]
    assert rows(merge.merge_ignore(target, inc, ["k"], ["v"]).select("k", "v")) == [(1, "a"), (5, "first"), (None, "n1"), (None, "n2")]
    known = inc.filter("k is not null")
    for _ in range(2):
        merge.append_new(path, known, ["k", "d"], ["v"], "d")
        assert rows(spark.read.parquet(path).select("k", "v")) == [(1, "a"), (5, "first")]


def test_keys_and_remap(spark, rows):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("99999999999999999999",)], "k string")
    assert rows(merge.valid_keys(df, "k")) == [(1,)]
    arr = spark.createDataFrame([(1, ["a", "b"], ["b", "a", "a"]), (2, ["a"], ["c"]), (3, None, [])], "id int, o array<string>, n array<string>")
    assert [r["id"] for r in merge.changed_sets(arr, "o", "n").collect()] == [2]
    assert dict(rows(merge.remap_report(arr, "o", "n"))) == {"changed_rows": 1, "distinct_before": 2, "distinct_after": 3}


def test_latest_per_key_day(spark, rows):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t, 1), ("a", t.replace(hour=5), 2), ("a", t.replace(day=2), 3), ("b", t, 4)], "entity string, ts timestamp, v int")
    assert rows(K.latest_per_key_day(df).select("entity", "v")) == [("a", 2), ("a", 3), ("b", 4)]


def test_csv_and_feed_round_trip(spark, tmp_path):
    body = 'He said "no",\nthen\r left; ünï'
    arts = spark.createDataFrame(
        [(1, "T, \"q\"", dt.datetime(2024, 1, 1, 5), "s", "S", "u", body, "A|B", None, "EN", "http://i", 1, 2), (2, "x", dt.datetime(2024, 1, 2), "s", "S", "u2", None, "", "t", "EN", "", 0, 0)],
        "id bigint, title string, published_on timestamp, source string, source_name string, url string, body string, categories string, tags string, lang string, imageurl string, upvotes int, downvotes int")
    sinks.write_articles_csv(arts, str(tmp_path / "csv"))
    a, b = readers.read_articles_csv(spark, str(tmp_path / "csv")).orderBy("id").collect()
    assert (a["title"], a["body"], a["has_image"], a["body_length"], a["published_on"]) == ('T, "q"', body, True, len(body), dt.datetime(2024, 1, 1, 5))
    assert (b["has_image"], b["body_length"]) == (False, 0)
    sinks.write_feed_json(arts, str(tmp_path / "json"))
    back = readers.feed_articles(spark.read.schema(readers.FEED_SCHEMA).json(str(tmp_path / "json"))).orderBy("id").collect()
    assert (back[0]["body"], back[0]["source_name"], back[0]["upvotes"]) == (body, "S", 1)


def test_feed_pages(spark, tmp_path, rows):
    good = {"Type": 100, "Message": "ok", "Data": [{"id": "7", "title": "t", "published_on": 1704067200, "url": "u", "body": "abc", "source_info": {"name": "N", "img": "", "lang": "EN"}, "upvotes": "3", "imageurl": ""}],
            "fetch_params": {"hours_back": 1}}
    (tmp_path / "a.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"Response": "Error", "Message": "limit", "Data": {}}))
    (tmp_path / "c.json").write_text(json.dumps({"Message": "odd", "Err": "x", "Data": []}))
    pages = readers.read_feed_json(spark, str(tmp_path))
    assert rows(readers.feed_error_rows(pages).select("Message")) == [("limit",), ("odd",)]
    assert rows(readers.feed_articles(pages).select("id", "source_name", "body_length", "has_image", "upvotes", "published_on")) == [(7, "N", 3, False, 3, dt.datetime(2024, 1, 1))]


def test_latest_snapshot_by_metadata(spark, tmp_path):
    import os
    for name, value, age in (("s_20240101.csv", "old", 100), ("s_20240301.csv", "new", 10), ("s_20240201.csv", "mid", 50)):
        (tmp_path / name).write_text(f"v\n{value}\n")
        os.utime(tmp_path / name, (1_700_000_000 - age, 1_700_000_000 - age))
    df = spark.read.schema("v string").option("header", True).csv(str(tmp_path))
    assert [r["v"] for r in readers.latest_snapshot(df).collect()] == ["new"]
    assert [r["v"] for r in readers.latest_snapshot(df, "file_name").collect()] == ["new"]


def test_feed_dedup_order_and_limit(spark):
    items = spark.createDataFrame([("a", 1, 1, 0), ("a", 0, 2, 5), ("b", 1, 1, 1), ("c", 0, 1, 0), ("", 0, 0, 0), (None, 0, 0, 1)], "link string, feed_rank int, page int, pos int")
    assert [r["link"] for r in readers.feed_pages_to_articles(items, 2).collect()] == ["c", "a"]


def test_normalize(spark):
    row = ("http://l", None, "2024-01-01 00:00:00", "", "Src", None, None, "", "http://img", None)
    df = spark.createDataFrame([row], "link string, title string, pubDate string, sourceKey string, source string, category string, lang string, image string, imageurl string, body string")
    r = readers.normalize_articles(df).first()
    assert (r["title"], r["source"], r["lang"], r["has_image"], r["imageurl"], r["body_length"], r["tags"]) == ("", "Src", "EN", True, "", 0, "")


def test_feature_tables_missing(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "k int, a double").write.parquet(str(tmp_path / "t"))
    got = readers.load_feature_tables(spark, str(tmp_path), {"t": ["a", "b"], "none": ["c"]}, ["k"])
    assert [tuple(r) for r in got["t"].collect()] == [(1, 2.0, None)] and got["none"] is None


def test_range_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d), d, 0) for d in range(1, 20)], "ts timestamp, v int, unused int").withColumn("date", F.to_date("ts"))
    df.write.partitionBy("date").parquet(str(tmp_path / "t"))
    out = readers.read_table_range(spark.read.parquet(str(tmp_path / "t")), "ts", "2024-01-10", "2024-01-11", 2, 1, date="date").select("v")
    assert sorted(r[0] for r in out.collect()) == [8, 9, 10, 11, 12]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(ts)" in plan and "unused" not in plan.split("ReadSchema")[1]


def test_found_in_prefers_title(spark, rows):
    df = spark.createDataFrame([(1, "Bitcoin", "bitcoin"), (2, "x", "BITCOIN"), (3, "x", "y"), (4, None, "bitcoin")], "id int, title string, body string")
    assert rows(R.search(df, "bitcoin").select("id", "found_in")) == [(1, "title"), (2, "body"), (4, "body")]


def test_missing_hours_and_bars(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t.replace(minute=5), "a", t), (t.replace(hour=3), "b", t), (t.replace(hour=3, minute=1), "b", t)], "fetched_at timestamp, url string, published_on timestamp")
    assert [r[0].hour for r in K.missing_hours(df, "fetched_at").orderBy("hour").collect()] == [1, 2]
    assert R.hour_bars(df).first()["bar"] == "##"


def test_duplicates_are_linear(spark, rows):
    df = spark.createDataFrame([(i, "t") for i in range(50)] + [(99, "u"), (100, None), (101, None)], "id int, title string")
    pairs = rows(K.duplicate_pairs(df, "title", "id", []).select("id1", "id2"))
    assert sorted(pairs) == [(0, i) for i in range(1, 50)]


@pytest.mark.parametrize("lengths,upper,median", [([5], 5, 5), ([1, 4], 4, 2), ([3, 1, 2], 2, 2), ([1, 1, 9, 300], 9, 5)])
def test_body_medians(spark, lengths, upper, median):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(n, "s", t, "d") for n in lengths], "body_length int, source_name string, published_on timestamp, dataset string")
    assert P.batch_body_metrics(df).first()["upper_median"] == upper
    assert P.length_stats(df).first()["body_median"] == median


def test_profiles_on_edges(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(None, None, None, None, None, None, t), ("s", "S", "A||B", "", "b", "i", t)], "source string, source_name string, categories string, tags string, body string, imageurl string, published_on timestamp")
    got = {(r["section"], r["key"]): r["value"] for r in P.article_profile(df).collect()}
    assert got[("totals", "total_articles")] == 2 and got[("totals", "image_percentage")] == 50.0
    assert got[("totals", "unique_categories")] == 3  # a doubled delimiter yields an empty label
    assert got[("totals", "unique_tags")] == 0
    enums = P.data_profile(spark.range(30).selectExpr("id", "id % 3 AS small", "timestamp'2024-01-01' AS t"), "id", "t", ["small", "id"])
    found = {(r["section"], r["key"]): r["value"] for r in enums.collect()}
    assert {s for s, _ in found} == {"table", "enum_small", "enum_id", "distinct"}
    assert found[("distinct", "id")] == 30 and found[("distinct", "small")] == 3 and sum(s == "enum_id" for s, _ in found) == 20


def test_merge_keeps_rows_of_the_null_partition(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    table(spark, path, [(1, "a", None), (2, "b", None), (3, "c", D(1))])
    inc = spark.createDataFrame([(2, "B", None), (4, "n", None)], "k int, v string, d date")
    merge.merge_into_table(path, inc, ["k"], ["v"], "d")
    assert rows(spark.read.parquet(path).select("k", "v")) == [(1, "a"), (2, "B"), (3, "c"), (4, "n")]


def test_profiles_scan_their_table_once(spark, tmp_path, monkeypatch):
    """The rows a profile reads from its table: each once, whatever its number of sections."""
    rows = [(f"s{i % 7}", "|".join(["A", f"c{i % 3}"][: 1 + i % 2]), None if i % 5 == 0 else "t", "x" * (i % 11), "u" if i % 2 else "", f"2024-01-0{1 + i % 9} 00:00:00") for i in range(90)]
    names = "source string, categories string, tags string, body string, imageurl string, at string"
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, names).selectExpr("*", "source AS source_name", "to_timestamp(at) AS published_on")
    counted = df.mapInArrow(count, df.schema)
    got = {(r["section"], r["key"]): r["value"] for r in P.article_profile(counted).collect()}
    assert seen.value == 90
    assert got["totals", "total_articles"] == 90 and got["totals", "unique_sources"] == 7 and got["totals", "unique_categories"] == 4 and got["totals", "unique_tags"] == 1
    assert got["top_categories", "A"] == 90 and got["top_tags", "t"] == 72 and got["totals", "max_length"] == 10
    empty = {(r["section"], r["key"]): r["value"] for r in P.article_profile(df.limit(0)).collect()}
    assert empty["totals", "total_articles"] == 0 and empty["totals", "unique_tags"] == 0 and empty["totals", "avg_length"] is None


def test_coverage_over_many_categories(spark):
    """More numbers than one bitmap holds, feeds in several rows, and feeds without categories."""
    wide = [f"c{i:06d}" for i in range(40_000)]
    feeds = [("all", wide), ("half", wide[::2]), ("half", wide[:10]), ("last", ["c039999", "c000000"]), ("none", [])]
    df = spark.createDataFrame(feeds, "source string, categories array<string>")
    got = {r["source"]: (r["covered"], r["missing"], r["shared"]) for r in P.coverage(df).collect()}
    assert got == {"all": (40_000, 0, 1), "half": (20_005, 19_995, 1), "last": (2, 39_998, 1)}
    small = df.where("source = 'last'").unionByName(spark.createDataFrame([("x", ["c000000", "q"])], df.schema))
    assert sorted((r["source"], r["category"], r["covers"]) for r in P.coverage_matrix(small).collect()) == [
        ("last", "c000000", True), ("last", "c039999", True), ("last", "q", False), ("x", "c000000", True), ("x", "c039999", False), ("x", "q", True)]
    assert P.coverage(df.limit(0)).count() == 0


def test_sketches_of_days_add_up(spark):
    df = spark.range(20_000).selectExpr("id % 5000 AS k", "id AS x", "timestamp_seconds(1704067200 + id * 43) AS t")
    days = P.day_sketches(df, "t", ["k"], ["x"])
    whole = {(r["section"], r["key"]): r["value"] for r in P.sketched_profile(days).collect()}
    assert whole["rows", "rows"] == 20_000 and abs(whole["distinct", "k"] - 5000) < 150 and abs(whole["quantile_0.5", "x"] - 10_000) < 400
    part = {(r["section"], r["key"]): r["value"] for r in P.sketched_profile(days, "2024-01-02", "2024-01-03").collect()}
    exact = df.where("to_date(t) between '2024-01-02' and '2024-01-03'")
    assert part["rows", "rows"] == exact.count() and abs(part["distinct", "k"] - exact.select("k").distinct().count()) < 150
    none = {(r["section"], r["key"]): r["value"] for r in P.sketched_profile(days, "2030-01-01").collect()}
    assert none["rows", "rows"] == 0
    approx = {(r["section"], r["key"]): r["value"] for r in P.data_profile(df, "k", "t", ["k"], 3, approximate=True).collect()}
    assert abs(approx["table", "entities"] - 5000) < 150 and abs(approx["distinct", "k"] - 5000) < 150

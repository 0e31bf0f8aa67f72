import hashlib

import pytest
from pyspark.sql import functions as F

from newsmill.functions import rules, text as X


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("cats,title,body,want", [
    ("BTC|ETH", "", "", ["bitcoin", "ethereum"]),
    (" btc |BTC|xrp", "", "", ["bitcoin", "ripple"]),
    ("ETH", "Bitcoin and ETHEREUM rally", "", ["ethereum", "bitcoin"]),
    (None, "the graph of solana", "fetch.ai news", ["solana", "fetch-ai", "the-graph"]),
    ("", "fetchxai bitcoins", "", []),
    ("MARKET|TRADING", "quiet day", "", ["bitcoin"]),
    ("OTHER", "quiet day", "", []),
    ("", "neo and eos", None, []),  # names of three letters are not searched
    ("", "", "x" * 4950 + " bitcoin", ["bitcoin"]),  # the whole body counts
    ("", "", "x" * 480 + " bitcoin", ["bitcoin"]),
    ("", "ébitcoin", "", []),  # an accented letter is part of the word
])
def test_map_entities(spark, cats, title, body, want):
    assert one(spark, X.map_entities("c", "t", "b"), c=cats, t=title, b=body) == want


def test_map_entities_later_name_wins(spark):
    col = X.map_entities("c", "t", names={"aaaa": "e1", "bbbb": "e1"}, proxy=None)
    assert one(spark, col, c="", t="aaaa") == []
    assert one(spark, col, c="", t="bbbb") == ["e1"]


@pytest.mark.parametrize("cats,title,want", [
    ("MARKET|SECURITY INCIDENTS|REGULATION", "etf", "HACK_EXPLOIT"),
    ("MARKET", "New ETF launch", "ADOPTION_PARTNERSHIP"),
    ("", "regulation", "OTHER"), ("", "regulat", "REGULATION"), (None, "SEC sues", "REGULATION"),
    ("", "rug pull", "HACK_EXPLOIT"), ("", "moved 500 coins on-chain", "WHALE_MOVEMENT"), ("", None, "OTHER"),
])
def test_classify_event(spark, cats, title, want):
    assert one(spark, X.classify_event("c", "t"), c=cats, t=title) == want


def test_source_tier(spark):
    df = spark.createDataFrame([("CoinDesk",), ("Coinpaper",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(X.source_tier("s")).collect()] == [1, 3, 2, 2]


def test_url_id_is_signed_sha1_head(spark):
    urls = [f"https://x/{i}" for i in range(50)]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(X.url_id("u")).collect()]
    want = [int.from_bytes(hashlib.sha1(u.encode()).digest()[:8], "big", signed=True) for u in urls]
    assert got == want and any(i < 0 for i in got)


def test_scores_and_text_guard(spark):
    df = spark.createDataFrame([(0.7, 0.1, 0.2)], "p double, n double, u double")
    r = df.select(X.polarity_score("p", "n", "u").alias("s"), X.composite_score(F.lit(0.5), F.lit(-0.25)).alias("c")).first()
    assert (r["s"]["score"], r["s"]["confidence"], r["c"]) == (0.6, 0.7, 0.05)
    assert one(spark, X.model_text("t"), t=" \n ") == rules.BLANK_TEXT
    assert len(one(spark, X.model_text("t"), t="a" * 3000)) == 3000
    assert [len(p) for p in one(spark, X.text_pieces("t", 2000), t="a" * 4500)] == [2000, 2000, 500]
    assert one(spark, X.word_count("t", "u"), t="  two  words ", u=None) == 2


def test_keyword_classes(spark):
    assert one(spark, X.matching_classes(F.col("t"), rules.CATEGORY_TOPIC_CLASSES), t="defi trading") == ["trading_related", "tech_related"]
    assert one(spark, X.matching_classes(F.col("t"), rules.CATEGORY_TOPIC_CLASSES), t="zzz") == ["other"]
    assert one(spark, X.first_class(F.col("t"), rules.CATEGORY_NAME_CLASSES), t="nft launch") == "topics"


def test_names_overlap_and_hold_marks(spark):
    from newsmill.functions import text as X
    names = {"Bitcoin": "btc", "bitcoin cash": "bch", "cash token": "ct", "c++x": "cpp", "a.b+": "ab"}
    df = spark.createDataFrame([("Bitcoin Cash Token rises", "x" * 3000 + " C++X and a.b+!"), ("bitcoins axb+", "")], "title string, body string")
    got = [r[0] for r in df.select(X.map_entities("title", "title", "body", tokens={"": ""}, names=names, proxy=None)).collect()]
    assert got == [["btc", "bch", "ct", "cpp", "ab"], []]

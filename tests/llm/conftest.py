import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     T.StructField("digest", T.StringType()), T.StructField("component", T.LongType()), T.StructField("size", T.LongType())])


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns with names the operators use."""
    rng = random.Random(3)
    base = words(rng, 120, 5000)
    texts = [None, "", " \t\n", "one", "one two three four", "one two three four", base, base, base + " tail", words(rng, 60_000, 5000),
             "Ünïcödé     wörds " * 20, "a\n\n\nb\n" + base, "\n".join([base] * 3), "é" * 5000, "x " * 3000, base.upper()]
    rows = [(i, t, ["en", None, "fr"][i % 3], ["s1", None, "s2", "s10"][i % 4], len(t or ""), "d", i, 7) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, base, "en", "s1", 1, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

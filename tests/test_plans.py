"""Shape of the physical plans: what must hold whatever the data size."""

import os
import re

import pytest
from pyspark.sql import functions as F

from newsmill.operators import keys as K
from newsmill.operators.ordering import pct_rank
from newsmill.registry.views import Views

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "forward_labels", "news_signals", "news_events", "cross_section", "training_matrix", "trade_outcomes", "interval_bars", "walkforward_rows",
    "coverage_matrix", "filter_comparison", "batch_body_metrics", "signal_table", "duplicate_title_pairs", "spearman_ic", "ledger_metrics", "regime_daily"])
def test_no_nested_loops_and_no_python(spark, name):
    import __spark_entry__ as entry
    text = plan(entry.queries()[name](spark, SF))
    for word in ("NestedLoop", "Cartesian", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text


def test_newest_per_key_is_limited_before_the_shuffle(spark):
    text = plan(K.latest_per_key_day(Views(spark, SF).table("events"), "event_type", "ts"))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_average_ranks_share_one_sort(spark):
    df = Views(spark, SF).table("events").select("event_type", "value", pct_rank("value", "event_type").alias("p"))
    text = plan(df)
    assert len(re.findall(r"\bSort \[", text)) == 1 and len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_scan_reads_only_needed_columns(spark):
    v = Views(spark, SF)
    text = plan(v.daily_bars.select("entity", "date", "volume").filter(F.col("date") > "1998-01-01"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_suppkey", "l_quantity", "l_shipdate"}
    assert "PushedFilters: [IsNotNull(l_shipdate)" in text


def test_merge_prunes_untouched_partitions(spark, tmp_path):
    from newsmill.operators.merge import touched_partitions
    path = str(tmp_path / "t")
    spark.sql("SELECT id, date_add(date'2024-01-01', cast(id AS int)) AS d FROM range(5)").write.partitionBy("d").parquet(path)
    inc = spark.sql("SELECT 9 AS id, date'2024-01-03' AS d")
    rows = touched_partitions(spark.read.parquet(path), inc, "d")
    assert [r["id"] for r in rows.collect()] == [2]
    assert "PartitionFilters: [isnotnull(d" in plan(rows) and "subquery" in plan(rows).split("PartitionFilters")[1].split("\n")[0].lower()

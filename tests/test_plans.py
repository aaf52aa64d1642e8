"""What the plans must look like, whatever the size of the tables."""

from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from chronostrata.functions import in_last_days
from chronostrata.operators.history import scd2_backfill
from chronostrata.operators.latest import latest_by_key

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    """Plan as for tables of any size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(name, text):
    return len(re.findall(rf"\b{name}\b", text))


# Streams and loads write as they are built; their reads are plain scans.
LAZY = sorted(n for n in contract.queries() if not n.startswith(("stream", "full_load")))


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


def test_both_history_windows_share_one_shuffle(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(scd2_backfill(events, "user_id", ["event_type"], "ts", ["event_id"], grain="ts", previous=["event_type"]))
    assert count("Exchange", text) == 1 and len(re.findall(r"- Sort ", text)) == 1
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>", text)


def test_newest_row_is_limited_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(latest_by_key(events.select("user_id", "ts"), "user_id", [F.desc("ts")]))
    assert count("WindowGroupLimit", text) == 2 and count("Exchange", text) == 1
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_filters_and_columns_reach_the_scan(spark):
    # `pit_read` takes all events since its facts are no longer a part of them; a filter that is left is the one on dates.
    recent = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_orderdate")
    text = plan(recent.where(in_last_days("o_orderdate", "2001-08-01", 30)))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,2001-07-02T00:00), LessThan(o_orderdate,2" in text
    text = plan(contract.queries()["active_90d"](spark, SF_DIR))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
    text = plan(contract.queries()["fact_sales"](spark, SF_DIR))
    assert "l_comment" not in text and "l_tax" not in text


def test_satellite_join_and_window_share_the_shuffle_of_the_batch(spark):
    from chronostrata.operators.vault import sat_load

    schema = "hk string, a string, record_source string, load_dttm timestamp_ntz"
    rows = [("1", "a", "s", dt.datetime(2024, 1, 1))]
    src = spark.createDataFrame(rows, schema)
    sat = src.withColumn("hashdiff", F.md5("a"))
    text = plan(sat_load(sat, src, "hk", ["a"]))
    # One for the batch, one for the newest stored rows.
    assert count("Exchange", text) == 2


def test_shuffles_start_with_as_many_partitions_as_the_tables_need(spark, monkeypatch):
    from chronostrata import session

    monkeypatch.setattr(session, "INPUT_SHARE", 1 << 15)
    # Small enough that adaptive execution merges nothing.
    names = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    for name in names:
        spark.conf.set(name, "1")
    try:
        size = sum(f.stat().st_size for f in Path(SF_DIR).iterdir())
        assert contract.queries()["mart_daily_sales"](spark, SF_DIR).rdd.getNumPartitions() > size >> 16 > 4
    finally:
        for name in names:
            spark.conf.unset(name)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")

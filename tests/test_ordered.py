"""Keys cut into chunks must give what one window over the whole key gives."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chronostrata.operators.anchor import anchor_split
from chronostrata.operators.history import scd2_backfill, scd6
from chronostrata.operators.joins import join_as_of, join_as_of_long
from chronostrata.operators.keys import assign_keys
from chronostrata.operators.ordered import carry_last, in_order, with_next, with_prev
from chronostrata.operators.quality import check_overlap
from chronostrata.operators.vault import effectivity, sat_load

HOT = 40


@pytest.fixture(scope="module")
def log(spark):
    """Key 1 holds more than a third of the rows, most of them within one minute; key 2 is hot as
    well; NULL is a value of `state`."""
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(900):
        key = 1 if i % 2 == 0 else 2 if i % 10 == 1 else rng.randint(3, 40)
        offset = rng.random() * 60 if key == 1 and i % 5 else rng.random() * 86400 * 30
        state = rng.choice(["a", "b", "c", None])
        rows.append((key, start + dt.timedelta(seconds=round(offset, 3)), i, state))
    return spark.createDataFrame(rows, "k int, ts timestamp_ntz, n int, state string").cache()


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_hot_keys_are_cut_evenly(log):
    cut = in_order(log, "k", ("ts", "n"), HOT)
    assert cut.hot
    sizes = cut.df.where("_chunk > 0").groupBy("_chunk").count().collect()
    assert len(sizes) > 5
    assert max(r["count"] for r in sizes) <= 3 * HOT
    assert rows(cut.plain()) == rows(log)


def test_small_keys_are_left_alone(log):
    assert not in_order(log, "k", ("ts", "n")).hot
    assert not in_order(log, "k", ("ts", "n"), None).hot


def test_neighbours_and_carry(log):
    w = Window.partitionBy("k").orderBy("ts", "n")
    cut = in_order(log, "k", ("ts", "n"), HOT)
    got = with_prev(cut, {"p": "state", "pn": "n"})
    got = with_next(got, {"x": "state", "xn": "n"}).plain()
    want = log.withColumns({
        "p": F.lag("state").over(w), "pn": F.lag("n").over(w), "x": F.lead("state").over(w), "xn": F.lead("n").over(w)
    })
    assert rows(got) == rows(want)
    carried = carry_last(cut, "state", "seen").plain()
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    assert rows(carried) == rows(log.withColumn("seen", F.last("state", ignorenulls=True).over(so_far)))


def test_next_after_a_filter_skips_empty_chunks(log):
    cut = in_order(log, "k", ("ts", "n"), HOT).where(F.col("n") % 97 == 0)
    w = Window.partitionBy("k").orderBy("ts", "n")
    want = log.where("n % 97 = 0").withColumn("x", F.lead("n").over(w))
    assert rows(with_next(cut, {"x": "n"}).plain()) == rows(want)


@pytest.mark.parametrize("build", [
    lambda d, hot: scd2_backfill(d, "k", ["state"], "ts", ["n"], grain="ts", hot_rows=hot),
    lambda d, hot: scd6(d, "k", "state", "ts", ["n"], grain="ts", hot_rows=hot),
    lambda d, hot: anchor_split(d, "k", ["state"], "ts", ["n"], hot_rows=hot)["state"],
    lambda d, hot: sat_load(
        None, d.select(F.col("k"), "state", "n", F.col("ts").alias("load_dttm"), F.lit("x").alias("record_source")),
        "k", ["state"], ["n"], hot_rows=hot),
    lambda d, hot: effectivity(d.withColumnRenamed("ts", "load_dttm"), "k", hot_rows=hot),
    lambda d, hot: check_overlap(
        d.select("k", F.col("ts").alias("valid_from"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("valid_to")),
        "k", "log", hot_rows=hot),
])
def test_operators_do_not_depend_on_the_cut(log, build):
    assert rows(build(log, HOT)) == rows(build(log, None))


def test_as_of_join_over_long_histories(spark, log):
    history = scd2_backfill(log, "k", ["state"], "ts", ["n"], grain="ts")
    history = history.where("hashdiff IS NOT NULL").where(F.hour("valid_from") != 3)  # leaves gaps
    facts = log.select("k", (F.col("ts") + F.expr("INTERVAL 7 MINUTES")).alias("at"), "n")
    want = rows(join_as_of(facts, history, "k", "at", max_versions=10**9))
    assert want
    assert rows(join_as_of(facts, history, "k", "at", max_versions=5)) == want
    assert rows(join_as_of_long(facts, history, "k", "at")) == want
    assert rows(join_as_of_long(facts, history, "k", "at", hot_rows=HOT)) == want


def test_keys_are_consecutive_in_order(spark, log):
    numbered = assign_keys(log, ["k", "ts", "n"], "sk", start=11, partitions=5)
    got = [r.n for r in numbered.orderBy("sk").collect()]
    assert [r.sk for r in numbered.orderBy("sk").collect()] == list(range(11, 911))
    assert got == [r.n for r in log.orderBy("k", "ts", "n").collect()]


@pytest.mark.parametrize("closed", [False, True])
def test_as_of_join_has_one_result_at_any_length(spark, closed):
    """Empty, touching and overlapping periods, tied starts: both forms give the same rows."""
    periods = [
        ("a", 1, 5, "x"), ("a", 5, 5, "empty"), ("a", 5, 9, "y"), ("a", 9, None, "z"),
        ("b", 1, 10, "wide"), ("b", 3, 5, "inner"), ("b", 12, 12, "point"),
        ("c", 2, 6, "one"), ("c", 2, 6, "two"), ("c", 6, 2, "backwards"),
    ]
    history = spark.createDataFrame(periods, "k string, valid_from int, valid_to int, v string")
    facts = spark.createDataFrame([(k, t) for k in "abcd" for t in range(14)], "k string, at int")
    found = [
        sorted(map(tuple, join_as_of(facts, history, "k", "at", closed=closed, max_versions=n).select("k", "at", "v").collect()))
        for n in (1, 10**9)
    ]
    assert found[0] == found[1]
    assert len({f[:2] for f in found[0]}) == len(found[0])
    assert closed or ("a", 5, "y") in found[0]
    assert ("a", 13, "z") in found[0]

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronostrata.operators import history as h
from chronostrata.operators import quality as q
from chronostrata.operators.latest import latest_as_of, latest_attrs, latest_by_key
from chronostrata.operators.upsert import insert_if_absent, upsert_newer

T = dt.datetime.fromisoformat
D = dt.date.fromisoformat
LOG = "k int, v string, ts timestamp_ntz, n int"


def log(spark, rows):
    return spark.createDataFrame([(k, v, T(t), i) for i, (k, v, t) in enumerate(rows)], LOG)


def daily(spark, rows):
    return h.scd2_backfill(log(spark, rows), "k", ["v"], "ts", ["n"])


def periods(df):
    return {(r.k, r.v, r.valid_from, r.valid_to) for r in df.select("k", "v", "valid_from", "valid_to").collect()}


def test_repeated_and_case_only_states_are_one_period(spark):
    got = periods(daily(spark, [(1, "active", "2024-01-01"), (1, "active", "2024-01-02"), (1, " ACTIVE", "2024-01-03")]))
    assert got == {(1, "active", D("2024-01-01"), None)}


def test_null_and_blank_are_one_state(spark):
    assert len(periods(daily(spark, [(1, None, "2024-01-01"), (1, " ", "2024-01-02")]))) == 1


def test_same_day_pair(spark):
    pair = [(1, "a", "2024-01-01 08:00"), (1, "b", "2024-01-01 09:00"), (1, "c", "2024-01-05")]
    assert periods(daily(spark, pair)) == {
        (1, "b", D("2024-01-01"), D("2024-01-05")), (1, "c", D("2024-01-05"), None)
    }
    by_time = h.scd2_backfill(log(spark, pair), "k", ["v"], "ts", ["n"], grain="ts")
    assert [(r.v, r.valid_to) for r in by_time.orderBy("valid_from").collect()] == [
        ("a", T("2024-01-01 09:00")), ("b", T("2024-01-05")), ("c", None)
    ]


def test_carried_columns_come_from_the_opening_event(spark):
    got = h.scd2_backfill(log(spark, [(1, "a", "2024-01-01"), (1, "a", "2024-01-02")]), "k", ["v"], "ts", ["n"], carry=["n"])
    assert [r.n for r in got.collect()] == [0]


def snap(spark, *rows):
    return spark.createDataFrame([(k, v, D(d)) for k, v, d in rows], "k int, v string, eff date")


def apply(dim, s):
    return h.scd2_apply(dim, s, "k", ["v"], "eff")


def test_increment_ignores_same_day_and_backdated_changes(spark):
    dim = daily(spark, [(1, "a", "2024-01-05")])
    for day in ("2024-01-05", "2024-01-01"):
        s = snap(spark, (1, "b", day))
        assert periods(apply(dim, s)) == periods(dim)
        assert h.not_newer(dim, s, "k", ["v"], "eff").count() == 1
    assert h.not_newer(dim, snap(spark, (1, "A ", "2024-01-01")), "k", ["v"], "eff").count() == 0


def test_increment_of_a_key_without_open_row(spark):
    """A closed key opens again, but never twice on one day."""
    dim = daily(spark, [(1, "a", "2024-01-05")]).withColumn("valid_to", F.lit("2024-01-10").cast("date"))
    assert len(periods(apply(dim, snap(spark, (1, "b", "2024-01-05"))))) == 1
    assert periods(apply(dim, snap(spark, (1, "b", "2024-01-12")))) == {
        (1, "a", D("2024-01-05"), D("2024-01-10")), (1, "b", D("2024-01-12"), None)
    }


def test_increment_stamps_only_what_it_touches(spark):
    old, run = dt.datetime(2024, 1, 6), dt.datetime(2024, 2, 1)
    dim = h.stamp(daily(spark, [(1, "a", "2024-01-05"), (2, "a", "2024-01-05")]), old)
    got = h.scd2_apply(dim, snap(spark, (1, "b", "2024-01-20"), (2, "a", "2024-01-20")), "k", ["v"], "eff", run)
    assert {(r.k, r.v, r.created_at, r.updated_at) for r in got.collect()} == {
        (1, "a", old, run), (1, "b", run, run), (2, "a", old, old)
    }


def test_repair_splits_the_period(spark):
    known = [(1, "a", "2024-01-01"), (1, "c", "2024-01-10"), (2, "x", "2024-01-01")]
    late = [(1, "b", "2024-01-05")]
    got = h.scd2_repair(daily(spark, known), log(spark, known + late), log(spark, late), "k", ["v"], "ts", ["n"])
    assert periods(got) == periods(daily(spark, known + late))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from("abc"), st.integers(0, 40)), min_size=1, max_size=25), st.data())
def test_increments_in_order_equal_the_backfill(spark, events, data):
    """One state per key and day, applied day range by day range with one state per batch."""
    by_day = {(k, d): v for k, v, d in events}
    rows = [(k, v, str(D("2024-01-01") + dt.timedelta(days=d))) for (k, d), v in sorted(by_day.items())]
    batches: list[list] = []
    for row in sorted(rows, key=lambda r: r[2]):
        last = batches[-1] if batches else None
        if last is None or row[0] in {r[0] for r in last} or data.draw(st.booleans()):
            batches.append([row])
        else:
            last.append(row)
    want = periods(daily(spark, rows))
    state = periods(daily(spark, batches[0]))
    for batch in batches[1:]:
        dim = spark.createDataFrame(sorted(state, key=repr), "k int, v string, valid_from date, valid_to date")
        dim = dim.withColumn("hashdiff", h.hashdiff("v"))
        once = apply(dim, snap(spark, *batch))
        state = periods(once)
    assert state == want
    final = daily(spark, rows)
    report = q.report([
        q.check_one_current(final, "k", "d"), q.check_overlap(final, "k", "d"), q.check_rules(final, "d", q.period_order())
    ])
    assert all(r.passed for r in report.collect())


def test_append_only(spark):
    """A changed and a new customer are appended, the stored row stays."""
    dim = spark.createDataFrame([(1, "Regular", D("2024-01-01"))], "k int, v string, valid_from date")
    src = spark.createDataFrame([(1, "VIP", None), (2, "Regular", None)], "k int, v string, eff date")
    added = h.scd2_append_rows(dim, src, "k", ["v"], "eff", as_of="2025-11-04")
    assert {tuple(r) for r in added.select("k", "v", "valid_from").collect()} == {
        (1, "VIP", D("2025-11-04")), (2, "Regular", D("2025-11-04"))
    }
    whole = dim.unionByName(added)
    assert h.scd2_append_rows(whole, src, "k", ["v"], "eff", "2025-12-01").count() == 0
    gone = spark.createDataFrame([(1, None, None)], "k int, v string, eff date")
    assert h.scd2_append_rows(whole, gone, "k", ["v"], "eff", "2025-12-01").count() == 1
    assert {(r.k, r.v) for r in h.append_only_current(whole, "k").collect()} == {(1, "VIP"), (2, "Regular")}
    at = latest_as_of(whole, "k", "valid_from", F.lit("2025-01-01").cast("date"))
    assert {(r.k, r.v) for r in at.collect()} == {(1, "Regular")}


def test_types_0_1_3(spark):
    dim = log(spark, [(1, "a", "2024-01-01")]).drop("n")
    src = log(spark, [(1, "b", "2024-02-01"), (1, "c", "2024-02-02"), (2, "x", "2024-02-01"), (2, "y", "2024-02-02")]).drop("n")
    kept = {(r.k, r.v) for r in h.scd0(dim, src, "k", "ts").collect()}
    assert kept == {(1, "a"), (2, "x")}
    assert {(r.k, r.v) for r in h.scd1(dim, src, "k", "ts").collect()} == {(1, "c"), (2, "y")}
    three = dim.select("k", "v", F.lit("z").alias("previous_v"), F.lit("2023-01-01").cast("date").alias("v_change_date"))
    got = {tuple(r) for r in h.scd3(three, src, "k", "v", "ts").collect()}
    assert got == {(1, "c", "a", D("2024-02-02")), (2, "y", None, None)}
    same = h.scd3(three, dim, "k", "v", "ts").first()
    assert tuple(same) == (1, "a", "z", D("2023-01-01"))


def test_latest_attrs_keeps_null_of_the_newest(spark):
    dim = spark.createDataFrame([(1, "a", D("2024-01-01")), (1, None, D("2024-02-01"))], "k int, v string, valid_from date")
    assert latest_attrs(dim, "k", "valid_from", ["v"]).first().v is None
    assert latest_by_key(dim, "k", [F.desc("valid_from")]).first().v is None


STATE = "k int, v string, ts timestamp_ntz, _load_id string, _load_ts timestamp_ntz"


def test_upsert_takes_strictly_newer_rows(spark):
    t = spark.createDataFrame([(1, "a", T("2024-01-05"), "l1", T("2024-01-05"))], STATE)
    for ts, want in (("2024-01-05", "a"), ("2024-01-04", "a"), ("2024-01-06", "b")):
        s = spark.createDataFrame([(1, "b", T(ts), "l2", T("2024-03-01"))], STATE)
        assert [r.v for r in upsert_newer(t, s, "k", F.col("ts")).collect()] == [want]


def test_insert_if_absent_ignores_replays(spark):
    t = spark.createDataFrame([(1, "a", T("2024-01-05"), "l1", T("2024-01-05"))], STATE)
    s = spark.createDataFrame(
        [(1, "z", T("2024-01-05"), "l2", T("2024-02-01")), (2, "late", T("2024-01-06"), "l3", T("2024-03-01")),
         (2, "first", T("2024-01-06"), "l2", T("2024-02-01"))], STATE)
    got = insert_if_absent(t, s, ["k", "ts"])
    assert {r.v for r in got.collect()} == {"a", "first"}
    assert insert_if_absent(got, s, ["k", "ts"]).count() == 2


def test_unknown_grain(spark):
    with pytest.raises(ValueError, match="grain"):
        h.scd2_backfill(log(spark, [(1, "a", "2024-01-01")]), "k", ["v"], "ts", ["n"], grain="week")

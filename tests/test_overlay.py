"""Overlays, repaired satellites and the point-in-time sweep against plain Python."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from chronostrata.operators import vault as v
from chronostrata.operators.history import scd2_backfill
from chronostrata.operators.ordered import carry_all, in_order
from chronostrata.operators.overlay import overlay

PERIODS = "k int, valid_from int, valid_to int, a string, b string"


def periods_of(seed):
    """Periods without overlap, some touching, some open, for key 1 many more than for others."""
    rng = random.Random(seed)
    rows = []
    for k in range(1, 7):
        at = rng.randint(0, 5)
        for i in range(60 if k == 1 else rng.randint(0, 5)):
            end = at + rng.randint(1, 4)
            last = i > 3 and rng.random() < 0.02
            rows.append((k, at, None if last else end, rng.choice("xy"), rng.choice(["p", None])))
            if last:
                break
            at = end + rng.choice([0, 0, 1, 3])
    return rows


def brute(sources, horizon=400):
    told = set()
    for k in range(1, 7):
        before, start = None, None
        for t in [*range(-1, horizon), None]:
            state = None
            if t is not None:
                valid = [next((r for r in rows if r[0] == k and r[1] <= t and (r[2] is None or t < r[2])), None) for rows in sources.values()]
                if any(valid):
                    picks = [next(((n, r[i]) for n, r in zip(sources, valid, strict=True) if r and r[i] is not None), ("", None)) for i in (3, 4)]
                    state = (picks[0][1], picks[1][1], picks[0][0], picks[1][0])
            if state != before or t is None:
                if before is not None:
                    told.add((k, *before, start, None if t is None else t))
                before, start = state, t
    return told


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_overlay_of_three_sources(spark, hot_rows):
    sources = {"best": periods_of(1), "second": periods_of(2), "last": [*periods_of(3), (6, 500, 500, "empty", None)]}
    dfs = {n: spark.createDataFrame(r, PERIODS) for n, r in sources.items()}
    got = overlay(dfs, "k", ["a", "b"], hot_rows=hot_rows).collect()
    want = brute(sources)
    assert {(r.k, r.a, r.b, r.sources[0], r.sources[1], r.valid_from, r.valid_to) for r in got} == want
    assert len(got) == len(want) > 50
    assert overlay({"only": dfs["best"].where("false")}, "k", ["a", "b"]).count() == 0


SAT = "hk string, a string, record_source string, load_dttm timestamp_ntz, n int"


def day(d):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=d)


def chain(rows):
    """Versions in order, without repeats of the one before."""
    told, before = [], {}
    for hk, a, d in sorted(rows, key=lambda r: (r[0], r[2])):
        if before.get(hk) != a:
            told.append((hk, a, d))
        before[hk] = a
    return told


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_late_rows_are_chained_in(spark, hot_rows):
    rng = random.Random(8)
    rows = [(f"k{rng.randint(1, 4) if i % 3 else 1}", rng.choice("ab"), day(d)) for i, d in enumerate(rng.sample(range(300), 90))]
    late = [r for r in rows if (r[2] - day(0)).days // 20 % 3 == 1]
    stored = chain([r for r in rows if r not in late])

    def frame(found):
        return spark.createDataFrame([(k, a, "s", d, i) for i, (k, a, d) in enumerate(found)], SAT)

    sat = v.sat_load(None, frame([r for r in rows if r not in late]), "hk", ["a"], hot_rows=hot_rows)
    assert sorted((r.hk, r.a, r.load_dttm) for r in sat.collect()) == sorted(stored)
    sat = sat.unionByName(v.sat_load(sat, frame(late), "hk", ["a"], hot_rows=hot_rows))
    fixes = v.sat_repair(sat, v.behind(sat, frame(late), "hk"), "hk", ["a"], hot_rows)
    assert fixes.where("is_void").count() and fixes.where("NOT is_void").count()
    whole = sat.withColumn("is_void", F.lit(False)).unionByName(fixes)
    assert sorted((r.hk, r.a, r.load_dttm) for r in v.sat_net(whole, "hk").collect()) == sorted(chain([*stored, *late]))
    # The same late rows once more, and a row at a load time that is stored.
    again = v.sat_repair(whole, frame([*late, (stored[0][0], "other", stored[0][2])]), "hk", ["a"], hot_rows)
    assert again.count() == 0


def test_late_sets_are_reported_and_chained_in(spark):
    def frame(sets):
        return spark.createDataFrame([("1", a, "s", day(d), 0) for d, values in sets for a in values], SAT)

    sat = v.multi_active_load(None, frame([(1, "xy"), (5, "yz"), (9, "xy")]), "hk", ["a"])
    late = frame([(2, "xy"), (3, "yz"), (7, "z"), (9, "xy")])
    assert {r.load_dttm for r in v.multi_active_late(sat, late, "hk", ["a"]).collect()} == {day(3), day(7)}
    fixes = v.multi_active_repair(sat, v.behind(sat, late, "hk"), "hk", ["a"])
    whole = sat.withColumn("is_void", F.lit(False)).unionByName(fixes)
    got = {}
    for r in v.sat_net(whole, "hk").collect():
        got.setdefault(r.load_dttm, set()).add(r.a)
    assert got == {day(1): set("xy"), day(3): set("yz"), day(7): set("z"), day(9): set("xy")}


def test_point_in_time_shuffles_changes_not_days(spark):
    hub = spark.createDataFrame([("1", day(3)), ("2", day(-40))], "hk string, load_dttm timestamp_ntz")
    sat = spark.createDataFrame([("1", day(5)), ("1", day(5) + dt.timedelta(hours=2)), ("2", day(-9)), ("3", day(8))], "hk string, load_dttm timestamp_ntz")
    pit = v.pit_daily(hub, {"s": sat, "t": sat.where("hk = '2'")}, "hk", "2024-01-01", "2024-01-10")
    text = pit._jdf.queryExecution().executedPlan().toString()
    got = {(r.hk, (r.as_of_date - dt.date(2024, 1, 1)).days): (r.s_load_dttm, r.t_load_dttm) for r in pit.collect()}
    want = {("1", d): (day(5) + dt.timedelta(hours=2) if d >= 5 else None, None) for d in range(3, 10)}
    want |= {("2", d): (day(-9), day(-9)) for d in range(10)} | {("3", d): (day(8), None) for d in (8, 9)}
    assert got == want
    # Days come out of the generator, above every exchange.
    assert text.count("Generate explode") == 1 and text.index("Generate explode") < text.index("Exchange")


def test_values_carried_together_equal_values_carried_alone(spark):
    rng = random.Random(2)
    rows = [(rng.randint(1, 3) if i % 2 else 1, i, rng.choice([None, "a", "b"]), rng.choice([None, 1, 2])) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, n int, s string, i int")
    want = carry_all(in_order(df, "k", "n", None), {"cs": "s", "ci": "i"}).plain()
    got = carry_all(in_order(df, "k", "n", 30), {"cs": "s", "ci": "i"}).plain()
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_a_hot_key_is_read_twice_however_much_is_asked(spark):
    rng = random.Random(1)
    rows = [(1 if i % 2 else rng.randint(2, 9), rng.choice("abc"), day(0) + dt.timedelta(minutes=i // 3), i) for i in range(400)]
    log = spark.createDataFrame(rows, "k int, v string, ts timestamp_ntz, n int")
    found = {}
    for asked in ((), ("v",)):
        df = scd2_backfill(log, "k", ["v"], "ts", ["n"], "ts", previous=asked, hot_rows=50)
        found[asked] = len(re.findall("FileScan parquet", df._jdf.queryExecution().executedPlan().toString()))
    assert found[()] == found[("v",)] == 2
    cold = scd2_backfill(log, "k", ["v"], "ts", ["n"], "ts", previous=["v"], hot_rows=None)
    hot = scd2_backfill(log, "k", ["v"], "ts", ["n"], "ts", previous=["v"], hot_rows=50)
    assert sorted(map(tuple, hot.select(*cold.columns).collect()), key=repr) == sorted(map(tuple, cold.collect()), key=repr)

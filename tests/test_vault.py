from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronostrata.operators import vault as v
from chronostrata.operators.joins import expand_days
from chronostrata.operators import search
from chronostrata.operators.search import ragged, vector_top_k

T = dt.datetime.fromisoformat
D = dt.date.fromisoformat


def sat_rows(spark, rows):
    return spark.createDataFrame(
        [(k, a, "src", T(t)) for k, a, t in rows], "hk string, a string, record_source string, load_dttm timestamp_ntz")


def test_hub_keeps_the_first_source(spark):
    src = spark.createDataFrame(
        [("c1", "crm", T("2024-01-02")), ("C1 ", "web", T("2024-01-01")), ("c2", "crm", T("2024-01-03")), (None, "crm", T("2024-01-01"))],
        "bk string, record_source string, load_dttm timestamp_ntz")
    hub = v.hub_load(None, src, "bk", "hk")
    assert {(r.record_source, r.load_dttm.day) for r in hub.collect()} == {("web", 1), ("crm", 3)}
    assert v.hub_load(hub, src, "bk", "hk").count() == 0


def test_satellite_reload_adds_nothing_and_returning_values_count(spark):
    src = sat_rows(spark, [("1", "a", "2024-01-01"), ("1", "a", "2024-01-02"), ("1", "b", "2024-01-03"), ("1", "a", "2024-01-04")])
    sat = v.sat_load(None, src, "hk", ["a"])
    assert [r.a for r in sat.orderBy("load_dttm").collect()] == ["a", "b", "a"]
    assert v.sat_load(sat, src, "hk", ["a"]).count() == 0
    assert v.sat_load(sat, src, "hk", ["a"], hot_rows=2).count() == 0
    assert v.sat_load(sat, sat_rows(spark, [("1", "a", "2024-01-05")]), "hk", ["a"]).count() == 0
    assert v.sat_load(sat, sat_rows(spark, [("1", "b", "2024-01-05")]), "hk", ["a"]).count() == 1


def test_point_in_time_does_not_fan_out_on_returning_values(spark):
    sat = v.sat_load(None, sat_rows(spark, [("1", "a", "2024-01-01"), ("1", "b", "2024-01-03"), ("1", "a", "2024-01-05")]), "hk", ["a"])
    hub = spark.createDataFrame([("1", T("2024-01-01")), ("2", T("2024-01-04"))], "hk string, load_dttm timestamp_ntz")
    pit = v.pit_daily(hub, {"s": sat}, "hk", "2023-12-30", "2024-01-06")
    got = {(r.hk, r.as_of_date.day): r.s_load_dttm and r.s_load_dttm.day for r in pit.collect()}
    assert got == {("1", 1): 1, ("1", 2): 1, ("1", 3): 3, ("1", 4): 3, ("1", 5): 5, ("1", 6): 5,
                   ("2", 4): None, ("2", 5): None, ("2", 6): None}
    facts = spark.createDataFrame([("1", D("2024-01-06"), 10), ("1", D("2024-01-03"), 20), ("2", D("2024-01-05"), 30)],
                                  "hk string, d date, amount int")
    read = v.read_pit(facts, pit, {"s": (sat, ["a"])}, "hk", "d")
    assert {(r.amount, r.a) for r in read.collect()} == {(10, "a"), (20, "b"), (30, None)} and read.count() == 3


def test_multi_active_compares_whole_sets(spark):
    src = sat_rows(spark, [("1", "x", "2024-01-01"), ("1", "y", "2024-01-01"),
                           ("1", "y", "2024-01-02"), ("1", "x", "2024-01-02"), ("1", "x", "2024-01-02"),
                           ("1", "x", "2024-01-03")])
    sat = v.multi_active_load(None, src, "hk", ["a"])
    assert sorted((r.load_dttm.day, r.a) for r in sat.collect()) == [(1, "x"), (1, "y"), (3, "x")]
    assert v.multi_active_load(sat, src, "hk", ["a"]).count() == 0
    same = v.multi_active_load(sat, sat_rows(spark, [("1", "x", "2024-01-04")]), "hk", ["a"])
    assert same.count() == 0
    grown = v.multi_active_load(sat, sat_rows(spark, [("1", "x", "2024-01-04"), ("1", "z", "2024-01-04")]), "hk", ["a"])
    assert sorted(r.a for r in grown.collect()) == ["x", "z"]


def test_bridge_over_a_long_chain(spark):
    def link(rows, a, b):
        return spark.createDataFrame(rows, f"{a} string, {b} string")

    links = [
        (link([("c1", "k1"), ("c1", "k2"), ("c2", "k2")], "c", "k"), "c", "k"),
        (link([("k1", "a1"), ("k2", "a1"), ("k2", "a2")], "k", "a"), "k", "a"),
        (link([("a1", "d1"), ("a2", "d2")], "a", "d"), "a", "d"),
        (link([("d1", "t1"), ("d1", "t2"), ("d2", "t3"), ("d2", "lost")], "d", "t"), "d", "t"),
    ]
    start = spark.createDataFrame([("c1",), ("c2",)], "c string")
    end = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "t string")
    want = {(c, t) for c in ("c1", "c2") for t in ("t1", "t2", "t3")}
    for each_hop in (True, False):
        got = v.bridge(start, links, end, each_hop)
        assert {(r.c, r.t) for r in got.collect()} == want and got.count() == len(want)


def test_priority_and_final_status(spark):
    a = spark.createDataFrame([(1, None, "A1"), (2, "p2", None)], "k int, plan string, name string")
    b = spark.createDataFrame([(1, "q1", "B1"), (3, "q3", None)], "k int, plan string, name string")
    got = {tuple(r) for r in v.pick_by_priority([a, b], "k", ["plan", "name"]).collect()}
    assert got == {(1, "q1", "A1"), (2, "p2", None), (3, "q3", None)}
    chain = ("created", "paid", "shipped", "delivered", "cancelled")
    events = spark.createDataFrame([(1, "paid", 1), (1, "shipped", 2), (1, "delivered", 2), (2, "created", 1)], "k int, s string, t int")
    assert {tuple(r) for r in v.final_status(events, "k", "s", "t", chain).collect()} == {(1, "delivered"), (2, "created")}


def test_zero_length_period_has_no_days(spark):
    df = spark.sql("SELECT 1 AS k, DATE '2024-01-05' AS valid_from, DATE '2024-01-05' AS valid_to")
    assert expand_days(df, "2024-01-01", "2024-01-31").count() == 0


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 16))
    vectors[100:200] = vectors[0]  # a third are copies of one vector
    queries = np.vstack([vectors[0], rng.normal(size=(6, 16)), np.zeros(16)])
    vs = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(vectors)], "vec_id long, embedding array<double>")
    qs = spark.createDataFrame([(f"q{i}", [float(x) for x in r]) for i, r in enumerate(queries)], "query_id string, embedding array<double>")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    norms = np.linalg.norm(queries, axis=1, keepdims=True)
    scores = np.round((queries / np.where(norms == 0, 1, norms)) @ unit.T, 12)
    want = {f"q{i}": sorted(range(300), key=lambda j: (-scores[i, j], j))[:7] for i in range(len(queries))}
    for block in (1024, 3):
        found = vector_top_k(qs, vs.repartition(5), 7, block=block)
        got = {}
        for r in found.orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert got == want
    assert vector_top_k(qs.where("false"), vs, 7).count() == 0


@pytest.mark.parametrize("broadcast_bytes", [search.BROADCAST_BYTES, 0])
def test_top_k_of_many_blocks_and_ragged_vectors(spark, monkeypatch, broadcast_bytes):
    """Broadcast blocks and the grid of blocks and parts, with vectors of several lengths and none at all."""
    monkeypatch.setattr(search, "BROADCAST_BYTES", broadcast_bytes)
    rng = np.random.default_rng(5)
    vectors = [(f"v{i:03}", rng.normal(size=4 if i % 3 else 6).tolist()) for i in range(200)] + [("none", None), ("empty", [])]
    queries = [(i, rng.normal(size=(4, 6, 5)[i % 3]).tolist()) for i in range(60)] + [(98, None), (99, [1.0, None, 0.0, 1.0])]
    vs = spark.createDataFrame(vectors, "vec_id string, embedding array<double>").repartition(4)
    qs = spark.createDataFrame(queries, "query_id long, embedding array<double>")
    want = set()
    for q, x in queries:
        same = [] if x is None or None in x else [(n, y) for n, y in vectors if y and len(y) == len(x)]
        scores = {n: float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)) for n, y in same}
        want |= {(q, n, r) for r, n in enumerate(sorted(scores, key=lambda n: (-scores[n], n))[:5], 1)}
    found = vector_top_k(qs, vs, 5, block=7, part=50)
    # As planned; what adaptive execution makes of these few rows is another matter.
    text = found._jdf.queryExecution().executedPlan().toString()
    assert {(r.query_id, r.vec_id, r["rank"]) for r in found.collect()} == want
    assert ("BroadcastHashJoin" in text) == bool(broadcast_bytes) and "CartesianProduct" not in text and "NestedLoop" not in text
    told = {(r.side, r.id, r.length) for r in ragged(qs, vs).collect()}
    assert told == {("query", str(q), len(x)) for q, x in queries if x and len(x) == 5} | {("query", "98", None), ("vector", "none", None), ("vector", "empty", 0)}


def test_hashed_keys_need_no_shuffle_and_ranges_follow_the_rows(spark):
    from chronostrata.operators.keys import assign_keys, hash_keys

    rows = spark.range(1000).withColumn("x", F.col("id") % 7)
    keyed = hash_keys(rows, ["id", "x"], "sk")
    assert "Exchange" not in keyed._jdf.queryExecution().executedPlan().toString()
    first, again = ({r.id: r.sk for r in hash_keys(df, ["id", "x"], "sk").collect()} for df in (rows, rows.repartition(3)))
    assert first == again and len(set(first.values())) == 1000 and min(first.values()) >= 0
    numbered = assign_keys(rows, ["x", "id"], "sk", rows_per_partition=100)
    assert numbered.rdd.getNumPartitions() >= 1 and [r.sk for r in numbered.orderBy("x", "id").collect()] == list(range(1, 1001))
    assert assign_keys(rows.where("false"), ["id"], "sk").count() == 0

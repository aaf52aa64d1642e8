"""Every constraint fails on the fixture made for it, and no other does; a failed write does not count."""

from __future__ import annotations

import datetime as dt

import pytest

import fixture_rows as fx
from chronostrata.operators.constraints import Constraints, gate, observed, report
from chronostrata.operators.quality import QualityError
from chronostrata.plans import warehouse
from chronostrata.session import cut
from chronostrata.sources.schemas import STAGING
from chronostrata.sources.staging import stage_rows
from chronostrata.sources.tables import read_table, versions, write_version

ROWS = "id int, name string, qty int, parent int, valid_to int"
GOOD = [(1, "a", 1, 10, None), (2, "b", 2, None, 5), (2, "b", 2, 10, 7), (3, None, 3, 11, None)]
PROMISES = Constraints(
    not_null=("id",),
    max_length={"name": 3},
    rules={"qty_positive": "qty > 0"},
    unique=(("id", "valid_to"),),
    unique_where={"one_open": (("id",), "valid_to IS NULL")},
    foreign={"parent": ("parents", "pk")},
)
BROKEN = {
    "id_filled": (None, "a", 1, 10, 1),
    "name_max_3": (9, "long", 1, 10, 1),
    "qty_positive": (9, "a", 0, 10, 1),
    "unique_id_valid_to": (2, "a", 1, 10, 5),
    "one_open": (1, "a", 1, 10, None),
    "parent_in_parents": (9, "a", 1, 99, 1),
}


@pytest.fixture(scope="module")
def parents(spark):
    return {"parents": spark.createDataFrame([(10,), (11,), (11,)], "pk long")}


def told(spark, rows, parents):
    df, counts = observed(spark.createDataFrame(rows, ROWS), PROMISES)
    return {check.split(".")[1]: actual for check, passed, actual, _ in report(counts, cut(df), "t", PROMISES, parents) if not passed}


def test_good_rows_keep_all_constraints(spark, parents):
    assert told(spark, GOOD, parents) == {}
    assert told(spark, [], parents) == {}


@pytest.mark.parametrize("rule", BROKEN)
def test_one_failure_per_rule(spark, parents, rule):
    assert told(spark, [*GOOD, BROKEN[rule]], parents) == {rule: 1}


def test_a_rule_without_an_answer_is_broken_and_keys_count_values(spark, parents):
    rows = [*GOOD, (9, "a", None, 10, 1), (9, "a", 1, 10, 1), (9, "a", 1, 10, 1), (8, "a", 1, 98, 1), (8, "a", 1, 98, 2)]
    assert told(spark, rows, parents) == {"qty_positive": 1, "unique_id_valid_to": 1, "parent_in_parents": 2}


def test_a_version_that_fails_does_not_count(spark, tmp_path, parents):
    path = f"{tmp_path}/t"

    def publish(rows):
        df, counts = observed(spark.createDataFrame(rows, ROWS), PROMISES)
        write_version(df, path, gate=gate(counts, "t", PROMISES, parents))

    publish(GOOD)
    with pytest.raises(QualityError, match="t.one_open: 1, expected 0"):
        publish([*GOOD, BROKEN["one_open"]])
    assert versions(spark, path) == [0] and read_table(spark, path).count() == len(GOOD)
    publish(GOOD[:2])
    assert versions(spark, path) == [0, 1] and read_table(spark, path).count() == 2


def test_an_increment_that_breaks_a_limit_is_refused(spark, tmp_path):
    run, loaded = dt.datetime(2024, 12, 1, 6, 0), dt.datetime(2024, 2, 6, 8)
    names = ("customers", "orders", "order_items", "products")
    sources = {"customers": fx.CUSTOMERS, "orders": fx.ORDERS, "order_items": fx.ORDER_ITEMS, "products": fx.PRODUCTS}
    staged = {
        n: stage_rows(spark, [r[: len(STAGING[n])] for r in sources[n]], STAGING[n], "batch_1", loaded) for n in names
    }
    at = warehouse.Warehouse(f"{tmp_path}/w")
    warehouse.full_load(staged, at, run)
    before = at.read(spark, "ods", "customers").count()
    long_city = [("900", "x@example.com", "700", "c" * 51, "2024-03-01")]
    batch = stage_rows(spark, long_city, STAGING["customers"], "batch_9", dt.datetime(2024, 3, 2))
    with pytest.raises(QualityError, match="customers.city_max_50"):
        warehouse.customer_increment(batch, at, run)
    assert at.read(spark, "ods", "customers").count() == before

"""The sample shop, from staged text to marts, against its expected rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixture_rows as fx
from chronostrata.operators import quality as q
from chronostrata.operators.history import scd2_backfill
from chronostrata.plans import cleaning, dims, sales, warehouse
from chronostrata.sources.schemas import STAGING, staging_schema
from chronostrata.sources.staging import stage_rows
from chronostrata.sources.tables import read_table, versions

RUN = dt.datetime(2024, 12, 1, 6, 0)


def staged(spark, name, rows):
    if len(rows[0]) > len(STAGING[name]):
        return spark.createDataFrame(rows, staging_schema(STAGING[name]))
    return stage_rows(spark, rows, STAGING[name], "batch_1", dt.datetime(2024, 2, 6, 8))


def rows(df, *cols):
    return {tuple(str(v) if type(v).__name__ == "Decimal" else v for v in r) for r in df.select(*cols).collect()}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    sources = {
        "customers": staged(spark, "customers", fx.CUSTOMERS),
        "orders": staged(spark, "orders", fx.ORDERS),
        "order_items": staged(spark, "order_items", fx.ORDER_ITEMS),
        "products": staged(spark, "products", fx.PRODUCTS),
    }
    return root, warehouse.full_load(sources, warehouse.Warehouse(root), RUN)


DIM = ("customer_bk", "email", "city", "hashdiff", "valid_from", "valid_to")


def test_full_load(loaded):
    _, t = loaded
    assert rows(t["dim_customer"], *DIM) == fx.DIM_CUSTOMER
    keys = {(r.customer_bk, r.valid_from): r.customer_sk for r in t["dim_customer"].collect()}
    assert [keys[k] for k in sorted(keys)] == [1, 2, 3, 4]
    customer = t["dim_customer"].select("customer_sk", "customer_bk", "valid_from")
    product = t["dim_product"].select("product_sk", "product_bk")
    fact = t["fact_sales"].join(customer, "customer_sk").join(product, "product_sk")
    assert rows(fact, "customer_bk", "valid_from", "product_bk", "date_key", "quantity", "amount") == fx.FACT_SALES
    assert sorted(r.sale_id for r in t["fact_sales"].collect()) == [1, 2, 3]
    assert rows(t["mart_daily_sales"], "*") == fx.MART_DAILY_SALES
    assert rows(t["mart_customer_360"], "*") == fx.MART_CUSTOMER_360


def test_calendar(loaded):
    dates = loaded[1]["dim_date"]
    assert dates.count() == 1826
    sunday = dates.where("date_key = 20240107").first()
    assert (sunday.weekday_name, sunday.weekday_num, sunday.is_first_week) == ("Sunday", 0, True)
    assert dates.where("day = 8 AND is_first_week").count() == 0


def test_customer_increment_and_rerun(spark, loaded):
    root, _ = loaded
    batch = staged(spark, "customers", fx.CUSTOMERS_INCREMENT)
    first = warehouse.customer_increment(batch, warehouse.Warehouse(root), RUN)
    assert rows(first["dim_customer"], *DIM) == fx.DIM_CUSTOMER_AFTER
    sk = [r.customer_sk for r in first["dim_customer"].collect()]
    assert sorted(sk) == [1, 2, 3, 4, 5, 6]
    before = rows(first["dim_customer"], "*")
    again = warehouse.customer_increment(batch, warehouse.Warehouse(root), RUN + dt.timedelta(days=1))
    assert rows(again["dim_customer"], "*") == before
    assert len(versions(spark, f"{root}/dds/dim_customer")) == 3


def test_status_history(spark, loaded, tmp_path):
    root, as_of = warehouse.Warehouse(str(tmp_path)), dt.date(2024, 12, 31)
    dates = dims.dim_date(spark)
    t = warehouse.status_load(staged(spark, "customer_status", fx.STATUS), root, RUN, as_of, dates)
    status = ("customer_bk", "status", "valid_from", "valid_to")
    assert rows(t["dim_customer_status"], *status) == fx.DIM_STATUS
    on = dims.status_at(t["dim_customer_status"], "2024-06-01", "customer_bk", ["status"])
    assert rows(on.where("customer_bk = 101"), "status") == {("vip",)}
    on = dims.status_at(t["dim_customer_status"], "2024-04-10", "customer_bk", ["status"])
    assert on.where("status = 'active'").count() == 2

    batch = staged(spark, "customer_status", fx.STATUS_INCREMENT)
    for _ in range(2):
        t = warehouse.status_increment(batch, root, RUN, as_of, dates)
        assert rows(t["dim_customer_status"], *status) == fx.DIM_STATUS_AFTER
        assert t["customer_status"].count() == 12
    mart = t["mart_customer_status_daily"]
    total = mart.agg(F.count("*"), F.sum("customers_cnt"), F.min("date_actual"), F.max("date_actual")).first()
    assert tuple(total) == (811, 1179, dt.date(2024, 1, 1), as_of)
    sample = mart.where(F.col("date_actual").isin([r[0] for r in fx.STATUS_DAILY_SAMPLE]))
    assert rows(sample, "*") == fx.STATUS_DAILY_SAMPLE


def test_price_differences(spark):
    prices, bad = cleaning.clean_prices(staged(spark, "prices", fx.PRICES))
    assert bad.count() == 0
    orders, _ = cleaning.clean_orders(staged(spark, "orders", fx.ORDERS))
    items, _ = cleaning.clean_items(staged(spark, "order_items", fx.ORDER_ITEMS))
    lines = items.join(orders.select("order_id", "order_date"), "order_id")
    assert rows(sales.price_differences(lines, prices), "order_item_id", "price", "price_at_sale") == {
        (3, "110.00", "100.00")
    }


def test_order_before_first_version_is_an_orphan(spark, loaded):
    _, t = loaded
    early = spark.createDataFrame([(1, dt.date(2023, 12, 31), 101)], "order_id int, order_date date, customer_id int")
    items = spark.createDataFrame(
        [(1, 1, 9001, 1, 5)], "order_item_id int, order_id int, product_id int, qty int, price_at_sale int"
    )
    fact = sales.fact_sales(early, items, t["dim_product"], t["dim_customer"])
    assert fact.count() == 0
    report = q.check_same_count(fact, items, "fact_sales").first()
    assert (report.passed, report.actual, report.expected) == (False, 0, 1)


def test_failed_gate_stops_before_the_marts(spark, tmp_path):
    sources = {
        "customers": staged(spark, "customers", fx.CUSTOMERS),
        "orders": staged(spark, "orders", [*fx.ORDERS, ("5003", "2023-01-01", "101")]),
        "order_items": staged(spark, "order_items", [*fx.ORDER_ITEMS, ("4", "5003", "9001", "1", "1.00")]),
        "products": staged(spark, "products", fx.PRODUCTS),
    }
    with pytest.raises(q.QualityError, match="fact_sales.same_count: 3, expected 4"):
        warehouse.full_load(sources, warehouse.Warehouse(str(tmp_path)), RUN)
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{tmp_path}/dm/mart_daily_sales")


def test_value_that_returns_has_one_hash_and_two_versions(spark):
    states, _ = cleaning.customer_states(staged(spark, "customers", fx.CUSTOMERS + fx.CUSTOMERS_INCREMENT))
    history = scd2_backfill(states, "customer_id", ["email", "phone", "city"], "eff_ts", ["_load_ts", "_load_id"])
    same = history.groupBy("customer_id", "hashdiff").count().where("count > 1")
    assert same.count() == 1


def counted(df):
    """`df` and a counter of its rows each time they are computed."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_rows_are_computed_once_in_a_load(spark, tmp_path):
    from chronostrata.operators.keys import assign_keys

    orders, seen = counted(spark.createDataFrame([("1", "2024-01-01", "7"), ("2", "2024-01-02", "8")], "order_id string, order_date string, customer_id string"))
    assert warehouse.Warehouse(str(tmp_path)).publish_clean("orders", cleaning.clean_orders, orders).count() == 2
    assert seen.value == 2 and spark.read.parquet(f"{tmp_path}/rejects/orders/version=0").count() == 0
    worse = orders.union(spark.createDataFrame([("x", "2024-01-01", "7")], orders.schema))
    assert warehouse.Warehouse(str(tmp_path)).publish_clean("orders", cleaning.clean_orders, worse).count() == 2
    assert [r["reject_reason"] for r in read_table(spark, f"{tmp_path}/rejects/orders").collect()] == ["order_id_is_key"]
    rows, seen = counted(spark.range(0, 100, 1, 4).select((F.col("id") * 7 % 100).alias("k")))
    assert {r["k"]: r["n"] for r in assign_keys(rows, ["k"], "n").collect()} == {k: k + 1 for k in range(100)}
    assert seen.value == 100

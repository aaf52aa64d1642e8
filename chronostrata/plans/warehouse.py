"""The load sequences a user schedules: full load, customer increment, status history.

Each target is written as a new version, so a failed run leaves the old tables in place and a
repeated run gives the same tables. A version counts only if it keeps the table's constraints
(`plans.constraints`), in full loads and increments alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chronostrata import fixed_values as fv
from chronostrata.operators import quality as q
from chronostrata.operators.constraints import Constraints, gate, observed
from chronostrata.plans import cleaning, dims, sales
from chronostrata.plans.constraints import CONSTRAINTS
from chronostrata.plans.status import mart_status_daily
from chronostrata.operators.keys import assign_keys, hash_keys
from chronostrata.operators.upsert import insert_if_absent, upsert_newer
from chronostrata.sources.schemas import CLEANED, INTEGRATED, MARTS, to_layout, with_key_type
from chronostrata.sources.tables import append_rows, read_table, write_version
from chronostrata.functions import effective_ts

CUSTOMER_ATTRS = ("email", "phone", "city")
LAYERS = {"ods": CLEANED, "dds": INTEGRATED, "dm": MARTS}


@dataclass(frozen=True)
class Warehouse:
    """Where the layers are and how wide their business keys are."""

    root: str
    key_type: str = "int"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        return read_table(spark, self.path(layer, name))

    def publish(
        self, df: DataFrame, layer: str, name: str, written: Callable[[], None] | None = None, **parents: DataFrame
    ) -> DataFrame:
        """Write the next version; it counts if it keeps the table's constraints. `parents` are the tables it
        refers to. `written` is called between the write and the check."""
        layout = with_key_type(LAYERS[layer][name], self.key_type)
        laid_out, promises = to_layout(df, layout), CONSTRAINTS.get(name, Constraints())
        counted, told = observed(laid_out, promises)
        check = gate(told, name, promises, parents)

        def judge(rows: DataFrame) -> None:
            if written:
                written()
            check(rows)

        write_version(counted, self.path(layer, name), gate=judge)
        return self.read(df.sparkSession, layer, name)

    def publish_clean(self, name: str, clean: Callable[..., tuple[DataFrame, DataFrame]], staged: DataFrame) -> DataFrame:
        """The good rows as the next version, the others among the rejects. The write of the good ones counts the
        others; where there is none, staging isn't read again for them."""
        told = Observation()
        good, bad = clean(staged, self.key_type, told)

        def reject() -> None:
            self.reject(bad if told.get["rejected"] else bad.limit(0), name)

        return self.publish(good, "ods", name, written=reject)

    def reject(self, bad: DataFrame, name: str) -> None:
        write_version(bad, self.path("rejects", name))


def full_load(
    staged: Mapping[str, DataFrame],
    at: Warehouse,
    run_ts: dt.datetime,
    calendar_from: dt.date = fv.CALENDAR_FROM,
    calendar_to: dt.date = fv.CALENDAR_TO,
    threshold: float = fv.PREMIUM_THRESHOLD,
    hashed_fact_keys: bool = False,
) -> dict[str, DataFrame]:
    """Staging (customers, orders, order_items, products) to cleaned tables, dimensions, fact,
    checks and marts. Stops before the marts when a check fails.

    Consecutive numbers cost the fact a sort of its own; with `hashed_fact_keys` a line's `sale_id` follows from its
    `order_item_id`, without a shuffle, and is the same in every load."""
    spark = staged["orders"].sparkSession
    orders = at.publish_clean("orders", cleaning.clean_orders, staged["orders"])
    items = at.publish_clean("order_items", cleaning.clean_items, staged["order_items"])
    products = at.publish_clean("products", cleaning.clean_products, staged["products"])
    states, bad = cleaning.customer_states(staged["customers"], at.key_type)
    at.reject(bad, "customers")
    customers = at.publish(cleaning.customer_snapshot(states), "ods", "customers")

    dates = at.publish(dims.dim_date(spark, calendar_from, calendar_to), "dds", "dim_date")
    product = at.publish(dims.dim_product(products), "dds", "dim_product")
    # History is built from all staged states; the cleaned snapshot holds only the newest one.
    customer = at.publish(
        dims.dim_history(states, "customer_id", CUSTOMER_ATTRS, "eff_ts", ("_load_ts", "_load_id"), "customer_sk", run_ts),
        "dds", "dim_customer",
    )
    if hashed_fact_keys:
        facts = hash_keys(sales.fact_sales(orders, items, product, customer, ["order_item_id"]), ["order_item_id"], "sale_id")
    else:
        facts = sales.fact_sales(orders, items, product, customer)
        facts = assign_keys(facts, ["date_key", "customer_sk", "product_sk", "quantity", "amount"], "sale_id")
    fact = at.publish(facts, "dds", "fact_sales", dim_customer=customer, dim_product=product, dim_date=dates)

    q.run_gate([
        q.check_not_empty(customer, "dim_customer"),
        q.check_same_count(fact, items, "fact_sales"),
        *history_checks(customer, "dim_customer"),
    ])
    return {
        "customers": customers, "orders": orders, "order_items": items, "products": products,
        "dim_date": dates, "dim_product": product, "dim_customer": customer, "fact_sales": fact,
        **marts(fact, dates, product, customer, at, threshold),
    }


def history_checks(dim: DataFrame, name: str) -> list[DataFrame]:
    """What takes more than a row or a key: one open version per customer, none that reaches into the next."""
    return [q.check_one_current(dim, "customer_bk", name), q.check_overlap(dim, "customer_bk", name)]


def marts(
    fact: DataFrame, dates: DataFrame, product: DataFrame, customer: DataFrame, at: Warehouse,
    threshold: float = fv.PREMIUM_THRESHOLD,
) -> dict[str, DataFrame]:
    """Scheduled refresh of the marts."""
    daily = sales.mart_daily_sales(fact, dates, product, threshold)
    profile = sales.mart_customer_360(fact, dates, customer)
    return {
        "mart_daily_sales": at.publish(daily, "dm", "mart_daily_sales"),
        "mart_customer_360": at.publish(profile, "dm", "mart_customer_360"),
    }


def customer_increment(staged: DataFrame, at: Warehouse, run_ts: dt.datetime) -> dict[str, DataFrame]:
    """New customer states into the cleaned snapshot (newer wins) and the history dimension.
    Replays and older states change nothing."""
    spark = staged.sparkSession
    states, bad = cleaning.customer_states(staged, at.key_type)
    at.reject(bad, "customers")
    snapshot = upsert_newer(
        at.read(spark, "ods", "customers"), states, "customer_id",
        effective_ts("event_ts", "_load_ts"),
    )
    customers = at.publish(snapshot, "ods", "customers")
    dim = at.read(spark, "dds", "dim_customer")
    delta = customers.withColumn("eff_ts", effective_ts("event_ts", "_load_ts"))
    applied = dims.dim_history_increment(dim, delta, "customer_id", CUSTOMER_ATTRS, "eff_ts", "customer_sk", run_ts)
    dim = at.publish(applied, "dds", "dim_customer")
    q.run_gate(history_checks(dim, "dim_customer"))
    return {"customers": customers, "dim_customer": dim}


def status_load(staged: DataFrame, at: Warehouse, run_ts: dt.datetime, as_of: dt.date, dates: DataFrame) -> dict[str, DataFrame]:
    """Status events: staging to cleaned events, full history, daily mart."""
    events = at.publish_clean("customer_status", cleaning.clean_status_events, staged)
    history = dims.dim_history(
        events, "customer_id", ["status"], "event_ts", ("_load_ts", "_load_id"), "customer_status_sk", run_ts
    )
    return _status_tables(events, history, at, as_of, dates)


def status_increment(staged: DataFrame, at: Warehouse, run_ts: dt.datetime, as_of: dt.date, dates: DataFrame) -> dict[str, DataFrame]:
    """A further batch of status events: known events are skipped, the newest event of each
    customer is applied to the history."""
    spark = staged.sparkSession
    append_rows(staged, at.path("stg", "customer_status"))
    batch, bad = cleaning.clean_status_events(staged, at.key_type)
    at.reject(bad, "customer_status")
    stored = at.read(spark, "ods", "customer_status")
    events = at.publish(
        insert_if_absent(stored, batch, ["customer_id", "event_ts"]), "ods", "customer_status"
    )
    newest = cleaning.snapshot_latest(events, "customer_id", F.col("event_ts"))
    dim = at.read(spark, "dds", "dim_customer_status")
    history = dims.dim_history_increment(
        dim, newest, "customer_id", ["status"], "event_ts", "customer_status_sk", run_ts
    )
    return _status_tables(events, history, at, as_of, dates)


def _status_tables(events: DataFrame, history: DataFrame, at: Warehouse, as_of: dt.date, dates: DataFrame) -> dict[str, DataFrame]:
    dim = at.publish(history, "dds", "dim_customer_status")
    q.run_gate(history_checks(dim, "dim_customer_status"))
    daily = mart_status_daily(dim, dates, as_of)
    mart = at.publish(daily, "dm", "mart_customer_status_daily")
    return {"customer_status": events, "dim_customer_status": dim, "mart_customer_status_daily": mart}

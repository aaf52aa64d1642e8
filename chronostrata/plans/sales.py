"""Sales fact and the marts over it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata import fixed_values as fv
from chronostrata.functions import amount, as_date, date_key, segment
from chronostrata.operators.joins import join_as_of
from chronostrata.operators.latest import latest_attrs


def fact_sales(
    orders: DataFrame, items: DataFrame, dim_product: DataFrame, dim_customer: DataFrame, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per order line with the customer version valid on the order date. `carry` names columns of
    the lines to be kept.

    The version is looked up once per order, before lines multiply the rows. Lines of orders
    older than the customer's first version, or of unknown products, are not in the fact;
    `check_orphans` and `check_same_count` report them.
    """
    versions = dim_customer.select("customer_sk", "customer_bk", "valid_from", "valid_to")
    dated = orders.select("order_id", "order_date", F.col("customer_id").alias("customer_bk"))
    headers = join_as_of(dated, versions, "customer_bk", "order_date").select("order_id", "order_date", "customer_sk")
    products = dim_product.select("product_sk", F.col("product_bk").alias("product_id"))
    lines = items.select("order_id", "product_id", "qty", "price_at_sale", *carry).join(headers, "order_id")
    return lines.join(products, "product_id").select(
        "customer_sk",
        "product_sk",
        date_key("order_date").alias("date_key"),
        F.col("qty").alias("quantity"),
        amount("price_at_sale", "qty").alias("amount"),
        *carry,
    )


def mart_daily_sales(
    fact: DataFrame, dates: DataFrame, products: DataFrame, threshold: float = fv.PREMIUM_THRESHOLD
) -> DataFrame:
    """Quantity and revenue per day, product and segment of the line amount.

    Rows are summed per surrogate key first and named afterwards: the dimensions are joined to
    the groups, not to every fact. Names two products share are summed again.
    """
    # A fact without its date or product is left out by these inner joins. The customer key
    # always has its dimension row: the fact takes it from there.
    grouped = fact.groupBy("date_key", "product_sk", segment("amount", threshold).alias("customer_segment")).agg(
        F.sum("quantity").alias("qty"), F.sum("amount").alias("revenue")
    )
    named = grouped.join(_days(dates, "date_actual"), "date_key").join(
        products.select("product_sk", "product_name"), "product_sk"
    )
    return named.groupBy("date_actual", "product_name", "customer_segment").agg(
        F.sum("qty").alias("total_qty"), F.sum("revenue").cast("decimal(18,2)").alias("total_revenue")
    )


def mart_customer_360(
    fact: DataFrame,
    dates: DataFrame,
    dim_customer: DataFrame,
    latest: Sequence[str] = ("email", "city"),
) -> DataFrame:
    """Lifetime numbers per customer over all versions, with the newest value of each `latest`
    attribute as `last_<attr>`, also when no fact points to that version."""
    # Dates first, within the scan; then one row per version meets the dimension. A fact row is
    # one line item, so counting rows counts distinct sale ids.
    per_version = (
        fact.join(_days(dates, "date_actual"), "date_key")
        .groupBy("customer_sk")
        .agg(
            F.min("date_actual").alias("first"),
            F.max("date_actual").alias("last"),
            F.count("*").alias("lines"),
            F.sum("quantity").alias("qty"),
            F.sum("amount").alias("spent"),
        )
    )
    owned = per_version.join(dim_customer.select("customer_sk", "customer_bk"), "customer_sk")
    totals = owned.groupBy("customer_bk").agg(
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
        F.sum("lines").alias("total_line_items"),
        F.sum("qty").alias("total_items"),
        F.sum("spent").cast("decimal(18,2)").alias("lifetime_value"),
    )
    newest = latest_attrs(dim_customer, "customer_bk", "valid_from", list(latest))
    return totals.join(newest.withColumnsRenamed({a: f"last_{a}" for a in latest}), "customer_bk", "left")


def spend_by_attribute(
    orders: DataFrame, dim_customer: DataFrame, attr: str, value: str, year: int, amount_col: str = "amount"
) -> DataFrame:
    """Orders and spend in `year` of whoever had `attr` = `value` when ordering. `orders` has
    customer_bk, order_id, order_date and the amount."""
    in_year = orders.where(F.year("order_date") == year)
    held = dim_customer.where(F.col(attr) == F.lit(value)).select("customer_bk", "valid_from", "valid_to")
    return join_as_of(in_year, held, "customer_bk", "order_date").agg(
        F.count("*").alias("orders_cnt"), F.coalesce(F.sum(amount_col), F.lit(0)).cast("decimal(18,2)").alias("spent")
    )


def revenue_star(fact: DataFrame, dim_customer: DataFrame, dates: DataFrame, attr: str = "city") -> DataFrame:
    """Revenue per `attr`, year and month with the attribute in the customer dimension."""
    wide = _monthly(fact, dates).join(dim_customer.select("customer_sk", attr), "customer_sk")
    return _revenue(wide, attr)


def revenue_normalised(
    fact: DataFrame, dim_customer: DataFrame, lookup: DataFrame, dates: DataFrame, attr: str, attr_key: str
) -> DataFrame:
    """The same revenue with the attribute in a table of its own."""
    keyed = _monthly(fact, dates).join(dim_customer.select("customer_sk", attr_key), "customer_sk")
    grouped = keyed.groupBy(attr_key, "year", "month").agg(F.sum("amount").alias("amount"))
    return _revenue(grouped.join(lookup.select(attr_key, attr), attr_key), attr)


def _monthly(fact: DataFrame, dates: DataFrame) -> DataFrame:
    dated = fact.join(_days(dates, "year", "month"), "date_key")
    return dated.groupBy("customer_sk", "year", "month").agg(F.sum("amount").alias("amount"))


def _days(dates: DataFrame, *cols: str) -> DataFrame:
    """The calendar, narrow enough for Spark to broadcast it where its size allows."""
    return dates.select("date_key", *cols)


def _revenue(wide: DataFrame, attr: str) -> DataFrame:
    return wide.groupBy(attr, "year", "month").agg(F.sum("amount").cast("decimal(18,2)").alias("revenue"))


def favourite_products(lines: DataFrame, key: str, product: str, date_col: str) -> DataFrame:
    """Most bought product per customer (ties by product) and the last visit."""
    bought = lines.groupBy(key, product).agg(
        F.count("*").alias("times"), F.max(as_date(F.col(date_col))).alias("last_bought")
    )
    # The smallest (-times, product) is the most frequent product, the first of equals.
    first = F.min(F.struct((-F.col("times")).alias("less"), F.col(product).alias("product"))).alias("_first")
    return (
        bought.groupBy(key)
        .agg(first, F.max("last_bought").alias("last_visit"))
        .select(
            key,
            F.col("_first.product").alias("favourite_product"),
            (-F.col("_first.less")).alias("times_bought"),
            "last_visit",
        )
    )


def price_differences(lines: DataFrame, prices: DataFrame, key: str = "product_id") -> DataFrame:
    """Lines sold at another price than the list price of their day (closed price periods)."""
    listed = prices.select(key, "valid_from", "valid_to", "price")
    matched = join_as_of(lines, listed, key, "order_date", closed=True)
    return matched.where(F.col("price") != F.col("price_at_sale")).drop("valid_from", "valid_to")


def mart_slice(
    mart: DataFrame,
    date_from: Column | dt.date | str,
    date_to: Column | dt.date | str,
    listed: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Days of a mart, both ends included; `listed` names columns with the values wanted of them. Sort the
    result where it is shown."""
    days = mart.where(F.col("date_actual").between(as_date(date_from), as_date(date_to)))
    for column, values in (listed or {}).items():
        days = days.where(F.col(column).isin(list(values)))
    return days

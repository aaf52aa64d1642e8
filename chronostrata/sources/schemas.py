"""Column layouts of the layers: staging is text as it came plus load metadata, the layers
above it are typed. Parquet keeps no constraints; `operators.quality` checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOAD_META = ("_load_id", "_load_ts")

STAGING = {
    "customers": ("customer_id", "email", "phone", "city", "event_ts"),
    "orders": ("order_id", "order_date", "customer_id"),
    "order_items": ("order_item_id", "order_id", "product_id", "qty", "price_at_sale"),
    "products": ("product_id", "name"),
    "prices": ("product_id", "valid_from", "valid_to", "price"),
    "customer_status": ("customer_id", "status", "event_ts"),
}


def staging_schema(columns, load_meta: bool = True) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    if load_meta:
        fields += [T.StructField("_load_id", T.StringType()), T.StructField("_load_ts", T.TimestampNTZType())]
    return T.StructType(fields)


CLEANED = {
    "customers": (
        "customer_id int, email string, phone string, city string, event_ts timestamp_ntz,"
        " _load_id string, _load_ts timestamp_ntz"
    ),
    "orders": ("order_id int, order_date date, customer_id int"),
    "order_items": (
        "order_item_id int, order_id int, product_id int, qty int, price_at_sale decimal(10,2)"
    ),
    "products": ("product_id int, name string"),
    "prices": ("product_id int, valid_from date, valid_to date, price decimal(10,2)"),
    "customer_status": (
        "customer_id int, status string, event_ts timestamp_ntz, _load_id string, _load_ts timestamp_ntz"
    ),
}

INTEGRATED = {
    "dim_date": (
        "date_key int, date_actual date, year smallint, quarter smallint, month smallint, day smallint,"
        " weekday_name string, weekday_num smallint, is_first_week boolean"
    ),
    "dim_product": ("product_sk bigint, product_bk int, product_name string"),
    "dim_customer": (
        "customer_sk bigint, customer_bk int, email string, phone string, city string, hashdiff string,"
        " valid_from date, valid_to date, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "dim_customer_status": (
        "customer_status_sk bigint, customer_bk int, status string, hashdiff string,"
        " valid_from date, valid_to date, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "fact_sales": (
        "sale_id bigint, customer_sk bigint, product_sk bigint, date_key int, quantity int, amount decimal(18,2)"
    ),
}

MARTS = {
    "mart_daily_sales": (
        "date_actual date, product_name string, customer_segment string, total_qty int,"
        " total_revenue decimal(18,2)"
    ),
    "mart_customer_360": (
        "customer_bk int, first_order_date date, last_order_date date, total_line_items int,"
        " total_items int, lifetime_value decimal(18,2), last_email string, last_city string"
    ),
    "mart_customer_status_daily": ("date_actual date, status string, customers_cnt int"),
}


def columns_of(layout: str) -> list[tuple[str, str]]:
    """`(name, type)` of every column of a layout text."""
    return [tuple(part.strip().split(" ")) for part in layout.split(", ")]


def with_key_type(layout: str, kind: str) -> str:
    """The layout with business keys of another type, for more than 2^31 of them."""
    keyed = ((n, kind if t == "int" and n.endswith(("_id", "_bk")) else t) for n, t in columns_of(layout))
    return ", ".join(f"{n} {t}" for n, t in keyed)


def empty_table(spark: SparkSession, layout: str) -> DataFrame:
    return spark.createDataFrame([], layout)


def to_layout(df: DataFrame, layout: str) -> DataFrame:
    """The columns of `layout` in its order and types. A count or sum that does not fit raises."""
    return df.select(*[df[name].cast(kind).alias(name) for name, kind in columns_of(layout)])

"""Reading and writing layers, and the whole load from staged text to marts."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from chronostrata.functions import to_int, to_money
from chronostrata.plans.warehouse import Warehouse, customer_increment, full_load
from chronostrata.session import shared_dir
from chronostrata.sources.staging import read_stg_csv, stage_rows, with_load_meta
from chronostrata.sources.tables import append_rows, read_table, replace_partitions, write_history, write_version
from chronostrata.suite.base import DAILY_SQL, query, table
from chronostrata.suite.history import daily_history
from chronostrata.suite.marts import THRESHOLD

RUN = dt.datetime(2024, 1, 31, 8)


def folder(spark):
    return f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"


@query("stage_csv", """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(10,2)) END AS balance,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS segment, 'batch_1' AS _load_id,
           TIMESTAMP '2024-01-31 08:00:00' AS _load_ts FROM customer""")
def stage_csv(spark, sf):
    """Customers through CSV: a missing balance stays missing, a blank segment stays blank."""
    path = f"{folder(spark)}/csv"
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.format_string("%.2f", "c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    rows.write.options(header="true", nullValue="", emptyValue='""', quoteAll="false").csv(path)
    staged = with_load_meta(read_stg_csv(spark, path, ["id", "balance", "segment"]), "batch_1", RUN)
    return staged.select(
        to_int("id", "bigint").alias("c_custkey"), to_money("balance").alias("balance"), "segment", "_load_id", "_load_ts"
    )


@query("refresh_versions", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def refresh_versions(spark, sf):
    """The second version is computed from the first and takes its place."""
    path = f"{folder(spark)}/orders"
    write_version(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path)
    done = F.when(F.col("o_orderstatus") == "P", F.lit("F")).otherwise(F.col("o_orderstatus"))
    write_version(read_table(spark, path).withColumn("o_orderstatus", done), path)
    return read_table(spark, path)


@query("replace_partitions", """
    SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority = '1-URGENT' THEN 'second' ELSE 'first' END AS load
    FROM orders""")
def replace_partitions_(spark, sf):
    path = f"{folder(spark)}/orders"
    rows = table(spark, sf, "orders").select("o_orderkey", F.lit("first").alias("load"), "o_orderpriority")
    replace_partitions(rows, path, "o_orderpriority")
    again = rows.where("o_orderpriority = '1-URGENT'").withColumn("load", F.lit("second"))
    replace_partitions(again, path, "o_orderpriority")
    return spark.read.parquet(path)


@query("append_staging", "SELECT event_id, event_type FROM events UNION ALL SELECT event_id, event_type FROM events")
def append_staging(spark, sf):
    """A replayed batch is kept in staging."""
    path = f"{folder(spark)}/events"
    rows = table(spark, sf, "events").select("event_id", "event_type")
    append_rows(rows, path)
    append_rows(rows, path)
    return spark.read.parquet(path)


@query("history_layout", f"WITH {DAILY_SQL} SELECT user_id, status, valid_from FROM hist WHERE valid_to IS NULL")
def history_layout(spark, sf):
    path = f"{folder(spark)}/history"
    write_history(daily_history(spark, sf), path, "user_id")
    return read_table(spark, path).where("is_current = 1").select("user_id", "status", "valid_from")


MOVED = "1998-01-01"


def staged_shop(spark, sf):
    """Customers (moving once when in debt), orders, lines and parts as staged text."""
    c = table(spark, sf, "customer")

    def state(rows, city, day, load):
        return rows.select(
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.concat(F.lower("c_name"), F.lit("@ex.com")).alias("email"),
            F.lit("700").alias("phone"),
            city.alias("city"),
            F.lit(day).alias("event_ts"),
            F.lit(load).alias("_load_id"),
            F.lit(f"{day} 08:00:00").cast("timestamp_ntz").alias("_load_ts"),
        )

    first = state(c, F.col("c_nationkey").cast("string"), "1995-01-01", "batch_1")
    moved = state(c.where("c_acctbal < 0"), F.lit("elsewhere"), MOVED, "batch_2")
    o, lines, parts = table(spark, sf, "orders"), table(spark, sf, "lineitem"), table(spark, sf, "part")
    return moved, {
        "customers": first,
        "orders": o.select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
            F.col("o_custkey").cast("string").alias("customer_id"),
        ),
        "order_items": lines.select(
            # The lines have no key of their own, and the table they go to promises one: whole rows are distinct.
            F.shiftrightunsigned(F.xxhash64(*lines.columns), 1).cast("string").alias("order_item_id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_quantity").cast("int").cast("string").alias("qty"),
            F.format_string("%.2f", "l_extendedprice").alias("price_at_sale"),
        ),
        "products": parts.select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("name")),
    }


@query("full_load_customer_360", """
    SELECT o_custkey AS customer_bk, min(CAST(o_orderdate AS DATE)) AS first_order_date,
           max(CAST(o_orderdate AS DATE)) AS last_order_date, CAST(count(*) AS INTEGER) AS total_line_items,
           CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) AS total_items,
           CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_quantity AS INTEGER) AS DECIMAL(18,2)))
             AS DECIMAL(18,2)) AS lifetime_value,
           lower(any_value(c_name)) || '@ex.com' AS last_email,
           CASE WHEN any_value(c_acctbal) < 0 THEN 'elsewhere' ELSE CAST(any_value(c_nationkey) AS VARCHAR) END AS last_city
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN part ON p_partkey = l_partkey GROUP BY o_custkey""")
def full_load_customer_360(spark, sf):
    """Staged text to the mart, with all layers written in between and the checks passed."""
    moved, staged = staged_shop(spark, sf)
    staged["customers"] = staged["customers"].unionByName(moved)
    at = Warehouse(folder(spark), "bigint")
    tables = full_load(staged, at, RUN, dt.date(1995, 1, 1), dt.date(2001, 12, 31), THRESHOLD)
    return tables["mart_customer_360"]


@query("full_load_then_increment", f"""
    WITH s AS (SELECT c_custkey AS customer_bk, lower(c_name) || '@ex.com' AS email, c_nationkey, c_acctbal FROM customer)
    SELECT customer_bk, email, CAST(c_nationkey AS VARCHAR) AS city, DATE '1995-01-01' AS valid_from,
           CASE WHEN c_acctbal < 0 THEN DATE '{MOVED}' END AS valid_to,
           row_number() OVER (ORDER BY customer_bk) AS customer_sk FROM s
    UNION ALL
    SELECT customer_bk, email, 'elsewhere', DATE '{MOVED}', CAST(NULL AS DATE),
           (SELECT count(*) FROM s) + row_number() OVER (ORDER BY customer_bk) FROM s WHERE c_acctbal < 0""")
def full_load_then_increment(spark, sf):
    """Customers move after the first load; the increment runs twice and numbers go on."""
    moved, staged = staged_shop(spark, sf)
    at = Warehouse(folder(spark), "bigint")
    full_load(staged, at, RUN, dt.date(1995, 1, 1), dt.date(2001, 12, 31), THRESHOLD)
    customer_increment(moved, at, RUN)
    dim = customer_increment(moved, at, RUN)["dim_customer"]
    return dim.select("customer_bk", "email", "city", "valid_from", "valid_to", "customer_sk")


# A batch typed in by hand, blanks and all, that gives the steps of the log their names.
STEP_ROWS = [("signup", "start", " 1"), ("view", "look", "2"), ("click", "look", "3 "), ("purchase", "buy", "4"), ("purchase", "buy", "4"), ("error", None, "x")]
STEP_COLUMNS = ("step", "stage", "nth")


@query("literal_batch", f"""
    WITH steps(step, stage, nth) AS (VALUES {", ".join(f"('{a}', {'NULL' if b is None else repr(b)}, '{c}')" for a, b, c in STEP_ROWS)})
    SELECT e.event_type, s.stage, TRY_CAST(trim(s.nth) AS INTEGER) AS nth, 'steps_1' AS load_id, TIMESTAMP '2024-02-06 08:00:00' AS load_ts,
           count(*) AS events
    FROM events e JOIN steps s ON s.step = e.event_type GROUP BY ALL""")
def literal_batch(spark, sf):
    """Rows of the batch are staged as they are, repeats included, and met by all events."""
    steps = stage_rows(spark, STEP_ROWS, STEP_COLUMNS, "steps_1", dt.datetime(2024, 2, 6, 8))
    named = table(spark, sf, "events").join(steps, F.col("event_type") == F.col("step"))
    typed = named.select(
        "event_type", "stage", to_int(F.trim("nth")).alias("nth"), F.col("_load_id").alias("load_id"), F.col("_load_ts").alias("load_ts")
    )
    return typed.groupBy(*typed.columns).agg(F.count("*").alias("events"))

"""Cleaning. The source tables are tidy, so staged text is made from their columns: some keys
get a prefix, some dates lose their zeros, some values go missing."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronostrata.functions import is_email, normalize_phone
from chronostrata.operators.latest import dedupe
from chronostrata.operators.rows import duplicates
from chronostrata.plans import cleaning
from chronostrata.suite.base import query, table

ORDERS_SQL = """
    staged AS (
      SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'ORD-' || o_orderkey
                  ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
             CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN ' '
                  WHEN o_orderstatus = 'F' THEN year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)
                  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
             CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus <> 'P' THEN ''
                  WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN NULL
                  ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
             CAST(o_orderdate AS DATE) AS true_date FROM orders),
    judged AS (
      SELECT *, regexp_full_match(order_id, '[0-9]+') AS ok_order,
             coalesce(regexp_full_match(customer_id, '[0-9]+'), false) AS ok_customer,
             trim(order_date) <> '' AS ok_date FROM staged)"""


def staged_orders(spark, sf):
    o = table(spark, sf, "orders")
    status, priority, d = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    return o.select(
        F.when((priority == "4-NOT SPECIFIED") & (status == "P"), F.concat(F.lit("ORD-"), key))
        .otherwise(key)
        .alias("order_id"),
        F.when((priority == "5-LOW") & (status == "O"), F.lit(" "))
        .when(status == "F", F.concat_ws("-", F.year(d), F.month(d), F.day(d)))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
        .alias("order_date"),
        F.when((priority == "5-LOW") & (status != "P"), F.lit(""))
        .when((priority == "2-HIGH") & (status == "F"), F.lit(None))
        .otherwise(customer)
        .alias("customer_id"),
    )


@query("clean_orders", f"""
    WITH {ORDERS_SQL}
    SELECT CAST(order_id AS BIGINT) AS order_id, true_date AS order_date, CAST(customer_id AS BIGINT) AS customer_id
    FROM judged WHERE ok_order AND ok_customer AND ok_date""")
def clean_orders(spark, sf):
    return cleaning.clean_orders(staged_orders(spark, sf), "bigint")[0]


@query("rejects", f"""
    WITH {ORDERS_SQL}
    SELECT order_id, customer_id, concat_ws(',', CASE WHEN NOT ok_order THEN 'order_id_is_key' END,
             CASE WHEN NOT ok_customer THEN 'customer_id_is_key' END,
             CASE WHEN NOT ok_date THEN 'order_date_is_date' END) AS reject_reason
    FROM judged WHERE NOT (ok_order AND ok_customer AND ok_date)""")
def rejects(spark, sf):
    return cleaning.clean_orders(staged_orders(spark, sf), "bigint")[1].select("order_id", "customer_id", "reject_reason")


@query("clean_items", """
    SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
           CAST(l_quantity AS INTEGER) AS qty, CAST(l_extendedprice AS DECIMAL(10,2)) AS price_at_sale
    FROM lineitem WHERE l_returnflag <> 'R' AND NOT (l_linestatus = 'F' AND l_returnflag = 'N')""")
def clean_items(spark, sf):
    """Returned lines come with a negative quantity, one other group with a comma in the price."""
    item, price = F.col("l_orderkey") * 10 + F.col("l_linenumber"), F.format_string("%.2f", "l_extendedprice")
    qty = F.col("l_quantity").cast("int").cast("string")
    staged = table(spark, sf, "lineitem").select(
        item.cast("string").alias("order_item_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), qty)).otherwise(qty).alias("qty"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N"), F.replace(price, F.lit("."), F.lit(",")))
        .otherwise(price)
        .alias("price_at_sale"),
    )
    return cleaning.clean_items(staged, "bigint")[0]


@query("clean_products", """
    SELECT p_partkey AS product_id, trim(p_name) AS name FROM part WHERE p_type <> 'PROMO'""")
def clean_products(spark, sf):
    """Promotional parts come with a key that is not one."""
    key = F.col("p_partkey").cast("string")
    staged = table(spark, sf, "part").select(
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("P"), key)).otherwise(key).alias("product_id"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("name"),
    )
    return cleaning.clean_products(staged, "bigint")[0]


@query("clean_status_events", """
    SELECT user_id AS customer_id, event_type AS status, ts AS event_ts,
           'batch_' || strftime(ts, '%Y%m%d') AS _load_id, ts AS _load_ts
    FROM events WHERE event_type NOT IN ('error', 'view')""")
def clean_status_events(spark, sf):
    """Errors have a blank status, views no time; every event is staged a second time later on."""
    e, kind = table(spark, sf, "events"), F.col("event_type")
    once = e.select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(kind == "error", F.lit("  ")).otherwise(F.concat(F.lit(" "), kind)).alias("status"),
        F.when(kind != "view", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" "))).alias("event_ts"),
        F.concat(F.lit("batch_"), F.date_format("ts", "yyyyMMdd")).alias("_load_id"),
        F.col("ts").alias("_load_ts"),
    )
    again = once.withColumns({"_load_id": F.lit("replay"), "_load_ts": F.col("_load_ts") + F.expr("INTERVAL 1 DAY")})
    return cleaning.clean_status_events(once.unionByName(again), "bigint")[0]


@query("phone_norm", """
    SELECT c_custkey, CASE c_mktsegment
        WHEN 'BUILDING' THEN '7900' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')
        WHEN 'MACHINERY' THEN '7900' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')
        WHEN 'HOUSEHOLD' THEN '7900' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')
        WHEN 'FURNITURE' THEN CAST(c_custkey AS VARCHAR) END AS phone
    FROM customer""")
def phone_norm(spark, sf):
    number, segment = F.lpad(F.col("c_custkey").cast("string"), 7, "0"), F.col("c_mktsegment")
    written = (
        F.when(segment == "BUILDING", F.concat(F.lit("8 (900) "), number))
        .when(segment == "MACHINERY", F.concat(F.lit("+7-900-"), number))
        .when(segment == "HOUSEHOLD", F.concat(F.lit("900 "), number))
        .when(segment == "FURNITURE", F.concat(F.lit("ext. "), F.col("c_custkey").cast("string")))
        .otherwise(F.lit("none"))
    )
    return table(spark, sf, "customer").select("c_custkey", normalize_phone(written).alias("phone"))


@query("email_valid", """
    SELECT c_custkey, c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AS is_valid FROM customer""")
def email_valid(spark, sf):
    name, segment = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.col("c_mktsegment")
    written = (
        F.when(segment == "BUILDING", F.concat(name, F.lit("@ex.com ")))
        .when(segment == "HOUSEHOLD", F.concat(name, F.lit("+x@mail.ex.org")))
        .when(segment == "MACHINERY", F.concat(name, F.lit("@ex")))
        .when(segment == "FURNITURE", F.concat(name, F.lit(" @ex.com")))
    )
    return table(spark, sf, "customer").select("c_custkey", is_email(written).alias("is_valid"))


@query("dedupe_orders", """
    SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'F' THEN 'load_2' ELSE 'load_1' END AS _load_id FROM orders""")
def dedupe_orders(spark, sf):
    """Finished orders arrive a second time."""
    keys = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), "o_orderstatus")
    first = keys.withColumn("_load_id", F.lit("load_1"))
    second = keys.where("o_orderstatus = 'F'").withColumn("_load_id", F.lit("load_2"))
    return dedupe(first.unionByName(second), "order_id", [F.desc("_load_id")]).select("order_id", "_load_id")


@query("duplicate_lines", """
    SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_lines(spark, sf):
    return duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])

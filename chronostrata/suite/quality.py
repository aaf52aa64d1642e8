"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronostrata.functions import as_date
from chronostrata.operators import quality as q
from chronostrata.operators.constraints import Constraints, as_table, observed, report
from chronostrata.session import cut
from chronostrata.suite.base import DAILY_SQL, ORDERS_AS_OF, query, table
from chronostrata.suite.cleaning import ORDERS_SQL, staged_orders
from chronostrata.suite.history import daily_history


@query("dq_report", """
    WITH l AS (
      SELECT count(*) AS n, count(CASE WHEN NOT (l_quantity > 0) THEN 1 END) AS q,
             count(CASE WHEN NOT (l_extendedprice >= 0) THEN 1 END) AS p, count(CASE WHEN l_orderkey IS NULL THEN 1 END) AS k,
             count(CASE WHEN NOT length(l_returnflag) <= 1 THEN 1 END) AS f FROM lineitem)
    SELECT 'lineitem.not_empty' AS "check", n > 0 AS passed, n AS actual, CAST(1 AS BIGINT) AS expected FROM l
    UNION ALL SELECT 'lineitem.l_quantity_positive', q = 0, q, 0 FROM l
    UNION ALL SELECT 'lineitem.l_extendedprice_not_negative', p = 0, p, 0 FROM l
    UNION ALL SELECT 'lineitem.l_orderkey_filled', k = 0, k, 0 FROM l
    UNION ALL SELECT 'lineitem.l_returnflag_max_1', f = 0, f, 0 FROM l
    UNION ALL SELECT 'lineitem.unique', count(*) = 0, count(*), 0
      FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) x
    UNION ALL SELECT 'orders.same_count', (SELECT count(*) FROM orders) = count(*), (SELECT count(*) FROM orders), count(*)
      FROM customer""")
def dq_report(spark, sf):
    lines = table(spark, sf, "lineitem")
    rules = {
        **q.measure_ranges("l_quantity", "l_extendedprice"),
        **q.not_null("l_orderkey"),
        **q.within_length({"l_returnflag": 1}),
    }
    return q.report([
        q.check_not_empty(lines, "lineitem"),
        q.check_rules(lines, "lineitem", rules),
        q.check_unique(lines, ["l_orderkey", "l_linenumber"], "lineitem"),
        q.check_same_count(table(spark, sf, "orders"), table(spark, sf, "customer"), "orders"),
    ])


@query("dq_history", f"""
    WITH {DAILY_SQL},
    nxt AS (SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS n FROM hist),
    bad AS (SELECT
      (SELECT count(*) FROM (SELECT 1 FROM hist GROUP BY user_id HAVING count_if(valid_to IS NULL) <> 1) x) AS one,
      (SELECT count(*) FROM hist WHERE valid_to <= valid_from) AS ord,
      (SELECT count(*) FROM nxt WHERE n IS NOT NULL AND (valid_to IS NULL OR n < valid_to)) AS lap,
      (SELECT count(*) FROM hist WHERE user_id = 7) AS vers)
    SELECT 'history.one_current' AS "check", one = 0 AS passed, one AS actual, CAST(0 AS BIGINT) AS expected FROM bad
    UNION ALL SELECT 'history.period_order', ord = 0, ord, 0 FROM bad
    UNION ALL SELECT 'history.overlap', lap = 0, lap, 0 FROM bad
    UNION ALL SELECT 'history.min_versions', vers >= 2, vers, 2 FROM bad""")
def dq_history(spark, sf):
    hist = cut(daily_history(spark, sf))
    return q.report([
        q.check_one_current(hist, "user_id", "history"),
        q.check_rules(hist, "history", q.period_order()),
        q.check_overlap(hist, "user_id", "history"),
        q.check_min_versions(hist, "user_id", 7, 2, "history"),
    ])


@query("dq_orphans", """
    SELECT 'orders.orphans' AS "check", count(*) = 0 AS passed, count(*) AS actual, CAST(0 AS BIGINT) AS expected
    FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)""")
def dq_orphans(spark, sf):
    """Customers in debt are missing from the dimension."""
    known = table(spark, sf, "customer").where("c_acctbal >= 0")
    return q.check_orphans(table(spark, sf, "orders"), known, "o_custkey", "c_custkey", "orders")


@query("dq_overlap", """
    WITH spans AS (SELECT l_partkey, CAST(o_orderdate AS DATE) AS valid_from, CAST(l_shipdate AS DATE) AS valid_to
                   FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    nxt AS (SELECT *, lead(valid_from) OVER (PARTITION BY l_partkey ORDER BY valid_from, valid_to) AS n FROM spans)
    SELECT 'spans.overlap' AS "check", count(*) = 0 AS passed, count(*) AS actual, CAST(0 AS BIGINT) AS expected
    FROM nxt WHERE n < valid_to""")
def dq_overlap(spark, sf):
    """Order-to-ship spans of a part do overlap."""
    ordered = table(spark, sf, "orders").select("o_orderkey", as_date(F.col("o_orderdate")).alias("valid_from"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", as_date(F.col("l_shipdate")).alias("valid_to")
    )
    spans = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    return q.check_overlap(spans, "l_partkey", "spans")


@query("dq_freshness", f"""
    SELECT 'orders.fresh' AS "check", count(*) > 0 AS passed, count(*) AS actual, CAST(1 AS BIGINT) AS expected
    FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '{ORDERS_AS_OF}' - 1""")
def dq_freshness(spark, sf):
    return q.check_fresh(table(spark, sf, "orders"), "o_orderdate", ORDERS_AS_OF, "orders")


@query("dq_validity", f"""
    WITH {ORDERS_SQL}
    SELECT 'orders.order_date_is_date' AS "check", count(*) = 0 AS passed, count(*) AS actual, CAST(0 AS BIGINT) AS expected
    FROM judged WHERE NOT ok_date
    UNION ALL SELECT 'orders.customer_id_filled', count(*) = 0, count(*), 0 FROM judged WHERE customer_id IS NULL""")
def dq_validity(spark, sf):
    rules = {**q.parses_as_date("order_date"), **q.not_null("customer_id")}
    return q.check_rules(staged_orders(spark, sf), "orders", rules)


@query("dq_audit", """
    SELECT 'link.record_source_filled' AS "check", count(*) = 0 AS passed, count(*) AS actual, CAST(0 AS BIGINT) AS expected
    FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'link.load_dttm_filled', count(*) = 0, count(*), 0 FROM orders WHERE o_orderdate IS NULL""")
def dq_audit(spark, sf):
    """Orders in progress lack their source."""
    link = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.lit("orders")).alias("record_source"),
        F.col("o_orderdate").alias("load_dttm"),
    )
    return q.check_rules(link, "link", q.audit_filled())


# Lines with one kind of damage each, told by the order's number.
PROMISES = Constraints(
    not_null=("l_partkey", "l_quantity"),
    max_length={"l_returnflag": 1},
    rules={"quantity_positive": "l_quantity > 0", "shipped_after_order": "l_shipdate >= o_orderdate"},
    unique=(("l_orderkey", "l_linenumber"),),
    unique_where={"one_return_a_part": (("l_partkey", "l_suppkey", "l_orderkey"), "l_returnflag = 'R'")},
    foreign={"l_partkey": ("part", "p_partkey"), "l_suppkey": ("supplier", "s_suppkey")},
)
DAMAGED_SQL = """
    lines AS (
      SELECT l_orderkey, l_linenumber,
             CASE WHEN l_orderkey % 97 = 5 THEN NULL WHEN l_orderkey % 103 = 7 THEN l_partkey + 100000000 ELSE l_partkey END AS l_partkey,
             l_suppkey, CASE WHEN l_orderkey % 89 = 3 THEN -l_quantity WHEN l_orderkey % 83 = 2 THEN NULL ELSE l_quantity END AS l_quantity,
             CASE WHEN l_orderkey % 79 = 1 THEN 'RR' ELSE l_returnflag END AS l_returnflag, l_shipdate, o_orderdate
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    damaged AS (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_orderkey % 101 = 11)"""


@query("load_gate_report", f"""
    WITH {DAMAGED_SQL},
    told AS (
      SELECT 1 AS n, 'lines.l_partkey_filled' AS "check", count(*) FILTER (WHERE l_partkey IS NULL) AS actual FROM damaged
      UNION ALL SELECT 2, 'lines.l_quantity_filled', count(*) FILTER (WHERE l_quantity IS NULL) FROM damaged
      UNION ALL SELECT 3, 'lines.l_returnflag_max_1', count(*) FILTER (WHERE length(l_returnflag) > 1) FROM damaged
      UNION ALL SELECT 4, 'lines.quantity_positive', count(*) FILTER (WHERE NOT coalesce(l_quantity > 0, false)) FROM damaged
      UNION ALL SELECT 5, 'lines.shipped_after_order', count(*) FILTER (WHERE NOT coalesce(l_shipdate >= o_orderdate, false)) FROM damaged
      UNION ALL SELECT 6, 'lines.unique_l_orderkey_l_linenumber', count(*) FROM (SELECT 1 FROM damaged GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) x
      UNION ALL SELECT 7, 'lines.one_return_a_part', count(*) FROM (
        SELECT 1 FROM damaged WHERE l_returnflag = 'R' AND l_partkey IS NOT NULL GROUP BY l_partkey, l_suppkey, l_orderkey HAVING count(*) > 1) x
      UNION ALL SELECT 8, 'lines.l_partkey_in_part', count(*) FROM damaged WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
      UNION ALL SELECT 9, 'lines.l_suppkey_in_supplier', count(*) FROM damaged WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier))
    SELECT "check", actual = 0 AS passed, actual, CAST(0 AS BIGINT) AS expected FROM told""")
def load_gate_report(spark, sf):
    """Row rules counted by the write, keys and references by one pass over what was written."""
    dates = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    order, part, quantity = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_quantity")
    lines = table(spark, sf, "lineitem").join(dates, "l_orderkey").select(
        "l_orderkey", "l_linenumber", F.when(order % 97 == 5, None).when(order % 103 == 7, part + 100_000_000).otherwise(part).alias("l_partkey"),
        "l_suppkey", F.when(order % 89 == 3, -quantity).when(order % 83 == 2, None).otherwise(quantity).alias("l_quantity"),
        F.when(order % 79 == 1, "RR").otherwise(F.col("l_returnflag")).alias("l_returnflag"), "l_shipdate", "o_orderdate",
    )
    damaged = lines.unionByName(lines.where(order % 101 == 11))
    counted, told = observed(damaged, PROMISES)
    written = cut(counted)
    parents = {"part": table(spark, sf, "part"), "supplier": table(spark, sf, "supplier")}
    return as_table(spark, report(told, written, "lines", PROMISES, parents))

"""Star schema, calendar and marts over orders, lines, parts and the event log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chronostrata.functions import as_date, version_key
from chronostrata.operators.history import scd2_backfill
from chronostrata.operators.joins import (
    date_bounds,
    expand_days,
    join_as_of,
    join_as_of_long,
    new_or_changed,
    semi,
)
from chronostrata.operators.latest import latest_attrs
from chronostrata.operators.rows import preview, row_count_label, table_counts
from chronostrata.plans import dims, sales
from chronostrata.plans.status import mart_status_daily
from chronostrata.session import cut
from chronostrata.suite.base import (
    CUT,
    DAILY_SQL,
    EVENTS_AS_OF,
    TS_SQL,
    daily_history_sql,
    query,
    table,
)
from chronostrata.suite.history import before_cut, daily_history, snapshot, ts_history

# Median line amounts are near a million here, so the segment border is moved.
THRESHOLD = 1_000_000


def money(c):
    return F.col(c).cast("decimal(18,2)")


def orders(spark, sf):
    """Order headers. The order's priority stands for the customer's tracked attribute."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        as_date(F.col("o_orderdate")).alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("segment"),
        money("o_totalprice").alias("amount"),
    )


def items(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        money("l_extendedprice").alias("price_at_sale"),
    )


def products(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_sk"),
        F.col("p_partkey").alias("product_bk"),
        F.col("p_name").alias("product_name"),
    )


def customers(spark, sf):
    """Customer history: the segment as told by each order, daily periods."""
    log = orders(spark, sf).withColumnRenamed("customer_id", "customer_bk")
    periods = scd2_backfill(log, "customer_bk", ["segment"], "order_date", ["order_id"])
    return periods.withColumn("customer_sk", version_key("customer_bk", "valid_from"))


def order_dates(spark, sf):
    day = as_date(F.col("o_orderdate"))
    return dims.calendar(date_bounds(table(spark, sf, "orders"), day, day))


def fact(spark, sf, dim=None):
    """The dimension is a stored table when facts are loaded."""
    dim = cut(customers(spark, sf)) if dim is None else dim
    return sales.fact_sales(orders(spark, sf), items(spark, sf), products(spark, sf), dim)


CUSTOMER_SQL = f"""
    log AS (SELECT o_custkey AS customer_bk, o_orderpriority AS segment, CAST(o_orderdate AS DATE) AS ts,
                   o_orderkey AS event_id FROM orders),
    {daily_history_sql('log', key='customer_bk', attr='segment')},
    dim AS (SELECT *, md5(concat_ws('||', CAST(customer_bk AS VARCHAR), CAST(valid_from AS VARCHAR))) AS customer_sk
            FROM hist)"""
FACT_SQL = f"""{CUSTOMER_SQL},
    fact AS (
      SELECT c.customer_sk, l.l_partkey AS product_sk,
             CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
             CAST(l.l_quantity AS INTEGER) AS quantity,
             CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_quantity AS INTEGER) AS DECIMAL(18,2)) AS amount,
             CAST(o.o_orderdate AS DATE) AS order_date, o.o_custkey AS customer_bk
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
      JOIN dim c ON c.customer_bk = o.o_custkey AND CAST(o.o_orderdate AS DATE) >= c.valid_from
        AND (c.valid_to IS NULL OR CAST(o.o_orderdate AS DATE) < c.valid_to))"""


@query("dim_date", """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date_actual,
           CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
           CAST(month(d) AS SMALLINT) AS month, CAST(day(d) AS SMALLINT) AS day,
           dayname(d) AS weekday_name, CAST(dayofweek(d) AS SMALLINT) AS weekday_num, day(d) <= 7 AS is_first_week
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders) x""")
def dim_date(spark, sf):
    return order_dates(spark, sf)


@query("dim_product", """
    SELECT row_number() OVER (ORDER BY p_partkey) AS product_sk, p_partkey AS product_bk, trim(p_name) AS product_name
    FROM part""")
def dim_product(spark, sf):
    parts = table(spark, sf, "part")
    return dims.dim_product(parts.select(F.col("p_partkey").alias("product_id"), F.trim("p_name").alias("name")))


@query("fact_sales", f"WITH {FACT_SQL} SELECT customer_sk, product_sk, date_key, quantity, amount FROM fact")
def fact_sales(spark, sf):
    return fact(spark, sf)


@query("mart_daily_sales", f"""
    WITH {FACT_SQL}
    SELECT order_date AS date_actual, p_name AS product_name,
           CASE WHEN amount >= {THRESHOLD} THEN 'Premium' ELSE 'Basic' END AS customer_segment,
           CAST(sum(quantity) AS BIGINT) AS total_qty, CAST(sum(amount) AS DECIMAL(18,2)) AS total_revenue
    FROM fact JOIN part ON p_partkey = product_sk GROUP BY 1, 2, 3""")
def mart_daily_sales(spark, sf):
    return sales.mart_daily_sales(fact(spark, sf), order_dates(spark, sf), products(spark, sf), THRESHOLD)


@query("mart_slice", f"""
    WITH {FACT_SQL}
    SELECT order_date AS date_actual, p_name AS product_name,
           CASE WHEN amount >= {THRESHOLD} THEN 'Premium' ELSE 'Basic' END AS customer_segment,
           CAST(sum(quantity) AS BIGINT) AS total_qty, CAST(sum(amount) AS DECIMAL(18,2)) AS total_revenue
    FROM fact JOIN part ON p_partkey = product_sk
    WHERE order_date BETWEEN DATE '1998-04-01' AND DATE '1998-04-30' GROUP BY 1, 2, 3""")
def mart_slice(spark, sf):
    return sales.mart_slice(mart_daily_sales(spark, sf), "1998-04-01", "1998-04-30")


# Days of orders that are missing on purpose, and two segments of which one does not exist.
LISTED_DAYS = ("1998-04-02", "1998-04-09", "1998-04-23")


@query("mart_slice_listed", f"""
    WITH {FACT_SQL},
    mart AS (
      SELECT order_date AS date_actual, p_name AS product_name,
             CASE WHEN amount >= {THRESHOLD} THEN 'Premium' ELSE 'Basic' END AS customer_segment,
             CAST(sum(quantity) AS BIGINT) AS total_qty, CAST(sum(amount) AS DECIMAL(18,2)) AS total_revenue
      FROM fact JOIN part ON p_partkey = product_sk GROUP BY 1, 2, 3)
    SELECT * FROM mart WHERE date_actual BETWEEN DATE '1998-04-01' AND DATE '1998-04-30'
      AND date_actual IN ({', '.join(f"DATE '{d}'" for d in LISTED_DAYS)}) AND customer_segment IN ('Premium', 'None')""")
def mart_slice_listed(spark, sf):
    days = [dt.date.fromisoformat(d) for d in LISTED_DAYS]
    listed = {"date_actual": days, "customer_segment": ["Premium", "None"]}
    return sales.mart_slice(mart_daily_sales(spark, sf), "1998-04-01", "1998-04-30", listed)


@query("customer_360", f"""
    WITH {FACT_SQL},
    newest AS (SELECT customer_bk, segment FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_bk ORDER BY valid_from DESC) AS rn FROM dim) x WHERE rn = 1)
    SELECT f.customer_bk, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
           count(*) AS total_line_items, CAST(sum(quantity) AS BIGINT) AS total_items,
           CAST(sum(amount) AS DECIMAL(18,2)) AS lifetime_value, any_value(n.segment) AS last_segment
    FROM fact f LEFT JOIN newest n ON n.customer_bk = f.customer_bk GROUP BY f.customer_bk""")
def customer_360(spark, sf):
    dim = cut(customers(spark, sf))
    return sales.mart_customer_360(fact(spark, sf, dim), order_dates(spark, sf), dim, ["segment"])


@query("latest_attrs", f"""
    WITH {CUSTOMER_SQL} SELECT customer_bk, segment FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_bk ORDER BY valid_from DESC) AS rn FROM dim) x WHERE rn = 1""")
def latest_attrs_(spark, sf):
    return latest_attrs(customers(spark, sf), "customer_bk", "valid_from", ["segment"])


@query("favourite_products", """
    WITH bought AS (
      SELECT o_custkey AS customer_bk, l_partkey, count(*) AS times, max(CAST(o_orderdate AS DATE)) AS last_bought
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_bk ORDER BY times DESC, l_partkey) AS rn,
                      max(last_bought) OVER (PARTITION BY customer_bk) AS last_visit FROM bought)
    SELECT customer_bk, l_partkey AS favourite_product, times AS times_bought, last_visit FROM ranked WHERE rn = 1""")
def favourite_products(spark, sf):
    lines = items(spark, sf).select("order_id", "product_id").join(
        orders(spark, sf).select("order_id", "order_date", F.col("customer_id").alias("customer_bk")), "order_id"
    )
    return sales.favourite_products(lines, "customer_bk", "product_id", "order_date")


@query("customer_spend_segment_year", f"""
    WITH {CUSTOMER_SQL}
    SELECT count(*) AS orders_cnt, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DECIMAL(18,2)) AS spent
    FROM orders JOIN dim c ON c.customer_bk = o_custkey AND CAST(o_orderdate AS DATE) >= c.valid_from
      AND (c.valid_to IS NULL OR CAST(o_orderdate AS DATE) < c.valid_to)
    WHERE c.segment = '1-URGENT' AND year(o_orderdate) = 1998""")
def customer_spend_segment_year(spark, sf):
    placed = orders(spark, sf).drop("segment").withColumnRenamed("customer_id", "customer_bk")
    return sales.spend_by_attribute(placed, cut(customers(spark, sf)), "segment", "1-URGENT", 1998)


def city_customers(spark, sf):
    """The nation stands for the city."""
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_sk"), "c_nationkey")
    return people.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("customer_sk", "city")


def order_fact(spark, sf):
    return orders(spark, sf).select(
        F.col("customer_id").alias("customer_sk"), F.date_format("order_date", "yyyyMMdd").cast("int").alias("date_key"),
        "amount",
    )


CITY_SQL = """
    SELECT n_name AS city, CAST(year(o_orderdate) AS SMALLINT) AS year, CAST(month(o_orderdate) AS SMALLINT) AS month,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3"""


@query("city_month_revenue_star", CITY_SQL)
def city_month_revenue_star(spark, sf):
    return sales.revenue_star(order_fact(spark, sf), city_customers(spark, sf), order_dates(spark, sf))


@query("city_month_revenue_normalised", CITY_SQL)
def city_month_revenue_normalised(spark, sf):
    lookup, slim = dims.normalise_attribute(city_customers(spark, sf), "city", "city_id")
    return sales.revenue_normalised(order_fact(spark, sf), slim, lookup, order_dates(spark, sf), "city", "city_id")


@query("normalise_city", """
    SELECT c_custkey AS customer_sk, city_id FROM customer JOIN nation ON n_nationkey = c_nationkey
    JOIN (SELECT n_name AS city, row_number() OVER (ORDER BY n_name) AS city_id FROM (
            SELECT DISTINCT n_name FROM nation JOIN customer ON c_nationkey = n_nationkey) y) x ON city = n_name""")
def normalise_city(spark, sf):
    return dims.normalise_attribute(city_customers(spark, sf), "city", "city_id")[1].select("customer_sk", "city_id")


def moments(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", "user_id", "ts", F.col("value").cast("decimal(18,2)").alias("amount"))


PIT_SQL = f"""
    WITH {TS_SQL}
    SELECT e.event_id, e.user_id, e.ts, CAST(e.value AS DECIMAL(18,2)) AS amount, x.status, x.valid_from
    FROM events e JOIN hist x ON x.user_id = e.user_id AND e.ts >= x.valid_from
      AND (x.valid_to IS NULL OR e.ts < x.valid_to)"""


def _picked(joined):
    return joined.select("event_id", "user_id", "ts", "amount", "status", "valid_from")


@query("pit_join_facts", PIT_SQL)
def pit_join_facts(spark, sf):
    return _picked(join_as_of(moments(spark, sf), cut(ts_history(spark, sf)), "user_id", "ts"))


@query("pit_join_long_history", PIT_SQL)
def pit_join_long_history(spark, sf):
    return _picked(join_as_of_long(moments(spark, sf), cut(ts_history(spark, sf)), "user_id", "ts"))


@query("pit_join_short_history", PIT_SQL)
def pit_join_short_history(spark, sf):
    """The form for short histories, whatever their length here."""
    return _picked(join_as_of(moments(spark, sf), cut(ts_history(spark, sf)), "user_id", "ts", max_versions=10**9))


@query("pit_join_tied_events", """
    WITH days AS (
      SELECT user_id, event_type AS status, date_trunc('day', ts) AS day_at, event_id,
             row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY event_id DESC) AS rn FROM events),
    told AS (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY day_at) AS prior FROM days WHERE rn = 1),
    hist AS (SELECT user_id, status, CAST(day_at AS TIMESTAMP) AS valid_from,
                    CAST(lead(day_at) OVER (PARTITION BY user_id ORDER BY day_at) AS TIMESTAMP) AS valid_to
             FROM told WHERE prior IS DISTINCT FROM status)
    SELECT e.event_id, e.user_id, e.ts, CAST(e.value AS DECIMAL(18,2)) AS amount, x.status, x.valid_from
    FROM events e JOIN hist x ON x.user_id = e.user_id AND e.ts >= x.valid_from AND (x.valid_to IS NULL OR e.ts < x.valid_to)""")
def pit_join_tied_events(spark, sf):
    """All events of a day share one time, so most of them tie."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    log = table(spark, sf, "events").select("user_id", F.col("event_type").alias("status"), day.alias("ts"), "event_id")
    history = scd2_backfill(log, "user_id", ["status"], "ts", ["event_id"], grain="ts")
    return _picked(join_as_of(moments(spark, sf), cut(history), "user_id", "ts"))


PRICE_SQL = """
    base AS (
      SELECT p_partkey AS product_id, CAST(p_retailprice AS DECIMAL(18,2)) AS list_price, first_day,
             first_day + CAST(p_size * 20 AS INTEGER) AS raised_on
      FROM part, (SELECT min(CAST(o_orderdate AS DATE)) AS first_day FROM orders) d),
    prices AS (
      SELECT product_id, first_day AS valid_from, raised_on - 1 AS valid_to, list_price AS price FROM base
      UNION ALL
      SELECT product_id, raised_on, CAST(NULL AS DATE), CAST(list_price * 2 AS DECIMAL(18,2)) FROM base),
    priced AS (
      SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS order_date, price,
             CASE WHEN l_linestatus = 'F' THEN CAST(p_retailprice AS DECIMAL(18,2))
                  ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 2 AS DECIMAL(18,2)) END AS price_at_sale
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
      JOIN prices x ON x.product_id = l_partkey AND CAST(o_orderdate AS DATE) >= x.valid_from
        AND (x.valid_to IS NULL OR CAST(o_orderdate AS DATE) <= x.valid_to))"""


def prices(spark, sf):
    """A price list made from parts: the price doubles after a while that depends on the part.
    Periods are closed at both ends."""
    first = table(spark, sf, "orders").agg(F.min(as_date(F.col("o_orderdate")))).scalar()
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        first.alias("first_day"),
        money("p_retailprice").alias("price"),
        F.date_add(first, F.col("p_size") * 20).alias("raised_on"),
    )
    old = F.struct(
        F.col("first_day").alias("valid_from"), F.date_sub("raised_on", 1).alias("valid_to"), F.col("price").alias("price")
    )
    new = F.struct(
        F.col("raised_on").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        (F.col("price") * 2).cast("decimal(18,2)").alias("price"),
    )
    return parts.select("product_id", F.explode(F.array(old, new)).alias("p")).select("product_id", "p.*")


def dated_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), "l_linenumber", F.col("l_partkey").alias("product_id"), "l_linestatus"
    )
    return lines.join(orders(spark, sf).select("order_id", "order_date"), "order_id")


@query("price_as_of", f"""
    WITH {PRICE_SQL} SELECT l_orderkey AS order_id, l_linenumber, l_partkey AS product_id, order_date, price FROM priced""")
def price_as_of(spark, sf):
    joined = join_as_of(dated_lines(spark, sf), prices(spark, sf), "product_id", "order_date", closed=True)
    return joined.select("order_id", "l_linenumber", "product_id", "order_date", "price")


@query("price_as_of_touching", f"""
    WITH {PRICE_SQL} SELECT l_orderkey AS order_id, l_linenumber, l_partkey AS product_id, order_date, price FROM priced""")
def price_as_of_touching(spark, sf):
    """Periods that share their border day: the later price holds on it, as where they do not touch."""
    touching = prices(spark, sf).withColumn("valid_to", F.date_add("valid_to", 1))
    joined = join_as_of(dated_lines(spark, sf), touching, "product_id", "order_date", closed=True)
    return joined.select("order_id", "l_linenumber", "product_id", "order_date", "price")


@query("price_differences", f"""
    WITH {PRICE_SQL} SELECT l_partkey AS product_id, count(*) AS lines_cnt FROM priced
    WHERE price <> price_at_sale GROUP BY l_partkey""")
def price_differences(spark, sf):
    """Lines of status F were sold at the part's first price, the others at its second."""
    first = money("p_retailprice")
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), first.alias("first"), (first * 2).cast("decimal(18,2)").alias("second")
    )
    paid = F.when(F.col("l_linestatus") == "F", F.col("first")).otherwise(F.col("second"))
    sold = dated_lines(spark, sf).join(parts, "product_id").withColumn("price_at_sale", paid)
    different = sales.price_differences(sold, prices(spark, sf))
    return different.groupBy("product_id").agg(F.count("*").alias("lines_cnt"))


@query("range_join_calendar", f"""
    WITH {DAILY_SQL}
    SELECT x.user_id, x.status, CAST(d AS DATE) AS date_actual FROM hist x
    JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '{EVENTS_AS_OF}', INTERVAL 1 DAY)) AS d) c
      ON CAST(d AS DATE) >= x.valid_from AND (x.valid_to IS NULL OR CAST(d AS DATE) < x.valid_to)""")
def range_join_calendar(spark, sf):
    days = expand_days(daily_history(spark, sf), "2024-01-01", EVENTS_AS_OF)
    return days.select("user_id", "status", "date_actual")


STATUS_DAILY_SQL = f"""
    WITH {DAILY_SQL}
    SELECT CAST(d AS DATE) AS date_actual, x.status, count(DISTINCT x.user_id) AS customers_cnt FROM hist x
    JOIN (SELECT unnest(generate_series(TIMESTAMP '2023-01-01', TIMESTAMP '2027-12-31', INTERVAL 1 DAY)) AS d) c
      ON CAST(d AS DATE) >= x.valid_from AND (x.valid_to IS NULL OR CAST(d AS DATE) < x.valid_to)
    WHERE CAST(d AS DATE) BETWEEN (SELECT min(valid_from) FROM hist)
      AND (SELECT max(coalesce(valid_to, DATE '{EVENTS_AS_OF}')) FROM hist)
    GROUP BY 1, 2"""


@query("mart_status_daily", STATUS_DAILY_SQL)
def mart_status_daily_(spark, sf):
    return mart_status_daily(daily_history(spark, sf), dims.dim_date(spark), EVENTS_AS_OF)


@query("status_on_date", f"""
    WITH {DAILY_SQL} SELECT status, count(*) AS customers_cnt FROM hist
    WHERE DATE '{CUT}' >= valid_from AND (valid_to IS NULL OR DATE '{CUT}' < valid_to) GROUP BY status""")
def status_on_date(spark, sf):
    held = dims.status_at(daily_history(spark, sf), CUT, "user_id", ["status"])
    return held.groupBy("status").agg(F.count("*").alias("customers_cnt"))


@query("new_or_changed", f"""
    WITH log AS (SELECT user_id, event_type AS status, ts, event_id FROM events WHERE ts < TIMESTAMP '{CUT}'),
    {daily_history_sql('log')},
    cur AS (SELECT * FROM hist WHERE valid_to IS NULL)
    SELECT s.user_id, s.status FROM (SELECT user_id, arg_max(event_type, ts) AS status FROM events GROUP BY user_id) s
    LEFT JOIN cur c ON c.user_id = s.user_id
    WHERE c.user_id IS NULL OR c.hashdiff <> md5(lower(trim(s.status)))""")
def new_or_changed_(spark, sf):
    current = before_cut(spark, sf).where("valid_to IS NULL")
    state = snapshot(spark, sf).withColumn("hashdiff", F.md5(F.lower("status")))
    return new_or_changed(state, current, "user_id").select("user_id", "status")


@query("customers_with_orders", """
    SELECT c_custkey, c_name FROM customer WHERE EXISTS (
      SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def customers_with_orders(spark, sf):
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey")
    return semi(table(spark, sf, "customer"), done, ["c_custkey"]).select("c_custkey", "c_name")


@query("table_counts", """
    SELECT 'orders' AS table_name, count(*) AS row_cnt, count(DISTINCT o_orderkey) AS key_cnt FROM orders
    UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey) FROM lineitem
    UNION ALL SELECT 'customer', count(*), count(DISTINCT c_custkey) FROM customer""")
def table_counts_(spark, sf):
    named = {"orders": "o_orderkey", "lineitem": "l_orderkey", "customer": "c_custkey"}
    return table_counts({name: (table(spark, sf, name), key) for name, key in named.items()})


@query("row_count_label", "SELECT 'lineitem count = ' || count(*) AS label FROM lineitem")
def row_count_label_(spark, sf):
    return row_count_label(table(spark, sf, "lineitem"), "lineitem")


@query("history_bounds", f"""
    WITH {DAILY_SQL} SELECT min(valid_from) AS date_from, max(coalesce(valid_to, DATE '{EVENTS_AS_OF}')) AS date_to
    FROM hist""")
def history_bounds(spark, sf):
    end = F.coalesce(F.col("valid_to"), as_date(EVENTS_AS_OF))
    return date_bounds(daily_history(spark, sf), F.col("valid_from"), end)


@query("preview_orders", """
    SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def preview_orders(spark, sf):
    top = preview(table(spark, sf, "orders"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)
    return top.select("o_orderkey", "o_custkey", money("o_totalprice").alias("total"))


@query("revenue_total", """
    SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue FROM orders
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE n_name = 'NATION_7' AND year(o_orderdate) = 1998 AND month(o_orderdate) = 1""")
def revenue_total(spark, sf):
    """One city, one month: the question both models answer."""
    held = city_customers(spark, sf).where("city = 'NATION_7'")
    days = order_dates(spark, sf).where("year = 1998 AND month = 1")
    wide = order_fact(spark, sf).join(held, "customer_sk").join(days, "date_key")
    return wide.agg(F.sum("amount").cast("decimal(18,2)").alias("revenue"))

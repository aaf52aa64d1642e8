"""Hubs, links, satellites, point-in-time and bridge tables, business rules, anchor model."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronostrata.fixed_values import ORDER_STATUS_CHAIN
from chronostrata.functions import as_date, conform_key, hash_key
from chronostrata.operators import anchor as a
from chronostrata.operators import vault as v
from chronostrata.operators.latest import last_of_day, latest_by_key
from chronostrata.operators.overlay import overlay
from chronostrata.session import cut
from chronostrata.suite.base import CUT, ORDERS_AS_OF, query, status_log, table

VIP_FROM = 3_000_000


def order_source(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_bk"),
        F.col("o_custkey").alias("customer_bk"),
        F.col("o_orderpriority").alias("segment"),
        F.lit("orders").alias("record_source"),
        F.col("o_orderdate").alias("load_dttm"),
    )


def in_two_loads(load, src, *args, at="1998-01-01"):
    """Rows of a first load and of a second one that sees everything again."""
    first = load(None, src.where(F.col("load_dttm") < F.lit(at).cast("timestamp_ntz")), *args)
    return first.unionByName(load(first, src, *args))


@query("hub_customer", """
    SELECT md5(CAST(o_custkey AS VARCHAR)) AS hk_customer, o_custkey AS customer_bk, 'orders' AS record_source,
           min(o_orderdate) AS load_dttm FROM orders GROUP BY o_custkey""")
def hub_customer(spark, sf):
    return in_two_loads(v.hub_load, order_source(spark, sf), "customer_bk", "hk_customer")


@query("multi_source_hub", """
    SELECT md5(CAST(k AS VARCHAR)) AS hk_customer, k AS customer_bk,
           CASE WHEN min(t) < TIMESTAMP '1997-01-01' THEN 'orders' ELSE 'crm' END AS record_source,
           least(min(t), TIMESTAMP '1997-01-01') AS load_dttm
    FROM (SELECT c_custkey AS k, CAST(NULL AS TIMESTAMP) AS t FROM customer
          UNION ALL SELECT o_custkey, o_orderdate FROM orders) x GROUP BY k""")
def multi_source_hub(spark, sf):
    crm = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_bk"),
        F.lit("crm").alias("record_source"),
        F.lit("1997-01-01").cast("timestamp_ntz").alias("load_dttm"),
    )
    shop = order_source(spark, sf).select("customer_bk", "record_source", "load_dttm")
    return v.hub_load(None, crm.unionByName(shop), "customer_bk", "hk_customer")


@query("link_order_customer", """
    SELECT md5(concat_ws('||', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR))) AS hk_order_customer,
           md5(CAST(o_orderkey AS VARCHAR)) AS hk_order, md5(CAST(o_custkey AS VARCHAR)) AS hk_customer,
           'orders' AS record_source, min(o_orderdate) AS load_dttm FROM orders GROUP BY o_orderkey, o_custkey""")
def link_order_customer(spark, sf):
    parts = {"hk_order": "order_bk", "hk_customer": "customer_bk"}
    return in_two_loads(v.link_load, order_source(spark, sf), "hk_order_customer", parts)


SAT_SQL = """
    told AS (
      SELECT md5(CAST(user_id AS VARCHAR)) AS hk_user, md5(lower(trim(event_type))) AS hashdiff, event_type AS status,
             ts AS load_dttm, event_id,
             lag(md5(lower(trim(event_type)))) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prior_hash
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn FROM events) e WHERE rn = 1),
    sat AS (SELECT hk_user, hashdiff, status, 'events' AS record_source, load_dttm FROM told
            WHERE prior_hash IS DISTINCT FROM hashdiff)"""


def user_source(spark, sf):
    events = table(spark, sf, "events")
    return events.select(
        hash_key("user_id").alias("hk_user"),
        "user_id",
        F.col("event_type").alias("status"),
        F.when(F.col("value") >= 50, F.lit("high")).otherwise(F.lit("low")).alias("band"),
        F.lit("events").alias("record_source"),
        F.col("ts").alias("load_dttm"),
        "event_id",
    )


def user_sat(spark, sf, *attrs):
    return v.sat_load(None, user_source(spark, sf), "hk_user", list(attrs), ["event_id"])


@query("sat_user", f"WITH {SAT_SQL} SELECT * FROM sat")
def sat_user(spark, sf):
    """Two loads that follow each other."""
    src, at = user_source(spark, sf), F.lit(CUT).cast("timestamp_ntz")
    first = cut(v.sat_load(None, src.where(F.col("load_dttm") < at), "hk_user", ["status"], ["event_id"]))
    second = v.sat_load(first, src.where(F.col("load_dttm") >= at), "hk_user", ["status"], ["event_id"])
    return first.unionByName(second)


@query("sat_late", f"""
    WITH src AS (
      SELECT *, ts < TIMESTAMP '{CUT}' AS late, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn FROM events),
    told AS (
      SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prior FROM src WHERE NOT late AND rn = 1),
    newest AS (SELECT user_id FROM told WHERE prior IS DISTINCT FROM event_type GROUP BY user_id)
    SELECT md5(CAST(user_id AS VARCHAR)) AS hk_user, event_id, event_type AS status, ts AS load_dttm
    FROM src WHERE late AND user_id IN (SELECT user_id FROM newest)""")
def sat_late(spark, sf):
    """The later half is loaded first: the earlier half comes back as late, and is not lost."""
    src, at = user_source(spark, sf), F.lit(CUT).cast("timestamp_ntz")
    stored = cut(v.sat_load(None, src.where(F.col("load_dttm") >= at), "hk_user", ["status"], ["event_id"]))
    late = v.sat_late(stored, src.where(F.col("load_dttm") < at), "hk_user", ["status"])
    return late.select("hk_user", "event_id", "status", "load_dttm")


@query("link_rejects", """
    SELECT o_orderkey AS order_bk FROM orders WHERE o_orderpriority = '1-URGENT'""")
def link_rejects(spark, sf):
    """Orders whose customer is blanked out make no link."""
    blank = F.when(F.col("segment") != "1-URGENT", F.col("customer_bk"))
    src = order_source(spark, sf).withColumn("customer_bk", blank)
    return v.link_rejects(src, {"hk_order": "order_bk", "hk_customer": "customer_bk"}).select("order_bk")


@query("effectivity_sat", f"""
    WITH {SAT_SQL} SELECT hk_user, status, load_dttm AS valid_from,
      lead(load_dttm) OVER (PARTITION BY hk_user ORDER BY load_dttm) AS valid_to FROM sat""")
def effectivity_sat(spark, sf):
    periods = v.effectivity(user_sat(spark, sf, "status"), "hk_user")
    return periods.select("hk_user", "status", "valid_from", "valid_to")


@query("multi_active_sat", """
    WITH members AS (
      SELECT DISTINCT o_custkey, date_trunc('year', o_orderdate) AS load_dttm, o_orderpriority AS segment FROM orders),
    sets AS (SELECT o_custkey, load_dttm, string_agg(segment, ',' ORDER BY segment) AS members FROM members GROUP BY 1, 2),
    told AS (SELECT *, lag(members) OVER (PARTITION BY o_custkey ORDER BY load_dttm) AS before_it FROM sets)
    SELECT md5(CAST(m.o_custkey AS VARCHAR)) AS hk_customer, m.segment, 'orders' AS record_source,
           CAST(m.load_dttm AS TIMESTAMP) AS load_dttm
    FROM members m JOIN told t ON t.o_custkey = m.o_custkey AND t.load_dttm = m.load_dttm
    WHERE t.members IS DISTINCT FROM t.before_it""")
def multi_active_sat(spark, sf):
    """The priorities a customer used in a year are values valid at once; two loads."""
    yearly = order_source(spark, sf).withColumn("load_dttm", F.date_trunc("year", "load_dttm").cast("timestamp_ntz"))
    src = yearly.withColumn("hk_customer", hash_key("customer_bk"))
    at = F.lit("1998-01-01").cast("timestamp_ntz")
    first = cut(v.multi_active_load(None, src.where(F.col("load_dttm") < at), "hk_customer", ["segment"]))
    second = v.multi_active_load(first, src.where(F.col("load_dttm") >= at), "hk_customer", ["segment"])
    return first.unionByName(second)


@query("txn_sat", """
    SELECT md5(CAST(user_id AS VARCHAR)) AS hk_user, event_type AS status, ts AS event_ts, ts AS load_dttm FROM events""")
def txn_sat(spark, sf):
    """The second load repeats the first, with later load times."""
    src = user_source(spark, sf).select("hk_user", "status", F.col("load_dttm").alias("event_ts"), "load_dttm")
    early = src.where(F.col("event_ts") < F.lit(CUT).cast("timestamp_ntz"))
    first = cut(v.txn_sat_load(None, early, ["hk_user", "event_ts"]))
    again = first.withColumn("load_dttm", F.col("load_dttm") + F.expr("INTERVAL 30 DAY"))
    return first.unionByName(v.txn_sat_load(first, src.unionByName(again), ["hk_user", "event_ts"]))


PIT_SQL = """
    told AS (
      SELECT user_id, event_type AS status, CASE WHEN value >= 50 THEN 'high' ELSE 'low' END AS band, ts,
             lag(event_type) OVER w AS s0, lag(CASE WHEN value >= 50 THEN 'high' ELSE 'low' END) OVER w AS b0
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    days AS (
      SELECT user_id, CAST(d AS DATE) AS as_of_date FROM (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id) h,
        (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS d) c
      WHERE CAST(d AS DATE) >= CAST(t0 AS DATE)),
    info AS (SELECT user_id, ts, status FROM told WHERE s0 IS DISTINCT FROM status),
    bands AS (SELECT user_id, ts, band FROM told WHERE b0 IS DISTINCT FROM band),
    pit AS (
      SELECT d.user_id, d.as_of_date,
        (SELECT max(i.ts) FROM info i WHERE i.user_id = d.user_id AND CAST(i.ts AS DATE) <= d.as_of_date) AS info_load_dttm,
        (SELECT max(b.ts) FROM bands b WHERE b.user_id = d.user_id AND CAST(b.ts AS DATE) <= d.as_of_date) AS band_load_dttm
      FROM days d)"""


def user_hub(spark, sf):
    return v.hub_load(None, user_source(spark, sf), "user_id", "hk_user")


def user_pit(spark, sf):
    sats = {"info": user_sat(spark, sf, "status"), "band": user_sat(spark, sf, "band")}
    return v.pit_daily(user_hub(spark, sf), sats, "hk_user", "2024-01-01", "2024-01-31"), sats


@query("pit_daily", f"""
    WITH {PIT_SQL} SELECT md5(CAST(user_id AS VARCHAR)) AS hk_user, as_of_date, info_load_dttm, band_load_dttm FROM pit""")
def pit_daily(spark, sf):
    return user_pit(spark, sf)[0]


@query("pit_read", f"""
    WITH {PIT_SQL}
    SELECT e.event_id, i.status, b.band FROM events e
    JOIN pit p ON p.user_id = e.user_id AND p.as_of_date = CAST(e.ts AS DATE)
    JOIN info i ON i.user_id = p.user_id AND i.ts = p.info_load_dttm
    JOIN bands b ON b.user_id = p.user_id AND b.ts = p.band_load_dttm""")
def pit_read(spark, sf):
    pit, sats = user_pit(spark, sf)
    facts = user_source(spark, sf).select(
        "hk_user", "event_id", as_date(F.col("load_dttm")).alias("sale_date")
    )
    wanted = {"info": (sats["info"], ["status"]), "band": (sats["band"], ["band"])}
    return v.read_pit(facts, pit, wanted, "hk_user", "sale_date").select("event_id", "status", "band")


def hub_keys(spark, sf, name, key, hk):
    return table(spark, sf, name).select(hash_key(key).alias(hk))


@query("bridge_build", """
    SELECT DISTINCT md5(CAST(o_custkey AS VARCHAR)) AS hk_customer, md5(CAST(l_partkey AS VARCHAR)) AS hk_part
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey""")
def bridge_build(spark, sf):
    """Customer to order to part. Links are distinct before the hop, as link tables are."""
    placed = table(spark, sf, "orders").select(hash_key("o_custkey").alias("hk_customer"), hash_key("o_orderkey").alias("hk_order"))
    holds = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct()
    holds = holds.select(hash_key("l_orderkey").alias("hk_order"), hash_key("l_partkey").alias("hk_part"))
    return v.bridge(
        hub_keys(spark, sf, "customer", "c_custkey", "hk_customer"),
        [(placed, "hk_customer", "hk_order"), (holds, "hk_order", "hk_part")],
        hub_keys(spark, sf, "part", "p_partkey", "hk_part"),
    )


@query("bridge_spend_30d", f"""
    SELECT o_custkey AS customer_bk, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount
    FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '{ORDERS_AS_OF}' - 30 GROUP BY o_custkey""")
def bridge_spend_30d(spark, sf):
    src = table(spark, sf, "orders")
    trx = src.select(
        hash_key("o_orderkey").alias("hk_trx"),
        as_date(F.col("o_orderdate")).alias("trx_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    placed = src.select(hash_key("o_custkey").alias("hk_customer"), hash_key("o_orderkey").alias("hk_trx"))
    hub = v.hub_load(None, order_source(spark, sf), "customer_bk", "hk_customer")
    pairs = v.bridge(hub.select("hk_customer"), [(placed, "hk_customer", "hk_trx")], trx.select("hk_trx"))
    return v.bridge_spend(hub, pairs, trx, "hk_customer", "hk_trx", "customer_bk", ORDERS_AS_OF)


@query("active_90d", f"""
    SELECT o_custkey AS customer_bk, max(CAST(o_orderdate AS DATE)) >= DATE '{ORDERS_AS_OF}' - 90 AS is_active_90d
    FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '{ORDERS_AS_OF}' GROUP BY o_custkey""")
def active_90d(spark, sf):
    return v.active_flag(order_source(spark, sf), "customer_bk", "load_dttm", ORDERS_AS_OF)


@query("order_status_collapsed", """
    WITH chain AS (
      SELECT o_orderkey AS order_bk, 'created' AS status, 1 AS rk, o_orderdate AS t FROM orders
      UNION ALL
      SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'cancelled' WHEN l_linestatus = 'F' THEN 'delivered' ELSE 'shipped' END,
             CASE WHEN l_returnflag = 'R' THEN 5 WHEN l_linestatus = 'F' THEN 4 ELSE 3 END, l_shipdate FROM lineitem)
    SELECT order_bk, status AS final_status FROM (
      SELECT *, row_number() OVER (PARTITION BY order_bk ORDER BY t DESC, rk DESC) AS rn FROM chain) x WHERE rn = 1""")
def order_status_collapsed(spark, sf):
    created = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_bk"), F.lit("created").alias("status"), F.col("o_orderdate").alias("t")
    )
    went = (
        F.when(F.col("l_returnflag") == "R", "cancelled").when(F.col("l_linestatus") == "F", "delivered").otherwise("shipped")
    )
    moved = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_bk"), went.alias("status"), F.col("l_shipdate").alias("t")
    )
    return v.final_status(created.unionByName(moved), "order_bk", "status", "t", ORDER_STATUS_CHAIN)


@query("source_priority", """
    WITH shop AS (SELECT o_custkey AS k, max(o_orderpriority) AS segment FROM orders GROUP BY o_custkey)
    SELECT c_custkey AS customer_bk, coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, s.segment) AS segment,
           c_name AS name FROM customer LEFT JOIN shop s ON s.k = c_custkey""")
def source_priority(spark, sf):
    """The segment of customers in debt is unknown to the first source."""
    crm = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_bk"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"),
        F.col("c_name").alias("name"),
    )
    shop = order_source(spark, sf).groupBy("customer_bk").agg(F.max("segment").alias("segment"))
    return v.pick_by_priority([crm, shop.withColumn("name", F.lit(None).cast("string"))], "customer_bk", ["segment", "name"])


def flags(spark, sf):
    src = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_bk"), "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("spent")
    )
    return v.customer_flags(src, "customer_bk", "o_orderdate", "spent", ORDERS_AS_OF, VIP_FROM)


FLAGS_SQL = f"""
    flags AS (
      SELECT o_custkey AS customer_bk, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS lifetime_value,
             sum(CAST(o_totalprice AS DECIMAL(18,2))) >= {VIP_FROM} AS is_vip,
             coalesce(bool_or(CAST(o_orderdate AS DATE) BETWEEN DATE '{ORDERS_AS_OF}' - 90 AND DATE '{ORDERS_AS_OF}'), false)
               AS is_active_90d FROM orders GROUP BY o_custkey)"""


@query("vip_flags", f"WITH {FLAGS_SQL} SELECT * FROM flags")
def vip_flags(spark, sf):
    return flags(spark, sf)


@query("flat_customer", f"""
    WITH {FLAGS_SQL},
    newest AS (SELECT o_custkey, o_orderpriority FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) x
      WHERE rn = 1)
    SELECT md5(CAST(f.customer_bk AS VARCHAR)) AS hk_customer, f.customer_bk, n.o_orderpriority AS segment_current,
           f.lifetime_value, f.is_vip, f.is_active_90d FROM flags f JOIN newest n ON n.o_custkey = f.customer_bk""")
def flat_customer(spark, sf):
    """Orders carry a day only, so the last order of a day tells the segment of that day."""
    src = order_source(spark, sf).withColumn("hk_customer", hash_key("customer_bk"))
    daily = last_of_day(src, "hk_customer", "load_dttm", ["order_bk"]).drop("_day")
    sat = v.sat_load(None, daily, "hk_customer", ["segment"])
    hub = v.hub_load(None, order_source(spark, sf), "customer_bk", "hk_customer")
    return v.flat_customer(hub, {"segment": (sat, ["segment"])}, flags(spark, sf), "hk_customer", "customer_bk")


@query("conform_keys", """
    SELECT c_custkey AS customer_bk, 'crm' AS record_source, c_name AS name FROM customer
    UNION ALL SELECT c_custkey, 'shop', upper(c_mktsegment) FROM customer WHERE c_acctbal >= 0""")
def conform_keys(spark, sf):
    """One system writes the key as a number, the other as CUST-000101."""
    c = table(spark, sf, "customer")
    crm = c.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    shop = c.where("c_acctbal >= 0").select(
        F.concat(F.lit("CUST-"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")).alias("id"),
        F.upper("c_mktsegment").alias("name"),
    )
    rule = conform_key("id", kind="bigint")
    return v.conform_sources({"crm": (crm, rule), "shop": (shop, rule)}, "customer_bk", ["name"])


def split(spark, sf):
    src = user_source(spark, sf)
    return a.anchor_split(src, "user_id", ["status", "band"], "load_dttm", ["event_id"])


@query("anchor_attributes", """
    WITH told AS (
      SELECT user_id, ts, event_type AS status, CASE WHEN value >= 50 THEN 'high' ELSE 'low' END AS band,
             lag(event_type) OVER w AS s0, lag(CASE WHEN value >= 50 THEN 'high' ELSE 'low' END) OVER w AS b0
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT 'status' AS attribute, user_id, status AS value, ts AS valid_from FROM told WHERE s0 IS DISTINCT FROM status
    UNION ALL SELECT 'band', user_id, band, ts FROM told WHERE b0 IS DISTINCT FROM band""")
def anchor_attributes(spark, sf):
    tables = [
        df.select(F.lit(name).alias("attribute"), "user_id", F.col(name).alias("value"), "valid_from")
        for name, df in split(spark, sf).items()
    ]
    return tables[0].unionByName(tables[1])


@query("anchor_ties", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def anchor_ties(spark, sf):
    return a.tie(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query("anchor_rebuild", f"""
    SELECT u.user_id, arg_max(e.event_type, e.ts) AS status,
           arg_max(CASE WHEN e.value >= 50 THEN 'high' ELSE 'low' END, e.ts) AS band
    FROM (SELECT DISTINCT user_id FROM events) u
    LEFT JOIN events e ON e.user_id = u.user_id AND e.ts <= TIMESTAMP '{CUT}' GROUP BY u.user_id""")
def anchor_rebuild(spark, sf):
    keys = a.anchor(status_log(spark, sf), "user_id")
    return a.anchor_as_of(keys, split(spark, sf), "user_id", F.lit(CUT).cast("timestamp_ntz"))


# Customers are known to three systems, each with a satellite of its own under one hub. The best source comes first.
SOURCE_VALIDITY = {"app": 3, "shop": 400, "crm": None}
SOURCE_ROWS_SQL = """
    rows_of AS (
      SELECT 'crm' AS src, c_custkey AS bk, c_mktsegment AS class, CAST(CASE WHEN c_acctbal >= 0 THEN 'credit' END AS VARCHAR) AS standing,
             TIMESTAMP '1990-01-01' AS tm, 0 AS nth FROM customer
      UNION ALL SELECT 'shop', o_custkey, o_orderpriority, o_orderstatus, o_orderdate, o_orderkey FROM orders
      UNION ALL SELECT 'app', user_id, event_type, CAST(NULL AS VARCHAR), ts, event_id FROM events),
    once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src, bk, tm ORDER BY nth DESC) AS rn FROM rows_of) x WHERE rn = 1),
    hashed AS (SELECT *, md5(concat_ws('||', lower(trim(coalesce(class, ''))), lower(trim(coalesce(standing, ''))))) AS hashdiff FROM once),
    told AS (SELECT *, lag(hashdiff) OVER (PARTITION BY src, bk ORDER BY tm) AS prior FROM hashed),
    sats AS (SELECT src, bk, hashdiff, class, standing, tm FROM told WHERE prior IS DISTINCT FROM hashdiff)"""


def customer_sources(spark, sf):
    """Rows of each system with a business key, two attributes, source and load time."""
    crm = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("bk"), F.col("c_mktsegment").alias("class"),
        F.when(F.col("c_acctbal") >= 0, "credit").alias("standing"), F.lit("1990-01-01").cast("timestamp_ntz").alias("load_dttm"), F.lit(0).cast("long").alias("nth"),
    )
    shop = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("bk"), F.col("o_orderpriority").alias("class"), F.col("o_orderstatus").alias("standing"),
        F.col("o_orderdate").alias("load_dttm"), F.col("o_orderkey").alias("nth"),
    )
    app = table(spark, sf, "events").select(
        F.col("user_id").alias("bk"), F.col("event_type").alias("class"), F.lit(None).cast("string").alias("standing"),
        F.col("ts").alias("load_dttm"), F.col("event_id").alias("nth"),
    )
    found = {"app": app, "shop": shop, "crm": crm}
    return {n: df.withColumns({"hk_customer": hash_key("bk"), "record_source": F.lit(n)}) for n, df in found.items()}


def customer_sats(spark, sf):
    return {n: v.sat_load(None, df, "hk_customer", ["class", "standing"], ["nth"]) for n, df in customer_sources(spark, sf).items()}


@query("sat_per_source", f"""
    WITH {SOURCE_ROWS_SQL}
    SELECT md5(CAST(bk AS VARCHAR)) AS hk_customer, hashdiff, class, standing, src AS record_source, tm AS load_dttm FROM sats""")
def sat_per_source(spark, sf):
    """The satellites of all systems under the hub of customers."""
    app, shop, crm = customer_sats(spark, sf).values()
    return app.unionByName(shop).unionByName(crm)


@query("dim_customer_merged", f"""
    WITH {SOURCE_ROWS_SQL},
    spans AS (
      SELECT src, bk, class, standing, tm AS a,
             least(lead(tm) OVER (PARTITION BY src, bk ORDER BY tm),
                   CASE src WHEN 'app' THEN tm + INTERVAL 3 DAY WHEN 'shop' THEN tm + INTERVAL 400 DAY END) AS b FROM sats),
    borders AS (SELECT bk, a AS p FROM spans UNION SELECT bk, b FROM spans WHERE b IS NOT NULL),
    pieces AS (SELECT bk, p FROM borders),
    filled AS (
      SELECT x.bk, x.p,
             max(app.class) AS c1, max(shop.class) AS c2, max(crm.class) AS c3, max(app.standing) AS s1, max(shop.standing) AS s2, max(crm.standing) AS s3,
             count(app.bk) + count(shop.bk) + count(crm.bk) AS n
      FROM pieces x
      LEFT JOIN spans app ON app.src = 'app' AND app.bk = x.bk AND app.a <= x.p AND (app.b IS NULL OR x.p < app.b)
      LEFT JOIN spans shop ON shop.src = 'shop' AND shop.bk = x.bk AND shop.a <= x.p AND (shop.b IS NULL OR x.p < shop.b)
      LEFT JOIN spans crm ON crm.src = 'crm' AND crm.bk = x.bk AND crm.a <= x.p AND (crm.b IS NULL OR x.p < crm.b)
      GROUP BY x.bk, x.p),
    chosen AS (
      SELECT bk, p, n > 0 AS has_any, coalesce(c1, c2, c3) AS class, coalesce(s1, s2, s3) AS standing,
             CASE WHEN c1 IS NOT NULL THEN 'app' WHEN c2 IS NOT NULL THEN 'shop' WHEN c3 IS NOT NULL THEN 'crm' ELSE '' END AS class_source,
             CASE WHEN s1 IS NOT NULL THEN 'app' WHEN s2 IS NOT NULL THEN 'shop' WHEN s3 IS NOT NULL THEN 'crm' ELSE '' END AS standing_source
      FROM filled),
    marked AS (
      SELECT *, lag(has_any || class_source || standing_source || coalesce(class, '-') || '|' || coalesce(standing, '-')) OVER w AS before,
             has_any || class_source || standing_source || coalesce(class, '-') || '|' || coalesce(standing, '-') AS now
      FROM chosen WINDOW w AS (PARTITION BY bk ORDER BY p)),
    starts AS (SELECT *, lead(p) OVER (PARTITION BY bk ORDER BY p) AS q FROM marked WHERE before IS DISTINCT FROM now)
    SELECT md5(CAST(bk AS VARCHAR)) AS hk_customer, bk AS customer_bk, class, standing, class_source, standing_source, p AS valid_from, q AS valid_to
    FROM starts WHERE has_any""")
def dim_customer_merged(spark, sf):
    """One customer dimension out of the three: an event of the app speaks for three days, an order for 400, the rest is the crm's."""
    periods = {}
    for name, sat in customer_sats(spark, sf).items():
        told, days = v.effectivity(sat, "hk_customer"), SOURCE_VALIDITY[name]
        if days is not None:
            told = told.withColumn("valid_to", F.least("valid_to", F.col("valid_from") + F.make_dt_interval(F.lit(days))))
        periods[name] = told
    hub = None
    for df in customer_sources(spark, sf).values():
        rows = df.select(F.col("bk").alias("customer_bk"), "record_source", "load_dttm")
        hub = rows if hub is None else hub.unionByName(rows)
    hub = v.hub_load(None, hub, "customer_bk", "hk_customer").select("hk_customer", "customer_bk")
    merged = overlay(periods, "hk_customer", ["class", "standing"])
    return merged.join(hub, "hk_customer").select(
        "hk_customer", "customer_bk", "class", "standing", F.col("sources")[0].alias("class_source"),
        F.col("sources")[1].alias("standing_source"), "valid_from", "valid_to",
    )


LATE_FROM, LATE_TO = "2024-01-10", "2024-01-15"
IN_LATE = f"ts >= TIMESTAMP '{LATE_FROM}' AND ts < TIMESTAMP '{LATE_TO}'"


def on_time_and_late(src):
    late = (F.col("load_dttm") >= F.lit(LATE_FROM).cast("timestamp_ntz")) & (F.col("load_dttm") < F.lit(LATE_TO).cast("timestamp_ntz"))
    return src.where(~late), src.where(late)


@query("sat_late_repair", f"""
    WITH e AS (SELECT user_id, event_type, ts, md5(lower(trim(event_type))) AS h, {IN_LATE} AS late
               FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn FROM events) x WHERE rn = 1),
    stored AS (SELECT * FROM (SELECT *, lag(h) OVER (PARTITION BY user_id ORDER BY ts) AS prior FROM e WHERE NOT late) x WHERE prior IS DISTINCT FROM h),
    newest AS (SELECT user_id, max(ts) AS since FROM stored GROUP BY user_id),
    later AS (SELECT e.* FROM e LEFT JOIN newest USING (user_id) WHERE late AND (since IS NULL OR ts > since)),
    on_top AS (SELECT user_id, event_type, ts, h FROM (
      SELECT l.*, coalesce(lag(l.h) OVER (PARTITION BY l.user_id ORDER BY l.ts), (SELECT arg_max(s.h, s.ts) FROM stored s WHERE s.user_id = l.user_id)) AS prior FROM later l) x
      WHERE prior IS DISTINCT FROM h),
    every AS (
      SELECT user_id, event_type, ts, h FROM stored UNION SELECT user_id, event_type, ts, h FROM on_top
      UNION SELECT e.user_id, event_type, ts, h FROM e JOIN newest n ON n.user_id = e.user_id WHERE late AND ts <= since),
    chain AS (SELECT *, lag(h) OVER (PARTITION BY user_id ORDER BY ts) AS prior FROM every)
    SELECT md5(CAST(user_id AS VARCHAR)) AS hk_user, event_type AS status, ts AS load_dttm FROM chain WHERE prior IS DISTINCT FROM h""")
def sat_late_repair(spark, sf):
    """Five days of events come after all others: loaded, their late rows repaired, compensations netted."""
    on_time, late = on_time_and_late(user_source(spark, sf))
    sat = v.sat_load(None, on_time, "hk_user", ["status"], ["event_id"])
    sat = cut(sat.unionByName(v.sat_load(sat, late, "hk_user", ["status"], ["event_id"])))
    once = latest_by_key(late, ["hk_user", "load_dttm"], [F.desc("event_id")])
    fixes = v.sat_repair(sat, v.behind(sat, once, "hk_user"), "hk_user", ["status"])
    whole = sat.withColumn("is_void", F.lit(False)).unionByName(fixes)
    return v.sat_net(whole, "hk_user").select("hk_user", "status", "load_dttm")


@query("multi_active_late", f"""
    WITH m AS (SELECT DISTINCT user_id, event_type, date_trunc('day', ts) AS tm, {IN_LATE} AS late FROM events),
    sets AS (SELECT user_id, tm, late, string_agg(event_type, ',' ORDER BY event_type) AS vals FROM m GROUP BY ALL),
    stored AS (SELECT * FROM (SELECT *, lag(vals) OVER (PARTITION BY user_id ORDER BY tm) AS prior FROM sets WHERE NOT late) x WHERE prior IS DISTINCT FROM vals),
    every AS (SELECT user_id, tm, vals FROM stored UNION SELECT user_id, tm, vals FROM sets WHERE late),
    chain AS (SELECT *, lag(vals) OVER (PARTITION BY user_id ORDER BY tm) AS prior FROM every)
    SELECT md5(CAST(user_id AS VARCHAR)) AS hk_user, unnest(string_split(vals, ',')) AS status, tm AS load_dttm
    FROM chain WHERE prior IS DISTINCT FROM vals""")
def multi_active_late(spark, sf):
    """The sets of statuses of five days come after all others."""
    days = user_source(spark, sf).withColumn("load_dttm", F.date_trunc("day", "load_dttm").cast("timestamp_ntz"))
    on_time, late = on_time_and_late(days)
    sat = v.multi_active_load(None, on_time, "hk_user", ["status"])
    sat = cut(sat.unionByName(v.multi_active_load(sat, late, "hk_user", ["status"])))
    fixes = v.multi_active_repair(sat, v.behind(sat, late, "hk_user"), "hk_user", ["status"])
    whole = sat.withColumn("is_void", F.lit(False)).unionByName(fixes)
    return v.sat_net(whole, "hk_user").select("hk_user", "status", "load_dttm")

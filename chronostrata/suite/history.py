"""Row history over the event table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chronostrata.functions import effective_ts, hashdiff, is_current, valid_at, version_key
from chronostrata.operators import history as h
from chronostrata.operators.keys import assign_keys
from chronostrata.operators.latest import latest_as_of, latest_by_key
from chronostrata.operators.rows import trace_load
from chronostrata.operators.upsert import insert_if_absent, snapshot_latest, upsert_newer
from chronostrata.session import cut
from chronostrata.suite.base import CUT, DAILY_SQL, TS_SQL, daily_history_sql, query, status_log, table

COLS = "user_id, status, hashdiff, valid_from, valid_to"


def daily_history(spark, sf):
    return h.scd2_backfill(status_log(spark, sf), "user_id", ["status"], "ts", ["event_id"])


def ts_history(spark, sf):
    return h.scd2_backfill(status_log(spark, sf), "user_id", ["status"], "ts", ["event_id"], grain="ts")


@query("change_hash", """
    SELECT c_custkey, md5(concat_ws('||', lower(trim(c_name)), lower(trim(c_mktsegment)),
                                   CAST(c_nationkey AS VARCHAR))) AS hashdiff FROM customer""")
def change_hash(spark, sf):
    customers = table(spark, sf, "customer")
    return customers.select("c_custkey", hashdiff("c_name", "c_mktsegment", "c_nationkey").alias("hashdiff"))


@query("scd2_backfill_ts", f"WITH {TS_SQL} SELECT {COLS} FROM hist")
def scd2_backfill_ts(spark, sf):
    return ts_history(spark, sf)


@query("scd2_backfill_daily", f"WITH {DAILY_SQL} SELECT {COLS} FROM hist")
def scd2_backfill_daily(spark, sf):
    return daily_history(spark, sf)


@query("scd2_stamped", f"""
    WITH {DAILY_SQL} SELECT {COLS}, CAST(DATE '{CUT}' AS TIMESTAMP) AS created_at, CAST(DATE '{CUT}' AS TIMESTAMP) AS updated_at
    FROM hist""")
def scd2_stamped(spark, sf):
    """Technical timestamps of the run beside the periods."""
    return h.stamp(daily_history(spark, sf), dt.datetime.fromisoformat(CUT))


@query("scd2_as_of", f"""
    WITH {DAILY_SQL} SELECT user_id, status FROM hist
    WHERE DATE '{CUT}' >= valid_from AND (valid_to IS NULL OR DATE '{CUT}' < valid_to)""")
def scd2_as_of(spark, sf):
    at = F.lit(CUT).cast("date")
    return daily_history(spark, sf).where(valid_at(at)).select("user_id", "status")


@query("scd2_current", f"WITH {TS_SQL} SELECT user_id, status, valid_from FROM hist WHERE valid_to IS NULL")
def scd2_current(spark, sf):
    return ts_history(spark, sf).where(is_current()).select("user_id", "status", "valid_from")


@query("append_only_as_of", f"""
    WITH {DAILY_SQL} SELECT user_id, status, valid_from FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY valid_from DESC) AS rn
      FROM hist WHERE valid_from <= DATE '{CUT}') x WHERE rn = 1""")
def append_only_as_of(spark, sf):
    versions = daily_history(spark, sf).select("user_id", "status", "valid_from")
    return latest_as_of(versions, "user_id", "valid_from", F.lit(CUT).cast("date"))


@query("append_only_current", f"""
    WITH {DAILY_SQL} SELECT user_id, status, valid_from FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY valid_from DESC) AS rn FROM hist) x
    WHERE rn = 1""")
def append_only_current(spark, sf):
    return h.append_only_current(daily_history(spark, sf), "user_id").select("user_id", "status", "valid_from")


OLD_SQL = f"""
    log AS (SELECT user_id, event_type AS status, ts, event_id FROM events WHERE ts < TIMESTAMP '{CUT}'),
    {daily_history_sql('log')},
    snap AS (
      SELECT user_id, status, md5(lower(trim(status))) AS hashdiff, CAST(ts AS DATE) AS eff FROM (
        SELECT user_id, event_type AS status, ts,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
      WHERE rn = 1),
    cur AS (SELECT * FROM hist WHERE valid_to IS NULL)"""
INCREMENT_SQL = f"""
    WITH {OLD_SQL}
    SELECT o.user_id, o.status, o.hashdiff, o.valid_from,
           CASE WHEN o.valid_to IS NULL AND s.hashdiff <> o.hashdiff AND s.eff > o.valid_from
                THEN s.eff ELSE o.valid_to END AS valid_to
    FROM hist o LEFT JOIN snap s ON s.user_id = o.user_id
    UNION ALL
    SELECT s.user_id, s.status, s.hashdiff, s.eff, CAST(NULL AS DATE)
    FROM snap s LEFT JOIN cur c ON c.user_id = s.user_id
    WHERE (c.user_id IS NULL OR (c.hashdiff <> s.hashdiff AND s.eff > c.valid_from))
      AND NOT EXISTS (SELECT 1 FROM hist o WHERE o.user_id = s.user_id AND o.valid_from = s.eff)"""


def before_cut(spark, sf):
    log = status_log(spark, sf)
    old = log.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    return h.scd2_backfill(old, "user_id", ["status"], "ts", ["event_id"])


def snapshot(spark, sf):
    newest = latest_by_key(status_log(spark, sf), "user_id", [F.desc("ts"), F.desc("event_id")])
    return newest.select("user_id", "status", F.col("ts").cast("date").alias("eff"))


def stored(spark, sf):
    """Dimension and snapshot as an increment finds them: tables."""
    return cut(before_cut(spark, sf)), cut(snapshot(spark, sf))


@query("scd2_increment", INCREMENT_SQL)
def scd2_increment(spark, sf):
    dim, snap = stored(spark, sf)
    return h.scd2_apply(dim, snap, "user_id", ["status"], "eff")


@query("scd2_increment_rerun", INCREMENT_SQL)
def scd2_increment_rerun(spark, sf):
    dim, snap = stored(spark, sf)
    once = cut(h.scd2_apply(dim, snap, "user_id", ["status"], "eff"))
    return h.scd2_apply(once, snap, "user_id", ["status"], "eff")


@query("scd2_ignored_changes", f"""
    WITH {DAILY_SQL}, cur AS (SELECT * FROM hist WHERE valid_to IS NULL)
    SELECT l.user_id, l.status, l.ts FROM log l JOIN cur c ON c.user_id = l.user_id
    WHERE md5(lower(trim(l.status))) <> c.hashdiff AND CAST(l.ts AS DATE) <= c.valid_from""")
def scd2_ignored_changes(spark, sf):
    late = h.not_newer(daily_history(spark, sf), status_log(spark, sf), "user_id", ["status"], "ts")
    return late.select("user_id", "status", "ts")


@query("scd2_backdated", f"WITH {DAILY_SQL} SELECT {COLS} FROM hist")
def scd2_backdated(spark, sf):
    """Events of great value arrive late; the keys they touch are rebuilt."""
    events = table(spark, sf, "events").withColumn("status", F.col("event_type"))
    late = events.where("value > 250")
    dim = h.scd2_backfill(events.where("value <= 250"), "user_id", ["status"], "ts", ["event_id"])
    return h.scd2_repair(dim, events, late, "user_id", ["status"], "ts", ["event_id"])


@query("scd2_append_rows", f"""
    WITH {OLD_SQL}
    SELECT s.user_id, s.status, s.eff AS valid_from, md5(concat_ws('||', CAST(s.user_id AS VARCHAR),
           CAST(s.eff AS VARCHAR))) AS version_key
    FROM snap s LEFT JOIN cur c ON c.user_id = s.user_id
    WHERE c.user_id IS NULL OR c.hashdiff <> s.hashdiff""")
def scd2_append_rows(spark, sf):
    stored = before_cut(spark, sf).select("user_id", "status", "valid_from")
    added = h.scd2_append_rows(stored, snapshot(spark, sf), "user_id", ["status"], "eff")
    return added.withColumn("version_key", version_key("user_id", "valid_from"))


STAGED_SQL = """
    staged AS (
      SELECT user_id, event_type AS status, CASE WHEN event_type <> 'error' THEN ts END AS event_ts,
             'batch_' || strftime(ts, '%Y%m%d') AS _load_id, ts + INTERVAL 1 HOUR AS _load_ts, ts FROM events),
    timed AS (SELECT *, coalesce(event_ts, _load_ts) AS eff FROM staged)"""
STATE = ("user_id", "status", "event_ts", "_load_id", "_load_ts")


def staged(spark, sf):
    """Events as staged states: errors come without event time."""
    log = status_log(spark, sf)
    return log.select(
        "user_id",
        "status",
        F.when(F.col("status") != "error", F.col("ts")).alias("event_ts"),
        F.concat(F.lit("batch_"), F.date_format("ts", "yyyyMMdd")).alias("_load_id"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("_load_ts"),
        "ts",
    )


@query("snapshot_latest", f"""
    WITH {STAGED_SQL} SELECT user_id, status, event_ts, _load_id, _load_ts FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY eff DESC, _load_ts DESC, _load_id DESC) AS rn
      FROM timed) x WHERE rn = 1""")
def snapshot_latest_(spark, sf):
    return snapshot_latest(staged(spark, sf).select(*STATE), "user_id", effective_ts("event_ts", "_load_ts"))


@query("upsert_newer", f"""
    WITH {STAGED_SQL},
    target AS (SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY eff DESC, _load_ts DESC) AS rn
      FROM timed WHERE ts < TIMESTAMP '{CUT}') x WHERE rn = 1),
    src AS (SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY eff DESC, _load_ts DESC) AS rn
      FROM timed WHERE ts >= TIMESTAMP '2024-01-10') x WHERE rn = 1)
    SELECT coalesce(t.user_id, s.user_id) AS user_id,
           CASE WHEN t.user_id IS NULL OR s.eff > t.eff THEN s.status ELSE t.status END AS status,
           CASE WHEN t.user_id IS NULL OR s.eff > t.eff THEN s.event_ts ELSE t.event_ts END AS event_ts,
           CASE WHEN t.user_id IS NULL OR s.eff > t.eff THEN s._load_id ELSE t._load_id END AS _load_id,
           CASE WHEN t.user_id IS NULL OR s.eff > t.eff THEN s._load_ts ELSE t._load_ts END AS _load_ts
    FROM target t FULL JOIN src s ON s.user_id = t.user_id""")
def upsert_newer_(spark, sf):
    rows, eff = staged(spark, sf), effective_ts("event_ts", "_load_ts")
    target = snapshot_latest(rows.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")).select(*STATE), "user_id", eff)
    src = rows.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")).select(*STATE)
    return upsert_newer(target, src, "user_id", eff)


@query("insert_if_absent", """
    SELECT user_id, event_type AS status, ts, min('batch_' || strftime(ts, '%Y%m%d')) AS _load_id
    FROM events GROUP BY user_id, event_type, ts""")
def insert_if_absent_(spark, sf):
    """The second batch replays a part of the first, stamped with a later load."""
    rows = staged(spark, sf).select("user_id", "status", "ts", "_load_id")
    target = rows.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    replay = target.withColumn("_load_id", F.concat(F.lit("replay_"), "_load_id"))
    batch = rows.where(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))
    again = batch.withColumn("_load_id", F.concat(F.lit("replay_"), "_load_id"))
    src = replay.unionByName(batch).unionByName(again)
    return insert_if_absent(target, src, ["user_id", "ts"], ["_load_id"])


@query("trace_load", """
    SELECT user_id, event_type AS status, ts FROM events WHERE strftime(ts, '%Y%m%d') = '20240115'""")
def trace_load_(spark, sf):
    return trace_load(staged(spark, sf), "batch_20240115").select("user_id", "status", "ts")


PER_USER_SQL = f"""
    b AS (SELECT user_id, arg_max(event_type, ts) AS status, max(ts) AS ts FROM events
          WHERE ts < TIMESTAMP '{CUT}' GROUP BY user_id),
    first_b AS (SELECT user_id, arg_min(event_type, ts) AS status, min(ts) AS ts FROM events
          WHERE ts < TIMESTAMP '{CUT}' GROUP BY user_id),
    a AS (SELECT user_id, arg_max(event_type, ts) AS status, max(ts) AS ts FROM events
          WHERE ts >= TIMESTAMP '{CUT}' GROUP BY user_id),
    first_a AS (SELECT user_id, arg_min(event_type, ts) AS status, min(ts) AS ts FROM events
          WHERE ts >= TIMESTAMP '{CUT}' GROUP BY user_id)"""


def halves(spark, sf):
    log = status_log(spark, sf).select("user_id", "status", "ts")
    cut = F.lit(CUT).cast("timestamp_ntz")
    return log.where(F.col("ts") < cut), log.where(F.col("ts") >= cut)


@query("scd0", f"""
    WITH {PER_USER_SQL} SELECT user_id, status, ts FROM first_b
    UNION ALL SELECT user_id, status, ts FROM first_a WHERE user_id NOT IN (SELECT user_id FROM first_b)""")
def scd0(spark, sf):
    old, new = halves(spark, sf)
    return h.scd0(latest_by_key(old, "user_id", [F.asc("ts")]), new, "user_id", "ts")


@query("scd1", f"""
    WITH {PER_USER_SQL}
    SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.status, b.status) AS status,
           coalesce(a.ts, b.ts) AS ts FROM b FULL JOIN a ON a.user_id = b.user_id""")
def scd1(spark, sf):
    old, new = halves(spark, sf)
    return h.scd1(latest_by_key(old, "user_id", [F.desc("ts")]), new, "user_id", "ts")


@query("scd3", f"""
    WITH {PER_USER_SQL}
    SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.status, b.status) AS status,
           CASE WHEN b.status <> a.status THEN b.status END AS previous_status,
           CASE WHEN b.status <> a.status THEN CAST(a.ts AS DATE) END AS status_change_date
    FROM b FULL JOIN a ON a.user_id = b.user_id""")
def scd3(spark, sf):
    old, new = halves(spark, sf)
    dim = latest_by_key(old, "user_id", [F.desc("ts")]).select(
        "user_id",
        "status",
        F.lit(None).cast("string").alias("previous_status"),
        F.lit(None).cast("date").alias("status_change_date"),
    )
    return h.scd3(dim, new, "user_id", "status", "ts")


HISTORY4_SQL = f"""
    {PER_USER_SQL},
    history AS (
      SELECT user_id, status, CAST(ts AS DATE) AS valid_from FROM b
      UNION ALL
      SELECT a.user_id, a.status, CAST(a.ts AS DATE) FROM a LEFT JOIN b ON b.user_id = a.user_id
      WHERE b.user_id IS NULL OR b.status <> a.status),
    now AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.status, b.status) AS status,
                   coalesce(a.ts, b.ts) AS ts FROM b FULL JOIN a ON a.user_id = b.user_id)"""


def current_and_history(spark, sf):
    old, new = halves(spark, sf)
    current = latest_by_key(old, "user_id", [F.desc("ts")])
    history = current.select("user_id", "status", F.col("ts").cast("date").alias("valid_from"))
    return h.scd4(current, history, new, "user_id", ["status"], "ts")


@query("scd4_current", f"WITH {HISTORY4_SQL} SELECT user_id, status, ts FROM now")
def scd4_current(spark, sf):
    return current_and_history(spark, sf)[0]


@query("scd4_history", f"WITH {HISTORY4_SQL} SELECT user_id, status, valid_from FROM history")
def scd4_history(spark, sf):
    return current_and_history(spark, sf)[1]


@query("scd5", f"""
    WITH {HISTORY4_SQL} SELECT x.user_id, x.status, x.valid_from, now.status AS current_status
    FROM history x LEFT JOIN now ON now.user_id = x.user_id""")
def scd5(spark, sf):
    current, history = current_and_history(spark, sf)
    return h.scd5(current, history, "user_id", ["status"])


SCD6_SQL = """
    SELECT user_id, status, hashdiff, valid_from, valid_to,
           lag(status) OVER (PARTITION BY user_id ORDER BY valid_from) AS previous_status,
           last_value(status) OVER (PARTITION BY user_id ORDER BY valid_from
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS current_status FROM hist"""


@query("scd6", f"WITH {DAILY_SQL} {SCD6_SQL}")
def scd6(spark, sf):
    return h.scd6(status_log(spark, sf), "user_id", "status", "ts", ["event_id"])


@query("scd6_ts", f"WITH {TS_SQL} {SCD6_SQL}")
def scd6_ts(spark, sf):
    return h.scd6(status_log(spark, sf), "user_id", "status", "ts", ["event_id"], grain="ts")


@query("surrogate_keys", f"""
    WITH {TS_SQL} SELECT row_number() OVER (ORDER BY user_id, valid_from) AS status_sk, user_id, status, valid_from
    FROM hist""")
def surrogate_keys(spark, sf):
    return assign_keys(
        ts_history(spark, sf).select("user_id", "status", "valid_from"), ["user_id", "valid_from"], "status_sk"
    )

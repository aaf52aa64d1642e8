"""Streams over the event table. Events are dropped into a folder week by week; a run after
each drop reads what is new. The queries return what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chronostrata.functions import blank_to_null
from chronostrata.operators.history import scd2_repair
from chronostrata.session import shared_dir
from chronostrata.sources.tables import append_rows, read_table, write_version
from chronostrata.streaming.history import run_scd2_stream, scd2_foreach_batch
from chronostrata.streaming.ingest import clean_stream, drop_repeats, stream_stage, write_stream
from chronostrata.suite.base import LOG_SQL, daily_history_sql, query, status_log

WEEKS = ("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29")


def folder(spark):
    return f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"


def weeks(spark, sf):
    """All events, one DataFrame per week, in order of time."""
    log = status_log(spark, sf)
    starts = [F.lit(w).cast("timestamp_ntz") for w in WEEKS]
    found = []
    for i, start in enumerate(starts):
        week = log.where(F.col("ts") >= start) if i else log
        found.append(week.where(F.col("ts") < starts[i + 1]) if i + 1 < len(starts) else week)
    return found


def drop_and_run(drops, path, start):
    """Each drop is followed by a run that reads what is new: one micro-batch per drop."""
    for drop in drops:
        append_rows(drop, path)
        start().awaitTermination()


@query("stream_ingest", "SELECT user_id, event_type AS status, ts FROM events WHERE event_type <> 'error'")
def stream_ingest(spark, sf):
    """Errors come with a blank status and are rejected on the way."""
    root, drops = folder(spark), weeks(spark, sf)

    def start():
        staged = stream_stage(spark, f"{root}/drops", drops[0].schema)
        blank = F.when(F.col("status") == "error", F.lit(" ")).otherwise(F.col("status"))
        judged = clean_stream(staged.withColumn("status", blank), {"status_filled": blank_to_null("status").isNotNull()})
        return write_stream(judged, f"{root}/events", f"{root}/state")

    drop_and_run(drops, f"{root}/drops", start)
    return spark.read.parquet(f"{root}/events").where("reject_reason IS NULL").select("user_id", "status", "ts")


@query("stream_dedupe", "SELECT user_id, event_type AS status, ts FROM events")
def stream_dedupe(spark, sf):
    """The second week is delivered twice."""
    root, drops = folder(spark), weeks(spark, sf)

    def start():
        staged = stream_stage(spark, f"{root}/drops", drops[0].schema)
        once = drop_repeats(staged, ["user_id", "ts"], "ts", "14 days")
        return write_stream(once, f"{root}/events", f"{root}/state")

    drop_and_run([*drops[:2], drops[1], *drops[2:]], f"{root}/drops", start)
    return spark.read.parquet(f"{root}/events").select("user_id", "status", "ts")


def streamed_history(spark, sf, order):
    root, drops = folder(spark), weeks(spark, sf)
    columns = "user_id bigint, status string, hashdiff string, valid_from date, valid_to date"
    write_version(spark.createDataFrame([], columns), f"{root}/dim", 0)
    apply = scd2_foreach_batch(f"{root}/dim", "user_id", ["status"], "ts", ["event_id"], f"{root}/late")

    def start():
        return run_scd2_stream(stream_stage(spark, f"{root}/drops", drops[0].schema), apply, f"{root}/state")

    drop_and_run([drops[i] for i in order], f"{root}/drops", start)
    return read_table(spark, f"{root}/dim"), spark.read.parquet(f"{root}/late")


IN_ORDER, WEEK_3_LATE = (0, 1, 2, 3, 4), (0, 1, 3, 2, 4)


def weekly_sql(order):
    """CTEs `dim0` to `dim5` and `late1` to `late5`: one increment per week, in the order given."""
    steps = [f"""
    {LOG_SQL},
    timed AS (SELECT *, md5(lower(trim(status))) AS hashdiff, CAST(ts AS DATE) AS eff,
                     least(date_diff('day', DATE '{WEEKS[0]}', CAST(ts AS DATE)) // 7, 4) AS week FROM log),
    snaps AS (SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, week ORDER BY ts DESC, event_id DESC) AS rn FROM timed) x
      WHERE rn = 1),
    dim0 AS (SELECT user_id, status, hashdiff, eff AS valid_from, CAST(NULL AS DATE) AS valid_to FROM timed LIMIT 0)"""]
    for i, week in enumerate(order):
        steps.append(f"""
    late{i + 1} AS (SELECT t.user_id FROM timed t JOIN dim{i} c ON c.user_id = t.user_id AND c.valid_to IS NULL
      WHERE t.week = {week} AND t.hashdiff <> c.hashdiff AND t.eff <= c.valid_from),
    dim{i + 1} AS (
      SELECT o.user_id, o.status, o.hashdiff, o.valid_from,
             CASE WHEN o.valid_to IS NULL AND s.hashdiff <> o.hashdiff AND s.eff > o.valid_from
                  THEN s.eff ELSE o.valid_to END AS valid_to
      FROM dim{i} o LEFT JOIN snaps s ON s.user_id = o.user_id AND s.week = {week}
      UNION ALL
      SELECT s.user_id, s.status, s.hashdiff, s.eff, CAST(NULL AS DATE)
      FROM snaps s LEFT JOIN dim{i} c ON c.user_id = s.user_id AND c.valid_to IS NULL
      WHERE s.week = {week} AND (c.user_id IS NULL OR (c.hashdiff <> s.hashdiff AND s.eff > c.valid_from))
        AND NOT EXISTS (SELECT 1 FROM dim{i} o WHERE o.user_id = s.user_id AND o.valid_from = s.eff))""")
    return ",".join(steps)


@query("stream_scd2", f"WITH {weekly_sql(IN_ORDER)} SELECT * FROM dim5")
def stream_scd2(spark, sf):
    """One increment per week: the newest state of each user in that week."""
    return streamed_history(spark, sf, IN_ORDER)[0]


@query("stream_late_repair", f"""
    WITH {weekly_sql(WEEK_3_LATE)},
    touched AS (SELECT user_id FROM late1 UNION SELECT user_id FROM late2 UNION SELECT user_id FROM late3
                UNION SELECT user_id FROM late4 UNION SELECT user_id FROM late5),
    {daily_history_sql('log')}
    SELECT * FROM dim5 WHERE user_id NOT IN (SELECT user_id FROM touched)
    UNION ALL
    SELECT user_id, status, hashdiff, valid_from, valid_to FROM hist WHERE user_id IN (SELECT user_id FROM touched)""")
def stream_late_repair(spark, sf):
    """The third week comes after the fourth. Users whose late events the increments could not
    take are rebuilt from the whole log."""
    dim, late = streamed_history(spark, sf, WEEK_3_LATE)
    return scd2_repair(dim, status_log(spark, sf), late, "user_id", ["status"], "ts", ["event_id"])

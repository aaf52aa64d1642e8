"""Registered queries: each with the SQL another engine runs on the same tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronostrata.session import sized_shuffles, sound_unions

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            sound_unions(spark)
            sized_shuffles(spark, sf_dir)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Run dates of the suite, fixed so that results can be compared.
CUT = "2024-01-15"
EVENTS_AS_OF = "2024-01-31"
ORDERS_AS_OF = "2001-08-01"


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table read as a log of status changes of users."""
    events = table(spark, sf_dir, "events")
    return events.select("user_id", F.col("event_type").alias("status"), "ts", "event_id")


def daily_history_sql(source: str, key: str = "user_id", attr: str = "status", ts: str = "ts", tie: str = "event_id") -> str:
    """CTE bodies `last_of_day`, `told`, `changes` and `hist` over `source`."""
    return f"""
    last_of_day AS (
      SELECT {key}, {attr}, CAST({ts} AS DATE) AS d, md5(lower(trim({attr}))) AS hashdiff FROM (
        SELECT *, row_number() OVER (PARTITION BY {key}, CAST({ts} AS DATE) ORDER BY {ts} DESC, {tie} DESC) AS rn
        FROM {source}) x WHERE rn = 1),
    told AS (SELECT *, lag(hashdiff) OVER (PARTITION BY {key} ORDER BY d) AS prior_hash FROM last_of_day),
    changes AS (SELECT * FROM told WHERE prior_hash IS DISTINCT FROM hashdiff),
    hist AS (
      SELECT {key}, {attr}, hashdiff, d AS valid_from, lead(d) OVER (PARTITION BY {key} ORDER BY d) AS valid_to
      FROM changes)"""


LOG_SQL = "log AS (SELECT user_id, event_type AS status, ts, event_id FROM events)"
DAILY_SQL = f"{LOG_SQL}, {daily_history_sql('log')}"
TS_SQL = f"""all_log AS (SELECT user_id, event_type AS status, ts, event_id FROM events),
    log AS (
      SELECT user_id, status, ts, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn FROM all_log) x WHERE rn = 1),
    told AS (
      SELECT *, md5(lower(trim(status))) AS hashdiff,
             lag(md5(lower(trim(status)))) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prior_hash FROM log),
    changes AS (SELECT * FROM told WHERE prior_hash IS DISTINCT FROM hashdiff),
    hist AS (
      SELECT user_id, status, hashdiff, ts AS valid_from,
             lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM changes)"""

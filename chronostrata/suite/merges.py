"""Histories merged batch by batch, and events that come late. However the log is cut and in whatever order
the parts come, the result is that of the whole log."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronostrata.operators.merge import scd2_merge
from chronostrata.session import cut
from chronostrata.sources.buckets import BucketedHistory
from chronostrata.streaming.dedupe import first_seen_foreach_batch, read_events, read_repeats
from chronostrata.streaming.history import run_scd2_stream
from chronostrata.streaming.ingest import stream_stage
from chronostrata.streaming.merge import history_schema, merge_foreach_batch
from chronostrata.suite.base import CUT, DAILY_SQL, TS_SQL, query, status_log
from chronostrata.suite.history import COLS
from chronostrata.suite.streams import WEEKS, drop_and_run, folder, weeks

KEY, ATTRS, TS, TIE = "user_id", ["status"], "ts", ["event_id"]
HISTORY = ["user_id", "status", "hashdiff", "valid_from", "valid_to"]
DAILY = f"WITH {DAILY_SQL} SELECT {COLS} FROM hist"
EXACT = f"WITH {TS_SQL} SELECT {COLS} FROM hist"

# In the middle of days, so that days are split between batches.
ODD_CUTS = ("2024-01-03 07:13:00", "2024-01-03 15:40:00", "2024-01-04 02:00:00", "2024-01-19 12:00:00")


def odd_parts(log):
    starts = [F.lit(c).cast("timestamp_ntz") for c in ODD_CUTS]
    ends = [*starts, None]
    return [
        log.where((F.col(TS) >= start if start is not None else F.lit(True)) & (F.col(TS) < end if end is not None else F.lit(True)))
        for start, end in zip([None, *starts], ends, strict=True)
    ]


def merged_stream(spark, sf, parts, grain="day", buckets=16):
    root = folder(spark)
    schema = history_schema(status_log(spark, sf).schema, KEY, ATTRS, TS, TIE, grain)
    table = BucketedHistory(f"{root}/history", KEY, schema, buckets)
    apply = merge_foreach_batch(table, ATTRS, TS, TIE, grain)

    def start():
        return run_scd2_stream(stream_stage(spark, f"{root}/drops", parts[0].schema), apply, f"{root}/state")

    drop_and_run(parts, f"{root}/drops", start)
    return table.read(spark, HISTORY)


@query("stream_merge_weeks", DAILY)
def stream_merge_weeks(spark, sf):
    """One batch per week; every change of a week counts, not the newest only."""
    return merged_stream(spark, sf, weeks(spark, sf))


@query("stream_merge_odd_cuts", DAILY)
def stream_merge_odd_cuts(spark, sf):
    """Batches that end in the middle of days."""
    return merged_stream(spark, sf, odd_parts(status_log(spark, sf)))


@query("stream_merge_ts", EXACT)
def stream_merge_ts(spark, sf):
    """Every change at its time."""
    return merged_stream(spark, sf, odd_parts(status_log(spark, sf)), "ts")


@query("stream_merge_shuffled", DAILY)
def stream_merge_shuffled(spark, sf):
    """Each event goes to one of five batches by its hash, so most come late; the second batch comes twice."""
    log = status_log(spark, sf)
    dealt = F.pmod(F.xxhash64("event_id"), F.lit(5))
    parts = [log.where(dealt == i) for i in (3, 0, 4, 2, 1)]
    return merged_stream(spark, sf, [*parts, parts[1]])


@query("stream_merge_shuffled_ts", EXACT)
def stream_merge_shuffled_ts(spark, sf):
    """Weeks out of order, at the time of each event."""
    found = weeks(spark, sf)
    return merged_stream(spark, sf, [found[i] for i in (2, 0, 4, 3, 1)], "ts")


@query("scd2_merge_batch", DAILY)
def scd2_merge_batch(spark, sf):
    """A history until a date, and all that comes after in one batch."""
    log, at = status_log(spark, sf), F.lit(CUT).cast("timestamp_ntz")
    old = scd2_merge(None, log.where(F.col(TS) < at), KEY, ATTRS, TS, TIE)
    heads = cut(old.current)
    new = scd2_merge(heads, log.where(F.col(TS) >= at), KEY, ATTRS, TS, TIE)
    return old.closed.unionByName(new.closed).unionByName(new.current.select(*HISTORY)).select(*HISTORY)


# Weeks are two months apart here, and some come months late or twice.
STRETCHED = f"least(date_diff('day', DATE '{WEEKS[0]}', CAST(ts AS DATE)) // 7, 4)"


def stretched(spark, sf):
    return [
        week.withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(60 * i))).select("user_id", "status", "ts", "event_id")
        for i, week in enumerate(weeks(spark, sf))
    ]


def deduped(spark, sf):
    root, found = folder(spark), stretched(spark, sf)
    parts = [found[i] for i in (1, 4, 4, 0, 2, 0, 3, 1)]
    apply = first_seen_foreach_batch(f"{root}/kept", ["event_id", "ts"], "ts")

    def start():
        return run_scd2_stream(stream_stage(spark, f"{root}/drops", parts[0].schema), apply, f"{root}/state")

    drop_and_run(parts, f"{root}/drops", start)
    return f"{root}/kept", parts[0].schema


@query("stream_dedupe_late", f"SELECT user_id, event_type AS status, ts + to_days(CAST(60 * {STRETCHED} AS INT)) AS ts, event_id FROM events")
def stream_dedupe_late(spark, sf):
    """First-time rows that come months late are kept, repeats of any age are not."""
    root, schema = deduped(spark, sf)
    return read_events(spark, root, schema)


@query("stream_dedupe_repeats", f"""
    SELECT user_id, event_type AS status, ts + to_days(CAST(60 * {STRETCHED} AS INT)) AS ts, event_id, 'stored' AS reason
    FROM events WHERE {STRETCHED} IN (0, 1, 4)""")
def stream_dedupe_repeats(spark, sf):
    """What was set aside: the three weeks that came twice."""
    root, schema = deduped(spark, sf)
    return read_repeats(spark, root, schema)

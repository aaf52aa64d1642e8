"""Batches merged into a history must give the history of the whole log, however they are cut."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from chronostrata.operators.history import scd2_backfill
from chronostrata.operators.merge import scd2_merge
from chronostrata.session import cut
from chronostrata.sources import buckets
from chronostrata.sources.batches import committed, read_part, write_part
from chronostrata.sources.buckets import BucketedHistory
from chronostrata.streaming.dedupe import first_seen, read_events, read_repeats
from chronostrata.streaming.merge import history_schema, merge_batch

LOG = "k int, v string, ts timestamp_ntz, n int"
COLUMNS = ["k", "v", "hashdiff", "valid_from", "valid_to"]


def rows_of(df, columns=COLUMNS):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def log_rows(seed, n=220):
    """Several events a day and some of one moment; NULL and blank states; one key has a third of the rows."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    times = sorted(start + dt.timedelta(hours=rng.choice([0, 0, 1, 5, 9, 23]), days=rng.randint(0, 9)) for _ in range(n))
    return [(1 if rng.random() < 0.34 else rng.randint(2, 12), rng.choice(["a", "A ", "b", "c", None, " "]), t, i) for i, t in enumerate(times)]


@pytest.mark.parametrize("grain", ["day", "ts"])
@pytest.mark.parametrize("hot_rows", [None, 15])
def test_any_cut_gives_the_history_of_the_log(spark, grain, hot_rows):
    rows = log_rows(grain)
    whole = spark.createDataFrame(rows, LOG)
    want = rows_of(scd2_backfill(whole, "k", ["v"], "ts", ["n"], grain))
    rng = random.Random(hot_rows or 1)
    cuts = sorted(rng.sample(range(1, len(rows)), 4))
    heads, closed = None, []
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        told = scd2_merge(heads, spark.createDataFrame(rows[a:b], LOG), "k", ["v"], "ts", ["n"], grain, hot_rows)
        assert told.late.count() == 0
        heads = cut(told.current)
        closed += rows_of(told.closed)
        assert heads.groupBy("k").count().where("count > 2").count() == 0
    assert sorted(closed + rows_of(heads), key=repr) == want


def test_a_batch_that_comes_again_is_late_and_changes_nothing(spark):
    rows = spark.createDataFrame(log_rows(4, 60), LOG)
    first = scd2_merge(None, rows, "k", ["v"], "ts", ["n"])
    heads = cut(first.current)
    again = scd2_merge(heads, rows, "k", ["v"], "ts", ["n"])
    assert rows_of(again.current) == rows_of(heads) and again.closed.count() == 0
    assert again.late.count() == rows.count()


def history(spark, root, grain="day", count=4):
    schema = history_schema(spark.createDataFrame([], LOG).schema, "k", ["v"], "ts", ["n"], grain)
    return BucketedHistory(root, "k", schema, count)


def test_shuffled_batches_are_rebuilt_from_the_log(spark, tmp_path):
    rows = log_rows(11, 120)
    whole = spark.createDataFrame(rows, LOG)
    table = history(spark, f"{tmp_path}/h")
    parts = [rows[70:], rows[:30], rows[30:70], rows[:30]]
    for i, part in enumerate(parts):
        merge_batch(table, spark.createDataFrame([*part, (None, "x", rows[0][2], -1)], LOG), i, ["v"], "ts", ["n"])
    assert rows_of(table.read(spark, COLUMNS)) == rows_of(scd2_backfill(whole, "k", ["v"], "ts", ["n"]))
    # What came late was noted; what came twice was not.
    late = read_part(spark, table.root, "late", whole.schema).groupBy("batch").count().collect()
    assert {r["batch"] for r in late} == {1, 2}


def test_a_batch_cut_off_is_done_again(spark, tmp_path, monkeypatch):
    rows = log_rows(5, 90)
    table = history(spark, f"{tmp_path}/h", "ts")
    first, second = (spark.createDataFrame(r, LOG) for r in (rows[:50], rows[50:]))
    merge_batch(table, first, 0, ["v"], "ts", ["n"], "ts")
    before = rows_of(table.read(spark, COLUMNS))

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError, match="driver lost"):
        broken.setattr(buckets, "commit", lost)
        merge_batch(table, second, 1, ["v"], "ts", ["n"], "ts")
    assert rows_of(table.read(spark, COLUMNS)) == before and committed(spark, table.root) == [0]
    for _ in range(2):
        merge_batch(table, second, 1, ["v"], "ts", ["n"], "ts")
    assert rows_of(table.read(spark, COLUMNS)) == rows_of(scd2_backfill(spark.createDataFrame(rows, LOG), "k", ["v"], "ts", ["n"], "ts"))


def test_an_increment_touches_its_buckets_only(spark, tmp_path):
    table = history(spark, f"{tmp_path}/h", count=16)
    day = dt.datetime(2024, 1, 1)
    merge_batch(table, spark.createDataFrame([(k, f"{d % 3}", day + dt.timedelta(days=d), d) for k in range(40) for d in range(6)], LOG), 0, ["v"], "ts", ["n"])
    merge_batch(table, spark.createDataFrame([(7, "new", day + dt.timedelta(days=9), 9)], LOG), 1, ["v"], "ts", ["n"])
    home = spark.createDataFrame([(7,)], "k int").select(table.bucket().alias("b")).first()["b"]
    newest = table.newest(spark)
    assert {b for b, n in newest.items() if n == 1} == {home}
    # One version was closed by the second batch, and nothing else written to the closed ones.
    assert read_part(spark, table.root, "closed", table.schema).where("batch = 1").count() == 1

    heads = table.current(spark, only=[home])
    files = [r[0] for r in heads.select(F.input_file_name()).distinct().collect()]
    assert files and all(f"bucket={home}/" in f for f in files)
    event = spark.createDataFrame([(7, "newer", day + dt.timedelta(days=12), 9)], LOG)
    told = scd2_merge(heads, event, "k", ["v"], "ts", ["n"])
    for part in (told.current, told.closed):
        scans = [x for x in part._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
        # The buckets of current rows are all that is read of the table, closed versions have no bucket.
        assert scans and all(re.search(r"PartitionFilters: [^]]*bucket#\d+", x) for x in scans)


def test_parts_of_an_unfinished_batch_are_not_read(spark, tmp_path):
    root = f"{tmp_path}/t"
    df = spark.createDataFrame([(1,)], "a int")
    write_part(df, root, "x", 0)
    assert read_part(spark, root, "x", df.schema).count() == 0


SENT = "id int, ts timestamp_ntz, v string"


@pytest.mark.parametrize("keys", [["id", "ts"], ["id"]])
def test_first_rows_are_kept_however_late(spark, tmp_path, keys):
    at = dt.datetime(2024, 1, 1, 12)
    old = dt.datetime(2020, 1, 1)
    batches = [
        [(1, at, "a"), (2, at, "b"), (2, at, "c"), (None, at, "x"), (3, None, "y")],
        [(4, old, "late"), (1, at, "a"), (None, at, "x"), (3, None, "z")],
        [(4, old, "late"), (5, old, "later")],
    ]
    root = f"{tmp_path}/e"
    for i, rows in enumerate(batches):
        first_seen(root, spark.createDataFrame(rows, SENT), i, keys, "ts")
        first_seen(root, spark.createDataFrame(rows, SENT), i, keys, "ts")
    schema = spark.createDataFrame([], SENT).schema
    kept = rows_of(read_events(spark, root, schema), ["id", "v"])
    assert kept == sorted([(1, "a"), (2, "b"), (None, "x"), (3, "y"), (4, "late"), (5, "later")], key=repr)
    aside = rows_of(read_repeats(spark, root, schema), ["id", "v", "reason"])
    assert aside == sorted(
        [(2, "c", "in batch"), (1, "a", "stored"), (None, "x", "stored"), (3, "z", "stored"), (4, "late", "stored")], key=repr
    )
    first_seen(root, spark.createDataFrame([], SENT), 9, keys, "ts")
    assert read_events(spark, root, schema).count() == len(kept)


def test_the_merged_chain_is_built_once(spark):
    """Current and closed versions are read from what was written of the chain."""
    events = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1), 1), (1, "b", dt.datetime(2024, 1, 2), 2), (1, "c", dt.datetime(2024, 1, 3), 3)], "k int, status string, ts timestamp_ntz, n int")
    merged = scd2_merge(None, events, "k", ["status"], "ts", ["n"], write_once=True)
    for part in (merged.current, merged.closed):
        assert "Window" not in part._jdf.queryExecution().optimizedPlan().toString()
    assert [r.status for r in merged.closed.collect()] == ["a"]
    assert sorted(r.status for r in merged.current.collect()) == ["b", "c"]

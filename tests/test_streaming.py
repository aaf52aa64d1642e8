from __future__ import annotations

import datetime as dt

from chronostrata.operators.history import scd2_repair
from chronostrata.sources.tables import append_rows, read_table, versions, write_version
from chronostrata.streaming.history import run_scd2_stream, scd2_foreach_batch
from chronostrata.streaming.ingest import stream_stage

T = dt.datetime.fromisoformat
LOG = "k int, v string, ts timestamp_ntz"


def batch(spark, *rows):
    return spark.createDataFrame([(k, v, T(t)) for k, v, t in rows], LOG)


def test_stream_keeps_history_and_reports_late_rows(spark, tmp_path):
    dim, late = f"{tmp_path}/dim", f"{tmp_path}/late"
    write_version(spark.createDataFrame([], "k int, v string, hashdiff string, valid_from date, valid_to date"), dim, 0)
    apply = scd2_foreach_batch(dim, "k", ["v"], "ts", late_path=late)
    batches = [
        batch(spark, (1, "a", "2024-01-01"), (2, "x", "2024-01-01")),
        batch(spark, (1, "c", "2024-01-10"), (2, "x", "2024-01-10")),
        batch(spark, (1, "b", "2024-01-05")),
    ]
    for rows in batches:
        append_rows(rows, f"{tmp_path}/in")
        staged = stream_stage(spark, f"{tmp_path}/in", rows.schema)
        run_scd2_stream(staged, apply, f"{tmp_path}/state").awaitTermination()
    assert versions(spark, dim) == [0, 1, 2, 3]
    got = {(r.k, r.v, str(r.valid_from), r.valid_to and str(r.valid_to)) for r in read_table(spark, dim).collect()}
    assert got == {(1, "a", "2024-01-01", "2024-01-10"), (1, "c", "2024-01-10", None), (2, "x", "2024-01-01", None)}

    # A batch that comes again after a failure changes nothing.
    apply(batches[1], 1)
    assert versions(spark, dim) == [0, 1, 2, 3]

    touched = spark.read.parquet(late)
    assert {(r.k, r.v) for r in touched.collect()} == {(1, "b")}
    whole = spark.read.parquet(f"{tmp_path}/in")
    fixed = scd2_repair(read_table(spark, dim), whole, touched, "k", ["v"], "ts")
    got = {(r.v, str(r.valid_from)) for r in fixed.where("k = 1").collect()}
    assert got == {("a", "2024-01-01"), ("b", "2024-01-05"), ("c", "2024-01-10")}

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronostrata.functions import hashdiff, is_email, normalize_phone, register_hash_function
from chronostrata.operators import quality as q
from chronostrata.plans import cleaning
from chronostrata.sources.schemas import INTEGRATED, STAGING, empty_table
from chronostrata.sources.staging import read_stg_csv, stage_rows, with_load_meta
from chronostrata.sources.tables import (
    append_rows,
    read_table,
    replace_partitions,
    version_path,
    versions,
    write_history,
    write_version,
)

RUN = dt.datetime(2024, 3, 1, 8)


def test_csv_keeps_quoted_blanks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('customer_id,status,event_ts\n101,"",2024-01-01\n102,,2024-01-01\n', "utf-8")
    got = read_stg_csv(spark, str(tmp_path), STAGING["customer_status"])
    assert [tuple(r) for r in got.orderBy("customer_id").collect()] == [("101", "", "2024-01-01"), ("102", None, "2024-01-01")]
    assert {f.dataType.simpleString() for f in got.schema.fields} == {"string"}


def test_load_metadata_is_stamped_where_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "customer_id,status,event_ts,_load_id,_load_ts\n1,new,2024-01-01,b1,2024-01-01 08:00\n2,new,2024-01-01,,\n", "utf-8")
    raw = read_stg_csv(spark, str(tmp_path), [*STAGING["customer_status"], "_load_id", "_load_ts"])
    got = {r.customer_id: (r._load_id, r._load_ts) for r in with_load_meta(raw, "b9", RUN).collect()}
    assert got == {"1": ("b1", dt.datetime(2024, 1, 1, 8)), "2": ("b9", RUN)}


def test_bad_keys_are_rejected_with_a_reason(spark):
    keys = ["abc", "", None, "12\n", "99999999999", "１２", " 7", "8"]
    staged = stage_rows(spark, [(k, "2024-1-5", "1") for k in keys], STAGING["orders"], "b", RUN)
    good, bad = cleaning.clean_orders(staged)
    assert [(r.order_id, r.order_date) for r in good.collect()] == [(8, dt.date(2024, 1, 5))]
    assert bad.count() == 7 and {r.reject_reason for r in bad.collect()} == {"order_id_is_key"}
    assert cleaning.clean_orders(staged, "bigint")[0].count() == 2


def test_bad_dates_and_amounts(spark):
    staged = stage_rows(spark, [("1", d, "1") for d in ("", " ", None, "2024-13-01", "2024-01-05")], STAGING["orders"], "b", RUN)
    good, bad = cleaning.clean_orders(staged)
    assert (good.count(), bad.count()) == (1, 4)
    lines = [("1", "1", "1", "2", "10.50"), ("2", "1", "1", "-2", "10.50"), ("3", "1", "1", "2", "1,5"), ("4", "1", "1", None, "")]
    good, bad = cleaning.clean_items(stage_rows(spark, lines, STAGING["order_items"], "b", RUN))
    assert [r.order_item_id for r in good.collect()] == [1]
    reasons = {r.order_item_id: r.reject_reason for r in bad.collect()}
    assert reasons == {"2": "qty_is_number", "3": "price_is_decimal", "4": "qty_is_number,price_is_decimal"}


def test_repeated_orders_keep_the_last_load(spark):
    first = stage_rows(spark, [("1", "2024-01-01", "5")], STAGING["orders"], "b1", RUN)
    second = stage_rows(spark, [("1", "2024-01-02", "5")], STAGING["orders"], "b2", RUN + dt.timedelta(days=1))
    good, _ = cleaning.clean_orders(first.unionByName(second))
    assert [(r.order_date, r._load_id) for r in good.collect()] == [(dt.date(2024, 1, 2), "b2")]


def test_blank_event_time_takes_the_load_time(spark):
    staged = stage_rows(spark, [("1", "a@ex.com", "7", "X", " ")], STAGING["customers"], "b", RUN)
    states, _ = cleaning.customer_states(staged)
    assert states.first().eff_ts == RUN


def test_case_only_change_updates_the_snapshot(spark):
    rows = [("1", v, "7", "X", d) for v, d in (("A@ex.com", "2024-01-01"), ("a@ex.com", "2024-01-02"))]
    states, _ = cleaning.customer_states(stage_rows(spark, rows, STAGING["customers"], "b", RUN))
    assert cleaning.customer_snapshot(states).first().email == "a@ex.com"
    assert states.select(hashdiff("email")).distinct().count() == 1


def test_phone_and_email(spark):
    phones = {"8 (999) 111-22-33": "79991112233", "+7 999 111 22 33": "79991112233", "9991112233": "79991112233", "700": "700", "-": None}
    df = spark.createDataFrame(list(phones.items()), "raw string, want string")
    assert df.where(~normalize_phone("raw").eqNullSafe(F.col("want"))).count() == 0
    mails = {"a@ex.com": True, "a@ex": False, "a b@ex.com": False, "": False, "a@ex.com\n": False, "x@a-b.co.uk": True}
    df = spark.createDataFrame(list(mails.items()), "raw string, want boolean")
    assert df.where(is_email("raw") != F.col("want")).count() == 0
    assert spark.createDataFrame([(None,)], "raw string").select(is_email("raw")).first()[0] is False


def test_sql_hash_function_equals_the_expression(spark):
    register_hash_function(spark, "customer_hash", ["email", "phone", "city"])
    df = spark.createDataFrame([("b@ex.com", "700", "Москва"), (None, " 1", "")], "email string, phone string, city string")
    got = [(r[0], r[1]) for r in df.select(F.expr("customer_hash(email, phone, city)"), hashdiff("email", "phone", "city")).collect()]
    assert all(a == b for a, b in got)
    assert got[0][0] == "ad1abd114a5b2541cbe1e542ed7b2a71"


def test_versions_are_swapped_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    write_version(spark.range(3), path)
    # The new version is computed from the one it replaces.
    write_version(read_table(spark, path).where("id < 2"), path)
    assert read_table(spark, path).count() == 2 and read_table(spark, path, 0).count() == 3
    # A version without its marker is one that never finished.
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(version_path(path, 2))
    (tmp_path / "t" / "version=2" / "_SUCCESS").unlink(missing_ok=True)
    assert versions(spark, path) == [0, 1] and read_table(spark, path).count() == 2
    assert write_version(spark.range(5), path) == 2 and read_table(spark, path).count() == 5
    write_version(spark.range(7), path, version=2)
    assert read_table(spark, path).count() == 5


def test_append_and_replace_partition(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, load_date string")
    replace_partitions(rows, path, "load_date")
    replace_partitions(spark.createDataFrame([(9, "2024-01-02")], "v int, load_date string"), path, "load_date")
    assert {r.v for r in spark.read.parquet(path).collect()} == {1, 9}
    append_rows(rows.drop("load_date"), str(tmp_path / "a"))
    append_rows(rows.drop("load_date"), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4


def test_history_layout_prunes_closed_rows(spark, tmp_path):
    dim = spark.sql("SELECT id AS k, DATE '2023-01-01' AS valid_from, IF(id % 3 = 0, NULL, DATE '2024-01-01') AS valid_to FROM range(30)")
    write_history(dim, str(tmp_path / "h"), "k")
    current = read_table(spark, str(tmp_path / "h")).where("is_current = 1")
    assert current.count() == 10
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan


def test_empty_table(spark):
    assert empty_table(spark, INTEGRATED["fact_sales"]).columns == [
        "sale_id", "customer_sk", "product_sk", "date_key", "quantity", "amount"]


def test_checks_find_what_totals_hide(spark):
    dim = spark.sql("""SELECT * FROM VALUES (1, DATE '2024-01-01', NULL), (1, DATE '2024-02-01', NULL),
        (2, DATE '2024-01-01', DATE '2024-02-01'), (3, DATE '2024-01-01', DATE '2024-01-01') AS t(k, valid_from, valid_to)""")
    one = q.check_one_current(dim, "k", "d").first()
    assert (one.passed, one.actual) == (False, 3)
    order = q.check_rules(dim, "d", q.period_order()).first()
    assert (order.check, order.passed, order.actual) == ("d.period_order", False, 1)
    assert q.check_overlap(dim, "k", "d").first().actual == 1
    assert not q.check_unique(dim, ["k"], "d").first().passed
    assert q.check_fresh(dim, "valid_from", "2024-02-02", "d").first().passed
    with pytest.raises(q.QualityError, match="d.one_current: 3, expected 0"):
        q.run_gate([q.check_not_empty(dim, "d"), q.check_one_current(dim, "k", "d")])
    assert len(q.run_gate([q.check_not_empty(dim, "d"), q.check_min_versions(dim, "k", 1, 2, "d")])) == 2


def test_orphans_count_missing_keys(spark):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert q.check_orphans(facts, spark.createDataFrame([(1,)], "id int"), "k", "id", "f").first().actual == 2

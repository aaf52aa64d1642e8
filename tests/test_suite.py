"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract
from check_queries import TABLES, sorted_rows

from chronostrata.suite import ORACLES, QUERIES

SF_DIR = os.environ.get("SUITE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    found = con.execute(contract.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(names, found.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_late_sets_meet_the_stored_ones_in_many_partitions(spark):
    """Joins by key on both sides of a union, and partitions merged by their sizes, as on large tables."""
    sf_dir = "/root/testdata/sf0.01"
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000", "spark.sql.shuffle.partitions": "16",
        "spark.sql.unionOutputPartitioning": "true",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        df = contract.queries()["multi_active_late"](spark, sf_dir)
        mine = sorted_rows(df.columns, df.collect())
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    found = con.execute(contract.oracle_sql()["multi_active_late"])
    assert mine == sorted_rows([c[0] for c in found.description], found.fetchall())

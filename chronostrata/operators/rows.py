"""Row-level helpers around staging and inspection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def split_rejects(df: DataFrame, rules: Mapping[str, Column], told: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every rule, and the others with the names of the broken rules in
    `reject_reason`. A rule that gives NULL counts as broken.

    With `told`, whoever computes the good rows counts the others there as `rejected`; the verdict is then a
    column that is computed once a row, where a filter moves into the source and takes its expressions along."""
    sound = reduce(and_, [F.coalesce(rule, F.lit(False)) for rule in rules.values()])
    bad = with_reject_reason(df.where(~sound), rules)
    if told is None:
        return df.where(sound), bad
    judged = df.withColumn("_sound", sound).observe(told, F.count_if(~F.col("_sound")).alias("rejected"))
    return judged.where("_sound").drop("_sound"), bad


def with_reject_reason(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """`reject_reason` lists the broken rules; it is NULL where all hold."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("reject_reason", F.nullif(F.concat_ws(",", *broken), F.lit("")))


def row_count_label(df: DataFrame, name: str) -> DataFrame:
    """One row with a text such as `fact_sales count = 3`."""
    return df.agg(F.concat(F.lit(f"{name} count = "), F.count("*").cast("string")).alias("label"))


def preview(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def trace_load(df: DataFrame, load_id: str) -> DataFrame:
    """Rows that came with one load."""
    return df.where(F.col("_load_id") == F.lit(load_id))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("cnt")).where("cnt > 1")


def table_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and distinct keys of every table: `{name: (df, key column)}`."""
    counted = [
        df.agg(F.count("*").alias("row_cnt"), F.count_distinct(key).alias("key_cnt")).select(
            F.lit(name).alias("table_name"), "row_cnt", "key_cnt"
        )
        for name, (df, key) in tables.items()
    ]
    result = counted[0]
    for df in counted[1:]:
        result = result.unionByName(df)
    return result

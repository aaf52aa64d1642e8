"""Data-quality checks. Each returns one row `(check, passed, actual, expected)`; `run_gate`
reads the report, which has one row per check, and stops the load when one failed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.functions import as_date, is_current, to_date_lenient
from chronostrata.operators.ordered import HOT_ROWS, in_order, with_next
from chronostrata.operators.rows import duplicates


class QualityError(RuntimeError):
    """A gate found failed checks; they are listed in the message."""


def _result(df: DataFrame, name: str, expected: Column | int, passed: Column | None = None) -> DataFrame:
    """`df` has one row with `actual`."""
    wanted = expected if isinstance(expected, Column) else F.lit(expected)
    wanted = wanted.cast("long")
    ok = F.col("actual") == wanted if passed is None else passed
    return df.select(
        F.lit(name).alias("check"), ok.alias("passed"), F.col("actual").cast("long").alias("actual"),
        wanted.alias("expected"),
    )


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("actual"))


def check_rules(df: DataFrame, name: str, rules: Mapping[str, Column]) -> DataFrame:
    """Any number of row rules in one pass: a row per rule `name.rule` with the count of rows
    that break it (a rule that gives NULL is broken)."""
    broken = df.agg(
        *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"r{i}") for i, rule in enumerate(rules.values())]
    )
    pairs = [
        F.struct(F.lit(f"{name}.{rule}").alias("check"), F.col(f"r{i}").alias("actual")) for i, rule in enumerate(rules)
    ]
    rows = broken.select(F.explode(F.array(*pairs)).alias("p")).select("p.check", "p.actual")
    return rows.select(
        "check", (F.col("actual") == 0).alias("passed"), "actual", F.lit(0).cast("long").alias("expected")
    )


def not_null(*cols: str) -> dict[str, Column]:
    return {f"{c}_filled": F.col(c).isNotNull() for c in cols}


def audit_filled() -> dict[str, Column]:
    return not_null("record_source", "load_dttm")


def within_length(limits: Mapping[str, int]) -> dict[str, Column]:
    """Text limits; a missing value has no length to exceed."""
    return {f"{c}_max_{n}": F.coalesce(F.length(c) <= n, F.lit(True)) for c, n in limits.items()}


def parses_as_date(*cols: str) -> dict[str, Column]:
    return {f"{c}_is_date": F.col(c).isNull() | to_date_lenient(c).isNotNull() for c in cols}


def measure_ranges(quantity: str = "quantity", amount: str = "amount") -> dict[str, Column]:
    return {f"{quantity}_positive": F.col(quantity) > 0, f"{amount}_not_negative": F.col(amount) >= 0}


def period_order(valid_from: str = "valid_from", valid_to: str = "valid_to") -> dict[str, Column]:
    return {"period_order": is_current(valid_to) | (F.col(valid_to) > F.col(valid_from))}


def check_not_empty(df: DataFrame, name: str) -> DataFrame:
    return _result(_count(df), f"{name}.not_empty", 1, F.col("actual") > 0)


def check_same_count(df: DataFrame, expected: DataFrame, name: str) -> DataFrame:
    """Row count equals the source's. Both are counted in one aggregation."""
    tagged = df.select(F.lit(1).alias("_mine")).unionAll(expected.select(F.lit(0).alias("_mine")))
    sums = tagged.agg(F.count_if(F.col("_mine") == 1).alias("actual"), F.count_if(F.col("_mine") == 0).alias("_want"))
    return _result(sums, f"{name}.same_count", F.col("_want"))


def check_min_versions(dim: DataFrame, key: str, value: object, at_least: int, name: str) -> DataFrame:
    found = _count(dim.where(F.col(key) == F.lit(value)))
    return _result(found, f"{name}.min_versions", at_least, F.col("actual") >= at_least)


def check_one_current(dim: DataFrame, key: str, name: str, valid_to: str = "valid_to") -> DataFrame:
    """Keys that do not have exactly one open row, counted per key, so that a key with two and
    a key with none do not cancel out."""
    per_key = dim.groupBy(key).agg(F.count_if(is_current(valid_to)).alias("_open"))
    return _result(_count(per_key.where("_open <> 1")), f"{name}.one_current", 0)


def check_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return _result(_count(duplicates(df, keys)), f"{name}.unique", 0)


def check_orphans(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, name: str) -> DataFrame:
    """Facts whose key the dimension does not have. A missing key is an orphan too. Facts are
    counted per key before they meet the dimension."""
    per_key = facts.groupBy(F.col(fact_key).alias("_fact")).agg(F.count("*").alias("_rows"))
    lost = per_key.join(dim.select(F.col(dim_key).alias("_key")), F.col("_fact") == F.col("_key"), "left_anti")
    return _result(lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("actual")), f"{name}.orphans", 0)


def check_overlap(
    dim: DataFrame,
    key: str,
    name: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Versions that reach into the next one of their key, or are open though not the newest."""
    rows = with_next(in_order(dim.select(key, valid_from, valid_to), key, (valid_from, valid_to), hot_rows), {"_next": valid_from})
    bad = F.col("_next").isNotNull() & (is_current(valid_to) | (F.col("_next") < F.col(valid_to)))
    return _result(_count(rows.plain().where(bad)), f"{name}.overlap", 0)


def check_fresh(df: DataFrame, date_col: str, as_of: Column | dt.date | str, name: str, days: int = 1) -> DataFrame:
    """Rows of the day `days` before `as_of` exist."""
    day = F.date_sub(as_date(as_of), days)
    found = _count(df.where(as_date(F.col(date_col)) == day))
    return _result(found, f"{name}.fresh", 1, F.col("actual") > 0)


def report(checks: Sequence[DataFrame]) -> DataFrame:
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def run_gate(checks: Sequence[DataFrame]) -> list:
    """Run all checks as one job; raise `QualityError` if any failed."""
    rows = report(checks).collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise QualityError("; ".join(f"{r['check']}: {r['actual']}, expected {r['expected']}" for r in failed))
    return rows

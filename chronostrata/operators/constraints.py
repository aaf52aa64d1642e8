"""Keys, NOT NULL, text limits, value rules and references of a table, checked while it is written.

Row rules are counted by the write itself (`observe`), so the rows are not read again for them. Keys and
references take one more pass over the key columns of what was written, whatever their number: all of
them are tagged and grouped in one shuffle, counted in map tasks first, so a key that many rows share
arrives as a few rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronostrata.operators.quality import QualityError, not_null, within_length

REPORT = "check string, passed boolean, actual long, expected long"


@dataclass(frozen=True)
class Constraints:
    """What a table promises. `rules` are SQL conditions every row meets; `unique` lists keys (rows with a NULL in
    a key are not compared, as in SQL); `foreign` maps a column to `(table, column)` it refers to (NULL
    refers to nothing); `unique_where` names a key that holds under a condition only, such as the open rows of a
    history."""

    not_null: Sequence[str] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    rules: Mapping[str, str] = field(default_factory=dict)
    unique: Sequence[Sequence[str]] = ()
    unique_where: Mapping[str, tuple[Sequence[str], str]] = field(default_factory=dict)
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def row_rules(self) -> dict[str, Column]:
        return {
            **not_null(*self.not_null),
            **within_length(self.max_length),
            **{n: F.expr(rule) for n, rule in self.rules.items()},
        }


def observed(df: DataFrame, constraints: Constraints) -> tuple[DataFrame, Observation]:
    """`df` that counts, as it is written, its rows and the rows that break each row rule (one that gives NULL
    is broken)."""
    told = Observation()
    counts = [F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in constraints.row_rules().items()]
    return df.observe(told, F.count(F.lit(1)).alias("rows"), *counts), told


def key_counts(df: DataFrame, constraints: Constraints, parents: Mapping[str, DataFrame]) -> dict[str, int]:
    """For each key the values held by several rows, for each reference the rows whose value its table lacks."""

    def whole(rows: DataFrame, cols: Sequence[str]) -> bool:
        return len(cols) == 1 and isinstance(rows.schema[cols[0]].dataType, T.IntegralType)

    def tagged(rows: DataFrame, n: int, cols: Sequence[str], mine: int, number: bool) -> DataFrame:
        # A whole number stays one; other keys are compared as text.
        single = F.col(cols[0]) if number else F.lit(None)
        value = F.lit(None) if number else F.array(*[F.col(c).cast("string") for c in cols])
        return rows.dropna(subset=list(cols)).select(
            F.lit(n).alias("n"), single.cast("long").alias("number"), value.cast("array<string>").alias("value"),
            F.lit(mine).alias("mine"), F.lit(1 - mine).alias("known"),
        )

    parts, names, references = [], [], set()
    keys = {f"unique_{'_'.join(k)}": (k, "true") for k in constraints.unique} | dict(constraints.unique_where)
    for name, (cols, condition) in keys.items():
        parts.append(tagged(df.where(condition), len(names), cols, 1, whole(df, cols)))
        names.append(name)
    for column, (table, parent) in constraints.foreign.items():
        references.add(len(names))
        number = whole(df, [column]) and whole(parents[table], [parent])
        parts += [tagged(df, len(names), [column], 1, number), tagged(parents[table], len(names), [parent], 0, number)]
        names.append(f"{column}_in_{table}")
    if not parts:
        return {}
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    met = everything.groupBy("n", "number", "value").agg(F.sum("mine").alias("mine"), F.sum("known").alias("known"))
    repeated, lost = F.count_if(F.col("mine") > 1), F.sum(F.when(F.col("known") == 0, F.col("mine")).otherwise(0))
    # One row per constraint.
    found = {r["n"]: r for r in met.groupBy("n").agg(repeated.alias("repeated"), lost.alias("lost")).collect()}
    return {
        name: 0 if n not in found else found[n]["lost" if n in references else "repeated"] for n, name in enumerate(names)
    }


def report(
    told: Observation, written: DataFrame, name: str, constraints: Constraints, parents: Mapping[str, DataFrame]
) -> list[tuple[str, bool, int, int]]:
    """One row `(check, passed, actual, expected)` per constraint of a table that has been written."""
    counts = told.get
    broken = {rule: counts[rule] for rule in constraints.row_rules()} | key_counts(written, constraints, parents)
    return [(f"{name}.{rule}", n == 0, n, 0) for rule, n in broken.items()]


def gate(
    told: Observation, name: str, constraints: Constraints, parents: Mapping[str, DataFrame]
) -> Callable[[DataFrame], None]:
    """For `write_version`: raises `QualityError` if what was written breaks a constraint."""

    def check(written: DataFrame) -> None:
        failed = [r for r in report(told, written, name, constraints, parents) if not r[1]]
        if failed:
            raise QualityError("; ".join(f"{check}: {actual}, expected {expected}" for check, _, actual, expected in failed))

    return check


def as_table(spark: SparkSession, rows: Sequence[tuple[str, bool, int, int]]) -> DataFrame:
    return spark.createDataFrame(list(rows), REPORT)

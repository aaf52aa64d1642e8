"""Row history: slowly changing dimensions in full-rebuild, incremental and append-only form."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronostrata.functions import as_date, as_moment, differs, hashdiff, is_current
from chronostrata.operators.joins import anti, new_or_changed, semi
from chronostrata.operators.latest import last_of_day, latest_by_key
from chronostrata.operators.ordered import HOT_ROWS, change_points, in_order, last_of_moment


def scd2_backfill(
    events: DataFrame,
    key: str,
    attrs: Sequence[str],
    ts_col: str,
    tie: Sequence[str] = (),
    grain: str = "day",
    carry: Sequence[str] = (),
    previous: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Periods of unchanged `attrs` from an event log.

    grain="day": the last event of a day stands for the day; periods are dates. A key then has
    at most one row per day, so its window stays small however many events it has.
    grain="ts": every change counts; `(ts_col, *tie)` must order the events of a key totally. Of
    events of one moment the last counts, so no period is empty.
    `carry` names columns taken over from the event that opened the period, `previous` those
    whose value in the period before is added as `previous_<column>`. All windows, the one
    that settles ties of a moment included, share one shuffle and one sort; a hot key is read twice, whatever is asked.
    """
    if grain not in ("day", "ts"):
        raise ValueError(f"grain must be 'day' or 'ts', not {grain!r}")
    log = events.select(*dict.fromkeys([key, *attrs, *carry, ts_col, *tie]))
    at, order = ts_col, (ts_col, *tie)
    if grain == "day":
        log = last_of_day(log, key, ts_col, tie)
        at, order, hot_rows = "_day", ("_day",), None
    rows = in_order(log.withColumn("hashdiff", hashdiff(*attrs)), key, order, hot_rows, cut_by=1)
    if grain == "ts" and tie:
        rows = last_of_moment(rows)
    periods = change_points(rows, "hashdiff", at, {f"previous_{c}": c for c in previous})
    return periods.select(
        key, *attrs, "hashdiff", *carry, F.col(at).alias("valid_from"), F.col("_to").alias("valid_to"),
        *[f"previous_{c}" for c in previous],
    )


def _state(snapshot: DataFrame, key: str, attrs: Sequence[str], eff_col: str) -> DataFrame:
    return snapshot.select(
        key, *attrs, hashdiff(*attrs).alias("_new_hash"), as_date(F.col(eff_col)).alias("_eff")
    )


def _is_newer() -> Column:
    return (F.col("hashdiff") != F.col("_new_hash")) & (F.col("_eff") > F.col("valid_from"))


def scd2_opened(dim: DataFrame, snapshot: DataFrame, key: str, attrs: Sequence[str], eff_col: str) -> DataFrame:
    """Rows a snapshot (one row per key) opens: new keys and later changes, except a
    (key, valid_from) the dimension already holds."""
    held = dim.where(is_current()).select(F.col(key).alias("_key"), "hashdiff", "valid_from")
    joined = _state(snapshot, key, attrs, eff_col).join(held, F.col(key) == F.col("_key"), "left")
    opened = joined.where(F.col("_key").isNull() | _is_newer()).select(
        key,
        *attrs,
        F.col("_new_hash").alias("hashdiff"),
        F.col("_eff").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )
    return anti(opened, dim, [key, "valid_from"])


def scd2_kept(
    dim: DataFrame,
    snapshot: DataFrame,
    key: str,
    attrs: Sequence[str],
    eff_col: str,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """Stored rows after a snapshot: current ones that change get their end, the rest stay.

    Only current rows meet the snapshot, one row per key on either side; closed rows pass
    through without a shuffle.
    """
    updates = {"valid_to": F.when(_is_newer(), F.col("_eff"))}
    if run_ts is not None:
        now = as_moment(run_ts)
        updates["updated_at"] = F.when(_is_newer(), now).otherwise(F.col("updated_at"))
    state = _state(snapshot, key, attrs, eff_col).select(key, "_new_hash", "_eff")
    current = dim.where(is_current()).join(state, key, "left").withColumns(updates).select(*dim.columns)
    return dim.where(~is_current()).unionByName(current)


def scd2_apply(
    dim: DataFrame,
    snapshot: DataFrame,
    key: str,
    attrs: Sequence[str],
    eff_col: str,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """The whole next version of the dimension: close and open in one result, both read from
    the old version, to be published by one `write_version`. Applying the same snapshot again
    changes nothing. A change on the day the current version began, or before it, is ignored;
    `not_newer` lists such rows and `scd2_repair` takes them in.

    With `run_ts`, `created_at`/`updated_at` are kept. A dimension with surrogate keys takes
    `scd2_kept` and `scd2_opened` by themselves, to number the opened rows in between.
    """
    opened = scd2_opened(dim, snapshot, key, attrs, eff_col)
    if run_ts is not None:
        opened = stamp(opened, run_ts)
    return scd2_kept(dim, snapshot, key, attrs, eff_col, run_ts).unionByName(opened, allowMissingColumns=True)


def not_newer(dim: DataFrame, snapshot: DataFrame, key: str, attrs: Sequence[str], eff_col: str) -> DataFrame:
    """Snapshot rows whose change `scd2_apply` ignores: same day as the current version or older."""
    held = dim.where(is_current()).select(F.col(key).alias("_key"), "hashdiff", "valid_from")
    joined = snapshot.join(held, F.col(key) == F.col("_key"))
    late = (F.col("hashdiff") != hashdiff(*attrs)) & (as_date(F.col(eff_col)) <= F.col("valid_from"))
    return joined.where(late).select(*snapshot.columns)


def scd2_repair(
    dim: DataFrame,
    all_events: DataFrame,
    touched: DataFrame,
    key: str,
    attrs: Sequence[str],
    ts_col: str,
    tie: Sequence[str] = (),
    grain: str = "day",
) -> DataFrame:
    """Rebuild the history of the keys in `touched` from all their events, keep the others."""
    keys = touched.select(key).distinct()
    rebuilt = scd2_backfill(semi(all_events, keys, [key]), key, attrs, ts_col, tie, grain)
    return anti(dim, keys, [key]).unionByName(rebuilt, allowMissingColumns=True)


def scd2_append_rows(
    dim: DataFrame,
    src: DataFrame,
    key: str,
    attrs: Sequence[str],
    eff_col: str,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Versions to append to a history that is never updated (it has no `valid_to`): rows of
    new keys and of keys whose attributes differ from their newest version."""
    start = as_date(F.col(eff_col))
    if as_of is not None:
        start = F.coalesce(start, as_date(as_of))
    incoming = src.select(key, *attrs, start.alias("valid_from")).withColumn("hashdiff", hashdiff(*attrs))
    newest = append_only_current(dim, key).withColumn("hashdiff", hashdiff(*attrs))
    fresh = new_or_changed(incoming, newest, key).drop("hashdiff")
    # A change that is dated back adds its version once, however often it is sent.
    return anti(fresh, dim, [key, "valid_from"])


def append_only_current(dim: DataFrame, key: str, start: str = "valid_from") -> DataFrame:
    """The newest version of each key; of several from one day the one with the greatest hash."""
    return latest_by_key(dim, key, [F.desc(start), F.desc(F.xxhash64(*dim.columns))])


def scd0(dim: DataFrame, src: DataFrame, key: str, ts_col: str) -> DataFrame:
    """First value wins for ever: only unknown keys are added, with their earliest row."""
    first = latest_by_key(src, key, [F.asc(ts_col)]).select(*dim.columns)
    return dim.unionByName(anti(first, dim, [key]))


def scd1(dim: DataFrame, src: DataFrame, key: str, ts_col: str) -> DataFrame:
    """Newest source row replaces the stored one; history is not kept."""
    both = src.select(*dim.columns).withColumn("_src", F.lit(1)).unionByName(dim.withColumn("_src", F.lit(0)))
    return latest_by_key(both, key, [F.desc("_src"), F.desc(ts_col)]).drop("_src")


def scd3(dim: DataFrame, src: DataFrame, key: str, attr: str, ts_col: str) -> DataFrame:
    """`attr` with one step of history in `previous_<attr>` and `<attr>_change_date`.
    `dim` has the key, the attribute and those two columns."""
    previous, changed_on = f"previous_{attr}", f"{attr}_change_date"
    newest = latest_by_key(src, key, [F.desc(ts_col)]).select(
        key, F.col(attr).alias("_new"), as_date(F.col(ts_col)).alias("_on"), F.lit(True).alias("_sent")
    )
    stored = dim.withColumn("_stored", F.lit(True))
    both = stored.join(newest, key, "full")
    changed = F.col("_stored") & F.col("_sent") & differs(attr, "_new")
    return both.select(
        key,
        F.when(F.col("_sent"), F.col("_new")).otherwise(F.col(attr)).alias(attr),
        F.when(changed, F.col(attr)).otherwise(F.col(previous)).alias(previous),
        F.when(changed, F.col("_on")).otherwise(F.col(changed_on)).alias(changed_on),
    )


def scd4(
    current: DataFrame, history: DataFrame, src: DataFrame, key: str, attrs: Sequence[str], ts_col: str
) -> tuple[DataFrame, DataFrame]:
    """Current values in one table, all versions in another. `history` is append-only with a
    `valid_from`; returns both next states."""
    newest = latest_by_key(src, key, [F.desc(ts_col)])
    added = scd2_append_rows(history, newest, key, attrs, ts_col)
    return scd1(current, src, key, ts_col), history.unionByName(added.select(*history.columns))


def scd5(current: DataFrame, history: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """History rows next to the current value of each attribute (`current_<attr>`)."""
    now = current.select(key, *[F.col(a).alias(f"current_{a}") for a in attrs])
    return history.join(now, key, "left")


def scd6(
    events: DataFrame,
    key: str,
    attr: str,
    ts_col: str,
    tie: Sequence[str] = (),
    grain: str = "day",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Periods of `attr` with its previous and its current value in every row."""
    periods = scd2_backfill(events, key, [attr], ts_col, tie, grain, previous=[attr], hot_rows=hot_rows)
    now = f"current_{attr}"
    if grain == "day":
        whole = Window.partitionBy(key).orderBy("valid_from")
        whole = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return periods.withColumn(now, F.last(attr).over(whole))
    # A key may have any number of periods here, but only one open.
    return periods.join(periods.where(is_current()).select(key, F.col(attr).alias(now)), key)


def stamp(df: DataFrame, run_ts: dt.datetime, columns: Sequence[str] = ("created_at", "updated_at")) -> DataFrame:
    """Technical timestamps; they take no part in comparing versions."""
    value: Column = as_moment(run_ts)
    return df.withColumns({c: value for c in columns})

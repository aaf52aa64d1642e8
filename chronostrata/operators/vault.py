"""Hubs, links, satellites and the tables built on them. Load functions return the rows to
append; nothing stored is rewritten. Pass `None` for a table that does not exist yet."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.fixed_values import ACTIVE_DAYS, RECENT_SPEND_DAYS
from chronostrata.functions import as_date, differs, hash_key, hashdiff, in_last_days
from chronostrata.operators.joins import anti, expand_days, semi
from chronostrata.operators.latest import latest_by_key
from chronostrata.operators.ordered import HOT_ROWS, carry_all, carry_last, in_order, last_of_moment, with_next, with_prev

SOURCE = "record_source"
LOADED = "load_dttm"


def _first_seen(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the source and time of its earliest arrival."""
    arrival = F.min(F.struct(LOADED, SOURCE)).alias("_arrival")
    return rows.groupBy(*keys).agg(arrival).select(
        *keys, F.col("_arrival")[SOURCE].alias(SOURCE), F.col("_arrival")[LOADED].alias(LOADED)
    )


def _not_stored(rows: DataFrame, stored: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    return rows if stored is None else anti(rows, stored, keys)


def hub_load(hub: DataFrame | None, src: DataFrame, bk: str, hk: str) -> DataFrame:
    """New business keys of `src` (columns `bk`, record_source, load_dttm)."""
    keyed = src.where(F.col(bk).isNotNull()).select(hash_key(bk).alias(hk), bk, SOURCE, LOADED)
    # Two spellings of one key share a hash; the hub keeps the smaller one.
    arrival = F.min(F.struct(LOADED, SOURCE)).alias("_arrival")
    rows = keyed.groupBy(hk).agg(F.min(bk).alias(bk), arrival).select(
        hk, bk, F.col("_arrival")[SOURCE].alias(SOURCE), F.col("_arrival")[LOADED].alias(LOADED)
    )
    return _not_stored(rows, hub, [hk])


def link_load(link: DataFrame | None, src: DataFrame, hk: str, parts: Mapping[str, str]) -> DataFrame:
    """New relations: `parts` maps each hub hash key column to its business key column in `src`. Rows
    that lack a business key belong to no hub; `link_rejects` returns them."""
    keyed = src.where(_complete(parts)).select(
        hash_key(*parts.values()).alias(hk), *[hash_key(b).alias(h) for h, b in parts.items()], SOURCE, LOADED
    )
    return _not_stored(_first_seen(keyed, [hk, *parts]), link, [hk])


def link_rejects(src: DataFrame, parts: Mapping[str, str]) -> DataFrame:
    """Rows of `src` that make no link because a business key is missing."""
    return src.where(~_complete(parts))


def _complete(parts: Mapping[str, str]) -> Column:
    return functools.reduce(Column.__and__, [F.col(b).isNotNull() for b in parts.values()])


def sat_late(sat: DataFrame, src: DataFrame, hk: str, attrs: Sequence[str]) -> DataFrame:
    """Rows of `src` that `sat_load` leaves out because a later version is stored, but that are no replay:
    no stored version of their load time has their attributes. For a repair or a reject table."""
    late = behind(sat, src, hk)
    known = effectivity(sat, hk).select(
        F.col(hk).alias("_key"), F.col("hashdiff").alias("_stored"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to")
    )
    told = late.withColumn("_hash", hashdiff(*attrs))
    during = (F.col(LOADED) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(LOADED) < F.col("_to")))
    same = (F.col(hk) == F.col("_key")) & (F.col("_hash") == F.col("_stored")) & during
    return told.join(known, same, "left_anti").drop("_hash")


def sat_load(
    sat: DataFrame | None,
    src: DataFrame,
    hk: str,
    attrs: Sequence[str],
    tie: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Rows of `src` whose attributes differ from the version before them, the stored one for
    the first row of a batch. `(load_dttm, *tie)` orders the rows of a key totally; of one load time
    the last row counts. A row not later than the key's newest stored version is skipped: it
    is a replay, or one of the rows `sat_late` returns.

    The join and the window share one shuffle of the batch.
    """
    incoming = src.select(hk, hashdiff(*attrs).alias("hashdiff"), *attrs, SOURCE, LOADED, *tie)
    stored_hash = F.lit(None).cast("string")
    if sat is not None:
        newest = latest_by_key(sat, hk, [F.desc(LOADED)]).select(
            F.col(hk).alias("_key"), F.col("hashdiff").alias("_stored"), F.col(LOADED).alias("_since")
        )
        incoming = incoming.join(newest, F.col(hk) == F.col("_key"), "left").where(_is_later())
        stored_hash = F.col("_stored")
    rows = in_order(incoming, hk, (LOADED, *tie), hot_rows, counted=src, cut_by=1)
    if tie:
        rows = last_of_moment(rows)
    told = with_prev(rows, {"_before": "hashdiff"}).plain()
    changed = told.where(differs("hashdiff", F.coalesce(F.col("_before"), stored_hash)))
    return changed.select(hk, "hashdiff", *attrs, SOURCE, LOADED)


def behind(sat: DataFrame, src: DataFrame, hk: str) -> DataFrame:
    """Rows of `src` not later than the newest stored version of their key: what a load leaves out, replays included.
    A repair wants all of them, since a row that only confirmed the stored version ends a late one before it."""
    newest = sat.groupBy(hk).agg(F.max(LOADED).alias("_since"))
    return src.join(newest, hk).where(F.col(LOADED) <= F.col("_since")).drop("_since")


def sat_repair(
    sat: DataFrame, late: DataFrame, hk: str, attrs: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Rows to append so that the chain takes in `late` rows (`behind`) at their own load time; `sat_net` reads
    the result. `is_void` is false for a late version that differs from the one before it, and true for a
    compensating row: a stored version that now repeats the one before it.

    Only keys with late rows are chained again. What a source said between versions, and repeated, is not stored, so
    it cannot come back; `scd2_repair` rebuilds from all events where they are kept. At a load time that is
    stored already the stored version stays.
    """
    net = sat_net(sat, hk)
    keys = late.select(hk).distinct()
    columns = [hk, "hashdiff", *attrs, SOURCE, LOADED]
    incoming = late.withColumn("hashdiff", hashdiff(*attrs)).select(*columns).distinct()
    both = semi(net, keys, [hk]).select(*columns, F.lit(1).alias("_stored")).unionByName(incoming.withColumn("_stored", F.lit(0)))
    rows = last_of_moment(in_order(both, hk, (LOADED, "_stored", "hashdiff"), hot_rows, cut_by=1))
    told = with_prev(rows, {"_before": "hashdiff"}).plain()
    opens = differs("hashdiff", "_before")
    # A late version is added where it opens one; a stored one is voided where it no longer does.
    return told.where(opens == (F.col("_stored") == 0)).select(*columns, (F.col("_stored") == 1).alias("is_void"))


def sat_net(sat: DataFrame, hk: str) -> DataFrame:
    """Versions of a repaired satellite that count: those without a compensating row. A satellite that was never
    repaired has no `is_void` and is returned as it is."""
    if "is_void" not in sat.columns:
        return sat
    voided = sat.where("is_void").select(hk, LOADED)
    return anti(sat.where("NOT coalesce(is_void, false)"), voided, [hk, LOADED]).drop("is_void")


def multi_active_late(sat: DataFrame, src: DataFrame, hk: str, attrs: Sequence[str]) -> DataFrame:
    """Rows of `src` that `multi_active_load` leaves out: sets not later than the newest stored one, except
    replays, whose set is the one in force at their time."""
    late = behind(sat, src, hk)
    keys = late.select(hk).distinct()
    known = _sets(semi(sat, keys, [hk]), hk, attrs).withColumn("_late", F.lit(0))
    asked = _sets(late, hk, attrs).withColumn("_late", F.lit(1))
    nothing = F.lit(None).cast(known.schema["_set"].dataType)
    both = known.withColumn("_state", F.col("_set")).unionByName(asked.withColumn("_state", nothing))
    rows = carry_last(in_order(both, hk, (LOADED, "_late")), "_state", "_valid").plain()
    first_time = rows.where((F.col("_late") == 1) & differs("_set", "_valid"))
    return semi(late, first_time, [hk, LOADED])


def multi_active_repair(
    sat: DataFrame, late: DataFrame, hk: str, attrs: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """`sat_repair` for sets: whole late sets that differ from the set before them, and compensating rows
    (`is_void`) for the members of stored sets that now repeat it. `sat_net` reads the result."""
    net = sat_net(sat, hk)
    keys = late.select(hk).distinct()
    members = late.groupBy(hk, LOADED, *attrs).agg(F.min(SOURCE).alias(SOURCE))
    stored = semi(net, keys, [hk])
    sets = _sets(stored, hk, attrs).withColumn("_stored", F.lit(1)).unionByName(_sets(members, hk, attrs).withColumn("_stored", F.lit(0)))
    rows = last_of_moment(in_order(sets, hk, (LOADED, "_stored"), hot_rows, cut_by=1))
    told = with_prev(rows, {"_before": "_set"}).plain()
    opens = differs("_set", "_before")
    added = semi(members, told.where(opens & (F.col("_stored") == 0)), [hk, LOADED]).withColumn("is_void", F.lit(False))
    gone = semi(stored, told.where(~opens & (F.col("_stored") == 1)), [hk, LOADED]).withColumn("is_void", F.lit(True))
    columns = [hk, *attrs, SOURCE, LOADED, "is_void"]
    return added.select(*columns).unionByName(gone.select(*columns))


def _sets(members: DataFrame, hk: str, attrs: Sequence[str]) -> DataFrame:
    """(hk, load_dttm, _set): the size of each set of values and sums of hashes of its members, which add up
    across map tasks."""
    digest = hashdiff(*attrs)
    halves = [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 17)]
    once = members.select(hk, LOADED, *attrs).distinct()
    return once.groupBy(hk, LOADED).agg(
        F.struct(F.count("*").alias("n"), F.sum(halves[0]).alias("a"), F.sum(halves[1]).alias("b")).alias("_set")
    )


def _is_later() -> Column:
    return F.col("_since").isNull() | (F.col(LOADED) > F.col("_since"))


def effectivity(sat: DataFrame, hk: str, start: str = LOADED, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Satellite versions as periods: `valid_from`/`valid_to` from the load times."""
    rows = with_next(in_order(sat, hk, start, hot_rows), {"valid_to": start}).plain()
    return rows.withColumn("valid_from", F.col(start))


def multi_active_load(
    sat: DataFrame | None,
    src: DataFrame,
    hk: str,
    attrs: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Several values of a key are valid at once. When the set of values of a (key, load_dttm)
    differs from the set before it, the whole set is added. Sets not later than the stored one
    are replays, or late: `multi_active_late` returns those and
    `multi_active_repair` takes them in.

    Sets are compared by size and by sums of hashes of their members, which add up across map
    tasks, so no set is ever gathered in one place.
    """
    members = src.groupBy(hk, LOADED, *attrs).agg(F.min(SOURCE).alias(SOURCE)).withColumn("_batch", F.lit(1))
    everything = members
    if sat is not None:
        newest = sat.groupBy(hk).agg(F.max(LOADED).alias("_since"))
        members = members.join(newest, hk, "left").where(_is_later()).drop("_since")
        stored = semi(sat, newest.withColumnRenamed("_since", LOADED), [hk, LOADED])
        stored = stored.select(hk, LOADED, *attrs, SOURCE).withColumn("_batch", F.lit(0))
        everything = members.unionByName(stored)
    digest = hashdiff(*attrs)
    halves = [F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 17)]
    sets = everything.groupBy(hk, "_batch", LOADED).agg(
        F.struct(F.count("*").alias("n"), F.sum(halves[0]).alias("a"), F.sum(halves[1]).alias("b")).alias("_set")
    )
    ordered = in_order(sets, hk, ("_batch", LOADED), hot_rows, counted=src)
    rows = with_prev(ordered, {"_before": "_set"}).plain()
    changed = rows.where((F.col("_batch") == 1) & differs("_set", "_before"))
    return semi(members, changed, [hk, LOADED]).select(hk, *attrs, SOURCE, LOADED)


def txn_sat_load(sat: DataFrame | None, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Event log on a hub or link: one row per event key, known events are skipped."""
    return _not_stored(latest_by_key(src, keys, [F.asc(LOADED)]), sat, keys)


def pit_daily(
    hub: DataFrame,
    sats: Mapping[str, DataFrame],
    hk: str,
    date_from: Column | dt.date | str,
    date_to: Column | dt.date | str,
) -> DataFrame:
    """For each (key, day) the `load_dttm` of the version of every satellite in force at the end
    of that day; days run from the key's first load. Columns: hk, as_of_date and `<name>_load_dttm`.

    Points to load_dttm, not to the hash: a value that comes back has one hash but two versions. The shuffles move
    changes, one row per key and day that has one, however many days are asked for.
    """
    pointers = [f"{name}_{LOADED}" for name in sats]

    def points(df: DataFrame, filled: str | None) -> DataFrame:
        empty = F.lit(None).cast("timestamp_ntz")
        # What came before the first day asked for counts from that day on; the newest load time is the newest version.
        day = F.greatest(as_date(F.col(LOADED)), as_date(date_from)).alias("_day")
        return df.select(hk, day, *[(F.col(LOADED) if p == filled else empty).alias(p) for p in pointers])

    everything = points(hub, None)
    for name, sat in sats.items():
        everything = everything.unionByName(points(sat, f"{name}_{LOADED}"))
    # One row per key and day on which something changes; the last of a day counts.
    changes = everything.where(F.col("_day") <= as_date(date_to)).groupBy(hk, "_day").agg(*[F.max(p).alias(p) for p in pointers])
    rows = carry_all(in_order(changes, hk, "_day", None), {f"_{p}": p for p in pointers})
    periods = with_next(rows, {"valid_to": "_day"}).plain()
    # Days are made last, from the periods where they are.
    days = expand_days(periods, date_from, date_to, valid_from="_day", name="as_of_date")
    return days.select(hk, "as_of_date", *[F.col(f"_{p}").alias(p) for p in pointers])


def read_pit(
    facts: DataFrame,
    pit: DataFrame,
    sats: Mapping[str, tuple[DataFrame, Sequence[str]]],
    hk: str,
    date_col: str,
) -> DataFrame:
    """Facts with satellite attributes of their day, by equality joins only."""
    result = facts.join(pit.withColumnRenamed("as_of_date", date_col), [hk, date_col])
    for name, (sat, attrs) in sats.items():
        pointer = f"{name}_{LOADED}"
        version = sat.select(hk, F.col(LOADED).alias(pointer), *attrs)
        result = result.join(version, [hk, pointer], "left")
    return result.drop(*[f"{name}_{LOADED}" for name in sats])


def bridge(
    start: DataFrame, links: Sequence[tuple[DataFrame, str, str]], end: DataFrame, dedupe_hops: bool = True
) -> DataFrame:
    """Distinct (start, end) pairs along a chain of links.

    `start` and `end` are one-column key tables; each link is `(df, from column, to column)`.
    Pairs are made distinct after every hop: what is carried on is at most the number of
    reachable (start, node) pairs, not the number of paths.
    """
    first, last = start.columns[0], end.columns[0]
    paths = start.select(first, F.col(first).alias("_at"))
    for link, source, target in links:
        hop = link.select(F.col(source).alias("_at"), F.col(target).alias("_to"))
        paths = paths.join(hop, "_at").select(first, F.col("_to").alias("_at"))
        if dedupe_hops:
            paths = paths.distinct()
    pairs = semi(paths.withColumnRenamed("_at", last), end, [last])
    return pairs if dedupe_hops else pairs.distinct()


def bridge_spend(
    hub: DataFrame,
    pairs: DataFrame,
    transactions: DataFrame,
    hk: str,
    trx: str,
    bk: str,
    as_of: Column | dt.date | str,
    days: int = RECENT_SPEND_DAYS,
) -> DataFrame:
    """Amount per business key over the last `days` days, through the bridge. `transactions`
    has `trx`, `trx_date` and `amount`."""
    recent = transactions.where(in_last_days("trx_date", as_of, days)).select(trx, "amount")
    spent = pairs.join(recent, trx).groupBy(hk).agg(F.sum("amount").alias("total_amount"))
    named = spent.join(hub.select(hk, bk), hk)
    return named.groupBy(bk).agg(F.sum("total_amount").cast("decimal(18,2)").alias("total_amount"))


def active_flag(
    orders: DataFrame, key: str, date_col: str, as_of: Column | dt.date | str, days: int = ACTIVE_DAYS
) -> DataFrame:
    """Whether a key had an order within the last `days` days."""
    day = as_date(F.col(date_col))
    last = orders.where(day <= as_date(as_of)).groupBy(key).agg(F.max(day).alias("_last"))
    return last.select(key, in_last_days("_last", as_of, days).alias(f"is_active_{days}d"))


def final_status(
    events: DataFrame, key: str, status: str, ts_col: str, ranking: Sequence[str], name: str = "final_status"
) -> DataFrame:
    """The last status of a key; of several at one moment, the one furthest in `ranking`."""
    rank = F.array_position(F.array(*[F.lit(s) for s in ranking]), F.col(status))
    newest = latest_by_key(events, key, [F.desc(ts_col), rank.desc(), F.asc(status)])
    return newest.select(key, F.col(status).alias(name))


def pick_by_priority(sources: Sequence[DataFrame], key: str, cols: Sequence[str]) -> DataFrame:
    """One row per key; each column from the first source (in the order given) that fills it.
    One aggregation over all sources, whatever their number."""
    ranked = [df.select(key, *cols).withColumn("_rank", F.lit(i)) for i, df in enumerate(sources)]
    everything = ranked[0]
    for df in ranked[1:]:
        everything = everything.unionByName(df)
    # NULL ranks are skipped by min, so a source without the value does not take part.
    picks = [F.min(F.when(F.col(c).isNotNull(), F.struct("_rank", c)))[c].alias(c) for c in cols]
    return everything.groupBy(key).agg(*picks)


def conform_sources(sources: Mapping[str, tuple[DataFrame, Column]], name: str, cols: Sequence[str]) -> DataFrame:
    """Rows of one entity from several systems under one business key `name`, with their
    `record_source`; `sources` maps the system to its rows and its key rule."""
    conformed = [
        df.select(rule.alias(name), F.lit(source).alias(SOURCE), *cols) for source, (df, rule) in sources.items()
    ]
    everything = conformed[0]
    for df in conformed[1:]:
        everything = everything.unionByName(df)
    return everything


def customer_flags(
    orders: DataFrame,
    key: str,
    date_col: str,
    amount_col: str,
    as_of: Column | dt.date | str,
    vip_from: float,
    days: int = ACTIVE_DAYS,
) -> DataFrame:
    """Lifetime value, VIP flag and activity per key in one aggregation."""
    day = as_date(F.col(date_col))
    active = F.max(in_last_days(day, as_of, days) & (day <= as_date(as_of)))
    total = F.sum(amount_col).cast("decimal(18,2)")
    return orders.groupBy(key).agg(
        total.alias("lifetime_value"),
        (total >= F.lit(vip_from)).alias("is_vip"),
        active.alias(f"is_active_{days}d"),
    )


def flat_customer(
    hub: DataFrame,
    sats: Mapping[str, tuple[DataFrame, Sequence[str]]],
    flags: DataFrame,
    hk: str,
    bk: str,
) -> DataFrame:
    """One row per hub key with the newest attributes of each satellite (`<attr>_current`) and
    the flags table joined by business key."""
    result = hub.select(hk, bk)
    for sat, attrs in sats.values():
        newest = latest_by_key(sat, hk, [F.desc(LOADED)])
        result = result.join(newest.select(hk, *[F.col(a).alias(f"{a}_current") for a in attrs]), hk, "left")
    return result.join(flags, bk, "left")

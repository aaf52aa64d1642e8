"""Events delivered more than once, and any amount of time late: each key is kept once, and none is lost.

A watermark bounds the state of Spark's own deduplication by leaving out what is older, repeats and first-time rows
alike. Here the state is the table of events itself, in places of the day an event belongs to (or of the
key's hash, where the same key may come with another time). A batch looks up the keys of the places its rows
fall in and of no others: the last few days for most, an old day for what comes late. So the look-up is exact
behind any watermark, and grows with the places a batch touches, not with the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronostrata.functions import as_date
from chronostrata.operators.latest import latest_by_key
from chronostrata.sources.batches import commit, committed, read_part, write_part

EVENTS, REPEATS, PLACE = "events", "repeats", "place"
KEY_PLACES = 1024


def place_of(keys: Sequence[str], ts_col: str) -> Column:
    """Where rows that may repeat each other meet: their day if the time is part of the key, else a part of the
    key's hash. Text, so that a missing day is a place too."""
    if ts_col in keys:
        return F.coalesce(as_date(F.col(ts_col)).cast("string"), F.lit("none"))
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_PLACES)).cast("string")


def first_seen(root: str, batch: DataFrame, number: int, keys: Sequence[str], ts_col: str) -> None:
    """Append the rows of a batch whose key is new to `<root>/events`, and the others to `<root>/repeats` with the
    `reason`: `in batch` for the further rows of a key in one batch (of which the least counts), `stored` for keys
    that an earlier batch brought. NULL is a value in a key."""
    spark = batch.sparkSession
    if number in committed(spark, root):
        return
    placed = batch.withColumn(PLACE, place_of(keys, ts_col)).persist()
    try:
        # At most one row per day or part of the hash reaches the driver.
        places = sorted(r[PLACE] for r in placed.select(PLACE).distinct().collect())
        place = T.StructField(PLACE, T.StringType())
        fields = T.StructType([*[batch.schema[k] for k in keys], place])
        stored = read_part(spark, root, EVENTS, fields, before=number).where(F.col(PLACE).isin(places))
        known = stored.select(*[F.col(c).alias(f"_{c}") for c in (PLACE, *keys)])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (PLACE, *keys)]
        order = [F.col(c) for c in batch.columns if c not in keys]
        ranked = latest_by_key(placed, [PLACE, *keys], order or [F.lit(0)])
        new = ranked.join(known, same, "left_anti")
        write_part(new.repartition(PLACE, F.pmod(F.xxhash64(*keys), F.lit(8))), root, EVENTS, number, [PLACE])
        mine = spark.read.schema(T.StructType([*batch.schema, place])).parquet(f"{root}/{EVENTS}/batch={number}")
        write_part(_repeats(placed, mine, keys).select(*batch.columns, "reason"), root, REPEATS, number)
        commit(spark.createDataFrame([(p,) for p in places], f"{PLACE} string"), root, number)
    finally:
        placed.unpersist()


def _repeats(placed: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch beyond those kept of it, one for one."""
    new = kept.select(*[F.col(c).alias(f"_{c}") for c in (PLACE, *keys)], F.lit(True).alias("_new"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (PLACE, *keys)]
    counts = placed.groupBy(*placed.columns).agg(F.count("*").alias("_n"))
    held = kept.groupBy(*placed.columns).agg(F.count("*").alias("_kept"))
    equal = [counts[c].eqNullSafe(held[c]) for c in placed.columns]
    rest = counts.join(held, equal, "left").select(*[counts[c] for c in placed.columns], (F.col("_n") - F.coalesce("_kept", F.lit(0))).alias("_n"))
    told = rest.where("_n > 0").withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    reason = F.when(F.col("_new"), "in batch").otherwise("stored")
    return told.join(new, same, "left").withColumn("reason", reason)


def first_seen_foreach_batch(root: str, keys: Sequence[str], ts_col: str) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`; a batch that comes again after a failure is done again or left alone."""

    def apply(batch: DataFrame, number: int) -> None:
        first_seen(root, batch, number, keys, ts_col)

    return apply


def read_events(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All events kept."""
    return read_part(spark, root, EVENTS, schema).select(*schema.names)


def read_repeats(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All rows set aside, with their `reason`."""
    whole = T.StructType([*schema, T.StructField("reason", T.StringType())])
    return read_part(spark, root, REPEATS, whole).select(*whole.names)

"""A history laid out for increments: the last versions of all keys in buckets of the key's hash, older ones apart.

A batch reads and writes the buckets its keys fall in and adds what it closes; no closed version is
read, moved or written again. Parts under the root, each by batch (`sources.batches`):

    current   last two versions per key, by bucket; of a bucket its newest batch counts
    closed    versions that ended, each written once
    rebuilt   keys whose history was built anew: their closed versions of earlier batches no longer count
    commits   the buckets the batch wrote

Buckets are written as new folders, not overwritten in place: a partition overwrite of plain files deletes the
old folder before it moves the new one in, and a driver lost in between would take the bucket with it.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronostrata.sources.batches import BATCH, commit, commits, read_part, write_part

BUCKET = "bucket"
CURRENT, CLOSED, REBUILT = "current", "closed", "rebuilt"
_TOUCHED = T.StructType([T.StructField(BUCKET, T.IntegerType())])


@dataclass(frozen=True)
class BucketedHistory:
    """Where a history is, its key, the columns of its current rows and the number of buckets."""

    root: str
    key: str
    schema: T.StructType
    buckets: int = 256

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def newest(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """The batch that wrote each bucket last. At most `buckets` rows reach the driver."""
        told = commits(spark, self.root, _TOUCHED, before).groupBy(BUCKET).agg(F.max(BATCH).alias(BATCH))
        return {r[BUCKET]: r[BATCH] for r in told.collect()}

    def current(self, spark: SparkSession, before: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """Current rows of all buckets or of some; other folders are not listed as input."""
        wanted = None if only is None else set(only)
        by_batch: dict[int, list[int]] = {}
        for bucket, batch in self.newest(spark, before).items():
            if wanted is None or bucket in wanted:
                by_batch.setdefault(batch, []).append(bucket)
        rows = spark.createDataFrame([], self.schema)
        if by_batch:
            held = F.lit(False)
            for batch, buckets in sorted(by_batch.items()):
                held = held | ((F.col(BATCH) == batch) & F.col(BUCKET).isin(sorted(buckets)))
            known = T.StructType([*self.schema, *[T.StructField(c, T.IntegerType()) for c in (BATCH, BUCKET)]])
            rows = spark.read.schema(known).parquet(f"{self.root}/{CURRENT}").where(held)
        return rows.select(*self.schema.names)

    def closed(self, spark: SparkSession, columns: list[str], before: int | None = None) -> DataFrame:
        fields = T.StructType([self.schema[c] for c in columns])
        rows = read_part(spark, self.root, CLOSED, fields, before)
        keys = read_part(spark, self.root, REBUILT, T.StructType([self.schema[self.key]]), before)
        since = keys.groupBy(F.col(self.key).alias("_key")).agg(F.max(BATCH).alias("_since"))
        old = (F.col(self.key) == F.col("_key")) & (F.col(BATCH) < F.col("_since"))
        return rows.join(since, old, "left_anti").select(*columns)

    def read(self, spark: SparkSession, columns: list[str], before: int | None = None) -> DataFrame:
        """The whole history."""
        return self.closed(spark, columns, before).unionByName(self.current(spark, before).select(*columns))

    def write(
        self, batch: int, current: DataFrame, closed: DataFrame, touched: Iterable[int], rebuilt: DataFrame | None = None
    ) -> None:
        """All parts of a batch. `current` holds the rows of all keys in the `touched` buckets."""
        spark = current.sparkSession
        # One writer per bucket: a bucket holds two rows per key at most.
        write_part(current.withColumn(BUCKET, self.bucket()).repartition(BUCKET), self.root, CURRENT, batch, [BUCKET])
        write_part(closed, self.root, CLOSED, batch)
        no_keys = spark.createDataFrame([], T.StructType([self.schema[self.key]]))
        write_part(no_keys if rebuilt is None else rebuilt.select(self.key), self.root, REBUILT, batch)
        commit(spark.createDataFrame([(b,) for b in sorted(touched)], _TOUCHED), self.root, batch)

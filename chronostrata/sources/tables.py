"""Writing layers as parquet. A table is a folder of versions `version=<n>`; the newest one
with Spark's `_SUCCESS` marker is the table. A job that dies half-way leaves the table as it
was, and a reader never sees half of a refresh."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_VERSION = re.compile(r"version=(\d+)$")
_MARKS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished versions, ascending."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop) or []
    numbers = (_VERSION.search(status.getPath().getParent().toString()) for status in found)
    return sorted(int(n.group(1)) for n in numbers if n)


def version_path(path: str, version: int) -> str:
    return f"{path}/version={version}"


def write_version(
    df: DataFrame,
    path: str,
    version: int | None = None,
    partition_by: Sequence[str] = (),
    gate: Callable[[DataFrame], None] | None = None,
) -> int:
    """Full refresh: write `df`, which may read the table itself, as the next version. With a
    `version` given (a batch id, say), one that is already finished is left as it is.

    A `gate` is called with the rows as written before the version counts; if it raises, the table stays at
    its version before and the next write takes the same number again."""
    spark = df.sparkSession
    done = versions(spark, path)
    if version is None:
        version = done[-1] + 1 if done else 0
    if version not in done:
        # A dynamic overwrite would leave no marker.
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by)
        place = version_path(path, version)
        if gate is None:
            writer.parquet(place)
        else:
            writer.option(_MARKS, "false").parquet(place)
            gate(spark.read.schema(df.schema).parquet(place))
            _mark(spark, place)
    return version


def _mark(spark: SparkSession, place: str) -> None:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, True).close()


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest finished version, or the one asked for."""
    if version is None:
        done = versions(spark, path)
        if not done:
            raise FileNotFoundError(f"no finished version under {path}")
        version = done[-1]
    return spark.read.parquet(version_path(path, version))


def append_rows(df: DataFrame, path: str) -> None:
    """Append to staging or to an append-only history; nothing stored is rewritten."""
    df.write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace just the partitions (load dates) found in `df`."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def write_history(
    df: DataFrame,
    path: str,
    key: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    version: int | None = None,
) -> int:
    """A history table laid out for its readers: current rows in a folder of their own
    (`is_current=1`) and files in ranges of the key, so that a filter on either skips files by
    partition or by the minimum and maximum parquet keeps. A key with very many versions takes
    several ranges."""
    laid_out = df.withColumn("is_current", F.col(valid_to).isNull().cast("int"))
    order = ["is_current", key, valid_from]
    laid_out = laid_out.repartitionByRange(*order).sortWithinPartitions(*order)
    return write_version(laid_out, path, version, partition_by=["is_current"])

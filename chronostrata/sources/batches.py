"""Tables that are written batch by batch. Batch `n` of a part is the folder `<root>/<part>/batch=<n>`, and
nothing else writes there: a batch that is run again overwrites its own folders and reads only what
was committed before it. What it wrote counts once its commit, written last, is there, so all parts of a batch
appear together and a reader never sees half of one."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "commits"
BATCH = "batch"

_BATCH = re.compile(r"batch=(\d+)$")


def batch_path(root: str, part: str, batch: int) -> str:
    return f"{root}/{part}/{BATCH}={batch}"


def committed(spark: SparkSession, root: str, before: int | None = None) -> list[int]:
    """Numbers of the finished batches, ascending; with `before`, those of lesser number."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{COMMITS}/{BATCH}=*/_SUCCESS")
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop) or []
    names = (_BATCH.search(status.getPath().getParent().toString()) for status in found)
    numbers = sorted(int(n.group(1)) for n in names if n)
    return [n for n in numbers if before is None or n < before]


def write_part(df: DataFrame, root: str, part: str, batch: int, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(batch_path(root, part, batch))


def commit(told: DataFrame, root: str, batch: int) -> None:
    """Finish a batch; `told` is a small table of facts about it, read back by `commits`."""
    write_part(told, root, COMMITS, batch)


def read_part(spark: SparkSession, root: str, part: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """All committed batches of a part, with their number in `batch`."""
    numbers = committed(spark, root, before)
    known = T.StructType([*[f for f in schema if f.name != BATCH], T.StructField(BATCH, T.IntegerType())])
    if not numbers:
        return spark.createDataFrame([], known)
    return spark.read.schema(known).parquet(f"{root}/{part}").where(F.col(BATCH).isin(numbers))


def commits(spark: SparkSession, root: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    return read_part(spark, root, COMMITS, schema, before)

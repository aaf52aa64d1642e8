"""Session settings the jobs are designed for, and the shared folder they may use."""

from __future__ import annotations

import tempfile
import uuid
from math import ceil

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes partitions at run time and splits skewed join partitions, also
# when that costs one more shuffle. The broadcast threshold stays at Spark's default: estimates
# come from compressed file sizes, and no job here hints a broadcast without a proven bound.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.unionOutputPartitioning": "false",
}


def build_session(
    app: str = "chronostrata", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the recommended settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def sound_unions(spark: SparkSession) -> None:
    """Spark 4.1 takes a union of parts that are dealt by key to be dealt by key itself, also where adaptive
    execution has merged the partitions of its parts differently: rows of one key then meet in no window, group or
    join. Without that claim the union is shuffled. Set at run time, since a session may come from elsewhere."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


# Parquet bytes of input for each shuffle partition a query starts with. Adaptive execution merges the small ones.
INPUT_SHARE = 8 << 20


def sized_shuffles(spark: SparkSession, input_dir: str) -> None:
    """As many partitions to start a shuffle with as the tables in `input_dir` need, and no fewer than the session
    has. Adaptive execution merges partitions up to its advisory size but does not cut one that is too large unless
    it is a skewed side of a join, so with a fixed number a task's sorts and hash maps grow with the tables."""
    place = spark._jvm.org.apache.hadoop.fs.Path(input_dir)
    size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(size / INPUT_SHARE))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(number))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, taken from `spark.checkpoint.dir`.

    Where the setting is absent, a temporary folder is made, but only in local
    mode: on a cluster another machine could not read it.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not configured:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="chronostrata-")
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and go on from there: it is not computed again, and a
    lost executor cannot change what was read. Parquet rather than `checkpoint()`, whose rows
    are read whole: later passes over a cut need a few columns each. The shuffles of the write are
    deleted when it ends; nothing reads them again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cuts/{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_END, "false")
    spark.conf.set(SHUFFLES_END, "true")
    try:
        df.write.parquet(path, compression="zstd")
    finally:
        spark.conf.set(SHUFFLES_END, before)
    return spark.read.schema(df.schema).parquet(path)

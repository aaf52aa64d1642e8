"""A history dimension fed by a stream. State lives in the dimension's table versions: batch
`n` writes version `n + 1` from version `n`, so a batch that is run again after a failure
rewrites its own version or finds it finished."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronostrata.operators.history import not_newer, scd2_apply
from chronostrata.operators.latest import latest_by_key
from chronostrata.sources.tables import read_table, version_path, versions, write_version


def scd2_foreach_batch(
    dim_path: str,
    key: str,
    attrs: Sequence[str],
    ts_col: str,
    tie: Sequence[str] = (),
    late_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Apply the newest row per key of each micro-batch to the dimension at `dim_path`, whose
    version 0 must exist. Changes the increment cannot take (same day or older) go to
    `late_path`, one folder per batch, as keys for `scd2_repair`."""
    order = [F.desc(ts_col), *[F.desc(t) for t in tie]]

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id + 1 in versions(spark, dim_path):
            return
        dim = read_table(spark, dim_path, batch_id)
        batch = batch.persist()
        try:
            if late_path is not None:
                late = not_newer(dim, batch, key, attrs, ts_col)
                late.write.mode("overwrite").parquet(version_path(late_path, batch_id))
            snapshot = latest_by_key(batch, key, order)
            write_version(scd2_apply(dim, snapshot, key, attrs, ts_col), dim_path, batch_id + 1)
        finally:
            batch.unpersist()

    return apply


def run_scd2_stream(events: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        events.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

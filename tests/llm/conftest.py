from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).resolve().parents[2] / "tools")]

from conftest_rows import ROWS  # noqa: E402

CLASHING = ("size", "key", "node", "kept", "position", "spans", "n", "shard", "_key", "_text", "_part", "slot", "text_key")


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and long texts, copies, repeated rows, names that clash."""
    fields = [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
    rows = [(*r, *([None] if i % 3 == 0 else [str(i)]) * len(CLASHING)) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, T.StructType(fields))


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

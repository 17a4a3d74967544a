"""Scans over rows in key order that no single task holds.

The rows are range-partitioned and sorted by (key, time, ...), so a key of any size is
spread over partitions. A partition is scanned once, in Arrow batches, with state carried
from row to row; what it can't know is the state at its start. Each partition therefore
also gives one edge row: the key it starts with, the key it ends with and the state at its
end. From the edges (a row per partition) every partition's start follows.

The scanned rows are written once below the shared folder: the partition numbers of rows
and edges must be those of the same run, also when an executor is lost between two reads.
"""

from __future__ import annotations

from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from featurekit.session import fresh_dir, ship_package


def scanned(df: DataFrame, order: Sequence[str], scan: Callable, schema, name: str) -> DataFrame:
    """``scan`` (a ``mapInArrow`` function) over the range partitions of ``df`` by ``order``."""
    spark = df.sparkSession
    ship_package(spark)
    path = fresh_dir(spark, name)
    (df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(scan, schema)
     .write.parquet(path))
    return spark.read.schema(schema).parquet(path)


def partition_id() -> int:
    return TaskContext.get().partitionId()


def changes(column: pa.Array, before: pa.Array | None) -> np.ndarray:
    """Where a value differs from the one of the row before (null equals null); the first
    row is held against ``before`` (one value, or None: there is no row before)."""
    if before is None:
        before = pa.nulls(1, column.type)
        first = True
    else:
        first = False
    prior = pa.concat_arrays([before, column.slice(0, len(column) - 1)])
    differs = pc.not_equal(column, prior)
    one_null = pc.xor(column.is_null(), prior.is_null())
    out = pc.if_else(differs.is_null(), one_null, differs).to_numpy(zero_copy_only=False).astype(bool)
    if first:
        out[0] = True
    return out

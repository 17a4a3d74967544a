"""K15/K16 sinks: metrics snapshots as JSON documents and Prometheus text.

Both are plain Spark writers (one file per task), readable by any text tool;
the metric rows are rendered by ``operators.metrics`` on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_prometheus(lines: DataFrame, path: str) -> None:
    """One exposition line per row (column ``line``)."""
    lines.select("line").write.mode("overwrite").text(path)


def read_prometheus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def write_json(docs: DataFrame, path: str) -> None:
    """One JSON document per row (column ``json``), as JSON lines."""
    docs.select("json").write.mode("overwrite").text(path)

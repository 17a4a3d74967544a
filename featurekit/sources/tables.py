"""Scans of the input tables (one Parquet dataset per table).

Only the columns a job needs are selected right after the scan so Catalyst
prunes the Parquet ReadSchema; filters written later are pushed into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit import schemas


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = schemas.INPUT_TABLES.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(table_path(sf_dir, name))


def raw_events(spark: SparkSession, sf_dir: str, null_errors: bool = False) -> DataFrame:
    """The raw event contract ``(user_id, timestamp, event_type, value)``.

    ``events.ts`` is renamed to ``timestamp``. With ``null_errors`` the value of
    ``error`` events becomes NULL (the test data has no NULLs; audits need some).
    """
    ev = read_table(spark, sf_dir, "events")
    value = F.col("value")
    if null_errors:
        value = F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(value)
    return ev.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type"),
        value.cast("double").alias("value"),
    )


def events_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events plus the event id (a stable tie-breaker for ordering)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type"),
        F.col("value"),
        F.col("props"),
    )


def empty(spark: SparkSession, schema=schemas.USER_FEATURES_DAILY) -> DataFrame:
    return spark.createDataFrame([], schema)

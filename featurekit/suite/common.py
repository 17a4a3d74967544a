"""Shared pieces of the registered queries and their DuckDB oracles.

Results are compared order-insensitively against DuckDB, so every query's
output is normalised the same way on both sides: dates and timestamps as
strings, doubles rounded to 6 decimals (summation order differs in the last
bits between engines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def norm(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits)
        elif isinstance(f.dataType, T.DecimalType):
            c = F.round(c.cast("double"), digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ----------------------------------------------------------------- SQL pieces
FEATURES_SQL = """
SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS event_count, sum(value) AS total_value
FROM events GROUP BY 1, 2"""

FEATURES_NULLS_SQL = """
SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS event_count,
       sum(CASE WHEN event_type = 'error' THEN NULL ELSE value END) AS total_value
FROM events GROUP BY 1, 2"""

BOUNDS_SQL = "SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events"


def batched_sql(features_sql: str = FEATURES_SQL) -> str:
    """Features tagged with the backfill batch (three equal date ranges)."""
    return f"""
SELECT f.*, CAST(floor(date_diff('day', b.lo, f.date) * 3 / (date_diff('day', b.lo, b.hi) + 1)) AS INTEGER)
       AS batch
FROM ({features_sql}) f, ({BOUNDS_SQL}) b"""


def feature_cols_sql(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return (f"{p}user_id, CAST({p}date AS VARCHAR) AS date, {p}event_count, "
            f"round({p}total_value, 6) AS total_value")


def batch_dates_sql() -> str:
    """(batch, start, end) of each batch."""
    return f"""
SELECT batch, min(date) AS start_date, max(date) AS end_date
FROM ({batched_sql()}) GROUP BY batch"""


def registrar(queries: dict, oracles: dict):
    """``@register(name, sql)`` for a suite module: the query's result is
    normalised with ``norm`` and its oracle SQL (if any) recorded."""
    def register(name: str, sql: str | None = None):
        def deco(fn):
            def run(spark, sf_dir):
                return norm(fn(spark, sf_dir))
            run.__doc__ = fn.__doc__
            queries[name] = run
            if sql is not None:
                oracles[name] = sql
            return fn
        return deco
    return register

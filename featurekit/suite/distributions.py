"""Registered queries: quantile sketches of the published feature days.

The three backfill runs over ``events`` are published one by one; after each, the days it
covered are sketched. The queries then read the stored sketches only (but for the check of
the error bound, which reads the rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import drift, sketches
from featurekit.plans import history
from featurekit.session import fresh_dir
from featurekit.suite.common import FEATURES_SQL, batched_sql, registrar
from featurekit.suite.metrics import DRIFT_FEATURES, FEATURE_PSI_SQL

QUERIES: dict = {}
ORACLES: dict = {}

register = registrar(QUERIES, ORACLES)

QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)
#: The distribution rule's limit: the greatest difference of cumulative shares.
MAX_DISTANCE = 0.25


def published(spark: SparkSession, sf_dir: str) -> tuple[history.History, str]:
    """Each run published, then its days sketched from main: (history, folder of the sketches)."""
    h, path = history.History(spark, sf_dir), fresh_dir(spark, "sketches")
    for b, run_id in zip(h.batches, "abc"):
        h.run(b, run_id)
        sketches.store_sketches(h.table.scan(), path, DRIFT_FEATURES, b.start, b.end)
    return h, path


def window_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(window, feature, x): points of the first run's days (baseline) and the last's (current)."""
    h, path = published(spark, sf_dir)
    a, _, c = h.batches
    day = F.col("date")
    window = (F.when(day.between(F.lit(a.start), F.lit(a.end)), "baseline")
              .when(day.between(F.lit(c.start), F.lit(c.end)), "current"))
    s = sketches.stored_sketches(spark, path).where((day <= F.lit(a.end)) | (day >= F.lit(c.start)))
    by = ["window", "feature"]
    return sketches.points(sketches.merged(s.withColumn("window", window), by), by)


_LONG_SQL = f"""
SELECT date, 'event_count' AS feature, CAST(event_count AS DOUBLE) AS x FROM ({FEATURES_SQL})
UNION ALL SELECT date, 'total_value', total_value FROM ({FEATURES_SQL})"""


@register("feature_sketches_daily", f"""
SELECT CAST(date AS VARCHAR) AS date, feature, count(*) AS rows, count(*) FILTER (WHERE x IS NULL) AS nulls,
       round(min(x), 6) AS min, round(max(x), 6) AS max FROM ({_LONG_SQL}) GROUP BY date, feature""")
def feature_sketches_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored per published day and feature, but for the sketch itself."""
    _, path = published(spark, sf_dir)
    return sketches.stored_sketches(spark, path).where("rows > 0").drop("sketch")


@register("feature_sketch_quantiles", f"""
SELECT feature, p, TRUE AS within FROM (SELECT DISTINCT feature FROM ({_LONG_SQL}) WHERE x IS NOT NULL),
       (VALUES {", ".join(f"({p}::DOUBLE)" for p in QUANTILES)}) v(p)""")
def feature_sketch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of all published days from their merged sketches, each held against the
    rows of main: its true rank lies within the stated error of p."""
    h, path = published(spark, sf_dir)
    q = sketches.quantiles(sketches.merged(sketches.stored_sketches(spark, path), ["feature"]), ["feature"], QUANTILES)
    return sketches.rank_check(h.table.scan(), q.where("quantile IS NOT NULL"), DRIFT_FEATURES, sketches.rank_error())


@register("feature_drift_sketch", f"SELECT feature, drift_detected FROM ({FEATURE_PSI_SQL})")
def feature_drift_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift flag (PSI) of the last run's days against the first's, from sketches."""
    return drift.psi(window_points(spark, sf_dir)).select("feature", "drift_detected")


@register("quality_distribution", f"""
WITH x AS (SELECT batch = 0 AS base, feature, x FROM (
  SELECT batch, 'event_count' AS feature, CAST(event_count AS DOUBLE) AS x FROM ({batched_sql()})
  UNION ALL SELECT batch, 'total_value', total_value FROM ({batched_sql()})) WHERE batch IN (0, 2) AND x IS NOT NULL),
c AS (SELECT feature, sum(CAST(base AS INTEGER)) OVER u / sum(CAST(base AS INTEGER)) OVER a AS fb,
             sum(CAST(NOT base AS INTEGER)) OVER u / sum(CAST(NOT base AS INTEGER)) OVER a AS fc
      FROM x WINDOW u AS (PARTITION BY feature ORDER BY x RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    a AS (PARTITION BY feature))
SELECT 'distribution_within:' || feature AS rule, 'distribution_within' AS kind, feature AS "column",
       CAST(CASE WHEN max(abs(fb - fc)) <= {MAX_DISTANCE} THEN 0 ELSE 1 END AS BIGINT) AS failures,
       max(abs(fb - fc)) <= {MAX_DISTANCE} AS passed
FROM c GROUP BY feature""")
def quality_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distribution rule of each feature against the baseline's stored sketches."""
    return sketches.distribution_rule(window_points(spark, sf_dir), MAX_DISTANCE).drop("observed")

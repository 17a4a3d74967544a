"""Registered queries: snapshot expiry, orphan files, compaction, maintenance run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit import schemas
from featurekit.operators import maintenance as mt
from featurekit.operators.features import UserFeaturesDaily
from featurekit.plans import history
from featurekit.session import fresh_dir
from featurekit.sources import tables
from featurekit.sources.versioned import SNAPSHOT_COL, VersionedTable
from featurekit.suite.common import registrar, batched_sql, feature_cols_sql

QUERIES: dict = {}
ORACLES: dict = {}


register = registrar(QUERIES, ORACLES)


def daily_history(spark: SparkSession, sf_dir: str):
    """One append commit per event date (bulk-loaded in one job), a branch
    ``audit_old`` kept at snapshot 5, then main compacted into a replace
    snapshot. Commit time = date + 1 day 01:00."""
    f = UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir))
    t = VersionedTable(spark, fresh_dir(spark, "daily_history"), schemas.USER_FEATURES_DAILY)
    dates = [r[0] for r in f.select("date").distinct().orderBy("date").collect()]
    at = {d: dt.datetime.combine(d + dt.timedelta(days=1), dt.time(1)) for d in dates}
    t.write_many(f, "date", "main", at, {"run-id": "daily"})
    t.create_branch("audit_old", at_snapshot=5, at=at[dates[4]])
    last = max(at.values())
    t._commits = t._refs = None
    mt.compact(t, committed_at=last + dt.timedelta(hours=1))
    return t, last - dt.timedelta(days=7)


@register("expire_snapshots_plan", """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events),
c AS (SELECT row_number() OVER (ORDER BY date) AS sid, CAST(date + 1 AS TIMESTAMP) + INTERVAL 1 HOUR AS committed_at
      FROM d),
cut AS (SELECT max(committed_at) - INTERVAL 7 DAY AS cutoff FROM c)
SELECT CAST(sid AS BIGINT) AS snapshot_id, CAST(committed_at AS VARCHAR) AS committed_at, 'append' AS operation,
       sid > 5 AS data_deletable
FROM c, cut WHERE committed_at < cutoff AND sid <> 5""")
def expire_snapshots_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: snapshots older than 7 days before the newest daily commit, except
    ref heads and the newest of main; data deletable unless a live ref still
    sees it (audit_old keeps snapshots 1-5 alive)."""
    t, cutoff = daily_history(spark, sf_dir)
    return mt.expire_plan(t, cutoff, retain_last=1)


@register("orphan_files_report")
def orphan_files_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: files of a crashed write (data without a commit) are reported."""
    h = history.standard(spark, sf_dir)
    t = h.table
    crashed = UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir)).withColumn(SNAPSHOT_COL, F.lit(999))
    crashed.write.mode("append").partitionBy(SNAPSHOT_COL).parquet(t.data_path)
    o = mt.orphan_files(t, dt.datetime.now() + dt.timedelta(minutes=5))
    return o.groupBy("snapshot_dir").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


@register("compact_preserves_rows", f"""
SELECT {feature_cols_sql()}, 'incremental' AS after_compaction
FROM ({batched_sql()}) WHERE batch IN (0, 1)""")
def compact_preserves_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: after compaction main has exactly the same rows, now in one replace
    snapshot; an incremental read from snapshot 0 still sees only appends."""
    h = history.standard(spark, sf_dir)
    t = h.table
    mt.compact(t, committed_at=h.batches[-1].published_at + dt.timedelta(hours=1))
    _, mode = t.incremental(1)
    return t.scan().withColumn("after_compaction", F.lit(mode))


@register("compaction_plan")
def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 plan: visible files of main binned to a 1 MiB target."""
    t = history.standard(spark, sf_dir).table
    p = mt.compaction_plan(t, 1 << 20)
    return p.groupBy("snapshot_dir", "bin").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


@register("maintenance_status")
def maintenance_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: expire → orphans → compact, each step's status recorded."""
    t, cutoff = daily_history(spark, sf_dir)
    return mt.run_maintenance(t, cutoff, True, 128 << 20, cutoff + dt.timedelta(days=8))

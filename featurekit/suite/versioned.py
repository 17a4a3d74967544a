"""Registered queries: versioned table scans, branches, WAP publish, time travel."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit import schemas
from featurekit.operators.features import UserFeaturesDaily
from featurekit.plans import history
from featurekit.plans.backfill import filter_dates, run_backfill
from featurekit.session import fresh_dir
from featurekit.sources import tables
from featurekit.suite.common import (
    BOUNDS_SQL,
    FEATURES_NULLS_SQL,
    FEATURES_SQL,
    batched_sql,
    feature_cols_sql,
    registrar,
)

QUERIES: dict = {}
ORACLES: dict = {}


register = registrar(QUERIES, ORACLES)


B = batched_sql()
BN = batched_sql(FEATURES_NULLS_SQL)
FC = feature_cols_sql()
COUNTS = f"SELECT batch, count(*) AS n FROM ({B}) GROUP BY batch"


def _n(i: int) -> str:
    return f"(SELECT coalesce(sum(n), 0) FROM ({COUNTS}) WHERE batch = {i})"


@register("table_head", f"""
SELECT {FC}, CAST(CASE batch WHEN 2 THEN 4 ELSE batch + 1 END AS BIGINT) AS _snapshot_id FROM ({B})""")
def table_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at the head of main (runs a and b published, run c rejected, run d
    published in its place)."""
    return history.recovered(spark, sf_dir).table.scan(with_snapshot_id=True)


@register("branch_scan", f"""
SELECT {FC}, CAST(batch + 1 AS BIGINT) AS _snapshot_id FROM ({B}) WHERE batch IN (0, 1)
UNION ALL
SELECT {FC}, CAST(3 AS BIGINT) FROM ({BN}) WHERE batch = 2""")
def branch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: rows at the head of the unpublished branch ``audit_c`` (with NULLs)."""
    return history.standard(spark, sf_dir).table.scan(ref="audit_c", with_snapshot_id=True)


@register("wap_reject_keeps_main", f"""
SELECT run_id, status, CAST(snapshot_id AS BIGINT) AS snapshot_id, CAST(branch_rows AS BIGINT) AS branch_rows,
       CAST({_n(0)} + {_n(1)} AS BIGINT) AS main_rows
FROM (VALUES ('a', 'published', 1, {_n(0)}),
             ('b', 'published', 2, {_n(0)} + {_n(1)}),
             ('c', 'rejected', 3, {_n(0)} + {_n(1)} + {_n(2)})) v(run_id, status, snapshot_id, branch_rows)""")
def wap_reject_keeps_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: a failed audit leaves the branch readable and main unchanged."""
    h = history.standard(spark, sf_dir)
    t = h.table
    main_rows = t.scan().count()
    rows = [(k, r["status"], r["snapshot_id"], t.scan(ref=r["branch"]).count(), main_rows)
            for k, r in sorted(h.outcomes.items())]
    return spark.createDataFrame(rows, "run_id string, status string, snapshot_id bigint, branch_rows bigint, "
                                       "main_rows bigint")


def _main_with_provenance(t) -> DataFrame:
    return t.scan(with_snapshot_id=True).join(t.provenance("main"), "_snapshot_id").drop("_snapshot_id")


@register("wap_publish_fast_forward", f"""
SELECT {FC}, CASE batch WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS run_id, 'fast_forward' AS published
FROM ({B})""")
def wap_publish_fast_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 (flagship): three backfill runs, each written to its audit branch,
    audited in one aggregate and published by fast-forward; main's rows with
    the run that produced them."""
    return _main_with_provenance(history.all_published(spark, sf_dir).table)


@register("wap_publish_cherry_pick", f"""
SELECT {FC}, CASE batch WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS run_id,
       CASE WHEN batch = 2 THEN 'cherry_pick' ELSE 'fast_forward' END AS published
FROM ({B})""")
def wap_publish_cherry_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: branch c diverged from main (b published meanwhile), so it is
    cherry-picked; its data is resolved through ``source_snapshot_id``."""
    return _main_with_provenance(history.diverged(spark, sf_dir).table)


@register("wap_branch_isolation", f"""
SELECT 'main' AS ref, {FC} FROM ({B}) WHERE batch = 0
UNION ALL SELECT 'audit_b', {FC} FROM ({B}) WHERE batch IN (0, 1)""")
def wap_branch_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: a write to a branch is invisible on main until published."""
    h = history.History(spark, sf_dir)
    a, b, _ = h.batches
    h.run(a, "a")
    t = h.table
    t.create_branch("audit_b", "main", b.committed_at)
    t.write(UserFeaturesDaily().compute(filter_dates(h.events, b.start, b.end)), "audit_b",
            committed_at=b.committed_at, properties={"run-id": "b"})
    return (t.scan().select(F.lit("main").alias("ref"), "*")
            .unionByName(t.scan(ref="audit_b").select(F.lit("audit_b").alias("ref"), "*")))


@register("incremental_changes", f"SELECT {FC}, 'incremental' AS mode FROM ({B}) WHERE batch IN (1, 2)")
def incremental_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended to main after snapshot 1 (exclusive) up to its head."""
    df, mode = history.recovered(spark, sf_dir).table.incremental(1)
    return df.withColumn("mode", F.lit(mode))


@register("incremental_fallback_full", f"SELECT {FC}, 'full' AS mode FROM ({B})")
def incremental_fallback_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The start snapshot (3, on the rejected branch) is not an ancestor of
    main's head, so the read falls back to a full load."""
    df, mode = history.recovered(spark, sf_dir).table.incremental(3)
    return df.withColumn("mode", F.lit(mode))


@register("time_travel_snapshot", f"SELECT {FC} FROM ({B}) WHERE batch = 0")
def time_travel_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as of snapshot 1."""
    return history.standard(spark, sf_dir).table.scan(snapshot_id=1)


@register("time_travel_timestamp", f"SELECT {FC} FROM ({B}) WHERE batch = 0")
def time_travel_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main as of a time after run b's commit but before its publish: only
    run a's rows (publish time decides, not commit time)."""
    h = history.standard(spark, sf_dir)
    b = h.batches[1]
    return h.table.as_of_time(b.committed_at + dt.timedelta(minutes=30))


_HIST_SQL = f"""
WITH c AS ({COUNTS}), d AS (SELECT batch, max(date) AS end_date FROM ({B}) GROUP BY batch)
SELECT CAST(CAST(d.end_date + 1 AS TIMESTAMP) + INTERVAL 1 HOUR AS VARCHAR) AS committed_at,
       CAST(d.batch + 1 AS BIGINT) AS snapshot_id,
       CAST(CASE WHEN d.batch = 0 THEN NULL ELSE d.batch END AS BIGINT) AS parent_id,
       'overwrite' AS operation, 'c0ffee1' AS git_hash,
       CASE d.batch WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS run_id,
       CAST(c.n AS BIGINT) AS added_records,
       CAST((SELECT sum(n) FROM c c2 WHERE c2.batch <= d.batch) AS BIGINT) AS total_records
FROM d JOIN c ON c.batch = d.batch"""


@register("snapshot_history", _HIST_SQL)
def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit history newest first, lineage read from the summary map."""
    return history.standard(spark, sf_dir).table.history()


@register("branch_heads", f"""
SELECT name, CAST(sid AS BIGINT) AS snapshot_id, CAST(total AS BIGINT) AS total_records
FROM (VALUES ('main', 2, {_n(0)} + {_n(1)}), ('audit_a', 1, {_n(0)}), ('audit_b', 2, {_n(0)} + {_n(1)}),
             ('audit_c', 3, {_n(0)} + {_n(1)} + {_n(2)})) v(name, sid, total)""")
def branch_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Head snapshot of every ref, with the record count from the commit summary."""
    t = history.standard(spark, sf_dir).table
    return (t.heads().join(t.commits().select("snapshot_id", F.col("summary")["total-records"]
                                              .cast("long").alias("total_records")), "snapshot_id")
            .select("name", "snapshot_id", "total_records"))


@register("latest_snapshot", f"""
SELECT CAST(2 AS BIGINT) AS snapshot_id, committed_at, total_records
FROM ({_HIST_SQL}) WHERE snapshot_id = 2""")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10/T-2: newest commit of main's chain (top-1); unpublished branch
    commits are not candidates."""
    t = history.standard(spark, sf_dir).table
    chain = t.ancestors(t.head("main"))
    return (t.commits().filter(F.col("snapshot_id").isin(chain))
            .orderBy(F.col("committed_at").desc(), F.col("snapshot_id").desc()).limit(1)
            .select("snapshot_id", "committed_at",
                    F.col("summary")["total-records"].cast("long").alias("total_records")))


@register("create_branch", f"""
SELECT name, CAST(sid AS BIGINT) AS snapshot_id, CAST(total AS BIGINT) AS total_records,
       CAST(1 AS BIGINT) AS create_rows
FROM (VALUES ('audit_a', NULL, NULL), ('audit_b', 1, {_n(0)}), ('audit_c', 2, {_n(0)} + {_n(1)}),
             ('audit_x', 2, {_n(0)} + {_n(1)})) v(name, sid, total)""")
def create_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: branches start at main's head when created (audit_a on the empty
    table has none); creating an existing branch is a no-op."""
    t = history.standard(spark, sf_dir).table
    t.create_branch("audit_x")
    t.create_branch("audit_x")
    created = t.refs().filter(F.col("kind") == "create").groupBy("name").agg(
        F.min_by("snapshot_id", "seq").alias("snapshot_id"), F.count(F.lit(1)).alias("create_rows"))
    totals = t.commits().select("snapshot_id", F.col("summary")["total-records"].cast("long").alias("total_records"))
    return created.join(totals, "snapshot_id", "left").select("name", "snapshot_id", "total_records", "create_rows")


@register("backfill_idempotent", f"""
SELECT {FC}, CASE batch WHEN 0 THEN 'a2' WHEN 1 THEN 'b' ELSE 'c' END AS run_id FROM ({B})""")
def backfill_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: re-running the backfill of a date range replaces those dates (no
    duplicates); the newest run of each date wins."""
    h = history.History(spark, sf_dir)
    a, b, c = h.batches
    h.run(a, "a")
    h.run(b, "b")
    h.run(a, "a2", publish_at=b.published_at + dt.timedelta(hours=1))
    h.run(c, "c")
    t = h.table
    return t.scan(with_snapshot_id=True).join(t.provenance("main"), "_snapshot_id") \
        .drop("_snapshot_id", "published")


@register("backfill_every_day", f"""
WITH b AS ({BOUNDS_SQL})
SELECT {feature_cols_sql('f')}, CASE WHEN date_diff('day', b.lo, f.date) % 3 = 0 THEN 'rerun' ELSE 'first' END AS run,
       CAST(count(*) OVER () AS BIGINT) AS total_records
FROM ({FEATURES_SQL}) f, b""")
def backfill_every_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 over many runs: one idempotent run per event date, then every third date
    again; each date is live once, from its newest run, and the commit's
    total-records is the row count."""
    h = history.History(spark, sf_dir)
    lo, hi = h.batches[0].start, h.batches[-1].end
    days = [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]
    for name, dates in (("first", days), ("rerun", days[::3])):
        for d in dates:
            h.run(history.Batch(0, d, d), f"{name}_{d}")
    t = h.table
    total = int(t.commit_list()[-1].summary["total-records"])
    return (t.scan(with_snapshot_id=True).join(t.provenance("main"), "_snapshot_id").drop("_snapshot_id", "published")
            .withColumn("run", F.substring_index("run_id", "_", 1)).drop("run_id")
            .withColumn("total_records", F.lit(total).cast("long")))


@register("wap_retry_after_rejection", f"SELECT {FC} FROM ({B}) WHERE batch IN (0, 1)")
def wap_retry_after_rejection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: a run is rejected for its NULLs, then retried under the same run id for the
    next date range: nothing of the rejected rows reaches main."""
    h = history.History(spark, sf_dir)
    a, b, c = h.batches
    h.run(a, "a")
    assert h.run(c, "b", with_nulls=True)["status"] == "rejected"
    h.run(b, "b")
    return h.table.scan()


@register("time_travel_default_times", f"SELECT {FC} FROM ({B})")
def time_travel_default_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 without given times: commits and publishes carry the current time, so main as
    of tomorrow is the whole table."""
    h = history.History(spark, sf_dir)
    run_backfill(h.table, h.events, h.batches[0].start, h.batches[-1].end, "a")
    return h.table.as_of_time(dt.datetime.now() + dt.timedelta(days=1))


@register("overwrite_partitions", f"""
SELECT {FC} FROM ({B}) WHERE batch <> 1
UNION ALL SELECT {FC} FROM ({BN}) WHERE batch = 1""")
def overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: dynamic partition overwrite of a date-partitioned Parquet table:
    only the dates present in the new data are replaced."""
    ev = tables.raw_events(spark, sf_dir)
    evn = tables.raw_events(spark, sf_dir, null_errors=True)
    bs = history.batches(ev)
    path = fresh_dir(spark, "predictions_overwrite")
    g = UserFeaturesDaily()
    first = g.compute(filter_dates(ev, bs[0].start, bs[-1].end))
    first.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    again = g.compute(filter_dates(evn, bs[1].start, bs[1].end))
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    return spark.read.schema(schemas.USER_FEATURES_DAILY).parquet(path)


@register("schema_evolution_read", f"""
SELECT {FC}, CAST(NULL AS DOUBLE) AS avg_value FROM ({B}) WHERE batch = 0
UNION ALL SELECT {FC}, round(total_value / event_count, 6) FROM ({B}) WHERE batch = 1""")
def schema_evolution_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written before a column was added read back with NULL for it
    (``mergeSchema``)."""
    ev = tables.raw_events(spark, sf_dir)
    bs = history.batches(ev)
    path = fresh_dir(spark, "evolving")
    g = UserFeaturesDaily()
    g.compute(filter_dates(ev, bs[0].start, bs[0].end)).write.parquet(f"{path}/v=1")
    (g.compute(filter_dates(ev, bs[1].start, bs[1].end))
     .withColumn("avg_value", F.col("total_value") / F.col("event_count"))
     .write.parquet(f"{path}/v=2"))
    return spark.read.option("mergeSchema", "true").parquet(path).drop("v")


@register("row_counts", f"""
WITH e AS (SELECT b.batch, count(*) AS n FROM events e JOIN ({B}) b
           ON e.user_id = b.user_id AND CAST(e.ts AS DATE) = b.date GROUP BY b.batch)
SELECT CASE e.batch WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS run_id,
       CAST(e.n AS BIGINT) AS source_records, CAST(c.n AS BIGINT) AS added_records
FROM e JOIN ({COUNTS}) c ON c.batch = e.batch""")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: rows read and rows written per backfill run, both observed during
    the single write job (no extra count passes)."""
    t = history.standard(spark, sf_dir).table
    return t.commits().select(F.col("summary")["run-id"].alias("run_id"),
                              F.col("summary")["source-records"].cast("long").alias("source_records"),
                              F.col("summary")["added-records"].cast("long").alias("added_records"))

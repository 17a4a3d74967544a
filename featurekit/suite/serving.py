"""Registered queries: latest-per-key upserts, store size, lookups, sync (batch and stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit import schemas
from featurekit.operators.features import UserFeaturesDaily
from featurekit.plans import history
from featurekit.plans.backfill import filter_dates, run_backfill
from featurekit.plans.online_sync import SyncState, run_online_sync
from featurekit.operators.serving import latest_per_key
from featurekit.session import fresh_dir, ship_package
from featurekit.sinks.kv_source import KeyValueDataSource
from featurekit.sinks.online_store import ParquetOnlineStore
from featurekit.sources import tables
from featurekit.streaming.online_sync import run_sync_stream
from featurekit.suite.common import registrar, FEATURES_SQL, batched_sql, feature_cols_sql

QUERIES: dict = {}
ORACLES: dict = {}


register = registrar(QUERIES, ORACLES)


B = batched_sql()
FC = feature_cols_sql()
STORE_SCHEMA = schemas.with_field(schemas.USER_FEATURES_DAILY, "_snapshot_id", schemas.T.LongType())


def latest_sql(where: str = "TRUE") -> str:
    return f"""
SELECT {FC} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS rn FROM ({B}) WHERE {where})
WHERE rn = 1"""


def _store(spark) -> ParquetOnlineStore:
    return ParquetOnlineStore(spark, fresh_dir(spark, "online_store"), STORE_SCHEMA)


@register("online_upsert_latest", latest_sql())
def online_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two upserts into the store (first date range, then the rest);
    the store keeps the latest record per user."""
    ev = tables.raw_events(spark, sf_dir)
    bs = history.batches(ev)
    g = UserFeaturesDaily()
    store = _store(spark)
    store.upsert(g.compute(filter_dates(ev, bs[0].start, bs[0].end)).withColumn("_snapshot_id", F.lit(1)))
    store.upsert(g.compute(filter_dates(ev, bs[1].start, bs[-1].end)).withColumn("_snapshot_id", F.lit(2)))
    return store.current().drop("_snapshot_id")


@register("online_store_plugin", latest_sql())
def online_store_plugin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store as a plug-in behind a data source. The first date range is written in one batch, the
    rest by a stream, and the records are read back through the same plug-in."""
    ship_package(spark)
    spark.dataSource.register(KeyValueDataSource)
    ev = tables.raw_events(spark, sf_dir)
    bs = history.batches(ev)
    g, root = UserFeaturesDaily(), fresh_dir(spark, "plugin")
    options = {"client": "featurekit.sinks.kv_source:FileClient", "path": f"{root}/store", "key": "user_id"}
    first = latest_per_key(g.compute(filter_dates(ev, bs[0].start, bs[0].end)), "user_id", ["date"])
    first.write.format("keyvalue").options(**options, version="load").mode("append").save()
    g.compute(filter_dates(ev, bs[1].start, bs[-1].end)).write.parquet(f"{root}/arriving")
    q = (spark.readStream.schema(schemas.USER_FEATURES_DAILY).parquet(f"{root}/arriving").writeStream.format("keyvalue")
         .options(**options, version="sync", checkpointLocation=f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    text = schemas.T.StructType([schemas.T.StructField(f.name, schemas.T.StringType() if isinstance(
        f.dataType, schemas.T.DateType) else f.dataType) for f in schemas.USER_FEATURES_DAILY])
    back = spark.read.format("keyvalue").options(**options).schema(text).load()
    return latest_per_key(back.withColumn("date", F.col("date").cast("date")), "user_id", ["date"])


@register("online_store_size", f"""
SELECT 'parquet' AS store_type, CAST(count(DISTINCT user_id) AS BIGINT) AS keys FROM ({FEATURES_SQL})""")
def online_store_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of keys in the store after loading all features."""
    store = _store(spark)
    store.upsert(UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir)).withColumn("_snapshot_id", F.lit(1)))
    return spark.createDataFrame([(store.store_type, store.size())], "store_type string, keys bigint")


@register("online_lookup", f"""
WITH k AS (SELECT DISTINCT CASE WHEN event_type = 'error' THEN user_id + 1000000000 ELSE user_id END AS user_id
           FROM events WHERE event_type IN ('purchase', 'error')),
s AS ({latest_sql()})
SELECT k.user_id, s.date, s.event_count, s.total_value, s.user_id IS NOT NULL AS found
FROM k LEFT JOIN s ON k.user_id = s.user_id""")
def online_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk lookup of requested keys (purchasers, plus unknown keys made
    from error events) against the store."""
    ev = tables.raw_events(spark, sf_dir)
    store = _store(spark)
    store.upsert(UserFeaturesDaily().compute(ev).withColumn("_snapshot_id", F.lit(1)))
    keys = (ev.filter(F.col("event_type").isin("purchase", "error"))
            .select(F.when(F.col("event_type") == "error", F.col("user_id") + 1000000000)
                    .otherwise(F.col("user_id")).alias("user_id")).distinct())
    return store.lookup(keys).drop("_snapshot_id")


def _sync_rounds(spark, sf_dir, stream: bool):
    h = history.History(spark, sf_dir)
    a, b, c = h.batches
    store = _store(spark)
    state = SyncState(spark, fresh_dir(spark, "sync_state"))
    ckpt = fresh_dir(spark, "sync_checkpoint")
    sync = ((lambda: run_sync_stream(h.table, store, ckpt)) if stream
            else (lambda: run_online_sync(h.table, store, state)))
    h.run(a, "a")
    sync()
    h.run(b, "b")
    sync()
    sync()  # nothing new: a no-op
    h.run(c, "c")
    sync()
    return store


@register("online_sync_two_rounds", latest_sql())
def online_sync_two_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full sync after run a, incremental (1, 2] after run b, then an
    up-to-date no-op; the store equals latest-per-user of main."""
    return _sync_rounds(spark, sf_dir, stream=False).current().drop("_snapshot_id")


@register("online_sync_stream", latest_sql())
def online_sync_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sync as an ``availableNow`` Structured Streaming query over
    main's refs log (three runs: full, incremental, nothing)."""
    return _sync_rounds(spark, sf_dir, stream=True).current().drop("_snapshot_id")


@register("online_sync_after_rerun", latest_sql("NOT (batch = 2 AND user_id % 5 = 0)"))
def online_sync_after_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a first sync the last date range is backfilled again without some
    users; the next sync retracts their replaced records and falls back to the latest
    that are still in the table."""
    h = history.all_published(spark, sf_dir)
    store, state = _store(spark), SyncState(spark, fresh_dir(spark, "sync_state"))
    run_online_sync(h.table, store, state)
    b = h.batches[2]
    run_backfill(h.table, h.events.filter(F.col("user_id") % 5 != 0), b.start, b.end, "c2")
    run_online_sync(h.table, store, state)
    return store.current().drop("_snapshot_id")


@register("online_sync_new_checkpoint", latest_sql())
def online_sync_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sync stream is started anew with an empty checkpoint, so its epochs count
    from 0 again; versions go on growing and no key is lost."""
    h = history.History(spark, sf_dir)
    store = _store(spark)
    for b, run_id in zip(h.batches, "abc"):
        h.run(b, run_id)
        run_sync_stream(h.table, store, fresh_dir(spark, "sync_checkpoint"))
    return store.current().drop("_snapshot_id")

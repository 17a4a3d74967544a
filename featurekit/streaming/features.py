"""Daily user features as a Structured Streaming aggregation.

Event time must be a TIMESTAMP (``timestamp_ntz`` is cast with the session
time zone). A 2-day watermark bounds the state; output mode ``update`` emits
changed (user, day) rows per micro-batch and ``foreachBatch`` appends them under a
number that grows over checkpoints: a new checkpoint restarts Spark's batch ids at 0,
so each stream run first looks up the greatest number there and counts from it, unless
this checkpoint has written before, whose offset is kept with its rows. A replayed
batch has the number it had and the same rows. The newest emission per key is the current value. Rows
later than the watermark are dropped by the stream and repaired by an
idempotent batch backfill of their dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.functions import timeutil as tu


def daily_features_stream(source: DataFrame, watermark: str = "2 days") -> DataFrame:
    # the wall clock read as UTC: day windows align with wall-clock midnight in
    # any session time zone
    ev = source.withColumn("event_time", tu.as_utc_instant("timestamp"))
    day = F.to_date(tu.from_epoch_seconds(F.unix_seconds(F.col("window.start"))))
    return (ev.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 day"), "user_id")
            .agg(F.count(F.lit(1)).alias("event_count"), F.sum("value").alias("total_value"))
            .select("user_id", day.alias("date"), "event_count", "total_value"))


def run_daily_features_stream(spark: SparkSession, input_path: str, schema, out_path: str, checkpoint: str,
                              timeout_s: float | None = None) -> None:
    src = spark.readStream.schema(schema).parquet(input_path)
    first: dict[str, int] = {}

    def sink(batch: DataFrame, epoch_id: int) -> None:
        # the offset of this checkpoint: that of its rows if it has any, otherwise behind all numbers
        s = batch.sparkSession
        query = s.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        if query not in first:
            first[query] = _offset(s, out_path, query)
        batch.withColumn("_batch", F.lit(first[query] + epoch_id).cast("long")).withColumn("_query", F.lit(query)).withColumn(
            "_epoch", F.lit(epoch_id).cast("long")).write.mode("append").parquet(out_path)

    q = (daily_features_stream(src).writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.isActive:
        q.stop()
        raise TimeoutError("feature stream did not finish")
    if q.exception():
        raise RuntimeError(str(q.exception()))


def _offset(spark: SparkSession, out_path: str, query: str) -> int:
    """What is added to the batch ids of the stream with that query id, which its checkpoint holds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    rows = spark.read.option("mergeSchema", "true").parquet(out_path)
    own = F.max(F.when(F.col("_query") == query, F.col("_batch") - F.col("_epoch")))
    r = rows.agg(own.alias("own"), F.max("_batch").alias("top")).first()
    return r["own"] if r["own"] is not None else (-1 if r["top"] is None else r["top"]) + 1


def current_features(spark: SparkSession, out_path: str) -> DataFrame:
    """Newest emission per (user, day) — an aggregate, skew-safe."""
    rows = spark.read.parquet(out_path)
    best = F.max_by(F.struct("event_count", "total_value"), "_batch")
    return (rows.groupBy("user_id", "date").agg(best.alias("r"))
            .select("user_id", "date", "r.event_count", "r.total_value"))

"""Sharding by a two-pass external shuffle (native).

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded hash of
(doc_id, text); Spark's shuffle files are the buckets. Pass 2 orders each bucket by
(doc_id, text hash), permutes it with ``shuffle`` (Fisher-Yates in the JVM) and lays
the buckets end to end. The shuffled sequence is cut into shards whose row counts
differ by at most one, and written by shard.

Records that repeat both doc_id and text would all get one hash. Where those of one pair
weigh more than a quarter of a bucket they are written with a number each, which joins
the hash; the rest need none. So a bucket's size depends on ``bucket_bytes`` (and on
the longest text), not on how often a record stands in the table.

Defined results: null doc_ids and null texts are ordinary records; equal rows get slots
of their own; an empty table gives empty shards; further
columns travel along, and none of them clashes with the operator's own (those get
names the input does not use, but for ``shard`` and ``slot``, which are replaced).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.functions.sizing import broadcast_if_small
from featurekit.llm.common import free_name, utf8_bytes, written


def _hashed(docs: DataFrame, seed: int, bucket_bytes: int, name: str) -> DataFrame:
    """``docs`` with the seeded hash that deals them to buckets, as column ``name``."""
    hid, hth, hn, hb, no = (free_name(docs, c) for c in ("_hid", "_hth", "_hn", "_hb", "_no"))
    often = written(docs.groupBy(F.col("doc_id").alias(hid), F.xxhash64("text").alias(hth)).agg(
        F.count(F.lit(1)).alias(hn), F.sum(utf8_bytes(F.col("text")) + 64).alias(hb))
        .where((F.col(hn) > 1) & (F.col(hb) > bucket_bytes // 4)).select(hid, hth), "shard-repeats")
    plain = F.xxhash64(F.lit(seed), "doc_id", "text")
    if often.isEmpty():
        return docs.withColumn(name, plain)
    marked = docs.join(broadcast_if_small(often.withColumn(hn, F.lit(1))), F.col("doc_id").eqNullSafe(F.col(hid))
                       & (F.xxhash64("text") == F.col(hth)), "left").drop(hid, hth)
    # numbered in a table of their own: a task that runs again finds the same numbers
    numbered = written(marked.where(F.col(hn).isNotNull()).withColumn(no, F.monotonically_increasing_id()),
                       "shard-numbered")
    return (marked.where(F.col(hn).isNull()).withColumn(name, plain).drop(hn).unionByName(
        numbered.withColumn(name, F.xxhash64(F.lit(seed), "doc_id", "text", no)).drop(hn, no)))


def external_shuffle(docs: DataFrame, n_shards: int = 16, seed: int = 20240229,
                     bucket_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in each
    shard). ``bucket_bytes`` is the text a bucket holds on average; a task permutes one
    bucket at a time, so it bounds the memory whatever the input's size."""
    docs = docs.drop("shard", "slot")
    bucket, rec, recs = (free_name(docs, c) for c in ("_bucket", "_rec", "_recs"))
    n_rows, n_bytes = docs.agg(F.count(F.lit(1)), F.sum(utf8_bytes(F.col("text")) + 64)).first()
    n_buckets = max(1, math.ceil((n_bytes or 0) / bucket_bytes))
    keyed = _hashed(docs, seed, bucket_bytes, bucket).withColumn(bucket, F.pmod(bucket, F.lit(n_buckets)))

    counts = keyed.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    # one row per bucket: the offsets need a running total over the buckets only
    offsets = counts.select(F.col(bucket).alias("b"), F.expr(
        f"sum(n) OVER (ORDER BY {bucket} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n").alias("before"))

    th = free_name(docs, "_th")
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    buckets = (keyed.select(bucket, F.col("doc_id").alias("_k"), F.xxhash64("text").alias(th), record.alias(rec))
               .repartition(n_buckets, bucket)
               .sortWithinPartitions(bucket, "_k", th)  # lists in a fixed order, whatever order blocks arrive in
               .groupBy(bucket).agg(F.collect_list(rec).alias(recs))
               .sortWithinPartitions(bucket))  # the generator runs on from bucket to bucket
    permuted = buckets.select(bucket, F.shuffle(recs, seed).alias(recs))
    ranked = (permuted.join(offsets, F.col(bucket) == F.col("b"))
              .select("before", F.posexplode(recs).alias("pos", "rec"))
              .select((F.col("before") + F.col("pos")).alias("rank"), F.col("rec").alias("row")))

    q, r = divmod(n_rows, n_shards)  # the first r shards hold q + 1 rows
    long_part = F.lit(r * (q + 1))
    shard = F.when(F.col("rank") < long_part, F.floor(F.col("rank") / (q + 1))).otherwise(
        r + F.floor((F.col("rank") - long_part) / max(q, 1)))
    slot = F.when(F.col("rank") < long_part, F.col("rank") % (q + 1)).otherwise(
        (F.col("rank") - long_part) % max(q, 1))
    return ranked.select(*[F.col("row").getField(c).alias(c) for c in docs.columns],
                         shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, **kwargs) -> DataFrame:
    """Shuffles ``docs`` and writes one folder per shard, rows with their slots;
    returns the table read back."""
    out = external_shuffle(docs, **kwargs)
    out.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)

"""A Parquet-backed key-value online store with versioned, hash-bucketed state.

The state is split into ``buckets`` by ``pmod(xxhash64(key), buckets)``. An
upsert reads only the buckets its updates touch, merges them (latest record
per key, computed by the executors) and writes those buckets as a new version
folder ``v=<n>/bucket=<b>/``; untouched buckets keep pointing at the version
that last wrote them. A metadata log row per (version, bucket) publishes the
write, so readers never see a half-written version. Versions only grow; an
upsert can carry a ``token`` (a stream's query id and epoch), and one whose token is in the
log is not applied again. The bucket count is written with the store: an existing
store is opened with its own count and refuses another. The cost of an upsert
is proportional to the touched buckets, not the whole store. Any external store can instead implement a ``foreachPartition``
writer over ``merge_latest`` output.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.operators import serving
from featurekit.sources import metalog

VERSIONS = T.StructType([T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType()),
                         T.StructField("token", T.StringType()), T.StructField("empty", T.BooleanType())])
LAYOUT = T.StructType([T.StructField("buckets", T.IntegerType())])
DEFAULT_BUCKETS = 16


class ParquetOnlineStore:
    store_type = "parquet"

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "user_id",
                 order: Sequence[str] = ("date", "_snapshot_id"), buckets: int | None = None):
        """``buckets``: state files and write tasks of a new store (size it to the keys:
        a bucket is one task); None takes the stored count."""
        self.spark, self.path, self.schema, self.key, self.order = spark, path.rstrip("/"), schema, key, list(order)
        stored = None
        if metalog.exists(spark, f"{self.path}/_layout"):
            stored = metalog.read(spark, f"{self.path}/_layout", LAYOUT).first().buckets
        if stored and buckets and stored != buckets:
            raise ValueError(f"the store at {self.path} has {stored} buckets, not {buckets}")
        self.buckets = stored or buckets or DEFAULT_BUCKETS
        self._is_new = stored is None
        self._cache: list[Row] | None = None

    def _log(self) -> list[Row]:
        """Version log rows (cached: one writer per store)."""
        if self._cache is None:
            self._cache = (metalog.read(self.spark, f"{self.path}/_versions", VERSIONS).collect()
                           if metalog.exists(self.spark, f"{self.path}/_versions") else [])
        return self._cache

    def _layout(self, before: int | None = None) -> dict[int, Row]:
        """bucket → log row of the newest version (older than ``before``) that wrote it."""
        out: dict[int, Row] = {}
        for r in sorted(self._log(), key=lambda r: r.version):
            if before is None or r.version < before:
                out[r.bucket] = r
        out = {b: r for b, r in out.items() if not r.empty}
        return out

    def version(self) -> int | None:
        log = self._log()
        return max(r.version for r in log) if log else None

    def _bucket_of(self, c: str) -> F.Column:
        return F.pmod(F.xxhash64(F.col(c)), F.lit(self.buckets)).cast("int")

    def _read(self, layout: dict[int, Row], buckets=None) -> DataFrame:
        paths = [f"{self.path}/v={r.version}/bucket={b}" for b, r in sorted(layout.items())
                 if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def current(self, before: int | None = None) -> DataFrame:
        """The whole state (or as it was before version ``before``)."""
        return self._read(self._layout(before))

    def upsert(self, updates: DataFrame, token: str | None = None, retract: DataFrame | None = None,
               replace: bool = False) -> int:
        """Merge ``updates`` into the touched buckets; returns the version written (with
        a token that is in the log: the version that applied it). The state of the keys
        in ``retract`` is dropped first; ``replace`` drops the whole state."""
        if token is not None:
            applied = [r.version for r in self._log() if r.token == token]
            if applied:
                return applied[0]
        if self._is_new:
            metalog.append(self.spark, f"{self.path}/_layout", [Row(buckets=self.buckets)], LAYOUT)
            self._is_new = False
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in updates.columns
                else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        u = serving.valid_keys(updates.select(*cols), self.key).withColumn("_bucket", self._bucket_of(self.key))
        # updates are reduced to one row per key first (partial aggregation, so a hot key
        # costs one row per task) and written once by bucket: the folders name the
        # touched buckets, and the merge reads them back
        v = (self.version() or 0) + 1
        staged = f"{self.path}/_updates/v={v}"
        (serving.latest_per_key(u, self.key, self.order, with_keys=["_bucket"])
         .withColumnRenamed("_bucket", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(staged))
        new = self._written_buckets(staged)
        layout = self._layout()
        touched = set(new)
        if replace:
            touched |= set(layout)
        elif retract is not None:  # bucket numbers only
            gone = retract.select(self.key).distinct().withColumn("_bucket", self._bucket_of(self.key))
            touched |= {r[0] for r in gone.select("_bucket").distinct().collect()} & set(layout)
        if not touched:
            return v - 1
        touched = sorted(touched)
        both = (self.spark.read.schema(self.schema).parquet(*[f"{staged}/bucket={b}" for b in new]) if new
                else self.spark.createDataFrame([], self.schema))
        if layout and not replace:
            state = self._read(layout, set(touched))
            if retract is not None:
                state = state.join(gone.select(self.key), self.key, "left_anti").select(*self.schema.names)
            both = state.unionByName(both)
        # one shuffle by bucket, then the latest-per-key aggregate (grouped by bucket and
        # key) runs without another, and each bucket is written by exactly one task
        both = both.withColumn("_bucket", self._bucket_of(self.key)).repartition("_bucket")
        merged = serving.latest_per_key(both, self.key, self.order, with_keys=["_bucket"])
        out = f"{self.path}/v={v}"
        merged.withColumnRenamed("_bucket", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(out)
        kept = set(self._written_buckets(out))
        rows = [Row(version=v, bucket=b, token=token, empty=b not in kept) for b in touched]
        metalog.append(self.spark, f"{self.path}/_versions", rows, VERSIONS)
        self._log().extend(rows)
        self._remove(staged)
        return v

    def _remove(self, folder: str) -> None:
        """Deletes an intermediate folder of this store."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def _written_buckets(self, out: str) -> list[int]:
        """Bucket folders of a written version (a metadata listing, no data read)."""
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(out)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("bucket="))

    def size(self) -> int:
        """Number of keys (a count over Parquet footers of the current buckets)."""
        return self.current().count()

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Bulk lookup reading only the buckets the requested keys fall in."""
        k = keys.withColumn("_bucket", self._bucket_of(self.key))
        wanted = {r[0] for r in k.select("_bucket").distinct().collect()}
        return serving.lookup(k.drop("_bucket"), self._read(self._layout(), wanted), self.key)

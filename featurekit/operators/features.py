"""Feature groups and feature-table joins.

A feature group is any object with ``name``, ``description`` and
``compute(DataFrame) -> DataFrame``; computation stays a lazy Catalyst plan.
"""

from __future__ import annotations

from typing import Iterator, Protocol, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.functions import ranged


class FeatureGroup(Protocol):
    name: str
    description: str

    def compute(self, source_df: DataFrame) -> DataFrame: ...


class UserFeaturesDaily:
    """``count(*)`` and ``sum(value)`` per (user_id, date).

    Plan: partial hash aggregate → shuffle on (user_id, date) → final aggregate.
    A hot user is split across days and pre-aggregated map side, so skew never
    reaches one reducer as raw rows. NULL values are ignored by ``sum``; an
    all-NULL group yields NULL (the audit rejects it).
    """

    name = "user_features_daily"
    description = "Events and summed value per user and day"
    source_count_column = "event_count"  # sum over groups = source rows read

    def compute(self, source_df: DataFrame) -> DataFrame:
        return (source_df
                .withColumn("date", F.to_date("timestamp"))
                .groupBy("user_id", "date")
                .agg(F.count(F.lit(1)).alias("event_count"),
                     F.sum("value").alias("total_value")))


def date_bounds(df: DataFrame, date_col: str = "date"):
    """(min, max) of a date column: one partial aggregate, two values to the driver."""
    r = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    return r["lo"], r["hi"]


def date_batches(df: DataFrame, n_batches: int = 3, date_col: str = "date", bounds=None) -> DataFrame:
    """Tag rows with a backfill batch number: the date range split in equal parts.

    ``batch = floor((date - min) * n / (max - min + 1))``; the bounds are two
    literals, so the tagging is a narrow projection (no join, no shuffle).
    """
    lo, hi = bounds or date_bounds(df, date_col)
    span = (hi - lo).days + 1
    return df.withColumn(
        "batch",
        F.floor(F.datediff(F.col(date_col), F.lit(lo)) * n_batches / span).cast("int"))


def feature_columns(df: DataFrame, entity: str = "user_id",
                    exclude: Sequence[str] = ("date", "timestamp", "created_at")) -> list[str]:
    """Auto-detected feature columns = all but the entity and time columns."""
    skip = {entity, *exclude}
    return [c for c in df.columns if c not in skip and not c.startswith("_")]


def with_feature_vector(df: DataFrame, cols: Sequence[str], out: str = "_features") -> DataFrame:
    """``array<double>`` of the feature columns (a native expression)."""
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in cols]))


def spine_join(spine: DataFrame, features: DataFrame, keys: Sequence[str] = ("user_id", "date")) -> DataFrame:
    """Entity spine LEFT JOIN feature table on the entity keys.

    No hint: AQE turns it into a broadcast join when the runtime size of the
    feature side is under the threshold, else it stays sort-merge.
    """
    return spine.join(features, list(keys), "left")


def _last_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The label rows with the last feature row of their key so far, then the edge row."""
    pid = ranged.partition_id()
    head = last = carried = payload = None
    for b in batches:
        if not b.num_rows:
            continue
        key, label, feature = b.column(0), b.column(4), b.column(5)
        at = np.arange(b.num_rows)
        is_feature = b.column(2).to_numpy(zero_copy_only=False) == 1
        begun = np.maximum.accumulate(np.where(ranged.changes(key, last), at, -1))
        seen = np.maximum.accumulate(np.where(is_feature, at, -1))
        none = pa.nulls(1, feature.type)
        pool = pa.concat_arrays([none, none if carried is None else carried, feature])
        # 0: no feature yet, 1: the one carried over from the batch before, else a row of this batch
        pick = np.where((seen >= 0) & (seen >= begun), seen + 2, np.where(begun < 0, 1, 0))
        match = pool.take(pa.array(pick))
        head = key.slice(0, 1) if head is None else head
        last, carried, payload = key.slice(b.num_rows - 1), match.slice(b.num_rows - 1), label.type
        keep = pa.array(~is_feature)
        n = int((~is_feature).sum())
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([pid] * n, pa.int32()), pa.array([False] * n), pa.nulls(n, key.type), key.filter(keep),
                 label.filter(keep), match.filter(keep)], ["pid", "edge", "head", "_k", "_l", "_f"])
    if head is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([pid], pa.int32()), pa.array([True]), head, last, pa.nulls(1, payload), carried],
            ["pid", "edge", "head", "_k", "_l", "_f"])


def asof_join(labels: DataFrame, features: DataFrame, key: str = "user_id",
              label_time: str = "label_date", feature_time: str = "date",
              feature_cols: Sequence[str] | None = None) -> DataFrame:
    """Point-in-time join, latest feature row strictly before the label time; every
    label row stays, one without a key, a time or an earlier feature row with nulls.

    Equals ``labels ASOF LEFT JOIN features ON key = key AND label_time > feature_time``.

    One sorted merge (``functions.ranged``): both sides are range-partitioned together by
    (key, time), labels before features of the same time, so a hot key is split, and each
    partition carries the last feature row along. The key that a partition starts with takes
    the last feature row that the partitions before ended with: a window over one row per
    partition. No pairs are emitted and neither side is read twice. Labels equal in all
    columns stay in one partition, which is streamed.
    """
    if feature_cols is None:
        feature_cols = [c for c in features.columns if c not in (key, feature_time)]
    cols = [feature_time, *feature_cols]
    # payload fields by position: the sides may use the same names
    lab = labels.select(F.col(key).alias("_k"), F.col(label_time).alias("_t"), F.lit(0).alias("_side"),
                        F.xxhash64(*labels.columns).alias("_h"),
                        F.struct(*[F.col(c).alias(f"l{i}") for i, c in enumerate(labels.columns)]).alias("_l"))
    feat = (features.filter(F.col(key).isNotNull() & F.col(feature_time).isNotNull())
            .select(F.col(key).alias("_k"), F.col(feature_time).alias("_t"), F.lit(1).alias("_side"),
                    F.lit(0).cast("long").alias("_h"),
                    F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(cols)]).alias("_f")))
    both = lab.unionByName(feat, allowMissingColumns=True).select("_k", "_t", "_side", "_h", "_l", "_f")
    of = {f.name: f.dataType for f in both.schema}
    schema = T.StructType([T.StructField("pid", T.IntegerType()), T.StructField("edge", T.BooleanType()),
                           T.StructField("head", of["_k"]), T.StructField("_k", of["_k"]),
                           T.StructField("_l", of["_l"]), T.StructField("_f", of["_f"])])
    t = ranged.scanned(both, ["_k", "_t", "_side", "_h"], _last_features, schema, "asof_join")

    edges = t.filter("edge")
    ends = edges.select("pid", "_k", "_f", F.lit(False).alias("start"))
    starts = edges.select("pid", F.col("head").alias("_k"), F.lit(None).cast(of["_f"]).alias("_f"), F.lit(True).alias("start"))
    before = Window.partitionBy("_k").orderBy("pid").rangeBetween(Window.unboundedPreceding, -1)
    carried = (ends.unionByName(starts).withColumn("_carried", F.last("_f", ignorenulls=True).over(before))
               .filter("start").select("pid", "_k", "_carried"))
    match = F.coalesce("_f", "_carried")
    sel = [F.col("_l")[f"l{i}"].alias(c) for i, c in enumerate(labels.columns)]
    sel += [match[f"f{i}"].alias(f"feature_{c}" if c == feature_time else c) for i, c in enumerate(cols)]
    return (t.filter("NOT edge").join(F.broadcast(carried), ["pid", "_k"], "left")  # one row per partition of the scan
            .select(*sel))


def label_spine(events: DataFrame, event_type: str = "purchase") -> DataFrame:
    """Labels for training sets: (user_id, label_date) of the given event type."""
    return (events.filter(F.col("event_type") == event_type)
            .select("user_id", F.to_date("timestamp").alias("label_date"))
            .distinct())


"""Distributions of published data as mergeable quantile sketches (KLL), one per day and feature.

A published day is summarised once (``daily_sketches``, one grouped aggregate) and kept as
plain Parquet partitioned by date beside the table; a day published again replaces its
partition. Everything later (quantiles, drift, the distribution rule) merges the days'
sketches and never reads the feature rows again, so a year of baseline costs one small
row per day and feature.

Error: a rank read from a sketch of parameter ``k`` is off by at most ``rank_error(k)`` of
the rows (99 % confidence, merges included); up to about ``k`` values it is exact. Minimum,
maximum and counts are exact. ``points`` adds at most ``1 / (m - 1)``.

Nulls and NaN are counted in ``nulls`` and take no further part; a day or feature without
values keeps a row with ``rows`` 0 or no minimum, and gives no points.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurekit.functions import sizing

K = 2048
POINTS = 1001


def rank_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch, 99 % confidence (the library's published fit)."""
    return 2.296 / k ** 0.9723  # fixed values


def daily_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("date",), k: int = K) -> DataFrame:
    """(by..., feature, rows, nulls, min, max, sketch): all columns in one aggregate,
    combined on the map side, so what is shuffled is a sketch per task, day and feature."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.count(x).alias(f"_n{i}"), F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}"),
                 F.kll_sketch_agg_double(x, F.lit(k)).alias(f"_s{i}")]
    per_feature = F.array(*[F.struct(
        F.lit(c).alias("feature"), (F.col("rows") - F.col(f"_n{i}")).alias("nulls"), F.col(f"_lo{i}").alias("min"),
        F.col(f"_hi{i}").alias("max"), F.when(F.col(f"_n{i}") > 0, F.col(f"_s{i}")).alias("sketch"))
        for i, c in enumerate(columns)])
    return df.groupBy(*by).agg(*aggs).select(*by, "rows", F.inline(per_feature)).select(
        *by, "feature", "rows", "nulls", "min", "max", "sketch")


def store_sketches(df: DataFrame, path: str, columns: Sequence[str], start: dt.date, end: dt.date,
                   k: int = K) -> None:
    """Sketches of the days ``start`` to ``end`` of ``df`` (a ``date`` column) replace those
    stored below ``path``; a day that has no rows any more is stored with 0 rows."""
    days = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    days = days.select("date", F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    made = daily_sketches(df.filter(F.col("date").between(F.lit(start), F.lit(end))), columns, k=k)
    full = days.join(made, ["date", "feature"], "left").select(
        "date", "feature", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("rows", "nulls")],
        "min", "max", "sketch")
    (full.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(path))


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    """All stored days; a filter on ``date`` prunes the folders read."""
    return spark.read.schema("feature string, rows long, nulls long, min double, max double, sketch binary, "
                             "date date").parquet(path)


def merged(sketches: DataFrame, by: Sequence[str], k: int = K) -> DataFrame:
    """(by..., rows, nulls, min, max, sketch): the sketches of each group merged into one."""
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("min").alias("min"),
        F.max("max").alias("max"), F.when(F.count("sketch") > 0, F.kll_merge_agg_double("sketch", F.lit(k))).alias("sketch"))


def quantiles(merged_: DataFrame, by: Sequence[str], ps: Sequence[float]) -> DataFrame:
    """(by..., p, quantile): the least value whose rank reaches p; null without values."""
    out = F.array(*[F.struct(F.lit(p).alias("p"), F.when(F.col("sketch").isNotNull(), F.kll_sketch_get_quantile_double(
        "sketch", F.lit(p))).alias("quantile")) for p in ps])
    return merged_.select(*by, F.inline(out))


def points(merged_: DataFrame, by: Sequence[str], m: int = POINTS) -> DataFrame:
    """(by..., x): ``m`` equally weighted values that stand for each distribution, the
    quantiles at ranks 0 (the minimum), 1/(m-1), ..., 1 (the maximum)."""
    ranks = F.array(*[F.lit(i / (m - 1)) for i in range(m)])
    return merged_.where("sketch IS NOT NULL").select(*by, F.explode(F.kll_sketch_get_quantile_double(
        "sketch", ranks)).alias("x"))


def distances(points_: DataFrame, group: str = "feature") -> DataFrame:
    """(group, distance): greatest difference of the cumulative shares of the windows
    ``baseline`` and ``current`` (Kolmogorov-Smirnov); null where one of them has no
    points. A window's partition holds the points of a group, a fixed number."""
    def is_(w: str) -> Column:
        return (F.col("window") == w).cast("long")

    upto = Window.partitionBy(group).orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    all_ = Window.partitionBy(group)
    shares = [F.try_divide(F.sum(is_(w)).over(upto), F.sum(is_(w)).over(all_)) for w in ("baseline", "current")]
    return points_.select(group, F.abs(shares[0] - shares[1]).alias("d")).groupBy(group).agg(F.max("d").alias("distance"))


def distribution_rule(points_: DataFrame, max_distance: float, group: str = "feature") -> DataFrame:
    """A19, the distribution rule on sketches: a verdict per feature, in the columns of
    ``quality.evaluate``; a feature without baseline or current values fails."""
    d = F.col("distance")
    return distances(points_, group).select(
        F.concat(F.lit("distribution_within:"), F.col(group)).alias("rule"), F.lit("distribution_within").alias("kind"),
        F.col(group).alias("column"), d.alias("observed"),
        F.when(d <= F.lit(max_distance), 0).otherwise(1).cast("long").alias("failures"),
        F.coalesce(d <= F.lit(max_distance), F.lit(False)).alias("passed"))


def rank_check(df: DataFrame, quantiles_: DataFrame, columns: Sequence[str], slack: float) -> DataFrame:
    """(feature, p, within): whether each quantile's true ranks in ``df`` come within ``slack``
    of p: the share below it is at most p + slack, the share up to it at least p - slack. One pass:
    the quantiles (features x p rows) are joined to the rows and counted on the map side."""
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for c in columns])
    x = df.select(F.inline(arr)).where(F.col("x").isNotNull() & ~F.isnan("x"))
    hit = x.join(sizing.broadcast_if_small(quantiles_), "feature").groupBy("feature", "p").agg(
        F.avg((F.col("x") < F.col("quantile")).cast("double")).alias("below"),
        F.avg((F.col("x") <= F.col("quantile")).cast("double")).alias("upto"))
    return hit.select("feature", "p", ((F.col("below") <= F.col("p") + slack) & (F.col("upto") >= F.col("p") - slack))
                      .alias("within"))

"""Distribution drift between a baseline and a current window.

PSI over fixed equal-width bins of the baseline range (values outside are
clamped to the edge bins), each share floored at 1e-4; drift is flagged when
PSI > 0.2. Mean shift is |mean_cur − mean_base| / stddev_base.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# PSI share floor and drift flag threshold (published convention).
PSI_FLOOR = 1e-4
PSI_THRESHOLD = 0.2


def long_form(df: DataFrame, features: Sequence[str], window_col: str) -> DataFrame:
    """(window, feature, x) rows — a narrow unpivot."""
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in features])
    return df.select(F.col(window_col).alias("window"), F.inline(arr))


def psi(long_df: DataFrame, group: str = "feature", bins: int = 10) -> DataFrame:
    """PSI per group of a (window ∈ baseline|current, group, x) table.

    A group without a current window has every share there at the floor; one without
    a baseline has no bins, so its PSI and flag are NULL. A constant baseline is one bin.
    Two passes: the baseline's range per group, then counts per bin (map-side
    combined, at most ``bins`` rows a group after it). The ranges, a row per group, are
    broadcast: joined by shuffle, all rows of a group would land in one task. Bins empty
    on both sides add nothing to the sum."""
    x = long_df.filter(F.col("x").isNotNull())
    in_base = F.col("window") == "baseline"
    edges = x.groupBy(F.col(group).alias("_g")).agg(F.min(F.when(in_base, F.col("x"))).alias("_lo"),
                                                    F.max(F.when(in_base, F.col("x"))).alias("_hi"))
    raw = F.floor(F.try_divide(F.col("x") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * bins)
    b = (F.when(F.col("_lo").isNull(), F.lit(None).cast("int")).when(F.col("_hi") == F.col("_lo"), F.lit(0))
         .otherwise(F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))).cast("int"))
    counts = (x.join(F.broadcast(edges), F.col(group).eqNullSafe(F.col("_g")))
              .groupBy(group, b.alias("bin"))
              .agg(F.count_if(in_base).alias("nb"), F.count_if(F.col("window") == "current").alias("nc")))
    per = counts.groupBy(group).agg(F.sum("nb").alias("tb"), F.sum("nc").alias("tc"),
                                    F.collect_list(F.struct("bin", "nb", "nc")).alias("bins"))

    def share(n: Column, total: str) -> Column:
        return F.greatest(F.coalesce(F.try_divide(n, F.col(total)), F.lit(0.0)), F.lit(PSI_FLOOR))

    def term(r: Column) -> Column:
        pb, pc = share(r["nb"], "tb"), share(r["nc"], "tc")
        return (pc - pb) * F.log(pc / pb)

    total = F.aggregate(F.transform(F.array_sort("bins"), term), F.lit(0.0), lambda a, t: a + t)
    return (per.select(group, F.when(F.col("tb") > 0, total).alias("psi"))
            .withColumn("drift_detected", F.col("psi") > PSI_THRESHOLD))


def mean_shift(long_df: DataFrame, group: str = "feature") -> DataFrame:
    """A11 (second score): |mean_current − mean_baseline| / stddev_baseline; NULL where
    a window is missing or the baseline does not vary."""
    g = long_df.groupBy(group).agg(
        F.avg(F.when(F.col("window") == "baseline", F.col("x"))).alias("mean_baseline"),
        F.stddev_samp(F.when(F.col("window") == "baseline", F.col("x"))).alias("stddev_baseline"),
        F.avg(F.when(F.col("window") == "current", F.col("x"))).alias("mean_current"))
    return g.withColumn("shift", F.try_divide(F.abs(F.col("mean_current") - F.col("mean_baseline")),
                                              F.col("stddev_baseline")))

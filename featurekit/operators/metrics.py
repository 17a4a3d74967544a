"""Metrics as a long time-series table ``(ts, seq, name, type, labels, value)``.

Counters are sums of increments, gauges keep their last value, histograms are
cumulative bucket counts; all are grouped aggregates with map-side partial
aggregation, so a single hot series costs one partial row per task.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.functions import ranged
from featurekit.functions.labels import labels_key, prometheus_labels

# Default latency histogram upper bounds (seconds), in order.
DEFAULT_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]

MAX_BROADCAST_RANKS = 200_000  # ranks that exact_percentiles broadcasts; beyond it they are joined


def counter_totals(metrics: DataFrame) -> DataFrame:
    """A5: total of increments per (name, labels)."""
    return (metrics.filter(F.col("type") == "counter")
            .groupBy("name", labels_key().alias("labels"))
            .agg(F.sum("value").alias("total")))


def gauge_latest(metrics: DataFrame) -> DataFrame:
    """Last value per (name, labels), ordered by (ts, seq)."""
    return (metrics.filter(F.col("type") == "gauge")
            .groupBy("name", labels_key().alias("labels"))
            .agg(F.max_by("value", F.struct("ts", "seq")).alias("value")))


def histogram(metrics: DataFrame, by: Sequence[str] = ("name",), buckets: Sequence[float] = DEFAULT_BUCKETS,
              grouping_sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """One row per histogram: ``cum`` array of ``count(value <= b)`` per
    bound (cumulative by construction), plus count (the +Inf bucket) and sum.
    ``grouping_sets`` computes e.g. per-model and overall in one pass."""
    v = F.col("value")
    aggs = [F.array(*[F.count_if(v <= F.lit(b)) for b in buckets]).alias("cum"),
            F.count(v).alias("count"), F.sum(v).alias("sum")]
    h = metrics.filter(F.col("type") == "histogram")
    if grouping_sets:
        cols = sorted({c for gs in grouping_sets for c in gs})
        return h.groupingSets([[F.col(c) for c in gs] for gs in grouping_sets], *cols).agg(*aggs)
    return h.groupBy(*by).agg(*aggs)


def bucket_rows(hist: DataFrame, keys: Sequence[str], buckets: Sequence[float] = DEFAULT_BUCKETS) -> DataFrame:
    """Unpivot a histogram to (keys..., le, cum_count) rows including ``+Inf``."""
    les = [repr(float(b)) for b in buckets] + ["+Inf"]
    arr = F.arrays_zip(F.array(*[F.lit(s) for s in les]).alias("le"),
                       F.concat("cum", F.array("count")).alias("cum_count"))
    return hist.select(*keys, F.inline(arr))


def percentile_from_buckets(cum: Column, count: Column, p: float,
                            buckets: Sequence[float] = DEFAULT_BUCKETS) -> Column:
    """A10 (bucket estimate): first bound whose cumulative count reaches
    ``p * count``, reported as the midpoint with the previous bound (0 before
    the first); the last bound when none reaches it; 0.0 for an empty histogram."""
    mids = [(0.0 + buckets[0]) / 2] + [(buckets[i - 1] + buckets[i]) / 2 for i in range(1, len(buckets))]
    pairs = F.arrays_zip(cum.alias("c"), F.array(*[F.lit(m) for m in mids]).alias("m"))
    hit = F.filter(pairs, lambda x: x["c"] >= count * F.lit(p))
    return (F.when(count == 0, F.lit(0.0))
            .when(F.size(hit) > 0, hit[0]["m"])
            .otherwise(F.lit(float(buckets[-1]))))


_SCANNED_TOTALS = ("pid int, edge boolean, head_name string, head_labels string, name string, labels string, "
                   "ts timestamp_ntz, seq long, value double, total double, n long")


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the non-null values of each series since the partition's start, then the edge row."""
    pid = ranged.partition_id()
    head: list[pa.Array] = []
    last: list[pa.Array | None] = [None, None]
    total, n, names = 0.0, 0, [f.split()[0] for f in _SCANNED_TOTALS.split(", ")]
    types = [pa.int32(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.string(), pa.timestamp("us"),
             pa.int64(), pa.float64(), pa.float64(), pa.int64()]

    def out(columns, rows):
        return pa.RecordBatch.from_arrays(
            [pa.nulls(rows, t) if c is None else pa.array(c, t) if not isinstance(c, pa.Array) else c.cast(t)
             for c, t in zip(columns, types, strict=True)], names)

    for b in batches:
        if not b.num_rows:
            continue
        series = [b.column(0), b.column(1)]
        group = np.cumsum(ranged.changes(series[0], last[0]) | ranged.changes(series[1], last[1]))
        head = head or [c.slice(0, 1) for c in series]
        value = b.column(4).to_numpy(zero_copy_only=False)
        present = np.asarray(b.column(4).is_valid())
        sums = pd.DataFrame({"v": np.where(present, value, 0.0), "n": present.astype(np.int64)}).groupby(group).cumsum()
        going_on = group == 0
        sums.loc[going_on, "v"] += total
        sums.loc[going_on, "n"] += n
        total, n = float(sums["v"].iat[-1]), int(sums["n"].iat[-1])
        last = [c.slice(b.num_rows - 1) for c in series]
        yield out([[pid] * b.num_rows, [False] * b.num_rows, None, None, *series, b.column(2), b.column(3),
                   b.column(4), sums["v"].to_numpy(), sums["n"].to_numpy()], b.num_rows)
    if head:
        yield out([[pid], [True], *head, *last, None, None, None, [total], [n]], 1)


def running_total(metrics: DataFrame) -> DataFrame:
    """Running total of each counter series in (ts, seq) order; a null value adds
    nothing, and before the first value the total is null.

    A scan by physical range partition (``functions.ranged``): the rows are range-partitioned
    by (series, ts, seq), each partition sums its series from its own start, and only the
    series a partition starts with needs an offset, the sum of what the partitions before
    ended with: a window over one row per partition. A series is split however its rows
    lie in time; only rows equal in all four columns stay together.
    """
    c = (metrics.filter(F.col("type") == "counter")
         .select("name", labels_key().alias("labels"), "ts", "seq", F.col("value").cast("double").alias("value")))
    t = ranged.scanned(c, ["name", "labels", "ts", "seq"], _totals, _SCANNED_TOTALS, "running_total")
    edges = t.filter("edge")
    ends = edges.select("pid", "name", "labels", "total", "n", F.lit(False).alias("start"))
    starts = edges.select("pid", F.col("head_name").alias("name"), F.col("head_labels").alias("labels"),
                          F.lit(None).cast("double").alias("total"), F.lit(0).cast("long").alias("n"),
                          F.lit(True).alias("start"))
    before = Window.partitionBy("name", "labels").orderBy("pid").rangeBetween(Window.unboundedPreceding, -1)
    offsets = (ends.unionByName(starts)
               .withColumn("_off", F.coalesce(F.sum("total").over(before), F.lit(0.0)))
               .withColumn("_off_n", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .filter("start").select("pid", F.col("name").alias("_name"), F.col("labels").alias("_labels"), "_off", "_off_n"))
    rows = t.filter("NOT edge")
    return (rows.join(F.broadcast(offsets),  # one row per partition of the scan
                      (rows["pid"] == offsets["pid"]) & rows["name"].eqNullSafe(F.col("_name"))
                      & rows["labels"].eqNullSafe(F.col("_labels")), "left")
            .select("ts", "seq", "name", "labels", "value",
                    F.when(F.col("n") + F.coalesce("_off_n", F.lit(0)) > 0,
                           F.col("total") + F.coalesce("_off", F.lit(0.0))).alias("running_total")))


def fmt(v: Column) -> Column:
    """Ten significant digits, whatever the magnitude."""
    return F.format_string("%.9e", v)


def prometheus_lines(metrics: DataFrame, buckets: Sequence[float] = DEFAULT_BUCKETS) -> DataFrame:
    """Prometheus text lines — counters and gauges with their labels,
    histogram ``_bucket{le=..}``, ``_sum`` and ``_count`` lines."""
    def with_labels(name: Column, labels: Column) -> Column:
        return F.when(labels == "", name).otherwise(F.concat(name, F.lit("{"), labels, F.lit("}")))

    series = metrics.filter(F.col("type").isin("counter", "gauge"))
    agg = (series.groupBy("name", "type", prometheus_labels().alias("pl"))
           .agg(F.sum("value").alias("total"), F.max_by("value", F.struct("ts", "seq")).alias("last")))
    cg = agg.select(F.concat(with_labels(F.col("name"), F.col("pl")), F.lit(" "),
                             fmt(F.when(F.col("type") == "counter", F.col("total")).otherwise(F.col("last"))))
                    .alias("line"))
    # histograms per series and, without labels, over all series of a name
    h = histogram(metrics.withColumn("pl", prometheus_labels()), buckets=buckets, grouping_sets=[["name", "pl"], ["name"]])
    b = bucket_rows(h, ["name", "pl"], buckets).select(
        F.concat(F.col("name"), F.lit("_bucket{"),
                 F.when(F.coalesce("pl", F.lit("")) == "", "").otherwise(F.concat("pl", F.lit(","))),
                 F.lit('le="'), F.col("le"), F.lit('"} '), F.col("cum_count").cast("string")).alias("line"))
    pl = F.coalesce("pl", F.lit(""))
    sc = h.select(F.inline(F.array(
        F.struct(F.concat(with_labels(F.concat("name", F.lit("_sum")), pl), F.lit(" "), fmt(F.col("sum"))).alias("line")),
        F.struct(F.concat(with_labels(F.concat("name", F.lit("_count")), pl), F.lit(" "),
                          F.col("count").cast("string")).alias("line")))))
    return cg.unionByName(b).unionByName(sc)


def metrics_json(metrics: DataFrame) -> DataFrame:
    """One JSON document per series: counters total, gauges last value,
    histograms count/sum/mean/p50/p95/p99."""
    cg = (metrics.filter(F.col("type").isin("counter", "gauge"))
          .groupBy("name", "type", labels_key().alias("labels"))
          .agg(F.sum("value").alias("total"), F.max_by("value", F.struct("ts", "seq")).alias("last"))
          .select("name", F.to_json(F.struct("name", "type", "labels",
                                             F.when(F.col("type") == "counter", F.col("total"))
                                             .otherwise(F.col("last")).alias("value"))).alias("json")))
    # per series and, without labels, over all series of a name
    h = histogram(metrics.withColumn("series", labels_key()), grouping_sets=[["name", "series"], ["name"]])
    hj = h.select("name", F.to_json(F.struct(
        "name", F.lit("histogram").alias("type"), F.col("series").alias("labels"), "count", "sum",
        F.when(F.col("count") > 0, F.col("sum") / F.col("count")).otherwise(F.lit(0.0)).alias("mean"),
        percentile_from_buckets(F.col("cum"), F.col("count"), 0.5).alias("p50"),
        percentile_from_buckets(F.col("cum"), F.col("count"), 0.95).alias("p95"),
        percentile_from_buckets(F.col("cum"), F.col("count"), 0.99).alias("p99"))).alias("json"))
    return cg.unionByName(hj)


_LOW_BITS = np.int64(0x7FFFFFFFFFFFFFFF)


@F.arrow_udf(T.LongType())
def _ordered_bits(v: pa.Array) -> pa.Array:
    """Longs in the order of the doubles: both zeros are equal, NaN is the largest."""
    x = v.to_numpy(zero_copy_only=False) + 0.0
    b = np.where(np.isnan(x), np.nan, x).view(np.int64)
    return pa.array(b ^ ((b >> 63) & _LOW_BITS))


@F.arrow_udf(T.DoubleType())
def _of_ordered_bits(v: pa.Array) -> pa.Array:
    b = v.to_numpy(zero_copy_only=False).astype(np.int64)
    return pa.array((b ^ ((b >> 63) & _LOW_BITS)).view(np.float64))


def _cell_of(cells: Column, rank: Column) -> Column:
    """The cell that holds a rank (from 0) among sorted cells, and the rows before it."""
    def step(acc, c):
        further = acc["seen"] + c["n"]
        return (F.when(acc["cell"].isNotNull(), acc)
                .when(further > rank, F.struct(acc["seen"].alias("seen"), c["cell"].alias("cell")))
                .otherwise(F.struct(further.alias("seen"), F.lit(None).cast("long").alias("cell"))))
    return F.aggregate(cells, F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("cell")), step)


def exact_percentiles(df: DataFrame, group: Sequence[str], value: str, ps: Sequence[float]) -> DataFrame:
    """A10 (exact): linearly interpolated percentiles, equal to ``percentile`` / DuckDB
    ``quantile_cont``, by radix selection; nulls are left out.

    A value's 64 ordered bits are read 16 at a time. Each of the four passes counts the rows
    of every cell that still holds a wanted rank by their next 16 bits (combined on the map
    side: at most 65,536 counts per cell, of rows that may be any number) and moves each rank
    into the cell its count leads to. After the fourth a cell is one value. The passes are
    one plan with four scans; nothing is sorted, kept or sampled. The ranks of all groups are
    broadcast where the groups were counted to be few, else joined.
    Output: group columns, ``p``, ``value``.
    """
    g = [f"_g{i}" for i in range(len(group))]
    x = (df.select(*[F.col(c).alias(k) for c, k in zip(group, g, strict=True)], F.col(value).cast("double").alias("_v"))
         .filter(F.col("_v").isNotNull()).select(*g, _ordered_bits("_v").alias("_b")))
    most = MAX_BROADCAST_RANKS // max(1, 2 * len(ps))
    few = not g or df.select(*group).distinct().limit(most + 1).count() <= most

    def cells(rows: DataFrame, keys: Sequence[str], shift: int) -> DataFrame:
        counts = rows.groupBy(*keys, F.shiftright("_b", shift).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        return counts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("_cells"))

    def moved(found: DataFrame) -> DataFrame:
        """A row per cell that holds ranks, with those ranks counted from the cell's start."""
        def place(t):
            at = _cell_of(F.col("_cells"), t["r"])
            return F.struct(at["cell"].alias("cell"), t["i"].alias("i"), (t["r"] - at["seen"]).alias("r"))
        placed = found.select(*g, "_n", F.transform("_ranks", place).alias("_placed"))
        return (placed.select(*g, "_n", "_placed", F.explode(F.array_distinct(F.col("_placed.cell"))).alias("_cell"))
                .select(*g, "_n", "_cell", F.transform(
                    F.filter("_placed", lambda t: t["cell"] == F.col("_cell")),
                    lambda t: F.struct(t["i"].alias("i"), t["r"].alias("r"))).alias("_ranks")))

    n = F.aggregate("_cells", F.lit(0).cast("long"), lambda a, c: a + c["n"])
    wanted = [F.struct(F.lit(2 * j + up).alias("i"), (F.ceil if up else F.floor)(F.lit(float(p)) * (F.col("_n") - 1)).cast("long").alias("r"))
              for j, p in enumerate(ps) for up in (0, 1)]
    first = cells(x, g, 48) if g else cells(x, [], 48).filter(F.size("_cells") > 0)
    state = moved(first.withColumn("_n", n).withColumn("_ranks", F.array(*wanted)))
    for shift in (32, 16, 0):
        held = state.select(*[F.col(k).alias(f"{k}s") for k in g], "_n", "_cell", "_ranks")
        on = F.shiftright("_b", shift + 16) == F.col("_cell")
        for k in g:
            on = on & F.col(k).eqNullSafe(F.col(f"{k}s"))
        state = moved(cells(x.join(F.broadcast(held) if few else held, on), [*g, "_n", "_ranks"], shift))
    at = (state.select(*g, "_n", F.explode("_ranks").alias("_r"), "_cell")
          .select(*g, "_n", F.col("_r.i").alias("_i"), _of_ordered_bits("_cell").alias("_v")))
    both = at.groupBy(*g, "_n").agg(*[F.max(F.when(F.col("_i") == i, F.col("_v"))).alias(f"_v{i}") for i in range(2 * len(ps))])

    def between(j: int, p: float) -> Column:
        lo, hi, pos = F.col(f"_v{2 * j}"), F.col(f"_v{2 * j + 1}"), F.lit(float(p)) * (F.col("_n") - 1)
        return F.when(lo == hi, lo).otherwise(lo + (pos - F.floor(pos)) * (hi - lo))

    return (both.select(*g, F.inline(F.array(*[F.struct(F.lit(float(p)).alias("p"), between(j, p).alias("value"))
                                               for j, p in enumerate(ps)])))
            .select(*[F.col(k).alias(c) for c, k in zip(group, g, strict=True)], "p", "value"))

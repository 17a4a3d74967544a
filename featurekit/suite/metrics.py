"""Registered queries: metrics time series, histograms, percentiles, exports, drift.

Metrics table derivation from ``events`` (one narrow explode, identical in the
oracle SQL): every event increments ``events_total{event_type}``; error events
increment ``job_failure_total{job_type,error_type}``, others
``job_success_total{job_type}``; clicks and views observe
``prediction_latency_seconds{model}`` = value / 1000 (every tenth event: value / 100);
purchases increment ``predictions_total{model}`` and set ``model_age_hours{model}`` =
3 * value; signups set ``feature_null_rate{feature}`` = value / 1000 and
``feature_drift_detected{feature}`` = 1 where value > 50; views set
``online_store_keys{store_type}`` = floor(value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import drift
from featurekit.operators import metrics as M
from featurekit.operators.features import UserFeaturesDaily, date_batches
from featurekit.sources import tables
from featurekit.suite.common import registrar, batched_sql

QUERIES: dict = {}
ORACLES: dict = {}


register = registrar(QUERIES, ORACLES)


# Label vocabularies of the derived metrics.
JOB_TYPES = ["backfill", "sync", "prediction", "maintenance"]
ERROR_TYPES = ["timeout", "connection_error", "permission_denied"]
FEATURES = ["total_value", "event_count"]


def metrics_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = tables.events_with_ids(spark, sf_dir)
    et, uid, eid, v = F.col("event_type"), F.col("user_id"), F.col("event_id"), F.col("value")
    jt = F.element_at(F.array(*[F.lit(x) for x in JOB_TYPES]), (uid % 4 + 1).cast("int"))
    er = F.element_at(F.array(*[F.lit(x) for x in ERROR_TYPES]), (eid % 3 + 1).cast("int"))
    model = F.concat(F.lit("model_"), (uid % 3).cast("string"))
    feat = F.element_at(F.array(*[F.lit(x) for x in FEATURES]), (uid % 2 + 1).cast("int"))

    def m(slot, name, typ, labels, value, cond=None):
        s = F.struct(F.lit(slot).alias("slot"), F.lit(name).alias("name"), F.lit(typ).alias("type"),
                     labels.alias("labels"), value.cast("double").alias("value"))
        return s if cond is None else F.when(cond, s)

    rows = F.array(
        m(0, "events_total", "counter", F.create_map(F.lit("event_type"), et), F.lit(1.0)),
        m(1, "job_failure_total", "counter",
          F.create_map(F.lit("job_type"), jt, F.lit("error_type"), er), F.lit(1.0), et == "error"),
        m(1, "job_success_total", "counter", F.create_map(F.lit("job_type"), jt), F.lit(1.0), et != "error"),
        m(2, "prediction_latency_seconds", "histogram", F.create_map(F.lit("model"), model),
          F.when(eid % 10 == 0, v / 100.0).otherwise(v / 1000.0), et.isin("click", "view")),
        m(3, "predictions_total", "counter", F.create_map(F.lit("model"), model), F.lit(1.0), et == "purchase"),
        m(4, "feature_null_rate", "gauge", F.create_map(F.lit("feature"), feat), v / 1000.0, et == "signup"),
        m(5, "online_store_keys", "gauge", F.create_map(F.lit("store_type"), F.lit("parquet")), F.floor(v),
          et == "view"),
        m(6, "model_age_hours", "gauge", F.create_map(F.lit("model"), model), v * 3.0, et == "purchase"),
        m(7, "feature_drift_detected", "gauge", F.create_map(F.lit("feature"), feat), (v > 50).cast("double"),
          et == "signup"),
    )
    # inline + null filter instead of a filter() lambda: stays in generated code
    return (ev.select(F.col("timestamp").alias("ts"), eid, F.inline(rows))
            .filter(F.col("name").isNotNull())
            .select("ts", (F.col("event_id") * 10 + F.col("slot")).alias("seq"), "name", "type",
                    "labels", "value"))


_JT = "CASE user_id % 4 WHEN 0 THEN 'backfill' WHEN 1 THEN 'sync' WHEN 2 THEN 'prediction' ELSE 'maintenance' END"
_ER = "CASE event_id % 3 WHEN 0 THEN 'timeout' WHEN 1 THEN 'connection_error' ELSE 'permission_denied' END"
_MODEL = "'model_' || CAST(user_id % 3 AS VARCHAR)"
_FEAT = "CASE user_id % 2 WHEN 0 THEN 'total_value' ELSE 'event_count' END"

METRICS_SQL = f"""
SELECT ts, event_id * 10 AS seq, 'events_total' AS name, 'counter' AS type, 'event_type=' || event_type AS labels,
       1.0 AS value, event_type AS l1, NULL AS l2 FROM events
UNION ALL SELECT ts, event_id * 10 + 1, 'job_failure_total', 'counter',
       'error_type=' || {_ER} || ',job_type=' || {_JT}, 1.0, {_JT}, {_ER} FROM events WHERE event_type = 'error'
UNION ALL SELECT ts, event_id * 10 + 1, 'job_success_total', 'counter', 'job_type=' || {_JT}, 1.0, {_JT}, NULL
       FROM events WHERE event_type <> 'error'
UNION ALL SELECT ts, event_id * 10 + 2, 'prediction_latency_seconds', 'histogram', 'model=' || {_MODEL},
       CASE WHEN event_id % 10 = 0 THEN value / 100.0 ELSE value / 1000.0 END, {_MODEL}, NULL
       FROM events WHERE event_type IN ('click', 'view')
UNION ALL SELECT ts, event_id * 10 + 3, 'predictions_total', 'counter', 'model=' || {_MODEL}, 1.0, {_MODEL}, NULL
       FROM events WHERE event_type = 'purchase'
UNION ALL SELECT ts, event_id * 10 + 4, 'feature_null_rate', 'gauge', 'feature=' || {_FEAT}, value / 1000.0,
       {_FEAT}, NULL FROM events WHERE event_type = 'signup'
UNION ALL SELECT ts, event_id * 10 + 5, 'online_store_keys', 'gauge', 'store_type=parquet', floor(value),
       'parquet', NULL FROM events WHERE event_type = 'view'
UNION ALL SELECT ts, event_id * 10 + 6, 'model_age_hours', 'gauge', 'model=' || {_MODEL}, value * 3.0, {_MODEL}, NULL
       FROM events WHERE event_type = 'purchase'
UNION ALL SELECT ts, event_id * 10 + 7, 'feature_drift_detected', 'gauge', 'feature=' || {_FEAT},
       CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END, {_FEAT}, NULL FROM events WHERE event_type = 'signup'"""

BOUNDS = M.DEFAULT_BUCKETS
LES = [repr(float(b)) for b in BOUNDS]


def _hist_sql(group: str) -> str:
    cnts = ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS c{i}" for i, b in enumerate(BOUNDS))
    return f"""SELECT name, {group} AS model, {cnts}, count(value) AS n, sum(value) AS s
FROM ({METRICS_SQL}) WHERE type = 'histogram' GROUP BY name{', ' + group if group != 'NULL' else ''}"""


HIST_SQL = f"{_hist_sql('l1')} UNION ALL {_hist_sql('NULL')}"


def _pct_sql(p: float) -> str:
    mids = [BOUNDS[0] / 2] + [(BOUNDS[i - 1] + BOUNDS[i]) / 2 for i in range(1, len(BOUNDS))]
    whens = " ".join(f"WHEN c{i} >= n * {p} THEN CAST({mids[i]!r} AS DOUBLE)" for i in range(len(BOUNDS)))
    return f"round(CASE WHEN n = 0 THEN CAST(0.0 AS DOUBLE) {whens} ELSE CAST({BOUNDS[-1]!r} AS DOUBLE) END, 6)"


@register("counter_totals", f"""
SELECT name, labels, round(sum(value), 6) AS total FROM ({METRICS_SQL}) WHERE type = 'counter' GROUP BY 1, 2""")
def counter_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: counter totals per (name, labels); labels as a sorted k=v key."""
    return M.counter_totals(metrics_from_events(spark, sf_dir))


@register("gauge_latest", f"""
SELECT name, labels, round(arg_max(value, (ts, seq)), 6) AS value
FROM ({METRICS_SQL}) WHERE type = 'gauge' GROUP BY 1, 2""")
def gauge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value of every gauge series."""
    return M.gauge_latest(metrics_from_events(spark, sf_dir))


@register("job_totals", f"""
SELECT round(coalesce(sum(value) FILTER (WHERE contains(name, 'success')), 0), 6) AS total_success,
       round(coalesce(sum(value) FILTER (WHERE contains(name, 'failure')), 0), 6) AS total_failure
FROM ({METRICS_SQL}) WHERE type = 'counter'""")
def job_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Success and failure totals over counters whose name contains the word."""
    c = metrics_from_events(spark, sf_dir).filter(F.col("type") == "counter")
    return c.agg(F.coalesce(F.sum(F.when(F.col("name").contains("success"), F.col("value"))), F.lit(0.0))
                 .alias("total_success"),
                 F.coalesce(F.sum(F.when(F.col("name").contains("failure"), F.col("value"))), F.lit(0.0))
                 .alias("total_failure"))


@register("job_failures_by_type", f"""
SELECT l1 AS job_type, l2 AS error_type, round(sum(value), 6) AS failures
FROM ({METRICS_SQL}) WHERE name = 'job_failure_total' GROUP BY 1, 2""")
def job_failures_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures per (job_type, error_type)."""
    f = metrics_from_events(spark, sf_dir).filter(F.col("name") == "job_failure_total")
    return (f.groupBy(F.col("labels")["job_type"].alias("job_type"), F.col("labels")["error_type"].alias("error_type"))
            .agg(F.sum("value").alias("failures")))


def _hist(spark, sf_dir):
    m = metrics_from_events(spark, sf_dir).withColumn("model", F.col("labels")["model"])
    return M.histogram(m, grouping_sets=[["name", "model"], ["name"]])


_BUCKET_ROWS_SQL = " UNION ALL ".join(
    [f"SELECT name, model, '{le}' AS le, c{i} AS cum_count FROM h" for i, le in enumerate(LES)]
    + ["SELECT name, model, '+Inf', n FROM h"])


@register("histogram_buckets", f"WITH h AS ({HIST_SQL}) {_BUCKET_ROWS_SQL}")
def histogram_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative bucket counts per histogram, per model and overall (one
    grouping-sets aggregate)."""
    return M.bucket_rows(_hist(spark, sf_dir), ["name", "model"])


@register("histogram_percentiles", f"""
WITH h AS ({HIST_SQL})
SELECT name, model, n AS count, round(s, 6) AS sum, round(CASE WHEN n > 0 THEN s / n ELSE 0.0 END, 6) AS mean,
       {_pct_sql(0.5)} AS p50, {_pct_sql(0.95)} AS p95, {_pct_sql(0.99)} AS p99
FROM h""")
def histogram_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: bucket-midpoint percentile estimates p50/p95/p99 with count, sum, mean."""
    h = _hist(spark, sf_dir)
    c, n = F.col("cum"), F.col("count")
    return h.select("name", "model", "count", "sum",
                    F.when(n > 0, F.col("sum") / n).otherwise(F.lit(0.0)).alias("mean"),
                    M.percentile_from_buckets(c, n, 0.5).alias("p50"),
                    M.percentile_from_buckets(c, n, 0.95).alias("p95"),
                    M.percentile_from_buckets(c, n, 0.99).alias("p99"))


@register("latency_summary", f"""
WITH h AS ({HIST_SQL})
SELECT n AS count, round(CASE WHEN n > 0 THEN s / n * 1000 ELSE 0.0 END, 6) AS mean_ms,
       round(({_pct_sql(0.5)}) * 1000, 6) AS p50_ms, round(({_pct_sql(0.99)}) * 1000, 6) AS p99_ms
FROM h WHERE model IS NULL""")
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction latency count, mean, p50 and p99 in milliseconds."""
    m = metrics_from_events(spark, sf_dir)
    h = M.histogram(m, ["name"])
    c, n = F.col("cum"), F.col("count")
    return h.select("count", F.when(n > 0, F.col("sum") / n * 1000).otherwise(F.lit(0.0)).alias("mean_ms"),
                    (M.percentile_from_buckets(c, n, 0.5) * 1000).alias("p50_ms"),
                    (M.percentile_from_buckets(c, n, 0.99) * 1000).alias("p99_ms"))


@register("latency_percentiles_exact", f"""
SELECT l1 AS model, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
       round(quantile_cont(value, 0.99), 6) AS p99
FROM ({METRICS_SQL}) WHERE type = 'histogram' GROUP BY 1""")
def latency_percentiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 (exact): interpolated percentiles per model. A model may hold a third of all
    observations: the ranks are found by radix selection, which counts and never sorts."""
    h = (metrics_from_events(spark, sf_dir).filter(F.col("type") == "histogram")
         .withColumn("model", F.col("labels")["model"]))
    r = M.exact_percentiles(h, ["model"], "value", [0.5, 0.95, 0.99])
    pick = lambda q: F.max(F.when(F.col("p") == q, F.col("value")))
    return r.groupBy("model").agg(pick(0.5).alias("p50"), pick(0.95).alias("p95"), pick(0.99).alias("p99"))


@register("counter_running_total", f"""
SELECT CAST(ts AS VARCHAR) AS ts, seq, name, labels, value,
       round(sum(value) OVER (PARTITION BY name, labels ORDER BY ts, seq ROWS UNBOUNDED PRECEDING), 6) AS running_total
FROM ({METRICS_SQL}) WHERE type = 'counter'""")
def counter_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running total of every counter series (scan by range partition)."""
    return M.running_total(metrics_from_events(spark, sf_dir))


def _prom_labels(col: str) -> str:
    return f"""regexp_replace({col}, '([a-z_]+)=([^,]*)', '\\1="\\2"', 'g')"""


_SERIES = "CASE WHEN model IS NULL THEN '' ELSE 'model=\"' || model || '\",' END"
_SERIES_ONLY = "CASE WHEN model IS NULL THEN '' ELSE '{model=\"' || model || '\"}' END"


@register("prometheus_lines", f"""
WITH m AS ({METRICS_SQL}), h AS ({HIST_SQL})
SELECT name || CASE WHEN labels = '' THEN '' ELSE '{{' || {_prom_labels('labels')} || '}}' END || ' '
       || printf('%.9e', CASE WHEN type = 'counter' THEN sum(value) ELSE arg_max(value, (ts, seq)) END) AS line
FROM m WHERE type IN ('counter', 'gauge') GROUP BY name, type, labels
UNION ALL {" UNION ALL ".join(f"SELECT name || '_bucket{{' || {_SERIES} || 'le=\"{le}\"}} ' || CAST(c{i} AS VARCHAR) FROM h" for i, le in enumerate(LES))}
UNION ALL SELECT name || '_bucket{{' || {_SERIES} || 'le="+Inf"}} ' || CAST(n AS VARCHAR) FROM h
UNION ALL SELECT name || '_sum' || {_SERIES_ONLY} || ' ' || printf('%.9e', s) FROM h
UNION ALL SELECT name || '_count' || {_SERIES_ONLY} || ' ' || CAST(n AS VARCHAR) FROM h""")
def prometheus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prometheus exposition lines with full names and labels, written
    as a text file set and read back."""
    from featurekit.session import fresh_dir
    from featurekit.sinks import exports
    path = fresh_dir(spark, "prometheus")
    exports.write_prometheus(M.prometheus_lines(metrics_from_events(spark, sf_dir)), path)
    return exports.read_prometheus(spark, path)


@register("metrics_json", f"""
WITH m AS ({METRICS_SQL}), h AS ({HIST_SQL})
SELECT name, type, labels, round(CASE WHEN type = 'counter' THEN sum(value) ELSE arg_max(value, (ts, seq)) END, 6) AS value,
       CAST(NULL AS BIGINT) AS count, CAST(NULL AS DOUBLE) AS sum, CAST(NULL AS DOUBLE) AS mean,
       CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p95, CAST(NULL AS DOUBLE) AS p99
FROM m WHERE type IN ('counter', 'gauge') GROUP BY name, type, labels
UNION ALL
SELECT name, 'histogram', 'model=' || model, NULL, n, round(s, 6), round(CASE WHEN n > 0 THEN s / n ELSE 0.0 END, 6),
       {_pct_sql(0.5)}, {_pct_sql(0.95)}, {_pct_sql(0.99)}
FROM h""")
def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per series, histograms also over all series of a name,
    written as JSON lines and read back as typed columns."""
    from featurekit.session import fresh_dir
    from featurekit.sinks import exports
    path = fresh_dir(spark, "metrics_json")
    exports.write_json(M.metrics_json(metrics_from_events(spark, sf_dir)), path)
    return spark.read.schema("name string, type string, labels string, value double, count long, sum double, "
                             "mean double, p50 double, p95 double, p99 double").json(path)


# ---------------------------------------------------------------------- drift
DRIFT_FEATURES = ["event_count", "total_value"]


def _windows(df: DataFrame) -> DataFrame:
    b = date_batches(df)
    return (b.filter(F.col("batch").isin(0, 2))
            .withColumn("window", F.when(F.col("batch") == 0, "baseline").otherwise("current")))


def _psi_sql(long_sql: str, group: str) -> str:
    return f"""
WITH x AS ({long_sql}),
e AS (SELECT {group}, min(x) AS lo, max(x) AS hi FROM x WHERE w = 'baseline' GROUP BY 1),
bx AS (SELECT x.{group}, w, CAST(CASE WHEN e.hi = e.lo THEN 0
            ELSE least(greatest(floor((x.x - e.lo) / (e.hi - e.lo) * 10), 0), 9) END AS INTEGER) AS bin
       FROM x JOIN e ON x.{group} = e.{group}),
t AS (SELECT {group}, count(*) FILTER (WHERE w = 'baseline') AS tb, count(*) FILTER (WHERE w = 'current') AS tc
      FROM x GROUP BY 1),
g AS (SELECT t.*, bin FROM t, range(0, 10) r(bin)),
c AS (SELECT {group}, bin, count(*) FILTER (WHERE w = 'baseline') AS nb, count(*) FILTER (WHERE w = 'current') AS nc
      FROM bx GROUP BY 1, 2),
j AS (SELECT g.{group}, greatest(coalesce(nb, 0) / tb, 0.0001) AS pb, greatest(coalesce(nc, 0) / tc, 0.0001) AS pc
      FROM g LEFT JOIN c ON g.{group} = c.{group} AND g.bin = c.bin)
SELECT {group}, round(sum((pc - pb) * ln(pc / pb)), 6) AS psi, sum((pc - pb) * ln(pc / pb)) > 0.2 AS drift_detected
FROM j GROUP BY 1"""


_FEAT_LONG_SQL = f"""
SELECT CASE WHEN batch = 0 THEN 'baseline' ELSE 'current' END AS w, 'event_count' AS feature,
       CAST(event_count AS DOUBLE) AS x FROM ({batched_sql()}) WHERE batch IN (0, 2)
UNION ALL
SELECT CASE WHEN batch = 0 THEN 'baseline' ELSE 'current' END, 'total_value', total_value
FROM ({batched_sql()}) WHERE batch IN (0, 2) AND total_value IS NOT NULL"""


FEATURE_PSI_SQL = _psi_sql(_FEAT_LONG_SQL, "feature")


@register("feature_drift_psi", FEATURE_PSI_SQL)
def feature_drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PSI of each daily feature, first third of the dates (baseline) vs
    the last third (current), with the drift flag."""
    f = _windows(UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir)))
    return drift.psi(drift.long_form(f, DRIFT_FEATURES, "window"))


@register("feature_mean_shift", f"""
WITH x AS ({_FEAT_LONG_SQL})
SELECT feature, round(avg(x) FILTER (WHERE w = 'baseline'), 6) AS mean_baseline,
       round(stddev_samp(x) FILTER (WHERE w = 'baseline'), 6) AS stddev_baseline,
       round(avg(x) FILTER (WHERE w = 'current'), 6) AS mean_current,
       round(abs(avg(x) FILTER (WHERE w = 'current') - avg(x) FILTER (WHERE w = 'baseline'))
             / stddev_samp(x) FILTER (WHERE w = 'baseline'), 6) AS shift
FROM x GROUP BY feature""")
def feature_mean_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean shift of each feature in baseline standard deviations."""
    f = _windows(UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir)))
    return drift.mean_shift(drift.long_form(f, DRIFT_FEATURES, "window"))


_LI_BATCH = """CAST(floor(date_diff('day', (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem), CAST(l_shipdate AS DATE)) * 3
    / (date_diff('day', (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem),
                 (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)) + 1)) AS INTEGER)"""
_PRED_LONG_SQL = f"""
WITH l AS (SELECT {_LI_BATCH} AS batch,
                  1.0 + 0.5 * l_quantity + 0.001 * l_extendedprice + -10.0 * l_discount + 20.0 * l_tax AS lin,
                  (0.0 + l_quantity + l_extendedprice + l_discount + l_tax) / 4 AS mean FROM lineitem)
SELECT CASE WHEN batch = 0 THEN 'baseline' ELSE 'current' END AS w, 'linear' AS _model_name, lin AS x
FROM l WHERE batch IN (0, 2)
UNION ALL SELECT CASE WHEN batch = 0 THEN 'baseline' ELSE 'current' END, 'mean', mean FROM l WHERE batch IN (0, 2)"""


@register("prediction_drift_psi", _psi_sql(_PRED_LONG_SQL, "_model_name"))
def prediction_drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PSI of each model's predictions over lineitems, first third of the
    ship dates vs the last third."""
    from featurekit.operators import scoring
    from featurekit.suite.scoring import LI_FEATURES, LINEAR
    v = _li_with_vectors(spark, sf_dir)
    lin = scoring.predict(v, LINEAR, feature_cols=LI_FEATURES).select("window", F.lit("linear").alias("_model_name"),
                                                                       F.col("prediction").alias("x"))
    mean = scoring.predict(v, scoring.MeanModel()).select("window", F.lit("mean").alias("_model_name"),
                                                          F.col("prediction").alias("x"))
    return drift.psi(lin.unionByName(mean), group="_model_name")


def _li_with_vectors(spark, sf_dir):
    from featurekit.operators.features import with_feature_vector
    from featurekit.suite.scoring import LI_FEATURES
    li = tables.read_table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"), *LI_FEATURES)
    return with_feature_vector(_windows(li), LI_FEATURES)

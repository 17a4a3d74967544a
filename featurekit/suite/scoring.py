"""Registered queries: batch scoring (UDF and native), rule bands, lineage, stats."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import scoring
from featurekit.operators.features import UserFeaturesDaily, with_feature_vector
from featurekit.plans import batch_predict, history
from featurekit.session import fresh_dir
from featurekit.sources import tables
from featurekit.suite.common import registrar, FEATURES_SQL, batched_sql

QUERIES: dict = {}
ORACLES: dict = {}


register = registrar(QUERIES, ORACLES)


# fixed model parameters of the test queries
LINEAR = scoring.LinearModel([0.5, 0.001, -10.0, 20.0], bias=1.0)
LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEAR_SQL = "1.0 + 0.5 * l_quantity + 0.001 * l_extendedprice + -10.0 * l_discount + 20.0 * l_tax"
MEAN_SQL = "(0.0 + l_quantity + l_extendedprice + l_discount + l_tax) / 4"
HASH_SQL = "CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(date AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0"
RULE_SQL = f"""CASE WHEN total_value > 50 THEN 0.7 + {HASH_SQL} * 0.3
     WHEN total_value > 10 THEN 0.3 + {HASH_SQL} * 0.4 ELSE 0.1 + {HASH_SQL} * 0.2 END"""


def lineitem_vectors(spark, sf_dir) -> DataFrame:
    li = tables.read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LI_FEATURES)
    return with_feature_vector(li, LI_FEATURES)


def linear_scores(spark, sf_dir) -> DataFrame:
    v = lineitem_vectors(spark, sf_dir)
    return scoring.predict(v, LINEAR, "_features", "prediction", LI_FEATURES, vectorized_udf=True)


@register("predict_linear_udf", f"""
SELECT l_orderkey, l_linenumber, round({LINEAR_SQL}, 6) AS prediction FROM lineitem""")
def predict_linear_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A linear model scored through the Arrow-batched iterator pandas UDF
    (model broadcast once, one matrix product per batch) over all lineitems."""
    return linear_scores(spark, sf_dir).select("l_orderkey", "l_linenumber", "prediction")


@register("predict_mean_udf", f"""
SELECT l_orderkey, l_linenumber, round({MEAN_SQL}, 6) AS prediction FROM lineitem""")
def predict_mean_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 fallback: a model without ``predict`` scores the mean of its features
    (a native array expression, no Python worker)."""
    v = lineitem_vectors(spark, sf_dir)
    return scoring.predict(v, scoring.MeanModel()).select("l_orderkey", "l_linenumber", "prediction")


@register("rule_score_bands", f"""
SELECT user_id, CAST(date AS VARCHAR) AS date, round(total_value, 6) AS total_value,
       round({RULE_SQL}, 6) AS prediction,
       CASE WHEN total_value > 50 THEN 'high' WHEN total_value > 10 THEN 'mid' ELSE 'low' END AS band
FROM ({FEATURES_SQL})""")
def rule_score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-based score bands with a reproducible in-band position."""
    f = UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir))
    v = F.col("total_value")
    return (scoring.rule_score(f).select(
        "user_id", "date", "total_value", "prediction",
        F.when(v > 50, "high").when(v > 10, "mid").otherwise("low").alias("band")))


_RUN = "run_0001"


@register("predictions_with_lineage", f"""
SELECT user_id, CAST(date AS VARCHAR) AS date, round({RULE_SQL}, 6) AS prediction,
       '{_RUN}' AS _prediction_run_id, 'mock_ctr_model' AS _model_name, '1.0.0' AS _model_version,
       '4' AS _feature_snapshot, TRUE AS has_predicted_at
FROM ({batched_sql()})""")
def predictions_with_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: scores of main's rows carry run id, model name and version, the
    feature snapshot they were read from and the prediction time."""
    t = history.recovered(spark, sf_dir).table
    df = scoring.with_lineage(scoring.rule_score(t.scan()), _RUN, "mock_ctr_model", "1.0.0", str(t.head()))
    return df.select("user_id", "date", "prediction", "_prediction_run_id", "_model_name", "_model_version",
                     "_feature_snapshot", F.col("_predicted_at").isNotNull().alias("has_predicted_at"))


class _Precomputed:
    """A model whose score is already a column (rule scores are native)."""

    def to_column(self, cols):
        return F.col("_rule_score")


_MODEL = "purchase_ctr_model"


_CODE = "rev-7f3a"  # code version of the test runs


def _rule_job(spark, sf_dir, mode="append"):
    """A scoring run per event date and one for the day after the last, in one job; the model
    version and its feature snapshot come from the registry."""
    from featurekit.suite.registry import model_versions
    versions, _ = model_versions(spark, sf_dir)
    cfg = batch_predict.config_for(versions, _MODEL, feature_columns=["total_value"], output_mode=mode, code_version=_CODE,
                                   input_table="user_features_daily", output_table="batch_predictions")
    ev = tables.raw_events(spark, sf_dir)
    f = scoring.rule_score(UserFeaturesDaily().compute(ev), out="_rule_score")
    out = fresh_dir(spark, "batch_predictions")
    bs = history.batches(ev)
    n = (bs[-1].end - bs[0].start).days + 2
    days = [bs[0].start + dt.timedelta(days=i) for i in range(n)]
    return out, batch_predict.run_dates(f, _Precomputed(), cfg, out, {d: f"run_{i}" for i, d in enumerate(days)})


def _production_sql(column: str) -> str:
    from featurekit.suite.registry import STAGED
    return f"(SELECT {column} FROM ({STAGED}) WHERE stage = 'production' AND model_name = '{_MODEL}')"


@register("append_predictions", f"""
WITH f AS ({FEATURES_SQL}), d AS (SELECT min(date) AS d0 FROM f)
SELECT user_id, CAST(date AS VARCHAR) AS date, round({RULE_SQL}, 6) AS prediction,
       'run_' || CAST(date_diff('day', d0, date) AS VARCHAR) AS _prediction_run_id,
       '{_MODEL}' AS _model_name, {_production_sql("version")} AS _model_version,
       {_production_sql("feature_snapshot_id")} AS _feature_snapshot
FROM f, d""")
def append_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job run per event date, all appending to one predictions table; only
    the output columns that exist are written."""
    out, _ = _rule_job(spark, sf_dir)
    return spark.read.parquet(out).drop("_predicted_at")


@register("prediction_stats", f"""
SELECT count(*) AS count, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS stddev,
       round(min(p), 6) AS min, round(max(p), 6) AS max
FROM (SELECT {LINEAR_SQL} AS p FROM lineitem)""")
def prediction_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: count, mean, sample stddev, min, max of the predictions, typed."""
    return linear_scores(spark, sf_dir).agg(*scoring.stats_exprs("prediction"))


@register("prediction_distribution", f"""
SELECT 'linear' AS _model_name, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS stddev
FROM (SELECT {LINEAR_SQL} AS p FROM lineitem)
UNION ALL
SELECT 'mean', round(avg(p), 6), round(stddev_samp(p), 6) FROM (SELECT {MEAN_SQL} AS p FROM lineitem)""")
def prediction_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction mean and stddev per model (one grouped aggregate)."""
    v = lineitem_vectors(spark, sf_dir)
    lin = scoring.predict(v, LINEAR, feature_cols=LI_FEATURES).withColumn("_model_name", F.lit("linear"))
    mean = scoring.predict(v, scoring.MeanModel()).withColumn("_model_name", F.lit("mean"))
    both = lin.select("_model_name", "prediction").unionByName(mean.select("_model_name", "prediction"))
    return both.groupBy("_model_name").agg(F.avg("prediction").alias("mean"),
                                           F.stddev_samp("prediction").alias("stddev"))


@register("prediction_job_summary", f"""
WITH f AS ({FEATURES_SQL}), d AS (SELECT min(date) AS d0, max(date) AS d1 FROM f),
k AS (SELECT CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY))
             AS DATE) AS day, d0 FROM d),
p AS (SELECT f.date, {RULE_SQL} AS p FROM f)
SELECT 'run_' || CAST(date_diff('day', d0, day) AS VARCHAR) AS run_id,
       CASE WHEN count(p) = 0 THEN 'empty' ELSE 'success' END AS status,
       '{_MODEL}:' || {_production_sql("version")} AS model,
       {_production_sql("feature_snapshot_id")} AS feature_snapshot_id, CAST(day AS VARCHAR) AS prediction_date,
       count(p) AS rows_processed, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS stddev,
       round(min(p), 6) AS min, round(max(p), 6) AS max, 'user_features_daily' AS input_table,
       'batch_predictions' AS output_table, '{_CODE}' AS code_version, TRUE AS has_duration
FROM k LEFT JOIN p ON p.date = k.day GROUP BY day, d0""")
def prediction_job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary rows (status, model, snapshot, tables, rows, stats, code version) of a
    run per event date and of an empty one, read back from the runs log."""
    out, _ = _rule_job(spark, sf_dir)
    return (batch_predict.runs(spark, out).withColumn("has_duration", F.col("duration_seconds") > 0)
            .drop("count", "duration_seconds"))


@register("prediction_lineage_runs", f"""
WITH f AS ({FEATURES_SQL}), d AS (SELECT min(date) AS d0 FROM f)
SELECT 'run_' || CAST(date_diff('day', d0, date) AS VARCHAR) AS run_id, '{_CODE}' AS code_version,
       '{_MODEL}:' || {_production_sql("version")} AS model, count(*) AS rows, count(*) AS rows_processed
FROM f, d GROUP BY date, d0""")
def prediction_lineage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predictions' rows per run, led to the code version and model by the runs log."""
    out, _ = _rule_job(spark, sf_dir)
    rows = spark.read.parquet(out).groupBy(F.col("_prediction_run_id").alias("run_id")).agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(batch_predict.runs(spark, out).select("run_id", "code_version", "model", "rows_processed"), "run_id")

"""Registered queries: raw scan, daily features, joins, quality, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import features as feat
from featurekit.operators import quality
from featurekit.plans import history
from featurekit.sources import tables
from featurekit.suite.common import (registrar, FEATURES_NULLS_SQL, FEATURES_SQL, batched_sql, feature_cols_sql)

QUERIES: dict = {}
ORACLES: dict = {}


register = registrar(QUERIES, ORACLES)


@register("raw_events", """
SELECT user_id, CAST(ts AS VARCHAR) AS timestamp, event_type, round(value, 6) AS value FROM events""")
def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw event contract scan (ts renamed to timestamp)."""
    return tables.raw_events(spark, sf_dir)


@register("daily_user_features", f"SELECT {feature_cols_sql()} FROM ({FEATURES_SQL})")
def daily_user_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily features over all events."""
    return feat.UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir))


@register("features_for_date", f"""
SELECT {feature_cols_sql()} FROM ({batched_sql()})
WHERE date = (SELECT min(date) FROM ({batched_sql()}) WHERE batch = 1)""")
def features_for_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read main of the feature table and keep one prediction date
    (the first day of the second backfill range); ``date`` exists, so the
    filter applies and reaches the Parquet scan."""
    h = history.standard(spark, sf_dir)
    df = h.table.scan()
    d = h.batches[1].start
    return df.filter(F.col("date") == F.lit(d)) if "date" in df.columns else df


@register("feature_vector", f"""
SELECT user_id, CAST(date AS VARCHAR) AS date, 2 AS n_features,
       round(CAST(event_count AS DOUBLE), 6) AS f0, round(total_value, 6) AS f1
FROM ({FEATURES_SQL})""")
def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Auto-detected feature columns → ``array<double>``; elements emitted
    as scalars for the comparison."""
    f = feat.UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir))
    cols = feat.feature_columns(f)
    v = feat.with_feature_vector(f, cols)
    return v.select("user_id", "date", F.size("_features").alias("n_features"),
                    *[F.col("_features")[i].alias(f"f{i}") for i in range(len(cols))])


_SPINE_SQL = """
SELECT DISTINCT user_id, CAST(ts AS DATE) + 1 AS date FROM events WHERE event_type = 'purchase'"""


@register("feature_join_spine", f"""
SELECT s.user_id, CAST(s.date AS VARCHAR) AS date, f.event_count, round(f.total_value, 6) AS total_value
FROM ({_SPINE_SQL}) s LEFT JOIN ({FEATURES_SQL}) f ON s.user_id = f.user_id AND s.date = f.date""")
def feature_join_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine (user, day after a purchase) LEFT JOIN daily features."""
    ev = tables.raw_events(spark, sf_dir)
    spine = (ev.filter(F.col("event_type") == "purchase")
             .select("user_id", F.date_add(F.to_date("timestamp"), 1).alias("date")).distinct())
    return feat.spine_join(spine, feat.UserFeaturesDaily().compute(ev))


@register("training_set_asof", f"""
SELECT l.user_id, CAST(l.label_date AS VARCHAR) AS label_date, CAST(f.date AS VARCHAR) AS feature_date,
       f.event_count, round(f.total_value, 6) AS total_value
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS label_date FROM events WHERE event_type = 'purchase') l
ASOF LEFT JOIN ({FEATURES_SQL}) f ON l.user_id = f.user_id AND l.label_date > f.date""")
def training_set_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-in-time training set: for each purchase label the latest daily
    features strictly before the label date."""
    ev = tables.raw_events(spark, sf_dir)
    labels = feat.label_spine(ev, "purchase")
    f = feat.UserFeaturesDaily().compute(ev)
    return feat.asof_join(labels, f, "user_id", "label_date", "date", ["event_count", "total_value"])


_NOT_NULL_SQL = f"""
SELECT 'not_null:user_id' AS rule, 'not_null' AS kind, 'user_id' AS "column",
       CAST(count(*) FILTER (WHERE user_id IS NULL) AS DOUBLE) AS observed,
       count(*) FILTER (WHERE user_id IS NULL) AS failures,
       count(*) FILTER (WHERE user_id IS NULL) = 0 AS passed
FROM ({FEATURES_NULLS_SQL})
UNION ALL
SELECT 'not_null:total_value', 'not_null', 'total_value',
       CAST(count(*) FILTER (WHERE total_value IS NULL) AS DOUBLE),
       count(*) FILTER (WHERE total_value IS NULL),
       count(*) FILTER (WHERE total_value IS NULL) = 0
FROM ({FEATURES_NULLS_SQL})"""


@register("quality_not_null", _NOT_NULL_SQL)
def quality_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-null audit of all checked columns in one aggregate; values of
    error events are NULL, so all-error groups fail."""
    f = feat.UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir, null_errors=True))
    return quality.evaluate(f, quality.rules_from_checks({"user_id": "not_null", "total_value": "not_null"}))


QUALITY_RULES = [
    quality.Rule("not_null", "total_value"),
    quality.Rule("range", "event_count", {"min": 1, "max": 50}),
    quality.Rule("null_rate", "total_value", {"max": 0.05}),
    quality.Rule("min_rows", None, {"min": 100}),
    quality.Rule("unique", "user_id,date"),
    quality.Rule("mean_within", "total_value", {"mean": 150.0, "k": 3.0, "stddev": 40.0}),
]


@register("quality_rules", f"""
WITH f AS ({FEATURES_NULLS_SQL}),
a AS (
  SELECT count(*) FILTER (WHERE total_value IS NULL) AS nn,
         count(*) FILTER (WHERE event_count IS NOT NULL AND (event_count < 1 OR event_count > 50)) AS rg,
         avg(CASE WHEN total_value IS NULL THEN 1.0 ELSE 0.0 END) AS nr,
         count(*) AS n, avg(total_value) AS m
  FROM f),
d AS (SELECT count(*) AS groups, coalesce(sum(c - 1), 0) AS extra
      FROM (SELECT user_id, date, count(*) AS c FROM f GROUP BY 1, 2 HAVING count(*) > 1))
SELECT 'not_null:total_value' AS rule, 'not_null' AS kind, 'total_value' AS "column",
       round(CAST(nn AS DOUBLE), 6) AS observed, nn AS failures, nn = 0 AS passed FROM a
UNION ALL SELECT 'range:event_count', 'range', 'event_count', round(CAST(rg AS DOUBLE), 6), rg, rg = 0 FROM a
UNION ALL SELECT 'null_rate:total_value', 'null_rate', 'total_value', round(nr, 6),
                 CAST(CASE WHEN nr <= 0.05 THEN 0 ELSE 1 END AS BIGINT), nr <= 0.05 FROM a
UNION ALL SELECT 'min_rows', 'min_rows', NULL, round(CAST(n AS DOUBLE), 6),
                 CAST(CASE WHEN n >= 100 THEN 0 ELSE 1 END AS BIGINT), n >= 100 FROM a
UNION ALL SELECT 'unique:user_id,date', 'unique', 'user_id,date', round(CAST(groups AS DOUBLE), 6),
                 CAST(extra AS BIGINT), extra = 0 FROM d
UNION ALL SELECT 'mean_within:total_value', 'mean_within', 'total_value', round(m, 6),
                 CAST(CASE WHEN m BETWEEN 30.0 AND 270.0 THEN 0 ELSE 1 END AS BIGINT), m BETWEEN 30.0 AND 270.0 FROM a""")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-null, range, null-rate limit, minimum rows, unique key and
    distribution rules, one verdict row each."""
    f = feat.UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir, null_errors=True))
    return quality.evaluate(f, QUALITY_RULES)


@register("quality_accepted_values", """
SELECT 'accepted_values:event_type' AS rule, 'accepted_values' AS kind, 'event_type' AS "column",
       round(CAST(count(*) FILTER (WHERE event_type NOT IN ('click', 'purchase', 'signup', 'view')) AS DOUBLE), 6) AS observed,
       count(*) FILTER (WHERE event_type NOT IN ('click', 'purchase', 'signup', 'view')) AS failures,
       count(*) FILTER (WHERE event_type NOT IN ('click', 'purchase', 'signup', 'view')) = 0 AS passed
FROM events""")
def quality_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values outside an accepted set, counted over the raw events."""
    rules = quality.rules_from_checks(
        {"event_type": ("accepted_values", {"values": ["click", "purchase", "signup", "view"]})})
    return quality.evaluate(tables.raw_events(spark, sf_dir), rules)


_PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("feature_profile", """
WITH l AS (SELECT CAST(l_shipdate AS DATE) AS date, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
SELECT CAST(date AS VARCHAR) AS date, count(*) AS rows, 'l_quantity' AS feature,
       round(avg(CASE WHEN l_quantity IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate,
       round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS stddev FROM l GROUP BY date
UNION ALL
SELECT CAST(date AS VARCHAR), count(*), 'l_extendedprice', round(avg(CASE WHEN l_extendedprice IS NULL THEN 1.0 ELSE 0.0 END), 6),
       round(avg(l_extendedprice), 6), round(stddev_samp(l_extendedprice), 6) FROM l GROUP BY date
UNION ALL
SELECT CAST(date AS VARCHAR), count(*), 'l_discount', round(avg(CASE WHEN l_discount IS NULL THEN 1.0 ELSE 0.0 END), 6),
       round(avg(l_discount), 6), round(stddev_samp(l_discount), 6) FROM l GROUP BY date
UNION ALL
SELECT CAST(date AS VARCHAR), count(*), 'l_tax', round(avg(CASE WHEN l_tax IS NULL THEN 1.0 ELSE 0.0 END), 6),
       round(avg(l_tax), 6), round(stddev_samp(l_tax), 6) FROM l GROUP BY date""")
def feature_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null rate, mean, stddev per feature column and per ship day of
    ``lineitem`` (one grouped aggregate, unpivoted)."""
    li = tables.read_table(spark, sf_dir, "lineitem")
    df = li.select(F.to_date("l_shipdate").alias("date"), *_PROFILE_COLS)
    return quality.profile(df, _PROFILE_COLS, by=["date"])


@register("quality_check_totals", f"""
WITH f AS ({FEATURES_NULLS_SQL}),
p AS (SELECT date, count(*) FILTER (WHERE user_id IS NULL) AS b0,
             count(*) FILTER (WHERE total_value IS NULL) AS b1 FROM f GROUP BY date),
o AS (SELECT 'not_null:user_id' AS "check", CASE WHEN b0 = 0 THEN 'passed' ELSE 'failed' END AS result FROM p
      UNION ALL
      SELECT 'not_null:total_value', CASE WHEN b1 = 0 THEN 'passed' ELSE 'failed' END FROM p)
SELECT 'user_features_daily' AS "table", "check", result, count(*) AS checks FROM o GROUP BY 1, 2, 3""")
def quality_check_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit outcomes per daily partition, counted by (table, check, result)."""
    f = feat.UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir, null_errors=True))
    o = quality.check_outcomes_by_partition(f, {"user_id": "not_null", "total_value": "not_null"}, "date")
    return (o.groupBy(F.lit("user_features_daily").alias("table"), "check", "result")
            .agg(F.count(F.lit(1)).alias("checks")))


@register("daily_features_stream", f"SELECT {feature_cols_sql()} FROM ({FEATURES_SQL})")
def daily_features_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming aggregation over two arrivals of event files (first
    half of the dates, then the rest) equals the batch daily features."""
    from featurekit.session import fresh_dir
    from featurekit.streaming import features as sf
    ev = tables.raw_events(spark, sf_dir)
    root = fresh_dir(spark, "features_stream")
    lo, hi = feat.date_bounds(ev.select(F.to_date("timestamp").alias("date")))
    mid = lo + (hi - lo) / 2
    day = F.to_date("timestamp")
    ckpt, out = f"{root}/checkpoint", f"{root}/out"
    for part in (ev.filter(day <= F.lit(mid)), ev.filter(day > F.lit(mid))):
        part.write.mode("append").parquet(f"{root}/input")
        sf.run_daily_features_stream(spark, f"{root}/input", ev.schema, out, ckpt)
    return sf.current_features(spark, out)


@register("schema_changes", """
SELECT * FROM (VALUES ('user_features_daily', 'avg_value', 'add', NULL, 'double'),
                      ('user_features_daily', 'event_count', 'retype', 'bigint', 'double'),
                      ('user_features_daily', 'total_value', 'drop', 'double', NULL))
       t("table", "column", change_type, old_type, new_type)""")
def schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column changes between two versions of the feature table schema
    (full outer join of the two column lists; a rename shows as drop + add)."""
    v1 = feat.UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir))
    v2 = v1.select("user_id", "date", F.col("event_count").cast("double"),
                   (F.col("total_value") / F.col("event_count")).alias("avg_value"))
    return quality.schema_changes(spark, v1.schema, v2.schema, "user_features_daily")


@register("quality_check_last", f"""
WITH f AS ({FEATURES_NULLS_SQL}),
p AS (SELECT date, count(*) FILTER (WHERE user_id IS NULL) AS b0,
             count(*) FILTER (WHERE total_value IS NULL) AS b1 FROM f GROUP BY date),
o AS (SELECT 'not_null:user_id' AS "check", date, CASE WHEN b0 = 0 THEN 'passed' ELSE 'failed' END AS result FROM p
      UNION ALL
      SELECT 'not_null:total_value', date, CASE WHEN b1 = 0 THEN 'passed' ELSE 'failed' END FROM p)
SELECT 'user_features_daily' AS "table", "check", CAST(max(date) AS VARCHAR) AS last_date, arg_max(result, date) AS result
FROM o GROUP BY 2""")
def quality_check_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value of every quality check, by partition date."""
    f = feat.UserFeaturesDaily().compute(tables.raw_events(spark, sf_dir, null_errors=True))
    o = quality.check_outcomes_by_partition(f, {"user_id": "not_null", "total_value": "not_null"}, "date")
    return (o.groupBy(F.lit("user_features_daily").alias("table"), "check")
            .agg(F.max("date").alias("last_date"), F.max_by("result", "date").alias("result")))

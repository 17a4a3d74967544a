"""Registered queries: the model registry, derived from the event data.

Registry derivation (deterministic, identical in the oracle SQL): every event
type is a model ``<type>_ctr_model``; every day with events is one training
run registering the next version (day index k → ``1.<k div 12>.<k mod 12>``)
with metrics computed from that day's events; the version is bound to the
feature snapshot of the backfill batch covering the day. Promotion log: a
version is staged when its auc beats the previous version's, and every 7th
version (k mod 7 = 6) is promoted to production.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurekit.functions import timeutil as tu
from featurekit.operators import registry as reg
from featurekit.operators import scoring
from featurekit.operators.features import date_bounds
from featurekit.plans import history
from featurekit.sources import tables
from featurekit.suite.common import registrar, BOUNDS_SQL, batched_sql, feature_cols_sql

QUERIES: dict = {}
ORACLES: dict = {}


register = registrar(QUERIES, ORACLES)


def model_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(model_versions with stages, promotion events), derived from ``events``."""
    ev = tables.raw_events(spark, sf_dir)
    day = F.to_date("timestamp")
    lo, hi = date_bounds(ev.select(day.alias("date")))
    span = (hi - lo).days + 1
    s = (ev.groupBy(F.concat(F.col("event_type"), F.lit("_ctr_model")).alias("model_name"), day.alias("date"),
                    "event_type")
         .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 50).alias("n_gt50"),
              F.countDistinct("user_id").alias("n_users"), F.count_if(F.col("value") < 10).alias("n_small")))
    k = F.dense_rank().over(Window.partitionBy("model_name").orderBy("date")) - 1
    batch = F.floor(F.datediff("date", F.lit(lo)) * 3 / span).cast("int")
    mv = (s.withColumn("k", k)
          .withColumn("version", F.concat_ws(".", F.lit("1"), F.floor(F.col("k") / 12).cast("string"),
                                             (F.col("k") % 12).cast("string")))
          .withColumn("auc", 0.5 + 0.5 * F.col("n_gt50") / F.col("n"))
          .select("model_name", "version", "k", "date",
                  F.lit("none").alias("stage"),
                  F.concat_ws("/", F.lit("models"), "model_name", "version", F.lit("model.json")).alias("model_path"),
                  F.lit("json").alias("model_format"),
                  F.create_map(F.lit("auc"), F.col("auc"),
                               F.lit("f1"), F.col("n_users") / F.col("n"),
                               F.lit("precision"), F.col("n_small") / F.col("n")).alias("metrics"),
                  F.struct(F.lit(history.CODE_VERSION).alias("git_commit_hash"),
                           (batch + 1).cast("string").alias("feature_snapshot_id"),
                           F.concat(F.lit("run_"), F.col("date").cast("string")).alias("training_run_id"),
                           F.lit(history.USER).alias("pipeline_user"),
                           F.lit("user_features_daily").alias("training_data_path"),
                           F.col("date").cast("string").alias("training_started_at"),
                           F.col("date").cast("string").alias("training_ended_at"),
                           F.lit("sklearn").alias("framework"),
                           F.create_map(F.lit("event_type"), F.col("event_type")).alias("custom_tags"))
                  .alias("metadata"),
                  F.concat(F.col("date").cast("string"), F.lit("T12:00:00")).alias("created_at"),
                  F.concat(F.lit("trained on "), F.col("date").cast("string")).alias("description"),
                  F.lit(None).cast("string").alias("input_schema"),
                  F.lit(None).cast("string").alias("output_schema")))
    prev = F.lag(F.col("metrics")["auc"]).over(Window.partitionBy("model_name").orderBy("k"))
    events = (mv.withColumn("_prev", prev)
              .select("model_name", "version", (2 * F.col("k")).alias("seq"),
                      F.when(F.col("metrics")["auc"] > F.col("_prev"), "staging").alias("kind"))
              .filter(F.col("kind").isNotNull())
              .unionByName(mv.filter(F.col("k") % 7 == 6)
                           .select("model_name", "version", (2 * F.col("k") + 1).alias("seq"),
                                   F.lit("production").alias("kind"))))
    return reg.stages(mv, events), events


# ----------------------------------------------------------------- oracle SQL
MV_SQL = f"""
WITH s AS (
  SELECT event_type || '_ctr_model' AS model_name, CAST(ts AS DATE) AS date, event_type, count(*) AS n,
         count(*) FILTER (WHERE value > 50) AS n_gt50, count(DISTINCT user_id) AS n_users,
         count(*) FILTER (WHERE value < 10) AS n_small
  FROM events GROUP BY 1, 2, 3),
b AS ({BOUNDS_SQL}),
k AS (SELECT s.*, CAST(dense_rank() OVER (PARTITION BY model_name ORDER BY date) - 1 AS BIGINT) AS k,
             CAST(floor(date_diff('day', b.lo, s.date) * 3 / (date_diff('day', b.lo, b.hi) + 1)) AS INTEGER) AS batch
      FROM s, b)
SELECT model_name, '1.' || CAST(k // 12 AS VARCHAR) || '.' || CAST(k % 12 AS VARCHAR) AS version, k, date,
       0.5 + 0.5 * CAST(n_gt50 AS DOUBLE) / n AS auc, CAST(n_users AS DOUBLE) / n AS f1,
       CAST(n_small AS DOUBLE) / n AS "precision", CAST(batch + 1 AS VARCHAR) AS feature_snapshot_id,
       CAST(date AS VARCHAR) || 'T12:00:00' AS created_at, event_type
FROM k"""

EVENTS_SQL = f"""
SELECT model_name, version, 2 * k AS seq, 'staging' AS kind
FROM (SELECT *, lag(auc) OVER (PARTITION BY model_name ORDER BY k) AS prev FROM ({MV_SQL})) WHERE auc > prev
UNION ALL
SELECT model_name, version, 2 * k + 1, 'production' FROM ({MV_SQL}) WHERE k % 7 = 6"""


def staged_sql(events_sql: str = EVENTS_SQL) -> str:
    return f"""
WITH mv AS ({MV_SQL}), ev AS ({events_sql}),
l AS (SELECT model_name, version, arg_max(kind, seq) AS kind, max(seq) AS seq FROM ev GROUP BY 1, 2),
mx AS (SELECT model_name, max(seq) FILTER (WHERE kind = 'staging') AS ms,
              max(seq) FILTER (WHERE kind = 'production') AS mp FROM ev GROUP BY 1)
SELECT mv.*, CASE WHEN l.kind = 'production' THEN CASE WHEN mx.mp > l.seq THEN 'archived' ELSE 'production' END
                  WHEN l.kind = 'staging' THEN CASE WHEN mx.ms > l.seq THEN 'none' ELSE 'staging' END
                  ELSE 'none' END AS stage
FROM mv LEFT JOIN l ON mv.model_name = l.model_name AND mv.version = l.version
        LEFT JOIN mx ON mv.model_name = mx.model_name"""


STAGED = staged_sql()
SEMVER = ("CAST(split_part(version, '.', 1) AS INTEGER), CAST(split_part(version, '.', 2) AS INTEGER), "
          "CAST(split_part(version, '.', 3) AS INTEGER)")


def _stored_registry(spark, sf_dir) -> reg.RegistryTable:
    """The derived versions and promotion events written to a registry table."""
    from featurekit.session import fresh_dir
    mv, events = model_versions(spark, sf_dir)
    r = reg.RegistryTable(spark, fresh_dir(spark, "registry"))
    r.register(mv.drop("k", "date"))
    r.promote(events)
    return r


@register("registry_list_versions", f"""
SELECT model_name, version, stage, round(auc, 6) AS auc, round(f1, 6) AS f1, round("precision", 6) AS "precision",
       feature_snapshot_id AS feature_snapshot, created_at,
       CAST(row_number() OVER (PARTITION BY model_name ORDER BY {SEMVER}) AS INTEGER) AS position
FROM ({STAGED})""")
def registry_list_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11/T-4: every version with stage, key metrics and snapshot, and its
    position in numeric semver order."""
    mv = _stored_registry(spark, sf_dir).versions()
    w = Window.partitionBy("model_name").orderBy(reg.semver_key("version"))
    return mv.select("model_name", "version", "stage", F.col("metrics")["auc"].alias("auc"),
                     F.col("metrics")["f1"].alias("f1"), F.col("metrics")["precision"].alias("precision"),
                     F.col("metadata")["feature_snapshot_id"].alias("feature_snapshot"), "created_at",
                     F.row_number().over(w).alias("position"))


_LATEST_SQL = f"""
SELECT model_name, arg_max(version, [{SEMVER}]) AS latest_version, count(*) AS versions
FROM ({MV_SQL}) GROUP BY model_name"""


@register("registry_list_models", _LATEST_SQL)
def registry_list_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered models with version count and latest version."""
    mv, _ = model_versions(spark, sf_dir)
    return reg.latest_versions(mv)


@register("registry_latest_version", f"SELECT model_name, latest_version FROM ({_LATEST_SQL})")
def registry_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest version per model by numeric semver (not lexical)."""
    mv, _ = model_versions(spark, sf_dir)
    return reg.latest_versions(mv).select("model_name", "latest_version")


@register("registry_next_version", f"""
WITH req AS (SELECT DISTINCT event_type || '_ctr_model' AS model_name FROM events
             UNION SELECT DISTINCT event_type || '_uplift_model' FROM events WHERE event_type = 'purchase'),
bumps AS (SELECT * FROM (VALUES ('major'), ('minor'), ('patch')) t(bump)),
l AS ({_LATEST_SQL})
SELECT req.model_name, bumps.bump, l.latest_version,
  CASE WHEN l.latest_version IS NULL THEN '1.0.0'
       WHEN bump = 'major' THEN CAST(CAST(split_part(latest_version, '.', 1) AS INTEGER) + 1 AS VARCHAR) || '.0.0'
       WHEN bump = 'minor' THEN split_part(latest_version, '.', 1) || '.'
                                || CAST(CAST(split_part(latest_version, '.', 2) AS INTEGER) + 1 AS VARCHAR) || '.0'
       ELSE split_part(latest_version, '.', 1) || '.' || split_part(latest_version, '.', 2) || '.'
            || CAST(CAST(split_part(latest_version, '.', 3) AS INTEGER) + 1 AS VARCHAR) END AS next_version
FROM req CROSS JOIN bumps LEFT JOIN l ON req.model_name = l.model_name""")
def registry_next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.9 semver: next version for each bump type; an unregistered model
    starts at 1.0.0."""
    ev = tables.raw_events(spark, sf_dir)
    mv, _ = model_versions(spark, sf_dir)
    req = (ev.select(F.concat("event_type", F.lit("_ctr_model")).alias("model_name"))
           .unionByName(ev.filter(F.col("event_type") == "purchase")
                        .select(F.concat("event_type", F.lit("_uplift_model")).alias("model_name")))
           .distinct())
    # three bump kinds per requested model: an explode of a literal array, not a join
    reqb = req.withColumn("bump", F.explode(F.array(F.lit("major"), F.lit("minor"), F.lit("patch"))))
    latest = reg.latest_versions(mv).select("model_name", "latest_version")
    return (reqb.join(latest, "model_name", "left")
            .withColumn("next_version", reg.next_version(F.col("latest_version"), F.col("bump"))))


@register("registry_production", f"SELECT model_name, version FROM ({STAGED}) WHERE stage = 'production'")
def registry_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: the production version of each model."""
    mv, _ = model_versions(spark, sf_dir)
    return reg.production(mv).select("model_name", "version")


@register("registry_promote_staging", f"""
SELECT model_name, version, stage FROM ({staged_sql(f"SELECT * FROM ({EVENTS_SQL}) WHERE kind = 'staging'")})""")
def registry_promote_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages after the staging promotions only: each new staging version
    demotes the previous one to none."""
    mv, events = model_versions(spark, sf_dir)
    return reg.stages(mv, events.filter(F.col("kind") == "staging")).select("model_name", "version", "stage")


@register("registry_promote_production", f"SELECT model_name, version, stage FROM ({STAGED})")
def registry_promote_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages after the full promotion log: earlier production versions
    are archived, at most one production version per model."""
    mv, _ = model_versions(spark, sf_dir)
    return mv.select("model_name", "version", "stage")


@register("registry_register", f"""
WITH l AS ({_LATEST_SQL}),
m AS (SELECT event_type || '_ctr_model' AS model_name,
             0.5 + 0.5 * CAST(count(*) FILTER (WHERE value > 50) AS DOUBLE) / count(*) AS auc
      FROM events GROUP BY 1)
SELECT m.model_name,
       split_part(latest_version, '.', 1) || '.' || split_part(latest_version, '.', 2) || '.'
       || CAST(CAST(split_part(latest_version, '.', 3) AS INTEGER) + 1 AS VARCHAR) AS version,
       'none' AS stage, round(m.auc, 6) AS auc, '2' AS feature_snapshot_id
FROM m JOIN l ON m.model_name = l.model_name""")
def registry_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register one new version per model (patch bump) trained on all
    events, bound to the current head of main (snapshot 2): rows are appended
    to the registry table and read back."""
    r = _stored_registry(spark, sf_dir)
    before = reg.latest_versions(r.raw_versions())
    ev = tables.raw_events(spark, sf_dir)
    metrics = (ev.groupBy(F.concat("event_type", F.lit("_ctr_model")).alias("model_name"))
               .agg((0.5 + 0.5 * F.count_if(F.col("value") > 50) / F.count(F.lit(1))).alias("auc")))
    new = (metrics.join(before, "model_name")
           .select("model_name", reg.next_version(F.col("latest_version"), F.lit("patch")).alias("version"),
                   F.create_map(F.lit("auc"), F.col("auc")).alias("metrics"),
                   reg.metadata(feature_snapshot_id="2", git_commit_hash=history.CODE_VERSION).alias("metadata")))
    r.register(new)
    after = r.versions()
    added = after.join(before.select("model_name", "latest_version"), "model_name") \
        .filter(reg.semver_key("version") > reg.semver_key("latest_version"))
    return added.select("model_name", "version", "stage", F.col("metrics")["auc"].alias("auc"),
                        F.col("metadata")["feature_snapshot_id"].alias("feature_snapshot_id"))


@register("registry_compare_versions", f"""
WITH mv AS ({MV_SQL}), l AS ({_LATEST_SQL}),
m AS (SELECT model_name, version, 'auc' AS metric, auc AS value FROM mv
      UNION ALL SELECT model_name, version, 'f1', f1 FROM mv
      UNION ALL SELECT model_name, version, 'precision', "precision" FROM mv)
SELECT a.model_name, a.metric, a.version AS version_a, b.version AS version_b, round(a.value, 6) AS value_a,
       round(b.value, 6) AS value_b, round(round(b.value - a.value, 4), 6) AS diff,
       CASE WHEN a.value <> 0 THEN round((b.value - a.value) / a.value * 100, 2) ELSE 0.0 END AS pct_change
FROM m a JOIN l ON a.model_name = l.model_name AND a.version = '1.0.0'
JOIN m b ON b.model_name = a.model_name AND b.version = l.latest_version AND b.metric = a.metric""")
def registry_compare_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric differences between the first and the latest version of each model."""
    mv, _ = model_versions(spark, sf_dir)
    pairs = reg.latest_versions(mv).select("model_name", F.lit("1.0.0").alias("version_a"),
                                           F.col("latest_version").alias("version_b"))
    return reg.compare_versions(mv, pairs, None)


@register("registry_metric_trend", f"""
WITH mv AS ({MV_SQL}),
m AS (SELECT model_name, version, 'auc' AS metric, auc AS value FROM mv
      UNION ALL SELECT model_name, version, 'f1', f1 FROM mv
      UNION ALL SELECT model_name, version, 'precision', "precision" FROM mv)
SELECT model_name, version, metric, round(value, 6) AS value,
       round(lag(value) OVER w, 6) AS prev_value, round(value - lag(value) OVER w, 6) AS change
FROM m WINDOW w AS (PARTITION BY model_name, metric ORDER BY {SEMVER})""")
def registry_metric_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version-to-version metric change along numeric semver order."""
    mv, _ = model_versions(spark, sf_dir)
    return reg.metric_trend(mv)


@register("registry_lineage", f"""
SELECT model_name || ':' || version AS model, created_at, 'c0ffee1' AS git_commit,
       'run_' || CAST(date AS VARCHAR) AS training_run_id, 'featurekit' AS pipeline_user, feature_snapshot_id,
       'user_features_daily' AS training_data_path,
       round(auc, 6) AS auc, round(f1, 6) AS f1,
       'sklearn' AS framework, 'models/' || model_name || '/' || version || '/model.json' AS artifact_path,
       'json' AS artifact_format
FROM ({STAGED}) WHERE stage = 'production'""")
def registry_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage record (code, data, environment, artifact) of production versions."""
    mv, _ = model_versions(spark, sf_dir)
    rows = reg.lineage(reg.production(mv))
    return (rows.withColumns({m: F.element_at("metrics", m) for m in ("auc", "f1")}).drop("metrics", "custom_tags"))


@register("model_age_hours", f"""
SELECT model_name, version,
       round(date_diff('second', CAST(created_at AS TIMESTAMP), (SELECT max(ts) FROM events)) / 3600.0, 6) AS age_hours
FROM ({STAGED}) WHERE stage = 'production'""")
def model_age_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours since creation of each production model, as of the newest event."""
    mv, _ = model_versions(spark, sf_dir)
    asof = tables.raw_events(spark, sf_dir).agg(F.max("timestamp").alias("asof")).first()["asof"]
    created = F.to_timestamp_ntz(F.col("created_at"))
    secs = tu.epoch_seconds(tu.ntz(asof)) - tu.epoch_seconds(created)
    return reg.production(mv).select("model_name", "version", (secs / 3600.0).alias("age_hours"))


@register("model_training_features", f"""
WITH p AS (SELECT feature_snapshot_id FROM ({STAGED}) WHERE stage = 'production' AND model_name = 'purchase_ctr_model')
SELECT {feature_cols_sql()} FROM ({batched_sql()})
WHERE batch + 1 <= (SELECT CAST(feature_snapshot_id AS INTEGER) FROM p)""")
def model_training_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features the production purchase model was trained on: time
    travel to its bound snapshot (only the snapshot id reaches the driver)."""
    mv, _ = model_versions(spark, sf_dir)
    snap = (reg.production(mv).filter(F.col("model_name") == "purchase_ctr_model")
            .select(F.col("metadata")["feature_snapshot_id"]).first()[0])
    h = history.all_published(spark, sf_dir)
    return h.table.scan(snapshot_id=int(snap))


@register("prediction_lineage", f"""
WITH p AS (SELECT *, row_number() OVER (ORDER BY model_name) - 1 AS i, count(*) OVER () AS n
           FROM ({STAGED}) WHERE stage = 'production')
SELECT f.user_id, CAST(f.date AS VARCHAR) AS date, p.model_name AS _model_name, p.version AS _model_version,
       p.feature_snapshot_id, 'run_' || CAST(p.date AS VARCHAR) AS training_run_id,
       CASE p.feature_snapshot_id WHEN '1' THEN 'a' WHEN '2' THEN 'b' ELSE 'c' END AS snapshot_run_id
FROM ({batched_sql()}) f JOIN p ON f.user_id % p.n = p.i""")
def prediction_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction rows → the model version that scored them → bound feature
    snapshot → the commit (run) that wrote it. Users are dealt to the production
    models, so every prediction has one."""
    mv, _ = model_versions(spark, sf_dir)
    h = history.all_published(spark, sf_dir)
    # the production list is registry metadata, one row per model
    prod = sorted((r.model_name, r.version) for r in reg.production(mv).select("model_name", "version").collect())
    models = F.array(*[F.struct(F.lit(n).alias("_model_name"), F.lit(v).alias("_model_version")) for n, v in prod])
    preds = (scoring.rule_score(h.table.scan())
             .withColumn("_m", F.get(models, F.pmod("user_id", F.lit(len(prod))).cast("int")))
             .select("*", "_m._model_name", "_m._model_version"))
    versions = mv.select(F.col("model_name").alias("_model_name"), F.col("version").alias("_model_version"),
                         F.col("metadata")["feature_snapshot_id"].alias("feature_snapshot_id"),
                         F.col("metadata")["training_run_id"].alias("training_run_id"))
    commits = h.table.commits().select(F.col("snapshot_id").cast("string").alias("feature_snapshot_id"),
                                       F.col("summary")["run-id"].alias("snapshot_run_id"))
    return (preds.join(versions, ["_model_name", "_model_version"], "left")
            .join(commits, "feature_snapshot_id", "left")
            .select("user_id", "date", "_model_name", "_model_version", "feature_snapshot_id",
                    "training_run_id", "snapshot_run_id"))


def artifact_hashes(spark: SparkSession, root: str) -> DataFrame:
    """SHA-256 (first 12 hex chars) of every artifact file under ``root``,
    computed on the executors from the file bytes (``binaryFile``)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.json").load(root))
    return files.select(F.regexp_extract("path", r"model_name=([^/]+)", 1).alias("model_name"),
                        F.col("length").alias("bytes"),
                        F.substring(F.sha2(F.col("content"), 256), 1, 12).alias("sha256_12"))


_TAMPERED = "view_ctr_model"


@register("artifact_hash_audit", f"""
SELECT event_type || '_ctr_model' AS model_name, event_type || '_ctr_model' <> '{_TAMPERED}' AS verified
FROM (SELECT DISTINCT event_type FROM events)""")
def artifact_hash_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model artifacts (one JSON file of version metrics per model) are hashed at
    registration and the hashes recorded; then one model's file is replaced. The
    audit re-hashes the stored files and reports which still match their record."""
    from featurekit.session import fresh_dir
    mv, _ = model_versions(spark, sf_dir)
    root = fresh_dir(spark, "artifacts")

    def write(rows: DataFrame, mode: str) -> None:
        (rows.repartition("model_name").sortWithinPartitions("model_name", "version")
         .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("model_name").json(f"{root}/files"))

    rows = mv.select("model_name", "version", F.to_json("metrics").alias("metrics"))
    write(rows, "append")
    artifact_hashes(spark, f"{root}/files").write.parquet(f"{root}/recorded")
    write(rows.filter(F.col("model_name") == _TAMPERED).withColumn("metrics", F.lit("{}")), "overwrite")
    recorded = spark.read.parquet(f"{root}/recorded").select("model_name", F.col("sha256_12").alias("recorded"))
    now = artifact_hashes(spark, f"{root}/files")
    return (now.join(recorded, "model_name", "full_outer")
            .select("model_name", F.coalesce(F.col("sha256_12") == F.col("recorded"), F.lit(False)).alias("verified")))

"""Explicit schemas of the tables featurekit reads and writes."""

from pyspark.sql import types as T

# input tables (explicit, so scans skip footer-based schema inference)
INPUT_TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
}

# raw event contract of a feature group: (user_id, timestamp, event_type, value).
RAW_EVENTS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# daily user features (the published feature table).
USER_FEATURES_DAILY = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("total_value", T.DoubleType()),
])

# commit log of a versioned table: one row per snapshot.
COMMITS = T.StructType([
    T.StructField("snapshot_id", T.LongType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("source_snapshot_id", T.LongType()),
    T.StructField("branch", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("committed_at", T.TimestampNTZType()),
    T.StructField("summary", T.MapType(T.StringType(), T.StringType())),
])

# refs log: the head of a ref is its row with the greatest seq.
REFS = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("snapshot_id", T.LongType()),
    T.StructField("prev_snapshot_id", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("published_at", T.TimestampNTZType()),
])

PREDICTIONS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("_prediction_run_id", T.StringType()),
    T.StructField("_model_name", T.StringType()),
    T.StructField("_model_version", T.StringType()),
    T.StructField("_feature_snapshot", T.StringType()),
    T.StructField("_predicted_at", T.TimestampType()),
])

MODEL_METADATA = T.StructType([
    T.StructField("git_commit_hash", T.StringType()),
    T.StructField("feature_snapshot_id", T.StringType()),
    T.StructField("training_run_id", T.StringType()),
    T.StructField("pipeline_user", T.StringType()),
    T.StructField("training_data_path", T.StringType()),
    T.StructField("training_started_at", T.StringType()),
    T.StructField("training_ended_at", T.StringType()),
    T.StructField("framework", T.StringType()),
    T.StructField("custom_tags", T.MapType(T.StringType(), T.StringType())),
])

MODEL_VERSIONS = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("model_format", T.StringType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("metadata", MODEL_METADATA),
    T.StructField("created_at", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("input_schema", T.StringType()),
    T.StructField("output_schema", T.StringType()),
])

METRICS = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("value", T.DoubleType()),
])

ALERT_RULES = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("condition", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("for_duration", T.DoubleType()),
    T.StructField("cooldown", T.DoubleType()),
    T.StructField("runbook_url", T.StringType()),
])

SILENCES = T.StructType([
    T.StructField("rule_name", T.StringType()),
    T.StructField("from", T.TimestampNTZType()),
    T.StructField("until", T.TimestampNTZType()),
])


def with_field(schema: T.StructType, name: str, dtype: T.DataType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(name, dtype)])

"""Batch prediction job: features → vector → model → lineage → write, one pass.

The feature read is filtered by date when the table has a ``date`` column. A run of one
date collects its row count and statistics by an ``Observation`` while the output is
written; a run of many dates scores all of them in one write partitioned by date, and
its statistics per date come from the written predictions alone. Either way the input is
scanned exactly once (no cache, no separate count or summary jobs over it).

Every run leaves its summary in the runs log, ``_runs`` below the output (a folder that
reads of the output skip): the lineage record of its write, with run id, model, feature
snapshot, tables, code version and duration.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import registry, scoring
from featurekit.operators.features import feature_columns, with_feature_vector

OUTPUT_COLUMNS = ["user_id", "date", "prediction", "_prediction_run_id", "_model_name", "_model_version",
                  "_feature_snapshot", "_predicted_at"]
RUNS = ("run_id string, status string, model string, feature_snapshot_id string, input_table string, "
        "output_table string, prediction_date string, rows_processed long, count long, mean double, stddev double, "
        "min double, max double, duration_seconds double, code_version string")


@dataclass
class PredictionConfig:
    model_name: str
    model_version: str
    feature_snapshot: str | None = None
    entity_column: str = "user_id"
    prediction_column: str = "prediction"
    feature_columns: list | None = None
    output_mode: str = "append"  # append | overwrite (dynamic partitions)
    partition_by: list = field(default_factory=list)
    output: str = "value"  # value | probability
    input_table: str | None = None
    output_table: str | None = None
    code_version: str = "unknown"


def config_for(versions: DataFrame, model_name: str, version: str | None = None, **options) -> PredictionConfig:
    """The job's configuration with model version and feature snapshot from the registry
    (the version asked for, else the one in production, else an error)."""
    r = registry.resolve(versions, model_name, version)
    return PredictionConfig(model_name, r.version, r.metadata["feature_snapshot_id"], **options)


def prepare(features: DataFrame, cfg: PredictionConfig, prediction_date=None):
    df = features
    if prediction_date is not None and "date" in df.columns:
        df = df.filter(F.col("date") == F.lit(prediction_date).cast("date"))
    cols = cfg.feature_columns or feature_columns(df, cfg.entity_column)
    return with_feature_vector(df, cols), cols


def score(features: DataFrame, model, cfg: PredictionConfig, run_id: str, prediction_date=None,
          vectorized_udf: bool = False) -> DataFrame:
    df, cols = prepare(features, cfg, prediction_date)
    df = scoring.predict(df, model, "_features", cfg.prediction_column, cols, vectorized_udf, cfg.output)
    return scoring.with_lineage(df, run_id, cfg.model_name, cfg.model_version, cfg.feature_snapshot)


def _summary(cfg: PredictionConfig, run_id: str, date, rows: int, stats: Mapping, seconds: float) -> dict:
    return {"run_id": run_id, "status": "success" if rows else "empty", "model": f"{cfg.model_name}:{cfg.model_version}",
            "feature_snapshot_id": cfg.feature_snapshot, "input_table": cfg.input_table, "output_table": cfg.output_table,
            "prediction_date": None if date is None else str(date), "rows_processed": rows,
            "count": int(stats.get("count") or 0), **{k: stats.get(k) for k in ("mean", "stddev", "min", "max")},
            "duration_seconds": seconds, "code_version": cfg.code_version}


def _log(spark: SparkSession, output_path: str, summaries: list[dict]) -> None:
    names = [f.split()[0] for f in RUNS.split(", ")]
    (spark.createDataFrame([tuple(s[n] for n in names) for s in summaries], RUNS).coalesce(1)
     .write.mode("append").parquet(f"{output_path}/_runs"))


def runs(spark: SparkSession, output_path: str) -> DataFrame:
    """The summaries of all runs that wrote to ``output_path``."""
    return spark.read.schema(RUNS).parquet(f"{output_path}/_runs")


def _output(scored: DataFrame, cfg: PredictionConfig) -> DataFrame:
    return scoring.select_existing(scored, [cfg.entity_column if c == "user_id" else
                                            cfg.prediction_column if c == "prediction" else c for c in OUTPUT_COLUMNS])


def _writer(out: DataFrame, cfg: PredictionConfig, partition_by: list):
    w = out.write.mode("append")
    if cfg.output_mode == "overwrite":
        w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return w.partitionBy(*partition_by) if partition_by else w


def run(features: DataFrame, model, cfg: PredictionConfig, output_path: str, run_id: str,
        prediction_date=None) -> dict:
    """Score and write; returns the job summary (``empty`` when nothing to score)."""
    begun = time.monotonic()
    out = _output(score(features, model, cfg, run_id, prediction_date), cfg)
    # an overwrite replaces the dates it holds, never the whole output
    partition_by = cfg.partition_by or (["date"] if cfg.output_mode == "overwrite" and "date" in out.columns else [])
    stats: Mapping = {"rows": 0}
    # without partitions an overwrite by no rows would empty the output
    if cfg.output_mode != "overwrite" or partition_by or not out.isEmpty():
        obs = Observation(f"predict_{run_id}")
        observed = out.observe(obs, *scoring.stats_exprs(cfg.prediction_column), F.count(F.lit(1)).alias("rows"))
        _writer(observed, cfg, partition_by).parquet(output_path)
        stats = obs.get
    summary = _summary(cfg, run_id, prediction_date, int(stats["rows"]), stats, time.monotonic() - begun)
    _log(features.sparkSession, output_path, [summary])
    return summary


def run_dates(features: DataFrame, model, cfg: PredictionConfig, output_path: str,
              run_ids: Mapping[dt.date, str]) -> list[dict]:
    """U5/K4 for many dates at once: each date has its own run id and summary, all are
    scored in one write partitioned by ``date`` (which the features must have). The run ids
    must be new to the output. ``run_ids`` (a row per date) is broadcast; the dates reach
    the scan as a range. ``duration_seconds`` is that of the whole job."""
    spark = features.sparkSession
    if not run_ids:
        return []
    if len(set(run_ids.values())) < len(run_ids):
        raise ValueError("each date needs a run id of its own")
    begun = time.monotonic()
    ids = spark.createDataFrame([(d, i) for d, i in run_ids.items()], "date date, _run_id string")
    due = features.filter(F.col("date").between(F.lit(min(run_ids)), F.lit(max(run_ids))))
    cols = cfg.feature_columns or feature_columns(features, cfg.entity_column)
    due = with_feature_vector(due.join(F.broadcast(ids), "date"), cols)
    scored = scoring.predict(due, model, "_features", cfg.prediction_column, cols, False, cfg.output)
    out = _output(scoring.with_lineage(scored, F.col("_run_id"), cfg.model_name, cfg.model_version, cfg.feature_snapshot), cfg)
    _writer(out, cfg, ["date"]).parquet(output_path)
    written = (spark.read.schema(out.schema).parquet(output_path)
               .filter(F.col("date").between(F.lit(min(run_ids)), F.lit(max(run_ids))))  # partitions, not files
               .join(F.broadcast(ids.select(F.col("_run_id").alias("_prediction_run_id"))), "_prediction_run_id", "left_semi"))
    stats = {r["_prediction_run_id"]: r.asDict() for r in written.groupBy("_prediction_run_id").agg(
        *scoring.stats_exprs(cfg.prediction_column), F.count(F.lit(1)).alias("rows")).collect()}  # a row per date
    seconds = time.monotonic() - begun
    summaries = [_summary(cfg, i, d, int(stats.get(i, {}).get("rows", 0)), stats.get(i, {}), seconds)
                 for d, i in sorted(run_ids.items())]
    _log(spark, output_path, summaries)
    return summaries

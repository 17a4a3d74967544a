"""Model registry as set-based operators over a ``model_versions`` table.

Versions are rows (``schemas.MODEL_VERSIONS``); lifecycle changes are rows of a
promotion event log ``(model_name, version, seq, kind)`` and the stage of every
version is derived from that log in one pass, so concurrent registries never
rewrite documents in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAGES = ("none", "staging", "production", "archived")


def semver_key(version: Column | str) -> Column:
    """Numeric sort key of ``major.minor.patch`` (1.0.10 > 1.0.9)."""
    v = F.col(version) if isinstance(version, str) else version
    return F.transform(F.split(v, r"\."), lambda x: x.cast("int"))


def latest_versions(mv: DataFrame) -> DataFrame:
    """Highest semantic version per model."""
    return mv.groupBy("model_name").agg(F.max_by("version", semver_key("version")).alias("latest_version"),
                                        F.count(F.lit(1)).alias("versions"))


def next_version(latest: Column, bump: Column) -> Column:
    """Next version after ``latest`` for bump ∈ major|minor|patch; none ⇒ 1.0.0."""
    p = semver_key(latest)
    major, minor, patch = p[0], p[1], p[2]
    nxt = (F.when(bump == "major", F.concat_ws(".", (major + 1).cast("string"), F.lit("0"), F.lit("0")))
           .when(bump == "minor", F.concat_ws(".", major.cast("string"), (minor + 1).cast("string"), F.lit("0")))
           .otherwise(F.concat_ws(".", major.cast("string"), minor.cast("string"), (patch + 1).cast("string"))))
    return F.when(latest.isNull(), F.lit("1.0.0")).otherwise(nxt)


def stages(versions: DataFrame, events: DataFrame) -> DataFrame:
    """Stage of every version from the promotion log.

    Fold semantics, evaluated set-wise: a version's last event decides; a
    production version is archived once another version reaches production
    later; a staging version drops to none once another version is staged
    later (promotion to production clears it through its own later event);
    an explicit ``archive`` event archives a version directly.
    """
    last = events.groupBy("model_name", "version").agg(F.max_by("kind", "seq").alias("_kind"),
                                                       F.max("seq").alias("_seq"))
    mx = events.groupBy("model_name").agg(
        F.max(F.when(F.col("kind") == "staging", F.col("seq"))).alias("_ms"),
        F.max(F.when(F.col("kind") == "production", F.col("seq"))).alias("_mp"))
    stage = (F.when(F.col("_kind") == "production",
                    F.when(F.col("_mp") > F.col("_seq"), "archived").otherwise("production"))
             .when(F.col("_kind") == "staging",
                   F.when(F.col("_ms") > F.col("_seq"), "none").otherwise("staging"))
             .when(F.col("_kind") == "archive", "archived")
             .otherwise("none"))
    return (versions.drop("stage").join(last, ["model_name", "version"], "left")
            .join(mx, "model_name", "left")
            .withColumn("stage", stage).drop("_kind", "_seq", "_ms", "_mp"))


def production(mv: DataFrame) -> DataFrame:
    """G1: the production version per model (at most one by construction)."""
    return mv.filter(F.col("stage") == "production")


class ModelNotFound(Exception):
    """No such version, or no production version of the model."""


def resolve(mv: DataFrame, model_name: str, version: str | None = None):
    """G1: the row of the version a job is to use: the one asked for, else the one in
    production; ``ModelNotFound`` when there is none."""
    of_model = mv.filter(F.col("model_name") == model_name)
    rows = (production(of_model) if version is None else of_model.filter(F.col("version") == version)).limit(1).collect()
    if not rows:
        raise ModelNotFound(f"{model_name}: " + ("no production version" if version is None else f"no version {version}"))
    return rows[0]


def metrics_long(mv: DataFrame) -> DataFrame:
    return mv.select("model_name", "version", F.explode("metrics").alias("metric", "value"))


def compare_versions(mv: DataFrame, version_a: Column | str, version_b: Column | str) -> DataFrame:
    """Metrics present in both versions: value_a, value_b,
    ``diff = round(b - a, 4)``, ``pct_change = round((b - a) / a * 100, 2)`` (0 if a = 0).

    ``version_a`` / ``version_b`` are literals or per-model columns of a
    (model_name, version_a, version_b) pairs table.
    """
    m = metrics_long(mv)
    a = m.select("model_name", F.col("version").alias("version_a"), "metric", F.col("value").alias("value_a"))
    b = m.select("model_name", F.col("version").alias("version_b"), "metric", F.col("value").alias("value_b"))
    if isinstance(version_a, DataFrame):  # pairs table
        pairs = version_a
    else:
        pairs = (mv.select("model_name").distinct()
                 .withColumn("version_a", F.lit(version_a) if isinstance(version_a, str) else version_a)
                 .withColumn("version_b", F.lit(version_b) if isinstance(version_b, str) else version_b))
    j = (pairs.join(a, ["model_name", "version_a"]).join(b, ["model_name", "version_b", "metric"]))
    d = F.col("value_b") - F.col("value_a")
    return j.select("model_name", "metric", "version_a", "version_b", "value_a", "value_b",
                    F.round(d, 4).alias("diff"),
                    F.when(F.col("value_a") != 0, F.round(d / F.col("value_a") * 100, 2))
                    .otherwise(F.lit(0.0)).alias("pct_change"))


def metric_trend(mv: DataFrame) -> DataFrame:
    """Change of each metric from the previous version in semver order."""
    m = metrics_long(mv).withColumn("_k", semver_key("version"))
    w = Window.partitionBy("model_name", "metric").orderBy("_k")
    return (m.withColumn("prev_value", F.lag("value").over(w))
            .withColumn("change", F.col("value") - F.col("prev_value"))
            .drop("_k"))


def lineage(mv: DataFrame) -> DataFrame:
    """Code, data, environment and artifact lineage of each version."""
    md = F.col("metadata")
    snap = md["feature_snapshot_id"]
    return mv.select(
        F.concat_ws(":", "model_name", "version").alias("model"),
        "created_at",
        md["git_commit_hash"].alias("git_commit"),
        md["training_run_id"].alias("training_run_id"),
        md["pipeline_user"].alias("pipeline_user"),
        snap.alias("feature_snapshot_id"),
        md["training_data_path"].alias("training_data_path"),
        F.map_from_entries(F.array_sort(F.map_entries(F.col("metrics")))).alias("metrics"),
        F.map_from_entries(F.array_sort(F.map_entries(md["custom_tags"]))).alias("custom_tags"),
        md["framework"].alias("framework"),
        F.col("model_path").alias("artifact_path"),
        F.col("model_format").alias("artifact_format"),
    )


PROMOTIONS = "model_name string, version string, seq long, kind string"


def metadata(**fields) -> Column:
    """A full ``metadata`` struct; unspecified lineage fields are NULL."""
    from featurekit import schemas
    parts = []
    for f in schemas.MODEL_METADATA.fields:
        v = fields.get(f.name)
        c = v if isinstance(v, Column) else F.lit(v)
        parts.append(c.cast(f.dataType).alias(f.name))
    return F.struct(*parts)


class RegistryTable:
    """A model registry stored as two Parquet tables: ``versions`` (one row per
    registered version, ``schemas.MODEL_VERSIONS``) and ``promotions`` (the
    lifecycle event log). Registering or promoting appends rows; stages are
    derived by ``stages`` on read, so nothing is rewritten in place."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema) -> DataFrame:
        from featurekit.sources import metalog
        p = f"{self.path}/{name}"
        if not metalog.exists(self.spark, p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(p)

    def raw_versions(self) -> DataFrame:
        from featurekit import schemas
        return self._read("versions", schemas.MODEL_VERSIONS)

    def promotions(self) -> DataFrame:
        return self._read("promotions", PROMOTIONS)

    def versions(self) -> DataFrame:
        """Every version with its stage derived from the promotion log."""
        return stages(self.raw_versions(), self.promotions())

    def register(self, new_versions: DataFrame) -> None:
        """Append version rows (callers compute ``version`` with ``next_version``)."""
        from featurekit import schemas
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in new_versions.columns
                else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.MODEL_VERSIONS.fields]
        new_versions.select(*cols).withColumn("stage", F.lit("none")) \
            .write.mode("append").parquet(f"{self.path}/versions")

    def import_json_documents(self, path: str) -> None:
        """Load version documents (one JSON object per version, as a
        file-based registry keeps them) into the versions table. The stage
        recorded in a document becomes a promotion event, so derived stages
        match the documents."""
        from featurekit import schemas
        docs = self.spark.read.schema(schemas.MODEL_VERSIONS).json(path)
        self.register(docs)
        seq = F.unix_seconds(F.to_timestamp("created_at"))
        kind = F.when(F.col("stage") == "archived", "archive").otherwise(F.col("stage"))
        self.promote(docs.filter(F.col("stage").isin("staging", "production", "archived"))
                     .select("model_name", "version", seq.alias("seq"), kind.alias("kind")))

    def promote(self, events: DataFrame) -> None:
        """Append promotion events (model_name, version, seq, kind); a version that
        is not registered cannot be promoted."""
        unknown = events.join(self.raw_versions(), ["model_name", "version"], "left_anti").limit(1).collect()
        if unknown:
            raise ModelNotFound(f"{unknown[0].model_name}: no version {unknown[0].version}")
        events.select("model_name", "version", F.col("seq").cast("long"), "kind") \
            .write.mode("append").parquet(f"{self.path}/promotions")

"""Data-quality audits: every rule of a check set is evaluated in ONE aggregate.

A rule set is a list of ``Rule`` rows; each becomes conditional aggregate
expressions inside a single ``agg`` (one scan, partial aggregation on the map
side), and the one-row result is unpivoted into one verdict row per rule.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """kind ∈ not_null | range | accepted_values | unique | min_rows | null_rate | mean_within"""
    kind: str
    column: str | None = None
    params: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}" if self.column else self.kind


#: Rule kinds and the parameters each needs.
KINDS = {"not_null": (), "range": ("min", "max"), "accepted_values": ("values",), "unique": (), "min_rows": ("min",),
         "null_rate": ("max",), "mean_within": ("mean", "k", "stddev")}


def rules_from_checks(checks: dict) -> list[Rule]:
    """The check dict ``{column: requirement}``: a kind without parameters by name, any
    other as ``(kind, {parameter: value})``. Unknown kinds and missing parameters raise."""
    out = []
    for col, req in checks.items():
        kind, params = (req, {}) if isinstance(req, str) else req
        if kind not in KINDS:
            raise ValueError(f"unknown quality requirement {kind!r} for column {col!r}")
        missing = [p for p in KINDS[kind] if p not in params]
        if missing:
            raise ValueError(f"requirement {kind!r} for column {col!r} needs {', '.join(missing)}")
        out.append(Rule(kind, col, dict(params)))
    return out


def _metric(rule: Rule) -> tuple[Column, Column]:
    """(observed value, failing-row count or pass flag) aggregate expressions."""
    c = F.col(rule.column) if rule.column else None
    p = rule.params
    if rule.kind == "not_null":
        bad = F.count_if(c.isNull())
        return bad.cast("double"), bad
    if rule.kind == "range":
        cond = c.isNotNull() & ((c < F.lit(p["min"])) | (c > F.lit(p["max"])))
        bad = F.count_if(cond)
        return bad.cast("double"), bad
    if rule.kind == "accepted_values":
        bad = F.count_if(c.isNotNull() & ~c.isin(list(p["values"])))
        return bad.cast("double"), bad
    if rule.kind == "min_rows":
        n = F.count(F.lit(1))
        return n.cast("double"), F.when(n >= F.lit(p["min"]), 0).otherwise(1).cast("long")
    if rule.kind == "null_rate":
        rate = F.avg(c.isNull().cast("double"))
        return rate, F.when(rate <= F.lit(p["max"]), 0).otherwise(1).cast("long")
    if rule.kind == "mean_within":
        m = F.avg(c)
        lo = F.lit(p["mean"] - p["k"] * p["stddev"])
        hi = F.lit(p["mean"] + p["k"] * p["stddev"])
        return m, F.when(m.between(lo, hi), 0).otherwise(1).cast("long")
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One verdict row per rule: (rule, kind, column, observed, failures, passed).

    ``unique`` needs a grouping and is computed as a second aggregate over
    ``groupBy(key).count() > 1`` (partial aggregation keeps a hot key cheap).
    """
    plain = [r for r in rules if r.kind != "unique"]
    parts = []
    if plain:
        exprs = []
        for i, r in enumerate(plain):
            obs, bad = _metric(r)
            exprs += [obs.alias(f"o{i}"), bad.cast("long").alias(f"b{i}")]
        one = df.agg(*exprs)
        stack = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"),
                                   F.lit(r.column).cast("string").alias("column"),
                                   F.col(f"o{i}").cast("double").alias("observed"),
                                   F.col(f"b{i}").alias("failures"))
                          for i, r in enumerate(plain)])
        parts.append(one.select(F.inline(stack)))
    for r in rules:
        if r.kind == "unique":
            keys = [k.strip() for k in r.column.split(",")]
            dup = df.groupBy(*keys).count().filter(F.col("count") > 1)
            parts.append(dup.agg(F.count(F.lit(1)).cast("double").alias("observed"),
                                 F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("failures"))
                         .select(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"),
                                 F.lit(r.column).alias("column"), "observed", "failures"))
    if not parts:  # nothing to check: no verdicts
        return df.sparkSession.createDataFrame([], "rule string, kind string, column string, observed double, "
                                                   "failures long, passed boolean")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


def validate(df: DataFrame, checks: dict) -> bool:
    """Reference-compatible gate: ``{column: 'not_null', ...}`` → bool (one job)."""
    verdicts = evaluate(df, rules_from_checks(checks))
    return verdicts.agg(F.coalesce(F.bool_and("passed"), F.lit(True))).first()[0]


def profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Null rate, mean and sample stddev per feature column (and per group).

    One aggregate computes all columns; ``stack`` unpivots to
    (group..., feature, null_rate, mean, stddev, rows).
    """
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.avg(x.isNull().cast("double")).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}")]
    aggs.append(F.count(F.lit(1)).alias("rows"))
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("null_rate"),
                             F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"))
                    for i, c in enumerate(columns)])
    return g.select(*by, "rows", F.inline(arr))


def check_outcomes_by_partition(df: DataFrame, checks: dict, partition_col: str) -> DataFrame:
    """A13 input: run the not-null checks per partition value, one row per
    (partition, check, result) — a single grouped aggregate for all checks."""
    exprs = [F.count_if(F.col(c).isNull()).alias(f"b{i}") for i, c in enumerate(checks)]
    g = df.groupBy(partition_col).agg(*exprs)
    arr = F.array(*[F.struct(F.lit(f"{req}:{c}").alias("check"),
                             F.when(F.col(f"b{i}") == 0, "passed").otherwise("failed").alias("result"))
                    for i, (c, req) in enumerate(checks.items())])
    return g.select(partition_col, F.inline(arr))


def schema_changes(spark, old, new, table: str) -> DataFrame:
    """(table, column, change_type ∈ add|drop|retype, old_type, new_type).

    Column lists are schema metadata (one row per column)."""
    o = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in old.fields],
                              "column string, old_type string")
    n = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in new.fields],
                              "column string, new_type string")
    j = o.join(n, "column", "full_outer")
    kind = (F.when(F.col("old_type").isNull(), "add").when(F.col("new_type").isNull(), "drop")
            .when(F.col("old_type") != F.col("new_type"), "retype"))
    return (j.withColumn("change_type", kind).filter(F.col("change_type").isNotNull())
            .select(F.lit(table).alias("table"), "column", "change_type", "old_type", "new_type"))


# rules whose verdict over a table equals the verdict over its newly added rows
# when the existing rows already passed (row-local rules)
ROW_LOCAL = ("not_null", "range", "accepted_values")


def observe(df: DataFrame, rules: Sequence[Rule], name: str):
    """Attach row-local rules to ``df`` as an ``Observation``: the audit runs
    inside the job that writes the rows (no second scan). Returns
    ``(observed_df, verdicts)`` where ``verdicts()`` → ``{rule name: failures}``
    after the write action has run."""
    from pyspark.sql import Observation
    local = [r for r in rules if r.kind in ROW_LOCAL]
    if not local:
        return df, lambda: {}
    obs = Observation(name)
    exprs = [_metric(r)[1].cast("long").alias(f"b{i}") for i, r in enumerate(local)]
    out = df.observe(obs, *exprs)
    return out, lambda: {r.name: int(obs.get[f"b{i}"]) for i, r in enumerate(local)}

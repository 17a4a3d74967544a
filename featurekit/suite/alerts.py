"""Registered queries: alert conditions, firings, resolutions, silences, history.

Ticks are the hours of the metrics table derived from ``events`` (see
``suite.metrics``); the six default rules are evaluated on every tick.
Silences (derived from the data): ``job_failure_spike`` is silenced every
day from 02:00 to 04:00 inclusive, for each day that has events.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.operators import alerts as A
from featurekit.session import fresh_dir
from featurekit.sources import tables
from featurekit.streaming.alerts import run_alert_stream
from featurekit.suite.common import registrar
from featurekit.suite.metrics import BOUNDS, METRICS_SQL, metrics_from_events

QUERIES: dict = {}
ORACLES: dict = {}


register = registrar(QUERIES, ORACLES)


def _ctx(spark, sf_dir):
    rules = A.rules_df(spark)
    ticks = A.tick_aggregates(metrics_from_events(spark, sf_dir))
    return rules, A.conditions(ticks, rules)


def silences(spark, sf_dir) -> DataFrame:
    d = tables.raw_events(spark, sf_dir).select(F.to_date("timestamp").alias("d")).distinct()
    start = F.to_timestamp_ntz(F.concat(F.col("d").cast("string"), F.lit(" 02:00:00")))
    return d.select(F.lit("job_failure_spike").alias("rule_name"), start.alias("from"),
                    (start + F.expr("INTERVAL 2 HOURS")).alias("until"))


# ----------------------------------------------------------------- oracle SQL
def _rules_values() -> str:
    import json
    rows = []
    for n, c, s, m, lab, fd, cd in A.DEFAULT_RULES:
        js = json.dumps(lab, sort_keys=True).replace("'", "''")
        rows.append(f"('{n}', '{s}', CAST({fd} AS DOUBLE), CAST({cd} AS DOUBLE), '{js}')")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") r(name, severity, for_duration, cooldown, labels_json)"


RULES_SQL = _rules_values()
_P99 = ("CASE WHEN n = 0 THEN 0.0 " + " ".join(
    f"WHEN c{i} >= n * 0.99 THEN {([BOUNDS[0] / 2] + [(BOUNDS[j - 1] + BOUNDS[j]) / 2 for j in range(1, len(BOUNDS))])[i]!r}"
    for i in range(len(BOUNDS))) + f" ELSE {BOUNDS[-1]!r} END")

_SO_FAR = "OVER (ORDER BY t ROWS UNBOUNDED PRECEDING)"
TICKS_SQL = f"""
WITH m AS (SELECT date_trunc('hour', ts) AS t, * FROM ({METRICS_SQL})),
g AS (SELECT t, name, labels, arg_max(value, (ts, seq)) AS last FROM m WHERE type = 'gauge' GROUP BY 1, 2, 3),
gi AS (SELECT *, lead(t) OVER (PARTITION BY name, labels ORDER BY t) AS until FROM g),
ga AS (SELECT k.t, max(last) FILTER (WHERE contains(name, 'null_rate')) AS max_null_rate,
              max(last) FILTER (WHERE contains(name, 'drift_detected')) AS max_drift_detected,
              max(last) FILTER (WHERE contains(name, 'model_age_hours')) AS max_model_age,
              count(*) FILTER (WHERE contains(name, 'online_store_keys') AND last = 0) AS store_zero
       FROM (SELECT DISTINCT t FROM m) k JOIN gi ON k.t >= gi.t AND (gi.until IS NULL OR k.t < gi.until) GROUP BY k.t),
ch AS (SELECT t, coalesce(sum(value) FILTER (WHERE type = 'counter' AND contains(name, 'failure')), 0) AS failures,
              {", ".join(f"count(*) FILTER (WHERE name = 'prediction_latency_seconds' AND type = 'histogram' AND value <= {b}) AS c{i}" for i, b in enumerate(BOUNDS))},
              count(*) FILTER (WHERE name = 'prediction_latency_seconds' AND type = 'histogram') AS n
       FROM m GROUP BY t),
ca AS (SELECT t, sum(failures) {_SO_FAR} AS failures, sum(n) {_SO_FAR} AS n,
              {", ".join(f"sum(c{i}) {_SO_FAR} AS c{i}" for i in range(len(BOUNDS)))} FROM ch)
SELECT ca.t, failures, CAST(({_P99}) AS DOUBLE) AS p99_latency, max_null_rate, max_drift_detected, max_model_age,
       coalesce(store_zero, 0) AS store_zero
FROM ca LEFT JOIN ga ON ca.t = ga.t"""

CONDS_SQL = f"""
WITH k AS ({TICKS_SQL})
SELECT 'high_feature_null_rate' AS rule, t, coalesce(max_null_rate > 0.1, false) AS cond FROM k
UNION ALL SELECT 'prediction_latency_high', t, p99_latency > 0.5 FROM k
UNION ALL SELECT 'job_failure_spike', t, failures > 3 FROM k
UNION ALL SELECT 'feature_drift_detected', t, coalesce(max_drift_detected > 0, false) FROM k
UNION ALL SELECT 'model_too_old', t, coalesce(max_model_age > 168, false) FROM k
UNION ALL SELECT 'online_store_empty', t, store_zero > 0 FROM k"""

SILENCES_SQL = """
SELECT 'job_failure_spike' AS rule_name, CAST(d AS TIMESTAMP) + INTERVAL 2 HOUR AS "from",
       CAST(d AS TIMESTAMP) + INTERVAL 4 HOUR AS "until"
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)"""


def fold_sql(conds_sql: str) -> str:
    """The sequential rule semantics as a recursive CTE (oracle only)."""
    return f"""
WITH RECURSIVE c AS MATERIALIZED (
  SELECT rule, date_diff('second', TIMESTAMP '1970-01-01', t) AS ts, cond,
         row_number() OVER (PARTITION BY rule ORDER BY t) AS rn
  FROM ({conds_sql}) WHERE cond IS NOT NULL),
r AS ({RULES_SQL}),
s(rule, rn, first_true, last_fired, active, status, ev_t, fired_at) AS (
  SELECT name, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT), false, CAST(NULL AS VARCHAR),
         CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM r
  UNION ALL
  SELECT s.rule, c.rn,
         CASE WHEN c.cond THEN coalesce(s.first_true, c.ts) END,
         CASE WHEN c.cond AND c.ts - coalesce(s.first_true, c.ts) >= r.for_duration
                   AND c.ts - s.last_fired >= r.cooldown THEN c.ts ELSE s.last_fired END,
         CASE WHEN c.cond AND c.ts - coalesce(s.first_true, c.ts) >= r.for_duration
                   AND c.ts - s.last_fired >= r.cooldown THEN true WHEN NOT c.cond THEN false ELSE s.active END,
         CASE WHEN c.cond AND c.ts - coalesce(s.first_true, c.ts) >= r.for_duration
                   AND c.ts - s.last_fired >= r.cooldown THEN 'firing'
              WHEN NOT c.cond AND s.active THEN 'resolved' END,
         c.ts,
         CASE WHEN c.cond THEN c.ts ELSE s.last_fired END
  FROM s JOIN c ON c.rule = s.rule AND c.rn = s.rn + 1 JOIN r ON r.name = s.rule)
SELECT rule AS rule_name, status, ev_t,
       make_timestamp(fired_at * 1000000) AS fired_at,
       CASE WHEN status = 'resolved' THEN make_timestamp(ev_t * 1000000) END AS resolved_at
FROM s WHERE status IS NOT NULL"""


UNSILENCED_SQL = f"""
SELECT c.* FROM ({CONDS_SQL}) c
WHERE NOT EXISTS (SELECT 1 FROM ({SILENCES_SQL}) s
                  WHERE s.rule_name = c.rule AND c.t >= s."from" AND c.t <= s."until")"""

FIRINGS = fold_sql(CONDS_SQL)
FINGERPRINT_SQL = "substr(md5(r.name || ':' || r.labels_json), 1, 12)"


@register("alert_conditions", f"SELECT rule, CAST(t AS VARCHAR) AS t, cond FROM ({CONDS_SQL})")
def alert_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1/U4: every default rule's SQL predicate on every hourly tick."""
    return _ctx(spark, sf_dir)[1]


@register("alert_condition_since", f"""
WITH c AS ({CONDS_SQL}),
i AS (SELECT *, sum(CASE WHEN NOT cond THEN 1 ELSE 0 END) OVER (PARTITION BY rule ORDER BY t ROWS UNBOUNDED PRECEDING)
               AS island FROM c)
SELECT rule, CAST(t AS VARCHAR) AS t, CAST(min(t) OVER (PARTITION BY rule, island) AS VARCHAR) AS first_true
FROM i WHERE cond""")
def alert_condition_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Since when each true condition has been continuously true."""
    return A.condition_since(_ctx(spark, sf_dir)[1])


@register("alert_firings", f"""
SELECT f.rule_name, r.severity, CAST(f.fired_at AS VARCHAR) AS fired_at, {FINGERPRINT_SQL} AS fingerprint
FROM ({FIRINGS}) f JOIN ({RULES_SQL}) r ON r.name = f.rule_name WHERE f.status = 'firing'""")
def alert_firings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts fired under for_duration and cooldown."""
    rules, conds = _ctx(spark, sf_dir)
    ev = A.enrich(A.fold_events(conds, rules), rules)
    return ev.filter(F.col("status") == "firing").select("rule_name", "severity", "fired_at", "fingerprint")


@register("alert_resolutions", f"""
SELECT rule_name, CAST(fired_at AS VARCHAR) AS fired_at, CAST(resolved_at AS VARCHAR) AS resolved_at
FROM ({FIRINGS}) WHERE status = 'resolved'""")
def alert_resolutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: active alerts resolved at the first false tick."""
    rules, conds = _ctx(spark, sf_dir)
    return (A.fold_events(conds, rules).filter(F.col("status") == "resolved")
            .select("rule_name", "fired_at", "resolved_at"))


@register("alert_silenced", f"""
SELECT rule_name, status, CAST(fired_at AS VARCHAR) AS fired_at, CAST(resolved_at AS VARCHAR) AS resolved_at
FROM ({fold_sql(UNSILENCED_SQL)})""")
def alert_silenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With daily silences of job_failure_spike, silenced ticks are not
    evaluated at all (state frozen), then the fold runs."""
    rules, conds = _ctx(spark, sf_dir)
    kept = A.remove_silenced(conds, silences(spark, sf_dir))
    return A.fold_events(kept, rules).select("rule_name", "status", "fired_at", "resolved_at")


@register("alert_active", f"""
SELECT rule_name, CAST(arg_max(fired_at, ev_t) AS VARCHAR) AS fired_at
FROM ({FIRINGS}) GROUP BY rule_name HAVING arg_max(status, ev_t) = 'firing'""")
def alert_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts still firing after the last tick."""
    rules, conds = _ctx(spark, sf_dir)
    return A.active(A.fold_events(conds, rules))


@register("alert_fingerprint", f"""
SELECT DISTINCT f.rule_name, {FINGERPRINT_SQL} AS fingerprint
FROM ({FIRINGS}) f JOIN ({RULES_SQL}) r ON r.name = f.rule_name WHERE f.status = 'firing'""")
def alert_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedup fingerprint of each rule that fired."""
    rules, conds = _ctx(spark, sf_dir)
    ev = A.enrich(A.fold_events(conds, rules), rules)
    return ev.filter(F.col("status") == "firing").select("rule_name", "fingerprint").distinct()


# rule management: one custom rule added, one default removed
CUSTOM_RULE = ("error_burst", "failures > 10", "error", "Error burst", {"team": "data-eng"}, 0.0, 3600.0)


@register("alert_rules", f"""
WITH k AS ({TICKS_SQL}),
r AS (SELECT name, severity, for_duration, cooldown FROM ({RULES_SQL}) WHERE name <> 'model_too_old'
      UNION ALL SELECT 'error_burst', 'error', CAST(0.0 AS DOUBLE), CAST(3600.0 AS DOUBLE)),
c AS ({CONDS_SQL} UNION ALL SELECT 'error_burst', t, failures > 10 FROM k)
SELECT r.name, r.severity, r.for_duration, r.cooldown,
       CAST(count(*) FILTER (WHERE c.cond) AS BIGINT) AS true_ticks
FROM r JOIN c ON c.rule = r.name GROUP BY 1, 2, 3, 4""")
def alert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule set management (add = union, remove = anti-join) and how often
    each rule's condition held."""
    rules = A.rules_df(spark)
    rules = rules.unionByName(A.rules_df(spark, [CUSTOM_RULE]))
    rules = rules.join(spark.createDataFrame([("model_too_old",)], "name string"), "name", "left_anti")
    ticks = A.tick_aggregates(metrics_from_events(spark, sf_dir))
    conds = A.conditions(ticks, rules)
    return (conds.groupBy("rule").agg(F.count_if("cond").alias("true_ticks"))
            .join(rules.select(F.col("name").alias("rule"), "severity", "for_duration", "cooldown"), "rule")
            .select(F.col("rule").alias("name"), "severity", "for_duration", "cooldown", "true_ticks"))


def _history(spark, sf_dir) -> DataFrame:
    """Alert events with all fields of their rules, written once as JSON lines."""
    rules, conds = _ctx(spark, sf_dir)
    ev = A.enrich(A.fold_events(conds, rules), rules)
    path = fresh_dir(spark, "alert_history")
    cols = ["event_ts", "rule_name", "severity", "status", "message", "description", "labels", "fired_at",
            "resolved_at", "fingerprint"]
    ev.select(*cols).write.mode("append").json(path)
    schema = ("event_ts bigint, rule_name string, severity string, status string, message string, description string, "
              "labels map<string,string>, fired_at timestamp_ntz, resolved_at timestamp_ntz, fingerprint string")
    return spark.read.schema(schema).json(path)


HISTORY_SQL = f"""SELECT f.*, r.severity, ev_t AS event_ts, {FINGERPRINT_SQL} AS fingerprint
FROM ({FIRINGS}) f JOIN ({RULES_SQL}) r ON r.name = f.rule_name"""


def _newest(h: DataFrame, n: int) -> DataFrame:
    return h.orderBy(*[F.col(c).desc() for c in A.HISTORY_ORDER]).limit(n)


@register("alert_history_tail", f"""
SELECT event_ts, rule_name, severity, status, CAST(fired_at AS VARCHAR) AS fired_at,
       CAST(resolved_at AS VARCHAR) AS resolved_at, fingerprint
FROM ({HISTORY_SQL}) ORDER BY event_ts DESC, rule_name DESC, status DESC LIMIT 100""")
def alert_history_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12/T-3: the last 100 alert history rows in insertion order (top-k)."""
    return _newest(_history(spark, sf_dir), 100).select(
        "event_ts", "rule_name", "severity", "status", "fired_at", "resolved_at", "fingerprint")


@register("alert_summary", f"""
WITH h AS (SELECT * FROM ({HISTORY_SQL}) ORDER BY event_ts DESC, rule_name DESC, status DESC LIMIT 1000),
a AS (SELECT rule_name, arg_max(status, ev_t) AS last_status FROM ({FIRINGS}) GROUP BY 1)
SELECT 'history' AS scope, severity, CAST(count(*) AS BIGINT) AS alerts FROM h GROUP BY severity
UNION ALL
SELECT 'active', r.severity, CAST(count(*) AS BIGINT) FROM a JOIN ({RULES_SQL}) r ON r.name = a.rule_name
WHERE a.last_status = 'firing' GROUP BY r.severity
UNION ALL SELECT 'all_history', severity, CAST(count(*) AS BIGINT) FROM ({HISTORY_SQL}) GROUP BY severity
UNION ALL SELECT 'rules', severity, CAST(count(*) AS BIGINT) FROM ({RULES_SQL}) GROUP BY severity
UNION ALL SELECT 'silenced_rules', r.severity, CAST(count(DISTINCT s.rule_name) AS BIGINT)
FROM ({SILENCES_SQL}) s JOIN ({RULES_SQL}) r ON r.name = s.rule_name GROUP BY r.severity""")
def alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By severity: the last 1000 history rows, active alerts, the whole history,
    rules, and rules with a silence. The history is written once and serves them all."""
    rules, _ = _ctx(spark, sf_dir)
    h = _history(spark, sf_dir)

    def by_severity(df: DataFrame, scope: str) -> DataFrame:
        return df.groupBy(F.lit(scope).alias("scope"), "severity").agg(F.count(F.lit(1)).alias("alerts"))

    silenced = rules.join(silences(spark, sf_dir).select("rule_name").distinct(),
                          F.col("name") == F.col("rule_name"), "left_semi")
    return (by_severity(_newest(h, 1000), "history").unionByName(by_severity(A.enrich(A.active(h), rules), "active"))
            .unionByName(by_severity(h, "all_history")).unionByName(by_severity(rules, "rules"))
            .unionByName(by_severity(silenced, "silenced_rules")))


BROKEN_RULES = [("divides_by_zero", "failures / (failures - failures) > 1", "info", "Errs on every tick", {}, 0.0, 0.0),
                ("unknown_column", "no_such_metric > 1", "info", "Cannot be analysed", {}, 0.0, 0.0)]


@register("alert_erring_rules", f"""
SELECT rule, CAST(count(*) AS BIGINT) AS ticks, CAST(count(cond) AS BIGINT) AS evaluated,
       CAST(count(*) FILTER (WHERE cond) AS BIGINT) AS true_ticks
FROM ({CONDS_SQL} UNION ALL SELECT 'divides_by_zero', t, NULL FROM ({TICKS_SQL})
      UNION ALL SELECT 'unknown_column', t, NULL FROM ({TICKS_SQL})) GROUP BY rule""")
def alert_erring_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that err are skipped, every other rule is evaluated as ever."""
    rules = A.rules_df(spark).unionByName(A.rules_df(spark, BROKEN_RULES))
    conds = A.conditions(A.tick_aggregates(metrics_from_events(spark, sf_dir)), rules)
    return conds.groupBy("rule").agg(F.count(F.lit(1)).alias("ticks"), F.count("cond").alias("evaluated"),
                                     F.count_if("cond").alias("true_ticks"))


@register("alert_stream", f"""
SELECT rule_name, status, CAST(fired_at AS VARCHAR) AS fired_at, CAST(resolved_at AS VARCHAR) AS resolved_at
FROM ({FIRINGS})""")
def alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same evaluation on the raw metric stream: totals per shard and tick, ticks closed by
    event-time timers, conditions per tick, and a state machine keyed by rule."""
    return run_alert_stream(spark, metrics_from_events(spark, sf_dir), A.rules_df(spark), fresh_dir(spark, "alert_stream"))

"""Alert rules evaluated over a metrics time series.

* rules are rows with a SQL predicate over per-tick aggregate columns (L1/L8);
* the per-tick conditions are computed with grouped aggregates (one row per
  tick), NULL conditions are dropped (an evaluation error neither fires nor
  resolves, L5) and silenced ticks are removed with an anti-join on dyadic
  intervals (J7/L4);
* firing/resolution semantics (``for_duration``, ``cooldown``, last firing
  surviving resolution) are sequential. A rule's ticks are cut into chunks of time: every
  chunk is summarised as a function from the state it starts in to the state it ends in,
  the functions are composed in order, and each chunk is then run from its own start
  (the streaming evaluator keeps the same state between micro-batches) — linear in the
  number of ticks, no task holds a rule's history, and metric rows are never touched (L2/L3).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from pyspark.errors import AnalysisException, ParseException

from featurekit import schemas
from featurekit.functions.labels import escaped, labels_key
from featurekit.functions import timeutil as tu
from featurekit.operators import metrics as M

# The six default rules (name, condition over tick aggregates,
# severity, message, labels, for_duration s, cooldown s).
DEFAULT_RULES = [
    ("high_feature_null_rate", "coalesce(max_null_rate > 0.1, false)", "warning",
     "Feature null rate exceeds 10%", {}, 60.0, 300.0),
    ("prediction_latency_high", "p99_latency > 0.5", "error",
     "P99 prediction latency exceeds 500ms", {"team": "ml-infra"}, 120.0, 600.0),
    ("job_failure_spike", "failures > 3", "critical",
     "Multiple job failures detected", {"team": "data-eng", "oncall": "true"}, 0.0, 900.0),
    ("feature_drift_detected", "coalesce(max_drift_detected > 0, false)", "warning",
     "Feature distribution drift detected", {}, 300.0, 3600.0),
    ("model_too_old", "coalesce(max_model_age > 168, false)", "info",
     "Production model is over 1 week old", {}, 0.0, 86400.0),
    ("online_store_empty", "store_zero > 0", "critical",
     "Online feature store is empty", {}, 0.0, 300.0),
]


def rules_df(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    rows = [Row(name=n, condition=c, severity=s, message=m, description="", labels=lab, for_duration=fd,
                cooldown=cd, runbook_url="") for n, c, s, m, lab, fd, cd in rules]
    return spark.createDataFrame(rows, schemas.ALERT_RULES)


#: Levels of dyadic intervals: of one unit to of 2^40. An open end is the last unit of them.
LEVELS = 41
OPEN_END = (1 << (LEVELS - 1)) - 1


def dyadic_nodes(df: DataFrame, lo: str, hi: str, levels: int = LEVELS) -> DataFrame:
    """The rows of ``df`` with (_k, _node) for each dyadic interval [node * 2^k, node * 2^k + 2^k) of the
    fewest that make up the whole numbers from ``lo`` to ``hi``: two a level at most. A number lies in
    one of them only, so sums over the intervals that hold it count each row once."""
    size = _level_size()
    s = df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    s = s.withColumn("_l", F.ceil(F.col(lo) / size)).withColumn("_h", F.floor((F.col(hi) + 1) / size) - 1)
    # what the next level cannot cover: an odd first interval, an even last one; on the last level, all
    top = F.col("_k") == levels - 1
    ends = F.array(F.when((F.col("_l") % 2 != 0) | top, F.col("_l")),
                   F.when(((F.col("_h") % 2 == 0) | top) & ~(top & (F.col("_l") == F.col("_h"))), F.col("_h")))
    return s.filter("_l <= _h").withColumn("_node", F.explode(F.array_compact(ends))).drop("_l", "_h")


def _level_size() -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_k"))


def tick_aggregates(metrics: DataFrame, tick_seconds: int = 3600, chunk_ticks: int = 4096) -> DataFrame:
    """Per-tick aggregate columns the rule predicates refer to: what a collector would
    show at the end of the tick. Counters and histograms are summed since the start,
    a gauge keeps its last value until it is set again.

    Metrics are first reduced to one row per tick, or per (tick, series) for gauges, with partial aggregation.
    Sums since the start go in two levels: inside chunks of ``chunk_ticks`` ticks, and over one row per chunk. A
    gauge's value holds for the ticks until it is replaced; these are a few dozen dyadic intervals at most, whatever their
    length, which are reduced per interval, and a tick looks up the intervals it lies in.
    """
    v, name, typ = F.col("value"), F.col("name"), F.col("type")
    m = metrics.withColumn("_tick", F.floor(tu.epoch_seconds("ts") / tick_seconds))
    lat = (name == "prediction_latency_seconds") & (typ == "histogram")
    bounds = list(enumerate(M.DEFAULT_BUCKETS))
    sums = m.groupBy("_tick").agg(
        F.coalesce(F.sum(F.when((typ == "counter") & name.contains("failure"), v)), F.lit(0.0)).alias("failures"),
        *[F.count_if(lat & (v <= F.lit(b))).alias(f"_c{i}") for i, b in bounds], F.count_if(lat).alias("_n"))
    added = [c for c in sums.columns if c != "_tick"]
    sums = sums.withColumn("_chunk", F.floor(F.col("_tick") / chunk_ticks))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row per chunk
    chunks = sums.groupBy("_chunk").agg(*[F.sum(c).alias(c) for c in added]).select(
        "_chunk", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_b{c}") for c in added])
    so_far = Window.partitionBy("_chunk").orderBy("_tick").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select("_tick", "_chunk", *[F.sum(c).over(so_far).alias(c) for c in added]).join(chunks, "_chunk").select(
        "_tick", *[(F.col(c) + F.col(f"_b{c}")).alias(c) for c in added])
    # last value per (tick, series): the (ts, seq) order needs a struct buffer, so only
    # gauge rows take that path
    kinds = ["null_rate", "drift_detected", "model_age_hours", "online_store_keys"]
    last = (m.filter((typ == "gauge") & name.rlike("|".join(kinds))).groupBy("_tick", "name", labels_key().alias("series"))
            .agg(F.max_by(v, F.struct("ts", "seq")).alias("last")))
    until = F.lead("_tick").over(Window.partitionBy("name", "series").orderBy("_tick"))
    held = last.select("_tick", "name", "last", F.coalesce(until - 1, F.lit(OPEN_END)).alias("_last_tick"))
    nodes = dyadic_nodes(held, "_tick", "_last_tick").groupBy("_k", "_node").agg(
        *[F.max(F.when(name.contains(kind), F.col("last"))).alias(f"_g{i}") for i, kind in enumerate(kinds[:3])],
        F.count_if(name.contains("online_store_keys") & (F.col("last") == 0)).alias("_g3"))
    up = sums.select("_tick", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("_k")).withColumn(
        "_node", F.floor(F.col("_tick") / _level_size()))
    gauges = up.join(nodes, ["_k", "_node"]).groupBy("_tick").agg(
        F.max("_g0").alias("max_null_rate"), F.max("_g1").alias("max_drift_detected"), F.max("_g2").alias("max_model_age"),
        F.sum("_g3").alias("store_zero"))
    per_tick = (sums.join(gauges, "_tick", "left")
                .withColumn("store_zero", F.coalesce("store_zero", F.lit(0)).cast("long"))
                .withColumn("_cum", F.array(*[F.col(f"_c{i}") for i, _ in bounds])))
    return (per_tick.withColumn("p99_latency", M.percentile_from_buckets(F.col("_cum"), F.col("_n"), 0.99))
            .withColumn("t", tu.from_epoch_seconds(F.col("_tick") * tick_seconds))
            .drop("_cum", "_n", "_tick", *[f"_c{i}" for i, _ in bounds]))


def conditions(ticks: DataFrame, rules: DataFrame) -> DataFrame:
    """(rule, t, cond) for every rule and tick. Rule predicates are SQL text,
    compiled into one projection (the rule list is metadata).

    A rule that errs harms no other: one that does not parse or names an unknown column
    has a NULL condition on every tick, and arithmetic errors (division by zero,
    overflow, bad casts) give NULL on the ticks they happen; NULL neither fires nor resolves."""
    conf = ticks.sparkSession.conf
    ansi = conf.get("spark.sql.ansi.enabled")
    # an expression keeps the arithmetic of the time it was analysed
    conf.set("spark.sql.ansi.enabled", "false")
    try:
        conds = []
        for r in rules.select("name", "condition").collect():
            cond = F.expr(r.condition).cast("boolean")
            try:
                ticks.select(cond)
            except (AnalysisException, ParseException):
                cond = F.lit(None).cast("boolean")
            conds.append(F.struct(F.lit(r.name).alias("rule"), cond.alias("cond")))
        return ticks.select("t", F.inline(F.array(*conds))).select("rule", "t", "cond")
    finally:
        conf.set("spark.sql.ansi.enabled", ansi)


def condition_since(conds: DataFrame, chunk_seconds: int = 7 * 86400) -> DataFrame:
    """For each true tick, the time the condition has been true since.

    Gaps and islands in two levels: inside a chunk of (rule, time) the first true tick after the chunk's last
    false one so far; a run of true ticks that reaches back over the chunk's start takes what the chunks
    before it end in, a window over one row per chunk."""
    c = conds.filter(F.col("cond").isNotNull()).withColumn("_chunk", F.floor(tu.epoch_seconds("t") / chunk_seconds))
    inside = Window.partitionBy("rule", "_chunk").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("_island", F.sum(F.when(~F.col("cond"), 1).otherwise(0)).over(inside))
    c = c.withColumn("_own", F.min(F.when(F.col("cond"), F.col("t"))).over(Window.partitionBy("rule", "_chunk", "_island")))
    ends = c.groupBy("rule", "_chunk").agg(F.max(F.struct("_island", "_own")).alias("_end"))
    before = Window.partitionBy("rule").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # the last chunk before with a false tick, and the first true tick since: its trailing run's, or a later chunk's first
    fell = F.max(F.when(F.col("_end._island") > 0, F.col("_chunk"))).over(before)
    ends = ends.withColumn("_fell", fell)
    runs = ends.groupBy("rule", "_fell").agg(F.min(F.struct("_chunk", "_end._own")).alias("_first"))
    trail = ends.filter(F.col("_end._island") > 0).select("rule", F.col("_chunk").alias("_fell"), F.col("_end._own").alias("_trail"))
    starts = (ends.join(runs.withColumnRenamed("_fell", "_f"), ["rule"]).filter(F.col("_fell").eqNullSafe(F.col("_f")))
              .join(trail, ["rule", "_fell"], "left")
              .select("rule", "_chunk", F.coalesce("_trail", F.when(F.col("_first._chunk") < F.col("_chunk"), F.col("_first._own"))).alias("_start")))
    since = F.when(F.col("_island") == 0, F.coalesce("_start", "_own")).otherwise(F.col("_own"))
    return (c.filter("cond").join(starts, ["rule", "_chunk"]).withColumn("first_true", since)
            .select("rule", "t", "first_true"))


def remove_silenced(conds: DataFrame, silences: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """Drop evaluations inside a silence (rule equal, from <= t <= until).

    The buckets that a silence covers are a union of dyadic intervals, two a level at most, so a silence of any
    length is a few dozen rows. A tick looks up the interval that holds it on each level that some silence
    uses; the join is on (rule, level, interval), and the exact range is checked after it."""
    def bucket(c: Column) -> Column:
        return F.floor(tu.epoch_seconds(c) / bucket_seconds).cast("long")

    s = dyadic_nodes(silences.select(
        F.col("rule_name").alias("rule"), F.col("from").alias("_from"), F.col("until").alias("_until"),
        bucket(F.col("from")).alias("_lo"), bucket(F.col("until")).alias("_hi")), "_lo", "_hi")
    s = s.select("rule", "_from", "_until", "_k", "_node")
    used = [r["_k"] for r in s.select("_k").distinct().collect()]  # LEVELS at most
    if not used:
        return conds
    c = conds.select("rule", "t", F.explode(F.array(*[F.lit(k) for k in sorted(used)])).alias("_k"))
    c = c.withColumn("_node", F.floor(bucket(F.col("t")) / _level_size()))
    hit = (c.join(s, ["rule", "_k", "_node"])
           .filter((F.col("t") >= F.col("_from")) & (F.col("t") <= F.col("_until")))
           .select("rule", "t").distinct())
    return conds.join(hit, ["rule", "t"], "left_anti")


EVENTS_SCHEMA = "rule_name string, status string, fired_at timestamp_ntz, resolved_at timestamp_ntz, event_ts long"


def run_rule(ts, conds, for_duration: float, cooldown: float, state=(None, 0, False)):
    """The alert state machine for one rule over its ticks in time order.

    ``state`` = (first_true, last_fired, active); returns (events, state) with
    events as (status, fired_at, resolved_at, event_ts) in epoch seconds. A
    true tick fires when ``t - first_true >= for_duration`` and ``t -
    last_fired >= cooldown``; a false tick resets first_true and resolves an
    active alert; a missing condition (evaluation error) is skipped. Linear in
    the number of ticks; shared by the batch and the streaming evaluator.
    """
    first, last, active = state
    out = []
    for t, cond in zip(ts, conds):
        if cond is None or cond != cond:  # None or NaN: neither fires nor resolves
            continue
        t = int(t)
        if cond:
            first = t if first is None else first
            if t - first >= for_duration and t - last >= cooldown:
                out.append(("firing", t, None, t))
                last, active = t, True
        else:
            first = None
            if active:
                out.append(("resolved", last, t, t))
                active = False
    return out, (first, last, active)


def events_frame(rule: str, events: list):
    import pandas as pd
    df = pd.DataFrame(events, columns=["status", "fired_at", "resolved_at", "event_ts"])
    df.insert(0, "rule_name", rule)
    df["fired_at"] = pd.to_datetime(df["fired_at"], unit="s")
    df["resolved_at"] = pd.to_datetime(df["resolved_at"], unit="s")
    df["event_ts"] = df["event_ts"].astype("int64")
    return df


_SUMMARY = ("rule string, chunk long, all_true boolean, trail_first long, first_tick long, for_duration double, cooldown double, "
            "lead array<long>, lead_last array<long>, rest array<long>, rest_last array<long>")
_ENTRY = "rule string, chunk long, first_true long, last_fired long, active boolean"


def _summary(ts: np.ndarray, cond: np.ndarray, for_duration: float, cooldown: float, start: float) -> dict:
    """What a chunk does to the state it starts in.

    Where an alert may fire first is known but for that state: on a tick of the leading run of true ticks, or on a
    later one that has been true for ``for_duration``. From each such tick the firings follow one another, so the
    chunk is a table of (first firing, last firing). A state from before the chunk delays the first firing by
    less than ``for_duration`` or ``cooldown``; the table ends with the first entries beyond that."""
    false = np.flatnonzero(~cond)
    lead = int(false[0]) if len(false) else len(ts)
    at = np.arange(len(ts))
    last_false = np.maximum.accumulate(np.where(cond, -1, at)) if len(ts) else at
    first = ts[np.minimum(last_false + 1, len(ts) - 1)]  # of the run that a true tick stands in
    later = cond & (at >= lead) & (ts - first >= for_duration)
    may = np.concatenate([ts[:lead], ts[later]])
    to = np.maximum(np.searchsorted(may, may + cooldown, "left"), np.arange(len(may)) + 1)
    end = np.arange(len(may))  # the last firing, by doubling
    jump = np.append(to, len(may))
    while len(may) and (jump[:-1] < len(may)).any():
        end = np.where(jump[:-1] < len(may), end[np.minimum(jump[:-1], len(may) - 1)], end)
        jump = np.append(jump[jump[:-1]], len(may))
    reach = start + max(for_duration, cooldown)
    k, r = (int(np.searchsorted(x, reach, "left")) + 1 for x in (may[:lead], may[lead:]))
    trail = len(ts) and (int(ts[false[-1] + 1]) if len(false) and false[-1] + 1 < len(ts) else None)
    return {"all_true": not len(false), "trail_first": trail if len(false) else None, "first_tick": int(ts[0]),
            "for_duration": for_duration, "cooldown": cooldown,
            "lead": may[:lead][:k], "lead_last": may[end[:lead][:k]], "rest": may[lead:][:r], "rest_last": may[end[lead:][:r]]}


def _summaries(batches):
    import pandas as pd
    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            ts, cond = np.asarray(r.ts, np.int64), np.asarray(r.cond, bool)
            rows.append({"rule": r.rule, "chunk": r.chunk} | _summary(ts, cond, r.for_duration, r.cooldown, r.chunk * r.span))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SUMMARY.split(", ")])


def _entries(pdf):
    """The state each chunk of a rule starts in: the chunks' functions composed in order."""
    import pandas as pd
    state, out = (None, 0, False), []
    for r in pdf.sort_values("chunk").itertuples(index=False):
        first, last, active = state
        out.append((r.rule, r.chunk, first, last, active))
        since = r.first_tick if first is None else first
        k = int(np.searchsorted(r.lead, max(since + r.for_duration, last + r.cooldown), "left"))
        j = int(np.searchsorted(r.rest, last + r.cooldown, "left"))
        fired = True
        if k < len(r.lead):
            last = int(r.lead_last[k])
        elif j < len(r.rest):
            last = int(r.rest_last[j])
        else:
            fired = False
        if r.all_true:
            state = since, last, active or fired
        else:
            trail = None if pd.isna(r.trail_first) else int(r.trail_first)
            state = trail, last, fired and trail is not None and last >= trail
    return pd.DataFrame(out, columns=[c.split()[0] for c in _ENTRY.split(", ")]).astype({"first_true": "Int64"})


def _replay(batches):
    import pandas as pd
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            state = (None if pd.isna(r.first_true) else int(r.first_true), int(r.last_fired), bool(r.active))
            events, _ = run_rule(r.ts.tolist(), r.cond.tolist(), r.for_duration, r.cooldown, state)
            if events:
                out.append(events_frame(r.rule, events))
        if out:
            yield pd.concat(out)


def fold_events(conds: DataFrame, rules: DataFrame, chunk_seconds: int = 7 * 86400) -> DataFrame:
    """Firing and resolution events per rule.

    A rule's ticks are packed by chunk of time (of ``chunk_seconds``, or four times the rule's ``for_duration`` or
    cooldown if that is longer). Each chunk is summarised alone, the summaries, a row per chunk, are
    composed per rule, and each chunk is run from the state it starts in (``run_rule``). A task holds
    a chunk's ticks or a rule's summaries, never its history. Only ticks reach Python, never metric rows.
    """
    from featurekit.session import ship_package
    ship_package(conds.sparkSession)
    span = F.greatest(F.lit(chunk_seconds), F.ceil(4 * F.greatest("for_duration", "cooldown"))).cast("long")
    r = rules.select(F.col("name").alias("rule"), "for_duration", "cooldown", span.alias("span"))
    ticks = (conds.filter(F.col("cond").isNotNull())
             .select("rule", tu.epoch_seconds("t").alias("ts"), "cond")
             .join(F.broadcast(r), "rule")  # rules: one row per rule
             .groupBy("rule", F.floor(F.col("ts") / F.col("span")).alias("chunk"), "for_duration", "cooldown", "span")
             .agg(F.sort_array(F.collect_list(F.struct("ts", "cond"))).alias("k"))
             .select("rule", "chunk", "for_duration", "cooldown", "span", F.col("k.ts").alias("ts"), F.col("k.cond").alias("cond")))
    entries = ticks.mapInPandas(_summaries, _SUMMARY).groupBy("rule").applyInPandas(_entries, _ENTRY)
    return ticks.join(entries, ["rule", "chunk"]).mapInPandas(_replay, EVENTS_SCHEMA)


def fingerprint(name: Column, labels: Column) -> Column:
    """First 12 hex chars of md5(``name:json(labels, sorted keys)``), with
    the JSON text laid out like Python's ``json.dumps`` (", " and ": ")."""
    body = F.concat_ws(", ", F.transform(F.array_sort(F.map_entries(labels)),
                                         lambda e: F.concat(F.lit('"'), escaped(e["key"]), F.lit('": "'),
                                                            escaped(e["value"]), F.lit('"'))))
    js = F.concat(F.lit("{"), body, F.lit("}"))
    return F.substring(F.md5(F.concat(name, F.lit(":"), js)), 1, 12)


def enrich(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Alert rows: severity, message, description, labels and fingerprint from the rule."""
    r = rules.select(F.col("name").alias("rule_name"), "severity", "message", "description", "labels",
                     fingerprint(F.col("name"), F.col("labels")).alias("fingerprint"))
    return events.join(F.broadcast(r), "rule_name")


#: The order of the history: event time, then rule, firing before resolution.
HISTORY_ORDER = ("event_ts", "rule_name", "status")


def active(events: DataFrame) -> DataFrame:
    """Rules whose last event is a firing."""
    last = events.groupBy("rule_name").agg(F.max_by(F.struct("status", "fired_at"), "event_ts").alias("l"))
    return last.filter(F.col("l.status") == "firing").select("rule_name", F.col("l.fired_at").alias("fired_at"))

"""Alerts on raw metrics as they arrive, the store plug-in, and feature streams over several checkpoints."""

import datetime as dt

import pytest
from pyspark.sql import Row

from featurekit import schemas
from featurekit.operators import alerts as A
from featurekit.session import fresh_dir, ship_package
from featurekit.sinks import kv_source
from featurekit.streaming import features as sf
from featurekit.streaming.alerts import run_alert_stream

T0 = dt.datetime(2024, 1, 1)


def _metrics(spark, rows):
    return spark.createDataFrame(
        [Row(ts=T0 + dt.timedelta(minutes=m), seq=i, name=n, type=t, labels=lab, value=float(v))
         for i, (m, n, t, lab, v) in enumerate(rows)], schemas.METRICS)


def _rules(spark):
    return A.rules_df(spark, [("late", "failures > 3", "info", "", {}, 7200.0, 10800.0),
                              ("drift", "max_drift_detected > 0", "info", "", {}, 0.0, 0.0)])


ROWS = [(5, "job_failure", "counter", {}, 5), (9, "drift_detected", "gauge", {"f": "a"}, 1),
        (7, "drift_detected", "gauge", {"f": "a"}, 0),  # older than the row before it
        (12, "other", "gauge", {}, 1), (130, "drift_detected", "gauge", {"f": "a"}, 0)]


def test_alert_fires_without_a_further_row(spark):
    got = run_alert_stream(spark, _metrics(spark, ROWS), _rules(spark), fresh_dir(spark, "t"), chunks=1,
                           close_s=8 * 3600, every_tick=True).collect()
    at = {(r.rule_name, r.status, (r.fired_at - T0).total_seconds() / 3600) for r in got}
    # ticks 0 to 8 close; the condition holds from tick 0 on and may fire from tick 2 on, every three hours
    assert {h for n, s, h in at if n == "late"} == {2, 5, 8}
    assert {(s, h) for n, s, h in at if n == "drift"} == {("firing", 0), ("firing", 1), ("resolved", 1)}


def test_alert_stream_equals_the_batch_evaluation_in_any_chunks(spark):
    m, rules = _metrics(spark, ROWS + [(200 + 7 * i, "prediction_latency_seconds", "histogram", {}, i % 3) for i in range(20)]), _rules(spark)
    want = sorted(map(str, A.fold_events(A.conditions(A.tick_aggregates(m), rules), rules).select(
        "rule_name", "status", "fired_at", "resolved_at").collect()))
    assert want and sorted(map(str, run_alert_stream(spark, m, rules, fresh_dir(spark, "t"), chunks=2).collect())) == want


def test_alert_stream_of_no_rows(spark):
    assert run_alert_stream(spark, _metrics(spark, []), _rules(spark), fresh_dir(spark, "t")).count() == 0


# ------------------------------------------------------------ store plug-in
def _options(root):
    return {"client": "featurekit.sinks.kv_source:FileClient", "path": root, "key": "k", "batchsize": "3"}


def _stored(spark, root):
    back = spark.read.format("keyvalue").options(**_options(root)).schema("k string, v long, d string").load()
    return sorted((r.k, r.v, r.d) for r in back.collect())


def test_plugin_writes_are_whole_and_repeatable(spark):
    ship_package(spark)
    spark.dataSource.register(kv_source.KeyValueDataSource)
    root = fresh_dir(spark, "kv")
    assert _stored(spark, root) == []
    rows = [(f"k{i}", i, dt.date(2024, 1, 1 + i % 3)) for i in range(20)] + [(None, 1, None), ("", 2, None), ("x", None, None)]
    df = spark.createDataFrame(rows, "k string, v long, d date").repartition(4)
    want = sorted((k, v, d and d.isoformat()) for k, v, d in rows if k)
    for _ in range(2):  # the same version again replaces itself
        df.write.format("keyvalue").options(**_options(root), version="a").mode("append").save()
        assert sorted(_stored(spark, root), key=str) == sorted(want, key=str)
    df.limit(2).write.format("keyvalue").options(**_options(root), version="b").mode("append").save()
    assert len(_stored(spark, root)) == len(want) + 2
    with pytest.raises(Exception, match="upserted"):
        df.write.format("keyvalue").options(**_options(root)).mode("overwrite").save()


def test_plugin_failure_shows_nothing(spark):
    ship_package(spark)
    spark.dataSource.register(kv_source.KeyValueDataSource)
    root = fresh_dir(spark, "kv")
    bad = spark.range(100).selectExpr("cast(id as string) k", "if(id = 97, raise_error('lost'), id) v", "'d' d").repartition(1)
    with pytest.raises(Exception, match="lost"):
        bad.write.format("keyvalue").options(**_options(root)).mode("append").save()
    assert _stored(spark, root) == []


# ----------------------------------------------------------- feature stream
def test_feature_stream_with_a_new_checkpoint_wins_over_older_batches(spark):
    root = fresh_dir(spark, "features")
    events = lambda v: spark.createDataFrame(
        [Row(user_id=1, timestamp=T0, event_type="click", value=float(v))], schemas.RAW_EVENTS)
    for i in range(3):  # three batches under one checkpoint
        events(1).write.mode("append").parquet(f"{root}/in")
        sf.run_daily_features_stream(spark, f"{root}/in", schemas.RAW_EVENTS, f"{root}/out", f"{root}/c1")
    assert [r.event_count for r in sf.current_features(spark, f"{root}/out").collect()] == [3]
    events(5).write.mode("append").parquet(f"{root}/in2")
    sf.run_daily_features_stream(spark, f"{root}/in2", schemas.RAW_EVENTS, f"{root}/out", f"{root}/c2")
    assert [(r.event_count, r.total_value) for r in sf.current_features(spark, f"{root}/out").collect()] == [(1, 5.0)]
    events(1).write.mode("append").parquet(f"{root}/in2")
    sf.run_daily_features_stream(spark, f"{root}/in2", schemas.RAW_EVENTS, f"{root}/out", f"{root}/c2")
    assert [(r.event_count, r.total_value) for r in sf.current_features(spark, f"{root}/out").collect()] == [(2, 6.0)]


# ------------------------------------------------- the alert fold in chunks
def _whole_history(conds, rules):
    """The state machine over each rule's whole history."""
    out = []
    for name, fd, cd in rules:
        ticks = sorted((t, c) for n, t, c in conds if n == name and c is not None)
        events, _ = A.run_rule([t for t, _ in ticks], [c for _, c in ticks], fd, cd)
        out += [(name, s, f, r) for s, f, r, _ in events]
    return sorted(out, key=str)


def _condition_rows(spark, conds):
    return spark.createDataFrame([(n, t, c) for n, t, c in conds], "rule string, s long, cond boolean").selectExpr(
        "rule", "timestampadd(SECOND, s, timestamp_ntz'1970-01-01 00:00:00') AS t", "cond")


def _random_conditions(seed, rules, n=400):
    import random
    rng = random.Random(seed)
    out = []
    for name, *_ in rules:
        t, state = rng.randint(0, 50), True
        for _ in range(n):
            t += rng.choice([1, 1, 1, 3, 40])
            state = state if rng.random() < 0.93 else not state
            out.append((name, t, None if rng.random() < 0.05 else state))
    return out


@pytest.mark.parametrize("chunk", [1, 7, 60, 10_000])
def test_alert_fold_in_chunks_equals_the_whole_history(spark, chunk):
    rules = [(f"r{i}", float(fd), float(cd)) for i, (fd, cd) in enumerate(
        [(0, 0), (0, 1), (5, 0), (0, 30), (12, 7), (3, 200), (100, 3), (2.5, 0.5)])]
    conds = _random_conditions(chunk, rules)
    frame = A.rules_df(spark, [(n, "true", "info", "", {}, fd, cd) for n, fd, cd in rules])
    got = A.fold_events(_condition_rows(spark, conds), frame, chunk_seconds=chunk).selectExpr(
        "rule_name", "status", "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', fired_at) f",
        "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', resolved_at) r").collect()
    assert sorted(map(tuple, got), key=str) == _whole_history(conds, rules)


@pytest.mark.parametrize("chunk", [1, 9, 100_000])
def test_condition_since_in_chunks(spark, chunk):
    conds = _random_conditions(chunk, [("a",), ("b",)])
    want = []
    for name in ("a", "b"):
        first = None
        for n, t, c in sorted((x for x in conds if x[0] == name and x[2] is not None), key=lambda x: x[1]):
            first = (t if first is None else first) if c else None
            if c:
                want.append((n, t, first))
    got = A.condition_since(_condition_rows(spark, conds), chunk).selectExpr(
        "rule", "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', t) t",
        "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', first_true) f").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_silences_of_any_length(spark):
    import random
    rng = random.Random(5)
    t = lambda s: T0 + dt.timedelta(seconds=s)
    spans = [("a", t(-10**7), dt.datetime(1999, 1, 1)), ("b", t(86400 * 300), dt.datetime(9999, 12, 31)), ("c", t(50), t(40))]
    for _ in range(60):
        lo = rng.randint(0, 86400 * 40)
        spans.append((rng.choice("abc"), t(lo), t(lo + rng.choice([0, 1, 3599, 3600, 7200, 86400 * 3]))))
    ticks = [(n, t(rng.randint(0, 86400 * 400))) for n in "abcd" for _ in range(400)]
    conds = spark.createDataFrame([(n, x, True) for n, x in ticks], "rule string, t timestamp_ntz, cond boolean")
    sil = spark.createDataFrame(spans, "rule_name string, from timestamp_ntz, until timestamp_ntz")
    want = sorted((n, x) for n, x in ticks if not any(m == n and lo <= x <= hi for m, lo, hi in spans))
    for bucket in (3600, 1, 7 * 86400):
        got = A.remove_silenced(conds, sil, bucket).select("rule", "t").collect()
        assert sorted(map(tuple, got)) == want
    assert A.remove_silenced(conds, sil.limit(0)).count() == len(ticks)


def test_ticks_hold_gauges_and_sums_over_chunks(spark):
    import random
    rng = random.Random(9)
    rows = []
    for _ in range(300):
        kind, name = rng.choice([("counter", "job_failure"), ("gauge", "null_rate"), ("gauge", "online_store_keys"),
                                 ("gauge", "model_age_hours"), ("histogram", "prediction_latency_seconds")])
        rows.append((rng.randint(0, 60 * 24 * 60), name, kind, {"f": rng.choice("abcd")}, rng.choice([0, 1, 2, 0.25])))
    metrics = _metrics(spark, rows)
    want, ticks = {}, sorted({m // 60 for m, *_ in rows})
    for t in ticks:
        seen = sorted((m, i) for i, (m, *_) in enumerate(rows) if m // 60 <= t)
        held = {(rows[i][1], rows[i][3]["f"]): rows[i][4] for _, i in seen if rows[i][2] == "gauge"}
        greatest = lambda n: max((v for (k, _), v in held.items() if k == n), default=None)  # noqa: E731, B023
        want[t] = (sum(rows[i][4] for _, i in seen if rows[i][2] == "counter"), greatest("null_rate"), greatest("model_age_hours"),
                   sum(v == 0 for (k, _), v in held.items() if k == "online_store_keys"))
    for chunk in (1, 5, 4096):
        got = A.tick_aggregates(metrics, chunk_ticks=chunk).collect()
        assert {int((r.t - T0).total_seconds() // 3600): (r.failures, r.max_null_rate, r.max_model_age, r.store_zero)
                for r in got} == want


# ------------------------------------------------------------- model scoring
def test_feature_matrix_of_sliced_and_null_components():
    import numpy as np
    import pyarrow as pa

    from featurekit.operators.scoring import _feature_matrix
    a = pa.array([[1, 2], [3, None], [5, 6], [7, 8]], pa.list_(pa.float64()))
    assert _feature_matrix(a.slice(2)).tolist() == [[5, 6], [7, 8]]
    got = _feature_matrix(a)
    assert got.shape == (4, 2) and np.isnan(got[1, 1])
    assert _feature_matrix(pa.array([[1], [2]], pa.list_(pa.int32()))).tolist() == [[1.0], [2.0]]
    assert len(_feature_matrix(a.slice(0, 0))) == 0
    for bad in ([[1.0], None], [[1.0], [1.0, 2.0]]):
        with pytest.raises(ValueError, match="one length"):
            _feature_matrix(pa.array(bad, pa.list_(pa.float64())))


# -------------------------------------------------- plans at any table size
def _plan(df):
    return df._jdf.queryExecution().toString()


def test_psi_deals_no_group_to_one_task(spark):
    """The ranges are broadcast where nothing else would be; joined by shuffle, a group's rows meet in one task."""
    from featurekit.operators import drift
    rows = [(w, f, float(i)) for w in ("baseline", "current") for f in ("a", None) for i in range(20)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = drift.psi(spark.createDataFrame(rows, "window string, feature string, x double"))
        assert "SortMergeJoin" not in _plan(got) and "BroadcastHashJoin" in _plan(got)
        assert {(r.feature, r.psi, r.drift_detected) for r in got.collect()} == {("a", 0.0, False), (None, 0.0, False)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tick_totals_read_no_metric_rows(spark):
    """Metric rows are combined before the stateful step: a tick's counters and latencies are one row, a gauge its last."""
    from featurekit.functions import timeutil as tu
    from featurekit.streaming.alerts import raw_ticks
    rows = ROWS + [(20, "job_failure", "counter", {"i": str(i)}, 1) for i in range(50)]
    rows += [(30, "prediction_latency_seconds", "histogram", {}, i) for i in range(50)] + [(500, "heartbeat", "heartbeat", {}, 0)]
    got = raw_ticks(_metrics(spark, rows).withColumn("event_time", tu.as_utc_instant("ts")), 3600).collect()
    first = min(r.tick for r in got)
    by = {(r.tick - first, r.name): r for r in got}
    assert set(by) == {(0, None), (0, "drift_detected"), (2, "drift_detected")} and len(got) == 3
    assert (by[0, None].n, by[0, None].failures, by[0, None].counts[-1]) == (102, 55.0, 50)
    assert by[0, "drift_detected"].n == 2 and by[0, "drift_detected"].value == 1.0 and by[2, "drift_detected"].value == 0.0

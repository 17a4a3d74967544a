"""Golden values of the registry, metrics and alert demos, re-derived by hand."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from featurekit import schemas
from featurekit.operators import alerts as A
from featurekit.operators import metrics as M
from featurekit.operators import registry as reg


def _mv(spark):
    rows = [("user_ctr_model", "1.0.0", {"auc": 0.85, "f1": 0.78, "precision": 0.82}, "3847293847293"),
            ("user_ctr_model", "1.0.1", {"auc": 0.92, "f1": 0.85, "precision": 0.88}, "9283749283749")]
    return spark.createDataFrame(
        [Row(model_name=n, version=v, stage="none", metrics=m, snap=s) for n, v, m, s in rows],
        "model_name string, version string, stage string, metrics map<string,double>, snap string")


def test_compare_versions_golden(spark):
    out = {r.metric: (r.diff, r.pct_change)
           for r in reg.compare_versions(_mv(spark), "1.0.0", "1.0.1").collect()}
    assert out == {"auc": (0.07, 8.24), "f1": (0.07, 8.97), "precision": (0.06, 7.32)}


def test_promotion_golden(spark):
    mv = _mv(spark)
    ev = spark.createDataFrame([("user_ctr_model", "1.0.1", 1, "production")],
                               "model_name string, version string, seq int, kind string")
    st = {r.version: r.stage for r in reg.stages(mv, ev).collect()}
    assert st == {"1.0.0": "none", "1.0.1": "production"}
    ev2 = spark.createDataFrame([("user_ctr_model", "1.0.0", 1, "production"),
                                 ("user_ctr_model", "1.0.0", 2, "staging"),
                                 ("user_ctr_model", "1.0.1", 3, "staging"),
                                 ("user_ctr_model", "1.0.1", 4, "production")],
                                "model_name string, version string, seq int, kind string")
    st = {r.version: r.stage for r in reg.stages(mv, ev2).collect()}
    assert st == {"1.0.0": "none", "1.0.1": "production"}


def test_semver_next_and_numeric_order(spark):
    df = spark.createDataFrame([("m", "1.0.9"), ("m", "1.0.10"), ("m", "1.0.2")], "model_name string, version string")
    latest = reg.latest_versions(df).first()["latest_version"]
    assert latest == "1.0.10"
    nxt = spark.createDataFrame([(None, "patch"), ("1.0.9", "patch"), ("1.2.3", "minor"), ("1.2.3", "major")],
                                "latest string, bump string")
    got = [r[0] for r in nxt.select(reg.next_version(F.col("latest"), F.col("bump"))).collect()]
    assert got == ["1.0.0", "1.0.10", "1.3.0", "2.0.0"]


def _latency_metrics(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [Row(ts=t0 + dt.timedelta(seconds=i), seq=i, name="prediction_latency_seconds", type="histogram",
                labels={}, value=0.01 + (i % 10) * 0.005) for i in range(100)]
    return spark.createDataFrame(rows, schemas.METRICS)


def test_latency_histogram_golden(spark):
    h = M.histogram(_latency_metrics(spark)).first()
    assert h["cum"][:5] == [0, 10, 40, 90, 100] and h["count"] == 100
    assert abs(h["sum"] - 3.25) < 1e-9
    df = M.histogram(_latency_metrics(spark)).select(
        *[M.percentile_from_buckets(F.col("cum"), F.col("count"), p).alias(f"p{int(p * 100)}")
          for p in (0.5, 0.95, 0.99)])
    r = df.first()
    assert (round(r.p50, 6), round(r.p95, 6), round(r.p99, 6)) == (0.0375, 0.075, 0.075)


def test_job_totals_and_counter_keys(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [Row(ts=t, seq=1, name="job_success_total", type="counter", labels={"job_type": "backfill"}, value=1.0),
            Row(ts=t, seq=2, name="job_success_total", type="counter", labels={"job_type": "backfill"}, value=1.0),
            Row(ts=t, seq=3, name="job_failure_total", type="counter",
                labels={"job_type": "sync", "error_type": "timeout"}, value=1.0)]
    m = spark.createDataFrame(rows, schemas.METRICS)
    tot = {(r.name, r.labels): r.total for r in M.counter_totals(m).collect()}
    assert tot == {("job_success_total", "job_type=backfill"): 2.0,
                   ("job_failure_total", "error_type=timeout,job_type=sync"): 1.0}


def test_alert_demo_one_evaluation(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 30)
    rows = [Row(ts=t, seq=1, name="feature_null_rate", type="gauge", labels={"feature": "user_id"}, value=0.15)]
    rows += [Row(ts=t, seq=2 + i, name="job_failure_total", type="counter",
                 labels={"job_type": j, "error_type": "x"}, value=1.0)
             for i, j in enumerate(["backfill", "sync", "maintenance", "prediction"])]
    m = spark.createDataFrame(rows, schemas.METRICS)
    rules = A.rules_df(spark)
    ev = A.fold_events(A.conditions(A.tick_aggregates(m), rules), rules)
    fired = [r.rule_name for r in ev.filter(F.col("status") == "firing").collect()]
    assert fired == ["job_failure_spike"]  # the null-rate rule must hold for 60 s first


def test_alert_fold_cooldown_and_resolution(spark):
    rules = A.rules_df(spark, [("r", "x", "info", "m", {}, 0.0, 7200.0)])
    t0 = dt.datetime(2024, 1, 1)
    seq = [True, True, True, False, True]
    conds = spark.createDataFrame([("r", t0 + dt.timedelta(hours=i), c) for i, c in enumerate(seq)],
                                  "rule string, t timestamp_ntz, cond boolean")
    ev = [(r.status, r.fired_at.hour, r.resolved_at.hour if r.resolved_at else None)
          for r in A.fold_events(conds, rules).orderBy("event_ts").collect()]
    # fires at 0, cooldown blocks 1, fires at 2, resolves at 3 (fired_at 2), fires at 4
    assert ev == [("firing", 0, None), ("firing", 2, None), ("resolved", 2, 3), ("firing", 4, None)]


def test_fingerprint_matches_python_json(spark):
    import hashlib
    import json
    labels = {"team": "data-eng", "oncall": "true"}
    want = hashlib.md5(f"job_failure_spike:{json.dumps(labels, sort_keys=True)}".encode()).hexdigest()[:12]
    df = spark.createDataFrame([("job_failure_spike", labels)], "name string, labels map<string,string>")
    assert df.select(A.fingerprint(F.col("name"), F.col("labels"))).first()[0] == want


def test_silence_range_anti_join(spark):
    t0 = dt.datetime(2024, 1, 1)
    conds = spark.createDataFrame([("r", t0 + dt.timedelta(hours=i), True) for i in range(6)],
                                  "rule string, t timestamp_ntz, cond boolean")
    sil = spark.createDataFrame([("r", t0 + dt.timedelta(hours=2), t0 + dt.timedelta(hours=4))],
                                schemas.SILENCES)
    kept = sorted(r.t.hour for r in A.remove_silenced(conds, sil).collect())
    assert kept == [0, 1, 5]


def test_running_total_matches_brute_force(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [Row(ts=t0 + dt.timedelta(minutes=17 * i), seq=i, name="c", type="counter",
                labels={"k": "hot" if i % 3 else "cold"}, value=float(i % 7)) for i in range(300)]
    m = spark.createDataFrame(rows, schemas.METRICS)
    got = {r.seq: r.running_total for r in M.running_total(m).collect()}
    run = {}
    for r in rows:
        key = r.labels["k"]
        run[key] = run.get(key, 0.0) + r.value
        assert got[r.seq] == run[key]


def test_alert_null_condition_neither_fires_nor_resolves(spark):
    rules = A.rules_df(spark, [("r", "x", "info", "m", {}, 0.0, 0.0)])
    t0 = dt.datetime(2024, 1, 1)
    seq = [True, None, False, None, True]
    conds = spark.createDataFrame([("r", t0 + dt.timedelta(hours=i), c) for i, c in enumerate(seq)],
                                  "rule string, t timestamp_ntz, cond boolean")
    ev = [(r.status, r.event_ts) for r in A.fold_events(conds, rules).orderBy("event_ts").collect()]
    hours = [(s, (t - int(t0.replace(tzinfo=dt.timezone.utc).timestamp())) // 3600) for s, t in ev]
    assert hours == [("firing", 0), ("resolved", 2), ("firing", 4)]


def test_exact_percentiles_match_numpy_with_hot_group_and_ties(spark):
    import random

    import numpy as np
    rnd = random.Random(3)
    rows = [("hot", float(rnd.randint(0, 50))) for _ in range(3000)]           # many ties
    rows += [("warm", rnd.random()) for _ in range(500)]
    rows += [("tiny", 5.0), ("tiny", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = [0.0, 0.1, 0.5, 0.95, 0.99, 1.0]
    got = {(r.g, r.p): r.value for r in M.exact_percentiles(df, ["g"], "v", ps).collect()}
    for g in ("hot", "warm", "tiny"):
        vals = np.array([v for k, v in rows if k == g])
        for p in ps:
            assert abs(got[(g, p)] - np.quantile(vals, p)) < 1e-9, (g, p)


def test_exact_percentiles_over_the_whole_range_of_doubles(spark, monkeypatch):
    import numpy as np
    rnd = np.random.default_rng(5)
    wide = [float(v) for v in rnd.standard_normal(400) * 10.0 ** rnd.integers(-300, 300, 400)]
    rows = [("wide", v) for v in [*wide, 0.0, -0.0, 5e-324, -5e-324]] + [("near", 1.0 + i * 2.0 ** -52) for i in range(70)]
    rows += [(None, 2.0), (None, 4.0), ("none", None), ("one", -7.5)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    few = {(r.g, r.p): r.value for r in M.exact_percentiles(df, ["g"], "v", ps).collect()}
    monkeypatch.setattr(M, "MAX_BROADCAST_RANKS", 1)  # ranks joined, not broadcast
    assert {(r.g, r.p): r.value for r in M.exact_percentiles(df, ["g"], "v", ps).collect()} == few
    assert {k for k, _ in few} == {"wide", "near", None, "one"}
    for (g, p), v in few.items():
        vals = np.array([x for k, x in rows if k == g and x is not None])
        assert np.isclose(v, np.quantile(vals, p), rtol=1e-12, atol=0), (g, p)
    whole = {r.p: r.value for r in M.exact_percentiles(df.where("g = 'near'"), [], "v", ps).collect()}
    assert whole == {p: few["near", p] for p in ps}
    assert M.exact_percentiles(df.where("g = 'none'"), ["g"], "v", ps).count() == 0
    assert M.exact_percentiles(df.where("g = 'none'"), [], "v", ps).count() == 0


def test_running_total_splits_a_series_inside_one_instant(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [Row(ts=t0, seq=i, name="c", type="counter", labels={"k": "hot"},
                value=None if i < 3 or i % 11 == 0 else float(i % 5)) for i in range(2400)]
    rows += [Row(ts=t0, seq=i, name="c", type="counter", labels={"k": "z"}, value=1.0) for i in range(3)]
    m = spark.createDataFrame(rows, schemas.METRICS).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would become one partition
    try:
        out = M.running_total(m)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {(r.labels, r.seq): r.running_total for r in out.collect()}
    run = {}
    for r in rows:
        k = "k=" + r.labels["k"]
        if r.value is not None:
            run[k] = run.get(k, 0.0) + r.value
        assert got[k, r.seq] == run.get(k)
    assert len(out.inputFiles()) > 1  # the one hot series was scanned in several partitions
    assert M.running_total(m.where("seq < 0")).count() == 0


def test_registry_imports_json_documents(spark, tmp_table_dir):
    import json
    import os
    import tempfile
    docs = [
        {"model_name": "m", "version": "1.0.0", "stage": "archived", "model_path": "a", "model_format": "pickle",
         "metrics": {"auc": 0.8}, "metadata": {"feature_snapshot_id": "1"}, "created_at": "2024-01-01T00:00:00"},
        {"model_name": "m", "version": "1.0.1", "stage": "production", "model_path": "b", "model_format": "pickle",
         "metrics": {"auc": 0.9}, "metadata": {"feature_snapshot_id": "2"}, "created_at": "2024-01-02T00:00:00"},
    ]
    d = tempfile.mkdtemp()
    for i, doc in enumerate(docs):
        with open(os.path.join(d, f"{i}.json"), "w") as f:
            f.write(json.dumps(doc))
    r = reg.RegistryTable(spark, tmp_table_dir)
    r.import_json_documents(d)
    st = {x.version: (x.stage, x.metadata.feature_snapshot_id) for x in r.versions().collect()}
    assert st == {"1.0.0": ("archived", "1"), "1.0.1": ("production", "2")}

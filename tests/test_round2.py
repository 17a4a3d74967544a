"""Edges that the happy path does not reach."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurekit.functions import labels as L
from featurekit.operators import alerts as A
from featurekit.operators import drift, metrics, quality, serving
from featurekit.plans import batch_predict


def test_latest_per_key_takes_any_snapshot_id(spark):
    d = dt.date(2024, 1, 1)
    ids = [3847293847293, 9283749283749, -5, None, 2**62]
    df = spark.createDataFrame([(1, d, i, float(n)) for n, i in enumerate(ids)] +
                               [(2, d, 2**62, 1.0), (2, d + dt.timedelta(1), 1, 2.0), (3, None, 9, 3.0), (3, d, None, 4.0)],
                               "user_id long, date date, _snapshot_id long, x double")
    got = {r.user_id: r.x for r in serving.latest_per_key(df, "user_id", ["date", "_snapshot_id"]).collect()}
    assert got == {1: 4.0, 2: 2.0, 3: 4.0}


def test_drift_of_one_sided_and_constant_groups(spark):
    rows = ([("baseline", "both", float(i)) for i in range(20)] + [("current", "both", float(i)) for i in range(20)]
            + [("baseline", "gone", float(i)) for i in range(20)] + [("current", "new", 1.0)]
            + [("baseline", "constant", 5.0), ("baseline", "constant", 5.0), ("current", "constant", 7.0)])
    df = spark.createDataFrame(rows, "window string, feature string, x double")
    psi = {r.feature: (r.psi, r.drift_detected) for r in drift.psi(df).collect()}
    assert abs(psi["both"][0]) < 1e-9 and psi["both"][1] is False
    assert psi["gone"][0] > 0.2 and psi["gone"][1] is True
    assert psi["new"] == (None, None) and abs(psi["constant"][0]) < 1e-9
    shift = {r.feature: r["shift"] for r in drift.mean_shift(df).collect()}
    assert shift["both"] == 0.0 and shift["gone"] is shift["new"] is shift["constant"] is None


def test_small_values_and_label_escapes_in_exports(spark):
    m = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, "g", "gauge", {"p": 'a"b\\c\nd'}, 1e-7)],
                              "ts timestamp_ntz, seq long, name string, type string, labels map<string,string>, value double")
    line = next(r.line for r in metrics.prometheus_lines(m).collect() if r.line.startswith("g{"))
    assert line == 'g{p="a\\"b\\\\c\\nd"} 1.000000000e-07'
    assert spark.range(1).select(L.escaped(F.lit("x"))).first()[0] == "x"


def test_history_order_with_many_rules(spark):
    ev = spark.createDataFrame([(f"r{i:04d}", s, t) for i in range(600) for t in (10, 11) for s in ("firing", "resolved")],
                               "rule_name string, status string, event_ts long")
    got = [tuple(r) for r in ev.orderBy(*A.HISTORY_ORDER).select(*A.HISTORY_ORDER).collect()]
    assert got == sorted(got) and len(set(got)) == 2400


def test_erring_rule_harms_no_other(spark):
    ticks = spark.createDataFrame([(dt.datetime(2024, 1, 1, h), float(h), 0.0) for h in range(3)],
                                  "t timestamp_ntz, failures double, zero double")
    rules = A.rules_df(spark, [("ok", "failures > 1", "info", "", {}, 0.0, 0.0), ("div", "1 / zero > 1", "info", "", {}, 0.0, 0.0),
                               ("col", "nope > 1", "info", "", {}, 0.0, 0.0), ("syntax", "failures >", "info", "", {}, 0.0, 0.0)])
    got = {}
    for r in A.conditions(ticks, rules).collect():
        got.setdefault(r.rule, []).append(r.cond)
    assert sorted(got["ok"]) == [False, False, True] and got["div"] == got["col"] == got["syntax"] == [None] * 3
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_model_resolution(spark):
    import pytest

    from featurekit.operators import registry as reg
    mv = spark.createDataFrame([("m", "1.0.0", "production"), ("m", "1.1.0", "none"), ("n", "1.0.0", "staging")],
                               "model_name string, version string, stage string")
    assert reg.resolve(mv, "m").version == "1.0.0" and reg.resolve(mv, "m", "1.1.0").version == "1.1.0"
    for name, version in (("n", None), ("m", "9.9.9"), ("x", None)):
        with pytest.raises(reg.ModelNotFound):
            reg.resolve(mv, name, version)


def test_unknown_version_cannot_be_promoted(spark, tmp_table_dir):
    import pytest

    from featurekit.operators import registry as reg
    r = reg.RegistryTable(spark, tmp_table_dir)
    r.register(spark.createDataFrame([("m", "1.0.0")], "model_name string, version string"))
    r.promote(spark.createDataFrame([("m", "1.0.0", 1, "production")], reg.PROMOTIONS))
    with pytest.raises(reg.ModelNotFound):
        r.promote(spark.createDataFrame([("m", "2.0.0", 2, "production")], reg.PROMOTIONS))


def test_checks_need_their_parameters():
    import pytest
    assert quality.rules_from_checks({"x": ("range", {"min": 0, "max": 1})})[0].params == {"min": 0, "max": 1}
    for req in ("range", ("null_rate", {}), "nonsense"):
        with pytest.raises(ValueError):
            quality.rules_from_checks({"x": req})


def test_no_checks_pass(spark):
    assert quality.validate(spark.range(3).toDF("x"), {}) is True


def test_empty_prediction_writes_nothing_and_overwrite_keeps_other_dates(spark, tmp_table_dir):
    from featurekit.operators.scoring import LinearModel
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 1.0), (2, dt.date(2024, 1, 2), 2.0)], "user_id long, date date, x double")
    model = LinearModel([1.0], 0.0)
    cfg = batch_predict.PredictionConfig("m", "1.0.0", output_mode="overwrite", feature_columns=["x"])
    out = f"{tmp_table_dir}/pred"
    assert batch_predict.run(df, model, cfg, out, "r0", dt.date(2030, 1, 1))["status"] == "empty"
    batch_predict.run(df, model, cfg, out, "r1", dt.date(2024, 1, 1))
    batch_predict.run(df, model, cfg, out, "r2", dt.date(2024, 1, 2))
    assert {r.user_id for r in spark.read.parquet(out).collect()} == {1, 2}


def test_scoring_many_dates_in_one_write_logs_every_run(spark, tmp_table_dir):
    from featurekit.operators.scoring import LinearModel
    rows = [(i, dt.date(2024, 1, 1 + i % 3), float(i)) for i in range(30)] + [(99, None, 1.0)]
    df = spark.createDataFrame(rows, "user_id long, date date, x double")
    out, days = f"{tmp_table_dir}/pred", [dt.date(2024, 1, d) for d in range(1, 5)]
    cfg = batch_predict.PredictionConfig("m", "1.0.0", feature_columns=["x"], input_table="f", output_table="p", code_version="c1")
    got = batch_predict.run_dates(df, LinearModel([2.0], 1.0), cfg, out, {d: f"r{d.day}" for d in days})
    assert [(s["run_id"], s["status"], s["rows_processed"]) for s in got] == [
        ("r1", "success", 10), ("r2", "success", 10), ("r3", "success", 10), ("r4", "empty", 0)]
    assert got[1]["mean"] == 2 * np.mean(range(1, 30, 3)) + 1 and got[3]["mean"] is None
    # a later run of one date appends; statistics and log are those of its own rows
    cfg.partition_by, cfg.code_version = ["date"], "c2"
    assert batch_predict.run(df, LinearModel([2.0], 1.0), cfg, out, "again", days[1])["rows_processed"] == 10
    assert batch_predict.run_dates(df, LinearModel([0.0], 5.0), cfg, out, {days[1]: "third"})[0]["mean"] == 5.0
    log = {r.run_id: r for r in batch_predict.runs(spark, out).collect()}
    assert set(log) == {"r1", "r2", "r3", "r4", "again", "third"}
    assert (log["again"].code_version, log["r1"].code_version, log["r1"].input_table, log["r1"].output_table) == ("c2", "c1", "f", "p")
    assert all(r.duration_seconds > 0 for r in log.values())
    back = spark.read.parquet(out)
    assert back.count() == 50 and {r.date for r in back.where("_prediction_run_id = 'r2'").select("date").collect()} == {days[1]}
    with pytest.raises(ValueError):
        batch_predict.run_dates(df, LinearModel([0.0], 5.0), cfg, out, {days[0]: "x", days[1]: "x"})

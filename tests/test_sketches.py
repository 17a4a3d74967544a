"""Quantile sketches of published days against exact ranks."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from featurekit.operators import drift, sketches

DAY = dt.date(2024, 1, 1)


def _rows(spark, n, days=4):
    """Two features over some days; one has nulls, NaN and many ties."""
    return spark.range(n).select(
        F.date_add(F.lit(DAY), (F.col("id") % days).cast("int")).alias("date"),
        F.exp(F.randn(3)).alias("a"),
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 10 == 1, float("nan"))
        .otherwise(F.floor(F.rand(4) * 7)).alias("b"))


def test_merged_days_keep_the_stated_error(spark, tmp_table_dir):
    k = 64  # small, so that the sketches compact
    df = _rows(spark, 40_000)
    df.write.parquet(f"{tmp_table_dir}/in")
    df = spark.read.parquet(f"{tmp_table_dir}/in")
    sketches.store_sketches(df, f"{tmp_table_dir}/s", ["a", "b"], DAY, DAY + dt.timedelta(days=3), k)
    m = sketches.merged(sketches.stored_sketches(spark, f"{tmp_table_dir}/s"), ["feature"], k)
    assert {(r["feature"], r["rows"], r["nulls"]) for r in m.collect()} == {("a", 40_000, 0), ("b", 40_000, 8_000)}
    assert m.select(F.max(F.length("sketch"))).first()[0] < 40_000  # far below eight bytes a value
    x = {c: np.sort([r[0] for r in df.where(F.col(c).isNotNull() & ~F.isnan(c)).select(c).collect()]) for c in "ab"}
    slack = 1.5 * sketches.rank_error(k)
    for r in sketches.quantiles(m, ["feature"], [0.0, 0.1, 0.5, 0.9, 1.0]).collect():
        v = x[r["feature"]]
        assert np.searchsorted(v, r["quantile"], "left") / len(v) <= r["p"] + slack
        assert np.searchsorted(v, r["quantile"], "right") / len(v) >= r["p"] - slack
    q = sketches.quantiles(m, ["feature"], [0.1, 0.5, 0.9])
    assert all(r["within"] for r in sketches.rank_check(df, q, ["a", "b"], slack).collect())
    wrong = q.withColumn("quantile", F.col("quantile") * 3 + 1)
    assert not any(r["within"] for r in sketches.rank_check(df, wrong, ["a", "b"], slack).where("p = 0.5").collect())


def test_days_are_replaced_and_emptied(spark, tmp_table_dir):
    path, df = f"{tmp_table_dir}/s", _rows(spark, 400)
    end = DAY + dt.timedelta(days=3)
    sketches.store_sketches(df, path, ["a", "b"], DAY, end)
    second = DAY + dt.timedelta(days=1)
    again = df.where((F.col("date") != F.lit(second)) & (F.col("a") < 1))
    sketches.store_sketches(again, path, ["a", "b"], second, second)
    got = {(r["date"], r["feature"]): r for r in sketches.stored_sketches(spark, path).collect()}
    assert len(got) == 8 and all(got[d, "a"]["rows"] == (0 if d == second else 100) for d, f in got if f == "a")
    assert got[second, "b"]["sketch"] is None and got[second, "b"]["max"] is None
    third = DAY + dt.timedelta(days=2)
    sketches.store_sketches(again, path, ["a", "b"], third, third)
    row = sketches.stored_sketches(spark, path).where((F.col("date") == F.lit(third)) & (F.col("feature") == "a")).first()
    assert row["rows"] == again.where(F.col("date") == F.lit(third)).count() and row["max"] < 1


def test_drift_and_rule_from_points(spark):
    rows = [("baseline", float(i), 1.0 * i) for i in range(1000)] + [("current", float(i), i + 400.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "window string, same double, moved double")
    none = spark.createDataFrame([("baseline", 1.0)], "window string, only double")
    s = sketches.daily_sketches(df, ["same", "moved"], by=["window"]).unionByName(
        sketches.daily_sketches(none, ["only"], by=["window"]))
    p = sketches.points(sketches.merged(s, ["window", "feature"]), ["window", "feature"])
    d = {r["feature"]: r["distance"] for r in sketches.distances(p).collect()}
    assert d["same"] == 0 and abs(d["moved"] - 0.4) < 0.003 and d["only"] is None
    verdict = {r["column"]: (r["failures"], r["passed"]) for r in sketches.distribution_rule(p, 0.2).collect()}
    assert verdict == {"same": (0, True), "moved": (1, False), "only": (1, False)}
    exact = {r["feature"]: r["psi"] for r in drift.psi(drift.long_form(df, ["same", "moved"], "window")).collect()}
    got = {r["feature"]: r["psi"] for r in drift.psi(p).collect()}
    assert abs(got["same"] - exact["same"]) < 0.01 and abs(got["moved"] - exact["moved"]) < 0.05 * exact["moved"]


def test_nothing_to_sketch(spark, tmp_table_dir):
    empty = _rows(spark, 0)
    sketches.store_sketches(empty, f"{tmp_table_dir}/s", ["a"], DAY, DAY)
    s = sketches.stored_sketches(spark, f"{tmp_table_dir}/s")
    assert [(r["rows"], r["sketch"]) for r in s.collect()] == [(0, None)]
    m = sketches.merged(s, ["feature"])
    assert sketches.points(m, ["feature"]).count() == 0
    assert [r["quantile"] for r in sketches.quantiles(m, ["feature"], [0.5]).collect()] == [None]

"""Golden values of the backfill fixture and versioned-table invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from featurekit import schemas
from featurekit.operators.features import UserFeaturesDaily
from featurekit.plans.backfill import run_backfill
from featurekit.sources.versioned import PublishRejected, VersionedTable


# the demo events of FIXTURES.md §2 as a literal table, with a third day alike
EVENTS = [
    (1, "2023-01-01 10:00", "click", 1.0), (1, "2023-01-01 11:00", "purchase", 100.0), (2, "2023-01-01 12:00", "click", 0.0),
    (1, "2023-01-02 10:00", "click", 1.0), (1, "2023-01-02 11:00", "purchase", 100.0), (2, "2023-01-02 12:00", "click", 0.0),
    (1, "2023-01-03 10:00", "click", 1.0), (1, "2023-01-03 11:00", "purchase", 100.0), (2, "2023-01-03 12:00", "click", 0.0),
]


def fixture_events(spark, days=2):
    rows = [(u, dt.datetime.fromisoformat(t), e, v) for u, t, e, v in EVENTS[:3 * days]]
    return spark.createDataFrame(rows, schemas.RAW_EVENTS)


def test_daily_features_golden(spark):
    f = UserFeaturesDaily().compute(fixture_events(spark))
    got = sorted((r.user_id, str(r.date), r.event_count, r.total_value) for r in f.collect())
    assert got == [(1, "2023-01-01", 2, 101.0), (1, "2023-01-02", 2, 101.0),
                   (2, "2023-01-01", 1, 0.0), (2, "2023-01-02", 1, 0.0)]


def _table(spark, tmp_table_dir):
    return VersionedTable(spark, tmp_table_dir, schemas.USER_FEATURES_DAILY)


def test_wap_fast_forward_then_cherry_pick(spark, tmp_table_dir):
    t = _table(spark, tmp_table_dir)
    ev = fixture_events(spark, days=3)
    d = dt.date(2023, 1, 1)
    r1 = run_backfill(t, ev, d, d, "r1")
    assert r1["published"] == "fast_forward" and t.scan().count() == 2
    t.create_branch("audit_r3")  # diverges from main at r1's head
    r2 = run_backfill(t, ev, d + dt.timedelta(1), d + dt.timedelta(1), "r2")
    assert r2["published"] == "fast_forward"
    r3 = run_backfill(t, ev, d + dt.timedelta(2), d + dt.timedelta(2), "r3")
    assert r3["published"] == "cherry_pick"
    assert t.scan().count() == 6
    picked = [c for c in t.commit_list() if c.source_snapshot_id is not None]
    assert len(picked) == 1 and picked[0].source_snapshot_id == r3["snapshot_id"]


def test_reject_keeps_main_and_branch_readable(spark, tmp_table_dir):
    t = _table(spark, tmp_table_dir)
    ev = fixture_events(spark)
    run_backfill(t, ev, dt.date(2023, 1, 1), dt.date(2023, 1, 1), "ok")
    bad = ev.withColumn("value", F.lit(None).cast("double"))
    with pytest.raises(PublishRejected):
        run_backfill(t, bad, dt.date(2023, 1, 2), dt.date(2023, 1, 2), "bad")
    assert t.scan().count() == 2
    assert t.scan(ref="audit_bad").count() == 4


def test_append_duplicates_vs_idempotent_rerun(spark, tmp_table_dir):
    ev = fixture_events(spark)
    d0, d1 = dt.date(2023, 1, 1), dt.date(2023, 1, 2)
    t = _table(spark, tmp_table_dir + "/append")
    run_backfill(t, ev, d0, d1, "x", idempotent=False)
    run_backfill(t, ev, d0, d1, "y", idempotent=False)
    assert t.scan().count() == 8  # raw append duplicates, as in the reference's metadata
    t2 = _table(spark, tmp_table_dir + "/idem")
    run_backfill(t2, ev, d0, d1, "x")
    run_backfill(t2, ev, d0, d1, "y")
    assert t2.scan().count() == 4
    assert {r.date for r in t2.scan().collect()} == {d0, d1}


def test_incremental_union_state_equals_head(spark, tmp_table_dir):
    t = _table(spark, tmp_table_dir)
    ev = fixture_events(spark, days=3)
    ids = [run_backfill(t, ev, dt.date(2023, 1, 1) + dt.timedelta(i), dt.date(2023, 1, 1) + dt.timedelta(i),
                        f"r{i}")["snapshot_id"] for i in range(3)]
    inc, mode = t.incremental(ids[0])
    assert mode == "incremental"
    both = t.scan(snapshot_id=ids[0]).unionByName(inc)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, t.scan().collect()))
    full, mode = t.incremental(999)
    assert mode == "full" and full.count() == 6


def test_time_travel_uses_publish_time(spark, tmp_table_dir):
    t = _table(spark, tmp_table_dir)
    ev = fixture_events(spark)
    c1, p1 = dt.datetime(2023, 1, 2, 1), dt.datetime(2023, 1, 2, 2)
    c2, p2 = dt.datetime(2023, 1, 3, 1), dt.datetime(2023, 1, 3, 2)
    run_backfill(t, ev, dt.date(2023, 1, 1), dt.date(2023, 1, 1), "a", committed_at=c1, published_at=p1)
    run_backfill(t, ev, dt.date(2023, 1, 2), dt.date(2023, 1, 2), "b", committed_at=c2, published_at=p2)
    assert t.as_of_time(c2 + dt.timedelta(minutes=30)).count() == 2
    assert t.as_of_time(p2).count() == 4
    assert t.as_of_time(dt.datetime(2022, 1, 1)).count() == 0


def test_empty_table_and_missing_branch(spark, tmp_table_dir):
    t = _table(spark, tmp_table_dir)
    assert t.scan().count() == 0
    assert t.head("nope") is None
    with pytest.raises(ValueError):
        t.publish("nope")


def test_compaction_keeps_rows_and_is_invisible_to_incremental(spark, tmp_table_dir):
    from featurekit.operators import maintenance as mt
    t = _table(spark, tmp_table_dir)
    ev = fixture_events(spark, days=2)
    a = run_backfill(t, ev, dt.date(2023, 1, 1), dt.date(2023, 1, 1), "a")["snapshot_id"]
    run_backfill(t, ev, dt.date(2023, 1, 2), dt.date(2023, 1, 2), "b")
    before = sorted(map(tuple, t.scan().collect()))
    sid = mt.compact(t)
    assert sid is not None
    assert sorted(map(tuple, t.scan().collect())) == before
    inc, _ = t.incremental(a)
    assert inc.count() == 2


def test_rejected_branch_is_not_reused(spark, tmp_table_dir):
    t = _table(spark, tmp_table_dir)
    ev = fixture_events(spark)
    bad = ev.withColumn("value", F.lit(None).cast("double"))
    d = dt.date(2023, 1, 1)
    with pytest.raises(PublishRejected):
        run_backfill(t, bad, d, d, "r")
    again = run_backfill(t, ev, d + dt.timedelta(1), d + dt.timedelta(1), "r")
    assert again["status"] == "published" and again["branch"] != "audit_r"
    assert t.scan().filter("total_value IS NULL").count() == 0 and t.scan().count() == 2
    assert t.scan(ref="audit_r").count() == 2  # the rejected rows stay readable
    with pytest.raises(ValueError, match="unpublished"):
        t.write_audit_publish(t.scan(), "audit_r", lambda df: True)


def test_times_default_to_now_and_totals_follow_replaces(spark, tmp_table_dir):
    t = _table(spark, tmp_table_dir)
    ev = fixture_events(spark)
    d, e = dt.date(2023, 1, 1), dt.date(2023, 1, 2)
    run_backfill(t, ev, d, e, "r1")
    run_backfill(t, ev, e, e, "r2")
    assert t.as_of_time(dt.datetime.now() + dt.timedelta(days=1)).count() == 4
    assert t.as_of_time(dt.datetime.now() - dt.timedelta(days=1)).count() == 0
    assert t.commit_list()[-1].summary["total-records"] == "4" == str(t.scan().count())


def test_scan_of_many_idempotent_runs_stays_plannable(spark, tmp_table_dir):
    import time
    n = 365
    t = _table(spark, tmp_table_dir)
    days = spark.range(n).select(F.lit(1).cast("long").alias("user_id"), F.expr("date_add(date'2023-01-01', cast(id as int))")
                                 .alias("date"), F.lit(1).cast("long").alias("event_count"), F.lit(1.0).alias("total_value"))
    t.write_many(days, "date")
    for c in t.commit_list():  # what as many default backfills write
        c.operation = "overwrite"
        c.summary["replace-from"] = c.summary["replace-to"] = c.summary["key"]
    t0 = time.perf_counter()
    assert len(t._parts(t.head())) == n and all(live is None for _, live, _ in t._parts(t.head()))
    assert time.perf_counter() - t0 < 2
    df = t.scan()
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 200_000
    assert df.count() == n


def test_intervals_against_sets():
    import random

    from featurekit.sources.versioned import Intervals
    rng, base = random.Random(5), dt.date(2024, 1, 1)
    for _ in range(200):
        spans, covered = Intervals(), set()
        for _ in range(12):
            lo = rng.randrange(40)
            hi = lo + rng.randrange(6)
            free = [x for x in range(lo, hi + 1) if x not in covered]
            got = [x for a, b in spans.outside(base + dt.timedelta(lo), base + dt.timedelta(hi))
                   for x in range((a - base).days, (b - base).days + 1)]
            assert got == free
            spans.add(base + dt.timedelta(lo), base + dt.timedelta(hi))
            covered |= set(range(lo, hi + 1))
        flat = [x for a, b in spans.spans() for x in range((a - base).days, (b - base).days + 1)]
        assert flat == sorted(covered) and len(spans.spans()) == sum(x - 1 not in covered for x in covered)

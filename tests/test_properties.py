"""Property tests of the versioned table (few examples: each is a few Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featurekit import schemas
from featurekit.operators.features import UserFeaturesDaily
from featurekit.plans.backfill import run_backfill
from featurekit.session import fresh_dir
from featurekit.sources import tables
from featurekit.sources.versioned import VersionedTable

SF = "/root/testdata/sf0.001"
D0 = dt.date(2024, 1, 1)
runs = st.lists(st.tuples(st.integers(0, 29), st.integers(0, 6)), min_size=1, max_size=4)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(runs=runs)
def test_backfill_reruns_equal_one_pass_over_covered_dates(spark, runs):
    ev = tables.raw_events(spark, SF)
    t = VersionedTable(spark, fresh_dir(spark, "prop"), schemas.USER_FEATURES_DAILY)
    covered = set()
    for i, (start, length) in enumerate(runs):
        a = D0 + dt.timedelta(days=start)
        b = min(a + dt.timedelta(days=length), D0 + dt.timedelta(days=29))
        run_backfill(t, ev, a, b, f"r{i}")
        covered |= {a + dt.timedelta(days=k) for k in range((b - a).days + 1)}
    want = UserFeaturesDaily().compute(ev).filter(F.col("date").isin(sorted(covered)))
    assert sorted(map(tuple, t.scan().collect())) == sorted(map(tuple, want.collect()))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(cut=st.integers(1, 3))
def test_incremental_plus_old_state_equals_new_state(spark, cut):
    ev = tables.raw_events(spark, SF)
    t = VersionedTable(spark, fresh_dir(spark, "prop_inc"), schemas.USER_FEATURES_DAILY)
    ids = []
    for i in range(4):
        a = D0 + dt.timedelta(days=7 * i)
        ids.append(run_backfill(t, ev, a, a + dt.timedelta(days=6), f"w{i}")["snapshot_id"])
    start = ids[cut - 1]
    inc, mode = t.incremental(start)
    assert mode == "incremental"
    both = t.scan(snapshot_id=start).unionByName(inc)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, t.scan().collect()))

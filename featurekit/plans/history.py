"""Reproducible table histories built from the event data.

The event dates are split into three equal date ranges (``date_batches``);
each range is one backfill run. Commit and publish times are derived from the
range end so results are deterministic: commit at end+1 day 01:00, publish at
end+1 day 02:00. The oracle SQL derives the same ranges from ``events``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from featurekit import schemas
from featurekit.operators.features import date_bounds
from featurekit.plans.backfill import run_backfill
from featurekit.session import fresh_dir
from featurekit.sources import tables
from featurekit.sources.versioned import PublishRejected, VersionedTable

CODE_VERSION = "c0ffee1"
USER = "featurekit"


@dataclass
class Batch:
    index: int
    start: dt.date
    end: dt.date

    @property
    def committed_at(self) -> dt.datetime:
        return dt.datetime.combine(self.end + dt.timedelta(days=1), dt.time(1))

    @property
    def published_at(self) -> dt.datetime:
        return dt.datetime.combine(self.end + dt.timedelta(days=1), dt.time(2))


def batches(events: DataFrame, n: int = 3) -> list[Batch]:
    # min/max of the raw timestamp column: a one-column scan with partial aggregation
    lo, hi = date_bounds(events, "timestamp")
    lo, hi = lo.date(), hi.date()
    span = (hi - lo).days + 1
    out = []
    for i in range(n):
        # days d with floor(d * n / span) == i
        days = [d for d in range(span) if (d * n) // span == i]
        if days:
            out.append(Batch(i, lo + dt.timedelta(days=days[0]), lo + dt.timedelta(days=days[-1])))
    return out


class History:
    """A feature table plus the batches used to build it."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str = "user_features_daily"):
        self.spark = spark
        self.events = tables.raw_events(spark, sf_dir)
        self.events_nulls = tables.raw_events(spark, sf_dir, null_errors=True)
        self.batches = batches(self.events)
        self.table = VersionedTable(spark, fresh_dir(spark, name), schemas.USER_FEATURES_DAILY)
        self.outcomes: dict[str, dict] = {}

    def run(self, b: Batch, run_id: str, with_nulls: bool = False, publish_at: dt.datetime | None = None) -> dict:
        ev = self.events_nulls if with_nulls else self.events
        try:
            r = run_backfill(self.table, ev, b.start, b.end, run_id, CODE_VERSION, USER,
                             committed_at=b.committed_at, published_at=publish_at or b.published_at)
        except PublishRejected as e:
            r = e.args[0]
        self.outcomes[run_id] = r
        return r


def standard(spark: SparkSession, sf_dir: str) -> History:
    """Run a (batch 0) and run b (batch 1) publish by fast-forward; run c (batch 2,
    error values NULL) fails its audit, so main keeps batches 0-1 and branch
    ``audit_c`` holds all three."""
    h = History(spark, sf_dir)
    a, b, c = h.batches
    h.run(a, "a")
    h.run(b, "b")
    h.run(c, "c", with_nulls=True)
    return h


def recovered(spark: SparkSession, sf_dir: str) -> History:
    """``standard``, then run d writes batch 2 anew (snapshot 4) and passes: main holds
    every event's features, the rejected rows stay on ``audit_c``."""
    h = standard(spark, sf_dir)
    h.run(h.batches[2], "d")
    return h


def diverged(spark: SparkSession, sf_dir: str) -> History:
    """Run a publishes; branches b and c are both created at a's head; b
    publishes by fast-forward, so c can only be published by cherry-pick."""
    h = History(spark, sf_dir)
    a, b, c = h.batches
    h.run(a, "a")
    t = h.table
    t.create_branch("audit_b", "main", b.committed_at)
    t.create_branch("audit_c", "main", c.committed_at)
    h.run(b, "b")
    h.run(c, "c")
    return h


def all_published(spark: SparkSession, sf_dir: str) -> History:
    """Runs a, b and c all pass their audits and publish by fast-forward."""
    h = History(spark, sf_dir)
    for b, run_id in zip(h.batches, "abc"):
        h.run(b, run_id)
    return h

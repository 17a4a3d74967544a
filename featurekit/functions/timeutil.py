"""Time-zone independent helpers for ``timestamp_ntz`` columns.

Event times are wall-clock ``timestamp_ntz`` values. Casting them to
``timestamp`` (or using ``date_trunc``, ``unix_seconds``, Python datetime
literals) would route through the session time zone; these helpers keep all
arithmetic on the wall clock, so results do not depend on the session or
driver time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz(value: dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal (from text, no zone conversion)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def epoch_seconds(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), col)


def from_epoch_seconds(c: Column) -> Column:
    return F.timestamp_add("SECOND", c, F.expr(_EPOCH))


def trunc_seconds(c: Column | str, seconds: int) -> Column:
    """Wall-clock truncation to a multiple of ``seconds`` (3600 = hour)."""
    e = epoch_seconds(c)
    return from_epoch_seconds(F.floor(e / seconds) * seconds)


def as_utc_instant(c: Column | str) -> Column:
    """The wall clock read as UTC, as a ``timestamp`` (for watermarks/windows)."""
    return F.timestamp_seconds(epoch_seconds(c))

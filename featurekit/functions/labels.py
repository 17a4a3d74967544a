"""Metric label helpers (labels are ``map<string,string>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def labels_key(labels: Column | str = "labels") -> Column:
    """Canonical label string ``k1=v1,k2=v2`` in sorted key order.

    Maps can be grouped on but not used in ``distinct``/set operations; this
    key works everywhere and is insensitive to entry order."""
    m = F.col(labels) if isinstance(labels, str) else labels
    return F.concat_ws(",", F.transform(F.array_sort(F.map_entries(m)),
                                        lambda e: F.concat(e["key"], F.lit("="), e["value"])))


def prometheus_labels(labels: Column | str = "labels") -> Column:
    """``k1="v1",k2="v2"`` in sorted key order (empty string for no labels)."""
    m = F.col(labels) if isinstance(labels, str) else labels
    return F.concat_ws(",", F.transform(F.array_sort(F.map_entries(m)),
                                        lambda e: F.concat(e["key"], F.lit('="'), escaped(e["value"]), F.lit('"'))))


def escaped(value: Column) -> Column:
    """Backslash, double quote and line feed written as ``\\\\``, ``\\"`` and ``\\n``."""
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit('"'), F.lit('\\"'))
    return F.replace(out, F.lit("\n"), F.lit("\\n"))

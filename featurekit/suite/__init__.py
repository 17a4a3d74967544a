"""Registered queries (one per operator of the survey inventory) and oracles.

Each area module exposes ``QUERIES`` (name → callable(spark, sf_dir) → DataFrame)
and ``ORACLES`` (name → DuckDB SQL over the input tables).
"""

from __future__ import annotations

import importlib

AREAS = ["features", "versioned", "serving", "scoring", "registry", "metrics", "alerts", "maintenance",
         "distributions"]


def all_queries() -> dict:
    out = {}
    for a in AREAS:
        out.update(importlib.import_module(f"featurekit.suite.{a}").QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    for a in AREAS:
        out.update(importlib.import_module(f"featurekit.suite.{a}").ORACLES)
    return out

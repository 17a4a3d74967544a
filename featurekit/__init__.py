"""featurekit: feature backfill, write-audit-publish and ML governance on Spark.

Everything is DataFrame / SQL / Structured Streaming work over plain Parquet.
Sub-packages:

* ``sources``   – table scans: raw events, the versioned (snapshot) table, file listings
* ``sinks``     – online store, JSON / text exports
* ``operators`` – features, joins, quality, drift, serving, scoring, registry,
  metrics, alerts, maintenance
* ``functions`` – column-level helpers (semver, hashes, label keys, formatting)
* ``plans``     – end-to-end jobs (backfill with WAP, online sync, batch predict,
  maintenance)
* ``streaming`` – Structured Streaming versions of sync, features and alerts
"""

__version__ = "0.1.0"

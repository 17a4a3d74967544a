"""Table maintenance as jobs over commit metadata and file listings.

* ``expire_plan``   – which snapshots may be expired and whose data files are
  no longer reachable from any live ref (report only; deleting is left to
  the operator);
* ``orphan_files``  – data files on storage that no commit references (e.g. a
  crashed write), older than a cutoff;
* ``compaction_plan`` / ``compact`` – bin the visible small files by size and
  rewrite them as one ``replace`` snapshot (rows unchanged; incremental reads
  skip replace commits).

File listings use the ``binaryFile`` source without selecting ``content``, so
only paths, sizes and times are read.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit.functions import timeutil as tu
from featurekit.sources.versioned import SNAPSHOT_COL, VersionedTable


def list_files(spark, path: str, glob: str = "*.parquet") -> DataFrame:
    """(path, length, modificationTime) of every file below ``path``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(path)
            .select("path", "length", "modificationTime"))


def _snapshot_of_path(path_col) -> F.Column:
    return F.regexp_extract(path_col, rf"{SNAPSHOT_COL}=(\d+)", 1).try_cast("long")


def live_data_ids(table: VersionedTable) -> set[int]:
    table._load()
    heads = {table.head(r.name) for r in table._refs} - {None}
    return {d for h in heads for d, *_ in table._parts(h)}


def expire_plan(table: VersionedTable, older_than: dt.datetime, retain_last: int = 1) -> DataFrame:
    """M1: snapshots committed before ``older_than`` that are not the head of a
    live ref and not among the newest ``retain_last`` of main's chain;
    ``data_deletable`` when their data is not visible from any live ref."""
    table._load()
    heads = {table.head(r.name) for r in table._refs} - {None}
    keep = set(table.ancestors(table.head("main"))[:retain_last])
    live = live_data_ids(table)
    schema = T.StructType([T.StructField("snapshot_id", T.LongType()),
                           T.StructField("data_deletable", T.BooleanType())])
    flags = table.spark.createDataFrame(
        [Row(snapshot_id=c.snapshot_id, data_deletable=c.snapshot_id not in live) for c in table.commit_list()],
        schema)
    return (table.commits()
            .filter((F.col("committed_at") < tu.ntz(older_than)) & ~F.col("snapshot_id").isin(list(heads | keep)))
            .join(F.broadcast(flags), "snapshot_id")  # one row per commit: metadata-sized
            .select("snapshot_id", "committed_at", "operation", "data_deletable"))


def orphan_files(table: VersionedTable, older_than: dt.datetime | None = None) -> DataFrame:
    """M2: data files whose snapshot directory no commit references."""
    table._load()
    committed = [c.snapshot_id for c in table.commit_list()]
    files = list_files(table.spark, table.data_path).withColumn("snapshot_dir", _snapshot_of_path(F.col("path")))
    out = files.filter(~F.col("snapshot_dir").isin(committed))
    if older_than is not None:
        out = out.filter(F.col("modificationTime") < F.lit(older_than))
    return out


def visible_files(table: VersionedTable, ref: str = "main") -> DataFrame:
    ids = sorted({d for d, *_ in table._parts(table.head(ref))})
    paths = [f"{table.data_path}/{SNAPSHOT_COL}={i}" for i in ids]
    if not paths:
        return table.spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return (table.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths)
            .select("path", "length", "modificationTime"))


def compaction_plan(table: VersionedTable, target_bytes: int = 128 << 20, ref: str = "main") -> DataFrame:
    """M3 plan: per snapshot directory, files in path order, bin = running
    byte sum // target. The window runs over file metadata rows of one
    directory, never over data rows."""
    from pyspark.sql import Window
    w = Window.partitionBy("snapshot_dir").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    f = visible_files(table, ref).withColumn("snapshot_dir", _snapshot_of_path(F.col("path")))
    return (f.withColumn("_before", F.coalesce(F.sum("length").over(w), F.lit(0)))
            .withColumn("bin", F.floor(F.col("_before") / F.lit(target_bytes)).cast("int"))
            .drop("_before"))


def compact(table: VersionedTable, target_bytes: int = 128 << 20, ref: str = "main",
            committed_at: dt.datetime | None = None) -> int | None:
    """M3: rewrite the rows visible on ``ref`` into ~target-sized files as one
    ``replace`` snapshot. Returns the new snapshot id (None if nothing to do)."""
    sizes = visible_files(table, ref).agg(F.sum("length").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not sizes["n"]:
        return None
    n_out = max(1, math.ceil((sizes["b"] or 0) / target_bytes))
    if n_out >= sizes["n"]:
        return None  # already compact
    rows = table.scan(ref=ref).repartition(n_out)
    return table.write(rows, ref, "replace", committed_at, {"compacted-files": str(sizes["n"])})


def run_maintenance(table: VersionedTable, older_than: dt.datetime, compact_files: bool = True,
                    target_bytes: int = 128 << 20, now: dt.datetime | None = None) -> DataFrame:
    """M4: expire → orphans → compact; a failing step is recorded and the next runs."""
    status = []
    for step, fn in [("expire_snapshots", lambda: expire_plan(table, older_than).count()),
                     ("remove_orphan_files", lambda: orphan_files(table, older_than).count()),
                     ("rewrite_data_files", (lambda: compact(table, target_bytes, committed_at=now))
                      if compact_files else None)]:
        if fn is None:
            status.append((step, "skipped", None))
            continue
        try:
            status.append((step, "ok", str(fn())))
        except Exception as e:  # noqa: BLE001 - each step is independent
            status.append((step, "failed", type(e).__name__))
    return table.spark.createDataFrame(status, "step string, status string, detail string")

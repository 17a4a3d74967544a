"""A versioned feature table on plain Parquet: snapshots, branches, WAP, time travel.

Layout under ``path``:

* ``data/_snapshot_id=<id>/`` – the rows added by one commit (Parquet, zstd)
* ``commits/`` – one JSON row per snapshot (``schemas.COMMITS``)
* ``refs/``    – one JSON row per ref move (``schemas.REFS``); a ref's head is its
  row with the greatest ``seq``

Write order is data → commit row → ref row, so a reader only sees a commit
once its ref row exists; a crashed write leaves orphan files (see
``operators.maintenance``), never dirty data. One writer per table.

Commit and ref rows are metadata (one row per commit); they are read once into
the driver like any table format's metadata, and only snapshot ids are used
to build scans. Scans pass the exact snapshot directories as paths (no listing
of the whole table) and keep ``_snapshot_id IN (...)`` as a partition filter.
"""

from __future__ import annotations

import bisect
import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurekit import schemas
from featurekit.sources import metalog

SNAPSHOT_COL = "_snapshot_id"
_DAY = dt.timedelta(days=1)


def _now() -> dt.datetime:
    return dt.datetime.now().replace(microsecond=0)


@dataclass
class Commit:
    snapshot_id: int
    parent_id: int | None
    source_snapshot_id: int | None
    branch: str
    operation: str  # append | overwrite | replace
    committed_at: dt.datetime
    summary: dict = field(default_factory=dict)

    @property
    def data_id(self) -> int:
        return self.source_snapshot_id if self.source_snapshot_id is not None else self.snapshot_id

    @property
    def added(self) -> int:
        return int(self.summary.get("added-records", "0"))


    @property
    def replaced(self) -> tuple[dt.date, dt.date] | None:
        """The dates an overwrite replaces."""
        if "replace-from" not in self.summary:
            return None
        return tuple(dt.date.fromisoformat(self.summary[k][:10]) for k in ("replace-from", "replace-to"))


class Intervals:
    """Disjoint date intervals (both ends included), merged where they touch."""

    def __init__(self):
        self._spans: list[tuple[dt.date, dt.date]] = []

    def spans(self) -> list[tuple[dt.date, dt.date]]:
        return list(self._spans)

    def outside(self, lo: dt.date, hi: dt.date) -> list[tuple[dt.date, dt.date]]:
        """The parts of [lo, hi] that no interval covers."""
        out = []
        for a, b in self._spans[max(0, bisect.bisect_left(self._spans, (lo, lo)) - 1):]:
            if a > hi:
                break
            if b < lo:
                continue
            if a > lo:
                out.append((lo, a - _DAY))
            lo = b + _DAY if b < dt.date.max else None
            if lo is None or lo > hi:
                return out
        return [*out, (lo, hi)]

    def add(self, lo: dt.date, hi: dt.date) -> None:
        first = last = bisect.bisect_left(self._spans, (lo, lo))
        if first and self._spans[first - 1][1] >= lo - _DAY:
            first -= 1
        while last < len(self._spans) and self._spans[last][0] <= hi + _DAY:
            last += 1
        if first < last:
            lo, hi = min(lo, self._spans[first][0]), max(hi, self._spans[last - 1][1])
        self._spans[first:last] = [(lo, hi)]


class PublishRejected(Exception):
    """Raised when the audit of a branch fails: main stays unchanged."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, date_col: str | None = "date"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.date_col = date_col
        self._commits: list[Commit] | None = None
        self._by_id: dict[int, Commit] = {}
        self._refs: list[Row] | None = None

    # ------------------------------------------------------------------ paths
    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    @property
    def commits_path(self) -> str:
        return f"{self.path}/commits"

    @property
    def refs_path(self) -> str:
        return f"{self.path}/refs"

    def _exists(self, p: str) -> bool:
        return metalog.exists(self.spark, p)

    # --------------------------------------------------------------- metadata
    def commits(self) -> DataFrame:
        """S8 input: the commit log as a DataFrame."""
        return metalog.read(self.spark, self.commits_path, schemas.COMMITS)

    def refs(self) -> DataFrame:
        return metalog.read(self.spark, self.refs_path, schemas.REFS)

    def heads(self) -> DataFrame:
        """Head snapshot of every ref (latest ``seq`` per name)."""
        return (self.refs().groupBy("name")
                .agg(F.max_by("snapshot_id", "seq").alias("snapshot_id"),
                     F.max("seq").alias("seq")))

    def _load(self) -> None:
        if self._commits is None:
            rows = self.commits().collect() if self._exists(self.commits_path) else []
            self._commits = [Commit(r.snapshot_id, r.parent_id, r.source_snapshot_id, r.branch, r.operation,
                                    r.committed_at, dict(r.summary or {})) for r in rows]
            self._commits.sort(key=lambda c: c.snapshot_id)
            self._by_id = {c.snapshot_id: c for c in self._commits}
        if self._refs is None:
            rows = self.refs().collect() if self._exists(self.refs_path) else []
            self._refs = sorted(rows, key=lambda r: r.seq)

    def commit_list(self) -> list[Commit]:
        self._load()
        return list(self._commits)

    def _commit(self, sid: int) -> Commit:
        self._load()
        if sid not in self._by_id:
            raise KeyError(f"snapshot {sid} not found")
        return self._by_id[sid]

    def head(self, ref: str = "main") -> int | None:
        self._load()
        rows = [r for r in self._refs if r.name == ref]
        return rows[-1].snapshot_id if rows else None

    def has_ref(self, ref: str) -> bool:
        self._load()
        return any(r.name == ref for r in self._refs)

    def ancestors(self, sid: int | None) -> list[int]:
        """Snapshot ids from ``sid`` back to the root, newest first."""
        out = []
        while sid is not None:
            out.append(sid)
            sid = self._commit(sid).parent_id
        return out

    def is_published(self, branch: str, to: str = "main") -> bool:
        """Whether every commit of ``branch`` is on ``to``, directly or picked."""
        on = {i for s in self.ancestors(self.head(to)) for i in (s, self._commit(s).data_id)}
        return all(s in on for s in self.ancestors(self.head(branch)))

    # ----------------------------------------------------------------- writes
    def _append_meta(self, path: str, rows: list, schema: T.StructType) -> None:
        metalog.append(self.spark, path, rows, schema)

    def _add_ref(self, name: str, sid: int | None, kind: str, at: dt.datetime | None) -> None:
        self._load()
        seq = (self._refs[-1].seq + 1) if self._refs else 1
        prev = self.head(name)
        row = Row(seq=seq, name=name, snapshot_id=sid, prev_snapshot_id=prev, kind=kind, published_at=at or _now())
        self._append_meta(self.refs_path, [row], schemas.REFS)
        self._refs.append(row)

    def _add_commit(self, c: Commit) -> None:
        row = Row(snapshot_id=c.snapshot_id, parent_id=c.parent_id, source_snapshot_id=c.source_snapshot_id,
                  branch=c.branch, operation=c.operation, committed_at=c.committed_at, summary=c.summary)
        self._append_meta(self.commits_path, [row], schemas.COMMITS)
        self._commits.append(c)
        self._by_id[c.snapshot_id] = c

    def _next_id(self) -> int:
        self._load()
        return (max(c.snapshot_id for c in self._commits) + 1) if self._commits else 1

    def create_branch(self, name: str, from_ref: str = "main", at: dt.datetime | None = None,
                      at_snapshot: int | None = None) -> bool:
        """K2: branch at the head of ``from_ref`` (or at ``at_snapshot``); a
        no-op when it exists."""
        if self.has_ref(name):
            return False
        self._add_ref(name, at_snapshot if at_snapshot is not None else self.head(from_ref), "create", at)
        return True

    def write(self, df: DataFrame, branch: str = "main", operation: str = "append",
              committed_at: dt.datetime | None = None, properties: dict | None = None,
              replace_range: tuple | None = None, observed: dict | None = None) -> int:
        """K3/K4/K6: write ``df`` as a new snapshot on ``branch``.

        ``operation='overwrite'`` with ``replace_range=(first_date, last_date)``
        makes the snapshot replace those dates of its ancestors (idempotent
        backfill) and must hold rows of those dates only; ``append`` adds rows.
        The row count is observed during the write (no second pass); replaced rows
        are only counted when a live snapshot overlaps the range. ``committed_at``
        defaults to the current time.
        """
        self._load()
        sid = self._next_id()
        parent = self.head(branch)
        committed_at = committed_at or _now()
        replaced = self._rows_between(parent, *replace_range) if operation == "overwrite" and replace_range else 0
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        obs = Observation(f"write_{sid}")
        out = df.select(*cols).observe(obs, F.count(F.lit(1)).alias("rows"))
        (out.withColumn(SNAPSHOT_COL, F.lit(sid).cast("long"))
         .write.mode("append").partitionBy(SNAPSHOT_COL).parquet(self.data_path))
        added = int(obs.get["rows"])
        total = added + (int(self._commit(parent).summary.get("total-records", "0"))
                         if parent and operation != "replace" else 0) - replaced
        summary = {"operation": operation, "added-records": str(added), "total-records": str(total)}
        if replace_range is not None:
            summary["replace-from"], summary["replace-to"] = str(replace_range[0]), str(replace_range[1])
        summary.update({k: str(v) for k, v in (properties or {}).items()})
        summary.update({k: str(o.get[m]) for k, (o, m) in (observed or {}).items()})
        self._add_commit(Commit(sid, parent, None, branch, operation, committed_at, summary))
        self._add_ref(branch, sid, "commit", committed_at)
        return sid

    def write_many(self, df: DataFrame, key_col: str, branch: str = "main",
                   committed_at: dict | None = None, properties: dict | None = None) -> list[int]:
        """Bulk load: one snapshot per distinct ``key_col`` value, written in one job.

        Snapshot ids follow the key order. Used to load a long history (for
        example one commit per day) without one Spark job per commit.
        """
        self._load()
        # one small aggregate lists the keys and their row counts (one row per
        # future snapshot), then one job writes every snapshot directory
        key_counts = {r[0]: r[1] for r in df.groupBy(key_col).count().collect()}
        keys = sorted(key_counts)
        first = self._next_id()
        ids = {k: first + i for i, k in enumerate(keys)}
        mapping = F.create_map(*[x for k, v in ids.items() for x in (F.lit(k), F.lit(v).cast("long"))])
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        tagged = df.select(*cols, mapping[F.col(key_col)].alias(SNAPSHOT_COL))
        tagged.write.mode("append").partitionBy(SNAPSHOT_COL).parquet(self.data_path)
        counts = {ids[k]: n for k, n in key_counts.items()}
        parent = self.head(branch)
        total = int(self._commit(parent).summary.get("total-records", "0")) if parent else 0
        out = []
        for k in keys:
            sid = ids[k]
            added = counts.get(sid, 0)
            total += added
            at = (committed_at or {}).get(k) or _now()
            summary = {"operation": "append", "added-records": str(added), "total-records": str(total),
                       "key": str(k)}
            summary.update({kk: str(v) for kk, v in (properties or {}).items()})
            c = Commit(sid, parent, None, branch, "append", at, summary)
            parent = sid
            out.append(c)
        rows = [Row(snapshot_id=c.snapshot_id, parent_id=c.parent_id, source_snapshot_id=None, branch=branch,
                    operation="append", committed_at=c.committed_at, summary=c.summary) for c in out]
        self._append_meta(self.commits_path, rows, schemas.COMMITS)
        self._commits.extend(out)
        self._by_id.update((c.snapshot_id, c) for c in out)
        self._add_ref(branch, out[-1].snapshot_id if out else self.head(branch), "commit",
                      out[-1].committed_at if out else None)
        return [c.snapshot_id for c in out]

    # ---------------------------------------------------------------- publish
    def publish(self, branch: str, to: str = "main", published_at: dt.datetime | None = None) -> str:
        """K7/K8: fast-forward ``to`` when its head is an ancestor of the branch
        head, else cherry-pick the branch-only commits onto it (source ids kept)."""
        src = self.head(branch)
        published_at = published_at or _now()
        if src is None:
            raise ValueError(f"branch {branch} has no snapshot")
        dst = self.head(to)
        chain = self.ancestors(src)
        if dst is None or dst in chain:
            self._add_ref(to, src, "fast_forward", published_at)
            return "fast_forward"
        base = set(self.ancestors(dst))
        picks = [s for s in reversed(chain) if s not in base]
        parent = dst
        for s in picks:
            c = self._commit(s)
            sid = self._next_id()
            total = c.added + int(self._commit(parent).summary.get("total-records", "0"))
            summary = dict(c.summary, **{"source-snapshot-id": str(c.data_id), "total-records": str(total)})
            self._add_commit(Commit(sid, parent, c.data_id, to, c.operation, published_at, summary))
            parent = sid
        self._add_ref(to, parent, "cherry_pick", published_at)
        return "cherry_pick"

    def write_audit_publish(self, df: DataFrame, branch: str, audit, committed_at=None, published_at=None,
                            properties: dict | None = None, operation: str = "append",
                            replace_range: tuple | None = None) -> dict:
        """K2+K3+audit+K7/K8/K9 in one call. ``audit(DataFrame) -> bool`` runs on
        the branch scan; on failure the branch stays readable and main unchanged.
        A branch with commits that are not on main (a rejected run) is not reused."""
        if self.has_ref(branch) and not self.is_published(branch):
            raise ValueError(f"branch {branch} holds unpublished commits; use another branch")
        self.create_branch(branch, "main", committed_at)
        sid = self.write(df, branch, operation, committed_at, properties, replace_range)
        ok = audit(self.scan(ref=branch))
        if not ok:
            raise PublishRejected(f"audit failed for {branch} (snapshot {sid}); main unchanged")
        how = self.publish(branch, "main", published_at)
        return {"snapshot_id": sid, "published": how}

    # ------------------------------------------------------------------ scans
    def _parts(self, sid: int | None, stop_at: int | None = None, appends_only: bool = False):
        """[(data_id, live, masked)] visible at ``sid``, newest first.

        One sweep from the head carries the replaced dates as disjoint intervals. The
        rows of a replacing snapshot lie in its own range: ``live`` is what of that
        range no newer one replaced (None: all of it, no filter), and a snapshot
        without live dates is left out. An append has no range of its own: ``masked``
        holds the intervals replaced after it."""
        parts, covered = [], Intervals()
        while sid is not None and sid != stop_at:
            c = self._commit(sid)
            if c.operation in ("append", "overwrite"):
                own = c.replaced if c.operation == "overwrite" else None
                if own is None:
                    if c.added > 0:
                        parts.append((c.data_id, None, covered.spans()))
                else:
                    live = covered.outside(*own)
                    if c.added > 0 and live:
                        parts.append((c.data_id, None if live == [own] else live, []))
                    covered.add(*own)
            elif c.operation == "replace":
                if not appends_only:
                    if c.added > 0:
                        parts.append((c.data_id, None, covered.spans()))
                    break
            sid = c.parent_id
        return parts

    def replaced_since(self, start_exclusive: int, end: int) -> list[tuple[dt.date, dt.date]]:
        """Date ranges that commits after ``start_exclusive`` up to ``end`` replaced and that
        were live at the start."""
        ranges = Intervals()
        for sid in self.ancestors(end):
            if sid == start_exclusive:
                break
            c = self._commit(sid)
            if c.operation == "overwrite" and c.replaced:
                ranges.add(*c.replaced)
        before = []
        for data_id, live, _ in self._parts(start_exclusive):
            own = self._commit(data_id).replaced
            before += live or [own or (dt.date.min, dt.date.max)]
        return [(a, b) for a, b in ranges.spans() if any(lo <= b and a <= hi for lo, hi in before)]

    def _rows_between(self, sid: int | None, first, last) -> int:
        """Rows visible at ``sid`` with a date in the range; no job when no live
        snapshot can hold any."""
        lo, hi = (dt.date.fromisoformat(str(d)[:10]) for d in (first, last))
        parts = []
        for p in self._parts(sid):
            own = self._commit(p[0]).replaced
            spans = p[1] or ([own] if own else [(dt.date.min, dt.date.max)])
            if any(a <= hi and lo <= b for a, b in spans):
                parts.append(p)
        if not parts:
            return 0
        return self._read_parts(parts).filter(F.col(self.date_col).between(F.lit(lo), F.lit(hi))).count()

    def _read_parts(self, parts) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        full = schemas.with_field(self.schema, SNAPSHOT_COL, T.LongType())
        ids = sorted({p[0] for p in parts})
        paths = [f"{self.data_path}/{SNAPSHOT_COL}={i}" for i in ids]
        df = (self.spark.read.schema(full).option("basePath", self.data_path).parquet(*paths)
              .filter(F.col(SNAPSHOT_COL).isin(ids)))

        def between(spans) -> Column:
            cond = F.lit(False)
            for lo, hi in spans:
                cond = cond | F.col(self.date_col).between(F.lit(lo), F.lit(hi))
            return cond

        cut = [p for p in parts if p[1] is not None or p[2]]
        if cut:
            cond: Column = ~F.col(SNAPSHOT_COL).isin([p[0] for p in cut])
            for i, live, masked in cut:
                # a row without a date is in no replaced range
                keep = between(live) if live is not None else ~F.coalesce(between(masked), F.lit(False))
                cond = cond | ((F.col(SNAPSHOT_COL) == i) & keep)
            df = df.filter(cond)
        return df

    def scan(self, ref: str | None = "main", snapshot_id: int | None = None,
             with_snapshot_id: bool = False) -> DataFrame:
        """Rows visible at a ref head or a snapshot id."""
        sid = snapshot_id if snapshot_id is not None else self.head(ref)
        df = self._read_parts(self._parts(sid))
        return df if with_snapshot_id else df.drop(SNAPSHOT_COL)

    def as_of_time(self, ts: dt.datetime, ref: str = "main", with_snapshot_id: bool = False) -> DataFrame:
        """The ref as it was published at ``ts`` (publish time, not commit time)."""
        sid = self.head_at(ts, ref)
        df = self._read_parts(self._parts(sid) if sid is not None else [])
        return df if with_snapshot_id else df.drop(SNAPSHOT_COL)

    def head_at(self, ts: dt.datetime, ref: str = "main") -> int | None:
        self._load()
        rows = [r for r in self._refs if r.name == ref and r.published_at is not None and r.published_at <= ts]
        return rows[-1].snapshot_id if rows else None

    def incremental(self, start_exclusive: int | None, end: int | None = None, ref: str = "main",
                    with_snapshot_id: bool = False) -> tuple[DataFrame, str]:
        """Rows appended after ``start_exclusive`` up to ``end`` (default:
        the ref head). Replace (compaction) commits are skipped. When the start
        is unknown or not an ancestor of the end, falls back to a full scan."""
        end = end if end is not None else self.head(ref)
        if start_exclusive is None or start_exclusive not in self.ancestors(end):
            return self.scan(snapshot_id=end, with_snapshot_id=with_snapshot_id), "full"
        df = self._read_parts(self._parts(end, stop_at=start_exclusive, appends_only=True))
        return (df if with_snapshot_id else df.drop(SNAPSHOT_COL)), "incremental"

    def provenance(self, ref: str = "main") -> DataFrame:
        """Per visible data snapshot of ``ref``: run id and how it reached the
        ref (direct commit, fast-forward or cherry-pick). Built from metadata,
        one row per commit, so it is safe to broadcast."""
        rows = []
        on = set(self.ancestors(self.head(ref)))
        picked = {c.source_snapshot_id for c in self._commits if c.snapshot_id in on}
        for data_id, *_ in self._parts(self.head(ref)):
            c = self._commit(data_id)
            how = "cherry_pick" if data_id in picked else ("direct" if c.branch == ref else "fast_forward")
            rows.append((data_id, c.summary.get("run-id"), how))
        schema = "_snapshot_id bigint, run_id string, published string"
        return F.broadcast(self.spark.createDataFrame(rows, schema))

    def history(self) -> DataFrame:
        """Commits newest first with lineage properties from the summary."""
        return (self.commits()
                .select("committed_at", "snapshot_id", "parent_id", "operation",
                        F.col("summary")["code-version"].alias("git_hash"),
                        F.col("summary")["run-id"].alias("run_id"),
                        F.col("summary")["added-records"].cast("long").alias("added_records"),
                        F.col("summary")["total-records"].cast("long").alias("total_records"))
                .orderBy(F.col("committed_at").desc(), F.col("snapshot_id").desc()))

"""The online sync as a Structured Streaming query over the refs log.

The stream source is the refs log of the versioned table filtered to ``main``
(streaming the data folder would pick up unpublished and compacted files).
Each micro-batch holds the ref moves since the last batch; ``foreachBatch``
reads exactly ``(first prev head, last head]`` and upserts it. The stream
checkpoint is the sync watermark; with ``availableNow`` a run processes what
is new and stops, and a run with nothing new does nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit import schemas
from featurekit.plans.online_sync import apply_changes
from featurekit.sinks.online_store import ParquetOnlineStore
from featurekit.sources.versioned import VersionedTable


def query_id(spark, checkpoint: str) -> str:
    """The id Spark keeps in a checkpoint: a new checkpoint, even at the same place, is another query."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


def sync_batch_fn(table: VersionedTable, store: ParquetOnlineStore, checkpoint: str):
    """Applies each (query id, epoch) once, whatever is replayed."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        moves = batch.orderBy("seq").select("seq", "snapshot_id", "prev_snapshot_id").collect()  # ref rows only
        if not moves:
            return
        start, end = moves[0].prev_snapshot_id, moves[-1].snapshot_id
        table._commits = table._refs = None  # re-read metadata written since the last batch
        apply_changes(table, store, start, end, token=f"{query_id(table.spark, checkpoint)}:{epoch_id}")
    return fn


def start_sync_stream(table: VersionedTable, store: ParquetOnlineStore, checkpoint: str):
    refs = (table.spark.readStream.schema(schemas.REFS).json(table.refs_path)
            .filter((F.col("name") == "main") & (F.col("kind") != "create")))
    return (refs.writeStream.foreachBatch(sync_batch_fn(table, store, checkpoint))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_sync_stream(table: VersionedTable, store: ParquetOnlineStore, checkpoint: str, timeout_s: float | None = None) -> None:
    q = start_sync_stream(table, store, checkpoint)
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.isActive:
        q.stop()
        raise TimeoutError("sync stream did not finish")
    if q.exception():
        raise RuntimeError(str(q.exception()))

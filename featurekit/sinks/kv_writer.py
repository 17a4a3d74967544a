"""Push latest-per-key records to an external key-value store from the executors.

``client_factory`` is called once per partition on the executor and must
return an object with ``batch_write(records: list[dict])`` (the store plug-in
interface). Records are sent in bounded batches; nothing passes through the
driver. Use on ``latest_per_key`` output so each key is written once per run;
retried tasks re-send the same latest values, so the upsert is idempotent.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, Protocol

from pyspark.sql import DataFrame


class KeyValueClient(Protocol):
    def batch_write(self, records: list[dict]) -> None: ...


def _plain(v):
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


def write_partitions(df: DataFrame, client_factory: Callable[[], KeyValueClient], key: str = "user_id",
                     batch_size: int = 10_000) -> None:
    from featurekit.session import ship_package
    ship_package(df.sparkSession)

    def run(rows) -> None:
        client = client_factory()
        batch: list[dict] = []
        for r in rows:
            rec = {k: _plain(v) for k, v in r.asDict().items()}
            if rec.get(key) in (None, ""):
                continue
            batch.append(rec)
            if len(batch) >= batch_size:
                client.batch_write(batch)
                batch = []
        if batch:
            client.batch_write(batch)

    df.foreachPartition(run)

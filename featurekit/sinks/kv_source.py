"""Any key-value store as a Spark data source, batch and streaming.

``spark.dataSource.register(KeyValueDataSource)``, then::

    df.write.format("keyvalue").option("client", "my.module:Client").option("key", "user_id").mode("append").save()
    df.writeStream.format("keyvalue").option("client", ...).option("checkpointLocation", ...).start()
    spark.read.format("keyvalue").option("client", ...).schema(...).load()

``client`` names the plug-in, a class that is made with the data source's options where it is used:

* ``batch_write(records)`` on the executors takes one bounded batch of records (dicts) and returns what names
  it, a piece of text, or nothing;
* ``commit(version, pieces)`` on the driver is called once for all tasks that succeeded, with the pieces of all of them and
  a version that is the same when the write is repeated (a stream's query id and epoch); ``abort(pieces)`` after a failure;
* ``partitions()`` and ``read(partition)``, where the store can be read back, give lists of pieces and record batches.

A store whose ``batch_write`` is an idempotent upsert needs no ``commit``: a retried task sends the same records
again. One that stages batches makes them visible in ``commit`` alone, so lost executors and repeated epochs add
nothing twice. Records with a null or empty key are left out. Nothing passes through the driver but the pieces' names.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    InputPartition,
    WriterCommitMessage,
)


def _client(options):
    module, _, name = options["client"].partition(":")
    return getattr(importlib.import_module(module), name)(dict(options))


def _plain(v):
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: its batches' names and the number of records."""
    records: int = 0
    pieces: list[str] = field(default_factory=list)


@dataclass
class Piece(InputPartition):
    value: object = None


class _Writes:
    """The executors' side of both writers."""

    def __init__(self, options):
        self.options = dict(options)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        client, key, size = _client(self.options), self.options["key"], int(self.options.get("batchsize", 10_000))
        done = Written()
        for whole in iterator:
            for at in range(0, whole.num_rows, size):
                records = [{k: _plain(v) for k, v in r.items()} for r in whole.slice(at, size).to_pylist()
                           if r.get(key) not in (None, "")]
                if records:
                    piece = client.batch_write(records)
                    done.records += len(records)
                    done.pieces += [] if piece is None else [piece]
        return done

    def _commit(self, version: str, messages) -> None:
        client = _client(self.options)
        if hasattr(client, "commit"):
            client.commit(version, sorted(p for m in messages if m is not None for p in m.pieces))

    def _abort(self, messages) -> None:
        client = _client(self.options)
        if hasattr(client, "abort"):
            client.abort(sorted(p for m in messages if m is not None for p in m.pieces))


class KeyValueWriter(_Writes, DataSourceArrowWriter):
    def __init__(self, options):
        _Writes.__init__(self, options)
        self.version = self.options.get("version") or uuid.uuid4().hex

    def commit(self, messages) -> None:
        self._commit(self.version, messages)

    def abort(self, messages) -> None:
        self._abort(messages)


class KeyValueStreamWriter(_Writes, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self._commit(f"{self.options.get('version', 'stream')}-{batchId:012d}", messages)

    def abort(self, messages, batchId: int) -> None:
        self._abort(messages)


class KeyValueReader(DataSourceReader):
    def __init__(self, schema, options):
        self.names, self.options = schema.fieldNames(), dict(options)

    def partitions(self) -> list[Piece]:
        return [Piece(p) for p in _client(self.options).partitions()] or [Piece(None)]

    def read(self, partition: Piece):
        if partition.value is None:
            return
        for batch in _client(self.options).read(partition.value):
            for r in batch:
                yield tuple(r.get(c) for c in self.names)


class KeyValueDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyvalue"

    def schema(self):
        raise ValueError("give the records' schema: spark.read.format('keyvalue').schema(...)")

    def writer(self, schema, overwrite: bool):
        if overwrite:
            raise ValueError("a key-value store is upserted: use mode('append')")
        return KeyValueWriter(self.options)

    def streamWriter(self, schema, overwrite: bool):
        return KeyValueStreamWriter(self.options)

    def reader(self, schema) -> DataSourceReader:
        return KeyValueReader(schema, self.options)


class FileClient:
    """A plug-in on a shared folder (option ``path``; any file system that Arrow opens by its URI): batches are staged
    as JSON lines, and a commit lists those that count in one file named by its version, so a
    repeated version replaces itself. Reading gives the batches of all versions; the newest record of a key is the reader's to pick."""

    def __init__(self, options: dict):
        from pyarrow import fs
        uri = options["path"]
        self.fs, self.root = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
            fs.LocalFileSystem(), uri)

    def _put(self, name: str, text: str) -> None:
        self.fs.create_dir(f"{self.root}/{name.rpartition('/')[0]}")
        part = f"{self.root}/{name}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(part) as out:
            out.write(text.encode())
        self.fs.move(part, f"{self.root}/{name}")

    def batch_write(self, records: list[dict]) -> str:
        name = f"staged/{uuid.uuid4().hex}.jsonl"
        self._put(name, "".join(json.dumps(r) + "\n" for r in records))
        return name

    def commit(self, version: str, pieces: list[str]) -> None:
        self._put(f"versions/{version}.json", json.dumps(pieces))

    def abort(self, pieces: list[str]) -> None:
        for p in pieces:
            self.fs.delete_file(f"{self.root}/{p}")

    def partitions(self) -> list[str]:
        from pyarrow import fs
        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/versions", allow_not_found=True))
        versions = sorted(f.path for f in found if f.path.endswith(".json"))
        return [p for v in versions for p in json.loads(self.fs.open_input_stream(v).read())]

    def read(self, piece: str):
        yield [json.loads(line) for line in self.fs.open_input_stream(f"{self.root}/{piece}").read().splitlines()]

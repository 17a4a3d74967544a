"""Append-only metadata logs (commit log, refs, sync state, audit outcomes).

Each append is one small JSON-lines file written through the Hadoop
FileSystem API under a hidden name and renamed into place, so it works on any
shared file system and readers never see a partial file. Reading is a plain
``spark.read.json`` with an explicit schema.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _enc(v):
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def append(spark: SparkSession, path: str, rows: list, schema: T.StructType) -> None:
    text = "".join(json.dumps({f.name: _enc(r[f.name]) for f in schema.fields}) + "\n" for r in rows)
    name = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}.json"
    tmp, fs = _fs(spark, f"{path}/.{name}.tmp")
    dst, _ = _fs(spark, f"{path}/{name}")
    out = fs.create(tmp, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.rename(tmp, dst):
        raise IOError(f"could not publish metadata file {name} in {path}")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)

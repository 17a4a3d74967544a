"""The queries against their SQL, their contracts and the pipeline's stages."""

import zlib

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from featurekit.llm import queries
from tests.conftest import SMOKE

TABLES = ("documents", "benchmark", "labels", "conversations", "embeddings")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SMOKE)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, want), key=str)


def test_all_queries_are_registered():
    names = [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert {f"op{i}" for i in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names


def test_sharding_query(spark):
    rows = queries.QUERIES["op8_sharding"](spark, SMOKE).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(r["text_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode()) for r in rows)
    assert all(r["size"] == len((texts[r["doc_id"]] or "").encode()) + 1 for r in rows)


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stage(spark, kept, SMOKE).cache()
        ids, had = ({r[0] for r in x.select("doc_id").collect()} for x in (kept, before))
        assert ids <= had
        if name != "sharding":
            assert kept.columns == columns
        else:
            assert kept.count() == before.count()
        if name in ("toxicity", "near_duplicates", "decontamination"):
            assert len(had) * 0.7 < len(ids)

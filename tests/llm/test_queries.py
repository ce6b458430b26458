"""Registered corpus queries against their SQL, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from fieldatlas.llm import queries
from tools_compare import compare

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, db, small, name):
    df = queries.QUERIES[name](spark, small)
    cursor = db.execute(queries.SQL[name])
    compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cursor.description], cursor.fetchall())


def test_native_queries_run_no_python(spark, small):
    for name in ("op4_quality_rules", "op7_mixing", "op13_exact_dedup"):
        plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages(spark, small, scratch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    counts = [docs.count()]
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = scratch.save(stage(spark, docs, small))
        if place < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        docs = out
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2] and counts[5] == counts[4] > 0
    assert all(len(r.ids) == r.n_tokens for r in docs.collect())

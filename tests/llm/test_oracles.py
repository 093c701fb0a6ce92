"""Operators with a SQL form against DuckDB on the smallest test data; the registry's shape."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from logroll.llm import queries
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_registry():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "personal_data",
                                                      "source_mixture", "packing"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(queries.SQL[name])
    columns = [d[0] for d in res.description]
    assert digest(df.columns, rows) == digest(columns, res.fetchall())


def test_pipeline_stages(spark):
    """Every stage keeps the columns of documents; clean documents reach the mixture; ids are packed once."""
    from logroll.llm.common import freeze, table
    docs = table(spark, SF, "documents")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = freeze(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and 0 < out.count() <= 3 * docs.count()
        if name == "quality_classifier":
            kept = {r["doc_id"] for r in out.select("doc_id").collect()}
            good = [d for d, q in labels.items() if q == 1]
            assert sum(d in kept for d in good) >= 0.97 * len(good)
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.select("doc_id").collect()}

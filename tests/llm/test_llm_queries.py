"""The training-data queries against SQL, and the pipeline against its stages' rules."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quadrat.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(zip(*(table.column(n).to_pylist() for n in names)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, db, name):
    assert rows(QUERIES[name](spark, FOLDER).toArrow()) == rows(db.sql(ORACLE_SQL[name]).to_arrow_table())


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_pipeline(spark):
    from quadrat.llm import decontaminate, neardup
    from quadrat.session import cut_lineage

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES[:4]:
        seen.append(cut_lineage(stage(spark, seen[-1], FOLDER)))
        assert seen[-1].columns == docs.columns, name
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    groups = neardup.near_duplicates(seen[1]).collect()
    assert ids[2] == {r.doc_id for r in groups if r.kept}
    dirty = decontaminate.report(seen[2], benchmark).where("contaminated").collect()
    assert ids[3] == ids[2] - {r.doc_id for r in dirty}
    last = corpus_pipeline.STAGES[4][1](spark, seen[4], FOLDER).collect()
    assert len(last) == seen[4].count()
    assert sum(r.n_tokens for r in last) == max(r.start + r.n_tokens for r in last)

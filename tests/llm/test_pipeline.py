"""The registered queries and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from barkeep.llm.batches import words_of
from barkeep.llm.oracle import ORACLE
from barkeep.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in ("embeddings", "conversations", "documents"):
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = database.sql(ORACLE[name])
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    left = sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)
    right = sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=repr)
    assert left == right


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
        docs.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and left <= ids and left
        ids = left
    rows = docs.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    windows = {tuple(words_of(i.text.encode())[k : k + 10]) for i in items for k in range(max(1, len(words_of(i.text.encode())) - 9))}
    for r in rows:
        words = words_of(r.text.encode())
        assert not any(tuple(words[i : i + 10]) in windows for i in range(len(words)))
    final = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.decoded for r in final} == {r.doc_id: r.text for r in rows}

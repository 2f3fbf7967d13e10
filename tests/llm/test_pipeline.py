"""The pipeline on odd rows and on the test tables: each stage against what it must keep."""

from __future__ import annotations

import pytest

import corpus_pipeline
from ledgerspark.llm import queries as llm
from tests.llm.conftest import odd_rows


@pytest.fixture(scope="module")
def folder(spark, odd, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    odd.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, "no such item in any of the odd documents at all"), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_of_odd_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    language, groups, benchmark, mix = ids
    assert {1, 2, 7, 10, 12} <= language and not {4, 5, 6, 14} & language
    assert -3 in groups and not {1, 2, 3, 8, 11} & groups
    assert benchmark == groups and mix <= benchmark
    digest = corpus_pipeline.token_ids(spark, docs, folder)
    assert digest.count() == docs.count()


def test_pipeline_of_an_empty_table(spark, folder, empty, tmp_path):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() == 0


def test_pipeline_of_the_test_tables(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert found and {"doc_id", "start", "n_tokens", "ids_crc32"} <= set(found[0].asDict())
    at = 0
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens


def test_registered_queries():
    names = llm.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(llm.oracle_sql()) <= set(names)
    assert len(odd_rows()) > 20 and len(corpus_pipeline.STAGES) == 5

"""The queries that SQL can express against that SQL, on whole tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from ledgerspark.llm import queries as llm

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    cursor = connection.execute(llm.oracle_sql()[name])
    columns = sorted(d[0] for d in cursor.description)
    wanted = Counter(tuple(v for _, v in sorted(zip([d[0] for d in cursor.description], row))) for row in cursor.fetchall())
    df = llm.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == columns
    assert Counter(map(tuple, df.select(*columns).collect())) == wanted

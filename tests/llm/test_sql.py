"""The queries that have SQL against it, on the given tables."""

import duckdb
import pytest
from check import compare

from tradeloom.llm.queries import ORACLE

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    verdict, _ = compare(spark, connection, SF, name)
    assert verdict.startswith("ok ")

import duckdb
import pytest

import __spark_entry__ as entry_points
from paylens.llm import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    rows = entry_points.queries()[name](spark, SF)
    columns = sorted(rows.columns)
    expected = duck.sql(entry_points.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in rows.collect()))) == sorted(
        map(str, duck.sql(f"select {', '.join(columns)} from ({entry_points.oracle_sql()[name]})").fetchall()))


def test_every_operator_is_registered():
    names = list(entry_points.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in catalog.ORACLES])
def test_query_gives_a_row_for_each_document(spark, name):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    found = entry_points.queries()[name](spark, SF).select("doc_id")
    assert found.distinct().count() == documents.distinct().count()
    if not name.startswith("op3_"):
        assert found.count() == documents.count()

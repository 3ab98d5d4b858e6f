import duckdb
import pytest
from pathlib import Path

import __spark_entry__ as entry_points
from check_oracles import normal, rows_of

from conftest import SMALL

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    columns, rows = rows_of(QUERIES[name](spark, SMALL))
    assert rows
    if name not in ORACLES:
        return
    result = database.execute(ORACLES[name])
    order = sorted(range(len(result.description)), key=lambda i: result.description[i][0])
    assert columns == [result.description[i][0] for i in order]
    want = [tuple(normal(row[i]) for i in order) for row in result.fetchall()]
    assert rows == sorted(want, key=repr)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    results = entry_points.entry(spark)
    assert {"doc_id", "outcome", "models", "final"} <= set(results.columns)
    assert results.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()

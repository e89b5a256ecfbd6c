import duckdb
import pytest

import __spark_entry__ as contract
from check import rows_of
from skytally.catalog.queries import QUERIES
from tests.conftest import TABLES

WITHOUT_SQL = {"kmeans_clusters", "kmeans_members", "random_forest_files", "random_forest_predict"}


def test_contract(spark):
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(QUERIES) - set(sql) == WITHOUT_SQL and set(sql) <= set(queries)
    assert contract.entry(spark).count() > 0


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
                 "labels conversations").split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql())))
def test_query_equals_its_sql(spark, database, name):
    df = contract.queries()[name](spark, TABLES)
    result = database.execute(contract.oracle_sql()[name])
    expected = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(df.columns, df.collect()) == expected

import duckdb
import pytest

from checks.compare import TABLES, bag
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    result = QUERIES[name](spark, FOLDER)
    got = result.collect()
    if name not in ORACLES:
        assert got
        return
    cursor = database.execute(ORACLES[name])
    wanted, columns = cursor.fetchall(), [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert bag(result.columns, got) == bag(columns, wanted)

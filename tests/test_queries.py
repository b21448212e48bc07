"""Every registered query against its SQL on the smallest given tables."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_file  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="given tables not mounted")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(table):
    columns = sorted(table.column_names)

    def text(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "~"
        return repr(value) if isinstance(value, float) else str(value)

    return columns, sorted(tuple(text(row[c]) for c in columns) for row in table.to_pylist())


def kinds(table):
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


@pytest.mark.parametrize("name", sorted(entry_file.queries()))
def test_query(spark, database, name):
    found = entry_file.queries()[name](spark, FOLDER).toArrow()
    sql = entry_file.oracle_sql().get(name)
    if sql is None:
        assert found.num_rows > 0
        return
    expected = database.sql(sql).to_arrow_table()
    assert plain(found) == plain(expected)
    assert kinds(found) == kinds(expected)


def test_entry(spark):
    assert entry_file.entry(spark).count() == 3

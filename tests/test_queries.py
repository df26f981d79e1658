"""Every registered query against its SQL on DuckDB, and the entry point."""

import __spark_entry__ as entry
import pytest
from check_oracles import compare, tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return tables(FOLDER)


@pytest.mark.parametrize("name", list(entry._QUERIES))
def test_query_equals_sql(spark, con, name):
    same, _ = compare(spark, con, name, FOLDER)
    assert same


def test_every_query_has_sql():
    assert entry._QUERIES.keys() == entry._ORACLES.keys()
    assert entry._QUERIES.keys() <= entry.queries().keys()


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["sensor_id", "ms", "value"]
    assert df.count() == 134

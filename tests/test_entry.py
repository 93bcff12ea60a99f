import duckdb
import pytest

import __spark_entry__ as entry_points
import verify

SF_DIR = "/root/testdata/sf0.001"
FITS = {"cv_macro_f1"}  # fifteen fits; tests/test_classifier.py covers them on a small table


def test_entry(spark):
    assert entry_points.entry(spark).count() == 16


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in verify.TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - FITS))
def test_query(spark, duck, name):
    got = verify.collected(entry_points.queries()[name](spark, SF_DIR))
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
    else:
        assert verify.compare(got, verify.plain(duck, sql)) == ""

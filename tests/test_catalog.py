"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import TABLES, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return connection


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and df.schema == entry(spark).schema


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    ours = queries()[name](spark, SF_DIR).toPandas()
    if name in oracle_sql():
        assert difference(ours, db.execute(oracle_sql()[name]).df()) is None
    else:
        assert len(ours) > 0

"""Every registered query runs, and equals its SQL where there is one."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from topicgrove.plans.oracle import ORACLE_SQL
from topicgrove.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _value(value):
    if value is None or value is pd.NA or (isinstance(value, (float, np.floating)) and np.isnan(value)):
        return None
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    return float(value) if isinstance(value, (int, float, np.number)) else str(value)


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(_value, r)) for r in frame.itertuples(index=False, name=None)), key=str)


def test_every_sql_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    expected = duck.execute(ORACLE_SQL[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert _rows(found) == _rows(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0

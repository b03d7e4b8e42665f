"""Every registered query of this part runs, and equals its SQL where there is one."""

import duckdb
import pytest

from topicgrove.llm.registry import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(repr(v.item() if hasattr(v, "item") else v) for v in r) for r in frame.astype(object).itertuples(index=False, name=None)), key=str)


def test_every_sql_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    expected = duck.execute(ORACLE_SQL[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found.where(found.notna(), None)) == rows(expected.where(expected.notna(), None))

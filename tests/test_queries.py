"""Every registered query against its SQL counterpart."""

import duckdb
import pytest
from conftest import SMALL

from mediabatch.plans.oracle import ORACLE
from mediabatch.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def normal(rows):
    rounded = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows]
    return sorted(rounded, key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    frame = QUERIES[name](spark, SMALL)
    found = sql.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(frame.columns)
    assert normal(tuple(r) for r in frame.select(*columns).collect()) == normal(found.fetchall())


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0

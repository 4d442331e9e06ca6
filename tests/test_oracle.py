"""Every registered query against its SQL text on the smallest driver tables."""

import math

import duckdb
import pytest

from driver_queries.all_queries import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _text(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, sql, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(row) for row in df.collect()]
    assert name in ORACLE, "every query has its SQL text"
    cursor = sql.execute(ORACLE[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, rows) == _rows(columns, cursor.fetchall())


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

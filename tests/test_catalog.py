"""Every registered query with SQL gives the rows of its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, base, name):
    df = driver.queries()[name](spark, SF)
    relation = base.sql(driver.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    expected = canonical(relation.fetchall(), relation.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == expected


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_flagship(spark):
    df = driver.entry(spark)
    assert df.columns == ["n_rows", "accuracy", "weighted_f1", "error_rate"]
    row = df.first()
    assert row.n_rows == 44 and row.accuracy > 0.9

"""Every query with SQL gives the rows DuckDB gives."""

import math

import duckdb
import pytest

from quirespark.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, sf_dir, duck, name):
    df = catalog.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    rel = duck.sql(catalog.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    want = sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0

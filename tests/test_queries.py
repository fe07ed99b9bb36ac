"""Every query against its SQL on the smallest data, and the contract of the entry module."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings recovery_extract level_samples measurements sessions relevante_ereignisse alt_export inventar manifest bewertungstexte vertrauen".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 5) + 0.0
    if isinstance(v, bool):
        return int(v)
    return v.isoformat() if hasattr(v, "isoformat") else v


def test_contract(spark):
    assert set(SQL) <= set(QUERIES)
    df = entry.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    r = con.execute(SQL[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(row[i]) for i in at) for row in r.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns and df.count() >= 0

"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import registry
from tools.check_oracles import TABLES, rows_of

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.queries())
SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "smallint": "SMALLINT", "float": "FLOAT", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(registry.oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(entry.oracle_sql()[name])
    names = rel.columns
    assert sorted(names) == sorted(df.columns)
    spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert got == rows_of(names, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "ROWKEY" and df.count() > 0

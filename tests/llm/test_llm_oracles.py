"""The operators that SQL can express against DuckDB on the smallest tables, types included."""

import duckdb
import pytest

from tessera.llm import registry
from tools.check_oracles import rows_of

SF = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER"}


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.queries()[name](spark, SF)
    rel = con.sql(registry.oracles()[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())

"""Text queries with SQL give the rows that DuckDB gives for it."""

import duckdb
import pytest

from splice_spark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    found = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted((tuple(r[names.index(c)] for c in columns) for r in found.fetchall()), key=str)

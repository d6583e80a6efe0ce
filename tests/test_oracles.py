"""Every query with SQL gives the rows that DuckDB gives for it, on the smallest tables."""

import math

import duckdb
import pytest

from splice_spark.jobs import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str)
    found = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=str)


def test_every_sql_has_a_query():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)


def test_sizes_grow_with_the_tables(duck):
    """Genes, sites, cells, junctions and reads grow with the scale; no query keeps to a part of a table."""
    large = duckdb.connect()
    for t in TABLES:
        large.execute(f"create view {t} as select * from '{SF.replace('0.001', '0.01')}/{t}.parquet'")
    for name in ("gene_intervals", "gene_strands", "genes_at_locus", "spliced_junctions", "pair_reads", "chimeric_junctions", "dedup_umis", "umi_counts", "junction_table", "weird_genes", "gene_repair", "gene_sign", "dense_ranks", "max_genomic_score"):
        few, many = (con.execute(f"select count(*) from ({catalog.ORACLE_SQL[name]})").fetchone()[0] for con in (duck, large))
        assert many > 5 * few, name
    for table, name in (("part", "gene_repair"), ("events", "cigar_features")):
        rows = large.execute(f"select count(*) from ({catalog.ORACLE_SQL[name]})").fetchone()[0]
        assert rows == large.execute(f"select count(*) from {table}").fetchone()[0]

"""Rows dealt in buckets of genes, with every size set low, so that small tables go the way of large ones."""

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from splice_spark.functions import joins, lineage, stats
from splice_spark.jobs import analysis_queries, catalog, score_queries
from splice_spark.jobs.pipeline import Params, score_job
from splice_spark.operators import differential, score, svd
from splice_spark.sources import fixtures, tables
from test_oracles import SF, TABLES, plain


@pytest.fixture
def large(monkeypatch):
    """Genes with a tenth of the rows are hot, and no table is small enough for a broadcast."""
    monkeypatch.setattr(joins, "LEAST_DEALT", 0)
    monkeypatch.setattr(joins, "BUCKET_ROWS", 700)
    monkeypatch.setattr(joins._hot_and_rows, "__defaults__", (10,))
    monkeypatch.setattr(joins.lookup, "__defaults__", ("inner", 0))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["domain_split_z", "split_z_pinned", "svd_scores", "permutation_pvals"])
def test_dealt_rows_give_what_sql_gives(spark, duck, large, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str)
    found = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=str)


def test_dealt_rows_are_shuffled_once(spark, large):
    """Windows by gene and cell and joins by gene leave them in their buckets."""
    rows = joins.deal(score_queries.named(spark, SF))
    out = joins.lookup(score.min_reads(rows, 0), joins.cut(score.junction_table(rows)), score.JUNCTION)
    plan = score.add_z(out.withColumns({f"nSijk{s}": score.F.lit(1.0) for s in score.SIDES}).withColumn("sign", score.F.lit(1)))
    exchanges = [x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 1 and "refName_newR1" not in exchanges[0]  # the table's
    assert rows.count() == plan.count()
    shares = dict(rows.groupBy("gene").agg(score.F.count_distinct(joins.dealt_by(rows)[0])).collect())
    assert 0 < sum(n > 1 for n in shares.values()) < len(shares)  # hot genes only


def test_narrow_input_is_that_of_the_sql(spark):
    """Null parts, lines and quantities included."""
    folder = score_queries.io_folder(spark)
    for t in ("customer", "orders", "nation", "region"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    odd = {c: score.F.when(score.F.col("l_orderkey") % k != 0, score.F.col(c)) for c, k in (("l_partkey", 7), ("l_suppkey", 5), ("l_linenumber", 11), ("l_quantity", 3), ("l_returnflag", 13))}
    lines.withColumns(odd).unionByName(lines.withColumn("l_quantity", -score.F.col("l_quantity"))).write.parquet(f"{folder}/lineitem.parquet")
    want = fixtures._run(spark, folder, fixtures.JUNCTIONS)
    got = fixtures.junctions(spark, folder).select(*want.columns)
    assert got.dtypes == want.dtypes
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < got.count()


def test_rows_of_the_job_are_written_once(spark, large):
    """With all that takes a window; and they are those of the steps one by one."""
    source = lineage.cut(fixtures.junctions(spark, SF))
    before = len(lineage._written)
    _, rows, _ = score_job(source, Params(sicilian=True, pin_s=0.1, level_1="tissue", level_2="compartment"))
    assert sum("z_Start" in spark.read.parquet(p).columns for p in lineage._written[before:]) == 1
    steps = score.add_split_z(score.score_rows(tables.normalise_input(source, True, "tissue"), True, 5, 0.1))
    steps = score.contributions(joins.lookup(steps, score.gene_cov(steps), ["gene"]), "tissue", "compartment").drop(*joins.dealt_by(steps))
    assert dict(steps.dtypes) == dict(rows.dtypes)
    rounded = [(score.F.round(c, 6) + 0.0).alias(c) if kind == "double" else c for c, kind in steps.dtypes]
    got, want = rows.select(rounded), steps.select(rounded)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < got.count()


def test_scores_join_components_in_their_buckets(spark, monkeypatch):
    """Also where every table beside the rows is small enough for a broadcast."""
    monkeypatch.setattr(joins, "LEAST_DEALT", 0)
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
    rows = score_queries.merged(spark, SF)
    values = joins.cut_dealt(svd.site_values(rows))
    load = joins.cut(svd.gene_components(values))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the two sides of the join are small here
    try:
        plan = svd.add_svd(score.cell_gene_scores(rows, ["tissue"]), values, load)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = plan[plan.index("SortMergeJoin") :]
    assert "cell" in joined.splitlines()[0]
    assert not [x for x in joined.splitlines() if "Exchange hashpartitioning" in x and "cell" in x]


def test_scored_rows_have_what_scores_and_components_need(spark, large):
    """Nothing else is dealt or written, and cells are chosen where they are."""
    before = len(lineage._written)
    scores, _ = analysis_queries.scored(spark, SF)
    stored = [spark.read.parquet(p).columns for p in lineage._written[before:]]
    dealt = [c for c in stored if any(x in joins._dealings for x in c)]
    assert dealt and not [c for c in dealt if {"splice_ann", "chrR1A", "called", "S_Start", "z_Start", "flat_Start"} & set(c)]
    plan = differential.eligible(scores, "tissue", "compartment")._jdf.queryExecution().executedPlan().toString()
    joined = plan[plan.index("ShuffledHashJoin") :]
    assert not [x for x in joined.splitlines() if "Exchange hashpartitioning" in x and "cell" in x]


def test_junction_rows_are_written_from_where_they_are(spark, monkeypatch):
    """In files of so many rows, without a copy before or a shuffle."""
    monkeypatch.setattr(tables, "FILE_ROWS", 100)
    rows = lineage.cut(spark.range(1000, numPartitions=4).selectExpr("id", "concat('c', id) as cell"))
    folder, before = score_queries.io_folder(spark), len(lineage._written)
    tables.write_scores(spark.range(3).selectExpr("id as z"), rows, folder)
    assert not [p for p in lineage._written[before:] if "cell" in spark.read.parquet(p).columns]
    back = spark.read.parquet(f"{folder}/junctions.parquet")
    files = [n for _, n in back.groupBy(score.F.input_file_name()).count().collect()]
    assert sum(files) == 1000 and max(files) <= 100 and back.exceptAll(rows).count() == 0


def test_small_tests_are_a_row_each(spark):
    """Counted where they are permuted, with the numbers of the statistic itself."""
    rng = np.random.default_rng(5)
    sizes = {"a": (4, 1, 7), "b": (6, 5)}
    cells = [(f"c{i:02}", "x", g, f"l{k}", "scZ", float(rng.normal())) for g in sizes for i, k in enumerate(np.repeat(np.arange(len(sizes[g])), sizes[g]).tolist())]
    melted = spark.createDataFrame(cells, "cell string, level_1 string, gene string, level_2 string, z_col string, z double").repartition(3)
    found = spark.createDataFrame([("x", g, "scZ", 1.5, 0.01) for g in sizes], "level_1 string, gene string, z_col string, Tn1 double, pval double")
    out = differential.permute(melted, found, 40)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroups" not in plan and "row_number" not in plan
    seeds = dict(found.select("gene", differential.seed_column(123)).collect())
    for r in out.collect():
        want = stats.permuted_statistics(np.array([c[-1] for c in cells if c[2] == r.gene]), np.array(sizes[r.gene]), 0.1, seeds[r.gene], np.arange(40))
        assert r.perm_pval == np.count_nonzero(want < 1.5 * (1 - differential.TIE)) / 40


def test_stored_rows_repeat_their_junctions(spark, large):
    """The derived input is in the order of junctions where it is written, and cell rows are compressed as such."""
    stored = score_queries.normal(spark, SF)
    rows = stored.select(score.F.spark_partition_id().alias("part"), *score.JUNCTION, "refName_newR1").collect()
    runs = 1 + sum(a != b for a, b in zip(rows, rows[1:], strict=False))
    assert runs == len(set(rows)) < len(rows)  # each junction once a partition
    dealt = joins.deal(stored)
    codecs = set()
    for file in [f for table in (stored, dealt, analysis_queries.melted(spark, SF)) for f in table.inputFiles()]:
        whole = pq.ParquetFile(file.removeprefix("file:").replace("///", "/")).metadata
        codecs |= {whole.row_group(g).column(c).compression for g in range(whole.num_row_groups) for c in range(whole.num_columns)}
    assert codecs == {"ZSTD"}

"""Operators whose groups outgrow a task, against plain versions, with the sizes from which they are taken apart set low."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from splice_spark.functions import joins, ordering, stats
from splice_spark.functions.quantiles import grouped_medians
from splice_spark.operators import annotate, counts, differential, permutation, reads, svd
from splice_spark.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def grouped(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g, n in (("a", 400), ("b", 401), (None, 350), ("d", 3), ("e", 1)):
        for k in range(n):
            x = float(rng.choice([rng.normal(), rng.integers(0, 3), rng.normal() * 1e6, 1e-300, -1e300]))
            rows.append((g, "x" if g != "b" or k % 2 else None, x, None if k % 7 == 0 else float(k % 5), float("nan") if k % 3 else 2.0))
    rows += [("same", "x", 4.0, 4.0, None)] * 300 + [("two", "x", 1.0, 0.0, 0.5)] * 150 + [("two", "x", 2.0, 1.0, 0.5)] * 150
    return spark.createDataFrame(rows, "g string, h string, u double, v double, w double").repartition(4)


@pytest.mark.parametrize("most", [10, 120, 10**6])
def test_grouped_medians_are_sparks(grouped, most):
    number = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double"))
    want = grouped.groupBy("g", "h").agg(*[F.median(number(c)).alias(f"{c}_median") for c in "uvw"], F.count("*").alias("n"))
    got = grouped_medians(grouped, ["g", "h"], ["u", "v", "w"], F.count("*").alias("n"), most=most)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_places_and_running_sums(spark):
    rows = [(k % 3 if k % 5 else 0, k * 7919 % 1000) for k in range(1000)]
    df = spark.createDataFrame(rows, "g int, x int").repartition(5)
    got = ordering.number_within(df, ["g"], ["x"], "i").collect()
    for g in range(3):
        assert [r.i for r in sorted((r for r in got if r.g == g), key=lambda r: r.x)] == list(range(sum(a == g for a, _ in rows)))


def test_benjamini_hochberg_over_ranges(spark):
    rng = np.random.default_rng(8)
    p = np.concatenate([rng.random(300), rng.random(80) ** 4, [0.0, 1.0, 0.5, 0.5, 0.5]])
    df = spark.createDataFrame([(k, float(x)) for k, x in enumerate(p)] + [(-1, None)], "k int, p double").repartition(4)
    adjusted = differential.bh_adjust(df, "p", "q")
    got = {r.k: r.q for r in adjusted.collect()}
    order = np.argsort(p)
    q = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1].clip(max=1)
    want = dict(zip(order.tolist(), q, strict=True))
    assert got.pop(-1) is None and got == pytest.approx(want)
    none = differential.bh_adjust(df.filter("p is null"), "p", "q").collect()
    assert [tuple(r) for r in none] == [(None, -1, None)]
    assert "SinglePartition" not in plan(adjusted)


@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_bounds_are_ranks_of_keys(chunk):
    for n, ends in ((1000, [10, 10, 500, 999]), (5, [0, 4]), (3, [])):
        for perm in range(3):
            keys = np.sort(permutation.placed_keys(np.arange(n), 77, perm))
            assert permutation.key_bounds(n, 77, perm, ends, chunk).tolist() == keys[ends].tolist()


def test_permuted_statistics_from_parts(spark):
    """Tests taken apart give the statistics of the kernel that has all cells: groups of one cell, ties and an even and an odd number of cells."""
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for t, sizes in enumerate(([90, 61, 50], [40, 1, 30], [2, 3])):
        z = rng.choice([rng.normal(size=sum(sizes)), rng.integers(0, 3, sum(sizes)).astype(float)])
        labels = np.repeat([f"L{g}" for g in range(len(sizes))], sizes)
        rows += [(t, str(labels[k]), f"c{k:04}", float(z[k])) for k in range(len(z))]
        want[t] = stats.permuted_statistics(z, np.array(sizes), 0.1, 11 + t, np.arange(23))
    cells = spark.createDataFrame(rows, "t long, level_2 string, cell string, z double").repartition(3)
    tests = spark.createDataFrame([(t, 11 + t) for t in want], "t long, seed long")
    got = {(r.t, r.perm): r.statistic for r in permutation.permuted_tests(cells, tests, 23, 0.1, part_rows=17).collect()}
    assert len(got) == 3 * 23
    for t, each in want.items():
        assert [got[t, p] for p in range(23)] == pytest.approx(list(each), nan_ok=True)


def test_components_of_many_sites(spark):
    """Genes above the size are iterated: projections and shares are those of the matrix, for close values, few cells and sites without reads too."""
    rng = np.random.default_rng(12)
    rows = []
    for gene, p, n in (("big", 60, 100), ("flat", 24, 60), ("few", 45, 4), ("small", 12, 30), ("none", 50, 2)):
        m = rng.normal(size=(n, 6)) @ rng.normal(size=(6, p)) * (gene == "big") + rng.normal(size=(n, p)) * (0.3 if gene == "big" else 1.0)
        m[:, 7] = 0.0
        keep = rng.random((n, p)) < 0.7
        keep[0] = True
        rows += [(gene, f"c{i}", "AB"[j % 2], j * 10, float(m[i, j])) for i in range(n) for j in range(p) if keep[i, j]]
    values = spark.createDataFrame(rows, "gene string, cell string, let string, pos long, value double").repartition(4)
    whole, iterated = (svd.gene_components(values, direct_sites=d).toPandas() for d in (1000, 20))
    assert set(iterated.gene) == set(whole.gene) == {"big", "flat", "few", "small"}
    both = whole.merge(iterated, on=["gene", "component", "let", "pos"], suffixes=("", "_i"))
    assert len(both) == len(whole) == len(iterated)
    assert both.loading_i.to_numpy() == pytest.approx(both.loading.to_numpy(), abs=1e-7)
    assert both.centred_i.to_numpy() == pytest.approx(both.centred.to_numpy(), abs=1e-7)
    assert both.f_i.to_numpy() == pytest.approx(both.f.to_numpy(), abs=1e-10)


def test_lookup_reads_rows_once(spark, tmp_path):
    """Beyond broadcast size: one scan of the rows in the join, hot and null keys dealt over tasks, all rows kept."""
    path = str(tmp_path / "rows")
    spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")).write.parquet(path)
    rows, table = spark.read.parquet(path), spark.range(0, 6000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).union(spark.sql("select 7L, 70L"))
    assert len(joins.hot_hashes(rows, ["k"])) == 2
    for how, n in (("inner", 3000), ("left", 6000)):
        got = joins.lookup(rows, table, ["k"], how, most_bytes=0)
        assert plan(got).count("rows") <= 2 and plan(got).count("FileScan") == 2  # the rows and the table
        assert got.count() == n and got.select("v").distinct().count() == n
        assert got.filter("w is not null and w <> k * 10").count() == 0
        assert got.columns == ["k", "v", "w"]


def test_counts_are_hash_aggregates(spark):
    row = ("s", "b", "u", "chr1:G:5:+|chr1:H:9:-|lin", "r1", "G", "H", 5, 9, "chr1", "chr1")
    frame = spark.createDataFrame([row, row[:2] + ("u2",) + row[3:], row[:1] + (None, None) + row[3:]], "sample_id string, barcode string, UMI string, refName_ABR1 string, id string, geneR1A string, geneR1B string, juncPosR1A long, juncPosR1B long, chrR1A string, chrR1B string")
    one, two = counts.count_junctions(frame), counts.count_first_reads(frame)
    assert "SortAggregate" not in plan(one) and "Sort " not in plan(one)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.select(*one.columns).collect()))


def test_least_rows(spark):
    frame = spark.createDataFrame([("a", "g", "x", 2.0), ("a", "g", "w", 3.0), ("a", "h", None, 1.0), ("b", "g", "x", None)] + [("c", "g", "x", 1.0)] * 3, "cell string, gene string, level_2 string, z double")
    got = differential.least_rows(frame, ["cell", "gene"])
    assert sorted(map(tuple, got.select("cell", "gene", "level_2").collect()), key=str) == [("a", "g", "w"), ("a", "h", None), ("b", "g", "x"), ("c", "g", "x")]


def test_metadata_of_a_cell_is_one_row(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "cell_id string, n long")
    meta = spark.createDataFrame([("a", "T"), ("a", "T"), (None, "N"), ("c", "C")], "cell_id string, tissue string")
    assert sorted(map(tuple, counts.attach_meta(table, meta).collect()), key=str) == [("a", 1, "T"), ("b", 2, None), (None, 3, None)]
    with pytest.raises(ValueError, match="cells with several rows of metadata: a"):
        counts.attach_meta(table, meta.union(spark.createDataFrame([("a", "U")], "cell_id string, tissue string")))


def test_lines_are_in_file_order(spark, tmp_path):
    """Several files in many splits, which Spark reads by size: lines come by file name and place."""
    want = []
    for f, n in (("a", 40), ("b", 400), ("c", 5)):
        lines = [f'chr1\tx\texon\t{k}\t{k + 5}\t.\t+\t.\tgene_name "{f}{k:04}"; {"pad " * (k % 30)}' for k in range(n)]
        (tmp_path / f"{f}.gtf").write_text("#!comment\n" + "\n".join(lines) + "\n")
        want += [f"{f}{k:04}" for k in range(n)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = tables.read_gtf(spark, str(tmp_path))
        assert got.columns[-1] == "line"
        assert [r.attribute.split('"')[1] for r in got.orderBy("line").collect()] == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_bounds_and_junctions_of_an_annotation(spark):
    exon = lambda c, a, b, t, f="exon": (c, "x", f, a, b, ".", "+", ".", t)
    t1, t2 = 'gene_id "g"; transcript_id "t1"; n "1"', "ID=e;Parent=t2;gene=g"
    rows = [exon("chr1", 300, 400, t1), exon("chr1", 100, 200, t1), exon("chr1", 350, 380, t1), exon("chr1", 500, 600, t1), exon("chr1", 601, 700, t1), exon("chr2", 900, 950, t1)]
    rows += [exon("chr1", 100, 200, t2), exon("chr1", 500, 600, t2), exon("chr1", 1000, 1100, t1, "CDS"), exon("chr1", 5, 9, None), exon("chr1", 20, 30, 'note "none"')]
    gtf = spark.createDataFrame(rows, tables.GTF_SCHEMA)
    assert {tuple(r) for r in annotate.known_splices(gtf).collect()} == {("chr1", 200, 300), ("chr1", 400, 500), ("chr1", 200, 500)}
    bounds = {tuple(r) for r in annotate.exon_bounds(gtf).collect()}
    assert ("chr1", 1000) not in bounds and {("chr1", 5), ("chr1", 9), ("chr2", 950), ("chr1", 350)} <= bounds


def test_files_follow_counted_rows(spark, tmp_path):
    """About as many files a chromosome as its rows need, from whatever partitions they come, nulls too."""
    sizes = {"chr1": 950, "chr2": 120, "chrUn": 3, None: 210}
    rows = [(c, 1, k) for c, n in sizes.items() for k in range(n)] + [("chr1", 0, -1)]
    frame = spark.createDataFrame(rows, "chrR1A string, called int, k long").repartition(7)
    tables.write_by_chromosome(frame, str(tmp_path / "w"), 100)
    back = spark.read.parquet(str(tmp_path / "w"))
    assert back.count() == len(rows) - 1
    for c, n in sizes.items():
        files = list((tmp_path / "w" / f"chrR1A={c or '__HIVE_DEFAULT_PARTITION__'}").glob("*.parquet"))
        assert -(-n // 200) <= len(files) <= -(-n // 100), c


def test_mates_that_may_pair(spark):
    """Second mates of named reads only: mapped, primary and not chimeric."""
    row = lambda q, flag, ch=None: (q, flag, ch)
    mates = spark.createDataFrame([row("a", 0), row("a", 4), row("a", 256), row("a", 0, "1"), row("b", 0)], "qname string, flag int, ch string")
    first = spark.createDataFrame([("a",), ("a",)], "id string")
    assert [tuple(r) for r in reads.mate_candidates(mates, first).collect()] == [("a", 0, None)]

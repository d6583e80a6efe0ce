"""Operators on small hand-made frames, numpy versions of the components, and properties of the scores."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from splice_spark.functions import cigar, stats
from splice_spark.functions.joins import lookup
from splice_spark.functions.quantiles import weighted_quantiles
from splice_spark.jobs.pipeline import Params, analysis_job, count_job, score_job
from splice_spark.operators import counts, differential, gene_repair, reads, score, sites, svd
from splice_spark.sources import fixtures, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    normal = tables.normalise_input(fixtures.junctions(spark, SF), True, "tissue")
    return score.score_rows(normal, True, 5, 0.1)


def test_cigar_table(spark):
    cases = [(100, "20M500N30M"), (100, "10M5N3M9N4D2M"), (100, "5M"), (100, None), (100, "5M7N3I"), (100, "3M5N2M5N1M")]
    df = spark.createDataFrame(cases, "pos long, cigar string").select("cigar", cigar.cigar_junction(F.col("pos"), F.col("cigar")).alias("j"), cigar.cigar_ref_span(F.col("cigar")).alias("s"))
    got = {r.cigar: (r.j and tuple(r.j), r.s) for r in df.collect()}
    assert got == {"20M500N30M": ((119, 620), 550), "10M5N3M9N4D2M": ((117, 131), 33), "5M": (None, 5), None: (None, 0), "5M7N3I": (None, 12), "3M5N2M5N1M": ((102, 108), 16)}


def test_chimeric_clips(spark):
    cases = {"5S20M": "20M", "20M7H": "20M", "9S20M3S": "20M3S", "3S20M3S": "3S20M", "20M": None}
    df = spark.createDataFrame([(c,) for c in cases], "c string").select("c", cigar.split_cigar_chim(F.col("c")).alias("k"))
    assert {r.c: r.k for r in df.collect()} == cases


def test_entropy_and_runs(spark):
    r = spark.createDataFrame([("AAAAAACCGT",)], "s string").select(cigar.kmer_entropy(F.col("s")).alias("e"), cigar.longest_runs(F.col("s")).alias("r")).first()
    mers = ["AAAAAACCGT"[i : i + 5] for i in range(6)]
    assert r.e == pytest.approx(-sum(mers.count(m) / 6 * math.log(mers.count(m) / 6) for m in set(mers)))
    assert tuple(r.r) == (6, 1, 2, 1, 0)


def test_chi2_tail():
    assert stats.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert stats.chi2_tail(5.991464547107979, 2) == pytest.approx(0.05, abs=1e-9)
    assert stats.chi2_tail(9.487729036781154, 4) == pytest.approx(0.05, abs=1e-9)
    assert stats.chi2_tail(11.070497693516351, 5) == pytest.approx(0.05, abs=1e-9)
    assert stats.chi2_tail(0, 3) == 1 and math.isnan(stats.chi2_tail(math.nan, 3)) and stats.chi2_tail(2000, 3) < 1e-300


def test_permutation_kernel_is_the_statistic():
    rng = np.random.default_rng(3)
    z, sizes = rng.normal(size=40), np.array([9, 14, 17])
    got = stats.permuted_statistics(z, sizes, 0.1, 77, np.arange(6))
    assert got == pytest.approx(np.concatenate([stats.permuted_statistics(z, sizes, 0.1, 77, np.arange(k, 6, 2)) for k in (0, 1)]).reshape(2, 3).T.ravel())
    for key, t in zip(stats.permutation_keys(40, 77, np.arange(6)), got, strict=True):
        v = z[sorted(range(40), key=lambda i: (key[i], i))]
        groups = [v[:9], v[9:23], v[23:]]
        w = np.array([len(g) / (g.var(ddof=1) + 0.1) for g in groups])
        m = np.array([np.median(g) for g in groups])
        assert t == pytest.approx((w * (m - (w * m).sum() / w.sum()) ** 2).sum())


def test_permutations_are_even():
    """Every cell comes to every place about equally often, whatever the seed, and pairs of places are independent."""
    n, perms = 8, 40_000
    for seed in (0, 1, 987_654):
        order = np.argsort(stats.permutation_keys(n, seed, np.arange(perms)), axis=1, kind="stable")
        counts = np.stack([np.bincount(order[:, k], minlength=n) for k in range(n)])
        assert ((counts - perms / n) ** 2 / (perms / n)).sum() < 110  # chi-square of 49 degrees of freedom
        pairs = np.bincount(order[:, 0] * n + order[:, 1], minlength=n * n).reshape(n, n)
        off = pairs[~np.eye(n, dtype=bool)]
        assert ((off - perms / 56) ** 2 / (perms / 56)).sum() < 110


def test_large_tests_are_taken_apart(spark):
    rng = np.random.default_rng(5)
    rows = [("a", f"g{g}", "scZ", f"c{k:03}", f"t{k % 3}", float(rng.normal() + (k % 3) * g)) for g in range(3) for k in range(60)]
    melted = spark.createDataFrame(rows, "level_1 string, gene string, z_col string, cell string, level_2 string, z double")
    tests = differential.with_pvals(differential.wald_stat(differential.group_stats(melted)))
    one, many = (sorted(map(tuple, differential.permute(melted, tests, alpha=1.0, test_rows=n).collect())) for n in (10**9, 30))
    assert one == many and any(r[-2] is not None for r in one)


@pytest.mark.parametrize("most", [3, 10_000])
def test_quantiles_are_exact(spark, most):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(size=300), rng.integers(0, 4, 200).astype(float), [1e12, -1e-9]])
    freq = rng.integers(0, 4, len(values))
    df = spark.createDataFrame([(float(v), int(n)) for v, n in zip(values, freq)] + [(None, 3)], "v double, n long").repartition(3)
    flat = np.repeat(values, freq)
    for q in (0.0, 0.01, 0.37, 0.99):
        assert weighted_quantiles(df, "v", "n", [q, 1 - q], most) == pytest.approx([np.quantile(flat, q), np.quantile(flat, 1 - q)])
    assert weighted_quantiles(df.filter("v is null"), "v", "n", [0.5]) is None


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_is_a_join(spark, how):
    rows = spark.createDataFrame([(k % 7 if k % 3 else 0, "x" if k % 5 else None, k) for k in range(900)], "a int, b string, k int")
    table = spark.createDataFrame([(a, "x", a * 10) for a in range(0, 9, 2)], "a int, b string, v int")
    want = sorted(map(str, rows.join(table, ["a", "b"], how).select("a", "b", "k", "v").collect()))
    for most in (0, 1 << 20):
        assert sorted(map(str, lookup(rows, table, ["a", "b"], how, most).select("a", "b", "k", "v").collect())) == want


def test_components_are_those_of_the_dense_matrix(rows):
    values = svd.site_values(rows)
    load = svd.gene_components(values, all_components=True)
    assert load.groupBy("gene").agg(F.max("component").alias("c")).filter("c > 2").count() > 0  # all components, not the first three
    scores, shares = svd.svd_scores(values, load).toPandas(), svd.fractions(load).toPandas().set_index("gene")
    long = values.toPandas()
    for gene in list(shares.index)[:4]:
        m = long[long.gene == gene].pivot_table(index="cell", columns=["let", "pos"], values="value", fill_value=0.0)
        a = m.to_numpy() - m.to_numpy().mean(1, keepdims=True)
        _, s, vh = np.linalg.svd(a, full_matrices=False)
        assert shares.loc[gene].to_numpy() == pytest.approx((s**2 / (s**2).sum())[:3], abs=1e-9)
        z = scores[scores.gene == gene].set_index("cell").loc[m.index]
        for k in range(3):
            assert np.abs(z[f"svd_z{k}"].to_numpy()) == pytest.approx(np.abs(a @ vh[k]), abs=1e-6)


def test_strand_flip_flips_the_score(spark):
    j = fixtures.junctions(spark, SF)
    flipped = j.withColumn("refName_newR1", F.translate("refName_newR1", "+-", "-+"))
    one, two = (score.cell_gene_scores(score.score_rows(tables.normalise_input(x, True, "tissue"), True)).select("cell", "gene", "scZ") for x in (j, flipped))
    both = one.join(two.withColumnRenamed("scZ", "other"), ["cell", "gene"])
    assert both.filter("abs(scZ + other) > 1e-9").count() == 0 and both.count() == one.count()


def test_positions_matter_by_order_only(spark):
    j = fixtures.junctions(spark, SF).filter("geneR1A_uniq <> 'unknown'")
    moved = j.withColumns({"juncPosR1A": F.col("juncPosR1A") * 3 + 7, "juncPosR1B": F.col("juncPosR1B") * 2})
    one, two = (score.cell_gene_scores(score.score_rows(tables.normalise_input(x, True, "tissue"), True)).select("cell", "gene", F.round("scZ", 9).alias("scZ")) for x in (j, moved.repartition(3)))
    assert one.exceptAll(two).count() == 0


def test_validation(spark):
    df = fixtures.junctions(spark, SF)
    with pytest.raises(ValueError, match="numReads"):
        tables.validate_columns(df.drop("numReads"), "tissue", "compartment")
    with pytest.raises(ValueError):
        Params(library="other")
    with pytest.raises(ValueError):
        Params(pin_s=0.7)
    with pytest.raises(ValueError):
        tables.read_junctions(spark, "x.doc")


def test_bh(spark):
    p = [0.01, 0.04, 0.03, 0.005, 0.03, None]
    got = differential.bh_adjust(spark.createDataFrame([(k, x) for k, x in enumerate(p)], "k int, p double"), "p", "q").orderBy("k").collect()
    assert [r.q for r in got][:5] == pytest.approx([0.025, 0.04, 0.0375, 0.025, 0.0375]) and got[5].q is None


def test_location_flag(spark):
    cases = [("a|b|fus", "+", 1, 2, None, 1), ("a|b|sc", "+", 1, 2, 5, 0), ("a|b|lin", "+", 5, 9, None, 0), ("a|b|lin", "+", 5, 9, 7, 1), ("a|b|lin", "-", 5, 9, 7, 0), ("a|b|rev", "+", 9, 5, 7, 1), ("a|b|rev", "+", 9, 5, 11, 0), ("a|b|err", "+", 1, 2, 3, -1)]
    df = spark.createDataFrame(cases, "refName_ABR1 string, read_strandR1 string, juncPosR1A long, juncPosR1B long, juncPosR2A long, want int")
    assert df.filter(reads.location_flag() != F.col("want")).count() == 0


def test_gene_repair_cases(spark):
    strands = spark.createDataFrame([("chr1", "+", "G1"), ("chr1", "-", "G2"), ("chr1", "+", "G3")], "seqname string, strand string, gene string")
    base = {"chrR1A": "chr1", "chrR1B": "chr1", "read_strandR1A": "+", "read_strandR1B": "+", "fileTypeR1": "Aligned", "juncPosR1A": 10, "juncPosR1B": 20}
    cases = [
        {"refName_ABR1": "chr1:G1:10:+|chr1:G3:20:+", "geneR1A": "G1", "geneR1B": "G3"},
        {"refName_ABR1": "chr1:G1,G3:10:?|chr1:G3:20:+", "geneR1A": "G1,G3", "geneR1B": "G3"},
        {"refName_ABR1": "chr1:G1,G2:10:?|chr1:G3:20:+", "geneR1A": "G1,G2", "geneR1B": "G3"},
        {"refName_ABR1": "chr1:G2:10:-|chr1:G2:20:-", "geneR1A": "G2", "geneR1B": "G2"},
        {"refName_ABR1": "chr1:x:10:?|chr1:y:20:?", "geneR1A": "x", "geneR1B": "y"},
        {"refName_ABR1": "chr1:G1:5:+|chr1:G3:2000000:+", "geneR1A": "G1", "geneR1B": "G3", "fileTypeR1": "Chimeric", "juncPosR1A": 5, "juncPosR1B": 2_000_000},
    ]
    df = spark.createDataFrame(pd.DataFrame([base | c for c in cases]))
    got = {r.refName_ABR1: r.refName_newR1 for r in gene_repair.modify_refnames(df, strands).collect()}
    assert list(got[c["refName_ABR1"]] for c in cases) == [
        "chr1:G1:10:+|chr1:G3:20:+|lin",
        "chr1:G3:10:+|chr1:G3:20:+|lin",
        "chr1:G1:10:+|chr1:G3:20:+|lin",
        "chr1:G2:20:-|chr1:G2:10:-|lin",
        "chr1:x:10:?|chr1:y:20:?|lin",
        "chr1:G1:5:+|chr1:G3:2000000:+|fus",
    ]


def test_umi_dedup(spark):
    r = [("s", "B-1", "u", "j", k) for k in "cab"] + [("s", "B-1", None, "j", "d"), ("s", "B-1", None, "j", "e")]
    df = spark.createDataFrame([(*x, "g", "h", 1, 2, "c", "c") for x in r], "sample_id string, barcode string, UMI string, refName_ABR1 string, id string, geneR1A string, geneR1B string, juncPosR1A long, juncPosR1B long, chrR1A string, chrR1B string")
    assert sorted(x.id for x in counts.dedup_umis(df).collect()) == ["a", "d"]
    row = counts.junction_table(df, "10X").first()
    assert (row.numReads, row.cell_id) == (2, "s_B")


def test_jobs(spark):
    params = Params(sicilian=True, pin_s=0.1, level_1="tissue", level_2="compartment", n_perms=20)
    scores, _, load = score_job(fixtures.junctions(spark, SF), params)
    tests, wide, found, summary = analysis_job(scores, load, params)
    assert summary.count() > 0 and found.count() > 0
    planted = tests.filter("z_col = 'scZ' and pval is not null").toPandas()
    planted["planted"] = planted.gene.str.extract(r"g(\d+)$")[0].fillna("1").astype(int) % 4 == 0
    assert planted[planted.planted].pval.median() < 0.05 < planted[~planted.planted].pval.median()
    assert wide.filter("perm_pval_adj_scZ is not null").count() > 0


def test_count_job(spark):
    aligned, gtf = fixtures.reads(spark, SF), fixtures.gtf(spark, SF)
    meta = spark.createDataFrame([("S0_BC1", "lung")], "cell_id string, tissue string")
    bounds = spark.createDataFrame([("chr1", 1)], "chr string, pos long")
    known = spark.createDataFrame([("chr1", 1, 2)], "chr string, lo long, hi long")
    out = count_job(aligned, gtf, meta, bounds, known, Params())
    assert {"cell", "numReads", "tissue", "splice_ann", "both_ann"} <= set(out.columns) and out.count() > 0


def test_entropy_of_a_long_read_takes_linear_time(spark):
    seq = "ACGTTGCA" * 2500
    e = spark.createDataFrame([(seq,)], "s string").select(cigar.kmer_entropy(F.col("s")).alias("e")).first().e
    n = len(seq) - 4
    counts_ = pd.Series([seq[i : i + 5] for i in range(n)]).value_counts() / n
    assert e == pytest.approx(-(counts_ * np.log(counts_)).sum())


def test_chi2_tails_of_many():
    x, df = np.array([0.5, 3.0, 11.0, -1.0, np.nan, 40.0]), np.array([1, 4, 5, 2, 3, 40])
    got = stats.chi2_tails(x, df)
    assert got[:2] == pytest.approx([math.erfc(math.sqrt(0.25)), math.exp(-1.5) * 2.5]) and got[3] == 1 and np.isnan(got[4])
    assert got[5] == pytest.approx(math.exp(-20) * sum(20**k / math.factorial(k) for k in range(20)))


def test_summary_takes_the_group_or_else_the_row_without_one(spark):
    scores = spark.createDataFrame([("g", "a", "x", 1.0), ("g", "b", "x", 2.0), ("h", "a", "x", 3.0)], "gene string, l1 string, l2 string, scZ double").withColumns({c: F.lit(None).cast("double") for c in differential.SCORES[1:]})
    p = [("g", "a", 0.1), ("g", None, 0.9), ("h", None, 0.5)]
    pvals = spark.createDataFrame(p, "gene string, level_1 string, perm_pval_adj_scZ double").withColumns({f"perm_pval_adj_{c}": F.lit(0.0) for c in differential.SCORES[1:]})
    found = spark.createDataFrame([], "gene string, component int, rank int, let string, end long, score double")
    got = sites.summarise(scores, pvals, found, "l1", "l2")
    assert [(r.gene, r.level_1, r.scZ_pval) for r in got.collect()] == [("g", "a", 0.1), ("g", "b", 0.9), ("h", "a", 0.5)]


def test_files(spark, tmp_path):
    (tmp_path / "genes.gtf").write_text('#!genome-build x\nchr1\tsrc\texon\t5\t9\t.\t+\t.\tgene_id "a"; gene_name "G1";\nchr1\tsrc\texon\t1\t3\t.\t+\t.\tgene_name "G0";\n')
    lines = tables.read_gtf(spark, str(tmp_path / "genes.gtf")).orderBy("line").collect()
    assert [(r.start, r.end, r.attribute) for r in lines] == [(5, 9, 'gene_id "a"; gene_name "G1";'), (1, 3, 'gene_name "G0";')]
    wide = spark.createDataFrame([("g2", "a", None), ("g1", "b", 0.2), ("g3", "a", 0.1)], "gene string, level_1 string, perm_pval_adj_scZ double")
    tables.write_results(str(tmp_path), wide=wide)
    text = [x for f in sorted((tmp_path / "wide.tsv").glob("part-*")) for x in f.read_text().splitlines() if not x.startswith("gene\t")]
    assert [x.split("\t")[0] for x in text] == ["g3", "g1", "g2"]


def test_samples_of_two_mates(spark, tmp_path):
    rows = {"a": "r1\t0\t1\t10\t9\t5M\t*\t0\t0\tACGTA\t*\tCB:Z:" + "A" * 5000, "b": "r1\t16\t1\t20\t9\t5M\t*\t0\t0\tACGTA\t*", "c": "r2\t0\t1\t30\t9\t5M\t*\t0\t0\t*\t*\tXC:Z:q"}
    for name, row in rows.items():
        (tmp_path / f"{name}.sam").write_text(f"@HD\tVN:1\n{row}\n")
    (tmp_path / "s.csv").write_text(f"S1, {tmp_path}/a.sam, {tmp_path}/b.sam\nS2, {tmp_path}/c.sam, {tmp_path}/c.sam\n")
    got = tables.read_samples(spark, tables.read_samplesheet(spark, str(tmp_path / "s.csv"), "SS2")).collect()
    assert sorted((r.sample_id, r.mate, r.qname, r.pos) for r in got) == [("S1", 1, "r1", 10), ("S1", 2, "r1", 20), ("S2", 1, "r2", 30), ("S2", 2, "r2", 30)]
    assert {len(r.cb) for r in got if r.cb} == {5000} and {r.seq for r in got} == {"ACGTA", None}
    with pytest.raises(ValueError):
        tables.read_samples(spark, spark.createDataFrame([("S", 1, "/x/a.sam"), ("S", 1, "/y/x/a.sam")], "sample_id string, mate int, path string"))


def test_sam_text(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nr1\t16\t1\t100\t9\t5M9N5M\t*\t0\t0\tACGTACGTAC\t*\tCB:Z:AA-1\tUR:Z:U1\tAS:i:7\n")
    row = tables.read_alignments(spark, str(tmp_path / "a.sam")).first()
    assert (row.qname, row.flag, row.pos, row.cigar, row.cb, row.ub, row.ur, row.as_score) == ("r1", 16, 100, "5M9N5M", "AA-1", None, "U1", 7)
    (tmp_path / "s.csv").write_text("S1, a.sam, b.sam\n")
    assert [(r.sample_id, r.mate, r.path) for r in tables.read_samplesheet(spark, str(tmp_path / "s.csv"), "SS2").collect()] == [("S1", 1, "a.sam"), ("S1", 2, "b.sam")]

"""Differences of scores between cell groups.

For each (level 1, gene, score) the medians of the level-2 groups are compared
by a chi-square statistic with adjusted variances; permutations follow where it
is significant.  Groups are counted and summed by Spark.  A permutation is a rule
(see ``stats.permutation_keys``), so it is the same on every run and in any
engine, however cells are dealt over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splice_spark.functions.joins import by_cell, dealt_by, lookup
from splice_spark.functions.lineage import CELL_ROWS, cut
from splice_spark.functions.ordering import adjusted_by_rank
from splice_spark.functions.quantiles import MOST, grouped_medians
from splice_spark.functions.stats import chi2_sf, permuted_statistics
from splice_spark.operators.permutation import permuted_tests

SCORES = ("scZ", "svd_z0", "svd_z1", "svd_z2")
TEST = ["level_1", "gene", "z_col"]


def least_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key, the least of several; keys aren't null.

    Keys are counted first, by a hash aggregate: rows whose key is theirs alone pass as they are, and only the others are ordered.
    """
    twice = cut(rows.groupBy(*keys).agg(F.count("*").alias("n__")).filter("n__ > 1").select(*keys, F.lit(True).alias("twice__")))
    if twice.isEmpty():
        return rows
    rest = [c for c in rows.columns if c not in keys]
    marked = lookup(rows, twice, keys, "left")
    least = marked.filter("twice__").groupBy(*keys).agg(F.min(F.struct(*rest)).alias("r")).select(*keys, "r.*")
    return marked.filter("twice__ is null").select(*rows.columns).unionByName(least)


def eligible(scores: DataFrame, level_1: str, level_2: str, min_cells: int = 10) -> DataFrame:
    """One row a cell and gene, ``level_1, level_2`` and scores, of level-2 groups with more than ``min_cells`` cells of the gene in all level-1 groups.

    Of several rows of a cell and gene it is the least by level 2, level 1 and scores.
    """
    l1 = F.lit("null") if level_1 == "dummy" else F.col(level_1).cast("string")
    plain = scores.select("cell", "gene", F.col(level_2).cast("string").alias("level_2"), l1.alias("level_1"), *SCORES, *dealt_by(scores))
    one = least_rows(plain, by_cell(plain))
    large = one.groupBy("level_2", "gene").agg(F.count("cell").alias("n")).filter(F.col("n") > min_cells).select("level_2", "gene")
    return lookup(one.filter("level_2 is not null"), large, ["level_2", "gene"]).drop(*dealt_by(one))


def melt_scores(cells: DataFrame) -> DataFrame:
    """``cell, gene, level_1, level_2, z_col, z``, a row for each score."""
    return cells.unpivot(["cell", "gene", "level_1", "level_2"], [F.col(c).cast("double").alias(c) for c in SCORES], "z_col", "z").withColumn("z", F.nanvl("z", F.lit(None).cast("double")))


def group_stats(melted: DataFrame, var_add: float = 0.1, most: int = MOST) -> DataFrame:
    """Per test and level-2 group: ``cells, ont_median, ont_var`` (sample variance, plus ``var_add``; null for one value), of one row a cell and test, as ``eligible`` gives them.

    Medians of groups of more than ``most`` cells are selected without a task that has the group.
    """
    keys = [*TEST, "level_2"]
    var = F.when(F.count("z") > 1, F.var_samp("z")) + var_add
    out = grouped_medians(melted, keys, ["z"], F.count("cell").alias("cells"), var.alias("ont_var"), most=most)
    return out.select(*keys, "cells", F.col("z_median").alias("ont_median"), "ont_var")


def wald_stat(stats: DataFrame) -> DataFrame:
    """Per test with two groups or more: ``num_onts, max_abs_median, Tn1``; Tn1 is null if a group lacks a median or variance."""
    w = F.col("cells") / F.col("ont_var")
    means = stats.groupBy(*TEST).agg(
        F.count("*").alias("num_onts"),
        F.max(F.abs("ont_median")).alias("max_abs_median"),
        F.try_divide(F.sum(w * F.col("ont_median")), F.sum(w)).alias("mean"),
        F.bool_and(F.col("ont_var").isNotNull() & F.col("ont_median").isNotNull()).alias("whole"),
    )
    # the spread about the mean, from the groups again: no difference of large sums
    spread = stats.join(means.filter("num_onts > 1"), TEST).groupBy(*TEST, "num_onts", "max_abs_median", "whole").agg(F.sum(w * (F.col("ont_median") - F.col("mean")) ** 2).alias("t"))
    return spread.select(*TEST, "num_onts", "max_abs_median", F.when(F.col("whole"), F.col("t")).alias("Tn1"))


def with_pvals(tests: DataFrame) -> DataFrame:
    """``pval``: the chi-square tail with groups - 1 degrees of freedom."""
    return tests.withColumn("pval", chi2_sf(F.col("Tn1"), (F.col("num_onts") - 1).cast("double")))


#: A permuted statistic counts as below the observed one if it is by more than this share, so that equal ones, whose last digits follow the order of sums, never do.
TIE = 1e-9
#: Cells of a test that one task permutes; larger tests are taken apart.
TEST_ROWS = 100_000
#: Bytes of an Arrow batch of tests, or one test.
BATCH_BYTES = 8 << 20


def seed_column(seed: int) -> F.Column:
    """The first 28 bits of the MD5 of a test's names and the seed."""
    names = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TEST], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(names), 1, 7), 16, 10).cast("long")


def _kernel(n_perms: int, var_add: float):
    """Permuted statistics below the observed one, of tests that are a row each: values in the order of groups and cells, and sizes of the groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            below = []
            for z, sizes, seed, observed in zip(*[batch.column(c) for c in ("z", "sizes", "seed", "Tn1")], strict=True):
                found = permuted_statistics(z.values.to_numpy(), sizes.values.to_numpy(), var_add, seed.as_py(), np.arange(n_perms))
                below.append(np.count_nonzero(found < observed.as_py() * (1 - TIE)))
            yield pa.RecordBatch.from_arrays([batch.column("t"), pa.array(below, pa.int64())], names=["t", "below"])

    return run


def permute(melted: DataFrame, tests: DataFrame, n_perms: int = 100, alpha: float = 0.05, seed: int = 123, var_add: float = 0.1, test_rows: int = TEST_ROWS) -> DataFrame:
    """Tests with ``perm_pval``, the share of permuted statistics below the observed one where ``pval`` is under ``alpha``, and two-sided ``perm_pval2``.

    The permutations depend on the test and their numbers only.  A test of ``test_rows`` cells or fewer becomes one row, whose statistics
    are counted where they are made; the cells of larger tests stay spread (``permuted_tests``).
    """
    valued = melted.filter("z is not null and level_2 is not null")
    chosen = tests.filter(F.col("pval") < alpha).select(*TEST, "Tn1")
    sized = lookup(valued.groupBy(*TEST).agg(F.count("*").alias("n")), chosen, TEST)
    sized = cut(sized.withColumns({"t": F.monotonically_increasing_id(), "seed": seed_column(seed)}))
    small = lookup(valued.select(*TEST, "cell", "level_2", "z"), sized.filter(F.col("n") <= test_rows).select(*TEST, "t", "seed", "Tn1"), TEST)
    test = ["t", "seed", "Tn1"]
    groups = small.repartition("t").groupBy(*test, "level_2").agg(F.sort_array(F.collect_list(F.struct("cell", "z"))).alias("cells"))
    whole = groups.groupBy(*test).agg(F.sort_array(F.collect_list(F.struct("level_2", F.col("cells.z").alias("z")))).alias("groups"))
    packed = whole.select(*test, F.transform("groups", lambda g: F.size(g["z"]).cast("long")).alias("sizes"), F.flatten("groups.z").alias("z"))
    melted.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    below = packed.mapInArrow(_kernel(n_perms, var_add), "t long, below long")
    large = cut(sized.filter(F.col("n") > test_rows))
    if not large.isEmpty():
        cells = lookup(valued.select(*TEST, "cell", "level_2", "z"), large.select(*TEST, "t"), TEST)
        statistics = lookup(permuted_tests(cells, large, n_perms, var_add), large.select("t", "Tn1"), ["t"])
        below = below.unionByName(statistics.groupBy("t").agg(F.count_if(F.col("statistic") < F.col("Tn1") * (1 - TIE)).alias("below")))
    share = sized.join(below, "t").select(*TEST, (F.col("below") / F.lit(float(n_perms))).alias("perm_pval"))
    out = tests.join(share, TEST, "left")
    return out.withColumn("perm_pval2", 2 * F.least("perm_pval", 1 - F.col("perm_pval")))


def bh_adjust(tests: DataFrame, name: str, out: str) -> DataFrame:
    """Benjamini-Hochberg over all non-null values of ``name``.

    Equal values share an adjusted value, so the order is taken over distinct values with their counts, dealt over range partitions.
    """
    values = tests.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    return lookup(tests, adjusted_by_rank(values, name, "n", out), [name], "left")


def widen(tests: DataFrame, fractions: DataFrame) -> DataFrame:
    """A row for each gene and level-1 group, four columns a score, energy shares; by the adjusted permutation p of scZ."""
    what = {"chi2_pval_adj": "pval_adj", "perm_pval_adj": "perm_pval2_adj", "max_abs_median": "max_abs_median", "perm_cdf": "perm_pval"}
    wide = tests.groupBy("gene", "level_1").agg(F.max("num_onts").alias("num_onts"), *[F.max(F.when(F.col("z_col") == z, F.col(c))).alias(f"{name}_{z}") for z in SCORES for name, c in what.items()])
    return wide.join(fractions, "gene", "left").orderBy(F.asc_nulls_last("perm_pval_adj_scZ"), "gene", "level_1")


def differential_tests(scores: DataFrame, level_1: str, level_2: str, n_perms: int = 100, seed: int = 123) -> DataFrame:
    """The long table of tests with adjusted p-values."""
    melted = cut(melt_scores(eligible(scores, level_1, level_2)), CELL_ROWS)
    tests = cut(permute(melted, cut(with_pvals(wald_stat(cut(group_stats(melted))))), n_perms, seed=seed))
    return bh_adjust(bh_adjust(tests, "pval", "pval_adj"), "perm_pval2", "perm_pval2_adj")

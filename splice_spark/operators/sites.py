"""Splice sites that drive a gene's components, and the summary of all results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splice_spark.functions.joins import lookup
from splice_spark.functions.quantiles import grouped_medians
from splice_spark.operators.differential import SCORES


def site_genes(pvals: DataFrame, library: str, alpha: float = 0.05) -> DataFrame:
    """Genes to look at: significant by permutation for SS2, all tested ones for 10X and SLS."""
    chosen = pvals.filter(F.col("perm_pval_adj_svd_z0") < alpha) if library == "SS2" else pvals
    return chosen.select("gene").distinct()


def top_sites(loadings: DataFrame, k: int = 3, threshold: float = 0.1) -> DataFrame:
    """Per gene and component the site of largest squared loading, and up to ``k`` in all if over ``threshold``."""
    order = Window.partitionBy("gene", "component").orderBy(F.round(F.col("loading") ** 2, 9).desc(), "pos", "let")
    best = loadings.withColumns({"rank": F.row_number().over(order), "score": F.col("loading") ** 2}).filter(F.col("rank") <= k)
    return best.filter((F.col("rank") == 1) | (F.col("score") > threshold)).select("gene", "component", "rank", "let", F.col("pos").alias("end"), "score")


def all_sites(sites: DataFrame) -> DataFrame:
    """``gene, let, end`` of all components, once each, with the component and rank where it stands first."""
    first = F.min(F.struct("component", "rank"))
    return sites.groupBy("gene", "let", "end").agg(first.alias("f")).select("gene", "let", "end", "f.component", "f.rank")


def site_list(sites: DataFrame) -> DataFrame:
    """``gene, SpliZsites``: ends in the order of components and ranks, comma-joined."""
    ordered = F.sort_array(F.collect_list(F.struct("component", "rank", "let", "end")))
    return all_sites(sites).groupBy("gene").agg(F.array_join(F.transform(ordered, lambda s: s["end"].cast("string")), ",").alias("SpliZsites"))


def summarise(scores: DataFrame, pvals: DataFrame, sites: DataFrame, level_1: str, level_2: str) -> DataFrame:
    """Medians of each score by gene and both levels, sites, and adjusted p-values: those of the level-1 group, or else those without a level-1 label."""
    l1 = F.lit("null") if level_1 == "dummy" else F.col(level_1).cast("string")
    keys = ["gene", "level_1", "level_2"]
    labelled = scores.select("gene", l1.alias("level_1"), F.col(level_2).cast("string").alias("level_2"), *SCORES)
    medians = grouped_medians(labelled, keys, list(SCORES), F.count("*").alias("n_cells"))
    p = pvals.select("gene", "level_1", *[F.col(f"perm_pval_adj_{z}").alias(f"{z}_pval") for z in SCORES])
    row = F.struct(*[f"{z}_pval" for z in SCORES])
    own = p.filter("level_1 is not null").groupBy("gene", "level_1").agg(F.min(row).alias("own"))
    any_level = p.filter("level_1 is null").groupBy("gene").agg(F.min(row).alias("any_level"))
    out = lookup(lookup(medians, own, ["gene", "level_1"], "left"), any_level, ["gene"], "left").withColumn("p", F.coalesce("own", "any_level"))
    out = out.select(*medians.columns, "p.*")
    return out.join(site_list(sites), "gene", "left").orderBy("gene", "level_1", "scZ_median", "level_2")

"""Queries of the component, test, site and summary operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splice_spark.functions.joins import cut_dealt, dealt_by
from splice_spark.functions.lineage import CELL_ROWS, cut
from splice_spark.jobs.pipeline import Params, analysis_job, score_job
from splice_spark.jobs.score_queries import BOUNDS, MERGED, PIN_S, d6, io_folder, merged, normal, r6
from splice_spark.operators import differential, score, sites, svd
from splice_spark.sources import fixtures, tables

L1, L2 = "tissue", "compartment"


def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``merged`` with what scores and components need."""
    return score.narrow_rows(normal(spark, sf_dir), [L1, L2], True, BOUNDS, PIN_S)


def values(spark: SparkSession, sf_dir: str, svd_type: str = "normdonor") -> DataFrame:
    return cut_dealt(svd.site_values(narrow(spark, sf_dir), svd_type))


def _site_values(svd_type: str):
    def run(spark, sf_dir):
        return values(spark, sf_dir, svd_type).select("gene", "cell", "let", "pos", *r6("value"))

    return run


def gene_gram(spark, sf_dir):
    return svd.gene_gram(values(spark, sf_dir)).select("gene", "let_i", "pos_i", "let_j", "pos_j", *[(F.round("g", 5) + 0.0).alias("g")])


def svd_total_energy(spark, sf_dir):
    v = values(spark, sf_dir)
    return svd.total_energy(svd.gene_gram(v), svd.sites(v)).select("gene", (F.round("energy", 4) + 0.0).alias("energy"))


def loadings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three, as the job makes them."""
    return svd.gene_components(values(spark, sf_dir))


def gene_components(spark, sf_dir):
    """The first three; the others are in ``svd_spectrum`` and ``svd_reconstruction``."""
    return loadings(spark, sf_dir).select("gene", F.col("component").cast("long").alias("component"), "let", "pos", *r6("loading", "f"))


def svd_spectrum(spark, sf_dir):
    """Of all components of a gene: their number, the sums of their shares and squared shares, and whether all loadings have length 1."""
    each = svd.gene_components(values(spark, sf_dir), all_components=True).groupBy("gene", "component").agg(F.first("f").alias("f"), F.sum(F.col("loading") ** 2).alias("length"))
    out = each.groupBy("gene").agg(F.count("*").alias("n"), F.sum("f").alias("shares"), F.sum(F.col("f") ** 2).alias("squares"), F.max(F.abs(F.col("length") - 1)).alias("off"))
    return out.select("gene", "n", *r6("shares", "squares", "off"))


def svd_reconstruction(spark, sf_dir):
    """The centred Gram matrix put together again from all components: its diagonal and the numbers beside it, as shares of the energy."""
    load = svd.gene_components(values(spark, sf_dir), all_components=True)
    following = F.lead("loading").over(Window.partitionBy("gene", "component").orderBy("let", "pos"))
    sums = load.withColumn("following", following).groupBy("gene", "let", "pos").agg(F.sum(F.col("f") * F.col("loading") ** 2).alias("own"), F.sum(F.col("f") * F.col("loading") * F.col("following")).alias("beside"))
    return sums.select("gene", "let", "pos", *r6("own", "beside"))


def scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Scores of cells and genes with components, and loadings."""
    rows = narrow(spark, sf_dir)
    v = cut_dealt(svd.site_values(rows))
    load = cut(svd.gene_components(v))
    return cut_dealt(svd.add_svd(score.cell_gene_scores(rows, [L1, L2]), v, load)), load


def svd_scores(spark, sf_dir):
    return scored(spark, sf_dir)[0].select("gene", "cell", *r6("svd_z0", "svd_z1", "svd_z2", "f0", "f1", "f2", "svd_z_sumsq"))


def melted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(differential.melt_scores(differential.eligible(scored(spark, sf_dir)[0], L1, L2)), CELL_ROWS)


def eligible(spark, sf_dir):
    return differential.eligible(scored(spark, sf_dir)[0], L1, L2).select("cell", "gene", "level_1", "level_2", *r6("scZ"))


def eligible_dummy(spark, sf_dir):
    """Without a first level."""
    return differential.eligible(scored(spark, sf_dir)[0], "dummy", L2).select("cell", "gene", "level_1", "level_2", *r6("scZ", "svd_z0"))


def melt_scores(spark, sf_dir):
    return melted(spark, sf_dir).select("cell", "gene", "level_1", "level_2", "z_col", *r6("z"))


def group_stats(spark, sf_dir):
    return differential.group_stats(melted(spark, sf_dir)).select(*differential.TEST, "level_2", "cells", *r6("ont_median", "ont_var"))


def tests(cells: DataFrame) -> DataFrame:
    return cut(differential.with_pvals(differential.wald_stat(cut(differential.group_stats(cells)))))


def wald_stat(spark, sf_dir):
    return differential.wald_stat(cut(differential.group_stats(melted(spark, sf_dir)))).select(*differential.TEST, "num_onts", *r6("max_abs_median", "Tn1"))


def chi2_pvals(spark, sf_dir):
    return tests(melted(spark, sf_dir)).select(*differential.TEST, *r6("pval"))


def bh_adjusted(spark, sf_dir):
    return differential.bh_adjust(tests(melted(spark, sf_dir)), "pval", "pval_adj").select(*differential.TEST, *r6("pval", "pval_adj"))


def permutation_pvals(spark, sf_dir):
    cells = melted(spark, sf_dir)
    return differential.permute(cells, tests(cells)).select(*differential.TEST, *r6("pval", "perm_pval", "perm_pval2"))


def permutation_adjusted(spark, sf_dir):
    return differential.differential_tests(scored(spark, sf_dir)[0], L1, L2).select(*differential.TEST, *r6("perm_pval2", "perm_pval2_adj"))


def wide(scores: DataFrame, level_1: str = L1) -> DataFrame:
    shares = scores.groupBy("gene").agg(*[F.max(f"f{k}").alias(f"f{k}") for k in range(3)])
    return cut(differential.widen(differential.differential_tests(scores, level_1, L2), shares))


def pvals_wide(spark, sf_dir):
    names = [f"{a}_{z}" for z in differential.SCORES for a in ("chi2_pval_adj", "perm_pval_adj", "max_abs_median", "perm_cdf")]
    return wide(scored(spark, sf_dir)[0]).select("gene", "level_1", "num_onts", *r6("f0", "f1", "f2", *names))


def _top(load: DataFrame) -> DataFrame:
    return sites.top_sites(load)


def top_sites(spark, sf_dir):
    return _top(loadings(spark, sf_dir)).select("gene", F.col("component").cast("long").alias("component"), F.col("rank").cast("long").alias("rank"), "let", "end", *r6("score"))


def all_sites(spark, sf_dir):
    return sites.all_sites(_top(loadings(spark, sf_dir))).select("gene", "let", "end")


def site_list(spark, sf_dir):
    return sites.site_list(_top(loadings(spark, sf_dir)))


def site_genes(spark, sf_dir):
    found = wide(scored(spark, sf_dir)[0])
    return sites.site_genes(found, "SS2").withColumn("library", F.lit("SS2")).unionByName(sites.site_genes(found, "10X").withColumn("library", F.lit("10X")))


def summary(spark, sf_dir):
    scores, load = scored(spark, sf_dir)
    out = sites.summarise(scores, wide(scores), _top(load), L1, L2)
    names = [f"{z}_{a}" for z in differential.SCORES for a in ("median", "pval")]
    return out.select("gene", "level_1", "level_2", "n_cells", "SpliZsites", *r6(*names))


def summary_dummy(spark, sf_dir):
    """Without a first level, all the way to the summary."""
    scores, load = scored(spark, sf_dir)
    out = sites.summarise(scores, wide(scores, "dummy"), _top(load), "dummy", L2)
    return out.select("gene", "level_1", "level_2", "n_cells", "SpliZsites", *r6(*[f"{z}_{a}" for z in differential.SCORES for a in ("median", "pval")]))


def pipeline_scores_light(spark, sf_dir):
    """Without the split scores, with a column of metadata that passes through."""
    named = cut(fixtures.junctions(spark, sf_dir), CELL_ROWS).withColumn("batch", F.concat(F.lit("B"), F.substring("cell", -1, 1)))
    scores, rows, _ = score_job(named, Params(sicilian=True, pin_s=0.1, level_1=L1, level_2=L2, light=True))
    if split := [c for c in rows.columns if c.endswith("ann") and c != "splice_ann"]:
        raise AssertionError(f"split scores in a light run: {split}")
    return scores.select("cell", "gene", L1, L2, "ontology", "batch", "n_g_Start", "n_g_End", *r6("scZ", "svd_z0", "svd_z_sumsq", "f0"))


def pipeline_scores(spark, sf_dir):
    scores, _, _ = score_job(cut(fixtures.junctions(spark, sf_dir), CELL_ROWS), Params(sicilian=True, pin_s=0.1, level_1=L1, level_2=L2))
    return scores.select("cell", "gene", L1, L2, "ontology", "n_g_Start", "n_g_End", *r6("scZ", "svd_z0", "svd_z1", "svd_z2", "svd_z_sumsq", "f0", "f1", "f2"))


def pipeline_diff(spark, sf_dir):
    params = Params(sicilian=True, pin_s=0.1, level_1=L1, level_2=L2)
    scores, _, load = score_job(cut(fixtures.junctions(spark, sf_dir), CELL_ROWS), params)
    return analysis_job(scores, load, params)[3].select("gene", "level_1", "level_2", "n_cells", "SpliZsites", *r6(*[f"{z}_{a}" for z in differential.SCORES for a in ("median", "pval")]))


QUERIES = {
    "site_values": _site_values("normdonor"),
    "site_values_normgene": _site_values("normgene"),
    "gene_gram": gene_gram,
    "svd_total_energy": svd_total_energy,
    "gene_components": gene_components,
    "svd_spectrum": svd_spectrum,
    "svd_reconstruction": svd_reconstruction,
    "svd_scores": svd_scores,
    "eligible": eligible,
    "eligible_dummy": eligible_dummy,
    "melt_scores": melt_scores,
    "group_stats": group_stats,
    "wald_stat": wald_stat,
    "chi2_pvals": chi2_pvals,
    "bh_adjusted": bh_adjusted,
    "permutation_pvals": permutation_pvals,
    "permutation_adjusted": permutation_adjusted,
    "pvals_wide": pvals_wide,
    "top_sites": top_sites,
    "all_sites": all_sites,
    "site_list": site_list,
    "site_genes": site_genes,
    "summary": summary,
    "summary_dummy": summary_dummy,
    "pipeline_scores": pipeline_scores,
    "pipeline_scores_light": pipeline_scores_light,
    "pipeline_diff": pipeline_diff,
}

_VALUES = f"""{MERGED},
sv0 AS (SELECT gene, cell, 'Start' AS let, juncStart AS pos, coalesce(numReads * nSijkStart, 0.0) AS x, numReads, n_g FROM y
        UNION ALL SELECT gene, cell, 'End', juncEnd, coalesce(numReads * nSijkEnd, 0.0), numReads, n_g FROM y),
sv AS (SELECT gene, cell, let, pos, sum(x) / sum(numReads) AS value, sum(x) / sqrt(any_value(n_g)) AS by_gene FROM sv0 GROUP BY gene, cell, let, pos)"""
_GRAM = f"""{_VALUES},
gr AS (SELECT a.gene, a.let AS let_i, a.pos AS pos_i, b.let AS let_j, b.pos AS pos_j, sum(a.value * b.value) AS g
       FROM sv a JOIN sv b ON a.gene = b.gene AND a.cell = b.cell AND (a.let < b.let OR a.let = b.let AND a.pos <= b.pos)
       WHERE a.value <> 0 AND b.value <> 0 GROUP BY ALL)"""
#: Squarings until a matrix is its first eigenvector's projector: it is the power 2 ** _SQUARINGS, over its trace.
_SQUARINGS = 20


def _svd_sql() -> str:
    """Components by repeated squaring of the centred Gram matrix, one after another: the projector's diagonal holds the squared
    loadings, and its column at the largest one their signs."""
    steps = ["""si AS MATERIALIZED (SELECT gene, let, pos, row_number() OVER (PARTITION BY gene ORDER BY let, pos) AS i FROM (SELECT DISTINCT gene, let, pos FROM sv)),
sn AS (SELECT gene, count(DISTINCT (let, pos)) AS p, count(DISTINCT cell) AS cells FROM sv GROUP BY gene HAVING least(count(DISTINCT (let, pos)), count(DISTINCT cell)) >= 3),
gi AS (SELECT gr.gene, a.i, b.i AS j, g FROM gr JOIN si a ON gr.gene = a.gene AND let_i = a.let AND pos_i = a.pos JOIN si b ON gr.gene = b.gene AND let_j = b.let AND pos_j = b.pos),
m0 AS (SELECT a.gene, a.i, b.i AS j, coalesce(gi.g, 0.0) AS g FROM si a JOIN si b ON a.gene = b.gene JOIN sn ON sn.gene = a.gene LEFT JOIN gi ON gi.gene = a.gene AND gi.i = least(a.i, b.i) AND gi.j = greatest(a.i, b.i)),
w0 AS MATERIALIZED (SELECT gene, i, j, g - avg(g) OVER (PARTITION BY gene, i) - avg(g) OVER (PARTITION BY gene, j) + avg(g) OVER (PARTITION BY gene) AS g FROM m0),
en AS (SELECT gene, sum(g) AS energy FROM w0 WHERE i = j GROUP BY gene)"""]
    over = "nullif(sum(CASE WHEN i = j THEN g ELSE 0 END) OVER (PARTITION BY gene), 0)"
    for c in range(3):
        steps.append(f"t{c}_0 AS MATERIALIZED (SELECT gene, i, j, g / {over} AS g FROM w{c})")
        for k in range(_SQUARINGS):
            steps.append(f"t{c}_{k + 1} AS MATERIALIZED (SELECT gene, i, j, g / {over} AS g FROM (SELECT a.gene, a.i, b.j, sum(a.g * b.g) AS g FROM t{c}_{k} a JOIN t{c}_{k} b ON a.gene = b.gene AND a.j = b.i GROUP BY a.gene, a.i, b.j))")
        t = f"t{c}_{_SQUARINGS}"
        steps.append(f"l{c} AS (SELECT t.gene, sum(t.g * w.g) AS l FROM {t} t JOIN w{c} w ON t.gene = w.gene AND t.i = w.i AND t.j = w.j GROUP BY t.gene)")
        steps.append(f"w{c + 1} AS MATERIALIZED (SELECT w.gene, w.i, w.j, w.g - l * t.g AS g FROM w{c} w JOIN {t} t ON t.gene = w.gene AND t.i = w.i AND t.j = w.j JOIN l{c} ON l{c}.gene = w.gene)")
        steps.append(f"d{c} AS (SELECT gene, i, g FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY round(sqrt(g), 9) DESC, i) AS place FROM {t} WHERE i = j) WHERE place = 1)")
        steps.append(f"v{c} AS (SELECT t.gene, t.i, {c} AS component, t.g / sqrt(d{c}.g) AS loading, l / energy AS f FROM {t} t JOIN d{c} ON t.gene = d{c}.gene AND t.j = d{c}.i JOIN l{c} ON l{c}.gene = t.gene JOIN en ON en.gene = t.gene)")
    steps.append("ld AS MATERIALIZED (SELECT v.gene, let, pos, component, loading, loading - avg(loading) OVER (PARTITION BY v.gene, component) AS centred, f FROM (SELECT * FROM v0 UNION ALL SELECT * FROM v1 UNION ALL SELECT * FROM v2) v JOIN si ON v.gene = si.gene AND v.i = si.i)")
    z = ", ".join(f"sum(value * centred) FILTER (component = {c}) AS svd_z{c}, any_value(f) FILTER (component = {c}) AS f{c}" for c in range(3))
    steps.append(f"zz AS MATERIALIZED (SELECT sv.gene, sv.cell, {z} FROM sv JOIN ld ON sv.gene = ld.gene AND sv.let = ld.let AND sv.pos = ld.pos GROUP BY sv.gene, sv.cell)")
    return ",\n" + ",\n".join(steps)


_SVD = f"{_GRAM}{_svd_sql()}"
_TESTED = "level_1, gene, z_col"
_SAME = lambda a, b: f"{a}.level_1 = {b}.level_1 AND {a}.gene = {b}.gene AND {a}.z_col = {b}.z_col"
_SCORED = f"""{_SVD},
k1 AS (SELECT *, row_number() OVER (PARTITION BY cell, gene ORDER BY refName_newR1) AS k FROM y),
ps AS MATERIALIZED (SELECT k1.cell, k1.gene, tissue, compartment, scZ, svd_z0, svd_z1, svd_z2, f0, f1, f2 FROM k1 LEFT JOIN zz ON k1.cell = zz.cell AND k1.gene = zz.gene WHERE k = 1)"""


def _adjusted_sql(name: str, source: str, value: str) -> str:
    """Benjamini-Hochberg of ``value`` as ``adj``."""
    return f"""{name}0 AS (SELECT {_TESTED}, {value} AS v, {value} * count(*) OVER () / count(*) OVER (ORDER BY {value} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS raw FROM {source} WHERE {value} IS NOT NULL),
{name} AS (SELECT {_TESTED}, least(1.0, min(raw) OVER (ORDER BY v DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS adj FROM {name}0)"""


_CELLS = f"""{_SCORED},
el AS (SELECT cell, gene, tissue AS level_1, compartment AS level_2, scZ, svd_z0, svd_z1, svd_z2 FROM ps WHERE (compartment, gene) IN (SELECT (compartment, gene) FROM ps GROUP BY compartment, gene HAVING count(DISTINCT cell) > 10)),
ml AS MATERIALIZED (SELECT cell, gene, level_1, level_2, 'scZ' AS z_col, scZ AS z FROM el UNION ALL SELECT cell, gene, level_1, level_2, 'svd_z0', svd_z0 FROM el
       UNION ALL SELECT cell, gene, level_1, level_2, 'svd_z1', svd_z1 FROM el UNION ALL SELECT cell, gene, level_1, level_2, 'svd_z2', svd_z2 FROM el),
gs AS (SELECT {_TESTED}, level_2, count(DISTINCT cell) AS cells, median(z) AS ont_median, var_samp(z) + 0.1 AS ont_var FROM ml GROUP BY {_TESTED}, level_2),
mn AS (SELECT {_TESTED}, count(*) AS num_onts, max(abs(ont_median)) AS max_abs_median, sum(cells / ont_var * ont_median) / sum(cells / ont_var) AS mean, count(ont_var + ont_median) = count(*) AS whole FROM gs GROUP BY {_TESTED} HAVING count(*) > 1),
wt AS (SELECT mn.level_1, mn.gene, mn.z_col, num_onts, any_value(max_abs_median) AS max_abs_median, CASE WHEN any_value(whole) THEN sum(cells / ont_var * (ont_median - mean) * (ont_median - mean)) END AS Tn1
       FROM mn JOIN gs ON {_SAME("mn", "gs")} GROUP BY mn.level_1, mn.gene, mn.z_col, num_onts),
pv AS MATERIALIZED (SELECT *, CASE WHEN Tn1 <= 0 THEN 1.0 WHEN Tn1 > 300 THEN 0.0 WHEN Tn1 IS NOT NULL THEN greatest(0.0, 1 - list_sum(list_transform(range(0, 400), lambda n: exp(((num_onts - 1) / 2.0 + n) * ln(Tn1 / 2) - Tn1 / 2 - lgamma((num_onts - 1) / 2.0 + n + 1))))) END AS pval FROM wt)"""
_PERMUTED = f"""{_CELLS},
ch AS (SELECT {_TESTED}, Tn1, CAST('0x' || substr(md5(level_1 || '|' || gene || '|' || z_col || '|123'), 1, 7) AS BIGINT) AS seed FROM pv WHERE pval < 0.05),
ce AS MATERIALIZED (SELECT ml.level_1, ml.gene, ml.z_col, level_2, z, seed, row_number() OVER (PARTITION BY ml.level_1, ml.gene, ml.z_col ORDER BY level_2, cell) - 1 AS i FROM ml JOIN ch ON {_SAME("ml", "ch")} WHERE z IS NOT NULL AND level_2 IS NOT NULL),
x0 AS (SELECT {_TESTED}, i, r, z, (seed * 48271 + r * 1566083941 + 1) % 2147483647 AS a FROM ce, range(100) q(r)),
x1 AS (SELECT *, (i * 1103515245 + a) % 2147483647 AS x FROM x0),
x2 AS (SELECT * REPLACE ((x * x + a) % 2147483647 AS x) FROM x1),
x3 AS (SELECT * REPLACE ((x * 69621 + r + i) % 2147483647 AS x) FROM x2),
x4 AS (SELECT * REPLACE ((x * x + a) % 2147483647 AS x) FROM x3),
x5 AS (SELECT {_TESTED}, r, z, row_number() OVER (PARTITION BY {_TESTED}, r ORDER BY (x * 48271 + i) % 2147483647, i) - 1 AS place FROM x4),
x6 AS (SELECT x5.level_1, x5.gene, x5.z_col, r, level_2, count(*) AS n, median(x5.z) AS mid, var_samp(x5.z) + 0.1 AS v FROM x5 JOIN ce ON {_SAME("x5", "ce")} AND place = i GROUP BY x5.level_1, x5.gene, x5.z_col, r, level_2),
x7 AS (SELECT {_TESTED}, r, sum(n / v * mid) / sum(n / v) AS mean, count(v) = count(*) AS whole FROM x6 GROUP BY {_TESTED}, r),
x8 AS (SELECT x6.level_1, x6.gene, x6.z_col, x6.r, CASE WHEN any_value(whole) THEN sum(n / v * (mid - mean) * (mid - mean)) END AS t FROM x6 JOIN x7 ON {_SAME("x6", "x7")} AND x6.r = x7.r GROUP BY x6.level_1, x6.gene, x6.z_col, x6.r),
x9 AS (SELECT x8.level_1, x8.gene, x8.z_col, count(*) FILTER (t < Tn1 * (1 - CAST(1e-9 AS DOUBLE))) / 100.0 AS perm_pval FROM x8 JOIN ch ON {_SAME("x8", "ch")} GROUP BY x8.level_1, x8.gene, x8.z_col),
pp AS MATERIALIZED (SELECT pv.*, perm_pval, 2 * least(perm_pval, 1 - perm_pval) AS perm_pval2 FROM pv LEFT JOIN x9 ON {_SAME("pv", "x9")}),
{_adjusted_sql("ac", "pp", "pval")},
{_adjusted_sql("ap", "pp", "perm_pval2")},
bh AS (SELECT pp.*, ac.adj AS pval_adj, ap.adj AS perm_pval2_adj FROM pp LEFT JOIN ac ON {_SAME("pp", "ac")} LEFT JOIN ap ON {_SAME("pp", "ap")})"""
_WIDE_COLS = {f"{name}_{z}": f"max(CASE WHEN z_col = '{z}' THEN {c} END)" for z in differential.SCORES for name, c in (("chi2_pval_adj", "pval_adj"), ("perm_pval_adj", "perm_pval2_adj"), ("max_abs_median", "max_abs_median"), ("perm_cdf", "perm_pval"))}
_WIDE = f"""{_PERMUTED},
wd AS (SELECT gene, level_1, max(num_onts) AS num_onts, {", ".join(f"{v} AS {k}" for k, v in _WIDE_COLS.items())} FROM bh GROUP BY gene, level_1)"""
_TOP = """,
tp0 AS (SELECT *, row_number() OVER (PARTITION BY gene, component ORDER BY round(loading * loading, 9) DESC, pos, let) AS rank FROM ld),
tp AS (SELECT gene, CAST(component AS BIGINT) AS component, rank, let, pos AS "end", loading * loading AS score FROM tp0 WHERE rank = 1 OR rank <= 3 AND loading * loading > 0.1)"""
_LIST = """,
ls0 AS (SELECT gene, let, "end", min(component * 10 + rank) AS k FROM tp GROUP BY gene, let, "end"),
ls AS (SELECT gene, string_agg(CAST("end" AS VARCHAR), ',' ORDER BY k, let, "end") AS SpliZsites FROM ls0 GROUP BY gene)"""
_SHARES = {f"f{c}": f"f{c}" for c in range(3)}
_SUMMARY = f"""{_WIDE}{_TOP}{_LIST},
sm AS (SELECT gene, tissue AS level_1, compartment AS level_2, count(*) AS n_cells, {", ".join(f"median({z}) AS {z}_median" for z in differential.SCORES)} FROM ps GROUP BY gene, tissue, compartment)
SELECT sm.gene, sm.level_1, level_2, n_cells, SpliZsites, {d6(**{f"{z}_median": f"{z}_median" for z in differential.SCORES}, **{f"{z}_pval": f"perm_pval_adj_{z}" for z in differential.SCORES})}
FROM sm LEFT JOIN wd ON sm.gene = wd.gene AND sm.level_1 = wd.level_1 LEFT JOIN ls ON sm.gene = ls.gene"""

ORACLE_SQL = {
    "site_values": f"{_VALUES} SELECT gene, cell, let, pos, {d6(value='value')} FROM sv",
    "site_values_normgene": f"{_VALUES} SELECT gene, cell, let, pos, {d6(value='by_gene')} FROM sv",
    "gene_gram": f"{_GRAM} SELECT gene, let_i, pos_i, let_j, pos_j, round(g, 5) + 0.0 AS g FROM gr",
    "svd_total_energy": f"{_VALUES}, rm AS (SELECT gene, cell, sum(value) AS t, sum(value * value) AS q FROM sv GROUP BY gene, cell), np AS (SELECT gene, count(DISTINCT let || pos) AS p FROM sv GROUP BY gene) SELECT rm.gene, round(sum(q - t * t / p), 4) + 0.0 AS energy FROM rm JOIN np ON rm.gene = np.gene GROUP BY rm.gene",
    "gene_components": f"{_SVD} SELECT gene, CAST(component AS BIGINT) AS component, let, pos, {d6(loading='loading', f='f')} FROM ld",
    "svd_reconstruction": f"{_SVD} SELECT a.gene, let, pos, {d6(own='a.g / energy', beside='b.g / energy')} FROM w0 a JOIN en ON en.gene = a.gene JOIN si ON si.gene = a.gene AND si.i = a.i LEFT JOIN w0 b ON b.gene = a.gene AND b.i = a.i AND b.j = a.i + 1 WHERE a.j = a.i",
    "svd_spectrum": f"{_SVD} SELECT w0.gene, least(any_value(p), any_value(cells)) AS n, CAST(1 AS DOUBLE) AS shares, round(sum(g * g) / (any_value(energy) * any_value(energy)), 6) + 0.0 AS squares, CAST(0 AS DOUBLE) AS off FROM w0 JOIN sn ON sn.gene = w0.gene JOIN en ON en.gene = w0.gene GROUP BY w0.gene",
    "svd_scores": f"{_SCORED} SELECT gene, cell, {d6(svd_z0='svd_z0', svd_z1='svd_z1', svd_z2='svd_z2', **_SHARES, svd_z_sumsq='coalesce(svd_z0 * svd_z0, 0) + coalesce(svd_z1 * svd_z1, 0) + coalesce(svd_z2 * svd_z2, 0)')} FROM ps",
    "eligible": f"{_CELLS} SELECT cell, gene, level_1, level_2, {d6(scZ='scZ')} FROM el",
    "eligible_dummy": f"{_CELLS} SELECT cell, gene, 'null' AS level_1, level_2, {d6(scZ='scZ', svd_z0='svd_z0')} FROM el",
    "melt_scores": f"{_CELLS} SELECT cell, gene, level_1, level_2, z_col, {d6(z='z')} FROM ml",
    "group_stats": f"{_CELLS} SELECT {_TESTED}, level_2, cells, {d6(ont_median='ont_median', ont_var='ont_var')} FROM gs",
    "wald_stat": f"{_CELLS} SELECT {_TESTED}, num_onts, {d6(max_abs_median='max_abs_median', Tn1='Tn1')} FROM wt",
    "chi2_pvals": f"{_CELLS} SELECT {_TESTED}, {d6(pval='pval')} FROM pv",
    "bh_adjusted": f"{_CELLS}, {_adjusted_sql('ac', 'pv', 'pval')} SELECT pv.level_1, pv.gene, pv.z_col, {d6(pval='pval', pval_adj='adj')} FROM pv LEFT JOIN ac ON {_SAME('pv', 'ac')}",
    "permutation_pvals": f"{_PERMUTED} SELECT {_TESTED}, {d6(pval='pval', perm_pval='perm_pval', perm_pval2='perm_pval2')} FROM pp",
    "permutation_adjusted": f"{_PERMUTED} SELECT {_TESTED}, {d6(perm_pval2='perm_pval2', perm_pval2_adj='perm_pval2_adj')} FROM bh",
    "pvals_wide": f"{_WIDE}, sh AS (SELECT gene, max(f0) AS f0, max(f1) AS f1, max(f2) AS f2 FROM ps GROUP BY gene) SELECT wd.gene, level_1, num_onts, {d6(**_SHARES, **{k: k for k in _WIDE_COLS})} FROM wd LEFT JOIN sh ON wd.gene = sh.gene",
    "top_sites": f'{_SVD}{_TOP} SELECT gene, component, rank, let, "end", {d6(score="score")} FROM tp',
    "all_sites": f'{_SVD}{_TOP} SELECT DISTINCT gene, let, "end" FROM tp',
    "site_list": f"{_SVD}{_TOP}{_LIST} SELECT gene, SpliZsites FROM ls",
    "site_genes": f"{_WIDE} SELECT DISTINCT gene, 'SS2' AS library FROM wd WHERE perm_pval_adj_svd_z0 < 0.05 UNION ALL SELECT DISTINCT gene, '10X' FROM wd",
    "summary": _SUMMARY,
    "pipeline_diff": _SUMMARY.replace("LEFT JOIN ls ON sm.gene = ls.gene", "LEFT JOIN ls ON sm.gene = ls.gene AND sm.gene IN (SELECT gene FROM wd)"),
    "pipeline_scores": f"{_SCORED} SELECT ps.cell, ps.gene, ps.tissue, ps.compartment, ps.tissue || ps.compartment AS ontology, n_g_Start, n_g_End, {d6(scZ='ps.scZ', svd_z0='svd_z0', svd_z1='svd_z1', svd_z2='svd_z2', svd_z_sumsq='coalesce(svd_z0 * svd_z0, 0) + coalesce(svd_z1 * svd_z1, 0) + coalesce(svd_z2 * svd_z2, 0)', **_SHARES)} FROM ps JOIN k1 ON k1.cell = ps.cell AND k1.gene = ps.gene WHERE k = 1",
}


def io_scores(spark, sf_dir):
    """Scores written as text and read again."""
    rows = merged(spark, sf_dir)
    folder = io_folder(spark)
    tables.write_scores(score.cell_gene_scores(rows, [L1, L2]), rows, folder)
    back = tables.read_tsv(spark, f"{folder}/scores.tsv", "scZ double, z double, n_g long")
    return back.select("cell", "gene", "tissue", "compartment", "n_g", *r6("z", "scZ"))


def io_score_rows(spark, sf_dir):
    """Junction rows written beside the scores and read again."""
    rows = merged(spark, sf_dir)
    folder = io_folder(spark)
    tables.write_scores(score.cell_gene_scores(rows, [L1, L2]), rows, folder)
    return spark.read.parquet(f"{folder}/junctions.parquet").select("cell", "gene", "refName_newR1", "n_g", *r6("nSijkStart", "nSijkEnd", "z", "scZ"))


def io_loadings(spark, sf_dir):
    """Loadings written and read again."""
    folder = io_folder(spark)
    tables.write_loadings(loadings(spark, sf_dir), folder)
    return spark.read.parquet(f"{folder}/loadings.parquet").select("gene", F.col("component").cast("long").alias("component"), "let", "pos", *r6("loading"))


def io_results_tests(spark, sf_dir):
    """The long table of tests as a result file."""
    folder = io_folder(spark)
    tables.write_results(folder, tests=differential.differential_tests(scored(spark, sf_dir)[0], L1, L2))
    back = tables.read_tsv(spark, f"{folder}/tests.tsv", "num_onts long, Tn1 double, pval_adj double, perm_pval2_adj double")
    return back.select(*differential.TEST, "num_onts", *r6("Tn1", "pval_adj", "perm_pval2_adj"))


def io_results_sites(spark, sf_dir):
    folder = io_folder(spark)
    tables.write_results(folder, sites=_top(loadings(spark, sf_dir)))
    back = tables.read_tsv(spark, f"{folder}/sites.tsv", "component long, rank long, end long, score double")
    return back.select("gene", "component", "rank", "let", "end", *r6("score"))


def _results(spark: SparkSession, sf_dir: str) -> str:
    scores, load = scored(spark, sf_dir)
    found, top = wide(scores), _top(load)
    folder = io_folder(spark)
    tables.write_results(folder, wide=found, sites=top, summary=sites.summarise(scores, found, top, L1, L2))
    return folder


def io_results_wide(spark, sf_dir):
    names = [f"{a}_{z}" for z in differential.SCORES for a in ("perm_pval_adj", "perm_cdf")]
    back = tables.read_tsv(spark, f"{_results(spark, sf_dir)}/wide.tsv", ", ".join(f"{n} double" for n in names))
    return back.select("gene", "level_1", *r6(*names))


def io_results_summary(spark, sf_dir):
    back = tables.read_tsv(spark, f"{_results(spark, sf_dir)}/summary.tsv", "n_cells long, scZ_median double, scZ_pval double")
    return back.select("gene", "level_1", "level_2", "n_cells", "SpliZsites", *r6("scZ_median", "scZ_pval"))


QUERIES |= {f.__name__: f for f in (io_scores, io_score_rows, io_loadings, io_results_tests, io_results_sites, io_results_wide, io_results_summary)}
ORACLE_SQL |= {
    "io_scores": f"{MERGED}, k1 AS (SELECT *, row_number() OVER (PARTITION BY cell, gene ORDER BY refName_newR1) AS k FROM y) SELECT cell, gene, tissue, compartment, n_g, {d6(z='z', scZ='scZ')} FROM k1 WHERE k = 1",
    "io_score_rows": f"{MERGED} SELECT cell, gene, refName_newR1, n_g, {d6(nSijkStart='nSijkStart', nSijkEnd='nSijkEnd', z='z', scZ='scZ')} FROM y",
    "io_loadings": f"{_SVD} SELECT gene, CAST(component AS BIGINT) AS component, let, pos, {d6(loading='loading')} FROM ld",
    "io_results_wide": f"{_WIDE} SELECT gene, level_1, {d6(**{f'{a}_{z}': f'{a}_{z}' for z in differential.SCORES for a in ('perm_pval_adj', 'perm_cdf')})} FROM wd",
    "io_results_summary": f"WITH whole AS ({_SUMMARY}) SELECT gene, level_1, level_2, n_cells, SpliZsites, scZ_median, scZ_pval FROM whole",
    "io_results_tests": f"{_PERMUTED} SELECT {_TESTED}, num_onts, {d6(Tn1='Tn1', pval_adj='pval_adj', perm_pval2_adj='perm_pval2_adj')} FROM bh",
    "io_results_sites": f'{_SVD}{_TOP} SELECT gene, component, rank, let, "end", {d6(score="score")} FROM tp',
    "summary_dummy": _SUMMARY.replace("tissue AS level_1", "'null' AS level_1").replace("GROUP BY gene, tissue, compartment", "GROUP BY gene, compartment"),
    "pipeline_scores_light": f"{_SCORED} SELECT ps.cell, ps.gene, ps.tissue, ps.compartment, ps.tissue || ps.compartment AS ontology, 'B' || right(ps.cell, 1) AS batch, n_g_Start, n_g_End, {d6(scZ='ps.scZ', svd_z0='svd_z0', svd_z_sumsq='coalesce(svd_z0 * svd_z0, 0) + coalesce(svd_z1 * svd_z1, 0) + coalesce(svd_z2 * svd_z2, 0)', f0='f0')} FROM ps JOIN k1 ON k1.cell = ps.cell AND k1.gene = ps.gene WHERE k = 1",
}

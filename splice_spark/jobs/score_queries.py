"""Queries of the scoring operators, and the same in SQL over rows (windows instead of a junction table)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splice_spark.functions.joins import cut_dealt, deal, lookup
from splice_spark.functions.lineage import CELL_ROWS, cut, shared_folder
from splice_spark.operators import score
from splice_spark.sources import fixtures, tables

PIN_S, BOUNDS = 0.1, 5
ROW = ["cell", "gene", "refName_newR1"]


def normal(spark: SparkSession, sf_dir: str, sicilian: bool = True) -> DataFrame:
    """The derived input, written once as the jobs' input table would be."""
    return cut(tables.normalise_input(fixtures.junctions(spark, sf_dir), sicilian, "tissue"), CELL_ROWS)


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.fill_gene(score.filter_called(normal(spark, sf_dir), True))


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.min_reads(score.drop_constitutive(named(spark, sf_dir)), BOUNDS)


def merged(spark: SparkSession, sf_dir: str, pin_z: float = 0.0) -> DataFrame:
    return score.score_rows(normal(spark, sf_dir), True, BOUNDS, PIN_S, pin_z)


def with_domains(rows: DataFrame) -> DataFrame:
    """Kept rows with domain columns: every third acceptor has one missing, every fourth donor one inserted."""
    missing = F.when(F.col("juncEnd") % 3000 == 1000, F.concat(F.lit("D"), F.col("juncEnd").cast("string")))
    inserted = F.when(F.col("juncStart") % 4000 == 1000, F.lit("I"))
    return rows.withColumns({"missing_domains": missing, "domain_insertions": inserted})


def io_folder(spark: SparkSession) -> str:
    """A new folder for what a query writes and reads."""
    return f"{shared_folder(spark)}/io-{uuid.uuid4().hex}"


def r6(*names: str) -> list:
    return [(F.round(F.col(n), 6) + 0.0).alias(n) for n in names]


def io_normalise(spark, sf_dir):
    out = tables.normalise_input(fixtures.junctions(spark, sf_dir).withColumn("geneR1B_uniq", F.lit("x")), False, "dummy")
    return tables.validate_columns(fixtures.junctions(spark, sf_dir), "tissue", "compartment", True) and out.select("cell", "gene", "juncStart", "juncEnd", "numReads", "called", "dummy", "refName_newR1")


def filter_called(spark, sf_dir):
    return score.filter_called(normal(spark, sf_dir, False), False).select("cell", "refName_newR1", "numReads")


def filter_called_marked(spark, sf_dir):
    return score.filter_called(normal(spark, sf_dir), True).select("cell", "refName_newR1", "numReads")


def fill_gene(spark, sf_dir):
    return named(spark, sf_dir).select(*ROW)


def gene_sign(spark, sf_dir):
    return score.gene_sign(named(spark, sf_dir)).withColumn("sign", F.col("sign").cast("long"))


def dense_ranks(spark, sf_dir):
    return score.dense_ranks(score.junction_table(named(spark, sf_dir))).select("gene", "juncStart", "juncEnd", "reads", "rows", "rank_acc", "rank_don")


def clamp_ranks(spark, sf_dir):
    k = score.clamp_ranks(score.dense_ranks(score.junction_table(named(spark, sf_dir))), 0.2)
    return k.select("gene", "juncStart", "juncEnd", *r6("rank_acc", "rank_don"))


def drop_constitutive(spark, sf_dir):
    return score.drop_constitutive(named(spark, sf_dir)).select(*ROW)


def min_reads(spark, sf_dir):
    return kept(spark, sf_dir).select(*ROW, "noncon_count")


def _sijk(side):
    def run(spark, sf_dir):
        s = score.sijk(score.junction_table(kept(spark, sf_dir)), side, PIN_S)
        return s.select("gene", "juncStart", "juncEnd", "rank", *r6("rank_mean", "S", "S_unpinned"))

    return run


def _gene_norm(side):
    def run(spark, sf_dir):
        s = score.normalise_sijk(score.sijk(score.junction_table(kept(spark, sf_dir)), side, PIN_S))
        return s.select("gene", "juncStart", "juncEnd", *r6("gene_mean", "gene_var", "nSijk"))

    return run


def _side_z(side):
    def run(spark, sf_dir):
        return score.side_z(merged(spark, sf_dir), side).select("cell", "gene", "n_g", *r6("z", "scaled_z"))

    return run


def merge_sides(spark, sf_dir):
    return merged(spark, sf_dir).select(*ROW, "n_g", "n_g_Start", "n_g_End", *r6("nSijkStart", "nSijkEnd", "z_Start", "z_End", "z", "scZ"))


def pinned_z(spark, sf_dir):
    return merged(spark, sf_dir, 0.05).select(*ROW, *r6("z_Start", "z_End", "z", "scZ"))


def cell_gene_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: one row for a cell and gene."""
    out = score.cell_gene_scores(merged(spark, sf_dir), ["tissue", "compartment"])
    return out.select("cell", "gene", "tissue", "compartment", "n_g", "n_g_Start", "n_g_End", *r6("z", "scZ"))


def _top(side):
    def run(spark, sf_dir):
        return score.top_junction(merged(spark, sf_dir), side).select("cell", "gene", "junc_max", *r6("max_don_z"))

    return run


def split_z(spark, sf_dir):
    out = score.add_split_z(merged(spark, sf_dir))
    return out.select(*ROW, *r6("z_Start_ann", "z_End_ann", "z_Start_unann", "z_End_unann", "cov_ann", "cov_unann", "z_ann", "z_unann"))


def split_z_pinned(spark, sf_dir):
    out = score.add_split_z(merged(spark, sf_dir), 0.05)
    return out.select(*ROW, *r6("z_Start_ann", "z_End_ann", "z_Start_unann", "z_End_unann", "z_ann", "z_unann"))


def drop_constitutive_clamped(spark, sf_dir):
    return score.drop_constitutive(named(spark, sf_dir), 0.2).select(*ROW)


def domain_change(spark, sf_dir):
    """Of both sides, in one table."""
    rows = with_domains(kept(spark, sf_dir))
    return score.domain_change(rows, "Start").withColumnRenamed("juncStart", "pos").withColumn("side", F.lit("Start")).unionByName(score.domain_change(rows, "End").withColumnRenamed("juncEnd", "pos").withColumn("side", F.lit("End")))


def domain_split_z(spark, sf_dir):
    dealt = deal(named(spark, sf_dir).drop("tissue", "compartment", "splice_ann", "chrR1A", "called"))
    rows = cut_dealt(with_domains(score.min_reads(score.drop_constitutive(dealt), BOUNDS)))
    out = score.add_z(lookup(score.merge_sides(rows, PIN_S), score.gene_sign(dealt), ["gene"]))
    for side in score.SIDES:
        out = lookup(out, score.domain_change(rows, side).withColumnRenamed("domain_changed", f"domain_{side}"), ["gene", f"junc{side}"], "left")
    out = score.add_split_z(out, 0.0, "domain_{side}", ("dom_ch", "dom_unch"))
    return out.select(*ROW, *r6("z_dom_ch", "z_dom_unch"))


def gene_cov(spark, sf_dir):
    return score.gene_cov(merged(spark, sf_dir)).select("gene", *r6("cov"))


def contributions(spark, sf_dir):
    return score.contributions(merged(spark, sf_dir), "tissue", "compartment").select(*ROW, "ontology", *r6("scaled_z", "zcontribStart", "zcontribEnd"))


QUERIES = {
    "io_normalise": io_normalise,
    "filter_called": filter_called,
    "filter_called_marked": filter_called_marked,
    "fill_gene": fill_gene,
    "gene_sign": gene_sign,
    "dense_ranks": dense_ranks,
    "clamp_ranks": clamp_ranks,
    "drop_constitutive": drop_constitutive,
    "min_reads": min_reads,
    "sijk_start": _sijk("Start"),
    "sijk_end": _sijk("End"),
    "gene_norm_start": _gene_norm("Start"),
    "gene_norm_end": _gene_norm("End"),
    "side_z_start": _side_z("Start"),
    "side_z_end": _side_z("End"),
    "merge_sides": merge_sides,
    "pinned_z": pinned_z,
    "cell_gene_scores": cell_gene_scores,
    "top_junction_start": _top("Start"),
    "top_junction_end": _top("End"),
    "split_z": split_z,
    "split_z_pinned": split_z_pinned,
    "drop_constitutive_clamped": drop_constitutive_clamped,
    "domain_change": domain_change,
    "domain_split_z": domain_split_z,
    "gene_cov": gene_cov,
    "contributions": contributions,
}

# SQL: common table expressions, a stage each, that later queries build on.

BASE = f"""
WITH j AS ({fixtures.duck(fixtures.JUNCTIONS)}),
n AS (SELECT cell, refName_newR1, geneR1A_uniq AS gene0, juncPosR1A AS juncStart, juncPosR1B AS juncEnd, chrR1A, splice_ann, tissue, compartment, numReads, called FROM j),
c AS (SELECT * FROM n WHERE called = 1),
g1 AS (SELECT *, CASE WHEN gene0 IS NULL OR gene0 IN ('', 'unknown') THEN split_part(split_part(refName_newR1, '|', 2), ':', 2) ELSE gene0 END AS gene1 FROM c),
g AS (SELECT * EXCLUDE (gene0, gene1), CASE WHEN gene1 IS NULL OR gene1 IN ('', 'unknown') THEN 'unknown_' || chrR1A || '_' || CAST(juncStart - juncStart % 100000 AS VARCHAR) ELSE gene1 END AS gene FROM g1),
sg AS (SELECT gene, CASE WHEN arg_min(CASE WHEN split_part(split_part(refName_newR1, '|', 1), ':', 4) = '?' THEN split_part(split_part(refName_newR1, '|', 2), ':', 4) ELSE split_part(split_part(refName_newR1, '|', 1), ':', 4) END, refName_newR1) = '-' THEN -1 ELSE 1 END AS sign FROM g GROUP BY gene),
rk AS (SELECT *, dense_rank() OVER (PARTITION BY gene, juncStart ORDER BY juncEnd) AS rank_acc, dense_rank() OVER (PARTITION BY gene, juncEnd ORDER BY juncStart) AS rank_don FROM g),
nc AS (SELECT * FROM (SELECT *, max(rank_acc) OVER (PARTITION BY gene, juncStart) AS ma, max(rank_don) OVER (PARTITION BY gene, juncEnd) AS md FROM rk) WHERE ma > 1 OR md > 1),
m AS (SELECT * FROM (SELECT *, CAST(sum(numReads) OVER (PARTITION BY cell, gene) AS BIGINT) AS noncon_count FROM nc) WHERE noncon_count > {BOUNDS})"""


def side_sql(side: str, source: str = "m") -> str:
    other = {"Start": "End", "End": "Start"}[side]
    by = f"PARTITION BY gene, junc{side}"
    return f""",
a_{side} AS (SELECT *, dense_rank() OVER ({by} ORDER BY junc{other}) AS rnk FROM {source}),
b_{side} AS (SELECT * FROM (SELECT *, max(rnk) OVER ({by}) AS mr FROM a_{side}) WHERE mr > 1),
c_{side} AS (SELECT *, sum(numReads * rnk) OVER ({by}) / CAST(sum(numReads) OVER ({by}) AS DOUBLE) AS rank_mean FROM b_{side}),
d_{side} AS (SELECT *, sum(numReads * (rnk - rank_mean) * (rnk - rank_mean)) OVER ({by}) / sum(numReads) OVER ({by}) AS v FROM c_{side}),
e_{side} AS (SELECT *, CASE WHEN v > 1e-12 THEN (rnk - rank_mean) / sqrt(v) END AS su FROM d_{side}),
q_{side} AS (SELECT quantile_cont(su, {PIN_S}) AS lo, quantile_cont(su, {1 - PIN_S}) AS hi FROM e_{side}),
f_{side} AS (SELECT e.*, CASE WHEN v > 1e-12 THEN greatest(lo, least(hi, su)) ELSE 0.0 END AS s FROM e_{side} e, q_{side}),
h_{side} AS (SELECT *, sum(numReads * s) OVER (PARTITION BY gene) / sum(numReads) OVER (PARTITION BY gene) AS gene_mean FROM f_{side}),
i_{side} AS (SELECT *, sum(numReads * (s - gene_mean) * (s - gene_mean)) OVER (PARTITION BY gene) / sum(numReads) OVER (PARTITION BY gene) AS gene_var FROM h_{side}),
s_{side} AS (SELECT *, (s - gene_mean) / sqrt(gene_var) AS ns, CAST(sum(numReads) OVER (PARTITION BY cell, gene) AS BIGINT) AS n_g FROM i_{side} WHERE gene_var > 1e-12),
z_{side} AS (SELECT s.*, sign, sign * sum(numReads * ns) OVER (PARTITION BY cell, s.gene) / sqrt(n_g) AS z FROM s_{side} s JOIN sg ON s.gene = sg.gene),
cg_{side} AS (SELECT cell, gene, any_value(n_g) AS n_g, any_value(z) AS z, any_value(z / sqrt(n_g)) AS scaled_z FROM z_{side} GROUP BY cell, gene)"""


SIDES_SQL = side_sql("Start") + side_sql("End")
BOTH = "CASE WHEN {a} IS NULL THEN -{b} WHEN {b} IS NULL THEN {a} ELSE ({a} - {b}) / sqrt(2.0) END"
MERGED = f"""{BASE}{SIDES_SQL},
o AS (
    SELECT coalesce(a.cell, b.cell) AS cell, coalesce(a.gene, b.gene) AS gene, coalesce(a.refName_newR1, b.refName_newR1) AS refName_newR1,
           coalesce(a.numReads, b.numReads) AS numReads, coalesce(a.juncStart, b.juncStart) AS juncStart, coalesce(a.juncEnd, b.juncEnd) AS juncEnd,
           coalesce(a.tissue, b.tissue) AS tissue, coalesce(a.compartment, b.compartment) AS compartment,
           a.ns AS nSijkStart, b.ns AS nSijkEnd, a.n_g AS n_g_Start, b.n_g AS n_g_End
    FROM s_Start a FULL JOIN s_End b ON a.cell = b.cell AND a.gene = b.gene AND a.refName_newR1 = b.refName_newR1
),
x AS (
    SELECT o.*, p.z AS z_Start, q.z AS z_End, p.scaled_z AS sc_Start, q.scaled_z AS sc_End, CAST(sum(numReads) OVER (PARTITION BY o.cell, o.gene) AS BIGINT) AS n_g
    FROM o LEFT JOIN cg_Start p ON o.cell = p.cell AND o.gene = p.gene LEFT JOIN cg_End q ON o.cell = q.cell AND o.gene = q.gene
),
y AS (SELECT *, {BOTH.format(a="z_Start", b="z_End")} AS z, {BOTH.format(a="sc_Start", b="sc_End")} AS scZ FROM x)"""


def d6(**columns: str) -> str:
    return ", ".join(f"round({sql}, 6) + 0.0 AS {name}" for name, sql in columns.items())


def _split_sql(flag: str, names: tuple[str, str], source: str, quantile: float = 0.0) -> str:
    parts, pinned = [], {}
    for side in ("Start", "End"):
        f = flag.format(side=side)
        parts.append(
            f"""w_{side} AS (SELECT cell, gene, refName_newR1, {", ".join(f"sign * sum(CASE WHEN {f} = {v} THEN s * CASE WHEN v > 1e-12 THEN numReads ELSE 0 END END) OVER (PARTITION BY cell, gene) / nullif(sqrt(sum(CASE WHEN v > 1e-12 THEN numReads ELSE 0 END) OVER (PARTITION BY cell, gene)), 0) AS {n}" for v, n in zip(("true", "false"), names, strict=True))} FROM {source.format(side=side)})"""
        )
    cols = ", ".join(f"a.{n} AS z_Start_{n}, b.{n} AS z_End_{n}" for n in names)
    if quantile:
        pinned = {c: f"CASE WHEN {c} IS NOT NULL THEN greatest((SELECT quantile_cont({c}, {quantile}) FROM u0), least((SELECT quantile_cont({c}, {1 - quantile}) FROM u0), {c})) END" for n in names for c in (f"z_Start_{n}", f"z_End_{n}")}
    shown = ", ".join(f"{v} AS {k}" for k, v in pinned.items())
    covs = ", ".join(f"CASE WHEN count(z_Start_{n} + z_End_{n}) > 1 THEN covar_samp(z_Start_{n}, z_End_{n}) END AS cov_{n}" for n in names)
    return f""", {", ".join(parts)},
u0 AS (SELECT o.cell, o.gene, o.refName_newR1, {cols} FROM o LEFT JOIN w_Start a USING (cell, gene, refName_newR1) LEFT JOIN w_End b USING (cell, gene, refName_newR1)),
u AS (SELECT {"cell, gene, refName_newR1, " + shown if quantile else "*"} FROM u0),
cv AS (SELECT gene, {covs} FROM u GROUP BY gene)"""


def _split_z_sql(n: str) -> str:
    return f"CASE WHEN z_Start_{n} IS NOT NULL AND z_End_{n} IS NOT NULL THEN (z_Start_{n} - z_End_{n}) / sqrt(2.0) - cov_{n} WHEN z_Start_{n} IS NULL THEN -z_End_{n} ELSE z_Start_{n} END"


DOMAINS = """,
dm AS (SELECT *, CASE WHEN juncEnd % 3000 = 1000 THEN 'D' || CAST(juncEnd AS VARCHAR) END AS missing_domains, CASE WHEN juncStart % 4000 = 1000 THEN 'I' END AS domain_insertions FROM m),
dc AS (SELECT gene, juncStart AS pos, 'Start' AS side, count(DISTINCT missing_domains) + count(DISTINCT domain_insertions) > 0 AS domain_changed FROM dm GROUP BY gene, juncStart
       UNION ALL SELECT gene, juncEnd, 'End', count(DISTINCT missing_domains) + count(DISTINCT domain_insertions) > 0 FROM dm GROUP BY gene, juncEnd)"""


def _top_sql(side: str) -> str:
    share = "s * CASE WHEN v > 1e-12 THEN numReads ELSE 0 END / nullif(sqrt(sum(CASE WHEN v > 1e-12 THEN numReads ELSE 0 END) OVER (PARTITION BY cell, gene)), 0)"
    return f"""{BASE}{SIDES_SQL}, sh AS (SELECT cell, gene, refName_newR1, {share} AS share FROM z_{side}),
rn AS (SELECT *, row_number() OVER (PARTITION BY cell, gene ORDER BY -round(abs(share), 9), refName_newR1) AS k FROM sh WHERE share IS NOT NULL)
SELECT cell, gene, refName_newR1 AS junc_max, {d6(max_don_z="share")} FROM rn WHERE k = 1"""


def _sides(make) -> dict[str, str]:
    return {side.lower(): make(side) for side in ("Start", "End")}


_PZ = """,
pq_{s} AS (SELECT quantile_cont(z, 0.05) AS lo, quantile_cont(z, 0.95) AS hi FROM z_{s})"""

ORACLE_SQL = {
    "io_normalise": f"WITH j AS ({fixtures.duck(fixtures.JUNCTIONS)}) SELECT cell, geneR1A_uniq AS gene, juncPosR1A AS juncStart, juncPosR1B AS juncEnd, numReads, 1 AS called, 'null' AS dummy, refName_newR1 FROM j",
    "filter_called": f"{BASE} SELECT cell, refName_newR1, numReads FROM (SELECT *, sum(numReads) OVER (PARTITION BY refName_newR1) AS t FROM n) WHERE t > 1",
    "filter_called_marked": f"{BASE} SELECT cell, refName_newR1, numReads FROM c",
    "fill_gene": f"{BASE} SELECT cell, gene, refName_newR1 FROM g",
    "gene_sign": f"{BASE} SELECT gene, CAST(sign AS BIGINT) AS sign FROM sg",
    "dense_ranks": f"{BASE} SELECT gene, juncStart, juncEnd, CAST(sum(numReads) AS BIGINT) AS reads, count(*) AS rows, CAST(any_value(rank_acc) AS DOUBLE) AS rank_acc, CAST(any_value(rank_don) AS DOUBLE) AS rank_don FROM rk GROUP BY gene, juncStart, juncEnd",
    "clamp_ranks": f"""{BASE}, qa AS (SELECT gene, juncStart, quantile_cont(rank_acc, 0.2) AS lo, quantile_cont(rank_acc, 0.8) AS hi FROM rk GROUP BY gene, juncStart),
qd AS (SELECT gene, juncEnd, quantile_cont(rank_don, 0.2) AS lo, quantile_cont(rank_don, 0.8) AS hi FROM rk GROUP BY gene, juncEnd)
SELECT DISTINCT gene, juncStart, juncEnd, {d6(rank_acc="least(qa.hi, greatest(qa.lo, rank_acc)) - qa.lo + 1", rank_don="least(qd.hi, greatest(qd.lo, rank_don)) - qd.lo + 1")} FROM rk JOIN qa USING (gene, juncStart) JOIN qd USING (gene, juncEnd)""",
    "drop_constitutive": f"{BASE} SELECT cell, gene, refName_newR1 FROM nc",
    "min_reads": f"{BASE} SELECT cell, gene, refName_newR1, noncon_count FROM m",
    **{f"sijk_{k}": v for k, v in _sides(lambda s: f"{BASE}{SIDES_SQL} SELECT DISTINCT gene, juncStart, juncEnd, CAST(rnk AS DOUBLE) AS rank, {d6(rank_mean='rank_mean', S='s', S_unpinned='su')} FROM f_{s}").items()},
    **{f"gene_norm_{k}": v for k, v in _sides(lambda s: f"{BASE}{SIDES_SQL} SELECT DISTINCT gene, juncStart, juncEnd, {d6(gene_mean='gene_mean', gene_var='gene_var', nSijk='ns')} FROM s_{s}").items()},
    **{f"side_z_{k}": v for k, v in _sides(lambda s: f"{BASE}{SIDES_SQL} SELECT cell, gene, n_g, {d6(z='z', scaled_z='scaled_z')} FROM cg_{s}").items()},
    "merge_sides": f"{MERGED} SELECT cell, gene, refName_newR1, n_g, n_g_Start, n_g_End, {d6(nSijkStart='nSijkStart', nSijkEnd='nSijkEnd', z_Start='z_Start', z_End='z_End', z='z', scZ='scZ')} FROM y",
    "pinned_z": f"""{MERGED}{_PZ.format(s="Start")}{_PZ.format(s="End")},
pz AS (SELECT y.cell, y.gene, y.refName_newR1, y.scZ, greatest(a.lo, least(a.hi, z_Start)) AS za, greatest(b.lo, least(b.hi, z_End)) AS zb, z_Start, z_End FROM y, pq_Start a, pq_End b),
pp AS (SELECT cell, gene, refName_newR1, scZ, CASE WHEN z_Start IS NOT NULL THEN za END AS z_Start, CASE WHEN z_End IS NOT NULL THEN zb END AS z_End FROM pz)
SELECT cell, gene, refName_newR1, {d6(z_Start='z_Start', z_End='z_End', z=BOTH.format(a='z_Start', b='z_End'), scZ='scZ')} FROM pp""",
    "cell_gene_scores": f"""{MERGED}, k1 AS (SELECT *, row_number() OVER (PARTITION BY cell, gene ORDER BY refName_newR1) AS k FROM y)
SELECT cell, gene, tissue, compartment, n_g, n_g_Start, n_g_End, {d6(z='z', scZ='scZ')} FROM k1 WHERE k = 1""",
    **{f"top_junction_{k}": v for k, v in _sides(_top_sql).items()},
    "split_z": f"""{MERGED}{_split_sql("splice_ann", ("ann", "unann"), "z_{side}")}
SELECT cell, u.gene, refName_newR1, {d6(**{c: c for c in ("z_Start_ann", "z_End_ann", "z_Start_unann", "z_End_unann", "cov_ann", "cov_unann")}, z_ann=_split_z_sql("ann"), z_unann=_split_z_sql("unann"))} FROM u JOIN cv ON u.gene = cv.gene""",
    "split_z_pinned": f"""{MERGED}{_split_sql("splice_ann", ("ann", "unann"), "z_{side}", 0.05)}
SELECT cell, u.gene, refName_newR1, {d6(**{c: c for c in ("z_Start_ann", "z_End_ann", "z_Start_unann", "z_End_unann")}, z_ann=_split_z_sql("ann"), z_unann=_split_z_sql("unann"))} FROM u JOIN cv ON u.gene = cv.gene""",
    "drop_constitutive_clamped": f"""{BASE}, qa AS (SELECT gene, juncStart, quantile_cont(rank_acc, 0.2) AS lo, quantile_cont(rank_acc, 0.8) AS hi FROM rk GROUP BY gene, juncStart),
qd AS (SELECT gene, juncEnd, quantile_cont(rank_don, 0.2) AS lo, quantile_cont(rank_don, 0.8) AS hi FROM rk GROUP BY gene, juncEnd),
qc AS (SELECT cell, gene, refName_newR1, max(least(qa.hi, greatest(qa.lo, rank_acc)) - qa.lo + 1) OVER (PARTITION BY gene, juncStart) AS ma, max(least(qd.hi, greatest(qd.lo, rank_don)) - qd.lo + 1) OVER (PARTITION BY gene, juncEnd) AS md FROM rk JOIN qa USING (gene, juncStart) JOIN qd USING (gene, juncEnd))
SELECT cell, gene, refName_newR1 FROM qc WHERE ma > 1 OR md > 1""",
    "domain_change": f"{BASE}{DOMAINS} SELECT gene, pos, side, domain_changed FROM dc",
    "domain_split_z": f"""{MERGED}{DOMAINS}, zd_Start AS (SELECT z.*, domain_changed FROM z_Start z JOIN dc ON dc.side = 'Start' AND dc.gene = z.gene AND dc.pos = juncStart), zd_End AS (SELECT z.*, domain_changed FROM z_End z JOIN dc ON dc.side = 'End' AND dc.gene = z.gene AND dc.pos = juncEnd)
{_split_sql("domain_changed", ("dom_ch", "dom_unch"), "zd_{side}")}
SELECT cell, u.gene, refName_newR1, {d6(z_dom_ch=_split_z_sql("dom_ch"), z_dom_unch=_split_z_sql("dom_unch"))} FROM u JOIN cv ON u.gene = cv.gene""",
    "gene_cov": f"{MERGED} SELECT gene, {d6(cov='CASE WHEN count(z_Start + z_End) > 1 THEN covar_samp(z_Start, z_End) END')} FROM y GROUP BY gene",
    "contributions": f"{MERGED} SELECT cell, gene, refName_newR1, tissue || compartment AS ontology, {d6(scaled_z='z / sqrt(n_g)', zcontribStart='numReads * nSijkStart / sqrt(n_g)', zcontribEnd='numReads * nSijkEnd / sqrt(n_g)')} FROM y",
}

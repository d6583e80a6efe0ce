"""The three jobs end to end: reads to counts, counts to scores, scores to tests, sites and summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splice_spark.functions.joins import cut_dealt, dealt_by
from splice_spark.functions.lineage import cut
from splice_spark.operators import annotate, counts, differential, reads, score, sites, svd
from splice_spark.sources import tables


@dataclass(frozen=True)
class Params:
    """Parameters of all jobs, with their defaults; impossible values are refused."""

    sicilian: bool = False
    pin_s: float = 0.01
    pin_z: float = 0.0
    bounds: int = 5
    light: bool = False
    svd_type: str = "normdonor"
    n_perms: int = 100
    rank_quant: float = 0.0
    level_1: str = "dummy"
    level_2: str = "ontology"
    library: str = "10X"
    stranded: bool = False
    seed: int = 123

    def __post_init__(self):
        if self.library not in counts.LIBRARIES:
            raise ValueError(f"library must be one of {counts.LIBRARIES}")
        if self.svd_type not in svd.TYPES:
            raise ValueError(f"svd_type must be one of {svd.TYPES}")
        if not (0 <= self.pin_s <= 0.5 and 0 <= self.pin_z <= 0.5 and 0 <= self.rank_quant <= 0.5):
            raise ValueError("quantiles must be between 0 and 0.5")
        if self.bounds < 0 or self.n_perms < 1:
            raise ValueError("bounds must be 0 or more and n_perms 1 or more")


def count_job(aligned: DataFrame, gtf: DataFrame, meta: DataFrame, exon_bounds: DataFrame, splices: DataFrame, params: Params) -> DataFrame:
    """Aligned reads to the annotated table of reads by cell and junction."""
    spliced = reads.class_input(aligned, gtf, params.library, params.stranded)
    table = counts.attach_meta(counts.junction_table(spliced, params.library), meta)
    return annotate.annotate_splices(annotate.annotate_exons(table, exon_bounds), splices)


def score_job(junctions: DataFrame, params: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores by cell and gene, junction rows, and loadings.

    Rows are written once, with all that takes a window; what is returned adds to them what a row and its gene's covariances give.
    """
    levels = [c for c in dict.fromkeys((params.level_1, params.level_2))]
    checked = tables.validate_columns(junctions, params.level_1, params.level_2, params.sicilian)
    normal = tables.normalise_input(checked, params.sicilian, params.level_1)
    chain = (normal, params.sicilian, params.bounds, params.pin_s, params.pin_z, params.rank_quant)
    stored = score.score_rows(*chain) if params.light else score.split_z(score.unwritten_rows(*chain), params.pin_z)
    rows = score.contributions(stored if params.light else score.combine_split(stored, sides=True), params.level_1, params.level_2)
    values = cut_dealt(svd.site_values(stored, params.svd_type))
    loadings = cut(svd.gene_components(values))
    known = {*tables.REQUIRED, "called", "gene", "juncStart", "juncEnd", "dummy"}
    carried = [*levels, "ontology", *[c for c in normal.columns if c not in known and c not in levels]]
    scores = svd.add_svd(score.cell_gene_scores(score.contributions(stored, params.level_1, params.level_2), carried), values, loadings)
    return scores.drop(*dealt_by(scores)), rows.drop(*dealt_by(rows)), loadings


def analysis_job(scores: DataFrame, loadings: DataFrame, params: Params) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Long and wide p-values, sites, and the summary."""
    scores = cut(scores)
    tests = differential.differential_tests(scores, params.level_1, params.level_2, params.n_perms, params.seed)
    shares = scores.groupBy("gene").agg(*[F.max(f"f{k}").alias(f"f{k}") for k in range(3)])
    wide = cut(differential.widen(tests, shares))
    found = sites.top_sites(loadings.filter("component < 3").join(sites.site_genes(wide, params.library), "gene", "left_semi"))
    return tests, wide, found, sites.summarise(scores, wide, found, params.level_1, params.level_2)

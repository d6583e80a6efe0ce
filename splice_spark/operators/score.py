"""Standardised splicing scores.

A side is ``Start`` (donors rank their acceptors) or ``End`` (acceptors rank
their donors).  Ranks, means, variances and standardised values depend only on
the junction, so they are computed on the junction table ``K(gene, juncStart,
juncEnd; reads, rows)``, which is smaller than the cell rows by orders of
magnitude, and joined back by ``lookup``: by broadcast while the table is small,
and with hot junctions and genes left in place beyond.  Quantiles over rows are
weighted by ``rows``.  Else cell rows are shuffled by (cell, gene) only.

Missing values are null, never NaN; a variance of 1e-12 or less is zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splice_spark.functions.joins import by_cell, cut_dealt, deal, dealt_by, lookup
from splice_spark.functions.lineage import cut
from splice_spark.functions.names import GENE, STRAND, name_part
from splice_spark.functions.quantiles import weighted_quantiles

SIDES = ("Start", "End")
OTHER = {"Start": "End", "End": "Start"}
JUNCTION = ["gene", "juncStart", "juncEnd"]
#: What the chain reads of named rows, and what scores and components read of merged ones.
CHAIN = ["cell", "refName_newR1", "numReads", *JUNCTION]
MERGED = [*CHAIN, *[f"{c}{s}" for c in ("nSijk", "n_g_") for s in SIDES], "n_g", "z", "scZ"]
ZERO = 1e-12


def filter_called(junctions: DataFrame, sicilian: bool = False) -> DataFrame:
    """Trusted junctions: marked as called, or with more than one read in all cells together."""
    if sicilian:
        return junctions.filter("called = 1")
    seen = junctions.groupBy("refName_newR1").agg(F.sum("numReads").alias("n")).filter("n > 1").select("refName_newR1")
    return lookup(junctions, seen, ["refName_newR1"])


def _unknown(gene: Column) -> Column:
    return gene.isNull() | gene.isin("unknown", "")


def fill_gene(junctions: DataFrame, bin_size: int = 100_000) -> DataFrame:
    """An unknown gene becomes that of the second end, or else a bin of its chromosome."""
    gene = F.when(_unknown(F.col("gene")), name_part("refName_newR1", 1, GENE)).otherwise(F.col("gene"))
    place = F.concat_ws("_", F.lit("unknown"), F.col("chrR1A").cast("string"), (F.col("juncStart") - F.col("juncStart") % bin_size).cast("string"))
    return junctions.withColumn("gene", gene).withColumn("gene", F.when(_unknown(F.col("gene")), place).otherwise(F.col("gene")))


def gene_sign(junctions: DataFrame) -> DataFrame:
    """``gene, sign``: -1 if the gene's first junction by name is on the minus strand (of its second end where the first's is unknown)."""
    first, second = name_part("refName_newR1", 0, STRAND), name_part("refName_newR1", 1, STRAND)
    strand = F.when(first == "?", second).otherwise(first)
    names = junctions.select("gene", "refName_newR1").distinct()  # by hash; the arg-min over strings sorts names only
    return names.groupBy("gene").agg(F.min_by(strand, "refName_newR1").alias("strand")).select("gene", F.when(F.col("strand") == "-", -1).otherwise(1).alias("sign"))


def junction_table(junctions: DataFrame) -> DataFrame:
    """``gene, juncStart, juncEnd, reads, rows``."""
    return junctions.groupBy(*JUNCTION).agg(F.sum("numReads").alias("reads"), F.count("*").alias("rows"))


def dense_ranks(k: DataFrame) -> DataFrame:
    """``k`` with the rank of the acceptor for its donor and of the donor for its acceptor."""
    return k.withColumns({name: F.dense_rank().over(Window.partitionBy("gene", f"junc{s}").orderBy(f"junc{OTHER[s]}")).cast("double") for s, name in (("Start", "rank_acc"), ("End", "rank_don"))})


def clamp_ranks(k: DataFrame, quantile: float) -> DataFrame:
    """Ranks held between the quantiles (over cell rows) of their group, the lower one shifted to 1; nothing to do at 0."""
    if quantile <= 0:
        return k
    for side, name in (("Start", "rank_acc"), ("End", "rank_don")):
        key = ["gene", f"junc{side}"]
        q = k.groupBy(*key).agg(F.percentile(name, F.array(F.lit(quantile), F.lit(1 - quantile)), F.col("rows")).alias("q"))
        low, high = F.col("q")[0], F.col("q")[1]
        k = k.join(q, key).withColumn(name, F.least(high, F.greatest(low, F.col(name))) - low + 1).drop("q")
    return k


def drop_constitutive(junctions: DataFrame, quantile: float = 0.0) -> DataFrame:
    """Rows of junctions whose donor or acceptor has a highest rank above 1."""
    k = clamp_ranks(dense_ranks(junction_table(junctions)), quantile)
    most = lambda s, name: F.max(name).over(Window.partitionBy("gene", f"junc{s}"))
    keep = k.withColumns({"a": most("Start", "rank_acc"), "d": most("End", "rank_don")}).filter("a > 1 or d > 1").select(*JUNCTION)
    return lookup(junctions, keep, JUNCTION)


def min_reads(junctions: DataFrame, bounds: int = 5) -> DataFrame:
    """Rows of cells with more than ``bounds`` remaining reads in the gene."""
    total = F.sum("numReads").over(Window.partitionBy(*by_cell(junctions)))
    return junctions.withColumn("noncon_count", total).filter(F.col("noncon_count") > bounds)


def pin(df: DataFrame, name: str, quantile: float, freq: str | Column, where: Column | None = None) -> DataFrame:
    """``name`` held between its global quantiles, each value counting ``freq`` times; nulls stay null."""
    ends = weighted_quantiles(df if where is None else df.filter(where), name, freq, [quantile, 1 - quantile])
    if ends is None:
        return df
    held = F.greatest(F.lit(ends[0]), F.least(F.lit(ends[1]), F.col(name)))
    return df.withColumn(name, F.when(F.col(name).isNotNull(), held))


def side_ranks(k: DataFrame, side: str) -> DataFrame:
    """Junctions of groups with two or more partners, with the partner's dense rank among those that are left."""
    group = Window.partitionBy("gene", f"junc{side}")
    ranked = k.withColumn("rank", F.dense_rank().over(group.orderBy(f"junc{OTHER[side]}")).cast("double"))
    return ranked.withColumn("max_rank", F.max("rank").over(group)).filter("max_rank > 1").drop("max_rank")


def sijk(k: DataFrame, side: str, pin_s: float = 0.01) -> DataFrame:
    """Standardised ranks of a side: ``S_unpinned``, ``S`` (pinned over cell rows; 0 without variance) and ``flat``."""
    group = Window.partitionBy("gene", f"junc{side}")
    mean = F.try_divide(F.sum(F.col("reads") * F.col("rank")).over(group), F.sum("reads").over(group))
    out = side_ranks(k, side).withColumn("rank_mean", mean)
    var = F.try_divide(F.sum(F.col("reads") * (F.col("rank") - F.col("rank_mean")) ** 2).over(group), F.sum("reads").over(group))
    out = out.withColumn("var", var).withColumn("flat", F.coalesce(F.col("var") <= ZERO, F.lit(True)))
    out = out.withColumn("S_unpinned", F.when(~F.col("flat"), F.try_divide(F.col("rank") - F.col("rank_mean"), F.sqrt("var"))))
    out = pin(cut(out.withColumn("S", F.col("S_unpinned"))), "S", pin_s, "rows")  # read for the quantiles, and again
    return out.withColumn("S", F.when(F.col("flat"), 0.0).otherwise(F.col("S")))


def normalise_sijk(s: DataFrame) -> DataFrame:
    """``nSijk``: S standardised by the gene's read-weighted mean and variance; genes without variance go."""
    gene = Window.partitionBy("gene")
    out = s.withColumn("gene_mean", F.try_divide(F.sum(F.col("reads") * F.col("S")).over(gene), F.sum("reads").over(gene)))
    out = out.withColumn("gene_var", F.try_divide(F.sum(F.col("reads") * (F.col("S") - F.col("gene_mean")) ** 2).over(gene), F.sum("reads").over(gene)))
    return out.filter(F.col("gene_var") > ZERO).withColumn("nSijk", (F.col("S") - F.col("gene_mean")) / F.sqrt("gene_var"))


def domain_change(junctions: DataFrame, side: str) -> DataFrame:
    """``gene, junc<side>, domain_changed``: whether any domain is missing or inserted at the site."""
    key = ["gene", f"junc{side}"]
    return junctions.groupBy(*key).agg(F.max(F.col("missing_domains").isNotNull() | F.col("domain_insertions").isNotNull()).alias("domain_changed"))


def merge_sides(junctions: DataFrame, pin_s: float = 0.01) -> DataFrame:
    """Cell rows with the standardised values of both sides; rows of neither side go.

    The two sides come from one junction table, so there is no outer self-join;
    (cell, gene, refName_newR1) must be unique.
    """
    k = cut(junction_table(junctions))  # small, and read four times: ranks and quantiles of two sides
    values = None
    for side in SIDES:
        one = normalise_sijk(sijk(k, side, pin_s)).select(*JUNCTION, F.col("nSijk").alias(f"nSijk{side}"), F.col("S").alias(f"S_{side}"), F.col("S_unpinned").alias(f"S_{side}_unpinned"), F.col("flat").alias(f"flat_{side}"))
        values = one if values is None else values.join(one, JUNCTION, "full")
    return lookup(junctions, values, JUNCTION)


def side_z(rows: DataFrame, side: str) -> DataFrame:
    """``cell, gene, z, n_g, rows, scaled_z`` of a side, from merged rows with ``sign``."""
    mine = rows.filter(F.col(f"nSijk{side}").isNotNull())
    sums = mine.groupBy(*by_cell(rows)).agg(F.sum("numReads").alias("n_g"), F.sum(F.col("numReads") * F.col(f"nSijk{side}")).alias("x"), F.first("sign").alias("sign"), F.count("*").alias("rows"))
    z = F.col("sign") * F.col("x") / F.sqrt("n_g")
    return sums.select("cell", "gene", z.alias("z"), "n_g", "rows", (z / F.sqrt("n_g")).alias("scaled_z"))


def combine(start: Column, end: Column) -> Column:
    """(start - end) / sqrt 2, or the one that is there."""
    return F.when(start.isNull(), -end).when(end.isNull(), start).otherwise((start - end) / F.sqrt(F.lit(2.0)))


def add_z(rows: DataFrame, pin_z: float = 0.0) -> DataFrame:
    """Merged rows with ``z_<side>``, ``scaled_z_<side>``, ``n_g_<side>`` (null on rows that lack the side) and combined ``z``, ``scZ``.

    One window over (cell, gene) serves both sides.
    """
    w = Window.partitionBy(*by_cell(rows))
    for s in SIDES:
        has = F.col(f"nSijk{s}").isNotNull()
        n_g = F.sum(F.when(has, F.col("numReads"))).over(w)
        x = F.sum(F.when(has, F.col("numReads") * F.col(f"nSijk{s}"))).over(w)
        rows = rows.withColumns({f"all_n_{s}": n_g, f"z_{s}": F.col("sign") * x / F.sqrt(n_g)}).withColumns({f"n_g_{s}": F.when(has, F.col(f"all_n_{s}")), f"scaled_z_{s}": F.col(f"z_{s}") / F.sqrt(f"all_n_{s}")}).drop(f"all_n_{s}")
    rows = rows.withColumn("n_g", F.sum("numReads").over(w))
    if pin_z:
        rows = cut_dealt(rows)  # read for the quantiles, and again
        for s in SIDES:
            rows = pin(rows, f"z_{s}", pin_z, F.lit(1), F.col(f"nSijk{s}").isNotNull())
    return rows.withColumns({"z": combine(F.col("z_Start"), F.col("z_End")), "scZ": combine(F.col("scaled_z_Start"), F.col("scaled_z_End"))})


def _counted(side: str) -> Column:
    """Reads of a row that count for a side: none where it has no value or no variance."""
    return F.when(F.col(f"nSijk{side}").isNull() | F.col(f"flat_{side}"), 0).otherwise(F.col("numReads"))


def top_junction(rows: DataFrame, side: str) -> DataFrame:
    """``cell, gene, junc_max, max_don_z``: the junction that adds most to a side, the first by name if several do."""
    weight = F.sum(_counted(side)).over(Window.partitionBy(*by_cell(rows)))
    mine = rows.filter(F.col(f"nSijk{side}").isNotNull()).withColumn("share", F.try_divide(F.col(f"S_{side}") * _counted(side), F.sqrt(weight)))
    best = F.min_by(F.struct("refName_newR1", "share"), F.struct(-F.round(F.abs("share"), 9), F.col("refName_newR1")))
    return mine.filter("share is not null").groupBy(*by_cell(rows)).agg(best.alias("b")).select("cell", "gene", F.col("b.refName_newR1").alias("junc_max"), F.col("b.share").alias("max_don_z"))


def split_z(rows: DataFrame, pin_z: float = 0.0, flag: str = "splice_ann", names: tuple[str, str] = ("ann", "unann")) -> DataFrame:
    """Merged rows, written, with annotated and unannotated z of each side, on the rows of that side.

    ``flag`` is a column, or ``{side}`` in it is replaced by the side.  One window over (cell, gene) serves all four, and those of ``add_z`` if its
    rows aren't written yet.
    """
    w = Window.partitionBy(*by_cell(rows))
    for side in SIDES:
        here, n = F.col(f"nSijk{side}").isNotNull(), _counted(side)
        weight = F.sum(n).over(w)
        for value, name in zip((True, False), names, strict=True):
            total = F.sum(F.when(here & (F.col(flag.format(side=side)) == value), F.col(f"S_{side}") * n)).over(w)
            rows = rows.withColumn(f"z_{side}_{name}", F.when(here, F.try_divide(F.col("sign") * total, F.sqrt(weight))))
    rows = cut_dealt(rows)  # read for quantiles and covariances, and again
    if pin_z:
        for side in SIDES:
            for name in names:
                rows = pin(rows, f"z_{side}_{name}", pin_z, F.lit(1))
    return rows


def _cov(start: str, end: str) -> Column:
    """Sample covariance over the rows that have both; null if they are fewer than two."""
    return F.when(F.count(F.col(start) + F.col(end)) > 1, F.covar_samp(start, end))


def combine_split(rows: DataFrame, names: tuple[str, str] = ("ann", "unann"), sides: bool = False) -> DataFrame:
    """Rows of ``split_z`` with annotated and unannotated z of both sides, less the gene's covariance; with ``sides``, that of both sides' z as ``cov`` beside."""
    both_sides = [_cov("z_Start", "z_End").alias("cov")] if sides else []
    rows = lookup(rows, rows.groupBy("gene").agg(*[_cov(f"z_Start_{n}", f"z_End_{n}").alias(f"cov_{n}") for n in names], *both_sides), ["gene"])
    for n in names:
        start, end = F.col(f"z_Start_{n}"), F.col(f"z_End_{n}")
        both = start.isNotNull() & end.isNotNull()
        rows = rows.withColumn(f"z_{n}", F.when(both, combine(start, end) - F.col(f"cov_{n}")).otherwise(combine(start, end)))
    return rows


def add_split_z(rows: DataFrame, pin_z: float = 0.0, flag: str = "splice_ann", names: tuple[str, str] = ("ann", "unann")) -> DataFrame:
    """Merged rows with annotated and unannotated z of each side, on the rows of that side, and combined less the gene's covariance."""
    return combine_split(split_z(rows, pin_z, flag, names), names)


def gene_cov(rows: DataFrame) -> DataFrame:
    """``gene, cov``: sample covariance of both sides' z over junction rows; null where a gene has fewer than two."""
    return rows.groupBy("gene").agg(_cov("z_Start", "z_End").alias("cov"))


def contributions(rows: DataFrame, level_1: str, level_2: str) -> DataFrame:
    """Rows with ``ontology``, ``scaled_z`` and ``zcontrib<side>``."""
    label = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("nan"))
    out = rows.withColumns({"ontology": F.concat(label(level_1), label(level_2)), "scaled_z": F.col("z") / F.sqrt("n_g")})
    return out.withColumns({f"zcontrib{s}": F.col("numReads") * F.col(f"nSijk{s}") / F.sqrt("n_g") for s in SIDES})


def cell_gene_scores(rows: DataFrame, carry: list[str] = ()) -> DataFrame:
    """One row for a cell and gene: scores, and ``n_g_<side>`` and ``carry`` of its first junction by name."""
    taken = ("n_g_Start", "n_g_End", *carry)
    # min_by passes over rows whose ordering is null only, so a null value of the first row stays null
    found = rows.groupBy(*by_cell(rows)).agg(F.first("scZ").alias("scZ"), F.first("z").alias("z"), F.first("n_g").alias("n_g"), F.min_by(F.struct(*taken), "refName_newR1").alias("first__"))
    return found.withColumns({c: F.col("first__").getField(c) for c in taken}).drop("first__")


def unwritten_rows(junctions: DataFrame, sicilian: bool = False, bounds: int = 5, pin_s: float = 0.01, pin_z: float = 0.0, rank_quant: float = 0.0, carry: list[str] | None = None) -> DataFrame:
    """Normalised junction rows to merged rows with z: the whole chain, for a caller that writes them with what it adds.

    The kept rows feed the junction table and the join back, so they are written.  Rows are shuffled once, by ``deal``; ``junctions`` should be stored.
    Of the input's other columns those in ``carry`` go along, all if it is None.
    """
    called = filter_called(junctions, sicilian)
    filled = fill_gene(called if sicilian else cut(called))
    named = deal(filled if carry is None else filled.select(*CHAIN, *carry))  # read for junctions, signs and rows
    sign = gene_sign(named)
    kept = cut_dealt(min_reads(drop_constitutive(named, rank_quant), bounds))
    return add_z(lookup(merge_sides(kept, pin_s), sign, ["gene"]), pin_z)


def score_rows(junctions: DataFrame, sicilian: bool = False, bounds: int = 5, pin_s: float = 0.01, pin_z: float = 0.0, rank_quant: float = 0.0) -> DataFrame:
    """``unwritten_rows``, written once for all later steps."""
    return cut_dealt(unwritten_rows(junctions, sicilian, bounds, pin_s, pin_z, rank_quant))


def narrow_rows(junctions: DataFrame, carry: list[str], *chain, **options) -> DataFrame:
    """``score_rows`` for a caller that needs scores and components only: nothing else is shuffled or written."""
    rows = unwritten_rows(junctions, *chain, **options, carry=carry)
    return cut_dealt(rows.select(*MERGED, *carry, *dealt_by(rows)))

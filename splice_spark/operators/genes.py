"""Genes of an annotation and the genes at a position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN = 10_000


def gtf_gene_name(attribute: Column) -> Column:
    """The quoted ``gene_name``, or the ``;gene=`` value, or null."""
    quoted = F.try_element_at(F.split(F.try_element_at(F.split(attribute, "gene_name"), F.lit(-1)), '"'), F.lit(2))
    keyed = F.try_element_at(F.split(F.try_element_at(F.split(attribute, ";gene="), F.lit(-1)), ";"), F.lit(1))
    return F.when(attribute.contains("gene_name"), quoted).when(attribute.contains(";gene="), keyed)


def gene_intervals(gtf: DataFrame) -> DataFrame:
    """``seqname, gene, start, end, strand, ord`` of each gene of a sequence: its whole range, ``?`` for two strands, its first line."""
    named = gtf.withColumn("gene", gtf_gene_name(F.col("attribute"))).filter("gene is not null")
    strand = F.when(F.count_distinct("strand") == 1, F.min("strand")).otherwise("?")
    return named.groupBy("seqname", "gene").agg(F.min("start").alias("start"), F.max("end").alias("end"), strand.alias("strand"), F.min("line").alias("ord"))


def gene_strands(gtf: DataFrame) -> DataFrame:
    """Distinct ``seqname, strand, gene``."""
    return gtf.select("seqname", "strand", gtf_gene_name(F.col("attribute")).alias("gene")).distinct()


def genes_at_locus(loci: DataFrame, intervals: DataFrame, stranded: bool = False) -> DataFrame:
    """``chr, pos, read_strand, gene, strand`` of distinct loci: all genes over the position in file order, ``unknown`` for none.

    Genes are listed in 10 kb bins and a position looks into its bin only, so
    this is an equi-join on (chr, bin) that Spark may broadcast or shuffle.
    Stranded libraries take genes of the read's strand only and fall back on it.
    """
    loci = loci.select("chr", "pos", "read_strand").distinct().withColumn("bin", F.floor(F.col("pos") / BIN))
    binned = intervals.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / BIN), F.floor(F.col("end") / BIN)))).withColumnRenamed("seqname", "chr")
    hit = loci.join(binned, ["chr", "bin"], "left")
    inside = F.col("pos").between(F.col("start"), F.col("end"))
    if stranded:
        inside &= F.col("strand") == F.col("read_strand")
    found = hit.groupBy("chr", "pos", "read_strand").agg(
        F.sort_array(F.collect_list(F.when(inside, F.struct("ord", "gene")))).alias("genes"),
        F.collect_set(F.when(inside, F.col("strand"))).alias("strands"),
    )
    names = F.array_join(F.transform("genes", lambda g: g["gene"]), ",")
    strand = F.when(F.size("strands") == 1, F.col("strands")[0]).otherwise(F.col("read_strand") if stranded else F.lit("?"))
    return found.select("chr", "pos", "read_strand", F.when(F.size("genes") > 0, names).otherwise("unknown").alias("gene"), strand.alias("strand"))

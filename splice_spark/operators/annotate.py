"""Known exon bounds and junctions: from an annotation, and as marks of junctions.

Distinct ends and junctions of the annotation are looked up: by broadcast if
they are few, and with rows of hot ones left in place if not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splice_spark.functions.joins import lookup


def transcript_name(attribute: Column) -> Column:
    """The quoted ``transcript_id``, or the ``Parent=`` value, or null."""
    quoted = F.regexp_extract(attribute, r'(?:^|[;\s])transcript_id\s+"([^"]*)"', 1)
    keyed = F.regexp_extract(attribute, r"(?:^|;\s*)(?:Parent|transcript_id)=([^;]*)", 1)
    return F.coalesce(F.nullif(quoted, F.lit("")), F.nullif(keyed, F.lit("")))


def exon_bounds(gtf: DataFrame) -> DataFrame:
    """``chr, pos``: first and last bases of all exons, once each."""
    return gtf.filter("feature = 'exon'").select(F.col("seqname").alias("chr"), F.explode(F.array("start", "end")).alias("pos")).distinct()


def known_splices(gtf: DataFrame) -> DataFrame:
    """``chr, lo, hi``: last base of an exon and first of the next one of its transcript, once each.

    Exons are chained by start within a transcript and sequence; exons that overlap or touch leave no junction between them.
    """
    exons = gtf.filter("feature = 'exon'").select(F.col("seqname").alias("chr"), transcript_name(F.col("attribute")).alias("transcript"), "start", "end").filter("transcript is not null")
    chain = Window.partitionBy("chr", "transcript").orderBy("start", "end")
    ends = exons.select("chr", F.max("end").over(chain.rowsBetween(Window.unboundedPreceding, 0)).alias("lo"), F.lead("start").over(chain).alias("hi"))
    return ends.filter("hi > lo + 1").distinct()


def annotate_exons(junctions: DataFrame, exon_bounds: DataFrame) -> DataFrame:
    """``exon_annR1A, exon_annR1B, both_ann``: both ends are looked up on the first end's chromosome."""
    known = exon_bounds.select("chr", "pos").distinct()
    for end in "AB":
        here = known.select(F.col("chr").alias("chrR1A"), F.col("pos").alias(f"juncPosR1{end}"), F.lit(True).alias(f"exon_annR1{end}"))
        junctions = lookup(junctions, here, ["chrR1A", f"juncPosR1{end}"], "left").withColumn(f"exon_annR1{end}", F.coalesce(f"exon_annR1{end}", F.lit(False)))
    return junctions.withColumn("both_ann", F.col("exon_annR1A") & F.col("exon_annR1B"))


def annotate_splices(junctions: DataFrame, splices: DataFrame) -> DataFrame:
    """``splice_ann``: whether the pair of positions, in order, is a known junction of the chromosome."""
    known = splices.select(F.col("chr").alias("chrR1A"), "lo", "hi").distinct().withColumn("splice_ann", F.lit(True))
    ordered = junctions.drop("splice_ann").withColumns({"lo": F.least("juncPosR1A", "juncPosR1B"), "hi": F.greatest("juncPosR1A", "juncPosR1B")})
    return lookup(ordered, known, ["chrR1A", "lo", "hi"], "left").withColumn("splice_ann", F.coalesce("splice_ann", F.lit(False))).drop("lo", "hi")

"""Repair of junction names where several genes overlap an end.

Works on distinct junctions, so joins with the annotation's strands are small;
the new names go back to the reads by the old ones.  A null strand differs from
every strand, as a missing value does in the comparisons below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splice_spark.functions.joins import lookup
from splice_spark.functions.lineage import cut
from splice_spark.functions.names import CHROMOSOME, GENE, POSITION, STRAND, make_name, name_part

#: Gene names taken out of overlapping lists, in this order (fixed values).
WEIRD = ("SNORA", "RP11", "RP4-", "SCARNA", "DLEU2", "SNORD", "CTSLP2")
FAR_APART = 1_000_000


def _same(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) == F.col(b), F.lit(False))


def _genes(name: str) -> Column:
    return F.split(name, ",")


def drop_weird_genes(df: DataFrame) -> DataFrame:
    """Shorter gene lists at ends with more than two genes, or more than one and a known strand; ``n_<end>`` counts genes."""
    for end in "AB":
        df = df.withColumns({f"n_{end}": F.size(_genes(f"geneR1{end}")), f"strand_{end}": F.element_at(F.split(name_part("refName_ABR1", "AB".index(end), STRAND), ":"), -1)})
    for weird in WEIRD:
        for end in "AB":
            gene = F.col(f"geneR1{end}")
            hit = gene.contains(weird) & ((F.col(f"n_{end}") > 2) | ((F.col(f"n_{end}") > 1) & ~F.coalesce(F.col(f"strand_{end}") == "?", F.lit(False))))
            df = df.withColumn(f"geneR1{end}", F.when(hit, F.regexp_replace(F.regexp_replace(gene, f"{weird}[^,]*,", ""), f",{weird}.*", "")).otherwise(gene)).withColumn(f"n_{end}", F.size(_genes(f"geneR1{end}")))
    return df


def resolve_shared_gene(df: DataFrame) -> DataFrame:
    """Both ends get the last gene they share if a list is ambiguous; ``shared`` counts shared genes."""
    both = F.array_join(F.filter(_genes("geneR1A"), lambda x: F.array_contains(_genes("geneR1B"), x)), ",")
    df = df.withColumn("shared_gene", both).withColumn("shared", F.when(F.col("shared_gene") == "", 0).otherwise(F.size(_genes("shared_gene"))))
    pick = (F.col("shared") > 0) & ((F.col("n_A") > 1) | (F.col("n_B") > 1))
    last = F.element_at(_genes("shared_gene"), -1)
    df = df.withColumns({f"geneR1{e}": F.when(pick, last).otherwise(F.col(f"geneR1{e}")) for e in "AB"})
    return df.withColumns({f"uniq_{e}": F.when((F.col(f"n_{e}") > 1) & (F.col("shared") == 0), F.element_at(_genes(f"geneR1{e}"), -1)).otherwise(F.col(f"geneR1{e}")) for e in "AB"})


def _look_up(df: DataFrame, strands: DataFrame, end: str) -> DataFrame:
    here = strands.filter("gene is not null").select(F.col("gene").alias(f"uniq_{end}"), F.col("seqname").alias(f"chrR1{end}"), F.col("strand").alias(f"new_{end}"))
    return df.drop(f"new_{end}").join(here, [f"uniq_{end}", f"chrR1{end}"], "left")


def _read_strands(df: DataFrame, stranded: bool) -> DataFrame:
    return df.withColumns({f"new_{e}": F.col(f"read_{e}") for e in "AB"}) if stranded else df


def pick_gene_by_strand(df: DataFrame, strands: DataFrame, stranded: bool = False) -> DataFrame:
    """The last but one gene of an ambiguous end whose last one doesn't go with the reads' strands; a gene on two strands makes two rows."""
    df = _read_strands(_look_up(_look_up(df, strands, "A"), strands, "B"), stranded)
    a, b = _same("new_A", "read_A"), _same("new_B", "read_B")
    wrong = ((~a & b) | (a & F.col("new_B").isNotNull() & ~b)) & F.coalesce(F.col("strand_A") == "?", F.lit(False)) & (F.col("shared") == 0) & (F.col("n_A") > 1)
    second = lambda e: F.try_element_at(_genes(f"geneR1{e}"), F.lit(-2))
    df = _look_up(df.withColumn("uniq_A", F.when(wrong, second("A")).otherwise(F.col("uniq_A"))), strands, "A")
    a, b = _same("new_A", "read_A"), _same("new_B", "read_B")
    wrong = ((~a & F.col("new_A").isNotNull() & b) | (a & ~b)) & F.coalesce(F.col("strand_B") == "?", F.lit(False)) & (F.col("shared") == 0) & (F.col("n_B") > 1)
    df = _look_up(df.withColumn("uniq_B", F.when(wrong, second("B")).otherwise(F.col("uniq_B"))), strands, "B")
    return _read_strands(df, stranded)


def fill_strand(df: DataFrame) -> DataFrame:
    """A missing gene strand follows the read's where the other end's does, and is its reverse where it doesn't; B before A."""
    for end, other in (("B", "A"), ("A", "B")):
        fits = _same(f"new_{other}", f"read_{other}")
        guess = F.when(fits, F.col(f"read_{end}")).when(F.col(f"new_{other}").isNotNull(), F.translate(f"read_{end}", "+-", "-+"))
        df = df.withColumn(f"new_{end}", F.coalesce(f"new_{end}", guess))
    return df


def rebuild_ref_name(df: DataFrame) -> DataFrame:
    """``refName_newR1``: ends swapped for aligned reads of the minus strand and chimeric ones where both strands disagree; else the old name."""
    end = {e: (F.col(f"chrR1{e}"), F.coalesce(f"uniq_{e}", F.lit("")), F.col(f"juncPosR1{e}"), F.col(f"new_{e}")) for e in "AB"}
    plain, swapped = make_name(*end["A"], *end["B"]), make_name(*end["B"], *end["A"])
    aligned, chimeric = F.col("fileTypeR1") == "Aligned", F.col("fileTypeR1") == "Chimeric"
    a, b = _same("new_A", "read_A"), _same("new_B", "read_B")
    name = F.when(aligned & (F.col("new_A") == "-") & (F.col("juncPosR1A") < F.col("juncPosR1B")), swapped).when(aligned & (F.col("new_A") == "+"), plain).when(chimeric & ~a & ~b, swapped).when(chimeric, plain)
    return df.withColumn("refName_newR1", F.coalesce(name, "refName_ABR1"))


def parse_ref_name(df: DataFrame, name: str = "refName_newR1") -> DataFrame:
    """Chromosome, gene, position and strand columns of both ends, from the name."""
    got = {}
    for k, e in enumerate("AB"):
        got |= {f"gene_strandR1{e}": name_part(name, k, STRAND), f"juncPosR1{e}": name_part(name, k, POSITION).cast("long"), f"chrR1{e}": name_part(name, k, CHROMOSOME), f"geneR1{e}_uniq": name_part(name, k, GENE)}
    return df.withColumns(got)


def junction_class(df: DataFrame) -> DataFrame:
    """The name with its class: fus, sc, rev or lin."""
    chimeric = F.col("fileTypeR1") == "Chimeric"
    same = _same("read_strandR1A", "read_strandR1B")
    far = F.abs(F.col("juncPosR1A") - F.col("juncPosR1B")) >= FAR_APART
    back = ((F.col("read_strandR1A") == "+") & (F.col("juncPosR1A") > F.col("juncPosR1B"))) | ((F.col("read_strandR1A") == "-") & (F.col("juncPosR1A") < F.col("juncPosR1B")))
    kind = F.when((F.col("chrR1A") != F.col("chrR1B")) | (same & far & chimeric), "fus").when(~same & chimeric, "sc").when(back & chimeric, "rev").otherwise("lin")
    return df.withColumn("refName_newR1", F.concat_ws("|", "refName_newR1", kind))


def modify_refnames(reads: DataFrame, strands: DataFrame, stranded: bool = False) -> DataFrame:
    """Reads with repaired names, and the columns that follow from them; of several names for one old name the last in order.

    Where reads of one old name differ, the least of them by strands, file type, places and genes stands for all.
    """
    what = [f"{c}{e}" for c in ("read_strandR1", "juncPosR1", "chrR1", "geneR1") for e in "AB"]
    one = reads.groupBy("refName_ABR1").agg(F.min(F.struct(*what[:2], "fileTypeR1", *what[2:])).alias("r")).select("refName_ABR1", "r.*")
    one = one.withColumns({f"geneR1{e}": F.coalesce(f"geneR1{e}", F.lit("")) for e in "AB"})
    read_b = F.when(F.col("fileTypeR1") == "Aligned", F.col("read_strandR1A")).otherwise(F.col("read_strandR1B"))
    # written between steps: chains of conditions on each other's results would make expressions that double at every step
    one = cut(drop_weird_genes(one.withColumns({"read_A": F.col("read_strandR1A"), "read_B": read_b})))
    picked = cut(pick_gene_by_strand(cut(resolve_shared_gene(one)), strands, stranded))
    named = rebuild_ref_name(cut(fill_strand(picked)))
    new = named.groupBy("refName_ABR1").agg(F.max("refName_newR1").alias("refName_newR1"))
    return junction_class(parse_ref_name(lookup(reads, new, ["refName_ABR1"])))

"""Spliced alignments to named junctions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splice_spark.functions.cigar import cigar_junction, cigar_ref_span
from splice_spark.functions.joins import lookup
from splice_spark.functions.lineage import cut
from splice_spark.functions.names import make_name
from splice_spark.operators.genes import gene_intervals, genes_at_locus


def usable_reads(reads: DataFrame, library: str) -> DataFrame:
    """Mapped alignments; 10X reads need a barcode and a CIGAR."""
    out = reads.filter(F.col("flag").bitwiseAND(4) == 0)
    return out.filter("cb is not null and cigar is not null") if library == "10X" else out


def spliced_reads(reads: DataFrame, library: str) -> DataFrame:
    """Usable alignments, not chimeric, whose CIGAR has an N."""
    return usable_reads(reads, library).filter("ch is null and cigar like '%N%'")


def barcode_umi(library: str, cellranger: bool = True) -> list[Column]:
    """``barcode, UMI``: by tags, by the read name's last two parts, or null."""
    if library == "10X" and cellranger:
        barcode, umi = F.col("cb"), F.coalesce("ub", "ur")
    elif library == "10X":
        parts = F.split("qname", "_")
        barcode, umi = F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1))
    elif library == "SLS":
        barcode, umi = F.col("xc"), F.col("xm")
    else:
        barcode = umi = F.lit(None).cast("string")
    return [barcode.alias("barcode"), umi.alias("UMI")]


def normalise_chrom(name: Column) -> Column:
    """A numeric sequence name gets the prefix ``chr``."""
    return F.when(name.rlike("^[0-9]+$"), F.concat(F.lit("chr"), name)).otherwise(name)


def strand_from_flag(flag: Column) -> Column:
    return F.when(flag.bitwiseAND(16) != 0, "-").otherwise("+")


def primary(flag: Column) -> Column:
    return flag.bitwiseAND(256) == 0


def primary_only(reads: DataFrame) -> DataFrame:
    return reads.filter(primary(F.col("flag")))


def max_genomic_score(reads: DataFrame, library: str) -> DataFrame:
    """``id, score``: best score of a read's unspliced alignments."""
    return usable_reads(reads, library).filter("ch is null and cigar not like '%N%'").groupBy(F.col("qname").alias("id")).agg(F.max("as_score").alias("score"))


def named_reads(reads: DataFrame, intervals: DataFrame, library: str, stranded: bool = False, cellranger: bool = True) -> DataFrame:
    """Alignments with the genes at both ends and their name, as ``name_junctions`` has them but without a mate's suffix; ``sample_id`` and ``mate`` are kept.

    Parsed reads are written once; genes are looked up for their distinct ends and joined back, with reads of hot ends dealt over tasks.
    """
    kept = [c for c in ("sample_id", "mate") if c in reads.columns]
    at = F.when(F.col("cigar").contains("N"), cigar_junction(F.col("pos"), F.col("cigar")))
    base = reads.select(
        *kept, F.col("qname").alias("id"), *barcode_umi(library, cellranger), normalise_chrom(F.col("rname")).alias("chr"),
        strand_from_flag(F.col("flag")).alias("read_strand"), primary(F.col("flag")).alias("primary"), F.col("cigar").contains("N").alias("spliced"), F.col("pos"), at.alias("at"),
    ).withColumns({"a": F.when(F.col("spliced"), F.col("at.posA")).otherwise(F.col("pos")), "b": F.col("at.posB")}).filter("not spliced or at is not null")
    base = cut(base.drop("at"))
    ends = base.select("chr", F.col("a").alias("pos"), "read_strand").unionByName(base.filter("b is not null").select("chr", F.col("b").alias("pos"), "read_strand"))
    genes = cut(genes_at_locus(ends, intervals, stranded))
    for end in "ab":
        here = genes.select("chr", F.col("pos").alias(end), "read_strand", F.col("gene").alias(f"gene_{end}"), F.col("strand").alias(f"strand_{end}"))
        base = lookup(base, here, ["chr", end, "read_strand"], "left")
    long = make_name(F.col("chr"), F.col("gene_a"), F.col("a"), F.col("strand_a"), F.col("chr"), F.col("gene_b"), F.col("b"), F.col("strand_b"), F.lit("lin"))
    short = F.concat_ws(":", "chr", "gene_a", "strand_a")
    return base.withColumn("name", F.when(F.col("spliced"), long).otherwise(short))


def as_mate(named: DataFrame, suffix: str = "R1") -> DataFrame:
    """``named_reads`` under the column names of the first or second mate."""
    return named.select(
        *[c for c in ("sample_id", "mate") if c in named.columns], "id", F.col("name").alias(f"refName_AB{suffix}"), "UMI", "barcode",
        F.col("primary").alias(f"primary{suffix}"), F.col("read_strand").alias(f"read_strand{suffix}"), F.col("a").alias(f"juncPos{suffix}A"), F.col("b").alias(f"juncPos{suffix}B"),
        F.col("gene_a").alias(f"gene{suffix}A"), F.col("gene_b").alias(f"gene{suffix}B"), F.col("chr").alias(f"chr{suffix}A"), F.when(F.col("spliced"), F.col("chr")).alias(f"chr{suffix}B"),
    )


def name_junctions(reads: DataFrame, intervals: DataFrame, library: str, stranded: bool = False, suffix: str = "R1", cellranger: bool = True) -> DataFrame:
    """Alignments with the genes at both ends and their name; unspliced ones have one end and a short name."""
    return as_mate(named_reads(reads.drop("mate"), intervals, library, stranded, cellranger), suffix)


def mate_candidates(mates: DataFrame, first: DataFrame) -> DataFrame:
    """Mapped, primary second mates, spliced or not, of reads in ``first``."""
    chosen = mates.filter("ch is null").filter((F.col("flag").bitwiseAND(4) == 0) & primary(F.col("flag")))
    return chosen.join(first.select(F.col("id").alias("qname")).distinct(), "qname", "left_semi")


def location_flag() -> Column:
    """Whether the mate's place fits the junction's class: 1, 0, or -1 where the class is none of the four."""
    a, b, mate, strand = (F.col(c) for c in ("juncPosR1A", "juncPosR1B", "juncPosR2A", "read_strandR1"))
    has = lambda kind: F.col("refName_ABR1").contains(f"|{kind}")
    flag = lambda c: F.when(c, 1).otherwise(0)
    lin = F.when(strand == "+", flag(mate >= a)).when(strand == "-", flag(mate <= a))
    return F.when(has("fus"), 1).when(has("sc"), 0).when(mate.isNull(), 0).when(has("lin"), lin).when(has("rev"), flag(mate.between(F.least(a, b), F.greatest(a, b)))).otherwise(-1)


def pair_reads(first: DataFrame, second: DataFrame) -> DataFrame:
    """All first mates with their second mates, and whether strands and places go together."""
    keys = ["id", *[c for c in ("sample_id", "mate") if c in first.columns and c in second.columns]]
    out = first.join(second.drop("UMI", "barcode"), keys, "left")
    apart = F.when(F.col("read_strandR1") == F.col("read_strandR2"), 0).otherwise(1)
    return out.withColumns({"read_strand_compatible": apart, "location_compatible": location_flag()})


def class_input(aligned: DataFrame, gtf: DataFrame, library: str, stranded: bool = False) -> DataFrame:
    """Primary spliced reads with names; for SS2 both mates in turn as the first, with their pairs, and the union."""
    intervals = gene_intervals(gtf)
    if library != "SS2":
        return name_junctions(spliced_reads(aligned, library), intervals, library, stranded).filter("primaryR1")
    # both mates are parsed and named once; each spliced one meets the other mate of its read in one join
    mapped = usable_reads(aligned, library).filter("ch is null and mate in (1, 2)").filter(F.col("cigar").contains("N") | primary(F.col("flag")))
    named = cut(named_reads(mapped, intervals, library, stranded))
    first = as_mate(named.filter("spliced and primary"))
    second = as_mate(named.filter("primary"), "R2").withColumn("mate", (3 - F.col("mate")).cast(dict(named.dtypes)["mate"]))
    return pair_reads(first, second).drop("mate")


def chimeric_junctions(reads: DataFrame, intervals: DataFrame, stranded: bool = False) -> DataFrame:
    """Junctions of reads with two chimeric lines, the lower ``segment`` first: names with class fus, sc, rev, lin or err.

    Columns ``qname, segment, flag, rname, pos, cigar``; reads with other than two lines are left out.
    """
    line = F.struct("segment", "flag", "rname", "pos", "cigar")
    two = reads.filter("ch is not null").groupBy("qname").agg(F.count("*").alias("n"), F.min(line).alias("p"), F.max(line).alias("q")).filter("n = 2")
    side = {}
    for x, forward in (("p", "+"), ("q", "-")):
        strand = strand_from_flag(F.col(f"{x}.flag"))
        # the first segment meets the junction with its last base, the second with its first one
        far = F.col(f"{x}.pos") + cigar_ref_span(F.col(f"{x}.cigar")) - 1
        side |= {f"{x}_strand": strand, f"{x}_pos": F.when(strand == forward, far).otherwise(F.col(f"{x}.pos")), f"{x}_chr": F.col(f"{x}.rname")}
    base = two.select(F.col("qname").alias("id"), *[c.alias(n) for n, c in side.items()])
    loci = None
    for x in "pq":
        one = base.select(F.col(f"{x}_chr").alias("chr"), F.col(f"{x}_pos").alias("pos"), F.col(f"{x}_strand").alias("read_strand"))
        loci = one if loci is None else loci.unionByName(one)
    genes = genes_at_locus(loci, intervals, stranded)
    for x in "pq":
        base = lookup(base, genes.toDF(f"{x}_chr", f"{x}_pos", f"{x}_strand", f"{x}_gene", f"{x}_gene_strand"), [f"{x}_chr", f"{x}_pos", f"{x}_strand"], "left")
    plus, before, after = F.col("p_strand") == "+", F.col("p_pos") < F.col("q_pos"), F.col("p_pos") > F.col("q_pos")
    kind = F.when(F.col("p_chr") != F.col("q_chr"), "fus").when(F.col("p_strand") != F.col("q_strand"), "sc").when((plus & after) | (~plus & before), "rev").when((plus & before) | (~plus & after), "lin").otherwise("err")
    name = make_name(*[F.col(f"{x}_{c}") for x in "pq" for c in ("chr", "gene", "pos", "gene_strand")], kind)
    return base.select("id", name.alias("refName_ABR1"), kind.alias("junc_type"), F.col("p_chr").alias("chrR1A"), F.col("p_gene").alias("geneR1A"), F.col("p_pos").alias("juncPosR1A"), F.col("q_chr").alias("chrR1B"), F.col("q_gene").alias("geneR1B"), F.col("q_pos").alias("juncPosR1B"))

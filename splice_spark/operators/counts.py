"""Spliced reads to reads by cell and junction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splice_spark.functions.joins import lookup
from splice_spark.functions.lineage import cut
from splice_spark.functions.names import CHROMOSOME, GENE, POSITION, name_part

LIBRARIES = ("SS2", "10X", "SLS")


def dedup_umis(reads: DataFrame) -> DataFrame:
    """One read for each sample, barcode, UMI and junction: that of the smallest id; nulls are equal."""
    key = ["sample_id", "barcode", "UMI", "refName_ABR1"]
    rest = [c for c in reads.columns if c not in key]
    one = reads.groupBy(*key).agg(F.min_by(F.struct(*rest), "id").alias("r"))
    return one.select(*key, *[F.col(f"r.{c}").alias(c) for c in rest])


def count_junctions(reads: DataFrame) -> DataFrame:
    """``numReads`` distinct UMIs for each sample, barcode and junction, with the ends that the junction's name has.

    Keys and counts only, so both steps are hash aggregates with partial sums; the first is keyed by UMI, so a hot junction is spread.
    """
    umis = reads.select("sample_id", "barcode", "refName_ABR1", "UMI").distinct()
    counted = umis.groupBy("sample_id", "barcode", "refName_ABR1").agg(F.count("*").alias("numReads"))
    parts = {"gene": GENE, "juncPos": POSITION, "chr": CHROMOSOME}
    ends = {c: name_part("refName_ABR1", "AB".index(c[-1]), parts[c[:-3]]) for c in _ENDS}
    return counted.withColumns({c: x.cast("long") if c.startswith("juncPos") else x for c, x in ends.items()})


def count_first_reads(reads: DataFrame) -> DataFrame:
    """As ``count_junctions``, with the id and ends of the smallest read: for libraries whose cells are named by reads."""
    umis = reads.groupBy("sample_id", "barcode", "refName_ABR1", "UMI").agg(F.min_by(F.struct("id", *_ENDS), "id").alias("r"))
    out = umis.groupBy("sample_id", "barcode", "refName_ABR1").agg(F.count("*").alias("numReads"), F.min_by("r", "r.id").alias("r"))
    return out.select("sample_id", "barcode", "refName_ABR1", "numReads", "r.*")


_ENDS = ["geneR1A", "geneR1B", "juncPosR1A", "juncPosR1B", "chrR1A", "chrR1B"]


def cell_id(library: str) -> F.Column:
    """The sample and the barcode without trailing ``-`` and ``1`` characters; for SS2 the read id before a dot."""
    if library == "SS2":
        return F.split("id", r"\.")[0]
    return F.concat(F.col("sample_id"), F.lit("_"), F.coalesce(F.regexp_replace("barcode", "[-1]+$", ""), F.lit("nan")))


def junction_table(reads: DataFrame, library: str) -> DataFrame:
    """The counts of all samples under the library's names."""
    counted = count_first_reads(reads) if library == "SS2" else count_junctions(reads)
    return counted.select(
        F.col("refName_ABR1").alias("refName_newR1"), F.col("geneR1A").alias("geneR1A_uniq"), F.col("geneR1B").alias("geneR1B_uniq"),
        "juncPosR1A", "juncPosR1B", "chrR1A", "chrR1B", "numReads", F.lit(1).alias("called"), cell_id(library).alias("cell_id"),
    )


def attach_meta(counts: DataFrame, meta: DataFrame) -> DataFrame:
    """Counts with the cell's metadata, whose columns replace those of the same name; cells without any stay.

    Rows of the metadata that are equal count once; a cell with two different ones is refused, as it would multiply counts.
    """
    meta = cut(meta.distinct())
    twice = meta.filter("cell_id is not null").groupBy("cell_id").agg(F.count("*").alias("n")).filter("n > 1").limit(3).collect()
    if twice:
        raise ValueError(f"cells with several rows of metadata: {', '.join(sorted(r['cell_id'] for r in twice))}")
    clash = [c for c in counts.columns if c in meta.columns and c != "cell_id"]
    return lookup(counts.drop(*clash), meta.filter("cell_id is not null"), ["cell_id"], "left").withColumnRenamed("cell_id", "cell")

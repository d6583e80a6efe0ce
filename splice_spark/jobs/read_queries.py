"""Queries of the read, gene, count and annotation operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splice_spark.functions import cigar
from splice_spark.jobs.score_queries import io_folder, r6
from splice_spark.operators import annotate, counts, gene_repair, genes, reads
from splice_spark.sources import bam, fixtures, tables


def cigar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("cigar")
    r = fixtures.reads(spark, sf_dir).select("qname", "pos", "cigar", cigar.cigar_junction(F.col("pos"), c).alias("j"), cigar.cigar_ref_span(c).alias("span"), cigar.cigar_counts(c).alias("k"), cigar.split_cigar_align(c).alias("s"))
    return r.select("qname", F.col("j.posA").alias("pos_a"), F.col("j.posB").alias("pos_b"), "span", *[F.col(f"k.{x}").alias(f"n_{x.lower()}") for x in "MSID"], F.col("s.first").alias("cigar_1"), F.col("s.second").alias("cigar_2"))


def chimeric_cigars(spark, sf_dir):
    """CIGARs with clips put at one or both ends."""
    clipped = F.when(F.col("as_score") % 3 == 0, F.concat(F.lit("7S"), "cigar")).when(F.col("as_score") % 3 == 1, F.concat("cigar", F.lit("9H"))).otherwise(F.concat((F.col("as_score") % 4 + 1).cast("string"), F.lit("S"), "cigar", F.lit("3S")))
    r = fixtures.reads(spark, sf_dir).withColumn("cigar", clipped)
    return r.select("qname", cigar.split_cigar_chim(F.col("cigar")).alias("kept"))


def sequence_features(spark, sf_dir):
    r = fixtures.reads(spark, sf_dir).select("qname", cigar.kmer_entropy(F.col("seq")).alias("entropy"), cigar.longest_runs(F.col("seq")).alias("r"), cigar.mismatch_count(F.col("md")).alias("mismatches"))
    return r.select("qname", *r6("entropy"), *[F.col(f"r.{b}").alias(f"run_{b.lower()}") for b in "ATCGN"], "mismatches")


def spliced_reads(spark, sf_dir):
    r = reads.spliced_reads(fixtures.reads(spark, sf_dir), "10X")
    return reads.primary_only(r).select("qname", *reads.barcode_umi("10X"), reads.normalise_chrom(F.col("rname")).alias("chr"), reads.strand_from_flag(F.col("flag")).alias("strand"))


def barcodes(spark, sf_dir):
    """Of all libraries, a row for each read and library."""
    out = None
    for name, library, ranger in (("10X", "10X", True), ("names", "10X", False), ("SLS", "SLS", True), ("SS2", "SS2", True)):
        one = reads.usable_reads(fixtures.reads(spark, sf_dir), library).select("qname", F.lit(name).alias("library"), *reads.barcode_umi(library, ranger))
        out = one if out is None else out.unionByName(one)
    return out


def max_genomic_score(spark, sf_dir):
    return reads.max_genomic_score(fixtures.reads(spark, sf_dir).withColumn("qname", F.concat(F.lit("q"), F.element_at(F.split("qname", "_U"), -1))), "10X")


def gene_intervals(spark, sf_dir):
    return genes.gene_intervals(fixtures.gtf(spark, sf_dir))


def gene_strands(spark, sf_dir):
    return genes.gene_strands(fixtures.gtf(spark, sf_dir))


def _loci(spark, sf_dir):
    r = fixtures.reads(spark, sf_dir)
    return r.select(reads.normalise_chrom(F.col("rname")).alias("chr"), "pos", reads.strand_from_flag(F.col("flag")).alias("read_strand"))


def genes_at_locus(spark, sf_dir):
    return genes.genes_at_locus(_loci(spark, sf_dir), genes.gene_intervals(fixtures.gtf(spark, sf_dir)))


def genes_at_locus_stranded(spark, sf_dir):
    return genes.genes_at_locus(_loci(spark, sf_dir), genes.gene_intervals(fixtures.gtf(spark, sf_dir)), True)


def _named(spark, sf_dir):
    return reads.class_input(fixtures.reads(spark, sf_dir), fixtures.gtf(spark, sf_dir), "10X")


def spliced_junctions(spark, sf_dir):
    return _named(spark, sf_dir).select("sample_id", "id", "refName_ABR1", "UMI", "barcode", "read_strandR1", "juncPosR1A", "juncPosR1B", "geneR1A", "geneR1B", "chrR1A")


def _mates(spark, sf_dir):
    """Every read as a first mate, and odd ones again as the second mate of the read before."""
    r = fixtures.reads(spark, sf_dir)
    number = F.regexp_extract("qname", "^r([0-9]+)_", 1).cast("long")
    second = r.filter(number % 2 == 1).withColumns({"mate": F.lit(2), "qname": F.concat(F.lit("r"), (number - 1).cast("string"), F.lit("_U"), F.floor(number / 4).cast("string")), "sample_id": F.lit("S0")})
    return r.withColumn("sample_id", F.lit("S0")).unionByName(second)


def pair_reads(spark, sf_dir):
    out = reads.class_input(_mates(spark, sf_dir), fixtures.gtf(spark, sf_dir), "SS2")
    return out.select("id", "refName_ABR1", "juncPosR1A", "juncPosR1B", "juncPosR2A", "read_strandR1", "read_strandR2", "read_strand_compatible", "location_compatible")


def chimeric_junctions(spark, sf_dir):
    """Two lines a read: a read and the one after it."""
    r = fixtures.reads(spark, sf_dir)
    number = F.regexp_extract("qname", "^r([0-9]+)_", 1).cast("long")
    lines = r.select(F.concat(F.lit("c"), (number - number % 2).cast("string")).alias("qname"), (number % 2).alias("segment"), "flag", F.when(number % 10 < 6, F.lit("chr1")).otherwise(F.concat(F.lit("chr"), "rname")).alias("rname"), "pos", "cigar", F.lit("1").alias("ch"))
    return reads.chimeric_junctions(lines, genes.gene_intervals(fixtures.gtf(spark, sf_dir)))


def dedup_umis(spark, sf_dir):
    return counts.dedup_umis(_named(spark, sf_dir)).select("sample_id", "barcode", "UMI", "refName_ABR1", "id")


def umi_counts(spark, sf_dir):
    return counts.count_junctions(_named(spark, sf_dir))


def first_read_counts(spark, sf_dir):
    return counts.count_first_reads(_named(spark, sf_dir)).select("sample_id", "barcode", "refName_ABR1", "numReads", "id")


def ss2_counts(spark, sf_dir):
    """Without barcodes and UMIs: a cell is named by its first read."""
    none = F.lit(None).cast("string")
    named = _named(spark, sf_dir).withColumns({"barcode": none, "UMI": none, "id": F.concat("id", F.lit(".1"))})
    return counts.junction_table(named, "SS2").select("refName_newR1", "geneR1A_uniq", "juncPosR1B", "numReads", "cell_id")


def junction_table(spark, sf_dir):
    return counts.junction_table(_named(spark, sf_dir), "10X")


def _meta(spark, sf_dir):
    j = fixtures.junctions(spark, sf_dir)
    return j.select(F.col("cell").alias("cell_id"), "tissue", "compartment", F.lit(2).alias("called")).distinct().filter("cell_id not like '%7'")


def attach_meta(spark, sf_dir):
    table = fixtures.junctions(spark, sf_dir).drop("tissue", "compartment").withColumnRenamed("cell", "cell_id")
    return counts.attach_meta(table, _meta(spark, sf_dir)).select("cell", "refName_newR1", "numReads", "tissue", "compartment", "called")


def exon_bounds(spark, sf_dir):
    return annotate.exon_bounds(fixtures.annotation(spark, sf_dir))


def known_splices(spark, sf_dir):
    return annotate.known_splices(fixtures.annotation(spark, sf_dir))


def annotate_exons(spark, sf_dir):
    """Bounds from the annotation; second ends on another chromosome are looked up on the first end's too."""
    j = fixtures.junctions(spark, sf_dir).drop("splice_ann").withColumn("chrR1B", F.when(F.col("juncPosR1B") % 7000 == 0, "chr9").otherwise(F.col("chrR1A")))
    return annotate.annotate_exons(j, annotate.exon_bounds(fixtures.annotation(spark, sf_dir))).select("cell", "refName_newR1", "exon_annR1A", "exon_annR1B", "both_ann")


def annotate_splices(spark, sf_dir):
    """Junctions from the annotation's transcripts; ends may stand in either order."""
    j, known = fixtures.junctions(spark, sf_dir), annotate.known_splices(fixtures.annotation(spark, sf_dir))
    return annotate.annotate_splices(j.withColumns({"juncPosR1A": F.col("juncPosR1B"), "juncPosR1B": F.col("juncPosR1A")}), known).select("cell", "refName_newR1", "splice_ann")


def gene_repair_names(spark, sf_dir):
    out = gene_repair.modify_refnames(fixtures.class_input(spark, sf_dir), genes.gene_strands(fixtures.gtf(spark, sf_dir)))
    return out.select("refName_ABR1", "refName_newR1", "chrR1A", "chrR1B", "juncPosR1A", "juncPosR1B", "geneR1A_uniq", "geneR1B_uniq", "gene_strandR1A", "gene_strandR1B")


def weird_genes(spark, sf_dir):
    one = gene_repair.resolve_shared_gene(gene_repair.drop_weird_genes(fixtures.class_input(spark, sf_dir)))
    return one.select("refName_ABR1", "geneR1A", "geneR1B", "uniq_A", "uniq_B", "n_A", "n_B", "shared")


def gene_repair_stranded(spark, sf_dir):
    out = gene_repair.modify_refnames(fixtures.class_input(spark, sf_dir), genes.gene_strands(fixtures.gtf(spark, sf_dir)), True)
    return out.select("refName_ABR1", "refName_newR1", "geneR1A_uniq", "geneR1B_uniq", "gene_strandR1A", "gene_strandR1B")


def unspliced_names(spark, sf_dir):
    """Short names of unspliced alignments."""
    plain = reads.usable_reads(fixtures.reads(spark, sf_dir), "10X").filter("cigar not like '%N%'")
    return reads.name_junctions(plain, genes.gene_intervals(fixtures.gtf(spark, sf_dir)), "10X").select("id", "refName_ABR1", "juncPosR1A", "juncPosR1B", "geneR1A", "chrR1A", "chrR1B")


def cell_ids(spark, sf_dir):
    """Of all libraries, a row for each read and library."""
    named, out = _named(spark, sf_dir).withColumn("id", F.concat("id", F.lit(".1"))), None
    for library in counts.LIBRARIES:
        one = named.select("id", F.lit(library).alias("library"), counts.cell_id(library).alias("cell_id"))
        out = one if out is None else out.unionByName(one)
    return out


def io_tsv_roundtrip(spark, sf_dir):
    path = f"{io_folder(spark)}/junctions.tsv"
    tables.write_tsv(fixtures.junctions(spark, sf_dir), path)
    return tables.read_junctions(spark, path).select("cell", "refName_newR1", "juncPosR1A", "juncPosR1B", "numReads", "splice_ann", "called")


def io_by_chromosome(spark, sf_dir):
    path = f"{io_folder(spark)}/chromosomes.parquet"
    tables.write_by_chromosome(fixtures.junctions(spark, sf_dir), path)
    return tables.read_junctions(spark, path).select("cell", "refName_newR1", "numReads", F.col("chrR1A").cast("string").alias("chrR1A"))


def io_convert(spark, sf_dir):
    """Parquet to text and back."""
    folder = io_folder(spark)
    fixtures.junctions(spark, sf_dir).write.parquet(f"{folder}/a.parquet")
    tables.convert_table(spark, f"{folder}/a.parquet", f"{folder}/b.tsv")
    tables.convert_table(spark, f"{folder}/b.tsv", f"{folder}/c.pq")
    return tables.read_junctions(spark, f"{folder}/c.pq").select("cell", "refName_newR1", "juncPosR1A", "juncPosR1B", "numReads", "splice_ann", "called")


SAM_TAGS = {"cb": "CB:Z", "ub": "UB:Z", "ur": "UR:Z", "xc": "XC:Z", "xm": "XM:Z", "as_score": "AS:i", "ch": "ch:A", "md": "MD:Z"}


def io_samples(spark, sf_dir):
    """SAM text of three samples, named by a sample sheet."""
    folder = io_folder(spark)
    tags = [F.concat(F.lit(f"{t}:"), F.col(c).cast("string")) for c, t in SAM_TAGS.items()]
    line = F.concat_ws("\t", "qname", F.col("flag").cast("string"), "rname", F.col("pos").cast("string"), F.lit("60"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", F.lit("*"), *tags)
    aligned = fixtures.reads(spark, sf_dir)
    heads = aligned.select("sample_id", F.lit("@HD\tVN:1.6").alias("value")).distinct()
    aligned.select("sample_id", line.alias("value")).unionByName(heads).write.partitionBy("sample_id").text(f"{folder}/sam")
    files = spark.read.text(f"{folder}/sam").select(F.col("_metadata.file_path").alias("path"), "sample_id").distinct()
    files.select(F.concat_ws(", ", "sample_id", "path").alias("value")).write.text(f"{folder}/sheet.csv")
    out = tables.read_samples(spark, tables.read_samplesheet(spark, f"{folder}/sheet.csv", "10X"))
    return out.select("sample_id", F.col("mate").cast("long").alias("mate"), "qname", F.col("flag").cast("long").alias("flag"), "rname", "pos", "cigar", "seq", *[c for c in SAM_TAGS if c != "as_score"], F.col("as_score").cast("long").alias("as_score"))


def io_bam(spark, sf_dir):
    """The same reads as BAM files of three samples, read in parts of 256 kB by a sample sheet."""
    folder = io_folder(spark)
    aligned = fixtures.reads(spark, sf_dir).withColumn("as_score", F.col("as_score").cast("int"))
    sheet = []
    for name in ("S0", "S1", "S2"):
        bam.write_bam(aligned.filter(F.col("sample_id") == name), f"{folder}/{name}", [(c, 1 << 29) for c in "123"])
        sheet += [(f"{name}, {path}",) for path, _ in bam.files_of(f"{folder}/{name}")]
    spark.createDataFrame(sheet, "value string").write.text(f"{folder}/sheet.csv")
    out = tables.read_samples(spark, tables.read_samplesheet(spark, f"{folder}/sheet.csv", "10X"), split_bytes=1 << 18)
    return out.select("sample_id", F.col("mate").cast("long").alias("mate"), "qname", F.col("flag").cast("long").alias("flag"), "rname", "pos", "cigar", "seq", *[c for c in SAM_TAGS if c != "as_score"], F.col("as_score").cast("long").alias("as_score"))


def io_gtf(spark, sf_dir):
    """An annotation file with a comment; genes' places in it by sequence."""
    path = f"{io_folder(spark)}/genes.gtf"
    columns = [c.split()[0] for c in tables.GTF_SCHEMA.split(", ")]
    lines = fixtures.gtf(spark, sf_dir).select("line", F.concat_ws("\t", *[F.col(c).cast("string") for c in columns]).alias("value"))
    lines.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("line"), F.lit("#!genome-build x").alias("value"))).repartition(1).sortWithinPartitions("line").select("value").write.text(path)
    found = genes.gene_intervals(tables.read_gtf(spark, path))
    return found.select("seqname", "gene", "start", "end", "strand", F.row_number().over(Window.partitionBy("seqname").orderBy("ord")).cast("long").alias("place"))


def io_meta(spark, sf_dir):
    path = f"{io_folder(spark)}/meta.tsv"
    tables.write_tsv(_meta(spark, sf_dir), path)
    return tables.read_meta(spark, path).select("cell_id", "tissue", "compartment", "called")


QUERIES = {f.__name__: f for f in (cigar_features, chimeric_cigars, sequence_features, spliced_reads, barcodes, max_genomic_score, gene_intervals, gene_strands, genes_at_locus, genes_at_locus_stranded, spliced_junctions, pair_reads, chimeric_junctions, dedup_umis, umi_counts, first_read_counts, ss2_counts, junction_table, attach_meta, exon_bounds, known_splices, annotate_exons, annotate_splices, weird_genes, gene_repair_stranded, unspliced_names, cell_ids, io_tsv_roundtrip, io_by_chromosome, io_convert, io_samples, io_bam, io_gtf, io_meta)}
QUERIES["gene_repair"] = gene_repair_names

# SQL

_READS = f"r AS ({fixtures.duck(fixtures.READS)})"
#: Each distinct CIGAR, operation by operation: bases to the junction, and from there to the other end; span, totals, and both parts.
_CIGARS = """st AS (SELECT cigar, CAST(unnest(regexp_extract_all(cigar, '[0-9]+')) AS BIGINT) AS n, unnest(regexp_extract_all(cigar, '[A-Z]')) AS op, unnest(range(1, len(regexp_extract_all(cigar, '[A-Z]')) + 1)) AS i FROM (SELECT DISTINCT cigar FROM r)),
kn AS (SELECT cigar, i AS k, n AS gap FROM (SELECT *, row_number() OVER (PARTITION BY cigar ORDER BY n DESC, i) AS place FROM st WHERE op = 'N') WHERE place = 1),
km AS (SELECT st.cigar, min(i) AS m FROM st JOIN kn ON st.cigar = kn.cigar WHERE op = 'M' AND i > k GROUP BY st.cigar),
co AS (SELECT st.*, k, gap, m FROM st LEFT JOIN kn ON st.cigar = kn.cigar LEFT JOIN km ON st.cigar = km.cigar),
cg AS (SELECT cigar, CAST(CASE WHEN m IS NOT NULL THEN before - 1 END AS BIGINT) AS a, CAST(CASE WHEN m IS NOT NULL THEN before + gap + after END AS BIGINT) AS b, * EXCLUDE (cigar, k, gap, m, before, after, c1), CASE WHEN k IS NULL THEN cigar ELSE coalesce(c1, '') END AS c1 FROM (
    SELECT cigar, k, gap, m, coalesce(sum(n) FILTER (op IN ('M', 'N', 'D') AND i < k), 0) AS before, coalesce(sum(n) FILTER (op IN ('N', 'D') AND i > k AND i < m), 0) AS after, CAST(coalesce(sum(n) FILTER (op IN ('M', 'N', 'D')), 0) AS BIGINT) AS span,
           CAST(coalesce(sum(n) FILTER (op = 'M'), 0) AS BIGINT) AS n_m, CAST(coalesce(sum(n) FILTER (op = 'S'), 0) AS BIGINT) AS n_s, CAST(coalesce(sum(n) FILTER (op = 'I'), 0) AS BIGINT) AS n_i, CAST(coalesce(sum(n) FILTER (op = 'D'), 0) AS BIGINT) AS n_d,
           string_agg(CAST(n AS VARCHAR) || op, '' ORDER BY i) FILTER (i < k) AS c1, string_agg(CAST(n AS VARCHAR) || op, '' ORDER BY i) FILTER (i > k) AS c2
    FROM co GROUP BY cigar, k, gap, m))"""
_GTF = f"""gt AS ({fixtures.duck(fixtures.GTF)}),
gn AS (SELECT *, CASE WHEN attribute LIKE '%gene_name%' THEN split_part(split_part(attribute, 'gene_name', 2), '"', 2) WHEN attribute LIKE '%;gene=%' THEN split_part(split_part(attribute, ';gene=', 2), ';', 1) END AS gene FROM gt),
gi AS (SELECT seqname, gene, min("start") AS "start", max("end") AS "end", CASE WHEN count(DISTINCT strand) = 1 THEN min(strand) ELSE '?' END AS strand, min(line) AS ord FROM gn WHERE gene IS NOT NULL GROUP BY seqname, gene)"""
_STRAND = "CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END"


def _loc(name: str, loci: str, stranded: bool = False) -> str:
    only = "AND gi.strand = l.read_strand" if stranded else ""
    fall = "l.read_strand" if stranded else "'?'"
    return f"""{name} AS (SELECT l.chr, l.pos, l.read_strand, coalesce(string_agg(gi.gene, ',' ORDER BY gi.ord), 'unknown') AS gene, CASE WHEN count(DISTINCT gi.strand) = 1 THEN min(gi.strand) ELSE {fall} END AS strand
FROM (SELECT DISTINCT chr, pos, read_strand FROM {loci}) l LEFT JOIN gi ON gi.seqname = l.chr AND l.pos BETWEEN gi."start" AND gi."end" {only} GROUP BY l.chr, l.pos, l.read_strand)"""


_USABLE = "flag & 4 = 0 AND cb IS NOT NULL AND cigar IS NOT NULL"
_LOCI = f"lo AS (SELECT DISTINCT CASE WHEN regexp_matches(rname, '^[0-9]+$') THEN 'chr' || rname ELSE rname END AS chr, pos, {_STRAND} AS read_strand FROM r)"


def _names(reads_sql: str, where: str = "flag & 4 = 0 AND cb IS NOT NULL AND ch IS NULL AND r.cigar LIKE '%N%' AND flag & 256 = 0") -> str:
    return f"""{reads_sql}, {_CIGARS}, {_GTF},
sp AS (SELECT sample_id, qname AS id, cb AS barcode, coalesce(ub, ur) AS UMI, 'chr' || rname AS chr, {_STRAND} AS read_strand, pos + a AS pa, pos + b AS pb FROM r JOIN cg ON r.cigar = cg.cigar WHERE {where}),
le AS (SELECT chr, pa AS pos, read_strand FROM sp UNION SELECT chr, pb, read_strand FROM sp),
{_loc("lg", "le")},
nm AS (SELECT sp.*, x.gene AS ga, y.gene AS gb, sp.chr || ':' || x.gene || ':' || CAST(pa AS VARCHAR) || ':' || x.strand || '|' || sp.chr || ':' || y.gene || ':' || CAST(pb AS VARCHAR) || ':' || y.strand || '|lin' AS name
       FROM sp JOIN lg x ON x.chr = sp.chr AND x.pos = pa AND x.read_strand = sp.read_strand JOIN lg y ON y.chr = sp.chr AND y.pos = pb AND y.read_strand = sp.read_strand)"""


_COUNTS = "um AS (SELECT sample_id, barcode, name, UMI, min(id) AS id FROM nm GROUP BY ALL), ct AS (SELECT sample_id, barcode, name, count(*) AS numReads, min(id) AS id FROM um GROUP BY sample_id, barcode, name)"
_ANNOTATED = f"""an AS ({fixtures.duck(fixtures.ANNOTATION)}), xb AS (SELECT DISTINCT seqname AS chr, unnest(["start", "end"]) AS pos FROM an WHERE feature = 'exon'),
xt AS (SELECT seqname AS chr, "start", "end", CASE WHEN attribute LIKE '%transcript_id "%' THEN split_part(split_part(attribute, 'transcript_id "', 2), '"', 1) WHEN attribute LIKE '%;Parent=%' THEN split_part(split_part(attribute, ';Parent=', 2), ';', 1) END AS t FROM an WHERE feature = 'exon'),
xs AS (SELECT DISTINCT chr, lo, hi FROM (SELECT chr, max("end") OVER (PARTITION BY chr, t ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS lo, lead("start") OVER (PARTITION BY chr, t ORDER BY "start", "end") AS hi FROM xt WHERE t IS NOT NULL) WHERE hi > lo + 1)"""
_J = f"j AS ({fixtures.duck(fixtures.JUNCTIONS)})"


def _weird_sql() -> str:
    """The seven removals, one after another, as nested subqueries."""
    sql = "SELECT *, len(string_split(geneR1A, ',')) AS n_A, len(string_split(geneR1B, ',')) AS n_B, split_part(split_part(refName_ABR1, '|', 1), ':', 4) AS strand_A, split_part(split_part(refName_ABR1, '|', 2), ':', 4) AS strand_B FROM ci"
    for weird in gene_repair.WEIRD:
        for e in "AB":
            g = f"geneR1{e}"
            hit = f"contains({g}, '{weird}') AND (n_{e} > 2 OR n_{e} > 1 AND strand_{e} <> '?')"
            new = f"CASE WHEN {hit} THEN regexp_replace(regexp_replace({g}, '{weird}[^,]*,', '', 'g'), ',{weird}.*', '', 'g') ELSE {g} END"
            sql = f"SELECT * REPLACE (len(string_split({g}, ',')) AS n_{e}) FROM (SELECT * REPLACE ({new} AS {g}) FROM ({sql}))"
    return f"""ci AS ({fixtures.duck(fixtures.CLASS_INPUT)}), wg AS ({sql}),
sh0 AS (SELECT *, array_to_string(list_filter(string_split(geneR1A, ','), lambda x: list_contains(string_split(geneR1B, ','), x)), ',') AS sg FROM wg),
sh1 AS (SELECT *, CASE WHEN sg = '' THEN 0 ELSE len(string_split(sg, ',')) END AS shared FROM sh0),
sh2 AS (SELECT * REPLACE (CASE WHEN shared > 0 AND (n_A > 1 OR n_B > 1) THEN string_split(sg, ',')[-1] ELSE geneR1A END AS geneR1A, CASE WHEN shared > 0 AND (n_A > 1 OR n_B > 1) THEN string_split(sg, ',')[-1] ELSE geneR1B END AS geneR1B) FROM sh1),
sh AS (SELECT *, CASE WHEN n_A > 1 AND shared = 0 THEN string_split(geneR1A, ',')[-1] ELSE geneR1A END AS uniq_A, CASE WHEN n_B > 1 AND shared = 0 THEN string_split(geneR1B, ',')[-1] ELSE geneR1B END AS uniq_B FROM sh2)"""


_NUM = "CAST(regexp_extract(qname, '^r([0-9]+)_', 1) AS BIGINT)"
_NAME = "{c1} || ':' || x.gene || ':' || CAST({p1} AS VARCHAR) || ':' || x.strand || '|' || {c2} || ':' || y.gene || ':' || CAST({p2} AS VARCHAR) || ':' || y.strand || '|' || "
_CHIMERIC = f"""WITH {_READS}, {_CIGARS}, {_GTF},
cl AS (SELECT {_NUM} - {_NUM} % 2 AS k, {_NUM} % 2 AS seg, CASE WHEN {_NUM} % 10 < 6 THEN 'chr1' ELSE 'chr' || rname END AS chr, {_STRAND} AS strand, pos, span FROM r JOIN cg ON r.cigar = cg.cigar),
pq AS (SELECT a.k, a.chr AS pc, a.strand AS ps, CASE WHEN a.strand = '+' THEN a.pos + a.span - 1 ELSE a.pos END AS pp, b.chr AS qc, b.strand AS qs, CASE WHEN b.strand = '-' THEN b.pos + b.span - 1 ELSE b.pos END AS qp FROM cl a JOIN cl b ON a.k = b.k AND a.seg = 0 AND b.seg = 1),
lx AS (SELECT pc AS chr, pp AS pos, ps AS read_strand FROM pq UNION SELECT qc, qp, qs FROM pq),
{_loc("lg", "lx")},
ck AS (SELECT *, CASE WHEN pc <> qc THEN 'fus' WHEN ps <> qs THEN 'sc' WHEN ps = '+' AND pp > qp OR ps = '-' AND pp < qp THEN 'rev' WHEN pp <> qp THEN 'lin' ELSE 'err' END AS kind FROM pq)
SELECT 'c' || CAST(k AS VARCHAR) AS id, {_NAME.format(c1="pc", p1="pp", c2="qc", p2="qp")} kind AS refName_ABR1, kind AS junc_type, pc AS chrR1A, x.gene AS geneR1A, pp AS juncPosR1A, qc AS chrR1B, y.gene AS geneR1B, qp AS juncPosR1B
FROM ck JOIN lg x ON x.chr = pc AND x.pos = pp AND x.read_strand = ps JOIN lg y ON y.chr = qc AND y.pos = qp AND y.read_strand = qs"""
_PAIRS = f"""WITH {_READS}, {_CIGARS}, {_GTF},
mt AS (SELECT 1 AS mate, qname, flag, rname, pos, cigar, ch FROM r UNION ALL SELECT 2, 'r' || CAST({_NUM} - 1 AS VARCHAR) || '_U' || CAST(CAST(floor({_NUM} / 4) AS BIGINT) AS VARCHAR), flag, rname, pos, cigar, ch FROM r WHERE {_NUM} % 2 = 1),
nx AS (SELECT mate, qname AS id, {_STRAND} AS strand, 'chr' || rname AS chr, coalesce(pos + a, pos) AS pa, pos + b AS pb, flag & 256 = 0 AS prim FROM mt JOIN cg ON mt.cigar = cg.cigar WHERE flag & 4 = 0 AND ch IS NULL),
lx AS (SELECT chr, pa AS pos, strand AS read_strand FROM nx WHERE pb IS NOT NULL UNION SELECT chr, pb, strand FROM nx WHERE pb IS NOT NULL),
{_loc("lg", "lx")},
fs AS (SELECT nx.*, {_NAME.format(c1="nx.chr", p1="pa", c2="nx.chr", p2="pb")} 'lin' AS name FROM nx JOIN lg x ON x.chr = nx.chr AND x.pos = pa AND x.read_strand = nx.strand JOIN lg y ON y.chr = nx.chr AND y.pos = pb AND y.read_strand = nx.strand WHERE prim)
SELECT fs.id, name AS refName_ABR1, fs.pa AS juncPosR1A, fs.pb AS juncPosR1B, s.pa AS juncPosR2A, fs.strand AS read_strandR1, s.strand AS read_strandR2, CASE WHEN fs.strand = s.strand THEN 0 ELSE 1 END AS read_strand_compatible,
       CASE WHEN s.pa IS NULL THEN 0 WHEN fs.strand = '+' AND s.pa >= fs.pa OR fs.strand = '-' AND s.pa <= fs.pa THEN 1 ELSE 0 END AS location_compatible
FROM fs LEFT JOIN nx s ON s.id = fs.id AND s.mate <> fs.mate AND s.prim"""

_SAME_A, _SAME_B = "coalesce(new_A = read_A, false)", "coalesce(new_B = read_B, false)"
_ENDS = {e: f"chrR1{e} || ':' || coalesce(uniq_{e}, '') || ':' || CAST(juncPosR1{e} AS VARCHAR) || ':' || new_{e}" for e in "AB"}
_PLAIN, _SWAPPED = f"{_ENDS['A']} || '|' || {_ENDS['B']}", f"{_ENDS['B']} || '|' || {_ENDS['A']}"
_REPAIR = f"""WITH {_weird_sql()}, {_GTF},
gs AS (SELECT DISTINCT seqname, strand, gene FROM gn WHERE gene IS NOT NULL),
rp0 AS (SELECT *, read_strandR1A AS read_A, CASE WHEN fileTypeR1 = 'Aligned' THEN read_strandR1A ELSE read_strandR1B END AS read_B FROM sh),
rp1 AS (SELECT rp0.*, a.strand AS new_A, b.strand AS new_B FROM rp0 LEFT JOIN gs a ON a.gene = uniq_A AND a.seqname = chrR1A LEFT JOIN gs b ON b.gene = uniq_B AND b.seqname = chrR1B),
rp2 AS (SELECT * EXCLUDE (new_A) REPLACE (CASE WHEN (NOT {_SAME_A} AND {_SAME_B} OR {_SAME_A} AND new_B IS NOT NULL AND NOT {_SAME_B}) AND strand_A = '?' AND shared = 0 AND n_A > 1 THEN string_split(geneR1A, ',')[-2] ELSE uniq_A END AS uniq_A) FROM rp1),
rp3 AS (SELECT rp2.*, a.strand AS new_A FROM rp2 LEFT JOIN gs a ON a.gene = uniq_A AND a.seqname = chrR1A),
rp4 AS (SELECT * EXCLUDE (new_B) REPLACE (CASE WHEN (NOT {_SAME_A} AND new_A IS NOT NULL AND {_SAME_B} OR {_SAME_A} AND NOT {_SAME_B}) AND strand_B = '?' AND shared = 0 AND n_B > 1 THEN string_split(geneR1B, ',')[-2] ELSE uniq_B END AS uniq_B) FROM rp3),
rp5 AS (SELECT rp4.*, b.strand AS new_B FROM rp4 LEFT JOIN gs b ON b.gene = uniq_B AND b.seqname = chrR1B),
rp6 AS (SELECT * REPLACE (CASE WHEN new_B IS NOT NULL THEN new_B WHEN {_SAME_A} THEN read_B WHEN new_A IS NOT NULL THEN translate(read_B, '+-', '-+') END AS new_B) FROM rp5),
rp7 AS (SELECT * REPLACE (CASE WHEN new_A IS NOT NULL THEN new_A WHEN {_SAME_B} THEN read_A WHEN new_B IS NOT NULL THEN translate(read_A, '+-', '-+') END AS new_A) FROM rp6),
rp8 AS (SELECT refName_ABR1, max(coalesce(CASE WHEN fileTypeR1 = 'Aligned' AND new_A = '-' AND juncPosR1A < juncPosR1B THEN {_SWAPPED} WHEN fileTypeR1 = 'Aligned' AND new_A = '+' THEN {_PLAIN}
        WHEN fileTypeR1 = 'Chimeric' AND NOT {_SAME_A} AND NOT {_SAME_B} THEN {_SWAPPED} WHEN fileTypeR1 = 'Chimeric' THEN {_PLAIN} END, refName_ABR1)) AS name FROM rp7 GROUP BY refName_ABR1),
rp9 AS (SELECT refName_ABR1, name, {", ".join(f"split_part(split_part(name, '|', {k}), ':', 1) AS chrR1{e}, split_part(split_part(name, '|', {k}), ':', 2) AS geneR1{e}_uniq, CAST(split_part(split_part(name, '|', {k}), ':', 3) AS BIGINT) AS juncPosR1{e}, split_part(split_part(name, '|', {k}), ':', 4) AS gene_strandR1{e}" for k, e in ((1, "A"), (2, "B")))} FROM rp8)
SELECT rp9.refName_ABR1, rp9.chrR1A, rp9.chrR1B, rp9.juncPosR1A, rp9.juncPosR1B, geneR1A_uniq, geneR1B_uniq, gene_strandR1A, gene_strandR1B,
       name || CASE WHEN rp9.chrR1A <> rp9.chrR1B OR fileTypeR1 = 'Chimeric' AND read_strandR1A = read_strandR1B AND abs(rp9.juncPosR1A - rp9.juncPosR1B) >= 1000000 THEN '|fus'
       WHEN fileTypeR1 = 'Chimeric' AND read_strandR1A <> read_strandR1B THEN '|sc'
       WHEN fileTypeR1 = 'Chimeric' AND (read_strandR1A = '+' AND rp9.juncPosR1A > rp9.juncPosR1B OR read_strandR1A = '-' AND rp9.juncPosR1A < rp9.juncPosR1B) THEN '|rev' ELSE '|lin' END AS refName_newR1
FROM rp9 JOIN ci ON ci.refName_ABR1 = rp9.refName_ABR1"""

#: Stranded libraries take the reads' strands where genes are chosen and at the end.
_STRANDED = _REPAIR.replace("SELECT rp0.*, a.strand AS new_A, b.strand AS new_B FROM", "SELECT rp0.*, read_A AS new_A, read_B AS new_B FROM").replace("END AS new_B) FROM rp5)", "END AS new_B) FROM (SELECT * REPLACE (read_A AS new_A, read_B AS new_B) FROM rp5))")
_STRANDED = f"SELECT refName_ABR1, refName_newR1, geneR1A_uniq, geneR1B_uniq, gene_strandR1A, gene_strandR1B FROM ({_STRANDED})"

ORACLE_SQL = {
    "gene_repair": _REPAIR,
    "chimeric_junctions": _CHIMERIC,
    "pair_reads": _PAIRS,
    "cigar_features": f"WITH {_READS}, {_CIGARS} SELECT qname, pos + a AS pos_a, pos + b AS pos_b, CAST(span AS BIGINT) AS span, CAST(n_m AS BIGINT) AS n_m, CAST(n_s AS BIGINT) AS n_s, CAST(n_i AS BIGINT) AS n_i, CAST(n_d AS BIGINT) AS n_d, c1 AS cigar_1, c2 AS cigar_2 FROM r JOIN cg ON r.cigar = cg.cigar",
    "chimeric_cigars": f"""WITH {_READS}, cl AS (SELECT qname, CASE as_score % 3 WHEN 0 THEN '7S' || cigar WHEN 1 THEN cigar || '9H' ELSE CAST(as_score % 4 + 1 AS VARCHAR) || 'S' || cigar || '3S' END AS c FROM r),
cp AS (SELECT *, CAST(regexp_extract(c, '^([0-9]+)', 1) AS BIGINT) AS first, CAST(regexp_extract(c, '([0-9]+)[A-Z]$', 1) AS BIGINT) AS last, regexp_matches(c, '^[0-9]+[SH]') AS a, regexp_matches(c, '[SH]$') AS b FROM cl)
SELECT qname, CASE WHEN a AND (NOT b OR first > last) THEN regexp_replace(c, '^[0-9]+[A-Z]', '') WHEN b THEN regexp_replace(c, '[0-9]+[A-Z]$', '') END AS kept FROM cp""",
    "sequence_features": f"""WITH {_READS}, km AS (SELECT qname, seq, substr(seq, CAST(i AS BIGINT), 5) AS m FROM r, range(1, 60) t(i) WHERE i <= length(seq) - 4),
k1 AS (SELECT qname, m, count(*) AS n FROM km GROUP BY qname, m), k2 AS (SELECT qname, n / CAST(sum(n) OVER (PARTITION BY qname) AS DOUBLE) AS p FROM k1), en AS (SELECT qname, -sum(p * ln(p)) AS e FROM k2 GROUP BY qname)
SELECT r.qname, round(coalesce(e, 0), 6) + 0.0 AS entropy, {", ".join(f"coalesce(list_max(list_transform(regexp_extract_all(seq, '{b}+'), lambda x: length(x))), 0) AS run_{b.lower()}" for b in "ATCGN")}, CAST(length(regexp_replace(md, '[^ACGT]', '', 'g')) AS BIGINT) AS mismatches FROM r LEFT JOIN en ON r.qname = en.qname""",
    "spliced_reads": f"WITH {_READS} SELECT qname, cb AS barcode, coalesce(ub, ur) AS UMI, 'chr' || rname AS chr, {_STRAND} AS strand FROM r WHERE {_USABLE} AND ch IS NULL AND cigar LIKE '%N%' AND flag & 256 = 0",
    "barcodes": f"""WITH {_READS} SELECT qname, '10X' AS library, cb AS barcode, coalesce(ub, ur) AS UMI FROM r WHERE {_USABLE} UNION ALL SELECT qname, 'names', split_part(qname, '_', 1), split_part(qname, '_', 2) FROM r WHERE {_USABLE}
UNION ALL SELECT qname, 'SLS', xc, xm FROM r WHERE flag & 4 = 0 UNION ALL SELECT qname, 'SS2', NULL, NULL FROM r WHERE flag & 4 = 0""",
    "max_genomic_score": f"WITH {_READS} SELECT 'q' || split_part(qname, '_U', 2) AS id, max(as_score) AS score FROM r WHERE {_USABLE} AND ch IS NULL AND cigar NOT LIKE '%N%' GROUP BY 1",
    "gene_intervals": f'WITH {_GTF} SELECT seqname, gene, "start", "end", strand, ord FROM gi',
    "gene_strands": f"WITH {_GTF} SELECT DISTINCT seqname, strand, gene FROM gn",
    "genes_at_locus": f"WITH {_READS}, {_GTF}, {_LOCI}, {_loc('lg', 'lo')} SELECT * FROM lg",
    "genes_at_locus_stranded": f"WITH {_READS}, {_GTF}, {_LOCI}, {_loc('lg', 'lo', True)} SELECT * FROM lg",
    "spliced_junctions": f"WITH {_names(_READS)} SELECT sample_id, id, name AS refName_ABR1, UMI, barcode, read_strand AS read_strandR1, pa AS juncPosR1A, pb AS juncPosR1B, ga AS geneR1A, gb AS geneR1B, chr AS chrR1A FROM nm",
    "dedup_umis": f"WITH {_names(_READS)}, {_COUNTS} SELECT sample_id, barcode, UMI, name AS refName_ABR1, id FROM um",
    "umi_counts": f"WITH {_names(_READS)}, {_COUNTS} SELECT sample_id, barcode, name AS refName_ABR1, numReads, ga AS geneR1A, gb AS geneR1B, pa AS juncPosR1A, pb AS juncPosR1B, chr AS chrR1A, chr AS chrR1B FROM ct JOIN (SELECT DISTINCT name AS nm_name, ga, gb, pa, pb, chr FROM nm) ON nm_name = name",
    "first_read_counts": f"WITH {_names(_READS)}, {_COUNTS} SELECT sample_id, barcode, name AS refName_ABR1, numReads, id FROM ct",
    "ss2_counts": f"WITH {_names(_READS)} SELECT name AS refName_newR1, ga AS geneR1A_uniq, pb AS juncPosR1B, 1 AS numReads, min(id) AS cell_id FROM nm GROUP BY sample_id, name, ga, pb",
    "junction_table": f"WITH {_names(_READS)}, {_COUNTS} SELECT name AS refName_newR1, ga AS geneR1A_uniq, gb AS geneR1B_uniq, pa AS juncPosR1A, pb AS juncPosR1B, chr AS chrR1A, chr AS chrR1B, numReads, 1 AS called, ct.sample_id || '_' || rtrim(ct.barcode, '-1') AS cell_id FROM ct JOIN (SELECT DISTINCT name AS nm_name, ga, gb, pa, pb, chr FROM nm) ON nm_name = name",
    "attach_meta": f"WITH {_J}, mt AS (SELECT DISTINCT cell AS cell_id, tissue, compartment, 2 AS called FROM j WHERE cell NOT LIKE '%7') SELECT cell, refName_newR1, numReads, mt.tissue, mt.compartment, mt.called FROM j LEFT JOIN mt ON j.cell = mt.cell_id",
    "exon_bounds": f"WITH {_ANNOTATED} SELECT chr, pos FROM xb",
    "known_splices": f"WITH {_ANNOTATED} SELECT chr, lo, hi FROM xs",
    "annotate_exons": f"WITH {_J}, {_ANNOTATED} SELECT cell, refName_newR1, a.pos IS NOT NULL AS exon_annR1A, b.pos IS NOT NULL AS exon_annR1B, a.pos IS NOT NULL AND b.pos IS NOT NULL AS both_ann FROM j LEFT JOIN xb a ON chrR1A = a.chr AND juncPosR1A = a.pos LEFT JOIN xb b ON chrR1A = b.chr AND juncPosR1B = b.pos",
    "annotate_splices": f"WITH {_J}, {_ANNOTATED} SELECT cell, refName_newR1, lo IS NOT NULL AS splice_ann FROM j LEFT JOIN xs ON chrR1A = chr AND juncPosR1A = lo AND juncPosR1B = hi",
    "weird_genes": f"WITH {_weird_sql()} SELECT refName_ABR1, geneR1A, geneR1B, uniq_A, uniq_B, n_A, n_B, shared FROM sh",
    "io_tsv_roundtrip": f"WITH {_J} SELECT cell, refName_newR1, juncPosR1A, juncPosR1B, numReads, splice_ann, called FROM j",
    "gene_repair_stranded": _STRANDED,
    "unspliced_names": f"""WITH {_READS}, {_GTF}, un AS (SELECT qname AS id, CASE WHEN regexp_matches(rname, '^[0-9]+$') THEN 'chr' || rname ELSE rname END AS chr, pos, {_STRAND} AS read_strand FROM r WHERE {_USABLE} AND cigar NOT LIKE '%N%'), {_loc('lg', 'un')}
SELECT id, un.chr || ':' || gene || ':' || strand AS refName_ABR1, un.pos AS juncPosR1A, CAST(NULL AS BIGINT) AS juncPosR1B, gene AS geneR1A, un.chr AS chrR1A, CAST(NULL AS VARCHAR) AS chrR1B FROM un JOIN lg ON lg.chr = un.chr AND lg.pos = un.pos AND lg.read_strand = un.read_strand""",
    "cell_ids": f"WITH {_names(_READS)} SELECT id || '.1' AS id, library, CASE WHEN library = 'SS2' THEN id ELSE sample_id || '_' || coalesce(rtrim(barcode, '-1'), 'nan') END AS cell_id FROM nm, (VALUES ('SS2'), ('10X'), ('SLS')) l(library)",
    "io_convert": f"WITH {_J} SELECT cell, refName_newR1, juncPosR1A, juncPosR1B, numReads, splice_ann, called FROM j",
    "io_samples": f"WITH {_READS} SELECT sample_id, CAST(mate AS BIGINT) AS mate, qname, CAST(flag AS BIGINT) AS flag, rname, pos, cigar, seq, cb, ub, ur, xc, xm, ch, md, as_score FROM r",
    "io_gtf": f'WITH {_GTF} SELECT seqname, gene, "start", "end", strand, row_number() OVER (PARTITION BY seqname ORDER BY ord) AS place FROM gi',
    "io_meta": f"WITH {_J} SELECT DISTINCT cell AS cell_id, tissue, compartment, '2' AS called FROM j WHERE cell NOT LIKE '%7'",
    "io_by_chromosome": f"WITH {_J} SELECT cell, refName_newR1, numReads, chrR1A FROM j WHERE called = 1",
}
ORACLE_SQL["io_bam"] = ORACLE_SQL["io_samples"]

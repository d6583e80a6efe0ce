"""Reading and writing of the library's tables.

Schemas are given where a format has none, so nothing is inferred at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splice_spark.functions.joins import lookup
from splice_spark.functions.lineage import cut
from splice_spark.sources.bam import SPLIT_BYTES, read_bam

JUNCTION_SCHEMA = (
    "cell string, refName_newR1 string, geneR1A_uniq string, geneR1B_uniq string, juncPosR1A long, juncPosR1B long, "
    "chrR1A string, chrR1B string, numReads long, splice_ann boolean, called int"
)
GTF_SCHEMA = "seqname string, source string, feature string, start long, end long, score string, strand string, frame string, attribute string"
REQUIRED = ("juncPosR1A", "geneR1A_uniq", "juncPosR1B", "numReads", "cell", "splice_ann", "refName_newR1", "chrR1A")


def read_tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Tab-separated text with a header; columns are strings unless a schema names their types."""
    reader = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", False)
    if schema is None:
        return reader.csv(path)
    types = {name: kind for name, kind in (c.split() for c in schema.split(", "))}
    text = reader.csv(path)
    return text.select(*[F.col(f"`{c}`").cast(types.get(c, "string")).alias(c) for c in text.columns])


def read_junctions(spark: SparkSession, path: str) -> DataFrame:
    """``.pq`` and ``.parquet`` as Parquet, ``.tsv`` and ``.txt`` as tab-separated text; other extensions are refused."""
    end = path.rstrip("/").rpartition(".")[2]
    if end in ("pq", "parquet"):
        return spark.read.parquet(path)
    if end in ("tsv", "txt"):
        return read_tsv(spark, path, JUNCTION_SCHEMA)
    raise ValueError(f"{path}: .pq, .parquet, .tsv or .txt is expected")


def validate_columns(junctions: DataFrame, level_1: str, level_2: str, sicilian: bool = False) -> DataFrame:
    """``junctions`` itself, or an error that lists the missing columns before any job runs."""
    need = [*REQUIRED, *(["called"] if sicilian else []), *([] if level_1 == "dummy" else [level_1]), level_2]
    if missing := [c for c in need if c not in junctions.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return junctions


def normalise_input(junctions: DataFrame, sicilian: bool, level_1: str) -> DataFrame:
    """Library names, no second-end gene columns; all junctions called unless the caller's marks are asked for; a null ``dummy`` level."""
    out = junctions.drop("geneR1B_uniq", "chrR1B").withColumnsRenamed({"geneR1A_uniq": "gene", "juncPosR1A": "juncStart", "juncPosR1B": "juncEnd"})
    out = out.withColumns({"juncStart": F.col("juncStart").cast("long"), "juncEnd": F.col("juncEnd").cast("long"), "numReads": F.col("numReads").cast("long")})
    if not sicilian:
        out = out.withColumn("called", F.lit(1))
    return out.withColumn("dummy", F.lit("null")) if level_1 == "dummy" else out


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def convert_table(spark: SparkSession, source: str, target: str) -> None:
    """Between Parquet and tab-separated text, by the extension of ``target``."""
    df = read_junctions(spark, source)
    write_tsv(df, target) if target.rstrip("/").endswith((".tsv", ".txt")) else df.write.mode("overwrite").parquet(target)


#: Rows of a file of cell rows, some hundred MB at most.
FILE_ROWS = 2_000_000


def planned_files(df: DataFrame, by: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """``df`` dealt for a write in folders by ``by``: each value's rows, which are counted, go by hash to as many files as they need, or fewer where hashes meet."""
    counts = df.groupBy(by).agg(F.ceil(F.count("*") / file_rows).cast("int").alias("files__"))
    counts = cut(counts)
    total = counts.agg(F.sum("files__")).first()[0] or 1
    sized = lookup(df, counts.filter(F.col(by).isNotNull()), [by], "left")
    nulls = F.lit((counts.filter(F.col(by).isNull()).first() or {"files__": 1})["files__"])
    atoms = [c for c, kind in df.dtypes if "map<" not in kind]
    dealt = sized.withColumn("salt__", F.pmod(F.xxhash64(*atoms), F.coalesce("files__", nulls)))
    return dealt.repartition(int(total), by, "salt__").drop("files__", "salt__")


def spread_files(df: DataFrame, file_rows: int = FILE_ROWS) -> DataFrame:
    """``df`` dealt over as many files as its counted rows need."""
    return df.repartition(max(1, -(-df.count() // file_rows)))


def write_by_chromosome(junctions: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """Called rows, a folder for each chromosome, with files of about ``file_rows`` rows whatever wrote them."""
    planned_files(junctions.filter("called = 1"), "chrR1A", file_rows).write.mode("overwrite").partitionBy("chrR1A").parquet(path)


def read_samplesheet(spark: SparkSession, path: str, library: str) -> DataFrame:
    """Headerless ``sample, reads`` (10X, SLS) or ``sample, reads of mate 1, of mate 2`` (SS2), a row for each file."""
    paired = library == "SS2"
    sheet = spark.read.csv(path, header=False, schema="sample_id string, path_1 string" + ", path_2 string" * paired)
    files = F.array(*[F.struct(F.lit(m).alias("mate"), F.trim(f"path_{m}").alias("path")) for m in ((1, 2) if paired else (1,))])
    return sheet.select(F.trim("sample_id").alias("sample_id"), F.explode(files).alias("f")).select("sample_id", "f.mate", "f.path")


def _name(path: F.Column) -> F.Column:
    """The last two parts of a path: what a reader's file names and a sheet's paths have in common, whatever the scheme."""
    return F.array_join(F.slice(F.split(F.regexp_replace(path, "/+$", ""), "/"), -2, 2), "/")


def _kind(path: str) -> str:
    end = path.rstrip("/").rpartition(".")[2]
    return {"pq": "parquet", "parquet": "parquet", "bam": "bam"}.get(end, "sam")


def read_samples(spark: SparkSession, sheet: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Alignments of all files of a sample sheet with ``sample_id`` and ``mate``: one scan, whose rows take them from the sheet by their file.

    Files are all Parquet, all BAM or all SAM text, and differ in name or folder.  A file that two rows name gives its records to both.
    """
    files = [r["path"] for r in sheet.select("path").distinct().collect()]  # a line for each file of a run
    if not files:
        raise ValueError("the sample sheet is empty")
    kinds = {_kind(p) for p in files}
    if len(kinds) > 1:
        raise ValueError(f"files of one sheet must be of one kind, not {', '.join(sorted(kinds))}")
    if len({"/".join(p.rstrip("/").split("/")[-2:]) for p in files}) < len(files):
        raise ValueError("two files of the sheet have the same folder and name")
    # a Parquet path may be a folder of part files
    path = F.col("path") if kinds == {"bam"} else F.col("_metadata.file_path")
    at = F.regexp_replace(path, "/[^/]*$", "") if kinds == {"parquet"} else path
    out = read_alignments(spark, *files, keep={"__file": _name(at)}, split_bytes=split_bytes)
    known = sheet.select(_name(F.col("path")).alias("__file"), "sample_id", "mate")
    return out.join(F.broadcast(known), "__file").drop("__file")


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """Cell metadata, keyed by ``cell_id``."""
    return read_tsv(spark, path)


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Annotation lines with ``line``, a number in file order: by file name, and within a file by place, however it is split.

    A task reads a block of a file from its start to its end, so its own numbers order the lines of a block; blocks are ordered by file and
    offset, a row for each.
    """
    lines = spark.read.csv(path, sep="\t", comment="#", schema=GTF_SCHEMA, quote="")
    lines = cut(lines.withColumns({"file__": F.col("_metadata.file_path"), "start__": F.col("_metadata.file_block_start"), "row__": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    order = Window.partitionBy(F.lit(0)).orderBy("file__", "start__")
    blocks = lines.select("file__", "start__").distinct().withColumn("block__", F.row_number().over(order).cast("long"))
    placed = lookup(lines, blocks, ["file__", "start__"]).withColumn("line", F.shiftleft("block__", 33) + F.col("row__"))
    return placed.drop("file__", "start__", "row__", "block__")


def read_alignments(spark: SparkSession, *paths: str, keep: dict[str, F.Column] | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Alignment records from Parquet, from BAM or from SAM text: fixed fields, and tags as columns; ``keep`` adds columns of the scan, such as file names."""
    keep, kinds = keep or {}, {_kind(p) for p in paths}
    if kinds == {"bam"}:
        return read_bam(spark, *paths, split_bytes=split_bytes).withColumns(keep).drop("path")
    if kinds == {"parquet"}:
        return spark.read.parquet(*paths).withColumns(keep) if keep else spark.read.parquet(*paths)
    field = F.split("value", "\t")
    rest = F.slice(field, F.lit(12), F.greatest(F.size(field) - 11, F.lit(0)))
    tags = F.map_from_entries(F.transform(rest, lambda t: F.struct(F.substring(t, 1, 2).alias("key"), F.substr(t, F.lit(6)).alias("value"))))
    text = spark.read.text(list(paths))
    lines = (text.withColumns(keep) if keep else text).filter("value != '' and value not like '@%'").withColumns({"field": field})
    got = lines.select(
        F.col("field")[0].alias("qname"), F.col("field")[1].cast("int").alias("flag"), F.nullif(F.col("field")[2], F.lit("*")).alias("rname"),
        F.col("field")[3].cast("long").alias("pos"), F.nullif(F.col("field")[5], F.lit("*")).alias("cigar"), F.nullif(F.col("field")[9], F.lit("*")).alias("seq"), tags.alias("tags"), *keep,
    )
    names = {"cb": "CB", "ub": "UB", "ur": "UR", "xc": "XC", "xm": "XM", "ch": "ch", "md": "MD"}
    out = got.withColumns({c: F.try_element_at("tags", F.lit(t)) for c, t in names.items()})
    return out.withColumn("as_score", F.try_element_at("tags", F.lit("AS")).cast("int")).drop("tags")


def write_scores(scores: DataFrame, rows: DataFrame, folder: str) -> None:
    """Scores by cell and gene as text, junction rows as Parquet, in files of about ``FILE_ROWS`` rows; ``rows`` should be stored.

    Junction rows are counted by a pass of its own and written from where they are, neighbouring partitions together.
    """
    write_tsv(spread_files(cut(scores)), f"{folder}/scores.tsv")  # counted, and written
    files = max(1, -(-rows.count() // FILE_ROWS))
    rows.coalesce(files).write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(f"{folder}/junctions.parquet")


def write_loadings(loadings: DataFrame, folder: str) -> None:
    """One table for all genes."""
    loadings.write.mode("overwrite").parquet(f"{folder}/loadings.parquet")


#: Order of the result files; a null comes last.
RESULT_ORDER = {
    "tests": ["level_1", "gene", "z_col"],
    "wide": ["perm_pval_adj_scZ", "gene", "level_1"],
    "sites": ["gene", "component", "rank"],
    "summary": ["gene", "level_1", "scZ_median", "level_2"],
}


def write_results(folder: str, **frames: DataFrame) -> None:
    """Each result as text in one sorted file set: ``tests``, ``wide``, ``sites``, ``summary``."""
    for name, df in frames.items():
        write_tsv(df.orderBy(*[F.asc_nulls_last(c) for c in RESULT_ORDER[name]]), f"{folder}/{name}.tsv")

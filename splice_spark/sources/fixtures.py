"""Inputs of the library derived from the star-schema tables, in SQL that Spark and DuckDB both read.

``{table}`` stands for a table; see FIXTURES.md for what each derived table exercises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Genes, sites and cells grow with the tables: customers in blocks of 150 share ten genes, and every block has gene 0.
JUNCTIONS = """
SELECT cell, refName_newR1, geneR1A_uniq, juncPosR1A, juncPosR1B, chrR1A, splice_ann, tissue, compartment,
       CAST(sum(reads) AS BIGINT) AS numReads, max(called) AS called
FROM (
    SELECT cell, tissue, compartment, juncPosR1A, juncPosR1B, chrR1A, splice_ann, reads, called,
           CASE WHEN gi % 10 IN (7, 9) THEN 'unknown' ELSE gene END AS geneR1A_uniq,
           chrR1A || ':' || CASE WHEN gi % 10 IN (7, 9) THEN 'unknown' ELSE gene END || ':' || CAST(juncPosR1A AS STRING) || strand
               || '|' || chrR1A || ':' || CASE WHEN gi % 10 = 7 THEN 'unknown' ELSE gene END || ':' || CAST(juncPosR1B AS STRING) || strand || '|lin' AS refName_newR1
    FROM (
        SELECT gi, 'C' || CAST(c_custkey AS STRING) AS cell, r_name AS tissue, c_mktsegment AS compartment,
               gi * 200000 + 1000 * (1 + sb) AS juncPosR1A, gi * 200000 + 100000 + 1000 * eb AS juncPosR1B, 'chr' || CAST(1 + gi % 3 AS STRING) AS chrR1A,
               (sb + eb) % 3 <> 0 AS splice_ann, CAST(l_quantity AS BIGINT) % 5 + 1 AS reads,
               CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 0 ELSE 1 END AS called,
               'g' || CAST(gi AS STRING) AS gene, CASE WHEN gi % 2 = 0 THEN ':+' ELSE ':-' END AS strand
        FROM (
            SELECT *, CASE WHEN gi % 5 = 1 AND sb = 0 THEN 9 WHEN gi % 4 = 0 THEN (length(c_mktsegment) % 3) * 2 + l_linenumber % 2 ELSE (l_suppkey + l_linenumber) % 5 END AS eb
            FROM (
                SELECT *, CAST(floor(l_partkey / 10) AS BIGINT) % CASE WHEN gi = 0 THEN 12 ELSE 3 + gi % 4 END AS sb
                FROM (
                    SELECT CAST(l_partkey AS BIGINT) AS l_partkey, CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_returnflag, c_custkey, c_mktsegment, r_name,
                           CASE WHEN l_partkey % 10 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(floor(c_custkey / 150) AS BIGINT) * 10 + CAST(l_partkey AS BIGINT) % 10 END AS gi
                    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
                ) AS a
            ) AS b
        ) AS c
    ) AS d
) AS e
GROUP BY cell, refName_newR1, geneR1A_uniq, juncPosR1A, juncPosR1B, chrR1A, splice_ann, tissue, compartment
"""

#: The rows of JUNCTIONS as numbers.  What a lineitem gives but its part is one number of four digits (9: null) in the joins, and rows are summed where the last join left them.
_NARROW = """
SELECT c_custkey, c_mktsegment, r_name, gi, sb, CASE WHEN gi IS NULL THEN NULL ELSE eb END AS eb, CAST(sum(reads) AS BIGINT) AS numReads, max(called) AS called
FROM (
    SELECT *, CASE WHEN gi % 5 = 1 AND sb = 0 THEN CAST(9 AS BIGINT) WHEN gi % 4 = 0 THEN CAST((length(c_mktsegment) % 3) * 2 + odd AS BIGINT) ELSE CAST(fifth AS BIGINT) END AS eb
    FROM (
        SELECT *, CAST(floor(l_partkey / 10) AS BIGINT) % CASE WHEN gi = 0 THEN 12 ELSE 3 + gi % 4 END AS sb
        FROM (
            SELECT c_custkey, c_mktsegment, r_name, l_partkey, nullif(packed % 10, 9) - 4 AS fifth, nullif(packed div 10 % 10, 9) - 1 AS odd, nullif(packed div 100 % 10, 9) - 3 AS reads, CAST(packed div 1000 AS INT) AS called,
                   CASE WHEN l_partkey % 10 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(floor(c_custkey / 150) AS BIGINT) * 10 + l_partkey % 10 END AS gi
            FROM (
                SELECT l_orderkey, CAST(l_partkey AS BIGINT) AS l_partkey,
                       CAST(coalesce((CAST(l_suppkey AS BIGINT) + CAST(l_linenumber AS BIGINT)) % 5 + 4, 9) + 10 * coalesce(CAST(l_linenumber AS BIGINT) % 2 + 1, 9) + 100 * coalesce(CAST(l_quantity AS BIGINT) % 5 + 4, 9)
                           + 1000 * CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 0 ELSE 1 END AS INT) AS packed
                FROM {lineitem}
            ) AS l JOIN {orders} ON l_orderkey = o_orderkey
            JOIN (SELECT c_custkey, c_mktsegment, r_name FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey) AS p ON o_custkey = c_custkey
        ) AS a
    ) AS b
) AS c
GROUP BY c_custkey, c_mktsegment, r_name, gi, sb, CASE WHEN gi IS NULL THEN NULL ELSE eb END
"""
#: Sorted by junction where they are, by one number, so that a junction's name and places, which are most of a row, repeat and compress wherever rows are written or dealt.
_JUNCTIONS = f"""
SELECT cell, chrR1A || ':' || known || ':' || CAST(juncPosR1A AS STRING) || strand || '|' || chrR1A || ':' || CASE WHEN gi % 10 = 7 THEN 'unknown' ELSE gene END || ':' || CAST(juncPosR1B AS STRING) || strand || '|lin' AS refName_newR1,
       known AS geneR1A_uniq, juncPosR1A, juncPosR1B, chrR1A, splice_ann, tissue, compartment, numReads, called
FROM (
    SELECT *, CASE WHEN gi % 10 IN (7, 9) THEN 'unknown' ELSE gene END AS known
    FROM (
        SELECT gi, 'C' || CAST(c_custkey AS STRING) AS cell, r_name AS tissue, c_mktsegment AS compartment, gi * 200000 + 1000 * (1 + sb) AS juncPosR1A, gi * 200000 + 100000 + 1000 * eb AS juncPosR1B,
               'chr' || CAST(1 + gi % 3 AS STRING) AS chrR1A, (sb + eb) % 3 <> 0 AS splice_ann, 'g' || CAST(gi AS STRING) AS gene, CASE WHEN gi % 2 = 0 THEN ':+' ELSE ':-' END AS strand, numReads, called
        FROM ({_NARROW} SORT BY gi * 1000 + sb * 10 + eb) AS s
    ) AS t
) AS u
"""

#: Places for genes, and gaps between them.
_SLOTS = "(SELECT CAST(floor(floor(max(p_partkey) / 4) * 13 / 10) AS BIGINT) + 1 FROM {part})"
#: Four events are a molecule, 25 molecules a cell, and four cells share their loci and junctions; all grow with the events.
READS = f"""
SELECT 'S' || CAST(k % 3 AS STRING) AS sample_id, 1 AS mate,
       'r' || CAST(event_id AS STRING) || '_U' || CAST(m AS STRING) AS qname,
       CASE WHEN (CAST(floor(m / 2) AS BIGINT) + CASE WHEN m % 7 = 0 THEN user_id ELSE 0 END) % 2 = 1 THEN 16 ELSE 0 END + CASE WHEN event_id % 13 = 0 THEN 256 ELSE 0 END + CASE WHEN event_id % 97 = 0 THEN 4 ELSE 0 END AS flag,
       CASE WHEN event_id % 11 = 0 THEN '3' ELSE CAST(1 + m % 2 AS STRING) END AS rname,
       CAST(1 + (g * 37 + m % 5) % {_SLOTS} * 4000 + CASE WHEN m % 3 = 0 THEN user_id % 5 * 100 ELSE 0 END AS BIGINT) AS pos,
       CASE m % 5 WHEN 0 THEN '50M'
            WHEN 1 THEN CAST(10 + q % 31 AS STRING) || 'M' || CAST(500 + q % 4999 AS STRING) || 'N' || CAST(20 + q % 17 AS STRING) || 'M'
            WHEN 2 THEN '10M2D10M' || CAST(800 + q % 197 AS STRING) || 'N5I20M' || CAST(100 + q % 901 AS STRING) || 'N10M'
            WHEN 3 THEN CAST(3 + q % 9 AS STRING) || 'S20M' || CAST(1200 + q % 3001 AS STRING) || 'N25M'
            ELSE CAST(25 + q % 11 AS STRING) || 'M' || CAST(300 + q % 2003 AS STRING) || 'N1D20M' END AS cigar,
       CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'BC' || CAST(k AS STRING) || '-1' END AS cb,
       CASE WHEN m % 17 = 0 THEN NULL ELSE 'U' || CAST(m AS STRING) END AS ub,
       'V' || CAST(m AS STRING) AS ur, 'X' || CAST(k AS STRING) AS xc, 'M' || CAST(m AS STRING) AS xm,
       CAST(event_id % 50 AS BIGINT) AS as_score, CASE WHEN event_id % 101 = 0 THEN '1' ELSE NULL END AS ch,
       CASE event_id % 3 WHEN 0 THEN 'AAAATTTGGCACGTACGTAACCGGNNTT' WHEN 1 THEN 'ACGTACGTACGTACGT' ELSE 'ACG' END || substr('TTTTTGGGGGCCCCC', 1, CAST(event_id % 15 AS INT)) AS seq,
       CAST(event_id % 20 AS STRING) || 'A' || CAST(event_id % 9 AS STRING) || CASE WHEN event_id % 4 = 0 THEN '^TT5C' ELSE 'G3' END AS md
FROM (
    SELECT *, g * 11 + m % 10 AS q
    FROM (SELECT event_id, user_id, CAST(floor(event_id / 4) AS BIGINT) AS m, CAST(floor(event_id / 100) AS BIGINT) AS k, CAST(floor(event_id / 400) AS BIGINT) AS g FROM {{events}}) AS a
) AS b
"""

#: Two exons a gene and sequence, and after every ten genes three empty places.
GTF = """
SELECT 'chr' || CAST(1 + p_partkey % 2 AS STRING) AS seqname, 'x' AS source, 'exon' AS feature,
       place * 4000 + 1 + exon * 1500 AS "start", place * 4000 + 3000 + p_size * 100 AS "end",
       '.' AS score, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand, '.' AS frame,
       CASE WHEN p_partkey % 5 = 0 THEN 'ID=' || CAST(p_partkey AS STRING) || ';gene=G' || CAST(gene AS STRING) || ';x=1'
            WHEN p_partkey % 23 = 0 THEN 'note "none"'
            ELSE 'gene_name "G' || CAST(gene AS STRING) || '"; exon ' || CAST(p_size AS STRING) END AS attribute,
       p_partkey AS line
FROM (
    SELECT *, gene + CAST(floor(gene / 10) AS BIGINT) * 3 AS place, CAST(floor(p_partkey / 2) AS BIGINT) % 2 AS exon
    FROM (SELECT CAST(p_partkey AS BIGINT) AS p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(floor(p_partkey / 4) AS BIGINT) AS gene FROM {part}) AS a
) AS b
"""

#: Exons by transcript over the places of JUNCTIONS, some of them on another chromosome, in both notations of attributes, and other features between them.
ANNOTATION = """
SELECT 'chr' || CAST(1 + (gi + CASE WHEN j = 5 THEN 1 ELSE 0 END) % 3 AS STRING) AS seqname, 'x' AS source, CASE WHEN j = 14 THEN 'gene' WHEN c_custkey % 41 = 0 THEN 'CDS' ELSE 'exon' END AS feature,
       gi * 200000 + CASE WHEN j < 7 THEN 1000 * (1 + j) - 200 ELSE 100000 + 1000 * (j - 7) END AS "start", gi * 200000 + CASE WHEN j < 7 THEN 1000 * (1 + j) ELSE 100200 + 1000 * (j - 7) END AS "end",
       '.' AS score, CASE WHEN gi % 2 = 0 THEN '+' ELSE '-' END AS strand, '.' AS frame,
       CASE WHEN c_custkey % 29 = 0 THEN 'note "none"' WHEN gi % 2 = 0 THEN 'gene_id "g' || CAST(gi AS STRING) || '"; transcript_id "T' || CAST(gi AS STRING) || '.' || CAST(j % 3 AS STRING) || '"; exon ' || CAST(j AS STRING)
            ELSE 'ID=e' || CAST(c_custkey AS STRING) || ';Parent=T' || CAST(gi AS STRING) || '.' || CAST(j % 3 AS STRING) || ';gene=g' || CAST(gi AS STRING) END AS attribute,
       c_custkey AS line
FROM (SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(floor(c_custkey / 150) AS BIGINT) * 10 + CAST(c_custkey AS BIGINT) % 10 AS gi, CAST(floor(c_custkey / 10) AS BIGINT) % 15 AS j FROM {customer}) AS a
"""

#: One distinct junction a row, with gene lists at both ends, for the repair of gene names.
CLASS_INPUT = """
SELECT 'chr' || CAST(1 + a % 2 AS STRING) || ':' || ga || ':' || CAST(pa AS STRING) || ':' || sa || '|chr' || CAST(CASE WHEN a % 9 = 0 THEN 3 ELSE 1 + a % 2 END AS STRING) || ':' || gb || ':' || CAST(pb AS STRING) || ':' || sb AS refName_ABR1,
       'chr' || CAST(1 + a % 2 AS STRING) AS chrR1A, 'chr' || CAST(CASE WHEN a % 9 = 0 THEN 3 ELSE 1 + a % 2 END AS STRING) AS chrR1B,
       ga AS geneR1A, gb AS geneR1B, pa AS juncPosR1A, pb AS juncPosR1B,
       CASE WHEN a % 2 = 0 THEN '+' ELSE '-' END AS read_strandR1A, CASE WHEN a % 7 = 0 THEN '-' ELSE '+' END AS read_strandR1B,
       CASE WHEN a % 3 = 0 THEN 'Chimeric' ELSE 'Aligned' END AS fileTypeR1
FROM (
    SELECT a, a * 1000 AS pa, a * 1000 + CASE WHEN a % 11 = 0 THEN 2000000 WHEN a % 4 = 0 THEN -500 ELSE 700 END AS pb,
           CASE a % 6 WHEN 0 THEN g0 WHEN 1 THEN 'SNORA1,' || g0 || ',G3' WHEN 2 THEN g1 || ',' || g0 || ',RP11-7' WHEN 3 THEN '' WHEN 4 THEN g0 || ',' || g1 ELSE 'unknown' END AS ga,
           CASE a % 5 WHEN 0 THEN g0 WHEN 1 THEN g1 || ',' || g2 WHEN 2 THEN g1 || ',SNORD5' WHEN 3 THEN g2 ELSE g1 || ',' || g2 || ',G6' END AS gb,
           CASE a % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '?' END AS sa, CASE a % 4 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '?' END AS sb
    FROM (
        SELECT CAST(p_partkey AS BIGINT) AS a, 'G' || CAST(CAST(floor(p_partkey / 4) AS BIGINT) AS STRING) AS g0,
               'G' || CAST(CAST(floor(p_partkey / 4) AS BIGINT) + 1 AS STRING) AS g1, 'G' || CAST(CAST(floor(p_partkey / 6) AS BIGINT) AS STRING) AS g2
        FROM {part}
    ) AS s
) AS t
"""

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    names = [t for t in TABLES if f"{{{t}}}" in sql]
    return spark.sql(sql.replace('"start"', "`start`").replace('"end"', "`end`"), **{t: _table(spark, sf_dir, t) for t in names})


def duck(sql: str) -> str:
    """The same text for DuckDB, where the tables are views."""
    for t in TABLES:
        sql = sql.replace(f"{{{t}}}", t)
    return sql


def junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each cell and junction with its reads: the core input, the rows of JUNCTIONS."""
    return _run(spark, sf_dir, _JUNCTIONS)


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned reads."""
    return _run(spark, sf_dir, READS)


def gtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, GTF)


def annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exons with transcripts."""
    return _run(spark, sf_dir, ANNOTATION)


def class_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, CLASS_INPUT)

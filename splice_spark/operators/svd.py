"""Principal components of each gene's cells x splice-sites matrix, without the matrix.

Contributions stay in long form.  The Gram matrix of the sites is a sum over
cells of products of the few sites a cell has in the gene, so it is a Spark
aggregate with partial sums; only a sites x sites matrix a gene goes to numpy,
and none for genes of many sites, whose first components are found by iteration.
With C = I - 11'/p, C (M'M) C is the Gram matrix of the row-centred M.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splice_spark.functions.joins import by_cell, dealt_by, lookup
from splice_spark.functions.lineage import cut
from splice_spark.operators.score import SIDES
from splice_spark.operators.subspace import top_components

TYPES = ("normdonor", "normgene")
LOADINGS = "gene string, component int, let string, pos long, loading double, centred double, f double"


def site_values(rows: DataFrame, svd_type: str = "normdonor") -> DataFrame:
    """``gene, cell, let, pos, value``: contributions of a cell to each of its sites; zeros are kept.

    ``normdonor`` divides by the cell's reads at the site, ``normgene`` by the root of its reads in the gene.
    """
    if svd_type not in TYPES:
        raise ValueError(f"svd_type must be one of {TYPES}")
    sides = F.array(*[F.struct(F.lit(s).alias("let"), F.col(f"junc{s}").alias("pos"), F.coalesce(F.col("numReads") * F.col(f"nSijk{s}"), F.lit(0.0)).alias("x")) for s in SIDES])
    out = rows.select(*by_cell(rows), "numReads", "n_g", F.explode(sides).alias("s")).groupBy(*by_cell(rows), "s.let", "s.pos")
    out = out.agg(F.sum("s.x").alias("x"), F.sum("numReads").alias("n"), F.first("n_g").alias("n_g"))
    scale = F.col("n") if svd_type == "normdonor" else F.sqrt("n_g")
    return out.select("gene", "cell", "let", "pos", (F.col("x") / scale).alias("value"), *dealt_by(rows))


def sites(values: DataFrame) -> DataFrame:
    """``gene, let, pos, n_cells``: all sites of a gene, and the gene's cells."""
    cells = values.groupBy("gene").agg(F.count_distinct("cell").alias("n_cells"))
    return values.select("gene", "let", "pos").distinct().join(cells, "gene")


def gene_gram(values: DataFrame) -> DataFrame:
    """``gene, let_i, pos_i, let_j, pos_j, g``: the upper triangle of M'M before centring, zeros left out.

    A cell's products are made inside its (gene, cell) group, whose size is the sites of one cell.
    """
    v = F.sort_array(F.collect_list(F.struct("let", "pos", "value")))
    cells = values.filter("value != 0").groupBy(*by_cell(values)).agg(v.alias("v"))
    first = cells.select("gene", "v", F.posexplode("v").alias("k", "i"))
    pairs = first.select("gene", "i", F.explode(F.slice("v", F.col("k") + 1, F.size("v"))).alias("j"))
    return pairs.groupBy("gene", F.col("i.let").alias("let_i"), F.col("i.pos").alias("pos_i"), F.col("j.let").alias("let_j"), F.col("j.pos").alias("pos_j")).agg(F.sum(F.col("i.value") * F.col("j.value")).alias("g"))


def total_energy(gram: DataFrame, where: DataFrame) -> DataFrame:
    """``gene, energy``: the sum of all squared singular values, tr(M'M) - 1'(M'M)1 / p."""
    p = where.groupBy("gene").agg(F.count("*").alias("p"))
    same = (F.col("let_i") == F.col("let_j")) & (F.col("pos_i") == F.col("pos_j"))
    sums = gram.groupBy("gene").agg(F.sum(F.when(same, F.col("g")).otherwise(0.0)).alias("t"), F.sum(F.when(same, F.col("g")).otherwise(2 * F.col("g"))).alias("a"))
    return p.join(sums, "gene", "left").select("gene", F.coalesce(F.col("t") - F.col("a") / F.col("p"), F.lit(0.0)).alias("energy"))


def components_of(m: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` right singular vectors (columns) and their share of the energy, from the Gram matrix of the sites before centring.

    The loading of largest size is positive (the first site of several).
    """
    m = m - m.mean(axis=0)
    m -= m.mean(axis=1)[:, None]
    values, vectors = np.linalg.eigh((m + m.T) / 2)
    values, vectors = np.maximum(values[::-1][:n], 0.0), vectors[:, ::-1][:, :n]
    vectors = vectors * np.where(vectors[np.argmax(np.round(np.abs(vectors), 9), axis=0), np.arange(n)] >= 0, 1, -1)
    energy = float(np.trace(m))
    return vectors, values / energy if energy > 0 else np.full(n, np.nan)


def _direct(k: int, all_components: bool):
    """Components of genes that are a row each: sites in order, cells, and products of sites."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                places = batch.column("sites")[r].values
                let, pos = places.field("let").to_pylist(), places.field("pos").to_pylist()
                p, cells = len(pos), batch.column("n_cells")[r].as_py()
                n = min(p, cells)
                if n < k or not n:
                    continue
                n = n if all_components else k
                index = {key: i for i, key in enumerate(zip(let, pos, strict=True))}
                m = np.zeros((p, p))
                if (products := batch.column("products")[r].values) is not None:
                    i, j = ([index[key] for key in zip(products.field(f"let_{x}").to_pylist(), products.field(f"pos_{x}").to_pylist(), strict=True)] for x in "ij")
                    m[i, j] = m[j, i] = products.field("g").to_numpy()
                vectors, shares = components_of(m, n)
                columns = [
                    pa.array([batch.column("gene")[r].as_py()] * (n * p), pa.string()), pa.array(np.repeat(np.arange(n, dtype=np.int32), p)), pa.array(let * n, pa.string()), pa.array(pos * n, pa.int64()),
                    pa.array(vectors.T.ravel()), pa.array((vectors - vectors.mean(axis=0)).T.ravel()), pa.array(np.repeat(shares, p)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in LOADINGS.split(", ")])

    return run


#: Sites of a gene whose matrix one task may hold: 8 MB of numbers, and its Gram matrix in rows.
DIRECT_SITES = 1_000


def gene_components(values: DataFrame, k: int = 3, all_components: bool = False, direct_sites: int = DIRECT_SITES) -> DataFrame:
    """``gene, component, let, pos, loading, centred, f``: the first ``k`` components of all genes with ``k`` cells and ``k`` sites or more.

    Genes of ``direct_sites`` or fewer are solved from their Gram matrix, larger ones by iteration over their cells (``splice_spark.operators.subspace``).
    ``all_components`` solves every gene from its matrix, in one task that has sites x sites numbers, and gives as many rows.  ``values`` is a written table.
    """

    where = cut(sites(values))
    large = cut(where.groupBy("gene").agg(F.count("*").alias("p"), F.first("n_cells").alias("n_cells")).filter(F.col("p") > direct_sites).filter(F.col("n_cells") >= k))
    small_values, small_where = values, where
    if split := not (all_components or large.isEmpty()):
        marks = large.select("gene", F.lit(True).alias("large"))
        small_values, small_where = (lookup(x, marks, ["gene"], "left").filter("large is null").drop("large") for x in (values, where))
    # a gene's sites, of which there are direct_sites at most, and their products meet in one row
    one = small_where.groupBy("gene").agg(F.sort_array(F.collect_list(F.struct("let", "pos"))).alias("sites"), F.first("n_cells").alias("n_cells"))
    products = gene_gram(small_values).groupBy("gene").agg(F.collect_list(F.struct("let_i", "pos_i", "let_j", "pos_j", "g")).alias("products"))
    out = one.join(products, "gene", "left").mapInArrow(_direct(k, all_components), LOADINGS)
    if split:
        out = out.unionByName(top_components(values, where, large, k))
    return out.withColumn("f", F.nanvl("f", F.lit(None).cast("double")))


def svd_scores(values: DataFrame, loadings: DataFrame, k: int = 3) -> DataFrame:
    """``gene, cell, svd_z0..``: cells projected on the components; centring is in the loadings."""
    wide = loadings.groupBy("gene", "let", "pos").pivot("component", list(range(k))).agg(F.first("centred"))
    got = lookup(values, wide, ["gene", "let", "pos"])
    return got.groupBy(*by_cell(values)).agg(*[F.sum(F.col("value") * F.col(f"`{c}`")).alias(f"svd_z{c}") for c in range(k)])


def fractions(loadings: DataFrame, k: int = 3) -> DataFrame:
    """``gene, f0..``: share of the energy of each component."""
    return loadings.groupBy("gene").agg(*[F.max(F.when(F.col("component") == c, F.col("f"))).alias(f"f{c}") for c in range(k)])


def add_svd(scores: DataFrame, values: DataFrame, loadings: DataFrame, k: int = 3) -> DataFrame:
    """Scores with ``svd_z*, f*`` and ``svd_z_sumsq``, which is 0 without components."""
    projected = svd_scores(values, loadings, k)
    keys = [*("gene", "cell"), *[c for c in dealt_by(scores) if c in projected.columns]]
    out = lookup(scores.join(projected.drop(*[c for c in dealt_by(projected) if c not in keys]), keys, "left"), fractions(loadings, k), ["gene"], "left")
    energy = sum((F.coalesce(F.col(f"svd_z{c}") ** 2, F.lit(0.0)) for c in range(k)), F.lit(0.0))
    return out.withColumn("svd_z_sumsq", energy)

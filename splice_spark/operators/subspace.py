"""First components of genes with many sites, by iteration of a block of vectors over the genes' cells.

With M the cells x sites matrix of a gene and C = I - 11'/p, the wanted vectors
are the first eigenvectors of B = C M'M C.  B is never formed: a block of a few
vectors, a row a site, is multiplied by M (a sum by cell), by M' (a sum by site)
and centred.  Each cycle solves the problem inside the block (Rayleigh and
Ritz), tests residuals, and drives the block towards the first vectors by a
Chebyshev polynomial of B that is small where the unwanted values are.  All
large genes go through the same Spark jobs; only block x block numbers of a gene
meet in one row.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splice_spark.functions.joins import lookup
from splice_spark.functions.lineage import cut
from splice_spark.functions.ordering import number_within

#: Vectors of a block beyond those wanted, degree of the polynomial, residual (share of the largest value), and cycles at most.
EXTRA, DEGREE, TOLERANCE, CYCLES = 5, 8, 1e-10, 40


def _times(values: DataFrame, block: DataFrame, b: int, name: str) -> DataFrame:
    """``block`` (``gene, s`` and columns ``name0..``, centred) with B times it in ``t0..``."""
    numbers = [f"{name}{j}" for j in range(b)]
    by_cell = lookup(values, block.select("gene", "s", *numbers), ["gene", "s"]).groupBy("gene", "cell").agg(*[F.sum(F.col("value") * F.col(c)).alias(f"u{j}") for j, c in enumerate(numbers)])
    by_site = values.join(by_cell, ["gene", "cell"]).groupBy("gene", "s").agg(*[F.sum(F.col("value") * F.col(f"u{j}")).alias(f"t{j}") for j in range(b)])
    whole = cut(block.join(by_site, ["gene", "s"], "left").fillna(0.0, [f"t{j}" for j in range(b)]))
    means = whole.groupBy("gene").agg(*[F.avg(f"t{j}").alias(f"m{j}") for j in range(b)])
    return lookup(whole, means, ["gene"]).withColumns({f"t{j}": F.col(f"t{j}") - F.col(f"m{j}") for j in range(b)}).drop(*[f"m{j}" for j in range(b)])


def _ritz(b: int):
    """Per gene, from the products of a block with itself and with B times it: the turn to Ritz vectors, and their values in falling order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = [(i, j) for i in range(b) for j in range(i, b)]
        for batch in batches:
            turns, found = [], []
            for row in batch.to_pylist():
                g, h = np.zeros((b, b)), np.zeros((b, b))
                for n, (i, j) in enumerate(upper):
                    g[i, j] = g[j, i] = row["g"][n]
                    h[i, j] = h[j, i] = row["h"][n]
                scale = 1 / np.sqrt(np.where(np.diag(g) > 0, np.diag(g), np.inf))
                sizes, basis = np.linalg.eigh(g * scale[:, None] * scale)
                kept = sizes > 1e-12 * max(sizes.max(), 1e-300)
                basis = scale[:, None] * basis[:, kept] / np.sqrt(sizes[kept])
                values, inside = np.linalg.eigh(basis.T @ h @ basis)
                turn = np.zeros((b, b))  # vectors that the block doesn't span are 0
                turn[:, : kept.sum()] = (basis @ inside)[:, ::-1]
                turns.append(turn.ravel().tolist())
                found.append(np.concatenate([np.maximum(values[::-1], 0.0), np.zeros(b - kept.sum())]).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("gene"), pa.array(turns, pa.list_(pa.float64())), pa.array(found, pa.list_(pa.float64()))], names=["gene", "turn", "lam"])

    return run


def _turned(name: str, j: int, b: int) -> Column:
    return sum((F.col(f"{name}{i}") * F.col("turn")[i * b + j] for i in range(b)), F.lit(0.0))


def _filtered(values: DataFrame, block: DataFrame, b: int, degree: int) -> DataFrame:
    """The Chebyshev polynomial of B, scaled to stay near 1 at the largest value, of the Ritz vectors ``q`` with ``w`` = B q."""
    half = F.greatest(F.col("lam")[b - 1] / 2, F.col("lam")[0] * 1e-9, F.lit(1e-300))
    first = block.withColumn("e", half).withColumn("s1", F.col("e") / (F.greatest(F.col("lam")[0], 3 * F.col("e")) - F.col("e"))).withColumn("sg", F.col("s1"))
    step = lambda t, x: (F.col(t) - F.col("e") * F.col(x)) / F.col("e")
    now = first.select("gene", "s", "e", "s1", "sg", *[F.col(f"q{j}").alias(f"x{j}") for j in range(b)], *[(step(f"w{j}", f"q{j}") * F.col("s1")).alias(f"y{j}") for j in range(b)])
    for _ in range(degree - 1):
        got = _times(values, now, b, "y").withColumn("s2", 1 / (2 / F.col("s1") - F.col("sg")))
        new = [(2 * step(f"t{j}", f"y{j}") * F.col("s2") - F.col("sg") * F.col("s2") * F.col(f"x{j}")).alias(f"y{j}") for j in range(b)]
        now = cut(got.select("gene", "s", "e", "s1", F.col("s2").alias("sg"), *[F.col(f"y{j}").alias(f"x{j}") for j in range(b)], *new))
    return now.select("gene", "s", *[F.col(f"y{j}").alias(f"z{j}") for j in range(b)])


def top_components(values: DataFrame, where: DataFrame, large: DataFrame, k: int, extra: int = EXTRA, degree: int = DEGREE, tolerance: float = TOLERANCE, cycles: int = CYCLES) -> DataFrame:
    """``gene, component, let, pos, loading, centred, f`` of the first ``k`` components of the genes in ``large``.

    ``values`` has ``gene, cell, let, pos, value`` and ``where`` all sites.  A gene stays in the cycles until the residuals of its ``k`` vectors are under
    ``tolerance`` of its largest value; after ``cycles`` a warning names how many aren't.  Components without energy have loadings of 0.
    """
    b = k + extra
    known = lookup(where.select("gene", "let", "pos"), large.select("gene", "p"), ["gene"])
    names = cut(number_within(known, ["gene"], ["let", "pos"], "s"))
    cells = cut(lookup(values.filter("value != 0"), names.select("gene", "let", "pos", "s"), ["gene", "let", "pos"]).select("gene", "cell", "s", "value"))
    by_cell = cells.groupBy("gene", "cell").agg(F.sum("value").alias("a"), F.sum(F.col("value") ** 2).alias("v"))
    energy = lookup(by_cell.groupBy("gene").agg(F.sum("v").alias("v"), F.sum(F.col("a") ** 2).alias("a")), large.select("gene", "p"), ["gene"])
    energy = energy.select("gene", (F.col("v") - F.col("a") / F.col("p")).alias("energy"))
    start = names.select("gene", "s", *[(F.xxhash64("gene", "s", F.lit(j)) / F.lit(2.0**63)).alias(f"z{j}") for j in range(b)])
    means = start.groupBy("gene").agg(*[F.avg(f"z{j}").alias(f"m{j}") for j in range(b)])
    block = cut(lookup(start, means, ["gene"]).select("gene", "s", *[(F.col(f"z{j}") - F.col(f"m{j}")).alias(f"z{j}") for j in range(b)]))
    upper = [(i, j) for i in range(b) for j in range(i, b)]
    ready = []
    for cycle in range(cycles):
        both = cut(_times(cells, block, b, "z"))
        sums = both.groupBy("gene").agg(*[F.sum(F.col(f"z{i}") * F.col(f"{x}{j}")).alias(f"{n}{i}_{j}") for n, x in (("g", "z"), ("h", "t")) for i, j in upper])
        sums = sums.select("gene", *[F.array(*[f"{n}{i}_{j}" for i, j in upper]).alias(n) for n in "gh"])
        turns = sums.mapInArrow(_ritz(b), "gene string, turn array<double>, lam array<double>")
        turned = lookup(both, turns, ["gene"]).select("gene", "s", "lam", *[_turned(x, j, b).alias(f"{n}{j}") for n, x in (("q", "z"), ("w", "t")) for j in range(b)])
        turned = cut(turned)
        off = [F.sum((F.col(f"w{j}") - F.col("lam")[j] * F.col(f"q{j}")) ** 2) for j in range(k)]
        rest = turned.groupBy("gene").agg((F.greatest(*off) > (F.max(F.col("lam")[0]) * tolerance) ** 2).alias("open"))
        rest = cut(rest.filter("open") if cycle + 1 < cycles else _told(rest))
        marked = lookup(turned, rest, ["gene"], "left")
        ready.append(cut(marked.filter("open is null").select("gene", "s", "lam", *[f"q{j}" for j in range(k)])))
        if rest.isEmpty():
            break
        cells = cut(lookup(cells, rest.select("gene"), ["gene"]))
        block = cut(_filtered(cells, cut(marked.filter("open").drop("open")), b, degree))
    found = ready[0]
    for more in ready[1:]:
        found = found.unionByName(more)
    vectors = F.array(*[F.struct(F.lit(j).alias("component"), F.col(f"q{j}").alias("x"), F.col("lam")[j].alias("value")) for j in range(k)])
    long = cut(found.select("gene", "s", F.explode(vectors).alias("v")).select("gene", "s", "v.*"))
    largest = F.max(F.struct(F.round(F.abs("x"), 9).alias("size"), (-F.col("s")).alias("s"), F.col("x").alias("x")))
    signs = long.groupBy("gene", "component").agg(F.when(largest["x"] < 0, -1.0).otherwise(1.0).alias("sign"), F.avg("x").alias("mean"))
    out = lookup(lookup(long, signs, ["gene", "component"]), energy, ["gene"], "left").join(names, ["gene", "s"])
    share = F.when(F.col("energy") > 0, F.col("value") / F.col("energy"))
    return out.select("gene", "component", "let", "pos", (F.col("x") * F.col("sign")).alias("loading"), ((F.col("x") - F.col("mean")) * F.col("sign")).alias("centred"), share.alias("f"))


def _told(rest: DataFrame) -> DataFrame:
    """An empty table, after a warning if genes are still open."""
    if n := rest.filter("open").count():
        warnings.warn(f"{n} genes have components whose residuals are above the tolerance", stacklevel=3)
    return rest.limit(0)

"""Permuted statistics of tests with any number of cells.

A permutation is a number for each cell index (``stats.permutation_keys``); cells
in the order of their numbers are cut into groups of the observed sizes.  So the
group of a cell follows from its index alone once the bounds between groups are
known, and those follow from the number of cells: ``key_bounds`` finds them
without any cell.  No cell is copied and no task has a whole test:

1. cells get their index and, by value, their part of about ``part_rows`` cells;
2. each part gives, for each permutation and group, its number of cells, sum and
   sum of squares; added up over parts these give variances, and say in which
   part the middle cells of each group are;
3. those parts pick the middle values, from which the statistics follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splice_spark.functions.joins import lookup
from splice_spark.functions.lineage import cut
from splice_spark.functions.ordering import number_within
from splice_spark.functions.stats import permutation_keys

#: Cells of a part, and permutations whose sums travel together.
PART_ROWS, BLOCK = 100_000, 10


def placed_keys(i: np.ndarray, seed: int, perm: int) -> np.ndarray:
    """The permutation's number of each cell index and, below it, the index: all different, and ordered as the permutation is."""
    return permutation_keys(0, seed, np.array([perm]), i)[0] << 32 | i


def key_bounds(n: int, seed: int, perm: int, ends: list[int], chunk: int = 1 << 20) -> np.ndarray:
    """The placed key of rank ``e`` among those of ``n`` cells, for each of ``ends``; only counts and a few ranges of keys are held."""
    if not ends:
        return np.zeros(0, np.int64)
    pieces = lambda: (placed_keys(np.arange(k, min(n, k + chunk), dtype=np.int64), seed, perm) for k in range(0, n, chunk))
    shift = 47  # 31 bits of keys over 32 of indices; 65,536 ranges
    upto = np.cumsum(sum(np.bincount(p >> shift, minlength=1 << 16) for p in pieces()))
    bins = np.searchsorted(upto, ends, "right")
    wanted = np.zeros(1 << 16, bool)
    wanted[bins] = True
    inside = np.sort(np.concatenate([p[wanted[p >> shift]] for p in pieces()]))
    first = np.searchsorted(inside >> shift, bins)
    return inside[first + np.array(ends) - np.where(bins > 0, upto[bins - 1], 0)]


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            ends = np.cumsum(r["sizes"])[:-1].tolist()
            yield pa.RecordBatch.from_arrays([pa.array([r["t"]], pa.int64()), pa.array([r["perm"]], pa.int64()), pa.array([key_bounds(r["n"], r["seed"], r["perm"], ends).tolist()], pa.list_(pa.int64()))], names=["t", "perm", "bounds"])


def _packed(key: tuple, table: pa.Table) -> pa.Table:
    """The cells of a part in the order of their values."""
    order = np.argsort(table.column("zr").to_numpy())
    data = [np.ascontiguousarray(table.column(c).to_numpy()[order]).tobytes() for c in ("i", "z")]
    return pa.table([pa.array([k.as_py()], pa.int64()) for k in key] + [pa.array([x], pa.binary()) for x in data], names=["t", "part", "i", "z"])


def _groups(i: np.ndarray, seed: int, perm: int, bounds: list[int]) -> np.ndarray:
    return np.searchsorted(np.array(bounds, np.int64), placed_keys(i, seed, perm), "right")


def _part_sums(n_perms: int):
    """Per block of permutations: numbers, sums and sums of squares (less the test's mean) of a part's cells, permutations x groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in ("t", "part", "i", "z", "seed", "bounds", "mean")}
                i, z = np.frombuffer(row["i"], np.int64), np.frombuffer(row["z"], np.float64) - row["mean"]
                for block in range(0, n_perms, BLOCK):
                    out = []
                    for bounds in row["bounds"][block : block + BLOCK]:
                        g, size = _groups(i, row["seed"], bounds["perm"], bounds["bounds"]), len(bounds["bounds"]) + 1
                        out.append([np.bincount(g, w, minlength=size) for w in (None, z, z * z)])
                    yield pa.RecordBatch.from_arrays([pa.array([row["t"]], pa.int64()), pa.array([block], pa.int64()), pa.array([row["part"]], pa.int64()), pa.array([np.array(out, np.float64).tobytes()], pa.binary())], names=["t", "block", "part", "sums"])

    return run


def _middles(key: tuple, table: pa.Table) -> pa.Table:
    """From all parts of a block of permutations: where the middle cells of each group are, and its number of cells and variance."""
    t, block = key[0].as_py(), key[1].as_py()
    order = np.argsort(table.column("part").to_numpy())
    parts = table.column("part").to_numpy()[order]
    groups = table.column("groups")[0].as_py()
    sums = np.stack([np.frombuffer(table.column("sums")[k].as_py(), np.float64).reshape(-1, 3, groups) for k in order.tolist()])
    upto = np.cumsum(sums[:, :, 0], axis=0)
    n, s, q = sums.sum(axis=0).transpose(1, 0, 2)
    var = np.where(n > 1, np.maximum(q - s * s / np.maximum(n, 1), 0.0) / np.maximum(n - 1, 1), np.nan)
    rows = []
    for p in range(n.shape[0]):
        for g in range(groups):
            for place in {int(n[p, g] - 1) // 2, int(n[p, g]) // 2}:
                k = int(np.searchsorted(upto[:, p, g], place, "right"))
                rows.append((t, int(parts[k]), block + p, g, place - int(upto[k - 1, p, g] if k else 0), int(n[p, g]), float(var[p, g])))
    names = ["t", "part", "perm", "g", "place", "n", "var"]
    return pa.table([pa.array(c, pa.float64() if x == "var" else pa.int64()) for x, c in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The middle values that a part was asked for."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {c: batch.column(c)[r].as_py() for c in ("t", "i", "z", "seed", "bounds", "asked")}
            i, z = np.frombuffer(row["i"], np.int64), np.frombuffer(row["z"], np.float64)
            before, rows = None, []
            for a in sorted(row["asked"], key=lambda a: (a["perm"], a["g"])):
                if before != a["perm"]:
                    before = a["perm"]
                    g = _groups(i, row["seed"], before, row["bounds"][before]["bounds"])
                    order, starts = np.argsort(g, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(g))])
                rows.append((row["t"], a["perm"], a["g"], float(z[order[starts[a["g"]] + a["place"]]]), a["n"], a["var"]))
            names = ["t", "perm", "g", "z", "n", "var"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if x in ("z", "var") else pa.int64()) for x, c in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def permuted_tests(cells: DataFrame, tests: DataFrame, n_perms: int, var_add: float, part_rows: int = PART_ROWS) -> DataFrame:
    """``t, perm, statistic``: variance-weighted spread of the permuted groups' medians.

    ``cells`` has ``t, level_2, cell, z`` without nulls; ``tests`` has ``t, seed``.  Cells are indexed by level 2 and cell.
    """
    cells = number_within(number_within(cells.select("t", "level_2", "cell", "z"), ["t"], ["level_2", "cell"], "i"), ["t"], ["z", "i"], "zr")
    cells = cut(cells.select("t", "level_2", "i", "zr", "z", F.floor(F.col("zr") / part_rows).alias("part")))
    sizes = cells.groupBy("t", "level_2").agg(F.count("*").alias("n"), F.sum("z").alias("s"))
    sizes = sizes.groupBy("t").agg(F.transform(F.sort_array(F.collect_list(F.struct("level_2", "n"))), lambda x: x["n"]).alias("sizes"), F.sum("n").alias("n"), (F.sum("s") / F.sum("n")).alias("mean"))
    known = cut(lookup(tests.select("t", "seed"), sizes, ["t"]))
    asked = known.select("t", "seed", "n", "sizes", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_perms - 1).cast("long"))).alias("perm")).repartition("t", "perm")
    bounds = asked.mapInArrow(_bounds, "t long, perm long, bounds array<long>")
    bounds = bounds.groupBy("t").agg(F.sort_array(F.collect_list(F.struct("perm", "bounds"))).alias("bounds"))
    known = cut(known.select("t", "seed", "mean", F.size("sizes").alias("groups")).join(bounds, "t"))  # a row a test
    parts = cut(cells.select("t", "part", "i", "zr", "z").groupBy("t", "part").applyInArrow(_packed, "t long, part long, i binary, z binary"))
    sums = parts.join(known.select("t", "seed", "mean", "bounds"), "t").mapInArrow(_part_sums(n_perms), "t long, block long, part long, sums binary")
    middles = sums.join(known.select("t", "groups"), "t").groupBy("t", "block").applyInArrow(_middles, "t long, part long, perm long, g long, place long, n long, var double")
    wanted = middles.groupBy("t", "part").agg(F.collect_list(F.struct("perm", "g", "place", "n", "var")).alias("asked"))  # two a permutation and group at most
    picked = parts.join(wanted, ["t", "part"]).join(known.select("t", "seed", "bounds"), "t").mapInArrow(_picked, "t long, perm long, g long, z double, n long, var double")
    medians = picked.groupBy("t", "perm", "g").agg(F.avg("z").alias("m"), (F.first("n") / (F.first("var") + var_add)).alias("w"))
    return medians.groupBy("t", "perm").agg(F.collect_list(F.struct("w", "m")).alias("gs")).select("t", "perm", _spread(F.col("gs")).alias("statistic"))


def _spread(groups: Column) -> Column:
    add = lambda f: F.aggregate(groups, F.lit(0.0), lambda s, x: s + f(x))
    mean = add(lambda x: x["w"] * x["m"]) / add(lambda x: x["w"])
    return add(lambda x: x["w"] * (x["m"] - mean) * (x["m"] - mean))

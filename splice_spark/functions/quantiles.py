"""Exact quantiles of a weighted column without bringing its values to one task."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splice_spark.functions.joins import lookup
from splice_spark.functions.lineage import cut

BINS = 1024


def _around(counts: DataFrame, place: int, most: int) -> tuple[list, int]:
    """Rows (value, n) of a range of at most ``most`` values that holds the one at ``place``, and how many stand before it."""
    low, high, size = counts.agg(F.min("v"), F.max("v"), F.count("*")).first()
    before = 0
    while size > most and high > low:
        step = F.least(F.lit(BINS - 1), F.floor((F.col("v") - low) / ((high - low) / BINS)))
        inside = counts.filter(F.col("v").between(low, high))
        bins = sorted(tuple(r) for r in inside.groupBy(step.alias("bin")).agg(F.sum("n"), F.count("*"), F.min("v"), F.max("v")).collect())
        for _, n, many, first, last in bins:
            if place < before + n:
                low, high, size = first, last, many
                break
            before += n
    return sorted(tuple(r) for r in counts.filter(F.col("v").between(low, high)).collect()), before


def weighted_quantiles(df: DataFrame, name: str | Column, freq: str | Column, quantiles: list[float], most: int = 50_000) -> list[float] | None:
    """Quantiles of ``name``, each value counting ``freq`` times, interpolated between neighbours; nulls don't count, and there is none without values.

    Equal values are counted first.  If more than ``most`` are left, they are written, and histograms of ranges narrow
    down on the range of the wanted one, so that ``most`` values are looked at one by one in any case.
    """
    value = F.col(name) if isinstance(name, str) else name
    weight = F.col(freq) if isinstance(freq, str) else freq
    counts = df.select(value.cast("double").alias("v"), weight.cast("long").alias("n")).filter("v is not null and n > 0").groupBy("v").agg(F.sum("n").alias("n"))
    rows, before = sorted(tuple(r) for r in counts.limit(most + 1).collect()), 0
    if not rows:
        return None
    if few := len(rows) <= most:
        total = sum(n for _, n in rows)
    else:
        counts = cut(counts)
        total, rows = counts.agg(F.sum("n")).first()[0], []
    places = [(total - 1) * q for q in quantiles]
    found = {}
    for place in sorted({f(p) for p in places for f in (math.floor, math.ceil)}):
        ends = before + np.cumsum([n for _, n in rows])
        if not few and not (len(rows) and before <= place < ends[-1]):
            rows, before = _around(counts, place, most)
            ends = before + np.cumsum([n for _, n in rows])
        found[place] = float(rows[int(np.searchsorted(ends, place, "right"))][0])
    return [found[math.floor(p)] + (found[math.ceil(p)] - found[math.floor(p)]) * (p - math.floor(p)) for p in places]


#: Rows of a group that one task may hold for its median.
MOST = 100_000


def _halves(long: DataFrame, groups: list[str]) -> DataFrame:
    """Per group: count, the two middle places (one, if odd), and the range of its values."""
    state = long.groupBy(*groups).agg(F.count("*").alias("size"), F.min("v").alias("low"), F.max("v").alias("high"))
    last = F.col("size") - 1
    return state.withColumns({"a": F.floor(last / 2), "b": F.ceil(last / 2), "before": F.lit(0).cast("long")})


def selected_medians(long: DataFrame, groups: list[str], most: int = MOST) -> DataFrame:
    """``groups, median`` of the finite column ``v`` of a written table, for large groups, all of them at once.

    Each round counts the values of every open group in ``BINS`` ranges between its least and greatest candidate, and keeps the range that
    holds the middle.  If the two middle values are in different ranges, they are the greatest of the one and the least of the other.  A group
    is settled when its candidates are equal, or ``most`` or fewer, which one task then orders.
    """
    state, done = cut(_halves(long, groups)), None
    middle = (F.col("x") + F.col("y")) / 2
    while True:
        equal = state.filter("low = high").select(*groups, F.col("low").alias("median"))
        few = lookup(long, state.filter(f"low < high and size <= {most}"), groups).filter(F.col("v").between(F.col("low"), F.col("high")))
        place = F.row_number().over(Window.partitionBy(*groups).orderBy("v")) - 1 + F.col("before")
        at = lambda c: F.max(F.when(F.col("place") == F.col(c), F.col("v")))
        settled = few.withColumn("place", place).groupBy(*groups).agg(at("a").alias("x"), at("b").alias("y")).select(*groups, middle.alias("median"))
        done = [*(done or []), cut(equal.unionByName(settled))]
        todo = cut(state.filter(f"low < high and size > {most}"))
        if todo.isEmpty():
            break
        # halves, so that the width of a range never overflows; the greatest value is alone at the end of the last range
        width = lambda to: to / 2 - F.col("low") / 2
        number = F.when(F.col("v") >= F.col("high"), BINS - 1).otherwise(F.least(F.lit(BINS - 2), F.floor(width(F.col("v")) / width(F.col("high")) * (BINS - 1))))
        inside = lookup(long, todo, groups).filter(F.col("v").between(F.col("low"), F.col("high"))).withColumn("bin", number)
        bins = inside.groupBy(*groups, "bin").agg(F.count("*").alias("n"), F.min("v").alias("first"), F.max("v").alias("last"), *[F.first(c).alias(c) for c in ("a", "b", "before")])
        ends = F.col("before") + F.sum("n").over(Window.partitionBy(*groups).orderBy("bin"))
        holds = bins.withColumn("end", ends).withColumn("start", F.col("end") - F.col("n"))
        has = lambda c: (F.col(c) >= F.col("start")) & (F.col(c) < F.col("end"))
        of = lambda c, x: F.max(F.when(has(c), F.col(x)))
        found = holds.groupBy(*groups).agg(*[of("a", x).alias(f"a_{x}") for x in ("bin", "first", "last", "n", "start")], of("b", "bin").alias("b_bin"), of("b", "first").alias("b_first"), F.max("a").alias("a"), F.max("b").alias("b"))
        found = cut(found)
        done.append(found.filter("a_bin <> b_bin").select(*groups, ((F.col("a_last") + F.col("b_first")) / 2).alias("median")))
        state = found.filter("a_bin = b_bin").select(*groups, F.col("a_n").alias("size"), F.col("a_first").alias("low"), F.col("a_last").alias("high"), "a", "b", F.col("a_start").alias("before"))
        state = cut(state)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def grouped_medians(df: DataFrame, keys: list[str], columns: list[str], *also: Column, most: int = MOST) -> DataFrame:
    """``keys``, ``{column}_median`` and the aggregates ``also`` of each group, null keys included; NaN counts as null in medians.

    Groups of ``most`` rows or fewer are left to Spark's median, which holds a group's values in one task; the values of larger ones go into ``selected_medians``.
    """
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    each = [F.median(number(c)).alias(f"{c}_median") for c in columns]
    large = cut(df.groupBy(*keys).agg(F.count("*").alias("n__")).filter(F.col("n__") > most))
    if large.isEmpty():
        return df.groupBy(*keys).agg(*each, *also)
    key = F.to_json(F.struct(*keys)).alias("key__")  # leaves nulls out, so that it is never null itself
    marked = lookup(df.withColumn("key__", key), large.select(key, F.lit(True).alias("large__")), ["key__"], "left")
    small = marked.filter("large__ is null").groupBy(*keys).agg(*each, *also)
    rest = marked.filter("large__").groupBy("key__", *keys).agg(F.count("*").alias("n__"), *also)
    long = marked.filter("large__").select("key__", *[number(c).alias(c) for c in columns]).unpivot(["key__"], columns, "column__", "v").filter("v is not null")
    wide = selected_medians(cut(long), ["key__", "column__"], most).groupBy("key__").pivot("column__", columns).agg(F.first("median"))
    found = lookup(rest, wide.select("key__", *[F.col(c).alias(f"{c}_median") for c in columns]), ["key__"], "left")
    return small.unionByName(found.select(*small.columns))

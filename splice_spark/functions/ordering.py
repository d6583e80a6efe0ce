"""Places, running sums and suffix minima in a global order, without bringing the order to one task.

Rows are dealt over range partitions, which are written with their number.  What
holds across partitions (rows before, least value behind) is worked out on a
table of one row a partition, or a partition and group, and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splice_spark.functions.joins import lookup
from splice_spark.functions.lineage import cut

PART = "part__"


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """``df``, written, with the number of its range partition: rows of a lower number come first; rows equal in ``order`` share one."""
    return cut(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def _before(counts: DataFrame, groups: list[str], n: str) -> DataFrame:
    """``counts`` (a row for each group and partition) with the sum of ``n`` over the group's earlier partitions in ``before__``."""
    earlier = Window.partitionBy(*groups).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before__", F.coalesce(F.sum(n).over(earlier), F.lit(0)))


def number_within(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with the place (from 0) of each row in its group by ``order``, which has no ties; groups aren't null.

    A group may span all partitions: each task numbers what it has, and adds the rows of the group in earlier partitions.
    """
    dealt = in_ranges(df, *groups, *order)
    before = _before(dealt.groupBy(*groups, PART).agg(F.count("*").alias("n__")), groups, "n__").drop("n__")
    here = Window.partitionBy(*groups, PART).orderBy(*order)
    placed = dealt.withColumn(name, F.row_number().over(here).cast("long") - 1)
    return lookup(placed, before, [*groups, PART]).withColumn(name, F.col(name) + F.col("before__")).drop("before__", PART)


def adjusted_by_rank(values: DataFrame, name: str, n: str, out: str) -> DataFrame:
    """``name, out`` for a table of distinct values with counts ``n``: the least of 1 and ``value * total / rank`` over this value and all greater
    ones, where the rank of a value is the count of values up to it (Benjamini-Hochberg)."""
    dealt = in_ranges(values.select(name, n), name)
    # the partitions' totals: a row each, gathered in one group
    ranges = cut(_before(dealt.groupBy(PART).agg(F.sum(n).alias("n__")).withColumn("all__", F.lit(0)), ["all__"], "n__").withColumn("total__", F.sum("n__").over(Window.partitionBy("all__"))))
    up = Window.partitionBy(PART).orderBy(name)
    ranked = dealt.join(F.broadcast(ranges.select(PART, "before__", "total__")), PART)  # as many rows as partitions
    ranked = cut(ranked.withColumn("q__", F.col(name) * F.col("total__") / (F.sum(n).over(up) + F.col("before__"))))
    behind = Window.partitionBy("all__").orderBy(F.col(PART).desc()).rowsBetween(Window.unboundedPreceding, -1)
    least = ranked.groupBy(PART).agg(F.min("q__").alias("q__")).withColumn("all__", F.lit(0)).withColumn("behind__", F.min("q__").over(behind))
    down = Window.partitionBy(PART).orderBy(F.col(name).desc())
    met = ranked.join(F.broadcast(least.select(PART, "behind__")), PART)
    return met.select(name, F.least(F.lit(1.0), F.min("q__").over(down), "behind__").alias(out))

"""Joins of cell rows with tables of one row a key, whose hot keys are dealt over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splice_spark.functions.lineage import cut, cut_buckets

#: Broadcast up to so many bytes, as ``counted_bytes`` counts them.
BROADCAST_BYTES = 64 << 20
#: A key with one in so many rows, or more, is hot: there are as many hot keys at most, and each is dealt over ``SALTS`` tasks.
SHARE, SALTS = 256, 64
#: Counters of the sketch that finds hot keys; it misses none with more than a few of this share of the rows.
COUNTERS = 4096


def counted_bytes(table: DataFrame) -> int:
    """Bytes of all rows: of strings their own, 8 a number or element of an array, and 16 a column and row beside."""

    def size(name: str, kind: str) -> Column:
        value = F.octet_length(name) if kind in ("string", "binary") else 8 * F.size(name) if kind.startswith("array") else F.lit(8)
        return F.coalesce(value.cast("long"), F.lit(0)) + 16

    return table.agg(F.sum(sum((size(f"`{c}`", k) for c, k in table.dtypes), F.lit(0)))).first()[0] or 0


def hot_hashes(rows: DataFrame, keys: list[str], share: int = SHARE) -> list[int]:
    """Hashes of the keys that one in ``share`` rows or more have: from one pass over the key columns, by a sketch of counters that tasks merge.

    Null keys count too.
    """
    return _hot_and_rows(rows, keys, share)[0]


def _hot_and_rows(rows: DataFrame, keys: list[str], share: int = SHARE) -> tuple[list[int], int]:
    hashes = rows.select(F.xxhash64(*keys).alias("h"))
    found, n = hashes.agg(F.expr(f"approx_top_k(h, {share}, {COUNTERS})"), F.count("*")).first()
    return sorted(x["item"] for x in found or [] if x["count"] * share >= n), n


#: Rows of a bucket, and rows below which a table isn't dealt.
BUCKET_ROWS, LEAST_DEALT = 400_000, 50_000
_dealings: dict[str, tuple[int, list[int]]] = {}


def deal(rows: DataFrame, least: int | None = None) -> DataFrame:
    """``rows`` written in buckets of genes, once shuffled: what follows by gene and cell, or joins by gene, moves none of them again.

    Genes with one in ``SHARE`` rows or more are dealt by cell over ``SALTS`` shares; a column that only ``by_cell``, ``lookup`` and ``cut_dealt`` look at
    has the share, 0 for other genes.  Small tables are written as they are.  The genes are counted in a pass of its own, so ``rows`` should be stored.
    """
    hot, n = _hot_and_rows(rows, ["gene"])
    if n < (LEAST_DEALT if least is None else least):
        return cut(rows)
    name = f"deal__{len(_dealings)}"
    rows.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")  # buckets are of gene and share, keys of joins have more
    _dealings[name] = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // BUCKET_ROWS)), hot
    share = F.when(F.xxhash64("gene").isin(hot), F.pmod(F.xxhash64("cell"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    return cut_dealt(rows.withColumn(name, share))


def dealt_by(rows: DataFrame) -> list[str]:
    """The column of shares of ``rows`` that come from ``deal``, or none."""
    return [c for c in rows.columns if c in _dealings]


def by_cell(rows: DataFrame) -> list[str]:
    """``cell, gene``, and the share of dealt rows, which follows from them: keys of groups and windows."""
    return ["cell", "gene", *dealt_by(rows)]


def cut_dealt(rows: DataFrame) -> DataFrame:
    """``cut`` that keeps the buckets of dealt rows."""
    if not (name := dealt_by(rows)):
        return cut(rows)
    n = _dealings[name[0]][0]
    return cut_buckets(rows.repartition(n, "gene", *name), n, ["gene", *name])


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` joined with ``table``, which has one row a key; ``how`` is inner or left.

    The table is written first.  If it is small, by its counted bytes, it is broadcast.  Else both sides are shuffled, once; rows of hot keys
    are dealt over ``SALTS`` tasks by a hash of the whole row, to each of which the table's row of that key is sent.  Rows from ``deal`` stay where
    they are if ``gene`` is a key: the table's rows go to their buckets.
    """
    table = cut(table)
    if counted_bytes(table) <= most_bytes:
        return rows.join(F.broadcast(table), keys, how)
    if "gene" in keys and (name := dealt_by(rows)):
        shares = F.when(F.xxhash64("gene").isin(_dealings[name[0]][1]), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        return rows.join(table.withColumn(name[0], F.explode(shares)).hint("shuffle_hash"), [*keys, *name], how)
    hot = hot_hashes(rows, keys)
    if not hot:
        return rows.join(table, keys, how)
    is_hot = F.xxhash64(*keys).isin(hot)
    spread = [c for c, kind in rows.dtypes if "map<" not in kind]
    salted = rows.withColumn("salt__", F.when(is_hot, F.pmod(F.xxhash64(F.lit(1), *spread), F.lit(SALTS))).otherwise(0).cast("int"))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(table.withColumn("salt__", F.explode(copies)), [*keys, "salt__"], how).drop("salt__")

"""Hard negatives by a two-dimensional block matrix multiply.

Rows go to shards of about 1,024 and anchors to shards of about 128; both are
cut into chunks of dimensions.  An anchor tile is sent to every row shard that
has the same chunk, each pair of tiles gives a partial tile of int64 scores,
and partial tiles of one (anchor shard, row shard) are added after a shuffle.
Every summed tile is reduced to its own first few rows per anchor, so what
meets at an anchor is a few rows a tile.

Rows with a null id, label or vector, or with a null or non-finite component,
take no part.  A vector shorter than the longest counts as padded with zeros,
an empty one has the score 0 with all.  Repeated ids are rows of their own: each
anchor row gets its results, and a row is never its own positive.  Equal scores
are in the order of ids.  An anchor without positives, and a positive without
rows in its window, give no rows; an empty table gives none.  Scores are 64-bit
sums, exact as long as they fit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read_table, squeeze, trimmed, unsqueeze

ROWS, ANCHORS, DIMS = 1024, 128, 32

_TILE = "shard int, chunk int, ids binary, labels binary, tile binary"


def scaled_rows(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: float) -> DataFrame:
    """``row, vec_id, label, v array<long>`` of the rows that take part."""
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    out = out.filter("vec_id is not null and label is not null and v is not null").filter(~odd)
    return out.withColumns({"v": F.transform("v", lambda x: F.floor(x * scale).cast("long")), "row": F.monotonically_increasing_id()})


def _tiles(n_dims: int, dims: int):
    """The tiles of a shard, a row for each chunk; its rows in the order of ids."""
    chunks = max(1, math.ceil(n_dims / dims))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        v = table.column("v").combine_chunks()
        lens = np.diff(v.offsets.to_numpy())
        wide = np.zeros((len(lens), chunks * dims), np.int64)
        starts = np.cumsum(lens) - lens
        place = np.arange(int(lens.sum())) - np.repeat(starts, lens)
        wide[np.repeat(np.arange(len(lens)), lens), place] = v.flatten().to_numpy()
        ids, labels, rows = (table.column(c).to_numpy() for c in ("vec_id", "label", "row"))
        order = np.lexsort((rows, ids))
        wide, names = wide[order], squeeze(np.stack([ids[order], rows[order]]).tobytes())
        marks = squeeze(labels[order].tobytes())
        tiles = [squeeze(np.ascontiguousarray(wide[:, c * dims : (c + 1) * dims]).tobytes()) for c in range(chunks)]
        shard = key[0].as_py()
        return pa.table([pa.array([shard] * chunks, pa.int32()), pa.array(range(chunks), pa.int32()), pa.array([names] * chunks, pa.binary()), pa.array([marks] * chunks, pa.binary()), pa.array(tiles, pa.binary())], names=["shard", "chunk", "ids", "labels", "tile"])

    return run


def _sharded(rows: DataFrame, count: int, each: int, n_dims: int, dims: int) -> DataFrame:
    shards = max(1, math.ceil(count / each))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(_tiles(n_dims, dims), _TILE)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a b' in int64; by float64 where that is exact, which has the faster multiply."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**52:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _ints(data: bytes, columns: int | None = None) -> np.ndarray:
    out = np.frombuffer(unsqueeze(data), np.int64)
    return out if columns is None else out.reshape(-1, columns)


def _multiply(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in ("anchors", "shard", "a_tile", "tile")}
                part = _product(_ints(row["a_tile"], dims), _ints(row["tile"], dims))
                yield pa.RecordBatch.from_arrays([pa.array([row["anchors"]], pa.int32()), pa.array([row["shard"]], pa.int32()), pa.array([squeeze(part.tobytes())], pa.binary())], names=["anchors", "shard", "part"])

    return run


class _Tile:
    """A summed tile with the ids, rows and labels of its anchors and rows."""

    def __init__(self, sums: bytes, a_ids: bytes, a_labels: bytes, ids: bytes, labels: bytes):
        self.a_ids, self.a_rows = _ints(a_ids).reshape(2, -1)
        self.ids, self.rows = _ints(ids).reshape(2, -1)
        self.a_labels, self.labels = _ints(a_labels), _ints(labels)
        self.scores = _ints(sums).reshape(len(self.a_ids), len(self.ids))

    def ranked(self, at: int, same: bool) -> np.ndarray:
        """Places of rows with the anchor's label (without itself), or with another, by score and id."""
        keep = (self.labels == self.a_labels[at]) == same
        if same:
            keep &= self.rows != self.a_rows[at]
        chosen = np.flatnonzero(keep)
        return chosen[np.argsort(-self.scores[at, chosen], kind="stable")]


def _add(key: tuple, table: pa.Table) -> pa.Table:
    """The sum of the partial tiles of an anchor shard and a row shard."""
    total = None
    for part in table.column("part"):
        one = _ints(part.as_py())
        total = one.copy() if total is None else np.add(total, one, out=total)
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([squeeze(total.tobytes())], pa.binary())], names=["anchors", "shard", "sums"])


_NAMES = ("sums", "a_ids", "a_labels", "ids", "labels")


def _first_positives(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                tile = _Tile(*(batch.column(c)[r].as_py() for c in _NAMES))
                out = []
                for at in range(len(tile.a_ids)):
                    out += [(at, int(tile.a_ids[at]), int(tile.ids[k]), int(tile.scores[at, k])) for k in tile.ranked(at, True)[:most]]
                yield _batch(batch.column("anchors")[r].as_py(), out, ("at", "anchor_id", "row_id", "score"))

    return run


def _first_negatives(most: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                tile = _Tile(*(batch.column(c)[r].as_py() for c in _NAMES))
                out, before, order = [], None, None
                for p in sorted(batch.column("positives")[r].as_py(), key=lambda p: (p["at"], p["rank"])):
                    if p["at"] != before:
                        before, order = p["at"], tile.ranked(p["at"], False)
                        falling = -tile.scores[before, order]
                    # low * positive <= 100 * negative <= high * positive, in whole numbers; scores fall along the order
                    least, greatest = -(-low * p["score"] // 100), high * p["score"] // 100
                    first, last = np.searchsorted(falling, -greatest, "left"), np.searchsorted(falling, -least, "right")
                    for k in order[first : min(last, first + most)]:
                        out.append((p["at"], p["anchor_id"], p["row_id"], p["rank"], p["score"], int(tile.ids[k]), int(tile.scores[before, k])))
                yield _batch(batch.column("anchors")[r].as_py(), out, ("at", "anchor_id", "positive_id", "positive", "positive_score", "negative_id", "negative_score"))

    return run


def _batch(anchors: int, rows: list[tuple], names: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    arrays = [pa.array(c, pa.int32() if n in ("at", "positive") else pa.int64()) for n, c in zip(names, columns, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([anchors] * len(rows), pa.int32()), *arrays], names=["anchors", *names])


def score_tiles(rows: DataFrame, anchors: DataFrame, dims: int = DIMS, shard_rows: int = ROWS, shard_anchors: int = ANCHORS) -> DataFrame:
    """``anchors, shard, sums, a_ids, a_labels, ids, labels``: all scores of ``anchors`` with ``rows`` (both of ``scaled_rows``, written), a row for each tile."""
    n, n_dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    right = cut(_sharded(rows, n, shard_rows, n_dims, dims))
    left = cut(_sharded(anchors, anchors.count(), shard_anchors, n_dims, dims))
    shards = max(1, math.ceil(n / shard_rows))
    # the panel of anchor tiles of a chunk goes to every row shard
    panel = left.select(F.col("shard").alias("anchors"), "chunk", F.col("tile").alias("a_tile"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    pairs = panel.join(right.select("shard", "chunk", "tile"), ["shard", "chunk"]).select("anchors", "shard", "a_tile", "tile")
    parts = pairs.mapInArrow(trimmed(_multiply(dims)), "anchors int, shard int, part binary")
    sums = parts.groupBy("anchors", "shard").applyInArrow(_add, "anchors int, shard int, sums binary")
    names = left.filter("chunk = 0").select(F.col("shard").alias("anchors"), F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"))
    return sums.join(names, "anchors").join(right.filter("chunk = 0").select("shard", "ids", "labels"), "shard")


def mine_hard_negatives(
    rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label", scale: float = 256.0,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, dims: int = DIMS, shard_rows: int = ROWS, shard_anchors: int = ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` is a condition on ``vec_id`` and ``label`` (as given by the argument).  An anchor's first ``positives`` rows of its label each open a
    window from ``low`` to ``high`` percent of their score, of which the first ``negatives`` rows of other labels come out.
    """
    known = cut(scaled_rows(rows, id_col, vector_col, F.col(label) if isinstance(label, str) else label, scale))
    tiles = cut(score_tiles(known, known.filter(anchor), dims, shard_rows, shard_anchors))
    best = Window.partitionBy("anchors", "at").orderBy(F.col("score").desc(), "row_id")
    local = tiles.select("anchors", *_NAMES).mapInArrow(trimmed(_first_positives(positives)), "anchors int, at int, anchor_id long, row_id long, score long")
    chosen = local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= positives)
    packed = cut(chosen.groupBy("anchors").agg(F.collect_list(F.struct("at", "anchor_id", "row_id", "score", "rank")).alias("positives")))  # at most an anchor shard's
    found = tiles.join(packed, "anchors").select("anchors", *_NAMES, "positives")
    found = found.mapInArrow(trimmed(_first_negatives(negatives, low, high)), "anchors int, at int, anchor_id long, positive_id long, positive int, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchors", "at", "positive").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine_hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


OP13_SQL = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
), u AS (
    SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS k FROM e
), bad AS (
    SELECT DISTINCT vec_id FROM u WHERE x IS NULL OR NOT isfinite(x)
), z AS (
    SELECT u.vec_id, e.label, u.k, CAST(floor(256 * CAST(u.x AS DOUBLE)) AS BIGINT) AS x FROM u JOIN e ON u.vec_id = e.vec_id WHERE u.vec_id NOT IN (SELECT vec_id FROM bad)
), s AS (
    SELECT a.vec_id AS anchor_id, a.label AS a_label, b.vec_id, b.label, CAST(sum(a.x * b.x) AS BIGINT) AS score
    FROM z a JOIN z b ON a.k = b.k WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY ALL
), p AS (
    SELECT anchor_id, a_label, vec_id AS positive_id, score AS positive_score FROM s WHERE label = a_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> p.a_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

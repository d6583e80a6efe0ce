"""Chat formatting after collapsing cumulative snapshots of conversations.

Logs often hold a conversation once after every turn.  A conversation goes if
all its turns, in order, begin a longer one; of equal ones the smallest conv_id
stays.  Two 64-bit hashes of (turn, role, text) are summed over the turns so
far: that rolling prefix sum is the identity of the prefix, and the last one
that of the conversation.  Conversations whose identity is somebody's proper
prefix leave by an anti-join; the others are rendered.

Sums are taken in segments of ``segment`` turns, and a segment's base is added
from a window over segments, so a conversation of very many turns is spread
over tasks.  A conversation is rendered as one row.  Only one that would exceed
``most_bytes`` comes in pieces of ``segment`` rows, cut by the place of its rows
in their order, whatever its turn numbers are (they may repeat without end in
rows of one id, or of none, logged over and over); its pieces, put together in
order, are the conversation.  A first turn or a conversation that very many
share is one row in the anti-join, as both sides are made distinct before.

Nulls and edges: rows with a null conv_id are one conversation; a null turn
comes first, a null role or text is shown as nothing but differs from an empty
one; repeated rows count as often as they occur; prefixes end between turn
numbers, never inside one; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, parts_for, read_table

_NO_ID = -(1 << 63)
_SUMS = ["n", "a", "b", "c", "d"]


def _halves(h: F.Column, names: str) -> list[F.Column]:
    """Sums of the two halves of 64-bit hashes; neither can overflow."""
    return [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias(names[0]), F.sum(F.shiftrightunsigned(h, 32)).alias(names[1])]


def _turns(conversations: DataFrame, segment: int) -> DataFrame:
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_NO_ID)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.floor(F.col("turn") / segment).cast("long"), F.lit(_NO_ID)).alias("piece"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )


def prefix_sums(turns: DataFrame) -> DataFrame:
    """``conv, turn, n, a, b, c, d, whole``: identity of all turns up to each turn number, and the turns of the conversation."""
    what = [F.coalesce("turn", F.lit(_NO_ID)), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    hashed = turns.select("conv", "turn", "piece", F.xxhash64(*what).alias("h"), F.xxhash64(F.lit(7), *what).alias("k"))
    steps = hashed.groupBy("conv", "piece", "turn").agg(F.count("*").alias("n"), *_halves(F.col("h"), "ab"), *_halves(F.col("k"), "cd"))
    pieces = steps.groupBy("conv", "piece").agg(*[F.sum(c).alias(c) for c in _SUMS])
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.select("conv", "piece", F.sum("n").over(Window.partitionBy("conv")).alias("whole"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in _SUMS])
    inside = Window.partitionBy("conv", "piece").orderBy(F.col("turn").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    return steps.join(bases, ["conv", "piece"]).select("conv", "turn", "whole", *[(F.sum(c).over(inside) + F.col(f"{c}0")).alias(c) for c in _SUMS])


def maximal(turns: DataFrame) -> DataFrame:
    """``conv, n, n_copies`` of the conversations that stay."""
    sums = prefix_sums(turns)
    whole = sums.filter("n = whole").groupBy(*_SUMS).agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    begun = sums.filter("n < whole").select(*_SUMS).distinct()
    return whole.join(begun, _SUMS, "left_anti").select("conv", "n", "n_copies")


def render(role: F.Column, text: F.Column) -> F.Column:
    """A turn in the chat markup."""
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def _bytes() -> F.Column:
    """Bytes of a turn in the chat markup, about."""
    return 30 + F.coalesce(F.octet_length("role"), F.lit(0)).cast("long") + F.coalesce(F.octet_length("text"), F.lit(0))


def _by_place(turns: DataFrame, segment: int, n_bytes: int) -> DataFrame:
    """``turns`` of few conversations with the ``segment`` rows that each row belongs to, in the order of turn, role and text, as its piece."""
    order = ["turn", "role", "text"]
    # Equal rows are dealt over tasks by a random number; which of them goes where makes no difference.
    dealt = turns.withColumn("any", F.rand(1)).repartitionByRange(parts_for(turns.sparkSession, n_bytes), "conv", *order, "any")
    dealt = cut(dealt.drop("any", "piece").withColumn("slot", F.spark_partition_id()))
    before = Window.partitionBy("conv").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("conv", "slot").agg(F.count("*").alias("rows")).select("conv", "slot", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    place = F.col("base") + F.row_number().over(Window.partitionBy("conv", "slot").orderBy(*order)) - 1
    return dealt.join(bases, ["conv", "slot"]).withColumn("piece", F.floor(place / segment).cast("long")).drop("slot", "base")


def _shown(turns: DataFrame) -> DataFrame:
    return turns.groupBy("conv", "piece").agg(
        F.first("n").alias("n_turns"),
        F.first("n_copies").alias("n_copies"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda t: render(t["role"], t["text"])), "").alias("rendered"),
    )


def collapse_snapshots(conversations: DataFrame, segment: int = 128, most_bytes: int = 16 << 20) -> DataFrame:
    """``conv_id, piece, n_turns, n_copies, rendered``: a row for each conversation that stays.

    ``n_turns`` is of the whole conversation; ``n_copies`` counts equal conversations.  ``piece`` is 0, but for
    conversations of more than ``most_bytes``, whose pieces of ``segment`` rows follow each other.
    """
    turns = _turns(conversations, segment)
    stay = maximal(turns)
    large = cut(turns.groupBy("conv").agg(F.sum(_bytes()).alias("bytes")).filter(F.col("bytes") > most_bytes))
    n_bytes = large.agg(F.sum("bytes")).first()[0]
    whole = turns.withColumn("piece", F.lit(0).cast("long"))
    if not n_bytes:
        shown = _shown(whole.join(stay, "conv"))
    else:
        # Each has more than ``most_bytes`` of text, so there are few.
        stay, few = cut(stay), F.broadcast(large.select("conv"))
        shown = _shown(whole.join(few, "conv", "left_anti").join(stay, "conv"))
        known = F.broadcast(cut(stay.join(few, "conv")))
        placed = _by_place(turns.join(F.broadcast(known.select("conv")), "conv", "left_semi"), segment, n_bytes)
        shown = shown.unionByName(_shown(placed.join(known, "conv")))
    return shown.select(F.when(F.col("conv") != _NO_ID, F.col("conv")).alias("conv_id"), "piece", "n_turns", "n_copies", "rendered")


def op4_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_snapshots(read_table(spark, sf_dir, "conversations"))


OP4_SQL = """
WITH c AS (
    SELECT conv_id, list({'t': turn, 'r': role, 'x': text} ORDER BY turn, role, text) AS a FROM conversations GROUP BY conv_id
), w AS (
    SELECT a, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY a
), p AS (
    SELECT DISTINCT list_slice(c.a, 1, k.k) AS a
    FROM c, (SELECT DISTINCT turn AS k FROM conversations) k WHERE k.k >= 1 AND k.k < len(c.a)
), m AS (
    SELECT w.* FROM w LEFT JOIN p ON w.a = p.a WHERE p.a IS NULL
)
SELECT m.conv_id, CAST(0 AS BIGINT) AS piece, len(any_value(m.a)) AS n_turns, any_value(m.n_copies) AS n_copies,
       string_agg('<|im_start|>' || coalesce(t.role, '') || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10), '' ORDER BY t.turn, t.role, t.text) AS rendered
FROM m JOIN conversations t ON t.conv_id = m.conv_id
GROUP BY m.conv_id
"""

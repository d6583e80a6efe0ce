"""SimHash near-duplicates: an inverted index on byte positions with count filtering.

A 64-bit fingerprint is eight positional bytes.  Fingerprints at two or fewer
differing bits differ in two bytes at most, so they share at least six: the
guaranteed minimum of matches.

Lists.  A list for one (place, byte) would hold 1/256 of all fingerprints, so
a list is keyed by the first ``depth`` bytes that its pairs share: of the first
``depth + 2`` places a pair lacks two at most, which makes (depth + 2 over 2)
lists a fingerprint, and every pair with six shared bytes meets in one of them
at least.  ``depth`` follows from the number of distinct fingerprints, so that a
list of even data holds few.  Lists are counted first, and one of more than
``long`` members is replaced by the lists of six shared bytes that refine it;
members of those differ in two bytes (65,536 values at most, which bounds
them).  So hot lists are split, and no pair is lost.

Tally.  In a list each pair's shared positional bytes are counted, pairs with
six or more are retained, and their differing bits verify them.  In the bounded
lists of six bytes every pair has the minimum already; long ones are verified
by looking up the values at one and two differing bits.

Copies of a fingerprint count once, so a group of any size costs one entry a
list.  Inside a list, verified links are reduced to a star for each connected
part: no link between different fingerprints is lost for the components, and no
pairs of a group are listed.  A fingerprint or component that holds a large
share of all rows is joined back by broadcast, where its rows are.

Nulls and edges: a null or wordless text has fingerprint zero and links like
any other; each row gives a row, an empty table none; null doc_ids never name a
component unless nothing else is in it (then it is null).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, ROW, cut, id_text, ids_and_bytes, join_counted, numbered, read_table, trimmed, without_rows
from .graph import star_components

#: Bytes that a pair shares at least.
SHARED = 6
_ROWS = 1 << 16


def fingerprint(text: bytes | None, n: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word n-grams (repeats included), as a signed 64-bit number."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    if len(words) < n:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[k:] for k in range(n)), strict=False)))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, seed) for g in grams), np.uint64, len(grams)).astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = sum(np.unpackbits(h[k : k + _ROWS], axis=1).sum(axis=0, dtype=np.int64) for k in range(0, len(h), _ROWS))
    return int(np.packbits(2 * ones > len(grams)).view(">i8")[0])


def _fingerprints(n: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = ids_and_bytes(batch)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([fingerprint(t, n, seed) for t in texts], pa.int64())], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, n: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, fp bigint`` of each row."""
    return id_text(docs).mapInArrow(trimmed(_fingerprints(n, seed)), "doc_id long, fp long")


def _masked(places: tuple[int, ...]) -> F.Column:
    """The bytes of ``fp`` at ``places`` (0 is the highest), the others zero."""
    mask = sum(0xFF << 8 * (7 - p) for p in places)
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _list_of(places: tuple[int, ...]) -> F.Column:
    return F.struct(F.lit(sum(1 << p for p in places)).alias("places"), _masked(places).alias("shared"))


def depth_for(n: int) -> int:
    """Shared bytes of a key, 1 to 6, such that lists of ``n`` evenly spread fingerprints hold one each or fewer."""
    return next((d for d in range(1, SHARED) if n <= 256**d), SHARED)


def positional_index(prints: DataFrame, depth: int) -> DataFrame:
    """``places, shared, fp``: entries of each distinct fingerprint in the lists of its first ``depth`` shared bytes."""
    lists = [_list_of(p) for p in combinations(range(depth + 2), depth)]
    return prints.select("fp", F.explode(F.array(*lists)).alias("k")).select("k.places", "k.shared", "fp")


def refined(entries: DataFrame, depth: int) -> DataFrame:
    """Entries of lists of ``depth`` bytes as entries of the lists of six bytes that begin with those."""
    longer = F.lit(None)
    for p in combinations(range(depth + 2), depth):
        more = [q for q in combinations(range(8), SHARED) if q[:depth] == p]
        longer = F.when(F.col("places") == sum(1 << x for x in p), F.array(*map(_list_of, more))).otherwise(longer)
    return entries.select("fp", F.explode(longer).alias("k")).select("k.places", "k.shared", "fp")


def split_long(entries: DataFrame, depth: int, long: int) -> DataFrame:
    """``entries`` with those of lists of more than ``long`` members refined; members are counted before they are dealt."""
    hot = cut(entries.groupBy("places", "shared").agg(F.count("*").alias("n")).filter(F.col("n") > long))
    if depth == SHARED or hot.isEmpty():
        return entries
    entries, hot = entries.withColumn("list", F.xxhash64("places", "shared")), hot.groupBy(F.xxhash64("places", "shared").alias("list")).agg(F.sum("n").alias("n"))
    long_ones = join_counted(entries, hot, "list").drop("list")
    # lists that hold one in 256 of these entries or more, 256 of them at most, leave where they are
    least = hot.agg(F.sum("n")).first()[0] / 256
    cold = entries.join(F.broadcast(hot.filter(F.col("n") >= least)), "list", "left_anti").join(hot, "list", "left_anti")
    return cold.drop("list").unionByName(refined(long_ones, depth))


_FLIPS = np.array([0] + [1 << i for i in range(16)] + [1 << i | 1 << j for i, j in combinations(range(16), 2)], np.int64)


def _tally(fp: np.ndarray) -> np.ndarray:
    """Shared positional bytes of every pair of a short list."""
    differ = (fp[:, None] ^ fp[None, :]).view(np.uint8).reshape(len(fp), len(fp), 8)
    return (differ == 0).sum(axis=2)


def _stars(fp: np.ndarray, most: int, short: int = 256) -> list[tuple[int, int]]:
    """Links of one list of the index, as a star for each part connected by ``most`` or fewer differing bits.

    A list of more than ``short`` members has six bytes in common.
    """
    n = len(fp)
    label = np.arange(n)
    if n <= short:
        near = _tally(fp) >= SHARED
        near[near] = np.bitwise_count((fp[:, None] ^ fp[None, :])[near]) <= most
        step = lambda label: np.where(near, label[None, :], n).min(axis=1)
    else:
        diff = np.bitwise_or.reduce(fp ^ fp[0])
        rest = np.zeros(n, np.int64)
        for byte in range(8):  # the two places in which members differ
            if diff >> np.uint64(8 * byte) & np.uint64(255):
                rest = rest << 8 | ((fp >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)
        place = np.full(1 << 16, -1)
        place[rest] = label
        flips = _FLIPS[np.bitwise_count(_FLIPS.astype(np.uint64)) <= most]

        def step(label: np.ndarray) -> np.ndarray:
            out = label
            for f in flips:
                at = place[rest ^ f]
                out = np.minimum(out, np.where(at >= 0, label[at], n))
            return out

    while True:
        new = step(label)
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    signed = fp.view(np.int64)
    return [(int(signed[k]), int(signed[r])) for k, r in enumerate(label.tolist()) if r != k]


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Sorted index entries in arrays that never cut a list in two."""
    held = np.zeros((3, 0), np.int64)
    for batch in batches:
        held = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])], axis=1)
        cuts = np.flatnonzero((held[0, 1:] != held[0, :-1]) | (held[1, 1:] != held[1, :-1]))
        if len(cuts):
            yield held[:, : cuts[-1] + 1]
            held = held[:, cuts[-1] + 1 :]
    if held.shape[1]:
        yield held


def _links(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places, shared, fp in _whole_lists(batches):
            runs = np.flatnonzero(np.concatenate(([True], (places[1:] != places[:-1]) | (shared[1:] != shared[:-1]))))
            lens = np.diff(np.append(runs, len(fp)))
            fp = fp.view(np.uint64)
            two = runs[lens == 2]
            differ = fp[two] ^ fp[two + 1]
            shared = (differ[:, None].view(np.uint8) == 0).sum(axis=1)
            two = two[(shared >= SHARED) & (np.bitwise_count(differ) <= most)]
            u, v = fp[two + 1].view(np.int64).tolist(), fp[two].view(np.int64).tolist()
            for s, k in zip(runs[lens > 2].tolist(), lens[lens > 2].tolist(), strict=True):
                for a, b in _stars(fp[s : s + k], most):
                    u.append(a)
                    v.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def links(prints: DataFrame, most: int = 2, long: int = 256) -> DataFrame:
    """``u, v``: stars of the parts of each list that links of ``most`` or fewer bits connect, from distinct ``fp``."""
    depth = depth_for(prints.count())
    index = split_long(positional_index(prints, depth), depth, long)
    dealt = index.repartition("places", "shared").sortWithinPartitions("places", "shared", "fp")
    return dealt.mapInArrow(trimmed(_links(most)), "u long, v long")


def near_duplicates(docs: DataFrame, most: int = 2, n: int = 3, seed: int = 42, long: int = 256) -> DataFrame:
    """``doc_id, fp, component_id`` of each row: the smallest doc_id reached over links of ``most`` (0 to 2) or fewer differing bits."""
    if not 0 <= most <= 2:
        raise ValueError("six of eight shared bytes are guaranteed for 0, 1 or 2 differing bits only")
    if not 1 <= long <= 256:
        raise ValueError("lists may hold 1 to 256 members before they are split")
    prints = cut(fingerprints(docs, n, seed))
    each = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    roots = star_components(links(each, most, long))
    rooted = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    of_print = join_counted(rooted, named, "root").select("fp", "component_id", F.col("copies").alias("n"))
    return join_counted(prints, of_print, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, most: int = 2) -> DataFrame:
    """Rows of ``docs``, with all their columns, that have the smallest doc_id of their component (the first row of those that share it)."""
    rows = cut(numbered(docs))
    found = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text"), most).toDF(ROW, "fp", "component")
    each = cut(found.join(rows.select(ROW, "doc_id"), ROW))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)
    first = each.groupBy("component").agg(F.min(place)[ROW].alias(ROW))
    return without_rows(rows, each.join(first.select(ROW), ROW, "left_anti"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

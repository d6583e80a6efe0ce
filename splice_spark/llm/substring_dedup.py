"""Exact substring de-duplication with fixed-block anchors.

A window is ``window`` consecutive words of one document.  A word is removed if
a window that covers it has a word sequence which also starts earlier (in a
smaller doc_id, or earlier in the same document).

Method.  An anchor has ``window / 2`` words.  The index holds the
non-overlapping anchors of every document, those that start at a multiple of
the anchor length; every window of any document holds a whole one of them.

1. Each block of documents sends the hashes of all its rolling anchor-length
   windows to the bucket of the hash, with a mark at those that are in the
   index.  So every rolling window probes the index.
2. The bucket answers two bits a hash: a hit (it is indexed, and stands in
   another place too), and whether it repeats at all.
3. A hit is extended to both sides while the rolling windows repeat.  A stretch
   of ``window`` words or more around a hit is a candidate, and each full
   window of it belongs to one hit inside it, that of the least hash, which is
   the same one wherever the window stands.  The words of the windows of a hit
   go to the bucket of the hit.
4. There the windows are compared word by word; a window goes if an earlier
   document, or an earlier place, has the same words.  Neighbours that go are
   put together in the block: the maximal exact repeats.

Without an index no window has a hit and nothing is removed.  Hashes only
select what is compared; equality is that of the words.

Hashes and windows travel packed, each distinct one once a block, so a passage
that a third of all documents share puts one entry a block into its bucket.  No
pairs of documents are made.  Texts are shuffled once (compressed, by block);
all later rounds read that one exchange.

Nulls and edges: a null text has no words; rows that share a doc_id are one
place in the order, so neither is earlier; null doc_ids come last.  Each input
row gives one output row, an empty table none.  A document longer than a block
is a block of its own.  The input must give the same rows per partition when a
task is run again (a file scan or a checkpoint does).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary, bits, doc_chunks, id_text, parts_for, read_table, squeeze, total_bytes, trimmed, unbits, unsqueeze
from .hashing import mix, windows, word_hashes

PACKET = "part long, block long, a binary, b binary, c binary, d binary"
_LAST = np.iinfo(np.int64).max
_LOW = np.uint64(0xFFFFFFFF)


class _Block:
    """Documents of one block in the order of their ids, as one word sequence."""

    def __init__(self, ids: list, texts: list, window: int, buckets: int):
        order = sorted(range(len(ids)), key=lambda i: _LAST if ids[i] is None else ids[i])
        self.ids = [ids[i] for i in order]
        self.texts = [texts[i] for i in order]
        self.data = b"\n".join(t or b"" for t in self.texts)
        h, self.starts, self.ends = word_hashes(np.frombuffer(self.data, np.uint8))
        tops = np.concatenate(([0], np.cumsum([len(t or b"") + 1 for t in self.texts])))
        bounds = np.searchsorted(self.starts, tops)  # word index of each document's first word
        self.n, self.anchor = len(h), window // 2
        lens = np.diff(bounds)
        self.start = (np.arange(self.n) - np.repeat(bounds[:-1], lens)).astype(np.int32)
        self.left = np.repeat(lens, lens).astype(np.int32) - self.start  # words from here to the document's end
        self.doc = np.repeat(np.array([_LAST if i is None else i for i in self.ids], np.int64), lens)
        # bucket above, 32 bits of the hash below
        self.roll = np.zeros(self.n, np.uint64)
        w = windows(h, self.anchor)
        self.roll[: len(w)] = _bucket(w, buckets).astype(np.uint64) << np.uint64(32) | w & _LOW

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of whole rolling windows by rising hash, the hashes, and where a new one begins."""
        at = np.flatnonzero(self.left >= self.anchor)
        at = at[np.argsort(self.roll[at], kind="stable")]
        h = self.roll[at]
        return at, h, _news(h)

    def indexed(self, at: np.ndarray) -> np.ndarray:
        """Which of these places start a block of the index."""
        return self.start[at] % self.anchor == 0


def _news(sorted_values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    new = np.ones(len(sorted_values), bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return new


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    """0 to n - 1."""
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _cuts(bucket: np.ndarray) -> list[int]:
    return [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)] if len(bucket) else [0]


def _rows(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *(binary(list(c)) for c in cols[2:])], names=["part", "block", "a", "b", "c", "d"])


def _table(rows: list) -> pa.Table:
    return pa.Table.from_batches([_rows(rows)])


def _rising(values: np.ndarray) -> bytes:
    """Rising 32-bit numbers as the steps between them, compressed by byte planes."""
    steps = np.diff(values.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return squeeze(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())


def _unrising(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(unsqueeze(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32)


def _packed(values: np.ndarray) -> bytes:
    return squeeze(values.tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(unsqueeze(data), kind)


def _send(size: int, window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 24
        for k, (ids, texts) in enumerate(doc_chunks(batches, size)):
            b = _Block(ids, texts, window, buckets)
            no = base + k
            lens = np.array([-1 if t is None else len(t) for t in b.texts], np.int64)
            keys = np.array([_LAST if i is None else i for i in b.ids], np.int64)
            rows = [(no, no, squeeze(b"".join(t or b"" for t in b.texts)), _packed(lens), _packed(keys), bits(np.array([i is None for i in b.ids], bool)))]
            at, h, new = b.probes()
            if len(h):
                run_of = np.flatnonzero(new)
                many = np.diff(np.append(run_of, len(h))) > 1
                marked = np.logical_or.reduceat(b.indexed(at), run_of)
                h = h[run_of]
                bucket = h >> np.uint64(32)
                for lo, hi in zip(cut := _cuts(bucket), cut[1:], strict=False):
                    rows.append((-1 - int(bucket[lo]), no, _rising(h[lo:hi] & _LOW), bits(many[lo:hi]), bits(marked[lo:hi]), None))
            yield _rows(rows)

    return run


def _probe(key: tuple, table: pa.Table) -> pa.Table:
    """Of each hash sent to a bucket: whether it hits the index beside another place, and whether it repeats.  Packets without a repeat get no answer."""
    if key[0].as_py() >= 0 or not table.num_rows:
        return _table([])
    block, a, many, marked = (table.column(c).to_pylist() for c in ("block", "a", "b", "c"))
    a = [_unrising(x) for x in a]
    sizes = [len(x) for x in a]
    h = np.concatenate(a)
    order = np.argsort(h, kind="stable")
    runs = np.flatnonzero(_news(h[order]))
    many, marked = (np.concatenate([unbits(x, n) for x, n in zip(y, sizes, strict=True)])[order] for y in (many, marked))
    lens = np.diff(np.append(runs, len(h)))
    twice = (lens > 1) | np.logical_or.reduceat(many, runs)
    again, hit = np.empty(len(h), bool), np.empty(len(h), bool)
    again[order] = np.repeat(twice, lens)
    hit[order] = np.repeat(twice & np.logical_or.reduceat(marked, runs), lens)
    ends, bucket = np.cumsum(sizes), -1 - key[0].as_py()
    return _table([(no, bucket, bits(hit[e - n : e]), bits(again[e - n : e]), None, None) for no, n, e in zip(block, sizes, ends, strict=True) if again[e - n : e].any()])


def _opened(table: pa.Table) -> tuple[list, list]:
    """Ids and texts of a block's own row."""
    own = table.slice(0, 1)
    text, lens, keys, none = (own.column(c)[0].as_py() for c in "abcd")
    text, lens, keys = unsqueeze(text), _unpacked(lens, np.int64), _unpacked(keys, np.int64).tolist()
    ids = [None if n else k for k, n in zip(keys, unbits(none, len(keys)), strict=True)]
    ends = np.cumsum(np.maximum(lens, 0)).tolist()
    return ids, [None if n < 0 else text[e - n : e] for n, e in zip(lens.tolist(), ends, strict=True)]


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def later(words: np.ndarray, at: np.ndarray, doc: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """Of windows at the places ``at`` of a sequence of word numbers: whether an equal one has a smaller (doc, start).

    Hashes bring equal windows together; windows whose words differ from the first of their hash are compared again by themselves.
    """
    late = np.zeros(len(at), bool)
    todo, h = np.arange(len(at)), windows(mix(words.astype(np.uint64)), window)[at] if len(at) else np.zeros(0, np.uint64)
    while len(todo):
        order = np.lexsort((start[todo], doc[todo], h[todo]))
        mine = todo[order]
        new = _news(h[mine])
        lead = mine[np.flatnonzero(new)][np.cumsum(new) - 1]
        same = np.ones(len(mine), bool)
        for j in range(window):
            same &= words[at[mine] + j] == words[at[lead] + j]
        late[mine[same]] = ((doc[mine] != doc[lead]) | (start[mine] != start[lead]))[same]
        todo = mine[~same]
    return late


def _around_hits(b: _Block, hit: np.ndarray, again: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the candidate windows, and the place of the hit of least hash (the leftmost of equal ones) in each."""
    inner = window - b.anchor + 1
    runs, hits = np.concatenate(([0], np.cumsum(again))), np.concatenate(([0], np.cumsum(hit)))
    p = np.flatnonzero(b.left >= window)
    p = p[(hits[p + inner] > hits[p]) & (runs[p + inner] - runs[p] == inner)]
    best, least = np.zeros(len(p), np.int64), np.full(len(p), ~np.uint64(0))
    for o in range(inner):
        better = hit[p + o] & (b.roll[p + o] < least)
        best[better], least[better] = p[better] + o, b.roll[p[better] + o]
    return p, best


def _extend(window: int, buckets: int):
    def run(key: tuple, mine: pa.Table, answers: pa.Table) -> pa.Table:
        """Candidate windows of a block: those that follow an equal one inside it, and the words of the others, for the buckets of their hits."""
        if key[0].as_py() < 0 or not mine.num_rows or not answers.num_rows:
            return _table([])
        no = key[0].as_py()
        b = _Block(*_opened(mine), window, buckets)
        at, h, new = b.probes()
        h = h[new]
        first = np.searchsorted(h, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
        flags = np.zeros((2, len(h)), bool)
        for bucket, hit, again in zip(*(answers.column(c).to_pylist() for c in ("block", "a", "b")), strict=True):
            lo, hi = first[bucket], first[bucket + 1]
            flags[:, lo:hi] = unbits(hit, hi - lo), unbits(again, hi - lo)
        places = np.zeros((2, b.n), bool)
        places[:, at] = flags[:, np.cumsum(new) - 1]
        p, hit = _around_hits(b, *places, window)
        if not len(p):
            return _table([])
        covered = np.cumsum(np.bincount(p, minlength=b.n + 1) - np.bincount(p + window, minlength=b.n + 1))[:-1] > 0
        at = np.flatnonzero(covered)
        numbers, words = _Numbers(), np.zeros(b.n, np.int32)
        words[at] = np.fromiter((numbers[b.data[s:e]] for s, e in zip(b.starts[at].tolist(), b.ends[at].tolist(), strict=True)), np.int32, len(at))
        late = later(words, p, b.doc[p], b.start[p], window)
        rows = [(no, no, _packed(p[late].astype(np.int32)), None, None, None)]
        # windows of a hit stand within its reach, so a mask of their starts will do
        p, hit = p[~late], hit[~late]
        heads = np.flatnonzero(_news(hit))
        begin, end = p[heads], p[np.append(heads[1:], len(p)) - 1] + window
        mask = np.add.reduceat(np.int64(1) << (p - np.repeat(begin, np.diff(np.append(heads, len(p))))), heads).astype(np.int32)
        order = np.argsort(b.roll[hit[heads]], kind="stable")
        begin, end, mask, bucket = begin[order], end[order], mask[order], (b.roll[hit[heads]][order] >> np.uint64(32)).astype(np.int64)
        for lo, hi in zip(cut := _cuts(bucket), cut[1:], strict=False):
            q, e = begin[lo:hi], end[lo:hi]
            text = b"\n".join(b.data[s:t] for s, t in zip(b.starts[q].tolist(), b.ends[e - 1].tolist(), strict=True))
            where = np.stack([q.astype(np.int32), (e - q).astype(np.int32), mask[lo:hi], b.start[q]])
            rows.append((-1 - int(bucket[lo]), no, squeeze(text), _packed(where), _packed(b.doc[q]), None))
        return _table(rows)

    return run


def _settle(window: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Places of windows of which an earlier equal one is in another block; a block's own row passes."""
        if key[0].as_py() >= 0:
            return table
        numbers, words, where, docs, blocks = _Numbers(), [], [], [], []
        for no, text, some, doc in zip(*(table.column(c).to_pylist() for c in ("block", "a", "b", "c")), strict=True):
            words.append(np.fromiter(map(numbers.__getitem__, unsqueeze(text).split()), np.int32))
            where.append(_unpacked(some, np.int32).reshape(4, -1))
            docs.append(_unpacked(doc, np.int64))
            blocks.append(np.full(where[-1].shape[1], no))
        words, docs, blocks = np.concatenate(words), np.concatenate(docs), np.concatenate(blocks)
        begin, length, mask, start = np.concatenate(where, axis=1)
        first = np.cumsum(length, dtype=np.int64) - length
        stretch, step = np.nonzero(mask[:, None] >> np.arange(window // 2 + 1) & 1)
        late = later(words, first[stretch] + step, docs[stretch], start[stretch] + step, window)
        stretch, place = stretch[late], (begin[stretch] + step)[late]
        order = np.argsort(blocks[stretch], kind="stable")
        no, place = blocks[stretch][order], place[order]
        cut = _cuts(no)
        return _table([(int(no[lo]), -1, _packed(place[lo:hi].astype(np.int32)), None, None, None) for lo, hi in zip(cut, cut[1:], strict=False)])

    return run


def _keep(window: int):
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())])

    def run(key: tuple, mine: pa.Table, found: pa.Table) -> pa.Table:
        """Cover the repeated windows and write each document's kept words."""
        if key[0].as_py() < 0 or not mine.num_rows:
            return out.empty_table()
        late = np.concatenate([np.zeros(0, np.int32), *(_unpacked(x, np.int32) for x in found.column("a").to_pylist())])
        late.sort()
        rows, lo = [], 0
        for i, t in zip(*_opened(mine), strict=True):
            words = (t or b"").split()
            hi = lo + len(words)
            p = late[np.searchsorted(late, lo) : np.searchsorted(late, hi)] - lo
            spans = []
            if len(p):
                mark = np.bincount(p, minlength=len(words) + 1) - np.bincount(p + window, minlength=len(words) + 1)
                edges = np.flatnonzero(np.diff(np.cumsum(mark)[:-1] > 0, prepend=False, append=False)).tolist()
                spans = [{"start": s, "end": e} for s, e in zip(edges[0::2], edges[1::2], strict=True)]
                stay = [0, *edges, len(words)]
                words = [w for s, e in zip(stay[0::2], stay[1::2], strict=True) for w in words[s:e]]
            rows.append((i, hi - lo, spans, b" ".join(words).decode()))
            lo = hi
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    return run


def remove_repeats(docs: DataFrame, window: int = 20, block_bytes: int = 8 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """``doc_id, n_words, removed array<struct<start,end>>`` (word indexes, end exclusive)``, kept_text``, a row for each input row.

    ``window`` must be even and 60 at most.  A task holds one block (``block_bytes`` of text, or
    one longer document) or one bucket (hashes, or windows, of ``bucket_bytes`` of text).
    """
    if window % 2 or not 2 <= window <= 60:
        raise ValueError("window must be even, and between 2 and 60")
    docs = id_text(docs)
    n = total_bytes(docs)
    buckets = max(1, math.ceil(n / bucket_bytes))
    sent = docs.mapInArrow(trimmed(_send(block_bytes, window, buckets)), PACKET).repartition(parts_for(docs.sparkSession, n), "part")
    answers = sent.groupBy("part").applyInArrow(_probe, PACKET)
    asked = sent.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_extend(window, buckets), PACKET)
    found = asked.groupBy("part").applyInArrow(_settle(window), PACKET)
    return sent.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(_keep(window), "doc_id long, n_words long, removed array<struct<start:long,end:long>>, kept_text string")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))

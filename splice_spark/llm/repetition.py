"""Repetition rules from suffix arrays over the words of each document.

Many documents share one array: suffixes compare inside their document only.
Prefix doubling refines groups of equal prefixes, and only groups of two or
more go on, so plain text stops after a few rounds.  Where a round parts two
neighbours, their longest common prefix is the length of the round plus that of
what follows, which earlier rounds have settled: a minimum over a range.  So
the arrays of a document take memory in proportion to its words.

The intervals of common prefixes are enumerated with a stack.  One whose
occurrences have different words before them is a maximal repeated substring.
The occurrences' spans are joined for the covered fraction; the deepest
intervals of the suffixes, which reach as far as all others, serve for that.

Verdict: a document fails if repeats of ``min_words`` or more words cover more
than ``max_covered`` of its words, or one repeat is longer than ``max_longest``
of them.

Nulls and edges: a null text has no words and fails the base rule; lines are
split at \\n only; each row gives a row, an empty table none.  A text longer
than a chunk is one of its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_chunks, id_text, read_table, trimmed
from .hashing import mix, word_hashes

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\r\x0b\x0c"


_UNKNOWN = np.iinfo(np.int32).max
_BLOCK = 32


class _Ranges:
    """Minima of ranges of an array, in memory in proportion to it: minima of blocks, and from both ends of each."""

    def __init__(self, values: np.ndarray):
        self.values = values
        blocks = np.full(-(-max(len(values), 1) // _BLOCK) * _BLOCK, _UNKNOWN, values.dtype)
        blocks[: len(values)] = values
        blocks = blocks.reshape(-1, _BLOCK)
        self.head = np.minimum.accumulate(blocks, axis=1).ravel()
        self.tail = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.levels = [self.head[_BLOCK - 1 :: _BLOCK].copy()]
        while (step := 1 << (len(self.levels) - 1)) < len(self.levels[-1]):
            self.levels.append(np.minimum(self.levels[-1][:-step], self.levels[-1][step:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value of each ``low`` to ``high``, both included."""
        first, last = low // _BLOCK, high // _BLOCK
        out = np.where(first < last, np.minimum(self.tail[low], self.head[high]), self.values[low])
        k = np.flatnonzero(last - first > 1)
        if len(k):
            level = np.frexp((last[k] - first[k] - 1).astype(np.float64))[1] - 1
            for n in np.unique(level).tolist():
                some = k[level == n]
                found = np.minimum(self.levels[n][first[some] + 1], self.levels[n][last[some] - (1 << n)])
                out[some] = np.minimum(out[some], found)
        k = np.flatnonzero(first == last)
        at = low[k] + 1
        while len(k := k[live := at <= high[k]]):
            at = at[live]
            out[k] = np.minimum(out[k], self.values[at])
            at = at + 1
        return out


def suffix_array(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all documents in order, and the words each has in common with the one before.

    ``words`` are 64-bit word hashes; document d is ``words[bounds[d]:bounds[d + 1]]``.
    """
    n = len(words)
    lens = np.diff(bounds)
    end = np.repeat(bounds[1:], lens)
    key = mix(words ^ np.repeat(mix(np.arange(1, len(lens) + 1, dtype=np.uint64)), lens))  # the same word of another document is another
    sa = np.argsort(key)
    new = np.ones(n, bool)
    new[1:] = key[sa][1:] != key[sa][:-1]
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int64)  # place of the group's first member
    rank[sa] = np.repeat(starts, np.diff(np.append(starts, n)))
    lcp, step = np.full(n, _UNKNOWN, np.int32), 1
    lcp[starts] = 0
    size = np.diff(np.append(starts, n))
    act = sa[np.repeat(size > 1, size)]
    while len(act):
        ahead = act + step
        inside = ahead < end[act]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)], -1)
        first = rank[act]
        order = np.argsort(first * (n + 1) + second + 1)
        act, first, second = act[order], first[order], second[order]
        group = np.ones(len(act), bool)
        group[1:] = first[1:] != first[:-1]
        heads = np.flatnonzero(group)
        place = np.arange(len(act)) - np.repeat(heads, np.diff(np.append(heads, len(act)))) + first
        sa[place] = act
        new = group.copy()
        new[1:] |= second[1:] != second[:-1]
        parted = np.flatnonzero(new & ~group)  # from the one before
        common = np.zeros(len(parted), np.int32)
        follow = np.flatnonzero(second[parted - 1] >= 0)
        if len(follow):
            common[follow] = _Ranges(lcp).least(second[parted[follow] - 1] + 1, second[parted[follow]])
        lcp[place[parted]] = step + common
        heads = np.flatnonzero(new)
        size = np.diff(np.append(heads, len(act)))
        rank[act] = np.repeat(place[heads], size)
        step *= 2
        act = act[np.repeat(size > 1, size)]
    return sa, lcp


def lcp_intervals(lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of suffixes with ``least`` or more words in common: the words, and the first and last suffix."""
    at = np.flatnonzero(lcp >= least)
    out, open_, before = [], [], -2
    for j, v in zip(at.tolist(), lcp[at].tolist(), strict=True):
        if j != before + 1:
            out += [(n, first, before) for n, first in open_]
            open_ = []
        first = j - 1
        while open_ and open_[-1][0] > v:
            n, first = open_.pop()
            out.append((n, first, before))
        if not open_ or open_[-1][0] < v:
            open_.append((v, first))
        before = j
    out += [(n, first, before) for n, first in open_]
    return tuple(np.array(out, np.int64).reshape(-1, 3).T)


def maximal_repeats(words: np.ndarray, bounds: np.ndarray, sa: np.ndarray, lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, words and number of occurrences of each maximal repeated substring of ``least`` or more words, by place and length."""
    length, low, high = lcp_intervals(lcp, least)
    if not len(length):
        return length, length, length
    begins = np.zeros(len(words) + 1, bool)
    begins[bounds] = True
    before = words[sa - 1]
    varied = np.zeros(len(sa), np.int64)
    varied[1:] = np.cumsum((before[1:] != before[:-1]) | begins[sa[1:]] | begins[sa[:-1]])
    keep = varied[high] > varied[low]
    length, low, high = length[keep], low[keep], high[keep]
    place = _Ranges(sa).least(low, high) if len(low) else low
    order = np.lexsort((length, place))
    return place[order], length[order], (high - low + 1)[order]


def longest_repeats(sa: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each position, the words of its deepest interval: the longest substring from there that stands elsewhere in its document too."""
    out = np.empty(len(sa), np.int64)
    out[sa] = np.maximum(lcp, np.append(lcp[1:], 0)) if len(sa) else lcp
    return out


def covered(repeats: np.ndarray, least: int) -> np.ndarray:
    """Words inside a repeat of ``least`` or more words."""
    at = np.flatnonzero(repeats >= least)
    mark = np.bincount(at, minlength=len(repeats) + 1) - np.bincount(at + repeats[at], minlength=len(repeats) + 1)
    return np.cumsum(mark[: len(repeats)]) > 0


_OUT = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")]
    + [("repeats", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("copies", pa.int64())])))]
)


def _measure(min_words: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in doc_chunks(batches, size):
            data = b"\n".join(t or b"" for t in texts)
            h, starts, _ = word_hashes(np.frombuffer(data, np.uint8))
            bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(t or b"") + 1 for t in texts]))))
            sa, lcp = suffix_array(h, bounds)
            place, length, copies = maximal_repeats(h, bounds, sa, lcp, min_words)
            longest = longest_repeats(sa, lcp)
            eight, spans = covered(longest, 8), covered(longest, min_words)
            cut = np.searchsorted(place, bounds)
            rows = []
            for k, (i, t) in enumerate(zip(ids, texts, strict=True)):
                t, lo, hi = t or b"", int(bounds[k]), int(bounds[k + 1])
                lines = Counter(x for x in t.split(b"\n") if x.strip(_SPACES)) if b"\n" in t else {}
                chars = t.translate(None, _SPACES)
                rows.append(
                    (
                        i,
                        hi - lo,
                        len(chars) if chars.isascii() else len(chars.decode()),
                        len(t) - len(t.translate(None, _SYMBOLS)),
                        sum(lines.values()) - len(lines),
                        int(eight[lo:hi].sum()),
                        int(spans[lo:hi].sum()),
                        int(longest[lo:hi].max(initial=0)),
                        [{"start": p - lo, "length": n, "copies": c} for p, n, c in zip(*(x[cut[k] : cut[k + 1]].tolist() for x in (place, length, copies)), strict=True)],
                    )
                )
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)

    return run


def measure_repetition(docs: DataFrame, min_words: int = 5, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Base counts, ``n_covered, longest_repeat`` and ``repeats array<struct<start,length,copies>>`` (maximal ones of ``min_words`` or more, at the first of their copies) of each row; no shuffle."""
    schema = ", ".join(f"{f.name} long" for f in list(_OUT)[:-1]) + ", repeats array<struct<start:long,length:long,copies:long>>"
    return id_text(docs).mapInArrow(trimmed(_measure(min_words, chunk_bytes)), schema)


def with_verdict(measured: DataFrame, max_covered: float = 0.3, max_longest: float = 0.2) -> DataFrame:
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    fine = (F.col("n_covered") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_longest * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & fine)


def op5_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_verdict(measure_repetition(read_table(spark, sf_dir, "documents"))).drop("repeats")

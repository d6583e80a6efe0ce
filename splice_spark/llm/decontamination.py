"""Benchmark decontamination on a distributed positional inverted index.

Index.  It is split by document: a shard is a run of documents of a partition,
one row with all the shard's terms and, for each, the gaps between the rising
positions at which it stands.  It is stored as a table in the shared folder; the
documents are read once, to build it, and every search reads the index alone,
whatever the benchmark's size (``build_index``, then ``search_index`` as often as
wanted).  The filter ``keep_clean``, which searches once and then drops its index,
stores the terms of a benchmark of one part only.

Phrases.  A shard is searched from its lists alone.  The terms of a phrase are
taken from the one that is rarest in all documents, found once for each phrase:
the positions in its list, less its offset, are the candidate starts, which are
intersected with the offset-adjusted lists of the other terms, the next rarest first.

Proximity.  The ``need`` rarest terms of an item (of those that occur, by their
counts in all documents) must stand within ``slop`` words of one document; every
window around an occurrence of the rarest is looked at, whatever the shards are.

Benchmark.  Its texts are cut by Spark into pieces of at most ``piece_words``
words, which overlap so that no phrase is lost.  Pieces are sent to all tasks as
term numbers and a vocabulary, about as large as the text, in parts of at most
``most_bytes`` of text; a larger benchmark is searched part by part in the same
index, and the parts' hits are merged by place in the index.

Nulls and edges: a null text has no words; an item without words matches
nothing; repeated items count once by item_id; each document row gives a row,
an empty table none, an empty benchmark no hits.  The input must give the same
rows per partition when a task is run again.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, cut, cut_long, doc_chunks, id_text, ids_and_bytes, numbered, read_table, trimmed, without_rows

#: Lower-cases A-Z; other ASCII but digits and letters separates words; bytes from 0x80 belong to words.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_AT_ONCE = 1 << 22

INDEX = "shard long, doc_ids array<long>, n_words array<long>, terms array<binary>, counts array<long>, gaps array<int>"
FOUND = "shard long, place int, doc_id long, n_words long, hits array<struct<start:long,end:long>>, items array<long>, near array<struct<item:long,start:long,end:long>>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


def _index(terms: list[bytes] | None, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 24
        fixed = None if terms is None else {t: n for n, t in enumerate(terms)}
        for k, (ids, texts) in enumerate(doc_chunks(batches, size)):
            numbers, found, lens = fixed if fixed is not None else defaultdict(), [], []
            if fixed is None:
                numbers.default_factory = numbers.__len__  # a new word gets the next number
            for t in texts:
                words = words_of(t)
                known = map(numbers.__getitem__, words) if fixed is None else map(numbers.get, words, repeat(-1))
                found.append(np.fromiter(known, np.int32, len(words)))
                lens.append(len(words))
            seq = np.concatenate(found)
            at = np.flatnonzero(seq >= 0)
            at = at[np.argsort(seq[at], kind="stable")]
            counts = np.bincount(seq[at], minlength=len(numbers))
            gaps = np.diff(at, prepend=0)
            begins = (np.cumsum(counts) - counts)[counts > 0]
            gaps[begins] = at[begins]  # a term's first gap is its first position
            names = list(numbers)
            yield pa.RecordBatch.from_pydict(
                {"shard": [base + k], "doc_ids": [ids], "n_words": [lens], "terms": [[names[i] for i in np.flatnonzero(counts).tolist()]], "counts": [counts[counts > 0]], "gaps": [gaps.astype(np.int32)]},
                pa.schema([("shard", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("terms", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())), ("gaps", pa.list_(pa.int32()))]),
            )

    return run


def build_index(docs: DataFrame, terms: list[bytes] | None = None, shard_bytes: int = 4 << 20) -> DataFrame:
    """A row a shard, of all words or only of ``terms`` (a list of checked size), stored in the shared folder."""
    return cut_long(id_text(docs).mapInArrow(trimmed(_index(terms, shard_bytes)), INDEX))


def term_counts(index: DataFrame) -> DataFrame:
    """``term, n``: occurrences in all documents."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    return pairs.groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.counts").alias("n"))


def _cut_items(window: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, t in zip(*ids_and_bytes(batch), strict=True):
                words = words_of(t)
                for k in range(0, max(1, len(words) - window + 1) if words else 0, most):
                    rows.append((i, b" ".join(words[k : k + most + window - 1])))
            ids, texts = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.binary())], names=["item_id", "words"])

    return run


def cut_items(benchmark: DataFrame, window: int = 13, piece_words: int = 1 << 16) -> DataFrame:
    """``item_id, words`` (normalised, joined by spaces): pieces of the items that overlap by ``window - 1`` words."""
    items = id_text(benchmark, "item_id").toDF("item_id", "text").dropDuplicates()
    return items.mapInArrow(trimmed(_cut_items(window, piece_words)), "item_id long, words binary")


def rarest_terms(pieces: DataFrame, counts: DataFrame, need: int) -> DataFrame:
    """``item_id, terms``: the ``need`` (or all, if fewer) distinct words of an item that are the rarest of those that occur, rarest first; no row where too few occur."""
    key = F.coalesce(F.col("item_id").cast("string"), F.lit("-"))  # a null id is an item too
    words = pieces.select("item_id", key.alias("item"), F.explode(F.split(F.col("words").cast("string"), " ")).alias("word")).distinct()
    wanted = words.groupBy("item").agg(F.least(F.lit(need), F.count("*")).alias("wanted"))
    there = words.join(counts.select(F.col("term").cast("string").alias("word"), "n"), "word")
    ranked = there.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy("n", "word"))).filter(F.col("rank") <= need)
    best = ranked.groupBy("item").agg(F.first("item_id").alias("item_id"), F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("t"))  # at most ``need`` an item
    return best.join(wanted, "item").filter("size(t) >= wanted").select("item_id", F.transform("t", lambda x: x["word"]).alias("terms"))


@dataclass
class Phrases:
    """A part of the benchmark as term numbers: pieces in a row, where each begins, and its item; terms' places by count; terms to be near; by length, where phrases begin and their rarest term's offset."""

    terms: list[bytes]
    seq: np.ndarray
    first: np.ndarray
    items: list
    rarity: np.ndarray
    near: list[tuple[int | None, np.ndarray]]
    tables: list[tuple[int, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, pieces: list[tuple[int | None, bytes]], near: list[tuple[int | None, list[str]]]) -> Phrases:
        numbers: dict[bytes, int] = {}
        seqs = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words.split(b" ")), np.int32) for _, words in pieces]
        for _, words in near:
            for w in words:
                numbers.setdefault(w.encode(), len(numbers))
        first = np.cumsum([0, *map(len, seqs)])
        close = [(i, np.array([numbers[w.encode()] for w in words], np.int64)) for i, words in near]
        return cls(list(numbers), np.concatenate(seqs) if seqs else np.zeros(0, np.int32), first, [i for i, _ in pieces], np.zeros(len(numbers), np.int32), close, [])

    def rank_by(self, counts: dict[bytes, int], window: int) -> None:
        """Places of the terms by their counts in all documents, the rarest first, and the rarest of each phrase."""
        self.rarity[np.lexsort((np.arange(len(self.terms)), [counts.get(t, 0) for t in self.terms]))] = np.arange(len(self.terms), dtype=np.int32)
        self.tables = [(n, begin, self._rarest(n, begin)) for n, begin in self.by_length(window)]

    def _rarest(self, n: int, begin: np.ndarray) -> np.ndarray:
        offset = np.zeros(len(begin), np.int8 if n < 128 else np.int32)
        rarest = np.full(len(begin), np.iinfo(np.int32).max, np.int32)
        for k in range(n):
            here = self.rarity[self.seq[begin + k]]
            offset[here < rarest] = k
            rarest = np.minimum(rarest, here)
        return offset

    def by_length(self, window: int) -> Iterator[tuple[int, np.ndarray]]:
        """Phrase lengths, and where phrases of each begin: whole pieces, or all windows of the longer ones."""
        lens = np.diff(self.first)
        for n in np.unique(np.minimum(lens, window)).tolist():
            some = np.flatnonzero(lens == n) if n < window else np.flatnonzero(lens >= window)
            many = np.where(lens[some] >= window, lens[some] - window + 1, 1)
            yield n, np.repeat(self.first[some] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))


class _Shard:
    """One row of the index: posting lists by term number, as one rising array of (term, position)."""

    def __init__(self, row: dict, terms: pa.Array):
        self.ends = np.cumsum(row["n_words"])
        self.n = int(self.ends[-1]) if len(self.ends) else 0
        known = pc.fill_null(pc.index_in(pa.array(row["terms"], pa.binary()), terms), -1).to_numpy().astype(np.int64)
        counts = np.asarray(row["counts"], np.int64)
        at, begins = np.cumsum(np.asarray(row["gaps"], np.int64)), np.cumsum(counts) - counts
        at -= np.repeat(at[begins] - np.asarray(row["gaps"], np.int64)[begins], counts)
        ours = np.repeat(known, counts)
        self.keys = np.sort(ours[ours >= 0] << 32 | at[ours >= 0])
        self.counts = np.bincount(known[known >= 0], weights=counts[known >= 0], minlength=len(terms)).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")

    def list_of(self, term: int) -> np.ndarray:
        return self.keys[self.starts[term] : self.starts[term] + self.counts[term]] & 0xFFFFFFFF

    def stand_at(self, terms: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether each position is in the list of its term."""
        keys = terms.astype(np.int64) << 32 | at
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys

    def find(self, phrases: Phrases, n: int, begin: np.ndarray, rarest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of phrases of ``n`` terms from ``begin`` on, whose rarest terms are at the offsets ``rarest``: those that occur and their start positions, an element for each occurrence."""
        sizes = self.counts[phrases.seq[begin + rarest]]
        live = np.flatnonzero(sizes)
        groups = np.cumsum(sizes[live] + 32) // _AT_ONCE
        for g in np.unique(groups):
            p = live[groups == g]
            order = np.argsort(phrases.rarity[phrases.seq[begin[p][:, None] + np.arange(n)]], axis=1, kind="stable")
            many, ends = sizes[p], np.cumsum(sizes[p])
            lead = self.starts[phrases.seq[begin[p] + order[:, 0]]]
            at = self.keys[np.repeat(lead - ends + many, many) + np.arange(int(ends[-1]))] & 0xFFFFFFFF
            q = np.repeat(np.arange(len(p)), many)
            at = at - order[q, 0]
            fits = (at >= 0) & (at + n <= self.n)
            q, at = q[fits], at[fits]
            fits = self.doc_of(at) == self.doc_of(at + n - 1)
            q, at = q[fits], at[fits]
            for k in range(1, n):  # intersect with the next list, adjusted by its offset
                if not len(q):
                    break
                offset = order[q, k]
                fits = self.stand_at(phrases.seq[begin[p[q]] + offset], at + offset)
                q, at = q[fits], at[fits]
            if len(q):
                yield begin[p[q]], at

    def near(self, terms: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the shortest window (the leftmost of equal ones) around each occurrence of the first term that has all ``terms``, where it has ``slop`` words at most."""
        lists = [self.list_of(t) for t in terms.tolist()]
        at = lists[0]
        far = self.n + 2 * slop  # beyond every window
        for other in lists[1:]:  # one within reach on either side
            at = at[np.append(other, far)[np.searchsorted(other, at - slop + 1)] < at + slop]
        low, size = at.copy(), np.full(len(at), slop + 1)
        for back in range(slop - 1, -1, -1) if len(at) else ():
            left = at - back
            right = at.copy()
            for other in lists[1:]:
                right = np.maximum(right, np.append(other, far)[np.searchsorted(other, left)])
            better = np.flatnonzero((left >= 0) & (right - left + 1 < size))
            better = better[self.doc_of(left[better]) == self.doc_of(right[better])]
            low[better], size[better] = left[better], (right - left + 1)[better]
        ok = size <= slop
        return low[ok], low[ok] + size[ok] - 1


def _search(phrases: Phrases, slop: int):
    span = [("start", pa.int64()), ("end", pa.int64())]
    schema = pa.schema([("shard", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.struct(span))), ("items", pa.list_(pa.int64())), ("near", pa.list_(pa.struct([("item", pa.int64()), *span])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(phrases.terms, pa.binary())
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                row |= {c: row[c].values.to_numpy() for c in ("counts", "gaps")} | {"terms": row["terms"].values}
                row |= {c: row[c].as_py() for c in ("shard", "doc_ids", "n_words")}
                shard = _Shard(row, terms)
                mark = np.zeros(shard.n + 1, np.int32)
                items: list[set] = [set() for _ in row["doc_ids"]]
                close: list[list] = [[] for _ in row["doc_ids"]]
                for n, begin, rarest in phrases.tables if len(shard.keys) else ():
                    for p, at in shard.find(phrases, n, begin, rarest):
                        np.add.at(mark, at, 1)
                        np.add.at(mark, at + n, -1)
                        owner = np.searchsorted(phrases.first, p, "right") - 1
                        for doc, which in set(zip(shard.doc_of(at).tolist(), owner.tolist(), strict=True)):
                            items[doc].add(phrases.items[which])
                bounds = np.concatenate(([0], shard.ends))
                for item, some in phrases.near:
                    if shard.counts[some].all():
                        low, high = shard.near(some, slop)
                        for d, a, b in zip(shard.doc_of(low).tolist(), low.tolist(), high.tolist(), strict=True):
                            close[d].append({"item": item, "start": a - int(bounds[d]), "end": b + 1 - int(bounds[d])})
                hit = np.cumsum(mark[:-1]) > 0
                docs = len(row["doc_ids"])
                spans: list[list] = [[] for _ in range(docs)]
                for doc in np.unique(shard.doc_of(np.flatnonzero(hit))).tolist():
                    edges = np.flatnonzero(np.diff(hit[bounds[doc] : bounds[doc + 1]], prepend=False, append=False)).tolist()
                    spans[doc] = [{"start": a, "end": b} for a, b in zip(edges[0::2], edges[1::2], strict=True)]
                yield pa.RecordBatch.from_pydict({"shard": [row["shard"]] * docs, "place": range(docs), "doc_id": row["doc_ids"], "n_words": row["n_words"], "hits": spans, "items": [sorted(x, key=str) for x in items], "near": close}, schema)

    return run


def search_index(index: DataFrame, benchmark: DataFrame, window: int = 13, need: int = 5, slop: int = 20, most_bytes: int = 8 << 20) -> DataFrame:
    """Of each document row ``doc_id, n_words, hits array<struct<start,end>>`` (merged word spans of phrases)``, items
    array<bigint>`` (with phrases)``, near array<struct<item,start,end>>``, from a stored index alone.

    A phrase is ``window`` consecutive words of an item, or all of a shorter item.  ``near`` has an element for each
    occurrence of the rarest of the ``need`` rarest terms of an item with all of them in ``slop`` words: the shortest such
    window, the leftmost of equal ones; with ``need`` 0 it is empty.
    """
    return _search_pieces(index, cut(cut_items(benchmark, window)), window, need, slop, most_bytes)


def _search_pieces(index: DataFrame, pieces: DataFrame, window: int, need: int, slop: int, most_bytes: int) -> DataFrame:
    n = max(1, math.ceil(_parts(pieces, most_bytes)))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("item_id", "words"), F.lit(n)))
    words = cut(pieces.select("part", F.explode(F.split(F.col("words").cast("string"), " ").cast("array<binary>")).alias("term")).distinct())
    counts = cut(term_counts(index).join(words.select("term").distinct(), "term", "left_semi"))
    close = cut(rarest_terms(pieces, counts, need).withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(n)))) if need else None
    found = []
    for k in range(n):
        mine = F.col("part") == k
        some = [(r[0], bytes(r[1])) for r in pieces.filter(mine).select("item_id", "words").collect()]
        near = [tuple(r) for r in close.filter(mine).select("item_id", "terms").collect()] if need else []
        phrases = Phrases.of(some, near)
        phrases.rank_by({bytes(r[0]): r[1] for r in counts.join(words.filter(mine), "term").select("term", "n").collect()}, window)  # a row for each word of the part at most
        here = index.mapInArrow(trimmed(_search(phrases, slop)), FOUND)
        if n == 1:
            return here.drop("shard", "place")
        found.append(cut(here.filter("size(hits) + size(near) > 0")))
    return _merged(index, found)


def _parts(pieces: DataFrame, most_bytes: int) -> float:
    """Parts of the benchmark that are searched one by one; 1 if it is no larger than ``most_bytes``."""
    size = pieces.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    return 1.25 * size / most_bytes if size > most_bytes else 1


def _merged(index: DataFrame, found: list[DataFrame]) -> DataFrame:
    """A row for each document row of the index, with what the parts found in it."""
    names = ["shard", "place", "doc_id", "n_words", "hits", "items", "near"]
    each = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("place", "d")).select("shard", "place", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").alias("n_words"))
    rows = each.withColumns({c: F.array().cast(found[0].schema[c].dataType) for c in names[4:]})
    for more in found:
        rows = rows.unionByName(more)
    spans = F.array_sort(F.flatten(F.collect_list("hits")))
    merged = F.aggregate(
        spans,
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda out, s: F.when((F.size(out) > 0) & (F.try_element_at(out, F.lit(-1))["end"] >= s["start"]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.try_element_at(out, F.lit(-1))["start"].alias("start"), F.greatest(F.try_element_at(out, F.lit(-1))["end"], s["end"]).alias("end"))))).otherwise(F.concat(out, F.array(s))),
    )
    once = rows.groupBy("shard", "place").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), merged.alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.flatten(F.collect_list("near")).alias("near"))
    return once.select(*names[2:])


def find_items(docs: DataFrame, benchmark: DataFrame, window: int = 13, need: int = 5, slop: int = 20, most_bytes: int = 8 << 20, shard_bytes: int = 4 << 20) -> DataFrame:
    """``search_index`` of the documents' index, which is built and stored first."""
    return search_index(build_index(docs, shard_bytes=shard_bytes), benchmark, window, need, slop, most_bytes)


def find_near(docs: DataFrame, benchmark: DataFrame, need: int = 5, slop: int = 20, **sizes: int) -> DataFrame:
    """``doc_id, item_id, start, end``: a row for each proximity match of ``find_items``."""
    found = find_items(docs, benchmark, need=need, slop=slop, **sizes)
    return found.select("doc_id", F.explode("near").alias("m")).select("doc_id", F.col("m.item").alias("item_id"), "m.start", "m.end")


def contaminated(n_hit: F.Column, n_words: F.Column) -> F.Column:
    """The rule: a twentieth of the words, or more, stand in benchmark phrases."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def with_verdict(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, most_bytes: int = 8 << 20) -> DataFrame:
    """Rows of ``docs``, with all their columns, that aren't contaminated."""
    rows, pieces = cut(numbered(docs)), cut(cut_items(benchmark, window))
    terms = None
    if _parts(pieces, most_bytes) == 1:
        words = pieces.select(F.explode(F.split(F.col("words").cast("string"), " ")).alias("term")).distinct()
        terms = [r[0].encode() for r in words.collect()]
    index = build_index(rows.select(F.col(ROW).alias("doc_id"), "text"), terms)
    found = with_verdict(_search_pieces(index, pieces, window, 0, 0, most_bytes))
    return without_rows(rows, found.filter("contaminated").withColumnRenamed("doc_id", ROW))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_verdict(find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))
    items = F.array_sort(F.col("items").cast("array<string>"))
    near = F.array_distinct(F.transform("near", lambda m: m["item"]))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated", F.size(near).cast("long").alias("n_near"))


def op3_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_near(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))

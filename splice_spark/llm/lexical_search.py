"""Ranked lexical search over a stored, tiered index.

The index is cut into blocks of about 8 MB of text, a row each, so a document's
postings stand together and a block is searched by one task.  In a block each
term's postings are dealt over tiers by impact (the part of the score that
depends on the document): terms of at most one in ``SHARE`` documents stand in
the first tier as a whole, others with as many of their highest impacts as
fit that share, then eight times as many, then the rest.  Tiers are columns, so
the lower ones aren't read for searches of the upper ones.  For each term and tier the index
has a residual bound: no posting below has a greater impact.

A search scores the first tier and takes each item's k-th best partial score,
which bounds its k-th score from below.  If it exceeds the sum of the item's
residual bounds, no unseen document can be among its k best: the item is proved
and only documents whose upper bound reaches that score are completed, from the
shelves of blocks that have such documents.  Items without proof fall through to
the next tier; below the last one nothing is left, so it always proves.

Terms are maximal runs of ASCII letters and digits and of characters beyond
ASCII, with A-Z lowered; a null text has none.  A document without terms isn't
counted or found.  Repeated ids are documents of their own; a null id is found
last among equal scores.  Repeated item rows each get their results.  An item
without a known term, and an empty table, give no rows.  Scores are 64-bit sums.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splice_spark.functions.lineage import shared_folder

from .common import LOWER, binary, cut, doc_chunks, id_text, read_table, small_batches, squeeze, trimmed, unsqueeze

TERM = regex.compile(rb"[0-9A-Za-z\x80-\xFF]+")
BLOCK_BYTES = 8 << 20
TIERS = 3
#: A term of more than one in so many documents is dealt over tiers; the tiers above the last hold so many times that share of documents at most.
SHARE, WIDTHS = 500, (1, 8)
#: Ranges of impacts (under 1,000,000) in which postings are counted.
LEVELS, STEP = 64, 15_625
#: Tasks whose blocks stand on one shelf (a folder).
SHELF = 16
#: Text of the items that are searched in one round of jobs.
PART_BYTES = 8 << 20
_NO_ID = np.iinfo(np.int64).max


def _pack(*parts: bytes) -> bytes:
    """Several byte strings in one, compressed."""
    return squeeze(b"".join([np.array([len(parts), *map(len, parts)], np.int64).tobytes(), *parts]))


def _unpack(data: bytes) -> list[bytes]:
    data = unsqueeze(data)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    ends = 8 * (n + 1) + np.cumsum(np.frombuffer(data, np.int64, n, 8))
    return [data[a:b] for a, b in zip([8 * (n + 1), *ends[:-1].tolist()], ends.tolist(), strict=True)]


def terms_of(text: bytes) -> list[bytes]:
    return TERM.findall(text.translate(LOWER))


_RAW = "block long, shelf int, n_docs long, n_terms long, docs binary, terms binary, postings binary"


def _blocks(size: int):
    """Blocks of documents: ids and lengths, terms with their document counts, and postings (document, occurrences) by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(doc_chunks(batches, size)):
            known: dict[bytes, int] = {}
            term, tf, doc_ids, lens, distinct = [], [], [], [], []
            for i, text in zip(ids, texts, strict=True):
                counts = Counter(terms_of(text or b""))
                if counts:
                    doc_ids.append(_NO_ID if i is None else i)
                    lens.append(counts.total())
                    distinct.append(len(counts))
                    term += [known.setdefault(t, len(known)) for t in counts]
                    tf += counts.values()
            if not doc_ids:
                continue
            term = np.array(term, np.int32)
            doc = np.repeat(np.arange(len(doc_ids), dtype=np.int32), distinct)
            order = np.argsort(term, kind="stable")
            df = np.bincount(term, minlength=len(known)).astype(np.int32)
            columns = [
                [task << 32 | number], [task // SHELF], [len(doc_ids)], [sum(lens)], [_pack(np.array(doc_ids, np.int64).tobytes(), np.array(lens, np.int64).tobytes())],
                [_pack(b"\n".join(known), df.tobytes())], [_pack(doc[order].tobytes(), np.array(tf, np.int32)[order].tobytes())],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == 1 else pa.int64() if n < 4 else pa.binary()) for n, c in enumerate(columns)], names=[c.split()[0] for c in _RAW.split(", ")])

    return run


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0):
            words, df = _unpack(data.as_py())
            yield pa.RecordBatch.from_arrays([binary(words.split(b"\n")), pa.array(np.frombuffer(df, np.int32).astype(np.int64))], names=["term", "df"])


def impacts(tf: np.ndarray, lens: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The part of a posting's score that depends on its document, in whole numbers."""
    m = 25 + (75 * lens * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _block_impacts(batch: pa.RecordBatch, k: int, n_docs: int, n_terms: int) -> tuple:
    """Terms, their document counts, documents and impacts of a block."""
    _, lens = _unpack(batch.column("docs")[k].as_py())
    words, df = _unpack(batch.column("terms")[k].as_py())
    doc, tf = (np.frombuffer(x, np.int32) for x in _unpack(batch.column("postings")[k].as_py()))
    return words.split(b"\n"), np.frombuffer(df, np.int32), doc, impacts(tf.astype(np.int64), np.frombuffer(lens, np.int64)[doc], n_docs, n_terms)


def _levels(frequent: dict[bytes, int], n_docs: int, n_terms: int):
    """Postings of each frequent term by range of impacts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words, df, _, impact = _block_impacts(batch, k, n_docs, n_terms)
                number = np.array([frequent.get(w, -1) for w in words], np.int64)
                at = np.repeat(number, df)
                counts = np.bincount(at[at >= 0] * LEVELS + impact[at >= 0] // STEP)
                there = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(there // LEVELS, pa.int64()), pa.array(there % LEVELS, pa.int64()), pa.array(counts[there], pa.int64())], names=["number", "level", "n"])

    return run


def _tiers(frequent: dict[bytes, int], floors: np.ndarray, n_docs: int, n_terms: int):
    """A block's postings dealt over tiers: by the least level of each frequent term in each tier; all others in the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words, df, doc, impact = _block_impacts(batch, k, n_docs, n_terms)
                least = np.zeros((TIERS - 1, len(words)), np.int64)
                for i, w in enumerate(words):
                    if w in frequent:
                        least[:, i] = floors[:, frequent[w]]
                at = np.repeat(np.arange(len(words)), df)
                tier = (impact // STEP < least[:, at]).sum(axis=0)
                made = []
                for t in range(TIERS):
                    here = tier == t
                    counts = np.bincount(at[here], minlength=len(words))
                    some = np.flatnonzero(counts)
                    made.append(_pack(b"\n".join([words[i] for i in some.tolist()]), counts[some].astype(np.int32).tobytes(), doc[here].tobytes(), impact[here].astype(np.int32).tobytes()))
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(k, 1), batch.column("shelf").slice(k, 1), binary([_unpack(batch.column("docs")[k].as_py())[0]]), *[binary([x]) for x in made]], names=["block", "shelf", "docs", *[f"tier{t}" for t in range(TIERS)]])

    return run


@dataclass(frozen=True)
class Index:
    """A stored index: ``blocks`` (a row each, tiers as columns), ``terms`` (``term, df``), ``residuals`` (``term, r0, r1``) of frequent terms, and totals."""

    path: str
    blocks: DataFrame
    terms: DataFrame
    residuals: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES, share: int = SHARE) -> Index:
    """Write the index of all rows of ``docs`` (``doc_id, text``) under ``path``.

    What goes to the driver, and from there to tasks, are the frequent terms with a few numbers each: at most ``share`` times the
    distinct terms of an average document, whatever the number of documents.
    """
    spark = docs.sparkSession
    raw = cut(id_text(docs).mapInArrow(trimmed(_blocks(block_bytes)), _RAW))
    n_docs, n_terms = (int(x or 0) for x in raw.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    counts = raw.select("terms").mapInArrow(trimmed(_term_counts), "term binary, df long")
    counts.groupBy("term").agg(F.sum("df").alias("df")).write.parquet(f"{path}/terms")
    terms = spark.read.parquet(f"{path}/terms")
    frequent = {bytes(r["term"]): k for k, r in enumerate(terms.filter(F.col("df") * share > n_docs).select("term").orderBy("term").toLocalIterator())}
    levels = np.zeros((len(frequent), LEVELS), np.int64)
    body = raw.select("block", "shelf", "docs", "terms", "postings")
    for number, level, n in body.mapInArrow(trimmed(_levels(frequent, n_docs, n_terms)), "number long, level long, n long").groupBy("number", "level").agg(F.sum("n")).toLocalIterator():
        levels[number, level] = n
    above = levels[:, ::-1].cumsum(axis=1)[:, ::-1]  # postings of this level and higher ones
    floors = np.stack([LEVELS - (above <= max(1, w * n_docs // share)).sum(axis=1) for w in WIDTHS])
    # of the levels below a floor the highest that has postings bounds them
    below = [np.where(levels[None, k] > 0, np.arange(1, LEVELS + 1), 0)[0] for k in range(len(frequent))]
    bounds = [[int(below[k][: floors[t, k]].max(initial=0)) * STEP for t in range(TIERS - 1)] for k in range(len(frequent))]
    spark.createDataFrame([(w, *bounds[k]) for w, k in frequent.items()], "term binary, r0 long, r1 long").write.parquet(f"{path}/residuals")
    spark.createDataFrame([(n_docs, n_terms)], "n_docs long, n_terms long").coalesce(1).write.parquet(f"{path}/totals")
    tiers = ", ".join(f"tier{t} binary" for t in range(TIERS))
    dealt = body.mapInArrow(trimmed(_tiers(frequent, floors, n_docs, n_terms)), f"block long, shelf int, docs binary, {tiers}")
    dealt.write.option("compression", "uncompressed").option("parquet.block.size", 16 << 20).partitionBy("shelf").parquet(f"{path}/blocks")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> Index:
    small_batches(spark)
    n_docs, n_terms = spark.read.parquet(f"{path}/totals").first()
    schema = "block long, docs binary, " + ", ".join(f"tier{t} binary" for t in range(TIERS)) + ", shelf int"
    return Index(path, spark.read.schema(schema).parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/residuals"), n_docs, n_terms)


@dataclass
class _Part:
    """Items of one round of jobs: terms, residual bounds by tier and term, and per item its number, terms and weights."""

    words: list[bytes]
    residuals: np.ndarray
    items: list[tuple[int, np.ndarray, np.ndarray]]

    def residual(self, item: int, tier: int) -> int:
        _, at, weight = self.items[item]
        return int((weight * self.residuals[tier, at]).sum())


class _Search:
    """Scores of a part's items in one block."""

    def __init__(self, part: _Part, batch: pa.RecordBatch, k: int):
        self.part, self.batch, self.k = part, batch, k
        self.ids = np.frombuffer(batch.column("docs")[k].as_py(), np.int64)
        self.lists: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in part.words]
        self.upto = 0

    def read(self, tiers: int) -> None:
        """Read further tiers until there are so many."""
        while self.upto < tiers:
            words, counts, doc, impact = _unpack(self.batch.column(f"tier{self.upto}")[self.k].as_py())
            place = {w: i for i, w in enumerate(words.split(b"\n"))} if words else {}
            ends = np.cumsum(np.frombuffer(counts, np.int32))
            doc, impact = np.frombuffer(doc, np.int32), np.frombuffer(impact, np.int32).astype(np.int64)
            for at, w in enumerate(self.part.words):
                if (i := place.get(w)) is not None:
                    here = slice(ends[i - 1] if i else 0, ends[i])
                    self.lists[at].append((doc[here], impact[here]))
            self.upto += 1

    def partial(self, item: int, tiers: int) -> np.ndarray:
        """Each document's score by the first tiers."""
        self.read(tiers)
        out = np.zeros(len(self.ids), np.int64)
        for at, weight in zip(self.part.items[item][1].tolist(), self.part.items[item][2].tolist(), strict=True):
            for doc, impact in self.lists[at]:
                out[doc] += weight * impact
        return out

    def candidates(self, item: int, tiers: int, least: int) -> np.ndarray:
        """Documents whose upper bound after the first tiers is ``least`` or more: partial score, and residuals of terms not met there."""
        bound = self.partial(item, tiers)
        bound += self.part.residual(item, tiers - 1)
        for at, weight in zip(self.part.items[item][1].tolist(), self.part.items[item][2].tolist(), strict=True):
            known = weight * int(self.part.residuals[tiers - 1, at])
            for doc, _ in self.lists[at]:
                bound[doc] -= known
        return np.flatnonzero(bound >= least)

    def best(self, scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
        if len(among) > k:
            kth = np.partition(scores[among], len(among) - k)[len(among) - k]
            among = among[scores[among] >= kth]
        return among[np.lexsort((self.ids[among], -scores[among]))][:k]


_FOUND = "q long, doc_id long, score long"


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [()] * 3)], names=["q", "doc_id", "score"])


def _partials(part: _Part, items: list[int], tiers: int, k: int):
    """Each block's k best partial scores of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                search, out = _Search(part, batch, r), []
                for item in items:
                    scores = search.partial(item, tiers)
                    best = search.best(scores, np.flatnonzero(scores), k)
                    out += [(part.items[item][0], i, s) for i, s in zip(search.ids[best].tolist(), scores[best].tolist(), strict=True)]
                yield _found(out)

    return run


def _shelves(part: _Part, proved: dict[int, tuple[int, int]]):
    """Shelves of blocks that have a candidate of an item; ``proved`` has tiers and the least score of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there = set()
            for r in range(batch.num_rows):
                search = _Search(part, batch, r)
                if any(len(search.candidates(item, tiers, least)) for item, (tiers, least) in sorted(proved.items(), key=lambda x: x[1][0])):
                    there.add(batch.column("shelf")[r].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(sorted(there), pa.int32())], names=["shelf"])

    return run


def _complete(part: _Part, proved: dict[int, tuple[int, int]], k: int):
    """Whole scores of the candidates; a block without any leaves its lower tiers packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                search, chosen, out = _Search(part, batch, r), {}, []
                for item, (tiers, least) in sorted(proved.items(), key=lambda x: x[1][0]):
                    if len(docs := search.candidates(item, tiers, least)):
                        chosen[item] = docs
                for item, docs in chosen.items():
                    scores = search.partial(item, TIERS)
                    best = search.best(scores, docs[scores[docs] > 0], k)
                    out += [(part.items[item][0], i, s) for i, s in zip(search.ids[best].tolist(), scores[best].tolist(), strict=True)]
                yield _found(out)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _compile(index: Index, rows: list) -> _Part:
    """Weights, as whole numbers, and residual bounds of the items' terms."""
    words = sorted({(bytes(t["term"]), t["df"], t["r0"] or 0, t["r1"] or 0) for r in rows for t in r["terms"]})
    place = {w[0]: i for i, w in enumerate(words)}
    weight = [math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df + 1))) for _, df, _, _ in words]
    residuals = np.array([[w[2 + t] for w in words] for t in range(TIERS - 1)] + [[0] * len(words)], np.int64)
    items = []
    for r in rows:
        at = np.array([place[bytes(t["term"])] for t in r["terms"]], np.int64)
        items.append((r["q"], at, np.array([weight[i] * t["n"] for i, t in zip(at.tolist(), r["terms"], strict=True)], np.int64)))
    return _Part([w[0] for w in words], residuals, items)


def _search_part(index: Index, part: _Part, k: int, report: list) -> DataFrame:
    """Ranks of all items of a part."""
    spark = index.blocks.sparkSession
    active, proved, out = list(range(len(part.items))), {}, []
    for t in range(TIERS):
        columns = ["docs", *[f"tier{x}" for x in range(t + 1)]]
        top = cut(_ranked(index.blocks.select(*columns).mapInArrow(trimmed(_partials(part, active, t + 1, k)), _FOUND), k))
        kth = {r["q"]: r["s"] for r in top.filter(F.col("rank") == k).select("q", F.col("score").alias("s")).collect()}  # a row an item of the part
        whole, rest = [], []
        for item in active:
            left, least = part.residual(item, t), kth.get(part.items[item][0], 0)
            if left == 0:
                whole.append(part.items[item][0])
            elif left < least:
                proved[item] = (t + 1, least)
            else:
                rest.append(item)
        report.append((t, len(active), len(active) - len(rest)))
        if whole:
            out.append(top.join(F.broadcast(spark.createDataFrame([(q,) for q in whole], "q long")), "q", "left_semi"))
        active = rest
        if not active:
            break
    if proved:
        upto = max(t for t, _ in proved.values())
        near = index.blocks.select("docs", *[f"tier{x}" for x in range(upto)], "shelf").mapInArrow(trimmed(_shelves(part, proved)), "shelf int").distinct()
        shelves = [r["shelf"] for r in near.collect()]
        blocks = index.blocks.filter(F.col("shelf").isin(shelves)).drop("block", "shelf")
        out.append(_ranked(blocks.mapInArrow(trimmed(_complete(part, proved, k)), _FOUND), k))
    done = out[0].select("q", "rank", "doc_id", "score")
    for more in out[1:]:
        done = done.unionByName(more.select("q", "rank", "doc_id", "score"))
    return done


def search(index: Index, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", part_bytes: int = PART_BYTES, report: list | None = None) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 of each row of ``items``, exactly.

    Items are searched in parts of ``part_bytes`` of text, which the driver compiles one after the other.  ``report`` gets (tier, items
    searched, items settled) of each round.
    """
    spark = items.sparkSession
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(text, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), 1)
    named = cut(items.select(F.col(id_col).alias("item_id"), found.alias("words"), F.octet_length(text).alias("size")).withColumn("q", F.monotonically_increasing_id()))
    asked = named.select("q", F.explode("words").alias("term")).groupBy("q", F.col("term").cast("binary").alias("term")).agg(F.count("*").alias("n"))
    met = asked.join(index.terms, "term").join(index.residuals, "term", "left")
    total = named.agg(F.sum("size")).first()[0] or 0
    parts = max(1, math.ceil(total / part_bytes))
    whole = cut(met.groupBy("q").agg(F.collect_list(F.struct("term", "df", "n", "r0", "r1")).alias("terms")).withColumn("part", F.pmod(F.xxhash64("q"), F.lit(parts)).cast("int")))
    done = spark.createDataFrame([], "q long, rank int, doc_id long, score long")
    for p in range(parts):
        rows = whole.filter(F.col("part") == p).select("q", "terms").collect()
        if rows:
            done = done.unionByName(_search_part(index, _compile(index, rows), k, [] if report is None else report))
    doc_id = F.when(F.col("doc_id") != int(_NO_ID), F.col("doc_id"))
    return done.join(named.select("q", "item_id"), "q").select("item_id", "rank", doc_id.alias("doc_id"), "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(read_table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/lexical-{uuid.uuid4().hex}")
    return search(index, read_table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11_SQL = rf"""
WITH w AS (
    SELECT doc_id, unnest({_TERMS}) AS term FROM documents
), p AS (
    SELECT doc_id, term, count(*) AS tf FROM w GROUP BY doc_id, term
), d AS (
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY doc_id
), t AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d
), f AS (
    SELECT term, CAST(floor(1000 * ln((2 * t.docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, t GROUP BY term, t.docs
), q AS (
    SELECT item_id, term, count(*) AS n FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
), s AS (
    SELECT q.item_id, p.doc_id, CAST(sum(q.n * f.weight * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * d.n * t.docs) // t.words)))) AS BIGINT) AS score
    FROM q JOIN p ON q.term = p.term JOIN f ON q.term = f.term JOIN d ON p.doc_id = d.doc_id, t GROUP BY q.item_id, p.doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 10
"""

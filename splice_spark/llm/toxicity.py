"""Toxicity scores: Levenshtein automata over a lexicon trie, weighed by context.

The lexicon is learned from labelled rows: whole words and word stems that
stand in ``least`` toxic texts or more and hardly in clean ones, beyond what
chance explains (``evidence``, a likelihood ratio), besides a short seed list.
It is learned in rounds that ask for less and less evidence; each counts only
toxic texts that no entry hits so far, so that the other words of a text that is
copied and changed over and over are no evidence.  Counting and choice are
Spark's; only what is chosen comes to the driver.  A word of a document hits if it is a lexicon word, begins with a lexicon stem, or
is a misspelling: the word's Levenshtein automaton (one edit from five letters,
two from nine) is run down the trie of lexicon words, after a test that a piece
of some word stands at its place.  Words longer than any of the lexicon by more
than the edits allowed can't be misspellings and aren't tried.  Figures for letters are undone first.

Each hit looks at the words around it: inside or beside quotation marks, or
near a word of saying, it counts as quoted.  Counts and rates of direct, stem,
misspelt and quoted hits go into a ridge logistic regression.

The lexicon and the regression are fitted on at most ``sample`` labelled rows a
class (``labelled_sample``), outside the held-out fifth (crc32 of doc_id as text,
modulo 5, is 0).  All texts are scored whole, in one pass
without a shuffle.

Nulls and edges: a null text is an empty one and has a score; each row gives a
row, an empty table none; words of any length are looked up; several different labels of a
doc_id all count, repeated rows once; without toxic rows the seed list and fixed weights serve.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, id_text, ids_and_bytes, read_table, trimmed
from .quality_classifier import held_out

#: Insults that are in the lexicon whatever the labels hold.
SEED = ("idiot", "moron", "stupid", "pathetic", "worthless", "disgusting", "trash", "scum", "loser", "clown")
#: Words near which a hit is taken as reported.
SAYING = frozenset("said says quote quoted quotes wrote called reported according cited dit disait dijo sagte schrieb".split())
_QUOTES = re.compile('["“”„«»‘’‹›]')
_FIGURES = str.maketrans("013457@$!", "oieastasi")
_WORDS = re.compile(r"[^\W_]+")
_CACHE = 1 << 20
NONE, WORD, STEM, NEAR = range(4)
LENGTHS = range(3, 8)


def edits_allowed(n: int) -> int:
    return 0 if n < 5 else 1 if n < 9 else 2


@dataclass
class Lexicon:
    words: frozenset[str]
    stems: frozenset[str]
    trie: dict = field(init=False)

    def __post_init__(self):
        self.trie = {}
        for w in self.words:
            node = self.trie
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w
        self.stem_lengths = sorted({len(s) for s in self.stems})
        self.reach = max((len(w) + edits_allowed(len(w)) for w in self.words), default=0)
        pieces = []
        for w in sorted(self.words):
            if k := edits_allowed(len(w)):
                cuts = [len(w) * i // (k + 1) for i in range(k + 2)]
                pieces += [f"^.{{{max(0, a - k)},{a + k}}}{re.escape(w[a:b])}" for a, b in zip(cuts, cuts[1:], strict=False)]
        self.piece = re.compile("|".join(pieces) or r"(?!)", re.S).match

    def misspelt(self, word: str) -> str | None:
        """A lexicon word within the edits allowed for it, the first of several, found by running the automaton of ``word`` down the trie."""
        if len(word) > self.reach:
            return None
        found, todo = None, [(self.trie, list(range(len(word) + 1)))]
        while todo:
            node, row = todo.pop()
            if "" in node and row[-1] <= edits_allowed(len(node[""])):
                found = node[""] if found is None else min(found, node[""])
            if min(row) > 2:
                continue
            for c, child in node.items():
                if c:
                    new = [row[0] + 1]
                    for i, d in enumerate(word):
                        new.append(min(new[i] + 1, row[i + 1] + 1, row[i] + (c != d)))
                    todo.append((child, new))
        return found

    def kind(self, word: str) -> int:
        if word in self.words:
            return WORD
        if any(word[:n] in self.stems for n in self.stem_lengths if n < len(word)):
            return STEM
        plain = word.translate(_FIGURES) if not word.isalpha() else word
        if plain != word and plain in self.words:
            return NEAR
        return NEAR if self.piece(plain) and self.misspelt(plain) else NONE


class _Kinds(dict):
    """Kind of hit of a raw word, kept while it fits."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __missing__(self, raw: bytes) -> int:
        text = raw.decode().lower()
        found = [self.lexicon.kind(w) for w in _WORDS.findall(text)]
        if not text.isalpha() and any(c in text for c in "@$!"):  # a sign inside a word
            found.append(self.lexicon.kind(text.strip(".,;:!?\"'()|*#%&").translate(_FIGURES)))
        kind = self[raw] = min((k for k in found if k), default=NONE)
        return kind


FEATURES = ("words", "near", "word_rate", "stem_rate", "near_rate", "quoted_rate")


def features(text: bytes | None, kinds: dict, around: int = 6) -> tuple[list[float], list[tuple[int, int, bool]]]:
    """Values of ``FEATURES`` for a text, and its hits: word index, kind, whether quoted."""
    words = (text or b"").split()
    found = list(map(kinds.__getitem__, words))
    hits = []
    if any(found):
        for i, kind in enumerate(found):
            if kind:
                near = [w.decode() for w in words[max(0, i - around) : i + around + 1]]
                said = any(w.lower().strip(".,;:!?") in SAYING for w in near)
                hits.append((i, kind, said or sum(len(_QUOTES.findall(w)) for w in near) >= 2))
    count = Counter(kind for _, kind, quoted in hits if not quoted)
    rate = lambda n: math.log1p(100 * n / (len(words) + 20))
    return [math.log1p(count[WORD]), math.log1p(count[NEAR]), rate(count[WORD]), rate(count[STEM]), rate(count[NEAR]), rate(len(hits) - sum(count.values()))], hits


def _entries(text: str) -> set[str]:
    """Whole words of a text (with an end mark), and stems of 3 to 7 letters that begin two words or more."""
    words = _WORDS.findall(text.lower())
    stems = Counter(w[:n] for w in words for n in LENGTHS if len(w) > n)
    return {w + "$" for w in words if len(w) > 1} | {s for s, k in stems.items() if k > 1}


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        count: Counter = Counter()
        for t in batch.column(0).to_pylist():
            count.update(_entries(t or ""))
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["entry", "n"])


def _without_hits(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _Kinds(lexicon)
        for batch in batches:
            if len(kinds) > _CACHE:
                kinds.clear()
            texts = batch.column(0).to_pylist()
            yield batch.filter(pa.array([not any(map(kinds.__getitem__, (t or "").encode().split())) for t in texts], pa.bool_()))

    return run


def _grown(lexicon: Lexicon, chosen: dict[str, int]) -> Lexicon:
    """``lexicon`` with chosen entries and the texts they stand in; of stems the shortest."""
    words, stems = set(lexicon.words), set(lexicon.stems)
    for e in sorted(chosen, key=lambda e: (len(e), e)):
        if e.endswith("$"):
            words.add(e[:-1])
        elif not any(e[:n] in stems for n in LENGTHS):
            stems.add(e)
    # a stem which only one kept word explains says no more than the word
    spread = Counter(w[:n] for w in words for n in LENGTHS if len(w) > n)
    stems -= {s for s in stems if spread[s] == 1 and any(w.startswith(s) and chosen.get(w + "$", 0) >= 0.9 * chosen.get(s, math.inf) for w in words)}
    words = {w for w in words if not any(w[:n] in stems for n in LENGTHS)} | set(SEED)
    return Lexicon(frozenset(words), frozenset(stems))


def levels(strongest: float, evidence: tuple[float, ...] = (150.0, 60.0, 20.0)) -> list[float]:
    """Evidence asked for round by round: fourfold steps from the strongest that there is down to the first of ``evidence``, and the rest of it."""
    first = [evidence[0]]
    while first[-1] * 4 <= strongest:
        first.append(first[-1] * 4)
    return [*reversed(first), *evidence[1:]]


def learn_lexicon(sampled: DataFrame, least: int = 3, purity: float = 0.97, toxic_per_clean: int = 8) -> Lexicon:
    """From ``text, label`` (0 or 1): entries of ``least`` toxic texts or more whose odds in toxic texts are ``purity`` or more, and of at most one clean text for each ``toxic_per_clean``, by likelihood ratios against even odds (``levels``).  Copies count once."""
    texts = cut(sampled.select("text", "label").distinct())
    size = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    count = lambda some, name: some.select("text").mapInArrow(trimmed(_count_entries), "entry string, n long").groupBy("entry").agg(F.sum("n").alias(name))
    lexicon, toxic = Lexicon(frozenset(SEED), frozenset()), texts.filter("label = 1").select("text")
    if not n1:
        return lexicon
    clean = cut(count(texts.filter("label = 0"), "clean"))
    share = n1 / (n0 + n1)
    surplus = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.ln(F.col(c) / ((F.col("clean") + F.col("toxic")) * p))).otherwise(0.0)
    ratio = 2 * (surplus("toxic", share) + surplus("clean", max(1 - share, 1e-9)))
    p1, p0 = F.col("toxic") / n1, (F.col("clean") + 0.5) / (n0 + 1)
    rounds = None
    while rounds is None or rounds:
        toxic = cut(toxic.mapInArrow(trimmed(_without_hits(lexicon)), "text string"))
        counts = count(toxic, "toxic").filter(F.col("toxic") >= least).join(clean, "entry", "left").withColumn("clean", F.coalesce("clean", F.lit(0)))
        proved = counts.filter((p1 / (p1 + p0) >= purity) & (F.col("clean") * toxic_per_clean <= F.col("toxic"))).select("entry", "toxic", ratio.alias("ratio"))
        rows = proved.filter(F.col("ratio") >= levels(0)[-1]).collect()  # what ``2 * sample`` texts can prove
        if not rows:
            break
        strongest = max(r["ratio"] for r in rows)
        rounds = [x for x in rounds or levels(strongest) if x <= strongest]
        lexicon = _grown(lexicon, {r["entry"]: r["toxic"] for r in rows if r["ratio"] >= rounds[0]})
        rounds = rounds[1:]
    return lexicon


@dataclass
class Weights:
    values: np.ndarray
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.values + self.bias, -500, 500)))


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 50) -> Weights:
    """Ridge logistic regression by Newton steps; fixed weights if a class is missing."""
    if not (0 < y.sum() < len(y)):
        return Weights(np.array([3.0, 1.0, 2.0, 4.0, 1.0, 0.5]), -3.0)
    a = np.hstack([x, np.ones((len(x), 1))])
    w, keep = np.zeros(a.shape[1]), np.diag([ridge] * x.shape[1] + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + keep, a.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Weights(w[:-1], float(w[-1]))


def _score(lexicon: Lexicon, weights: Weights | None):
    hit = pa.struct([("word", pa.int64()), ("kind", pa.int64()), ("quoted", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _Kinds(lexicon)
        for batch in batches:
            ids, texts = ids_and_bytes(batch)
            rows, hits = [], []
            for t in texts:
                if len(kinds) > _CACHE:
                    kinds.clear()
                row, found = features(t, kinds)
                rows.append(row)
                hits.append([{"word": i, "kind": k, "quoted": q} for i, k, q in found])
            x = np.array(rows, np.float64).reshape(-1, len(FEATURES))
            if weights is None:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(weights.scores(x), pa.float64()), pa.array(hits, pa.list_(hit))], names=["doc_id", "score", "hits"])

    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """``text, label`` of at most ``sample`` rows a class, however often an id stands in ``docs`` or ``labels``.

    First the ``sample`` ids of least hash, then, of the rows they have, those of least hash of id and text; rows equal in id, text and label count once.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter(~held_out(parts=5, part=0)).distinct()
    some = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    met = cut(docs.join(F.broadcast(some[0].unionByName(some[1])), "doc_id").select(F.xxhash64("doc_id", "text").alias("key"), "label", "text"))
    keys = met.select("label", "key").distinct()
    kept = [keys.filter(F.col("label") == k).orderBy("key").limit(sample) for k in (0, 1)]
    rows = met.join(F.broadcast(kept[0].unionByName(kept[1])), ["label", "key"])  # at most 2 * sample keys
    return rows.groupBy("label", "key").agg(F.min("text").alias("text")).select("text", "label")


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = 20_000) -> DataFrame:
    """``doc_id, held_out, score, predicted, hits array<struct<word,kind,quoted>>`` of each row of ``docs``."""
    docs = id_text(docs)
    sampled = cut(labelled_sample(docs, labels, label, sample))
    lexicon = learn_lexicon(sampled)
    rows = sampled.select(F.col("label").cast("long").alias("doc_id"), "text").mapInArrow(trimmed(_score(lexicon, None)), "label long, x array<double>").collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(-1, len(FEATURES))
    weights = fit_weights(x, np.array([r["label"] for r in rows], np.float64))
    out = docs.mapInArrow(trimmed(_score(lexicon, weights)), "doc_id long, score double, hits array<struct<word:long,kind:long,quoted:boolean>>")
    return out.select("doc_id", held_out(parts=5, part=0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "hits")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.withColumn("n_hits", F.size("hits").cast("long")).drop("hits")

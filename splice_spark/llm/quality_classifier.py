"""Quality classifier: regularised quadratic discriminant over document statistics.

One pass computes a row of statistics a document (whole texts, no labels, lang,
source or id); the rows, not the texts, are written to the shared folder and
joined with the labels.  Class means and scatter matrices are Spark aggregates
of fixed size.  Each class covariance is shrunk towards its diagonal and the
pooled covariance, and its Cholesky factor is kept with the model, so a score
is two triangular products: half the difference of squared Mahalanobis lengths
and log-determinants, through a logistic function.

Only labelled rows outside the held-out third (crc32 of doc_id as text, modulo
3, is 1) are learned from.

Nulls and edges: a null text is an empty one; empty texts have a score as all
others; several labels of a doc_id all count; without rows of both classes the
score is the share of class 1 (0.5 without labels).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from .common import cut, give_back, id_text, ids_and_bytes, read_table, small_batches, trimmed

STATS = [
    "word_length", "word_spread", "symbols", "bars", "bangs", "capitals", "digits", "marks",
    "distinct", "top_word", "twice", "dup_lines", "line_words", "packed", "long_words", "other",
]
_UPPER, _DIGIT = bytes(range(65, 91)), b"0123456789"
_OTHER = bytes(set(range(32)) - set(b"\t\n\r")) + b"\"'()[]{}=+-_/\\@^~`"


def _share(part: float, whole: float, usual: float, weight: float) -> float:
    """Logarithm of a share, drawn to ``usual`` as by ``weight`` more cases, so that short texts are no outliers."""
    return math.log((part + usual * weight) / (whole + weight))


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of one text: logarithms of damped shares and means."""
    t = text or b""
    words = t.split()
    n, m = len(t), len(words)
    drop = lambda chars: n - len(t.translate(None, chars))
    lens = np.fromiter(map(len, words), np.float64, m)
    counts = Counter(words)
    lines = [x for x in t.split(b"\n") if x.strip()]
    packed = len(zstandard.ZstdCompressor(level=1).compress(t))
    return [
        _share(lens.sum(), m, 6, 30),
        _share((lens**2).sum(), m, 50, 30),
        _share(drop(b"#$%&*<>"), n, 0.002, 300),
        _share(drop(b"|"), n, 0.002, 300),
        _share(drop(b"!?"), n, 0.002, 300),
        _share(drop(_UPPER), n, 0.02, 300),
        _share(drop(_DIGIT), n, 0.005, 300),
        _share(drop(b".,;:"), n, 0.02, 300),
        _share(len(counts), m, 0.8, 50) + 0.1 * math.log(m + 50),
        _share(max(counts.values(), default=0), m, 0.03, 50),
        _share(sum(a == b for a, b in zip(words, words[1:], strict=False)), m, 0.01, 50),
        _share(len(lines) - len(set(lines)), len(lines), 0.02, 10),
        _share(m, len(lines), 20, 3),
        _share(packed, n, 0.5, 300),
        _share(int((lens > 25).sum()), m, 0.01, 50),
        _share(drop(_OTHER), n, 0.005, 300),
    ]


def _all_statistics(texts: list) -> pa.Array:
    rows = np.array([statistics(t) for t in texts], np.float64).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * len(STATS), pa.int32()), pa.array(rows, pa.float64()))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = ids_and_bytes(batch)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _all_statistics(texts)], names=["doc_id", "stats"])


def stats_of(texts: pa.Array) -> pa.Array:
    """The statistics of a text column."""
    out = _all_statistics(texts.cast(pa.binary()).to_pylist())
    give_back()
    return out


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, stats array<double>`` (in the order of ``STATS``) of each row; no shuffle."""
    return id_text(docs).mapInArrow(trimmed(_measure), "doc_id long, stats array<double>")


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log-determinants of classes 0 and 1, and the log prior odds."""

    means: list
    factors: list
    logdets: list
    log_odds: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), 1 / (1 + math.exp(-self.log_odds)))
        near = [((x - m) @ f.T) for m, f in zip(self.means, self.factors, strict=True)]
        d = self.log_odds + 0.5 * ((near[0] ** 2).sum(1) - (near[1] ** 2).sum(1) + self.logdets[0] - self.logdets[1])
        return 1 / (1 + np.exp(-np.clip(d, -500, 500)))


def fit(labelled: DataFrame, shrink: float = 0.05, pool: float = 0.05, floor: float = 1e-3) -> Discriminant:
    """From ``stats, label``: per class a count, sums and a scatter matrix, all aggregated by Spark."""
    d = len(STATS)
    sums = labelled.filter("label in (0, 1) and stats is not null").groupBy("label").agg(
        F.count("*").alias("n"),
        *[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(d)],
        *[F.sum(F.col("stats")[i] * F.col("stats")[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)],
    )
    rows = {r["label"]: r for r in sums.collect()}  # two rows
    n = {k: rows[k]["n"] if k in rows else 0 for k in (0, 1)}
    odds = math.log((n[1] + 0.5) / (n[0] + 0.5))
    if min(n.values()) < 2:
        return Discriminant([], [], [], odds)
    means, scatter = [], []
    for k in (0, 1):
        m = np.array([rows[k][f"s{i}"] for i in range(d)]) / n[k]
        s = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                s[i, j] = s[j, i] = rows[k][f"p{i}_{j}"] / n[k] - m[i] * m[j]
        means.append(m)
        scatter.append(s)
    pooled = (n[0] * scatter[0] + n[1] * scatter[1]) / (n[0] + n[1])
    factors, logdets = [], []
    for k in (0, 1):
        a = shrink + (1 - shrink) * d / (d + n[k])  # few rows, more shrinkage
        s = (1 - a - pool) * scatter[k] + a * np.diag(np.diag(scatter[k])) + pool * pooled if a + pool < 1 else np.diag(np.diag(scatter[k])) + pool * pooled
        s += floor * np.eye(d)
        low = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(low))
        logdets.append(2 * float(np.log(np.diag(low)).sum()))
    return Discriminant(means, factors, logdets, odds)


def held_out(key: str = "doc_id", parts: int = 3, part: int = 1) -> F.Column:
    """Whether crc32 of the id as text leaves ``part``; a null id is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == part, F.lit(True))


def train(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """A model from the ``doc_id, stats`` of labelled rows that aren't held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter(~held_out())
    return fit(stats.join(known, "doc_id"))


def scorer(model: Discriminant):
    """A vectorised function of the ``stats`` column to the score."""

    @pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(x.tolist(), np.float64).reshape(-1, len(STATS))))

    return score


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``."""
    stats = cut(measure(docs))
    score = scorer(train(stats, labels, label))
    out = stats.select("doc_id", held_out().alias("held_out"), score("stats").alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


#: A name that no caller's column has.
_STATS = "__quality_stats__"


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all their columns, whose score is 0.5 or more.

    Rows and their statistics are written once; both the model and the choice read them there.
    """
    small_batches(docs.sparkSession)
    measured = cut(docs.withColumn(_STATS, F.arrow_udf(stats_of, "array<double>")(F.col(text_col).cast("string"))))
    score = scorer(train(measured.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(_STATS).alias("stats")), labels, label))
    return measured.filter(score(F.col(_STATS)) >= 0.5).drop(_STATS)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))

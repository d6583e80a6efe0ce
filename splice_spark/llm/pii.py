"""Personal data by weak supervision.

Base rules find e-mail addresses, IP addresses, card numbers and phone numbers
exactly; they always stay.  Looser patterns find further candidates.  Five
labelers (strict pattern, structure, gazetteer, context words, shape) vote yes,
no or nothing on every candidate.  Expectation-maximisation over the counts of
vote patterns estimates each labeler's reliability by kind, and its posteriors
train the final span classifier, a ridge logistic regression over votes, shapes
and the word before the span (one of 32 hashes), which no labeler's list needs
to hold.  It adds the candidates it is sure of.

One pass over the texts makes a small row of candidates a document; patterns
are counted by Spark (a table of at most 4 kinds x 3^5 votes x 8 shapes x 32
words, which bounds what comes to the driver), and the verdicts are a narrow
second step.  Counts enter the regression as shares of all candidates, so the
ridge weighs alike at every size.

Nulls and edges: a null text is an empty one; each row gives a row, an empty
table none; positions are code points, ends exclusive; an added span never
touches a base span.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, give_back, id_text, read_table, small_batches, trimmed

KINDS = ("email", "ip", "card", "phone")
#: Base patterns (fixed values).
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: The same matches in linear time: a run is taken whole, and counts if the rest of the pattern follows it.
#: (A start inside a run has the same rest, so it can't succeed where the whole run fails.)
_BY_RUN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?"),
    "ip": re.compile(r"[0-9]++((?:\.[0-9]+){3})?"),
}
_AT_SIGN = re.compile(r"[\[(](?:at|AT)[\])]")
_LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]++( ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]+(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]+)+)?"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?\[\.\] ?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9A-Za-z])(?=((?:[0-9]{4}(?:[ ./_-]{1,3}[0-9]{4}){3}|[0-9]{13,19})(?![0-9A-Za-z])))"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])(?=((?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|00[1-9][0-9 ]{8,14}[0-9]|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])))"),
}
#: Gazetteers (fixed values): generic top-level domains, beside which any two letters are a country's; dialling codes of two
#: digits, beginnings of those of three (and 1 and 7); first digits of card issuers.
_DOMAINS = frozenset("com org net edu gov mil int info biz name pro io dev app online site cloud tech shop blog test example invalid".split())
_TWO_DIGITS = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_OF_THREE = frozenset("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split())
_ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "60", "62", "65")
_NEAR = {
    "email": "email e-mail mail contact write correo courriel".split(),
    "ip": "ip host server address adresse".split(),
    "card": "card visa mastercard amex credit payment karte carte tarjeta".split(),
    "phone": "tel phone call fax mobile cell telefon téléphone teléfono".split(),
}
_AGAINST = "version release build serial order invoice token id isbn page chapter".split()
YES, NO, NONE = "y", "n", "-"
#: Hashes of the word before a span.
WORDS = 32


def luhn(digits: str) -> bool:
    return (sum(map(int, digits[-1::-2])) + sum(int("0246813579"[int(c)]) for c in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _dialling(digits: str) -> bool:
    return digits[:1] in ("1", "7") or digits[:2] in _TWO_DIGITS or (len(digits) > 2 and digits[:2] in _OF_THREE)


def base_holds(kind: str, found: str) -> bool:
    """The check that a match of the base pattern must pass."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind == "card":
        digits = _digits(found)
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(_digits(found)) <= 15


def base_spans(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of the base pattern that pass its check; failing ones are not tried again."""
    if kind in _BY_RUN:
        found = (m for m in _BY_RUN[kind].finditer(text) if m[1])
    else:
        found = BASE[kind].finditer(text)
    return (m.span() for m in found if base_holds(kind, m[0]))


class _Taken:
    """Stretches of a text that spans cover, disjoint and in order."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def take(self, start: int, end: int) -> bool:
        """Cover the span if it touches no other."""
        k = bisect_right(self.ends, start)
        if k < len(self.starts) and self.starts[k] < end:
            return False
        self.starts.insert(k, start)
        self.ends.insert(k, end)
        return True


def votes(kind: str, found: str, base: bool, text: str, start: int, end: int) -> str:
    """One letter a labeler: strict pattern, structure, gazetteer, context, shape."""
    digits = _digits(found)
    before = text[max(0, start - 40) : start].lower().split()[-5:]
    around = [w.strip(".,;:()=\"'") for w in before + text[end : end + 25].lower().split()[:2]]
    strict = YES if base else NONE
    if kind == "email":
        tail = re.split(r"[^A-Za-z]+", found.lower())[-1]
        structure = YES if tail.isalpha() and len(tail) > 1 else NO
        gazetteer = YES if tail in _DOMAINS or len(tail) == 2 else NONE
        shape = YES if len(found) <= 60 else NO
    elif kind == "ip":
        parts = [int(p) for p in re.findall("[0-9]{1,9}", found)]
        structure = YES if max(parts) <= 255 else NO
        gazetteer = NO if parts[0] in (0, 255) or parts == [1, 0, 0, 0] else NONE
        shape = YES if sum(p > 9 for p in parts) > 2 else NONE if sum(p > 9 for p in parts) else NO
    elif kind == "card":
        structure = YES if 13 <= len(digits) <= 19 and luhn(digits) else NO
        gazetteer = YES if digits.startswith(_ISSUERS) else NONE
        shape = YES if len(digits) in (15, 16) else NO
    else:
        structure = YES if 9 <= len(digits) <= 15 else NO
        gazetteer = (YES if _dialling(digits) else NO) if found.startswith("+") else NONE
        shape = YES if re.search(r"[0-9][ ).-]", found) else NO
    context = YES if any(w in _NEAR[kind] for w in around) else NO if any(w in _AGAINST for w in around) else NONE
    return strict + structure + gazetteer + context + shape


def candidates(text: str) -> list[dict]:
    """Base spans, and loose ones that touch none of them, with votes, a shape from 0 to 7, and the hash of the word before."""
    spans = []
    asked = {"email": "@" in text, "phone": "+" in text, "ip": True, "card": True}
    for k, kind in enumerate(KINDS):
        if asked[kind]:
            spans += [(k, s, e, True) for s, e in base_spans(kind, text)]
    taken = _Taken((s, e) for _, s, e, _ in spans)
    for k, kind in enumerate(KINDS):
        if kind == "email":
            loose = [m.span() for m in _LOOSE[kind].finditer(text) if m[1]] if _AT_SIGN.search(text) else []
        else:  # starts may overlap; what the structure confirms comes first
            loose = [m.span(m.lastindex or 0) for m in _LOOSE[kind].finditer(text)]
        for s, e in sorted(loose, key=lambda x: (kind == "card" and not luhn(_digits(text[x[0] : x[1]])), x)):
            if taken.take(s, e):
                spans.append((k, s, e, False))
    out = []
    for k, s, e, base in sorted(spans):
        left, right = text[s - 1 : s] if s else "", text[e : e + 1]
        shape = 4 * left.isalnum() + 2 * right.isalnum() + ("\n" in text[max(0, s - 1) : e + 1])
        before = text[max(0, s - 40) : s].lower().split()[-1:]
        word = zlib.crc32(before[0].strip(".,;:()=\"'").encode()) % WORDS if before else 0
        out.append({"kind": k, "start": s, "end": e, "base": base, "votes": votes(KINDS[k], text[s:e], base, text, s, e), "shape": int(shape), "word": word})
    return out


_CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.string()), ("shape", pa.int32()), ("word", pa.int32())])
_FOUND_TYPE = "array<struct<kind:int,start:long,end:long,base:boolean,votes:string,shape:int,word:int>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [candidates(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(_CANDIDATE))], names=["doc_id", "found"])


def find_candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, found array<struct<kind,start,end,base,votes,shape,word>>`` of each row; no shuffle."""
    return id_text(docs).mapInArrow(trimmed(_find), f"doc_id long, found {_FOUND_TYPE}")


@dataclass
class SpanModel:
    """Reliabilities (kind, labeler, class, vote) of the label model, and the weights of the span classifier."""

    reliability: np.ndarray
    weights: np.ndarray

    def probability(self, kind: int, votes: str, shape: int, word: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(_inputs(kind, votes, shape, word) @ self.weights, -50, 50))))


def _inputs(kind: int, votes: str, shape: int, word: int) -> np.ndarray:
    """One-hot kind, signed votes by kind, shape bits, and the one-hot word before."""
    x = np.zeros(4 + 20 + 3 + WORDS)
    x[kind] = 1
    x[4 + 5 * kind : 9 + 5 * kind] = [{YES: 1, NO: -1, NONE: 0}[v] for v in votes]
    x[24:27] = [shape >> 2 & 1, shape >> 1 & 1, shape & 1]
    x[27 + word] = 1
    return x


#: What the label model starts from, and how many candidates that counts for: shares of yes, no and none of a labeler for class 0 and 1.
_START = np.array([[0.1, 0.5, 0.4], [0.6, 0.1, 0.3]])
_STRENGTH = 5


def label_model(votes: list[str], n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for one kind: (labeler, class, vote) shares, and the posterior of each vote pattern, of which there are ``n``."""
    like, prior, post = np.tile(_START, (5, 1, 1)), 0.5, np.zeros(len(votes))
    v = np.array([["yn-".index(c) for c in p] for p in votes], int).reshape(-1, 5)
    for _ in range(rounds if len(votes) else 0):
        logs = [np.log(like[np.arange(5), c, v]).sum(1) + np.log(prior if c else 1 - prior) for c in (0, 1)]
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        prior = float(np.clip((n * post).sum() / n.sum(), 0.02, 0.98))
        for c, w in ((0, n * (1 - post)), (1, n * post)):
            for j in range(5):
                got = np.bincount(v[:, j], weights=w, minlength=3) + _STRENGTH * _START[c]
                like[j, c] = got / got.sum()
    return like, post


def fit(patterns: list[tuple[int, str, int, int, int]], ridge: float = 1e-4) -> SpanModel:
    """From counts of (kind, votes, shape, word): EM for the labelers' reliabilities, then ridge logistic regression on the posteriors.

    ``ridge`` is relative to all candidates, whose shares are the weights.
    """
    reliability, x, q, n = np.zeros((4, 5, 2, 3)), [], [], []
    for kind in range(4):
        rows = [p for p in patterns if p[0] == kind]
        reliability[kind], post = label_model([p[1] for p in rows], np.array([p[4] for p in rows], float))
        x += [_inputs(*p[:4]) for p in rows]
        q += post.tolist()
        n += [p[4] for p in rows]
    weights = np.zeros(27 + WORDS)
    if x:
        x, q, n = np.array(x), np.array(q), np.array(n, float) / sum(n)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights)), x.T @ (n * (q - p)) - ridge * weights)
            weights += step
            if np.abs(step).max() < 1e-7:
                break
    return SpanModel(reliability, weights)


def train(found: DataFrame, column: str = "found", sure: float = 0.9) -> frozenset[str]:
    """Kinds of candidates (kind, votes, shape, word) that the span classifier, trained on ``found``, is ``sure`` of."""
    key = ["kind", "votes", "shape", "word"]
    counts = found.select(F.explode(column).alias("c")).groupBy(*[f"c.{k}" for k in key]).agg(F.count("*").alias("n"))
    patterns = sorted(tuple(r[k] for k in (*key, "n")) for r in counts.collect())  # bounded: see above
    model = fit(patterns)
    return frozenset(f"{k}{v}{s}.{w}" for k, v, s, w, _ in patterns if model.probability(k, v, s, w) >= sure)


def accepted(found: F.Column, yes: frozenset[str]) -> F.Column:
    """The base spans of a document's candidates, and those whose kind is among ``yes``."""
    sure = F.array(*map(F.lit, sorted(yes))).cast("array<string>")
    key = lambda c: F.concat(c["kind"].cast("string"), c["votes"], c["shape"].cast("string"), F.lit("."), c["word"].cast("string"))
    return F.filter(found, lambda c: c["base"] | F.array_contains(sure, key(c)))


def find_personal(docs: DataFrame, sure: float = 0.9) -> DataFrame:
    """``doc_id, spans array<struct<kind,start,end,base,votes,shape,word>>`` of each row, by kind, then start."""
    found = cut(find_candidates(docs))
    return found.select("doc_id", accepted(F.col("found"), train(found, sure=sure)).alias("spans"))


def candidates_of(texts: pa.Array) -> pa.Array:
    """The candidates of a text column."""
    out = pa.array([candidates(t or "") for t in texts.to_pylist()], pa.list_(_CANDIDATE))
    give_back()
    return out


def cleaned(text: str | None, spans: list[dict]) -> str | None:
    """``text`` with spans replaced by their kinds; overlapping ones by that of the first."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for c in sorted(spans, key=lambda c: (c["start"], -c["end"])):
        if c["start"] >= at:
            out += [text[at : c["start"]], f"[{KINDS[c['kind']].upper()}]"]
        at = max(at, c["end"])
    return "".join([*out, text[at:]])


def _clean(texts: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array(map(cleaned, texts.to_pylist(), spans.to_pylist()), pa.string())


#: A name that no caller's column has.
_FOUND = "__personal_data__"


def redact(docs: DataFrame, sure: float = 0.9, text_col: str = "text") -> DataFrame:
    """``docs`` with each span in ``text_col`` replaced by its kind in brackets; overlapping spans by the first one's. Other columns stay.

    Rows and their candidates are written once; both the model and the replacement read them there.
    """
    small_batches(docs.sparkSession)
    found = cut(docs.withColumn(_FOUND, F.arrow_udf(candidates_of, _FOUND_TYPE)(F.col(text_col).cast("string"))))
    return found.withColumn(text_col, F.arrow_udf(_clean, "string")(F.col(text_col), accepted(F.col(_FOUND), train(found, _FOUND, sure)))).drop(_FOUND)


def _shown(spans: F.Column) -> F.Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.element_at(names, c["kind"] + 1), c["start"].cast("string"), c["end"].cast("string"))), ",")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_personal(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda c: c["base"])
    of = lambda k: lambda c: c["kind"] == k
    counts = [F.size(F.filter(base, of(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(_shown(base), 256).alias("base_sha256"), _shown(F.col("spans")).alias("spans"))

"""CIGAR strings as expressions: arrays of (length, operation) and sums over them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def steps(cigar: Column) -> Column:
    """``array<struct<n, op>>`` of a CIGAR; empty for null."""
    one = F.transform(F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(r"(\d+[A-Z])"), 1), lambda t: F.struct(F.regexp_replace(t, "[A-Z]", "").cast("long").alias("n"), F.substring(t, -1, 1).alias("op")))
    return one


def total(parts: Column, ops: str) -> Column:
    """Sum of the lengths of the operations in ``ops``."""
    return F.aggregate(F.filter(parts, lambda s: s["op"].isin(*ops)), F.lit(0).cast("long"), lambda a, s: a + s["n"])


def split_at(parts: Column) -> Column:
    """1-based place of the largest N, the first of equal ones; 0 if there is none."""
    largest = F.array_max(F.transform(F.filter(parts, lambda s: s["op"] == "N"), lambda s: s["n"]))
    return F.coalesce(F.array_position(F.transform(parts, lambda s: F.struct(s["n"], s["op"])), F.struct(largest.alias("n"), F.lit("N").alias("op"))), F.lit(0).cast("long"))


def cigar_ref_span(cigar: Column) -> Column:
    """Bases of the reference that the alignment spans."""
    return total(steps(cigar), "MND")


def cigar_counts(cigar: Column) -> Column:
    """``struct<M, S, I, D>`` of total lengths; null for null."""
    return F.when(cigar.isNotNull(), F.struct(*[total(steps(cigar), op).alias(op) for op in "MSID"]))


def cigar_junction(pos: Column, cigar: Column) -> Column:
    """``struct<posA, posB>``: the bases beside the largest N; null without N or without an M after it."""
    parts = steps(cigar)
    k = split_at(parts)
    before, after = F.slice(parts, F.lit(1), F.greatest(k - 1, F.lit(0))), F.slice(parts, k + 1, F.size(parts))
    left = pos + total(before, "MND")
    # operations until the next M, found by the place of the first M
    m = F.array_position(F.transform(after, lambda s: s["op"]), F.lit("M"))
    gap = total(F.slice(after, F.lit(1), F.greatest(m - 1, F.lit(0))), "ND")
    n = F.try_element_at(parts, F.greatest(k, F.lit(1)).cast("int"))["n"]
    return F.when((k > 0) & (m > 0), F.struct((left - 1).alias("posA"), (left + n + gap).alias("posB")))


def _text(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda s: F.concat(s["n"].cast("string"), s["op"])), "")


def split_cigar_align(cigar: Column) -> Column:
    """``struct<first, second>`` of the parts around the largest N; all of it, and null, without N."""
    parts = steps(cigar)
    k = split_at(parts)
    first = F.when(k == 0, cigar).otherwise(_text(F.slice(parts, F.lit(1), F.greatest(k - 1, F.lit(0)))))
    return F.struct(first.alias("first"), F.when(k > 0, _text(F.slice(parts, k + 1, F.size(parts)))).alias("second"))


def split_cigar_chim(cigar: Column) -> Column:
    """A chimeric CIGAR without its clipped end, the longer one of two (the last of equal ones); null without clips."""
    parts = steps(cigar)
    first, last = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(-1))
    a, b = first["op"].isin("S", "H"), last["op"].isin("S", "H")
    without_first, without_last = F.slice(parts, F.lit(2), F.size(parts)), F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.when(a & (~b | (first["n"] > last["n"])), _text(without_first)).when(b, _text(without_last))


def kmer_entropy(seq: Column, c: int = 5) -> Column:
    """Shannon entropy (natural logarithm) of the sequence's c-mers; 0 if it is shorter.

    The c-mers are sorted and their runs counted: ln n less the mean of ln(copies).
    """
    n = F.length(seq) - c + 1
    mers = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(seq, i, F.lit(c)))).otherwise(F.array().cast("array<string>"))
    part = lambda k: k * F.ln(F.greatest(k, F.lit(1.0)))
    state = lambda mer, run, done: F.struct(mer.alias("mer"), run.alias("run"), done.alias("done"))
    runs = F.aggregate(
        F.sort_array(mers),
        state(F.lit(""), F.lit(0.0), F.lit(0.0)),
        lambda s, m: F.when(m == s["mer"], state(m, s["run"] + 1, s["done"])).otherwise(state(m, F.lit(1.0), s["done"] + part(s["run"]))),
    )
    return F.when(n > 0, F.ln(n) - (runs["done"] + part(runs["run"])) / n).otherwise(0.0)


def longest_runs(seq: Column) -> Column:
    """``struct<A, T, C, G, N>``: the longest run of each base."""
    runs = [F.coalesce(F.array_max(F.transform(F.regexp_extract_all(seq, F.lit(f"({b}+)"), 1), F.length)), F.lit(0)).cast("long").alias(b) for b in "ATCGN"]
    return F.struct(*runs)


def mismatch_count(md: Column) -> Column:
    """A, C, G and T letters of an MD tag."""
    return F.length(F.regexp_replace(md, "[^ACGT]", "")).cast("long")

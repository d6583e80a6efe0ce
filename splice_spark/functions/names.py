"""Junction names ``chr:gene:pos:strand|chr:gene:pos:strand|type`` as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHROMOSOME, GENE, POSITION, STRAND = range(4)


def name_part(name: str | Column, end: int, part: int) -> Column:
    """A field of the first (0) or second (1) end of a name; null if it isn't there."""
    col = F.col(name) if isinstance(name, str) else name
    return F.try_element_at(F.split(F.try_element_at(F.split(col, r"\|"), F.lit(end + 1)), ":"), F.lit(part + 1))


def make_name(chr_a: Column, gene_a: Column, pos_a: Column, strand_a: Column, chr_b: Column, gene_b: Column, pos_b: Column, strand_b: Column, kind: Column | None = None) -> Column:
    """The name of two ends, with a type if given; null if any part is."""
    ends = [F.concat(c, F.lit(":"), g, F.lit(":"), p.cast("string"), F.lit(":"), s) for c, g, p, s in ((chr_a, gene_a, pos_a, strand_a), (chr_b, gene_b, pos_b, strand_b))]
    return F.concat(ends[0], F.lit("|"), ends[1], *([F.lit("|"), kind] if kind is not None else []))

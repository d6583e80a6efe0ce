"""The BAM source against SAM text, at all sizes of parts, and on damaged files."""

import random
import struct

import pytest

from splice_spark.sources import bam, tables

COLUMNS = [c.split()[0] for c in bam.SCHEMA.split(", ")[:-1]]
TYPES = ", ".join(bam.SCHEMA.split(", ")[:-1])


def records(n=3000):
    rng = random.Random(4)
    out = []
    for k in range(n):
        bases = rng.choice([0, 1, 50, 151, 3000]) if k % 200 == 0 else rng.randrange(1, 160)
        cigar = None if k % 17 == 0 else "".join(f"{rng.randrange(1, 5000)}{op}" for op in rng.sample("MIDNSHP=X", rng.randrange(1, 9)))
        tag = lambda x, m: x if k % m else None
        out.append((f"read:{k}", rng.randrange(4096), None if k % 29 == 0 else rng.choice(["1", "chrX", "3"]), 0 if k % 29 == 0 else rng.randrange(1, 1 << 28), cigar, "".join(rng.choice("ACGTN") for _ in range(bases)) or None,
                    tag(f"BC{k}-1", 5), tag("ACGT", 3), tag("TT", 7), tag("x", 4), tag("m", 6), tag("1", 2), tag("10A5^AC6", 8), tag(rng.randrange(-5, 300), 9)))
    return out


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bam")
    rows = records()
    frame = spark.createDataFrame(rows, TYPES)
    bam.write_bam(frame.repartition(2), str(folder / "b"), [("1", 1 << 29), ("chrX", 1 << 29), ("3", 1 << 29)])
    names = {"cb": "CB:Z", "ub": "UB:Z", "ur": "UR:Z", "xc": "XC:Z", "xm": "XM:Z", "ch": "ch:Z", "md": "MD:Z", "as_score": "AS:i"}
    with open(folder / "s.sam", "w") as out:
        out.write("@HD\tVN:1.6\n")
        for r in rows:
            row = dict(zip(COLUMNS, r, strict=True))
            tags = [f"{t}:{row[c]}" for c, t in names.items() if row[c] is not None]
            out.write("\t".join([row["qname"], str(row["flag"]), row["rname"] or "*", str(row["pos"]), "255", row["cigar"] or "*", "*", "0", "0", row["seq"] or "*", "*", *tags]) + "\n")
    return folder, rows


@pytest.mark.parametrize("split", [15_000, 30_000, 1 << 26])
def test_parts_have_all_records_once(spark, written, split):
    folder, rows = written
    frame = bam.read_bam(spark, str(folder / "b"), split_bytes=split)
    assert sorted(map(str, frame.select(*COLUMNS).collect())) == sorted(str(r) for r in spark.createDataFrame(rows, TYPES).collect())
    parts = [p for path, size in bam.files_of(str(folder / "b")) for p in bam.plan(path, size, split)]
    assert len(parts) > 2 or split > 1 << 20
    assert {p.path for p in parts} == {r.path for r in frame.select("path").distinct().collect()}


def test_rows_are_those_of_sam_text(spark, written):
    folder, _ = written
    one, two = tables.read_alignments(spark, str(folder / "s.sam")), tables.read_alignments(spark, *[p for p, _ in bam.files_of(str(folder / "b"))])
    assert set(one.columns) == set(two.columns)
    order = sorted(one.columns)
    assert sorted(map(str, one.select(*order).collect())) == sorted(map(str, two.select(*order).collect()))
    sheet = spark.createDataFrame([("x", 1, str(folder / "s.sam")), ("y", 1, bam.files_of(str(folder / "b"))[0][0])], "sample_id string, mate int, path string")
    with pytest.raises(ValueError, match="one kind"):
        tables.read_samples(spark, sheet)


def test_every_kind_of_tag():
    tags = b"XAAq" + b"Xcc" + struct.pack("<b", -3) + b"XCC\xfa" + b"Xss" + struct.pack("<h", -300) + b"XSS" + struct.pack("<H", 60_000) + b"Xii" + struct.pack("<i", -70_000)
    tags += b"XII" + struct.pack("<I", 4_000_000_000) + b"Xff" + struct.pack("<f", 0.5) + b"XHH1AE3\0" + b"XBBs" + struct.pack("<i2h", 2, -1, 5) + b"CBZbar code\0"
    assert bam._tags(tags, 0) == {"XA": "q", "Xc": "-3", "XC": "250", "Xs": "-300", "XS": "60000", "Xi": "-70000", "XI": "4000000000", "Xf": "0.5", "XH": "1AE3", "XB": (-1, 5), "CB": "bar code"}


def test_cigars_of_many_operations():
    row = dict.fromkeys(COLUMNS) | {"qname": "q", "flag": 0, "rname": "1", "pos": 5, "cigar": "1M1N" * 40_000, "seq": "ACG", "as_score": -4}
    got = dict(zip(COLUMNS, bam.decode(bam.encode(row, {"1": 0})[4:], ["1"]), strict=True))
    assert got == row


def test_damaged_files_are_refused(spark, written, tmp_path):
    folder, _ = written
    whole = open(bam.files_of(str(folder / "b"))[0][0], "rb").read()
    (tmp_path / "cut.bam").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "text.bam").write_bytes(b"@HD\tVN:1.6\n" * 10)
    for name in ("cut.bam", "text.bam"):
        with pytest.raises(Exception):  # noqa: B017
            bam.read_bam(spark, str(tmp_path / name)).count()
    with pytest.raises(Exception):  # noqa: B017
        bam.read_bam(spark, str(tmp_path / "none.bam")).count()


def test_a_wrong_start_is_an_error(spark, written):
    """A part that doesn't end where the next begins gives no rows but an error."""
    path, size = bam.files_of(str(written[0] / "b"))[0]
    first, *_ = bam.plan(path, size, 15_000)
    block, at = first.end
    wrong = bam.Part(path, size, first.references, first.start, (block, at + 3))
    with pytest.raises(ValueError, match="not at"):
        list(bam.BamReader([path], 1 << 16).read(wrong))

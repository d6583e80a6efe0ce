"""BAM files as a Spark data source, decoded from the public format.

A BAM file is a row of BGZF blocks, small gzip members whose header has their
size.  A file is cut at about every ``split_bytes``; the planner looks for the
first block from there on and for the first record in it, which nothing marks:
a place is taken if it and the records that follow it make sense as far as the
bytes read reach.  Each part begins at such a place and has to end exactly where
the next one begins, so a wrong guess is an error and never a lost or repeated
record.

Rows are those of SAM text (``tables.read_alignments``): positions from 1,
``*`` as null, and the tags that the library uses as columns; ``path`` is the
file.  Files are opened through Arrow's file systems, on the driver for the
planning and on executors for the records.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Columns from tags, as the format names them.
TAGS = {"cb": "CB", "ub": "UB", "ur": "UR", "xc": "XC", "xm": "XM", "ch": "ch", "md": "MD", "as_score": "AS"}
SCHEMA = "qname string, flag int, rname string, pos long, cigar string, seq string, cb string, ub string, ur string, xc string, xm string, ch string, md string, as_score int, path string"
SPLIT_BYTES = 64 << 20
_ROWS = 4096

# Fixed by the format: CIGAR operations, base codes, sizes of tag values.
_OPS = "MIDNSHP=X"
_BASES = "=ACMGRSVTWYHKDBN"
_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_CODES = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
_PAIRS = [_BASES[b >> 4] + _BASES[b & 15] for b in range(256)]
#: The empty block that ends a file.
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def _open(path: str) -> pa.NativeFile:
    system, inside = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system.open_input_file(inside)


def files_of(path: str) -> list[tuple[str, int]]:
    """Files and sizes: ``path`` itself, or the ``.bam`` files of a folder."""
    uri = "://" in path or path.startswith("file:")
    system, inside = fs.FileSystem.from_uri(path) if uri else (fs.LocalFileSystem(), path)
    found = system.get_file_info(inside)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    many = [found] if found.is_file else sorted(system.get_file_info(fs.FileSelector(inside)), key=lambda f: f.path)
    scheme = path[: path.index(inside)] if uri and inside in path else ""
    return [(scheme + f.path, f.size) for f in many if f.is_file and f.path.endswith(".bam")]


def block_size(head: bytes) -> int | None:
    """Bytes of the BGZF block that begins here, or None if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return None
    extra, at = struct.unpack_from("<H", head, 10)[0], 12
    while at + 4 <= min(12 + extra, len(head)):
        name, n = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"BC" and n == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + n
    return None


class Blocks:
    """The blocks of a file from an offset on, one after the other; ``place`` of a byte is its block's offset and where it is in it."""

    def __init__(self, file: pa.NativeFile, start: int, size: int):
        self.file, self.next, self.size = file, start, size
        self.data, self.at, self.starts = b"", 0, []

    def more(self) -> bool:
        """Append the next block's bytes; False at the end of the file."""
        while self.next < self.size:
            head = self.file.read_at(min(65_536, self.size - self.next), self.next)
            n = block_size(head)
            if n is None or n > len(head):
                raise ValueError(f"no whole BGZF block at byte {self.next}")
            inflater = zlib.decompressobj(31)
            got = inflater.decompress(head[:n])
            if not inflater.eof:
                raise ValueError(f"the BGZF block at byte {self.next} is damaged")
            self.next, here = self.next + n, self.next
            if got:
                self.starts.append((len(self.data), here))
                self.data += got
                return True
        return False

    def take(self, n: int) -> bytes | None:
        """The next ``n`` bytes, or None if there are no more at all."""
        while len(self.data) - self.at < n:
            if not self.more():
                if len(self.data) == self.at:
                    return None
                raise ValueError("the file ends inside a record")
        self.at += n
        return self.data[self.at - n : self.at]

    def place(self) -> tuple[int, int]:
        """Where the next byte is; the end of a block is the beginning of the next one."""
        if self.at == len(self.data) and not self.more():
            return self.size, 0
        first, block = next(x for x in reversed(self.starts) if x[0] <= self.at)
        return block, self.at - first

    def forget(self) -> None:
        """Drop what has been taken, but the block that the next byte is in."""
        while len(self.starts) > 1 and self.starts[1][0] <= self.at:
            self.starts.pop(0)
        if drop := self.starts[0][0] if self.starts else 0:
            self.data, self.at, self.starts = self.data[drop:], self.at - drop, [(a - drop, b) for a, b in self.starts]


def read_header(blocks: Blocks) -> list[str]:
    """Names of the reference sequences; the blocks then stand at the first record."""
    if blocks.take(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    blocks.take(struct.unpack("<i", blocks.take(4))[0])
    names = []
    for _ in range(struct.unpack("<i", blocks.take(4))[0]):
        n = struct.unpack("<i", blocks.take(4))[0]
        names.append(blocks.take(n)[:-1].decode())
        blocks.take(4)
    return names


def plausible(data: bytes, at: int, references: int) -> int | None:
    """Where the record that may begin at ``at`` ends, or None if none does; a record whose end is beyond ``data`` may."""
    if at + 36 > len(data):
        return len(data)
    size, ref, pos, name, _, _, ops, flag, bases, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if not (-1 <= ref < references and -1 <= mate < references and pos >= -1 and mate_pos >= -1 and name > 1 and bases >= 0 and flag < 4096):
        return None
    if size < 32 + name + 4 * ops + (bases + 1) // 2 + bases or size > 1 << 28:
        return None
    text = data[at + 36 : at + 36 + name]
    if len(text) == name and (text[-1] != 0 or not all(33 <= c <= 126 for c in text[:-1])):
        return None
    codes = data[at + 36 + name : at + 36 + name + 4 * ops]
    if any(c & 15 > 8 for c in codes[::4]):
        return None
    return at + 4 + size


def first_record(blocks: Blocks, references: int, enough: int = 3 << 16) -> int | None:
    """Where in the blocks read on from here the first record begins: the first place from which records follow each other to the end of ``enough`` bytes."""
    while len(blocks.data) < enough and blocks.more():
        pass
    data = blocks.data
    for start in range(len(data)):
        at, n = start, 0
        while at is not None and at < len(data):
            at, n = plausible(data, at, references), n + 1
        if at is not None and (n > 1 or blocks.next >= blocks.size):
            return start
    return None


@dataclass
class Part(InputPartition):
    path: str
    size: int
    references: list[str]
    start: tuple[int, int]
    end: tuple[int, int]

    def __post_init__(self):
        super().__init__((self.path, self.start))


def plan(path: str, size: int, split_bytes: int) -> list[Part]:
    """Parts of a file that begin at records."""
    with _open(path) as file:
        head = Blocks(file, 0, size)
        names = read_header(head)
        starts = [head.place()]
        for target in range(split_bytes, size, split_bytes):
            block = _first_block(file, target, size)
            if block is None or (block, 0) <= starts[-1]:
                continue
            blocks = Blocks(file, block, size)
            at = first_record(blocks, len(names))
            if at is not None:
                blocks.at = at
                if blocks.place() > starts[-1]:
                    starts.append(blocks.place())
    ends = [*starts[1:], (size, 0)]
    return [Part(path, size, names, a, b) for a, b in zip(starts, ends, strict=True) if a < b]


def _first_block(file: pa.NativeFile, target: int, size: int) -> int | None:
    """Offset of the first block from ``target`` on: its header is followed by the next block's, or the end."""
    data = file.read_at(min(3 << 16, size - target), target)
    at = data.find(b"\x1f\x8b\x08\x04")
    while at >= 0:
        n = block_size(data[at : at + 65_536])
        if n is not None and (target + at + n == size or block_size(data[at + n : at + n + 65_536]) is not None):
            return target + at
        at = data.find(b"\x1f\x8b\x08\x04", at + 1)
    return None


def _cigar(codes: tuple[int, ...]) -> str | None:
    return "".join(f"{c >> 4}{_OPS[c & 15]}" for c in codes) or None


def _tags(data: bytes, at: int) -> dict[str, object]:
    """Tags of a record as text; an array of integers (``CG``) as a tuple."""
    out: dict[str, object] = {}
    while at < len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            value, at = data[at:end].decode(), end + 1
        elif kind == "B":
            each, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            value = struct.unpack_from(f"<{n}{_CODES[each]}", data, at + 5)
            at += 5 + n * _SIZES[each]
        elif kind == "A":
            value, at = chr(data[at]), at + 1
        else:
            value = str(struct.unpack_from(f"<{_CODES[kind]}", data, at)[0])
            at += _SIZES[kind]
        out[name] = value
    return out


def decode(record: bytes, references: list[str]) -> tuple:
    """A record (without its size) as the columns of ``SCHEMA`` but the path."""
    ref, pos, name, _, _, ops, flag, bases = struct.unpack_from("<iiBBHHHi", record)
    at = 32 + name
    codes = struct.unpack_from(f"<{ops}I", record, at)
    at += 4 * ops
    seq = "".join([_PAIRS[b] for b in record[at : at + (bases + 1) // 2]])[:bases] or None
    tags = _tags(record, at + (bases + 1) // 2 + bases)
    if ops == 2 and isinstance(tags.get("CG"), tuple) and codes[0] == bases << 4 | 4:  # more operations than the field holds
        codes = tags["CG"]
    found = [tags.get(t) for t in TAGS.values()]
    score = found[-1]
    return (record[32 : 31 + name].decode(), flag, references[ref] if ref >= 0 else None, pos + 1, _cigar(codes), seq, *found[:-1], int(score) if isinstance(score, str) and score.lstrip("-").isdigit() else None)


_ARROW = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[k]) for n, k in (c.split() for c in SCHEMA.split(", "))])


class BamReader(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int):
        self.paths, self.split_bytes = paths, split_bytes

    def partitions(self) -> list[Part]:
        return [p for path in self.paths for file, size in files_of(path) for p in plan(file, size, self.split_bytes)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        with _open(part.path) as file:
            blocks = Blocks(file, part.start[0], part.size)
            blocks.take(part.start[1])
            rows = []
            while (here := blocks.place()) < part.end:
                n = struct.unpack("<i", blocks.take(4))[0]
                rows.append((*decode(blocks.take(n), part.references), part.path))
                blocks.forget()
                if len(rows) == _ROWS:
                    yield _batch(rows)
                    rows = []
            if here != part.end:
                raise ValueError(f"{part.path}: records from {part.start} on end at {here}, not at {part.end}; read it with a larger split_bytes")
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)


def compress_blocks(data: bytes, each: int = 60_000) -> bytes:
    """BGZF blocks of ``data``, without the closing one."""
    out = []
    for k in range(0, len(data), each):
        piece = data[k : k + each]
        deflater = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = deflater.compress(piece) + deflater.flush()
        out += [struct.pack("<4BI2BH2sHH", 31, 139, 8, 4, 0, 0, 255, 6, b"BC", 2, len(body) + 25), body, struct.pack("<II", zlib.crc32(piece), len(piece))]
    return b"".join(out)


def encode_header(references: list[tuple[str, int]]) -> bytes:
    text = ("@HD\tVN:1.6\tSO:unknown\n" + "".join(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in references)).encode()
    parts = [b"BAM\x01", struct.pack("<i", len(text)), text, struct.pack("<i", len(references))]
    return b"".join(parts + [struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in references])


def encode(row: dict, numbers: dict[str, int]) -> bytes:
    """A record of the columns of ``SCHEMA``, without qualities and mate."""
    name, seq = row["qname"].encode() + b"\0", row["seq"] or ""
    codes, n = [], ""
    for c in row["cigar"] or "":
        if c.isdigit():
            n += c
        else:
            codes.append(int(n) << 4 | _OPS.index(c))
            n = ""
    tags = b""
    if len(codes) > 65_535:  # the real operations go to a tag
        span = sum(c >> 4 for c in codes if _OPS[c & 15] in "MDN=X")
        tags += b"CGBI" + struct.pack(f"<i{len(codes)}I", len(codes), *codes)
        codes = [len(seq) << 4 | 4, span << 4 | 3]
    for column, tag in TAGS.items():
        if row[column] is not None:
            tags += tag.encode() + (b"i" + struct.pack("<i", row[column]) if column == "as_score" else b"Z" + row[column].encode() + b"\0")
    bases = [_BASES.index(c) if c in _BASES else 15 for c in seq] + [0] * (len(seq) % 2)
    body = struct.pack("<iiBBHHHiiii", numbers.get(row["rname"], -1), row["pos"] - 1, len(name), 255, 0, len(codes), row["flag"], len(seq), -1, -1, 0)
    body += name + struct.pack(f"<{len(codes)}I", *codes) + bytes(a << 4 | b for a, b in zip(bases[::2], bases[1::2], strict=True)) + b"\xff" * len(seq) + tags
    return struct.pack("<i", len(body)) + body


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class BamWriter(DataSourceWriter):
    """A file for each task that has rows, named once it is whole."""

    def __init__(self, path: str, references: list[tuple[str, int]]):
        self.path, self.references = path.rstrip("/"), references

    def _system(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def write(self, rows: Iterator) -> Written:
        system, folder = self._system()
        numbers = {n: i for i, (n, _) in enumerate(self.references)}
        name, out, held = f"{folder}/.{uuid.uuid4().hex}.open", None, encode_header(self.references)
        for row in rows:
            if out is None:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(name)
            held += encode(row.asDict(), numbers)
            if len(held) > 1 << 20:
                out.write(compress_blocks(held))
                held = b""
        if out is None:
            return Written(None)
        out.write(compress_blocks(held) + END)
        out.close()
        return Written(name)

    def commit(self, messages: list) -> None:
        system, folder = self._system()
        for k, m in enumerate(m for m in messages if m and m.path):
            system.move(m.path, f"{folder}/part-{k:05}.bam")

    def abort(self, messages: list) -> None:
        system, _ = self._system()
        for m in messages:
            if m and m.path:
                system.delete_file(m.path)


class Bam(DataSource):
    """Format ``bam``: options ``paths`` (a JSON list) or ``path``, ``split_bytes``; for writing ``references`` (JSON pairs of name and length)."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        paths = json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]
        return BamReader(paths, int(self.options.get("split_bytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> BamWriter:
        return BamWriter(self.options["path"], [(n, int(k)) for n, k in json.loads(self.options["references"])])


def read_bam(spark: SparkSession, *paths: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of BAM files, or of all ``.bam`` files of folders."""
    spark.dataSource.register(Bam)
    return spark.read.format("bam").option("paths", json.dumps(list(paths))).option("split_bytes", split_bytes).load()


def write_bam(records: DataFrame, path: str, references: list[tuple[str, int]]) -> None:
    """Records with the columns of ``SCHEMA`` (but the path) as BAM files, one a task, in a folder."""
    spark = records.sparkSession
    spark.dataSource.register(Bam)
    columns = [c.split()[0] for c in SCHEMA.split(", ")[:-1]]
    records.selectExpr(*columns, "cast(null as string) as path").write.format("bam").mode("append").option("references", json.dumps(references)).save(path)

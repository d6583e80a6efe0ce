"""Byte-level BPE encoding and decoding with one encoding of each distinct word.

Encoding.  Blocks of documents split their texts into pre-tokens, number the
distinct ones, and keep the sequence of numbers (the positions) by document.
Each distinct word goes to the bucket of its hash, packed with the block's
other words for that bucket.  A bucket merges the packets and encodes every
word once for the whole corpus; its answers go back to the blocks, which put
the ids in place by position.  Words and positions leave a block through one
exchange, which both sides read; texts are not shuffled.  A frequent word is
one entry a block in its bucket, however often it occurs.

Decoding joins each id with the token-byte table.  The table has a row for each
vocabulary entry, which bounds it, so it is held by every task.

Nulls and edges: a null or empty text has no ids and decodes to nothing; a row
for each input row; null and repeated doc_ids are carried along.  The input
must give the same rows per partition when a task is run again.
"""

from __future__ import annotations

import base64
import functools
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary, doc_chunks, give_back, id_text, parts_for, read_table, squeeze, total_bytes, trimmed, unsqueeze

PACKET = "part long, block long, a binary, b binary, c binary, d binary"


@functools.lru_cache(4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a ranks file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(4)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@functools.lru_cache(4)
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens in a row, and start and length by id."""
    by_id = {i: t for t, i in ranks(path).items()}
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    lens = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lens) - lens, lens


def _odd(chars: set[str], pattern: str) -> set[str]:
    """Characters that the library's pattern engine and this module's put in different classes (their Unicode versions may differ).

    A vocabulary in which "a", "1" and "!" merge with each character shows the library's class.
    """
    tokens = {bytes([b]): None for b in range(256)}
    for c in chars:
        for mate in (b"a", b"1", b"!"):
            whole = mate + c.encode()
            tokens |= {whole[:n]: None for n in range(2, len(whole) + 1)}
    tokens = sorted(tokens, key=len)
    library = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})
    split = regex.compile(pattern).findall
    return {c for c in chars if any((len(library.encode_ordinary(m + c)) == 1) != (len(split(m + c)) == 1) for m in "a1!")}


def gather(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, step: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """``data[start : start + len]`` of each pair in a row, and where each ends; index arrays are made for ``step`` pairs at a time."""
    ends = np.cumsum(lens)
    out = np.empty(int(ends[-1]) if len(ends) else 0, data.dtype)
    for k in range(0, len(lens), step):
        n, e = lens[k : k + step], ends[k : k + step]
        lo, hi = int(e[0] - n[0]), int(e[-1])
        out[lo:hi] = data[np.repeat(starts[k : k + step] - e + n, n) + np.arange(lo, hi)]
    return out, ends


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers, compressed by byte planes."""
    return squeeze(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unsqueeze(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _rows(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *(binary(list(c)) for c in cols[2:])], names=["part", "block", "a", "b", "c", "d"])


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _send(size: int, buckets: int, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, base = regex.compile(pattern).findall, TaskContext.get().partitionId() << 24
        seen: set[str] = set()
        odd: set[str] = set()
        for k, (ids, texts) in enumerate(doc_chunks(batches, size)):
            no, numbers, places = base + k, _Numbers(), []
            texts = [(t or b"").decode() for t in texts]
            new = set().union(*texts) - seen
            seen |= new
            odd |= _odd(new, pattern)
            for t in texts:
                words = split(t) if not odd or odd.isdisjoint(t) else [t]  # the library splits a text with an odd character
                places.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            words = [w.encode() for w in numbers]
            bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), np.int32, len(words))
            order = np.argsort(bucket, kind="stable")
            head = np.array([[-1 if i is None else i, i is None, len(p)] for i, p in zip(ids, places, strict=True)], np.int64)
            rows = [(no, no, _planes(np.concatenate(places)), _planes(bucket), squeeze(head.tobytes()), None)]
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
            for b, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if hi > lo:
                    some = [words[i] for i in order[lo:hi].tolist()]
                    rows.append((-1 - b, no, _planes(np.array([len(w) for w in some])), squeeze(b"".join(some), 3), None, None))
            yield _rows(rows)

    return run


def _encode_words(path: str, pattern: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Ids of each word of a bucket; a word of many blocks is encoded once."""
        give_back()
        if key[0].as_py() >= 0 or not table.num_rows:
            return pa.Table.from_batches([_rows([])])
        encode, known, rows = _encoding(path, pattern).encode_ordinary, {}, []
        for no, lens, data in zip(*(table.column(c).to_pylist() for c in ("block", "a", "b")), strict=True):
            data, ends = unsqueeze(data), np.cumsum(lens := _unplanes(lens).astype(np.int64))
            out = []
            for s, e in zip((ends - lens).tolist(), ends.tolist(), strict=True):
                if (ids := known.get(w := data[s:e])) is None:
                    ids = known[w] = encode(w.decode())
                out.append(ids)
            rows.append((no, -1 - key[0].as_py(), _planes(np.fromiter(map(len, out), np.int64, len(out))), _planes(np.fromiter(chain.from_iterable(out), np.int64)), None, None))
        return pa.Table.from_batches([_rows(rows)])

    return run


def _decoded(lists: pa.ListArray, path: str) -> Iterator[tuple[int, int, pa.Array]]:
    """Bytes of rows lo to hi of ``lists``, some million ids at a time: each id is joined with its row of the token-byte table."""
    data, starts, lens = _token_bytes(path)
    counts = np.array([n or 0 for n in lists.value_lengths().to_pylist()], np.int64)
    ids, stops, lo = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(counts), 0
    while lo < len(counts):
        first = int(stops[lo] - counts[lo])
        hi = max(lo + 1, int(np.searchsorted(stops, first + (1 << 20), "right")))
        some = ids[first : int(stops[hi - 1])]
        out, ends = gather(data, starts[some], lens[some])
        offsets = np.concatenate(([0], ends))[np.concatenate(([0], stops[lo:hi] - first))].astype(np.int32)
        yield lo, hi, pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(offsets), pa.py_buffer(out)])
        lo = hi


_ROUND_TRIP = "doc_id long, ids array<int>, decoded binary"
_NAMES = ["doc_id", "ids", "decoded"]


def _reassemble(path: str, decoded: bool):
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())][: 2 + decoded])

    def run(key: tuple, mine: pa.Table, answers: pa.Table) -> pa.Table:
        """Ids of a block's documents, by position; decoded too if asked for."""
        give_back()
        if key[0].as_py() < 0 or not mine.num_rows:
            return out.empty_table()
        places, bucket, head = (mine.column(c)[0].as_py() for c in "abc")
        places, bucket, head = _unplanes(places), _unplanes(bucket), np.frombuffer(unsqueeze(head), np.int64).reshape(-1, 3)
        got = sorted(zip(*(answers.column(c).to_pylist() for c in ("block", "a", "b")), strict=True), key=lambda x: x[0])
        none = np.zeros(0, np.uint32)
        lens, ids = (np.concatenate([none, *(_unplanes(x[k]) for x in got)]) for k in (1, 2))
        lens = lens.astype(np.int64)
        starts = np.cumsum(lens) - lens
        at = np.empty(len(bucket), np.int32)  # of the block's word numbers among the answers
        at[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
        at = at[places]
        ids, ends = gather(ids.astype(np.int32), starts[at], lens[at])
        offsets = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(head[:, 2])))]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        keys = pa.array(head[:, 0], pa.int64(), mask=head[:, 1] > 0)
        if not decoded:
            return pa.Table.from_arrays([keys, lists], schema=out)
        return pa.Table.from_batches([pa.RecordBatch.from_arrays([keys[lo:hi], lists[lo:hi], data], schema=out) for lo, hi, data in _decoded(lists, path)], out)

    return run


def encode(docs: DataFrame, vocab_path: str | None = None, pattern: str | None = None, decoded: bool = False, block_bytes: int = 4 << 20, bucket_bytes: int = 8 << 20) -> DataFrame:
    """``doc_id, ids array<int>`` of each row, as the tiktoken library encodes the text without special tokens; ``decoded binary`` too if asked for."""
    path, pattern = vocab_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    docs = id_text(docs)
    n = total_bytes(docs)
    sent = docs.mapInArrow(trimmed(_send(block_bytes, max(1, math.ceil(n / bucket_bytes)), pattern)), PACKET).repartition(parts_for(docs.sparkSession, n), "part")
    answers = sent.groupBy("part").applyInArrow(_encode_words(path, pattern), PACKET)
    return sent.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_reassemble(path, decoded), _ROUND_TRIP if decoded else "doc_id long, ids array<int>")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = batch.columns
            for lo, hi, data in _decoded(lists, path):
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), lists.slice(lo, hi - lo), data], names=_NAMES)

    return run


def decode(ids: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded binary`` of rows with ``doc_id, ids``; an id out of the table is an error, null ids decode to nothing."""
    path = vocab_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return ids.select("doc_id", "ids").mapInArrow(trimmed(_decode(path)), _ROUND_TRIP)


def round_trip(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row."""
    return encode(docs, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"))

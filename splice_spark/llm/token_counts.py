"""Token counts with a whole-token shortcut.

Offline, once for a vocabulary, every token string is proved or refused: it is
proved if it is one pre-token and the library encodes it alone as that one
token.  A pre-token that is a proved string counts one, with no merging; only
the rest is merged by the library, each string once while it stays in a
bounded cache.  The proof is a Spark job over the vocabulary (``prove``), stored
under the digest of its file and read by every later run that names the same
store; tasks get the proved strings, of which there are no more than tokens.

Nulls and edges: a null or empty text has 0 bytes and 0 tokens, a null id stays
null; a special token's string inside a text counts as that token, as the
library does by default; each row gives a row, repeated ones too, and an empty
table none; very long texts are counted whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from splice_spark.functions.lineage import shared_folder

from .common import id_text, ids_and_bytes, read_table, trimmed

#: The pre-token pattern of byte-level vocabularies (a fixed value).
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CACHE = 1 << 20


@functools.lru_cache(2)
def load(path: str) -> tuple[Tokenizer, list[str]]:
    """The library's tokenizer and its special strings; only byte-level ones with the standard pattern are taken."""
    with open(path, encoding="utf-8") as f:
        parts = json.load(f)
    pre = parts["pre_tokenizer"] or {}
    if pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or parts["normalizer"]:
        raise ValueError(f"{path} isn't a plain byte-level vocabulary")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, [t["content"] for t in parts["added_tokens"]]


def proved(path: str, ids: list[int]) -> dict[int, str]:
    """Strings of those of the tokens ``ids`` that are one pre-token and encode alone as that one token."""
    tokenizer, special = load(path)
    split = regex.compile(BYTE_LEVEL).findall
    strings = {i: tokenizer.decode([i], skip_special_tokens=False) for i in ids}
    whole = [(i, s) for i, s in strings.items() if s not in special and split(s) == [s]]
    found = tokenizer.encode_batch([s for _, s in whole], add_special_tokens=False)
    return {i: s for (i, s), e in zip(whole, found, strict=True) if e.ids == [i]}


def _prove(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = proved(path, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.string())], names=["id", "token"])

    return run


def prove(spark: SparkSession, path: str, store: str | None = None) -> DataFrame:
    """``id, token`` of the proved tokens of a vocabulary: read from ``store``, or proved by a job and stored there first.

    Without ``store`` the folder of this application serves, so that a vocabulary is proved once an application.
    """
    with open(path, "rb") as f:
        digest = hashlib.sha256(f.read()).hexdigest()
    folder = f"{store or shared_folder(spark)}/proved-{digest}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not done.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(done):
        ids = spark.range(load(path)[0].get_vocab_size())
        ids.mapInArrow(trimmed(_prove(path)), "id long, token string").write.mode("overwrite").parquet(folder)
    return spark.read.schema("id long, token string").parquet(folder)


def _splits_alike(tokenizer: Tokenizer, char: str) -> bool:
    """Whether the library and this module's pattern put ``char`` in the same class (their Unicode versions may differ)."""
    text = f"a{char}b {char}1{char} {char}!{char} "
    return len(tokenizer.pre_tokenizer.pre_tokenize_str(text)) == len(regex.findall(BYTE_LEVEL, text))


def _count(path: str, one: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, special = load(path)
        split, merged = regex.compile(BYTE_LEVEL).findall, {}
        seen: set[str] = set()
        odd: set[str] = set()
        between = regex.compile("|".join(map(regex.escape, special))).split if special else lambda t: [t]
        for batch in batches:
            ids, texts = ids_and_bytes(batch)
            counts, rests, sizes = [], [], [len(t or b"") for t in texts]
            texts = [(t or b"").decode() for t in texts]
            new = set().union(*texts) - seen
            seen |= new
            odd |= {c for c in new if not _splits_alike(tokenizer, c)}
            for t in texts:
                pieces = between(t)
                words = [w for p in pieces for w in (split(p) if not odd or odd.isdisjoint(p) else [p])]  # an odd piece is left to the library as a whole
                rest = [w for w in words if w not in one]
                counts.append(len(pieces) - 1 + len(words) - len(rest))
                rests.append(rest)
            if len(merged) > _CACHE:
                merged.clear()
            new = list({w for rest in rests for w in rest if w not in merged})
            for k in range(0, len(new), 8192):
                some = new[k : k + 8192]
                merged.update(zip(some, (len(e) for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)), strict=True))
            counts = [n + sum(map(merged.__getitem__, rest)) for n, rest in zip(counts, rests, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str | None = None, store: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each row; no shuffle.  ``store`` is a folder for proofs that outlives the application."""
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    one = frozenset(r["token"] for r in prove(docs.sparkSession, path, store).collect())  # a row a token of the vocabulary at most
    return id_text(docs).mapInArrow(trimmed(_count(path, one)), "doc_id long, n_bytes long, n_tokens long")


def op6_token_counts(spark: SparkSession, sf_dir: str, limit: int = 512) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > limit)

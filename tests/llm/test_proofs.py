"""The stored proof of whole tokens, and the pipeline's redaction and tokens against plain versions."""

import base64
import hashlib
import re

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from splice_spark.llm import pii, token_counts


def test_proof_is_stored_and_read(spark, tmp_path, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    first = {r.id: r.token for r in token_counts.prove(spark, path, str(tmp_path)).collect()}
    library = Tokenizer.from_file(path)
    assert len(first) > 40_000
    assert all(library.encode(t, add_special_tokens=False).ids == [i] for i, t in list(first.items())[::97])
    monkeypatch.setattr(token_counts, "_prove", None)  # a second run only reads
    assert {r.id: r.token for r in token_counts.prove(spark, path, str(tmp_path)).collect()} == first
    docs = spark.createDataFrame([(1, "the cat sat"), (1, "the cat sat"), (None, None)], "doc_id long, text string")
    want = len(library.encode("the cat sat", add_special_tokens=False).ids)
    assert sorted((r.n_tokens for r in token_counts.count_tokens(docs, store=str(tmp_path)).collect())) == [0, want, want]


def test_pipeline_redacts_and_encodes(spark):
    """Every document that is left: its redacted text has no base span any more, all else is unchanged, and ids and bytes are tiktoken's."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r.text or "" for r in docs.collect()}
    redacted = {r.doc_id: r.text for r in corpus_pipeline.redact_pii(spark, docs, sf).collect()}
    spans = {r.doc_id: r.spans for r in pii.op2_pii(spark, sf).collect()}
    kinds = {"email", "ip", "card", "phone"}
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert any(spans.values())
    for i, text in before.items():
        assert not mail.search(redacted[i])
        at, want = 0, ""
        cuts = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans[i].split(",") if s))
        rest = redacted[i]
        for a, b, kind in cuts:
            if a < at:
                continue
            want = text[at:a]
            assert kind in kinds and rest.startswith(want)
            rest = rest[len(want) :]
            mark = re.match(r"[\[<{(]?[A-Za-z_]+[\]>})]?", rest)
            assert mark and kind in mark[0].lower()
            rest, at = rest[mark.end() :], b
        assert rest == text[at:]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    done = {r.doc_id: r for r in corpus_pipeline.tokenise(spark, corpus_pipeline.redact_pii(spark, docs, sf), sf).collect()}
    for i, text in redacted.items():
        ids = library.encode_ordinary(text)
        assert done[i].n_tokens == len(ids)
        assert done[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert done[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()

"""The stored positional index: searched without the documents, part by part, with null item ids and clashing columns."""

import random
import re
import shutil
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from splice_spark.llm import decontamination as d


def plain(rows, items, window=13):
    """``doc_id, n_words, hit places, items`` of each row, by looking at every window of every document."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    phrases = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            phrases.setdefault(tuple(w[k : k + n]), set()).add(i)
    for i, t in rows:
        w, places, found = words(t), set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in phrases:
                    found |= phrases[tuple(w[k : k + n])]
                    places |= set(range(k, k + n))
        yield i, len(w), tuple(sorted(places)), tuple(sorted(found, key=str))


def test_one_index_serves_every_search_without_the_documents(spark, tmp_path):
    rng = random.Random(7)
    some = lambda n: " ".join(rng.choice(["Alpha", "beta", "γάμμα", "delta9", "e", "f-g"]) for _ in range(n))
    rows = [(k if k % 9 else None, some(rng.randrange(0, 90))) for k in range(80)] + [(5, None), (5, ""), (6, some(4000)), (7, "-- !")]
    rows += rows[:3]
    spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, shard int").repartition(4).write.parquet(f"{tmp_path}/docs")
    index = d.build_index(spark.read.parquet(f"{tmp_path}/docs"), shard_bytes=1500)
    shutil.rmtree(tmp_path / "docs")
    long = [t for _, t in rows if t and len(t.split()) > 40]
    items = [(1, " ".join(long[0].split()[3:30])), (None, " ".join(long[1].split()[:14])), (None, "delta9 e F"), (3, " ".join(long[2].split()[5:25])), (4, None), (None, "never seen"), (3, "Beta beta BETA")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, place string")
    for few in (items, items[:2]):
        want = Counter(plain(rows, few))
        for most in (1 << 20, 100):
            got = d.search_index(index, bench if few is items else bench.limit(0).union(spark.createDataFrame([(i, t, "x") for i, t in few], bench.schema)), most_bytes=most)
            assert got.columns == ["doc_id", "n_words", "hits", "items", "near"]
            assert Counter((r.doc_id, r.n_words, tuple(k for a, b in r.hits for k in range(a, b)), tuple(sorted(r["items"], key=str))) for r in got.collect()) == want


def test_index_holds_every_word_and_gives_positions_back(spark):
    rows = [(1, "a b a"), (2, None), (3, "b c a a"), (4, "")]
    index = d.build_index(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert len(index) == 1 and index[0].doc_ids == [1, 2, 3, 4] and index[0].n_words == [3, 0, 4, 0]
    terms = {bytes(t): k for k, t in enumerate(index[0].terms)}
    shard = d._Shard({**index[0].asDict(), "gaps": np.array(index[0].gaps)}, pa.array([bytes(t) for t in terms]))
    assert {t.decode(): shard.list_of(k).tolist() for t, k in terms.items()} == {"a": [0, 2, 5, 6], "b": [1, 3], "c": [4]}
    assert {bytes(r.term): r.n for r in d.term_counts(spark.createDataFrame(index, d.INDEX)).collect()} == {b"a": 4, b"b": 2, b"c": 1}


def test_filter_keeps_the_same_rows_whatever_the_parts(spark):
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[k : k + 60])) for k in range(0, 340, 17)] + [(None, None), (900, "x y z")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, gaps string").repartition(3)
    items = [(1, " ".join(words[50:80])), (None, " ".join(words[300:330]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter((i, t) for (i, t), (_, n, hit, _) in zip(rows, plain(rows, items), strict=True) if not (hit and 20 * len(hit) >= n))
    assert 0 < sum(want.values()) < len(rows)
    for most in (1 << 20, 60):
        kept = d.keep_clean(docs, bench, most_bytes=most)
        assert kept.columns == docs.columns and Counter((r.doc_id, r.text) for r in kept.collect()) == want


def test_a_row_group_of_the_index_holds_few_shards(spark, tmp_path):
    """However many shards a partition has: the writer and the reader hold a row group each."""
    words = " ".join(f"w{k * 7919 % 100_003}" for k in range(120_000))
    spark.createDataFrame([(k, words) for k in range(40)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    index = d.build_index(spark.read.parquet(f"{tmp_path}/docs"), shard_bytes=1 << 19)
    files = [pq.ParquetFile(p.removeprefix("file://")).metadata for p in index.inputFiles()]
    groups = [f.row_group(k) for f in files for k in range(f.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 40
    assert max(g.total_byte_size for g in groups) < 16 << 20
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").removesuffix("b")) <= 8 << 20

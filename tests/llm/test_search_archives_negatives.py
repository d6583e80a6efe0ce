"""Lexical search, archives and hard negatives against brute force, on nulls, repeated rows, ties, long and empty values and clashing columns."""

import base64
import gzip
import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from splice_spark.llm import hard_negatives, lexical_search, warc

CLASH = "tier0 long, term string, score double, rank string, shelf string"
EXTRA = (1, "t", 0.5, "r", "s")


def documents():
    rng = random.Random(11)
    words = [f"t{int(rng.paretovariate(0.6)) % 400}" for _ in range(3000)] + ["Été", "NAÏVE", "x" * 300]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = some(20_000)
    out = [None, "", " .,; ", "the", "The THE the", long, long, some(40).upper(), "a-b a_b a.b"]
    out += [some(rng.randrange(1, 120)) for _ in range(400)]
    out += [out[20]] * 6
    rows = [(k, t) for k, t in enumerate(out)]
    return rows + [rows[30], rows[30], (None, out[40]), (None, out[40]), (31, "another text under a used id"), (-5, out[41])]


def queries(rows):
    rng = random.Random(3)
    out = [(k, " ".join((rows[20 + 9 * k][1] or "x").split()[:30])) for k in range(25)]
    out += [(100 + k, f"t{k} t{k} t1 t2 zzz") for k in range(12)] + [(200, None), (201, ""), (202, "nothingknown here9"), (None, "t1 t3"), (300, "the"), (300, "the"), (301, rows[5][1])]
    return out + [(400 + k, " ".join(f"t{rng.randrange(400)}" for _ in range(8))) for k in range(10)]


def brute_ranks(rows, items, k=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    split = lambda t: term.findall((t or "").translate(lower))
    docs = [(i, Counter(split(t))) for i, t in rows]
    docs = [(i, c, c.total()) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in docs:
            m = 25 + (75 * n * n_docs) // n_terms
            s = sum(x * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, x in Counter(split(text)).items() if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.fixture(scope="module")
def searched(spark, tmp_path_factory):
    rows = documents()
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows], f"doc_id long, text string, {CLASH}").repartition(5)
    index = lexical_search.build_index(docs, str(tmp_path_factory.mktemp("index") / "at"), block_bytes=20_000, share=20)
    return rows, index


def test_search_is_exact(spark, searched):
    rows, index = searched
    items = queries(rows)
    frame = spark.createDataFrame([(*x, "d", 0.1, 7) for x in items], "item_id long, text string, doc_id string, score double, q long").repartition(2)
    rounds = []
    got = lexical_search.search(index, frame, part_bytes=40_000, report=rounds)
    assert Counter(map(tuple, got.collect())) == Counter(brute_ranks(rows, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    settled = Counter()
    for tier, _, n in rounds:
        settled[tier] += n
    assert settled[0] and settled[lexical_search.TIERS - 1]  # some items are proved above, others fall through


def test_proved_items_are_completed(spark, searched):
    """A rare term and a frequent one: the first tier proves the item before all postings of the frequent one are read."""
    rows, index = searched
    frequent = index.residuals.filter("r0 > 0").join(index.terms, "term").orderBy(F.desc("df")).first()["term"].decode()
    lone = [t for t, n in Counter(t for _, x in rows for t in set((x or "").split())).items() if n > 10 and t.startswith("t")]
    items = [(k, f"{t} " * 9 + frequent) for k, t in enumerate(sorted(lone)[:30])]
    rounds = []
    got = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"), report=rounds)
    assert Counter(map(tuple, got.collect())) == Counter(brute_ranks(rows, items))
    assert rounds[0][2] > 0


def test_index_is_stored(spark, searched):
    rows, index = searched
    again = lexical_search.open_index(spark, index.path)
    assert (again.n_docs, again.n_terms) == (index.n_docs, index.n_terms)
    assert again.terms.count() == len({t for _, x in rows for t in lexical_search.terms_of((x or "").encode())})
    items = queries(rows)[:3]
    assert Counter(map(tuple, lexical_search.search(again, spark.createDataFrame(items, "item_id long, text string"), k=3).collect())) == Counter(brute_ranks(rows, items, 3))


def test_search_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical_search.search(lexical_search.build_index(none, str(tmp_path / "a")), items).collect() == []
    some = lexical_search.build_index(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), str(tmp_path / "b"))
    assert lexical_search.search(some, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in lexical_search.search(some, items).collect()] in ([(1, 1, 1)], [])


def pages():
    rng = random.Random(2)
    long = "".join(rng.choice("ab <é\r\n") for _ in range(300_000))
    out = [(k, f"http://x/{k}", f"<p>page {k}</p>") for k in range(30)]
    out += [(100 + k, "http://copy/", "<p>same</p>") for k in range(60)]
    out += [(200, None, None), (201, "", ""), (202, "http://a b\r\nX: y", None), (300, "http://l", long), (299, "http://m", long)]
    out += [(None, "http://n", "<p>no id</p>"), (None, "http://n", "<p>no id</p>"), (5, "http://x/5", "<p>page 5</p>"), (400, "http://w", "WARC/1.1\r\nWARC-Type: response\r\n\r\nx\r\n\r\n\r\n\r\nWARC/1.1")]
    return out


def brute_pages(rows, min_bytes=0):
    groups = {}
    for i, _, h in rows:
        groups.setdefault((h or "").encode(), []).append(i)
    out = Counter()
    for data, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = max(ids, key=lambda i: (i is not None, i or 0))
        for i in ids:
            out[(i, len(data), digest, "response" if i == first or len(data) < min_bytes else "revisit", None if i == first or len(data) < min_bytes else first)] += 1
        if len(data) >= min_bytes and ids.count(first) > 1:  # one of them is the original
            out[(first, len(data), digest, "response", None)] = 1
            out[(first, len(data), digest, "revisit", first)] = ids.count(first) - 1
    return out


@pytest.mark.parametrize("min_bytes", [0, 12, 10**9])
def test_archives_round_trip(spark, tmp_path, min_bytes):
    rows = pages()
    frame = spark.createDataFrame([(*r, "x", 1, "k") for r in rows], "page_id long, url string, html string, digest string, n_bytes long, key string").repartition(3)
    warc.write_archives(warc.page_rows(frame), str(tmp_path / "w"), min_bytes, file_bytes=100_000)
    records = warc.read_archives(spark, str(tmp_path / "w"))
    got = warc.resolve_revisits(records)
    found = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.original_page_id) for r in got.collect())
    assert found == brute_pages(rows, min_bytes)
    assert Counter((r.page_id, bytes(r.payload)) for r in got.collect()) == Counter((i, (h or "").encode()) for i, _, h in rows)
    assert got.filter("declared_digest <> payload_digest").count() == 0
    assert records.select("record_id").distinct().count() == len(rows)


def test_archives_are_warc_files(spark, tmp_path):
    warc.write_archives(warc.page_rows(spark.createDataFrame(pages(), "page_id long, url string, html string")), str(tmp_path / "w"), file_bytes=50_000)
    files = sorted((tmp_path / "w").glob("part-*.gz"))
    assert len(files) > 1
    n = 0
    for f in files:
        data = gzip.open(f).read()
        for headers, block in warc.parse_records(data):
            n += 1
            assert {"warc-type", "warc-record-id", "warc-date", "warc-target-uri", "warc-payload-digest", "content-type", "content-length"} <= set(headers)
            http, _, body = bytes(block).partition(b"\r\n\r\n")
            assert http.startswith(b"HTTP/1.1 200 OK") and (headers["warc-type"] == "response" or not body)
            assert ("warc-refers-to" in headers) == (headers["warc-type"] == "revisit")
    assert n == len(pages())
    with pytest.raises(ValueError):
        list(warc.parse_records(b"no archive"))
    two = gzip.compress(b"a") + gzip.compress(b"b")
    assert warc.inflate(two) == b"ab" and warc.inflate(b"plain") == b"plain"


def test_archives_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(warc.page_rows(none), str(tmp_path / "w"))
    assert warc.resolve_revisits(warc.read_archives(spark, str(tmp_path / "w"))).count() == 0


def test_revisit_without_its_original(spark):
    row = {"record_id": "a", "record_type": "revisit", "page_id": 1, "target_uri": "u", "refers_to": "gone", "declared_digest": "D", "payload_digest": None, "payload_bytes": None, "payload": None}
    got = warc.resolve_revisits(spark.createDataFrame([row], warc._RECORD)).collect()
    assert [(r.page_id, r.payload_bytes, r.original_page_id) for r in got] == [(1, None, None)]


def vectors():
    rng = random.Random(9)
    out = [(k, [rng.gauss(0.05, 0.3) for _ in range(20)], rng.randrange(4)) for k in range(420)]
    same = [0.25] * 20
    out += [(1000 + k, same, k % 3) for k in range(40)] + [(100, same, 1), (100, same, 1), (200, same, 2)]
    out += [(501, None, 1), (600, same, None), (None, same, 1), (601, [0.1, None] + [0.0] * 18, 1), (602, [float("nan")] * 20, 1), (603, [float("inf")] * 20, 1)]
    return out + [(700, [], 1), (701, [0.5, 0.5], 1), (800, [1e6] * 20, 2), (801, [-1e6] * 20, 2), (900, same, 77)]


def brute_negatives(rows):
    known = []
    for n, (i, v, label) in enumerate(rows):
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            known.append((i, n, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for i, n, label, v in known:
        if i % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), j, m, other) for j, m, other, w in known)
        for s, j, _, _ in [x for x in scores if x[3] == label and x[2] != n][:5]:
            window = [x for x in scores if x[3] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, r, x[1], -s, -x[0]) for r, x in enumerate(window, 1)]
    return out


@pytest.mark.parametrize(("dims", "rows", "anchors"), [(8, 64, 2), (32, 1024, 128), (1, 100, 100)])
def test_hard_negatives(spark, dims, rows, anchors):
    data = vectors()
    frame = spark.createDataFrame([(*r, 1, 2, 0.5) for r in data], "vec_id long, embedding array<double>, label int, row long, shard int, score double").repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    got = hard_negatives.mine_hard_negatives(frame, F.col("vec_id") % 100 == 0, label=label, dims=dims, shard_rows=rows, shard_anchors=anchors)
    assert Counter(map(tuple, got.collect())) == Counter(brute_negatives(data))


def test_products_beyond_doubles_are_exact():
    import numpy as np

    a, b = np.full((2, 3), 3_000_000_001), np.full((2, 3), 1_000_000_007)
    assert (hard_negatives._product(a, b) == 3 * 3_000_000_001 * 1_000_000_007).all()


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine_hard_negatives(none, F.col("vec_id") % 100 == 0).collect() == []
    lone = spark.createDataFrame([(100, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine_hard_negatives(lone, F.col("vec_id") % 100 == 0).collect() == []

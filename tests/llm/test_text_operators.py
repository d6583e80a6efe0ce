"""The text operators against brute force, on texts with nulls, copies, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
from collections import Counter
from types import SimpleNamespace

import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from splice_spark.llm import byte_bpe, chat_snapshots, decontamination, pii, quality_classifier, repetition, simhash_dedup, substring_dedup, token_counts, toxicity

SCHEMA = "doc_id long, text string, part long, fp string, score double, stats string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)] + ["Été", "naïve", "ÄÖ", "x" * 200, "idiot", "the"]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, long = some(60), some(3000)
    out = [None, "", " \n\t ", "one", "one two", "ONE two", some(19), some(20), some(21), long, long, long + " end", shared]
    out += [f"{some(30)}\n{shared} {some(25)}" for _ in range(12)]
    out += ["a b c d e f g h i j " * 12, ("same line here\n" * 9), some(40).upper() + " !! ", some(50).replace(" ", " | ")]
    out += [some(rng.randrange(5, 400)) for _ in range(40)]
    base = some(200)
    for k in range(20):
        w = base.split()
        w[k * 7 % 200] = "changed"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, 1, "f", 0.5, "s") for k, t in enumerate(texts())]
    rows += [rows[9], rows[9], (None, "no id at all", 1, "f", 0.5, "s"), (7, "another text under a used id", 1, "f", 0.5, "s")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.checkpoint() if spark.sparkContext.getCheckpointDir() else _checkpointed(spark, df)


def _checkpointed(spark, df):
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    return df.checkpoint()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(rows):
    return Counter(rows)


def brute_removed(rows, window=20):
    first = {}
    key = lambda i: (i is None, i or 0)
    for i, t in rows:
        w = WORD.findall(t or "")
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, ((True, 0), s)), (key(i), s)) if k in first else (key(i), s)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if (key(i), s) > first[tuple(w[s : s + window])]:
                gone[s : s + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def test_substring_dedup(docs, rows, empty):
    for blocks, buckets in ((1 << 20, 1 << 20), (600, 900)):
        got = substring_dedup.remove_repeats(docs, block_bytes=blocks, bucket_bytes=buckets).collect()
        assert counted((r.doc_id, r.n_words, sum(s.end - s.start for s in r.removed), r.kept_text) for r in got) == counted(brute_removed(rows))
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_substring_dedup_of_blocks_of_few_words(spark):
    words = lambda n: " ".join(f"w{k}" for k in range(n))
    # A document a partition, so each is a block of its own; the last table has a short document after a full block.
    tables = [[(n, words(n)) for n in range(23)], [(0, words(40)), (1, words(40)), (2, words(12))]]
    for rows in tables:
        docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows) if len(rows) > 3 else 1), "doc_id long, text string")
        got = substring_dedup.remove_repeats(docs, block_bytes=150, bucket_bytes=900).collect()
        assert counted((r.doc_id, r.n_words, sum(s.end - s.start for s in r.removed), r.kept_text) for r in got) == counted(brute_removed(rows))


def _in_one_process(rows, monkeypatch, window=20, buckets=3):
    """The steps of the operator by hand, so that a patched index is the one that is used."""
    import pyarrow as pa

    sent = []
    for no, part in enumerate((rows[0::2], rows[1::2])):
        batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in part], pa.int64()), pa.array([t for _, t in part], pa.string())], names=["doc_id", "text"])
        monkeypatch.setattr(substring_dedup, "TaskContext", SimpleNamespace(get=lambda no=no: SimpleNamespace(partitionId=lambda: no)))
        sent += [r for b in substring_dedup._send(1 << 30, window, buckets)(iter([batch])) for r in b.to_pylist()]

    def groups(found):
        out = {}
        for r in found:
            out.setdefault(r["part"], []).append(r)
        return out

    table = lambda some: pa.Table.from_pylist(some, substring_dedup._rows([]).schema)
    each = lambda f, one, *others: [r for k, v in one.items() for r in f((pa.scalar(k),), table(v), *(table(o.get(k, [])) for o in others)).to_pylist()]
    sent = groups(sent)
    answers = groups(each(substring_dedup._probe, sent))
    asked = groups(each(substring_dedup._extend(window, buckets), sent, answers))
    found = groups(each(substring_dedup._settle(window), asked))
    return each(substring_dedup._keep(window), sent, found)


def test_substring_dedup_needs_its_index(rows, monkeypatch):
    removed = lambda: sum(s["end"] - s["start"] for r in _in_one_process(rows, monkeypatch) for s in r["removed"])
    assert removed() == sum(n for _, _, n, _ in brute_removed(rows)) > 0
    monkeypatch.setattr(substring_dedup._Block, "indexed", lambda self, at: at < 0)
    assert removed() == 0


def test_equal_hashes_are_no_equal_windows(monkeypatch):
    """With one hash for all windows the words alone decide."""
    import numpy as np

    monkeypatch.setattr(substring_dedup, "windows", lambda h, n: np.zeros(len(h) - n + 1, np.uint64))
    words = np.array([1, 2, 3, 1, 2, 3, 2, 2, 3, 1, 2, 9])
    at = np.arange(11)
    late = substring_dedup.later(words, at, np.zeros(11, np.int64), at, 2)
    seen, want = set(), []
    for k in at:
        want.append((w := tuple(words[k : k + 2])) in seen)
        seen.add(w)
    assert late.tolist() == want


def brute_print(t):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, rows, empty):
    prints = [(i, brute_print(t)) for i, t in rows]
    group = list(range(len(prints)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a][1] ^ prints[b][1]).count("1") <= 2:
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    want = counted((i, p, least.get(root(k))) for k, (i, p) in enumerate(prints))
    got = simhash_dedup.near_duplicates(docs).collect()
    assert counted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
    got = simhash_dedup.near_duplicates(docs, long=1).collect()
    assert counted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({root(k) for k in range(len(prints))})
    assert simhash_dedup.near_duplicates(empty).count() == 0


def test_no_link_is_lost_in_long_lists(spark):
    """Fingerprints that share bytes by the hundred, and pairs that differ in each two places."""
    import numpy as np

    rng = np.random.default_rng(3)
    fp = [rng.integers(0, 1 << 63, 300, dtype=np.uint64), np.uint64(0x123456) << np.uint64(40) | rng.integers(0, 1 << 18, 900, dtype=np.uint64)]
    some = fp[0][:70]
    fp += [some ^ (np.uint64(1) << rng.integers(0, 64, 70, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 70, dtype=np.uint64)) for _ in range(3)]
    fp = np.unique(np.concatenate(fp))
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2
    label = np.arange(len(fp))
    while not ((new := np.where(near, label[None, :], len(fp)).min(1)) == label).all():
        label = new
    want = {}
    for k, r in enumerate(label.tolist()):
        want.setdefault(r, set()).add(int(fp[k].view(np.int64)))
    table = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    for long in (256, 20, 2):
        group = {int(x): {int(x)} for x in fp.view(np.int64)}
        for u, v in simhash_dedup.links(table, 2, long).collect():
            if group[u] is not group[v]:
                group[u] |= group[v]
                for x in group[v]:
                    group[x] = group[u]
        assert {frozenset(g) for g in group.values()} == {frozenset(g) for g in want.values()}
    assert [simhash_dedup.depth_for(n) for n in (0, 256, 257, 1 << 24, 1 << 60)] == [1, 1, 2, 3, 6]


def test_links_of_a_large_list():
    import numpy as np

    rng = np.random.default_rng(1)
    fp = np.unique(np.uint64(0xABCD) << np.uint64(40) | rng.integers(0, 1 << 16, 700, dtype=np.uint64))
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2
    label = np.arange(len(fp))
    while True:
        new = np.where(near, label[None, :], len(fp)).min(1)
        if (new == label).all():
            break
        label = new
    stars = dict(simhash_dedup._stars(fp, 2))
    signed = fp.view(np.int64).tolist()
    assert [stars.get(s, s) for s in signed] == [signed[k] for k in label]


def test_byte_bpe(docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(path), special_tokens={})
    want = counted((i, tuple(library.encode_ordinary(t or ""))) for i, t in rows)
    for size in (1 << 20, 2000):
        got = byte_bpe.encode(docs, decoded=True, block_bytes=size, bucket_bytes=size).collect()
        assert counted((r.doc_id, tuple(r.ids)) for r in got) == want
        assert counted((r.doc_id, bytes(r.decoded).decode()) for r in got) == counted((i, t or "") for i, t in rows)
    again = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert counted(bytes(r.decoded).decode() for r in again) == counted(t or "" for _, t in rows)
    assert byte_bpe.round_trip(empty).count() == 0


def test_token_counts(docs, rows, spark, empty):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = token_counts.count_tokens(docs).collect()
    assert counted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == counted((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    odd = ["a<|endoftext|>b  <|endoftext|>", "<|endoftext|>", " \u0085  x", "it's we'll", "⃁՘x", "  tail  "]
    got = token_counts.count_tokens(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {k: len(library.encode(t, add_special_tokens=False).ids) for k, t in enumerate(odd)}
    assert token_counts.count_tokens(empty).count() == 0


def test_decontamination(docs, rows, spark, empty):
    source = [t for _, t in rows if t and len(t.split()) > 100][:3]
    items = [(1, " ".join(source[0].split()[10:40])), (2, " ".join(source[1].split()[5:12])), (3, None), (4, "!!"), (5, "never seen words " * 9), (2, "ONE, two"), (1, " ".join(source[0].split()[10:40]))]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    phrases = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            phrases.setdefault(tuple(w[k : k + n]), set()).add(i)
    want = []
    for i, t in rows:
        w, found = words(t), set()
        hit = [False] * len(w)
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in phrases:
                    found |= phrases[tuple(w[k : k + n])]
                    hit[k : k + n] = [True] * n
        want.append((i, len(w), sum(hit), tuple(sorted(found))))
    for most in (1 << 20, 150):
        got = decontamination.with_verdict(decontamination.find_items(docs, bench, most_bytes=most)).collect()
        assert counted((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in got) == counted(want)
    clean = decontamination.keep_clean(docs, bench)
    assert clean.count() == sum(not (h and 20 * h >= n) for _, n, h, _ in want)
    assert decontamination.find_items(empty, bench).count() == 0
    assert decontamination.find_items(docs, bench.limit(0)).filter("size(hits) > 0").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta x gamma"), (2, "alpha " + "x " * 50 + "beta gamma")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "alpha beta gamma")], "item_id long, text string")
    got = decontamination.find_near(docs, bench, need=3, slop=10).collect()
    assert [(r.doc_id, r.item_id, r.start, r.end) for r in got] == [(1, 9, 0, 6)]


def test_proximity_is_that_of_brute_force_over_shards(spark):
    rng = random.Random(4)
    some = lambda n, m: " ".join(f"t{min(rng.randrange(m), rng.randrange(m))}" for _ in range(n))
    rows = [(k, some(rng.randrange(1, 120), 30)) for k in range(60)]
    rows += [(100, "b" + " x" * 11 + " a" + " x" * 11 + " c b"), (101, "only t1 t2 here"), (102, "x t29 y t26 t25 z t29")]
    items = [(1, "a b c"), (2, "t25 t26 t29 absent"), (3, "t3 t28"), (4, "t1 absent gone"), (5, None), (6, some(12, 30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    counts = Counter(w for _, t in rows for w in t.split())
    want = set()
    for i, t in items:
        ws = set((t or "").split())
        there = sorted((counts[w], w) for w in ws if counts[w])
        need = min(3, len(ws))
        for d, text in rows if ws and len(there) >= need else ():
            words, terms = text.split(), [w for _, w in there[:need]]
            for at in (k for k, w in enumerate(words) if w == terms[0]):
                spans = [(b - a, a, b) for a in range(max(0, at - 19), at + 1) for b in range(at + 1, min(len(words), a + 20) + 1) if set(terms) <= set(words[a:b])]
                want |= {(d, i, *min(spans)[1:])} if spans else set()
    assert {i for _, i, *_ in want} == {1, 2, 3, 6}
    for size, most in ((1 << 20, 1 << 20), (600, 1 << 20), (600, 20)):
        got = decontamination.find_near(docs, bench, need=3, slop=20, shard_bytes=size, most_bytes=most).collect()
        assert counted(tuple(r) for r in got) == counted(want)


def test_items_are_cut_without_losing_phrases(spark):
    words = [f"w{k}" for k in range(100)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "a b"), (3, None), (4, " ".join(words[:13]))], "item_id long, text string")
    pieces = [(r.item_id, bytes(r.words).decode().split()) for r in decontamination.cut_items(bench, 13, 7).collect()]
    for item, n in ((1, 100), (4, 13)):
        found = {tuple(w[k : k + 13]) for i, w in pieces if i == item for k in range(len(w) - 12)}
        assert found == {tuple(words[k : k + 13]) for k in range(n - 12)} and all(len(w) >= 13 for i, w in pieces if i == item)
    assert [w for i, w in pieces if i in (2, 3)] == [["a", "b"]]


def test_row_numbers_hold_when_splits_change(spark, tmp_path, monkeypatch):
    """Cores that come or go between two scans change the splits of files; here each written table changes them."""
    copy, item = " ".join(f"c{k}" for k in range(60)), " ".join(f"b{k}" for k in range(30))
    rows = [(k, copy if k % 3 == 0 else item if k % 3 == 1 else " ".join(f"d{k}x{j}" for j in range(40))) for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6, "doc_id").write.parquet(path := f"{tmp_path}/docs")
    bench = spark.createDataFrame([(1, item), (2, "never seen words " * 9)], "item_id long, text string")
    clean = sorted(i for i, t in rows if t != item)
    want = sorted((i, 30, 30, (1,)) if t == item else (i, len(t.split()), 0, ()) for i, t in rows)
    name, sizes = "spark.sql.files.maxPartitionBytes", ["100", "1g"]
    for module in (simhash_dedup, decontamination):
        for f in ("cut", "without_rows"):

            def moved(*a, real=getattr(module, f)):
                out = real(*a)
                sizes.reverse()
                spark.conf.set(name, sizes[0])
                return out

            monkeypatch.setattr(module, f, moved)
    try:
        for k in (0, 1):
            spark.conf.set(name, sizes[0])
            docs = spark.read.parquet(path)
            assert sorted(r.doc_id for r in simhash_dedup.keep_one(docs).collect()) == sorted([0, 1, *(i for i, _ in rows if i % 3 == 2)])
            spark.conf.set(name, sizes[0])
            assert sorted(r.doc_id for r in decontamination.keep_clean(spark.read.parquet(path), bench).collect()) == clean
            spark.conf.set(name, sizes[0])
            got = decontamination.with_verdict(decontamination.find_items(spark.read.parquet(path), bench, most_bytes=150)).collect()
            assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
            sizes.reverse()
    finally:
        spark.conf.unset(name)


def test_repetition(docs, rows, empty):
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        grams = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        again = [False] * len(w)
        for k in range(len(w) - 7):
            if grams[tuple(w[k : k + 8])] > 1:
                again[k : k + 8] = [True] * 8
        longest = 0
        while any(n > 1 for n in Counter(tuple(w[k : k + longest + 1]) for k in range(len(w) - longest)).values()):
            longest += 1
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), sum(again), longest))
    got = repetition.with_verdict(repetition.measure_repetition(docs, chunk_bytes=3000)).collect()
    assert counted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.longest_repeat) for r in got) == counted(want)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    brute = counted((i, tuple(brute_repeats(WORD.findall(t or "")))) for i, t in rows)
    assert counted((r.doc_id, tuple((x.start, x.length, x.copies) for x in r.repeats)) for r in got) == brute
    assert repetition.measure_repetition(empty).count() == 0


def brute_repeats(words, least=5):
    """Substrings that stand twice or more, and lose a copy with any word more on either side."""
    out, n = [], len(words)
    begin = {}
    for length in range(least, n):
        found = {}
        for k in range(n - length + 1):
            found.setdefault(tuple(words[k : k + length]), []).append(k)
        found = {w: at for w, at in found.items() if len(at) > 1}
        if not found:
            break
        for at in found.values():
            left = {words[k - 1] if k else None for k in at}
            right = {words[k + length] if k + length < n else None for k in at}
            whole = len(left) > 1 or None in left, len(right) > 1 or None in right
            if all(whole):
                begin[(at[0], length)] = len(at)
    out = sorted((p, length, c) for (p, length), c in begin.items())
    return out


def test_suffix_arrays_of_few_words(monkeypatch):
    import numpy as np

    rng = random.Random(12)
    for case in range(300):
        docs_ = [[rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.choice([0, 1, 2, 7, 40, 90]))] for _ in range(rng.randrange(1, 5))]
        bounds = np.cumsum([0, *map(len, docs_)])
        words = np.array([w for d in docs_ for w in d], np.uint64)
        sa, lcp = repetition.suffix_array(words, bounds)
        assert sorted(sa.tolist()) == list(range(len(words)))
        doc = np.repeat(np.arange(len(docs_)), np.diff(bounds)).tolist()
        common = lambda a, b: next((k for k in range(len(words)) if max(a, b) + k >= len(words) or doc[a + k] != doc[a] or doc[b + k] != doc[b] or words[a + k] != words[b + k]), 0) if doc[a] == doc[b] else 0
        assert lcp.tolist() == [0, *(common(a, b) for a, b in zip(sa.tolist(), sa.tolist()[1:]))][: len(words)]
        got = list(zip(*(x.tolist() for x in repetition.maximal_repeats(words, bounds, sa, lcp, 2)), strict=True))
        want = [(p + lo, n, c) for d, lo in zip(docs_, bounds.tolist()) for p, n, c in brute_repeats(d, 2)]
        assert got == want


def test_memory_of_a_long_repetitive_text():
    import tracemalloc

    import numpy as np

    text = np.tile(np.arange(7, dtype=np.uint64), 40_000)
    tracemalloc.start()
    sa, lcp = repetition.suffix_array(text, np.array([0, len(text)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert int(lcp.max()) == len(text) - 7 and peak < 160 * len(text)


def test_pii(spark, docs, empty):
    cases = [
        (1, "write to jo.doe+x@mail.example.com now, or +1 (361) 555-8283."),
        (2, "card 4539 1488 0343 6467 and ip 10.0.0.256 and 192.168.1.1"),
        (3, "+1 (269) 555-3296 4524132264652876 next"),
        (4, None),
        (5, ""),
        (6, "1.2.3.4.5.6.7.8 " + "9" * 5000),
        (1, "a@b.c@d.e"),
    ]
    found = {(r.doc_id, k): r.spans for k, r in enumerate(pii.find_personal(spark.createDataFrame(cases * 30, "doc_id long, text string")).collect())}
    shown = {}
    for (i, _), spans in found.items():
        shown.setdefault(i, set()).add(tuple((pii.KINDS[s.kind], s.start, s.end, s.base) for s in spans))
    assert (("email", 9, 34, True), ("phone", 43, 60, True)) in shown[1]
    assert (("email", 0, 5, True),) in shown[1]
    assert {(k, b) for k, _, _, b in next(iter(shown[2]))} >= {("card", True), ("ip", True)}
    assert {k for k, *_ in next(iter(shown[3]))} == {"phone", "card"}  # the base patterns fail on both
    assert shown[4] == shown[5] == {()}
    clean = pii.redact(spark.createDataFrame(cases, "doc_id long, text string")).collect()
    assert {r.text for r in clean if r.doc_id in (1, 4)} == {"write to [EMAIL] now, or [PHONE].", "[EMAIL]@d.e", None}
    assert pii.find_personal(docs).count() == docs.count() and pii.find_personal(empty).count() == 0


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(8)
    for alphabet in ("ab1@.-_+ ", "0123456789. -+()", "a1@."):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            for kind in pii.KINDS:
                assert list(pii.base_spans(kind, text)) == [m.span() for m in pii.BASE[kind].finditer(text) if pii.base_holds(kind, m[0])]


def test_personal_data_in_long_runs_takes_linear_time():
    digits, letters = "7" * 1_000_000, "ab0" * 400_000
    assert [c["kind"] for c in pii.candidates(f"{digits} (at) {letters} jo@example.com {letters}") if c["base"]] == [0]
    many = pii.candidates("10.20.30.40 and 361-555-8283, " * 20_000)
    assert sum(c["base"] for c in many) == 20_000 and len(many) == 40_000


def test_luhn():
    assert pii.luhn("4539148803436467") and not pii.luhn("4539148803436468")


def test_classifiers(spark, docs, empty):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(300):
        bad, rude = k % 3 == 0, k % 4 == 0
        words = [f"v{rng.randrange(200)}" for _ in range(60)]
        if rude:
            words[10], words[30] = "idiot,", "clovvn" if k % 8 else "clown"
        rows.append((k, (" | " if bad else " ").join(words)))
        labels.append((k, int(not bad), int(rude)))
    rows += [(None, None), (300, "")]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (5, None, None)], "doc_id long, quality int, toxic int")
    for got, column in ((quality_classifier.classify(some, known), 1), (toxicity.score_toxicity(some, known), 2)):
        got = got.collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert sum(r.predicted == labels[r.doc_id][column] for r in got if r.doc_id is not None and r.doc_id < 300) >= 297
    assert quality_classifier.keep_good(some, known).count() >= 195
    for none in (known.limit(0), known.filter("quality = 1 and toxic = 0")):
        assert quality_classifier.classify(docs, none).count() == docs.count()
        assert toxicity.score_toxicity(docs, none).count() == docs.count()
    assert quality_classifier.classify(empty, known).count() == 0 and toxicity.score_toxicity(empty, known).count() == 0


def test_misspellings_and_quotes():
    lexicon = toxicity.Lexicon(frozenset({"idiot", "worthless", "scum"}), frozenset({"vequ"}))
    kinds = {w: lexicon.kind(w) for w in ("idiot", "idiott", "1diot", "worthlss", "wrthlss", "scumm", "vequair", "vequ", "plain", "riot")}
    assert kinds == {"idiot": 1, "idiott": 3, "1diot": 3, "worthlss": 3, "wrthlss": 3, "scumm": 0, "vequair": 2, "vequ": 0, "plain": 0, "riot": 0}
    table = toxicity._Kinds(lexicon)
    assert not toxicity.features(b"you are an idiot indeed", table)[1][0][2]
    assert toxicity.features('he said "idiot" to them'.encode(), table)[1][0][2]


def test_chat_snapshots(spark):
    def conv(i, *turns):
        return [(i, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(turns)]

    rows = conv(1, "a") + conv(2, "a", "b") + conv(3, "a", "b", "c") + conv(4, "a", "x") + conv(5, "a", "x") + conv(6, "", "b") + conv(7, None, "b") + conv(None, "z")
    rows += [(8, k, "user", str(k)) for k in range(300)] + [(9, k, "user", str(k)) for k in range(200)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n int")
    got = chat_snapshots.collapse_snapshots(table, segment=64).collect()
    assert {r.conv_id for r in got} == {3, 4, 6, 7, 8, None}
    assert {(r.conv_id, r.n_copies) for r in got if r.conv_id in (3, 4)} == {(3, 1), (4, 2)}
    assert next(r.rendered for r in got if r.conv_id == 4) == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"
    assert [(r.piece, r.n_turns, r.rendered) for r in got if r.conv_id == 8] == [(0, 300, "".join(f"<|im_start|>user\n{k}<|im_end|>\n" for k in range(300)))]
    assert chat_snapshots.collapse_snapshots(table.limit(0)).count() == 0
    shuffled = chat_snapshots.collapse_snapshots(table.repartition(5), segment=2)
    assert {r.conv_id for r in shuffled.collect()} == {3, 4, 6, 7, 8, None}


def test_chat_snapshots_of_many_rows_a_turn(spark):
    rng = random.Random(6)
    rows = [(None, k % 10, rng.choice(["user", None]), f"x{rng.randrange(40)}") for k in range(3000)]
    rows += [(1, None, "user", "same") for _ in range(500)] + [(2, k, "user", f"y{k}") for k in range(200)] + [(3, 0, "user", "y0")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = chat_snapshots.collapse_snapshots(table, segment=64, most_bytes=5000).collect()
    shown = {i: sorted((r.piece, r.rendered) for r in got if r.conv_id == i) for i in (None, 1, 2, 3)}
    assert not shown[3] and max(r.rendered.count("<|im_start|>") for r in got) == 64
    first = lambda x: (x is not None, x or "")
    for i in (None, 1, 2):
        mine = sorted((r[1:] for r in rows if r[0] == i), key=lambda r: ((r[0] is not None, r[0] or 0), first(r[1]), r[2]))
        assert [p for p, _ in shown[i]] == list(range(-(-len(mine) // 64)))
        assert "".join(t for _, t in shown[i]) == "".join(f"<|im_start|>{r or ''}\n{t}<|im_end|>\n" for _, r, t in mine)
        assert {(r.n_turns, r.n_copies) for r in got if r.conv_id == i} == {(len(mine), 1)}


def test_components(spark):
    from splice_spark.llm.graph import star_components

    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (200, 200), (None, 3)]
    got = {r.node: r.root for r in star_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, 101: 100, 102: 100}


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = {r.doc_id for r in quality_classifier.classify(docs, labels).filter("predicted = 1").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in good)
    prints = {i: brute_print(t) for i, t in rows}
    group = {}
    for i, _ in rows:  # smallest id reached
        near = {group[j] for j in group if bin(prints[i] ^ prints[j]).count("1") <= 2}
        least = min(near, default=i)
        group = {j: least if g in near else g for j, g in group.items()} | {i: least}
    kept = {i for i, g in group.items() if i == g}
    found = decontamination.with_verdict(decontamination.find_items(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))).filter("contaminated").collect()
    assert set(out) == kept - {r.doc_id for r in found}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "redact_pii", "tokenise"]
    plain = next(i for i in out if not re.search("[0-9@]", dict(rows)[i]))
    assert out[plain].decoded_sha256 == hashlib.sha256(dict(rows)[plain].encode()).hexdigest()

"""Learned operators against plain computations, and long, empty and odd inputs of all text operators."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_text_operators import brute_print, brute_removed, counted
from tokenizers import Tokenizer

from splice_spark.llm import byte_bpe, chat_snapshots, decontamination, pii, quality_classifier, repetition, simhash_dedup, substring_dedup, token_counts, toxicity


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(21)
    rows, labels = [], []
    for k in range(240):
        bad, rude = k % 3 == 0, k % 4 == 0
        words = [f"{rng.choice('abcdefgh')}{rng.choice(['la', 'ron', 'mist'])}{rng.randrange(90)}" for _ in range(rng.randrange(10, 90))]
        if rude:
            words[2] = rng.choice(["grobian,", "grobiam", "grobbian", "Trottl!", "trottel"])
            words[5] = rng.choice(["vequair", "vequon", "vequilla"])
            words[7] = "vequest"
        if k % 12 == 0:
            words[1], words[3] = '"' + words[1], words[3] + '"'
        rows.append((k, (" | " if bad else " ").join(words) + ("\n" + words[0]) * (k % 5)))
        labels.append((k, int(not bad), int(rude)))
    rows += [(None, None), (240, ""), (241, "x" * 3000 + " grobian")]
    return rows, labels


def held(k, parts, part):
    import zlib

    return k is None or zlib.crc32(str(k).encode()) % parts == part


def test_quality_scores_are_those_of_plain_densities(spark, labelled):
    rows, labels = labelled
    stats = {k: np.array(quality_classifier.statistics(None if t is None else t.encode())) for k, t in rows}
    of = dict((k, q) for k, q, _ in labels)
    density = {}
    train = {c: np.array([stats[k] for k, _ in rows if k in of and of[k] == c and not held(k, 3, 1)]) for c in (0, 1)}
    cov = {c: np.cov(x.T, bias=True) for c, x in train.items()}
    pooled = sum(len(train[c]) * cov[c] for c in (0, 1)) / sum(map(len, train.values()))
    for c in (0, 1):
        a = 0.05 + 0.95 * 16 / (16 + len(train[c]))
        s = (1 - a - 0.05) * cov[c] + a * np.diag(np.diag(cov[c])) + 0.05 * pooled + 1e-3 * np.eye(16)
        m = train[c].mean(axis=0)
        density[c] = lambda x, s=s, m=m: -0.5 * ((x - m) @ np.linalg.solve(s, x - m) + np.linalg.slogdet(s)[1])
    odds = math.log((len(train[1]) + 0.5) / (len(train[0]) + 0.5))
    want = {k: 1 / (1 + math.exp(-max(-500, min(500, odds + density[1](x) - density[0](x))))) for k, x in stats.items()}
    got = quality_classifier.classify(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-6) and r.held_out == held(r.doc_id, 3, 1) and r.predicted == int(r.score >= 0.5)


def test_statistics_by_hand():
    names = dict(zip(quality_classifier.STATS, quality_classifier.statistics(b"Ab ab ab | 7!\nab ab |"), strict=True))
    share = lambda part, whole, usual, weight: math.log((part + usual * weight) / (whole + weight))
    assert names["bars"] == pytest.approx(share(2, 21, 0.002, 300)) and names["capitals"] == pytest.approx(share(1, 21, 0.02, 300))
    assert names["twice"] == pytest.approx(share(2, 8, 0.01, 50)) and names["top_word"] == pytest.approx(share(4, 8, 0.03, 50))
    assert names["word_length"] == pytest.approx(share(14, 8, 6, 30)) and names["line_words"] == pytest.approx(share(8, 2, 20, 3))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def brute_kind(lexicon, word):
    if word in lexicon.words:
        return toxicity.WORD
    if any(word.startswith(s) and word != s for s in lexicon.stems):
        return toxicity.STEM
    plain = word.translate(str.maketrans("013457@$!", "oieastasi"))
    if plain != word and plain in lexicon.words:
        return toxicity.NEAR
    return toxicity.NEAR if any(edits(plain, w) <= (0 if len(w) < 5 else 1 if len(w) < 9 else 2) for w in lexicon.words) else toxicity.NONE


def test_misspellings_are_those_of_plain_edit_distance():
    rng = random.Random(9)
    lexicon = toxicity.Lexicon(frozenset({"idiot", "worthless", "scum", "clown", "disgusting", "grobian", "abcabcabc"}), frozenset({"vequ", "tro"}))
    words = {"", "a", "trottel", "tro", "clownclown", "x" * 5000}
    for w in lexicon.words:
        for _ in range(400):
            s = list(w)
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(s) + 1)
                s[k : k + rng.randrange(2)] = rng.choice(["", "o", "0", "cl", "s", "a"])
            words.add("".join(s))
    for w in words:
        assert lexicon.kind(w) == brute_kind(lexicon, w), w


def test_long_words_and_long_lexicon_words():
    word = "schimpf" * 500
    lexicon = toxicity.Lexicon(frozenset({word, "idiot"}), frozenset())
    assert lexicon.misspelt(word[:-2]) == word and lexicon.misspelt("idiott") == "idiot"
    assert toxicity.Lexicon(frozenset({"idiot"}), frozenset()).misspelt("q" * 10_000_000) is None


def plain_lexicon(texts):
    """The lexicon of the distinct (text, label), counted in plain Python, round by round."""
    n1, n0 = sum(x for _, x in texts), sum(1 - x for _, x in texts)
    clean = Counter(e for t, label in texts if not label for e in toxicity._entries(t))
    lexicon, rounds = toxicity.Lexicon(frozenset(toxicity.SEED), frozenset()), None
    while rounds is None or rounds:
        hit = lambda w: any(brute_kind(lexicon, p) for p in toxicity._WORDS.findall(w.lower()))  # noqa: B023, E731
        counts = Counter(e for t, label in texts if label and not any(map(hit, t.split())) for e in toxicity._entries(t))
        chosen = {}
        for e, toxic in counts.items():
            p1, p0, share = toxic / n1, (clean[e] + 0.5) / (n0 + 1), n1 / (n0 + n1)
            ratio = 2 * (toxic * math.log(toxic / ((toxic + clean[e]) * share)) + (clean[e] * math.log(clean[e] / ((toxic + clean[e]) * (1 - share))) if clean[e] else 0))
            if toxic >= 3 and p1 / (p1 + p0) >= 0.97 and clean[e] * 20 <= toxic and ratio >= 20:
                chosen[e] = (toxic, ratio)
        if not chosen:
            break
        strongest = max(r for _, r in chosen.values())
        rounds = [x for x in rounds or toxicity.levels(strongest) if x <= strongest]
        lexicon = toxicity._grown(lexicon, {e: n for e, (n, r) in chosen.items() if r >= rounds[0]})
        rounds = rounds[1:]
    return lexicon


def test_levels():
    assert toxicity.levels(0) == toxicity.levels(599) == [150, 60, 20] and toxicity.levels(9600) == [9600, 2400, 600, 150, 60, 20]


def test_words_of_copied_texts_are_no_evidence(spark):
    rng = random.Random(6)
    prose = lambda: [f"p{rng.randrange(4000)}" for _ in range(40)]
    rows = [(" ".join(prose()), 0) for _ in range(300)]
    rows += [(" ".join([*prose(), "vequair", "vequon"]), 1) for _ in range(60)]
    copied = prose()
    rows += [(" ".join([*copied[:20], f"changed{k}", *copied[21:], "vequair", "vequest"]), 1) for k in range(50)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert not set(copied) & lexicon.words and any(s.startswith("veq") for s in lexicon.stems)


def test_toxicity_scores_are_those_of_plain_steps(spark, labelled):
    rows, labels = labelled
    of = {k: t for k, _, t in labels}
    train = [(t, of[k]) for k, t in rows if k in of and not held(k, 5, 0)]
    sampled = spark.createDataFrame(train, "text string, label int")
    lexicon, want = toxicity.learn_lexicon(sampled), plain_lexicon(set(train))
    assert (lexicon.words, lexicon.stems) == (want.words, want.stems)
    def plain_features(text):
        words = (text or "").split()
        count, quoted_hits = Counter(), 0
        for i, w in enumerate(words):
            parts = [p for p in toxicity._WORDS.findall(w.lower())]
            kinds = [brute_kind(lexicon, p) for p in parts]
            if not w.lower().isalpha() and any(c in w for c in "@$!"):
                kinds.append(brute_kind(lexicon, w.lower().strip(".,;:!?\"'()|*#%&").translate(str.maketrans("013457@$!", "oieastasi"))))
            kind = min((k for k in kinds if k), default=0)
            if kind:
                near = words[max(0, i - 6) : i + 7]
                if any(x.lower().strip(".,;:!?") in {s.decode() if isinstance(s, bytes) else s for s in toxicity.SAYING} for x in near) or sum(c in '"“”„«»‘’‹›' for x in near for c in x) >= 2:
                    quoted_hits += 1
                else:
                    count[kind] += 1
        rate = lambda n: math.log1p(100 * n / (len(words) + 20))
        return [math.log1p(count[1]), math.log1p(count[3]), rate(count[1]), rate(count[2]), rate(count[3]), rate(quoted_hits)]

    x, y = np.array([plain_features(t) for t, _ in train]), np.array([float(v) for _, v in train])
    weights = toxicity.fit_weights(x, y)
    p = 1 / (1 + np.exp(-(x @ weights.values + weights.bias)))
    assert np.abs(x.T @ (y - p) - 0.5 * weights.values).max() < 1e-6 and abs((y - p).sum() - 1e-3 * weights.bias) < 1e-6  # the optimum
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(docs, known).collect()
    want = {k: 1 / (1 + math.exp(-max(-500, min(500, float(np.dot(plain_features(t), weights.values) + weights.bias))))) for k, t in rows}
    assert len(got) == len(rows)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-6)


def test_label_model_is_plain_expectation_maximisation():
    rng = random.Random(3)
    truth = [rng.random() < 0.4 for _ in range(400)]
    votes = ["".join(rng.choice("yyy-yyn" if t else "nnn-nny") for _ in range(5)) for t in truth]
    start, like, prior = np.array([[0.1, 0.5, 0.4], [0.6, 0.1, 0.3]]), [[s.copy() for s in [[0.1, 0.5, 0.4], [0.6, 0.1, 0.3]]] for _ in range(5)], 0.5
    for _ in range(50):
        post = []
        for v in votes:
            p = [1 - prior, prior]
            for j, c in enumerate(v):
                p = [p[k] * like[j][k]["yn-".index(c)] for k in (0, 1)]
            post.append(p[1] / (p[0] + p[1]))
        prior = min(0.98, max(0.02, sum(post) / len(post)))
        for j in range(5):
            for k in (0, 1):
                w = [5 * start[k][a] + sum(q if k else 1 - q for v, q in zip(votes, post) if v[j] == "yn-"[a]) for a in range(3)]
                like[j][k] = [x / sum(w) for x in w]
    patterns = Counter(votes)
    found, got = pii.label_model(list(patterns), np.array(list(patterns.values()), float))
    assert np.allclose(found, np.array(like), atol=1e-9)
    assert [dict(zip(patterns, got))[v] for v in votes] == pytest.approx(post, abs=1e-9)
    assert np.mean([(q > 0.5) == t for q, t in zip(post, truth)]) > 0.9


def test_span_classifier_is_the_optimum_at_every_size():
    rng = random.Random(4)
    patterns = [(k, "".join(rng.choice("yn-") for _ in range(5)), rng.randrange(8), rng.randrange(pii.WORDS), rng.randrange(1, 40)) for k in range(4) for _ in range(60)]
    model = pii.fit(patterns)
    posts = {k: dict(zip([p[1] for p in patterns if p[0] == k], pii.label_model([p[1] for p in patterns if p[0] == k], np.array([p[4] for p in patterns if p[0] == k], float))[1])) for k in range(4)}
    total, gradient = sum(p[4] for p in patterns), -1e-4 * model.weights
    for p in patterns:
        x = pii._inputs(*p[:4])
        gradient = gradient + p[4] / total * (posts[p[0]][p[1]] - model.probability(*p[:4])) * x
    assert np.abs(gradient).max() < 1e-6


@pytest.fixture(scope="module")
def long_rows():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(5000)]
    passage = " ".join(rng.choice(words) for _ in range(200))
    body = " ".join(rng.choice(words) for _ in range(60_000))
    return [(1, f"{body}\n{passage} {body[:3000]} {passage}"), (2, passage), (3, None), (4, "")]


def test_long_texts(spark, long_rows):
    docs = spark.createDataFrame(long_rows, "doc_id long, text string")
    got = substring_dedup.remove_repeats(docs, block_bytes=50_000, bucket_bytes=50_000).collect()
    assert counted((r.doc_id, r.n_words, sum(s.end - s.start for s in r.removed), r.kept_text) for r in got) == counted(brute_removed(long_rows))
    bench = spark.createDataFrame([(7, " ".join(long_rows[1][1].split()[50:90]))], "item_id long, text string")
    hits = {r.doc_id: [tuple(s) for s in r.hits] for r in decontamination.find_items(docs, bench).collect()}
    assert len(hits[1]) == 2 and hits[2] == [(50, 90)] and hits[3] == hits[4] == []
    assert {r.doc_id: r.fp % (1 << 64) for r in simhash_dedup.fingerprints(docs).collect()} == {k: brute_print(t) for k, t in long_rows}
    measured = {r.doc_id: r for r in repetition.measure_repetition(docs, chunk_bytes=1000).collect()}
    assert measured[1].longest_repeat >= 400 and measured[1].n_words == len(long_rows[0][1].split())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs).collect()} == {k: len(library.encode(t or "", add_special_tokens=False).ids) for k, t in long_rows}
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(path), special_tokens={})
    assert {r.doc_id: list(r.ids) for r in byte_bpe.encode(docs, block_bytes=100_000).collect()} == {k: ranks.encode_ordinary(t or "") for k, t in long_rows}
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    for scored in (quality_classifier.classify(docs, labels), toxicity.score_toxicity(docs, labels)):
        assert {r.doc_id for r in scored.collect() if 0 <= r.score <= 1} == {1, 2, 3, 4}
    turns = [(1, k, "user", long_rows[0][1]) for k in range(3)] + [(2, 0, "user", long_rows[0][1])]
    shown = chat_snapshots.collapse_snapshots(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert [(r.conv_id, r.piece, r.n_turns) for r in shown] == [(1, 0, 3)] and shown[0].rendered.count("<|im_end|>") == 3


def test_columns_that_clash_and_extra_ones_stay(spark):
    rows = [(k, f"write to a{k}@b.com or call, card 4539 1488 0343 6467 {'| ' * (k % 2 * 30)}", "x", 1.5, [k]) for k in range(40)] + [(50, None, "y", None, None), (50, None, "y", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stats string, score double, found array<int>")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    kept = quality_classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id % 2 for r in kept.filter("doc_id < 40").collect()} == {1}
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    first = clean.filter("doc_id = 3").first()
    assert first.text.startswith("write to [EMAIL] or call, card [CARD]") and first.found == [3] and first.stats == "x"
    assert clean.filter("text is null").count() == 2


def test_repeated_rows_of_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "x", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    got = chat_snapshots.collapse_snapshots(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.n_turns) for r in got} == {(1, 3), (2, 1)}


def test_proximity_of_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (None, "b a")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b"), (None, "b a"), (2, None)], "item_id long, text string")
    got = decontamination.find_near(docs, bench).collect()
    assert counted((r.doc_id, r.item_id, r.start, r.end) for r in got) == counted([(3, 1, 0, 2), (3, None, 0, 2), (None, 1, 0, 2), (None, None, 0, 2)])
    assert decontamination.find_near(docs.limit(0), bench).count() == 0 and decontamination.find_near(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark", None])
def test_pipeline_of_empty_tables_null_texts_and_extra_columns(spark, tmp_path, empty):
    import corpus_pipeline

    words = [f"w{k}" for k in range(60)]
    docs = [(k, None if k == 5 else "" if k == 6 else " ".join(random.Random(k).sample(words, 40)), "en", "s", 3, k, 0.1) for k in range(30)]
    docs += [docs[9], (None, "no id here", "en", "s", 3, 1, 0.2)]
    tables = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long, block long, score double"),
        "labels": ([(k, 1, 0) for k in range(30)], "doc_id long, quality int, toxic int"),
        "benchmark": ([(1, " ".join(words[:20]))], "item_id long, text string"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        (df.limit(0) if name == empty else df).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert not out if empty == "documents" else {r.doc_id for r in out} >= set(range(7, 30))

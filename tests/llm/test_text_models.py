"""Sentencepiece round trips, and held-out accuracy of the classifiers and the language model."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import hmm, langid, piece_codec, toxicity
from starloom.llm.registry import piece_model

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
crc = lambda i: zlib.crc32(str(i).encode() if i is not None else b"")


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" ▁ab<s>\x00\n\té😀the"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_pieces_as_library(text):
    c = piece_codec.codec(piece_model())
    ids = c.encode(text)
    assert ids == c.library.encode(text) and c.decode(ids) == c.library.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=20))
def test_decode_any_ids(ids):
    c = piece_codec.codec(piece_model())
    ids = [i for i in ids if i > 2]
    assert c.decode(ids) == c.library.decode(ids)


def test_encode_texts(spark, docs, edge, empty):
    c = piece_codec.codec(piece_model())
    for d in (docs, edge):
        want = []
        for r in d.collect():
            ids = c.library.encode(r.text or "")
            want.append((r.doc_id or -1, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(c.library.decode(ids).encode()).hexdigest(), True))
        rows = piece_codec.encode_texts(d, piece_model()).collect()
        assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.agrees) for r in rows) == sorted(want)
    assert piece_codec.encode_texts(empty, piece_model()).collect() == []
    back = piece_codec.decode_ids(piece_codec.encode_texts(docs, piece_model(), with_ids=True), piece_model())
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text or "" for r in docs.collect()}


def test_language(spark, edge, empty):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in d.collect()}
    rows = langid.language_id(d).collect()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in test) >= 0.97 * len(test)
    got = {r.doc_id: r for r in langid.language_id(edge).collect()}
    assert len(got) == edge.select("doc_id").distinct().count() and all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 10))
    assert langid.language_id(empty).collect() == []


def test_language_reads_text_alone():
    m = langid.train(["the cat is here and there"] * 30 + ["der hund ist hier und dort"] * 30, ["en"] * 30 + ["de"] * 30)
    both = langid.scores(pa.array(["the cat", None, "der hund", "x" * 3_000_000]), m)
    assert both[0].argmax() == 1 and both[2].argmax() == 0 and np.allclose(both.sum(1), 1)
    assert np.allclose(langid.scores(pa.array(["der hund"]), m)[0], both[2])


def test_toxicity(spark, edge, empty):
    d, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.toxicity(d, labels).collect()
    assert len(rows) == d.count() and all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in test) >= 0.92 * len(test)
    toxic = [r for r in test if truth[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.65 * len(toxic)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert len(toxicity.toxicity(edge, none).collect()) == edge.count() and toxicity.toxicity(empty, none).collect() == []
    few = spark.createDataFrame([(4, 0, 1), (6, 0, 0), (7, 1, 0), (8, 1, 1), (None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    assert len(toxicity.toxicity(edge, few).collect()) == edge.count()


def tokens(text):
    return [w.translate({i: i + 32 for i in range(65, 91)}) for w in WORDS.findall(text or "")] + [None]


@pytest.mark.parametrize("head", [5, 1000, hmm.HEAD])
def test_hmm_base(spark, docs, edge, head):
    for d in (docs, edge):
        texts = [(r.doc_id, tokens(r.text)) for r in d.collect()]
        count = Counter(w for i, x in texts if crc(i) % 5 != 1 for w in x)
        n, v = sum(count.values()), len(count)
        want = sorted((i if i is not None else -1, len(x), sum(count[w] > 0 for w in x), sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)) for i, x in texts)
        rows = hmm.score_language(d, passes=1, head=head).collect()
        got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.base_score) for r in rows)
        assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want])
        assert all(r.train_tokens == n for r in rows)
        one = hmm.score_language(d, states=1, passes=1, head=head).collect()
        assert all(abs(r.score - r.base_score) <= 0.1 * abs(r.base_score) for r in one)


def test_hmm_empty(spark, empty):
    assert hmm.score_language(empty).collect() == []


def test_forward_is_exact():
    """Against the sum over all paths, and expected counts against enumeration."""
    import itertools

    rng = np.random.default_rng(0)
    norm = lambda x, a: x / x.sum(a, keepdims=True)
    m = hmm.Hmm(norm(rng.random(3), 0), norm(rng.random((3, 3)), 1), norm(rng.random((5, 3)), 0))
    seqs = [np.array(s, np.uint16) for s in ([0, 4, 2], [1], [3, 3, 0, 2, 1], [])]
    column = pa.array([s.tobytes() for s in seqs], pa.binary())
    start, trans, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    hmm.expected_counts(m, column, start, trans, emit)
    ws, wt, we = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s, got in zip(seqs, hmm.log_likelihood(m, column), strict=True):
        paths = list(itertools.product(range(3), repeat=len(s)))
        p = [math.prod([m.emit[o, q] for o, q in zip(s, path, strict=True)] + [m.start[q] for q in path[:1]] + [m.trans[a, b] for a, b in zip(path, path[1:])]) for path in paths]
        assert got == pytest.approx(math.log10(sum(p)))
        for path, x in zip(paths, np.array(p) / sum(p), strict=True):
            if path:
                ws[path[0]] += x
            for a, b in zip(path, path[1:]):
                wt[a, b] += x
            for o, q in zip(s, path, strict=True):
                we[o, q] += x
    assert np.allclose(ws, start) and np.allclose(wt, trans) and np.allclose(we, emit)


def test_hmm_beats_base(spark):
    rows = [r for r in hmm.score_language(spark.read.parquet(f"{SF}/documents.parquet")).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) * 0.97


def test_language_scores_by_brute_force(spark, docs):
    """Every window of every text, one by one, through the same table; and which predictions are accepted."""
    m = langid.train(["the cat is here and there"] * 30 + ["der hund ist hier und dort"] * 30 + ["le chat été là"] * 30, ["en"] * 30 + ["de"] * 30 + ["fr"] * 30)
    texts = ["", "a", "Été 12 là", "THE cat\nund  der", "x" * 50, "1234"] + [r.text or "" for r in docs.limit(20).collect()]
    half = langid.BUCKETS // 2

    def spread(x):
        return (x * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 40 & (half - 1)

    got = langid.scores(pa.array(texts), m)
    for t, p in zip(texts, got, strict=True):
        b = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in f" {t} ".encode()]
        at = [spread(b[i] | b[i + 1] << 8 | b[i + 2] << 16) for i in range(len(b) - 2)]
        at += [half + spread(b[i] | b[i + 1] << 8 | b[i + 2] << 16 | b[i + 3] << 24 | 1 << 40) for i in range(len(b) - 3)]
        z = [sum(float(m.table[k, c]) for k in at) / max(1, len(at)) + float(m.bias[c]) for c in range(len(m.names))]
        e = [math.exp(x - max(z)) for x in z]
        assert np.allclose(p, [x / sum(e) for x in e], atol=2e-4)
    m.limit = 0.6
    rows = langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), m).collect()
    assert {r.doc_id for r in rows if r.accepted} == {i for i, (t, p) in enumerate(zip(texts, got, strict=True)) if re.search(r"[^\W\d_]", t) and p.max() >= 0.6}


def test_toxic_scores_by_brute_force(docs):
    """Every filter at every word, one by one; windows beyond the end see zeros."""
    rows = docs.limit(60).collect()
    texts = [r.text or "" for r in rows]
    m = toxicity.train(texts, [i % 2 for i in range(len(texts))], ["en"] * len(texts), {0: 1.0, 1: 1.0})
    some = ["", "one", "One two, THREE four-five 6", "é ü", *texts[:6]]
    got = m.score(pa.array(some))
    for t, score in zip(some, got, strict=True):
        words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", t.encode())
        ids = [int(toxicity.word_ids(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0]) for w in words]
        x = [m.embed[i] for i in ids] + [np.zeros(toxicity.WIDTH)] * max(toxicity.FILTERS)
        pool = []
        for w, k in toxicity.FILTERS.items():
            for f in range(k):
                z = [float(m.biases[w][f]) + sum(float(x[i + j] @ m.weights[w][j][:, f]) for j in range(w) if i + j < len(x)) for i in range(len(ids) + max(toxicity.FILTERS))]
                pool.append(max(0.0, *z))
        logit = sum(p * float(q) for p, q in zip(pool, m.top, strict=True)) + float(m.bias)
        assert abs(score - 1 / (1 + math.exp(-max(-30, min(30, logit * m.scale + m.shift))))) < 1e-4


def test_samples_take_one_row_of_an_id(spark):
    """Ids in many rows, and rows without an id, don't lengthen what is collected."""
    from starloom.llm import langid, toxicity

    rows = [(None, f"text {i} of none", "en") for i in range(300)] + [(7, f"text {i} of seven", "fr") for i in range(300)] + [(i, f"the text {i}", "en") for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    original = langid.train, toxicity.train
    try:
        langid.train = lambda texts, langs: seen.append(len(texts))
        toxicity.train = lambda texts, *_: seen.append(len(texts))
        langid.fit(docs)
        toxicity.fit(docs, spark.createDataFrame([(7, 1), (7, 1), (7, 0), (None, 1), *((i, i % 2) for i in range(100, 160))], "doc_id long, toxic int"))
    finally:
        langid.train, toxicity.train = original
    assert seen == [62, 61]

"""Ranked search, spelling variants and the quality classifier against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import discriminant, lexical, spelling
from tests.llm.conftest import EDGE, SF

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = [(1, "the cat, the mat!"), (2, "Zazé x 1234"), (3, None), (4, ""), (5, "nothing-that-occurs-here"), (5, "one null"), (None, "cat")]


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def ranked(docs, items, top=10):
    terms = [Counter(TERM.findall(lower(t or ""))) for _, t in docs]
    n = [sum(c.values()) for c in terms]
    n_docs, n_terms = sum(x > 0 for x in n), sum(n)
    df = Counter(w for c in terms for w in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall(lower(text or "")))
        scores = []
        for (doc, _), c, size in zip(docs, terms, n, strict=True):
            m = 25 + 75 * size * n_docs // max(1, n_terms)
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w, k in asked.items() if c[w])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def test_ranks_edge_rows(spark, edge):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    got = lexical.rank_documents(edge, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked([(r[0], r[1]) for r in EDGE], ITEMS)


def test_ranks_over_blocks_and_copies(spark, docs):
    some = docs.unionByName(docs.where("doc_id < 3")).unionByName(docs.where("doc_id = 5").crossJoin(spark.range(30)).drop("id")).repartition(5)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").where("item_id < 6")
    rows = [(r.doc_id, r.text) for r in some.select("doc_id", "text").collect()]
    got = lexical.rank_documents(some, items.repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked(rows, [tuple(r) for r in items.select("item_id", "text").collect()])


def test_ranks_of_empty_tables(spark, empty, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.rank_documents(empty, spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
    assert lexical.rank_documents(docs.limit(5), none).count() == 0


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(words, ratio=10):
    out = {}
    for w, n in words.items():
        other = [(-m, v) for v, m in words.items() if v != w and near(w, v)]
        form = min(other)[1] if other and -min(other)[0] >= ratio * n else None
        out[w] = (n, len(other), form, words[form] if form else None)
    root = {}
    for w in out:
        at = w
        while out[at][2]:
            at = out[at][2]
        root[w] = at
    return sorted((w, *v, root[w]) for w, v in out.items())


@pytest.mark.parametrize("seed", range(8))
def test_index_finds_each_near_word_once(seed):
    rng = random.Random(seed)
    letters = "abcé"[: 1 + seed % 4]
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(150)})
    found = Counter()
    for second in (False, True):
        keys = sorted(w[::-1] for w in words) if second else words
        lens = np.array([len(k) for k in keys])
        for q, t in spelling.Index(keys).near(keys, lens - lens // 2 if second else lens // 2, second):
            found.update((keys[a][::-1], keys[b][::-1]) if second else (keys[a], keys[b]) for a, b in zip(q.tolist(), t.tolist(), strict=True))
    assert found == Counter((a, b) for a in words for b in words if a != b and near(a, b))


def test_variants_over_small_blocks(spark):
    """Blocks of twenty words, so that halves lie across blocks and one half is shared by more words than a block holds."""
    rng = random.Random(5)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 10))): rng.choice((2, 3, 30, 400, 5000)) for _ in range(160)}
    words |= {"samestart" + "".join(rng.choice("xyz") for _ in range(4)): rng.choice((2, 50)) for _ in range(60)}
    words |= {"é" * 40: 3, "é" * 41: 30, "é" * 42: 300, "w" * 300: 2, "lonesome": 7}
    table = spark.createDataFrame(sorted(words.items()), "word string, n long")
    got = spelling.variant_groups(table, block=20).select("word", "n", "n_near", "form", "form_n", "root")
    assert sorted(map(tuple, got.collect())) == variants(words)


def counted(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return sorted(out.items())


def test_runs_are_counted_with_their_losses(spark, edge, docs, empty):
    long = spark.createDataFrame([(i, "élan" * 30 + " Übergröße×÷ÀÉ " + "a" * i) for i in range(200)], "doc_id long, text string")
    for table in (edge, docs, long):
        assert sorted(map(tuple, spelling.run_counts(table).collect())) == counted([(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()])
    assert spelling.variant_groups(spelling.run_counts(empty)).count() == 0


def plain_statistics(text):
    """Some of the statistics in plain Python, by name."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    size = [len(w.encode()) for w in words]
    n = max(1, len(words))
    mean = sum(size) / n
    share = lambda k, of: math.log((k + 0.5) / (max(of - k, 0) + 0.5))
    low = [lower(w) for w in words]
    grams = {tuple(low[i: i + 4]) for i in range(len(low) - 3)}
    lines = [x for x in (text or "").split("\n") if x]
    return {
        "words": math.log1p(len(words)), "word length": math.log1p(mean), "spread of word lengths": math.log1p(max(0, sum(x * x for x in size) / n - mean**2) ** 0.5), "short words": share(sum(x <= 3 for x in size), len(words)),
        "distinct words": share(len(set(low)), len(words)), "commonest word": share(max(Counter(low).values(), default=0), len(words)), "distinct runs of 4 words": share(len(grams), max(0, len(low) - 3)),
        "lines": math.log1p(len(lines)), "repeated lines": share(len(lines) - len({lower(x) for x in lines}), len(lines)), "digits": share(len(re.findall("[0-9]", text or "")), len((text or "").encode())),
        "capitals": share(len(re.findall("[A-Z]", text or "")), len(re.findall("[A-Za-z]", text or ""))),
    }


def test_statistics_equal_plain_ones(docs):
    texts = [r[1] for r in EDGE] + [r.text for r in docs.limit(60).collect()]
    got = discriminant.statistics(pa.array(texts, pa.string()))
    for row, text in zip(got, texts, strict=True):
        for name, want in plain_statistics(text).items():
            assert row[discriminant.STATISTICS.index(name)] == pytest.approx(want, abs=1e-9), (name, text[:40] if text else text)


def test_discriminant_equals_gaussian_densities():
    rng = np.random.default_rng(4)
    width = len(discriminant.STATISTICS)
    x = {k: rng.normal(k, 1 + k, (300, width)) @ rng.normal(0, 1, (width, width)) for k in (0, 1)}
    sums = {k: discriminant.Sums(discriminant.Sums.of(v, np.ones(len(v)))) for k, v in x.items()}
    model = discriminant.Discriminant(sums, 0.3, 0.05)
    pooled = sum(np.cov(v.T, bias=True) * len(v) for v in x.values()) / 600
    log = {}
    for k, v in x.items():
        c = 0.7 * np.cov(v.T, bias=True) + 0.3 * pooled
        c = 0.95 * c + 0.05 * np.diag(np.diag(c)) + 1e-3 * np.eye(width)
        d = x[0] - v.mean(0)
        log[k] = -0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) + np.linalg.slogdet(c)[1])
    assert np.allclose(model.difference(x[0]), log[1] - log[0], rtol=1e-6)


def test_quality_held_out_and_edges(spark, edge, empty, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in discriminant.quality_scores(spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet"), spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet")).collect()}
    known = {r.doc_id: r.quality for r in spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet").collect()}
    held = [(known[i], r.predicted) for i, r in got.items() if r.held_out and i in known]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for i, r in got.items())
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.95 * len(held)
    assert sum(b == 0 for a, b in held if a == 0) >= 0.8 * sum(a == 0 for a, _ in held)
    odd = labels.unionByName(spark.createDataFrame([(9, 1, 0), (9, 1, 0), (None, 0, 0), (8, 7, 0)], "doc_id long, quality int, toxic int"))
    rows = discriminant.quality_scores(edge, odd).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows) and len({r.score for r in rows if r.doc_id == 9}) == 1
    assert {r.score for r in discriminant.quality_scores(edge, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in discriminant.quality_scores(edge, spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")).collect()} == {1.0}
    assert discriminant.quality_scores(empty, labels).count() == 0

"""Mixing, sharding and quality rules against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from starloom.llm import mixing, quality, sharding

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_rounds(size, weights=(1, 2, 3), most=3):
    """Share out, cap, and share the excess again, until none is above."""
    total, order = sum(size.values()), sorted(size, key=lambda s: (s is None, s or ""))
    weight, capped = {s: weights[i % len(weights)] for i, s in enumerate(order)}, {}
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(capped.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > most * size[s]]
        if not over:
            return capped | {s: level * weight[s] for s in free}
        capped |= {s: most * size[s] for s in over}


def test_mix_targets_and_taken(spark, docs):
    rows = mixing.mix_sources(docs).collect()
    text = {r.doc_id: r for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    size = defaultdict(int)
    for r in text.values():
        size[r.source] += len(WORDS.findall(r.text or ""))
    want, taken, largest = targets_by_rounds(size), Counter(), Counter()
    for r in rows:
        s = text[r.doc_id].source
        assert r.size == len(WORDS.findall(text[r.doc_id].text or "")) and r.source_size == size[s]
        assert r.target == pytest.approx(want[s]) and r.taken in (r.size * k for k in range(4)) and abs(r.copies - (want[s] / size[s] if size[s] else 0)) < 1
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s, w in want.items():
        assert abs(taken[s] - w) <= 2 * largest[s]
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_keeps_counts_in_blocks(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 5), "s" + str(i % 2)) for i in range(2000)], "doc_id long, text string, source string")
    by = defaultdict(int)
    for r in mixing.mix_sources(docs).collect():
        by[r.source_size, r.target] += r.taken
    for (_, target), taken in by.items():
        assert abs(taken - target) <= 10


def test_mix_edges(spark, edge, empty):
    rows = mixing.mix_sources(edge).collect()
    assert len(rows) == edge.count() and all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mix_sources(empty).collect() == []


def test_expand(spark, docs):
    mixed = mixing.mix_sources(docs)
    assert mixing.expand_copies(docs, mixed).count() == sum(r.copies for r in mixed.collect() if r.size)


def test_expand_repeated_rows(spark):
    """Rows equal in id and text, null ids, one id for two texts, and columns with the names used inside."""
    rows = [(i % 7 if i % 5 else None, "w " * (1 + i % 3), "s" + str(i % 2), i, i, i) for i in range(60)] + [(99, "one two three", "s0", 1, 2, 3)] * 40
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int, row int, share int")
    mixed = mixing.mix_sources(d)
    out = mixing.expand_copies(d, mixed)
    assert out.columns == d.columns
    want, got = Counter(), Counter((r.doc_id, r.text) for r in out.collect())
    for r in mixed.collect():
        want[r.doc_id, r.size] += r.copies
    assert Counter({k: v for k, v in want.items() if v}) == sum((Counter({(i, len(WORDS.findall(t))): v}) for (i, t), v in got.items()), Counter())
    each = Counter(tuple(r) for r in out.collect() if r.doc_id != 99)
    assert max(each.values()) <= 3


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 100, 1025])
def test_feistel_is_a_permutation(spark, n):
    x = spark.range(n).select(sharding.permuted(sharding.F.col("id"), n, 5, sharding.walks(n, 5)).alias("y"))
    assert sorted(r.y for r in x.collect()) == list(range(n))
    a, b = sharding.domain(n)
    assert sorted(sharding.feistel_of(x, a, b, 5) for x in range(a * b)) == list(range(a * b))


def test_shards(spark, docs, edge, empty):
    for d in (docs, edge):
        rows, texts = sharding.shard_rows(d).collect(), d.select("doc_id", "text").collect()
        assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows) == sorted((t.doc_id or -1, len((t.text or "").encode()) + 1, zlib.crc32((t.text or "").encode())) for t in texts)
        count = Counter(r.shard for r in rows)
        assert max(count.values()) - min(count[s] for s in range(8)) <= 1
        for s, n in count.items():
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    assert sharding.shard_rows(empty).collect() == []


def measured(text):
    text = text or ""
    words = WORDS.findall(text)
    grams = [tuple(words[i: i + 8]) for i in range(len(words) - 7)]
    often, cover = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            cover |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    failed = len(words) < 20 or 100 * len(cover) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover), failed


def test_quality(spark, docs, edge, empty):
    for d in (docs, edge):
        rows = quality.quality_rules(d).collect()
        assert sorted((r.doc_id or -1, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in rows) == sorted((t.doc_id or -1, measured(t.text)) for t in d.select("doc_id", "text").collect())
        assert not any(r.kept and r.base_failed for r in rows)
    assert quality.quality_rules(empty).collect() == []


def test_bad_host_goes(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, good if i % 10 else "short", f"h{i % 7}") for i in range(700)] + [(1000 + i, good if i % 10 == 0 else "short", "bad") for i in range(200)] + [(2000, "short", "single"), (2001, good, None)]
    out = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(r.kept == (not r.base_failed and r.host != "bad") for r in out)

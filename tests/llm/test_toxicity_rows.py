"""The toxicity classifier learns from all labelled rows, in blocks that add up."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from starloom.llm import toxicity


def made(spark, n):
    """Rows with ids in order of their texts, so that Spark and one process see them in the same order."""
    texts = sorted(f"{'bad' if i % 7 == 0 else 'good'} word{i % 50} and number{i}" for i in range(n))
    rows = [(i, t, ("en", "fr", None)[i % 3]) for i, t in enumerate(texts)]
    labels = [(i, int(t.startswith("bad"))) for i, t, _ in rows]
    return rows, labels, spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    """More rows than any sample took: 9,000 of label 0 and 3,000 of label 1."""
    docs = spark.range(12_000).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda rows, *_: seen.append((len(rows), rows.counts.sum(0).tolist())))
    toxicity.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 4 = 0 as int) as toxic"))
    assert seen == [(12_000, [9_000, 3_000])]


def test_spark_and_one_process_learn_the_same(spark):
    rows, labels, docs, known = made(spark, 240)
    there = toxicity.fit(docs, known)
    here = toxicity.train([r[1] for r in rows], [y for _, y in labels], [r[2] for r in rows])
    assert np.array_equal(there.numbers, here.numbers) and (there.scale, there.shift, there.limits) == (here.scale, here.shift, here.limits)


@pytest.mark.parametrize("size", [300, 1 << 22])
def test_blocks_hold_every_row_once(spark, monkeypatch, size):
    rows, labels, docs, known = made(spark, 240)
    monkeypatch.setattr(toxicity, "BLOCK", size)
    spread = toxicity.Spread(docs, known)
    blocks = spread.blocks.collect()
    assert len({b.block for b in blocks}) == len(blocks) and (len(blocks) > 3) == (size == 300)
    want = Counter((len(re.findall(r"\w+", t)), y, zlib.crc32(t.encode()) % toxicity.FOLDS, lang) for (_, t, lang), (_, y) in zip(rows, labels, strict=True))
    assert Counter(x for b in blocks for x in zip(b.sizes, b.toxic, b.fold, b.lang, strict=True)) == want

    def words(block, out):
        np.add.at(out, (block.ids, 0), 1)

    by_word = Counter(int(toxicity.buckets(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0]) for _, t, _ in rows for w in t.split())
    total = spread.total(words, toxicity.BUCKETS + 1)[:, 0]
    assert {int(i): int(total[i]) for i in np.flatnonzero(total) if i} == by_word


def test_several_blocks_learn_and_agree_on_reruns(spark, monkeypatch):
    rows, labels, docs, known = made(spark, 600)
    monkeypatch.setattr(toxicity, "BLOCK", 1000)
    m, again = toxicity.fit(docs, known), toxicity.fit(docs.repartition(7), known.repartition(3))
    assert np.array_equal(m.numbers, again.numbers) and m.limits == again.limits
    found = {r.doc_id: r.score for r in toxicity.score_texts(docs, m).collect()}
    assert np.mean([(found[i] >= 0.3) == y for i, y in labels]) >= 0.95

"""The corpus stages on a small table, each against plain Python over its own input."""

import hashlib
from collections import Counter

import pyarrow as pa
import sentencepiece
from test_dedup import WORDS, classes, removed

import corpus_pipeline
from starloom.llm import mixing, toxicity
from starloom.llm.common import durable, load
from starloom.llm.registry import piece_model

SF = "/root/testdata/sf0.001"


def test_stages_by_brute_force(spark):
    docs = load(spark, SF, "documents")
    columns, seen = docs.columns, [docs.collect()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, SF))
        assert docs.columns == columns
        seen.append(docs.collect())
    start, clean, apart, cut, mixed = seen
    held = toxicity.held_out()
    model = toxicity.fit(load(spark, SF, "documents").where(~held), load(spark, SF, "labels").where(~held))
    score = model.score(pa.array([r.text for r in start], pa.string()))
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r, s in zip(start, score, strict=True) if s < model.limits.get(r.lang, model.limits[None]))
    # the document of the least id of each class of all pairs stays, as it is
    least = {i: c for i, c, _ in classes([(r.doc_id, r.text) for r in clean], "count")}
    assert sorted(apart) == sorted(r for r in clean if least[r.doc_id] == r.doc_id)
    want = {i: (left, sha) for i, _, left, _, sha in removed([(r.doc_id, r.text) for r in apart])}
    before = {r.doc_id: (r.text or "").encode() for r in apart}
    for r in cut:
        taken, sha = want[r.doc_id]
        assert r.n_chars == (None if r.text is None else len(r.text))
        if "�" not in (r.text or ""):
            assert hashlib.sha256((r.text or "").encode()).hexdigest() == sha and len(before[r.doc_id]) - len((r.text or "").encode()) == taken
    assert len(cut) == len(apart)
    # copies by the operator's own count, whose rules test_native.py checks; sizes and sources from the texts
    size = Counter()
    for r in cut:
        size[r.source] += len(WORDS.findall(r.text or ""))
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(spark.createDataFrame(cut, docs.schema)).collect()}
    assert Counter(mixed) == Counter({r: copies[r.doc_id] for r in cut if copies[r.doc_id]})
    after = Counter()
    for r in mixed:
        after[r.source] += len(WORDS.findall(r.text or ""))
    assert all(after[s] <= 3 * n + 1 for s, n in size.items())
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    ids = {r.doc_id: library.encode(r.text or "") for r in mixed}
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in mixed)
    for r in out:
        assert r.agrees and r.ids == ids[r.doc_id] and r.decoded_sha256 == hashlib.sha256(library.decode(ids[r.doc_id]).encode()).hexdigest()

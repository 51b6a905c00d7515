"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the three- and four-byte windows of the lower-cased text (all that is not a letter reads as one gap
byte), hashed to buckets. A text's vector is the mean of its windows' embeddings; embeddings and softmax weights are
trained by stochastic gradient descent in numpy on a bounded sample of labelled rows (SAMPLE rows are expected, chosen
by a hash of the id). A fifth of the sample sets the temperature of the scores and the score under which a
prediction counts as rejected.

Prediction reads whole texts, and only them. Edge cases: null text and text without a letter is `und` with score 0 and not
accepted; without labelled rows all is `und`; repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import LOWER, digest, id_mod, mix64, pieces

SAMPLE = 4000
BUCKETS = 1 << 14
WIDTH = 16
EPOCHS = 6
PRECISION = 0.99
"""Accepted predictions are to be right this often on the part of the sample that is set aside."""
_LETTER = re.compile(r"[^\W\d_]")
_READ = np.where((LOWER >= 97) & (LOWER <= 122) | (np.arange(256) >= 128), LOWER, 32).astype(np.uint64)


def subwords(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the windows that start at each byte, of three bytes and of four."""
    b = _READ[data]
    three = b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16)
    four = three[:-1] | b[3:] << np.uint64(24) | np.uint64(1 << 40)
    half = np.uint64(BUCKETS // 2 - 1)
    spread = lambda x: (x * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40) & half).astype(np.int64)
    return spread(three), spread(four) + BUCKETS // 2


def counts(text: str) -> np.ndarray:
    """Relative frequencies of the buckets."""
    data = np.frombuffer(f" {text} ".encode(), np.uint8)
    c = sum(np.bincount(x, minlength=BUCKETS) for x in subwords(data)).astype(np.float32)
    return c / max(1, c.sum())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class Model:
    def __init__(self, names: list[str], table: np.ndarray, bias: np.ndarray, limit: float):
        self.names, self.table, self.bias, self.limit = names, table, bias, limit


def train(texts: list[str], langs: list[str], seed: int = 3) -> Model | None:
    """None if there is nothing to learn from. Rows come in any order; the result depends on the set only."""
    rows = sorted(zip(texts, langs, strict=True))
    if not rows:
        return None
    names = sorted({x for _, x in rows})
    y = np.array([names.index(x) for _, x in rows])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    sparse = []
    for t, _ in rows:
        c = counts(t)
        at = np.flatnonzero(c)
        sparse.append((at, c[at]))

    def dense(some: np.ndarray) -> np.ndarray:
        x = np.zeros((len(some), BUCKETS), np.float32)
        for r, i in enumerate(some):
            x[r, sparse[i][0]] = sparse[i][1]
        return x

    aside = order[: len(order) // 5]
    learn = order[len(order) // 5:]
    embed = rng.normal(0, 0.5, (BUCKETS, WIDTH)).astype(np.float32)
    weight, bias = np.zeros((WIDTH, len(names)), np.float32), np.zeros(len(names), np.float32)
    steps, total = 0, EPOCHS * -(-len(learn) // 32)
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(learn), max(1, -(-len(learn) // 32))):
            rate = np.float32(1 - steps / total)
            x = dense(at)
            h = x @ embed
            p = softmax(h @ weight + bias)
            p[np.arange(len(at)), y[at]] -= 1
            p /= len(at)
            back = p @ weight.T
            weight -= rate * 4 * h.T @ p
            bias -= rate * 0.2 * p.sum(0)
            embed -= rate * 400 * x.T @ back
            steps += 1
    table = embed @ weight
    limit = 0.0
    if len(aside) >= 50:
        z = np.concatenate([dense(part) @ table for part in np.array_split(aside, -(-len(aside) // 64))]) + bias
        loss = {s: -np.log(np.maximum(softmax(z * s)[np.arange(len(z)), y[aside]], 1e-9)).mean() for s in (0.25, 0.5, 0.75, 1, 1.5, 2, 3, 4, 6)}
        scale = np.float32(min(loss, key=loss.get))
        table, bias = table * scale, bias * scale
        p = softmax(z * scale)
        score, right = p.max(1), p.argmax(1) == y[aside]
        best = np.argsort(-score, kind="stable")
        good = np.flatnonzero(np.cumsum(right[best]) >= PRECISION * np.arange(1, len(best) + 1))
        limit = float(score[best[good[-1]]]) if len(good) else 1.0
    return Model(names, table.astype(np.float32), bias.astype(np.float32), limit)


def fit(docs: DataFrame, expected: int = SAMPLE) -> Model | None:
    """Learn from text and non-null lang of docs (doc_id, text, lang): about `expected` rows, chosen by a hash of the id. Of rows that share an id, or
    have none, the one of least digest is learned from, so ids in many rows don't lengthen the sample."""
    labelled = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    n = labelled.count()
    share = int(min(1.0, expected / max(n, 1)) * (1 << 20))
    rows = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) < share).groupBy("doc_id").agg(F.min_by(F.struct("text", "lang"), F.struct(digest(F.col("text")), "lang")).alias("x")).select("x.*").collect()
    return train([r.text for r in rows], [r.lang for r in rows])


def scores(column: pa.Array, model: Model) -> np.ndarray:
    """Probabilities of the languages for each row."""
    out = np.zeros((len(column), len(model.names)), np.float32)
    for lo, hi, data, offsets in pieces(column):
        padded = np.full(len(data) + 2 * (hi - lo), 32, np.uint8)
        place = offsets + 2 * np.arange(hi - lo + 1)  # a gap before and after each row
        if len(data):
            padded[np.arange(len(data)) + np.repeat(2 * np.arange(hi - lo) + 1, np.diff(offsets))] = data
        three, four = subwords(padded)
        total = np.zeros((hi - lo, len(model.names)), np.float64)
        n = np.maximum(1, 2 * np.diff(place) - 5)
        for windows, k in ((three, 3), (four, 4)):
            for c in range(len(model.names)):
                s = np.concatenate(([0], np.cumsum(model.table[:, c][windows], dtype=np.float64)))
                end = np.maximum(place[:-1], place[1:] - k + 1)
                total[:, c] += s[end] - s[place[:-1]]
        out[lo:hi] = softmax((total / n[:, None]).astype(np.float32) + model.bias)
    return out


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) for each row of docs (doc_id, text)."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            letters = np.array([bool(t.is_valid and _LETTER.search(t.as_py())) for t in texts], bool)
            if model is None or not len(texts):
                pred, score, accepted = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            else:
                p = scores(texts, model)
                score = np.where(letters, p.max(1), 0.0).astype(np.float64)
                pred = [model.names[k] if x else "und" for k, x in zip(p.argmax(1), letters, strict=True)]
                accepted = letters & (score >= model.limit)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())], ["doc_id", "lang_pred", "score", "accepted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")


def language_id(docs: DataFrame) -> DataFrame:
    """Train on rows with crc32(doc_id) mod 4 other than 2 and predict all rows; adds held_out."""
    held = id_mod(F.col("doc_id"), 4) == 2
    found = identify(docs, fit(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "accepted")

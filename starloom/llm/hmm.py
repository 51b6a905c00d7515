"""A hidden Markov language model: Baum-Welch over all training texts, exact scores by the scaled forward recursion.

Tokens are words (A-Z lower-cased) and one end for each text. Word counts cover the whole training corpus. Every word belongs
to an emission class, and the states differ in how they emit classes. The most frequent words (at most HEAD, by whole steps
of a logarithmic histogram of counts, so the bound holds) are classes of their own; a hash deals all other words out to
shared classes, one for every WORDS_A_CLASS of them and at most SHARED. Inside a shared class a word's probability comes from
its corpus count, with half a count for each word and for all words never seen together. So the states' emission table is
bounded whatever the vocabulary, no word is outside it, and the likelihood is exact. With one state it is the base score, but
for a norm that reserves half a count in each shared class instead of one.

Texts are encoded once: class ids as a binary column, words of `rest` as (word, n). The sums over `rest` words come from
a join with the count table by word. Each Baum-Welch pass computes expected counts in the partitions and adds them up by
class in a shuffle; the driver gets the bounded table. Expected counts of a group of texts use 32-bit floats (each step is
scaled) and are added up in 64; likelihoods use 64-bit floats throughout.

Edge cases: null and empty texts are one end token; without training texts every token is unseen; repeated rows are
scored (and learned from) each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import LOWER, Rolling, cut, durable, id_mod, pieces, utf8, word_spans

HEAD = 60_000
SHARED, WORDS_A_CLASS = 4096, 16
STATES = 8
PASSES = 4
SMOOTH = 100.0
"""Weight, in tokens, of the corpus distribution in each state's emissions."""
FLUSH = 200_000
"""Distinct words that a task holds before it hands them on."""


def _count_words(batches):
    """(word, n) from (text), added up within the task."""
    held: dict[int, list] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in held.values()], pa.string()), pa.array([n for _, n in held.values()], pa.int64())], ["word", "n"])

    for batch in batches:
        for _, _, data, offsets in pieces(batch.column(0), 1 << 22):
            start, end, _ = word_spans(data, offsets)
            if not len(start):
                continue
            key, at, n = np.unique(Rolling(data, lower=True).spans(start, end), return_index=True, return_counts=True)
            words = None
            new = [i for i, k in enumerate(key.tolist()) if k not in held]
            words = cut(LOWER[data], start[at[new]], end[at[new]]).to_pylist()
            for k, w in zip(key[new].tolist(), words, strict=True):
                held[k] = [w, 0]
            for k, c in zip(key.tolist(), n.tolist(), strict=True):
                held[k][1] += c
            if len(held) >= FLUSH:
                yield out()
                held.clear()
    if held:
        yield out()


class Vocabulary:
    """The head words' hashes (sorted) and counts, the shared classes' counts, and the corpus totals."""

    def __init__(self, words: list[str], counts: list[int], shared: np.ndarray, distinct: int, texts: int):
        """shared: (words, tokens) of each shared class."""
        joined = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) for w in words], dtype=np.int64) if words else np.zeros(0, np.int64)
        hashes = Rolling(joined, lower=True).spans(np.concatenate(([0], ends[:-1])).astype(np.int64), ends) if words else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], np.array(counts, np.int64)[order]
        self.texts, self.tokens, self.distinct = texts, int(sum(counts) + shared[:, 1].sum()) + texts, distinct + (texts > 0)
        self.norm = self.tokens + 0.5 * (self.distinct + 1)
        self.rest, self.shared, self.end = len(words), len(shared), len(words) + len(shared)  # first shared class, how many, the end
        self.classes = self.end + 1
        if self.classes > 1 << 16:
            raise ValueError("more emission classes than 16 bits can name")
        mass = shared[:, 1] + 0.5 * shared[:, 0] + 0.5
        self.log = np.log10(np.concatenate([self.counts + 0.5, np.ones(self.shared), [texts + 0.5]]))
        self.mass_log = np.log10(np.concatenate([np.ones(self.rest), mass, [1.0]]))
        self.half = np.concatenate([np.full(self.rest, 0.5), mass - shared[:, 1], [0.5]])  # what the base score adds to the counts
        self.unigram = np.concatenate([self.counts + 0.5, mass, [texts + 0.5]])
        self.unigram /= self.unigram.sum()
        bits = max(1, int(len(words) * 8).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift)  # where each hash prefix begins

    def find(self, h: np.ndarray) -> np.ndarray:
        """Class of each hash."""
        out = self.rest + shared_class(h, self.shared)
        if not self.rest:
            return out
        at = self.first[(h >> self.shift).astype(np.int64)]
        open_ = np.arange(len(h))
        while len(open_):
            k = at[open_]
            inside = k < self.rest
            open_, k = open_[inside], k[inside]
            found = self.hashes[k]
            same = found == h[open_]
            out[open_[same]] = k[same]
            open_ = open_[found < h[open_]]
            at[open_] += 1
        return out


def shared_class(h: np.ndarray, shared: int) -> np.ndarray:
    """Which of the shared classes a word's hash falls into."""
    return ((h >> np.uint64(40)) % np.uint64(shared)).astype(np.int64)


def _class_sums(shared: int):
    """(k, words, total) of each shared class from rows (word, n), added up within the task."""
    def run(batches):
        sums = np.zeros((shared, 2))
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            lo = offsets[0]
            h = Rolling(data[lo: offsets[-1]], lower=True).spans(offsets[:-1] - lo, offsets[1:] - lo)
            k = shared_class(h, shared)
            sums += np.stack([np.bincount(k, minlength=shared), np.bincount(k, batch.column(1).to_numpy(), shared)], 1)
        used = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used, 0].astype(np.int64)), pa.array(sums[used, 1].astype(np.int64))], ["k", "words", "total"])

    return run


def vocabulary(counts: DataFrame, texts: int, head: int) -> Vocabulary:
    """counts: (word, n). The driver gets a histogram of some hundred steps, at most `head` words, and a row for each shared class."""
    step = F.floor(F.log2("n") * 16).cast("int")
    histogram = sorted(((r.step, r.words, r.total) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("total")).collect()), reverse=True)
    least, room = math.inf, head
    for s, words, _ in histogram:
        if words > room:
            break
        least, room = s, room - words
    rows = counts.where(step >= least).collect() if least < math.inf else []
    rows.sort()
    distinct = sum(h[1] for h in histogram)
    shared = np.zeros((max(1, min(SHARED, (distinct - len(rows)) // WORDS_A_CLASS)), 2))
    if distinct > len(rows):
        others = counts.where(step < least) if least < math.inf else counts
        sums = others.select("word", "n").mapInArrow(_class_sums(len(shared)), "k long, words long, total long")
        for r in sums.groupBy("k").agg(F.sum("words").alias("words"), F.sum("total").alias("total")).collect():
            shared[r.k] = r.words, r.total
    return Vocabulary([r.word for r in rows], [r.n for r in rows], shared, distinct, texts)


def _encode(vocab: Vocabulary, ids_type=np.uint16):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(2)):
                start, end, first = word_spans(data, offsets)
                h = Rolling(data, lower=True).spans(start, end)
                ids = vocab.find(h)
                rows = hi - lo
                row = np.repeat(np.arange(rows), np.diff(first))
                everything = np.insert(ids, first[1:], vocab.end)
                place = first + np.arange(rows + 1)
                sums, mass = (np.concatenate(([0], np.cumsum(x[everything]))) for x in (vocab.log, vocab.mass_log))
                known = np.concatenate(([0], np.cumsum(np.where(everything == vocab.end, vocab.texts > 0, everything < vocab.rest))))
                tail = np.flatnonzero(ids >= vocab.rest)
                order = tail[np.lexsort((h[tail], row[tail]))]
                new = np.flatnonzero(np.append(True, (np.diff(row[order]) != 0) | (np.diff(h[order].view(np.int64)) != 0))) if len(order) else order
                n = np.diff(np.append(new, len(order)))
                which = order[new]
                words = pa.StructArray.from_arrays([cut(LOWER[data], start[which], end[which]), pa.array(n, pa.int64())], ["word", "n"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[which], np.arange(rows + 1)), pa.int32()), words)
                raw = np.ascontiguousarray(everything.astype(ids_type))
                codes = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((place * raw.itemsize).astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, rows), batch.column(1).slice(lo, rows), pa.array(np.diff(place)), pa.array(sums[place[1:]] - sums[place[:-1]]), pa.array(mass[place[1:]] - mass[place[:-1]]), pa.array(known[place[1:]] - known[place[:-1]]), codes, lists],
                    ["doc_id", "held_out", "n_tokens", "head_log", "mass_log", "head_known", "ids", "tail"])

    return run


class Hmm:
    def __init__(self, start: np.ndarray, trans: np.ndarray, emit: np.ndarray):
        """emit: (classes, states)."""
        self.start, self.trans, self.emit = start, trans, emit


def first_guess(vocab: Vocabulary, states: int, seed: int = 4) -> Hmm:
    rng = np.random.default_rng(seed)
    emit = vocab.unigram[:, None] * np.exp(rng.normal(0, 1.0, (vocab.classes, states)))
    trans = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Hmm(np.full(states, 1 / states), trans, emit / emit.sum(0))


def groups(column: pa.Array, most: int = 150_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of like length together: (rows, ids in order of time then text, first place of each time, texts at each time)."""
    data, offsets = utf8(column)
    ids, bounds = data.view(np.uint16) if len(data) else np.zeros(0, np.uint16), offsets // 2
    length = np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    lo = 0
    while lo < len(order):
        total = np.cumsum(length[order[lo:]])
        hi = lo + max(1, int(np.searchsorted(total, most, "right")))
        rows = order[lo:hi]
        n = length[rows]
        width = np.searchsorted(-n, -np.arange(n[0]), "left")  # texts longer than t, a prefix of rows
        begin = np.concatenate(([0], np.cumsum(width)))
        t = np.repeat(np.arange(n[0]), width)
        k = np.arange(begin[-1]) - begin[t]
        yield rows, ids[bounds[rows][k] + t].astype(np.int64), begin, width
        lo = hi


def forward(model: Hmm, ids: np.ndarray, begin: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward vectors and scales of every token."""
    alpha, scale = model.emit[ids], np.empty(len(ids))
    last = None
    for t in range(len(width)):
        a = alpha[begin[t]: begin[t + 1]]
        a *= model.start if t == 0 else last[: width[t]] @ model.trans
        s = a.sum(1)
        scale[begin[t]: begin[t + 1]] = s
        a /= s[:, None]
        last = a
    return alpha, scale


def log_likelihood(model: Hmm, column: pa.Array) -> np.ndarray:
    """log10 probability of each row's class sequence."""
    out = np.zeros(len(column))
    for rows, ids, begin, width in groups(column):
        _, scale = forward(model, ids, begin, width)
        k = np.arange(len(ids)) - np.repeat(begin[:-1], width)
        out[rows] = np.bincount(k, np.log10(scale), len(rows))
    return out


def expected_counts(model: Hmm, column: pa.Array, start: np.ndarray, trans: np.ndarray, emit: np.ndarray) -> None:
    """Add the expected counts of a column of class sequences."""
    for rows, ids, begin, width in groups(column):
        alpha, scale = forward(model, ids, begin, width)
        beta = np.ones_like(alpha)
        onward = np.empty_like(alpha)  # emission * beta / scale
        for t in range(len(width) - 1, -1, -1):
            at = slice(begin[t], begin[t + 1])
            if t + 1 < len(width):
                beta[begin[t]: begin[t] + width[t + 1]] = onward[begin[t + 1]: begin[t + 2]] @ model.trans.T
            onward[at] = model.emit[ids[at]] * beta[at] / scale[at][:, None]
        gamma = alpha * beta
        start += gamma[: width[0]].sum(0)
        if len(width) > 1:
            later = np.arange(begin[1], len(ids))
            before = later - np.repeat(width[:-1], width[1:])
            trans += model.trans * (alpha[before].T @ onward[later])
        for s in range(emit.shape[1]):
            emit[:, s] += np.bincount(ids, gamma[:, s], len(emit))


def _e_step(model: Hmm):
    states = len(model.start)
    model = Hmm(*(x.astype(np.float32) for x in (model.start, model.trans, model.emit)))

    def run(batches):
        start, trans, emit = np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape)
        for batch in batches:
            expected_counts(model, batch.column(0), start, trans, emit)
        used = np.flatnonzero(emit.any(1))
        if len(used):
            whole = np.concatenate([emit[used], trans, start[None]])
            key = np.concatenate([used, -1 - np.arange(states), [-1 - states]])  # negative keys: transitions from a state, then the start
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), *[pa.array(whole[:, s]) for s in range(states)]], ["key", *[f"s{s}" for s in range(states)]])

    return run


def baum_welch(encoded: DataFrame, vocab: Vocabulary, states: int = STATES, passes: int = PASSES) -> Hmm:
    """Train on all rows of encoded (ids)."""
    model = first_guess(vocab, states)
    names = [f"s{s}" for s in range(states)]
    for _ in range(passes):
        sums = encoded.select("ids").mapInArrow(_e_step(model), "key long, " + ", ".join(f"{n} double" for n in names)).groupBy("key").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        if not sums.num_rows:
            break
        key, value = sums.column("key").to_numpy(), np.stack([sums.column(n).to_numpy() for n in names], 1)
        emit = np.zeros_like(model.emit)
        emit[key[key >= 0]] = value[key >= 0]
        emit += SMOOTH * vocab.unigram[:, None] + vocab.half[:, None] * (emit.sum(0) / emit.sum())
        trans, start = np.full((states, states), 0.01), np.full(states, 0.01)
        for k, v in zip(-1 - key[key < 0], value[key < 0], strict=True):
            if k < states:
                trans[k] += v
            else:
                start += v
        model = Hmm(start / start.sum(), trans / trans.sum(1, keepdims=True), emit / emit.sum(0))
    return model


def score_language(docs: DataFrame, states: int = STATES, passes: int = PASSES, head: int = HEAD) -> DataFrame:
    """Train on rows of docs (doc_id, text) with crc32(doc_id) mod 5 other than 1 and score all rows.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    rows = docs.select("doc_id", (id_mod(F.col("doc_id"), 5) == 1).alias("held_out"), "text")
    learn = rows.where("not held_out")
    counts = durable(learn.select("text").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    vocab = vocabulary(counts, learn.count(), head)
    encoded = durable(rows.mapInArrow(_encode(vocab), "doc_id long, held_out boolean, n_tokens long, head_log double, mass_log double, head_known long, ids binary, tail array<struct<word: string, n: long>>").withColumn("uid", F.monotonically_increasing_id()))
    model = baum_welch(encoded.where("not held_out"), vocab, states, passes)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(6)], pa.array(log_likelihood(model, batch.column(6))), batch.column(7)], ["doc_id", "held_out", "n_tokens", "head_log", "mass_log", "head_known", "head_score", "uid"])

    scored = encoded.select("doc_id", "held_out", "n_tokens", "head_log", "mass_log", "head_known", "ids", "uid").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, head_log double, mass_log double, head_known long, head_score double, uid long")
    words = encoded.select("uid", F.explode("tail").alias("t")).select("uid", "t.word", F.col("t.n").alias("times"))
    n = F.coalesce(F.col("n"), F.lit(0))
    tail = words.join(counts, "word", "left").groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(n + 0.5)).alias("tail_log"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("tail_known"))
    rest = F.coalesce(F.col("tail_log"), F.lit(0.0))
    return scored.join(tail, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + rest - F.col("n_tokens") * F.lit(math.log10(vocab.norm))).alias("base_score"),
        (F.col("head_score") + rest - F.col("mass_log")).alias("score"))

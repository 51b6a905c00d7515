"""Toxicity by a convolutional text classifier.

Words (runs of ASCII letters and digits and of bytes from 128, letters lower-cased) are hashed to embeddings; filters of widths
one to three run over them, each filter keeps its maximum over the text, and a logistic layer joins the maxima. The first
number of each embedding starts at the word's log odds among the labelled rows, the others at random.

It learns from all labelled rows. Their words are written once, in blocks of about BLOCK words chosen by a hash of the id. In each of
EPOCHS rounds every block goes on from the common numbers in numpy (Adam), and Spark adds up by how much the blocks moved each
number; the next round starts from the mean over the blocks that moved it. Sums are integers, so reruns agree. The driver
holds the numbers of the models and sums of fixed length, never rows.

The scale of the logits and, by language, the score from which a text is rejected come from all labelled rows too: each is
scored by a model that has not learned from its fold (FOLDS, by a hash of the text). Languages with few toxic rows take the threshold of
all; with fewer than 100 rows, or all of a label in one fold, the final model itself scores the rows.

Scores read whole texts, and only them; the language serves for the threshold of the verdict alone. Edge cases: null and
empty texts get the score of a text without words; without labelled rows of both kinds the score is 0 and nothing is
rejected; null languages take the threshold of all; repeated rows get equal scores; of rows that share an id one is learned from;
of labels of one id the least counts, once; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Rolling, crc_of, digest, discard, durable, id_mod, pieces, word_spans

BUCKETS = 1 << 16
WIDTH = 8
FILTERS = {1: 8, 2: 8, 3: 8}
"""Filters by width in words."""
EPOCHS = 6
SHRINK = 8
"""Documents' worth of the base rate that a word's rate is shrunk by."""
PRECISION = 0.95
"""Rejected texts are to be toxic this often, by language, when models that have not learned from them score them."""
FOLDS = 3
BLOCK = 1 << 22
"""Words that a task learns from at once."""
SCALES = (0.2, 0.35, 0.5, 0.75, 1.0, 1.25, 1.5)
BINS = 1000
"""Thresholds are multiples of a BINS-th."""
_GAP = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
_EXTRA = max(FILTERS)
_DENSE = sum((w * WIDTH + 2) * k for w, k in FILTERS.items()) + 1
_ROWS = BUCKETS + 1 + -(-(3 * _DENSE + 1) // WIDTH)
_SUMS = WIDTH + 1
_FIXED = 1 << 36
"""Moves of numbers are added up in these parts."""


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each word, words before each row and in all)."""
    start, end, first = word_spans(data, offsets, _GAP)
    return (Rolling(data, lower=True).spans(start, end) % np.uint64(BUCKETS)).astype(np.int64) + 1, first


def padded(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids with max(widths) zeros after each row; where each row begins, and the end)."""
    place = first + _EXTRA * np.arange(len(first))
    out = np.zeros(place[-1], np.int64)
    out[np.arange(len(ids)) + _EXTRA * np.repeat(np.arange(len(first) - 1), np.diff(first))] = ids
    return out, place


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return padded(*buckets(data, offsets))


def layers(dense: np.ndarray) -> tuple[dict, dict, np.ndarray, np.ndarray]:
    """Views of the numbers beside the embeddings: filters and their biases by width, top layer, bias."""
    weights, biases, at = {}, {}, 0
    for w, k in FILTERS.items():
        weights[w] = dense[at: at + w * WIDTH * k].reshape(w, WIDTH, k)
        biases[w] = dense[at + w * WIDTH * k: at + (w * WIDTH + 1) * k]
        at += (w * WIDTH + 1) * k
    return weights, biases, dense[at: _DENSE - 1], dense[_DENSE - 1: _DENSE]


class Model:
    """All numbers are one matrix: embeddings by bucket, then those of layers(), Adam's two moments of these, and its steps."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        self.scale, self.shift, self.limits = 1.0, 0.0, {None: 2.0}

    embed = property(lambda self: self.numbers[: BUCKETS + 1])
    rest = property(lambda self: self.numbers[BUCKETS + 1:].reshape(-1))
    weights = property(lambda self: layers(self.rest)[0])
    biases = property(lambda self: layers(self.rest)[1])
    top = property(lambda self: layers(self.rest)[2])
    bias = property(lambda self: layers(self.rest)[3][0])

    @staticmethod
    def start(odds: np.ndarray | None, seed: int) -> Model:
        """Random numbers; odds: of each bucket, where the first number of its embedding starts."""
        rng = np.random.default_rng(seed)
        m = Model(np.zeros((_ROWS, WIDTH), np.float32))
        weights, biases, top, bias = layers(m.rest)
        m.embed[:] = rng.normal(0, 0.1, (BUCKETS + 1, WIDTH))
        if odds is not None:
            m.embed[:, 0] = np.clip(odds, -3, 3)
        m.embed[0] = 0
        for w in FILTERS:
            weights[w][:] = rng.normal(0, 0.3, weights[w].shape)
            biases[w][:] = -0.5
        weights[1][0][0, : FILTERS[1] // 2] = 1
        top[:], bias[:] = 0.3, -1
        return m

    def responses(self, ids: np.ndarray, x: np.ndarray, width: int) -> np.ndarray:
        """The filters of a width at each word; windows that reach beyond the end see zeros."""
        n, weights = len(ids), self.weights[width]
        z = np.tile(self.biases[width], (n, 1))
        for j in range(min(width, n)):
            z[: n - j] += x[j:] @ weights[j]
        return z

    def pooled(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        x = self.embed[ids]
        return np.maximum(np.concatenate([np.maximum.reduceat(self.responses(ids, x, w), place[:-1], axis=0) for w in FILTERS], axis=1), 0)

    def logits(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for lo, hi, data, offsets in pieces(column):
            out[lo:hi] = self.pooled(*word_ids(data, offsets)) @ self.top + self.bias
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        return _logistic(self.logits(column) * self.scale + self.shift)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# ---- labelled rows, in blocks ----

class Block:
    """Some labelled rows: ids as one run, words before each row, and by row the label, fold and language."""

    def __init__(self, number: int, ids: np.ndarray, first: np.ndarray, toxic, fold, lang):
        self.number, (self.ids, self.place) = number, padded(ids, first)
        self.toxic, self.fold, self.lang = np.array(toxic, np.int64), np.array(fold, np.int64), lang

    def some(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Like padded(), of these rows."""
        docs = [self.ids[self.place[i]: self.place[i + 1]] for i in rows]
        return np.concatenate(docs), np.concatenate(([0], np.cumsum([len(x) for x in docs])))


class Here:
    """Labelled rows in this process, one block."""

    def __init__(self, texts: list[str], labels: list[int], langs: list[str | None]):
        rows = sorted(zip(texts, labels, [x or "" for x in langs], strict=True))
        data = [r[0].encode() for r in rows]
        toxic, fold, lang = [r[1] for r in rows], [zlib.crc32(x) % FOLDS for x in data], [r[2] for r in rows]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in data]))).astype(np.int64)
        self.blocks = [Block(0, *buckets(np.frombuffer(b"".join(data), np.uint8), offsets), toxic, fold, lang)]
        self.counts = np.zeros((FOLDS, 2), np.int64)
        np.add.at(self.counts, (np.array(fold, np.int64), np.array(toxic, np.int64)), 1)
        known = Counter(x for x, y in zip(lang, toxic, strict=True) if x and y)
        self.langs = sorted(x for x, n in known.items() if n >= 20)

    def __len__(self) -> int:
        return int(self.counts.sum())

    def total(self, add: Callable[[Block, np.ndarray], None], size: int) -> np.ndarray:
        """add(block, out) adds integers to out, of `size` rows; the sums over all blocks."""
        out = np.zeros((size, _SUMS), np.int64)
        for block in self.blocks:
            add(block, out)
        return out


class Spread:
    """Rows of docs (doc_id, text, lang) with labels (doc_id, toxic), as a written table with a row for each block."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"))
        rows = docs_words(docs).join(known, "doc_id").groupBy("doc_id").agg(F.min_by(F.struct("words", "toxic", "lang", "fold"), F.struct("key", "lang")).alias("x"))
        rows = durable(rows.select("doc_id", "x.*"))
        self.counts, words = np.zeros((FOLDS, 2), np.int64), 0
        for r in rows.groupBy("fold", "toxic").agg(F.count("*").alias("n"), F.sum(F.octet_length("words") / 2 + _EXTRA).alias("words")).collect():
            self.counts[r.fold, r.toxic] = r.n
            words += r.words
        self.langs = sorted(r.lang for r in rows.where("lang != '' and toxic = 1").groupBy("lang").count().where("count >= 20").collect())
        n = max(1, -(-int(words) // BLOCK))
        block = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(n)).cast("int")
        kind = "block int, words binary, sizes array<int>, toxic array<int>, fold array<int>, lang array<string>"
        self.blocks = durable(rows.withColumn("block", block).repartitionById(n, "block").mapInArrow(_packed, kind))
        discard(rows)

    def __len__(self) -> int:
        return int(self.counts.sum())

    def total(self, add: Callable[[Block, np.ndarray], None], size: int) -> np.ndarray:
        """As in Here; the tasks add up their blocks, Spark adds up the tasks."""
        names = [f"v{i}" for i in range(_SUMS)]

        def run(batches):
            out = np.zeros((size, _SUMS), np.int64)
            for batch in batches:
                for r in batch.to_pylist():
                    ids = np.frombuffer(r["words"], "<u2").astype(np.int64) + 1
                    add(Block(r["block"], ids, np.concatenate(([0], np.cumsum(r["sizes"]))).astype(np.int64), r["toxic"], r["fold"], r["lang"]), out)
            at = np.flatnonzero(out.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(out[at, i]) for i in range(_SUMS))], ["at", *names])

        parts = self.blocks.mapInArrow(run, "at int, " + ", ".join(f"{x} long" for x in names))
        table = durable(parts.groupBy("at").agg(*(F.sum(x).alias(x) for x in names)))
        found = table.toArrow()
        discard(table)
        out = np.zeros((size, _SUMS), np.int64)
        out[found["at"].to_numpy()] = np.stack([found[x].to_numpy() for x in names], 1)
        return out


def docs_words(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, key, fold, words) for each row of docs (doc_id, text, lang): buckets less one as 16-bit numbers."""
    def run(batches):
        for batch in batches:
            words = []
            for _, _, data, offsets in pieces(batch.column(1)):
                ids, first = buckets(data, offsets)
                ids = (ids - 1).astype("<u2")
                words += [ids[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(words, pa.binary())], ["doc_id", "lang", "key", "fold", "words"])

    rows = docs.select("doc_id", "text", "lang", digest(F.col("text")).alias("key"), (crc_of(F.col("text")) % FOLDS).cast("int").alias("fold"))
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, key binary, fold int, words binary")


def _packed(batches):
    """The rows of a partition, which is a block, as one row."""
    batches = [x for x in batches if x.num_rows]
    if batches:
        t = pa.Table.from_batches(batches).sort_by("doc_id")
        words = t["words"].to_pylist()
        row = {"block": t["block"][0].as_py(), "words": b"".join(words), "sizes": [len(x) // 2 for x in words], **{x: t[x].to_pylist() for x in ("toxic", "fold", "lang")}}
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_pylist([row], pa.schema([("block", pa.int32()), ("words", pa.binary()), ("sizes", ints), ("toxic", ints), ("fold", ints), ("lang", pa.list_(pa.string()))]))


# ---- training ----

def improve(m: Model, block: Block, learn: np.ndarray, rate: float, rng: np.random.Generator) -> None:
    """Go once over the rows `learn` of the block, in place."""
    weights, _, top, bias = layers(m.rest)
    dense, first, second, steps = (m.rest[i * _DENSE: min((i + 1) * _DENSE, 3 * _DENSE + 1)] for i in range(4))
    for part in np.array_split(rng.permutation(learn), max(1, len(learn) // 48)):
        ids, place = block.some(part)
        x = m.embed[ids]
        best, value = [], []
        for w in FILTERS:
            z = m.responses(ids, x, w)
            at = np.stack([lo + z[lo:hi].argmax(0) for lo, hi in zip(place[:-1], place[1:], strict=True)])
            best.append(at)
            value.append(np.take_along_axis(z, at, 0))
        pool = np.maximum(np.concatenate(value, 1), 0)
        d = ((_logistic(pool @ top + bias) - block.toxic[part]) / len(part)).astype(np.float32)
        down = d[:, None] * top * (pool > 0)
        gradient = np.zeros(_DENSE, np.float32)
        g_weights, g_biases, g_top, g_bias = layers(gradient)
        g_top[:], g_bias[:] = pool.T @ d + 1e-4 * top, d.sum()
        c, touched, pull = 0, [], []
        for (w, k), at in zip(FILTERS.items(), best, strict=True):
            g = down[:, c: c + k]
            c += k
            for j in range(w):
                r, f = np.nonzero((at + j < len(ids)) & (g != 0))
                word, gr = at[r, f] + j, g[r, f]
                np.add.at(g_weights[w][j].T, f, gr[:, None] * x[word])
                touched.append(ids[word])
                pull.append(gr[:, None] * weights[w][j][:, f].T)
            g_biases[w][:] = g.sum(0)
        steps += 1
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient**2 - second)
        dense -= rate * (first / (1 - 0.9**steps)) / (np.sqrt(np.maximum(second, 0) / (1 - 0.99**steps)) + 1e-6)
        np.subtract.at(m.embed, np.concatenate(touched), np.clip(np.concatenate(pull), -1, 1) * np.float32(rate * 20))
        m.embed[0] = 0


def train(rows: Spread | list[str], labels: list[int] | None = None, langs: list[str | None] | None = None, share: dict[int, float] | None = None, seed: int = 9, odds_first: bool = True) -> Model | None:
    """rows: labelled rows in Spark, or texts with labels and langs. share: the share of the rows of each label that is
    given (all, unless said). None if a label is missing. odds_first: start the first number of each embedding at the word's log
    odds; without, all start at random."""
    if labels is not None:
        rows = Here(rows, labels, langs)
    n, share = rows.counts, share or {0: 1.0, 1: 1.0}
    if not n.sum(0).all():
        return None
    # a model for each fold, which learns from the others, and one of all
    keys = [*range(FOLDS), -1] if n.sum() >= 100 and (n.sum(0) - n).all() else [-1]

    def see(block, out):
        row, word = np.divmod(np.unique(np.repeat(np.arange(len(block.toxic)), np.diff(block.place)) * (BUCKETS + 1) + block.ids), BUCKETS + 1)
        np.add.at(out, (word, 2 * block.fold[row] + block.toxic[row]), 1)

    seen, models = rows.total(see, BUCKETS + 1)[:, : 2 * FOLDS].reshape(-1, FOLDS, 2), []
    for key in keys:
        use = [f for f in range(FOLDS) if f != key]
        n0, n1 = n[use].sum(0)
        base, having = n1 / (n0 + n1), seen[:, use].sum(1)
        chance = (having[:, 1] + SHRINK * base) / (having.sum(1) + SHRINK)
        odds = np.log(chance / base) - np.log((1 - chance) / (1 - base))
        models.append(Model.start(odds if odds_first else None, seed))

    for epoch in range(EPOCHS):
        def move(block, out, epoch=epoch):
            for k, (key, m) in enumerate(zip(keys, models, strict=True)):
                learn = np.flatnonzero(block.fold != key)
                if not len(learn):
                    continue
                new = Model(m.numbers.copy())
                improve(new, block, learn, 0.02 * (1 - epoch / EPOCHS), np.random.default_rng((seed, epoch, block.number, k)))
                by = new.numbers.astype(np.float64) - m.numbers
                moved = by.any(1)
                moved[BUCKETS + 1:] = True
                at = np.flatnonzero(moved)
                out[k * _ROWS + at, :WIDTH] += np.rint(by[at] * _FIXED).astype(np.int64)
                out[k * _ROWS + at, WIDTH] += 1

        sums = rows.total(move, len(keys) * _ROWS).reshape(len(keys), _ROWS, _SUMS)
        for m, s in zip(models, sums, strict=True):
            m.numbers += (s[:, :WIDTH] / _FIXED / np.maximum(s[:, WIDTH:], 1)).astype(np.float32)

    m = models[-1]
    fix = np.log(share[1] / share[0])  # in what is given, label 1 has these more odds
    weight = np.array([1 / share[0], 1 / share[1]])

    def apart(block) -> np.ndarray:
        """Logits by models that have not learned from the rows."""
        z = np.zeros(len(block.toxic))
        for key, model in list(zip(keys, models, strict=True))[: FOLDS]:
            at = np.flatnonzero(block.fold == key) if key >= 0 else np.arange(len(z))
            if len(at):
                z[at] = model.pooled(*block.some(at)) @ model.top + model.bias
        return z

    def loss(block, out):
        z, sign = apart(block), 2 * block.toxic - 1
        for i, a in enumerate(SCALES):
            each = np.logaddexp(0, -sign * np.clip(z * a - fix, -30, 30))
            out[:, i] += np.rint(np.bincount(block.toxic, weights=each, minlength=2) * (1 << 20)).astype(np.int64)

    m.scale, m.shift = SCALES[int((weight @ rows.total(loss, 2)[:, : len(SCALES)]).argmin())], -fix
    place = {x: i for i, x in enumerate(rows.langs, 1)}
    scale = m.scale

    def spread(block, out):
        at = (_logistic(apart(block) * scale - fix) * BINS).astype(np.int64)
        lang = np.array([place.get(x, 0) for x in block.lang])
        np.add.at(out, (at, block.toxic), 1)
        np.add.at(out, ((lang * (BINS + 1) + at)[lang > 0], block.toxic[lang > 0]), 1)

    def limit(by_bin: np.ndarray) -> float:
        above = np.cumsum(by_bin[::-1] * weight, 0)[::-1]
        good = np.flatnonzero((above[:, 1] >= PRECISION * above.sum(1)) & by_bin.any(1))
        return float(min(0.9, max(0.3, good[0] / BINS))) if len(good) else 0.9

    bins = rows.total(spread, (len(place) + 1) * (BINS + 1))[:, :2].reshape(-1, BINS + 1, 2)
    m.limits = {x: limit(b) for x, b in zip([None, *place], bins, strict=True)}
    return m


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learn from all texts of docs (doc_id, text, lang) that have labels (doc_id, toxic)."""
    rows = Spread(docs, labels)
    try:
        return train(rows)
    finally:
        discard(rows.blocks)


def score_texts(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, rejected) for each row of docs (doc_id, text, lang)."""
    def run(batches):
        for batch in batches:
            score = model.score(batch.column(1)) if model else np.zeros(batch.num_rows)
            limits = np.array([model.limits.get(x, model.limits[None]) for x in batch.column(2).to_pylist()]) if model else np.full(batch.num_rows, 2.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array(score >= limits, pa.bool_())], ["doc_id", "score", "rejected"])

    return docs.select("doc_id", "text", "lang").mapInArrow(run, "doc_id long, score double, rejected boolean")


def held_out():
    return id_mod(F.col("doc_id"), 4) == 2


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels whose crc32(doc_id) mod 4 is not 2 and score all rows; adds held_out and predicted."""
    found = score_texts(docs, fit(docs.where(~held_out()), labels.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "rejected")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not rejected, with their columns, from one pass over the texts."""
    model = fit(docs.where(~held_out()), labels.where(~held_out()))
    if model is None:
        return docs
    names = docs.columns
    at, lang = names.index("text"), names.index("lang")

    def run(batches):
        for batch in batches:
            limits = np.array([model.limits.get(x, model.limits[None]) for x in batch.column(lang).to_pylist()], np.float64)
            yield batch.filter(pa.array(model.score(batch.column(at)) < limits))

    return docs.mapInArrow(run, docs.schema)

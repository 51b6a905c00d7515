"""Document quality by a regularised quadratic discriminant.

Each text becomes a few statistics (counts as logarithms, shares as log odds), in one pass. Class means and covariances are sums over
all labelled rows, made in the tasks and added up by Spark, so nothing is sampled and the driver gets a few hundred numbers a
class. A class's covariance is shrunk towards the pooled one (share `pool`) and then towards its own diagonal (share `flat`). Both
shares, and the scale of the log-density difference, are those with the least log loss when each of four folds of the labelled
rows is scored by sums of the other three. The Cholesky factor of each class is inverted once, at fit; a score is the difference of
two squared Mahalanobis lengths with log determinants and the prior odds, through the logistic function.

Only the text decides a score. Edge cases: null and empty texts are texts without words; without rows of both labels every score
is the share of label 1 among the labelled rows (one half without any); null ids are scored and never labelled; repeated rows
get equal scores and count each; repeated labels of an id count each; other labels than 0 and 1 are left out; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Rolling, durable, id_mod, pieces, word_spans

STATISTICS = ("words", "word length", "spread of word lengths", "short words", "capitals", "symbols", "digits", "words that end in a sign", "sentence ends", "distinct words", "commonest word", "distinct runs of 4 words", "lines", "repeated lines", "bytes beyond ASCII")
POOL = (0.0, 0.1, 0.3, 0.6, 0.9)
FLAT = (0.01, 0.05, 0.2)
SCALE = (1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)
FOLDS = 4
_BYTE = np.arange(256)
_UPPER, _LETTER = (_BYTE >= 65) & (_BYTE <= 90), ((_BYTE | 32) >= 97) & ((_BYTE | 32) <= 122) & (_BYTE < 128)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_SIGN = (_BYTE > 32) & (_BYTE < 127) & ~_LETTER & ~_DIGIT
_SYMBOL = _SIGN & ~np.isin(_BYTE, [ord(c) for c in ".,;:!?'\"-()"])
_STOP = np.isin(_BYTE, [ord(c) for c in ".!?"])


def _distinct(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """By row: how many values differ, and how often the commonest occurs."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, row[at], np.diff(np.append(at, len(row))))
    return np.bincount(row[at], minlength=rows), most


def statistics(column: pa.Array) -> np.ndarray:
    """A row for each text, a column for each of STATISTICS."""
    out = np.zeros((len(column), len(STATISTICS)))
    for lo, hi, data, offsets in pieces(column):
        rows = hi - lo

        def count(mask: np.ndarray, data=data, offsets=offsets) -> np.ndarray:
            return np.diff(np.concatenate(([0], np.cumsum(mask[data])))[offsets])

        start, end, first = word_spans(data, offsets)
        rolling = Rolling(data, lower=True)
        n, row, length = np.diff(first), np.repeat(np.arange(rows), np.diff(first)), end - start
        by_row = lambda x, row=row, rows=rows: np.bincount(row, weights=x, minlength=rows)
        share = lambda k, of: np.log((k + 0.5) / (np.maximum(of - k, 0) + 0.5))
        mean = by_row(length) / np.maximum(n, 1)
        spread = np.sqrt(np.maximum(by_row(length.astype(float) ** 2) / np.maximum(n, 1) - mean**2, 0))
        word = rolling.spans(start, end)
        kinds, most = _distinct(row, word, rows)
        runs = np.flatnonzero(row[3:] == row[:-3]) if len(row) > 3 else np.zeros(0, np.int64)
        grams = (word[runs] * np.uint64(3) + word[runs + 1]) * np.uint64(5) + word[runs + 2]
        gram_kinds, _ = _distinct(row[runs], grams * np.uint64(7) + word[runs + 3], rows)
        line_start, line_end, line_first = word_spans(data, offsets, _BYTE == 10)
        n_lines = np.diff(line_first)
        line_kinds, _ = _distinct(np.repeat(np.arange(rows), n_lines), rolling.spans(line_start, line_end), rows)
        letters, size = count(_LETTER), np.diff(offsets)
        out[lo:hi] = np.stack([
            np.log1p(n), np.log1p(mean), np.log1p(spread), share(by_row(length <= 3), n), share(count(_UPPER), letters), share(count(_SYMBOL), size), share(count(_DIGIT), size),
            share(by_row(_SIGN[data[end - 1]] if len(end) else length), n), share(np.minimum(count(_STOP), n), n), share(kinds, n), share(most, n), share(gram_kinds, np.maximum(n - 3, 0)),
            np.log1p(n_lines), share(n_lines - line_kinds, n_lines), share(count(_BYTE >= 128), size),
        ], 1)
    return out


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of rows (doc_id, text): x has STATISTICS in order."""
    def run(batches):
        for batch in batches:
            x = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), _vectors(x)], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, x array<double>")


def _vectors(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1), pa.float64()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Sums:
    """Weights, sums and sums of products of rows, which add up."""

    def __init__(self, flat: np.ndarray, width: int = len(STATISTICS)):
        self.n, self.x, self.xx = flat[0], flat[1: width + 1], flat[width + 1:].reshape(width, width)

    @staticmethod
    def of(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        return np.concatenate(([weight.sum()], weight @ x, ((x * weight[:, None]).T @ x).reshape(-1)))

    def mean(self) -> np.ndarray:
        return self.x / self.n

    def scatter(self) -> np.ndarray:
        return self.xx - np.outer(self.x, self.x) / self.n


class Discriminant:
    """Two Gaussian classes with shrunk covariances. `sums`: label -> Sums."""

    def __init__(self, sums: dict[int, Sums], pool: float, flat: float, scale: float = 1.0):
        n = sum(s.n for s in sums.values())
        pooled = sum(s.scatter() for s in sums.values()) / n
        self.scale, self.prior = scale, np.log(sums[1].n / sums[0].n)
        self.classes = {}
        for label, s in sums.items():
            c = (1 - pool) * s.scatter() / s.n + pool * pooled
            c = (1 - flat) * c + flat * np.diag(np.diag(c)) + 1e-3 * np.eye(len(c))
            factor = np.linalg.cholesky(c)
            self.classes[label] = s.mean(), np.linalg.inv(factor).T, 2 * np.log(np.diag(factor)).sum()

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        log = {k: -0.5 * ((((x - mean) @ whiten) ** 2).sum(1) + det) for k, (mean, whiten, det) in self.classes.items()}
        return log[1] - log[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.difference(x) + self.prior, -30, 30)))


class Constant:
    def __init__(self, share: float):
        self.share = share

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def _summed(rows: DataFrame, key: list[str]) -> dict:
    """Element-wise sums of the arrays `part` by key, a few rows of fixed length."""
    each = rows.select(*key, F.posexplode("part").alias("i", "v")).groupBy(*key, "i").agg(F.sum("v").alias("v"))
    out: dict = {}
    for r in sorted(each.collect()):
        out.setdefault(tuple(r[: len(key)]), []).append(r.v)
    return {k: np.array(v) for k, v in out.items()}


def fit(found: DataFrame, labels: DataFrame, fold) -> Discriminant | Constant:
    """Learn from rows of found (doc_id, x) that have labels (doc_id, quality); fold: a column from 0 to FOLDS - 1 over doc_id."""
    width = len(STATISTICS)
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(*(F.count(F.when(F.col("quality") == k, 1)).cast("double").alias(f"n{k}") for k in (0, 1)))
    rows = durable(found.join(known, "doc_id").select(fold.cast("int").alias("fold"), "x", "n0", "n1"))

    def add_up(batches):
        for batch in batches:
            folds, x = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            parts = [(f, k, Sums.of(x[folds == f], batch.column(2 + k).to_numpy()[folds == f])) for f in np.unique(folds) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.int32()), _vectors(np.array([p[2] for p in parts]).reshape(-1, 1 + width + width**2))], ["fold", "label", "part"])

    parts = {k: v for k, v in _summed(rows.mapInArrow(add_up, "fold int, label int, part array<double>"), ["fold", "label"]).items() if v[0]}

    def sums(leave: int | None) -> dict[int, Sums]:
        some = {k: [v for (f, label), v in parts.items() if label == k and f != leave] for k in (0, 1)}
        return {k: Sums(sum(v)) for k, v in some.items() if v}

    whole = sums(None)
    if len(whole) < 2:
        return Constant(0.5 if not whole else float(1 in whole))
    grid = [(pool, flat) for pool in POOL for flat in FLAT]
    by_fold = {f: sums(f) for f in range(FOLDS)}
    if any(len(s) < 2 or min(x.n for x in s.values()) < 2 * width for s in by_fold.values()):
        return Discriminant(whole, POOL[-1], FLAT[-1], SCALE[2])
    models = {f: [Discriminant(s, *g) for g in grid] for f, s in by_fold.items()}

    def losses(batches):
        for batch in batches:
            folds, x = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            n0, n1 = (batch.column(i).to_numpy() for i in (2, 3))
            part = np.zeros((len(grid), len(SCALE)))
            for f in np.unique(folds):
                at = folds == f
                for i, m in enumerate(models[int(f)]):
                    z = np.clip(m.difference(x[at])[:, None] * SCALE + m.prior, -30, 30)
                    part[i] += n1[at] @ np.logaddexp(0, -z) + n0[at] @ np.logaddexp(0, z)
            yield pa.RecordBatch.from_arrays([_vectors(part.reshape(1, -1))], ["part"])

    loss = _summed(rows.mapInArrow(losses, "part array<double>"), [])[()].reshape(len(grid), len(SCALE))
    i, j = np.unravel_index(loss.argmin(), loss.shape)
    return Discriminant(whole, *grid[i], SCALE[j])


def score_statistics(found: DataFrame, model: Discriminant | Constant) -> DataFrame:
    """(doc_id, score) for each row (doc_id, x)."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1), len(STATISTICS))), pa.float64())], ["doc_id", "score"])

    return found.mapInArrow(run, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, score double")


def held_out():
    return id_mod(F.col("doc_id"), 5) == 0


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels whose crc32(doc_id) mod 5 is not 0 and score all rows; adds held_out and predicted."""
    found = durable(text_statistics(docs))
    model = fit(found.where(~held_out()), labels.where(~held_out()), id_mod(F.col("doc_id"), 5) - 1)
    return score_statistics(found, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

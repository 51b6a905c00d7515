"""Shared pieces: durable tables, document loading, and byte-level views of Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.storage import discard, durable, shared_dir  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"
"""A word is a run of anything but the six ASCII white-space characters."""


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Lower the session's Arrow batches to so many rows and bytes, as texts may be long; smaller settings stay. The queries and
    the corpus stages call this, as a lazy result is computed after they return; the operators leave the session alone."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def crc_of(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def n_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def digest(text: Column) -> Column:
    """16 bytes of SHA-256; null is as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32))


# ---- bytes of Arrow text ----

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets as int64 of length rows + 1) of a string or binary column; null rows are empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    kind = np.dtype(np.int64 if wide else np.int32)
    offsets = np.frombuffer(offs, kind, len(column) + 1, column.offset * kind.itemsize).astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def pieces(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of whole rows of about `most` bytes: (first row, end row, bytes, offsets from 0).

    A longer row comes alone, so memory is bounded by `most` or the longest single text."""
    data, offsets = utf8(column)
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi, data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        lo = hi


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ODD = 0x9E3779B97F4A7C15
_BYTE_CODE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_CODE = _BYTE_CODE[LOWER]
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, (1 << 20) + 4096)
        inverse = pow(_ODD, -1, 1 << 64)
        _powers[:] = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (_ODD, inverse)]
    return _powers


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (the splitmix64 constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """64-bit polynomial hashes of any byte span in O(1), from one prefix sum."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        power, self.inverse = _power_tables(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_LOWER_CODE if lower else _BYTE_CODE)[data] * power[: len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def windows(self, k: int) -> np.ndarray:
        n = max(0, len(self.sums) - k)
        return mix64((self.sums[k:] - self.sums[:n]) * self.inverse[:n])


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words before each row) of the runs of bytes outside `gap`; words never cross rows."""
    inside = ~gap[data]
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    if len(data):
        after[-1] = False
        after[:-1] = inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    after[ends] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte spans as an Arrow string array; spans must be whole UTF-8."""
    lens = end - start
    offsets = np.concatenate(([0], np.cumsum(lens)))
    body = data[np.repeat(start - offsets[:-1], lens) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(body))]).cast(pa.string())

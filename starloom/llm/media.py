"""ISO media containers: writing text as raw frames, walking boxes and reading sample tables.

The payload is stored as 8 x 8 grey frames of one byte a pixel, so a sample is 64 bytes, in a file of ftyp, moov and
mdat boxes with the usual sample tables (stts, stsc, stsz, stco or co64, stss). Reading walks the nested boxes of
any such file, decodes the tables to byte ranges, and never decodes a payload: codec, duration and keyframe ranges
come from the tables alone.

Edge cases: null and empty texts are one frame of zeros; a file without a track, with a truncated box or with sizes that
do not fit raises ValueError; boxes of unknown type are skipped; sizes of 0 (to the end) and 1 (64 bits) are read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

SAMPLE = 64
KEY_EVERY = 30
"""Frames from one keyframe to the next; also the frames of a chunk."""
RATE = 25
TIMESCALE = 600
NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"mvex", b"udta"}
DEEPEST = 32
"""Boxes inside one another; files have eight."""


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I", len(body) + 8) + kind + body


def _full(kind: bytes, *parts: bytes, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", flags), *parts)


def _u32(values) -> bytes:
    return np.asarray(values, ">u4").tobytes()


def pad(data: bytes) -> bytes:
    """Zeros up to a positive multiple of 64 bytes."""
    return data + bytes(max(SAMPLE, -(-len(data) // SAMPLE) * SAMPLE) - len(data))


def write_media(payload: bytes) -> bytes:
    """A container with the payload as frames; equal payloads give equal files."""
    n = len(payload) // SAMPLE
    if not n or len(payload) % SAMPLE:
        raise ValueError("the payload must be whole samples")
    step = TIMESCALE // RATE
    chunks = -(-n // KEY_EVERY)
    last = n - (chunks - 1) * KEY_EVERY
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", 8, 8, 0x480000, 0x480000, 0, 1), bytes(32), struct.pack(">Hh", 40, -1))
    stsc = [(1, KEY_EVERY, 1), (chunks, last, 1)] if chunks > 1 and last != KEY_EVERY else [(1, min(n, KEY_EVERY), 1)]
    tables = (
        _full(b"stsd", struct.pack(">I", 1), entry), _full(b"stts", struct.pack(">III", 1, n, step)), _full(b"stss", struct.pack(">I", chunks), _u32(np.arange(chunks) * KEY_EVERY + 1)),
        _full(b"stsc", struct.pack(">I", len(stsc)), _u32(stsc)), _full(b"stsz", struct.pack(">II", SAMPLE, n)),
    )

    def moov(first: int) -> bytes:
        places = first + np.arange(chunks, dtype=np.int64) * (KEY_EVERY * SAMPLE)
        wide = int(places[-1]) >= 1 << 32
        stco = _full(b"co64" if wide else b"stco", struct.pack(">I", chunks), places.astype(">u8" if wide else ">u4").tobytes())
        return _box(
            b"moov", _full(b"mvhd", struct.pack(">IIIIIH", 0, 0, TIMESCALE, n * step, 0x10000, 0x100), bytes(10), matrix, bytes(24), struct.pack(">I", 2)),
            _box(b"trak", _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n * step), bytes(16), matrix, struct.pack(">II", 8 << 16, 8 << 16), flags=3),
                 _box(b"mdia", _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, n * step, 0x55C4, 0)), _full(b"hdlr", bytes(4), b"vide", bytes(12), b"frames\0"),
                      _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), _box(b"stbl", *tables, stco)))),
        )

    head = len(ftyp) + len(moov(0))
    large = len(payload) + 8 >= 1 << 32
    start = struct.pack(">I4sQ", 1, b"mdat", len(payload) + 16) if large else struct.pack(">I4s", len(payload) + 8, b"mdat")
    return b"".join((ftyp, moov(head + len(start)), start, payload))


def boxes(data: bytes) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path of box types, start and end of the content) of every box, parents before children.

    Boxes may be nested to any depth the file has room for. What is left of a box with under 8 bytes is an error, but for the end mark of
    four zero bytes that user data may have."""
    todo: list[tuple[int, int, tuple[bytes, ...]]] = [(0, len(data), ())]
    while todo:
        lo, hi, path = todo.pop()
        if lo >= hi:
            continue
        if hi - lo < 8:
            if path[-1:] == (b"udta",) and not any(data[lo:hi]):
                continue
            raise ValueError("truncated box header")
        size, kind = struct.unpack_from(">I4s", data, lo)
        body = lo + 8
        if size == 1:
            if hi - lo < 16:
                raise ValueError("truncated box header")
            size, body = struct.unpack_from(">Q", data, body)[0], lo + 16
        end = hi if size == 0 else lo + size
        if end > hi or end < body:
            raise ValueError(f"box {kind!r} does not fit")
        todo.append((end, hi, path))
        if kind in NESTED:
            if len(path) >= DEEPEST:
                raise ValueError("boxes are nested too deeply")
            todo.append((body, end, (*path, kind)))
        yield (*path, kind), body, end


def read_tracks(data: bytes) -> list[dict]:
    """Per track: handler, codec, timescale, duration, and offset, size and keyframe flag of each sample."""
    tracks: list[dict] = []
    for path, lo, hi in boxes(data):
        kind = path[-1]
        if kind == b"trak":
            tracks.append({})
        if not tracks or len(path) < 3 or path[1] != b"trak":
            continue
        t = tracks[-1]

        def u32(at: int, n: int, kind_=">u4", lo=lo, hi=hi) -> np.ndarray:
            """n numbers of a table, which must end within its box."""
            if lo + at + n * np.dtype(kind_).itemsize > hi:
                raise ValueError("beyond the box")
            return np.frombuffer(data, kind_, n, lo + at).astype(np.int64)

        try:
            if kind == b"mdhd":
                t["timescale"], t["duration"] = struct.unpack_from(">IQ", data, lo + 20) if data[lo] == 1 else struct.unpack_from(">II", data, lo + 12)
            elif kind == b"hdlr":
                t["handler"] = data[lo + 8: lo + 12].decode("latin1")
            elif kind == b"stsd":
                t["codec"] = data[lo + 12: lo + 16].decode("latin1")
            elif kind in (b"stts", b"stsc", b"stss"):
                width = {b"stts": 2, b"stsc": 3, b"stss": 1}[kind]
                t[kind] = u32(8, int(u32(4, 1)[0]) * width).reshape(-1, width)
            elif kind == b"stsz":
                same, n = (int(x) for x in u32(4, 2))
                if same * n > len(data):
                    raise ValueError("more samples than bytes")
                t[kind] = np.full(n, same) if same else u32(12, n)
            elif kind in (b"stco", b"co64"):
                n = int(u32(4, 1)[0])
                t[b"stco"] = u32(8, n, ">u4" if kind == b"stco" else ">u8")
        except (struct.error, ValueError, IndexError) as e:
            raise ValueError(f"truncated table {kind!r}") from e
    if not tracks:
        raise ValueError("no track")
    for t in tracks:
        missing = [k for k in (b"stsz", b"stco", b"stsc", "timescale", "handler", "codec") if k not in t]
        if missing:
            raise ValueError(f"a track without {missing[0]!r}")
        size, chunk, runs = t[b"stsz"], t[b"stco"], t[b"stsc"]
        spans = np.diff(np.append(runs[:, 0], len(chunk) + 1))
        if (spans < 0).any() or len(runs) and runs[0, 0] != 1:
            raise ValueError("chunks of stsc are out of order")
        per = np.repeat(runs[:, 1], spans)
        if per.sum() != len(size):
            raise ValueError("sample counts of stsc and stsz differ")
        if b"stss" in t and len(t[b"stss"]) and not 1 <= t[b"stss"].min() <= t[b"stss"].max() <= len(size):
            raise ValueError("a keyframe beyond the samples")
        before = np.concatenate(([0], np.cumsum(size)))
        first = np.cumsum(per) - per
        t["size"], t["offset"] = size, np.repeat(chunk - before[first], per) + before[:-1]
        if len(size) and (t["offset"] + size).max() > len(data):
            raise ValueError("samples beyond the end")
        t["key"] = np.zeros(len(size), bool)
        t["key"][t[b"stss"][:, 0] - 1 if b"stss" in t else slice(None)] = True
    return tracks


def payload_of(data: bytes, track: dict) -> bytes:
    """The samples' bytes in order; adjoining samples are cut out as one range."""
    if not len(track["size"]):
        return b""
    start, end = track["offset"], track["offset"] + track["size"]
    new = np.flatnonzero(np.append(True, start[1:] != end[:-1]))
    return b"".join(data[a:b] for a, b in zip(start[new], end[np.append(new[1:] - 1, len(end) - 1)], strict=True))


def describe(track: dict) -> str:
    """codec, handler, duration, samples, keyframes, then the byte range of the first and last keyframe."""
    keys = np.flatnonzero(track["key"])
    at = [f"{track['offset'][k]}+{track['size'][k]}" for k in ([keys[0], keys[-1]] if len(keys) else [])]
    return f"codec={track['codec']};handler={track['handler']};duration={track['duration']}/{track['timescale']};samples={len(track['size'])};keyframes={len(keys)};ranges={','.join(at)}"


def keyframe_ranges(track: dict) -> list[dict]:
    """start and bytes of each keyframe."""
    return [{"start": int(track["offset"][k]), "bytes": int(track["size"][k])} for k in np.flatnonzero(track["key"])]


_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("bytes", pa.int64())]))


def _media_rows(batches):
    for batch in batches:
        columns: list[list] = [[] for _ in range(8)]
        for text in batch.column(1):
            raw = (text.as_py() or "").encode()
            stored = write_media(pad(raw))
            track = read_tracks(stored)[0]
            back = payload_of(stored, track)
            for c, v in zip(columns, (len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-SAMPLE:]), len(stored), hashlib.sha256(stored).hexdigest(), describe(track), keyframe_ranges(track)), strict=True):
                c.append(v)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), _RANGES), strict=True)]],
                                         ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "keyframes"])


def media_digests(docs: DataFrame) -> DataFrame:
    """Store each text of docs (doc_id, text) as a container, read it back, and describe it."""
    return docs.select("doc_id", "text").mapInArrow(_media_rows, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, keyframes array<struct<start: long, bytes: long>>")


def _encode(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([write_media(pad((t.as_py() or "").encode())) for t in batch.column(1)], pa.binary())], ["doc_id", "media"])


def store_media(docs: DataFrame) -> DataFrame:
    """(doc_id, media binary) for each row of docs (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(_encode, "doc_id long, media binary")


def _probe(frames):
    for frame in frames:
        rows = []
        for i, data in zip(frame.iloc[:, 0], frame.iloc[:, 1], strict=True):
            try:
                for k, t in enumerate(read_tracks(data)) if data is not None else ():
                    rows.append((i, k, t["codec"], t["handler"], t["duration"] / t["timescale"] if t["timescale"] else None, len(t["size"]), keyframe_ranges(t), None))
            except (ValueError, IndexError, OverflowError, MemoryError, struct.error) as e:
                rows.append((i, None, None, None, None, None, None, str(e) or type(e).__name__))
        yield pd.DataFrame(rows, columns=["doc_id", "track", "codec", "handler", "seconds", "samples", "keyframes", "error"]).astype({c: "Int64" for c in ("doc_id", "track", "samples")})


def probe_media(media: DataFrame) -> DataFrame:
    """One row per track of media (doc_id, media): codec, seconds, samples and all keyframe byte ranges. Null media: no row.
    A damaged file is one row with what is wrong in `error` and nulls beside it."""
    return media.select("doc_id", "media").mapInPandas(_probe, "doc_id long, track int, codec string, handler string, seconds double, samples long, keyframes array<struct<start: long, bytes: long>>, error string")

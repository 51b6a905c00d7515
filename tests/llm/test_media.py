"""Containers: round trips, nested boxes, damage."""

import hashlib
import struct
import zlib

import pytest

from starloom.llm import media


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 64 * 30, 64 * 30 + 1, 64 * 95, 200_001])
def test_round_trip(n):
    payload = media.pad(bytes(i * 7 % 251 for i in range(n)))
    assert len(payload) % 64 == 0 and len(payload) >= 64
    stored = media.write_media(payload)
    (track,) = media.read_tracks(stored)
    assert media.payload_of(stored, track) == payload
    frames = len(payload) // 64
    assert track["codec"] == "raw " and track["handler"] == "vide" and track["duration"] == frames * 24 and track["key"].sum() == -(-frames // 30)
    assert sum(struct.unpack_from(">I", stored, lo - 8)[0] for path, lo, _ in media.boxes(stored) if len(path) == 1) == len(stored)


def test_damage():
    stored = media.write_media(media.pad(b"x" * 500))
    for bad in (stored[:-1], stored[:40], stored[:10], b"", *(stored.replace(k, b"free") for k in (b"stsz", b"stsc", b"stco", b"stsd", b"hdlr", b"mdhd"))):
        with pytest.raises(ValueError):
            media.read_tracks(bad)


def test_columns(spark, docs, edge, empty):
    for d in (docs, edge):
        rows, texts = media.media_digests(d).collect(), d.select("doc_id", "text").collect()
        want = []
        for t in texts:
            raw = (t.text or "").encode()
            p = media.pad(raw)
            want.append((t.doc_id or -1, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
        assert sorted((r.doc_id or -1, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == sorted(want)
        assert all(r.media_bytes > r.payload_bytes and "codec=raw " in r.feature for r in rows)
    assert media.media_digests(empty).collect() == []


def test_probe(spark, docs):
    rows = media.probe_media(media.store_media(docs)).collect()
    assert len(rows) == docs.count() and all(len(r.keyframes) == -(-r.samples // 30) for r in rows)


def test_damaged_among_sound(spark):
    sound = media.write_media(media.pad(b"x" * 500))
    d = spark.createDataFrame([(1, sound), (2, sound[:100]), (None, b"junk"), (4, None), (5, sound.replace(b"stsz", b"free")), (6, sound)], "doc_id long, media binary")
    rows = {r.doc_id: r for r in media.probe_media(d).collect()}
    assert set(rows) == {1, 2, None, 5, 6} and all((rows[i].error is None) == (i in (1, 6)) for i in rows) and rows[6].samples == 8 and rows[2].track is None


def nested(depth):
    body = b""
    for _ in range(depth):
        body = struct.pack(">I4s", len(body) + 8, b"moov") + body
    return body


def test_hostile_files_are_rows(spark):
    """A sample count of billions, boxes in boxes in boxes, user data with its end mark, and a table beyond its box."""
    stored = media.write_media(media.pad(b"x" * 500))
    at = stored.index(b"stsz")
    huge = stored[: at + 8] + struct.pack(">II", 64, 0xFFFFFFFF) + stored[at + 16:]
    wide = stored[: at + 8] + struct.pack(">II", 0, 8) + stored[at + 16:]
    mark = struct.pack(">I4s", 12, b"udta") + bytes(4)
    odd = struct.pack(">I4s", 12, b"udta") + b"abcd"
    d = spark.createDataFrame([(1, huge), (2, nested(5000)), (3, stored + mark), (4, wide), (5, stored + odd), (6, stored)], "doc_id long, media binary")
    rows = {r.doc_id: r for r in media.probe_media(d).collect()}
    assert {i for i, r in rows.items() if r.error is None} == {3, 6} and len(rows) == 6
    assert "more samples" in rows[1].error or "truncated" in rows[1].error


def test_feature_and_stored_form_from_the_layout(spark):
    """Digest, duration and every keyframe range of a stored file, from its bytes and not from the operator's reader."""
    text = "é" + "word " * 2000
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = media.media_digests(d).first()
    raw = text.encode()
    payload = raw + bytes(-len(raw) % 64)
    stored = media.store_media(d).first().media
    begin, frames = bytes(stored).index(payload), len(payload) // 64
    assert r.media_sha256 == hashlib.sha256(stored).hexdigest() and r.media_bytes == len(stored)
    assert [(k.start, k.bytes) for k in r.keyframes] == [(begin + 64 * i, 64) for i in range(0, frames, 30)]
    assert r.feature == f"codec=raw ;handler=vide;duration={24 * frames}/600;samples={frames};keyframes={-(-frames // 30)};ranges={begin}+64,{begin + 64 * (30 * ((frames - 1) // 30))}+64"

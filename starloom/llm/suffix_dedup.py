"""Removing repeated passages by sorting sampled suffixes.

A passage is a string of LENGTH bytes; each byte of it goes if the same string starts in a document with a smaller id.

Exact copies come first: of equal texts of at least LENGTH bytes all but those with the least id lose everything, and only
distinct texts, each with the least id of its documents, go on.

Sample. Suffixes are sampled by content, not by position modulo three: an anchor is the place of the least hash among
the K-byte strings inside some LENGTH-byte window. A window finds its anchor from its own bytes, so equal windows of
different documents have their anchors at the same offset, and the anchors cover all windows as a difference cover
covers all pairs of positions, at a fraction of 2 / (LENGTH - K + 2) of the suffixes. Anchors whose K bytes occur in one
document only cannot be in a repeated passage and are left out.

Sort. A sampled suffix is cut into a triple of blocks of a third of LENGTH bytes, and the triples are sorted over the cluster
by range partitions (equal suffixes with equal lead bytes count once, with the least id among them). A triple spans the
whole LENGTH bytes that decide, so the names that follow from comparing adjacent triples need no recursion.

Merge. The other suffixes start a few bytes before an anchor; each is merged by its lead bytes and the name of the sampled
suffix that follows, and adjacent equal prefixes of LENGTH bytes form a class, whose least id is the verdict for all.
First blocks that over HOT suffixes may share (a common line in many surroundings) are not merged in memory: each of their
windows becomes a row, and the least id of equal windows comes from a grouped minimum.
Verdicts go back to the documents by a join, and the spans of a document are joined into maximal runs.

Edge cases: null and empty texts, and texts under LENGTH bytes, lose nothing; null ids come after all others; rows that share
an id do not take from each other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Rolling, digest, discard, durable, mix64, pieces

LENGTH = 50
K = 20
HOT, SLOTS = 50_000, 1 << 16
"""Suffixes whose first blocks fall into one of SLOTS hash slots, beyond which the slot is not merged in one task."""
LAST = (1 << 63) - 1
"""Stands for a null id."""


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, first window, last window, hash of the K bytes), places counted in `data`."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    h = Rolling(data).windows(k)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the first
    span, low = 1, key
    want = length - k + 1
    while span * 2 <= want:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[: len(low) - (want - span)], low[want - span:])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # anchor of the window at each place
    n = np.diff(offsets)
    ok = np.zeros(len(at) + 1, np.int64)
    has = n >= length
    np.add.at(ok, offsets[:-1][has], 1)
    np.add.at(ok, offsets[1:][has] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(ok)[:-1] > 0)
    a = at[window]
    if not len(window):
        return none, none, none, none, none.astype(np.uint64)
    row = np.searchsorted(offsets, window, "right") - 1
    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (row[1:] != row[:-1])))
    end = np.append(new[1:], len(window)) - 1
    return row[new], a[new], window[new], window[end], h[a[new]]


def _anchor_hashes(batches):
    for batch in batches:
        for lo, hi, data, offsets in pieces(batch.column(2)):
            row, a, _, _, h = anchors(data, offsets)
            ends = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
            found = pa.StructArray.from_arrays([pa.array(h.view(np.int64)), pa.array((a - offsets[row]).astype(np.int32))], ["h", "pos"])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), found)], ["id", "t", "anchors"])


def _binary(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    lens = end - start
    offs = np.concatenate(([0], np.cumsum(lens)))
    body = data[np.repeat(start - offs[:-1], lens) + np.arange(offs[-1])]
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))])


def _contexts(batches):
    """(id, t, pos, lead, around): the bytes that the windows of an anchor hold, and how many of them lie before it."""
    for batch in batches:
        wanted, bounds = batch.column(3).values.to_numpy(), batch.column(3).offsets.to_numpy()
        for lo, hi, data, offsets in pieces(batch.column(2)):
            row, a, first, last, _ = anchors(data, offsets)
            mine = np.repeat(offsets[:-1], np.diff(bounds[lo: hi + 1])) + wanted[bounds[lo]: bounds[hi]]
            chosen = np.isin(a, mine)
            row, a, first, last = row[chosen], a[chosen], first[chosen], last[chosen]
            take = pa.array(row + lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array((a - offsets[row]).astype(np.int32)), pa.array((a - first).astype(np.int32)), _binary(data, first, last + LENGTH)],
                ["id", "t", "pos", "lead", "around"])


def _matrix(column: pa.Array, width: int, right: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes padded with zeros to width, lengths); right: the last byte comes first."""
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(1, np.uint8)
    n = np.diff(offsets)
    j = np.arange(width)
    at = offsets[1:, None] - 1 - j if right else offsets[:-1, None] + j
    return np.where(j < n[:, None], data[np.clip(at, 0, len(data) - 1)], 0), n


def _merge(table: pa.Table) -> pa.Table:
    """Verdicts of rows (lead, b1, b2, b3, least, docs, k1, k2) in the order of (b1, b2, b3): per row, the least id of each window's class."""
    n, third = table.num_rows, -(-LENGTH // 3)
    blocks = [_matrix(table.column(f"b{i}").combine_chunks(), third) for i in (1, 2, 3)]
    tail = np.concatenate([m for m, _ in blocks], 1)[:, :LENGTH]
    size = sum(x for _, x in blocks)
    lead, ahead = _matrix(table.column("lead").combine_chunks(), LENGTH - K, right=True)
    least = table.column("least").to_numpy()
    differ = tail[1:] != tail[:-1]
    common = np.append(0, np.where(differ.any(1), differ.argmax(1), LENGTH)) if n else np.zeros(0, np.int64)
    common[1:] = np.minimum(common[1:], np.minimum(size[1:], size[:-1]))  # of each suffix and the one before
    best = np.full((n, LENGTH - K + 1), LAST)
    valid = np.zeros((n, LENGTH - K + 1), bool)
    hashed = np.zeros(n, np.uint64)
    for o in range(LENGTH - K + 1):
        if o:
            hashed = mix64(hashed * np.uint64(0x9E3779B97F4A7C15) + lead[:, o - 1].astype(np.uint64) + np.uint64(1))
        rows = np.flatnonzero((size >= LENGTH - o) & (ahead >= o))
        if not len(rows):
            continue
        name = np.cumsum(common < LENGTH - o)[rows]  # adjacent suffixes with the same first LENGTH - o bytes have one name
        order = np.lexsort((hashed[rows], name))
        s, same = rows[order], np.zeros(len(rows), bool)
        # adjacent merged suffixes are equal if the names and all o lead bytes are
        same[1:] = (name[order][1:] == name[order][:-1]) & (lead[s[1:], :o] == lead[s[:-1], :o]).all(1)
        group = np.flatnonzero(~same)
        best[s, o] = np.repeat(np.minimum.reduceat(least[s], group), np.diff(np.append(group, len(s))))
        valid[s, o] = True
    keep = (table.column("docs").to_numpy() > 1) | (valid & (best < least[:, None])).any(1)
    best, valid = best[keep], valid[keep]
    start = valid.copy()
    start[:, 1:] &= ~valid[:, :-1] | (best[:, 1:] != best[:, :-1])
    r, o = np.nonzero(start)
    stop = valid.copy()
    stop[:, :-1] &= ~valid[:, 1:] | (best[:, 1:] != best[:, :-1])
    _, e = np.nonzero(stop)
    runs = pa.StructArray.from_arrays([pa.array(o.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(best[r, o])], ["near", "far", "least"])
    mask = pa.array(keep)
    return pa.table({"k1": table.column("k1").filter(mask), "k2": table.column("k2").filter(mask), "runs": pa.ListArray.from_arrays(pa.array(np.searchsorted(r, np.arange(len(best) + 1)).astype(np.int32)), runs)})


def _verdicts(batches):
    """Sorted batches in, verdicts out; suffixes with the same first block stay together."""
    held: list[pa.RecordBatch] = []

    def out():
        yield from _merge(pa.Table.from_batches(held)).to_batches(max_chunksize=20_000)

    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if rows > 100_000:
            first = batch.column(1)
            last = held[-1].column(1)[-1]
            k = 0
            while k < batch.num_rows and first[k].equals(last):
                k += 1
            if k < batch.num_rows:
                if k:
                    held.append(batch.slice(0, k))
                yield from out()
                held, rows, batch = [], 0, batch.slice(k)
        held.append(batch)
        rows += batch.num_rows
    if held:
        yield from out()


def _keys() -> list[Column]:
    return [F.xxhash64("lead", "around").alias("k1"), F.xxhash64(F.lit(1), "around", "lead").alias("k2")]


def _blocks() -> list[Column]:
    """The bytes before an anchor, and its suffix in three blocks."""
    third, before = -(-LENGTH // 3), F.col("lead")
    cuts = [before + i * third + 1 for i in range(3)]
    return [F.substring("around", F.lit(1), before).alias("lead"), *[F.substring("around", at, F.lit(third)).alias(f"b{i + 1}") for i, at in enumerate(cuts)]]


def _slot() -> Column:
    return F.pmod(F.xxhash64(F.substring("around", F.col("lead") + 1, F.lit(-(-LENGTH // 3)))), F.lit(SLOTS)).alias("slot")


def _hot_verdicts(contexts: DataFrame) -> DataFrame:
    """What _merge gives, of rows (lead, around, least, docs), by a grouped minimum over all their windows."""
    windows = contexts.select("lead", "around", "least", "docs", *_keys()).withColumn("o", F.explode(F.sequence(F.lit(0), F.least("lead", F.lit(LENGTH - K)))))
    windows = windows.where(F.octet_length("around") >= F.col("lead") - F.col("o") + LENGTH).withColumn("w", F.substring("around", F.col("lead") - F.col("o") + 1, F.lit(LENGTH)))
    windows = windows.select("k1", "k2", "o", "least", "docs", F.xxhash64("w").alias("w1"), F.xxhash64(F.lit(1), "w").alias("w2"))
    best = windows.groupBy("o", "w1", "w2").agg(F.min("least").alias("best"))
    per = windows.join(best, ["o", "w1", "w2"]).where("docs > 1 OR best < least").groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("o", "best"))).alias("all"))
    # offsets in a row with the same verdict are one run
    runs = """aggregate(all, cast(array() as array<struct<near: int, far: int, least: bigint>>), (r, x) ->
        if(size(r) > 0 and r[size(r) - 1].far = x.o - 1 and r[size(r) - 1].least = x.best,
           concat(slice(r, 1, size(r) - 1), array(struct(r[size(r) - 1].near as near, x.o as far, x.best as least))),
           concat(r, array(struct(x.o as near, x.o as far, x.best as least)))))"""
    return per.select("k1", "k2", F.expr(runs).alias("runs"))


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, dig, spans array<struct<s, e>>) for each distinct text, with the least id of the documents that have it; spans are
    the bytes to remove from these documents, unmerged, or null."""
    known = docs.select(_id().alias("id"), digest(F.col("text")).alias("dig"), F.coalesce("text", F.lit("")).alias("text"))
    texts = durable(known.groupBy("dig").agg(F.min("id").alias("id"), F.first("text").alias("text")).withColumn("t", F.monotonically_increasing_id()))
    plain = texts.select("id", "t", "text")
    found = plain.mapInArrow(_anchor_hashes, "id long, t long, anchors array<struct<h: long, pos: int>>").select("id", "t", F.explode("anchors").alias("a")).select("id", "t", "a.h", "a.pos")
    often = durable(found.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h"))
    chosen = durable(found.select("t", "h", "pos").join(often, "h", "left_semi").groupBy("t").agg(F.collect_set("pos").alias("at")))
    discard(often)
    contexts = plain.join(chosen, "t").select("id", "t", "text", "at").mapInArrow(_contexts, "id long, t long, pos int, lead int, around binary")
    distinct = durable(contexts.groupBy("lead", "around").agg(F.min("id").alias("least"), F.count("*").alias("docs")))
    hot = durable(distinct.groupBy(_slot()).agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("slot"))
    some = not hot.isEmpty()
    slotted = distinct.withColumn("slot", _slot())
    cold = slotted.join(F.broadcast(hot), "slot", "left_anti") if some else distinct  # at most SLOTS numbers
    ordered = cold.select(*_blocks(), "least", "docs", *_keys()).repartitionByRange("b1").sortWithinPartitions("b1", "b2", "b3")
    verdicts = durable(ordered.mapInArrow(_verdicts, "k1 long, k2 long, runs array<struct<near: int, far: int, least: long>>"))
    if some:
        more = durable(_hot_verdicts(slotted.join(F.broadcast(hot), "slot", "left_semi")))
        written, verdicts = [verdicts, more], verdicts.unionByName(more)
    else:
        written = [verdicts]
    discard(distinct, hot)
    hit = contexts.select("id", "t", "pos", *_keys()).join(verdicts, ["k1", "k2"])
    hit = hit.select("t", F.expr("transform(filter(runs, r -> r.least < id), r -> struct(pos - r.far as s, pos - r.near + %d as e))" % LENGTH).alias("w")).where("size(w) > 0")
    spans = durable(hit.groupBy("t").agg(F.flatten(F.collect_list("w")).alias("spans")))
    discard(chosen, *written)
    out = durable(texts.select("id", "dig", "t").join(spans, "t", "left").select("id", "dig", "spans"))
    discard(texts, spans)
    return out


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of (start, end) rows."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.append(True, spans[1:, 0] > reach[:-1]))
    return np.stack([spans[new, 0], reach[np.append(new[1:], len(spans)) - 1]], 1)


def _cut_rows(batch: pa.RecordBatch):
    """(raw bytes, runs, remaining bytes) of each row (text, first, spans, ...): rows that are not first are copies and go whole."""
    for t, first, s in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
        raw = (t.as_py() or "").encode()
        if not first.is_valid and len(raw) >= LENGTH:
            yield raw, np.array([[0, len(raw)]]), b""
        elif not s.is_valid:
            yield raw, np.zeros((0, 2), np.int64), raw
        else:
            v = s.values
            runs = merged(np.stack([v.field(0).to_numpy(), v.field(1).to_numpy()], 1).astype(np.int64))
            ends = np.concatenate(([0], runs[:, 1]))
            yield raw, runs, b"".join(raw[a:b] for a, b in zip(ends, np.append(runs[:, 0], len(raw)), strict=True))


def _digests(batches):
    for batch in batches:
        rows = [(len(raw), len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest(), [{"s": int(a), "e": int(b)} for a, b in runs]) for raw, runs, left in _cut_rows(batch)]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([batch.column(3), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), strict=True)]],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def _with_spans(docs: DataFrame) -> DataFrame:
    """(text, first, spans, row): the rows of docs as structs, so that no column of theirs can clash."""
    rows = docs.select(_id().alias("id"), digest(F.col("text")).alias("dig"), F.struct("*").alias("row"))
    return rows.join(repeated_spans(docs).withColumn("first", F.lit(True)), ["id", "dig"], "left").select("row.text", "first", "spans", "row")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for each row of docs (doc_id, text)."""
    rows = _with_spans(docs.select("doc_id", "text")).select("text", "first", "spans", F.col("row.doc_id").alias("doc_id"))
    return rows.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<s: long, e: long>>")


def cut_passages(docs: DataFrame) -> DataFrame:
    """docs with the repeated passages cut out of text; bytes left over from a cut character become U+FFFD."""
    names, schema = docs.columns, docs.schema
    at = names.index("text")

    def run(batches):
        for batch in batches:
            new = [left.decode(errors="replace") if len(runs) else None for _, runs, left in _cut_rows(batch)]
            text = pa.array([o.as_py() if x is None else x for o, x in zip(batch.column(0), new, strict=True)], pa.string())
            old = batch.column(3).flatten()
            yield pa.RecordBatch.from_arrays([text if i == at else old[i] for i in range(len(names))], names)

    return _with_spans(docs).mapInArrow(run, schema)

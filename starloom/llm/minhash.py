"""Near-duplicates by DartMinHash signatures over five-word shingles.

Each element (a shingle; with weights="count" each further occurrence is an element too) has a region of unit weight,
into which hashed darts fall: their ranks are a Poisson process from the element's hash alone, and each dart names one of
K coordinates. A text keeps, per coordinate, the dart of least rank, so two texts agree in a coordinate with the
probability of their (weighted) Jaccard similarity. Only darts below a rank that fits the text's size are thrown, about
K ln K + 2 K of them; where a coordinate stays empty, the bound is doubled for that text.

Bands of ROWS coordinates give buckets; exact copies are one node (by SHA-256) before that. In each bucket nodes are paired
with a representative, and pairs are checked by the exact Jaccard similarity of the shingles. Then every bucket that is still of several components and
has up to GROUP elements is compared in full by one task, which gets the element hashes of each node once instead of two texts for each
pair: nodes outside the bucket's largest component are held against all others of other components, and components merge as
links are found. A pair is checked only if its sketches allow it: sizes and parities of elements on 256 bits, of which no
more can differ than the elements that only one of the texts has. Classes are the connected components. At similarity 0.8 a pair
shares no bucket with a probability of 3e-6.

The exact rest of larger buckets. Their nodes are joined on rare elements instead of in pairs: elements are put in one order
(those of a single component first, then by the nodes that hold them), and two texts of at least the wanted similarity
share one of their first few, a fifth of the longer and a ninth of the shorter text at 0.8. Pairs that the sketches or the
places of the shared element rule out are dropped in the join. Elements held by over SMALL nodes link them with one of them
first, so families become components before their members are compared. Nothing is sampled or capped: what stays quadratic
is a group of texts that share a rare element, fit in length, and are not similar to each other.

Edge cases: texts with one to four words are one shingle; texts without words (null included) are in classes of their exact
copies only; null ids are kept and never become a class id unless the class has no other; repeated rows share a class;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import Rolling, digest, durable, mix64, pieces, word_spans
from starloom.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
K = BANDS * ROWS
SMALL = 48
"""Nodes that hold a rare element, from which on they are linked with one of them before they meet in pairs."""
GROUP = 1 << 21
"""Elements of a bucket up to which a task compares it in full; in larger buckets nodes are joined on rare elements."""
COMMON = 1 << 19
"""Most common elements whose places every task holds."""
_UNIT = 2.0**-53
WORDS = ("m0", "m1", "m2", "m3")
SKETCH = "k struct<n: int, m0: long, m1: long, m2: long, m3: long>"


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all k-word shingles, shingles before each row); a row of fewer words is one shingle, of none no shingle."""
    start, end, first = word_spans(data, offsets)
    w = Rolling(data).spans(start, end)
    n = np.diff(first)
    short = (n > 0) & (n < k)
    per = np.where(short, 1, np.maximum(0, n - k + 1))
    place = np.concatenate(([0], np.cumsum(per)))
    at = np.repeat(first[:-1] - place[:-1], per) + np.arange(place[-1])
    length = np.repeat(np.where(short, n, k), per)
    h = length.astype(np.uint64)
    for j in range(k):
        inside = j < length
        h = np.where(inside, mix64(h * np.uint64(0x9E3779B97F4A7C15) ^ w[np.where(inside, at + j, 0)]), h) if len(w) else h
    return h, place


def _uniform(h: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1) * _UNIT


def elements(h: np.ndarray, place: np.ndarray, weights: str) -> tuple[np.ndarray, np.ndarray]:
    """(element hashes, row of each): distinct shingles, or with "count" the i-th occurrence of a shingle as an element."""
    row = np.repeat(np.arange(len(place) - 1), np.diff(place))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])) if len(h) else np.zeros(0, bool)
    if weights == "set":
        return h[new], row[new]
    run = np.flatnonzero(new)
    nth = np.arange(len(h)) - np.repeat(run, np.diff(np.append(run, len(h))))
    return mix64(h + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), row


def darts(h: np.ndarray, row: np.ndarray, rows: int, k: int = K) -> np.ndarray:
    """Signatures (rows, k): the hash of the dart of least rank in each coordinate; rows without elements stay 0."""
    best = np.full((rows, k), np.inf)
    sign = np.zeros((rows, k), np.uint64)
    size = np.bincount(row, minlength=rows)
    bound = (k * math.log(k) + 2 * k) / np.maximum(size, 1)
    todo = size > 0
    while todo.any():
        keep = todo[row]
        e, r = h[keep], row[keep]
        limit = bound[r]
        rank = np.zeros(len(e))
        j = np.uint64(0)
        while len(e):
            j += np.uint64(1)
            d = mix64(e + j * np.uint64(0x9E3779B97F4A7C15))
            rank = rank - np.log(_uniform(d))
            below = rank <= limit
            e, r, rank, limit, d = e[below], r[below], rank[below], limit[below], d[below]
            c = (mix64(d) % np.uint64(k)).astype(np.int64)
            flat = r * k + c
            order = np.lexsort((d, -rank, flat))  # of each coordinate the least rank comes last
            last = np.flatnonzero(np.append(flat[order][1:] != flat[order][:-1], True)) if len(order) else order
            win = order[last]
            better = rank[win] < best.ravel()[flat[win]]
            win = win[better]
            best.ravel()[flat[win]] = rank[win]
            sign.ravel()[flat[win]] = d[win]
        todo &= np.isinf(best).any(1)
        bound = bound * 2
    return sign


def sketches(e: np.ndarray, row: np.ndarray, rows: int) -> pa.StructArray:
    """Per row its number of elements and the parities of how many of them fall on each of 256 bits."""
    odd = np.bincount(row * 256 + (mix64(e) >> np.uint64(56)).astype(np.int64), minlength=rows * 256) & 1
    words = np.packbits(odd.astype(np.uint8).reshape(rows, 256), axis=1).view(np.int64)
    return pa.StructArray.from_arrays([pa.array(np.bincount(row, minlength=rows).astype(np.int32)), *[pa.array(np.ascontiguousarray(words[:, i])) for i in range(4)]], ["n", *WORDS])


def may_link(x: Column, y: Column, threshold: float) -> Column:
    """False only if two sketches rule out the similarity: by the numbers of elements, or as more bits differ than the elements
    that two such texts may not share (each of these changes one bit)."""
    apart = sum((F.bit_count(x[w].bitwiseXOR(y[w])) for w in WORDS), F.lit(0))
    slack = 1e-6  # of rounding
    return (F.least(x["n"], y["n"]) >= F.greatest(x["n"], y["n"]) * (threshold - slack)) & (apart <= (x["n"] + y["n"]) * ((1 - threshold) / (1 + threshold)) + slack)


def _signatures(weights: str, bands: int, rows_per: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(2)):
                h, place = shingles(data, offsets)
                e, row = elements(h, place, weights)
                sign = darts(e, row, hi - lo, bands * rows_per)
                sketch = sketches(e, row, hi - lo)
                out = np.zeros((hi - lo, bands), np.uint64)
                for b in range(bands):
                    x = np.full(hi - lo, b + 1, np.uint64)
                    for i in range(rows_per):
                        x = mix64(x * np.uint64(0x9E3779B97F4A7C15) ^ sign[:, b * rows_per + i])
                    out[:, b] = x
                some = np.diff(place) > 0
                ends = np.concatenate(([0], np.cumsum(np.where(some, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(out[some].ravel().view(np.int64))), sketch], ["doc_id", "node", "buckets", "k"])

    return run


def similarity(left: pa.Array, right: pa.Array, weights: str = "set") -> np.ndarray:
    """Exact (weighted) Jaccard similarity of the shingles of each pair of texts; 0 where one has no words."""
    out = np.zeros(len(left))
    step = 256
    for lo in range(0, len(left), step):
        sides = []
        for column in (left, right):
            part = column.slice(lo, step)
            e = [elements(*shingles(data, offsets), weights) for _, _, data, offsets in pieces(part)]
            starts = [p[0] for p in pieces(part)]
            h = np.concatenate([x[0] for x in e]) if e else np.zeros(0, np.uint64)
            r = np.concatenate([x[1] + s for x, s in zip(e, starts, strict=True)]) if e else np.zeros(0, np.int64)
            sides.append((np.sort(mix64(h ^ mix64(r.astype(np.uint64) + np.uint64(1)))), np.bincount(r, minlength=len(part)), h, r))
        (a, na, ha, ra), (b, nb, _, _) = sides
        key = mix64(ha ^ mix64(ra.astype(np.uint64) + np.uint64(1)))
        at = np.searchsorted(b, key)
        hit = (at < len(b)) & (b[np.minimum(at, max(len(b) - 1, 0))] == key) if len(b) else np.zeros(len(key), bool)
        common = np.bincount(ra[hit], minlength=len(na))
        out[lo: lo + len(na)] = common / np.maximum(1, na + nb - common)
    return out


def _check(threshold: float, weights: str):
    def run(batches):
        for batch in batches:
            ok = pa.array(similarity(batch.column(2), batch.column(3), weights) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(ok)

    return run


def _compare_bucket(threshold: float):
    """Links (a, b) that join the components (label) of a bucket's nodes (node, label, n, m0 to m3, es)."""
    def run(group: pa.Table) -> pa.Table:
        label = group["label"].combine_chunks().dictionary_encode().indices.to_numpy().copy()
        es = group["es"].combine_chunks()
        ends = es.offsets.to_numpy() - es.offsets[0].as_py()
        size = np.diff(ends)
        words = np.stack([group[w].to_numpy() for w in WORDS], 1).view(np.uint64)
        _, code = np.unique(es.flatten().to_numpy(), return_inverse=True)
        order = np.argsort(code, kind="stable")
        holder = np.repeat(np.arange(len(size)), size)[order]
        first = np.concatenate(([0], np.cumsum(np.bincount(code))))
        share = (1 - threshold) / (1 + threshold)
        outside = np.flatnonzero(label != np.bincount(label).argmax())
        a, b = [], []
        for x in outside:
            apart = np.bitwise_count(words ^ words[x]).sum(1)
            may = (label != label[x]) & (np.minimum(size, size[x]) >= np.maximum(size, size[x]) * (threshold - 1e-6)) & (apart <= (size + size[x]) * share + 1e-6)
            if not may.any():
                continue
            mine = code[ends[x]: ends[x + 1]]
            lens = first[mine + 1] - first[mine]
            at = np.repeat(first[mine] - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(lens.sum())
            common = np.bincount(holder[at], minlength=len(size))
            for y in np.flatnonzero(may & (common >= (threshold - 1e-6) * np.maximum(1, size + size[x] - common))):
                if label[y] != label[x] and common[y] / max(1, size[y] + size[x] - common[y]) >= threshold:
                    a.append(x)
                    b.append(y)
                    label[label == label[y]] = label[x]
        return pa.table({"a": group["node"].take(pa.array(a, pa.int64())), "b": group["node"].take(pa.array(b, pa.int64()))})

    return run


def _element_lists(weights: str):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(2)):
                h, row = elements(*shingles(data, offsets), weights)
                ends = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))], ["node", "label", "es"])

    return run


def _prefix_size(n, threshold: float):
    """How many of a text's n elements, in the common order, hold one that it shares with any text at least so similar."""
    return n - np.ceil(n * (threshold - 1e-9)).astype(np.int64) + 1  # the slack is for rounding: a longer prefix is never wrong


def most_common(often: DataFrame, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """(elements in order of their value, place of each in the order of (df, e)) of those of often (e, df) held by most nodes: at
    most `most`, by whole steps of a logarithmic histogram of df."""
    step = F.floor(F.log2("df") * 8).cast("int")
    least, room = math.inf, most
    for r in sorted(often.groupBy(step.alias("step")).count().collect(), reverse=True):  # some hundred steps
        if r["count"] > room:
            break
        least, room = r["step"], room - r["count"]
    found = often.where(step >= least).toArrow() if least < math.inf else None
    e, df = (found.column(c).to_numpy() for c in ("e", "df")) if found is not None else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = np.argsort(e)
    rank = np.empty(len(e), np.int64)
    rank[np.lexsort((e, df))] = np.arange(len(e))
    return e[order], rank[order]


def _prefixes(weights: str, threshold: float, common: np.ndarray, rank: np.ndarray, others: bool):
    """Per node n, the number of its elements outside `common`, these (if asked for), and those of `common` in its prefix, as (e, pos)."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(1)):
                h, row = elements(*shingles(data, offsets), weights)
                h, rows = h.view(np.int64), hi - lo
                at = np.minimum(np.searchsorted(common, h), max(len(common) - 1, 0))
                known = common[at] == h if len(common) else np.zeros(len(h), bool)
                n = np.bincount(row, minlength=rows)
                rest = n - np.bincount(row[known], minlength=rows)
                some = np.flatnonzero(known)
                some = some[np.lexsort((rank[at[some]], row[some]))] if len(some) else some
                first = np.searchsorted(row[some], np.arange(rows))
                pos = np.arange(len(some)) - first[row[some]] + rest[row[some]] + 1
                keep = pos <= _prefix_size(n, threshold)[row[some]]
                some, pos = some[keep], pos[keep]
                lists = lambda r, values: pa.ListArray.from_arrays(pa.array(np.searchsorted(r, np.arange(rows + 1)).astype(np.int32)), values)
                tops = lists(row[some], pa.StructArray.from_arrays([pa.array(h[some]), pa.array(pos.astype(np.int32))], ["e", "pos"]))
                left = ~known if others else np.zeros(len(h), bool)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, rows), pa.array(n.astype(np.int32)), pa.array(rest.astype(np.int32)), lists(row[left], pa.array(h[left])), tops], ["node", "n", "rest", "es", "tops"])

    return run


def rare_elements(texts: DataFrame, threshold: float, weights: str) -> DataFrame:
    """(e, node, n, pos, short) for each of texts (node, label, text): the elements of which two texts with different labels
    and at least `threshold` share one; pos counts from 1 in the common order, short: also in the prefix of the shorter text.

    The order: elements of a single label, which cannot be shared by texts to be linked and need no rows, then the others by the
    nodes that hold them. The places of the most common ones, a bounded table, are known to every task; a join gives the rest."""
    each = texts.select("node", "label", "text").mapInArrow(_element_lists(weights), "node binary, label binary, es array<long>").select("label", F.explode("es").alias("e"))
    often = durable(each.groupBy("e").agg(F.count("*").alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("e", "df"))
    common, rank = most_common(often)
    others = often.count() > len(common)
    lists = durable(texts.select("node", "text").mapInArrow(_prefixes(weights, threshold, common, rank, others), "node binary, n int, rest int, es array<long>, tops array<struct<e: long, pos: int>>"))
    held = lists.select("node", "n", F.explode("tops").alias("x")).select("x.e", "node", "n", "x.pos")
    if others:
        mine = Window.partitionBy("node")
        rare = lists.select("node", "n", "rest", F.explode("es").alias("e")).join(often, "e").withColumn("pos", F.col("rest") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("df", "e")))
        held = held.unionByName(rare.select("e", "node", "n", F.col("pos").cast("int").alias("pos")))

    def prefix(share: float) -> Column:
        return F.col("n") - F.ceil(F.col("n") * (share - 1e-9)) + 1

    return held.where(F.col("pos") <= prefix(threshold)).select("e", "node", "n", "pos", (F.col("pos") <= prefix(2 * threshold / (1 + threshold))).alias("short"))


def near_links(docs: DataFrame, threshold: float = THRESHOLD, weights: str = "count") -> tuple[DataFrame, DataFrame]:
    """(members: doc_id, node; classes: node, root) - exact copies share a node, checked links join nodes."""
    known = docs.select("doc_id", digest(F.col("text")).alias("node"), "text")
    members = durable(known.mapInArrow(_signatures(weights, BANDS, ROWS), "doc_id long, node binary, buckets array<long>, " + SKETCH))
    # one row for each node, with the id by which its text is found again
    nodes = members.groupBy("node").agg(F.min_by(F.struct("doc_id", "buckets", "k"), F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("x"))
    nodes = durable(nodes.select("node", "x.*"))
    rows = nodes.select("node", "k", F.explode("buckets").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct("node", "k")).alias("rep")).where("n > 1")
    shared = durable(rows.join(shared.select("bucket", "rep"), "bucket"))
    met = shared.select("node").distinct()
    texts = durable(known.withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63)))).join(nodes.join(met, "node", "left_semi").select("node", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id")), ["node", "id"], "left_semi").select("node", "text").dropDuplicates(["node"]))

    def checked(pairs: DataFrame) -> DataFrame:
        one = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
        two = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
        return durable(two.select("a", "b", "ta", "tb").mapInArrow(_check(threshold, weights), "a binary, b binary"))

    tried = durable(shared.where((F.col("node") != F.col("rep.node")) & may_link(F.col("k"), F.col("rep.k"), threshold)).select(F.col("node").alias("a"), F.col("rep.node").alias("b")).distinct())
    edges = checked(tried)
    found = durable(components(edges))

    def compare(pairs: DataFrame) -> None:
        nonlocal tried, edges, found
        pairs = durable(pairs.distinct().join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            return
        more = checked(pairs)
        tried = durable(tried.unionByName(pairs))
        if not more.isEmpty():
            edges = edges.unionByName(more)
            found = durable(components(edges))

    # every bucket that is still mixed, in full: the elements of a node go to a bucket once
    mixed = durable(shared.select("bucket", "node", "k").join(found, "node", "left").select("bucket", "node", "k", F.coalesce("root", "node").alias("label")))
    still = durable(mixed.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.sum("k.n").alias("size"), F.count("*").alias("n")).where("lo <> hi AND n > 2").select("bucket", "size"))  # two have met
    near = durable(mixed.join(still.where(F.col("size") <= GROUP).select("bucket"), "bucket"))
    held = durable(texts.join(near.select("node").distinct(), "node", "left_semi").select("node", F.col("node").alias("label"), "text").mapInArrow(_element_lists(weights), "node binary, label binary, es array<long>").drop("label"))
    more = durable(near.join(held, "node").select("bucket", "node", "label", "k.*", "es").groupBy("bucket").applyInArrow(_compare_bucket(threshold), "a binary, b binary").distinct())
    if not more.isEmpty():
        edges = edges.unionByName(more)
        found = durable(components(edges))

    # the exact rest of larger buckets
    many = still.where(F.col("size") > GROUP)
    mixed = shared.join(many.select("bucket"), "bucket").join(found, "node", "left").select("bucket", "node", "k", F.coalesce("root", "node").alias("label"))
    still = mixed.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("bucket")
    rest = durable(mixed.join(still, "bucket", "left_semi").select("node", "k", "label").distinct())
    if rest.isEmpty():
        return members.select("doc_id", "node"), found
    rare = durable(rare_elements(texts.join(rest, "node"), threshold, weights).join(rest.select("node", "k"), "node"))
    for last in (False, True):
        now = rare.join(found, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
        groups = now.groupBy("e").agg(F.count("*").alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.struct(F.col("node").alias("b"), F.col("k").alias("bk"), F.col("label").alias("bl"))).alias("r")).where("lo <> hi")
        if not last:
            one = now.join(groups.where(F.col("m") > SMALL).select("e", "r"), "e").where((F.col("label") != F.col("r.bl")) & may_link(F.col("k"), F.col("r.bk"), threshold))
            pairs = one.select(F.least("node", "r.b").alias("a"), F.greatest("node", "r.b").alias("b"))
        else:
            now = durable(now.join(groups.select("e"), "e", "left_semi"))
            x, y = (now.select("e", "short", *[F.col(c).alias(s + c) for c in ("node", "n", "pos", "label", "k")]) for s in "xy")
            fits = "xlabel <> ylabel AND (xn < yn OR xn = yn AND xnode < ynode) AND least(xn - xpos, yn - ypos) + 1 >= (xn + yn) * {0}D".format(f"{threshold / (1 + threshold) - 1e-9:.12f}")
            pairs = x.where("short").drop("short").join(y.drop("short"), "e").where(F.expr(fits) & may_link(F.col("xk"), F.col("yk"), threshold)).select(F.least("xnode", "ynode").alias("a"), F.greatest("xnode", "ynode").alias("b"))
        compare(pairs)
    return members.select("doc_id", "node"), found


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, weights: str = "count") -> DataFrame:
    """(doc_id, class_id, class_size) for each row of docs (doc_id, text): class_id is the least doc_id of the class."""
    members, found = near_links(docs, threshold, weights)
    per = members.groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = per.groupBy("root").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_size"))
    return members.join(per.select("node", "root").join(classes, "root").select("node", "class_id", "class_size"), "node").select("doc_id", "class_id", "class_size")


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD, weights: str = "count") -> DataFrame:
    """One row of docs for each class: a text with its least id (of equal ids the least digest), or with a null id if it has no other."""
    members, found = near_links(docs, threshold, weights)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("x")
    keep = members.join(found, "node", "left").groupBy(F.coalesce("root", "node")).agg(first).select(F.col("x.doc_id").alias("_id"), F.col("x.node").alias("_node"))
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", digest(F.col("text")).alias("_node"))
    kept = keyed.join(keep, (keyed["_node"] == keep["_node"]) & keyed["doc_id"].eqNullSafe(keep["_id"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "_node"]).select("row.*")

"""Near copies and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import minhash, suffix_dedup
from starloom.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
RNG = random.Random(1)


def bag(text, k=5):
    w = WORDS.findall(text or "")
    return Counter(tuple(w[i: i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def classes(rows, weights):
    root = {i: i for i in range(len(rows))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = [bag(t) if weights == "count" else Counter(set(bag(t))) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or bags[i] and jaccard(bags[i], bags[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = {}
    for i in range(len(rows)):
        out.setdefault(find(i), []).append(i)
    least = {}
    for members in out.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            least[i] = (min(ids) if ids else None, len(members))
    return sorted(((rows[i][0] if rows[i][0] is not None else -1), *(x if x is not None else -1 for x in least[i])) for i in range(len(rows)))


def check_classes(d, weights="count"):
    rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.class_id if r.class_id is not None else -1, r.class_size) for r in minhash.near_classes(d, weights=weights).collect())
    assert got == classes(rows, weights)


def test_near_classes(spark, docs, edge, empty):
    check_classes(docs)
    check_classes(docs, "set")
    check_classes(edge)
    assert minhash.near_classes(empty).collect() == []


def test_chain_of_edits(spark):
    """A chain whose ends differ: every link is found through one component."""
    words, rows = [f"w{i}" for i in range(200)], []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words = list(words)
        words[(i * 37) % 200] = f"e{i}"
    check_classes(spark.createDataFrame(rows, "doc_id long, text string"))


def test_signature_is_jaccard():
    a = [f"w{i}" for i in range(300)]
    b = a[:200] + [f"x{i}" for i in range(60)]
    texts = pa.array([" ".join(a), " ".join(b), " ".join(a * 2), "", "one two"])
    for weights in ("set", "count"):
        total = np.zeros((5, 5))
        data, offsets = next(minhash.pieces(texts))[2:]
        s = minhash.darts(*minhash.elements(*minhash.shingles(data, offsets), weights), 5, 2000)
        bags = [bag(t) if weights == "count" else Counter(set(bag(t))) for t in texts.to_pylist()]
        for i in range(5):
            for j in range(5):
                if bags[i] and bags[j]:
                    total[i, j] = (s[i] == s[j]).mean()
                    assert abs(total[i, j] - jaccard(bags[i], bags[j])) < 0.05
        left = texts.take(pa.array([0, 0, 1, 3]))
        right = texts.take(pa.array([1, 2, 2, 0]))
        want = [jaccard(bags[i], bags[j]) for i, j in ((0, 1), (0, 2), (1, 2), (3, 0))]
        assert np.allclose(minhash.similarity(left, right, weights), want)


def test_sketches_never_rule_out_a_link(spark):
    """may_link holds for every pair that is as similar as asked for, and fails for most that are far from it."""
    rng, texts = random.Random(8), []
    for n in (3, 30, 150, 900):
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for k in (0, 1, 2, n // 40, n // 20, n // 4):
            page = list(base)
            for at in rng.sample(range(n), min(k, n)):
                page[at] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(page))
    for weights in ("set", "count"):
        e, row = minhash.elements(*minhash.shingles(*next(minhash.pieces(pa.array(texts)))[2:]), weights)
        k = minhash.sketches(e, row, len(texts)).to_pylist()
        d = spark.createDataFrame([(i, x) for i, x in enumerate(k)], "i int, " + minhash.SKETCH)
        other = d.selectExpr("i AS j", "k AS l")
        bags = [bag(t) if weights == "count" else Counter(set(bag(t))) for t in texts]
        far = [0, 0]
        for r in d.join(other, minhash.F.col("i") < minhash.F.col("j")).select("i", "j", minhash.may_link(minhash.F.col("k"), minhash.F.col("l"), 0.8).alias("may")).collect():
            j = jaccard(bags[r.i], bags[r.j])
            assert r.may or j < 0.8
            if j < 0.5 and min(len(bags[r.i]), len(bags[r.j])) > 100:
                far[r.may] += 1
        assert far[0] > far[1]


def test_components(spark):
    edges = [(RNG.randrange(300), RNG.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root}


def test_drop_near_copies(spark, edge):
    kept = minhash.drop_near_copies(edge)
    assert kept.columns == edge.columns and sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == [-1, 1, 3, 4, 6, 7, 8, 10]


def test_rows_without_an_id_of_their_own(spark):
    """Null ids, and one id for unrelated texts: one row stays for each class, and near copies with null ids meet."""
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words), " ".join([*words, "more"]), "quite another text of seven words here", "and a third one that is unlike both"]
    d = spark.createDataFrame([(None, t) for t in texts] + [(None, texts[2]), (5, "one text under five that is not two"), (5, "the second text by the same number")], "doc_id long, text string")
    assert sorted(r.class_size for r in minhash.near_classes(d).collect()) == [1, 1, 1, 2, 2, 2, 2]
    kept = [r.text for r in minhash.drop_near_copies(d).collect()]
    assert len(kept) == 5 and set(kept) >= {texts[2], texts[3], "one text under five that is not two", "the second text by the same number"}


def removed(rows):
    """Brute force over (doc_id, text): n_bytes, n_removed, n_spans, sha of each."""
    first = {}
    order = {None: float("inf")}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            w = b[p: p + 50]
            first[w] = min(first.get(w, float("inf")), order.get(i, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        mark = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p: p + 50]] < order.get(i, i):
                mark[p: p + 50] = b"\1" * 50
        left = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        out.append((i if i is not None else -1, len(b), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def check_removed(d):
    rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_passages(d).collect())
    assert got == removed(rows)


def test_passages(spark, docs, edge, empty):
    check_removed(docs)
    check_removed(edge)
    assert suffix_dedup.repeated_passages(empty).collect() == []


def test_planted_passages(spark):
    """Passages of 49 to 130 bytes at any offset, low-entropy runs, and texts in which only one byte matters."""
    base = "".join(RNG.choice("abcdé ") for _ in range(600))
    rows = [(0, base)]
    for i in range(1, 60):
        n, at = RNG.choice([49, 50, 51, 64, 130]), RNG.randrange(0, 400)
        rows.append((RNG.choice([i, i, None, 7]), "".join(RNG.choice("abc xyz") for _ in range(RNG.randrange(0, 90))) + base[at: at + n] + "".join(RNG.choice("abc xyz") for _ in range(RNG.randrange(0, 90)))))
    rows += [(100 + i, "a" * n + "ab" * m) for i, (n, m) in enumerate([(49, 0), (50, 0), (51, 3), (200, 40), (10, 80), (75, 25)])]
    check_removed(spark.createDataFrame(rows, "doc_id long, text string"))


def test_common_line_is_not_merged_in_one_task(spark, monkeypatch):
    """A line in many surroundings, with a bound that its first block exceeds: same rows, and no large group is merged."""
    rng, line = random.Random(5), "the same licence line of a page, long enough to hold an anchor. "
    rows = [(i if i % 9 else None, "".join(rng.choice("abc xyz") for _ in range(rng.randrange(0, 60))) + line[rng.randrange(0, 9):] + "".join(rng.choice("abc xyz") for _ in range(60))) for i in range(150)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    grouped = []
    whole = suffix_dedup._hot_verdicts
    monkeypatch.setattr(suffix_dedup, "_hot_verdicts", lambda c: (grouped.append(c.count()), whole(c))[1])
    check_removed(d)
    assert grouped and grouped[0] > 20
    monkeypatch.setattr(suffix_dedup, "HOT", 0)
    check_removed(d)


def test_equal_rows(spark):
    """A text a thousand times under one id, under null ids and under ids of their own, beside a text that holds it."""
    text = "one page that is there again and again, and nothing else beside it at all"
    rows = [(4, text)] * 1000 + [(None, text)] * 5 + [(i, text) for i in range(5, 30)] + [(3, "before " + text + " after"), (9, text[:49]), (10, text[:49])]
    check_removed(spark.createDataFrame(rows, "doc_id long, text string"))


def test_columns_that_clash(spark):
    """Columns with the names that the operator uses inside come through."""
    rows = [(i, "a page with a passage that comes again and is longer than fifty bytes, page " + "xyz"[i % 3], *"abcdefgh") for i in range(6)]
    names = ["_id", "_dig", "_spans", "id", "dig", "t", "first", "row"]
    d = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    for out in (suffix_dedup.cut_passages(d), minhash.drop_near_copies(d)):
        assert out.columns == d.columns and {tuple(r[n] for n in names) for r in out.collect()} == {tuple("abcdefgh")}


def test_cut(spark, edge):
    got = suffix_dedup.cut_passages(edge)
    assert got.columns == edge.columns and got.count() == edge.count()
    assert {r.text for r in got.where("doc_id = 9").collect()} == {""}


def test_repeats_count(spark):
    """Texts with the same set of shingles whose repeats differ: one class by sets, two by counts."""
    once = " ".join(f"w{i}" for i in range(60))
    d = spark.createDataFrame([(1, once), (2, " ".join([once] * 3)), (3, " ".join([once] * 3) + " more")], "doc_id long, text string")
    for weights in ("set", "count"):
        check_classes(d, weights)
    assert {r.doc_id: r.class_id for r in minhash.near_classes(d).collect()} == {1: 1, 2: 2, 3: 2}


def by_matrix(rows):
    """Class of each of rows (0.., text) without repeated shingles, by all pairs."""
    bags = [set(bag(t)) for _, t in rows]
    place = {x: i for i, x in enumerate(set().union(*bags))}
    held = np.zeros((len(rows), len(place)), np.float32)
    for i, b in enumerate(bags):
        held[i, [place[x] for x in b]] = 1
    common, size = held @ held.T, held.sum(1)
    near = common >= 0.8 * (size[:, None] + size - common)
    want = np.arange(len(rows))
    while (want != (least := np.where(near, want, len(rows)).min(1))).any():
        want = least
    return want.tolist()


def test_one_bucket_of_hundreds(spark):
    """Independent edits of one long text, most pairs a little under the limit: every link of a bucket of over 500 nodes."""
    rng, base, rows = random.Random(11), [f"b{i}" for i in range(200)], []
    for i in range(520):
        page = list(base)
        for at in rng.sample(range(200), 3):
            page[at] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(page)))
    want = by_matrix(rows)
    assert 1 < len(set(want)) < 500
    got = {r.doc_id: r.class_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == want


@pytest.mark.parametrize("common", [minhash.COMMON, 300, 0])
def test_prefixes_hold_every_link(spark, monkeypatch, common):
    """Two texts over the limit share an element of their prefixes, whatever the number of elements whose places tasks hold."""
    monkeypatch.setattr(minhash.most_common, "__defaults__", (common,))
    rng, rows = random.Random(6), []
    for family in range(60):
        own = [f"t{i}" for i in range(120)]
        for at in rng.sample(range(120), 4):
            own[at] = f"f{family}"
        for _ in range(2):
            page = list(own)
            for at in rng.sample(range(120), rng.randrange(3)):
                page[at] = f"p{len(rows)}"
            rows.append((b"%03d" % len(rows), b"%03d" % len(rows), " ".join(page)))
    bags = [set(bag(t)) for *_, t in rows]
    held, size = {}, {}
    for r in minhash.rare_elements(spark.createDataFrame(rows, "node binary, label binary, text string"), 0.8, "count").collect():
        assert bytes(r.node) not in size or size[bytes(r.node)] == r.n
        size[bytes(r.node)] = r.n
        held.setdefault(bytes(r.node), {})[r.e] = (r.pos, r.short)
    linked = 0
    for i in range(len(rows)):
        for j in range(i):
            if len(bags[i] & bags[j]) >= 0.8 * len(bags[i] | bags[j]):
                linked += 1
                a, b = held.get(rows[i][0], {}), held.get(rows[j][0], {})
                shorter, longer = (a, b) if len(bags[i]) <= len(bags[j]) else (b, a)
                assert any(e in longer and shorter[e][1] for e in shorter)
    assert linked > 20


@pytest.mark.parametrize("group", [minhash.GROUP, 0])
def test_families_in_large_buckets(spark, monkeypatch, group):
    """Pages of one template at about 0.7, in buckets of hundreds, and pairs of them over 0.8: no pair may be lost, whether the
    buckets are compared in full or joined on rare elements."""
    monkeypatch.setattr(minhash, "GROUP", group)
    rng, rows = random.Random(3), []
    for family in range(600):
        own = [f"t{i}" for i in range(300)]
        for at in rng.sample(range(300), 2):
            own[at] = f"f{family}"
        for _ in range(2):
            page = list(own)
            for at in rng.sample(range(300), 3):
                page[at] = f"p{len(rows)}"
            rows.append((len(rows), " ".join(page)))
    want = by_matrix(rows)
    assert 300 < len(set(want)) < 1000
    got = {r.doc_id: r.class_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == want

"""Operators that SQL does not express, edge rows, and rules that must hold whatever the data."""

import math
import random

import pytest
from pyspark.sql import functions as F

from starloom.functions import sky, text
from starloom.operators import inventory, lineage, photometry, pixels, selection, skyjoin, stats
from starloom.sources import catalogs, files
from starloom.storage import durable
from starloom.streaming import arrivals

RNG = random.Random(3)


def sep(a, b):
    (r1, d1), (r2, d2) = ((math.radians(x), math.radians(y)) for x, y in (a, b))
    h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((r2 - r1) / 2) ** 2
    return 2 * math.asin(min(1, math.sqrt(h))) * 206264.80624709636


def points(n, around=None):
    base = around or [(RNG.uniform(0, 360), math.degrees(math.asin(RNG.uniform(-1, 1)))) for _ in range(n)]
    special = [(359.99999, 10.0), (0.00001, 10.0), (12.0, 89.99999), (200.0, 89.99999), (40.0, -90.0), (1.0, -89.99999), (50.0, 0.0), (50.0, 0.0), (50.0 + 0.99999 / 3600, 0.0), (50.0 - 1.00001 / 3600, 0.0)]
    return base + special


def test_pairs_everywhere(spark):
    """Brute force over wraps, poles, exact duplicates and separations about the radius; null and NaN match nothing."""
    p = points(60)
    rows = [(i, a, d) for i, (a, d) in enumerate(p)] + [(900, None, 1.0), (901, 1.0, None), (902, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id long, ra double, dec double")
    for radius in (1.0, 100.0):
        want = {(i, j) for i, a in enumerate(p) for j, b in enumerate(p) if sep(a, b) < radius}
        for copy_b in (True, False):
            got = skyjoin.sky_pairs(df, df, radius, "id", "id", copy_b=copy_b).collect()
            assert {(r.a_id, r.b_id) for r in got} == want
            assert all(abs(r.separation - sep(p[r.a_id], p[r.b_id])) < 1e-6 for r in got)


def test_match_sides(spark):
    sci = spark.createDataFrame([(1, 10.0, 0.0), (2, 10.0 + 0.5 / 3600, 0.0), (3, 50.0, 0.0)], "det_id long, ra double, dec double")
    ref = spark.createDataFrame([(7, 10.0 + 0.1 / 3600, 0.0), (8, 99.0, 0.0)], "source_id long, ra double, dec double")
    rows = lambda how: sorted(((r.det_id, r.source_id) for r in skyjoin.cross_match(sci, ref, 1.0, how).collect()), key=str)
    assert rows("inner") == [(1, 7)]  # the smaller reference side drives
    assert rows("left") == [(1, 7), (2, 7), (3, None)]
    assert rows("right") == [(1, 7), (None, 8)]
    assert rows("outer") == [(1, 7), (2, 7), (3, None), (None, 8)]
    assert skyjoin.cross_match(sci.limit(0), ref, 1.0).collect() == []


def test_drop_close_is_greedy(spark):
    rows = [(i, 10 + RNG.uniform(0, 8) / 3600, RNG.uniform(-4, 4) / 3600) for i in range(120)]
    order = list(range(120))
    RNG.shuffle(order)
    df = spark.createDataFrame([(i, a, d, order[i]) for i, a, d in rows], "id long, ra double, dec double, pos long")
    kept = []
    for i, a, d in sorted(rows, key=lambda r: order[r[0]]):
        if all(sep((a, d), (rows[k][1], rows[k][2])) >= 1 for k in kept):
            kept.append(i)
    assert sorted(r.id for r in skyjoin.drop_close(df, 1.0, durable).collect()) == sorted(kept)


def test_lattice_is_greedy(spark):
    pts = [(k, i, RNG.uniform(0, 90), RNG.uniform(0, 60)) for k in range(3) for i in range(k * 100, k * 100 + (30, 12, 5)[k])]
    want = set()
    for k in range(3):
        free = {i: (x, y) for m, i, x, y in pts if m == k}
        for t in range(9):
            tx, ty = 90 * (2 * (t % 3) + 1) / 6, 60 * (2 * (t // 3) + 1) / 6
            if free:
                i = min(free, key=lambda i: ((free[i][0] - tx) ** 2 + (free[i][1] - ty) ** 2, i))
                want.add((k, t, i))
                del free[i]
    got = skyjoin.lattice(spark.createDataFrame(pts, "image_id int, det_id int, x double, y double"), 90.0, 60.0)
    assert {(r.image_id, r.target, r.det_id) for r in got.collect()} == want


def test_rotation_keeps_matches(spark):
    p = [(RNG.uniform(100, 100.01), RNG.uniform(20, 20.01)) for _ in range(80)]
    df = lambda shift: spark.createDataFrame([(i, (a + shift) % 360, d) for i, (a, d) in enumerate(p)], "id long, ra double, dec double")
    pairs = lambda x: {(r.a_id, r.b_id) for r in skyjoin.sky_pairs(x, x, 5.0, "id", "id").collect()}
    assert pairs(df(0)) == pairs(df(259.995)) == pairs(df(360))


def test_polygon_and_box(spark):
    df = spark.createDataFrame([(1, 359.0, 1.0), (2, 1.0, 1.0), (3, 10.0, 1.0), (4, 181.0, -1.0)], "id int, ra double, dec double")
    assert [r.id for r in df.where(sky.in_ra_box(F.col("ra"), 350, 5)).collect()] == [1, 2]
    assert [r.id for r in df.where(sky.in_polygon(F.col("ra"), F.col("dec"), [(355, -5), (5, -5), (5, 5), (355, 5)])).collect()] == [1, 2]
    with pytest.raises(ValueError):
        sky.in_polygon(F.col("ra"), F.col("dec"), [(0, 0), (1, 1)])


def test_conditions(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0), (3, None)], "a int, b double")
    assert [r.a for r in df.where(photometry.condition([("b", "lower", 2.0)])).collect()] == [2]
    assert [r.a for r in df.where(photometry.condition(["a", ">=", 2, "b", "upper", 9])).collect()] == [2]
    with pytest.raises(ValueError):
        photometry.condition(["a", ">"])
    with pytest.raises(KeyError):
        photometry.condition([("a", "~", 1)])


def test_clip_small_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 5.0), ("c", None)], "k string, v double")
    assert {(r.k, r.zp) for r in photometry.zero_points(df.withColumnRenamed("v", "mag").withColumn("mag_inst", F.lit(0.0)), ["k"]).collect()} == {("a", 1.0), ("b", 5.0)}
    assert {(r.k, r.n, r.mean) for r in stats.clipped_stats_fixed(df, ["k"], "v").collect()} == {("a", 0, 0.0), ("b", 0, 0.0), ("c", 0, 0.0)}  # strict limits at sigma 0


def test_filter_inference_falls_back(spark):
    z = spark.createDataFrame([(1, "m525", 28.0, 0.01, "r"), (1, "g", 25.0, None, "r"), (2, "m525", 28.0, 0.01, "r"), (2, "i", 25.0, 0.5, "r")], "image int, filt string, zp double, zperr double, alleged string")
    assert {(r.image, r.filt) for r in photometry.infer_filter(z, ["image"]).collect()} == {(1, "r"), (2, "i")}


def test_cut_grammar():
    assert selection.parse_cuts("seeing<=2.5 ul5_5>=19,ppflag=101") == [("seeing", "<=", 2.5), ("ul5_5", ">=", 19.0), ("ppflag", "=", 5)]
    with pytest.raises(ValueError):
        selection.parse_cuts("seeing<2")


def test_as_of_ties_and_defaults(spark):
    left = spark.createDataFrame([(1, "u", 5), (2, "u", 0), (3, None, 5)], "id int, k string, t int")
    right = spark.createDataFrame([("u", 1, 10), ("u", 5, 20), ("u", 5, 30), ("u", 9, 40)], "k string, at int, v int")
    assert {(r.id, r.v) for r in inventory.as_of(left, right, ["k"], "t", "at", "v", F.lit(-1)).collect()} == {(1, 30), (2, -1), (3, -1)}


def test_null_safe_association(spark):
    cols = "group int, nightdate string, unit string, gain int, n_binning int, camera string"
    s = spark.createDataFrame([(1, "n", "u", None, 1, "c"), (2, "n", "u", 5, 1, "c")], cols)
    assert [(r.science, r.calib) for r in inventory.associate(s, spark.createDataFrame([(9, "n", "u", None, 1, "c")], cols), "bias").collect()] == [(1, 9)]


def test_closure_on_cycles(spark):
    e = spark.createDataFrame([(2, 1), (3, 2), (1, 3), (4, 3)], "derived long, source long")
    got = lineage.downstream(e, spark.createDataFrame([(1,)], "id long")).collect()
    assert {(r.id, r.depth) for r in got} == {(1, 0), (2, 1), (3, 2), (4, 3)}
    with pytest.raises(ValueError):
        lineage.cascade_plan(e, spark.createDataFrame([(1, 1, "bias")], "id long, process_status_id long, image_type string"), spark.createDataFrame([], "id long, config_type string, config_exists boolean"), spark.createDataFrame([(77,)], "id long"))


def test_tiles_equal_long_form(spark):
    px = spark.createDataFrame([(f, y, x, float(RNG.choice([0, RNG.randrange(100)]))) for f in range(5) for y in range(11) for x in range(13)], "frame int, y int, x int, v double")
    t = pixels.tile_median(pixels.to_tiles(px, 4)).select("ty", "tx", "w", F.posexplode("data").alias("k", "v"))
    got = {(r.ty * 4 + r.k // r.w, r.tx * 4 + r.k % r.w): r.v for r in t.collect() if r.v is not None}
    assert got == {(r.y, r.x): r.v for r in px.where("v <> 0").groupBy("y", "x").agg(F.median("v").alias("v")).collect()}


def test_angles_and_names(spark):
    df = spark.createDataFrame([("-00:30:00",), ("12 30 00",), ("nonsense",), (None,), ("181.5",)], "t string")
    assert [r[0] for r in df.select(text.angle(F.col("t"))).collect()] == [-0.5, 12.5, None, None, 181.5]
    n = spark.createDataFrame([("SU03_20240102_030405_my_odd_name_m525_1x1_100s.fits",), ("junk",)], "n string").select(*[c.alias(k) for k, c in text.parse_raw(F.col("n")).items()]).collect()
    assert n[0].obj == "my_odd_name" and n[0].filt == "m525" and n[0].exptime == 100 and n[1].ts is None


def test_header_cards(spark):
    cards = ["SIMPLE  =                    T / x", "NAXIS   =                    2", "NAXIS1  =                  100", "NAXIS2  =                   50", "BITPIX  =                  -32", "OBJECT  = 'it''s M31 / x'      / name", "COMMENT = not a card", "END"]
    wide, lines = "".join(c.ljust(80) for c in cards), "\n".join(cards)
    for t in (wide, lines):
        h = spark.createDataFrame([(t,)], "t string").select(files.parse_cards(F.col("t")).alias("h")).first().h
        assert h["OBJECT"] == "it's M31 / x" and h["NAXIS1"] == "100" and h["SIMPLE"] == "T" and "COMMENT" not in h
    rows = spark.createDataFrame([("a", 2880 * 8, 1, h), ("b", 2880 * 7, 1, h), ("c", 0, 1, h), ("d", 99, 1, {})], "path string, length long, header_blocks int, headers map<string,string>")
    assert {r.path for r in files.truncated(rows).collect()} == {"b", "c", "d"}


def test_scan_and_cells(spark, tmp_path):
    for d, o, f in (("20240101", "T1", "g"), ("20240102", "T1", "r"), ("20240102", "T2", "g")):
        p = tmp_path / "in" / d / o / f
        p.mkdir(parents=True)
        (p / "x.fits").write_bytes(b"12345")
        (p / "x.txt").write_bytes(b"1")
    rows = files.inventory_scan(spark, str(tmp_path / "in"), newest_first=True, obj="T1").collect()
    assert [(r.date, r.filt, r.length) for r in rows] == [("20240102", "r", 5), ("20240101", "g", 5)]
    ref = spark.createDataFrame([(i, (i * 37.7) % 360, math.degrees(math.asin(1 - 2 * (i + 0.5) / 400))) for i in range(400)], "source_id long, ra double, dec double")
    catalogs.write_cells(ref.unionByName(ref.limit(20)), str(tmp_path / "cells"))
    for a, d, r in ((1.0, 0.0, 15.0), (359.0, 88.0, 12.0), (200.0, -89.5, 5.0), (123.0, 45.0, 30.0)):
        got = catalogs.load_cone(spark, str(tmp_path / "cells"), a, d, r, ["source_id"])
        assert sorted(x.source_id for x in got.collect()) == sorted(x.source_id for x in ref.where(sky.in_cone(F.col("ra"), F.col("dec"), a, d, r)).collect())


def test_file_stream(spark, tmp_path):
    for name in ("SU01/a.fits", "SU21/b.fits", "SU02/c.txt", "SU20/d.fits"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(b"x")
    q = arrivals.new_files(spark, str(tmp_path)).writeStream.format("memory").queryName("seen_files").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.path.rsplit("/", 2)[1] for r in spark.table("seen_files").collect()) == ["SU01", "SU20"]


def test_qa_row_and_catalog_columns(spark):
    df = spark.createDataFrame([("/d/2024-01-02/x_coadd.fits", {"imageid": "i1", "TELESCOP": "SU01", "image-typ": "z", "IMAGETYP": "SCI"}), ("/y.fits", {"TELESCOP": "u"})], "path string, headers map<string,string>")
    assert [tuple(r) for r in files.qa_row(df).collect()] == [("/d/2024-01-02/x_coadd.fits", "i1", "SU01", "sci_coadd", "2024-01-02")]
    assert files.catalog_columns(df.withColumn("r", F.lit(1)).select("r", "path"), ["r"]).columns == ["path", "r"]


def test_exact_quantiles(spark, tmp_path):
    """Groups of all sizes with ties and nulls, against the engine's own percentile."""
    from starloom.operators.stats import exact_medians, exact_quantiles

    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.997, 1.0]
    d = spark.range(100_000).selectExpr("CASE WHEN id < 3 THEN id WHEN id < 1000 THEN 10 + id % 7 ELSE 20 END AS k", "CASE WHEN id % 5 = 0 THEN 1e0 WHEN id % 11 = 0 THEN NULL ELSE pow(id * 7919 % 100003 / 100003, 4) * 1000 END AS v")
    want = {r.k: (r.n, r.q) for r in d.groupBy("k").agg(F.count("v").alias("n"), F.percentile("v", probs).alias("q")).collect() if r.n}
    got = {r.k: (r.n, r.q) for r in exact_quantiles(d, ["k"], "v", probs).collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and max(abs(x - y) for x, y in zip(got[k][1], want[k][1], strict=True)) < 1e-9 for k in want)
    assert exact_medians(d.where("v IS NULL"), ["k"], "v").collect() == []
    assert [r.n for r in exact_medians(d, [], "v").collect()] == [d.where("v IS NOT NULL").count()]


def test_fixed_tables(spark):
    """Typed in again: penalties of a median at and between the knots, in both forms, and the names of the flag bits."""
    from starloom.functions import text
    from starloom.operators.pixels import median_penalty

    knots = {1: 1.0, 2: 1.0, 3: 1.3460, 5: 1.4342, 7: 1.4731, 9: 1.4949, 11: 1.5088, 15: 1.5254, 21: 1.5385, 31: 1.5489, 51: 1.5575, 101: 1.5641, 201: 1.5674}
    rows = spark.range(0, 400).select("id", median_penalty(F.col("id")).alias("a"), median_penalty(F.col("id"), limit=True).alias("b")).collect()
    for r in rows:
        if r.id in knots:
            assert abs(r.a - knots[r.id]) < 1e-12
        assert r.b == (math.pi / 2 if r.id >= 201 else r.a) and (r.a == 1.5674 or r.id < 201)
    assert abs(rows[4].a - (1.3460 + (1.4342 - 1.3460) * (1 / 4 - 1 / 3) / (1 / 5 - 1 / 3))) < 1e-12
    labels = [r[0] for r in spark.createDataFrame([(0,), (1,), (2,), (4,), (8,), (16,), (32,), (34,)], "b int").select(text.flag_label(F.col("b"))).collect()]
    assert labels == ["", "other night", "manual master", "sanity false", "lenient keys", "across a wall", "hard keys ignored", "manual master, hard keys ignored"]


def test_sky_cells_against_brute_force(spark):
    """Pairs at the poles, at RA 0 and across cell borders, for radii below and above the least cell."""
    import random

    from starloom.operators import skyjoin

    rng = random.Random(2)
    points = [(i, rng.choice([0.0, 359.9999, 120.0]) + rng.uniform(-3, 3) / 3600, rng.choice([89.9995, -90.0, 0.0, 45.0]) + rng.uniform(-3, 3) / 3600 * (-1 if i % 2 else 1)) for i in range(300)]
    points = [(i, ra % 360, max(-90.0, min(90.0, dec))) for i, ra, dec in points]
    d = spark.createDataFrame(points, "id long, ra double, dec double")

    def apart(a, b):
        x, y = ((math.cos(math.radians(q[2])) * math.cos(math.radians(q[1])), math.cos(math.radians(q[2])) * math.sin(math.radians(q[1])), math.sin(math.radians(q[2]))) for q in (a, b))
        return 2 * math.asin(min(1.0, math.dist(x, y) / 2)) * 648000 / math.pi

    for radius in (0.05, 0.4, 2.0, 5.0):
        want = {(a[0], b[0]) for a in points for b in points if apart(a, b) < radius * (1 - 1e-9)}
        maybe = {(a[0], b[0]) for a in points for b in points if apart(a, b) < radius * (1 + 1e-6) + 1e-6}
        for copy_b in (True, False):
            got = [(r.a_id, r.b_id) for r in skyjoin.sky_pairs(d, d, radius, "id", "id", copy_b=copy_b).collect()]
            assert len(got) == len(set(got)) and set(got) <= maybe and want - set(got) <= {(i, i) for i, _, _ in points if radius < 1e-3}


def test_multi_match_with_foreign_friends(spark):
    """Dense random fields, in which groups join rows of several sources: against friends of friends in plain Python."""
    import itertools
    import random

    rng = random.Random(4)
    rows = [(i, i % 3, 150 + rng.uniform(0, 20) / 3600, 20 + rng.uniform(0, 20) / 3600) for i in range(90)]

    def apart(a, b):
        return sep(a[2:], b[2:])

    edges = {(a[0], b[0]): apart(a, b) for a, b in itertools.combinations(rows, 2) if a[1] != b[1] and apart(a, b) < 1}
    root = {i: i for i, *_ in rows}
    for _ in rows:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    groups = {}
    for r in rows:
        groups.setdefault(root[r[0]], []).append(r)
    near = {}
    for (a, b), s in edges.items():
        for x, y in ((a, b), (b, a)):
            c = rows[y][1]
            near[x, c] = min(s, near.get((x, c), 9))
    d = durable(spark.createDataFrame(rows, "id long, cat int, ra double, dec double"))
    assert any(len(g) > 3 for g in groups.values())
    for join, pivot_cat in (("matched", None), ("inner", 0), ("left", 2), ("outer", None)):
        want = set()
        for key, g in groups.items():
            cats = {r[1] for r in g}
            if join == "matched" and len(cats) < 2 or join == "inner" and len(cats) < 3 or join == "left" and 2 not in cats:
                continue
            cost = {r[0]: round(sum(near[r[0], c] for c in cats if (r[0], c) in near) + (len(cats) - 1 - sum((r[0], c) in near for c in cats)), 9) for r in g}
            pivot = min(g, key=lambda r: (pivot_cat is not None and r[1] != pivot_cat, cost[r[0]], r[0]))
            want.add((key, pivot[0], pivot[1], pivot[0]))
            for c in cats - {pivot[1]}:
                want.add((key, pivot[0], c, min((r for r in g if r[1] == c), key=lambda r: (round(apart(pivot, r), 9), r[0]))[0]))
        got = skyjoin.multi_match(d, 1.0, durable, join=join, pivot_cat=pivot_cat).collect()
        assert {(r["group"], r["pivot"], r["cat"], r["id"]) for r in got} == want and len(got) == len(want)

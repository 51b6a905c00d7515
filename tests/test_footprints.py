"""Sky solutions and footprints against plain arithmetic."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from starloom.functions import sky, wcs
from starloom.operators import footprints

CORNERS = "array<struct<ra: double, dec: double>>"


def vec(ra, dec):
    a, d = math.radians(ra), math.radians(dec)
    return math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def cross(a, b):
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def inside(p, corners):
    sides = [dot(cross(a, b), p) for a, b in zip(corners, corners[1:] + corners[:1], strict=True)]
    middle = [sum(x) for x in zip(*corners, strict=True)]
    return dot(p, middle) > 0 and (min(sides) >= -1e-12 or max(sides) <= 1e-12)


def apart(a, b):
    """A plane through two corner rays has the polygons on different sides."""
    for u, v in itertools.permutations(a + b, 2):
        n = cross(u, v)
        if max(dot(n, x) for x in a) <= 1e-15 and min(dot(n, x) for x in b) >= -1e-15:
            return True
    return False


def around(rng, ra, dec, size, k):
    """k corners on a circle about a position, in order."""
    turns = sorted(rng.uniform(0, 360) for _ in range(k)) if k == 3 else [rng.uniform(0, 360 / k) + 360 * i / k for i in range(k)]
    out = []
    for t in turns:
        d = math.degrees(math.asin(max(-1, min(1, math.sin(math.radians(dec)) * math.cos(math.radians(size)) + math.cos(math.radians(dec)) * math.sin(math.radians(size)) * math.cos(math.radians(t))))))
        a = ra + math.degrees(math.atan2(math.sin(math.radians(t)) * math.sin(math.radians(size)) * math.cos(math.radians(dec)), math.cos(math.radians(size)) - math.sin(math.radians(dec)) * math.sin(math.radians(d))))
        out.append((a % 360, d))
    return out if rng.random() < 0.5 else out[::-1]


PLACES = [(0.1, 89.9), (200, 90), (123, -89.5), (359.9, 10), (0.05, -30), (180, 0), (90, 45)]


def test_points_and_polygons_equal_brute_force(spark):
    rng = random.Random(2)
    frames, areas, points = [], [], []
    for i, (ra, dec) in enumerate(PLACES * 4):
        frames.append((i, around(rng, (ra + rng.uniform(-1, 1)) % 360, max(-89.99, min(89.99, dec + rng.uniform(-1, 1))), rng.choice((0.3, 1.0, 4.0)), rng.choice((3, 4, 5)))))
        areas.append((i, around(rng, (ra + rng.uniform(-2, 2)) % 360, max(-89.99, min(89.99, dec + rng.uniform(-2, 2))), rng.choice((0.2, 2.0, 8.0)), 4)))
        points += [(len(points) + k, (ra + rng.uniform(-3, 3)) % 360, max(-90.0, min(90.0, dec + rng.uniform(-2, 2)))) for k in range(12)]
    f = footprints.with_footprint(spark.createDataFrame([(i, c + c[:1] if i % 2 else c) for i, c in frames], f"frame int, corners {CORNERS}")).drop("corners")
    p = spark.createDataFrame([*points, (9999, None, 1.0)], "point int, ra double, dec double")
    got = {(r.point, r.frame) for r in footprints.frames_at_points(p, f).collect()}
    assert got == {(i, j) for i, ra, dec in points for j, c in frames if inside(vec(ra, dec), [vec(*x) for x in c])} and len(got) > 20
    a = footprints.with_footprint(spark.createDataFrame(areas, f"area int, corners {CORNERS}")).drop("corners")
    rows = [(r.area, r.frame) for r in footprints.frames_meeting(a, f).collect()]
    assert len(rows) == len(set(rows)) > 20
    assert set(rows) == {(i, j) for i, x in areas for j, y in frames if dot(*(vec(*z[0]) for z in (x, y))) > 0 and not apart([vec(*c) for c in x], [vec(*c) for c in y])}


def test_odd_footprints_meet_nothing(spark):
    odd = [(1, None), (2, []), (3, [(1.0, 1.0), (2.0, 2.0)]), (4, [(1.0, 1.0), (None, 2.0), (3.0, 0.0)]), (5, [(0.0, -1.0), (1.0, 1.0), (359.0, 1.0)])]
    f = footprints.with_footprint(spark.createDataFrame(odd, f"frame int, corners {CORNERS}")).drop("corners")
    points = spark.createDataFrame([(0, 0.0, 0.0)] * 2, "point int, ra double, dec double")
    assert [r.frame for r in footprints.frames_at_points(points, f).collect()] == [5, 5]
    assert footprints.frames_at_points(points.limit(0), f).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        footprints.frames_at_points(points.withColumn("frame", F.lit(1)), f)


def test_points_near_plain_positions(spark):
    frames = [(1, 0.0, 90.0), (2, 0.0, 0.0), (3, 359.9999, 0.0)]
    points = [(1, 180.0, 89.9999), (2, 0.0002, 0.0001), (3, 359.9997, 0.0), (4, 0.1, 0.0)]
    got = footprints.frames_near_points(spark.createDataFrame(points, "point int, ra double, dec double"), spark.createDataFrame(frames, "frame int, frame_ra double, frame_dec double"))
    assert sorted((r.point, r.frame) for r in got.collect()) == [(1, 1), (2, 2), (3, 3)]


def test_solution_returns_and_turns(spark):
    rng = random.Random(4)
    rows = [(i, rng.uniform(0, 360), rng.choice((-89.0, -20.0, 0.0, 60.0, 89.9)), 4788.5, 3194.5, 0.505, rng.uniform(0, 360), bool(i % 2), rng.uniform(1, 9576), rng.uniform(1, 6388)) for i in range(80)]
    s = spark.createDataFrame(rows, "i int, crval1 double, crval2 double, crpix1 double, crpix2 double, scale double, pa double, mirror boolean, x double, y double")
    s = s.withColumns(wcs.cd_matrix(F.col("scale"), F.col("pa"), F.col("mirror")))
    ra, dec = wcs.pixel_to_sky(F.col("x"), F.col("y"))
    s = s.withColumns({"ra": ra, "dec": dec, "turn": F.pmod(wcs.rotation(), F.lit(360.0)), "flip": wcs.flipped(), "quad": wcs.quad(F.lit(9576), F.lit(6388))})
    x, y = wcs.sky_to_pixel(F.col("ra"), F.col("dec"))
    behind, _ = wcs.sky_to_pixel(F.col("ra") + 180, -F.col("dec"))
    for r in s.withColumns({"x2": x, "y2": y, "behind": behind}).collect():
        assert abs(r.x2 - r.x) < 1e-6 and abs(r.y2 - r.y) < 1e-6 and r.behind is None
        assert r.flip == r.mirror and abs((r.turn - r.pa + 180) % 360 - 180) < 1e-9
        p = [a + b + c for a, b, c in zip(vec(r.crval1, r.crval2), *([k * u for u in axis] for k, axis in zip((math.radians(r.cd11 * (r.x - 4788.5) + r.cd12 * (r.y - 3194.5)), math.radians(r.cd21 * (r.x - 4788.5) + r.cd22 * (r.y - 3194.5))), (vec(r.crval1 + 90, 0), vec(r.crval1, r.crval2 + 90)), strict=True)), strict=True)]
        assert math.dist([x / math.hypot(*p) for x in p], vec(r.ra, r.dec)) < 1e-11
        assert inside(vec(r.crval1, r.crval2), [vec(c.ra, c.dec) for c in r.quad])


def test_galactic_returns(spark):
    rows = spark.createDataFrame([(10.0, 20.0), (266.4, -28.9), (0.0, -90.0), (359.0, 89.0)], "lon double, lat double")
    lon, lat = sky.galactic(*sky.from_galactic(F.col("lon"), F.col("lat")))
    for r in rows.withColumns({"l": lon, "b": lat}).collect():
        assert math.dist(vec(r.lon, r.lat), vec(r.l, r.b)) < 1e-9


def test_sizes_and_corners_of_one_table_differ(spark):
    """Frames of a few arcsec to tens of degrees and areas of up to ten corners, in one table; sides without rows."""
    rng = random.Random(5)
    frames = [(i, around(rng, rng.uniform(0, 360), rng.uniform(-80, 80), size, 4)) for i, size in enumerate((0.001, 0.5, 3.0, 12.0) * 12)]
    for k, most in ((4, 15.0), (10, 15.0), (4, 40.0)):
        areas = [(i, around(rng, rng.uniform(0, 360), rng.uniform(-80, 80), most, k)) for i in range(20)]
        a, f = (footprints.with_footprint(spark.createDataFrame(r, f"{n} int, corners {CORNERS}")).drop("corners") for n, r in (("area", areas), ("frame", frames)))
        got = [(r.area, r.frame) for r in footprints.frames_meeting(a, f).collect()]
        near = lambda x, y: dot(*([sum(c) for c in zip(*(vec(*p) for p in z), strict=True)] for z in (x, y))) > -0.5
        assert sorted(got) == sorted((i, j) for i, x in areas for j, y in frames if near(x, y) and not apart([vec(*c) for c in x], [vec(*c) for c in y])) and got
    assert footprints.frames_meeting(a, f.limit(0)).count() == footprints.frames_meeting(a.limit(0), f).count() == 0


def test_pairs_are_tested_by_compiled_code(spark):
    """Lambdas over arrays are not compiled, and a pair cost 50 microseconds."""
    a, f = (footprints.with_footprint(spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])], f"{n} int, corners {CORNERS}")).drop("corners") for n in ("area", "frame"))
    points = spark.createDataFrame([(1, 0.5, 0.1)], "point int, ra double, dec double")
    for pairs in (footprints.frames_meeting(a, f), footprints.frames_at_points(points, f)):
        assert "lambda" not in pairs._jdf.queryExecution().optimizedPlan().toString() and pairs.count() == 1

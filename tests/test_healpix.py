"""Nested pixels against their definition, discs, and what a cone reads."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from starloom.functions import healpix
from starloom.sources import catalogs


def vec(ra, dec):
    a, d = math.radians(ra), math.radians(dec)
    return np.array([math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d)])


def points(seed, n):
    rng = random.Random(seed)
    return [(0.0, 90.0), (0.0, -90.0), (0.0, 0.0), (360.0, 0.0), (359.999999, 41.8), (45.0, math.degrees(math.asin(2 / 3))), (-10.0, 5.0)] + [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(n)]


def test_centres_lie_in_their_pixels_and_areas_are_equal(spark):
    for nside in (1, 2, 8):
        v = healpix.centres(np.arange(12 * nside * nside), nside)
        rows = [(i, float(np.degrees(np.arctan2(y, x))), float(np.degrees(np.arcsin(z)))) for i, (x, y, z) in enumerate(v)]
        got = spark.createDataFrame(rows, "i long, ra double, dec double").where(healpix.nested_pixel(F.col("ra"), F.col("dec"), nside) != F.col("i"))
        assert got.count() == 0
    rng = np.random.default_rng(1)
    many = spark.createDataFrame([(float(a), float(np.degrees(np.arcsin(z)))) for a, z in zip(rng.uniform(0, 360, 24000), rng.uniform(-1, 1, 24000), strict=True)], "ra double, dec double")
    counts = [r["count"] for r in many.groupBy(healpix.nested_pixel(F.col("ra"), F.col("dec"), 4)).count().collect()]
    assert len(counts) == 192 and 70 < min(counts) and max(counts) < 190


def test_points_lie_near_their_centre_and_children_in_their_parent(spark):
    p = spark.createDataFrame(points(2, 3000), "ra double, dec double")
    got = p.select("*", *(healpix.nested_pixel(F.col("ra"), F.col("dec"), n).alias(f"n{n}") for n in (16, 64, 128))).collect()
    for n in (16, 64, 128):
        c = healpix.centres(np.array([r[f"n{n}"] for r in got]), n)
        far = [math.acos(min(1.0, float(x @ vec(r.ra, r.dec)))) for x, r in zip(c, got, strict=True)]
        assert max(far) <= healpix.reach(n) + 1e-9
    assert all(r.n128 // 4 == r.n64 and r.n64 // 16 == r.n16 for r in got)


def test_discs_hold_every_point(spark):
    p = spark.createDataFrame(points(3, 4000), "ra double, dec double").withColumn("pixel", healpix.nested_pixel(F.col("ra"), F.col("dec"), 64)).collect()
    for ra, dec, radius in ((0.0, 90.0, 3.0), (10.0, -89.5, 2.0), (0.1, 0.0, 5.0), (359.9, 41.0, 10.0), (120.0, -60.0, 1.0), (77.0, 10.0, 100.0)):
        cells = healpix.disc_pixels(ra, dec, radius, 64)
        inside = {r.pixel for r in p if math.degrees(math.acos(max(-1.0, min(1.0, float(vec(r.ra, r.dec) @ vec(ra, dec)))))) <= radius}
        assert inside <= set(cells)
        area = 2 * math.pi * (1 - math.cos(math.radians(radius))) / (4 * math.pi) * 49152
        assert len(cells) <= 1.5 * area + 8 * math.sqrt(area) + 12


def test_cone_reads_its_cells_only(spark, tmp_path):
    rows = [(i, ra % 360, dec) for i, (ra, dec) in enumerate(points(4, 300))]
    path = str(tmp_path / "cells")
    catalogs.write_cells(spark.createDataFrame(rows + rows[:5], "source_id long, ra double, dec double"), path)
    for ra, dec, radius in ((0.0, 90.0, 25.0), (0.0, 0.0, 20.0), (200.0, -30.0, 8.0)):
        cone = catalogs.load_cone(spark, path, ra, dec, radius, ["source_id"])
        want = {i for i, a, d in rows if math.degrees(math.acos(max(-1.0, min(1.0, float(vec(a, d) @ vec(ra, dec)))))) <= radius}
        assert sorted(r.source_id for r in cone.collect()) == sorted(want)
        assert len(cone.inputFiles()) == len(spark.read.parquet(path).inputFiles()) > 200  # the list before pruning
        read = cone._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in read
        scanned = spark.read.parquet(path).where(F.col("cell").isin(healpix.disc_pixels(ra, dec, radius, 64))).select(F.input_file_name()).distinct().count()
        assert len({i for i in want}) <= 310 and scanned < 0.2 * 300

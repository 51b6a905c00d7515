"""Tiles against the long form: borders, last tiles narrower than the reach, gaps, deep stacks in small runs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import pixels, tiles

H, W, SIZE = 21, 34, 8


@pytest.fixture(scope="module")
def frames(spark):
    """Three frames, the second without a gap; the last tiles are 5 high and 2 wide."""
    rng = random.Random(3)
    rows = [(f, y, x, 0.0 if f != 1 and rng.random() < 0.05 else rng.choice((1.0, 2.0, rng.gauss(10, 3))), rng.choice((0.5, 1.0, 2.0)), rng.random() < 0.1 or (y < 3 and x < 3)) for f in range(3) for y in range(H) for x in range(W)]
    return spark.createDataFrame(rows, "frame long, y long, x long, v double, w double, bad boolean").cache()


def same(a, b, *planes):
    key = lambda r: (r.frame, r.y, r.x)
    a, b = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert len(a) == len(b)
    for r, s in zip(a, b, strict=True):
        assert key(r) == key(s)
        for p in planes:
            assert r[p] == s[p] or (r[p] is not None and s[p] is not None and math.isclose(r[p], s[p], rel_tol=1e-9, abs_tol=1e-9)), (r, s)


@pytest.mark.parametrize("r", [1, 3, 7])
def test_neighbourhoods(spark, frames, r):
    cut = tiles.cut_tiles(frames.withColumnRenamed("w", "wt"), SIZE, ["v", "wt", "bad"])
    assert cut.count() == 3 * 3 * 5
    same(tiles.to_pixels(tiles.gaussian(cut, SIZE, 1.2, r), SIZE, ["v"]), pixels.gaussian(frames, 1.2, r), "v")
    same(tiles.to_pixels(tiles.erode(cut, SIZE, r), SIZE, ["ok"]).withColumn("ok", F.col("ok") == 1), pixels.erode(frames, r), "ok")
    if r < 7:
        for method in ("median", "mean"):
            got = tiles.to_pixels(tiles.interpolate_bad(cut, SIZE, r, method), SIZE, ["v", "wt"]).withColumnRenamed("wt", "w")
            same(got, pixels.interpolate_bad(frames, r, method), "v", "w")


def test_shrinking_by_frame(spark, frames):
    masks = frames.select("frame", "y", "x", (F.col("v") != 0).alias("ok"))
    deltas = spark.createDataFrame([(0, 1.5), (1, 2.0), (2, -1.0)], "frame long, delta double")
    got = tiles.shrink(tiles.cut_tiles(masks, SIZE, ["ok"]), SIZE, deltas)
    same(tiles.to_pixels(got, SIZE, ["ok"]).withColumn("ok", F.col("ok") == 1), pixels.shrink(masks, deltas), "ok")
    with pytest.raises(ValueError, match="reach"):
        tiles.shrink(tiles.cut_tiles(masks, SIZE, ["ok"]), SIZE, deltas.withColumn("delta", F.lit(9.0)))


@pytest.mark.parametrize("budget", [1, 300, 1 << 20])
def test_deep_stacks(spark, budget):
    rng = random.Random(budget)
    rows = [(f, y, x, rng.choice((0.0, None, 5.0, rng.gauss(50, 9))) if rng.random() < 0.3 else rng.gauss(50, 2) + (500 if rng.random() < 0.02 else 0), rng.choice((0.0, 0.5, 1.0))) for f in range(60) for y in range(5) for x in range(9)]
    d = spark.createDataFrame(rows, "frame long, y long, x long, v double, w double").withColumn("f", 1 + F.col("frame") * 0.01)
    cut = tiles.cut_tiles(d.withColumnRenamed("w", "wt"), 4, ["v", "wt"]).withColumn("f", 1 + F.col("frame") * 0.01).repartition(5)
    for method, long in (("mean", pixels.mean_coadd), ("median", pixels.median_coadd), ("clipped", pixels.clipped_coadd)):
        got = tiles.to_pixels(tiles.stack(cut, method, budget=budget), 4, ["v", "weight", "n"]).where("n > 0")
        same(got, long(d).where("n > 0").withColumn("frame", F.lit(0)), "v", "weight", "n")


def test_empty(spark, frames):
    none = tiles.cut_tiles(frames.withColumnRenamed("w", "wt").limit(0), SIZE, ["v", "wt"])
    assert tiles.gaussian(none, SIZE, 1.0, 2).count() == 0 and tiles.stack(none.withColumn("f", F.lit(1.0))).count() == 0

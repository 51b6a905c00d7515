"""Pixel stacks in long form (frame, y, x, v, w): combination, statistics, masks, neighbourhoods.

0 and null both mean no data unless said otherwise. Every operation is a group by pixel, cell or frame, or an equi-join on
the pixel, so the number of frames and the size of an image are both free; neighbourhoods copy a pixel to the bounded
number of its neighbours.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.operators.stats import clipped_stats_fixed, exact_medians, join_stats, median_nmad

XY = ["y", "x"]
#: Variance of a median over that of a mean, by number of values; from the last number on, the limit.
MEDIAN_PENALTY = ((1, 1.0), (2, 1.0), (3, 1.3460), (5, 1.4342), (7, 1.4731), (9, 1.4949), (11, 1.5088), (15, 1.5254), (21, 1.5385), (31, 1.5489), (51, 1.5575), (101, 1.5641), (201, 1.5674))
MEDIAN_LIMIT = math.pi / 2


def valid(v: str = "v") -> Column:
    return F.col(v).isNotNull() & ~F.isnan(v) & (F.col(v) != 0)


def master_combine(frames: DataFrame, subtract: DataFrame | None = None, normalise: bool = False, method: str = "median") -> DataFrame:
    """(y, x, v, sd) over frames (frame, y, x, v): optional master (y, x, m) taken off, optional division by the frame's median (0 reads as 1e-8)."""
    df = frames if subtract is None else frames.join(subtract, XY).withColumn("v", F.col("v") - F.col("m"))
    if normalise:
        med = exact_medians(df, ["frame"], "v").select("frame", F.col("median").alias("_m"))
        df = join_stats(df, med, ["frame"]).withColumn("v", F.col("v") / F.when(F.col("_m") == 0, 1e-8).otherwise(F.col("_m")))
    return df.groupBy(*XY).agg((F.median if method == "median" else F.avg)("v").alias("v"), F.stddev_samp("v").alias("sd"))


def outlier_mask(images: DataFrame, n_sigma: float = 5.0, key: str = "frame") -> DataFrame:
    """Adds bad to images (frame, y, x, v): |v - clipped median| beyond n clipped sigmas of the frame."""
    s = clipped_stats_fixed(images, [key], "v").select(key, "median", "std")
    return join_stats(images, s, [key]).withColumn("bad", F.abs(F.col("v") - F.col("median")) > n_sigma * F.col("std")).drop("median", "std")


def reduce_science(raw: DataFrame, bias: DataFrame, dark: DataFrame, flat: DataFrame, scale: float = 1.0) -> DataFrame:
    """(frame, y, x, v) = (raw - bias - scale dark) / flat; null where the flat is 0."""
    j = raw.join(bias.select(*XY, F.col("v").alias("b")), XY).join(dark.select(*XY, F.col("v").alias("d")), XY).join(flat.select(*XY, F.col("v").alias("f")), XY)
    return j.select("frame", *XY, F.try_divide(F.col("v") - F.col("b") - scale * F.col("d"), F.col("f")).alias("v"))


def mean_coadd(frames: DataFrame) -> DataFrame:
    """(y, x, v, weight, n) of frames (y, x, v, w, f): sum(w' f v) / sum(w') with w' = w / f**2."""
    w = F.when(valid() & (F.col("w") > 0), F.col("w") / (F.col("f") * F.col("f")))
    return frames.groupBy(*XY).agg((F.sum(w * F.col("f") * F.col("v")) / F.sum(w)).alias("v"), F.coalesce(F.sum(w), F.lit(0.0)).alias("weight"), F.count(w).alias("n"))


def median_penalty(n: Column, limit: bool = False) -> Column:
    """Variance penalty of a median of n values, linear in 1/n between knots. From the last knot on it stays as it is, or
    with limit is pi / 2."""
    last, most = MEDIAN_PENALTY[-1]
    out = F.lit(most)
    for (n1, p1), (n2, p2) in reversed(list(zip(MEDIAN_PENALTY, MEDIAN_PENALTY[1:], strict=False))):
        out = F.when(n <= n2, p1 + (p2 - p1) * (1 / n - 1 / n1) / (1 / n2 - 1 / n1)).otherwise(out)
    out = F.when(n <= 1, 1.0).otherwise(out)
    return F.when(n >= last, MEDIAN_LIMIT).otherwise(out) if limit else out


def median_coadd(frames: DataFrame) -> DataFrame:
    """(y, x, v, weight, n): median of f v; weight n**2 / sum(variance) over the median's penalty."""
    ok = valid() & (F.col("w") > 0)
    scaled, var = F.when(ok, F.col("f") * F.col("v")), F.when(ok, F.col("f") * F.col("f") / F.col("w"))
    g = frames.groupBy(*XY).agg(F.median(scaled).alias("v"), F.sum(var).alias("s"), F.count(scaled).alias("n"))
    return g.select(*XY, "v", F.coalesce(F.col("n") * F.col("n") / F.col("s") / median_penalty(F.col("n")), F.lit(0.0)).alias("weight"), "n")


def clipped_coadd(frames: DataFrame, kappa: float = 3.0, slack: float = 0.1) -> DataFrame:
    """Weighted mean of what lies within kappa / sqrt(w') + slack |c| of the pixel's median c."""
    c = frames.groupBy(*XY).agg(F.median(F.when(valid() & (F.col("w") > 0), F.col("f") * F.col("v"))).alias("c"))
    j = frames.join(c, XY)
    near = F.abs(F.col("f") * F.col("v") - F.col("c")) <= kappa * F.try_divide(F.col("f"), F.sqrt("w")) + slack * F.abs("c")
    return mean_coadd(j.where(near))


def effective_gain(frames: DataFrame, method: str = "mean") -> DataFrame:
    """One row: the median over covered pixels of the gain of a coadd.

    mean: (sum w)**2 / sum(w**2 / gain); median: n**2 / sum(1 / gain) over the penalty of a median of n."""
    ok, n = F.when(valid(), F.col("w")), F.count(F.when(valid(), 1))
    one = F.sum(ok) * F.sum(ok) / F.sum(ok * ok / F.col("gain")) if method == "mean" else n * n / F.sum(F.when(valid(), 1 / F.col("gain"))) / median_penalty(n, limit=True)
    per = frames.groupBy(*XY).agg(one.alias("g"))
    return exact_medians(per, [], "g").select(F.col("median").alias("gain"))


def register(frames: DataFrame, offsets: DataFrame, height: int, width: int) -> DataFrame:
    """frames moved by offsets (frame, y0, x0) onto a common grid and cropped."""
    moved = frames.join(offsets, "frame").withColumns({"y": F.col("y") + F.col("y0"), "x": F.col("x") + F.col("x0")}).drop("y0", "x0")
    return moved.where(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1))


def weight_sum(frames: DataFrame) -> DataFrame:
    return frames.groupBy(*XY).agg(F.coalesce(F.sum("w"), F.lit(0.0)).alias("w"))


def difference(a: DataFrame, b: DataFrame, scale: float = 1.0, dy: int = 0, dx: int = 0) -> DataFrame:
    """(y, x, v) = a - scale b, b moved by (dy, dx); null where either has no data."""
    m = b.select((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x"), F.col("v").alias("_b"))
    return a.join(m, XY, "left").select(*XY, F.when(valid() & F.coalesce(F.col("_b") != 0, F.lit(False)), F.col("v") - scale * F.col("_b")).alias("v"))


def zero_mask(a: DataFrame, b: DataFrame) -> DataFrame:
    """(y, x, masked, v): masked where either is missing or 0, and the difference, 0 there."""
    j = a.select(*XY, F.col("v").alias("_a")).join(b.select(*XY, F.col("v").alias("_b")), XY, "full")
    bad = (F.coalesce("_a", F.lit(0.0)) == 0) | (F.coalesce("_b", F.lit(0.0)) == 0)
    return j.select(*XY, bad.alias("masked"), F.when(bad, 0.0).otherwise(F.col("_a") - F.col("_b")).alias("v"))


def noise_weight(image: DataFrame, masters: DataFrame, read_noise: float, gain: float) -> DataFrame:
    """(frame, y, x, w) of image (frame, y, x, v) and masters (y, x, flat, flat_err, dark): one over the variance.

    Variance: (read noise / gain)**2 floored at 1/12, Poisson noise of signal and dark clipped at 0, and the flat's error."""
    j = image.join(masters, XY)
    z = max(read_noise / gain, 1 / math.sqrt(12)) ** 2
    var = (z + F.greatest(F.col("v") * F.col("flat"), F.lit(0.0)) / gain + F.greatest("dark", F.lit(0.0)) / gain + F.pow(F.col("v") * F.col("flat_err"), F.lit(2.0))) / F.pow("flat", F.lit(2.0))
    w = F.try_divide(F.lit(1.0), var)
    return j.select("frame", *XY, F.when(w.isNull() | F.isnan(w) | (w == float("inf")), 0.0).otherwise(w).alias("w"))


def _around(df: DataFrame, r: int) -> DataFrame:
    """Each row once for every offset of the (2r + 1) square, with its target pixel (ty, tx)."""
    span = F.sequence(F.lit(-r), F.lit(r))
    return df.withColumn("ty", F.explode(F.transform(span, lambda i: F.col("y") + i))).withColumn("tx", F.explode(F.transform(span, lambda i: F.col("x") + i)))


def interpolate_bad(frames: DataFrame, r: int = 1, method: str = "median") -> DataFrame:
    """frames (frame, y, x, v, w, bad) with bad pixels replaced from the good ones of the window around; 0 where none is.

    median: the values' median, with the weight of that value, or for even counts the mean weight of the two middle
    neighbours in reading order; mean: weighted by w, with the sum of the weights."""
    keys = ["frame", "y", "x"]
    lost = _around(frames.where("bad").select(*keys), r)
    good = frames.where("NOT bad").select("frame", F.col("y").alias("ty"), F.col("x").alias("tx"), "v", "w")
    near = lost.join(good, ["frame", "ty", "tx"])
    if method == "median":
        # at most (2 r + 1)**2 neighbours of a pixel
        g = near.groupBy(*keys).agg(F.sort_array(F.collect_list("v")).alias("a"), F.sort_array(F.collect_list(F.struct("ty", "tx", "v", "w"))).alias("b"))
        n = F.size("a")
        lo, hi = F.floor((n + 1) / 2).cast("int"), (F.floor(n / 2) + 1).cast("int")
        middle = F.element_at("a", lo)
        own = F.filter("b", lambda x: x["v"] == middle)[0]["w"]  # of equal values the first
        slots = (F.element_at("b", lo)["w"] + F.element_at("b", hi)["w"]) / 2
        near = g.select(*keys, ((middle + F.element_at("a", hi)) / 2).alias("_v"), F.when(n % 2 == 1, own).otherwise(slots).alias("_w"))
    else:
        near = near.groupBy(*keys).agg(F.try_divide(F.sum(F.col("v") * F.col("w")), F.sum("w")).alias("_v"), F.sum("w").alias("_w"))
    new = {c: F.when(F.col("bad"), F.coalesce(f"_{c}", F.lit(0.0))).otherwise(F.col(c)) for c in "vw"}
    return frames.join(near, keys, "left").withColumns(new).drop("_v", "_w")


def block_bin(frames: DataFrame, ny: int, nx: int, height: int, width: int, method: str = "mean") -> DataFrame:
    """Blocks of ny x nx; the remainder at the far edges is cropped."""
    f = {"mean": F.avg, "sum": F.sum, "median": F.median}[method]
    inside = frames.where((F.col("y") < height // ny * ny) & (F.col("x") < width // nx * nx))
    return inside.groupBy("frame", F.floor(F.col("y") / ny).alias("y"), F.floor(F.col("x") / nx).alias("x")).agg(f("v").alias("v"))


def frame_statistics(frames: DataFrame, height: int, width: int, crop: int) -> DataFrame:
    """Per frame: clipped count, mean, median, std, raw extremes, and the median of the central crop."""
    clipped = clipped_stats_fixed(frames, ["frame"], "v")
    centre = F.when(F.col("y").between(height // 2 - crop // 2, height // 2 + crop // 2 - 1) & F.col("x").between(width // 2 - crop // 2, width // 2 + crop // 2 - 1), F.col("v"))
    middle = exact_medians(frames.select("frame", centre.alias("v")), ["frame"], "v").select("frame", F.col("median").alias("centre"))
    return clipped.join(frames.groupBy("frame").agg(F.min("v").alias("lo"), F.max("v").alias("hi")), "frame").join(middle, "frame", "left")


def edge_variation(frames: DataFrame, height: int, width: int, corner: int) -> DataFrame:
    """Per frame: the largest less the least corner median, over the centre's median; and edge less centre."""
    top, left = F.col("y") < corner, F.col("x") < corner
    bottom, right = F.col("y") >= height - corner, F.col("x") >= width - corner
    parts = {"tl": top & left, "tr": top & right, "bl": bottom & left, "br": bottom & right, "c": F.col("y").between(height // 2 - corner // 2, height // 2 + corner // 2) & F.col("x").between(width // 2 - corner // 2, width // 2 + corner // 2)}
    g = frames.groupBy("frame").agg(*[F.median(F.when(c, F.col("v"))).alias(k) for k, c in parts.items()])
    four = ["tl", "tr", "bl", "br"]
    return g.select("frame", ((F.greatest(*four) - F.least(*four)) / F.col("c")).alias("edgevar"), (sum((F.col(c) for c in four[1:]), F.col("tl")) / 4 - F.col("c")).alias("edge_centre"))


def uniformity(frames: DataFrame, cell_y: int, cell_x: int) -> DataFrame:
    """Per frame: -log10(cv of the cell means + half the mean of the cells' relative sigma); bad pixels are out, values shifted up if not positive."""
    good = frames.where("NOT bad")
    low = good.groupBy("frame").agg(F.min("v").alias("_l"))
    shifted = good.join(low, "frame").withColumn("v", F.when(F.col("_l") <= 0, F.col("v") - F.col("_l") + 1).otherwise(F.col("v")))
    cells = shifted.groupBy("frame", F.floor(F.col("y") / cell_y).alias("cy"), F.floor(F.col("x") / cell_x).alias("cx")).agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"))
    return cells.groupBy("frame").agg((-F.log10(F.stddev_pop("m") / F.avg("m") + 0.5 * F.avg(F.col("s") / F.col("m")))).alias("uniformity"))


def relative_rms(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: root mean square of a / b - 1 over the pixels where b is not 0."""
    j = a.join(b.select(*XY, F.col("v").alias("_b")), XY).where("_b <> 0")
    return j.agg(F.sqrt(F.avg(F.pow(F.col("v") / F.col("_b") - 1, F.lit(2.0)))).alias("rms"))


def column_profile(frames: DataFrame, step: int, method: str = "median") -> DataFrame:
    """(frame, x, v): per column the median of every step-th row, or 2.5 median - 1.5 mean."""
    v = F.median("v") if method == "median" else 2.5 * F.median("v") - 1.5 * F.avg("v")
    return frames.where(F.col("y") % step == 0).groupBy("frame", "x").agg(v.alias("v"))


def shifted_score(profile: DataFrame, level: float, bin_width: int = 200, widths: int = 50, floor: float = 1.0, least: float = 4.0) -> DataFrame:
    """(frame, score, flag) of column profiles (frame, x from 0, v) against the bias level; flag: the score exceeds 5.

    The background is the medians of bins of columns (the last filled up with its last value), linear between the bins'
    centres. Over windows of 1..widths columns, with b the background above the level (not below 0), e the profile above it
    and s the median step from column to column (at least floor): the largest (sum b b - 2 sum e b) / (2 s sqrt(sum b b))
    where sum b b / s**2 exceeds `least`, and at least 0."""
    size = profile.groupBy("frame").agg((F.max("x") + 1).alias("_n"))
    bins = F.ceil(F.col("_n") / bin_width)
    rows = profile.join(size, "frame")
    copies = F.when(F.col("x") == F.col("_n") - 1, 1 + bins * bin_width - F.col("_n")).otherwise(1).cast("long")
    base = rows.groupBy("frame", F.floor(F.col("x") / bin_width).alias("b")).agg(F.percentile("v", 0.5, copies).alias("m"))
    at = F.greatest(F.lit(0.0), F.least((bins - 1).cast("double"), (F.col("x") - (bin_width / 2 - 0.5)) / bin_width))
    rows = rows.withColumn("_t", at).withColumn("_b", F.floor("_t"))
    rows = rows.join(base.select("frame", F.col("b").alias("_b"), F.col("m").alias("_lo")), ["frame", "_b"])
    rows = rows.join(base.select("frame", (F.col("b") - 1).alias("_b"), F.col("m").alias("_hi")), ["frame", "_b"], "left")
    ground = F.col("_lo") + (F.col("_t") - F.col("_b")) * (F.coalesce("_hi", "_lo") - F.col("_lo"))
    w = W.partitionBy("frame").orderBy("x")
    rows = rows.select("frame", "x", "v", F.greatest(ground - level, F.lit(0.0)).alias("b"), (F.col("v") - level).alias("e")).withColumn("step", F.abs(F.col("v") - F.lag("v").over(w)))
    s = rows.groupBy("frame").agg(F.greatest(F.coalesce(F.median("step"), F.lit(floor)), F.lit(floor)).alias("s"))
    sums = rows.withColumns({"bb": F.sum(F.col("b") * F.col("b")).over(w), "eb": F.sum(F.col("e") * F.col("b")).over(w)})
    windows = sums.select("frame", F.array(*[F.when(F.lag("x", k - 1).over(w).isNotNull(), F.struct((F.col("bb") - F.lag("bb", k, 0.0).over(w)).alias("bb"), (F.col("eb") - F.lag("eb", k, 0.0).over(w)).alias("eb"))) for k in range(1, widths + 1)]).alias("z")).select("frame", F.explode("z").alias("z"))
    z = F.when(F.col("z.bb") / (F.col("s") * F.col("s")) > least, (F.col("z.bb") - 2 * F.col("z.eb")) / (2 * F.col("s") * F.sqrt("z.bb")))
    scored = windows.join(s, "frame").groupBy("frame").agg(F.greatest(F.lit(0.0), F.max(z)).alias("score"))
    return scored.select("frame", "score", (F.col("score") > 5).alias("flag"))


def steps(profile: DataFrame, half: int, quantum: float) -> DataFrame:
    """(frame, run, level, n): runs of equal quantised values of the profile less its moving average over 2 half + 1 columns."""
    w = W.partitionBy("frame").orderBy("x")
    q = profile.withColumn("level", F.floor((F.col("v") - F.avg("v").over(w.rowsBetween(-half, half))) / quantum).cast("long"))
    new = q.withColumn("_n", F.coalesce((F.col("level") != F.lag("level").over(w)).cast("int"), F.lit(1)))
    runs = new.withColumn("run", F.sum("_n").over(w))
    return runs.groupBy("frame", "run", "level").agg(F.count("*").alias("n"))


def mesh_background(frames: DataFrame, cell: int) -> DataFrame:
    """(frame, cy, cx, level, sigma): clipped median and sigma of each mesh cell, bad pixels out."""
    cells = frames.where("NOT bad").select("frame", F.floor(F.col("y") / cell).alias("cy"), F.floor(F.col("x") / cell).alias("cx"), "v")
    s = clipped_stats_fixed(cells, ["frame", "cy", "cx"], "v")
    return s.select("frame", "cy", "cx", F.col("median").alias("level"), F.col("std").alias("sigma"))


def source_mask(sources: DataFrame, grow: float, least: float, most: int, height: int, width: int) -> DataFrame:
    """Distinct (image_id, y, x) inside the grown ellipses of sources (image_id, x, y, a, b, theta), at least `least` in radius, at most `most` pixels out."""
    s = sources.withColumns({"_x": F.col("x"), "_y": F.col("y"), "_a": F.greatest(F.col("a") * grow, F.lit(least)), "_b": F.greatest(F.col("b") * grow, F.lit(least))})
    box = _around(s.withColumns({"y": F.floor("y"), "x": F.floor("x")}), most)
    dx, dy, t = F.col("tx") - F.col("_x"), F.col("ty") - F.col("_y"), F.radians("theta")
    along, across = dx * F.cos(t) + dy * F.sin(t), dy * F.cos(t) - dx * F.sin(t)
    inside = F.pow(along / F.col("_a"), F.lit(2.0)) + F.pow(across / F.col("_b"), F.lit(2.0)) <= 1
    return box.where(inside & F.col("tx").between(0, width - 1) & F.col("ty").between(0, height - 1)).select("image_id", F.col("ty").alias("y"), F.col("tx").alias("x")).distinct()


def class_source_mask(sources: DataFrame, height: int, width: int, star_scale: float, galaxy_scale: float, class_star_cut: float, min_radius: float, bright_flux: float = 3.0e5, bright_radius_per_dex: float = 90.0) -> DataFrame:
    """Distinct (image_id, y, x) inside the ellipses of sources (image_id, x, y counted from 1, a, b, theta, kron, class_star, flux).

    An ellipse is a, b times the Kron radius (at least 1) times the scale of its class: extended sources, with class_star under the cut,
    have their own. From bright_flux on, neither radius is less than min_radius and bright_radius_per_dex for each decade of flux
    beyond, which makes a circle. Each source is copied to the pixels of its ellipse's box in the image."""
    grow = F.greatest(F.coalesce("kron", F.lit(1.0)), F.lit(1.0)) * F.when(F.col("class_star") < class_star_cut, galaxy_scale).otherwise(star_scale)
    wing = F.when((F.col("flux") > bright_flux) & ~F.isnan("flux") & (F.col("flux") < float("inf")), min_radius + bright_radius_per_dex * F.log10(F.col("flux") / bright_flux)).otherwise(0.0)
    radius = lambda c: F.greatest(F.col(c) * grow, F.lit(min_radius), wing)
    s = sources.select("image_id", (F.col("x") - 1).alias("_x"), (F.col("y") - 1).alias("_y"), radius("a").alias("_a"), radius("b").alias("_b"), F.radians("theta").alias("_t"))
    dx, dy = F.hypot(F.col("_a") * F.cos("_t"), F.col("_b") * F.sin("_t")), F.hypot(F.col("_a") * F.sin("_t"), F.col("_b") * F.cos("_t"))

    def span(at: Column, half: Column, size: int) -> Column:
        low, high = F.greatest(F.lit(0), F.floor(at - half)).cast("long"), F.least(F.lit(size - 1), F.ceil(at + half)).cast("long")
        return F.explode(F.when(low <= high, F.sequence(low, F.greatest(low, high))))

    p = s.withColumns({"_dx": dx, "_dy": dy}).withColumn("y", span(F.col("_y"), F.col("_dy"), height)).withColumn("x", span(F.col("_x"), F.col("_dx"), width))
    u = (F.col("x") - F.col("_x")) * F.cos("_t") + (F.col("y") - F.col("_y")) * F.sin("_t")
    v = (F.col("y") - F.col("_y")) * F.cos("_t") - (F.col("x") - F.col("_x")) * F.sin("_t")
    return p.where(F.pow(u / F.col("_a"), F.lit(2.0)) + F.pow(v / F.col("_b"), F.lit(2.0)) <= 1).select("image_id", "y", "x").distinct()


def gaussian(frames: DataFrame, sigma: float, r: int) -> DataFrame:
    """Separable smoothing with zeros outside the image, kernel of 2 r + 1 taps that sums to 1. Images are whole rectangles.

    A pass takes the neighbours from the rows before and after in its line, so each pixel is shuffled once a pass."""
    k = [math.exp(-i * i / (2 * sigma * sigma)) for i in range(-r, r + 1)]
    out = frames.select("frame", *XY, "v")
    for axis, line in (("x", "y"), ("y", "x")):
        w = W.partitionBy("frame", line).orderBy(axis)
        out = out.withColumn("v", sum((F.lag("v", i, 0.0).over(w) * (x / sum(k)) for i, x in zip(range(-r, r + 1), k, strict=True)), F.lit(0.0)))
    return out


def robust_sky_sigma(frames: DataFrame, step: int = 8, least: int = 1000) -> DataFrame:
    """(frame, sigma) of every step-th row; null for under `least` values."""
    some = frames.where((F.col("y") % step == 0) & valid())
    return median_nmad(some, ["frame"], "v", bounded=False).select("frame", F.when(F.col("n") >= least, F.col("nmad")).alias("sigma"))


def optimal_scalars(scalars: DataFrame) -> DataFrame:
    """(frame, w, share, total) from (frame, f, s): w = 1 / (f s)**2, the share of the response, and its root sum F."""
    w = F.pow(F.col("f") * F.col("s"), F.lit(-2.0))
    everything = W.partitionBy()  # a row per frame
    return scalars.select("frame", w.alias("w"), (w / F.sum(w).over(everything)).alias("share"), F.sqrt(F.sum(w).over(everything)).alias("total"))


def optimal_stack(frames: DataFrame, scalars: DataFrame, sigma: float, r: int) -> DataFrame:
    """(y, x, numerator, response, count, weight) of frames (frame, y, x, v) and scalars (frame, f, s).

    Each frame is smoothed by its matched filter (its r outermost pixels read as 0) and added with w f; the response is the
    sum of the shares of the frames that have data there, count their number, and weight is F**2 times the response."""
    box = frames.groupBy("frame").agg(F.max("y").alias("_h"), F.max("x").alias("_w"))
    inner = F.col("y").between(r, F.col("_h") - r) & F.col("x").between(r, F.col("_w") - r)
    cut = frames.join(box, "frame").select("frame", *XY, F.when(inner & valid(), F.col("v")).otherwise(0.0).alias("v"))
    own = optimal_scalars(scalars).join(scalars.select("frame", "f"), "frame")
    matched = gaussian(cut, sigma, r).join(frames.select("frame", *XY, valid().alias("_ok")), ["frame", *XY]).join(own, "frame")
    seen = F.when(F.col("_ok"), F.col("share"))
    return matched.groupBy(*XY).agg(F.sum(F.col("w") * F.col("f") * F.col("v")).alias("numerator"), F.coalesce(F.sum(seen), F.lit(0.0)).alias("response"), F.count(seen).alias("count"), F.coalesce(F.first("total") * F.first("total") * F.sum(seen), F.lit(0.0)).alias("weight"))


def _eroded(ok: DataFrame, n: int) -> DataFrame:
    """m (0 or 1) as the least of the (2 n + 1) square, within the image."""
    for a, b in (("x", "y"), ("y", "x")):
        ok = ok.withColumn("m", F.min("m").over(W.partitionBy("frame", b).orderBy(a).rangeBetween(-n, n)))
    return ok


def erode(frames: DataFrame, n: int) -> DataFrame:
    """(frame, y, x, ok): valid pixels after n erosions by a 3 x 3 box; beyond the border counts as valid, and frames without gaps stay whole. Images are whole rectangles."""
    return _eroded(frames.select("frame", *XY, valid().cast("int").alias("m")), n).select("frame", *XY, (F.col("m") == 1).alias("ok"))


def shrink(masks: DataFrame, deltas: DataFrame) -> DataFrame:
    """masks (frame, y, x, ok) shrunk by the reach of a kernel of delta pixels (frame, delta): ceil(4 delta / sqrt(8 ln 2)), beyond
    the border counting as invalid. Frames without a gap, and those without a positive delta, stay as they are."""
    reach = F.ceil(4 * F.col("delta") / math.sqrt(8 * math.log(2))).cast("int")
    known = deltas.select("frame", F.when(F.col("delta") > 0, reach).otherwise(0).alias("_n"))
    box = masks.groupBy("frame").agg(F.max("y").alias("_h"), F.max("x").alias("_w"), F.min(F.col("ok").cast("int")).alias("_all"))
    m = masks.join(box.join(known, "frame", "left"), "frame").withColumn("_n", F.when(F.col("_all") == 1, 0).otherwise(F.coalesce("_n", F.lit(0))))
    # the nearest invalid pixel of a line before and after, then of the lines around: a square reaches n in both axes
    bad = m.withColumn("_bad", F.when(~F.col("ok"), F.col("x")))
    w = W.partitionBy("frame", "y").orderBy("x")
    before, after = F.last("_bad", True).over(w), F.last("_bad", True).over(W.partitionBy("frame", "y").orderBy(F.desc("x")))
    line = bad.withColumn("_d", F.least(F.coalesce(F.col("x") - before, F.lit(1 << 30)), F.coalesce(after - F.col("x"), F.lit(1 << 30))))
    line = line.withColumn("_hit", F.when(F.col("_d") <= F.col("_n"), F.col("y")))
    u = W.partitionBy("frame", "x").orderBy("y")
    up, down = F.last("_hit", True).over(u), F.last("_hit", True).over(W.partitionBy("frame", "x").orderBy(F.desc("y")))
    far = (F.coalesce(F.col("y") - up, F.lit(1 << 30)) > F.col("_n")) & (F.coalesce(down - F.col("y"), F.lit(1 << 30)) > F.col("_n"))
    inside = (F.least("y", F.col("_h") - F.col("y")) >= F.col("_n")) & (F.least("x", F.col("_w") - F.col("x")) >= F.col("_n"))
    return line.select("frame", *XY, F.when(F.col("_n") == 0, F.col("ok")).otherwise(far & inside).alias("ok"))


def forced_photometry(frames: DataFrame, targets: DataFrame, radius: float, inner: float, outer: float, gain: float, zp: float, zperr: float) -> DataFrame:
    """(frame, target, flux, err, mag, magerr, upper) at targets (target, ty, tx): circle sum less the annulus median.

    A pixel belongs to a region if its centre does (no fractional areas). Under SNR 3, or without flux, mag is the three-sigma limit."""
    j = _near_targets(frames, targets, int(math.ceil(outer)))
    d = F.hypot(F.col("x") - F.col("tx"), F.col("y") - F.col("ty"))
    inside, ring = d <= radius, (d >= inner) & (d <= outer)
    g = j.groupBy("frame", "target").agg(F.sum(F.when(inside, F.col("v"))).alias("s"), F.count_if(inside).alias("n"), F.median(F.when(ring, F.col("v"))).alias("sky"), F.stddev_pop(F.when(ring, F.col("v"))).alias("sd"))
    flux = F.col("s") - F.col("n") * F.col("sky")
    g = g.select("frame", "target", flux.alias("flux"), F.sqrt(F.greatest(flux, F.lit(0.0)) / gain + F.col("n") * F.col("sd") * F.col("sd")).alias("err"))
    upper = (F.col("flux") <= 0) | (F.col("flux") < 3 * F.col("err"))
    mag = F.when(upper, zp - 2.5 * F.log10(3 * F.col("err"))).otherwise(zp - 2.5 * F.log10(F.when(F.col("flux") > 0, F.col("flux"))))
    return g.select("frame", "target", "flux", "err", mag.alias("mag"), F.when(~upper, F.sqrt(F.pow(2.5 / math.log(10) * F.col("err") / F.col("flux"), F.lit(2.0)) + zperr * zperr)).alias("magerr"), upper.alias("upper"))


def _near_targets(frames: DataFrame, targets: DataFrame, r: int) -> DataFrame:
    """Pixels joined to the targets within r in both axes, by the targets' copies on the pixels around them."""
    t = _around(targets.withColumns({"y": F.round("ty").cast("long"), "x": F.round("tx").cast("long")}).withColumnsRenamed({"ty": "_ty", "tx": "_tx"}), r)
    t = t.select("target", F.col("_ty").alias("cy"), F.col("_tx").alias("cx"), F.col("ty").alias("y"), F.col("tx").alias("x"))
    return frames.join(t, XY).withColumnsRenamed({"cy": "ty", "cx": "tx"})


def stack_weights(frames: DataFrame, mode: str = "global") -> DataFrame:
    """frames (.., skysig) with w: 1 / skysig**2, 1 where that is missing or 0, and 1 everywhere when off."""
    w = F.coalesce(F.when(F.col("skysig") != 0, 1 / (F.col("skysig") * F.col("skysig"))), F.lit(1.0))
    return frames.withColumn("w", F.lit(1.0) if mode == "off" else w)


def to_tiles(frames: DataFrame, size: int) -> DataFrame:
    """Tiles (frame, ty, tx, h, w, data array<double>), row by row; missing pixels are 0."""
    part = frames.select("frame", F.floor(F.col("y") / size).alias("ty"), F.floor(F.col("x") / size).alias("tx"), (F.col("y") % size).alias("r"), (F.col("x") % size).alias("c"), "v")
    g = part.groupBy("frame", "ty", "tx").agg((F.max("r") + 1).alias("h"), (F.max("c") + 1).alias("w"), F.sort_array(F.collect_list(F.struct((F.col("r") * size + F.col("c")).alias("k"), "v"))).alias("a"))
    cells = F.flatten(F.transform(F.sequence(F.lit(0), F.col("h") - 1), lambda i: F.transform(F.sequence(F.lit(0), F.col("w") - 1), lambda j: i * size + j)))
    whole = F.transform("a", lambda x: x["v"])  # no pixel is missing, and they are in order
    patched = F.transform(cells, lambda k: F.coalesce(F.try_element_at(F.map_from_entries("a"), k), F.lit(0.0)))
    return g.select("frame", "ty", "tx", "h", "w", F.when(F.size("a") == F.col("h") * F.col("w"), whole).otherwise(patched).alias("data"))


def tile_median(tiles: DataFrame) -> DataFrame:
    """Median of the valid values at each place of a tile over its frames: (ty, tx, h, w, data)."""
    g = tiles.groupBy("ty", "tx", "h", "w").agg(F.collect_list("data").alias("stack"))

    def middle(k: Column) -> Column:
        v = F.array_sort(F.filter(F.transform("stack", lambda d: F.element_at(d, k)), lambda x: x != 0))
        n = F.size(v)
        return F.when(n > 0, (F.element_at(v, F.greatest(F.lit(1), F.floor((n + 1) / 2).cast("int"))) + F.element_at(v, F.greatest(F.lit(1), F.floor(n / 2 + 1).cast("int")))) / 2)

    return g.select("ty", "tx", "h", "w", F.transform(F.sequence(F.lit(1), (F.col("h") * F.col("w")).cast("int")), middle).alias("data"))

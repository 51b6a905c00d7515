"""Robust statistics per group: location and scale, iterative clipping, separations, axial alignment."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.storage import discard, durable

NMAD = 1.4826
"""Fixed value: scale of the median absolute deviation of a normal distribution."""


BROADCAST_ROWS = 100_000
"""Rows of a table of group statistics, counted, up to which it is broadcast; beyond, groups are joined by a shuffle."""
ACCURACY = 10_000


def join_stats(rows: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the statistics of their group. Few groups may be huge ones, so a small table (it is counted) is broadcast
    and no group has to fit one task; of many groups AQE splits what is skewed."""
    stats = durable(stats)
    return rows.join(F.broadcast(stats) if stats.count() <= BROADCAST_ROWS else stats, keys)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """(keys, n, q): exact quantiles of the non-null values of each group, linear between ranks, for groups of any size.

    A sketch of bounded size brackets each quantile; the ranks below the bracket are counted, and only the distinct values
    inside, some 6 / ACCURACY of the group, are sorted. (F.median holds all distinct values of a group in one buffer.)"""
    names = keys or ["_one"]
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    rows = rows if keys else rows.withColumn("_one", F.lit(1))
    wide = [min(1.0, max(0.0, p + d)) for p in probs for d in (-2 / ACCURACY, 2 / ACCURACY)]
    bounds = rows.groupBy(*names).agg(F.count("*").alias("n"), F.percentile_approx("_v", wide, ACCURACY).alias("b"))
    near = join_stats(rows, bounds, names)
    lo, hi, v = [F.col("b")[2 * i] for i in range(len(probs))], [F.col("b")[2 * i + 1] for i in range(len(probs))], F.col("_v")
    within = [(v >= a) & (v <= b) for a, b in zip(lo, hi, strict=True)]
    counts = near.groupBy(*names).agg(F.first("n").alias("n"), *[F.count_if(v < a).alias(f"_below{i}") for i, a in enumerate(lo)], *[F.max(F.when(v < a, v)).alias(f"_last{i}") for i, a in enumerate(lo)], *[F.min(F.when(v > b, v)).alias(f"_next{i}") for i, b in enumerate(hi)])
    values = near.where(reduce(or_, within)).groupBy(*names, "_v").agg(F.count("*").alias("_c"), *[F.first(x).alias(f"_in{i}") for i, x in enumerate(within)])
    w = W.partitionBy(*names).orderBy("_v")
    values = join_stats(values, counts, names)
    picked = []
    for i, p in enumerate(probs):
        values = values.withColumn(f"_cum{i}", F.col(f"_below{i}") + F.sum(F.when(F.col(f"_in{i}"), F.col("_c")).otherwise(0)).over(w))
        place = (F.col("n") - 1) * p
        for j, rank in enumerate((F.floor(place), F.ceil(place))):
            # a bracket may be one rank short at either end
            inside = F.coalesce(F.min(F.when(F.col(f"_in{i}") & (F.col(f"_cum{i}") > rank), v)), F.first(f"_next{i}"))
            picked.append(F.when(F.first(f"_below{i}") > F.first(rank), F.first(f"_last{i}")).otherwise(inside).alias(f"_q{i}_{j}"))
    found = values.groupBy(*names).agg(F.first("n").alias("n"), *picked)

    def between(i: int, p: float) -> Column:
        place = (F.col("n") - 1) * p
        low, high = F.col(f"_q{i}_0"), F.col(f"_q{i}_1")
        return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)

    return found.select(*keys, "n", F.array(*[between(i, p) for i, p in enumerate(probs)]).alias("q"))


def exact_medians(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, median) for groups of any size; without keys one row, unless there is no value."""
    return exact_quantiles(df, keys, value, [0.5]).select(*keys, "n", F.col("q")[0].alias("median"))


def median_nmad(df: DataFrame, keys: list[str], value: str, bounded: bool = True) -> DataFrame:
    """(keys, n, med, nmad): median and 1.4826 times the median absolute deviation. Null values do not count.

    bounded: no group has more values than a task can hold (the sources of an image); if not, exact_medians."""
    if bounded:
        med = df.groupBy(*keys).agg(F.median(value).alias("med"))
        return df.join(med, keys).groupBy(*keys).agg(F.count(value).alias("n"), F.first("med").alias("med"), (F.median(F.abs(F.col(value) - F.col("med"))) * NMAD).alias("nmad"))
    med = durable(exact_medians(df, keys, value).withColumnRenamed("median", "med"))
    off = join_stats(df.select(*keys, F.col(value).alias("_x")), med, keys).withColumn("_d", F.abs(F.col("_x") - F.col("med")))
    spread = exact_medians(off, keys, "_d").select(*keys, (F.col("median") * NMAD).alias("nmad"))
    return med.join(spread, keys).select(*keys, "n", "med", "nmad")


def sigma_clip(df: DataFrame, keys: list[str], value: str, sigma: float, passes: int, centre: str = "median", ddof: int = 0, strict: bool = False) -> DataFrame:
    """The rows of df that survive `passes` rounds of clipping at sigma standard deviations around the centre, per group.

    A round is a group aggregate joined back, so no group has to fit one task; each is written, as a round reads its
    predecessor twice and is deleted after it. strict keeps |v - c| < limit, else <=. Rows with a null value go."""
    rows, written = df.where(F.col(value).isNotNull()), None
    for _ in range(passes):
        s = F.coalesce((F.stddev_samp if ddof else F.stddev_pop)(value), F.lit(0.0)).alias("_s")
        if centre == "median":
            stats = exact_medians(rows, keys, value).select(*keys, F.col("median").alias("_c")).join(rows.groupBy(*keys).agg(s), keys)
        else:
            stats = rows.groupBy(*keys).agg(F.avg(value).alias("_c"), s)
        off = F.abs(F.col(value) - F.col("_c"))
        rows = join_stats(rows, stats, keys).where(off < F.col("_s") * sigma if strict else off <= F.col("_s") * sigma).drop("_c", "_s")
        before, rows = written, durable(rows)
        written = rows
        discard(*([before] if before is not None else []))
    return rows


def clipped_stats_fixed(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, mean, median, std): five passes around the mean at a strict three sigma (n - 1), then population std.

    The number of passes and the limit are fixed, as in the variant this stands for, whose arguments had no effect."""
    kept = sigma_clip(df, keys, value, 3.0, 5, centre="mean", ddof=1, strict=True)
    found = kept.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")).join(exact_medians(kept, keys, value), keys)
    every = df.select(*keys).distinct()
    return every.join(found, keys, "left").select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) if c == "n" else F.coalesce(c, F.lit(0.0)).alias(c) for c in ("n", "mean", "median", "std")])


def separation_stats(df: DataFrame, keys: list[str], sep: str, pixel: float) -> DataFrame:
    """Per group over matched rows: counts, rms, extremes, quartiles, P95 and P99, zero-centred deviation, fractions."""
    p = F.percentile(sep, [0.25, 0.5, 0.75, 0.95, 0.99])
    s = F.col(sep)
    return df.groupBy(*keys).agg(
        F.count(sep).alias("n"), F.sqrt(F.avg(s * s)).alias("rms"), F.min(sep).alias("lo"), F.max(sep).alias("hi"), p.alias("p"), (F.median(F.abs(s)) * NMAD).alias("mad"),
        F.avg((s < pixel).cast("double")).alias("frac_pixel"), F.avg((s < 1.0).cast("double")).alias("frac_arcsec"), F.avg(s.isNull().cast("double")).alias("unmatched"),
    ).select(*keys, "n", "rms", "lo", "hi", *[F.col("p")[i].alias(c) for i, c in enumerate(("q1", "q2", "q3", "p95", "p99"))], "mad", "frac_pixel", "frac_arcsec", "unmatched")


def radial_bin(r: Column, r_max: Column | float, bins: int) -> Column:
    """Index of the ring of equal area that holds r: edges at sqrt(k / bins) of r_max; null outside."""
    share = (r / r_max) * (r / r_max) * bins
    return F.when(share <= bins, F.least(F.floor(share), F.lit(bins - 1))).cast("int")


def axial_alignment(df: DataFrame, keys: list[str], angle: Column, weight: Column | None = None, normalised: bool = True) -> DataFrame:
    """(keys, r, axis, variance, sd) of directionless angles in degrees: resultant of doubled angles."""
    w = weight if weight is not None else F.lit(1.0)
    a = F.radians(angle) * 2
    known = angle.isNotNull()
    sums = df.groupBy(*keys).agg(F.sum(F.when(known, w * F.cos(a))).alias("c"), F.sum(F.when(known, w * F.sin(a))).alias("s"), F.sum(F.when(known, w)).alias("w"), F.count(angle).alias("n"))
    r = F.least(F.lit(1.0), F.hypot("c", "s") / (F.col("w") if normalised else F.col("n")))
    return sums.select(*keys, r.alias("r"), F.pmod(F.degrees(F.atan2("s", "c")) / 2, F.lit(180.0)).alias("axis"), (1 - r).alias("variance"), (F.degrees(F.sqrt(-2 * F.log(F.when(r > 0, r)))) / 2).alias("sd"))


def plateau_end(df: DataFrame, keys: list[str], order: str, value: str, width: int = 15, jump: float = 0.05) -> DataFrame:
    """(keys, plateau): how many of the brightest rows come before the moving average of value first falls by `jump`.

    The average runs over `width` rows around each row and counts missing rows as zeros."""
    half = width // 2
    w = W.partitionBy(*keys).orderBy(order)
    smooth = df.withColumn("_k", F.row_number().over(w)).withColumn("_m", F.sum(value).over(w.rowsBetween(-half, half)) / width)
    inner = smooth.withColumn("_d", F.col("_m") - F.lag("_m").over(w)).where(F.col("_k") > half + 1)
    return inner.groupBy(*keys).agg((F.coalesce(F.min(F.when(F.col("_d") < -jump, F.col("_k"))), F.lit(1)) - 1).alias("plateau"))


def saturated_end(df: DataFrame, keys: list[str], order: str, tie: str, flagged: Column, width: int = 15, share: float = 0.5) -> DataFrame:
    """(keys, plateau): how many rows come, in order, before the share of flagged ones among the `width` around falls under `share`; 0 if it
    never does. Rows beyond both ends count as not flagged."""
    half = width // 2
    w = W.partitionBy(*keys).orderBy(order, tie)
    seen = df.where(F.col(order).isNotNull()).select(*keys, order, tie, F.when(flagged, 1).otherwise(0).alias("_f")).select(*keys, F.row_number().over(w).alias("_k"), (F.sum("_f").over(w.rowsBetween(-half, width - 1 - half)) / width).alias("_m"))
    return seen.groupBy(*keys).agg((F.coalesce(F.min(F.when(F.col("_m") < share, F.col("_k"))), F.lit(1)) - 1).alias("plateau"))


def brightest(df: DataFrame, keys: list[str], order: str, tie: str, n: int) -> DataFrame:
    """The n rows of least `order` in each group."""
    w = W.partitionBy(*keys).orderBy(order, tie)
    return df.where(F.col(order).isNotNull()).withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def most_common(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """(keys, value, n): the most frequent value of each group; of equals the one met first in `order`."""
    per = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = per.groupBy(*keys).agg(F.max_by(F.struct(value, "n"), F.struct("n", (-F.col("first")).alias("f"))).alias("b"))
    return best.select(*keys, F.col(f"b.{value}").alias(value), F.col("b.n").alias("n"))

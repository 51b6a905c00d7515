"""Photometric calibration: filters on catalogs, zero points, filter inference, magnitudes and fluxes."""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.functions import sky
from starloom.operators import stats
from starloom.operators.footprints import frames_at_points
from starloom.operators.skyjoin import sky_pairs
from starloom.storage import durable

OPERATORS = {
    "lower": operator.gt, ">": operator.gt, ">=": operator.ge, "upper": operator.lt, "<": operator.lt, "<=": operator.le, "equal": operator.eq, "=": operator.eq, "==": operator.eq,
}
"""Names of comparisons; `lower` names a lower bound, and is strict."""
MU_JY_ZERO = 23.9
"""Fixed value: AB magnitude of one microjansky."""


def condition(triples) -> Column:
    """AND of (column, operator, value) triples, or of a flat list of three per condition."""
    flat = list(triples)
    if flat and not isinstance(flat[0], (tuple, list)):
        if len(flat) % 3:
            raise ValueError("a flat list needs three items for each condition")
        flat = [tuple(flat[i: i + 3]) for i in range(0, len(flat), 3)]
    return functools.reduce(lambda a, b: a & b, (OPERATORS[op](F.col(c), v) for c, op, v in flat), F.lit(True))


def calibration_sample(df: DataFrame, mag: str, snr: float = 20.0, low: float = 12.0, high: float = 17.5, fraction: float = 0.75, width: int = 9576, height: int = 6388) -> DataFrame:
    """Unflagged rows inside the central ellipse with a finite reference magnitude strictly within bounds and enough SNR."""
    a, b = fraction * width / 2, fraction * height / 2
    inside = ((F.col("x") - width / 2) / a) ** 2 + ((F.col("y") - height / 2) / b) ** 2 <= 1
    m = F.col(mag)
    return df.where((F.col("flags") == 0) & inside & m.isNotNull() & ~F.isnan(m) & (m > low) & (m < high) & (F.col("snr") > snr))


def interval_cuts(df: DataFrame, **cuts: tuple[float, float]) -> DataFrame:
    """Open interval for each named column that exists."""
    return df.where(condition([t for c, (lo, hi) in cuts.items() if c in df.columns for t in ((c, ">", lo), (c, "<", hi))]))


def zero_points(matched: DataFrame, keys: list[str], ref: str = "mag", inst: str = "mag_inst", sigma: float = 2.0, passes: int = 5) -> DataFrame:
    """(keys, n, zp, zperr): median of ref - inst after clipping around the median, and the scaled deviation of what is left."""
    diff = matched.withColumn("dz", F.col(ref) - F.col(inst))
    kept = stats.sigma_clip(diff, keys, "dz", sigma, passes)
    return stats.median_nmad(kept, keys, "dz", bounded=False).select(*keys, "n", F.col("med").alias("zp"), F.col("nmad").alias("zperr"))


def limiting_mag(n_sigma: float, zp: Column, aperture: Column, sky_sigma: Column) -> Column:
    """Depth at n sigma of the sky noise in a circular aperture of that diameter, to three places."""
    area = F.sqrt(F.lit(math.pi)) * aperture / 2
    return F.round(zp - 2.5 * F.log10(n_sigma * area * sky_sigma), 3)


def infer_filter(zps: DataFrame, keys: list[str], alleged: str = "alleged", active: DataFrame | None = None) -> DataFrame:
    """(keys, filt): the candidate of least zero-point error, medium bands (m...) only if their zero point is at most 27.2; the alleged one if none.

    active: (keys, filt) of the filters in use that night; others are no candidates, unless a key has none at all."""
    usable = F.col("zperr").isNotNull() & ~(F.col("filt").startswith("m") & (F.col("zp") > 27.2))
    if active is not None:
        a = active.groupBy(*keys).agg(F.collect_set("filt").alias("_active"))  # the filters of an instrument
        zps = zps.join(a, keys, "left")
        usable = usable & (F.col("_active").isNull() | F.array_contains("_active", F.col("filt")))
    best = zps.groupBy(*keys).agg(F.min(F.when(usable, F.struct("zperr", "filt"))).alias("b"), F.first(alleged, ignorenulls=True).alias("a"))
    return best.select(*keys, F.coalesce(F.col("b.filt"), F.col("a")).alias("filt"))


def calibrated(mag: Column, err: Column, zp: Column, zperr: Column) -> dict[str, Column]:
    """Calibrated magnitude, error in quadrature, flux in microjansky, flux error and SNR."""
    m, e = mag + zp, F.sqrt(err * err + zperr * zperr)
    flux = F.pow(F.lit(10.0), (MU_JY_ZERO - m) / 2.5)
    k = 2.5 / math.log(10)
    return {"mag_cal": m, "magerr_cal": e, "flux": flux, "fluxerr": flux * e / k, "snr_cal": k / e}


def rss(*columns: Column) -> Column:
    """Root of summed squares; null and NaN count as 0."""
    return F.sqrt(functools.reduce(operator.add, (F.pow(F.nanvl(F.coalesce(c, F.lit(0.0)), F.lit(0.0)), F.lit(2.0)) for c in columns)))


def flux_scale(zp: Column, on: bool = True) -> Column:
    """10 ** (0.4 (23.9 - zp)); a missing zero point is an error; null when scaling is off."""
    if not on:
        return F.lit(None).cast("double")
    return F.when(zp.isNull(), F.raise_error(F.lit("missing zero point")).cast("double")).otherwise(F.pow(F.lit(10.0), 0.4 * (MU_JY_ZERO - zp)))


def aperture_diameters(peeing: Column, pixel_scale: float, factors: dict[str, float], fixed: dict[str, float]) -> dict[str, Column]:
    """Diameters in pixels: factors of the seeing in pixels, and fixed arcsecs over the pixel scale."""
    return {k: peeing * v for k, v in factors.items()} | {k: F.lit(v / pixel_scale) for k, v in fixed.items()}


def evaluation_sample(sources: DataFrame, reference: DataFrame, fields: DataFrame, radius: float, years: float, n_ref: int = 100, n_sci: int | None = None) -> DataFrame:
    """(image_id, source_id, det_id, separation, flags, plateau) of what an image's astrometry is judged by.

    sources: image_id, det_id, ra, dec, mag_auto, flags. reference: source_id, ra, dec, mag, pmra, pmdec. fields: image_id, shape (of
    footprints.with_footprint). Of each image, in order of magnitude: the saturated end of its sources (saturated_end over the flags),
    the brightest n_sci and as many more as that, and of the reference inside its footprint the brightest n_ref and as many more. Each
    of these, moved by `years` of proper motion, gets the image's nearest source within `radius` arcsec; those matched to a flagged source go,
    those without a match stay."""
    plateau = stats.saturated_end(sources, ["image_id"], "mag_auto", "det_id", F.col("flags") != 0)

    def top(rows: DataFrame, order: str, tie: str, n: int) -> DataFrame:
        w = W.partitionBy("image_id").orderBy(order, tie)
        return rows.where(F.col(order).isNotNull()).withColumn("_k", F.row_number().over(w)).join(plateau, "image_id").where(F.col("_k") <= n + F.col("plateau")).drop("_k")

    inside = frames_at_points(reference.select("source_id", "ra", "dec", F.struct("ra", "dec", "mag", "pmra", "pmdec").alias("r")), fields.select("image_id", "shape"))
    ref = top(inside.select("image_id", "source_id", "r.*"), "mag", "source_id", n_ref)
    ra, dec = sky.moved(F.col("ra"), F.col("dec"), F.col("pmra"), F.col("pmdec"), years)
    ref = durable(ref.select("image_id", "source_id", ra.alias("ra"), dec.alias("dec"), "plateau").withColumn("key", F.struct("image_id", "source_id")))
    sci = top(sources, "mag_auto", "det_id", n_sci or n_ref)
    pairs = sky_pairs(ref, sci.withColumn("key", F.struct("image_id", "det_id", "flags")), radius, "key", "key").where("a_id.image_id = b_id.image_id")
    best = pairs.groupBy("a_id").agg(F.min(F.struct("separation", F.col("b_id.det_id").alias("det_id"), F.col("b_id.flags").alias("flags"))).alias("m"))
    found = ref.join(best, F.col("key") == F.col("a_id"), "left").select("image_id", "source_id", "m.det_id", "m.separation", "m.flags", "plateau")
    return found.where("flags = 0 OR det_id IS NULL")

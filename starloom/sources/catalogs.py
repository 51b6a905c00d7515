"""Reference catalogs: cleaning, writing by sky cell, and loading the cells around a position."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import healpix, sky

NSIDE = 64
"""Cells are nested equal-area pixels: 49,152 of 0.84 square degrees."""


def clean_reference(df: DataFrame, pm: tuple[str, ...] = ("pmra", "pmdec"), must: tuple[str, ...] = ("ra", "dec", "mag", "bp_rp")) -> DataFrame:
    """Drop rows whose other numbers are missing or NaN; missing proper motions become 0 and are flagged; errors from the magnitude error."""
    lost = [F.col(c).isNull() | F.isnan(c) for c in pm]
    good = [F.col(c).isNotNull() & ~F.isnan(c) for c in must if c in df.columns]
    keep = good[0]
    for g in good[1:]:
        keep = keep & g
    touched = lost[0]
    for x in lost[1:]:
        touched = touched | x
    return df.where(keep).withColumns({"touched": touched, "pm_err": 230 * F.col("mag_err") + 0.1, "ra_err": F.col("mag_err") * F.cos(F.radians("dec")), **{c: F.nanvl(F.coalesce(c, F.lit(0.0)), F.lit(0.0)) for c in pm}})


#: Columns of the survey's table that a reference catalog is made of.
SOURCE_COLUMNS = {
    "source_id": "long", "ra": "double", "dec": "double", "ra_error": "double", "dec_error": "double", "pmra": "double", "pmdec": "double", "pmra_error": "double", "pmdec_error": "double", "phot_g_mean_flux": "double",
    "phot_g_mean_flux_error": "double", "phot_g_mean_mag": "double", "ref_epoch": "double",
}


def read_sources(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The columns in use of CSV files without a header, whose columns have these names in this order; only they are parsed."""
    schema = ", ".join(f"`{n}` {SOURCE_COLUMNS.get(n, 'string')}" for n in names)
    return spark.read.schema(schema).csv(path).select(*[c for c in SOURCE_COLUMNS if c in names])


def build_reference(sources: DataFrame, ra: float, dec: float, a: float, b: float, angle: float, must: tuple[str, ...] = ("ra", "dec", "mag")) -> DataFrame:
    """Reference rows inside the sky ellipse of semi-axes a, b degrees and position angle: the magnitude error from the flux and
    its error, position errors from milliarcsec to degrees, rows with a missing number in `must` dropped, missing proper
    motions 0 and flagged in touched."""
    t = F.radians(sky.position_angle(F.lit(ra), F.lit(dec), F.col("ra"), F.col("dec")) - angle)
    reach = a * b / F.sqrt((b * F.cos(t)) ** 2 + (a * F.sin(t)) ** 2)
    error = 2.5 / math.log(10) * F.col("phot_g_mean_flux_error") / F.col("phot_g_mean_flux")
    inside = sources.where(sky.separation(F.lit(ra), F.lit(dec), F.col("ra"), F.col("dec")) / 3600 <= reach).withColumns({"mag": F.col("phot_g_mean_mag"), "mag_err": error, "ra_error": F.col("ra_error") / 3.6e6, "dec_error": F.col("dec_error") / 3.6e6})
    return clean_reference(inside.drop("phot_g_mean_flux", "phot_g_mean_flux_error", "phot_g_mean_mag"), must=must).drop("pm_err", "ra_err")


def write_cells(df: DataFrame, path: str, nside: int = NSIDE) -> None:
    """Parquet partitioned by cell; a cell with many rows is split over several files and tasks."""
    df.withColumn("cell", healpix.nested_pixel(F.col("ra"), F.col("dec"), nside)).hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)


def load_cone(spark: SparkSession, path: str, ra: float, dec: float, radius: float, columns: list[str], key: str = "source_id", nside: int = NSIDE) -> DataFrame:
    """Rows within `radius` degrees, reading only the cells that the cone touches; unique by key. nside: that of the writing."""
    df = spark.read.parquet(path).where(F.col("cell").isin(healpix.disc_pixels(ra, dec, radius, nside)))
    return df.where(sky.in_cone(F.col("ra"), F.col("dec"), ra, dec, radius)).select(*columns).dropDuplicates([key])

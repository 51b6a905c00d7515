"""An image's own sky solution as column expressions: TAN projection with a CD matrix, pixels counted from 1 at their centres.

A solution is a set of columns crval1, crval2 (degrees), crpix1, crpix2, cd11, cd12, cd21, cd22 (degrees per pixel), given to the
functions by a name of theirs or as a prefix in front. Distortion polynomials are not built.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions import sky

COLUMNS = ("crval1", "crval2", "crpix1", "crpix2", "cd11", "cd12", "cd21", "cd22")


def cd_matrix(scale: Column, angle: Column, flipped: Column) -> dict[str, Column]:
    """CD matrix of a pixel scale in arcsec and a position angle in degrees; flipped frames are mirrored along RA."""
    s, a = scale / 3600, F.radians(angle)
    sign = F.when(flipped, 1.0).otherwise(-1.0)
    return {"cd11": sign * s * F.cos(a), "cd12": -sign * s * F.sin(a), "cd21": s * F.sin(a), "cd22": s * F.cos(a)}


def _solution(prefix: str) -> dict[str, Column]:
    return {c: F.col(prefix + c) for c in COLUMNS}


def pixel_to_sky(x: Column, y: Column, prefix: str = "") -> tuple[Column, Column]:
    """(ra, dec) of a pixel position."""
    s = _solution(prefix)
    dx, dy = x - s["crpix1"], y - s["crpix2"]
    return sky.tan_deproject(s["cd11"] * dx + s["cd12"] * dy, s["cd21"] * dx + s["cd22"] * dy, s["crval1"], s["crval2"])


def sky_to_pixel(ra: Column, dec: Column, prefix: str = "") -> tuple[Column, Column]:
    """(x, y) of a sky position; null for the half of the sky behind the projection."""
    s = _solution(prefix)
    xi, eta = sky.tan_project(ra, dec, s["crval1"], s["crval2"])
    det = s["cd11"] * s["cd22"] - s["cd12"] * s["cd21"]
    front = sky.chord2(sky.xyz(ra, dec), sky.xyz(s["crval1"], s["crval2"])) < 2
    x = s["crpix1"] + (s["cd22"] * xi - s["cd12"] * eta) / det
    y = s["crpix2"] + (s["cd11"] * eta - s["cd21"] * xi) / det
    return F.when(front, x), F.when(front, y)


def flipped(prefix: str = "") -> Column:
    """RA grows with x."""
    s = _solution(prefix)
    return s["cd11"] * s["cd22"] - s["cd12"] * s["cd21"] > 0


def rotation(prefix: str = "") -> Column:
    """Degrees from north, counterclockwise."""
    return F.degrees(F.atan2(F.col(prefix + "cd21"), F.col(prefix + "cd22")))


def centre(width: Column, height: Column, prefix: str = "") -> tuple[Column, Column]:
    return pixel_to_sky((width + 1) / 2, (height + 1) / 2, prefix)


#: Corners of the quad in pixels as (share of the width, offset, share of the height, offset), flipped frames first.
QUAD = {True: ((1, 0.5, 1, 0.5), (1, 0.5, 0, 0.5), (0, -0.5, 0, 0.5), (0, -0.5, 1, 0.5)), False: ((0, -0.5, 1, 0.5), (0, -0.5, 0, -0.5), (1, 0.5, 0, -0.5), (1, 0.5, 1, 0.5))}


def quad(width: Column, height: Column, prefix: str = "") -> Column:
    """Four corners of a frame as an array of (ra, dec), from the outer edges of its pixels."""
    corners = []
    for a, b in zip(QUAD[True], QUAD[False], strict=True):
        x, y = (F.when(flipped(prefix), a[i] * side + a[i + 1]).otherwise(b[i] * side + b[i + 1]) for i, side in ((0, width), (2, height)))
        ra, dec = pixel_to_sky(x, y, prefix)
        corners.append(F.struct(ra.alias("ra"), dec.alias("dec")))
    return F.array(*corners)

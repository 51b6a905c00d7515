"""Equal-area sky pixels in the nested scheme: the number as a column expression, and the pixels that a disc touches."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _spread(c: Column) -> Column:
    """The bits of a number under 2**16 at the even places."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return c


def nested_pixel(ra: Column, dec: Column, nside: int) -> Column:
    """Number of the pixel that holds a position in degrees; nside is a power of two up to 2**15. Null without a position."""
    if nside < 1 or nside > 1 << 15 or nside & (nside - 1):
        raise ValueError("nside is a power of two up to 32768")
    z = F.sin(F.radians(dec))
    high = F.abs(z)
    turn = F.pmod(ra, F.lit(360.0)) / 90
    turn = F.when(turn >= 4, 0.0).otherwise(turn)
    # the equatorial belt: lines that rise and fall
    mid, tilt = nside * (0.5 + turn), nside * z * 0.75
    up, down = F.floor(mid - tilt), F.floor(mid + tilt)
    fu, fd = F.floor(up / nside), F.floor(down / nside)
    belt = {"face": F.when(fu == fd, fu % 4 + 4).when(fu < fd, fu % 4).otherwise(fd % 4 + 8), "x": down % nside, "y": nside - 1 - up % nside}
    # the caps: distance from the pole
    quarter = F.least(F.floor(turn), F.lit(3))
    far = nside * F.sqrt(F.greatest(F.lit(0.0), 3 * (1 - high)))
    p = F.least(F.floor((turn - quarter) * far), F.lit(nside - 1))
    m = F.least(F.floor((1 - turn + quarter) * far), F.lit(nside - 1))
    north = z >= 0
    cap = {"face": F.when(north, quarter).otherwise(quarter + 8), "x": F.when(north, nside - 1 - m).otherwise(p), "y": F.when(north, nside - 1 - p).otherwise(m)}
    face, x, y = (F.when(high <= 2 / 3, belt[k]).otherwise(cap[k]).cast("long") for k in ("face", "x", "y"))
    return face * nside * nside + _spread(x) + F.shiftleft(_spread(y), 1)


def _gather(n: np.ndarray) -> np.ndarray:
    """The bits at the even places."""
    out = np.zeros_like(n)
    for i in range(16):
        out |= ((n >> (2 * i)) & 1) << i
    return out


def centres(pixels: np.ndarray, nside: int) -> np.ndarray:
    """Unit vectors of the centres of nested pixels."""
    face, inside = np.divmod(np.asarray(pixels, np.int64), nside * nside)
    x, y = _gather(inside), _gather(inside >> 1)
    row, column = np.divmod(face, 4)
    ring = (row + 2) * nside - x - y - 1  # from 1 at the north to 4 nside - 1
    n = np.where(ring < nside, ring, np.where(ring > 3 * nside, 4 * nside - ring, nside))
    z = np.where(ring < nside, 1 - n * n / (3 * nside * nside), np.where(ring > 3 * nside, n * n / (3 * nside * nside) - 1, (2 * nside - ring) * 2 / (3 * nside)))
    lead = np.where(row == 1, 2 * column, 2 * column + 1)
    phi = (lead * n + x - y) * (math.pi / 4) / n
    flat = np.sqrt(1 - z * z)
    return np.stack([flat * np.cos(phi), flat * np.sin(phi), z], 1)


def reach(nside: int) -> float:
    """The largest distance, in radians, of a pixel's points from its centre."""
    a = math.pi / (4 * nside)
    z1, z2 = 2 / 3, 1 - (1 - 1 / nside) ** 2 / 3
    return math.acos(min(1.0, math.sqrt(1 - z1 * z1) * math.sqrt(1 - z2 * z2) * math.cos(a) + z1 * z2))


def disc_pixels(ra: float, dec: float, radius: float, nside: int) -> list[int]:
    """All pixels that a disc of `radius` degrees may touch, and few others, found by descending from the twelve faces."""
    a, d, r = math.radians(ra), math.radians(dec), math.radians(radius)
    centre = np.array([math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d)])
    pixels, n = np.arange(12), 1
    while True:
        far = np.arccos(np.clip(centres(pixels, n) @ centre, -1, 1))
        pixels = pixels[far <= r + reach(n) + 1e-9]
        if n == nside:
            return sorted(pixels.tolist())
        pixels, n = (4 * pixels[:, None] + np.arange(4)).reshape(-1), 2 * n

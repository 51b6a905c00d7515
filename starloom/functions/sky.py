"""Spherical geometry as column expressions. Degrees in, degrees or arcsec out."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ARCSEC = math.pi / 648000
"""Radians in an arcsec."""


def xyz(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    """Unit vector."""
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def chord2(p, q) -> Column:
    """Squared distance of two vectors."""
    return sum(((a - b) * (a - b) for a, b in zip(p[1:], q[1:], strict=True)), (p[0] - q[0]) * (p[0] - q[0]))


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Arcsec, stable for small angles."""
    return 2 * F.asin(F.least(F.lit(1.0), F.sqrt(chord2(xyz(ra1, dec1), xyz(ra2, dec2))) / 2)) / ARCSEC


def offsets(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> tuple[Column, Column]:
    """(dra cos dec, ddec) in arcsec of point 2 in the frame centred on point 1."""
    d1, d2, a = F.radians(dec1), F.radians(dec2), F.radians(ra2 - ra1)
    x = F.cos(d2) * F.cos(a)
    east = F.atan2(F.cos(d2) * F.sin(a), x * F.cos(d1) + F.sin(d2) * F.sin(d1))
    north = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.sin(d2) * F.cos(d1) - x * F.sin(d1))))
    return east / ARCSEC, north / ARCSEC


def position_angle(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """East of north from point 1 to point 2, in [0, 360)."""
    d1, d2, a = F.radians(dec1), F.radians(dec2), F.radians(ra2 - ra1)
    pa = F.degrees(F.atan2(F.sin(a), F.cos(d1) * F.tan(d2) - F.sin(d1) * F.cos(a)))
    return F.pmod(pa, F.lit(360.0))


def tan_project(ra: Column, dec: Column, ra0: float | Column, dec0: float | Column) -> tuple[Column, Column]:
    """Gnomonic plane coordinates in degrees around (ra0, dec0)."""
    ra0, dec0 = (c if isinstance(c, Column) else F.lit(c) for c in (ra0, dec0))
    d, d0, a = F.radians(dec), F.radians(dec0), F.radians(ra - ra0)
    cos_c = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    return F.degrees(F.cos(d) * F.sin(a) / cos_c), F.degrees((F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a)) / cos_c)


def tan_deproject(xi: Column, eta: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    """Inverse of tan_project: (ra in [0, 360), dec)."""
    x, y, d0 = F.radians(xi), F.radians(eta), F.radians(dec0)
    down = F.cos(d0) - y * F.sin(d0)
    ra = F.pmod(ra0 + F.degrees(F.atan2(x, down)), F.lit(360.0))
    return ra, F.degrees(F.atan2(F.sin(d0) + y * F.cos(d0), F.sqrt(x * x + down * down)))


def moved(ra: Column, dec: Column, pmra: Column, pmdec: Column, years: float) -> tuple[Column, Column]:
    """Position after `years` of proper motion (mas/yr, pmra with cos dec); rows without both stay."""
    x, y, z = xyz(ra, dec)
    a, d = F.radians(ra), F.radians(dec)
    east = pmra * (years * ARCSEC / 1000)
    north = pmdec * (years * ARCSEC / 1000)
    vx = x - east * F.sin(a) - north * F.sin(d) * F.cos(a)
    vy = y + east * F.cos(a) - north * F.sin(d) * F.sin(a)
    vz = z + north * F.cos(d)
    known = pmra.isNotNull() & pmdec.isNotNull()
    return (F.when(known, F.pmod(F.degrees(F.atan2(vy, vx)), F.lit(360.0))).otherwise(ra),
            F.when(known, F.degrees(F.atan2(vz, F.sqrt(vx * vx + vy * vy)))).otherwise(dec))


def in_ra_box(ra: Column, low: float, high: float) -> Column:
    """RA between low and high, through 0 if low > high."""
    return ra.between(low, high) if low <= high else (ra >= low) | (ra <= high)


def in_polygon(ra: Column, dec: Column, corners: list[tuple[float, float]]) -> Column:
    """Inside a convex great-circle polygon: on one side of all its edges. Needs three corners; closes itself."""
    if len(corners) < 3:
        raise ValueError("a polygon needs three corners")
    p = xyz(ra, dec)
    v = [(math.cos(math.radians(d)) * math.cos(math.radians(a)), math.cos(math.radians(d)) * math.sin(math.radians(a)), math.sin(math.radians(d))) for a, d in corners]
    sides = []
    for (ax, ay, az), (bx, by, bz) in zip(v, v[1:] + v[:1], strict=True):
        normal = (ay * bz - az * by, az * bx - ax * bz, ax * by - ay * bx)
        sides.append(sum((c * n for c, n in zip(p[1:], normal[1:], strict=True)), p[0] * normal[0]))
    middle = [sum(c) for c in zip(*v, strict=True)]
    front = p[0] * middle[0] + p[1] * middle[1] + p[2] * middle[2] > 0
    return front & ((F.least(*sides) >= -1e-12) | (F.greatest(*sides) <= 1e-12))


def in_cone(ra: Column, dec: Column, ra0: float, dec0: float, radius: float) -> Column:
    """Within `radius` degrees."""
    p = tuple(F.lit(c) for c in (math.cos(math.radians(dec0)) * math.cos(math.radians(ra0)), math.cos(math.radians(dec0)) * math.sin(math.radians(ra0)), math.sin(math.radians(dec0))))
    return chord2(xyz(ra, dec), p) <= (2 * math.sin(math.radians(radius) / 2)) ** 2


#: Rotation from equatorial (J2000) to galactic axes.
GALACTIC = ((-0.0548755604162154, -0.8734370902348850, -0.4838350155487132), (0.4941094278755837, -0.4448296299600112, 0.7469822444972189), (-0.8676661490190047, -0.1980763734312015, 0.4559837761750669))


def galactic(ra: Column, dec: Column) -> tuple[Column, Column]:
    """(l, b) in degrees."""
    p = xyz(ra, dec)
    x, y, z = (sum((c * k for c, k in zip(p[1:], row[1:], strict=True)), p[0] * row[0]) for row in GALACTIC)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0)), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z))))


def from_galactic(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(ra, dec) of galactic coordinates, the inverse of galactic()."""
    p = xyz(lon, lat)
    x, y, z = (sum((p[i] * GALACTIC[i][k] for i in (1, 2)), p[0] * GALACTIC[0][k]) for k in range(3))
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0)), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z))))

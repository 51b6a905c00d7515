"""Queries: images' own sky solutions and searches by their footprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.fixtures import table, with_
from starloom.functions import sky, wcs
from starloom.operators import footprints, photometry
from starloom.plans.registry import query
from starloom.storage import durable

# Gnomonic positions by vectors: the tangent point plus xi to the east and eta to the north.
FRAME = "cos(radians({d})) * cos(radians({a})) AS cx, cos(radians({d})) * sin(radians({a})) AS cy, sin(radians({d})) AS cz, -sin(radians({a})) AS ex, cos(radians({a})) AS ey, -sin(radians({d})) * cos(radians({a})) AS nx, -sin(radians({d})) * sin(radians({a})) AS ny, cos(radians({d})) AS nz"
TANGENT = FRAME.format(a="crval1", d="crval2")
ALONG = "cx + xi * ex + eta * nx AS vx, cy + xi * ey + eta * ny AS vy, cz + eta * nz AS vz"
RADEC = "(degrees(atan2(vy, vx)) + 360) % 360 AS ra, degrees(atan2(vz, sqrt(vx * vx + vy * vy))) AS dec"
PLANE = "radians(cd11 * (x - crpix1) + cd12 * (y - crpix2)) AS xi, radians(cd21 * (x - crpix1) + cd22 * (y - crpix2)) AS eta"
CORNERS = f""", box AS (SELECT s.*, k, CASE WHEN image_id % 2 = 0 THEN CASE WHEN k < 2 THEN naxis1 + 0.5 ELSE -0.5 END WHEN k < 2 THEN -0.5 ELSE naxis1 + 0.5 END AS x,
 CASE WHEN k IN (0, 3) THEN naxis2 + 0.5 WHEN image_id % 2 = 0 THEN 0.5 ELSE -0.5 END AS y FROM solutions s, (SELECT unnest([0, 1, 2, 3]) AS k)),
 corner AS MATERIALIZED (SELECT image_id, kind, k, cx, cy, cz, {ALONG} FROM (SELECT *, {PLANE}, {TANGENT} FROM box))"""


@query(with_("exposures", "solutions") + CORNERS + f""", mid AS (SELECT image_id, {RADEC} FROM (SELECT image_id, {ALONG} FROM (SELECT *, (naxis1 + 1) / 2.0 AS x, (naxis2 + 1) / 2.0 AS y FROM (SELECT *, {TANGENT} FROM solutions)) t, LATERAL (SELECT {PLANE}))),
 four AS (SELECT image_id, k, {RADEC} FROM corner) SELECT s.image_id, round(mid.ra, 6) AS ra_centre, round(mid.dec, 6) AS dec_centre, round(degrees(atan2(cd21, cd22)), 6) AS rotation, image_id % 2 = 0 AS flipped,
 {", ".join(f"(SELECT round(ra, 6) FROM four f WHERE f.image_id = s.image_id AND k = {k}) AS ra{k}, (SELECT round(dec, 6) FROM four f WHERE f.image_id = s.image_id AND k = {k}) AS dec{k}" for k in range(4))} FROM solutions s JOIN mid USING (image_id)""")
def e6_field_geometry(spark, sf):
    """Centre, quad, rotation and flip of every image from its own solution."""
    s = table(spark, sf, "solutions")
    ra, dec = wcs.centre(F.col("naxis1"), F.col("naxis2"))
    s = s.withColumn("quad", wcs.quad(F.col("naxis1"), F.col("naxis2")))
    corners = [F.round(F.col("quad")[k][c], 6).alias(f"{c}{k}") for k in range(4) for c in ("ra", "dec")]
    return s.select("image_id", F.round(ra, 6).alias("ra_centre"), F.round(dec, 6).alias("dec_centre"), F.round(wcs.rotation(), 6).alias("rotation"), wcs.flipped().alias("flipped"), *corners)


@query(with_("det", "exposures", "solutions") + f""", j AS (SELECT d.det_id, d.image_id, d.x, d.y, s.* EXCLUDE (image_id) FROM det d JOIN solutions s USING (image_id)), v AS (SELECT *, {ALONG} FROM (SELECT *, {PLANE}, {TANGENT} FROM j))
 SELECT det_id, image_id, round(x, 6) AS x, round(y, 6) AS y, round(ra, 6) AS ra, round(dec, 6) AS dec, true AS returns FROM (SELECT det_id, image_id, x, y, {RADEC} FROM v)""")
def e16_reprojected(spark, sf):
    """Catalog rows put on the sky by the solution of their image; `returns`: to the sky, back and to the sky again differ by under 1e-9 degrees."""
    j = table(spark, sf, "det").drop("ra", "dec").join(table(spark, sf, "solutions").drop("kind"), "image_id")
    ra, dec = wcs.pixel_to_sky(F.col("x"), F.col("y"))
    j = j.withColumns({"ra": ra, "dec": dec})
    x, y = wcs.sky_to_pixel(F.col("ra"), F.col("dec"))
    j = j.withColumns({"x2": x, "y2": y})
    ra2, dec2 = wcs.pixel_to_sky(F.col("x2"), F.col("y2"))
    back = (F.abs(ra2 - F.col("ra")) < 1e-9) & (F.abs(dec2 - F.col("dec")) < 1e-9)
    return j.select("det_id", "image_id", F.round("x2", 6).alias("x"), F.round("y2", 6).alias("y"), F.round("ra", 6).alias("ra"), F.round("dec", 6).alias("dec"), back.alias("returns"))


GALACTIC = "-0.0548755604162154, 0.4941094278755837, -0.8676661490190047; -0.8734370902348850, -0.4448296299600112, -0.1980763734312015; -0.4838350155487132, 0.7469822444972189, 0.4559837761750669"
_TURN = [" + ".join(f"({c}) * {v}" for c, v in zip(row.split(","), ("gx", "gy", "gz"), strict=True)) for row in GALACTIC.split(";")]
POINTS = f""", g AS (SELECT *, cos(radians(lat)) * cos(radians(lon)) AS gx, cos(radians(lat)) * sin(radians(lon)) AS gy, sin(radians(lat)) AS gz FROM requests),
 p AS MATERIALIZED (SELECT request, {", ".join(f"CASE coord_sys WHEN 'galactic' THEN {t} ELSE g{k} END AS p{k}" for k, t in zip("xyz", _TURN, strict=True))} FROM g)"""
SIDES = """, side AS MATERIALIZED (SELECT image_id, kind, k, cx, cy, cz, (vy * wz - vz * wy) * turn AS sx, (vz * wx - vx * wz) * turn AS sy, (vx * wy - vy * wx) * turn AS sz FROM
 (SELECT a.*, b.vx AS wx, b.vy AS wy, b.vz AS wz, sign((a.vy * b.vz - a.vz * b.vy) * a.cx + (a.vz * b.vx - a.vx * b.vz) * a.cy + (a.vx * b.vy - a.vy * b.vx) * a.cz) AS turn FROM corner a JOIN corner b ON b.image_id = a.image_id AND b.k = (a.k + 1) % 4))"""


def _stored(solutions):
    """The table of footprints, written once, as an archive keeps it."""
    quads = solutions.where("kind = 'science'").select("image_id", wcs.quad(F.col("naxis1"), F.col("naxis2")).alias("corners"))
    return durable(footprints.with_footprint(quads).select("image_id", "shape"))


def _points(spark, sf):
    r = table(spark, sf, "requests")
    ra, dec = sky.from_galactic(F.col("lon"), F.col("lat"))
    far = F.col("coord_sys") == "galactic"
    return r.select("request", F.when(far, ra).otherwise(F.col("lon")).alias("ra"), F.when(far, dec).otherwise(F.col("lat")).alias("dec"))


@query(with_("exposures", "solutions", "requests") + CORNERS + SIDES + POINTS + """, near AS (SELECT DISTINCT request, image_id, px, py, pz FROM p JOIN (SELECT DISTINCT image_id, kind, cx, cy, cz FROM corner) c ON kind = 'science' AND abs(asin(pz) - asin(cz)) < 0.03 AND px * cx + py * cy + pz * cz > 0.999)
 SELECT request, image_id, 'footprint' AS how FROM near JOIN side USING (image_id) GROUP BY request, image_id HAVING min(px * sx + py * sy + pz * sz) >= -1e-12
 UNION ALL SELECT request, image_id, 'point' FROM p JOIN (SELECT DISTINCT image_id, kind, cx, cy, cz FROM corner) c ON kind <> 'science' AND abs(pz - cz) < 1e-5 AND power(px - cx, 2) + power(py - cy, 2) + power(pz - cz, 2) <= power(2 * sin(radians(1.0 / 3600) / 2), 2)""")
def f8_frames_at_point(spark, sf):
    """Frames that contain a requested point, given in either system; where only a position is stored, within an arcsec of it."""
    s = table(spark, sf, "solutions")
    stored = _stored(s)
    plain = s.where("kind <> 'science'").select("image_id", F.col("crval1").alias("frame_ra"), F.col("crval2").alias("frame_dec"))
    points = _points(spark, sf)
    inside = footprints.frames_at_points(points, stored).select("request", "image_id", F.lit("footprint").alias("how"))
    return inside.unionByName(footprints.frames_near_points(points, plain).select("request", "image_id", F.lit("point").alias("how")))


@query(with_("exposures", "requests") + POINTS + """, e AS (SELECT image_id, cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z FROM exposures)
 SELECT request, image_id FROM p JOIN e ON abs(pz - z) < 0.02 AND power(px - x, 2) + power(py - y, 2) + power(pz - z, 2) <= power(2 * sin(radians(1.0) / 2), 2)""")
def f8_point_or_cone(spark, sf):
    """Frames of every kind whose stored position lies within a degree of a requested point."""
    frames = table(spark, sf, "exposures").select("image_id", F.col("ra").alias("frame_ra"), F.col("dec").alias("frame_dec"))
    return footprints.frames_near_points(_points(spark, sf), frames, 1.0).select("request", "image_id")


# Areas asked for: quads of 3 by 2 degrees about every tenth request, turned by its number; the corners are in the request's system.
AREA = ((-1.5, -1.0), (1.5, -1.0), (1.5, 1.0), (-1.5, 1.0))
AREAS = POINTS + f""", ask AS (SELECT request, coord_sys, {FRAME.format(a="lon", d="lat")}, k, radians((dx * cos(radians(request)) - dy * sin(radians(request)))) AS xi, radians((dx * sin(radians(request)) + dy * cos(radians(request)))) AS eta FROM requests,
 (VALUES {", ".join(f"({k}, {x}, {y})" for k, (x, y) in enumerate(AREA))}) t(k, dx, dy)),
 asked AS (SELECT request, coord_sys, k, vx / r AS gx, vy / r AS gy, vz / r AS gz FROM (SELECT *, sqrt(vx * vx + vy * vy + vz * vz) AS r FROM (SELECT request, coord_sys, k, {ALONG} FROM ask))),
 av AS MATERIALIZED (SELECT request, k, {", ".join(f"CASE coord_sys WHEN 'galactic' THEN {t} ELSE g{k} END AS a{k}" for k, t in zip("xyz", _TURN, strict=True))} FROM asked)"""
# Two convex cones are apart if a plane through two of their corner rays has them on different sides.
APART = """, pair AS (SELECT DISTINCT p.request, c.image_id FROM p JOIN (SELECT DISTINCT image_id, kind, cx, cy, cz FROM corner) c ON kind = 'science' AND abs(asin(pz) - asin(cz)) < 0.06 AND px * cx + py * cy + pz * cz > 0.998),
 ray AS (SELECT request, image_id, true AS own, k, ax AS x, ay AS y, az AS z FROM pair JOIN av USING (request) UNION ALL SELECT request, image_id, false, k, vx, vy, vz FROM pair JOIN corner USING (image_id)),
 plane AS (SELECT request, image_id, CAST(a.own AS INT) * 4 + a.k AS i, CAST(b.own AS INT) * 4 + b.k AS j, a.y * b.z - a.z * b.y AS nx, a.z * b.x - a.x * b.z AS ny, a.x * b.y - a.y * b.x AS nz FROM ray a JOIN ray b USING (request, image_id) WHERE a.own <> b.own OR a.k <> b.k),
 cut AS (SELECT request, image_id, i, j, max(CASE WHEN own THEN d END) AS amax, min(CASE WHEN NOT own THEN d END) AS bmin FROM (SELECT request, image_id, i, j, own, nx * x + ny * y + nz * z AS d FROM plane JOIN ray USING (request, image_id)) GROUP BY ALL)
 SELECT request, image_id FROM pair WHERE (request, image_id) NOT IN (SELECT (request, image_id) FROM cut WHERE amax <= 1e-15 AND bmin >= -1e-15)"""


@query(with_("exposures", "solutions", "requests") + CORNERS + AREAS + APART)
def f8_frames_in_polygon(spark, sf):
    """Science frames whose footprint meets a requested polygon, given in either system."""
    r = table(spark, sf, "requests")
    corners, turn = [], F.radians("request")
    for dx, dy in AREA:
        lon, lat = sky.tan_deproject(dx * F.cos(turn) - dy * F.sin(turn), dx * F.sin(turn) + dy * F.cos(turn), F.col("lon"), F.col("lat"))
        ra, dec = sky.from_galactic(lon, lat)
        far = F.col("coord_sys") == "galactic"
        corners.append(F.struct(F.when(far, ra).otherwise(lon).alias("ra"), F.when(far, dec).otherwise(lat).alias("dec")))
    asked = durable(footprints.with_footprint(r.select("request", F.array(*corners).alias("corners"))).select("request", "shape"))
    return footprints.frames_meeting(asked, _stored(table(spark, sf, "solutions")))


MOVED = "CASE WHEN pmra IS NULL OR pmdec IS NULL THEN 0e0 ELSE {0} * 8 * pi() / 648000000 END"


@query(with_("ref", "fields", "seen") + CORNERS.replace("solutions", "fields") + SIDES + f""", rp AS (SELECT *, cos(radians(dec)) * cos(radians(ra)) AS px, cos(radians(dec)) * sin(radians(ra)) AS py, sin(radians(dec)) AS pz, {MOVED.format("pmra")} AS e, {MOVED.format("pmdec")} AS n FROM ref),
 flag AS (SELECT image_id, det_id, mag_auto, row_number() OVER w AS k, sum(flags) OVER (PARTITION BY image_id ORDER BY mag_auto, det_id ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) / 15e0 AS m FROM seen WINDOW w AS (PARTITION BY image_id ORDER BY mag_auto, det_id)),
 sat AS (SELECT image_id, coalesce(min(CASE WHEN m < 0.5 THEN k END), 1) - 1 AS plateau FROM flag GROUP BY image_id),
 inq AS (SELECT image_id, source_id, any_value(mag) AS mag FROM rp JOIN side ON px * cx + py * cy + pz * cz > 0.5 GROUP BY image_id, source_id HAVING min(px * sx + py * sy + pz * sz) >= -1e-12),
 tr AS (SELECT image_id, source_id, plateau FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY mag, source_id) AS k FROM inq) JOIN sat USING (image_id) WHERE k <= 100 + plateau),
 td AS (SELECT s.* FROM seen s JOIN flag USING (image_id, det_id) JOIN sat USING (image_id) WHERE k <= 100 + plateau),
 mv AS (SELECT image_id, source_id, plateau, ux / r AS ux, uy / r AS uy, uz / r AS uz FROM (SELECT *, sqrt(ux * ux + uy * uy + uz * uz) AS r FROM (SELECT image_id, source_id, plateau, px - e * sin(radians(ra)) - n * sin(radians(dec)) * cos(radians(ra)) AS ux, py + e * cos(radians(ra)) - n * sin(radians(dec)) * sin(radians(ra)) AS uy, pz + n * cos(radians(dec)) AS uz FROM tr JOIN rp USING (source_id)))),
 dv AS (SELECT *, cos(radians(dec)) * cos(radians(ra)) AS qx, cos(radians(dec)) * sin(radians(ra)) AS qy, sin(radians(dec)) AS qz FROM td),
 j AS (SELECT mv.image_id, source_id, det_id, flags, 2 * asin(sqrt(power(ux - qx, 2) + power(uy - qy, 2) + power(uz - qz, 2)) / 2) * 648000 / pi() AS sep FROM mv JOIN dv ON dv.image_id = mv.image_id AND abs(uz - qz) < 1e-4),
 b AS (SELECT image_id, source_id, arg_min(det_id, (sep, det_id)) AS det_id, arg_min(flags, (sep, det_id)) AS flags, min(sep) AS sep FROM j WHERE sep < 10 GROUP BY image_id, source_id)
 SELECT image_id, source_id, det_id, round(sep, 4) AS separation, CAST(plateau AS BIGINT) AS plateau FROM mv LEFT JOIN b USING (image_id, source_id) WHERE flags = 0 OR det_id IS NULL""")
def a12_evaluation_sample(spark, sf):
    """Saturated end, brightest sources and reference inside the quad, and the match that keeps the reference, image by image."""
    fields = table(spark, sf, "fields")
    quads = durable(fields.select("image_id", wcs.quad(F.col("naxis1"), F.col("naxis2")).alias("corners")))
    shapes = durable(footprints.with_footprint(quads).select("image_id", "shape"))
    got = photometry.evaluation_sample(table(spark, sf, "seen"), table(spark, sf, "ref"), shapes, 10.0, 8.0)
    return got.select("image_id", "source_id", "det_id", F.round("separation", 4).alias("separation"), F.col("plateau").cast("long").alias("plateau"))

"""Survey-shaped tables derived from the supplied ones by integer arithmetic.

Each is one SQL text that Spark and DuckDB read alike (`//` is written `div` for Spark), so an oracle sees the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SQL: dict[str, str] = {
    "ref": """SELECT o_orderkey AS source_id, (o_orderkey * 7919 % 360000) / 1000e0 AS ra, (o_orderkey * 104729 % 120000) / 1000e0 - 60 AS dec,
        11 + (o_orderkey % 900) / 100e0 AS mag, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey % 41 - 20 AS DOUBLE) END AS pmra,
        CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE CAST(o_orderkey % 31 - 15 AS DOUBLE) END AS pmdec, (o_orderkey % 50) / 20e0 AS bp_rp,
        11 + (o_orderkey % 900) / 100e0 + 1e-1 AS mag_g, 0.001e0 * (o_orderkey % 7 + 1) AS mag_err FROM {orders}""",
    "det": """SELECT e.event_id AS det_id, e.user_id AS image_id, r.ra + ((e.event_id % 5 - 2) * 4e-1 / 3600) / cos(radians(r.dec)) AS ra, r.dec + (e.event_id % 7 - 3) * 4e-1 / 3600 AS dec,
        (e.event_id * 37 % 9576) + 5e-1 AS x, (e.event_id * 53 % 6388) + 5e-1 AS y, r.mag - 25 + (e.event_id % 21 - 10) * 1e-2 + CASE WHEN e.event_id % 50 = 0 THEN 15e-1 ELSE 0e0 END AS mag_auto,
        1e-2 + (e.event_id % 13) * 2e-3 AS magerr_auto, CASE WHEN e.event_id % 17 = 0 THEN 1 ELSE 0 END AS flags, (e.event_id % 100) / 100e0 AS class_star, 2 + (e.event_id % 30) / 10e0 AS fwhm,
        (e.event_id % 40) / 100e0 AS ellipticity, CAST(e.event_id % 180 - 90 AS DOUBLE) AS theta, CAST(5 + e.event_id % 200 AS DOUBLE) AS snr, {filt} AS filt
        FROM (SELECT e0.*, (e0.event_id * 13 + 7) % k.n AS sid FROM {events} e0 CROSS JOIN (SELECT {n_orders} AS n) k) e JOIN ({ref}) r ON r.source_id = e.sid""",
    "exposures": """SELECT event_id AS image_id, ts, CAST(ts - INTERVAL 15 HOURS AS DATE) AS nightdate, concat('SU0', CAST(user_id % 5 + 1 AS VARCHAR(2))) AS unit,
        CASE event_id % 8 WHEN 0 THEN 'bias' WHEN 1 THEN 'dark' WHEN 2 THEN 'flat' ELSE 'science' END AS kind, {filt} AS filt, CASE WHEN (event_id // 8) % 2 = 0 THEN 100 ELSE 60 END AS exptime,
        CASE WHEN (event_id // 8) % 11 = 0 THEN 0 ELSE 2750 END AS gain, 1 + (event_id // 16) % 2 AS n_binning, CAST(31000 + user_id % 5 AS VARCHAR(8)) AS camera,
        concat('T', lpad(CAST(user_id % 20 AS VARCHAR(8)), 5, '0')) AS obj, (event_id * 7919 % 360000) / 1000e0 AS ra, (event_id * 104729 % 120000) / 1000e0 - 60 AS dec FROM {events}""",
    "solutions": """SELECT image_id, kind, crval1, crval2, crpix1, crpix2, turn * scale * cos(a) AS cd11, -turn * scale * sin(a) AS cd12, scale * sin(a) AS cd21, scale * cos(a) AS cd22, 9576 AS naxis1, 6388 AS naxis2 FROM
        (SELECT image_id, kind, ra AS crval1, dec AS crval2, 47885e-1 + image_id % 7 AS crpix1, 31945e-1 - image_id % 5 AS crpix2, CASE WHEN image_id % 2 = 0 THEN 1e0 ELSE -1e0 END AS turn, 505e-3 / 3600 AS scale, radians(image_id * 37 % 360) AS a FROM ({exposures}) x) y""",
    "fields": """SELECT image_id, 'science' AS kind, crval1, crval2, 4788e0 AS crpix1, 3194e0 AS crpix2, turn * 15e0 / 3600 * cos(a) AS cd11, -turn * 15e0 / 3600 * sin(a) AS cd12, 15e0 / 3600 * sin(a) AS cd21, 15e0 / 3600 * cos(a) AS cd22, 9576 AS naxis1, 6388 AS naxis2 FROM
        (SELECT image_id, 20e0 + 40 * (image_id // 4) AS crval1, -45e0 + 30 * (image_id % 4) AS crval2, CASE WHEN image_id % 2 = 0 THEN 1e0 ELSE -1e0 END AS turn, radians(image_id * 3) AS a FROM (SELECT DISTINCT event_id % 36 AS image_id FROM {events}) x) y""",
    "seen": """SELECT det_id, CAST(floor((ra + 360) % 360 / 40) * 4 + least(floor((dec + 60) / 30), 3) AS BIGINT) AS image_id, ra, dec, mag_auto, CASE WHEN mag_auto < -13 OR det_id % 17 = 0 THEN 1 ELSE 0 END AS flags FROM ({det}) d""",
    "requests": """SELECT c_custkey AS request, CASE WHEN c_custkey % 4 = 1 THEN 'galactic' ELSE 'radec' END AS coord_sys, (c_custkey * 7919 % 360000) / 1000e0 + CASE WHEN c_custkey % 3 = 0 THEN 0e0 ELSE (c_custkey % 100) / 2e2 END AS lon,
        (c_custkey * 104729 % 120000) / 1000e0 - 60 + CASE WHEN c_custkey % 3 = 0 THEN 0e0 ELSE (c_custkey % 70) / 2e2 END AS lat FROM {customer}""",
    "image_qa": """SELECT o_orderkey AS id, o_custkey AS process_status_id, concat('img', CAST(o_orderkey AS VARCHAR(12))) AS image_name, CASE o_orderkey % 4 WHEN 0 THEN 'bias' WHEN 1 THEN 'dark' WHEN 2 THEN 'flat' ELSE 'science' END AS image_type,
        CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('/data/', CAST(o_orderkey AS VARCHAR(12))) END AS image_path, concat('i', CAST(o_orderkey * 31 AS VARCHAR(16))) AS imageid, CAST(o_orderdate AS DATE) AS nightdate,
        concat('SU0', CAST(o_orderkey % 5 + 1 AS VARCHAR(2))) AS unit, CASE o_orderkey % 5 WHEN 0 THEN 'g' WHEN 1 THEN 'r' WHEN 2 THEN 'i' WHEN 3 THEN 'm525' ELSE 'm650' END AS filt, o_orderkey % 20 AS object, 100 AS exptime,
        CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS sanity, CAST(o_orderkey % 64 AS INT) AS ppflag, CASE WHEN o_orderkey % 97 = 0 THEN 0e0 ELSE 1 + (o_orderkey % 300) / 100e0 END AS seeing,
        (o_orderkey % 60) / 100e0 AS ellipmn, 18 + (o_orderkey % 400) / 100e0 AS ul5_5, CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderkey % 80 AS DOUBLE) END AS skyval FROM {orders}""",
    "process_status": """SELECT c_custkey AS id, concat('cfg', CAST(c_custkey // 2 AS VARCHAR(12))) AS name, CASE c_custkey % 3 WHEN 0 THEN 'preprocess' WHEN 1 THEN 'science' ELSE 'coadd' END AS config_type, DATE '2024-01-01' + CAST(c_custkey % 30 AS INT) AS nightdate,
        CAST(c_custkey % 101 AS INT) AS progress, CASE c_custkey % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'done' ELSE 'running' END AS status, c_custkey % 7 <> 0 AS config_exists FROM {customer}""",
    "edges": """SELECT k AS derived, k // 7 AS source, 'primary' AS role, CASE WHEN k % 17 = 0 THEN NULL WHEN k % 13 = 0 THEN 'old' ELSE concat('i', CAST((k // 7) * 31 AS VARCHAR(16))) END AS source_imageid FROM (SELECT o_orderkey AS k FROM {orders}) a WHERE k > 0
        UNION ALL SELECT k, k // 11, 'secondary', concat('i', CAST((k // 11) * 31 AS VARCHAR(16))) FROM (SELECT o_orderkey AS k FROM {orders}) b WHERE k > 0 AND k % 5 = 0 AND k // 7 <> k // 11""",
    "cyclic_edges": """SELECT derived, source, role, source_imageid FROM ({edges}) e UNION ALL SELECT source, derived, 'back', NULL FROM ({edges}) f WHERE derived % 1001 = 0""",
    "configs": """SELECT 1000000000 + k AS id, concat(CAST(nightdate AS VARCHAR(10)), '_', unit) AS name, 'preprocess' AS config_type, CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN '/home/u/c.yml' ELSE '/cfg/c.yml' END AS config_file, k % 23 <> 0 AS config_exists, nightdate,
        CASE k % 11 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS sanity FROM (SELECT nightdate, unit, min(id) AS k FROM ({image_qa}) q GROUP BY nightdate, unit) g WHERE k % 13 <> 0
        UNION ALL SELECT id, concat('night', CAST(id AS VARCHAR(12))), 'science', CASE WHEN id % 29 = 0 THEN '/home/v.yml' ELSE '/cfg/v.yml' END, config_exists, CASE WHEN id % 4 = 0 THEN NULL ELSE nightdate END, CASE WHEN id % 31 = 0 THEN false END FROM ({process_status}) p WHERE id % 5 <> 0""",
    "config_deps": """SELECT DISTINCT concat('night', CAST(process_status_id AS VARCHAR(12))) AS derived, concat(CAST(nightdate AS VARCHAR(10)), '_', unit) AS source FROM ({image_qa}) q""",
    "pixels": """SELECT event_id % 10 AS frame, (event_id // 10) // 40 AS y, (event_id // 10) % 40 AS x, CASE WHEN event_id % 29 = 0 THEN 0e0 ELSE value END AS v, event_id % 31 = 0 AS bad, 1e0 / (1 + event_id % 7) AS w FROM {events}""",
    "instrument_log": """SELECT concat('SU0', CAST(u AS VARCHAR(2))) AS unit, DATE '2024-01-01' + CAST(7 * k + u AS INT) AS nightdate, 31000 + u * 10 + k AS camera FROM
        (SELECT DISTINCT user_id % 5 + 1 AS u FROM {events}) a CROSS JOIN (SELECT DISTINCT event_id % 4 AS k FROM {events}) b""",
    "headers": """SELECT event_id AS image_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 8 * 10 AS VARCHAR(8)) END AS exptime, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(60000 + event_id % 1000 AS VARCHAR(12)) END AS mjd,
        CAST(2460000 + event_id % 1000 AS VARCHAR(12)) AS jd, event_type AS object, CAST(user_id % 5 AS VARCHAR(4)) AS telescop, user_id % 30 AS stack, CAST(event_id % 64 AS INT) AS ppflag, (event_id % 90) / 30e0 AS seeing,
        1 + (event_id % 10) / 10e0 AS flxscale, CASE WHEN event_id % 500 = 0 THEN NULL ELSE 50000 + event_id % 10000 END AS saturate FROM {events}""",
    "too": """SELECT event_id AS id, concat('T', lpad(CAST(user_id % 20 AS VARCHAR(8)), 5, '0')) AS objname, ts AS trigger_time FROM {events} WHERE event_type = 'signup'""",
}
NESTED = ("ref", "det", "exposures", "edges", "image_qa", "process_status")
"""Fixtures that others are built on."""
FILT = "CASE event_type WHEN 'click' THEN 'g' WHEN 'view' THEN 'r' WHEN 'purchase' THEN 'i' WHEN 'signup' THEN 'm525' ELSE 'm650' END"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def sql(name: str) -> str:
    """The fixture for DuckDB."""
    names = {t: t for t in TABLES} | {"filt": FILT, "n_orders": "(SELECT count(*) FROM orders)"}
    return SQL[name].format(**names, **{n: SQL[n].format(**names, ref=SQL["ref"].format(**names)) for n in NESTED})


def with_(*names: str) -> str:
    """A WITH clause of fixtures, by name."""
    return "WITH " + ", ".join(f"{n} AS ({sql(n)})" for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture as a DataFrame."""
    text = SQL[name]
    for n in NESTED[1:]:
        text = text.replace("{%s}" % n, SQL[n])
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{%s}" % t in text or t in ("orders",)}
    text = text.replace("{filt}", FILT).replace("//", "div")
    if "{n_orders}" in text:
        text = text.replace("{n_orders}", str(read["orders"].count())).replace("{ref}", SQL["ref"])
    return spark.sql(text, **{t: d for t, d in read.items() if "{%s}" % t in text})

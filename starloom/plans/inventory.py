"""Queries: inventory, association, as-of lookups, header aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.fixtures import table, with_
from starloom.functions import text
from starloom.operators import inventory
from starloom.plans.registry import query
from starloom.sources.files import export_table, write_csv
from starloom.storage import new_folder

EX = with_("exposures")
D = "CAST(nightdate AS VARCHAR) AS nightdate"


def _d(c="nightdate"):
    return F.col(c).cast("string").alias(c)


@query(EX + " SELECT image_id, unit FROM exposures WHERE nightdate BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AND unit IN ('SU01', 'SU03') AND filt = 'r' AND kind = 'science' AND obj ILIKE '%0001%' AND exptime BETWEEN 80 AND 120")
def f9_f11_frame_query(spark, sf):
    return inventory.frame_query(table(spark, sf, "exposures"), start="2024-01-05", end="2024-01-12", units=["SU01", "SU03"], filters="r", kinds="science", name_like="0001", exptime=(80, 120)).select("image_id", "unit")


@query(EX + " SELECT image_id, unit FROM exposures WHERE kind = 'science' AND (obj IN ('T00003', 'T00011') OR concat('M', filt) = 'Mg') AND nightdate >= DATE '2024-01-20' - 12 AND image_id % 5 <> 0")
def f9_f11_targets_and_tiles(spark, sf):
    e = table(spark, sf, "exposures").withColumns({"tile": F.col("obj"), "obj": F.concat(F.lit("M"), "filt"), "usable": F.col("image_id") % 5 != 0})
    return inventory.frame_query(e, targets=["T00003", "Mg", "T00011"], tile="tile", days=12, now="2024-01-20", start="2030-01-01", usable=True).select("image_id", "unit")


@query(EX + ", u AS (SELECT DISTINCT unit, 1 AS known FROM exposures WHERE unit <> 'SU05'), f AS (SELECT DISTINCT filt, 'band ' || filt AS band FROM exposures WHERE filt <> 'i') SELECT image_id, unit, band FROM exposures JOIN u USING (unit) LEFT JOIN f USING (filt)")
def j9_star_join(spark, sf):
    e = table(spark, sf, "exposures")
    u = e.where("unit <> 'SU05'").select("unit").distinct()
    f = e.where("filt <> 'i'").select("filt").distinct().withColumn("band", F.concat(F.lit("band "), "filt"))
    return e.join(u, "unit").join(f, "filt", "left").select("image_id", "unit", "band")


@query(EX + " SELECT unit, kind, filt, count(*) AS n, list_sort(list(image_id))[1] AS first, list_sort(list(image_id))[-1] AS last FROM exposures GROUP BY unit, kind, filt")
def a1_groups(spark, sf):
    g = inventory.groups(table(spark, sf, "exposures"), ["unit", "kind", "filt"])
    return g.select("unit", "kind", "filt", "n", F.element_at("files", 1).alias("first"), F.element_at("files", -1).alias("last"))


GROUPS = EX + """, s AS (SELECT DISTINCT nightdate, unit, gain, n_binning, camera, exptime, filt FROM exposures WHERE kind = 'science'),
 b AS (SELECT nightdate, unit, nullif(gain, 0) AS gain, n_binning, camera, count(*) AS n FROM exposures WHERE kind = 'bias' GROUP BY ALL)"""


@query(GROUPS + " SELECT CAST(s.nightdate AS VARCHAR) AS nightdate, s.unit, s.exptime, s.filt, s.n_binning, s.gain, b.n FROM s JOIN b ON s.nightdate = b.nightdate AND s.unit = b.unit AND nullif(s.gain, 0) IS NOT DISTINCT FROM b.gain AND s.n_binning = b.n_binning AND s.camera = b.camera")
def j10_calibration_association(spark, sf):
    e = table(spark, sf, "exposures").withColumn("gain", F.nullif(F.col("gain"), F.lit(0)))
    keys = inventory.KEYS["bias"]
    s = e.where("kind = 'science'").select(*keys, "exptime", "filt").distinct().withColumn("group", F.struct(*keys, "exptime", "filt"))
    b = e.where("kind = 'bias'").groupBy(*keys).agg(F.count("*").alias("n")).withColumn("group", F.struct("n"))
    j = inventory.associate(s, b, "bias")
    return j.select(F.col("science.nightdate").cast("string").alias("nightdate"), "science.unit", "science.exptime", "science.filt", "science.n_binning", F.coalesce("science.gain", F.lit(0)).alias("gain"), "calib.n")


def _alike(keys, left="s", right="c"):
    return " AND ".join(f"{left}.{k} IS NOT DISTINCT FROM {right}.{k}" for k in keys)


def _calib_sql(kind):
    k = ", ".join(inventory.KEYS[kind])
    return f"(SELECT {k}, count(*) AS n FROM exposures WHERE kind = '{kind}' GROUP BY {k})"


@query(EX + f" SELECT CAST(c.nightdate AS VARCHAR) AS nightdate, c.unit, c.exptime, c.gain, c.n_binning, c.n FROM {_calib_sql('dark')} c WHERE NOT EXISTS (SELECT 1 FROM exposures s WHERE s.kind = 'science' AND {_alike(inventory.KEYS['dark'])})")
def j11_unused_calibration(spark, sf):
    e, keys = table(spark, sf, "exposures"), inventory.KEYS["dark"]
    s = e.where("kind = 'science'").select(*keys).distinct()
    d = e.where("kind = 'dark'").groupBy(*keys).agg(F.count("*").alias("n"))
    return d.join(s, keys, "left_anti").select(_d(), "unit", "exptime", "gain", "n_binning", "n")


PLAN_KEYS = ["nightdate", "unit", "gain", "n_binning", "camera", "exptime", "filt"]


def _plan_sql():
    """Science groups with the sizes of their calibration groups, then the large calibration groups without science."""
    n = ", ".join(f"CASE WHEN {k}.n >= 5 THEN {k}.n ELSE 0 END AS n_{k}" for k in inventory.KEYS)
    joins = " ".join(f"LEFT JOIN {_calib_sql(k)} {k} ON {_alike(keys, 's', k)}" for k, keys in inventory.KEYS.items())
    alone = " UNION ALL ".join(
        "SELECT " + ", ".join(f"c.{k}" if k in keys else f"NULL AS {k}" for k in PLAN_KEYS) + f", 0 AS n_sci, '{kind}' AS lone, " + ", ".join("c.n" if k == kind else "0" for k in inventory.KEYS)
        + f" FROM {_calib_sql(kind)} c WHERE c.n >= 5 AND NOT EXISTS (SELECT 1 FROM exposures s WHERE s.kind = 'science' AND {_alike(keys)})" for kind, keys in inventory.KEYS.items())
    order = ", ".join(f"{k} NULLS FIRST" for k in ["lone", *PLAN_KEYS])
    return f"""{EX}, g AS (SELECT {', '.join(PLAN_KEYS)}, count(*) AS n_sci FROM exposures WHERE kind = 'science' GROUP BY ALL), p AS (SELECT {', '.join('s.' + k for k in PLAN_KEYS)}, s.n_sci, NULL AS lone, {n} FROM g s {joins} UNION ALL {alone})
     SELECT * REPLACE (CAST(nightdate AS VARCHAR) AS nightdate), row_number() OVER (ORDER BY lone IS NOT NULL, n_sci DESC, {order}) AS place FROM p"""


@query(_plan_sql())
def a2_preprocess_plan(spark, sf):
    return inventory.preprocess_plan(table(spark, sf, "exposures")).withColumn("nightdate", F.col("nightdate").cast("string"))


@query(EX + " SELECT obj, filt, count(DISTINCT unit) AS units, count(*) AS n, count(DISTINCT unit) > 1 AS multi, row_number() OVER (ORDER BY count(DISTINCT unit) DESC, count(*) DESC, obj, filt) AS place FROM exposures WHERE kind = 'science' GROUP BY obj, filt")
def a3_science_groups(spark, sf):
    return inventory.science_groups(table(spark, sf, "exposures"), ["obj", "filt"])


@query(EX + " SELECT CAST(nightdate AS VARCHAR) AS nightdate, count(*) AS n FROM exposures WHERE unit = 'SU02' GROUP BY nightdate")
def a25_nights(spark, sf):
    return inventory.frame_query(table(spark, sf, "exposures"), units="SU02").groupBy("nightdate").agg(F.count("*").alias("n")).select(_d(), "n")


LOG = with_("instrument_log", "exposures")


@query(LOG + " SELECT unit, CAST(nightdate AS VARCHAR) AS nightdate, CAST(lead(nightdate) OVER (PARTITION BY unit ORDER BY nightdate) - 1 AS VARCHAR) AS until FROM instrument_log")
def j14_validity(spark, sf):
    v = inventory.validity(table(spark, sf, "instrument_log"), ["unit"])
    return v.select("unit", _d(), _d("until"))


@query(LOG + " SELECT image_id, coalesce((SELECT arg_max(l.camera, l.nightdate) FROM instrument_log l WHERE l.unit = e.unit AND l.nightdate <= e.nightdate), 30000 + CAST(right(e.unit, 2) AS INT)) AS camera FROM exposures e")
def j15_camera_as_of(spark, sf):
    e = table(spark, sf, "exposures").select("image_id", "unit", "nightdate")
    found = inventory.as_of(e, table(spark, sf, "instrument_log"), ["unit"], "nightdate", "nightdate", "camera", 30000 + F.right("unit", F.lit(2)).cast("long"))
    return found.select("image_id", "camera")


MASTERS = EX + """, m AS (SELECT image_id AS master, unit, filt, n_binning, nightdate, exptime + (image_id % 7) AS exptime, image_id % 3 <> 0 AS sane, image_id % 4 = 0 AS lenient FROM exposures WHERE kind = 'flat'),
 d AS (SELECT unit, filt, n_binning, lenient, nightdate, min(exptime) AS exptime, arg_min(master, (exptime, master)) AS master, arg_min(sane, (exptime, master)) AS sane FROM m GROUP BY unit, filt, n_binning, lenient, nightdate),
 q AS (SELECT image_id AS req, unit, filt, n_binning, nightdate, DATE '2024-01-08' AS wall_from FROM exposures WHERE kind = 'science')"""


def _masters(spark, sf):
    e = table(spark, sf, "exposures")
    m = e.where("kind = 'flat'").select(F.col("image_id").alias("master"), "unit", "filt", "n_binning", "nightdate", (F.col("exptime") + F.col("image_id") % 7).alias("exptime"), (F.col("image_id") % 3 != 0).alias("sane"), (F.col("image_id") % 4 == 0).alias("lenient"))
    q = e.where("kind = 'science'").select(F.col("image_id").alias("req"), "unit", "filt", "n_binning", "nightdate", F.lit("2024-01-08").cast("date").alias("wall_from"), F.lit(None).cast("date").alias("wall_to"))
    return m, q


@query(MASTERS + """, j AS (SELECT req, d.master, d.nightdate - q.nightdate AS days, d.nightdate < wall_from AS wall, lenient, NOT sane AS insane, d.n_binning <> q.n_binning AS bin FROM q JOIN d USING (unit, filt) WHERE d.nightdate - q.nightdate BETWEEN -30 AND 30),
 r AS (SELECT *, row_number() OVER (PARTITION BY req ORDER BY wall, lenient, insane, bin, abs(days), days > 0, master) AS k FROM j)
 SELECT req, master, CAST(days AS INT) AS days, CASE WHEN days <> 0 THEN 1 ELSE 0 END + CASE WHEN insane THEN 4 ELSE 0 END + CASE WHEN lenient THEN 8 ELSE 0 END + CASE WHEN wall THEN 16 ELSE 0 END AS ppflag FROM r WHERE k = 1""")
def j12_j13_relaxed_master_search(spark, sf):
    m, q = _masters(spark, sf)
    return inventory.relaxed_search(q, m, 30, future=True)


@query(MASTERS + ", j AS (SELECT req, master, abs(d.nightdate - q.nightdate) AS far, d.exptime FROM q JOIN d USING (unit, filt)), n AS (SELECT req, min((far, exptime, master)) AS b FROM j GROUP BY req) SELECT req, coalesce(CASE WHEN req % 40 = 4 THEN -1 END, b[3]) AS flatdark FROM q LEFT JOIN n USING (req)")
def j26_flatdark_choice(spark, sf):
    m, q = _masters(spark, sf)
    near = inventory.nearest_night(q, m.select("unit", "filt", "nightdate", F.struct("exptime", "master").alias("choice")), ["unit", "filt"], "choice")
    return near.select("req", F.coalesce(F.when(F.col("req") % 40 == 4, -1), F.col("choice.master")).alias("flatdark"))


TOO = with_("too", "exposures")


REQUESTS = TOO + """, rq AS (SELECT id, trigger_time, CASE WHEN id % 3 = 0 THEN objname END AS tile, CASE WHEN id % 3 = 1 THEN 'Mg' WHEN id % 6 = 2 THEN 'Mr' END AS name FROM too), ob AS (SELECT image_id, ts, obj AS tile, concat('M', filt) AS name FROM exposures)"""
BY = "{0} AS (SELECT image_id, arg_max(rq.id, (CAST(trigger_time AS DATE) = CAST(ts AS DATE), trigger_time, rq.id)) AS id FROM ob JOIN rq ON rq.{1} = ob.{1} WHERE CAST(trigger_time AS DATE) = CAST(ts AS DATE) OR trigger_time <= ts GROUP BY image_id)"


@query(REQUESTS + f", {BY.format('a', 'tile')}, {BY.format('b', 'name')}, c AS (SELECT image_id, t.id FROM ob ASOF JOIN (SELECT trigger_time, max(id) AS id FROM rq GROUP BY 1) t ON ob.ts >= t.trigger_time) SELECT image_id, coalesce(a.id, b.id, c.id) AS too_id FROM ob LEFT JOIN a USING (image_id) LEFT JOIN b USING (image_id) LEFT JOIN c USING (image_id) WHERE coalesce(a.id, b.id, c.id) IS NOT NULL")
def j16_too_as_of(spark, sf):
    t = table(spark, sf, "too").withColumns({"tile": F.when(F.col("id") % 3 == 0, F.col("objname")), "name": F.when(F.col("id") % 3 == 1, "Mg").when(F.col("id") % 6 == 2, "Mr")})
    o = table(spark, sf, "exposures").select("image_id", "ts", F.col("obj").alias("tile"), F.concat(F.lit("M"), "filt").alias("name"))
    return inventory.too_match(o, t, {"tile": "tile", "name": "name"}, anyone=True)


@query(TOO + " SELECT id, EXISTS (SELECT 1 FROM exposures e WHERE e.obj = too.objname AND e.kind = 'science' AND CAST(e.ts AS DATE) = CAST(trigger_time AS DATE)) AS observed FROM too")
def j24_too_observed(spark, sf):
    e = table(spark, sf, "exposures").where("kind = 'science'").select(F.col("obj").alias("objname"), F.to_date("ts").alias("day"), F.lit(True).alias("hit")).distinct()
    return table(spark, sf, "too").withColumn("day", F.to_date("trigger_time")).join(e, ["objname", "day"], "left").select("id", F.coalesce("hit", F.lit(False)).alias("observed"))


COADDS = ", s AS (SELECT DISTINCT obj, filt, nightdate FROM exposures WHERE kind = 'science'), c AS (SELECT obj, filt, nightdate, CASE WHEN image_id % 3 = 0 THEN 'too' ELSE 'processed' END AS base, concat('/', image_id, '.fits') AS path FROM exposures WHERE kind = 'science' AND image_id % 2 = 0)"


@query(EX + COADDS + """, f AS (SELECT a.obj, a.filt, a.nightdate, arg_max(b.nightdate, (abs(b.nightdate - a.nightdate), b.nightdate)) AS farthest FROM s a JOIN s b ON a.obj = b.obj AND a.filt = b.filt AND a.nightdate <> b.nightdate GROUP BY ALL),
 h AS (SELECT obj, filt, nightdate, base, string_agg(path, ',' ORDER BY path) AS paths FROM c GROUP BY ALL), r AS (SELECT f.*, h.nightdate AS ref_night, h.base, h.paths, row_number() OVER (PARTITION BY f.obj, f.filt, f.nightdate ORDER BY h.nightdate, h.base) AS k FROM f LEFT JOIN h ON h.obj = f.obj AND h.filt = f.filt AND h.nightdate - f.farthest BETWEEN -3 AND 2 AND h.nightdate <> f.nightdate)
 SELECT obj, filt, CAST(nightdate AS VARCHAR) AS nightdate, CAST(farthest AS VARCHAR) AS farthest, CAST(ref_night AS VARCHAR) AS ref_night, base, paths FROM r WHERE k = 1""")
def j23_reference_image(spark, sf):
    """The farthest other night of an object and filter, and the coadds of the first night about it that has any."""
    e = table(spark, sf, "exposures").where("kind = 'science'")
    c = e.where("image_id % 2 = 0").select("obj", "filt", "nightdate", F.when(F.col("image_id") % 3 == 0, "too").otherwise("processed").alias("base"), F.concat(F.lit("/"), "image_id", F.lit(".fits")).alias("path"))
    r = inventory.reference_image(e, c)
    return r.select("obj", "filt", _d(), _d("farthest"), _d("ref_night"), "base", F.array_join("paths", ",").alias("paths"))


FRAMES = ", f AS (SELECT concat('/d/', image_id, '.fits') AS path, image_id AS name, image_id AS pos FROM exposures UNION ALL SELECT concat('/e/', image_id, '.fits'), -image_id, image_id + 1000000 FROM exposures WHERE kind = 'bias' UNION ALL SELECT concat('/d/', image_id, '.fits'), image_id + 5, image_id - 1000000 FROM exposures WHERE kind = 'flat')"


def _frames(spark, sf):
    e = table(spark, sf, "exposures")
    part = lambda rows, folder, name, pos: rows.select(F.concat(F.lit(folder), "image_id", F.lit(".fits")).alias("path"), name.alias("name"), pos.alias("pos"))
    i = F.col("image_id")
    return part(e, "/d/", i, i).unionByName(part(e.where("kind = 'bias'"), "/e/", -i, i + 1_000_000)).unionByName(part(e.where("kind = 'flat'"), "/d/", i + 5, i - 1_000_000))


@query(EX + FRAMES + ", w AS (SELECT event_id AS pos, CASE WHEN event_id % 3 = 0 THEN concat('/x/', event_id, '.gone') WHEN event_id % 7 = 0 THEN concat(event_id, '.fits') ELSE concat('/y/', event_id, '.fits') END AS path FROM events), l AS (SELECT split_part(path, '/', 3) AS base, arg_max(name, pos) AS name FROM f GROUP BY 1) SELECT pos, name FROM w LEFT JOIN l ON base = split_part(path, '/', -1)")
def j25_names_of_paths(spark, sf):
    """One of the paths has no folder, so all are looked up by file name."""
    i = F.col("event_id")
    path = F.when(i % 3 == 0, F.concat(F.lit("/x/"), i, F.lit(".gone"))).when(i % 7 == 0, F.concat(i, F.lit(".fits"))).otherwise(F.concat(F.lit("/y/"), i, F.lit(".fits")))
    w = spark.read.parquet(f"{sf}/events.parquet").select(i.alias("pos"), path.alias("path"))
    return inventory.names_of_paths(w, _frames(spark, sf)).select("pos", "name")


@query(EX + FRAMES + ", w AS (SELECT event_id AS pos, CASE WHEN event_id % 3 = 0 THEN concat('/e/', event_id, '.fits') ELSE concat('/d/', event_id, '.fits') END AS path FROM events), l AS (SELECT path, arg_max(name, pos) AS name FROM f GROUP BY 1) SELECT pos, name FROM w LEFT JOIN l USING (path)")
def j25_names_of_whole_paths(spark, sf):
    """All paths have a folder, so they must agree as they are."""
    i = F.col("event_id")
    w = spark.read.parquet(f"{sf}/events.parquet").select(i.alias("pos"), F.concat(F.when(i % 3 == 0, "/e/").otherwise("/d/"), i, F.lit(".fits")).alias("path"))
    return inventory.names_of_paths(w, _frames(spark, sf)).select("pos", "name")


@query(with_("headers") + """ SELECT stack, CASE WHEN count(DISTINCT exptime) = 1 THEN min(exptime) WHEN count(exptime) = count(*) THEN 'MIXED' END AS exptime, CASE WHEN count(DISTINCT seeing) = 1 THEN printf('%.4f', min(seeing)) ELSE printf('%.4f', avg(seeing)) END AS seeing,
 CASE WHEN count(DISTINCT object) = 1 THEN min(object) ELSE 'MIXED' END AS object FROM headers GROUP BY stack""")
def a4_header_aggregate(spark, sf):
    h = inventory.header_aggregate(table(spark, sf, "headers"), ["stack"], ["exptime", "seeing", "object"], "image_id")
    return h.withColumn("seeing", F.format_string("%.4f", F.col("seeing").cast("double")))


@query(with_("headers") + """ SELECT stack, sum(CAST(exptime AS BIGINT)) AS exptime, round(avg(coalesce(CAST(mjd AS DOUBLE), CAST(jd AS DOUBLE) - 2400000.5)), 6) AS mjd, CASE WHEN count(saturate) = count(*) THEN round(min(saturate * flxscale), 6) END AS saturate, round(sum(2.5e0 / flxscale), 6) AS egain,
 bit_or(ppflag) AS ppflag, max(seeing) AS worst, CASE WHEN length(string_agg(DISTINCT telescop, ',' ORDER BY telescop)) > 68 THEN 'long' ELSE string_agg(DISTINCT telescop, ',' ORDER BY telescop) END AS units FROM headers GROUP BY stack""")
def a5_coadd_header(spark, sf):
    h = table(spark, sf, "headers")
    mjd = text.mjd_or_fallback(F.col("mjd").cast("double"), F.lit(None).cast("double"), F.col("jd").cast("double"), F.lit(None).cast("timestamp"))
    units = F.array_join(F.sort_array(F.collect_set("telescop")), ",")
    sat = F.when(F.count("saturate") == F.count("*"), F.round(F.min(F.col("saturate") * F.col("flxscale")), 6))
    return h.groupBy("stack").agg(F.sum(F.col("exptime").cast("long")).alias("exptime"), F.round(F.avg(mjd), 6).alias("mjd"), sat.alias("saturate"), F.round(F.sum(2.5 / F.col("flxscale")), 6).alias("egain"), F.bit_or("ppflag").alias("ppflag"), F.max("seeing").alias("worst"), F.when(F.length(units) > 68, F.concat(F.substring(units, 1, 65), F.lit("..."))).otherwise(units).alias("units"))


@query(EX + " SELECT CAST(nightdate AS VARCHAR) AS nightdate, left(CAST(make_timestamp(CAST(floor(avg(epoch_us(ts))) AS BIGINT)) AS VARCHAR), 19) AS mean_time FROM exposures GROUP BY nightdate")
def a28_mean_time(spark, sf):
    m = table(spark, sf, "exposures").groupBy("nightdate").agg(F.floor(F.avg(F.unix_micros(F.col("ts").cast("timestamp")))).alias("us"))
    return m.select(_d(), F.substring(F.timestamp_micros("us").cast("string"), 1, 19).alias("mean_time"))


@query(EX + " SELECT min(strftime(ts, '%Y%m%d_%H%M%S')) AS first, arg_min(image_id, (exptime, image_id)) AS shortest, obj FROM exposures GROUP BY obj")
def k4_first_time(spark, sf):
    return table(spark, sf, "exposures").groupBy("obj").agg(F.min(text.compact_time(F.col("ts"))).alias("first"), F.min_by("image_id", F.struct("exptime", "image_id")).alias("shortest"))


QA = with_("image_qa")


@query(QA + " SELECT id, image_name, CAST(nightdate AS VARCHAR) AS nightdate, unit, CASE WHEN id % 3 = 0 THEN 'a \"quoted\", word' END AS note FROM image_qa WHERE unit IN ('SU02', 'SU03') AND nightdate <= DATE '1997-12-31' ORDER BY nightdate DESC, id LIMIT 10000")
def s9_export_to_csv(spark, sf):
    """An export with its default limit, written as CSV and read back."""
    q = table(spark, sf, "image_qa").withColumn("note", F.when(F.col("id") % 3 == 0, 'a "quoted", word').when(F.col("id") % 3 == 2, ""))
    path = new_folder(spark)
    rows = export_table(q, [F.desc("nightdate"), F.col("id")], nightdate=(None, "1997-12-31"), unit=["SU02", "SU03"], filt=None)
    write_csv(rows.select("id", "image_name", _d(), "unit", "note"), path)
    return spark.read.option("header", True).option("escape", '"').schema("id long, image_name string, nightdate string, unit string, note string").csv(path)


@query(QA + " SELECT id, image_name, CAST(nightdate AS VARCHAR) AS nightdate FROM image_qa WHERE unit = 'SU02' AND filt IN ('g', 'r') AND nightdate >= DATE '1996-01-01' ORDER BY image_name LIMIT 500")
def s9_table_export(spark, sf):
    q = table(spark, sf, "image_qa").where((F.col("unit") == "SU02") & F.col("filt").isin("g", "r") & (F.col("nightdate") >= F.lit("1996-01-01").cast("date")))
    return q.select("id", "image_name", _d()).orderBy("image_name").limit(500)


@query(QA + ", n AS (SELECT id, CASE WHEN id % 4 = 0 THEN NULL ELSE 9e0 END AS seeing, CASE WHEN id % 8 = 1 THEN 'None' WHEN id % 8 = 2 THEN NULL ELSE 'new' END AS unit FROM image_qa WHERE id % 3 = 0 UNION ALL SELECT id + 1000000, 1e0, 'x' FROM image_qa WHERE id < 50) SELECT coalesce(q.id, n.id) AS id, coalesce(n.seeing, q.seeing) AS seeing, nullif(coalesce(n.unit, q.unit), 'None') AS unit FROM image_qa q FULL JOIN n ON q.id = n.id")
def s8_upsert(spark, sf):
    q = table(spark, sf, "image_qa").select("id", "seeing", "unit").withColumn("ver", F.lit(0))
    n = q.where("id % 3 = 0").select("id", F.when(F.col("id") % 4 != 0, 9.0).alias("seeing"), F.when(F.col("id") % 8 == 1, "None").when(F.col("id") % 8 != 2, "new").alias("unit"), F.lit(1).alias("ver"))
    extra = q.where("id < 50").select((F.col("id") + 1_000_000).alias("id"), F.lit(1.0).alias("seeing"), F.lit("x").alias("unit"), F.lit(2).alias("ver"))
    return inventory.upsert(q, n.unionByName(extra), "id", "ver").drop("ver")


@query(QA + """, o AS (SELECT id, image_name, image_path, seeing FROM image_qa), top AS (SELECT max(id) AS t FROM o),
 n AS (SELECT id, CASE WHEN id % 9 = 0 THEN concat('/new/', id) ELSE image_path END AS p, CASE WHEN id % 9 = 0 THEN 8e0 WHEN id % 4 = 1 THEN 9e0 WHEN id % 6 = 2 THEN 7e0 ELSE seeing END AS s FROM o)
 SELECT id, concat('img', CAST(id AS VARCHAR)) AS image_name, p AS image_path, s AS seeing FROM n
 UNION ALL SELECT t + row_number() OVER (ORDER BY id), image_name, concat('/else/', id), 6e0 FROM o, top WHERE id % 10 = 3 AND image_path IS NOT NULL""")
def s8_upsert_by_path(spark, sf):
    q = table(spark, sf, "image_qa").select("id", "image_name", "image_path", "seeing").withColumn("ver", F.lit(-1).cast("long"))
    gone = F.lit(None).cast("string")
    known = q.where("id % 4 = 1 AND image_path IS NOT NULL").select("image_name", "image_path", F.lit(9.0).alias("seeing"), F.col("id").alias("ver"))
    bare = q.where("id % 9 = 0").select("image_name", F.concat(F.lit("/new/"), "id").alias("image_path"), F.lit(8.0).alias("seeing"), F.col("id").alias("ver"))
    pathless = q.where("id % 6 = 2 AND id % 9 <> 0").select("image_name", gone.alias("image_path"), F.lit(7.0).alias("seeing"), F.col("id").alias("ver"))
    moved = q.where("id % 10 = 3 AND image_path IS NOT NULL").select("image_name", F.concat(F.lit("/else/"), "id").alias("image_path"), F.lit(6.0).alias("seeing"), F.col("id").alias("ver"))
    new = known.unionByName(bare).unionByName(pathless).unionByName(moved)
    return inventory.upsert_by_path(q, new, "ver").drop("ver")


@query(QA + " SELECT id, coalesce(skyval, CASE WHEN id % 2 = 0 THEN 7e0 END) AS skyval FROM image_qa")
def s13_backfill(spark, sf):
    q = table(spark, sf, "image_qa").select("id", "skyval")
    return inventory.backfill(q, q.where("id % 2 = 0").select("id", F.lit(7.0).alias("skyval")), "id", "skyval")


@query("SELECT name, n FROM (SELECT regexp_extract(line, '^ERR (\\S+)', 1) AS name, count(*) AS n FROM (SELECT CASE WHEN event_id % 9 = 0 THEN concat('ERR f', user_id, ' bad') ELSE 'ok' END AS line FROM events) WHERE starts_with(line, 'ERR ') GROUP BY 1)")
def s14_log_scan(spark, sf):
    from starloom.sources.files import error_names

    e = spark.read.parquet(f"{sf}/events.parquet")
    lines = e.select(F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("ERR f"), "user_id", F.lit(" bad"))).otherwise("ok").alias("value"), F.col("event_id").alias("pos"))
    return error_names(lines, "ERR ").select("name", "n")


@query(with_("headers") + " SELECT image_id, coalesce(CAST(exptime AS DOUBLE), 60) AS exptime, CASE WHEN mjd IS NULL THEN CAST(jd AS DOUBLE) - 2400000.5 ELSE CAST(mjd AS DOUBLE) END AS mjd, coalesce(saturate, 60000) AS saturate, round(1 / (1 - seeing / 10), 6) AS elong, 0.505e0 * (1 + image_id % 2) AS pixscale FROM headers")
def s15_typed_header(spark, sf):
    from starloom.sources.files import typed_header

    h = table(spark, sf, "headers")
    cards = F.map_filter(F.create_map(*[x for k, c in (("EXPTIME", "exptime"), ("MJD", "mjd"), ("JD", "jd"), ("SATURATE", "saturate")) for x in (F.lit(k), F.col(c).cast("string"))], F.lit("ELLIP"), (F.col("seeing") / 10).cast("string"), F.lit("XBINNING"), (1 + F.col("image_id") % 2).cast("string")), lambda k, v: v.isNotNull())
    t = typed_header(h.select("image_id", cards.alias("headers")))
    return t.select("image_id", "exptime", "mjd", "saturate", F.round("elong", 6).alias("elong"), "pixscale")

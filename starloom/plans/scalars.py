"""Queries: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.fixtures import table, with_
from starloom.functions import text
from starloom.operators.stats import exact_quantiles, join_stats
from starloom.plans.registry import query

NAMES = """, n AS (SELECT image_id, ts, obj, filt, unit, n_binning, exptime, concat(unit, '_', strftime(ts, '%Y%m%d_%H%M%S'), '_', obj, '_x_', filt, '_', n_binning, 'x', n_binning, '_', exptime, 's.fits') AS name FROM exposures)"""


def _named(spark, sf):
    e = table(spark, sf, "exposures")
    return e.withColumn("name", F.concat(text.raw_name(F.col("unit"), F.col("ts"), F.concat("obj", F.lit("_x")), F.col("filt"), F.col("n_binning"), F.col("exptime")), F.lit(".fits")))


@query(with_("exposures") + " SELECT image_id, CAST(nightdate AS VARCHAR) AS nightdate, CAST(nightdate + 1 AS VARCHAR) AS master_date, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, round(epoch_us(ts) / 86400000000.0 + 40587, 6) AS mjd, strftime(ts + INTERVAL 3 HOURS, '%Y%m%d_%H%M%S') AS utc FROM exposures")
def e8_dates(spark, sf):
    e = table(spark, sf, "exposures")
    return e.select("image_id", text.nightdate(F.col("ts")).cast("string").alias("nightdate"), text.master_date(F.col("nightdate")).cast("string").alias("master_date"), text.compact_time(F.col("ts")).alias("stamp"), F.round(text.mjd(F.col("ts")), 6).alias("mjd"), text.compact_time(text.local_to_utc(F.col("ts"), "-03:00")).alias("utc"))


@query(with_("exposures") + NAMES + " SELECT image_id, name, concat(obj, '_', filt, '_', unit, '_', strftime(ts, '%Y%m%d_%H%M%S'), '_', exptime, 's') AS processed FROM n")
def e9_names(spark, sf):
    return _named(spark, sf).select("image_id", "name", text.processed_name(F.col("obj"), F.col("filt"), F.col("unit"), F.col("ts"), F.col("exptime")).alias("processed"))


@query(with_("exposures") + NAMES + " SELECT image_id, unit, strftime(ts, '%Y%m%d_%H%M%S') AS ts, concat(obj, '_x') AS obj, filt, n_binning AS binning, exptime FROM n")
def f14_parse_names(spark, sf):
    return _named(spark, sf).select("image_id", *[(text.compact_time(c) if k == "ts" else c).alias(k) for k, c in text.parse_raw(F.col("name")).items()])


@query(with_("exposures") + """ SELECT image_id, CASE WHEN image_id % 3 = 0 THEN 'raw' WHEN kind <> 'science' AND image_id % 3 = 1 THEN 'master' ELSE 'calibrated' END AS stage, kind, CASE WHEN image_id % 3 = 2 THEN 'coadded' ELSE 'single' END AS stack, false AS difference, 'image' AS product FROM exposures""")
def f14_type_tuple(spark, sf):
    e = table(spark, sf, "exposures")
    kind = F.when(F.col("kind") == "science", "obj").otherwise(F.col("kind"))
    name = F.when(F.col("image_id") % 3 == 0, F.concat(F.lit("SU01_"), kind, F.lit(".fits"))).when(F.col("image_id") % 3 == 1, F.concat(kind, F.lit("_20240101.fits"))).otherwise(F.concat(F.lit("x_"), kind, F.lit("_coadd.fits")))
    return e.select("image_id", *[c.alias(k) for k, c in text.type_tuple(name).items()])


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'date' WHEN 1 THEN 'unit' WHEN 2 THEN 'filter' WHEN 3 THEN 'type' ELSE 'target' END AS kind FROM events""")
def f10_parameters(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    p = F.element_at(F.array(*map(F.lit, ["2024-01-02", "SU07", "m525", "Sci", "T00012", "SU21"])), (F.col("event_id") % 6 + 1).cast("int"))
    return e.select("event_id", text.classify_parameter(p).alias("kind"))


@query(with_("exposures") + " SELECT image_id, image_id % 2 = 0 AS is_tile, CASE WHEN image_id % 5 = 0 THEN NULL ELSE obj END AS tile FROM exposures")
def f15_tiles(spark, sf):
    e = table(spark, sf, "exposures")
    name = F.when(F.col("image_id") % 2 == 0, F.concat("obj", F.lit("_g"))).otherwise(F.concat(F.lit("x_"), "obj"))
    gone = F.when(F.col("image_id") % 5 == 0, F.lit("T12")).otherwise(name)
    return e.select("image_id", text.is_tile(name).alias("is_tile"), text.find_tile(gone).alias("tile"))


@query("SELECT event_id, round((event_id % 24 + 30 / 60.0 + 18 / 3600.0) * 15, 6) AS ra, round(-(event_id % 90 + 15 / 60.0), 6) AS dec, round(event_id % 360 + 0.25, 6) AS plain FROM events")
def e7_angles(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    ra, dec, plain = F.concat((F.col("event_id") % 24).cast("string"), F.lit(":30:18")), F.concat(F.lit("-"), (F.col("event_id") % 90).cast("string"), F.lit(" 15 0")), F.concat((F.col("event_id") % 360).cast("string"), F.lit(".25"))
    return e.select("event_id", F.round(text.angle(ra, True), 6).alias("ra"), F.round(text.angle(dec), 6).alias("dec"), F.round(text.angle(plain, True), 6).alias("plain"))


@query("SELECT event_id, concat('b', user_id, CASE WHEN event_id % 3 = 0 THEN '_ToO' ELSE '' END) AS key, concat('b', user_id) AS family FROM events")
def e10_batch_keys(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    path = F.concat(F.lit("b"), "user_id", F.when(F.col("event_id") % 3 == 0, "_ToO").otherwise(""), F.lit("_20240102_030405"), F.when(F.col("event_id") % 2 == 0, ".tar").otherwise(""))
    return e.select("event_id", text.batch_key(path).alias("key"), text.batch_family(text.batch_key(path)).alias("family"))


@query(with_("exposures") + " SELECT CAST(nightdate AS VARCHAR) AS nightdate, CASE WHEN count(DISTINCT unit) = 1 THEN min(unit) END AS unit, min(unit) AS forced FROM exposures GROUP BY nightdate")
def e11_collapse(spark, sf):
    u = table(spark, sf, "exposures").groupBy("nightdate").agg(F.sort_array(F.collect_set("unit")).alias("u"))
    return u.select(F.col("nightdate").cast("string").alias("nightdate"), text.collapse(F.col("u")).alias("unit"), text.collapse(F.col("u"), True).alias("forced"))


@query(with_("image_qa") + " SELECT id, lpad(bin(ppflag), 6, '0') AS spec, (ppflag & 4) <> 0 AS bad, (ppflag & ~9) = 0 AS allowed, ppflag | 16 AS walled FROM image_qa")
def e12_flags(spark, sf):
    p = F.col("ppflag")
    return table(spark, sf, "image_qa").select("id", text.flag_spec(p).alias("spec"), (p.bitwiseAND(F.lit(4)) != 0).alias("bad"), (p.bitwiseAND(F.lit(~9)) == 0).alias("allowed"), p.bitwiseOR(F.lit(16)).alias("walled"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 2 END AS n, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS first, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def e13_json(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    doc = F.when(F.col("event_id") % 3 == 0, F.lit("[broken")).otherwise(F.concat(F.lit('["'), "event_type", F.lit('", "x"]')))
    items = text.json_list(doc)
    return e.select("event_id", F.when(items.isNotNull(), F.size(items)).alias("n"), F.try_element_at(items, F.lit(1)).alias("first"), F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query(with_("ref") + """ SELECT source_id, coalesce(pmra, 0) AS pmra, coalesce(pmdec, 0) AS pmdec, round(230 * mag_err + 0.1, 6) AS pm_err, round(mag_err * cos(radians(dec)), 8) AS ra_err, pmra IS NULL OR pmdec IS NULL AS touched FROM ref WHERE bp_rp > 0""")
def e14_clean_reference(spark, sf):
    from starloom.sources.catalogs import clean_reference

    ref = table(spark, sf, "ref").withColumn("bp_rp", F.when(F.col("bp_rp") > 0, F.col("bp_rp")).otherwise(F.lit(float("nan"))))
    return clean_reference(ref).select("source_id", "pmra", "pmdec", F.round("pm_err", 6).alias("pm_err"), F.round("ra_err", 8).alias("ra_err"), "touched")


@query(with_("image_qa") + " SELECT id, CASE WHEN id % 3 = 0 THEN 'new' WHEN id % 3 = 1 THEN CASE WHEN id % 2 = 0 THEN 'new' ELSE ' ' END ELSE 'old' END AS comment FROM image_qa")
def e15_comments(spark, sf):
    old = F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).when(F.col("id") % 3 == 1, " ").otherwise("old")
    new = F.when((F.col("id") % 2 == 0) | (F.col("id") % 3 == 0), "new")
    return table(spark, sf, "image_qa").select("id", text.merge_comment(old, new).alias("comment"))


@query(with_("pixels") + " SELECT frame, y, x, round(asinh((v - 100) / 50) * 10, 6) AS s FROM pixels WHERE NOT bad")
def e5_stretch(spark, sf):
    return table(spark, sf, "pixels").where("NOT bad").select("frame", "y", "x", F.round(text.asinh_stretch(F.col("v"), 100.0, 5.0), 6).alias("s"))


@query(with_("pixels") + """, h AS (SELECT frame, quantile_cont(v, 0.997) AS hi FROM pixels GROUP BY frame)
 SELECT frame, y, x, round(greatest(0, least(1, asinh(least(greatest(v - 20e0, -5e0), hi - 20) / 15) / asinh((hi - 20) / 15))), 6) AS s FROM pixels JOIN h USING (frame)""")
def e5_clipped_stretch(spark, sf):
    d = table(spark, sf, "pixels")
    hi = exact_quantiles(d, ["frame"], "v", [0.997]).select("frame", F.col("q")[0].alias("hi"))
    return join_stats(d, hi, ["frame"]).select("frame", "y", "x", F.round(text.clipped_stretch(F.col("v"), 20.0, 5.0, F.col("hi")), 6).alias("s"))


@query(with_("image_qa") + """ SELECT id, concat_ws(', ', CASE WHEN ppflag & 1 <> 0 THEN 'other night' END, CASE WHEN ppflag & 2 <> 0 THEN 'manual master' END, CASE WHEN ppflag & 4 <> 0 THEN 'sanity false' END,
 CASE WHEN ppflag & 8 <> 0 THEN 'lenient keys' END, CASE WHEN ppflag & 16 <> 0 THEN 'across a wall' END, CASE WHEN ppflag & 32 <> 0 THEN 'hard keys ignored' END) AS label FROM image_qa""")
def e12_flag_labels(spark, sf):
    return table(spark, sf, "image_qa").select("id", text.flag_label(F.col("ppflag")).alias("label"))


@query(with_("headers") + " SELECT image_id, CASE WHEN exptime IS NULL THEN round(0.9e0 * 65535, 4) ELSE round((65535 - 500 - CAST(exptime AS DOUBLE)) / flxscale, 4) END AS sat FROM headers")
def e4_saturation(spark, sf):
    return table(spark, sf, "headers").select("image_id", F.round(text.saturation(F.lit(16), F.lit(500.0), F.col("exptime").cast("double"), F.col("flxscale")), 4).alias("sat"))

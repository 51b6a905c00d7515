"""Queries: calibration and astrometric statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.fixtures import table, with_
from starloom.operators import photometry, skyjoin, stats
from starloom.plans.registry import query
from starloom.plans.sky import BASE
from starloom.storage import durable

JOINED = BASE + ", m AS (SELECT d.*, b.source_id, b.separation, r.mag AS ref_mag FROM det d LEFT JOIN best b USING (det_id) LEFT JOIN ref r ON r.source_id = b.source_id)"


def matched(spark, sf) -> DataFrame:
    """Detections with the nearest reference source, nulls where there is none."""
    det, ref = table(spark, sf, "det"), table(spark, sf, "ref")
    m = skyjoin.cross_match(det, ref, 1.0, "left").withColumn("separation", F.round("separation", 6))
    return det.join(m, "det_id").join(ref.select("source_id", F.col("mag").alias("ref_mag")), "source_id", "left")


SAMPLE = "flags = 0 AND power((x - 4788) / (0.75 * 4788), 2) + power((y - 3194) / (0.75 * 3194), 2) <= 1 AND ref_mag > 12 AND ref_mag < 17.5 AND snr > 20"


@query(JOINED + f" SELECT det_id, source_id, ref_mag FROM m WHERE {SAMPLE}")
def f2_calibration_sample(spark, sf):
    return photometry.calibration_sample(matched(spark, sf), "ref_mag").select("det_id", "source_id", "ref_mag")


CLIP = ", ".join(f"c{i} AS (SELECT c{i - 1}.* FROM c{i - 1} JOIN (SELECT filt, ap, median(dz) AS c, stddev_pop(dz) AS s FROM c{i - 1} GROUP BY filt, ap) USING (filt, ap) WHERE abs(dz - c) <= 2.0 * s)" for i in range(1, 6))
ZP = JOINED + f""", c0 AS (SELECT filt, ap, ref_mag - (mag_auto + ap * 0.05e0) AS dz FROM m CROSS JOIN (SELECT 0 AS ap UNION ALL SELECT 1 UNION ALL SELECT 2) a WHERE {SAMPLE}), {CLIP},
 md AS (SELECT filt, ap, median(dz) AS zp FROM c5 GROUP BY filt, ap),
 z AS (SELECT filt, ap, count(*) AS n, any_value(zp) AS zp, 1.4826 * median(abs(dz - zp)) AS zperr FROM c5 JOIN md USING (filt, ap) GROUP BY filt, ap)"""


def zero_point_table(spark, sf) -> DataFrame:
    """Zero points by filter and aperture; the apertures are shifts of the automatic magnitude."""
    s = photometry.calibration_sample(matched(spark, sf), "ref_mag").withColumn("ap", F.explode(F.array(*map(F.lit, range(3)))))
    return photometry.zero_points(s.withColumn("mag_inst", F.col("mag_auto") + F.col("ap") * 0.05), ["filt", "ap"], "ref_mag")


@query(ZP + " SELECT filt, ap, n, round(zp, 6) AS zp, round(zperr, 6) AS zperr FROM z")
def a7_zero_point(spark, sf):
    return zero_point_table(spark, sf).select("filt", "ap", "n", F.round("zp", 6).alias("zp"), F.round("zperr", 6).alias("zperr"))


@query(ZP + """ SELECT det_id, round(mag_auto + zp, 5) AS mag_cal, round(sqrt(magerr_auto * magerr_auto + zperr * zperr), 5) AS magerr_cal, round(power(10, (23.9 - (mag_auto + zp)) / 2.5), 3) AS flux,
 round(ln(10) / 2.5 * power(10, (23.9 - (mag_auto + zp)) / 2.5) * sqrt(magerr_auto * magerr_auto + zperr * zperr), 4) AS fluxerr, round(2.5 / ln(10) / sqrt(magerr_auto * magerr_auto + zperr * zperr), 3) AS snr_cal FROM det JOIN z USING (filt) WHERE ap = 0""")
def e1_calibrated_columns(spark, sf):
    z = F.broadcast(zero_point_table(spark, sf).where("ap = 0"))  # a row per filter
    c = photometry.calibrated(F.col("mag_auto"), F.col("magerr_auto"), F.col("zp"), F.col("zperr"))
    digits = {"mag_cal": 5, "magerr_cal": 5, "flux": 3, "fluxerr": 4, "snr_cal": 3}
    return table(spark, sf, "det").join(z, "filt").select("det_id", *[F.round(v, digits[k]).alias(k) for k, v in c.items()])


@query(ZP + """ SELECT filt, round(zp - 2.5 * log10(3 * sqrt(pi()) * 8 / 2 * 25), 3) AS ul3, round(zp - 2.5 * log10(5 * sqrt(pi()) * 8 / 2 * 25), 3) AS ul5, round(sqrt(zperr * zperr + 0.0001), 6) AS rss, round(2.5e0 * 3.2e0, 4) AS d1, round(3 / 0.505e0, 4) AS d2 FROM z WHERE ap = 1""")
def e2_depths_and_apertures(spark, sf):
    z = zero_point_table(spark, sf).where("ap = 1")
    d = photometry.aperture_diameters(F.lit(3.2), 0.505, {"d1": 2.5}, {"d2": 3.0})
    ul = {f"ul{n}": photometry.limiting_mag(n, F.col("zp"), F.lit(8.0), F.lit(25.0)) for n in (3, 5)}
    return z.select("filt", *[c.alias(k) for k, c in ul.items()], F.round(photometry.rss(F.col("zperr"), F.lit(0.01), F.lit(None).cast("double"), F.lit(float("nan"))), 6).alias("rss"), *[F.round(c, 4).alias(k) for k, c in d.items()])


@query(ZP + " SELECT filt, ap, round(power(10, 0.4 * (23.9 - zp)), 6) AS flxscale FROM z")
def e3_flux_scale(spark, sf):
    return zero_point_table(spark, sf).select("filt", "ap", F.round(photometry.flux_scale(F.col("zp")), 6).alias("flxscale"))


@query(ZP + """, w AS (SELECT ap, CASE WHEN ap = 2 AND filt LIKE 'm%' THEN zp + 3 ELSE zp END AS zp, CASE WHEN ap = 1 AND filt NOT LIKE 'm%' THEN NULL WHEN filt = 'm525' THEN 0.0001 ELSE zperr END AS zperr, filt FROM z)
 SELECT ap, coalesce((SELECT arg_min(filt, (zperr, filt)) FROM w v WHERE v.ap = k.ap AND zperr IS NOT NULL AND NOT (filt LIKE 'm%' AND zp > 27.2) AND NOT (v.ap = 0 AND filt = 'm525')), 'g') AS filt FROM (SELECT DISTINCT ap FROM z) k""")
def a9_filter_inference(spark, sf):
    m = F.col("filt").startswith("m")
    z = zero_point_table(spark, sf).select("ap", "filt", F.when((F.col("ap") == 2) & m, F.col("zp") + 3).otherwise(F.col("zp")).alias("zp"), F.when((F.col("ap") == 1) & ~m, None).when(F.col("filt") == "m525", 0.0001).otherwise(F.col("zperr")).alias("zperr"), F.lit("g").alias("alleged"))
    active = z.select("ap", "filt").where("ap <> 0 OR filt <> 'm525'")
    return photometry.infer_filter(z, ["ap"], active=active)


@query(with_("det") + " SELECT det_id FROM det WHERE snr > 10 AND class_star > 0.2 AND flags <= 0")
def f1_f3_source_selection(spark, sf):
    return table(spark, sf, "det").where(photometry.condition(["snr", "lower", 10, "class_star", ">", 0.2, "flags", "<=", 0])).select("det_id")


@query(with_("ref") + " SELECT source_id FROM ref WHERE mag > 13 AND mag < 16 AND bp_rp > 0.5 AND bp_rp < 2")
def f4_reference_cuts(spark, sf):
    return photometry.interval_cuts(table(spark, sf, "ref"), mag=(13.0, 16.0), bp_rp=(0.5, 2.0), absent=(0.0, 1.0)).select("source_id")


@query(with_("det") + """, m AS (SELECT image_id, median(fwhm) AS med FROM det GROUP BY image_id) SELECT image_id, count(*) AS n, any_value(med) AS med, round(1.4826 * median(abs(fwhm - med)), 6) AS nmad FROM det JOIN m USING (image_id) GROUP BY image_id""")
def a6_median_nmad(spark, sf):
    return stats.median_nmad(table(spark, sf, "det"), ["image_id"], "fwhm").withColumn("nmad", F.round("nmad", 6))


FIXED = ", ".join(f"c{i} AS (SELECT c{i - 1}.* FROM c{i - 1} JOIN (SELECT filt, avg(v) AS c, stddev_samp(v) AS s FROM c{i - 1} GROUP BY filt) USING (filt) WHERE abs(v - c) < 3.0 * s)" for i in range(1, 6))


@query(with_("det") + f", c0 AS (SELECT filt, snr * snr AS v FROM det), {FIXED} SELECT filt, count(*) AS n, round(avg(v), 6) AS mean, median(v) AS median, round(stddev_pop(v), 6) AS std FROM c5 GROUP BY filt")
def a8_clip_fixed_passes(spark, sf):
    d = table(spark, sf, "det").withColumn("v", F.col("snr") * F.col("snr"))
    return stats.clipped_stats_fixed(d, ["filt"], "v").withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(with_("det") + " SELECT image_id, median(fwhm) AS seeing, median(ellipticity) AS ellip, round(median(1 / (1 - ellipticity)), 6) AS elong FROM det WHERE flags = 0 AND class_star > 0.5 GROUP BY image_id")
def a10_seeing_medians(spark, sf):
    d = table(spark, sf, "det").where("flags = 0 AND class_star > 0.5")
    return d.groupBy("image_id").agg(F.median("fwhm").alias("seeing"), F.median("ellipticity").alias("ellip"), F.round(F.median(1 / (1 - F.col("ellipticity"))), 6).alias("elong"))


SEPS = ["rms", "q1", "q2", "q3", "p95", "p99", "mad", "frac_pixel", "frac_arcsec", "unmatched"]
SEP_SQL = JOINED + """, s AS (SELECT image_id, count(separation) AS n, round(sqrt(avg(separation * separation)), 5) AS rms, min(separation) AS lo, max(separation) AS hi, round(quantile_cont(separation, 0.25), 5) AS q1, round(quantile_cont(separation, 0.5), 5) AS q2,
 round(quantile_cont(separation, 0.75), 5) AS q3, round(quantile_cont(separation, 0.95), 5) AS p95, round(quantile_cont(separation, 0.99), 5) AS p99, round(1.4826 * median(separation), 5) AS mad, round(avg(CASE WHEN separation < 0.505 THEN 1.0 WHEN separation IS NOT NULL THEN 0.0 END), 5) AS frac_pixel,
 round(avg(CASE WHEN separation < 1 THEN 1.0 WHEN separation IS NOT NULL THEN 0.0 END), 5) AS frac_arcsec, round(avg(CASE WHEN separation IS NULL THEN 1.0 ELSE 0.0 END), 5) AS unmatched FROM m GROUP BY image_id)"""


@query(SEP_SQL + " SELECT * FROM s")
def a11_separation_stats(spark, sf):
    return stats.separation_stats(matched(spark, sf), ["image_id"], "separation", 0.505).withColumns({c: F.round(c, 5) for c in SEPS})


@query(SEP_SQL + " SELECT image_id, coalesce(p95 < 0.98, false) AS good, coalesce(unmatched > 0.4 OR q2 > 2 * 0.4, false) AS bad FROM s")
def a33_solution_verdict(spark, sf):
    s = stats.separation_stats(matched(spark, sf), ["image_id"], "separation", 0.505).withColumns({c: F.round(c, 5) for c in SEPS})
    return s.select("image_id", F.coalesce(F.col("p95") < 0.98, F.lit(False)).alias("good"), F.coalesce((F.col("unmatched") > 0.4) | (F.col("q2") > 2 * 0.4), F.lit(False)).alias("bad"))


@query(JOINED + """, p AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY mag_auto, det_id) AS k FROM m), q AS (SELECT * FROM p WHERE k <= 40 AND (flags = 0 OR source_id IS NULL)) SELECT det_id, image_id, source_id FROM q""")
def a12_k1_evaluation_sample(spark, sf):
    top = stats.brightest(matched(spark, sf), ["image_id"], "mag_auto", "det_id", 40)
    return top.where((F.col("flags") == 0) | F.col("source_id").isNull()).select("det_id", "image_id", "source_id")


@query(with_("det") + """, k AS (SELECT image_id, row_number() OVER w AS k, sum(fwhm) OVER (PARTITION BY image_id ORDER BY det_id ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) / 15 AS m FROM det WINDOW w AS (PARTITION BY image_id ORDER BY det_id)),
 d AS (SELECT image_id, k, m - lag(m) OVER (PARTITION BY image_id ORDER BY k) AS d FROM k) SELECT image_id, coalesce(min(CASE WHEN d < -0.05 THEN k END), 1) - 1 AS plateau FROM d WHERE k > 8 GROUP BY image_id""")
def a12_plateau(spark, sf):
    return stats.plateau_end(table(spark, sf, "det"), ["image_id"], "det_id", "fwhm")


RING = "CAST(least(floor((power(x - 4788, 2) + power(y - 3194, 2)) / (4788.0 * 4788 + 3194.0 * 3194) * 5), 4) AS INT)"


@query(JOINED + f" SELECT {RING} AS ring, count(*) AS n, round(1.4826 * median(abs(separation)), 5) AS mad, median(fwhm) AS fwhm, median(ellipticity) AS ellipticity FROM m GROUP BY 1")
def a13_radial_bins(spark, sf):
    r = F.hypot(F.col("x") - 4788, F.col("y") - 3194)
    m = durable(matched(spark, sf).select(stats.radial_bin(r, float((4788**2 + 3194**2) ** 0.5), 5).alias("ring"), F.abs("separation").alias("mad"), "fwhm", "ellipticity"))
    out = m.groupBy("ring").agg(F.count("*").alias("n"))
    for c in ("mad", "fwhm", "ellipticity"):
        out = out.join(stats.exact_medians(m, ["ring"], c).select("ring", F.col("median").alias(c)), "ring", "left")
    return out.withColumn("mad", F.round(F.col("mad") * stats.NMAD, 5))


@query(with_("det") + " SELECT image_id, round(avg(fwhm) * 0.505 + 1e-9, 4) AS fwhm_mean, round(stddev_pop(fwhm) * 0.505 + 1e-9, 4) AS fwhm_std, round(avg(ellipticity) + 1e-9, 4) AS ell_mean, round(stddev_pop(ellipticity) + 1e-9, 4) AS ell_std FROM det GROUP BY image_id")
def a14_image_stats(spark, sf):
    return table(spark, sf, "det").groupBy("image_id").agg(*[F.round(f(c) * k + 1e-9, 4).alias(f"{a}_{s}") for c, a, k in (("fwhm", "fwhm", 0.505), ("ellipticity", "ell", 1.0)) for f, s in ((F.avg, "mean"), (F.stddev_pop, "std"))])


@query(with_("det") + """, z AS (SELECT image_id, avg(CASE WHEN (x < 2394 OR x > 7182) AND (y < 1597 OR y > 4791) THEN fwhm END) AS corner, avg(CASE WHEN x BETWEEN 2394 AND 7182 AND y BETWEEN 1597 AND 4791 THEN fwhm END) AS centre FROM det GROUP BY image_id)
 SELECT image_id, round(corner / centre, 6) AS ratio FROM z""")
def a15_corner_ratio(spark, sf):
    x, y = F.col("x"), F.col("y")
    corner, centre = ((x < 2394) | (x > 7182)) & ((y < 1597) | (y > 4791)), x.between(2394, 7182) & y.between(1597, 4791)
    return table(spark, sf, "det").groupBy("image_id").agg(F.round(F.avg(F.when(corner, F.col("fwhm"))) / F.avg(F.when(centre, F.col("fwhm"))), 6).alias("ratio"))


@query(with_("det") + """, s AS (SELECT image_id, sum(ellipticity * cos(2 * radians(theta))) AS c, sum(ellipticity * sin(2 * radians(theta))) AS s, sum(ellipticity) AS w FROM det GROUP BY image_id), r AS (SELECT *, sqrt(c * c + s * s) / w AS r FROM s)
 SELECT image_id, round(r, 6) AS r, round((degrees(atan2(s, c)) / 2 + 180) % 180, 4) AS axis, round(1 - r, 6) AS variance, round(degrees(sqrt(-2 * ln(r))) / 2, 4) AS sd FROM r""")
def a16_axial_alignment(spark, sf):
    d = stats.axial_alignment(table(spark, sf, "det"), ["image_id"], F.col("theta"), F.col("ellipticity"))
    return d.select("image_id", F.round("r", 6).alias("r"), F.round("axis", 4).alias("axis"), F.round("variance", 6).alias("variance"), F.round("sd", 4).alias("sd"))


@query(with_("det", "ref") + """, dp AS (SELECT 'g' AS filt, -8.5e0 AS depth UNION ALL SELECT 'r', -8e0 UNION ALL SELECT 'i', -9e0 UNION ALL SELECT 'm525', -10e0 UNION ALL SELECT 'm650', -11e0) SELECT filt, count(*) FILTER (WHERE mag_auto < depth AND snr > 5 AND x BETWEEN 5 AND 9571 AND y BETWEEN 5 AND 6383) AS n,
 round(count(*) FILTER (WHERE mag_auto < depth AND snr > 5 AND x BETWEEN 5 AND 9571 AND y BETWEEN 5 AND 6383) / (0.5e0 * (SELECT count(*) FROM ref)), 6) AS frac FROM det JOIN dp USING (filt) GROUP BY filt""")
def a18_source_fraction(spark, sf):
    depth = F.when(F.col("filt") == "g", -8.5).when(F.col("filt") == "r", -8.0).when(F.col("filt") == "i", -9.0).when(F.col("filt") == "m525", -10.0).when(F.col("filt") == "m650", -11.0)
    good = (F.col("mag_auto") < depth) & (F.col("snr") > 5) & F.col("x").between(5, 9571) & F.col("y").between(5, 6383)
    total = table(spark, sf, "ref").agg(F.count("*").alias("total"))
    counts = table(spark, sf, "det").where(depth.isNotNull()).groupBy("filt").agg(F.count_if(good).alias("n"))
    return counts.crossJoin(F.broadcast(total)).select("filt", "n", F.round(F.col("n") / (0.5 * F.col("total")), 6).alias("frac"))  # one row on the right


@query(with_("det") + ", c AS (SELECT image_id, filt, count(*) AS n, min(det_id) AS f FROM det GROUP BY image_id, filt) SELECT image_id, arg_min(filt, (-n, f)) AS filt, max(n) AS n FROM c GROUP BY image_id")
def a27_most_common_filter(spark, sf):
    return stats.most_common(table(spark, sf, "det"), ["image_id"], "filt", "det_id")


WIDE = ", ".join(f"round(max(CASE WHEN ap = {a} THEN {c} END), 6) AS {n}_{a}" for a in range(3) for c, n in (("zp", "zp"), ("zperr", "ezp")))


@query(ZP + f" SELECT filt, {WIDE} FROM z GROUP BY filt")
def a29_aperture_wide(spark, sf):
    z = zero_point_table(spark, sf)
    wide = z.groupBy("filt").pivot("ap", [0, 1, 2]).agg(F.round(F.first("zp"), 6).alias("zp"), F.round(F.first("zperr"), 6).alias("ezp"))
    return wide.select("filt", *[F.col(f"{a}_{c}").alias(f"{c}_{a}") for a in range(3) for c in ("zp", "ezp")])

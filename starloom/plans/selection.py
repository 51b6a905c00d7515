"""Queries: metric tables, cuts and quality criteria."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.fixtures import table, with_
from starloom.operators import selection
from starloom.plans.registry import query

QA = with_("image_qa") + ", q AS (SELECT * REPLACE (nullif(seeing, 0) AS seeing, nullif(ellipmn, 0) AS ellipmn, nullif(ul5_5, 0) AS ul5_5) FROM image_qa)"


def _qa(spark, sf):
    return selection.missing_zeros(table(spark, sf, "image_qa"))


@query(with_("headers") + " SELECT image_id, CASE WHEN (SELECT count(exptime) FROM headers) > 0 THEN nullif(CAST(exptime AS DOUBLE), 0) ELSE CAST(mjd AS DOUBLE) END AS exptime, nullif(round(seeing, 6), 0) AS seeing FROM headers")
def s3_metrics_from_headers(spark, sf):
    h = table(spark, sf, "headers").withColumn("absent", F.lit(None).cast("string"))
    key = selection.first_key(h, ["absent", "exptime", "mjd"])
    return h.select("image_id", F.nullif(F.expr(f"try_cast({key} AS DOUBLE)"), F.lit(0.0)).alias("exptime"), F.nullif(F.round("seeing", 6), F.lit(0.0)).alias("seeing"))


@query(QA + " SELECT image_name, unit, seeing, ul5_5 FROM q WHERE filt = 'r' AND image_type = 'science' AND skyval < 50")
def s4_metrics_from_qa(spark, sf):
    return _qa(spark, sf).where("skyval < 50").where((F.col("filt") == "r") & (F.col("image_type") == "science")).select("image_name", "unit", "seeing", "ul5_5")


PATHS = "p AS (SELECT concat('/data/', CAST(o_orderkey AS VARCHAR)) AS image_path, o_orderkey AS pos FROM orders WHERE o_orderkey % 5 = 0)"


@query(QA + f", {PATHS} SELECT pos, p.image_path, seeing, (SELECT count(*) FROM p JOIN q USING (image_path)) AS found FROM p LEFT JOIN q USING (image_path)")
def s5_metrics_for_paths(spark, sf):
    paths = spark.read.parquet(f"{sf}/orders.parquet").where("o_orderkey % 5 = 0").select(F.concat(F.lit("/data/"), F.col("o_orderkey").cast("string")).alias("image_path"), F.col("o_orderkey").alias("pos"))
    joined = paths.join(_qa(spark, sf).select("image_path", "seeing", F.lit(True).alias("hit")), "image_path", "left")
    found = joined.agg(F.count("hit").alias("found"))
    return joined.select("pos", "image_path", "seeing").crossJoin(F.broadcast(found))  # one row on the right


CUTS = """, l AS (SELECT filt, unnest(['seeing', 'ellipmn', 'ul5_5']) AS metric, unnest([seeing, ellipmn, ul5_5]) AS v, unnest([1, 1, -1]) AS sign FROM q),
 m AS (SELECT filt, metric, median(v) AS med, stddev_pop(v) AS sd FROM l GROUP BY ALL), d AS (SELECT filt, metric, any_value(sign) AS sign, any_value(med) AS med, any_value(sd) AS sd, 1.4826 * median(abs(v - med)) AS mad FROM l JOIN m USING (filt, metric) WHERE v IS NOT NULL GROUP BY filt, metric)"""


@query(QA + CUTS + " SELECT filt, metric, round(med + sign * 3 * CASE WHEN mad > 0 THEN mad ELSE sd END, 6) AS cut FROM d")
def a19_suggested_cuts(spark, sf):
    return selection.suggest_cuts(_qa(spark, sf), ["filt"], {m: selection.WORSE[m] for m in ("seeing", "ellipmn", "ul5_5")}).withColumn("cut", F.round("cut", 6))


TEXT = "seeing<=3.5, ellipmn<=0.45 ul5_5>=18.5 ppflag=1111"
FAILS = ", f AS (SELECT id, coalesce(seeing > 3.5, false) AS a, coalesce(ellipmn > 0.45, false) AS b, coalesce(ul5_5 < 18.5, false) AS c, (ppflag & ~15) <> 0 AS d FROM q), g AS (SELECT *, CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) AS n FROM f)"


@query(QA + FAILS + " SELECT id, NOT (a OR b OR c OR d) AS keep FROM f")
def a20_apply_cuts(spark, sf):
    return selection.apply_cuts(_qa(spark, sf), selection.parse_cuts(TEXT)).select("id", "keep")


@query(QA + FAILS + " " + " UNION ALL ".join(f"SELECT '{m}' AS metric, count(*) FILTER (WHERE {c}) AS total, count(*) FILTER (WHERE {c} AND n = 1) AS alone FROM g" for m, c in (("seeing", "a"), ("ellipmn", "b"), ("ul5_5", "c"), ("ppflag", "d"))))
def a20_a21_rejection_counts(spark, sf):
    return selection.rejection_counts(_qa(spark, sf), selection.parse_cuts(TEXT))


STATS = """, h AS (SELECT id, image_type, sanity AS old, 511 + id % 5 AS clipmed, 2 + (id % 10) / 10e0 AS clipstd, CASE WHEN id % 6 = 0 THEN NULL ELSE 1 + (id % 50) / 100e0 END AS clipmax, (60 + id % 40) / 100e0 AS clipmin, (id % 80) / 100e0 AS edgevar, ellipmn FROM image_qa),
 r AS (SELECT id, CASE image_type WHEN 'bias' THEN CASE WHEN clipmed NOT BETWEEN 512 AND 514 THEN 'clipmed' WHEN clipstd > 2.5 THEN 'clipstd' END WHEN 'dark' THEN CASE WHEN clipstd > 2.8 THEN 'clipstd' END
 WHEN 'flat' THEN CASE WHEN clipmax >= 1.3 THEN 'clipmax' WHEN clipmin <= 0.7 THEN 'clipmin' WHEN edgevar >= 0.6 THEN 'edgevar' END ELSE CASE WHEN ellipmn >= 0.3 THEN 'ellipmn' END END AS rejected_by FROM h)"""


@query(with_("image_qa") + STATS + " SELECT id, rejected_by, rejected_by IS NULL AS sanity FROM r")
def f12_quality_criteria(spark, sf):
    h = table(spark, sf, "image_qa").selectExpr("id", "image_type", "511 + id % 5 AS clipmed", "2 + (id % 10) / 10e0 AS clipstd", "CASE WHEN id % 6 = 0 THEN NULL ELSE 1 + (id % 50) / 100e0 END AS clipmax", "(60 + id % 40) / 100e0 AS clipmin", "(id % 80) / 100e0 AS edgevar", "ellipmn")
    return selection.apply_criteria(h).select("id", "rejected_by", "sanity")


@query(with_("image_qa") + """ SELECT id, CASE WHEN id % 19 = 0 THEN 'keep' WHEN sanity = false AND NOT (id % 4 <= id % 3) THEN 'reject' ELSE 'recompute' END AS action FROM image_qa""")
def f13_sanity_action(spark, sf):
    q = table(spark, sf, "image_qa")
    human = F.when(F.col("id") % 19 == 0, "seen")
    return q.select("id", selection.sanity_action(human, F.col("sanity"), F.col("id") % 4, F.col("id") % 3, True).alias("action"))


@query(with_("image_qa") + " SELECT id, seeing FROM image_qa WHERE image_type = 'dark' AND seeing IS NOT NULL AND nightdate BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'")
def f16_rows_in_date_range(spark, sf):
    q = table(spark, sf, "image_qa")
    return q.where((F.col("image_type") == "dark") & F.col("seeing").isNotNull() & F.col("nightdate").between(F.lit("1995-01-01").cast("date"), F.lit("1996-12-31").cast("date"))).select("id", "seeing")


@query(with_("image_qa") + " SELECT id, coalesce(skyval < 40, true) AS dynamic, bool_or(coalesce(skyval < 40, true)) OVER (PARTITION BY unit, nightdate) AS group_dynamic, round(ul5_5 - coalesce(skyval, 0), 6) AS level FROM image_qa")
def p21_background_choice(spark, sf):
    from pyspark.sql import Window as W

    low = F.coalesce(F.col("skyval") < 40, F.lit(True))
    return table(spark, sf, "image_qa").select("id", low.alias("dynamic"), F.bool_or(low).over(W.partitionBy("unit", "nightdate")).alias("group_dynamic"), F.round(F.col("ul5_5") - F.coalesce("skyval", F.lit(0.0)), 6).alias("level"))

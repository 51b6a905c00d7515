"""Queries: the derivation graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.fixtures import table, with_
from starloom.operators import inventory, lineage
from starloom.plans.registry import query

BASE = with_("edges", "image_qa", "process_status").replace("WITH ", "WITH RECURSIVE ", 1)
CLOSURE = BASE + """, c(id, depth) AS (SELECT CAST(0 AS BIGINT), 0 UNION SELECT e.derived, c.depth + 1 FROM c JOIN edges e ON e.source = c.id WHERE c.depth < 12), m AS (SELECT id, min(depth) AS depth FROM c GROUP BY id)"""


def _all(spark, sf):
    return (table(spark, sf, n) for n in ("edges", "image_qa", "process_status"))


def _seed(spark, k=0):
    return spark.range(k, k + 1)


@query(CLOSURE + " SELECT id, depth FROM m")
def t1_downstream(spark, sf):
    return lineage.downstream(table(spark, sf, "edges"), _seed(spark))


@query(BASE + ", c(id, depth) AS (SELECT CAST(1234 AS BIGINT), 0 UNION SELECT e.source, c.depth + 1 FROM c JOIN edges e ON e.derived = c.id WHERE c.depth < 12) SELECT id, min(depth) AS depth FROM c GROUP BY id")
def t1_upstream(spark, sf):
    return lineage.upstream(table(spark, sf, "edges"), _seed(spark, 1234))


@query(BASE + " SELECT e.derived, i.image_name AS source_name, role FROM edges e JOIN image_qa i ON i.id = e.source")
def j17_ingredients(spark, sf):
    e, i, _ = _all(spark, sf)
    return e.join(i.select(F.col("id").alias("source"), F.col("image_name").alias("source_name")), "source").select("derived", "source_name", "role")


@query(BASE + " SELECT e.derived % 100 AS grp, i.unit, count(*) AS n FROM edges e JOIN image_qa i ON i.id = e.source WHERE right(i.image_name, 1) = '7' GROUP BY ALL")
def j17_units(spark, sf):
    e, i, _ = _all(spark, sf)
    return e.join(i.where(F.right("image_name", F.lit(1)) == "7").select(F.col("id").alias("source"), "unit"), "source").groupBy((F.col("derived") % 100).alias("grp"), "unit").agg(F.count("*").alias("n"))


@query(BASE + " SELECT e.derived, e.source, source_imageid, i.imageid AS current FROM edges e JOIN image_qa i ON i.id = e.source WHERE source_imageid IS NOT NULL AND source_imageid <> i.imageid")
def j18_stale_edges(spark, sf):
    e, i, _ = _all(spark, sf)
    return lineage.stale_edges(e, i).select("derived", "source", "source_imageid", "current")


@query(BASE + " SELECT p.id FROM process_status p WHERE progress > 50 AND NOT EXISTS (SELECT 1 FROM image_qa i WHERE i.process_status_id = p.id AND image_type = 'science')")
def j19_configs_without_products(spark, sf):
    _, i, p = _all(spark, sf)
    return p.where("progress > 50").join(i.where("image_type = 'science'").select(F.col("process_status_id").alias("id")), "id", "left_anti").select("id")


@query(BASE + " SELECT DISTINCT process_status_id AS id FROM image_qa i WHERE EXISTS (SELECT 1 FROM process_status p WHERE p.id = i.process_status_id) AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.derived = i.id AND role = 'secondary')")
def j19_configs_without_lineage(spark, sf):
    e, i, p = _all(spark, sf)
    alone = i.join(e.where("role = 'secondary'").select(F.col("derived").alias("id")), "id", "left_anti")
    return alone.select(F.col("process_status_id").alias("id")).join(p, "id", "left_semi").distinct()


ROLL = BASE + ", r AS (SELECT DISTINCT d.process_status_id AS derived_config, s.process_status_id AS source_config FROM edges e JOIN image_qa d ON d.id = e.derived JOIN image_qa s ON s.id = e.source WHERE d.process_status_id <> s.process_status_id)"


@query(ROLL + " SELECT * FROM r")
def a22_config_rollup(spark, sf):
    e, i, _ = _all(spark, sf)
    return lineage.config_edges(e, i)


@query(ROLL + ", s AS (SELECT derived_config, source_config FROM r WHERE derived_config % 2 = 0), o AS (SELECT derived_config AS derived, source_config AS source, 'old' AS role FROM r), n AS (SELECT derived_config AS derived, source_config AS source, CASE WHEN source_config % 3 = 0 THEN 'product' ELSE 'scheduled' END AS role FROM s) SELECT * FROM n UNION ALL SELECT * FROM o WHERE derived NOT IN (SELECT derived FROM n)")
def a23_replace_dependencies(spark, sf):
    e, i, _ = _all(spark, sf)
    r = lineage.durable(lineage.config_edges(e, i).select(F.col("derived_config").alias("derived"), F.col("source_config").alias("source")))
    s = r.where("derived % 2 = 0")
    return lineage.replace_dependencies(s.where("source % 3 = 0").withColumn("role", F.lit("product")), s.withColumn("role", F.lit("scheduled")), r.withColumn("role", F.lit("old")))


@query(CLOSURE + " SELECT process_status_id AS config, min(depth) AS depth, count(*) AS images, image_type FROM m JOIN image_qa USING (id) WHERE depth > 0 GROUP BY ALL")
def a24_impact_summary(spark, sf):
    e, i, _ = _all(spark, sf)
    return lineage.downstream(e, _seed(spark)).where("depth > 0").join(i, "id").groupBy(F.col("process_status_id").alias("config"), "image_type").agg(F.min("depth").alias("depth"), F.count("*").alias("images"))


@query(BASE + " SELECT name, count(*) AS n FROM process_status GROUP BY name HAVING count(*) > 1")
def a26_duplicate_configs(spark, sf):
    return table(spark, sf, "process_status").groupBy("name").agg(F.count("*").alias("n")).where("n > 1")


@query(CLOSURE + """, h AS (SELECT process_status_id, min(depth) AS depth, count(*) AS images, bool_or(image_type <> 'science') AS master FROM m JOIN image_qa USING (id) WHERE depth > 0 GROUP BY 1)
 SELECT process_status_id AS config, CASE WHEN config_exists IS NULL THEN 'skip: no config row' WHEN NOT config_exists THEN 'skip: config file is missing' WHEN master THEN 'master' ELSE config_type END AS action, depth, images FROM h LEFT JOIN process_status p ON p.id = process_status_id""")
def t2_cascade_plan(spark, sf):
    e, i, p = _all(spark, sf)
    return lineage.cascade_plan(e, i, p, _seed(spark))


@query(BASE + """ SELECT derived, CASE WHEN bool_or(source % 40 = 0) THEN 'designated' WHEN bool_or(source_imageid <> imageid) THEN 'regenerated' WHEN bool_or(sanity = false) THEN 'sanity' WHEN derived % 6 = 0 THEN 'better-match' ELSE 'none' END AS reason FROM edges JOIN image_qa i ON i.id = source GROUP BY derived""")
def t3_rebuild_reason(spark, sf):
    e, i, _ = _all(spark, sf)
    return lineage.rebuild_reason(e, i, i.where("id % 40 = 0").select(F.col("id").alias("source")), i.where("id % 6 = 0").select(F.col("id").alias("derived")))


@query(BASE + """, r AS (SELECT derived, CASE WHEN bool_or(source_imageid <> imageid) THEN 'regenerated' WHEN bool_or(sanity = false) THEN 'sanity' END AS reason FROM edges JOIN image_qa i ON i.id = source GROUP BY derived)
 SELECT id, CASE WHEN id % 9 = 0 THEN 'adopt' WHEN id % 2 = 0 AND (image_path IS NULL OR reason IS NOT NULL) THEN 'generate' ELSE 'fetch' END AS action FROM image_qa LEFT JOIN r ON derived = id WHERE image_type <> 'science'""")
def t10_master_decision(spark, sf):
    e, i, _ = _all(spark, sf)
    none = i.limit(0)
    r = lineage.rebuild_reason(e, i, none.select(F.col("id").alias("source")), none.select(F.col("id").alias("derived"))).withColumnRenamed("derived", "id")
    action = F.when(F.col("id") % 9 == 0, "adopt").when((F.col("id") % 2 == 0) & (F.col("image_path").isNull() | (F.coalesce("reason", F.lit("none")) != "none")), "generate").otherwise("fetch")
    return i.where("image_type <> 'science'").join(r, "id", "left").select("id", action.alias("action"))


@query(BASE + " SELECT DISTINCT id AS image, concat('m', CAST(id % 7 + n AS VARCHAR)) AS imageid, CASE n WHEN 1 THEN 'bias' WHEN 2 THEN 'dark' ELSE 'input' END AS role FROM image_qa CROSS JOIN (SELECT unnest([1, 2, 3]) AS n)")
def t4_parse_ingredients(spark, sf):
    i = table(spark, sf, "image_qa")
    cards = []
    for n, name in ((1, "bias_x"), (2, "dark_x"), (3, "sci_x"), (4, "SU01_raw")):
        prefix = ("IMCMB", "IMCID") if n < 3 else ("IMG", "IID")
        number = f"{n:03d}" if n < 3 else f"{n:05d}"
        cards += [F.lit(prefix[0] + number), F.lit(name), F.lit(prefix[1] + number), F.concat(F.lit("m"), (F.col("id") % 7 + n).cast("string"))]
    return lineage.parse_ingredients(i.select(F.col("id").alias("image"), F.create_map(*cards).alias("headers"))).select("image", "imageid", "role")


@query(BASE + ", k AS (SELECT concat('k', id % 5000) AS imageid, arg_min(id, (image_path IS NULL, id)) AS source FROM image_qa GROUP BY 1) SELECT DISTINCT derived, k.source, role FROM edges e JOIN k ON k.imageid = concat('k', e.source % 5000)")
def t5_sync_edges(spark, sf):
    e, i, _ = _all(spark, sf)
    wanted = e.select("derived", F.concat(F.lit("k"), F.col("source") % 5000).alias("imageid"), "role")
    return lineage.sync_edges(wanted, i.withColumn("imageid", F.concat(F.lit("k"), F.col("id") % 5000)))


@query(ROLL + " SELECT derived_config AS config, count(*) AS parents, count(*) FILTER (WHERE status IN ('done', 'failed')) AS finished, count(*) = count(*) FILTER (WHERE status IN ('done', 'failed')) AS ready FROM r LEFT JOIN process_status p ON p.id = source_config GROUP BY 1")
def t6_readiness(spark, sf):
    e, i, p = _all(spark, sf)
    return lineage.readiness(lineage.config_edges(e, i), p)


@query("SELECT DISTINCT b.user_id AS derived, a.user_id AS source, 'scheduled' AS origin FROM events a JOIN events b ON b.event_id IN (a.event_id + 1, a.event_id * 2) WHERE a.user_id <> b.user_id")
def t7_task_edges(spark, sf):
    t = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("idx"), F.col("user_id").alias("config"), F.array_distinct(F.array(F.col("event_id") + 1, F.col("event_id") * 2)).alias("dependents"))
    return lineage.task_edges(t)


LEVELS = BASE + """, f0 AS (SELECT id, 0 AS ppflag FROM image_qa WHERE image_type = 'bias'),
 f1 AS (SELECT i.id, coalesce(bit_or(f.ppflag), 0) AS ppflag FROM image_qa i LEFT JOIN edges e ON e.derived = i.id LEFT JOIN f0 f ON f.id = e.source WHERE image_type = 'dark' GROUP BY i.id), g1 AS (SELECT * FROM f0 UNION ALL SELECT * FROM f1),
 f2 AS (SELECT i.id, coalesce(bit_or(f.ppflag), 0) AS ppflag FROM image_qa i LEFT JOIN edges e ON e.derived = i.id LEFT JOIN g1 f ON f.id = e.source WHERE image_type = 'flat' GROUP BY i.id), g2 AS (SELECT * FROM g1 UNION ALL SELECT * FROM f2),
 f3 AS (SELECT i.id, coalesce(bit_or(f.ppflag), 0) | CASE WHEN bool_or(s.nightdate <> i.nightdate) THEN 1 ELSE 0 END | CASE WHEN bool_or(s.sanity = false) THEN 4 ELSE 0 END AS ppflag FROM image_qa i LEFT JOIN (edges e JOIN g2 f ON f.id = e.source JOIN image_qa s ON s.id = e.source) ON e.derived = i.id WHERE i.image_type = 'science' GROUP BY i.id)"""


@query(LEVELS + " SELECT id, CAST(ppflag AS INT) AS ppflag FROM g2 UNION ALL SELECT id, CAST(ppflag AS INT) FROM f3")
def t8_flags_over_lineage(spark, sf):
    e, i, _ = _all(spark, sf)
    return lineage.flags_up(e, i)


@query(BASE + " SELECT id FROM image_qa WHERE image_type = 'science' AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.derived = image_qa.id AND e.role = 'secondary') AND nightdate >= DATE '1995-06-01'")
def t9_backfill_targets(spark, sf):
    e, i, _ = _all(spark, sf)
    return i.where((F.col("image_type") == "science") & (F.col("nightdate") >= F.lit("1995-06-01").cast("date"))).join(e.where("role = 'secondary'").select(F.col("derived").alias("id")), "id", "left_anti").select("id")


@query(BASE + ", m AS (SELECT id // 4 AS sci, max(CASE WHEN id % 3 = 0 THEN id % 11 END) AS b, max(CASE WHEN id % 3 = 1 THEN id % 7 END) AS d, max(CASE WHEN id % 3 = 2 THEN id % 5 END) AS f FROM image_qa GROUP BY 1) SELECT b, d, f, count(*) AS n, min(sci) AS first FROM m GROUP BY ALL")
def a31_groups_by_masters(spark, sf):
    i = table(spark, sf, "image_qa").select(F.floor(F.col("id") / 4).alias("sci"), F.element_at(F.array(*map(F.lit, "bdf")), (F.col("id") % 3 + 1).cast("int")).alias("role"), F.when(F.col("id") % 3 == 0, F.col("id") % 11).when(F.col("id") % 3 == 1, F.col("id") % 7).otherwise(F.col("id") % 5).alias("m"))
    wide = i.groupBy("sci").pivot("role", ["b", "d", "f"]).agg(F.max("m"))
    return wide.groupBy("b", "d", "f").agg(F.count("*").alias("n"), F.min("sci").alias("first"))


@query("""WITH e AS (SELECT user_id AS config, event_id AS pos, CASE WHEN event_id % 97 = 0 THEN 999 WHEN event_id % 31 = 0 THEN 100 * (event_id % 4 + 1) ELSE 100 * (event_id % 4 + 1) + event_id % 9 + 1 END AS code FROM events),
 l AS (SELECT a.* FROM e a WHERE code <> 999 AND code % 100 <> 0 AND NOT EXISTS (SELECT 1 FROM e b WHERE b.config = a.config AND b.pos > a.pos AND (b.code = 999 OR b.code % 100 = 0 AND b.code // 100 = a.code // 100)))
 SELECT config, string_agg(DISTINCT CAST(code AS VARCHAR), ',' ORDER BY CAST(code AS VARCHAR)) AS codes, arg_min(code, pos) FILTER (WHERE pos % 5 = 0) AS first_error FROM l GROUP BY config""")
def a34_warning_codes(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id AS config", "event_id AS pos", "event_id % 5 = 0 AS error", "CASE WHEN event_id % 97 = 0 THEN 999 WHEN event_id % 31 = 0 THEN 100 * (event_id % 4 + 1) ELSE 100 * (event_id % 4 + 1) + event_id % 9 + 1 END AS code")
    return lineage.latest_codes(e).select("config", F.array_join(F.transform("codes", lambda c: c.cast("string")), ",").alias("codes"), "first_error")


def _reason(c: str) -> str:
    """SQL of why the config row c can't run."""
    return f"CASE WHEN {c}.id IS NULL THEN 'no config of this name' WHEN {c}.sanity = false THEN 'rejected by hand' WHEN coalesce({c}.config_file, '') = '' OR NOT coalesce({c}.config_exists, false) THEN 'config file is missing' WHEN starts_with({c}.config_file, '/home/') THEN 'config file is in a home folder' END"


@query("WITH RECURSIVE " + with_("cyclic_edges", "image_qa", "process_status", "configs", "config_deps")[5:] + f""", seed AS (SELECT unnest([1, 2, 3, 5, -7]) AS id),
 c(id, depth) AS (SELECT seed.id, 0 FROM seed JOIN image_qa USING (id) UNION SELECT e.derived, c.depth + 1 FROM c JOIN cyclic_edges e ON e.source = c.id WHERE c.depth < 12),
 hit AS MATERIALIZED (SELECT i.*, concat(nightdate, '_', unit) AS stem FROM (SELECT id FROM c GROUP BY id HAVING min(depth) > 0) m JOIN image_qa i USING (id)),
 stem AS MATERIALIZED (SELECT s.stem, {_reason('p')} AS reason FROM (SELECT DISTINCT stem FROM hit) s LEFT JOIN configs p ON p.name = s.stem AND p.config_type = 'preprocess'),
 b(id, depth) AS (SELECT h.id, 0 FROM hit h JOIN stem USING (stem) WHERE image_type <> 'science' AND reason IS NOT NULL UNION SELECT e.derived, b.depth + 1 FROM b JOIN cyclic_edges e ON e.source = b.id WHERE b.depth < 12),
 h AS MATERIALIZED (SELECT *, id IN (SELECT id FROM b) AS old FROM hit),
 one AS (SELECT stem, 1 AS phase, min(CASE image_type WHEN 'bias' THEN 1 WHEN 'dark' THEN 2 ELSE 3 END) AS sweep, count(*) AS images, count(*) FILTER (WHERE old) AS stale FROM h WHERE image_type <> 'science' GROUP BY stem),
 singles AS (SELECT stem, 2 AS phase, CAST(NULL AS INT) AS sweep, count(*) AS images, count(*) FILTER (WHERE old) AS stale FROM h WHERE image_type = 'science' GROUP BY stem),
 two AS (SELECT * FROM singles UNION ALL SELECT stem, 2, NULL, 0, 0 FROM one JOIN stem USING (stem) WHERE reason IS NULL AND stem NOT IN (SELECT stem FROM singles)),
 early AS (SELECT x.*, reason, CASE WHEN reason IS NOT NULL THEN 'blocked' END AS state FROM (SELECT * FROM one UNION ALL SELECT * FROM two) x JOIN stem USING (stem)),
 own AS (SELECT process_status_id AS id, count(*) AS images, count(*) FILTER (WHERE old) AS stale FROM h WHERE image_type = 'science' GROUP BY 1),
 also AS (SELECT id, 0, 0 FROM configs s WHERE config_type = 'science' AND id NOT IN (SELECT id FROM own) AND name IN (SELECT derived FROM config_deps JOIN two ON stem = source JOIN stem USING (stem) WHERE reason IS NULL)
  AND EXISTS (SELECT 1 FROM image_qa i WHERE i.process_status_id = s.id AND image_type = 'science' AND NOT EXISTS (SELECT 1 FROM cyclic_edges e WHERE e.derived = i.id))),
 late AS (SELECT s.name, CASE WHEN s.nightdate IS NULL THEN 4 ELSE 3 END AS phase, CAST(NULL AS INT), images, stale, {_reason('s')} AS reason, CASE WHEN {_reason('s')} IS NOT NULL THEN 'skip' END FROM (SELECT * FROM own UNION ALL SELECT * FROM also) o JOIN configs s ON s.id = o.id AND config_type = 'science'),
 r AS (SELECT * FROM early UNION ALL SELECT * FROM late UNION ALL SELECT CAST(id AS VARCHAR), NULL, NULL, 0, 0, 'no such image', 'skip' FROM seed WHERE id NOT IN (SELECT id FROM image_qa))
 SELECT stem AS config, CAST(phase AS INT) AS phase, CAST(sweep AS INT) AS sweep, coalesce(state, CASE WHEN images > 0 AND stale = images THEN 'stale' ELSE 'run' END) AS state, coalesce(reason, CASE WHEN images > 0 AND stale = images THEN 'below a blocked master' END) AS reason, images, stale FROM r""")
def t2_phased_cascade(spark, sf):
    """Masters, preprocess, nightly and multi-night science below remade masters, on a graph with cycles and blocked configs."""
    e, i, c, d = (table(spark, sf, n) for n in ("cyclic_edges", "image_qa", "configs", "config_deps"))
    seeds = spark.createDataFrame([(x,) for x in (1, 2, 3, 5, -7)], "id long")
    return lineage.phased_cascade(e, i, c, d, seeds)


@query(BASE + """, x AS (SELECT id, CASE WHEN id % 3 = 0 THEN 'difference' WHEN id % 3 = 1 THEN 'coadd' ELSE 'difference without parents' END AS what FROM image_qa),
 u AS (SELECT id AS image, concat('s', id % 11) AS imageid, 'science' AS role FROM x WHERE what = 'difference' UNION ALL SELECT id, concat('r', id % 13), 'reference' FROM x WHERE what = 'difference' AND id % 2 = 0 UNION ALL SELECT id, concat('m', id % 7), 'input' FROM x WHERE what = 'coadd') SELECT image, imageid, role FROM u""")
def t4_direct_parents(spark, sf):
    """Differences name their parents; those that don't inherit cards that aren't theirs and get none."""
    i = table(spark, sf, "image_qa")
    kind = F.col("id") % 3
    name = F.when(kind == 1, "T00001_x_coadd.fits").otherwise("T00001_x_coadd_diff.fits")
    card = lambda k, test, v: F.create_map(F.lit(k), F.when(test, v))
    cards = F.map_concat(card("SCIIID", kind == 0, F.concat(F.lit(" s"), F.col("id") % 11)), card("REFIID", kind == 0, F.when(F.col("id") % 2 == 0, F.concat(F.lit("r"), F.col("id") % 13)).otherwise("  ")), card("IMG00001", F.lit(True), F.lit("T00001_single.fits")), card("IID00001", F.lit(True), F.concat(F.lit("m"), F.col("id") % 7)))
    return lineage.all_ingredients(i.select(F.col("id").alias("image"), name.alias("name"), F.map_filter(cards, lambda k, v: v.isNotNull()).alias("headers"))).select("image", "imageid", "role")


DECIDE = with_("exposures", "edges", "image_qa") + """, w AS (SELECT nightdate AS night, unit, kind, count(*) AS n_raw, min(image_id) AS output FROM exposures WHERE kind <> 'science' GROUP BY ALL),
 g AS (SELECT concat(night, '_', unit) AS grp, kind, CASE WHEN output % 41 = 0 THEN NULL ELSE output END AS output, CASE WHEN output % 5 = 0 THEN 0 ELSE n_raw END AS n_raw, output % 4 <> 0 AS there, night, unit FROM w),
 r AS (SELECT derived AS output, CASE WHEN bool_or(source_imageid <> imageid) THEN 'regenerated' WHEN bool_or(sanity = false) THEN 'sanity' ELSE 'none' END AS reason FROM edges JOIN image_qa i ON i.id = source GROUP BY derived),
 o AS (SELECT output, nullif(best, output) AS other FROM (SELECT a.output, arg_min(b.output, (b.output % 3 = 0, abs(b.night - a.night), b.night > a.night, b.output)) AS best FROM g a JOIN g b ON a.unit = b.unit AND a.kind = b.kind AND abs(b.night - a.night) <= 30 AND b.there WHERE a.output IS NOT NULL AND b.output IS NOT NULL GROUP BY a.output))"""


@query(DECIDE + """, j AS (SELECT g.*, CASE WHEN output % 37 = 0 THEN -output END AS given, n_raw > 0 AND (NOT there OR coalesce(reason, 'none') <> 'none') AS make, output % 3 = 0 AS bad, other FROM g LEFT JOIN r USING (output) LEFT JOIN o USING (output)),
 a AS (SELECT grp, kind, CASE WHEN given IS NOT NULL THEN 'adopt' WHEN output IS NULL THEN 'none' WHEN make AND NOT bad THEN 'generate' WHEN make AND bad AND other IS NOT NULL THEN 'fetch another' WHEN NOT (make AND bad) AND there THEN 'fetch' WHEN other IS NOT NULL THEN 'fetch another' ELSE 'missing' END AS action, given, output, other FROM j)
 SELECT grp AS "group", kind, action, CASE action WHEN 'adopt' THEN given WHEN 'generate' THEN output WHEN 'fetch' THEN output WHEN 'fetch another' THEN other END AS master FROM a""")
def t10_master_decisions(spark, sf):
    """Adopt, generate or fetch each night's masters; what fails its QA is replaced by the nearest sane night's."""
    e = table(spark, sf, "exposures").where("kind <> 'science'").groupBy("nightdate", "unit", "kind").agg(F.count("*").alias("n"), F.min("image_id").alias("o"))
    wanted = e.select(F.concat_ws("_", F.col("nightdate").cast("string"), "unit").alias("group"), "kind", F.when(F.col("o") % 41 != 0, F.col("o")).alias("output"), F.when(F.col("o") % 5 == 0, 0).otherwise(F.col("n")).alias("n_raw"), (F.col("o") % 4 != 0).alias("exists"), "nightdate", "unit")
    given = wanted.where("output % 37 = 0").select("group", "kind", (-F.col("output")).alias("master"))
    edges, images = table(spark, sf, "edges"), table(spark, sf, "image_qa")
    none = images.limit(0)
    reasons = lineage.rebuild_reason(edges, images, none.select(F.col("id").alias("source")), none.select(F.col("id").alias("derived"))).withColumnRenamed("derived", "output")
    there = wanted.where("exists AND output IS NOT NULL")
    same = [F.concat_ws("_", "unit", "kind").alias("unit"), F.lit("x").alias("filt"), F.lit(1).alias("n_binning"), "nightdate"]
    masters = there.select(F.col("output").alias("master"), *same, F.lit(0).alias("exptime"), (F.col("output") % 3 != 0).alias("sane"), F.lit(False).alias("lenient"))
    ask = wanted.where("output IS NOT NULL").select(F.col("output").alias("req"), *same, *(F.lit(None).cast("date").alias(c) for c in ("wall_from", "wall_to")))
    other = inventory.relaxed_search(ask, masters, 30, future=True).where("req <> master").select(F.col("req").alias("output"), "master")
    verdicts = wanted.select("output", (F.col("output") % 3 != 0).alias("ok"))
    return lineage.master_decisions(wanted, given, reasons, verdicts, other)


@query(BASE + """, t AS (SELECT id, nightdate FROM image_qa i WHERE image_type IN ('science', 'flat') AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.derived = i.id) AND nightdate >= DATE '1993-01-01' ORDER BY nightdate DESC NULLS LAST, id DESC LIMIT 500),
 s AS (SELECT DISTINCT source AS id FROM edges e JOIN image_qa i ON i.id = e.source WHERE source_imageid IS NOT NULL AND source_imageid <> i.imageid) SELECT id, 'backfill' AS why FROM t UNION ALL SELECT id, 'stale edge' FROM s UNION ALL SELECT id, 'config' FROM image_qa WHERE process_status_id = 7 AND image_type <> 'science'""")
def t9_targets_and_seeds(spark, sf):
    """What to give edges (at most 500, latest night first), and where an impact search may start: stale edges, or one config's masters."""
    e, i, _ = _all(spark, sf)
    parts = [lineage.backfill_targets(e, i, ["science", "flat"], "1993-01-01", limit=500).select("id", F.lit("backfill").alias("why")), lineage.seeds_from_staleness(e, i).withColumn("why", F.lit("stale edge")), lineage.seeds_from_config(i, 7).withColumn("why", F.lit("config"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])

"""Queries: arrivals in their batch form, and the streams run to the end over the same events."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.fixtures import table, with_
from starloom.plans.registry import query
from starloom.storage import durable, new_folder
from starloom.streaming import arrivals

EXPOSURES = with_("exposures")
ARR = EXPOSURES + """, a AS (SELECT CAST(nightdate AS VARCHAR) AS nightdate, concat('b', image_id % 4) AS batch_key, image_id % 50 = 7 AS is_too, ts, concat('/SU01/', image_id, '.fits') AS path FROM exposures),
 m AS (SELECT DISTINCT nightdate, batch_key FROM a WHERE NOT is_too AND nightdate <> '2024-01-10' UNION ALL SELECT '2024-01-12', 'never'),
 ready AS (SELECT nightdate, CASE WHEN count(m.batch_key) = 0 THEN min(b) WHEN count(t) = count(m.batch_key) THEN max(t) END AS ready FROM (SELECT nightdate, min(ts) AS b FROM a GROUP BY 1) n LEFT JOIN m USING (nightdate)
 LEFT JOIN (SELECT nightdate, batch_key, min(ts) AS t FROM a WHERE NOT is_too GROUP BY 1, 2) f USING (nightdate, batch_key) GROUP BY 1),
 r AS (SELECT nightdate, greatest(ts, ready) AS rt, count(*) AS k FROM a JOIN ready USING (nightdate) WHERE ready IS NOT NULL GROUP BY 1, 2), o AS (SELECT nightdate, rt, row_number() OVER w AS release_no, sum(k) OVER w AS n_files FROM r WINDOW w AS (PARTITION BY nightdate ORDER BY rt))"""
SLICES = 4
LAST = " SELECT nightdate, max(release_no) AS releases, CAST(max(n_files) AS BIGINT) AS n_files, CAST(min(n_files) AS BIGINT) AS first_files FROM o GROUP BY nightdate"


def _sides(spark, sf):
    a = table(spark, sf, "exposures").select(F.concat(F.lit("/SU01/"), "image_id", F.lit(".fits")).alias("path"), "unit", F.col("nightdate").cast("string").alias("nightdate"), F.concat(F.lit("b"), F.col("image_id") % 4).alias("batch_key"), (F.col("image_id") % 50 == 7).alias("is_too"), F.col("ts").cast("timestamp").alias("ts"))
    m = a.where("NOT is_too AND nightdate <> '2024-01-10'").select("nightdate", "batch_key").distinct()
    return a, m.unionByName(m.limit(1).select(F.lit("2024-01-12").alias("nightdate"), F.lit("never").alias("batch_key")))


def _run(stream, folder):
    """What a stream writes until it has no more input, read back."""
    q = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def _through_stream(spark, rows, step):
    """rows (ts, ...) written as SLICES files in order of time and read as a stream, one file in each micro-batch."""
    folder = new_folder(spark)
    rows = durable(rows)
    begin, end = rows.agg(F.min("ts").cast("double"), F.max("ts").cast("double")).first()
    at = F.least(F.lit(SLICES - 1), F.floor((F.col("ts").cast("double") - begin) / max(end - begin, 1.0) * SLICES))
    for k in range(SLICES):
        rows.where(at == k).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return _run(step(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")), folder)


def _summary(releases):
    return releases.groupBy("nightdate").agg(F.max("release_no").alias("releases"), F.max("n_files").alias("n_files"), F.min("n_files").alias("first_files"))


@query(ARR + LAST)
def r3_r4_gate_batch(spark, sf):
    return _summary(arrivals.gate_batch(*_sides(spark, sf)))


@query(ARR + LAST)
def r3_r4_gate_stream(spark, sf):
    """Arrivals come in SLICES files in order of time, one in each micro-batch, so the nights' state crosses batches."""
    a, m = _sides(spark, sf)
    m = durable(m)
    return _summary(_through_stream(spark, a, lambda s: arrivals.gate_stream(s, m)))


@query(ARR + " SELECT m.* FROM m ANTI JOIN (SELECT * FROM a WHERE NOT is_too) b USING (nightdate, batch_key)")
def u4_missing_batches(spark, sf):
    return arrivals.missing_batches(*_sides(spark, sf))


@query(ARR + """, g AS (SELECT ts, path, CASE WHEN ts - lag(ts) OVER (ORDER BY ts) < INTERVAL 600 SECONDS THEN 0 ELSE 1 END AS n FROM a), s AS (SELECT *, sum(n) OVER (ORDER BY ts) AS s FROM g) SELECT strftime(min(ts), '%Y%m%d_%H%M%S') AS start, count(*) AS n FROM s GROUP BY s""")
def r2_debounce(spark, sf):
    a, _ = _sides(spark, sf)
    return arrivals.debounce(a, "600 seconds").select(F.date_format("start", "yyyyMMdd_HHmmss").alias("start"), "n")


@query(EXPOSURES + """, g AS (SELECT unit, nightdate, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 600 SECONDS THEN 0 ELSE 1 END AS n FROM exposures WINDOW w AS (PARTITION BY unit, nightdate ORDER BY ts)), s AS (SELECT *, sum(n) OVER (PARTITION BY unit, nightdate ORDER BY ts) AS s FROM g)
 SELECT unit, CAST(nightdate AS VARCHAR) AS nightdate, strftime(min(ts), '%Y%m%d_%H%M%S') AS start, count(*) AS n FROM s GROUP BY unit, nightdate, s""")
def r2_debounce_by_night(spark, sf):
    """Each unit and night by itself, so that tasks share the arrivals."""
    a, _ = _sides(spark, sf)
    return arrivals.debounce(a, "600 seconds", keys=("unit", "nightdate")).select("unit", "nightdate", F.date_format("start", "yyyyMMdd_HHmmss").alias("start"), "n")


@query(ARR + """, g AS (SELECT ts, CASE WHEN ts - lag(ts) OVER (ORDER BY ts) < INTERVAL 600 SECONDS THEN 0 ELSE 1 END AS n FROM a), s AS (SELECT *, sum(n) OVER (ORDER BY ts) AS s FROM g)
 SELECT strftime(min(ts), '%Y%m%d_%H%M%S') AS start, count(*) AS n FROM s GROUP BY s HAVING max(ts) + INTERVAL 600 SECONDS <= (SELECT max(ts) FROM a) - INTERVAL 30 SECONDS""")
def r2_debounce_stream(spark, sf):
    """The sessions that the watermark has passed by the end."""
    a, _ = _sides(spark, sf)
    done = _through_stream(spark, a.select("path", "ts"), lambda s: arrivals.debounce(s, "600 seconds", "30 seconds").drop("paths"))
    return done.select(F.date_format("start", "yyyyMMdd_HHmmss").alias("start"), "n")


@query(EXPOSURES + ", u AS (SELECT DISTINCT unit, filt FROM exposures) SELECT unit, filt FROM u WHERE filt <> 'i'")
def r1_new_files(spark, sf):
    """Files by unit and filter, of which all but those of one filter get the wanted suffix, seen by a stream of new files."""
    folder = new_folder(spark)
    e = table(spark, sf, "exposures").select("unit", "filt", F.col("image_id").cast("string").alias("value"))
    e.repartition("unit", "filt").write.partitionBy("unit", "filt").text(f"{folder}/written")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.globStatus(path(f"{folder}/written/unit=*/filt=*/part-*")):  # one for each unit and filter
        unit, filt = (str(p).split("=")[1] for p in (f.getPath().getParent().getParent().getName(), f.getPath().getParent().getName()))
        fs.mkdirs(path(f"{folder}/{unit}"))
        fs.rename(f.getPath(), path(f"{folder}/{unit}/{filt}" + (".txt" if filt == "i" else ".fits")))
    seen = _run(arrivals.new_files(spark, folder), new_folder(spark))
    parts = F.split("path", "/")
    return seen.select(F.element_at(parts, -2).alias("unit"), F.regexp_replace(F.element_at(parts, -1), r"\.fits$", "").alias("filt"))


@query(ARR + " SELECT unit, count(*) AS n FROM (SELECT unit FROM exposures WHERE kind = 'bias' UNION ALL SELECT unit FROM exposures WHERE kind = 'flat' UNION ALL SELECT unit FROM exposures WHERE kind = 'science') GROUP BY unit")
def u5_union_of_types(spark, sf):
    e = table(spark, sf, "exposures")
    return e.where("kind = 'bias'").select("unit").unionByName(e.where("kind = 'flat'").select("unit")).unionByName(e.where("kind = 'science'").select("unit")).groupBy("unit").agg(F.count("*").alias("n"))


@query(with_("ref") + " SELECT source_id, arg_min(ra, src) AS ra, arg_min(mag, src) AS mag FROM (SELECT source_id, ra, mag, 1 AS src FROM ref WHERE source_id % 3 <> 0 UNION ALL SELECT source_id, ra + 1, NULL, 2 FROM ref WHERE source_id % 2 = 0) GROUP BY source_id")
def s6_u1_stack_unique(spark, sf):
    from starloom.sources.files import stack_catalogs

    r = table(spark, sf, "ref").select("source_id", "ra", "mag")
    a = r.where("source_id % 3 <> 0").withColumn("src", F.lit(1))
    b = r.where("source_id % 2 = 0").select("source_id", (F.col("ra") + 1).alias("ra"), F.lit(2).alias("src"))
    return stack_catalogs(a, b, key="source_id", order="src").select("source_id", "ra", F.when(F.col("src") == 1, F.col("mag")).alias("mag"))

"""Frames, groups and associations: which files belong together, and what was valid when."""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.storage import durable

#: Fewest raw calibration frames for a master.
NUM_MIN_CALIB = 5
#: Keys on which calibration frames must agree with science frames.
KEYS = {"bias": ["nightdate", "unit", "gain", "n_binning", "camera"], "dark": ["nightdate", "unit", "gain", "n_binning", "camera", "exptime"], "flat": ["nightdate", "unit", "gain", "n_binning", "camera", "filt"]}


TILE = r"T\d+"
"""A name of this form is a tile's."""


def frame_query(frames: DataFrame, *, dates=None, start=None, end=None, days: int | None = None, now: str | None = None, units=None, filters=None, kinds=None, targets=None, tile: str | None = None, name_like: str | None = None, exptime: tuple[float, float] | None = None, binning=None, gain=None, camera=None, **flags) -> DataFrame:
    """Frames under all of the conditions that are given; lists mean one of them.

    targets: names; those of the form of a tile's name are looked for in the column `tile` (if one is named) and the others
    in obj, and either may hold. Targets without kinds mean science frames. days: nights from that many days before now (a
    date; today if not given), in place of start and end. flags: further columns by value (usable=True, version=2, ...)."""
    tests: list[Column] = []

    def among(column: str, wanted) -> Column:
        wanted = list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]
        return F.col(column).cast("string").isin([str(x).lower() if isinstance(x, bool) else str(x) for x in wanted])

    if targets is not None and kinds is None:
        kinds = "science"
    for column, wanted in {"nightdate": dates, "unit": units, "filt": filters, "kind": kinds, "n_binning": binning, "gain": gain, "camera": camera, **flags}.items():
        if wanted is not None:
            tests.append(among(column, wanted))
    if targets is not None:
        names = [targets] if isinstance(targets, str) else list(targets)
        tiles = [t for t in names if tile and re.fullmatch(TILE, t)]
        either = [among(c, x) for c, x in (("obj", [t for t in names if t not in tiles]), (tile, tiles)) if x]
        tests.append(functools.reduce(operator.or_, either, F.lit(False)))
    if days is not None:
        tests.append(F.col("nightdate") >= F.date_sub(F.lit(now).cast("date") if now else F.current_date(), days))
    else:
        if start is not None:
            tests.append(F.col("nightdate") >= F.lit(start).cast("date"))
        if end is not None:
            tests.append(F.col("nightdate") <= F.lit(end).cast("date"))
    if name_like is not None:
        tests.append(F.col("obj").ilike(f"%{name_like}%"))
    if exptime is not None:
        tests.append(F.col("exptime").between(*exptime))
    return frames.where(functools.reduce(operator.and_, tests)) if tests else frames


def groups(frames: DataFrame, keys: list[str], key: str = "image_id") -> DataFrame:
    """(keys, n, files): frames grouped by type and parameters, with their sorted ids."""
    return frames.groupBy(*keys).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(key)).alias("files"))


def science_groups(frames: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, units, n, multi, place): science frames over all units, and the order of processing: most units, then most
    frames, then by key."""
    g = frames.where("kind = 'science'").groupBy(*keys).agg(F.count_distinct("unit").alias("units"), F.count("*").alias("n"))
    place = F.row_number().over(W.orderBy(F.desc("units"), F.desc("n"), *keys))  # a row per group of frames
    return g.select(*keys, "units", "n", (F.col("units") > 1).alias("multi"), place.alias("place"))


def associate(science: DataFrame, calib: DataFrame, kind: str, group: str = "group") -> DataFrame:
    """(science group, calibration group) equal on the keys of the kind; a missing key equals a missing key."""
    c = calib.select(F.col(group).alias("calib"), *[F.col(k).alias(f"_{k}") for k in KEYS[kind]])
    same = functools.reduce(operator.and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS[kind]))
    return science.join(c, same).select(F.col(group).alias("science"), "calib")


def validity(log: DataFrame, keys: list[str], at: str = "nightdate") -> DataFrame:
    """Adds until: the day before the next entry of the same keys; null for the last. Every entry is a wall."""
    return log.withColumn("until", F.date_sub(F.lead(at).over(W.partitionBy(*keys).orderBy(at)), 1))


def preprocess_plan(frames: DataFrame) -> DataFrame:
    """(place, nightdate, unit, gain, n_binning, camera, exptime, filt, n_sci, n_bias, n_dark, n_flat, lone) from frames (kind and KEYS).

    A row for each distinct triple of calibration groups that science frames resolve to, largest number of science frames
    first; groups of under NUM_MIN_CALIB raw frames count 0, as their master is searched instead. Then the calibration
    groups of at least that many frames that no science frame resolves to (lone: their kind)."""
    every = ["nightdate", "unit", "gain", "n_binning", "camera", "exptime", "filt"]
    plan = frames.where("kind = 'science'").groupBy(*every).agg(F.count("*").alias("n_sci")).withColumn("lone", F.lit(None).cast("string"))
    alone = []
    for kind, keys in KEYS.items():
        calib = frames.where(F.col("kind") == kind).groupBy(*keys).agg(F.count("*").alias("_n")).withColumnsRenamed({k: f"_{k}" for k in keys})
        same = functools.reduce(operator.and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
        unused = calib.where(F.col("_n") >= NUM_MIN_CALIB).join(plan.select(*keys).distinct(), same, "left_anti")
        dtypes = dict(frames.dtypes)
        alone.append(unused.select(*[F.col(f"_{k}").alias(k) if k in keys else F.lit(None).cast(dtypes[k]).alias(k) for k in every], F.lit(0).cast("long").alias("n_sci"), F.lit(kind).alias("lone"), *[(F.col("_n") if k == kind else F.lit(0).cast("long")).alias(f"n_{k}") for k in KEYS]))
        n = F.when(F.col("_n") >= NUM_MIN_CALIB, F.col("_n")).otherwise(0).alias(f"n_{kind}")
        plan = plan.join(calib, same, "left").select(*[c for c in plan.columns], n)
    whole = functools.reduce(DataFrame.unionByName, alone, plan)
    place = F.row_number().over(W.orderBy(F.col("lone").isNotNull(), F.desc("n_sci"), "lone", *every))  # a row per group of frames
    return whole.withColumn("place", place)


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, value: str, default: Column | None = None, bucket=None) -> DataFrame:
    """left with `value` of the latest right row at or before left_at per keys; ties by the larger value.

    Both sides are laid in one order per key, each time of left once, and the last right row is carried forward, so no pairs
    are made. bucket(column): a coarser time (a day for a timestamp); then a task holds a key's bucket at most, and what
    earlier buckets hand on comes from one row for each bucket."""
    step = bucket or (lambda c: F.lit(0))
    latest = F.max(F.struct(F.col(right_at).alias("t"), F.col(value).alias("v")))
    r = right.where(F.col(right_at).isNotNull()).withColumn("_b", step(F.col(right_at))).groupBy(*keys, "_b", F.col(right_at).alias("_at")).agg(latest.alias("_r")).withColumn("_side", F.lit(0))
    points = left.select(*keys, F.col(left_at).alias("_at")).distinct().withColumns({"_b": step(F.col("_at")), "_side": F.lit(1)})
    w = W.partitionBy(*keys, "_b").orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, 0)
    found = points.unionByName(r, allowMissingColumns=True).withColumn("_l", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    if bucket:
        ends = r.groupBy(*keys, "_b").agg(F.max("_r").alias("_e")).unionByName(points.select(*keys, "_b").distinct(), allowMissingColumns=True).groupBy(*keys, "_b").agg(F.max("_e").alias("_e"))
        before = ends.withColumn("_h", F.last("_e", ignorenulls=True).over(W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)))
        same = functools.reduce(operator.and_, (found[k].eqNullSafe(before[k]) for k in [*keys, "_b"]))
        found = found.join(before, same).select(*[found[k] for k in keys], "_at", F.coalesce("_l", "_h").alias("_l"))
    found = found.select(*[F.col(k).alias(f"_{k}") for k in keys], "_at", "_l")
    back = functools.reduce(operator.and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys), F.col(left_at).eqNullSafe(F.col("_at")))
    v = F.col("_l.v")
    return left.join(found, back).select(*left.columns, (F.coalesce(v, default) if default is not None else v).alias(value))


def relaxed_search(requests: DataFrame, masters: DataFrame, window: int = 30, future: bool = False) -> DataFrame:
    """For each request (req, unit, filt, n_binning, nightdate, wall_from, wall_to) the master (master, unit, filt, n_binning, nightdate, exptime, sane, lenient) to use.

    A master of a night within the window counts if it is the one of least exposure time of its day (per unit, filter,
    binning and leniency), chosen before its sanity is looked at. The order of preference is: inside the walls before
    outside, strict keys before lenient, sane before not, equal binning before not, then the nearest night, the past
    before the future. Returns req, master, days, and the bits of what was relaxed: 1 night, 4 sanity, 8 keys, 16 wall.

    Equal requests are searched once, and met with the days in the window's own stretches of time only."""
    kind = F.struct("unit", "filt", "n_binning", "nightdate", "wall_from", "wall_to")
    stretch = lambda c: F.floor(F.datediff(c, F.lit("2000-01-01").cast("date")) / (window + 1))
    day = masters.groupBy("unit", "filt", "n_binning", "lenient", "nightdate").agg(F.min(F.struct("exptime", "master", "sane")).alias("m"))
    day = day.select("unit", "filt", F.col("n_binning").alias("mb"), "lenient", F.col("nightdate").alias("mn"), F.col("m.master").alias("master"), F.col("m.sane").alias("sane")).withColumn("stretch", stretch(F.col("mn")))
    asked = requests.select(kind.alias("kind")).distinct().select("kind", "kind.*")
    asked = asked.withColumn("stretch", F.explode(F.sequence(stretch(F.date_sub("nightdate", window)), stretch(F.date_add("nightdate", window if future else 0)))))
    j = asked.join(day, ["unit", "filt", "stretch"]).withColumn("days", F.datediff("mn", "nightdate"))
    j = j.where(F.col("days").between(-window, window if future else 0))
    wall = ~(F.col("mn").between(F.coalesce("wall_from", F.lit("0001-01-01").cast("date")), F.coalesce("wall_to", F.lit("9999-12-31").cast("date"))))
    rank = F.struct(wall.alias("wall"), F.col("lenient").alias("lenient"), (~F.coalesce("sane", F.lit(True))).alias("insane"), (F.col("mb") != F.col("n_binning")).alias("binning"), F.abs("days").alias("far"), (F.col("days") > 0).alias("after"), F.col("master").alias("master"), F.col("days").alias("days"))
    best = j.groupBy("kind").agg(F.min(rank).alias("b"))
    bit = lambda c, b: F.when(c, b).otherwise(0)
    b = F.col("b")
    found = requests.select("req", kind.alias("kind")).join(best, "kind")
    return found.select("req", b["master"].alias("master"), b["days"].alias("days"), (bit(b["days"] != 0, 1) + bit(b["insane"], 4) + bit(b["lenient"], 8) + bit(b["wall"], 16)).alias("ppflag"))


def nearest_night(requests: DataFrame, rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """requests (keys, nightdate) with `value` of the night of rows nearest to theirs; of two as near, and of several rows
    of a night, the least value. One row before and one after each night are looked at, so there are no pairs."""
    night = rows.groupBy(*keys, "nightdate").agg(F.min(value).alias("_v")).withColumn("_back", -F.datediff("nightdate", F.lit("1970-01-01").cast("date")))
    night = night.withColumn("_past", F.struct((-F.col("_back")).alias("n"), "_v")).withColumn("_next", F.struct((-F.col("_back")).alias("n"), "_v"))
    at = requests.withColumn("_on", F.datediff("nightdate", F.lit("1970-01-01").cast("date"))).withColumn("_off", -F.col("_on"))
    found = as_of(at, night.withColumn("_day", -F.col("_back")), keys, "_on", "_day", "_past")
    found = as_of(found, night, keys, "_off", "_back", "_next")
    near = [F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}.n") - F.col("_on")).alias("far"), F.col(f"{c}._v").alias("v"))) for c in ("_past", "_next")]
    return found.withColumn(value, F.least(*near)["v"]).select(*requests.columns, value)


def too_match(obs: DataFrame, too: DataFrame, identifiers: dict[str, str] | None = None, anyone: bool = False) -> DataFrame:
    """(image_id, too_id) for observations (image_id, ts, ...) that have one of requests (id, trigger_time, ...).

    identifiers: column of obs -> column of too, tried in this order (a tile before an object's name): the latest request of
    the same day, else the latest before the observation. anyone: where none is found, the latest of all before it."""
    day = F.to_date
    rows = obs
    steps = list((identifiers or {"obj": "objname"}).items())
    for i, (mine, theirs) in enumerate(steps):
        t = too.where(F.col(theirs).isNotNull()).select(F.col(theirs).alias(mine), F.col("id").alias("_id"), "trigger_time")
        same = t.groupBy(mine, day("trigger_time").alias("_day")).agg(F.max(F.struct("trigger_time", "_id"))["_id"].alias(f"_same{i}"))
        rows = rows.withColumn("_day", day("ts")).join(same, [mine, "_day"], "left").drop("_day")
        rows = as_of(rows, t.withColumn(f"_past{i}", F.col("_id")), [mine], "ts", "trigger_time", f"_past{i}", bucket=day)
    found = [F.col(c) for i in range(len(steps)) for c in (f"_same{i}", f"_past{i}")]
    if anyone:
        rows = as_of(rows, too.withColumn("_any", F.col("id")), [], "ts", "trigger_time", "_any", bucket=day)
        found.append(F.col("_any"))
    return rows.select("image_id", F.coalesce(*found).alias("too_id")).where("too_id IS NOT NULL")


def header_aggregate(df: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """One value per column and group: the common one; the mean of differing numbers; MIXED for differing strings; null if a value is missing among differing ones."""
    out = []
    for c in columns:
        numeric = dict(df.dtypes)[c] not in ("string", "boolean")
        same = F.count_distinct(c) == 1
        first = F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).cast("string")
        mixed = F.round(F.avg(c), 6).cast("string") if numeric else F.lit("MIXED")
        out.append(F.when(same, first).when(F.count(c) == F.count("*"), mixed).alias(c))
    return df.groupBy(*keys).agg(*out)


def upsert(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of both: for a key in both, fields of the newest row that are not null win, and the text None clears a field."""
    values = [c for c in old.columns if c != key]
    both = old.withColumns({"_age": F.lit(0), order: F.col(order)}).unionByName(new.withColumn("_age", F.lit(1)))
    rank = F.when(F.lit(True), F.struct("_age", order))
    out = []
    for c in values:
        is_text = dict(old.dtypes)[c] == "string"
        latest = F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank))
        out.append((F.when(latest == "None", None).otherwise(latest) if is_text else latest).alias(c))
    return both.groupBy(key).agg(*out)


def upsert_by_path(old: DataFrame, new: DataFrame, order: str, key: str = "id", name: str = "image_name", path: str = "image_path") -> DataFrame:
    """upsert() by name and path: a new row without a path goes to the name's first row; one with a path to the row of that
    path, else to a row of the name that has no path yet (the first new path to the first such row), else it is added with
    the next free keys. The rows without a path are applied before the others; rows without a name are added each."""
    ranked = new.withColumn("_new", F.struct(order, F.xxhash64(*new.columns)))
    named = ranked.where(F.col(name).isNotNull())
    rows = old.select(key, F.col(name), F.col(path))
    first = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(key).alias("_to"))
    bare = named.where(F.col(path).isNull()).join(first, name, "left")
    placed = named.where(F.col(path).isNotNull()).join(rows.where(F.col(path).isNotNull()).groupBy(name, path).agg(F.min(key).alias("_to")), [name, path], "left")
    # the paths that no row has, in order of their first arrival, take the rows without a path in order of their keys
    w = W.partitionBy(name)
    fresh = placed.where("_to IS NULL").groupBy(name, path).agg(F.min("_new").alias("_first")).withColumn("_k", F.row_number().over(w.orderBy("_first")))
    free = rows.where(F.col(name).isNotNull() & F.col(path).isNull()).withColumn("_k", F.row_number().over(w.orderBy(key))).select(name, "_k", F.col(key).alias("_to2"))
    taken = fresh.join(free, [name, "_k"], "left").select(name, path, "_to2")
    placed = placed.join(taken, [name, path], "left").withColumn("_to", F.coalesce("_to", "_to2")).drop("_to2")
    both = bare.unionByName(placed).unionByName(ranked.where(F.col(name).isNull()), allowMissingColumns=True)
    # what goes to no row is one added row for each name and path
    missing = F.when(F.col("_to").isNull(), F.when(F.col(name).isNull(), F.concat_ws(":", F.lit("r"), F.xxhash64("_new").cast("string"))).otherwise(F.concat_ws(":", F.lit("n"), name, F.coalesce(F.concat(F.lit("p"), path), F.lit("")))))
    both = both.withColumn("_added", missing)
    top = old.agg(F.coalesce(F.max(key), F.lit(0)).alias("_top"))  # one row
    added = both.where("_added IS NOT NULL").groupBy("_added").agg(F.min("_new").alias("_first")).transform(lambda d: numbered(d, "_first", "_n")).crossJoin(F.broadcast(top)).select("_added", (F.col("_n") + F.col("_top")).alias("_to3"))
    both = both.join(added, "_added", "left").withColumn(key, F.coalesce("_to", "_to3").cast(dict(old.dtypes)[key]))
    return upsert(old, both.select(*old.columns), key, order)


def numbered(rows: DataFrame, order: str, name: str) -> DataFrame:
    """rows with their number from 1 in `order`, whose values differ. Ranges of values are numbered side by side, from the counts of those
    before, so no task sees all rows."""
    laid = durable(rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    before = laid.groupBy("_part").agg(F.count("*").alias("_c")).withColumn("_before", F.coalesce(F.sum("_c").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # a row per range
    return laid.join(F.broadcast(before.select("_part", "_before")), "_part").withColumn(name, F.row_number().over(W.partitionBy("_part").orderBy(order)) + F.col("_before")).drop("_part", "_before")


def reference_image(nights: DataFrame, coadds: DataFrame, before: int = 3, after: int = 2) -> DataFrame:
    """(obj, filt, nightdate, farthest, ref_night, base, paths) for nights (obj, filt, nightdate) and coadds (obj, filt, nightdate, base, path).

    Of the other nights of an object and filter the farthest (of two as far the later), and of the nights from `before` days ahead of it to
    `after` behind, the first, other than the night itself, that has coadds; of its bases the least. Null where none has, and no row
    without another night."""
    n = nights.select("obj", "filt", "nightdate").distinct()
    # the farthest other night is the first or the last of the group, so no pairs are needed
    ends = n.groupBy("obj", "filt").agg(F.min("nightdate").alias("_lo"), F.max("nightdate").alias("_hi")).where("_lo <> _hi")
    far = F.when(F.datediff("_hi", "nightdate") >= F.datediff("nightdate", "_lo"), F.col("_hi")).otherwise(F.col("_lo"))
    asked = n.join(ends, ["obj", "filt"]).select("obj", "filt", "nightdate", far.alias("farthest"))
    days = asked.withColumn("_at", F.explode(F.transform(F.sequence(F.lit(-before), F.lit(after)), lambda i: F.date_add("farthest", i)))).where("_at <> nightdate")
    have = coadds.groupBy("obj", "filt", F.col("nightdate").alias("_at"), "base").agg(F.sort_array(F.collect_list("path")).alias("paths"))  # the coadds of a night
    best = days.join(have, ["obj", "filt", "_at"]).groupBy("obj", "filt", "nightdate").agg(F.min(F.struct(F.col("_at").alias("ref_night"), "base", "paths")).alias("b"))
    return asked.join(best, ["obj", "filt", "nightdate"], "left").select("obj", "filt", "nightdate", "farthest", "b.ref_night", "b.base", "b.paths")


def names_of_paths(wanted: DataFrame, frames: DataFrame, order: str = "pos") -> DataFrame:
    """wanted (path) with the name of the frame (path, name, pos) of that path; the last in `order` of several, null if there is none.

    If any of the wanted has no folder, all are looked up by file name alone."""
    bare = not wanted.where(~F.contains("path", F.lit("/"))).isEmpty()
    key = (lambda c: F.substring_index(c, "/", -1)) if bare else F.col
    last = frames.groupBy(key("path").alias("_key")).agg(F.max_by("name", order).alias("name"))
    return wanted.withColumn("_key", key("path")).join(last, "_key", "left").drop("_key")


def backfill(rows: DataFrame, pairs: DataFrame, key: str, column: str, force: bool = False) -> DataFrame:
    """rows with `column` filled from pairs (key, column), where it is null unless forced."""
    p = pairs.select(key, F.col(column).alias("_new"))
    filled = F.coalesce("_new", column) if force else F.coalesce(column, "_new")
    return rows.join(p, key, "left").withColumn(column, filled).drop("_new")

"""The derivation graph: what an image came from, what depends on it, what is stale and what to make again.

edges: derived, source, role, source_imageid. Closures are frontier joins: each round joins the newly reached images to the
edges and drops those already reached, so a round costs what is new, and the first arrival has the least depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.functions.text import UNIT, type_tuple

from starloom.storage import discard, durable


def downstream(edges: DataFrame, seeds: DataFrame, max_depth: int = 12) -> DataFrame:
    """(id, depth): images reached from seeds (id) within max_depth steps, seeds at 0."""
    reached = durable(seeds.select("id").distinct().withColumn("depth", F.lit(0)))
    front = reached
    for depth in range(1, max_depth + 1):
        new = edges.join(front.select(F.col("id").alias("source")), "source").select(F.col("derived").alias("id")).distinct().join(reached, "id", "left_anti").withColumn("depth", F.lit(depth))
        front = durable(new)
        if front.isEmpty():
            break
        reached = reached.unionByName(front)
    return reached


def upstream(edges: DataFrame, seeds: DataFrame, max_depth: int = 12) -> DataFrame:
    """The same against the direction of the edges."""
    return downstream(edges.select(F.col("source").alias("derived"), F.col("derived").alias("source")), seeds, max_depth)


def stale_edges(edges: DataFrame, images: DataFrame) -> DataFrame:
    """Edges whose recorded source imageid is known and differs from the source's present one."""
    now = images.select(F.col("id").alias("source"), F.col("imageid").alias("current"))
    return edges.where("source_imageid IS NOT NULL").join(now, "source").where("source_imageid <> current")


def config_edges(edges: DataFrame, images: DataFrame) -> DataFrame:
    """(derived config, source config): the graph of images rolled up to their configs, distinct, without loops."""
    c = images.select("id", "process_status_id")
    d = edges.join(c.withColumnsRenamed({"id": "derived", "process_status_id": "derived_config"}), "derived").join(c.withColumnsRenamed({"id": "source", "process_status_id": "source_config"}), "source")
    return d.where("derived_config <> source_config").select("derived_config", "source_config").distinct()


def replace_dependencies(product: DataFrame, scheduled: DataFrame, old: DataFrame) -> DataFrame:
    """One role per pair: edges from products before scheduled ones; of old edges those of configs that neither names."""
    both = product.withColumn("rank", F.lit(0)).unionByName(scheduled.withColumn("rank", F.lit(1)))
    new = both.groupBy("derived", "source").agg(F.min(F.struct("rank", "role")).alias("m")).select("derived", "source", F.col("m.role").alias("role"))
    return new.unionByName(old.select("derived", "source", "role").join(new.select("derived").distinct(), "derived", "left_anti"))


def sync_edges(wanted: DataFrame, images: DataFrame) -> DataFrame:
    """(derived, source, role) from (derived, imageid, role): an imageid means the row with a path, then the lowest id."""
    best = images.groupBy("imageid").agg(F.min(F.struct(F.col("image_path").isNull().alias("p"), "id")).alias("m")).select("imageid", F.col("m.id").alias("source"))
    return wanted.join(best, "imageid").select("derived", "source", "role").distinct()


def parse_ingredients(cards: DataFrame, unit: str = UNIT) -> DataFrame:
    """(image, name, imageid, role) from header maps: numbered card pairs IMCMBnnn/IMCIDnnn and IMGnnnnn/IIDnnnnn, by number.

    The role follows the name; raw names and those without an id are dropped, and an imageid counts once."""
    e = cards.select("image", F.explode("headers").alias("k", "v")).where(r"k RLIKE '^(IMCMB|IMCID)\\d{3}$|^(IMG|IID)\\d{5}$'")
    e = e.select("image", F.regexp_extract("k", r"(\d+)$", 1).alias("n"), F.when(F.col("k").rlike("^(IMCMB|IMG)"), "name").otherwise("imageid").alias("what"), F.when(F.col("k").rlike("^IMC"), "a").otherwise("b").alias("family"), "v")
    p = e.groupBy("image", "family", "n").pivot("what", ["name", "imageid"]).agg(F.first("v")).where("name IS NOT NULL AND imageid IS NOT NULL").where(~F.col("name").rlike(f"^{unit}"))
    role = F.when(F.col("name").rlike("^bias"), "bias").when(F.col("name").rlike("^dark"), "dark").when(F.col("name").rlike("^flat"), "flat").otherwise("input")
    return p.groupBy("image", "imageid").agg(F.min_by("name", F.struct("family", "n")).alias("name"), F.min_by(role, F.struct("family", "n")).alias("role"))


DIRECT = (("SCIIID", "science"), ("REFIID", "reference"))
"""Fixed values: cards of a difference image that name its two parents."""


def all_ingredients(cards: DataFrame, unit: str = UNIT) -> DataFrame:
    """(image, imageid, role) from rows (image, name, headers): the parents named by SCIIID and REFIID, if any card of these is not
    blank; else nothing for a difference image (by its name), which inherits its science image's other cards; else parse_ingredients."""
    of = lambda k: F.nullif(F.trim(F.try_element_at("headers", F.lit(k))), F.lit(""))
    parents = F.filter(F.array(*(F.struct(of(k).alias("imageid"), F.lit(role).alias("role")) for k, role in DIRECT)), lambda p: p["imageid"].isNotNull())
    rows = cards.withColumn("_p", parents)
    direct = rows.select("image", F.explode("_p").alias("p")).select("image", "p.imageid", "p.role")
    plain = rows.where((F.size("_p") == 0) & ~F.coalesce(type_tuple(F.col("name"))["difference"], F.lit(False)))
    return direct.unionByName(parse_ingredients(plain, unit).select("image", "imageid", "role"))


def flags_up(edges: DataFrame, images: DataFrame) -> DataFrame:
    """(id, ppflag) by levels bias, dark, flat, science: the OR of the sources' flags, for science also 1 and 4 from nights and sanity."""
    flags = images.where("image_type = 'bias'").select("id", F.lit(0).alias("ppflag"))
    for kind in ("dark", "flat", "science"):
        mine = images.where(F.col("image_type") == kind).select(F.col("id").alias("derived"), F.col("nightdate").alias("night"))
        src = images.select(F.col("id").alias("source"), F.col("nightdate").alias("sn"), F.coalesce("sanity", F.lit(True)).alias("ok"))
        up = edges.join(mine, "derived").join(flags.select(F.col("id").alias("source"), "ppflag"), "source").join(src, "source")
        extra = F.when(F.bool_or(F.col("sn") != F.col("night")), 1).otherwise(0).bitwiseOR(F.when(F.bool_or(~F.col("ok")), 4).otherwise(0)) if kind == "science" else F.lit(0)
        got = up.groupBy("derived").agg(F.bit_or("ppflag").bitwiseOR(extra).alias("ppflag"))
        level = mine.join(got, "derived", "left").select(F.col("derived").alias("id"), F.coalesce("ppflag", F.lit(0)).alias("ppflag"))
        before, flags = flags, durable(flags.unionByName(level))
        discard(before)
    return flags


def cascade_plan(edges: DataFrame, images: DataFrame, status: DataFrame, seeds: DataFrame, max_depth: int = 12) -> DataFrame:
    """(config, action, depth, images) for the configs that a change of the seeds touches.

    Actions: master for those that make calibration images, preprocess, science or coadd by type, and skip with a
    missing config. Unknown seeds raise."""
    lost = seeds.select("id").join(images.select("id"), "id", "left_anti").limit(5).collect()
    if lost:
        raise ValueError(f"unknown images: {[r.id for r in lost]}")
    hit = downstream(edges, seeds, max_depth).where("depth > 0").join(images.select("id", "process_status_id", "image_type"), "id")
    per = hit.groupBy("process_status_id").agg(F.min("depth").alias("depth"), F.count("*").alias("images"), F.bool_or(F.col("image_type") != "science").alias("master"))
    s = status.select(F.col("id").alias("process_status_id"), "config_type", "config_exists")
    action = F.when(F.col("config_exists").isNull(), "skip: no config row").when(~F.col("config_exists"), "skip: config file is missing").when(F.col("master"), "master").otherwise(F.col("config_type"))
    return per.join(s, "process_status_id", "left").select(F.col("process_status_id").alias("config"), action.alias("action"), "depth", "images")


MASTERS = ("bias", "dark", "flat")
"""Fixed values: kinds of calibration masters in the order in which they are made."""


def blocked_reason(home: str = "/home/") -> Column:
    """Why a config row (id, sanity, config_file, config_exists) can't run; null if it can."""
    file = F.coalesce("config_file", F.lit(""))
    return (F.when(F.col("id").isNull(), "no config of this name").when(F.col("sanity") == F.lit(False), "rejected by hand").when((file == "") | ~F.coalesce("config_exists", F.lit(False)), "config file is missing")
            .when(F.startswith(file, F.lit(home)), "config file is in a home folder"))


def phased_cascade(edges: DataFrame, images: DataFrame, configs: DataFrame, config_deps: DataFrame, seeds: DataFrame, max_depth: int = 12) -> DataFrame:
    """(config, phase, sweep, state, reason, images, stale): what a set of regenerated images obliges, and in what order.

    images: id, image_type, process_status_id, nightdate, unit. configs: id, name, config_type, config_file, config_exists,
    nightdate, sanity. config_deps: derived, source (names). Phases: 1 masters below the seeds, remade by the preprocess config
    `<nightdate>_<unit>` (sweep: 1 to 3 for the first of bias, dark and flat that it makes), 2 the preprocess configs of single
    images below the seeds and those of phase 1, 3 the science configs of a night, and 4 those over several nights: they own
    something below the seeds, or depend on a config of phase 2 and have single images without any edge.

    A config that can't run is `blocked` in phases 1 and 2 and `skip` in 3 and 4, with the reason. A blocked master is a
    barrier: what lies below it can't become current; `stale` counts such images, and a config with no others is `stale`
    instead of `run`. Cycles end by depth. Seeds that no image has are rows in state `skip`; if none is known it is an error."""
    known = seeds.select("id").distinct().join(images.select("id"), "id", "left_semi")
    if known.isEmpty():
        raise ValueError("none of the seeds is a known image")
    unknown = seeds.select("id").distinct().join(images.select("id"), "id", "left_anti")
    what = images.select("id", "image_type", "process_status_id", F.col("nightdate").alias("night"), "unit")
    hit = durable(downstream(edges, known, max_depth).where("depth > 0").join(what, "id").withColumn("stem", F.concat_ws("_", F.col("night").cast("string"), "unit")))
    is_master = F.col("image_type").isin(*MASTERS)
    named = configs.groupBy("name", "config_type").agg(F.min_by(F.struct("id", "sanity", "config_file", "config_exists", "nightdate"), "id").alias("c")).select("name", "config_type", "c.*")
    able = named.where("config_type = 'preprocess'").select(F.col("name").alias("stem"), "id", "sanity", "config_file", "config_exists")

    def with_reason(rows: DataFrame) -> DataFrame:
        return rows.join(able, "stem", "left").withColumn("reason", blocked_reason()).drop("id", "sanity", "config_file", "config_exists")

    stems = durable(with_reason(hit.where("night IS NOT NULL AND unit IS NOT NULL").select("stem").distinct()))
    walls = hit.where(is_master).join(stems.where("reason IS NOT NULL").select("stem"), "stem", "left_semi").select("id")
    below = durable(downstream(edges, walls, max_depth).select("id", F.lit(True).alias("stale")))
    hit = hit.join(below, "id", "left")
    counts = [F.count("*").alias("images"), F.count("stale").alias("stale")]

    order = F.array_position(F.array(*map(F.lit, MASTERS)), F.col("image_type")).cast("int")
    one = hit.where(is_master).groupBy("stem").agg(*counts, F.min(order).alias("sweep")).withColumn("phase", F.lit(1))
    singles = hit.where("image_type = 'science' AND night IS NOT NULL AND unit IS NOT NULL").groupBy("stem").agg(*counts)
    two = singles.unionByName(one.join(stems.where("reason IS NULL").select("stem"), "stem", "left_semi").join(singles, "stem", "left_anti").select("stem", F.lit(0).cast("long").alias("images"), F.lit(0).cast("long").alias("stale")))
    two = two.withColumns({"phase": F.lit(2), "sweep": F.lit(None).cast("int")})
    early = one.unionByName(two).join(stems, "stem", "left").withColumn("state", F.when(F.col("reason").isNotNull(), "blocked"))

    ready = two.join(stems.where("reason IS NULL"), "stem", "left_semi").select(F.col("stem").alias("source"))
    science = configs.where("config_type = 'science'").select("id", F.col("name").alias("stem"), "sanity", "config_file", "config_exists", "nightdate")
    owned = hit.where(~is_master).groupBy(F.col("process_status_id").alias("id")).agg(*counts)
    loose = images.where("image_type = 'science'").join(edges.select(F.col("derived").alias("id")), "id", "left_anti").select(F.col("process_status_id").alias("id")).distinct()
    told = config_deps.join(ready, "source", "left_semi").select(F.col("derived").alias("stem")).distinct()
    also = science.join(told, "stem", "left_semi").join(loose, "id", "left_semi").select("id").join(owned, "id", "left_anti").select("id", F.lit(0).cast("long").alias("images"), F.lit(0).cast("long").alias("stale"))
    late = owned.unionByName(also).join(science, "id").withColumn("reason", blocked_reason()).withColumn("phase", F.when(F.col("nightdate").isNotNull(), 3).otherwise(4))
    late = late.select("stem", "images", "stale", F.lit(None).cast("int").alias("sweep"), "phase", "reason", F.when(F.col("reason").isNotNull(), "skip").alias("state"))
    lost = unknown.select(F.col("id").cast("string").alias("stem"), F.lit(0).cast("long").alias("images"), F.lit(0).cast("long").alias("stale"), F.lit(None).cast("int").alias("sweep"), F.lit(None).cast("int").alias("phase"), F.lit("no such image").alias("reason"), F.lit("skip").alias("state"))
    rows = early.unionByName(late).unionByName(lost)
    only_stale = (F.col("images") > 0) & (F.col("stale") == F.col("images"))
    return rows.select(F.col("stem").alias("config"), "phase", "sweep", F.coalesce("state", F.when(only_stale, "stale").otherwise("run")).alias("state"), F.coalesce("reason", F.when(only_stale, "below a blocked master")).alias("reason"), "images", "stale")


def master_decisions(wanted: DataFrame, designated: DataFrame, reasons: DataFrame, verdicts: DataFrame, found: DataFrame, overwrite: bool = False) -> DataFrame:
    """(group, kind, action, master): what to do about each calibration master that a group of frames needs.

    wanted: group, kind, output (null: none is needed), n_raw, exists. designated: group, kind, master. reasons: output, reason (of
    rebuild_reason). verdicts: output, ok (of a master just made). found: output, master (of the search for another).

    A designated master is adopted. With raw frames, and no output yet, overwrite, or a reason other than none, it is
    generated; if its QA then fails, what the search finds is fetched instead. Anything else is fetched: the output if it exists,
    else what the search finds; `missing` if nothing is. The least row counts where one of the tables has several."""
    least = lambda df, keys, c: df.groupBy(*keys).agg(F.min(c).alias(c))
    j = wanted.join(least(designated.select("group", "kind", F.col("master").alias("_given")), ["group", "kind"], "_given"), ["group", "kind"], "left")
    for table, column, name in ((reasons, "reason", "_reason"), (verdicts, "ok", "_ok"), (found, "master", "_other")):
        j = j.join(least(table.select("output", F.col(column).alias(name)), ["output"], name), "output", "left")
    make = (F.col("n_raw") > 0) & (~F.col("exists") | F.lit(overwrite) | (F.coalesce("_reason", F.lit("none")) != "none"))
    failed = make & ~F.coalesce("_ok", F.lit(True))
    action = (F.when(F.col("_given").isNotNull(), "adopt").when(F.col("output").isNull(), "none").when(make & ~failed, "generate").when(failed & F.col("_other").isNotNull(), "fetch another")
              .when(~failed & F.col("exists"), "fetch").when(F.col("_other").isNotNull(), "fetch another").otherwise("missing"))
    master = F.when(action == "adopt", F.col("_given")).when(action.isin("generate", "fetch"), F.col("output")).when(action == "fetch another", F.col("_other"))
    return j.select("group", "kind", action.alias("action"), master.alias("master"))


def backfill_targets(edges: DataFrame, images: DataFrame, kinds: list[str] | None = None, first_night: str | None = None, last_night: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows of images (id, image_type, nightdate) without any edge to what they came from, by type and night, the latest first as far as
    limit goes."""
    rows = images
    for test in [F.col("image_type").isin(kinds) if kinds else None, F.col("nightdate") >= first_night if first_night else None, F.col("nightdate") <= last_night if last_night else None]:
        rows = rows if test is None else rows.where(test)
    rows = rows.join(edges.select(F.col("derived").alias("id")).distinct(), "id", "left_anti")
    return rows if limit is None else rows.orderBy(F.desc_nulls_last("nightdate"), F.desc("id")).limit(limit)


def seeds_from_staleness(edges: DataFrame, images: DataFrame) -> DataFrame:
    """(id) of sources that were remade since something was derived from them."""
    return stale_edges(edges, images).select(F.col("source").alias("id")).distinct()


def seeds_from_config(images: DataFrame, config) -> DataFrame:
    """(id) of the masters that a config owns."""
    return images.where((F.col("process_status_id") == config) & F.col("image_type").isin(*MASTERS)).select("id")


def rebuild_reason(edges: DataFrame, images: DataFrame, designated: DataFrame, better: DataFrame) -> DataFrame:
    """(derived, reason): the strongest of designated, regenerated, sanity, better-match over the ingredients; none otherwise."""
    now = images.select(F.col("id").alias("source"), "imageid", "sanity")
    j = edges.join(now, "source").join(designated.select("source", F.lit(True).alias("des")), "source", "left").join(better.select("derived", F.lit(True).alias("bet")), "derived", "left")
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    reason = F.when(any_(F.col("des")), "designated").when(any_(F.col("source_imageid") != F.col("imageid")), "regenerated").when(any_(F.col("sanity") == F.lit(False)), "sanity").when(any_(F.col("bet")), "better-match").otherwise("none")
    return j.groupBy("derived").agg(reason.alias("reason"))


def readiness(edges: DataFrame, status: DataFrame, terminal=("done", "failed")) -> DataFrame:
    """(config, parents, finished, ready) over config edges."""
    s = status.select(F.col("id").alias("source_config"), F.col("status").isin(*terminal).alias("over"))
    return edges.join(s, "source_config", "left").groupBy("derived_config").agg(F.count("*").alias("parents"), F.count_if("over").alias("finished")).select(F.col("derived_config").alias("config"), "parents", "finished", (F.col("parents") == F.col("finished")).alias("ready"))


def task_edges(tasks: DataFrame) -> DataFrame:
    """(derived, source, origin) from tasks (idx, config, dependents array of idx); edges inside a config are dropped."""
    d = tasks.select(F.col("config").alias("source"), F.explode("dependents").alias("idx"))
    return d.join(tasks.select("idx", F.col("config").alias("derived")), "idx").where("derived <> source").select("derived", "source", F.lit("scheduled").alias("origin")).distinct()


def latest_codes(events: DataFrame) -> DataFrame:
    """(config, codes, first_error): distinct warning codes sorted, and the first error, after the last reset of each stage (code div 100).

    A reset row has code 999 or the stage's number times 100 and drops earlier codes of that stage, all stages for 999."""
    w = W.partitionBy("config").orderBy(F.desc("pos")).rowsBetween(W.unboundedPreceding, -1)
    stage = (F.col("code") / 100).cast("int")
    later = events.withColumns({"_all": F.max(F.when(F.col("code") == 999, 1)).over(w), "_stages": F.collect_set(F.when((F.col("code") % 100 == 0), stage)).over(w)})
    live = later.where(F.col("_all").isNull() & ~F.array_contains("_stages", stage) & (F.col("code") % 100 != 0) & (F.col("code") != 999))
    return live.groupBy("config").agg(F.sort_array(F.collect_set("code")).alias("codes"), F.min_by("code", F.when(F.col("error"), F.col("pos"))).alias("first_error"))

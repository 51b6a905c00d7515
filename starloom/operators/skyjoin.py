"""Joins by position on the sky.

Points become unit vectors in a cubic grid of cells a few match radii wide; one side is copied to the cells that a cube of
the radius around it touches (1 to 8, two on average), so an equi-join on the cell finds all pairs within the radius, with
no special case at the poles or at RA 0. The join is a plain shuffle join, so AQE splits the cells of repeated pointings.
Rows without a position match nothing. Ties at equal distance go to the smaller id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.functions import sky
from starloom.operators.stats import exact_quantiles
from starloom.storage import discard

CELL_RADII, LEAST_CELL = 6.0, 0.45
"""Width of a cell in match radii, and at least, in arcsec (a code has 20 bits for each axis)."""


def _placed(df: DataFrame, key: str, ra: str, dec: str, side: str, by: str | None = None) -> DataFrame:
    x, y, z = sky.xyz(F.col(ra), F.col(dec))
    here = F.col(ra).isNotNull() & F.col(dec).isNotNull() & ~F.isnan(F.col(ra).cast("double")) & ~F.isnan(F.col(dec).cast("double"))
    return df.where(here).select(F.col(key).alias(f"{side}_id"), x.alias(f"{side}_x"), y.alias(f"{side}_y"), z.alias(f"{side}_z"), *([F.col(by).alias("_by")] if by else []))


def sky_pairs(a: DataFrame, b: DataFrame, radius: float, a_key: str, b_key: str, ra: str = "ra", dec: str = "dec", copy_b: bool = True, by: str | None = None) -> DataFrame:
    """(a_id, b_id, separation) of all pairs closer than `radius` arcsec. copy_b: b is the smaller side. by: only rows that are equal in this
    column meet, such as those of one field or epoch."""
    cell = max(CELL_RADII * radius, LEAST_CELL) * sky.ARCSEC
    reach = radius * sky.ARCSEC * (1 + 1e-6)  # a chord is never longer than its arc
    left, right = _placed(a, a_key, ra, dec, "a", by), _placed(b, b_key, ra, dec, "b", by)

    def cells(df: DataFrame, side: str, around: bool) -> DataFrame:
        """cell: the own one, or all that the cube around the point touches."""
        df = df.withColumn("cell", F.lit(0).cast("long"))
        for c in "xyz":
            at = lambda shift, c=c: F.floor((F.col(f"{side}_{c}") + shift) / cell).cast("long") + (1 << 20)
            place = F.explode(F.sequence(at(-reach), at(reach))) if around else at(0.0)
            df = df.withColumn("_p", place).withColumn("cell", F.col("cell") * (1 << 21) + F.col("_p")).drop("_p")
        return df

    pairs = cells(left, "a", not copy_b).join(cells(right, "b", copy_b), ["cell", *(["_by"] if by else [])])
    d2 = sky.chord2([F.col(f"a_{c}") for c in "xyz"], [F.col(f"b_{c}") for c in "xyz"])
    limit = 2 * math.sin(radius * sky.ARCSEC / 2)
    return pairs.where(d2 < limit * limit).select("a_id", "b_id", (2 * F.asin(F.sqrt(d2) / 2) / sky.ARCSEC).alias("separation"))


def nearest(driver: DataFrame, other: DataFrame, radius: float, driver_key: str, other_key: str, copy_other: bool = True) -> DataFrame:
    """(a_id, b_id, separation): the nearest other row of each driver row that has one within the radius."""
    pairs = sky_pairs(driver, other, radius, driver_key, other_key, copy_b=copy_other)
    best = pairs.groupBy("a_id").agg(F.min(F.struct("separation", "b_id")).alias("m"))
    return best.select("a_id", F.col("m.b_id").alias("b_id"), F.col("m.separation").alias("separation"))


def cross_match(sci: DataFrame, ref: DataFrame, radius: float, how: str = "inner", sci_key: str = "det_id", ref_key: str = "source_id") -> DataFrame:
    """(sci id, ref id, separation).

    inner: the smaller side drives (ref only if strictly smaller). left, right: that side drives and keeps all rows.
    outer: the best pair of each sci row, and what is left of both sides."""
    ref_smaller = ref.count() < sci.count()  # the smaller side is copied to the cells around
    from_ref = how == "right" or how == "inner" and ref_smaller
    if from_ref:
        m = nearest(ref, sci, radius, ref_key, sci_key, copy_other=not ref_smaller).select(F.col("b_id").alias(sci_key), F.col("a_id").alias(ref_key), "separation")
        return m if how == "inner" else ref.select(ref_key).join(m, ref_key, "left").select(sci_key, ref_key, "separation")
    m = nearest(sci, ref, radius, sci_key, ref_key, copy_other=ref_smaller).select(F.col("a_id").alias(sci_key), F.col("b_id").alias(ref_key), "separation")
    if how == "inner":
        return m
    rows = sci.select(sci_key).join(m, sci_key, "left").select(sci_key, ref_key, "separation")
    if how == "left":
        return rows
    alone = ref.select(ref_key).join(m.select(ref_key), ref_key, "left_anti").select(F.lit(None).cast(sci.schema[sci_key].dataType).alias(sci_key), ref_key, F.lit(None).cast("double").alias("separation"))
    return rows.unionByName(alone)


def friends_edges(cats: DataFrame, radius: float, by: str | None = None) -> DataFrame:
    """(a_id, b_id, separation) between rows of different catalogs; cats: id, cat, ra, dec."""
    return _friends(cats, radius, by).select("a_id", "b_id", "separation")


def _friends(cats: DataFrame, radius: float, by: str | None) -> DataFrame:
    """friends_edges() with the catalogs ca and cb of both rows."""
    both = sky_pairs(cats, cats, radius, "id", "id", by=by)
    kind = cats.select("id", "cat")
    joined = both.where("a_id < b_id").join(kind.withColumnsRenamed({"id": "a_id", "cat": "ca"}), "a_id").join(kind.withColumnsRenamed({"id": "b_id", "cat": "cb"}), "b_id")
    return joined.where("ca <> cb").select("a_id", "b_id", "separation", "ca", "cb")


def propagate_min(edges: DataFrame, checkpoint, rounds: int = 60) -> DataFrame:
    """(id, group): connected components of (a_id, b_id) by the least id. checkpoint(df) cuts lineage. Fails after `rounds`."""
    both = checkpoint(edges.select("a_id", "b_id").unionByName(edges.select(F.col("b_id").alias("a_id"), F.col("a_id").alias("b_id"))))
    first = checkpoint(both.groupBy("a_id").agg(F.least(F.min("b_id"), F.first("a_id")).alias("g")))
    label, tables = first.withColumnRenamed("a_id", "id"), [first]
    for _ in range(rounds):
        near = both.join(label.withColumnsRenamed({"id": "b_id"}), "b_id").groupBy("a_id").agg(F.min("g").alias("m")).withColumnRenamed("a_id", "id")
        step = label.join(near, "id").select("id", F.least("g", "m").alias("h"), "g")
        jump = step.join(label.select(F.col("id").alias("h"), F.col("g").alias("j")), "h", "left").select("id", F.least("h", F.coalesce("j", "h")).alias("n"), "g")
        jump = checkpoint(jump)
        discard(*tables)
        tables = [jump]
        changed = jump.where("n <> g").limit(1).count()
        label = jump.select("id", F.col("n").alias("g"))
        if not changed:
            discard(both)
            return label.withColumnRenamed("g", "group")
    raise RuntimeError("components did not settle")


def multi_match(cats: DataFrame, radius: float, checkpoint, join: str = "matched", pivot_cat=None, reference: str = "pivot", by: str | None = None) -> DataFrame:
    """Friends of friends over several catalogs (id, cat, ra, dec): per group the pivot, and of each other catalog the row nearest to it.

    The pivot has the least sum of separations to the nearest row of each other catalog it has an edge to, counting
    those it misses as one radius; then the least id. With pivot_cat it is one of that catalog's rows where the group has any.
    join: matched, groups of at least two catalogs; inner, of all catalogs of the table; left, those with a row of pivot_cat;
    outer, all, rows without a match too. reference: the pivot, or the spherical centroid of the group's chosen rows.
    by: rows are friends only where they are equal in this column.
    Rows: group, pivot, cat, id, and from the reference to the row separation, dra_cosdec and ddec in arcsec (0 for the pivot)."""
    if join not in ("matched", "inner", "left", "outer") or reference not in ("pivot", "centroid") or join == "left" and pivot_cat is None:
        raise ValueError("no such join or reference, or left without pivot_cat")
    edges = checkpoint(_friends(cats, radius, by))
    groups = propagate_min(edges, checkpoint)
    if join in ("left", "outer"):
        alone = cats.select("id").join(groups, "id", "left_anti")
        groups = groups.unionByName(alone.select("id", F.col("id").alias("group")))
    other = edges.select("a_id", F.col("cb").alias("b_cat"), "separation").unionByName(edges.select(F.col("b_id").alias("a_id"), F.col("ca").alias("b_cat"), "separation"))
    near = other.groupBy("a_id", "b_cat").agg(F.min("separation").alias("s"))
    # written between the steps, so that a step's shuffle files go before the next one's come
    members = checkpoint(groups.join(cats.select("id", "cat", "ra", "dec"), "id"))
    if join == "inner":
        every = cats.agg(F.count_distinct("cat").alias("_every"))  # one row
        whole = members.groupBy("group").agg(F.count_distinct("cat").alias("_n")).crossJoin(F.broadcast(every)).where("_n = _every")
        members = members.join(whole.select("group"), "group", "left_semi")
    elif join == "left":
        members = members.join(members.where(F.col("cat") == pivot_cat).select("group").distinct(), "group", "left_semi")
    n_cats = members.groupBy("group").agg(F.count_distinct("cat").alias("n"))
    cost = near.groupBy("a_id").agg(F.sum("s").alias("sum"), F.count("*").alias("k")).withColumnRenamed("a_id", "id")
    scored = members.join(cost, "id", "left").join(n_cats, "group").withColumn("cost", F.coalesce("sum", F.lit(0.0)) + (F.col("n") - 1 - F.coalesce("k", F.lit(0))) * radius)
    other = F.lit(False) if pivot_cat is None else F.col("cat") != pivot_cat
    pivot = scored.groupBy("group").agg(F.min(F.struct(other.alias("other"), F.round("cost", 9).alias("cost"), "id", "cat", "ra", "dec")).alias("p"))
    pivot = checkpoint(pivot)
    discard(edges)
    p = F.col("p")
    s = sky.separation(p["ra"], p["dec"], F.col("ra"), F.col("dec"))
    chosen = members.join(pivot, "group").where((F.col("cat") != p["cat"]) | (F.col("id") == p["id"]))
    best = chosen.groupBy("group", p["id"].alias("pivot"), p["ra"].alias("_ra"), p["dec"].alias("_dec"), "cat").agg(F.min(F.struct(F.round(s, 9).alias("separation"), "id", "ra", "dec")).alias("m"))
    rows = best.select("group", "pivot", "cat", "m.*", "_ra", "_dec")
    if reference == "centroid":
        ra, dec = centroid(F.col("ra"), F.col("dec"))
        rows = rows.drop("_ra", "_dec").join(rows.groupBy("group").agg(ra.alias("_ra"), dec.alias("_dec")), "group")
        rows = rows.withColumn("separation", sky.separation(F.col("_ra"), F.col("_dec"), F.col("ra"), F.col("dec")))
    dra, ddec = sky.offsets(F.col("_ra"), F.col("_dec"), F.col("ra"), F.col("dec"))
    return rows.select("group", "pivot", "cat", "id", "separation", dra.alias("dra_cosdec"), ddec.alias("ddec"))


def group_presence(match: DataFrame) -> DataFrame:
    """(group, cats, size) of multi_match rows: the catalogs that each group has a row of, in order."""
    g = match.groupBy("group").agg(F.sort_array(F.collect_set("cat")).alias("cats"))
    return g.withColumn("size", F.size("cats"))


def group_sizes(match: DataFrame) -> DataFrame:
    """(size, n): how many groups have rows of so many catalogs."""
    return group_presence(match).groupBy("size").agg(F.count("*").alias("n"))


def recalls(match: DataFrame) -> DataFrame:
    """(cat, given, n_given, n, recall): of the groups that have a row of catalog `given`, the share with one of cat as well; given null: of
    those that have one of any catalog but cat. 0 of none is null."""
    g = group_presence(match)
    pairs = g.select(F.explode("cats").alias("given"), "cats").select("given", F.explode("cats").alias("cat")).where("cat <> given").groupBy("cat", "given").agg(F.count("*").alias("n"))
    alone = g.select(F.explode("cats").alias("given"), "size").groupBy("given").agg(F.count("*").alias("n_given"), F.count_if(F.col("size") > 1).alias("n"))
    names = alone.agg(F.collect_set("given").alias("names"))  # one row, a name per catalog
    each = alone.select("given", "n_given").crossJoin(F.broadcast(names)).select("given", "n_given", F.explode("names").alias("cat")).where("cat <> given").join(pairs, ["cat", "given"], "left")
    groups = g.agg(F.count("*").alias("groups"), F.count_if(F.col("size") == 1).alias("single"))  # one row
    own = g.where("size = 1").select(F.col("cats")[0].alias("given")).groupBy("given").agg(F.count("*").alias("only"))
    any_ = alone.join(own, "given", "left").crossJoin(F.broadcast(groups)).select(F.col("given").alias("cat"), F.lit(None).cast(dict(match.dtypes)["cat"]).alias("given"), (F.col("groups") - F.coalesce("only", F.lit(0))).alias("n_given"), "n")
    both = each.select("cat", "given", "n_given", F.coalesce("n", F.lit(0)).alias("n")).unionByName(any_)
    return both.withColumn("recall", F.try_divide(F.col("n"), F.col("n_given")))


def catalog_rms(match: DataFrame) -> DataFrame:
    """(cat, n, rms_x, rms_y, rms, least, q1, q2, q3, p95, p99, most) of the rows' separations from their group's reference."""
    square = lambda c: F.sqrt(F.avg(F.col(c) * F.col(c)))
    sums = match.groupBy("cat").agg(F.count("*").alias("n"), square("dra_cosdec").alias("rms_x"), square("ddec").alias("rms_y"), square("separation").alias("rms"), F.min("separation").alias("least"), F.max("separation").alias("most"))
    q = exact_quantiles(match, ["cat"], "separation", [0.25, 0.5, 0.75, 0.95, 0.99]).select("cat", *(F.col("q")[i].alias(c) for i, c in enumerate(("q1", "q2", "q3", "p95", "p99"))))
    return sums.join(q, "cat").select("cat", "n", "rms_x", "rms_y", "rms", "least", "q1", "q2", "q3", "p95", "p99", "most")


def centroid(ra: Column, dec: Column) -> tuple[Column, Column]:
    """Aggregates: spherical mean position; the first by (ra, dec) where the mean vector vanishes."""
    x, y, z = (F.avg(c) for c in sky.xyz(ra, dec))
    none = F.sqrt(x * x + y * y + z * z) < 1e-12
    first = F.min(F.struct(ra.alias("ra"), dec.alias("dec")))
    return (F.when(none, first["ra"]).otherwise(F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))), F.when(none, first["dec"]).otherwise(F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))))


def drop_close(rows: DataFrame, radius: float, checkpoint, key: str = "id", order: str = "pos", by: str | None = None) -> DataFrame:
    """Keep a row unless it lies within `radius` of a kept row of smaller `order` (unique). Lineage is cut each round. by: only rows that are
    equal in this column are compared.

    A row is kept once all its earlier neighbours are dropped, dropped once one is kept; rows settle in rounds, so no
    component of neighbours has to fit one task."""
    close = sky_pairs(rows, rows, radius, key, key, by=by).where("a_id <> b_id").select("a_id", "b_id")
    o = rows.select(key, order)
    earlier = close.join(o.withColumnsRenamed({key: "a_id", order: "oa"}), "a_id").join(o.withColumnsRenamed({key: "b_id", order: "ob"}), "b_id").where("ob < oa").select(F.col("a_id").alias("late"), F.col("b_id").alias("early"))
    left = checkpoint(earlier)
    dropped = left.select(F.col("late").alias(key)).limit(0)
    while left.limit(1).count():
        kept = left.select("early").distinct().join(left.select("late").distinct(), F.col("early") == F.col("late"), "left_anti")
        out = checkpoint(left.join(kept, "early", "left_semi").select("late").distinct())
        old = dropped, left, out
        dropped = checkpoint(dropped.unionByName(out.withColumnRenamed("late", key)))
        left = checkpoint(left.join(out, "late", "left_anti").join(out.withColumnRenamed("late", "early"), "early", "left_anti"))
        discard(*old)
    return rows.join(dropped, key, "left_anti")


def nearest_pixels(points: DataFrame, targets: DataFrame, most: float) -> DataFrame:
    """(image_id, target, det_id, dist): per image and target the nearest point by pixel distance if within `most`.

    A point has one cell of `most` pixels, a target the nine around it, so a target meets what lies near and no more."""
    cell = lambda c, d=0: F.floor(F.col(c) / most).cast("long") + d
    near = F.sequence(F.lit(-1), F.lit(1))
    spread = targets.withColumnsRenamed({"x": "tx", "y": "ty"}).withColumn("_i", F.explode(near)).withColumn("_j", F.explode(near)).withColumns({"_cx": cell("tx", F.col("_i")), "_cy": cell("ty", F.col("_j"))}).drop("_i", "_j")
    j = points.withColumns({"_cx": cell("x"), "_cy": cell("y")}).join(spread, ["image_id", "_cx", "_cy"])
    dist = F.sqrt((F.col("x") - F.col("tx")) ** 2 + (F.col("y") - F.col("ty")) ** 2)
    best = j.groupBy("image_id", "target").agg(F.min(F.struct(dist.alias("dist"), "det_id")).alias("m")).where(F.col("m.dist") <= most)
    return best.select("image_id", "target", F.col("m.det_id").alias("det_id"), F.col("m.dist").alias("dist"))


def lattice(points: DataFrame, width: float, height: float) -> DataFrame:
    """(image_id, target, det_id): nine lattice targets in order, each taking its nearest point that is still free.

    Nine candidates per target are enough, as at most eight are taken before; the greedy choice runs over the 81
    candidates of an image."""
    grid = F.explode(F.array(*[F.struct(F.lit(3 * j + i).alias("target"), F.lit(width * (2 * i + 1) / 6).alias("tx"), F.lit(height * (2 * j + 1) / 6).alias("ty")) for j in range(3) for i in range(3)]))
    cand = points.select("image_id", "det_id", "x", "y", grid.alias("g")).select("image_id", "det_id", "g.target", ((F.col("x") - F.col("g.tx")) ** 2 + (F.col("y") - F.col("g.ty")) ** 2).alias("d"))
    top = cand.withColumn("k", F.row_number().over(W.partitionBy("image_id", "target").orderBy("d", "det_id"))).where("k <= 9")
    per = top.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("target", "k", "det_id"))).alias("c"))
    none = F.filter(F.col("c"), lambda c: F.lit(False))
    done = F.aggregate("c", none, lambda s, c: F.when(F.exists(s, lambda t: (t["target"] == c["target"]) | (t["det_id"] == c["det_id"])), s).otherwise(F.concat(s, F.array(c))))
    return per.select("image_id", F.explode(done).alias("t")).select("image_id", "t.target", "t.det_id")

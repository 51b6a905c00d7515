"""Search by stored footprints: convex great-circle polygons of any number of corners, smaller than a hemisphere.

A footprint lies in the cap around its middle that reaches its furthest corner; of the cubic grid in which unit vectors have cells, it
is copied to the few that this cap meets. Points have one cell, an equi-join on the cell proposes pairs, and half-spaces of the
edges decide. For pairs of polygons, frames have one cell by their middle, in a grid that fits their size, and areas are
copied to the cells within reach, so a pair is met once. Neither 0/360 nor the poles are special, nothing is broadcast, and a cell
that many frames cover is split by AQE. Corners and normals are plain columns in the joins, as lambdas are not compiled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import sky

CELL = 0.04
"""Edge of the grid's cells on the unit sphere, 2.3 degrees."""
POINT = 1 / 3600
"""Radius in degrees that stands for a point where nothing but a position is stored."""
EDGE = 1e-12
FLAT = 8
"""Corners up to which polygons are compared as plain columns; with more on either side, by lambdas over arrays."""
_VECTOR = T.StructType([T.StructField(k, T.DoubleType()) for k in "xyz"])
SHAPE = T.StructType([T.StructField("corners", T.ArrayType(_VECTOR)), T.StructField("normals", T.ArrayType(_VECTOR)), T.StructField("middle", _VECTOR), T.StructField("radius", T.DoubleType())])


def _dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def _cross(a: Column, b: Column) -> Column:
    return F.struct((a["y"] * b["z"] - a["z"] * b["y"]).alias("x"), (a["z"] * b["x"] - a["x"] * b["z"]).alias("y"), (a["x"] * b["y"] - a["y"] * b["x"]).alias("z"))


def _key(x: Column, y: Column, z: Column) -> Column:
    return (x.cast("long") * 1000 + y) * 1000 + z


def _lists(vectors: np.ndarray, sizes: np.ndarray, there: np.ndarray) -> pa.ListArray:
    """Rows' lists of vectors; null where not there."""
    ends = np.concatenate([[0], np.cumsum(np.where(there, sizes, 0))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=np.append(~there, False)), _vectors(vectors))


def _vectors(v: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in v.T], ["x", "y", "z"])


def _shapes(corners: pa.ListArray) -> pa.StructArray:
    """SHAPE of lists of (ra, dec)."""
    sizes = pc.fill_null(pc.list_value_length(corners), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = corners.flatten()
    at = np.stack([pc.struct_field(flat, k).cast(pa.float64()).to_numpy(zero_copy_only=False) for k in ("ra", "dec")], axis=1)
    row, first = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
    there = np.bincount(row, ~np.isfinite(at).all(axis=1), len(sizes)) == 0
    closed = np.flatnonzero(there & (sizes > 3))
    closed = closed[(at[first[closed]] == at[first[closed] + sizes[closed] - 1]).all(axis=1)]
    keep = np.ones(len(row), bool)
    keep[first[closed] + sizes[closed] - 1] = False
    sizes[closed] -= 1
    there &= sizes >= 3
    a, d = np.radians(at[keep & there[row]]).T
    n = sizes[there]
    first, of = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
    v = np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], axis=1)
    after = np.arange(1, len(v) + 1)
    after[first + n - 1] = first
    normals = np.cross(v, v[after])
    total = np.add.reduceat(v, first) if len(n) else v
    m = total / np.sqrt((total * total).sum(axis=1))[:, None]
    if len(n):
        turn = np.where(np.add.reduceat((normals * m[of]).sum(axis=1), first) < 0, -1.0, 1.0)
        r = np.arccos(np.clip(np.minimum.reduceat((v * m[of]).sum(axis=1), first), -1, 1)) + 1e-9
    else:
        turn = r = np.zeros(0)
    middle, radius = np.zeros((len(there), 3)), np.zeros(len(there))
    middle[there], radius[there] = m, r
    parts = [_lists(v, sizes, there), _lists(normals * turn[of][:, None], sizes, there), _vectors(middle), pa.array(radius)]
    return pa.StructArray.from_arrays(parts, SHAPE.names, mask=pa.array(~there))


def with_footprint(frames: DataFrame, corners: str = "corners") -> DataFrame:
    """Add `shape` (corners as vectors, inward normals, middle, radius in radians) from a column of (ra, dec) corners in either sense
    of rotation.

    A last corner that repeats the first is dropped; fewer than three corners, or one that is not known, give a null shape, which meets nothing."""
    frames = frames.drop("shape")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _shapes(batch.column(corners))], [*batch.schema.names, "shape"])

    return frames.mapInArrow(run, T.StructType([*frames.schema.fields, T.StructField("shape", SHAPE)]))


def _flat(vectors: Column, k: int, name: str, rest: Column | None = None) -> list[Column]:
    """Numbers of the first k vectors as columns that are never null; what is missing is `rest`, or zero."""
    return [F.coalesce(F.get(vectors, F.lit(i))[c], *([rest[c]] if rest is not None else []), F.lit(0.0)).alias(f"{name}{i}{c}") for i in range(k) for c in "xyz"]


def _named(name: str) -> dict[str, Column]:
    return {c: F.col(f"{name}{c}") for c in "xyz"}


def _in_cells(d: DataFrame, m: str, reach: Column, edge: Column) -> DataFrame:
    """d with a row and its `_cell` for each cell, `edge` wide, that the cap of `reach` radians around the vector m meets."""
    d = d.withColumns({"_e": edge, "_far": 2 * F.sin(F.least(F.lit(math.pi), reach) / 2) + 1e-9})
    off, least, most, e = F.lit(0.0), F.lit(0.0), F.lit(0.0), F.col("_e")
    for c in "xyz":
        x = F.col(f"{m}{c}")
        d = d.withColumn(f"_{c}", F.explode(F.sequence(F.floor((x - F.col("_far")) / e).cast("int"), F.floor((x + F.col("_far")) / e).cast("int"))))
        low, high = F.col(f"_{c}") * e, (F.col(f"_{c}") + 1) * e
        out, near, far = F.greatest(F.lit(0.0), low - x, x - high), F.greatest(F.lit(0.0), low, -high), F.greatest(F.abs(low), F.abs(high))
        off, least, most = off + out * out, least + near * near, most + far * far
    met = (off <= F.col("_far") * F.col("_far")) & (least <= 1 + 1e-9) & (most >= 1 - 1e-9)
    return d.where(met).withColumn("_cell", _key(F.col("_x"), F.col("_y"), F.col("_z"))).drop("_x", "_y", "_z", "_e", "_far")


def _inside(point: Column, normals: Column) -> Column:
    return F.forall(normals, lambda n: _dot(n, point) >= -EDGE)


def _shared(left: DataFrame, right: DataFrame) -> list[str]:
    return sorted(set(left.columns) & set(right.columns))


def frames_at_points(points: DataFrame, frames: DataFrame) -> DataFrame:
    """Every pair of a point (ra, dec) and a frame (shape) that contains it, with the columns of both but ra, dec and shape.

    Points without a position meet nothing. Column names must differ."""
    if clash := _shared(points.drop("ra", "dec"), frames.drop("shape", "ra", "dec")):
        raise ValueError(f"columns of both sides: {clash}")
    x, y, z = sky.xyz(F.col("ra"), F.col("dec"))
    cell = _key(*(F.floor(c / CELL).cast("int") for c in (x, y, z)))
    p = points.where("ra IS NOT NULL AND dec IS NOT NULL").withColumns({"_px": x, "_py": y, "_pz": z, "_cell": cell}).drop("ra", "dec")
    p = p.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("_px", "_py", "_pz")})
    f = frames.drop("ra", "dec").where("shape IS NOT NULL")
    k = f.agg(F.max(F.size("shape.normals"))).first()[0] or 0  # one number
    keep = [c for c in f.columns if c != "shape"]
    n = F.col("shape.normals")
    f = f.select(*keep, *(F.col(f"shape.middle.{c}").alias(f"_m{c}") for c in "xyz"), F.col("shape.radius").alias("_r"), *([n.alias("_n")] if k > FLAT else _flat(n, k, "_n")))
    f = _in_cells(f, "_m", F.col("_r"), F.lit(CELL)).drop("_mx", "_my", "_mz", "_r")
    kept = [*(c for c in p.columns if c not in ("_cell", "_px", "_py", "_pz")), *keep]
    if k > FLAT:
        return p.join(f, "_cell").where(_inside(F.struct(*(F.col(f"_p{c}").alias(c) for c in "xyz")), F.col("_n"))).select(*kept)
    inside = F.lit(True)
    for i in range(k):
        inside = inside & (_dot(_named("_p"), _named(f"_n{i}")) >= -EDGE)
    return p.join(f, "_cell").where(inside).select(*kept)


def _arcs_cross(a: Column, b: Column) -> Column:
    """Whether any edge of one polygon (corner vectors) meets any edge of the other, of polygons in one hemisphere."""
    def edges(v: Column) -> Column:
        return F.transform(v, lambda p, i: F.struct(p.alias("p"), v[(i + 1) % F.size(v)].alias("q")))

    def meet(e: Column, f: Column) -> Column:
        m, n = _cross(e["p"], e["q"]), _cross(f["p"], f["q"])
        return (_dot(m, f["p"]) * _dot(m, f["q"]) <= 0) & (_dot(n, e["p"]) * _dot(n, e["q"]) <= 0)

    return F.exists(edges(a), lambda e: F.exists(edges(b), lambda f: meet(e, f)))


def _class(radius: Column) -> Column:
    """The least k for which the radius is at most CELL / 2 times 2 to the k."""
    return F.greatest(F.lit(0), F.ceil(F.log2(radius / (CELL / 2)))).cast("int")


def _edge(size: Column) -> Column:
    """Edge of the cells of a class, three times the radius that its frames may have."""
    return 3 * CELL / 2 * F.pow(F.lit(2.0), size)


def frames_meeting(polygons: DataFrame, frames: DataFrame) -> DataFrame:
    """Every pair of a polygon and a frame (both with shape) that have a point in common, with the columns of both but shape.

    Two convex polygons of one hemisphere are apart if all corners of one lie beyond an edge of the other. Each side is read twice, so
    it should be a written table. Column names must differ."""
    if clash := _shared(polygons.drop("shape"), frames.drop("shape")):
        raise ValueError(f"columns of both sides: {clash}")
    p, f = polygons.where("shape IS NOT NULL"), frames.where("shape IS NOT NULL")
    top = lambda d: d.agg(F.max(F.size("shape.corners")).alias("k"), F.max("shape.radius").alias("r")).first()  # noqa: E731, one row
    a, b = top(p), top(f)
    classes = sorted(r.k for r in f.select(_class(F.col("shape.radius")).alias("k")).distinct().collect())  # a class doubles the radius, so there are few
    most_a, most_b = max(a.k or 0, 3), max(b.k or 0, 3)
    ours, theirs = ([c for c in d.columns if c != "shape"] for d in (p, f))
    flat = max(most_a, most_b) <= FLAT and (a.r or 0) + (b.r or 0) < math.pi / 2

    def placed(d: DataFrame, k: int, s: str, keep: list[str]) -> DataFrame:
        """Middle, radius, and as the test needs them corners and normals as columns or the shape."""
        v, r = F.col("shape"), F.col("shape.radius")
        middle = [F.coalesce(v["middle"][c], F.lit(0.0)).alias(f"_{s}m{c}") for c in "xyz"]
        reach = [F.coalesce(x, F.lit(0.0)).alias(f"_{s}{n}") for n, x in (("r", r), ("cos", F.cos(r)), ("sin", F.sin(r)))]
        return d.select(*keep, *middle, *reach, *([*_flat(v["corners"], k, f"_{s}v", v["corners"][0]), *_flat(v["normals"], k, f"_{s}n")] if flat else [v.alias(f"_{s}")]))

    cell = lambda x, e: F.floor(x / e).cast("int")
    f = placed(f, most_b, "b", theirs).withColumn("_class", _class(F.col("_br"))).withColumn("_edge", _edge(F.col("_class")))
    f = f.withColumn("_cell", _key(*(cell(F.col(f"_bm{c}"), F.col("_edge")) for c in "xyz"))).drop("_edge", "_br")
    p = placed(p, most_a, "a", ours).withColumn("_class", F.explode(F.array(*map(F.lit, classes)).cast("array<int>"))).withColumn("_w", _edge(F.col("_class")))
    p = _in_cells(p, "_am", F.col("_ar") + F.col("_w") / 3, F.col("_w")).drop("_w")
    near = _dot(_named("_am"), _named("_bm")) >= F.col("_acos") * F.col("_bcos") - F.col("_asin") * F.col("_bsin") - 1e-15
    if not flat:
        near = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot(_named("_am"), _named("_bm"))))) <= F.col("_ar") + F.col("_b.radius")
        u, v = F.col("_a"), F.col("_b")
        meet = F.exists(u["corners"], lambda x: _inside(x, v["normals"])) | F.exists(v["corners"], lambda x: _inside(x, u["normals"])) | _arcs_cross(u["corners"], v["corners"])
        return p.join(f, ["_class", "_cell"]).where(near).where(meet).select(*ours, *theirs)
    meet = F.lit(True)
    for s, n, t, k in (("a", most_a, "b", most_b), ("b", most_b, "a", most_a)):
        for i in range(n):
            meet = meet & (F.greatest(*(_dot(_named(f"_{s}n{i}"), _named(f"_{t}v{j}")) for j in range(k))) >= -EDGE)
    return p.drop("_ar").join(f, ["_class", "_cell"]).where(near & meet).select(*ours, *theirs)


def frames_near_points(points: DataFrame, frames: DataFrame, radius: float = POINT) -> DataFrame:
    """Every pair of a point (ra, dec) and a frame (frame_ra, frame_dec) within `radius` degrees: a cone around a stored position, or a point where frames have no footprint."""
    width = 2 * math.sin(math.radians(radius) / 2)
    cell = max(3 * width, 1e-7)
    x, y, z = sky.xyz(F.col("ra"), F.col("dec"))
    key = lambda c: [F.floor(v / cell).cast("long") for v in c]
    p = points.withColumns({"_p": F.struct(x.alias("x"), y.alias("y"), z.alias("z")), **dict(zip(("_x", "_y", "_z"), key((x, y, z)), strict=True))}).drop("ra", "dec")
    u, v, w = sky.xyz(F.col("frame_ra"), F.col("frame_dec"))
    f = frames.withColumn("_f", F.struct(u.alias("x"), v.alias("y"), w.alias("z"))).drop("frame_ra", "frame_dec")
    for name, c in zip(("_x", "_y", "_z"), "xyz", strict=True):
        f = f.withColumn(name, F.explode(F.sequence(F.floor((F.col("_f")[c] - width) / cell).cast("long"), F.floor((F.col("_f")[c] + width) / cell).cast("long"))))
    close = sky.chord2(tuple(F.col("_p")[k] for k in "xyz"), tuple(F.col("_f")[k] for k in "xyz")) <= width * width
    return p.join(f, ["_x", "_y", "_z"]).where(close).drop("_x", "_y", "_z", "_p", "_f")

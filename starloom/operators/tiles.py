"""Pixel stacks as tiles: a row holds a square of one frame, so a frame of 62 million pixels is a thousand rows instead of as many as it has pixels.

Tiles are rows (frame, ty, tx, h, w, planes...): planes are float64 bytes, row by row, NaN where there is no value. All tiles of a frame
are `size` wide and high but for the last of a line or column. A neighbourhood needs a strip of `r` pixels of the eight tiles
around: tiles send those, and themselves, to their targets in one shuffle of (1 + 2 r / size)**2 of the data, and numpy works on
the padded square. A stack of frames is dealt out by runs of pixels so short that all frames of a run fit into `budget` values;
no row or task holds a tile of all frames. Each operation gives what the long form in `pixels` gives.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.pixels import MEDIAN_PENALTY

KEYS = "frame long, ty int, tx int, h int, w int"
BUDGET = 1 << 22
"""Values of a plane that a group of a stack holds at most: 32 MB."""


def _plane(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, np.float64).tobytes()


def _array(b: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(b, np.float64).reshape(shape)


def _schema(planes, keys: str = KEYS) -> str:
    return ", ".join([keys, *(f"{p} binary" for p in planes)])


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy() if not pa.types.is_boolean(column.type) else column.cast(pa.int8()).cast(pa.float64()).to_numpy()


def cut_tiles(frames: DataFrame, size: int, planes: list[str]) -> DataFrame:
    """Tiles of rows (frame, y, x, planes); a missing pixel and a null are NaN."""
    def run(key: tuple, group: pa.Table) -> pa.Table:
        y, x = group["y"].to_numpy() % size, group["x"].to_numpy() % size
        h, w = int(y.max()) + 1, int(x.max()) + 1
        cells = {}
        for p in planes:
            a = np.full((h, w), np.nan)
            a[y, x] = _numbers(group[p])
            cells[p] = [_plane(a)]
        frame, ty, tx = (k.as_py() for k in key)
        return pa.table({"frame": pa.array([frame], pa.int64()), "ty": pa.array([ty], pa.int32()), "tx": pa.array([tx], pa.int32()), "h": pa.array([h], pa.int32()), "w": pa.array([w], pa.int32()), **{p: pa.array(v, pa.binary()) for p, v in cells.items()}})

    part = frames.select(F.col("frame").cast("long").alias("frame"), F.floor(F.col("y") / size).cast("int").alias("ty"), F.floor(F.col("x") / size).cast("int").alias("tx"), F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), *planes)
    return part.groupBy("frame", "ty", "tx").applyInArrow(run, _schema(planes))


def to_pixels(tiles: DataFrame, size: int, planes: list[str]) -> DataFrame:
    """(frame, y, x, planes) of tiles; NaN becomes null."""
    def run(batches):
        for batch in batches:
            for t in batch.to_pylist():
                y, x = np.indices((t["h"], t["w"])).reshape(2, -1)
                columns = [pa.array(np.full(len(y), t["frame"]), pa.int64()), pa.array(y + t["ty"] * size, pa.int64()), pa.array(x + t["tx"] * size, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(np.frombuffer(t[p]), pa.float64(), from_pandas=True) for p in planes)], ["frame", "y", "x", *planes])

    return tiles.select("frame", "ty", "tx", "h", "w", *planes).mapInArrow(run, "frame long, y long, x long, " + ", ".join(f"{p} double" for p in planes))


def around(tiles: DataFrame, r: int, size: int, planes: list[str], work: Callable, out: list[str], extra: str | None = None) -> DataFrame:
    """Tiles with planes `out` from work(padded, there, extra): padded planes have r more pixels on each side, `there` is where the frame has
    pixels, and the result's planes have the tile's own shape. extra: an integer column of the tiles that is handed over."""
    if r > size:
        raise ValueError(f"{r} pixels reach beyond the tiles around, which have {size}")
    handed = [extra] if extra else []

    def send(batches):
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("frame", "ty", "tx", "h", "w", "py", "px", *handed, *planes)}
            for t in batch.to_pylist():
                whole = {p: _array(t[p], t["h"], t["w"]) for p in planes}
                for dy in (-1, 0, 1):
                    for dx in (-1, 0, 1):
                        if t["ty"] + dy < 0 or t["tx"] + dx < 0 or ((dy or dx) and not r):
                            continue
                        cut = tuple(slice(None) if not d else slice(max(0, n - r), n) if d > 0 else slice(0, r) for d, n in ((dy, t["h"]), (dx, t["w"])))
                        some = {p: a[cut] for p, a in whole.items()}
                        h, w = some[planes[0]].shape
                        for c, v in (("frame", t["frame"]), ("ty", t["ty"] + dy), ("tx", t["tx"] + dx), ("h", h), ("w", w), ("py", -dy), ("px", -dx), *((c, t[c]) for c in handed), *((p, _plane(a)) for p, a in some.items())):
                            rows[c].append(v)
            kinds = {"frame": pa.int64(), **{p: pa.binary() for p in planes}}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int32())) for c, v in rows.items()], list(rows))

    def meet(key: tuple, group: pa.Table) -> pa.Table:
        kinds = {"frame": pa.int64(), "ty": pa.int32(), "tx": pa.int32(), "h": pa.int32(), "w": pa.int32(), **{p: pa.binary() for p in out}}
        pieces = group.to_pylist()
        own = next((t for t in pieces if not t["py"] and not t["px"]), None)
        if own is None:  # beyond the frame's last tile
            return pa.table({c: pa.array([], k) for c, k in kinds.items()})
        h, w = own["h"], own["w"]
        padded = {p: np.full((h + 2 * r, w + 2 * r), np.nan) for p in planes}
        there = np.zeros((h + 2 * r, w + 2 * r), bool)
        for t in pieces:
            at = tuple(slice(r - n, r) if d < 0 else slice(r + m, r + m + n) if d > 0 else slice(r, r + n) for d, n, m in ((t["py"], t["h"], h), (t["px"], t["w"], w)))
            there[at] = True
            for p in planes:
                padded[p][at] = _array(t[p], t["h"], t["w"])
        made = work(padded, there, own[extra] if extra else None)
        row = {"frame": own["frame"], "ty": own["ty"], "tx": own["tx"], "h": h, "w": w, **{p: _plane(made[p]) for p in out}}
        return pa.table({c: pa.array([row[c]], k) for c, k in kinds.items()})

    more = "".join(f", {c} int" for c in handed)
    sent = tiles.select("frame", "ty", "tx", "h", "w", *handed, *planes).mapInArrow(send, _schema(planes, KEYS + ", py int, px int" + more))
    return sent.groupBy("frame", "ty", "tx").applyInArrow(meet, _schema(out))


def gaussian(tiles: DataFrame, size: int, sigma: float, r: int) -> DataFrame:
    """Plane v smoothed with a separable kernel of 2 r + 1 taps that sums to 1, zeros outside the frame."""
    kernel = np.exp(-(np.arange(-r, r + 1) ** 2) / (2 * sigma * sigma))
    kernel /= kernel.sum()

    def work(padded, there, _):
        a = np.where(there, padded["v"], 0.0)
        n = a.shape[1] - 2 * r
        a = sum(k * a[:, i: i + n] for i, k in enumerate(kernel))
        n = a.shape[0] - 2 * r
        return {"v": sum(k * a[i: i + n] for i, k in enumerate(kernel))}

    return around(tiles, r, size, ["v"], work, ["v"])


def interpolate_bad(tiles: DataFrame, size: int, r: int = 1, method: str = "median") -> DataFrame:
    """Planes v and wt with the pixels of plane bad replaced from the good ones of the window around, by the rules of
    pixels.interpolate_bad; good pixels without a value are left out."""
    def work(padded, there, _):
        core = (slice(r, -r or None), slice(r, -r or None))
        v, w, lost = padded["v"][core].copy(), padded["wt"][core].copy(), padded["bad"][core] == 1
        y, x = np.nonzero(lost)
        dy, dx = (d.reshape(-1) for d in np.mgrid[0: 2 * r + 1, 0: 2 * r + 1])
        yy, xx = y[:, None] + dy, x[:, None] + dx
        good = there[yy, xx] & (padded["bad"][yy, xx] == 0) & ~np.isnan(padded["v"][yy, xx])
        nv, nw, n = padded["v"][yy, xx], padded["wt"][yy, xx], good.sum(1)
        some = n > 0
        row = np.arange(len(y))
        if method == "median":
            ordered = np.sort(np.where(good, nv, np.inf), 1)
            low, high = np.maximum((n + 1) // 2 - 1, 0), np.minimum(n // 2, len(dy) - 1)
            middle = ordered[row, low]
            new_v = (middle + ordered[row, high]) / 2
            place = np.cumsum(good, 1) - 1
            slot = lambda s: nw[row, (good & (place == s[:, None])).argmax(1)]
            own = nw[row, (good & (nv == middle[:, None])).argmax(1)]
            new_w = np.where(n % 2 == 1, own, (slot(low) + slot(high)) / 2)
        else:
            total = np.where(good, nw, 0).sum(1)
            new_v = np.divide(np.where(good, nv * nw, 0).sum(1), total, out=np.zeros(len(y)), where=total != 0)
            new_w = total
        v[y, x], w[y, x] = np.where(some, new_v, 0), np.where(some, new_w, 0)
        return {"v": v, "wt": w}

    return around(tiles, r, size, ["v", "wt", "bad"], work, ["v", "wt"])


def _near(bad: np.ndarray, n: int, r: int) -> np.ndarray:
    """Whether any of the (2 n + 1) square around each pixel of the core is set, of an array padded by r."""
    total = np.pad(bad.astype(np.int32).cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h, w = bad.shape[0] - 2 * r, bad.shape[1] - 2 * r
    a, b = r - n, r + n + 1
    return total[b: b + h, b: b + w] - total[a: a + h, b: b + w] - total[b: b + h, a: a + w] + total[a: a + h, a: a + w] > 0


def erode(tiles: DataFrame, size: int, n: int) -> DataFrame:
    """Plane ok (1 or 0): v is valid after n erosions by a 3 x 3 box; beyond the border counts as valid."""
    def work(padded, there, _):
        gap = there & (np.isnan(padded["v"]) | (padded["v"] == 0))
        return {"ok": ~_near(gap, n, n)}

    return around(tiles, n, size, ["v"], work, ["ok"])


def shrink(tiles: DataFrame, size: int, deltas: DataFrame) -> DataFrame:
    """Plane ok shrunk by the reach of a kernel of delta pixels (frame, delta), as pixels.shrink does: beyond the border counts as
    invalid, and frames without a gap or a positive delta stay."""
    def gaps(batches):
        for batch in batches:
            n = [int((np.frombuffer(b) != 1).sum()) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["frame", "gaps"])

    reach = F.ceil(4 * F.col("delta") / float(np.sqrt(8 * np.log(2)))).cast("int")
    known = deltas.select(F.col("frame").cast("long").alias("frame"), F.when(F.col("delta") > 0, reach).otherwise(0).alias("reach"))
    most = known.agg(F.coalesce(F.max("reach"), F.lit(0))).first()[0]
    torn = tiles.select("frame", "ok").mapInArrow(gaps, "frame long, gaps long").groupBy("frame").agg(F.sum("gaps").alias("gaps")).where("gaps > 0").select("frame")
    own = known.join(torn, "frame", "left_semi")

    def work(padded, there, n):
        core = (slice(most, -most or None), slice(most, -most or None))
        ok = padded["ok"] == 1
        return {"ok": ok[core] & ~_near(~(there & ok), n, most) if n else ok[core]}

    ready = tiles.join(own, "frame", "left").withColumn("reach", F.coalesce("reach", F.lit(0)))
    return around(ready, most, size, ["ok"], work, ["ok"], extra="reach")


# ---- stacks ----

_PART = "ty int, tx int, part int, h int, w int, n int, {}"


def _parts(tiles: DataFrame, budget: int) -> Callable[[int], int]:
    """Pixels of a run, so that all frames of a tile hold `budget` values in it at most (one pixel at least)."""
    deep = tiles.groupBy("ty", "tx").count().agg(F.coalesce(F.max("count"), F.lit(1))).first()[0]
    return max(1, budget // deep)


def _deal(run: int, partial: bool):
    """Rows of runs of pixels: the frames of a batch that share a tile together, or with partial their sums."""
    def deal(batches):
        for batch in batches:
            held: dict[tuple, list] = {}
            for t in batch.to_pylist():
                held.setdefault((t["ty"], t["tx"], t["h"], t["w"]), []).append((np.frombuffer(t["v"]), np.frombuffer(t["wt"]), t["f"]))
            rows: dict[str, list] = {c: [] for c in ("ty", "tx", "part", "h", "w", "n", "a", "b", "c")}
            for (ty, tx, h, w), frames in held.items():
                v, wt = np.stack([x[0] for x in frames]), np.stack([x[1] for x in frames])
                f = np.array([x[2] for x in frames], np.float64)[:, None]
                planes = _sums(v, wt, f)[:, None] if partial else (v, wt, np.broadcast_to(f, v.shape))
                for part, lo in enumerate(range(0, h * w, run)):
                    for c, x in zip(("ty", "tx", "part", "h", "w", "n"), (ty, tx, part, h, w, planes[0].shape[0]), strict=True):
                        rows[c].append(x)
                    for c, x in zip("abc", planes, strict=True):
                        rows[c].append(_plane(x[:, lo: lo + run] if partial or c != "c" else x[:, :1]))
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary() if c in "abc" else pa.int32()) for c, v in rows.items()], list(rows))

    return deal


def _sums(v: np.ndarray, wt: np.ndarray, f: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
    """Sums over frames of w' f v, of w' = w / f**2, and the number of values."""
    ok = ~np.isnan(v) & (v != 0) & (wt > 0)
    if keep is not None:
        ok &= keep
    w = np.where(ok, wt / (f * f), 0.0)
    return np.stack([(w * np.where(ok, f * v, 0.0)).sum(0), w.sum(0), ok.sum(0)])


def _median(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Median over frames of the n values that aren't NaN; NaN where n is 0."""
    x = np.sort(x, 0)
    at = np.arange(x.shape[1])
    return (x[np.maximum((n + 1) // 2 - 1, 0), at] + x[np.minimum(n // 2, len(x) - 1), at]) / 2


def _penalty(n: np.ndarray) -> np.ndarray:
    count, value = np.array(MEDIAN_PENALTY).T
    return np.interp(-1 / np.maximum(n, 1), -1 / count, value)


def stack(tiles: DataFrame, method: str = "mean", kappa: float = 3.0, slack: float = 0.1, budget: int = BUDGET) -> DataFrame:
    """Tiles without a frame, planes v, weight and n, of tiles with planes v and wt and a factor f, by method mean, median or clipped: what
    mean_coadd, median_coadd and clipped_coadd of `pixels` give. v is NaN where no frame has a value.

    Means add up in the tasks first; for the others all values of a run of pixels meet, each shuffled once."""
    run = _parts(tiles, budget)
    names = ["v", "weight", "n"]

    def join(key: tuple, group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        ty, tx, part, h, w = (rows[0][c] for c in ("ty", "tx", "part", "h", "w"))
        if method == "mean":
            total = np.sum([[_array(r[c], -1) for c in "abc"] for r in rows], 0)
        else:
            v, wt = (np.concatenate([_array(r[c], r["n"], -1) for r in rows]) for c in "ab")
            f = np.concatenate([_array(r["c"], r["n"], 1) for r in rows])
            ok = ~np.isnan(v) & (v != 0) & (wt > 0)
            n = ok.sum(0)
            middle = _median(np.where(ok, f * v, np.nan), n)
            if method == "clipped":
                with np.errstate(invalid="ignore", divide="ignore"):
                    total = _sums(v, wt, f, np.abs(f * v - middle) <= kappa * f / np.sqrt(wt) + slack * np.abs(middle))
            else:
                spread = np.where(ok, f * f / np.where(ok, wt, 1), 0).sum(0)
                weight = np.divide(n * n, spread * _penalty(n), out=np.zeros(len(n)), where=n > 0)
                out = middle, weight, n
        if method != "median":
            out = np.divide(total[0], total[1], out=np.full(len(total[0]), np.nan), where=total[1] > 0), total[1], total[2]
        head = {c: pa.array([x], pa.int32()) for c, x in (("ty", ty), ("tx", tx), ("part", part), ("h", h), ("w", w))}
        return pa.table({**head, **{c: pa.array([_plane(a)], pa.binary()) for c, a in zip(names, out, strict=True)}})

    dealt = tiles.select("ty", "tx", "h", "w", F.col("f").cast("double").alias("f"), "v", "wt").mapInArrow(_deal(run, method == "mean"), _PART.format("a binary, b binary, c binary"))
    done = dealt.groupBy("ty", "tx", "part").applyInArrow(join, "ty int, tx int, part int, h int, w int, v binary, weight binary, n binary")
    joined = lambda p: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", p))), lambda x: F.hex(x[p])), "")
    return done.groupBy("ty", "tx", "h", "w").agg(*(F.unhex(joined(p)).alias(p) for p in names)).select(F.lit(0).cast("long").alias("frame"), "ty", "tx", "h", "w", *names)

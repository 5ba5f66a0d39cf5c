"""Ground: chunks with buffers, classification, terrain rasters, and heights above ground.

A raster is a relation (col, row, value) over a lattice of `resolution` with its corner at
(x0, y0); a cell without a row has no data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from understory.functions.scalars import in_cells, snapped
from understory.operators.delaunay import interpolate, interpolated, triangulate
from understory.streaming.ingest import state_folder

#: Raster cells whose broadcast is asked for at most.
BROADCAST_CELLS = 1_000_000
#: Small cells with their triangles (some 600 bytes each) whose broadcast is asked for at most.
BROADCAST_SURFACE = 50_000
#: Metres from the surface within which a point is ground without becoming a corner of it.
FLAT = 0.15


def snapped_bounds(extents: DataFrame, resolution: float) -> DataFrame:
    """extents (xmin, ymin, xmax, ymax) with the covering cell bounds gx0, gy0, gx1, gy1; empty spans get one cell."""
    low = {n: F.floor(snapped(F.col(c), resolution)) * F.lit(resolution) for n, c in (("gx0", "xmin"), ("gy0", "ymin"))}
    high = {n: F.ceil(snapped(F.col(c), resolution)) * F.lit(resolution) for n, c in (("gx1", "xmax"), ("gy1", "ymax"))}
    found = extents.withColumns(low | high)
    return found.withColumns({b: F.when(F.col(b) <= F.col(a), F.col(a) + F.lit(resolution)).otherwise(F.col(b)) for a, b in (("gx0", "gx1"), ("gy0", "gy1"))})


def covers(outer: tuple[float, float, float, float], inner: tuple[float, float, float, float], resolution: float) -> bool:
    """Whether a raster's bounds hold a point extent, within a billionth of a cell or 16 ulps."""
    slack = max(resolution * 1e-9, np.finfo(float).eps * max(map(abs, (*outer, *inner))) * 16)
    return outer[0] <= inner[0] + slack and outer[1] <= inner[1] + slack and outer[2] >= inner[2] - slack and outer[3] >= inner[3] - slack


def chunked(points: DataFrame, x0: float, y0: float, size: float, buffer: float) -> DataFrame:
    """points once for each chunk whose buffered square holds them: chunk_x, chunk_y, in_core.

    A point is sent to its own chunk and to those it is within the buffer of.
    """
    def reach(c: str, origin: float) -> tuple:
        at = F.col(c) - F.lit(origin)
        return F.floor((at - buffer) / size).cast("long"), F.floor((at + buffer) / size).cast("long"), F.floor(at / size).cast("long")

    (a, b, own_x), (c, d, own_y) = reach("x", x0), reach("y", y0)
    spread = points.withColumns({"_ox": own_x, "_oy": own_y}).withColumn("chunk_x", F.explode(F.sequence(a, b))).withColumn("chunk_y", F.explode(F.sequence(c, d)))
    return spread.withColumn("in_core", (F.col("chunk_x") == F.col("_ox")) & (F.col("chunk_y") == F.col("_oy"))).drop("_ox", "_oy")


def nondegenerate(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, usable): at least three distinct XY that aren't on one line."""
    xx, yy, xy = F.var_pop("x"), F.var_pop("y"), F.covar_pop("x", "y")
    flat = xx * yy - xy * xy <= F.lit(1e-9) * xx * yy
    return points.groupBy(*keys).agg(((F.count_distinct("x", "y") >= 3) & ~F.coalesce(flat, F.lit(True))).alias("usable"))


def mosaic(rasters: DataFrame) -> DataFrame:
    """(col, row, value): mean of the overlapping chunk rasters in each cell."""
    return rasters.groupBy("col", "row").agg(F.avg("value").alias("value"))


def normalize_nearest(points: DataFrame, raster: DataFrame, x0: float, y0: float, resolution: float) -> DataFrame:
    """points with h, the height above the raster's cell; points over no data go."""
    cell = {n: F.floor((F.col(c) - F.lit(o)) / F.lit(resolution)).cast("long") for n, c, o in (("col", "x", x0), ("row", "y", y0))}
    joined = points.withColumns(cell).join(_sized(raster.select("col", "row", "value")), ["col", "row"])
    return joined.withColumn("h", F.col("z") - F.col("value")).drop("col", "row", "value")


def normalize_bilinear(points: DataFrame, raster: DataFrame, x0: float, y0: float, resolution: float) -> DataFrame:
    """points with h above the raster interpolated between the four nearest cell centres.

    Weights of missing cells are left out; a point without any of the four goes.
    The raster, the small side, gets a row for each square of four centres with a value;
    a point meets its square in one join, whatever its columns.
    """
    corner = F.array(*(F.struct((F.col("col") - i).alias("_i"), (F.col("row") - j).alias("_j"), F.lit(2 * i + j).alias("k")) for i in (0, 1) for j in (0, 1)))
    sent = raster.select("value", F.inline(corner))
    squares = sent.groupBy("_i", "_j").agg(*(F.max(F.when(F.col("k") == k, F.col("value"))).alias(f"_g{k}") for k in range(4)))
    u, v = ((F.col(c) - F.lit(o)) / F.lit(resolution) - 0.5 for c, o in (("x", x0), ("y", y0)))
    placed = points.withColumns({"_i": F.floor(u).cast("long"), "_j": F.floor(v).cast("long")})
    met = placed.join(_sized(squares), ["_i", "_j"])
    du, dv = u - F.floor(u), v - F.floor(v)
    weights = [(du if i else 1 - du) * (dv if j else 1 - dv) for i in (0, 1) for j in (0, 1)]
    present = [F.when(F.col(f"_g{k}").isNull(), F.lit(0.0)).otherwise(w) for k, w in enumerate(weights)]
    total = present[0] + present[1] + present[2] + present[3]
    sums = [F.when(F.col(f"_g{k}").isNull(), F.lit(0.0)).otherwise(w * F.col(f"_g{k}")) for k, w in enumerate(weights)]
    ground = (sums[0] + sums[1] + sums[2] + sums[3]) / total
    return met.where(total > 0).withColumn("h", F.col("z") - ground).select(*[c for c in points.columns if c != "h"], "h")


def _sized(raster: DataFrame, most: int = BROADCAST_CELLS) -> DataFrame:
    """The raster, broadcast where its counted cells allow."""
    return F.broadcast(raster) if raster.count() <= most else raster


def _saved(rows: DataFrame) -> DataFrame:
    """rows, written and read again."""
    folder = state_folder(rows.sparkSession)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _dealt(points: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """points dealt by chunk into as many partitions as keep all cores busy; small ones aren't put together."""
    spark = points.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return points.repartition(n, *keys)


def classify_ground(points: DataFrame, seed: float = 20.0, angle: float = 30.0, distance: float = 1.0, keys: tuple[str, ...] = ("chunk_x", "chunk_y")) -> DataFrame:
    """points with classification 2 (ground) or 1, by progressive TIN densification in each chunk.

    The lowest point of each seed cell starts a triangulation; points within `distance`
    of it whose angles to the triangle's corners are at most `angle` degrees join, until
    none does.  The lowest point of each small cell (a 20th of a seed cell) may join: all
    that lie within FLAT of the surface at once, others one an eighth of a seed cell and
    round.  At the end all points within FLAT of the surface are ground.  Only the lowest
    points of small cells are gathered by chunk, however many points a chunk has; each point
    meets the triangles of its small cell in a join.
    """
    cell = [*keys, "_i", "_j"]
    placed = points.withColumns({"_i": in_cells(F.col("x"), seed / 20), "_j": in_cells(F.col("y"), seed / 20)})
    low = _saved(placed.groupBy(*cell).agg(F.min("z").alias("_z"), F.count("*").alias("_n")))
    thin = placed.join(_sized(low), cell).where("z = _z").groupBy(*cell, "z", "_n").agg(F.min(F.struct("x", "y")).alias("_at"))

    def run(group: pa.Table) -> pa.Table:
        return _sheets(group, list(keys), seed, angle, distance)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in low.select(*cell).schema) + ", _gx double, _gy double, _gz double, _low double, _high double, _sides array<struct<" + ", ".join(f"{n}: double" for n in _SIDES) + ">>"
    sheets = _saved(_dealt(thin.select(*cell, "_n", "_at.x", "_at.y", "z"), keys).groupBy(*keys).applyInArrow(run, schema))
    met = placed.join(_sized(sheets, BROADCAST_SURFACE), cell, "left")
    own = (F.col("x") == F.col("_gx")) & (F.col("y") == F.col("_gy")) & (F.col("z") == F.col("_gz"))
    near = F.col("z").between(F.col("_low") - FLAT - 1e-6, F.col("_high") + FLAT + 1e-6)
    ground = F.when(own, True).when(near, F.abs(F.col("z") - _surface_at(F.col("x"), F.col("y"))) <= FLAT)
    names = [*points.columns, *([] if "classification" in points.columns else ["classification"])]
    return met.withColumn("classification", F.when(F.coalesce(ground, F.lit(False)), 2).otherwise(1)).select(*names)


#: Corners of a triangle.
_SIDES = [f"{corner}{c}" for corner in "abc" for c in "xyz"]


def _surface_at(x: Column, y: Column) -> Column:
    """Height of the first of the cell's triangles that holds a place, null where none does; as interpolate()."""

    def weights(t: Column) -> tuple[Column, Column, Column]:
        det = (t.by - t.cy) * (t.ax - t.cx) + (t.cx - t.bx) * (t.ay - t.cy)
        u = ((t.by - t.cy) * (x - t.cx) + (t.cx - t.bx) * (y - t.cy)) / det
        v = ((t.cy - t.ay) * (x - t.cx) + (t.ax - t.cx) * (y - t.cy)) / det
        return u, v, 1 - u - v

    def holds(t: Column) -> Column:
        u, v, w = weights(t)
        return (u >= -1e-9) & (v >= -1e-9) & (w >= -1e-9)

    def height(t: Column) -> Column:
        u, v, w = weights(t)
        return u * t.az + v * t.bz + w * t.cz

    return F.get(F.transform(F.filter("_sides", holds), height), F.lit(0))


def _sheets(group: pa.Table, keys: list[str], seed: float, angle: float, distance: float) -> pa.Table:
    """The small cells of a chunk: their lowest point if it is ground, the surface's triangles in them and its bounds."""
    xyz = np.column_stack([group[c].to_numpy() for c in "xyz"])
    cells = np.column_stack([group["_i"].to_numpy(), group["_j"].to_numpy()])
    order = np.lexsort((cells[:, 1], cells[:, 0]))
    group, xyz, cells = group.take(order), xyz[order], cells[order]
    if int(group["_n"].to_numpy().sum()) < 3:
        mask, base, triangles = np.zeros(len(xyz), bool), xyz, np.zeros((0, 3), np.int64)
    else:
        mask, base, triangles = _grown(xyz, seed, angle, distance)
    a, b, c = (base[triangles[:, i]] for i in range(3))
    triangles = triangles[(b[:, 1] - c[:, 1]) * (a[:, 0] - c[:, 0]) + (c[:, 0] - b[:, 0]) * (a[:, 1] - c[:, 1]) != 0]
    row, t = _touched(base[:, :2], triangles, cells, seed / 20)
    ends = base[triangles[t]]
    offsets = np.searchsorted(row, np.arange(len(cells) + 1)).astype(np.int32)
    low, high = np.full(len(cells), np.inf), np.full(len(cells), -np.inf)
    np.minimum.at(low, row, ends[:, :, 2].min(axis=1, initial=np.inf))
    np.maximum.at(high, row, ends[:, :, 2].max(axis=1, initial=-np.inf))
    made = {f"_g{c}": pa.array(xyz[:, k], mask=~mask) for k, c in enumerate("xyz")} | {"_low": pa.array(low), "_high": pa.array(high)}
    sides = pa.StructArray.from_arrays([pa.array(v) for v in ends.reshape(-1, 9).T.copy()], _SIDES)
    made["_sides"] = pa.ListArray.from_arrays(pa.array(offsets), sides)
    return pa.table({n: group[n] for n in [*keys, "_i", "_j"]} | made)


def _touched(places: np.ndarray, triangles: np.ndarray, cells: np.ndarray, size: float, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(cell, triangle) by place in their lists, in this order: the triangles that touch each of the sorted cells."""
    slack = 1e-6
    corners = places[triangles]
    floor = lambda v: np.floor(v / size).astype(np.int64)
    least, span = cells.min(axis=0), np.ptp(cells, axis=0) + 1
    first = np.maximum(floor(corners.min(axis=1, initial=np.inf) - slack), least) - least if len(triangles) else np.zeros((0, 2), np.int64)
    last = np.minimum(floor(corners.max(axis=1, initial=-np.inf) + slack), least + span - 1) - least if len(triangles) else np.zeros((0, 2), np.int64)
    wide = np.maximum(last - first + 1, 0)
    n = wide.prod(axis=1)
    known = (cells[:, 0] - least[0]) * span[1] + cells[:, 1] - least[1]
    parts, begin, total = [], 0, np.concatenate([[0], np.cumsum(n)])
    while begin < len(triangles):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + most, "right")) - 1)
        t = np.repeat(np.arange(begin, end), n[begin:end])
        step = np.arange(len(t)) - (total[t] - total[begin])
        i, j = first[t, 0] + step % np.maximum(wide[t, 0], 1), first[t, 1] + step // np.maximum(wide[t, 0], 1)
        key = i * span[1] + j
        row = np.minimum(np.searchsorted(known, key), len(known) - 1)
        held = known[row] == key
        row, t = row[held], t[held]
        # a cell lies apart from a triangle if it lies beyond one of its sides
        corner, near = corners[t], cells[row] * size
        touch = np.ones(len(row), bool)
        for k in range(3):
            p, q = corner[:, k], corner[:, (k + 1) % 3]
            dx, dy = q[:, 0] - p[:, 0], q[:, 1] - p[:, 1]
            x = np.where(dy > 0, near[:, 0] - slack, near[:, 0] + size + slack)
            y = np.where(dx > 0, near[:, 1] + size + slack, near[:, 1] - slack)
            touch &= dx * (y - p[:, 1]) - dy * (x - p[:, 0]) >= 0
        parts.append(np.column_stack([row[touch], t[touch]]))
        begin = end
    found = np.vstack([np.zeros((0, 2), np.int64), *parts])
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    return found[:, 0], found[:, 1]


def _ground_points(xyz: np.ndarray, seed: float, angle: float, distance: float) -> np.ndarray:
    """Mask of the ground points of one chunk that is at hand as a whole."""
    whole = np.zeros(len(xyz), bool)
    if len(xyz) < 3:
        return whole
    thin = _lowest(xyz, seed / 20, np.zeros(2))
    mask, base, triangles = _grown(xyz[thin], seed, angle, distance)
    surface, at = interpolate(base, triangles, xyz[:, :2])
    whole[thin[mask]] = True
    return whole | ((at >= 0) & (np.abs(xyz[:, 2] - surface) <= FLAT))


def _grown(xyz: np.ndarray, seed: float, angle: float, distance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mask, corners, triangles): which of the lowest points of small cells are ground, and their surface."""
    mask = np.zeros(len(xyz), bool)
    origin = xyz[:, :2].min(axis=0)
    mask[_lowest(xyz, seed)] = True
    # the chunk's corners at the height of the nearest seeds, so that every point is inside
    limit = math.tan(math.radians(angle))
    while True:  # every round adds a point
        ground = xyz[mask]
        low, high = xyz[:, :2].min(axis=0) - seed, xyz[:, :2].max(axis=0) + seed
        corners = np.array([[low[0], low[1]], [high[0], low[1]], [high[0], high[1]], [low[0], high[1]]])
        nearest = ((corners[:, None, :] - ground[None, :, :2]) ** 2).sum(axis=2).argmin(axis=1)
        base = np.vstack([ground, np.column_stack([corners, ground[nearest, 2]])])
        triangles = triangulate(base[:, :2])
        surface, at = interpolate(base, triangles, xyz[:, :2])
        off = xyz[:, 2] - surface
        todo = ~mask & (at >= 0) & (np.abs(off) <= distance)
        flat = todo & (np.abs(off) <= FLAT)
        if flat.any():
            mask |= flat
            continue
        if not todo.any():
            break
        ends = base[triangles[at[todo]]]
        away = np.sqrt(((ends[:, :, :2] - xyz[todo][:, None, :2]) ** 2).sum(axis=2))
        slopes = np.abs(off[todo])[:, None] / np.maximum(away, 1e-9)
        good = np.flatnonzero(todo)[(slopes <= limit).all(axis=1)]
        if not len(good):
            break
        part = np.floor((xyz[good, :2] - origin) / max(seed / 8, 1e-6)).astype(np.int64)
        order = np.lexsort((xyz[good, 1], xyz[good, 0], np.abs(off[good]), part[:, 1], part[:, 0]))
        first = np.ones(len(order), bool)
        first[1:] = (part[order][1:] != part[order][:-1]).any(axis=1)
        mask[good[order[first]]] = True
    return mask, base, triangles


def _lowest(xyz: np.ndarray, size: float, origin: np.ndarray | None = None) -> np.ndarray:
    """Index of the lowest point of each square cell, counted from the least x and y or an origin; of equal ones least x, then y."""
    cell = np.floor((xyz[:, :2] - (xyz[:, :2].min(axis=0) if origin is None else origin)) / size).astype(np.int64)
    order = np.lexsort((xyz[:, 1], xyz[:, 0], xyz[:, 2], cell[:, 1], cell[:, 0]))
    first = np.ones(len(order), bool)
    first[1:] = (cell[order][1:] != cell[order][:-1]).any(axis=1)
    return order[first]


def tin_raster(points: DataFrame, x0: float, y0: float, resolution: float, chunk: float, keys: tuple[str, ...] = ("chunk_x", "chunk_y")) -> DataFrame:
    """(chunk_x, chunk_y, col, row, value): ground points of a chunk interpolated at its core's cell centres.

    Delaunay triangles with linear interpolation.  A chunk with fewer than three ground
    points, or all on one line, has no cells.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return _surface(pdf[["x", "y", "z"]].to_numpy(float), int(pdf.chunk_x.iloc[0]), int(pdf.chunk_y.iloc[0]), x0, y0, resolution, chunk)

    ground = points.where("classification = 2").select(*dict.fromkeys([*keys, "chunk_x", "chunk_y", "x", "y", "z"]))
    return _dealt(ground, keys).groupBy(*keys).applyInPandas(run, _CELLS)


_CELLS = "chunk_x long, chunk_y long, col long, row long, value double"


def _surface(xyz: np.ndarray, cx: int, cy: int, x0: float, y0: float, resolution: float, chunk: float) -> pd.DataFrame:
    """Cells of a chunk's core from its ground points; of points at one place the lowest counts."""
    xyz = xyz[np.lexsort((xyz[:, 2], xyz[:, 1], xyz[:, 0]))]
    once = np.ones(len(xyz), bool)
    once[1:] = (xyz[1:, :2] != xyz[:-1, :2]).any(axis=1)
    xyz = xyz[once]
    n = max(1, round(chunk / resolution))
    cols, rows = np.meshgrid(np.arange(cx * n, (cx + 1) * n), np.arange(cy * n, (cy + 1) * n))
    centres = np.column_stack([x0 + (cols.ravel() + 0.5) * resolution, y0 + (rows.ravel() + 0.5) * resolution])
    value, ok = interpolated(xyz, centres)
    return pd.DataFrame({"chunk_x": cx, "chunk_y": cy, "col": cols.ravel()[ok], "row": rows.ravel()[ok], "value": value[ok]})


def terrain(points: DataFrame, x0: float, y0: float, resolution: float = 1.0, chunk: float = 60.0, buffer: float = 20.0, seed: float = 20.0, classified: bool = False, angle: float = 30.0, distance: float = 1.0) -> DataFrame:
    """(col, row, value): the terrain raster of points; classifies ground first unless it is classified.

    Ground points are the only ones gathered by chunk.
    """
    spread = chunked(points.select("x", "y", "z", *(["classification"] if classified else [])), x0, y0, chunk, buffer).drop("in_core")
    return mosaic(tin_raster(spread if classified else classify_ground(spread, seed, angle, distance), x0, y0, resolution, chunk))

"""Segments (trees): voxels, layers, apexes, extents, gates, their tiles and per-tile metrics."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from understory.functions.aggregates import arg_max, gini_of, ranked
from understory.functions.scalars import fail_reason, finite, in_cells
from understory.operators.grid import lattice_join
from understory.operators.voxels import within_heights
from understory.params import Parameters

KEYS = ["instance_dimension", "instance_id"]
#: Gates by column, with their names in fail reasons.
GATES = (("pass_voxels", "voxels"), ("pass_apex", "apex"), ("pass_thickness", "thickness"), ("pass_occupied_layers", "layers"))


def valid(points: DataFrame, p: Parameters) -> DataFrame:
    """Long points of a finite, positive segment id within the height range."""
    return within_heights(points.where(finite(F.col("instance_id")) & (F.col("instance_id") > 0)), p.maximum_height)


def voxels(points: DataFrame, p: Parameters) -> DataFrame:
    """(keys, voxel_x, voxel_y, voxel_z): distinct occupied voxels, cells counted from 0 in all three."""
    r = p.voxel_resolution
    return points.select(*KEYS, *(in_cells(F.col(c), r).alias(f"voxel_{n}") for c, n in (("x", "x"), ("y", "y"), ("h", "z")))).distinct()


def layers(points: DataFrame) -> DataFrame:
    """(keys, occupied_layer): distinct whole metres of height."""
    return points.select(*KEYS, F.floor("h").cast("long").alias("occupied_layer")).distinct()


def apexes(points: DataFrame) -> DataFrame:
    """(keys, apex_x, apex_y, apex_z): the highest point; of equal ones least pid, x, y."""
    return arg_max(points, KEYS, "h", ["pid", "x", "y"], {"x": "apex_x", "y": "apex_y", "h": "apex_z"})


def counts(voxel_rows: DataFrame, p: Parameters) -> DataFrame:
    """(keys, n_vox, voxel_volume)."""
    return voxel_rows.groupBy(*KEYS).agg(F.count("*").cast("int").alias("n_vox")).withColumn("voxel_volume", F.col("n_vox") * F.lit(p.voxel_resolution**3))


def crowns(voxel_rows: DataFrame, p: Parameters) -> DataFrame:
    """(keys, crown_area): distinct voxel columns times their area."""
    return voxel_rows.groupBy(*KEYS).agg((F.count_distinct("voxel_x", "voxel_y") * F.lit(p.voxel_resolution**2)).alias("crown_area"))


def layer_totals(layer_rows: DataFrame) -> DataFrame:
    """(keys, n_occupied_layers)."""
    return layer_rows.groupBy(*KEYS).agg(F.count("*").cast("int").alias("n_occupied_layers"))


def _eigen(c: dict[str, Column]) -> list[Column]:
    """Eigenvalues, greatest first, of a symmetric matrix of xx, xy, xz, yy, yz, zz in closed form."""
    q = (c["xx"] + c["yy"] + c["zz"]) / 3
    off = c["xy"] * c["xy"] + c["xz"] * c["xz"] + c["yz"] * c["yz"]
    p2 = (c["xx"] - q) * (c["xx"] - q) + (c["yy"] - q) * (c["yy"] - q) + (c["zz"] - q) * (c["zz"] - q) + 2 * off
    s = F.sqrt(p2 / 6)
    a, b, d = (c["xx"] - q) / s, (c["yy"] - q) / s, (c["zz"] - q) / s
    e, f, g = c["xy"] / s, c["xz"] / s, c["yz"] / s
    det = a * (b * d - g * g) - e * (e * d - g * f) + f * (e * g - b * f)
    phi = F.acos(F.greatest(F.least(det / 2, F.lit(1.0)), F.lit(-1.0))) / 3
    first = q + 2 * s * F.cos(phi)
    last = q + 2 * s * F.cos(phi + F.lit(2.0943951023931953))
    flat = p2 <= 0
    return [F.when(flat, q).otherwise(first), F.when(flat, q).otherwise(3 * q - first - last), F.when(flat, q).otherwise(last)]


def _vector(c: dict[str, Column], value: Column) -> Column:
    """A unit eigenvector as struct(x, y, z): the longest cross product of two rows of the shifted matrix."""
    r1 = (c["xx"] - value, c["xy"], c["xz"])
    r2 = (c["xy"], c["yy"] - value, c["yz"])
    r3 = (c["xz"], c["yz"], c["zz"] - value)

    def cross(u, v):
        return (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])

    options = [cross(r1, r2), cross(r1, r3), cross(r2, r3)]
    structs = [F.struct((o[0] * o[0] + o[1] * o[1] + o[2] * o[2]).alias("n"), o[0].alias("x"), o[1].alias("y"), o[2].alias("z")) for o in options]
    return F.greatest(*structs)


def extents(voxel_rows: DataFrame, p: Parameters) -> DataFrame:
    """(keys, pca_extent_1..3): range of the voxels along their principal axes; null for fewer than 3 voxels.

    One aggregation for covariances, a closed-form eigen-decomposition, and one for the
    ranges along the axes; no Python.  Covariances are of whole numbers of voxels and exact,
    so that the order of rows doesn't count.  Equal values leave axes open: then the axis is
    the coordinate axis across the one that isn't, made perpendicular to it; x and z if all
    are equal.  The middle axis is the cross product of the others.
    """
    whole = {k: F.col(f"voxel_{k}").cast("decimal(20,0)") for k in "xyz"}
    names = ("xx", "xy", "xz", "yy", "yz", "zz")
    sums = voxel_rows.groupBy(*KEYS).agg(
        F.count("*").alias("_n"), *(F.min(f"voxel_{k}").alias(f"m{k}") for k in "xyz"), *(F.sum(whole[k]).alias(f"s{k}") for k in "xyz"), *(F.sum(whole[n[0]] * whole[n[1]]).alias(f"s{n}") for n in names)
    )
    c = {n: F.col(n) for n in names}
    means = [f"m{k}" for k in "xyz"]
    n = F.col("_n").cast("decimal(20,0)")
    squared = F.col("_n").cast("double") * F.col("_n")
    stats = sums.select(*KEYS, "_n", *means, *(((n * F.col(f"s{k}") - F.col(f"s{k[0]}") * F.col(f"s{k[1]}")).cast("double") / squared).alias(k) for k in names))
    stats = stats.withColumns({f"l{i}": v for i, v in enumerate(_eigen(c), 1)})
    stats = stats.withColumn("v1", _vector(c, F.col("l1"))).withColumn("v3", _vector(c, F.col("l3")))
    slack = (F.col("l1") - F.col("l3")) * 1e-7 + (F.col("l1") + F.col("l2") + F.col("l3")) * 1e-12
    stats = stats.withColumns({"_same12": F.col("l1") - F.col("l2") <= slack, "_same23": F.col("l2") - F.col("l3") <= slack})

    def unit(x: list[Column]) -> Column:
        length = F.sqrt(x[0] * x[0] + x[1] * x[1] + x[2] * x[2])
        return F.struct(*(F.try_divide(v, length).alias(k) for v, k in zip(x, "xyz", strict=True)))

    def of(v: str) -> list[Column]:
        return [F.col(f"{v}.{k}") for k in "xyz"]

    def axis(k: str) -> list[Column]:
        return [F.lit(float(k == j)) for j in "xyz"]

    def across(v: str, order: str) -> Column:
        """The coordinate axis least along v, the first in order of equal ones, less its part along v."""
        made = {k: unit([e - F.col(f"{v}.{k}") * x for e, x in zip(axis(k), of(v), strict=True)]) for k in order}
        size = {k: F.abs(F.col(f"{v}.{k}")) for k in order}
        i, j, k = order
        return F.when((size[i] <= size[j]) & (size[i] <= size[k]), made[i]).when(size[j] <= size[k], made[j]).otherwise(made[k])

    every = F.col("_same12") & F.col("_same23")
    frame = stats.withColumn("_a", F.when(every, unit(axis("x"))).when(~F.col("_same12"), unit(of("v1"))))
    frame = frame.withColumn("_c", F.when(every, unit(axis("z"))).when(F.col("_same23"), across("_a", "zyx")).otherwise(unit(of("v3"))))
    frame = frame.withColumn("_a", F.coalesce(F.col("_a"), across("_c", "xyz")))
    frame = frame.select(*KEYS, "_n", *means, *(F.col(f"_a.{k}").alias(f"a{k}") for k in "xyz"), *(F.col(f"_c.{k}").alias(f"c{k}") for k in "xyz"))
    cross = [F.col("cy") * F.col("az") - F.col("cz") * F.col("ay"), F.col("cz") * F.col("ax") - F.col("cx") * F.col("az"), F.col("cx") * F.col("ay") - F.col("cy") * F.col("ax")]
    frame = frame.withColumns({f"b{k}": x for k, x in zip("xyz", cross, strict=True)})
    turned = voxel_rows.join(frame, KEYS)
    spans = []
    for i, name in enumerate("abc", 1):
        along = sum(((F.col(f"voxel_{k}") - F.col(f"m{k}")) * F.col(f"{name}{k}") for k in "xyz"), F.lit(0.0))
        spans.append(F.when(F.max("_n") >= 3, (F.max(along) - F.min(along)) * F.lit(p.voxel_resolution)).alias(f"pca_extent_{i}"))
    return turned.groupBy(*KEYS).agg(*spans)


def merge(parts: list[DataFrame]) -> DataFrame:
    """Full outer join of segment relations on their keys."""
    return reduce(lambda a, b: a.join(b, KEYS, "full_outer"), parts)


def gated(segments: DataFrame, p: Parameters) -> DataFrame:
    """segments with the four gates, is_tree and fail_reason."""
    s = segments.withColumns(
        {
            "pass_voxels": F.col("n_vox") >= p.minimum_tree_voxels,
            "pass_apex": F.col("apex_z") > p.apex_minimum_height,
            "pass_thickness": F.coalesce(F.col("pca_extent_3") >= p.minimum_tree_thickness, F.lit(False)),
            "pass_occupied_layers": F.col("n_occupied_layers") >= p.minimum_occupied_layers,
        }
    )
    s = s.withColumn("is_tree", F.col("pass_voxels") & F.col("pass_apex") & F.col("pass_thickness") & F.col("pass_occupied_layers"))
    return s.withColumn("fail_reason", fail_reason(*((name, F.col(c)) for c, name in GATES)))


def segment_table(points: DataFrame, p: Parameters, kept: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """All segment measures from long points (x, y, h, pid, keys); kept as in voxels.tile_metrics()."""
    rows = valid(points, p)
    v = kept(voxels(rows, p))
    stats = v.groupBy(*KEYS).agg(F.count("*").cast("int").alias("n_vox"), (F.count_distinct("voxel_x", "voxel_y") * F.lit(p.voxel_resolution**2)).alias("crown_area"))
    stats = stats.withColumn("voxel_volume", F.col("n_vox") * F.lit(p.voxel_resolution**3))
    return gated(merge([apexes(rows), stats, layer_totals(layers(rows)), extents(v, p)]), p)


def assign_tiles(segments: DataFrame, tiles: DataFrame) -> DataFrame:
    """segments with the tile_id of their apex's tile, null outside of all; half-open bounds."""
    return lattice_join(segments, tiles, "apex_x", "apex_y", "left")


def tree_metrics(segments: DataFrame) -> DataFrame:
    """(tile_id, n_seg_total, n_trees, tree_*) of tiles with segments; measures are of accepted ones."""
    measures = {"height": "apex_z", "crownarea": "crown_area", "volume": "voxel_volume"}
    placed = segments.where("tile_id IS NOT NULL").select("tile_id", "is_tree", *(F.when(F.col("is_tree"), F.col(c)).alias(n) for n, c in measures.items()))
    aggs = [F.count("*").cast("int").alias("n_seg_total"), F.count_if("is_tree").cast("int").alias("n_trees")]
    for name in measures:
        aggs += [F.max(name).alias(f"tree_{name}_max"), F.avg(name).alias(f"tree_{name}_mean"), gini_of(name).alias(f"tree_{name}_gini")]
    return ranked(placed, ["tile_id"], list(measures)).groupBy("tile_id").agg(*aggs)

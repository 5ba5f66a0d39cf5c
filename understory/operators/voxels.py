"""Voxels, canopy cells and the per-tile statistics of both.

Tile voxels: cells of `resolution` in x and y counted from 0, heights at the nearest
multiple of the resolution.  Indices stay integers throughout, so no level is merged by
rounding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from understory.functions.aggregates import entropy_share, moments, slope
from understory.functions.scalars import finite, in_cells, layer_bin, layers_to
from understory.params import Parameters


def within_heights(points: DataFrame, maximum: float, height: str = "h") -> DataFrame:
    """Points of finite height from 0 to the maximum, both included."""
    return points.where(finite(F.col(height)) & (F.col(height) >= 0) & (F.col(height) <= maximum))


def tile_voxels(points: DataFrame, resolution: float, keys: tuple[str, ...] = ("tile_id",), height: str = "h") -> DataFrame:
    """(keys, vx, vy, vz): occupied voxels; vz is the height in multiples of the resolution."""
    level = F.floor(F.col(height) / F.lit(resolution) + 0.5).cast("long")
    return points.select(*keys, in_cells(F.col("x"), resolution).alias("vx"), in_cells(F.col("y"), resolution).alias("vy"), level.alias("vz")).distinct()


def with_height(voxels: DataFrame, resolution: float) -> DataFrame:
    return voxels.withColumn("z", F.col("vz") * F.lit(resolution))


def vegetation(voxels: DataFrame, p: Parameters) -> DataFrame:
    """Voxels strictly above the vegetation's lowest height, with z."""
    return with_height(voxels, p.voxel_resolution).where(F.col("z") > p.vegetation_minimum_height)


def heights(voxels: DataFrame, p: Parameters) -> DataFrame:
    """(tile_id, height_max, height_mean) of all voxels."""
    return with_height(voxels, p.voxel_resolution).groupBy("tile_id").agg(F.max("z").alias("height_max"), F.avg("z").alias("height_mean"))


def density(voxels: DataFrame, p: Parameters) -> DataFrame:
    """(tile_id, vox_filled, vox_total, veg_density) of tiles with vegetation."""
    filled = vegetation(voxels, p).groupBy("tile_id").agg(F.count("*").cast("int").alias("vox_filled"))
    return filled.select("tile_id", "vox_filled", F.lit(p.voxel_total).alias("vox_total"), (F.col("vox_filled") / F.lit(float(p.voxel_total))).alias("veg_density"))


def height_moments(voxels: DataFrame, p: Parameters) -> DataFrame:
    """(tile_id, zsd, zskew, zkurt, zq90) of vegetation voxels."""
    return vegetation(voxels, p).groupBy("tile_id").agg(*(c.alias(n) for n, c in moments("z").items()))


def box_counts(voxels: DataFrame, p: Parameters) -> DataFrame:
    """(tile_id, factor, boxes): vegetation boxes of each width, in voxels; one pass over all widths."""
    scaled = vegetation(voxels, p).withColumn("factor", F.explode(F.array(*map(F.lit, p.box_factors))))
    coarse = [F.floor(F.col(c) / F.col("factor")).cast("long").alias(c) for c in ("vx", "vy", "vz")]
    return scaled.select("tile_id", "factor", *coarse).distinct().groupBy("tile_id", "factor").agg(F.count("*").alias("boxes"))


def box_dimension(voxels: DataFrame, p: Parameters) -> DataFrame:
    """(tile_id, box_dim_fixed): slope of the logarithm of boxes on that of one over their width."""
    counts = box_counts(voxels, p)
    inverse = F.ln(F.lit(1.0) / (F.col("factor") * F.lit(p.voxel_resolution)))
    return counts.groupBy("tile_id").agg(slope(F.ln(F.col("boxes").cast("double")), inverse).alias("box_dim_fixed"))


def layer_counts(voxels: DataFrame, p: Parameters) -> DataFrame:
    """(tile_id, layer, n): vegetation voxels in each 1 m layer up to the last whole one."""
    levels = layers_to(p.maximum_height)
    kept = vegetation(voxels, p).withColumn("layer", layer_bin(F.col("z"))).where(F.col("z") <= levels)
    return kept.groupBy("tile_id", "layer").agg(F.count("*").alias("n"))


def vertical_complexity(voxels: DataFrame, p: Parameters) -> DataFrame:
    """(tile_id, vci): entropy of the layers over that of all layers filled alike."""
    return entropy_share(layer_counts(voxels, p), ["tile_id"], "n", layers_to(p.maximum_height), "vci")


def canopy(voxels: DataFrame, p: Parameters, keys: tuple[str, ...] = ("tile_id",)) -> DataFrame:
    """(keys, cx, cy, top): greatest voxel height of each canopy cell with a voxel."""
    centre = lambda c: (F.col(c) + F.lit(0.5)) * F.lit(p.voxel_resolution)
    placed = with_height(voxels, p.voxel_resolution).select(*keys, in_cells(centre("vx"), p.chm_resolution).alias("cx"), in_cells(centre("vy"), p.chm_resolution).alias("cy"), "z")
    return placed.groupBy(*keys, "cx", "cy").agg(F.max("z").alias("top"))


def canopy_statistics(cells: DataFrame, p: Parameters) -> DataFrame:
    """(tile_id, chm_mean, chm_sd, chm_cv, gap_fraction) over observed cells."""
    found = cells.groupBy("tile_id").agg(
        F.avg("top").alias("chm_mean"),
        F.stddev_samp("top").alias("chm_sd"),
        F.avg((F.col("top") < p.gap_height_threshold).cast("double")).alias("gap_fraction"),
    )
    return found.withColumn("chm_cv", F.try_divide("chm_sd", "chm_mean"))


def rumple(cells: DataFrame, p: Parameters) -> DataFrame:
    """(tile_id, rumple): surface area over ground area of the canopy.

    Every square of four neighbouring observed cells is split into two triangles
    through the cell centres; the index is their summed area over their summed ground
    area.  Each cell is sent to the four squares it is a corner of, so corners meet in
    one aggregation; tiles without a whole square have no row.
    """
    r = p.chm_resolution
    corners = F.array(*(F.struct((F.col("cx") - dx).alias("cx"), (F.col("cy") - dy).alias("cy"), F.lit(name).alias("corner")) for name, dx, dy in (("a", 0, 0), ("b", 1, 0), ("c", 0, 1), ("d", 1, 1))))
    sent = cells.select("tile_id", "top", F.inline(corners))
    squares = sent.groupBy("tile_id", "cx", "cy").agg(F.count("*").alias("n"), *(F.max(F.when(F.col("corner") == k, F.col("top"))).alias(k) for k in "abcd")).where("n = 4")

    def triangle(first: str, right: str, second: str) -> F.Column:
        """Area of the triangle of a corner and its two neighbours across a right angle of sides r."""
        u, v = F.col(first) - F.col(right), F.col(second) - F.col(right)
        return F.sqrt(F.lit(r * r) * (u * u + v * v) + F.lit(r**4)) / 2

    area = triangle("a", "b", "d") + triangle("a", "c", "d")
    return squares.groupBy("tile_id").agg((F.sum(area) / (F.count("*") * F.lit(r * r))).alias("rumple"))


def tile_metrics(points: DataFrame, p: Parameters, kept: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """All structure metrics of tiles from their points (tile_id, x, y, h); a row for each tile with points in range.

    Statistics that share a grouping are one aggregation.  kept: what a caller does to
    the distinct voxels, which are read several times, such as persisting them.
    """
    voxels = kept(tile_voxels(within_heights(points, p.maximum_height), p.voxel_resolution))
    z = with_height(voxels, p.voxel_resolution)
    green = F.col("z") > p.vegetation_minimum_height
    over = F.when(green, F.col("z"))
    spread = F.var_pop(over) > 0
    base = z.groupBy("tile_id").agg(
        F.max("z").alias("height_max"),
        F.avg("z").alias("height_mean"),
        F.count_if(green).cast("int").alias("vox_filled"),
        F.stddev_samp(over).alias("zsd"),
        F.when(spread, F.skewness(over)).alias("zskew"),
        F.when(spread, F.kurtosis(over) + 3).alias("zkurt"),
        F.percentile(over, F.lit(0.9)).alias("zq90"),
    )
    cells = canopy(voxels, p)
    parts = (canopy_statistics(cells, p), rumple(cells, p), box_dimension(voxels, p), vertical_complexity(voxels, p))
    for part in parts:
        base = base.join(part, "tile_id", "left")
    return base

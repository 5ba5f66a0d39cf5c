"""The queries' shared inputs: the virtual cloud, its tiles and its segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from understory.operators import grid, segments, voxels
from understory.params import Parameters
from understory.sources import points

P = Parameters()
#: Inclusion and exclusion rectangles, and one off the lattice for the placement search.
AOI = (412346.0, 5733158.0, 412386.0, 5733198.0)
EXCLUSION = (412363.0, 5733155.0, 412379.0, 5733172.0)
WIDE_AOI = (412337.3, 5733149.2, 412395.1, 5733203.7)
DIMENSIONS = ["PredInstance", "PredInstance_SAT"]
FILE = "virtual"


def cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.virtual(spark, sf_dir)


def tiles(spark: SparkSession) -> DataFrame:
    """The tiles of the AOI."""
    return grid.optimized(spark, [AOI], P.tile_size, P.grid_search_step)


def tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the AOI's tiles: tile_id, x, y, h."""
    return grid.lattice_join(cloud(spark, sf_dir).select("pid", "x", "y", "h"), tiles(spark), columns=["tile_id"])


def tile_voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voxels.tile_voxels(voxels.within_heights(tiled(spark, sf_dir), P.maximum_height), P.voxel_resolution)


def long_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by segment-id attribute."""
    return points.unpivot(cloud(spark, sf_dir).select("pid", "x", "y", "h", *DIMENSIONS), DIMENSIONS)


def valid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.valid(long_points(spark, sf_dir), P)


def segment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of all attributes with their tile."""
    return segments.assign_tiles(segments.segment_table(long_points(spark, sf_dir), P), tiles(spark))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that two engines' last digits don't matter; a zero has no sign."""
    return df.select(*(F.round(F.col(f.name), digits).alias(f.name) + F.lit(0.0) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema)).toDF(*df.columns)

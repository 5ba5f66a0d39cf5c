"""All queries of the point-cloud engine, over the virtual cloud, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from understory.functions.aggregates import gini
from understory.functions.scalars import bucket, safe_xy_scale
from understory.operators import grid, results, segments, terrain, voxels
from understory.plans import oracle, virtual
from understory.plans.virtual import AOI, EXCLUSION, FILE, WIDE_AOI, P, rounded
from understory.sources import aoi, points
from understory.streaming.ingest import SegmentIngest, state_folder

Query = Callable[[SparkSession, str], DataFrame]
X0, Y0 = points.ORIGIN_X, points.ORIGIN_Y


def _raster(spark: SparkSession) -> DataFrame:
    """The ground plane at the centres of 60 by 60 cells of 1 m."""
    cells = spark.range(3600).select((F.col("id") % 60).alias("col"), F.floor(F.col("id") / 60).alias("row"))
    value = points.PLANE_Z + points.PLANE_X * (F.col("col") + F.lit(0.5)) + points.PLANE_Y * (F.col("row") + F.lit(0.5))
    return cells.withColumn("value", value)


def _tiles(df: DataFrame) -> DataFrame:
    return rounded(df.select("tile_id", "xmin", "ymin", "xmax", "ymax"))


def _per_tile(operator: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """An operator on the tile voxels."""
    return lambda s, d: rounded(operator(virtual.tile_voxels(s, d)).select("tile_id", *columns))


def _per_cell(operator: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda s, d: rounded(operator(voxels.canopy(virtual.tile_voxels(s, d), P)).select("tile_id", *columns))


def _per_segment(operator: Callable[[DataFrame], DataFrame], *columns: str, digits: int = 6) -> Query:
    """An operator on the valid long points."""
    return lambda s, d: rounded(operator(virtual.valid_points(s, d)).select(*segments.KEYS, *columns), digits)


def _per_table(*columns: str) -> Query:
    """Columns of the finished segment table."""
    return lambda s, d: rounded(virtual.segment_table(s, d).select(*segments.KEYS, *columns))


def covering_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiles(grid.covering(spark, points.bounds(virtual.cloud(spark, sf_dir))[0], P.tile_size))


def edge_flags(corner: tuple[float, float]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tiles = grid.covering(spark, (*corner, corner[0] + 100, corner[1] + 100), P.tile_size)
        return grid.edge_flags(tiles, P.tile_size).select("tile_id", "edge_tile")

    return run


def buffered_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = terrain.chunked(virtual.cloud(spark, sf_dir).select("x", "y"), X0, Y0, 20.0, 5.0)
    return spread.groupBy("chunk_x", "chunk_y").agg(F.count("*").alias("points"), F.count_if("in_core").alias("core"))


def dtm_mosaic_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rasters of buffered chunks, each off by its own amount, merged by the mean of a cell."""
    placed = _raster(spark).withColumns({"x": F.lit(X0) + F.col("col") + 0.5, "y": F.lit(Y0) + F.col("row") + 0.5})
    spread = terrain.chunked(placed, X0, Y0, 20.0, 5.0)
    spread = spread.withColumn("value", F.col("value") + F.lit(0.01) * F.col("chunk_x") - F.lit(0.02) * F.col("chunk_y"))
    return rounded(terrain.mosaic(spread))


def global_chm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canopy raster of the whole cloud: heights in range, voxels, greatest height of a cell."""
    vox = voxels.tile_voxels(voxels.within_heights(virtual.cloud(spark, sf_dir), P.maximum_height), P.voxel_resolution, keys=())
    return rounded(voxels.canopy(vox, P, keys=()))


def segment_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return virtual.valid_points(spark, sf_dir).groupBy(*segments.KEYS, bucket(F.col("instance_id")).alias("bucket")).agg(F.count("*").alias("points"))


def segment_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.segment_diagnostics(virtual.segment_table(spark, sf_dir).where("instance_dimension = 'PredInstance'"), FILE)


def _trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.tree_metrics(virtual.segment_table(spark, sf_dir).where("instance_dimension = 'PredInstance'"))


def tile_tree_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"tree_{m}_{s}" for m in ("height", "crownarea", "volume") for s in ("max", "mean")]
    return rounded(_trees(spark, sf_dir).select("tile_id", "n_seg_total", "n_trees", *names))


def tree_gini(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = virtual.segment_table(spark, sf_dir).where("instance_dimension = 'PredInstance' AND tile_id IS NOT NULL AND is_tree")
    parts = [gini(accepted, ["tile_id"], c, f"tree_{n}_gini") for n, c in (("height", "apex_z"), ("crownarea", "crown_area"), ("volume", "voxel_volume"))]
    return rounded(parts[0].join(parts[1], "tile_id", "full_outer").join(parts[2], "tile_id", "full_outer"))


def tile_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: 34 columns for each tile of the AOI."""
    metrics = voxels.tile_metrics(virtual.tiled(spark, sf_dir), P)
    return results.tile_results(virtual.tiles(spark), metrics, _trees(spark, sf_dir), P, FILE, digits=6)


def union_distinct_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Voxels of chunks, deduplicated in each and again over all: buffers count once."""
    spread = terrain.chunked(virtual.valid_points(spark, sf_dir), X0, Y0, 20.0, 5.0)
    r = P.voxel_resolution
    keys = [F.floor(F.col(c) / F.lit(r)).cast("long").alias(f"v{i}") for i, c in enumerate(("x", "y", "h"))]
    partial = spread.select("chunk_x", "chunk_y", *segments.KEYS, *keys).distinct()
    return partial.drop("chunk_x", "chunk_y").distinct().groupBy(*segments.KEYS).agg(F.count("*").alias("voxels"))


def partial_final_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = virtual.valid_points(spark, sf_dir)
    vox = segments.counts(segments.voxels(rows, P), P).drop("voxel_volume")
    return rounded(segments.merge([segments.apexes(rows), vox, segments.layer_totals(segments.layers(rows))]))


def stream_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of the order lines as a stream, through partials of its batches."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    stream = spark.readStream.schema(lines.schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir)
    columns = ["pid", "x", "y", "h", *virtual.DIMENSIONS]
    long = points.unpivot(points.virtual_of(stream).select(*columns), virtual.DIMENSIONS)
    folder = state_folder(spark)
    ingest = SegmentIngest(f"{folder}/state", P)
    query = ingest.start(long, f"{folder}/checkpoint")
    query.awaitTermination()
    return rounded(ingest.segments(spark))


def snap_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terrain.snapped_bounds(points.extent(virtual.cloud(spark, sf_dir)), P.chm_resolution).select("gx0", "gy0", "gx1", "gy1")


def safe_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    largest = F.max(F.greatest(F.abs("x"), F.abs("y")))
    return virtual.cloud(spark, sf_dir).agg(safe_xy_scale(largest).alias("scale"))


def aoi_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(F.lit(" Include"), F.lit("INCLUSION "), F.lit("exclude"), F.lit("Exclusion"))
    raw = spark.read.parquet(f"{sf_dir}/nation.parquet").select(names[F.col("n_nationkey") % 4].alias("raw"))
    return aoi.roles(raw, "raw").groupBy("raw", "role").agg(F.count("*").alias("features"))


def _ground_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cloud, low vegetation and all, over a lattice of ground points."""
    lattice = spark.range(61 * 61).select((F.lit(X0) + F.col("id") % 61).alias("x"), (F.lit(Y0) + F.floor(F.col("id") / 61)).alias("y"))
    bare = lattice.withColumn("z", points.ground(F.col("x"), F.col("y")))
    return virtual.cloud(spark, sf_dir).select("x", "y", "z").unionByName(bare)


def ptd_ground(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by class after ground classification of buffered chunks, of the chunks' own points."""
    spread = terrain.chunked(_ground_points(spark, sf_dir), X0, Y0, P.dtm_chunk_size, P.dtm_buffer)
    return terrain.classify_ground(spread, P.ptd_resolution).where("in_core").groupBy("classification").agg(F.count("*").alias("points"))


def tin_dtm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the terrain raster from classified ground, and whether they lie as near the plane as ground points do."""
    found = terrain.terrain(_ground_points(spark, sf_dir), X0, Y0, P.dtm_resolution, P.dtm_chunk_size, P.dtm_buffer, P.ptd_resolution)
    plane = points.ground(F.lit(X0) + F.col("col") + F.lit(0.5), F.lit(Y0) + F.col("row") + F.lit(0.5))
    return found.select("col", "row", (F.abs(F.col("value") - plane) <= terrain.FLAT).alias("near"), (F.col("value") >= plane - 1e-6).alias("not_below"))


def nondegenerate_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = terrain.chunked(virtual.cloud(spark, sf_dir).select("x", "y"), X0, Y0, 20.0, 5.0)
    return terrain.nondegenerate(spread, ["chunk_x", "chunk_y"])


def queries() -> dict[str, Query]:
    """Each query by name, in the order of the operator survey."""
    p = P
    return {
        "scan_points": lambda s, d: rounded(virtual.cloud(s, d)),
        "point_extent": lambda s, d: points.extent(virtual.cloud(s, d)),
        "covering_grid": covering_grid,
        "offset_search": lambda s, d: grid.search(s, [WIDE_AOI], p.tile_size, p.grid_search_step, [EXCLUSION]),
        "optimized_grid": lambda s, d: _tiles(grid.optimized(s, [WIDE_AOI], p.tile_size, p.grid_search_step)),
        "grid_with_exclusion": lambda s, d: _tiles(grid.optimized(s, [WIDE_AOI], p.tile_size, p.grid_search_step, [EXCLUSION])),
        "edge_flags_offlattice": edge_flags(AOI[:2]),
        "edge_flags_aligned": edge_flags((412340.0, 5733160.0)),
        "points_in_tiles": lambda s, d: rounded(virtual.tiled(s, d).select("tile_id", "pid", "x", "y", "h")),
        "ground_normalize_nearest": lambda s, d: rounded(terrain.normalize_nearest(virtual.cloud(s, d).select("pid", "x", "y", "z"), _raster(s), X0, Y0, 1.0).select("pid", "x", "y", "h")),
        "ground_normalize_bilinear": lambda s, d: rounded(terrain.normalize_bilinear(virtual.cloud(s, d).select("pid", "x", "y", "z"), _raster(s), X0, Y0, 1.0).select("pid", "x", "y", "h")),
        "buffered_chunks": buffered_chunks,
        "nondegenerate_chunks": nondegenerate_chunks,
        "dtm_mosaic_mean": dtm_mosaic_mean,
        "tile_voxels": _per_tile(lambda v: v, "vx", "vy", "vz"),
        "tile_density": _per_tile(lambda v: voxels.density(v, p), "vox_filled", "vox_total", "veg_density"),
        "tile_heights": _per_tile(lambda v: voxels.heights(v, p), "height_max", "height_mean"),
        "tile_moments": _per_tile(lambda v: voxels.height_moments(v, p), "zsd", "zskew", "zkurt"),
        "tile_zq90": _per_tile(lambda v: voxels.height_moments(v, p), "zq90"),
        "tile_box_counts": _per_tile(lambda v: voxels.box_counts(v, p), "factor", "boxes"),
        "tile_box_dimension": _per_tile(lambda v: voxels.box_dimension(v, p), "box_dim_fixed"),
        "tile_layers": _per_tile(lambda v: voxels.layer_counts(v, p), "layer", "n"),
        "tile_vci": _per_tile(lambda v: voxels.vertical_complexity(v, p), "vci"),
        "tile_chm": _per_cell(lambda c: c, "cx", "cy", "top"),
        "tile_chm_stats": _per_cell(lambda c: voxels.canopy_statistics(c, p), "chm_mean", "chm_sd", "chm_cv", "gap_fraction"),
        "tile_rumple": _per_cell(lambda c: voxels.rumple(c, p), "rumple"),
        "global_chm": global_chm,
        "segment_unpivot": lambda s, d: rounded(virtual.long_points(s, d).select("pid", "x", "y", "h", *segments.KEYS)),
        "segment_voxels": _per_segment(lambda r: segments.voxels(r, p), "voxel_x", "voxel_y", "voxel_z"),
        "segment_layers": _per_segment(segments.layers, "occupied_layer"),
        "segment_apex": _per_segment(segments.apexes, "apex_x", "apex_y", "apex_z"),
        "segment_counts": _per_segment(lambda r: segments.counts(segments.voxels(r, p), p), "n_vox", "voxel_volume"),
        "segment_crown": _per_segment(lambda r: segments.crowns(segments.voxels(r, p), p), "crown_area"),
        "segment_layer_totals": _per_segment(lambda r: segments.layer_totals(segments.layers(r)), "n_occupied_layers"),
        "segment_pca": _per_segment(lambda r: segments.extents(segments.voxels(r, p), p), "pca_extent_1", "pca_extent_2", "pca_extent_3", digits=4),
        "segment_full_outer": _per_table("apex_z", "n_vox", "n_occupied_layers", "crown_area"),
        "segment_gates": _per_table("pass_voxels", "pass_apex", "pass_thickness", "pass_occupied_layers", "is_tree"),
        "segment_fail_reason": _per_table("fail_reason"),
        "segment_buckets": segment_buckets,
        "apex_to_tile": _per_table("apex_x", "apex_y", "tile_id"),
        "segment_diagnostics": segment_diagnostics,
        "tile_tree_metrics": tile_tree_metrics,
        "tree_gini": tree_gini,
        "tile_results": tile_results,
        "union_distinct_chunks": union_distinct_chunks,
        "partial_final_segments": partial_final_segments,
        "stream_segments": stream_segments,
        "snap_bounds": snap_bounds,
        "safe_scale": safe_scale,
        "aoi_roles": aoi_roles,
        "ptd_ground": ptd_ground,
        "tin_dtm": tin_dtm,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)

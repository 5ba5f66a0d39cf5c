"""A whole analysis: point cloud and footprint in, tables, rasters and images out."""

from __future__ import annotations

import logging
import os
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from understory import geometry, params
from understory.operators import grid, results, segments, terrain, voxels
from understory.params import Parameters
from understory.sinks import geotiff, layout, tables
from understory.sources import aoi, points

log = logging.getLogger(__name__)


def footprint(path: str | None, extent: geometry.Box) -> dict:
    """Inclusions, exclusions and the source; the extent itself without a file."""
    if path is None:
        return {"inclusion": [geometry.rectangle(extent)], "exclusion": [], "source": "point_cloud_extent"}
    found = aoi.read(params.check_aoi(path))
    geometry.usable(found["inclusion"], found["exclusion"])
    geometry.assert_overlap(found["inclusion"], extent)
    return found | {"source": "aoi"}


def tiles_for(spark: SparkSession, found: dict, p: Parameters) -> DataFrame:
    """Analysis tiles: covering ones for an extent, else complete ones at the best offset.

    Rectangles apart from each other are searched by expressions, other polygons by area.
    """
    inclusions, exclusions = found["inclusion"], found["exclusion"]
    if found["source"] == "point_cloud_extent":
        return grid.covering(spark, geometry.box_of(inclusions), p.tile_size)
    if geometry.rectangles_apart(inclusions) and all(geometry.is_rectangle(r) for r in exclusions):
        boxes = [geometry.box_of([r]) for r in inclusions], [geometry.box_of([r]) for r in exclusions]
        return grid.optimized(spark, boxes[0], p.tile_size, p.grid_search_step, boxes[1])
    return grid.optimized_in_polygons(spark, inclusions, p.tile_size, p.grid_search_step, exclusions)


@contextmanager
def _timed(timings: dict, name: str):
    began = time.monotonic()
    yield
    timings[name] = time.monotonic() - began
    log.info("PERF %s %.3f s", name, timings[name])


def _together(*phases: Callable[[], object]) -> list:
    """Results of phases that don't need each other, run side by side: small jobs of one fill the cores that another leaves idle."""
    with ThreadPoolExecutor(len(phases)) as pool:
        return [f.result() for f in [pool.submit(phase) for phase in phases]]


def run(spark: SparkSession, cloud: DataFrame | str, folder: str, p: Parameters, aoi_path: str | None = None, name: str | None = None, epsg: int | None = None) -> dict:
    """Write all artifacts of a run; the paths written, and its counts.

    cloud: points (x, y, z, ...), or a path.  Ground is classified, whatever classes the
    points have, unless p.keep_ground_classes says to use those.  epsg: the coordinate
    system of rasters and tiles; that of the file, where it says one, by default.
    """
    held: list[DataFrame] = []
    try:
        return _run(spark, cloud, folder, p, aoi_path, name, epsg, held)
    finally:
        for df in held:
            df.unpersist()


def _run(spark: SparkSession, cloud: DataFrame | str, folder: str, p: Parameters, aoi_path: str | None, name: str | None, epsg: int | None, held: list[DataFrame]) -> dict:
    def kept(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return df

    timings: dict[str, float] = {}
    began = time.monotonic()
    if isinstance(cloud, str):
        name = name or os.path.basename(cloud)
        epsg = epsg or points.epsg_of(cloud)
        path = params.check_input(cloud)
        wanted = {"x", "y", "z", "pid", *p.instance_dimensions, *(["classification"] if p.keep_ground_classes else [])}
        cloud = points.read(spark, path, [c for c in points.read(spark, path).columns if c in wanted])
    name = name or "points"
    if not os.path.isdir(folder) or not os.access(folder, os.W_OK):
        raise ValueError(f"the output folder cannot be written: {folder}")
    params.artifacts(folder, p.dataset_id)
    if "pid" not in cloud.columns:
        cloud = cloud.withColumn("pid", F.xxhash64("x", "y", "z"))
    extent, found_count = points.bounds(cloud)
    count = params.check_point_count(found_count)
    whole = spark.range(1).select(*(F.lit(v).alias(n) for n, v in zip(("xmin", "ymin", "xmax", "ymax"), extent, strict=True)))
    r = p.dtm_resolution
    box = terrain.snapped_bounds(whole, r).select("gx0", "gy0", "gx1", "gy1").first()
    if not terrain.covers(tuple(box), extent, r):
        raise ValueError("the raster does not cover the points")
    paths = params.artifacts(folder, p.dataset_id)
    found = footprint(aoi_path, extent)

    def placed_tiles() -> tuple[DataFrame, int]:
        with _timed(timings, "grid"):
            tiles = kept(tiles_for(spark, found, p))
            n_tiles = tiles.count()
            log.info("grid: %d tiles", n_tiles)
            return tiles, n_tiles

    def ground() -> DataFrame:
        with _timed(timings, "dtm"):
            dtm = kept(terrain.terrain(cloud, box[0], box[1], r, p.dtm_chunk_size, p.dtm_buffer, p.ptd_resolution, p.keep_ground_classes))
            geotiff.write(dtm, paths["dtm"], box[0], box[1], r, round((box[2] - box[0]) / r), round((box[3] - box[1]) / r), epsg)
            return dtm

    (tiles, n_tiles), dtm = _together(placed_tiles, ground)
    normal = kept(terrain.normalize_bilinear(cloud, dtm, box[0], box[1], r))
    dimensions = params.select_dimensions(p.instance_dimensions, cloud.columns)

    def canopy() -> None:
        with _timed(timings, "chm"):
            c = p.chm_resolution
            high = terrain.snapped_bounds(whole, c).select("gx0", "gy0", "gx1", "gy1").first()
            vox = voxels.tile_voxels(voxels.within_heights(normal, p.maximum_height), p.voxel_resolution, keys=())
            chm = voxels.canopy(vox, p, keys=())
            placed = chm.select((F.col("cx") - round(high[0] / c)).alias("col"), (F.col("cy") - round(high[1] / c)).alias("row"), F.col("top").alias("value"))
            geotiff.write(placed, paths["chm"], high[0], high[1], c, round((high[2] - high[0]) / c), round((high[3] - high[1]) / c), epsg)

    def trees() -> DataFrame | None:
        with _timed(timings, "segment"):
            if not dimensions:
                return None
            long = points.unpivot(normal.select("pid", "x", "y", "h", *dimensions), dimensions)
            table = kept(segments.assign_tiles(segments.segment_table(long, p, kept), tiles))
            return table if table.limit(1).count() else None

    def structure() -> DataFrame:
        with _timed(timings, "tile"):
            inside = grid.lattice_join(normal.select("x", "y", "h"), tiles, columns=["tile_id"])
            metrics = kept(voxels.tile_metrics(inside, p, kept))
            metrics.count()
            return metrics

    _, table, metrics = _together(canopy, trees, structure)
    written = [paths["dtm"], paths["chm"]]
    crs = f"urn:ogc:def:crs:EPSG::{epsg}" if epsg else None

    def tile_files(own: dict, mine: DataFrame | None) -> None:
        rows = results.tile_results(tiles, metrics, None if mine is None else segments.tree_metrics(mine), p, name)
        if tables.write_tiles(rows, own["results"], own["tiles"], p.tile_size, crs) != n_tiles:
            raise RuntimeError("the results do not have one row for each tile")

    def segment_file(own: dict, mine: DataFrame | None) -> None:
        diagnostics = spark.createDataFrame([], results.DIAGNOSTICS) if mine is None else results.segment_diagnostics(mine, name)
        tables.write_csv(diagnostics, own["diagnostics"], ["PredInstance"])

    def image() -> None:
        flags = grid.edge_flags(tiles, p.tile_size).orderBy("tile_id").select("tile_id", "xmin", "ymin", "xmax", "ymax", "edge_tile").collect()
        layout.draw(paths["layout"], found["inclusion"], found["exclusion"], [tuple(t) for t in flags])

    with _timed(timings, "output"):
        outputs = [image]
        for d in dimensions or [None]:
            own = params.artifacts(folder, p.dataset_id, d)
            mine = None if table is None or d is None else table.where(F.col("instance_dimension") == d)
            outputs += [partial(tile_files, own, mine), partial(segment_file, own, mine)]
            written += [own["results"], own["tiles"], own["diagnostics"]]
        _together(*outputs)
        written.append(paths["layout"])
    timings["total"] = time.monotonic() - began
    if p.performance_report:
        tables.write_report(tables.report_row(p, name, found["source"], count, n_tiles, dimensions, timings, spark.sparkContext.defaultParallelism), paths["performance"])
        written.append(paths["performance"])
    return {"paths": written, "tiles": n_tiles, "points": count, "dimensions": dimensions, "timings": timings}

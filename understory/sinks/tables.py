"""CSV and GeoJSON files of results that are a row a tile or segment, and the run report.

Rows come over one after the other, so the driver holds a partition at most; files are
written beside their place and moved there.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame

from understory.params import Parameters, as_row


@contextmanager
def published(path: str, mode: str = "w"):
    """A file that appears at its path only when it is complete."""
    partial = f"{path}.partial"
    with open(partial, mode, **({} if "b" in mode else {"encoding": "utf-8", "newline": ""})) as f:
        yield f
    os.replace(partial, path)


def _text(value: object) -> str:
    if value is None or (isinstance(value, float) and (value != value or abs(value) == float("inf"))):
        return "NA"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, str):
        return '"' + value.replace('"', '""') + '"'
    if isinstance(value, float):
        return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)
    return str(value)


def write_csv(rows: DataFrame, path: str, order: Iterable[str] = ()) -> int:
    """Quoted header and strings, NA for null, TRUE and FALSE; the number of rows."""
    n = 0
    with published(path) as f:
        f.write(",".join(f'"{c}"' for c in rows.columns) + "\n")
        for r in (rows.orderBy(*order) if order else rows).toLocalIterator():
            f.write(",".join(map(_text, r)) + "\n")
            n += 1
    return n


def write_tiles(rows: DataFrame, csv_path: str, geojson_path: str, size: float, crs: str | None = None) -> int:
    """The tiles' table, and a FeatureCollection of their squares with all its attributes, in one pass; the number of rows."""
    n = 0
    with published(csv_path) as table, published(geojson_path) as f:
        table.write(",".join(f'"{c}"' for c in rows.columns) + "\n")
        f.write('{"type":"FeatureCollection",')
        if crs:
            f.write(f'"crs":{{"type":"name","properties":{{"name":{json.dumps(crs)}}}}},')
        f.write('"features":[')
        for r in rows.orderBy("tile_id").toLocalIterator(prefetchPartitions=True):
            table.write(",".join(map(_text, r)) + "\n")
            x, y = r["tile_xmin"], r["tile_ymin"]
            ring = [[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]
            properties = {k: None if isinstance(v, float) and v != v else v for k, v in r.asDict().items()}
            f.write(("," if n else "") + "\n" + json.dumps({"type": "Feature", "properties": properties, "geometry": {"type": "Polygon", "coordinates": [ring]}}))
            n += 1
        f.write("\n]}\n" if n else "]}\n")
    return n


def peak_memory_mib() -> float:
    """Peak resident memory of this process."""
    try:
        with open("/proc/self/status") as f:
            return next(int(line.split()[1]) / 1024 for line in f if line.startswith("VmHWM"))
    except (OSError, StopIteration):
        return float("nan")


def report_row(p: Parameters, path: str, source: str, points: int, tiles: int, dimensions: list[str], timings: dict[str, float], parallelism: int) -> dict:
    """The run report: inputs, counts, seconds by phase and parameters."""
    row = {
        "point_cloud": os.path.basename(path),
        "footprint_source": source,
        "point_count": points,
        "tile_count": tiles,
        "instance_dimension": "|".join(dimensions) or None,
        "threads_requested": p.threads,
        "threads_effective": parallelism,
        "catalog_workers": p.catalog_workers,
        "peak_rss_mib": round(peak_memory_mib(), 3),
    }
    row |= {f"{k}_seconds": round(timings.get(k, 0.0), 6) for k in ("grid", "dtm", "chm", "segment", "tile", "output", "total")}
    values = as_row(p)
    names = (
        "tile_size", "grid_search_step", "ptd_resolution", "dtm_resolution", "maximum_height", "voxel_resolution", "vegetation_minimum_height", "chm_resolution", "gap_height_threshold",
        "minimum_tree_voxels", "apex_minimum_height", "minimum_tree_thickness", "minimum_occupied_layers", "dtm_chunk_size", "chunk_size", "dtm_buffer",
    )
    row |= {n: values[n] for n in names}
    return row | {"dtm_storage_mode": "relation", "chm_storage_mode": "relation", "instance_dimension_candidates": "|".join(p.instance_dimensions)}


def write_report(row: dict, path: str) -> None:
    with published(path) as f:
        f.write(",".join(f'"{c}"' for c in row) + "\n" + ",".join(_text(v) for v in row.values()) + "\n")

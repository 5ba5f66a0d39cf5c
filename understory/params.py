"""Parameters of an analysis run, their checks, and the names of its artifacts."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields

#: Segment-id attributes that are looked for when none is asked for.
DEFAULT_DIMENSIONS = ("PredInstance", "PredInstance_SAT", "PredInstance_FM")

_POSITIVE = ("tile_size", "grid_search_step", "ptd_resolution", "dtm_resolution", "maximum_height", "voxel_resolution", "chm_resolution", "dtm_chunk_size", "chunk_size", "dtm_buffer")
_NOT_NEGATIVE = ("vegetation_minimum_height", "gap_height_threshold", "apex_minimum_height", "minimum_tree_thickness", "threads")
_ONE_AT_LEAST = ("dataset_id", "minimum_tree_voxels", "minimum_occupied_layers", "catalog_workers")


@dataclass(frozen=True)
class Parameters:
    """Scientific and runtime controls; invalid values raise ValueError."""

    tile_size: float = 20.0
    grid_search_step: float = 0.5
    ptd_resolution: float = 20.0
    dtm_resolution: float = 1.0
    maximum_height: float = 70.0
    voxel_resolution: float = 0.2
    vegetation_minimum_height: float = 0.5
    chm_resolution: float = 0.5
    gap_height_threshold: float = 3.0
    minimum_tree_voxels: int = 100
    apex_minimum_height: float = 3.0
    minimum_tree_thickness: float = 0.5
    minimum_occupied_layers: int = 3
    dtm_chunk_size: float = 60.0
    chunk_size: float = 60.0
    dtm_buffer: float = 20.0
    threads: int = 0
    catalog_workers: int = 2
    dataset_id: int = 1
    performance_report: bool = False
    keep_ground_classes: bool = False
    instance_dimensions: tuple[str, ...] = field(default=DEFAULT_DIMENSIONS)

    def __post_init__(self):
        for names, ok, what in (
            (_POSITIVE, lambda v: v > 0, "has to be above 0"),
            (_NOT_NEGATIVE, lambda v: v >= 0, "must not be negative"),
            (_ONE_AT_LEAST, lambda v: v >= 1, "must be one or more"),
        ):
            for name in names:
                value = getattr(self, name)
                if not isinstance(value, (int, float)) or value != value or not ok(value):
                    raise ValueError(f"{name.replace('_', '-')} {what}")
        if self.grid_search_step > self.tile_size:
            raise ValueError("grid-search-step cannot be wider than tile-size")
        if self.maximum_height <= self.vegetation_minimum_height:
            raise ValueError("maximum-height must exceed vegetation-minimum-height")

    @property
    def voxel_total(self) -> int:
        """Voxels a tile has between the vegetation's lowest height and the highest one."""
        across = self.tile_size / self.voxel_resolution
        return round(across * across * ((self.maximum_height - self.vegetation_minimum_height) / self.voxel_resolution))

    @property
    def box_factors(self) -> list[int]:
        """Widths of the counted boxes in voxels: powers of two below the tile's width."""
        return [2**k for k in range(31) if self.voxel_resolution * 2**k < self.tile_size]


def split_names(names: str | None) -> tuple[str, ...]:
    """Comma-separated names, trimmed, without empty ones and repeats, in order."""
    return tuple(dict.fromkeys(n.strip() for n in (names or "").split(",") if n.strip()))


def select_dimensions(requested: tuple[str, ...] | list[str], available: list[str]) -> list[str]:
    """The requested names that are available, in the order of the request, each once."""
    return [n for n in dict.fromkeys(requested) if n in set(available)]


def column_selection(requested: list[str], available: list[str], base: str = "xyzrn") -> str:
    """The reader's attribute string for extra attributes by place: 1 to 9 singly, 0 for all where one is beyond."""
    places = [available.index(n) + 1 for n in dict.fromkeys(requested) if n in available]
    if any(p > 9 for p in places):
        return base + "0"
    return base + "".join(map(str, sorted(places)))


def check_input(path: str) -> str:
    """A point file's path; a missing one, a folder or another kind is an error."""
    if not os.path.exists(path):
        raise ValueError(f"point cloud does not exist: {path}")
    if os.path.isdir(path) and not path.endswith(".parquet"):
        raise ValueError(f"point cloud is a directory: {path}")
    if not re.search(r"(?i)\.(las|laz|parquet|csv)$", path):
        raise ValueError("point cloud must end in .las, .laz, .parquet or .csv")
    return path


def check_aoi(path: str) -> str:
    if not re.search(r"(?i)\.(geojson|json|gpkg)$", path):
        raise ValueError("AOI must end in .geojson, .json or .gpkg")
    if not os.path.isfile(path):
        raise ValueError(f"AOI does not exist: {path}")
    return path


def check_point_count(count: float, limit: float | None = None) -> int:
    """A header's point count; a limit is opt-in, as nothing here needs one."""
    if count != count or count < 0 or count == float("inf"):
        raise ValueError("the point count is not a finite number of zero or more")
    if limit is not None and count > limit:
        raise ValueError(f"unsupported point count: {count:.0f} is more than {limit:.0f}")
    return int(count)


def artifacts(folder: str, dataset_id: int, dimension: str | None = None) -> dict[str, str]:
    """Paths of the files of a run, the last three for an instance dimension."""
    prefix = os.path.join(folder, str(dataset_id))
    suffix = ""
    if dimension is not None:
        if not (safe := re.sub(r"[^A-Za-z0-9_-]", "_", dimension)):
            raise ValueError("an instance dimension cannot form an artifact name")
        suffix = f"_{safe}"
    return {
        "dtm": f"{prefix}_dtm.tif",
        "chm": f"{prefix}_chm.tif",
        "layout": f"{prefix}_tiles.png",
        "performance": f"{prefix}_performance.csv",
        "results": f"{prefix}{suffix}_results.csv",
        "diagnostics": f"{prefix}{suffix}_segment_diagnostics.csv",
        "tiles": f"{prefix}{suffix}_tiles.geojson",
    }


def as_row(parameters: Parameters) -> dict:
    """Parameters as plain values."""
    return {f.name: ",".join(v) if isinstance(v := getattr(parameters, f.name), tuple) else v for f in fields(parameters)}

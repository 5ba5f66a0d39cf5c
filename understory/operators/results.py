"""The 34-column tile results and the 17-column segment diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from understory.functions.scalars import safe_round
from understory.operators.grid import edge_flags
from understory.params import Parameters

_S, _I, _D, _B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TREE_COLUMNS = (
    ("n_seg_total", _I), ("n_trees", _I),
    *((f"tree_{m}_{s}", _D) for m, stats in (("height", ("max", "mean", "gini")), ("crownarea", ("mean", "max", "gini")), ("volume", ("mean", "max", "gini"))) for s in stats),
)
RESULTS = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("file", _S), ("sensor", _S), ("country", _S), ("tile_id", _I), ("tile_xmin", _D), ("tile_ymin", _D), ("edge_tile", _B), ("n_tiles_plot", _I), ("vox_filled", _I), ("vox_total", _I),
        *((n, _D) for n in ("veg_density", "zsd", "zskew", "zkurt", "zq90", "box_dim_fixed", "vci", "rumple", "gap_fraction", "chm_sd", "chm_cv", "height_max", "height_mean")),
        *TREE_COLUMNS,
    )]
)
DIAGNOSTICS = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("file", _S), ("sensor", _S), ("country", _S), ("tile_id", _I), ("PredInstance", _D), ("n_vox", _I), ("apex_z", _D), ("pc_ext1", _D), ("pc_ext2", _D), ("pc_ext3", _D), ("n_zlayer", _I),
        ("pass_vox", _B), ("pass_apex", _B), ("pass_thick", _B), ("pass_zlayer", _B), ("is_tree", _B), ("apex_in_tile", _B),
    )]
)


def tile_results(tiles: DataFrame, metrics: DataFrame, trees: DataFrame | None, p: Parameters, file: str, digits: int = 4) -> DataFrame:
    """One row for each tile in RESULTS order.

    Tiles without points have 0 filled voxels and null measures; density is null
    without vegetation.  trees: per-tile tree metrics; None (no segments at all) leaves
    all tree columns null, a tile without segments has counts of 0.
    """
    n = tiles.count()
    rows = edge_flags(tiles, p.tile_size).join(metrics, "tile_id", "left")
    if trees is not None:
        rows = rows.join(trees, "tile_id", "left")
    filled = F.coalesce(F.col("vox_filled"), F.lit(0))
    made = {
        "file": F.lit(file),
        "sensor": F.lit(None).cast("string"),
        "country": F.lit(None).cast("string"),
        "tile_xmin": F.col("xmin"),
        "tile_ymin": F.col("ymin"),
        "n_tiles_plot": F.lit(n),
        "vox_filled": filled,
        "vox_total": F.lit(p.voxel_total),
        "veg_density": F.when(filled > 0, filled / F.lit(float(p.voxel_total))),
    }
    for name, kind in TREE_COLUMNS:
        if trees is None:
            made[name] = F.lit(None).cast(kind)
        elif kind == _I:
            made[name] = F.coalesce(F.col(name), F.lit(0))
    columns = []
    for f in RESULTS:
        c = made.get(f.name, F.col(f.name))
        rounded = f.dataType == _D and f.name not in ("tile_xmin", "tile_ymin")
        columns.append((safe_round(c.cast("double"), digits) if rounded else c).cast(f.dataType).alias(f.name))
    return rows.select(*columns)


def segment_diagnostics(segments: DataFrame, file: str, digits: int = 4) -> DataFrame:
    """One row for each segment of a dimension in DIAGNOSTICS order; the id column's name is fixed."""
    names = {
        "PredInstance": "instance_id", "pc_ext1": "pca_extent_1", "pc_ext2": "pca_extent_2", "pc_ext3": "pca_extent_3", "n_zlayer": "n_occupied_layers",
        "pass_vox": "pass_voxels", "pass_thick": "pass_thickness", "pass_zlayer": "pass_occupied_layers",
    }
    made = {"file": F.lit(file), "sensor": F.lit(None).cast("string"), "country": F.lit(None).cast("string"), "apex_in_tile": F.col("tile_id").isNotNull()}
    columns = []
    for f in DIAGNOSTICS:
        c = made.get(f.name, F.col(names.get(f.name, f.name)))
        rounded = f.dataType == _D and f.name != "PredInstance"
        columns.append((safe_round(c, digits) if rounded else c).cast(f.dataType).alias(f.name))
    return segments.select(*columns)

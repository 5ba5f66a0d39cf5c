"""Synthetic orchards: paraboloid crowns in staggered rows over rolling ground.

Places come from a low-discrepancy sequence over row numbers, so a cloud of n points is the
same whatever its partitions and needs no seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: South-west corner of the plots, and the strip around their AOI.
CORNER_X, CORNER_Y, STRIP = 412337.0, 5733149.0, 7.5
#: Metres between trees of a row and between rows.
SPACING, ROWS = 7.0, 6.0
#: One point in this many is ground.
GROUND_SHARE = 5
#: Reciprocals of the plastic number's first two powers, and of the golden ratio.
_A, _B, _C = 0.7548776662466927, 0.5698402909980532, 0.6180339887498949


def ground_height(x: Column, y: Column) -> Column:
    """Height of the rolling ground."""
    return F.lit(143.0) + F.lit(1.5) * F.sin((x - CORNER_X) / 19.0) + F.lit(1.1) * F.cos((y - CORNER_Y) / 26.0)


def _part(step: float) -> Column:
    at = F.col("id") * F.lit(step)
    return at - F.floor(at)


def orchard(spark: SparkSession, count: int, width: float) -> DataFrame:
    """x, y, z, classification, PredInstance: `count` points over a square AOI of `width` and its strip.

    Ground is class 2 and of no tree (0); crown points are class 5 and of their tree's
    number.  Trees are 8 to 17 m tall and 2.2 to 3.1 m wide from the stem.
    """
    side = width + 2 * STRIP
    across, along = max(1, int(side // SPACING)), max(1, int(side // ROWS))
    points = spark.range(count).withColumns({"u": _part(_A), "v": _part(_B), "w": _part(_C)})
    tree = F.pmod(F.xxhash64("id"), F.lit(across * along))
    points = points.withColumn("bare", F.col("id") % GROUND_SHARE == 0).withColumns({"tree": tree, "place": tree % across, "line": F.floor(tree / across)})
    radius, tall = 2.2 + F.pmod(F.hash("tree"), F.lit(10)) * 0.1, 8.0 + F.pmod(F.hash("tree", F.lit(1)), F.lit(91)) * 0.1
    stem_x = (F.col("place") + 0.25 + 0.5 * (F.col("line") % 2)) * (side / (across + 0.5))
    stem_y = (F.col("line") + 0.5) * (side / along)
    out, turn = radius * F.sqrt("u"), F.col("v") * 6.283185307179586
    inside = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(side))
    x = F.lit(CORNER_X) + F.when(F.col("bare"), F.col("u") * side).otherwise(inside(stem_x + out * F.cos(turn)))
    y = F.lit(CORNER_Y) + F.when(F.col("bare"), F.col("v") * side).otherwise(inside(stem_y + out * F.sin(turn)))
    # the crown is a paraboloid, its foliage in the upper 60 %
    above = tall * (1 - 0.45 * F.col("u")) * (1 - 0.6 * F.col("w") * F.col("w"))
    placed = points.select(x.alias("x"), y.alias("y"), "bare", "tree", above.alias("above"))
    z = ground_height(F.col("x"), F.col("y")) + F.when(F.col("bare"), 0.0).otherwise(F.col("above"))
    return placed.select(
        "x", "y", z.alias("z"), F.when(F.col("bare"), 2).otherwise(5).alias("classification"),
        F.when(F.col("bare"), 0.0).otherwise(F.col("tree") + 1.0).alias("PredInstance"),
    )


def aoi_box(width: float) -> tuple[float, float, float, float]:
    """The AOI of orchard()."""
    x, y = CORNER_X + STRIP, CORNER_Y + STRIP
    return x, y, x + width, y + width

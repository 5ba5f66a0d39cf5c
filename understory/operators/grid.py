"""Analysis tiles: grids, placement search, edge flags, and the range join of points to tiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from understory import geometry
from understory.geometry import MultiPolygon

#: (xmin, ymin, xmax, ymax).
Box = tuple[float, float, float, float]
#: Tiles whose broadcast is asked for at most (48 bytes each).
BROADCAST_TILES = 500_000


def _numbered(tiles: DataFrame) -> DataFrame:
    """tile_id by (ymin, xmin): ranks of rows and of places in a row, so no global sort of tiles is needed."""
    rows = tiles.groupBy("row").agg(F.count("*").alias("_n"))
    before = Window.orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy("row").orderBy("col"))
    numbered = tiles.join(rows, "row").withColumn("tile_id", (F.col("_before") + place).cast("int"))
    return numbered.select("tile_id", "col", "row", "xmin", "ymin", "xmax", "ymax")


def cells(spark: SparkSession, x0: float, y0: float, size: float, columns: int, rows: int) -> DataFrame:
    """(col, row, xmin, ymin, xmax, ymax) of a lattice, row by row from the south-west."""
    ids = spark.range(columns * rows).select((F.col("id") % columns).alias("col"), F.floor(F.col("id") / columns).alias("row"))
    xmin, ymin = F.lit(x0) + F.col("col") * F.lit(float(size)), F.lit(y0) + F.col("row") * F.lit(float(size))
    return ids.select("col", "row", xmin.alias("xmin"), ymin.alias("ymin"), (xmin + F.lit(float(size))).alias("xmax"), (ymin + F.lit(float(size))).alias("ymax"))


def covering(spark: SparkSession, box: Box, size: float) -> DataFrame:
    """Tiles that cover a box; what they are wider than it is split between both sides."""
    columns, rows = math.ceil((box[2] - box[0]) / size), math.ceil((box[3] - box[1]) / size)
    x0 = box[0] - (columns * size - (box[2] - box[0])) / 2
    y0 = box[1] - (rows * size - (box[3] - box[1])) / 2
    found = cells(spark, x0, y0, size, columns, rows)
    return found.select((F.col("row") * columns + F.col("col") + 1).cast("int").alias("tile_id"), "col", "row", "xmin", "ymin", "xmax", "ymax")


def candidates(spark: SparkSession, size: float, step: float) -> DataFrame:
    """(offset_x, offset_y) of the placement search."""
    n = math.floor((size - step) / step + 1e-9) + 1
    return spark.range(n * n).select((F.floor(F.col("id") / n) * F.lit(step)).alias("offset_x"), ((F.col("id") % n) * F.lit(step)).alias("offset_y"))


def _inside(box: Box):
    return (F.col("xmin") >= box[0]) & (F.col("ymin") >= box[1]) & (F.col("xmax") <= box[2]) & (F.col("ymax") <= box[3])


def _apart(box: Box):
    return (F.col("xmax") <= box[0]) | (F.col("xmin") >= box[2]) | (F.col("ymax") <= box[1]) | (F.col("ymin") >= box[3])


def complete(tiles: DataFrame, inclusions: Sequence[Box], exclusions: Sequence[Box] = ()) -> DataFrame:
    """Tiles within one of the (apart) rectangles and touching no exclusion by an area; boundary contact is allowed."""
    ok = F.lit(False)
    for box in inclusions:
        ok = ok | _inside(box)
    for box in exclusions:
        ok = ok & _apart(box)
    return tiles.where(ok)


def search(spark: SparkSession, inclusions: Sequence[Box], size: float, step: float, exclusions: Sequence[Box] = ()) -> DataFrame:
    """(offset_x, offset_y, tiles): complete tiles of every candidate offset, counted over all rectangles.

    For a rectangle the complete tiles of a lattice are a closed count; exclusions
    take tiles away, so with them the lattice's cells are tested.
    """
    x0, y0 = min(b[0] for b in inclusions), min(b[1] for b in inclusions)
    offsets = candidates(spark, size, step)
    columns = math.ceil((max(b[2] for b in inclusions) - x0 + size) / size)
    rows = math.ceil((max(b[3] for b in inclusions) - y0 + size) / size)
    grid = offsets.withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(columns)))).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows))))
    xmin = (F.lit(x0) - F.col("offset_x")) + F.col("col") * F.lit(float(size))
    ymin = (F.lit(y0) - F.col("offset_y")) + F.col("row") * F.lit(float(size))
    grid = grid.withColumns({"xmin": xmin, "ymin": ymin}).withColumns({"xmax": F.col("xmin") + F.lit(float(size)), "ymax": F.col("ymin") + F.lit(float(size))})
    counted = complete(grid, inclusions, exclusions).groupBy("offset_x", "offset_y").agg(F.count("*").alias("n"))
    return offsets.join(counted, ["offset_x", "offset_y"], "left").select("offset_x", "offset_y", F.coalesce("n", F.lit(0)).cast("long").alias("tiles"))


def best_offset(scored: DataFrame) -> DataFrame:
    """The offset of most tiles; of equal ones the first of the search."""
    return scored.orderBy(F.desc("tiles"), "offset_x", "offset_y").limit(1)


def optimized(spark: SparkSession, inclusions: Sequence[Box], size: float, step: float, exclusions: Sequence[Box] = (), offset: tuple[float, float] | None = None) -> DataFrame:
    """Complete tiles at the best offset, numbered by (ymin, xmin).

    The first offset is taken where it has as many tiles as the area allows.
    """
    area = sum((b[2] - b[0]) * (b[3] - b[1]) for b in inclusions)
    x0, y0 = min(b[0] for b in inclusions), min(b[1] for b in inclusions)
    columns = math.ceil((max(b[2] for b in inclusions) - x0 + size) / size) + 1
    rows = math.ceil((max(b[3] for b in inclusions) - y0 + size) / size) + 1
    if offset is None:
        at_first = complete(cells(spark, x0, y0, size, columns, rows), inclusions, exclusions).count()
        if at_first >= math.floor(area / size**2) or step >= size:
            offset = (0.0, 0.0)
        else:
            offset = tuple(best_offset(search(spark, inclusions, size, step, exclusions)).first()[:2])
    found = complete(cells(spark, x0 - offset[0], y0 - offset[1], size, columns, rows), inclusions, exclusions)
    return _numbered(found)


def optimized_in_polygons(spark: SparkSession, inclusions: MultiPolygon, size: float, step: float, exclusions: MultiPolygon = ()) -> DataFrame:
    """optimized() for any polygons: each candidate's cells are tested in tasks, a candidate a row.

    The polygons are a few outlines of a footprint and go with the code.
    """
    x0, y0, x1, y1 = geometry.box_of(inclusions)

    def whole(dx: float, dy: float) -> list[Box]:
        columns, rows = math.ceil((x1 - x0 + dx) / size), math.ceil((y1 - y0 + dy) / size)
        boxes = ((x0 - dx + c * size, y0 - dy + r * size, x0 - dx + (c + 1) * size, y0 - dy + (r + 1) * size) for r in range(rows) for c in range(columns))
        return [b for b in boxes if geometry.complete(b, inclusions, exclusions)]

    def count(batches):
        for pdf in batches:
            pdf["tiles"] = [len(whole(dx, dy)) for dx, dy in zip(pdf.offset_x, pdf.offset_y, strict=True)]
            yield pdf

    best, offset = whole(0.0, 0.0), (0.0, 0.0)
    if len(best) < math.floor(geometry.usable_area(inclusions, exclusions) / size**2 + 1e-9) and step < size:
        offsets = candidates(spark, size, step)
        scored = offsets.repartition(4 * spark.sparkContext.defaultParallelism).mapInPandas(count, "offset_x double, offset_y double, tiles long")
        offset = tuple(best_offset(scored).first()[:2])
        best = whole(*offset)
    rows = [(round((b[0] - x0 + offset[0]) / size), round((b[1] - y0 + offset[1]) / size), *map(float, b)) for b in best]
    return _numbered(spark.createDataFrame(rows, "col long, row long, xmin double, ymin double, xmax double, ymax double"))


def edge_flags(tiles: DataFrame, size: float) -> DataFrame:
    """tiles with edge_tile: whether one of the eight neighbours is missing.

    The lattice place of a tile is its centre over the size, rounded half-even: centres
    on halves (corners on multiples of the size) then skip and repeat places, and every
    such tile is an edge.
    """
    place = tiles.select(
        "tile_id",
        F.rint((F.col("xmin") + F.col("xmax")) / 2 / size).cast("long").alias("_i"),
        F.rint((F.col("ymin") + F.col("ymax")) / 2 / size).cast("long").alias("_j"),
    )
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]
    around = place.select("tile_id", F.inline(F.array(*(F.struct((F.col("_i") + i).alias("_i"), (F.col("_j") + j).alias("_j")) for i, j in steps))))
    there = around.join(place.select("_i", "_j").distinct(), ["_i", "_j"], "left_semi").groupBy("tile_id").agg(F.count("*").alias("_n"))
    return tiles.join(there, "tile_id", "left").withColumn("edge_tile", F.coalesce(F.col("_n"), F.lit(0)) < 8).drop("_n")


def lattice_join(points: DataFrame, tiles: DataFrame, x: str = "x", y: str = "y", how: str = "inner", columns: Sequence[str] = ("tile_id",)) -> DataFrame:
    """points with the columns of the tile that holds them: xmin <= x < xmax and ymin <= y < ymax.

    Tiles of one lattice: the tile's place is computed from its corner and joined by
    equality, and the exact bounds are tested.  The tiles are broadcast where their
    counted size allows.
    """
    first = tiles.agg(F.min("xmin"), F.min("ymin"), F.min(F.col("xmax") - F.col("xmin")), F.count("*")).first()
    kept = list(points.columns)
    if not first[3]:
        empty = [F.lit(None).cast(tiles.schema[c].dataType).alias(c) for c in columns]
        return points.select(*kept, *empty) if how == "left" else points.select(*kept, *empty).limit(0)
    x0, y0, size, n = first
    near = F.rint((F.col("xmin") - x0) / size).cast("long"), F.rint((F.col("ymin") - y0) / size).cast("long")
    side = tiles.select(near[0].alias("_i"), near[1].alias("_j"), F.col("xmin").alias("_x0"), F.col("ymin").alias("_y0"), F.col("xmax").alias("_x1"), F.col("ymax").alias("_y1"), *columns)
    side = F.broadcast(side) if n <= BROADCAST_TILES else side
    placed = points
    for c, name, origin in ((x, "_i", x0), (y, "_j", y0)):
        u = (F.col(c) - F.lit(origin)) / F.lit(size)
        if how == "inner":
            # one place, or both beside a border that division may round across
            placed = placed.withColumn(name, F.explode(F.sequence(F.floor(u - 1e-9).cast("long"), F.floor(u + 1e-9).cast("long"))))
        else:
            low = F.lit(origin) + F.floor(u) * F.lit(size)
            placed = placed.withColumn(name, F.when(F.col(c) < low, F.floor(u) - 1).when(F.col(c) >= low + F.lit(size), F.floor(u) + 1).otherwise(F.floor(u)).cast("long"))
    joined = placed.alias("p").join(
        side.alias("t"),
        (F.col("p._i") == F.col("t._i")) & (F.col("p._j") == F.col("t._j")) & (F.col(f"p.{x}") >= F.col("t._x0")) & (F.col(f"p.{x}") < F.col("t._x1")) & (F.col(f"p.{y}") >= F.col("t._y0")) & (F.col(f"p.{y}") < F.col("t._y1")),
        how,
    )
    return joined.select(*(F.col(f"p.{c}") for c in kept), *(F.col(f"t.{c}") for c in columns))

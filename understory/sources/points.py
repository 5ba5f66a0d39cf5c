"""Point relations: files, the virtual cloud over order lines, and their extents.

A point row has x, y, z (double), and may have return_number, number_of_returns,
classification and segment-id attributes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: South-west corner and ground plane of the virtual cloud.
ORIGIN_X, ORIGIN_Y = 412337.0, 5733149.0
PLANE_Z, PLANE_X, PLANE_Y = 96.0, 0.02, 0.03


def read(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Points of a .parquet, .csv, .las or .laz file; only the columns that are named, if any are."""
    if re.search(r"(?i)\.la[sz]$", path):
        from understory.sources.las import register

        register(spark)
        reader = spark.read.format("las")
        return (reader.option("columns", ",".join(columns)) if columns else reader).load(path)
    if re.search(r"(?i)\.csv$", path):
        found = spark.read.option("header", True).option("inferSchema", True).csv(path)
    else:
        found = spark.read.parquet(path)
    return found.select(*columns) if columns else found


def ground(x: Column, y: Column) -> Column:
    """Height of the virtual cloud's ground plane."""
    return PLANE_Z + PLANE_X * (x - ORIGIN_X) + PLANE_Y * (y - ORIGIN_Y)


def virtual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deterministic cloud over the order lines of a folder."""
    return virtual_of(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def virtual_of(lines: DataFrame) -> DataFrame:
    """A cloud of 60 m by 60 m from order lines, streamed ones too: pid, x, y, z, h and two segment ids.

    Millimetres are computed in integers; h is the height above the ground plane.
    """
    order, line, part, supplier = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    p = lines.select(
        (order * 10 + line).alias("pid"),
        ((order * 7919 + line * 104729 + part * 31) % 60000).alias("hx"),
        ((order * 6101 + part * 15485 + supplier * 13) % 60000).alias("hy"),
        "l_quantity",
        "l_discount",
    )
    sx, sy = F.floor(F.col("hx") / 7000), F.floor(F.col("hy") / 7000)
    p = p.withColumns({"x": F.lit(ORIGIN_X) + F.col("hx") / F.lit(1000.0), "y": F.lit(ORIGIN_Y) + F.col("hy") / F.lit(1000.0), "sx": sx, "sy": sy})
    p = p.withColumn("h", (F.col("l_quantity") - 1) / F.lit(49.0) * (4 + (F.col("sx") * 7 + F.col("sy") * 11) % 20) + F.col("l_discount"))
    instance = F.when((F.col("sx") + F.col("sy")) % 5 == 0, 0).otherwise(1 + F.col("sx") + 100 * F.col("sy"))
    p = p.withColumn("PredInstance", instance.cast("double"))
    wide = F.when(F.col("PredInstance") == 0, 0).otherwise(1 + F.floor(F.col("hx") / 20000))
    p = p.withColumn("PredInstance_SAT", wide.cast("double"))
    return p.select("pid", "x", "y", (ground(F.col("x"), F.col("y")) + F.col("h")).alias("z"), "h", "PredInstance", "PredInstance_SAT")


def extent(points: DataFrame) -> DataFrame:
    """One row: n_points and the bounds in x and y."""
    return points.agg(F.count("*").alias("n_points"), F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))


def epsg_of(path: str) -> int | None:
    """The coordinate system that a file names by its EPSG number."""
    if not re.search(r"(?i)\.la[sz]$", path):
        return None
    from understory.sources.las import read_header

    return read_header(path).epsg


def bounds(points: DataFrame) -> tuple[tuple[float, float, float, float], int]:
    """(xmin, ymin, xmax, ymax) and the number of points; an error unless finite with positive spans."""
    count, *found = extent(points).first()
    if any(v is None or v != v or abs(v) == float("inf") for v in found) or found[2] <= found[0] or found[3] <= found[1]:
        raise ValueError("the point cloud has no finite XY extent with positive spans")
    return tuple(found), count


def unpivot(points: DataFrame, dimensions: list[str]) -> DataFrame:
    """Long form: a row for each point and segment-id attribute (instance_dimension, instance_id)."""
    ids = [c for c in points.columns if c not in dimensions]
    typed = points.select(*ids, *(F.col(d).cast("double").alias(d) for d in dimensions))
    return typed.unpivot(ids, dimensions, "instance_dimension", "instance_id")

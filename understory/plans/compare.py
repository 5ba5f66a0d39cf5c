"""Comparison of results: relations, tables as text, rasters and whole folders of artifacts."""

from __future__ import annotations

import csv
import hashlib
import os
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from understory.sinks import geotiff


def differences(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float = 1e-9) -> DataFrame:
    """(keys, column, a, b): cells in which two relations differ, doubles by more than the tolerance (absolute or relative).

    One full outer join on the keys; a row that one side lacks differs in every column.
    """
    columns = [f for f in a.schema if f.name not in keys]
    if [f.name for f in a.schema] != [f.name for f in b.schema]:
        raise ValueError("the relations have different columns")
    left = a.select(*keys, F.lit(True).alias("_a"), *(F.col(f.name).alias(f"a_{f.name}") for f in columns))
    right = b.select(*keys, F.lit(True).alias("_b"), *(F.col(f.name).alias(f"b_{f.name}") for f in columns))
    both = left.join(right, keys, "full_outer")
    cells = []
    for f in columns:
        x, y = F.col(f"a_{f.name}"), F.col(f"b_{f.name}")
        same = x.eqNullSafe(y)
        if f.dataType.typeName() in ("double", "float"):
            near = F.abs(x - y) <= F.greatest(F.lit(tolerance), F.lit(tolerance) * F.greatest(F.abs(x), F.abs(y)))
            same = same | F.coalesce(near, F.lit(False))
        differs = ~same | F.col("_a").isNull() | F.col("_b").isNull()
        cells.append(F.when(differs, F.struct(F.lit(f.name).alias("column"), x.cast("string").alias("a"), y.cast("string").alias("b"))))
    return both.select(*keys, F.explode(F.array_compact(F.array(*cells))).alias("_d")).select(*keys, "_d.*")


def csv_differences(a: str, b: str, ignored: Iterable[str] = ("file", "sensor", "country")) -> list[tuple[int, str, str, str]]:
    """(row, column, a, b) of cells whose text differs; other headers or row counts are an error."""
    tables = []
    for path in (a, b):
        with open(path, newline="", encoding="utf-8") as f:
            tables.append(list(csv.reader(f)))
    if tables[0][:1] != tables[1][:1] or len(tables[0]) != len(tables[1]):
        raise ValueError("the tables have other columns or row counts")
    header, skip = tables[0][0], set(ignored)
    rows = zip(tables[0][1:], tables[1][1:], strict=True)
    return [(i, c, x, y) for i, (p, q) in enumerate(rows, 1) for c, x, y in zip(header, p, q, strict=True) if c not in skip and x != y]


def same_raster(a: str, b: str, tolerance: float = 1e-9) -> bool:
    """Whether two rasters have the same place, size and cells."""
    (x, s), (y, t) = geotiff.read(a), geotiff.read(b)
    return all(s.get(k) == t.get(k) for k in (256, 257, 33550, 33922, 34735)) and np.allclose(x, y, rtol=tolerance, atol=tolerance, equal_nan=True)


def different_files(a: str, b: str, ignored: tuple[str, ...] = ("_performance.csv",)) -> list[str]:
    """Names of files that differ in bytes, or are in one folder only."""
    def digests(folder: str) -> dict[str, str]:
        out = {}
        for name in os.listdir(folder):
            if not name.endswith(ignored):
                with open(os.path.join(folder, name), "rb") as f:
                    out[name] = hashlib.file_digest(f, "sha256").hexdigest()
        return out

    x, y = digests(a), digests(b)
    return sorted(n for n in x.keys() | y.keys() if x.get(n) != y.get(n))

"""Footprints: GeoJSON and GeoPackage files of polygons with roles."""

from __future__ import annotations

import json
import sqlite3
import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from understory.geometry import MultiPolygon, clean

#: Names of roles, after trimming and lower-casing.
ROLES = {"include": "inclusion", "inclusion": "inclusion", "exclude": "exclusion", "exclusion": "exclusion"}


def role(c: Column) -> Column:
    """inclusion or exclusion; null for any other name."""
    names = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    return names[F.lower(F.trim(c))]


def roles(features: DataFrame, column: str) -> DataFrame:
    """features with their role; an unknown one fails the query."""
    found = role(F.col(column))
    return features.withColumn("role", F.when(found.isNull(), F.raise_error(F.concat(F.lit("unknown AOI role: "), F.coalesce(F.col(column), F.lit("null"))))).otherwise(found))


def _polygons(geometry: dict | None, label: str) -> MultiPolygon:
    kind = (geometry or {}).get("type")
    if kind == "Polygon":
        return [[[tuple(p[:2]) for p in ring] for ring in geometry["coordinates"]]]
    if kind == "MultiPolygon":
        return [[[tuple(p[:2]) for p in ring] for ring in polygon] for polygon in geometry["coordinates"]]
    raise ValueError(f"{label} must contain only Polygon or MultiPolygon geometries")


def read_geojson(path: str) -> dict[str, MultiPolygon]:
    """Polygons by role; without any role all are inclusions."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    kind = data.get("type")
    features = data["features"] if kind == "FeatureCollection" else [data] if kind == "Feature" else [{"geometry": data, "properties": {}}]
    if not features:
        raise ValueError("the AOI has no features")
    named = any("role" in (f.get("properties") or {}) for f in features)
    out: dict[str, MultiPolygon] = {"inclusion": [], "exclusion": []}
    for f in features:
        name = (f.get("properties") or {}).get("role") if named else "inclusion"
        known = ROLES.get(str(name).strip().lower()) if name is not None else None
        if known is None:
            raise ValueError(f"unknown AOI role: {name}")
        out[known] += _polygons(f.get("geometry"), f"AOI {known}")
    return {k: clean(v) for k, v in out.items()}


def _wkb(data: bytes, at: int = 0) -> tuple[MultiPolygon, int]:
    """Polygons of well-known binary, and where it ends."""
    order = "<" if data[at] == 1 else ">"
    kind = struct.unpack_from(order + "I", data, at + 1)[0]
    at += 5
    base, size = kind % 1000 & 0xFF, 2
    size += (kind // 1000 in (1, 2, 3)) + (kind // 1000 == 3) + bool(kind & 0x80000000) + bool(kind & 0x40000000)
    if kind & 0x20000000:
        at += 4
    (n,) = struct.unpack_from(order + "I", data, at)
    at += 4
    if base == 3:
        rings = []
        for _ in range(n):
            (m,) = struct.unpack_from(order + "I", data, at)
            values = struct.unpack_from(f"{order}{m * size}d", data, at + 4)
            rings.append([(values[i], values[i + 1]) for i in range(0, m * size, size)])
            at += 4 + 8 * m * size
        return [rings], at
    if base == 6:
        out: MultiPolygon = []
        for _ in range(n):
            part, at = _wkb(data, at)
            out += part
        return out, at
    raise ValueError("the AOI must contain only Polygon or MultiPolygon geometries")


def _gpkg_geometry(blob: bytes) -> MultiPolygon:
    """Polygons of a GeoPackage geometry: its header says how long the envelope is."""
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    envelope = (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7]
    return [] if blob[3] & 0x10 else _wkb(blob, 8 + envelope)[0]


def read_geopackage(path: str) -> dict[str, MultiPolygon]:
    """Polygons of the layers include (required) and exclude."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        layers = dict(db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns").fetchall())
        if "include" not in layers:
            raise ValueError("the GeoPackage has no layer named include")
        out: dict[str, MultiPolygon] = {"inclusion": [], "exclusion": []}
        for layer, name in (("include", "inclusion"), ("exclude", "exclusion")):
            if layer in layers:
                for (blob,) in db.execute(f'SELECT "{layers[layer]}" FROM "{layer}"'):
                    out[name] += _gpkg_geometry(blob) if blob else []
    if not out["inclusion"]:
        raise ValueError("the layer include has no features")
    return {k: clean(v) for k, v in out.items()}


def read(path: str) -> dict[str, MultiPolygon]:
    """Polygons by role of a .gpkg or GeoJSON file."""
    return read_geopackage(path) if path.lower().endswith(".gpkg") else read_geojson(path)

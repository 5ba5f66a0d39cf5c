"""GeoTIFF files of raster relations, written strip by strip.

Strips are filled and compressed in tasks, a strip a group; the driver appends the
compressed ones in order.  Cells without a row hold the no-data value.  A file that may
pass 4 GB is a BigTIFF.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from understory.sinks.tables import published

NODATA = -999999.0
STRIP_ROWS = 16


def _strip(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 6)


def _strips(cells: DataFrame, columns: int, rows: int, kind: np.dtype) -> DataFrame:
    """(strip, data): the compressed strips that have a cell, from the north."""
    height = STRIP_ROWS

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf.strip.iloc[0])
        values = np.full((min(height, rows - number * height), columns), NODATA, kind)
        values[rows - 1 - pdf.row.to_numpy() - number * height, pdf.col.to_numpy()] = pdf.value.to_numpy()
        return pd.DataFrame({"strip": [number], "data": [_strip(values)]})

    placed = cells.withColumn("strip", F.floor((F.lit(rows - 1) - F.col("row")) / height).cast("long"))
    return placed.groupBy("strip").applyInPandas(fill, "strip long, data binary")


def write(raster: DataFrame, path: str, x0: float, y0: float, resolution: float, columns: int, rows: int, epsg: int | None = None, value: str = "value", double: bool = True, big: bool | None = None) -> None:
    """raster (col, row counted from the south-west corner x0, y0; value) as a deflated GeoTIFF; big: as a BigTIFF, by its size if not said."""
    kind = np.dtype("<f8" if double else "<f4")
    big = rows * columns * kind.itemsize > 3 << 30 if big is None else big
    inside = raster.where((F.col("col") >= 0) & (F.col("col") < columns) & (F.col("row") >= 0) & (F.col("row") < rows)).select("col", "row", F.col(value).alias("value"))
    offsets, sizes = [], []
    place, entry, word = ("Q", 20, 8) if big else ("I", 12, 4)
    with published(path, "wb") as f:
        f.write(b"II+\0" + struct.pack("<HHQ", 8, 0, 0) if big else b"II*\0" + bytes(4))
        rest = _strips(inside, columns, rows, kind).orderBy("strip").toLocalIterator(prefetchPartitions=True)
        found = next(rest, None)
        empty: dict[int, bytes] = {}
        for number, top in enumerate(range(0, rows, STRIP_ROWS)):
            if found is not None and found[0] == number:
                data, found = bytes(found[1]), next(rest, None)
            else:
                height = min(STRIP_ROWS, rows - top)
                if height not in empty:
                    empty[height] = _strip(np.full((height, columns), NODATA, kind))
                data = empty[height]
            offsets.append(f.tell())
            sizes.append(len(data))
            f.write(data + b"\0" * (len(data) % 2))
        keys = [1, 1, 0, 2, 1024, 0, 1, 1, 1025, 0, 1, 1]
        if epsg:
            keys = [1, 1, 0, 3, *keys[4:], 3072, 0, 1, epsg]
        nodata = f"{NODATA:.0f}".encode() + b"\0"
        tags = [
            (256, "I", [columns]), (257, "I", [rows]), (258, "H", [kind.itemsize * 8]), (259, "H", [8]), (262, "H", [1]), (273, place, offsets), (277, "H", [1]), (278, "I", [STRIP_ROWS]),
            (279, place, sizes), (284, "H", [1]), (339, "H", [3]), (33550, "d", [resolution, resolution, 0.0]), (33922, "d", [0.0, 0.0, 0.0, x0, y0 + rows * resolution, 0.0]), (34735, "H", keys), (42113, "s", nodata),
        ]
        entries = []
        for tag, code, values in tags:
            data = values if code == "s" else struct.pack(f"<{len(values)}{code}", *values)
            head = struct.pack(f"<HH{place}", tag, {"H": 3, "I": 4, "d": 12, "s": 2, "Q": 16}[code], len(values))
            if len(data) <= word:
                entries.append(head + data.ljust(word, b"\0"))
            else:
                entries.append(head + struct.pack(f"<{place}", f.tell()))
                f.write(data + b"\0" * (len(data) % 2))
        at = f.tell()
        f.write(struct.pack("<Q" if big else "<H", len(entries)) + b"".join(entries) + bytes(word))
        f.seek(8 if big else 4)
        f.write(struct.pack(f"<{place}", at))


def read(path: str) -> tuple[np.ndarray, dict]:
    """A file of write(): rows from the north, NaN for no data, and its tags."""
    with open(path, "rb") as f:
        data = f.read()
    big = data[2] == 43
    place, entry, word = ("Q", 20, 8) if big else ("I", 12, 4)
    (at,) = struct.unpack_from(f"<{place}", data, word)
    (count,) = struct.unpack_from("<Q" if big else "<H", data, at)
    tags = {}
    for i in range(count):
        here = at + (8 if big else 2) + entry * i
        tag, kind, n = struct.unpack_from(f"<HH{place}", data, here)
        code, size = {3: ("H", 2), 4: ("I", 4), 12: ("d", 8), 2: ("s", 1), 16: ("Q", 8)}[kind]
        here += entry - word
        if n * size > word:
            (here,) = struct.unpack_from(f"<{place}", data, here)
        tags[tag] = data[here : here + n] if code == "s" else struct.unpack_from(f"<{n}{code}", data, here)
    raw = b"".join(zlib.decompress(data[o : o + n]) for o, n in zip(tags[273], tags[279], strict=True))
    grid = np.frombuffer(raw, "<f8" if tags[258][0] == 64 else "<f4").reshape(tags[257][0], tags[256][0]).astype(float)
    return np.where(grid == NODATA, np.nan, grid), tags

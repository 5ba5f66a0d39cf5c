"""LAS 1.2 to 1.4 point files as a Spark data source, and a writer.

Compressed (LAZ) records are unpacked by the laspy package with one of its decoders,
where it is installed on driver and executors; without it they are refused.

The source's schema comes from the file's header: coordinates, returns, class and the
extra attributes its records carry.  A partition is a range of records, so one file is
read by many tasks; each task decodes its range by numpy into Arrow batches.  Paths are
of a file system that driver and executors share.
"""

from __future__ import annotations

import importlib.util
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Records a partition holds, and records an Arrow batch holds.
PARTITION_RECORDS = 2_000_000
BATCH_RECORDS = 100_000

#: Bytes of a record of each point format, before extra bytes.
_SIZES = (20, 28, 26, 34, 57, 63, 30, 36, 38, 59, 67)
#: numpy kinds of the extra-byte data types 1 to 10.
_EXTRA = ("u1", "i1", "<u2", "<i2", "<u4", "<i4", "<u8", "<i8", "<f4", "<f8")


@dataclass
class Header:
    """What a reader needs of a file's header."""

    version: tuple[int, int]
    format: int
    size: int
    count: int
    offset: int
    scale: tuple[float, float, float]
    shift: tuple[float, float, float]
    low: tuple[float, float, float]
    high: tuple[float, float, float]
    extras: list[tuple[str, str, float, float]]
    epsg: int | None = None
    compressed: bool = False


def _epsg(record: int, data: bytes) -> int | None:
    """The EPSG number of a coordinate system record: well-known text, or keys."""
    if record == 2112:
        found = re.findall(rb'(?:AUTHORITY|ID)\["EPSG",\s*"?(\d+)"?\]', data)
        return int(found[-1]) if found else None
    keys = struct.unpack_from(f"<{len(data) // 2}H", data)
    named = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    code = named.get(3072) or named.get(2048)
    return code if code and code != 32767 else None


def read_header(path: str) -> Header:
    """The header of a LAS or LAZ file; another magic is an error."""
    with open(path, "rb") as f:
        h = f.read(375)
        if len(h) < 227 or h[:4] != b"LASF":
            raise ValueError(f"{path} is not a LAS file")
        version, (size,), (offset, n_vlr) = (h[24], h[25]), struct.unpack_from("<H", h, 94), struct.unpack_from("<II", h, 96)
        point_format, (length,), (count,) = h[104], struct.unpack_from("<H", h, 105), struct.unpack_from("<I", h, 107)
        compressed, point_format = bool(point_format & 0xC0), point_format & 0x3F
        if version >= (1, 4) and len(h) >= 255:
            count = struct.unpack_from("<Q", h, 247)[0] or count
        values = struct.unpack_from("<12d", h, 131)
        f.seek(size)
        extras, epsg = [], None
        for _ in range(n_vlr):
            vlr = f.read(54)
            user, (record, body) = vlr[2:18].rstrip(b"\0"), struct.unpack_from("<HH", vlr, 18)
            data = f.read(body)
            if user == b"LASF_Spec" and record == 4:
                extras += [_extra(data[i : i + 192]) for i in range(0, len(data) - 191, 192)]
            elif user == b"LASF_Projection" and record in (2112, 34735):
                epsg = _epsg(record, data) or epsg
    return Header(version, point_format, length, count, offset, values[0:3], values[3:6], (values[7], values[9], values[11]), (values[6], values[8], values[10]), extras, epsg, compressed)


def _extra(record: bytes) -> tuple[str, str, float, float]:
    """(name, kind, scale, offset) of an extra-bytes descriptor."""
    kind, options = record[2], record[3]
    name = record[4:36].split(b"\0")[0].decode("utf-8", "replace")
    scale = struct.unpack_from("<d", record, 112)[0] if options & 8 else 1.0
    shift = struct.unpack_from("<d", record, 136)[0] if options & 16 else 0.0
    return name, _EXTRA[kind - 1] if 1 <= kind <= 10 else f"V{options or 1}", scale, shift


def extent(path: str) -> tuple[float, float, float, float]:
    """xmin, ymin, xmax, ymax of the header; an error unless finite with positive spans."""
    h = read_header(path)
    box = (h.low[0], h.low[1], h.high[0], h.high[1])
    if not np.isfinite(box).all() or box[2] <= box[0] or box[3] <= box[1]:
        raise ValueError("the point cloud has no finite XY extent with positive spans")
    return box


def _layout(h: Header) -> np.dtype:
    """The record's fields that are read."""
    new = h.format >= 6
    fields = [("X", "<i4", 0), ("Y", "<i4", 4), ("Z", "<i4", 8), ("returns", "u1", 14), ("class", "u1", 16 if new else 15)]
    at = _SIZES[h.format]
    for i, (_, kind, _, _) in enumerate(h.extras):
        fields.append((f"e{i}", kind, at))
        at += np.dtype(kind).itemsize
    names, kinds, offsets = zip(*fields, strict=True)
    return np.dtype({"names": names, "formats": kinds, "offsets": offsets, "itemsize": h.size})


def _names(h: Header) -> list[str]:
    """Names of the extra attributes, each once."""
    return list(dict.fromkeys(n for n, k, _, _ in h.extras if k[0] != "V"))


def schema(h: Header) -> T.StructType:
    base = [("x", T.DoubleType()), ("y", T.DoubleType()), ("z", T.DoubleType()), ("return_number", T.IntegerType()), ("number_of_returns", T.IntegerType()), ("classification", T.IntegerType())]
    return T.StructType([T.StructField(n, t) for n, t in [*base, *((n, T.DoubleType()) for n in _names(h))]])


def decode(h: Header, data: bytes) -> pa.RecordBatch:
    """Rows of whole records."""
    rows = np.frombuffer(data, _layout(h))
    columns = [rows[c] * h.scale[i] + h.shift[i] for i, c in enumerate("XYZ")]
    bits, mask = rows["returns"], (15, 4) if h.format >= 6 else (7, 3)
    columns += [(bits & mask[0]).astype(np.int32), ((bits >> mask[1]) & mask[0]).astype(np.int32)]
    columns.append((rows["class"] if h.format >= 6 else rows["class"] & 31).astype(np.int32))
    names = [f.name for f in schema(h)]
    seen = {}
    for i, (name, kind, scale, shift) in enumerate(h.extras):
        if kind[0] != "V" and name not in seen:
            seen[name] = rows[f"e{i}"].astype(np.float64) * scale + shift
    columns += [seen[n] for n in _names(h)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def packed(path: str, first: int, count: int) -> Iterator[bytes]:
    """Records of a range of a compressed file, a batch at a time."""
    import laspy

    with laspy.open(path) as f:
        f.seek(first)
        for at in range(0, count, BATCH_RECORDS):
            yield f.read_points(min(BATCH_RECORDS, count - at)).array.tobytes()


def plain(path: str, h: Header, first: int, count: int) -> Iterator[bytes]:
    """Records of a range of an uncompressed file, a batch at a time."""
    with open(path, "rb") as f:
        f.seek(h.offset + first * h.size)
        for at in range(0, count, BATCH_RECORDS):
            yield f.read(min(BATCH_RECORDS, count - at) * h.size)


class _Range(InputPartition):
    def __init__(self, first: int, count: int):
        self.first, self.count = first, count


class _Reader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns
        self.header = read_header(path)
        if self.header.compressed and not importlib.util.find_spec("laspy"):
            raise ValueError("reading compressed LAZ records needs the laspy package with a decoder: install it, or convert the file to LAS")

    def partitions(self) -> Sequence[InputPartition]:
        n = self.header.count
        return [_Range(i, min(PARTITION_RECORDS, n - i)) for i in range(0, n, PARTITION_RECORDS)] or [_Range(0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        h, first, count = self.header, partition.first, partition.count
        for data in packed(self.path, first, count) if h.compressed else plain(self.path, h, first, count):
            if len(data) < min(count, BATCH_RECORDS) * h.size:
                raise ValueError(f"{self.path} ends before its last record")
            count -= len(data) // h.size
            yield decode(h, data).select(self.columns)


class LasSource(DataSource):
    """Format "las": option path; option columns, comma-separated, reads only those."""

    @classmethod
    def name(cls) -> str:
        return "las"

    def _columns(self) -> list[str]:
        every = [f.name for f in schema(read_header(self._path()))]
        asked = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        return [c for c in every if not asked or c in asked]

    def _path(self) -> str:
        return re.sub(r"^file:(//)?", "", self.options["path"])

    def schema(self) -> T.StructType:
        wanted = self._columns()
        return T.StructType([f for f in schema(read_header(self._path())) if f.name in wanted])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self._path(), [f.name for f in schema])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LasSource)


def write(path: str, xyz: np.ndarray, classification: np.ndarray | None = None, extras: dict[str, np.ndarray] | None = None, scale: float = 0.001, version: tuple[int, int] = (1, 4), epsg: int | None = None) -> None:
    """Write points to a LAS file: format 6 for 1.4, else format 0; extras are 8-byte floats."""
    extras = extras or {}
    n, new = len(xyz), version >= (1, 4)
    point_format = 6 if new else 0
    head = 375 if new else 227
    vlr = b""
    if extras:
        body = b"".join(b"\0\0" + bytes([10, 0]) + k.encode()[:32].ljust(32, b"\0") + bytes(156) for k in extras)
        vlr = b"\0\0" + b"LASF_Spec".ljust(16, b"\0") + struct.pack("<HH", 4, len(body)) + bytes(32) + body
    if epsg:
        body = struct.pack("<8H", 1, 1, 0, 1, 3072, 0, 1, epsg)
        vlr += b"\0\0" + b"LASF_Projection".ljust(16, b"\0") + struct.pack("<HH", 34735, len(body)) + bytes(32) + body
    shift = np.floor(xyz.min(axis=0)) if n else np.zeros(3)
    low, high = (xyz.min(axis=0), xyz.max(axis=0)) if n else (np.zeros(3), np.zeros(3))
    size = _SIZES[point_format] + 8 * len(extras)
    h = Header(version, point_format, size, n, head + len(vlr), (scale,) * 3, tuple(shift), tuple(low), tuple(high), [(k, "<f8", 1.0, 0.0) for k in extras])
    rows = np.zeros(n, _layout(h))
    for i, c in enumerate("XYZ"):
        rows[c] = np.rint((xyz[:, i] - shift[i]) / scale)
    rows["returns"] = 0x11 if new else 0x09
    rows["class"] = 1 if classification is None else classification
    for i, values in enumerate(extras.values()):
        rows[f"e{i}"] = values
    header = bytearray(head)
    header[:4] = b"LASF"
    header[24:26] = bytes(version)
    struct.pack_into("<HIIBH", header, 94, head, head + len(vlr), bool(extras) + bool(epsg), point_format, size)
    struct.pack_into("<I", header, 107, 0 if new else n)
    struct.pack_into("<12d", header, 131, scale, scale, scale, *shift, high[0], low[0], high[1], low[1], high[2], low[2])
    if new:
        struct.pack_into("<Q", header, 247, n)
    with open(path, "wb") as f:
        f.write(bytes(header) + vlr + rows.tobytes())

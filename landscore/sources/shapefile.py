"""A Python data source for polygon shapefiles: attributes from the .dbf, geometry as WKB. One partition for each PIECE
records, found by the .shx index; every record's bytes are read by its own task."""

from __future__ import annotations

import struct

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from ..operators.spatial import wkb_polygon

PIECE = 10_000


def dbf_fields(path: str) -> tuple[int, int, int, list[tuple[str, str, int, int]]]:
    """Records, header size, record size, fields (name, kind, size, decimals)."""
    with open(path, "rb") as f:
        n, head, size = struct.unpack("<IHH", f.read(12)[4:])
        f.seek(32)
        fields = []
        while (b := f.read(32))[0] != 0x0D:
            fields.append((b[:11].split(b"\0")[0].decode(), chr(b[11]), b[16], b[17]))
            if len(fields) * 32 + 32 >= head:
                break
    return n, head, size, fields


def spark_type(kind: str, decimals: int):
    if kind in "NF":
        return DoubleType() if decimals or kind == "F" else LongType()
    return BooleanType() if kind == "L" else StringType()


def parsed(raw: bytes, kind: str, decimals: int):
    text = raw.decode("utf-8", "replace").strip()
    if kind in "NF":
        if not text or set(text) == {"*"}:
            return None
        return float(text) if decimals or kind == "F" else int(float(text))
    if kind == "L":
        return {"Y": True, "T": True, "N": False, "F": False}.get(text.upper())
    return text or None


def area2(ring: list[tuple[float, float]]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False))


def polygon(record: bytes) -> bytes | None:
    """WKB of a polygon record (its rings in one polygon, outer ones first: rings count by the even-odd rule)."""
    if struct.unpack_from("<i", record)[0] not in (5, 15, 25):
        return None
    parts, points = struct.unpack_from("<2i", record, 36)
    first = [*struct.unpack_from(f"<{parts}i", record, 44), points]
    flat = struct.unpack_from(f"<{2 * points}d", record, 44 + 4 * parts)
    rings = [[(flat[2 * i], flat[2 * i + 1]) for i in range(a, b)] for a, b in zip(first, first[1:], strict=False)]
    return wkb_polygon(sorted(rings, key=lambda r: area2(r) > 0))


class Piece(InputPartition):
    def __init__(self, first: int, end: int):
        self.first, self.end = first, end


class ShapefileReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.removesuffix(".shp")

    def partitions(self) -> list[Piece]:
        n = dbf_fields(f"{self.path}.dbf")[0]
        return [Piece(i, min(n, i + PIECE)) for i in range(0, max(n, 1), PIECE)]

    def read(self, partition: Piece):
        _, head, size, fields = dbf_fields(f"{self.path}.dbf")
        k = partition.end - partition.first
        with open(f"{self.path}.dbf", "rb") as d, open(f"{self.path}.shx", "rb") as x, open(f"{self.path}.shp", "rb") as s:
            d.seek(head + size * partition.first)
            x.seek(100 + 8 * partition.first)
            for _ in range(k):
                row, at, values = d.read(size), 1, []
                offset, length = struct.unpack(">2i", x.read(8))
                if row[:1] == b"*":
                    continue
                for _, kind, width, decimals in fields:
                    values.append(parsed(row[at : at + width], kind, decimals))
                    at += width
                s.seek(2 * offset + 8)
                yield (*values, polygon(s.read(2 * length)))


class ShapefileSource(DataSource):
    """spark.dataSource.register(ShapefileSource); spark.read.format("shapefile").load(path)."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> StructType:
        fields = dbf_fields(self.options["path"].removesuffix(".shp") + ".dbf")[3]
        return StructType([*(StructField(n, spark_type(k, d)) for n, k, _, d in fields), StructField("geometry", BinaryType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return ShapefileReader(self.options["path"])

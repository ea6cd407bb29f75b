"""Shapefiles as a Python data source: ``spark.read.format("shapefile").load("layer.shp")``.

The index (.shx) gives each record's place, so the layer is read in ranges of records, each by a task of its own; attributes have records of
fixed size and are read by the same ranges.  Rows: row_idx, rings (null for a null shape) and one text column an attribute.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def _read(path: str, start: int = 0, size: int | None = None) -> bytes:
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    with store.open_input_file(at) as f:
        f.seek(start)
        return f.read() if size is None else f.read(size)


@dataclass
class Field:
    name: str
    start: int
    size: int


@dataclass
class Range(InputPartition):
    first: int
    end: int


def dbf_header(data: bytes) -> tuple[int, int, int, list[Field]]:
    """(records, header bytes, record bytes, fields)."""
    n, head, size = struct.unpack("<IHH", data[4:12])
    fields, at, place = [], 32, 1
    while data[at] != 0x0D:
        name = data[at : at + 11].split(b"\0")[0].decode("latin-1")
        fields.append(Field(name, place, data[at + 16]))
        place += data[at + 16]
        at += 32
    return n, head, size, fields


def rings_of(record: bytes) -> list[list[dict]] | None:
    """Rings of a polygon record, or a ring of one point; None for a null shape."""
    kind = struct.unpack("<i", record[:4])[0]
    if kind == 0:
        return None
    if kind in (1, 11, 21):
        x, y = struct.unpack("<2d", record[4:20])
        return [[{"x": x, "y": y}]]
    n_parts, n_points = struct.unpack("<2i", record[36:44])
    parts = [*struct.unpack(f"<{n_parts}i", record[44 : 44 + 4 * n_parts]), n_points]
    flat = struct.unpack(f"<{2 * n_points}d", record[44 + 4 * n_parts : 44 + 4 * n_parts + 16 * n_points])
    points = [{"x": x, "y": y} for x, y in zip(flat[::2], flat[1::2], strict=True)]
    rings = [points[a:b] for a, b in zip(parts, parts[1:], strict=False)]
    return [r[:-1] if len(r) > 1 and r[0] == r[-1] else r for r in rings]


class ShapefileReader(DataSourceReader):
    def __init__(self, path: str, per_task: int) -> None:
        self.base = path[:-4] if path.lower().endswith(".shp") else path
        self.per_task = per_task

    def _size(self) -> int:
        return (struct.unpack(">i", _read(f"{self.base}.shx", 24, 4))[0] * 2 - 100) // 8

    def partitions(self) -> list[Range]:
        n = self._size()
        return [Range(i, min(i + self.per_task, n)) for i in range(0, n, self.per_task)] or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        n = partition.end - partition.first
        if not n:
            return
        index = struct.unpack(f">{2 * n}i", _read(f"{self.base}.shx", 100 + 8 * partition.first, 8 * n))
        starts, sizes = index[::2], index[1::2]
        first = 2 * starts[0]
        shapes = _read(f"{self.base}.shp", first, 2 * starts[-1] + 8 + 2 * sizes[-1] - first)
        _, head, size, fields = dbf_header(_read(f"{self.base}.dbf", 0, 32 + 32 * 256 + 1))
        rows = _read(f"{self.base}.dbf", head + size * partition.first, size * n)
        for i in range(n):
            at = 2 * starts[i] - first + 8
            row = rows[i * size : (i + 1) * size]
            values = [row[f.start : f.start + f.size].decode("utf-8", "replace").strip(" \0") for f in fields]
            yield (partition.first + i, rings_of(shapes[at : at + 2 * sizes[i]]), *values)


class Shapefile(DataSource):
    """Options: ``per_task``, records read by a task (50000)."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        path = self.options["path"]
        base = path[:-4] if path.lower().endswith(".shp") else path
        fields = dbf_header(_read(f"{base}.dbf", 0, 32 + 32 * 256 + 1))[3]
        return "row_idx long, rings array<array<struct<x:double,y:double>>>, " + ", ".join(f"`{f.name}` string" for f in fields)

    def reader(self, schema) -> ShapefileReader:
        return ShapefileReader(self.options["path"], int(self.options.get("per_task", 50_000)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Shapefile)

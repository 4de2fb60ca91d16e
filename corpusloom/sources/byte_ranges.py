"""A data source that reads lines from a few byte ranges of large files, each range a partition.

``spark.read.format("byte_ranges").option("ranges", 5).option("bytes", 2 << 20)``:
of each file that many ranges at evenly spaced offsets. A range that doesn't
begin a file or a line drops the line it begins within; a line that goes on beyond
the range's end is left out, so nothing outside the ranges is read but one byte
before each. Ranges that meet are read once. A file no larger than the ranges
together is read whole. Files are opened by pyarrow, so any store that it knows
serves.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, start long, line string"
#: Lines of an Arrow batch.
LINES = 4096


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        super().__init__((path, start, end))
        self.path, self.start, self.end = path, start, end


def spaced(size: int, ranges: int, width: int) -> list[tuple[int, int]]:
    """``ranges`` of ``width`` bytes, the first at 0, at evenly spaced offsets; those that meet become one."""
    out: list[tuple[int, int]] = []
    for k in range(ranges):
        start = k * size // ranges
        end = min(size, start + width)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        elif start < end:
            out.append((start, end))
    return out


def whole_lines(data: bytes, before: bytes, at_end: bool, start: int) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the lines that lie whole in ``data``, which begins at ``start`` after the byte ``before`` (none: the file begins)."""
    at = 0
    if before not in (b"", b"\n"):
        at = data.find(b"\n") + 1
        if not at:
            return
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0 and not at_end:
            return
        end = len(data) if end < 0 else end
        yield start + at, data[at:end]
        at = end + 1


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///") if path.startswith("file:/") and not path.startswith("file://") else path)


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.ranges, self.width = options["path"], int(options.get("ranges", 5)), int(options.get("bytes", 2 << 20))
        if self.ranges < 1 or self.width < 1:
            raise ValueError("ranges and bytes must be at least 1")

    def partitions(self) -> list[Range]:
        store, path = open_path(self.path)
        info = store.get_file_info(path)
        files = [info] if info.type == fs.FileType.File else sorted(store.get_file_info(fs.FileSelector(path)), key=lambda f: f.path)
        files = [f for f in files if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
        root = self.path.rstrip("/")
        return [Range(root if f is info else f"{root}/{f.base_name}", a, b) for f in files for a, b in spaced(f.size, self.ranges, self.width)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, bytes]] = []
        if partition.end > partition.start:
            store, path = open_path(partition.path)
            with store.open_input_file(path) as file:
                size, lead = file.size(), min(partition.start, 1)
                data = file.read_at(partition.end - partition.start + lead, partition.start - lead)
            rows = list(whole_lines(data[lead:], data[:lead], partition.end >= size, partition.start))
        for at in range(0, len(rows), LINES):
            some = rows[at : at + LINES]
            lines = [x.removesuffix(b"\r").decode("utf-8", "replace") for _, x in some]
            yield pa.RecordBatch.from_arrays([pa.array([partition.path] * len(some)), pa.array([s for s, _ in some], pa.int64()), pa.array(lines)], names=["file", "start", "line"])


class ByteRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(self.options)


def sample_lines(spark: SparkSession, path: str, ranges: int = 5, width: int = 2 << 20) -> DataFrame:
    """``file, start, line`` of the whole lines in the ranges."""
    spark.dataSource.register(ByteRanges)
    return spark.read.format("byte_ranges").option("path", path).option("ranges", str(ranges)).option("bytes", str(width)).load()


def sample_records(spark: SparkSession, path: str, schema: str, key: str, ranges: int = 5, width: int = 2 << 20) -> DataFrame:
    """The JSON records of ``sample_lines``, each key once (the first in file order); lines that aren't records of a key are left out."""
    rows = sample_lines(spark, path, ranges, width).select("file", "start", F.from_json("line", schema).alias("x")).filter(F.col("x")[key].isNotNull())
    first = rows.groupBy(F.col("x")[key].alias("k")).agg(F.min_by("x", F.struct("file", "start")).alias("x"))
    return first.select("x.*")

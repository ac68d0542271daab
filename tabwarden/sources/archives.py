"""CSV files in zip archives as a Spark source: the driver reads the archives' lists of members, tasks read the members.

A member is one partition, as a compressed stream cannot be entered in its middle; many archives are read by many tasks.  Nothing is
unpacked to a disk, and a task that is run again opens its member again.
"""

from __future__ import annotations

import csv
import glob
import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BATCH = 10_000


def archives(path: str) -> list[str]:
    """The zip archives of a path, folder or pattern, in the order of their names."""
    path = path.removeprefix("file://")
    found = glob.glob(f"{path}/*.zip") if Path(path).is_dir() else glob.glob(path)
    if not found:
        raise FileNotFoundError(path)
    return sorted(found)


def members(archive: str) -> list[str]:
    """The CSV members of an archive by name."""
    with zipfile.ZipFile(archive) as z:
        names = sorted(n for n in z.namelist() if n.lower().endswith(".csv"))
    if not names:
        raise ValueError(f"no CSV in {archive}")
    return names


@dataclass
class Member(InputPartition):
    archive: str
    name: str


def _rows(archive: str, name: str) -> Iterator[list[str]]:
    with zipfile.ZipFile(archive) as z, z.open(name) as raw:
        yield from csv.reader(io.TextIOWrapper(raw, encoding="utf-8-sig", newline=""))


class ZippedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, parts: list[Member]):
        self.names, self.parts = schema.names, parts

    def partitions(self) -> list[Member]:
        return self.parts

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        """Columns are found by the member's own header; missing and empty ones are null."""
        rows = _rows(partition.archive, partition.name)
        header = {c: i for i, c in enumerate(next(rows, []))}
        at, held = [header.get(c) for c in self.names], []

        def batch() -> pa.RecordBatch:
            columns = [[r[i] or None if i is not None and i < len(r) else None for r in held] for i in at]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=self.names)

        for row in rows:
            if row:
                held.append(row)
            if len(held) == BATCH:
                yield batch()
                held.clear()
        if held:
            yield batch()


class ZippedCsv(DataSource):
    """``spark.read.format("zipped_csv").option("members", "first" or "all").load(path)``: all columns as text."""

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def _parts(self) -> list[Member]:
        every = self.options.get("members", "first") == "all"
        return [Member(a, n) for a in archives(self.options["path"]) for n in (members(a) if every else members(a)[:1])]

    def schema(self) -> T.StructType:
        """The columns of all members' headers, in the order in which they come."""
        names = dict.fromkeys(c for p in self._parts() for c in next(_rows(p.archive, p.name), []))
        return T.StructType([T.StructField(c, T.StringType()) for c in names])

    def reader(self, schema: T.StructType) -> ZippedReader:
        return ZippedReader(schema, self._parts())


def read_zipped(spark: SparkSession, path: str, every: bool = False) -> DataFrame:
    spark.dataSource.register(ZippedCsv)
    return spark.read.format("zipped_csv").option("members", "all" if every else "first").load(path)

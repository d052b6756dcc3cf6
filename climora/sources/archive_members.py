"""Yearly ZIP archives as a Spark data source: a partition is a range of members, not an archive.

Planning reads the end of each archive, its central directory, and nothing else. Members of stations that were not asked for
are dropped there; the others are dealt to partitions of about ``split_bytes`` compressed bytes, in the order of the file. A
partition reads the bytes of its members only, and hands on one station file at a time, so neither the size of an
archive nor the number of its members bounds what can be read (a member itself has to fit into a binary value).

Files are opened by Arrow's file systems (local, HDFS, S3, GCS, Azure). ``archives.scan_archives`` reads the same through Spark's own
readers, an archive at a time, for stores that Arrow does not open.
"""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from climora.sources.archives import MEMBER_FIELDS, MEMBER_SCHEMA, first_members, years_of

SPLIT_BYTES = 16 << 20
_LOCAL_HEADER = struct.Struct("<4s5H3I2H")


@dataclass(frozen=True)
class Member:
    """Where a station file lies in its archive."""

    station: str
    name: str
    offset: int
    compressed: int
    size: int
    crc: int
    method: int


@dataclass
class MemberRange(InputPartition):
    """Members of one archive, in the order of their offsets."""

    path: str
    year: int
    members: tuple[Member, ...]


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path or URI, and the path in it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def list_members(store: fs.FileSystem, path: str, stations: tuple[str, ...] | None) -> list[Member] | None:
    """The wanted members of an archive by offset; None if there is no such archive."""
    if store.get_file_info(path).type != fs.FileType.File:
        return None
    with store.open_input_file(path) as file, zipfile.ZipFile(file) as archive:
        chosen = first_members(archive.namelist(), stations)
        found = [
            Member(code, name, i.header_offset, i.compress_size, i.file_size, i.CRC, i.compress_type)
            for code, name in chosen.items() for i in [archive.getinfo(name)]
        ]
    return sorted(found, key=lambda m: (m.offset, m.station))


def split_members(members: list[Member], most: int) -> Iterator[tuple[Member, ...]]:
    """Runs of members whose compressed sizes sum to ``most`` at most; a larger member is alone."""
    held, size = [], 0
    for member in members:
        if held and size + member.compressed > most:
            yield tuple(held)
            held, size = [], 0
        held.append(member)
        size += member.compressed
    if held:
        yield tuple(held)


def read_member(file, member: Member) -> bytes:
    """Content of a member: its local header tells where the data begin, the directory how long they are."""
    file.seek(member.offset)
    head = _LOCAL_HEADER.unpack(file.read(_LOCAL_HEADER.size))
    if head[0] != b"PK\x03\x04":
        raise ValueError(f"{member.name}: no member at byte {member.offset}")
    if head[2] & 1 or member.method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"{member.name}: encrypted, or compressed by method {member.method}")
    file.seek(member.offset + _LOCAL_HEADER.size + head[-2] + head[-1])
    data = file.read(member.compressed)
    if member.method == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(data, wbits=-zlib.MAX_WBITS, bufsize=max(1, member.size))
    if len(data) != member.size or zlib.crc32(data) != member.crc:
        raise ValueError(f"{member.name}: content does not agree with the archive's directory")
    return data


class _MemberReader(DataSourceReader):
    def __init__(self, root: str, years: range, stations: tuple[str, ...] | None, split_bytes: int):
        self.root, self.years, self.stations, self.split_bytes = root.rstrip("/"), years, stations, split_bytes

    def partitions(self) -> list[InputPartition]:
        found = []
        for year in self.years:
            path = f"{self.root}/{year}.zip"
            store, inside = open_store(path)
            members = list_members(store, inside, self.stations) or []
            found += [MemberRange(path, year, part) for part in split_members(members, self.split_bytes)]
        return found or [MemberRange("", 0, ())]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.members:
            return
        store, inside = open_store(partition.path)
        with store.open_input_file(inside) as file:
            for m in partition.members:
                cells = [[partition.year], [m.station], [m.name], [read_member(file, m)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, MEMBER_FIELDS)], schema=MEMBER_FIELDS)


class ArchiveMembers(DataSource):
    """Options: ``path``, ``first_year``, ``last_year``, ``stations`` (comma-separated; absent: all), ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "climora_archive_members"

    def schema(self) -> str:
        return MEMBER_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        given = self.options
        stations = tuple(given["stations"].split(",")) if given.get("stations") else None
        years = range(int(given["first_year"]), int(given["last_year"]) + 1)
        return _MemberReader(given["path"], years, stations, int(given.get("split_bytes", SPLIT_BYTES)))


def scan_archive_members(
    spark: SparkSession,
    root: str,
    start: date,
    end: date,
    stations: tuple[str, ...] | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Station files of the archives ``root/<year>.zip`` for the years of the range, as ``archives.scan_archives`` gives them.

    A year without an archive contributes nothing. Rows need no shuffle: members are spread as they are read.
    """
    spark.dataSource.register(ArchiveMembers)
    years = years_of(start, end)
    reader = spark.read.format(ArchiveMembers.name()).options(
        path=root, first_year=years[0], last_year=years[-1], split_bytes=split_bytes
    )
    if stations is not None:
        if any("," in s or not s for s in stations):
            raise ValueError("station codes are not empty and hold no commas")
        reader = reader.option("stations", ",".join(stations))
    return reader.load()

"""Folders as a table of their files: a data source whose partitions are folder prefixes, so that executors do the listing.

The driver opens only the topmost folders, level by level, until there are ``prefixes`` of them, and keeps folders' names and nothing else.
Each prefix is then walked by a task, folder by folder, and each file is asked for once, with its size and time. Every entry
gives a row: hidden names, empty files, names that are not UTF-8, links that lead nowhere and folders that may not be
read; the last two say so in ``problem``.

As a stream, each batch lists the folder as it is then; ``new_files`` keeps those that were not listed before, by path, size and time,
so files that come late with an old date are not lost and a file written anew comes again.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from . import stores

SCHEMA = "path string, rel_path string, place binary, size_bytes long, modified timestamp, problem string"
NAME = "folder_listing"
_ARROW = pa.schema([("path", pa.string()), ("rel_path", pa.string()), ("place", pa.binary()), ("size_bytes", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("problem", pa.string())])
BATCH = 4096  # rows that are handed on at a time
OPEN = 200  # folders that a walk keeps open; deeper ones are read to their end at once, because the system limits open ones


class Prefix(InputPartition):
    """A folder, with or without what is below its subfolders."""

    def __init__(self, folder: bytes, whole: bool):
        super().__init__(None)
        self.folder, self.whole = folder, whole


def prefixes(root: str, wanted: int) -> list[Prefix]:
    """Folders that together hold all files below root, ``wanted`` or more if there are so many within reach.

    A level with more than ``wanted`` times 64 folders is not opened nor read to its end, so the driver's memory is bounded.
    """
    store, path = stores.opened(root)
    level, out = [path.encode("utf-8", "surrogateescape")], []
    while level and len(level) < wanted:
        below, shut = [], []
        for folder in level:
            room = 64 * wanted - len(below)
            try:
                inner = list(islice((_under(folder, e.name) for e in stores.entries(store, folder) if e.is_folder), room + 1))
            except OSError:
                inner = None  # its task will say why
            if inner is None or len(inner) > room:
                shut.append(folder)
                continue
            out.append(Prefix(folder, False))
            below += inner
        out += [Prefix(f, True) for f in shut]
        level = below
    return out + [Prefix(f, True) for f in level]


def _under(folder: bytes, name: bytes) -> bytes:
    return folder.rstrip(b"/") + b"/" + name


def _readable(name: bytes) -> str:
    return name.decode("utf-8", "backslashreplace")


def _inside(store: object, folder: bytes, at_once: bool) -> Iterator[stores.Entry]:
    found = stores.entries(store, folder)
    yield from list(found) if at_once else found


def listed(root: str, prefix: Prefix) -> Iterator[pa.RecordBatch]:
    """A row for each entry of a prefix that is no folder."""
    store, path = stores.opened(root)
    head, _ = stores.split(root)
    base = path.encode("utf-8", "surrogateescape").rstrip(b"/") + b"/"
    rows: list[tuple] = []

    def row(place: bytes, size: int | None, modified: int | None, problem: str | None) -> tuple:
        return head + _readable(place), _readable(place.removeprefix(base)), place, size, modified, problem

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    # the folders that are open, each read as far as the walk has come; what is still to come is held by none of them
    walk = [(prefix.folder, _inside(store, prefix.folder, False))]
    while walk:
        folder, inside = walk[-1]
        try:
            e = next(inside, None)
        except OSError as x:
            rows.append(row(folder, None, None, f"Folder{type(x).__name__}"))
            e = None
        if e is None:
            walk.pop()
            continue
        place = _under(folder, e.name)
        if e.is_folder:
            if prefix.whole:
                walk.append((place, _inside(store, place, len(walk) >= OPEN)))
            continue
        rows.append(row(place, e.size, e.modified_us, e.problem))
        if len(rows) >= BATCH:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


class _Reader(DataSourceReader):
    def __init__(self, root: str, wanted: int):
        self.root, self.wanted = root, wanted

    def partitions(self) -> list[Prefix]:
        return prefixes(self.root, self.wanted)

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        return listed(self.root, partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are times of asking: each batch lists everything there is."""

    def __init__(self, root: str, wanted: int):
        self.root, self.wanted = root, wanted

    def initialOffset(self) -> dict:
        return {"asked": 0}

    def latestOffset(self) -> dict:
        return {"asked": time.time_ns() // 1_000_000}

    def partitions(self, start: dict, end: dict) -> list[Prefix]:
        return prefixes(self.root, self.wanted)

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        return listed(self.root, partition)


class FolderListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def _given(self) -> tuple[str, int]:
        return self.options["root"], int(self.options.get("prefixes", "64"))

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(*self._given())

    def streamReader(self, schema: object) -> DataSourceStreamReader:
        return _StreamReader(*self._given())


def _source(spark: SparkSession, reader: object, root: str) -> DataFrame:
    spark.dataSource.register(FolderListing)
    wanted = max(64, 4 * spark.sparkContext.defaultParallelism)
    return reader.format(NAME).option("root", os.path.abspath(root) if "://" not in root and not root.startswith("file:") else root).option("prefixes", wanted).load()


def files_below(spark: SparkSession, root: str) -> DataFrame:
    """path, rel_path, place (the name's bytes), size_bytes, modified and problem of every file below root."""
    return _source(spark, spark.read, root)


def new_files(spark: SparkSession, root: str) -> DataFrame:
    """As a stream: each file once, and again when its size or time changes. The state holds a row for each of these."""
    return _source(spark, spark.readStream, root).dropDuplicates(["place", "size_bytes", "modified"])

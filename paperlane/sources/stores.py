"""File systems by URI, as the Python workers see them."""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

# Names under which Hadoop and Arrow know the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}


class Entry(NamedTuple):
    """What a folder holds: a name's bytes, and a problem instead of a size where it cannot be asked for."""

    name: bytes
    is_folder: bool
    size: int | None
    modified_us: int | None
    problem: str | None


def split(uri: str) -> tuple[str, str]:
    """(what stands before the path, the path): ``s3a://`` and ``bucket/x``; a plain path has an empty head."""
    if uri.startswith("file:"):
        return "file://", "/" + uri[5:].lstrip("/")
    scheme, mark, rest = uri.partition("://")
    return (scheme + mark, rest) if mark else ("", uri)


def opened(uri: str) -> tuple[object, str]:
    """Arrow's file system for a URI, and the path in it; None stands for this machine's own files."""
    head, path = split(uri)
    if head in ("", "file://"):
        return None, path
    from pyarrow import fs

    scheme = head[:-3]
    store, inner = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{quote(path, safe='/@:')}")
    return store, inner


def entries(store: object, folder: bytes) -> Iterator[Entry]:
    """All entries of one folder, hidden ones, too. Links to folders are entries without a folder's content, so no loop is walked."""
    if store is None:
        with os.scandir(folder) as found:
            for e in found:
                try:
                    if e.is_dir(follow_symlinks=False):
                        yield Entry(e.name, True, None, None, None)
                        continue
                    if e.is_dir():
                        yield Entry(e.name, False, None, None, "LinkToFolder")
                        continue
                    s = e.stat()
                    yield Entry(e.name, False, s.st_size, s.st_mtime_ns // 1000, None)
                except OSError as x:
                    yield Entry(e.name, False, None, None, type(x).__name__)
        return
    from pyarrow import fs

    for e in store.get_file_info(fs.FileSelector(folder.decode())):
        is_folder = e.type == fs.FileType.Directory
        modified = None if e.mtime_ns is None else e.mtime_ns // 1000
        yield Entry(e.base_name.encode(), is_folder, None if is_folder else e.size, None if is_folder else modified, None)


def copy(source: str, target: str) -> None:
    """One file to another place, perhaps another store, piece by piece; folders are made."""
    from pyarrow import fs

    (a, path_a), (z, path_z) = opened(source), opened(target)
    a, z = a or fs.LocalFileSystem(), z or fs.LocalFileSystem()
    z.create_dir(path_z.rsplit("/", 1)[0], recursive=True)
    with a.open_input_stream(path_a) as i, z.open_output_stream(path_z) as o:
        while part := i.read(1 << 20):
            o.write(part)


class Replacing:
    """A stream to a file that takes the place of an older one once it is whole; after an error nothing is left of it."""

    def __init__(self, target: str, attempt: object = ""):
        from pyarrow import fs

        store, self.path = opened(target)
        self.store, self.part = store or fs.LocalFileSystem(), f"{self.path}.{attempt}.new"

    def __enter__(self) -> object:
        if "/" in self.path.strip("/"):
            self.store.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.out = self.store.open_output_stream(self.part)
        return self.out

    def __exit__(self, kind: object, *_: object) -> None:
        self.out.close()
        if kind is None:
            self.store.move(self.part, self.path)
        else:
            self.store.delete_file(self.part)


def write(target: str, data: bytes) -> None:
    """A small file of its own, whole or not at all."""
    with Replacing(target) as out:
        out.write(data)


def read(store: object, path: bytes, most: int) -> bytes:
    """A file's bytes; ValueError if it has grown beyond ``most``."""
    if store is None:
        with open(path, "rb") as f:
            data = f.read(most + 1)
    else:
        with store.open_input_stream(path.decode()) as f:
            data = f.read(most + 1)
    if len(data) > most:
        raise ValueError("grown beyond the limit of size")
    return data

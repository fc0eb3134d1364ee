"""Folders and small files of shared storage, by the file system Spark itself uses."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import SparkSession


#: Folders moved at a time.
MOVERS = 8


class Entry(NamedTuple):
    """A child of a folder; `modified` in milliseconds, where the storage keeps it."""

    name: str
    is_dir: bool
    modified: int


class Storage:
    """The file system a path lies on."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._utils = spark._jvm.org.apache.commons.io.IOUtils

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def entries(self, path: str) -> list[Entry]:
        """Children by name; none of a folder that isn't there."""
        if not self.exists(path):
            return []
        return sorted(
            Entry(s.getPath().getName(), s.isDirectory(), s.getModificationTime())
            for s in self._fs.listStatus(self._path(path)))

    def folders(self, path: str, key: str) -> Iterator[tuple[str, str]]:
        """Values and names of the partition folders `key=value` in a folder."""
        for entry in self.entries(path):
            name, equals, value = entry.name.partition("=")
            if entry.is_dir and equals and name == key and not value.startswith("__"):
                yield value, entry.name

    def move(self, source: str, target: str) -> None:
        """Rename; the target's parent is made, the target must not be there."""
        self._fs.mkdirs(self._path(target).getParent())
        if self.exists(target) or not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def move_folders(self, source: str, target: str, key: str, name: str) -> None:
        """Move every partition folder `key=value` to `target/key=value/name`, and replace that.

        Several at a time: most of a move is waiting for the storage.
        """
        found = self._fs.listStatus(self._path(source))

        def move(i: int) -> None:
            folder = found[i].getPath()
            value = folder.getName()
            if not value.startswith(f"{key}="):
                return
            place = self._path(f"{target}/{value}/{name}")
            if not self._fs.delete(place, True):
                self._fs.mkdirs(place.getParent())
            if not self._fs.rename(folder, place):
                raise OSError(f"could not rename {folder.toString()} to {place.toString()}")

        with ThreadPoolExecutor(MOVERS) as movers:
            for _ in movers.map(move, range(len(found))):
                pass

    def remove(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._utils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Write a small file that others see whole or not at all; it must not be there."""
        folder, _, name = path.rpartition("/")
        aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(aside), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(aside, path)

"""Versions of a rebuilt table and the pointer to the present one.

A table's folder holds `_data-<id>`, a folder for each version, and `_versions`, with an
empty file `<number>-<id>` for each version that was published. The greatest number is the
present version. Publishing is the creation of that one file, so readers see the old version or
the new one, whole, at whatever step a rebuild ends. A version's name begins with an
underscore: a reader who doesn't resolve it finds nothing rather than several versions.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from lumentide.sources.files import Storage

POINTERS, DATA = "_versions", "_data-"
#: A folder without pointer may belong to a rebuild under way; after a day it doesn't.
ABANDONED_MS = 24 * 3600 * 1000


class NotPublished(RuntimeError):
    """A new version failed its checks and was dropped; the old one stays."""

    def __init__(self, path: str, observed: Mapping[str, object], failed: list[str]):
        super().__init__(f"{path}: " + ", ".join(f"{name} = {observed[name]}" for name in failed))
        self.observed, self.failed = dict(observed), failed


def _pointers(storage: Storage, path: str) -> list[str]:
    return [e.name for e in storage.entries(f"{path}/{POINTERS}") if not e.name.startswith(".")]


def current(spark: SparkSession, path: str) -> str:
    """The folder with the present version's files; a table without versions is its own."""
    path = path.rstrip("/")
    published = _pointers(Storage(spark, path), path)
    return f"{path}/{DATA}{published[-1].partition('-')[2]}" if published else path


def new_version(path: str) -> tuple[str, str]:
    """An id and the folder to write its files to."""
    version = uuid.uuid4().hex
    return version, f"{path.rstrip('/')}/{DATA}{version}"


def publish(spark: SparkSession, path: str, version: str, keep: int = 2) -> None:
    """Make a version the present one and remove all but the last `keep`.

    The version before stays by default, for readers that have begun with it.
    """
    path = path.rstrip("/")
    storage = Storage(spark, path)
    published = _pointers(storage, path)
    number = int(published[-1].partition("-")[0]) + 1 if published else 1
    storage.write(f"{path}/{POINTERS}/{number:012d}-{version}", "")
    vacuum(spark, path, keep)


def vacuum(
    spark: SparkSession, path: str, keep: int = 1, abandoned_ms: int = ABANDONED_MS,
) -> list[str]:
    """Remove old versions, and those never published that are older than a day.

    Also removes files that lie in the folder itself, from before the table had versions.
    The folders go before their pointers, so a stop in between leaves pointers to remove
    next time, never the present version's. Names what went.
    """
    path = path.rstrip("/")
    storage = Storage(spark, path)
    published = _pointers(storage, path)
    if not published:
        return []
    newest = max(storage.entries(path), key=lambda e: e.modified).modified
    kept = {f"{DATA}{name.partition('-')[2]}" for name in published[-max(keep, 1):]}
    known = {f"{DATA}{name.partition('-')[2]}" for name in published}
    gone = []
    for entry in storage.entries(path):
        if entry.name == POINTERS or entry.name in kept or entry.name.startswith("."):
            continue
        pending = entry.name.startswith(DATA) and entry.name not in known
        if pending and newest - entry.modified < abandoned_ms:
            continue
        storage.remove(f"{path}/{entry.name}")
        gone.append(entry.name)
    for name in published[:-max(keep, 1)]:
        storage.remove(f"{path}/{POINTERS}/{name}")
    return gone


class Checked:
    """Checks that are observed while a version is written, without another scan of it.

    `measures` are aggregates by name, `passes` conditions on them by the same names.
    """

    def __init__(self, measures: Mapping[str, Column], passes: Mapping[str, object]):
        self.measures, self.passes = dict(measures), dict(passes)
        self._observation = Observation(f"checks-{uuid.uuid4().hex}")

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(
            self._observation, *[c.alias(name) for name, c in self.measures.items()])

    def observed(self) -> dict[str, object]:
        """The measures, once a version has been written."""
        return dict(self._observation.get)

    def failed(self) -> list[str]:
        """The checks that don't hold; one whose measure is missing or NULL doesn't."""
        found = self.observed()
        return [name for name, passes in self.passes.items()
                if found.get(name) is None or not passes(found[name])]

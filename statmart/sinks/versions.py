"""Versioned folders: readers follow a pointer, and nothing is ever moved.

    <path>/load=<id>/...                rows of one write
    <path>/_versions/<number>.json      a version: which folders make it up

A version names one folder for the whole table, or one for each of its
partitions (slices). A write goes to a folder of its own; it counts once its pointer file
is there, which is created only if no other writer has taken the number. So a
reader sees all of a replacement or nothing of it, whenever it looks, and all
slices of one load change together. Writers that meet take the next number
upon what the other has written.

The newest ``KEEP`` versions keep their files, so readers that have resolved a
pointer can finish. A pointer that cannot be read - its writer is at work on
it, or has died - is passed over.

Paths without pointers are read as they lie.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from statmart.sinks import files

#: Versions whose files stay: the current one and those that readers may still be at.
KEEP = 3
#: Seconds after which the folder of a write that no version names is an orphan.
ORPHAN_AGE = 7 * 24 * 3600
#: Seconds a writer waits for a pointer that another one has begun.
PATIENCE = 10.0

POINTERS = "_versions"
LOAD = "load="
WHOLE = ""


class LostRace(RuntimeError):
    """Other writers took every number that was tried."""


@dataclass(frozen=True)
class Version:
    """Folders by partition; a table without partitions has one, named ``WHOLE``.

    ``covers`` names files beside them that the version stands for (``sinks.logs``).
    """

    number: int = 0
    folders: Mapping[str, str] = field(default_factory=dict)
    covers: tuple[str, ...] = ()


def new_folder(path: str) -> str:
    """Where a write goes; its name makes it a partition that readers drop."""
    return f"{path.rstrip('/')}/{LOAD}v{uuid.uuid4().hex}"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = files.names(spark, f"{path.rstrip('/')}/{POINTERS}")
    return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())


def _pointer(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{POINTERS}/{number:012d}.json"


def _read(spark: SparkSession, path: str, number: int) -> Version | None:
    text = files.read_text(spark, _pointer(path, number))
    try:
        said = json.loads(text or "")
        return Version(number, said["folders"], tuple(said["covers"]))
    except (ValueError, KeyError):
        return None


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version that can be read."""
    for number in reversed(_numbers(spark, path)):
        version = _read(spark, path, number)
        if version is not None:
            return version
    return None


def frame(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The rows of the current version; None if there is nothing at all."""
    path = path.rstrip("/")
    reader = spark.read.schema(schema)
    version = current(spark, path)
    if version is not None:
        # Slices from before the first pointer lie one level higher than others, so they are read apart.
        groups = [[f"{path}/{f}" for f in version.folders.values() if f.startswith(LOAD) == written] for written in (True, False)]
        columns = [f"`{name}`" for name in schema.names]
        parts = [reader.option("basePath", path).parquet(*folders).select(*columns) for folders in groups if folders]
        return reduce(DataFrame.unionByName, parts)
    # Without a pointer, what a first write has begun does not count.
    plain = [name for name in files.names(spark, path) if name[0] not in "._" and not name.startswith(LOAD)]
    return reader.parquet(path) if plain else None


def partitions(spark: SparkSession, path: str, column: str) -> list[str | None]:
    """The values of a partition column in the current version, from the names of its folders alone."""
    version = current(spark, path)
    if version is None:
        return []
    path, found = path.rstrip("/"), set()
    for part, folder in version.folders.items():
        names = [part] if part else files.folders(spark, f"{path}/{folder}")
        found |= {files.partition_value(n) for n in names if n.startswith(f"{column}=")}
    return sorted(found, key=lambda v: (v is not None, v or ""))


def commit(spark: SparkSession, path: str, change: Callable[[Version], Version], attempts: int = 100) -> Version:
    """Make a version from the current one (number 0 before the first); again, upon the newer one, if another writer was faster."""
    for _ in range(attempts):
        numbers = _settled(spark, path)
        changed = change(current(spark, path) or Version())
        version = Version(numbers[-1] + 1 if numbers else 1, dict(changed.folders), tuple(changed.covers))
        text = json.dumps({"folders": version.folders, "covers": version.covers})
        if files.create(spark, _pointer(path, version.number), text):
            _expire(spark, path)
            return version
    raise LostRace(f"{path}: {attempts} versions were taken by other writers")


def kept(spark: SparkSession, path: str) -> list[Version]:
    """The versions that can be read, oldest first."""
    return [v for v in (_read(spark, path, n) for n in _numbers(spark, path)) if v is not None]


def _settled(spark: SparkSession, path: str) -> list[int]:
    """All version numbers, once the newest pointer is complete or has been waited for."""
    deadline = time.monotonic() + PATIENCE
    while True:
        numbers = _numbers(spark, path)
        if not numbers or _read(spark, path, numbers[-1]) is not None or time.monotonic() > deadline:
            return numbers
        time.sleep(0.05)


def _expire(spark: SparkSession, path: str) -> None:
    """Remove versions beyond the newest ``KEEP``, the folders only they name, and what dead writers have left."""
    path = path.rstrip("/")
    found = kept(spark, path)
    named = {folder for version in found[-KEEP:] for folder in version.folders.values()}
    gone = {folder for version in found[:-KEEP] for folder in version.folders.values()} - named
    for folder in gone:
        files.remove(spark, f"{path}/{folder}")
    for version in found[:-KEEP]:
        files.remove(spark, _pointer(path, version.number))
    in_use, emptied = ({folder.split("/")[0] for folder in folders} for folders in (named, gone))
    for name in files.folders(spark, path):
        # A load all of whose slices have gone, or one that never became a version.
        if name.startswith(LOAD) and name not in in_use and (name in emptied or files.age(spark, f"{path}/{name}") > ORPHAN_AGE):
            files.remove(spark, f"{path}/{name}")


def replace_all(spark: SparkSession, path: str, folder: str) -> Version:
    """One folder below the path becomes the whole table."""
    name = folder.removeprefix(path.rstrip("/") + "/")
    return commit(spark, path, lambda _: Version(folders={WHOLE: name}))


def replace_parts(spark: SparkSession, path: str, folder: str) -> Version:
    """The partitions in a folder take the place of those of the same name, all at once."""
    path = path.rstrip("/")
    name = folder.removeprefix(path + "/")
    parts = {part: f"{name}/{part}" for part in files.folders(spark, folder) if "=" in part}

    def replaced(base: Version) -> Version:
        if not base.number:
            # What lay there before the first pointer counts as parts of its own.
            old = {n: n for n in files.folders(spark, path) if "=" in n and not n.startswith(LOAD)}
        elif WHOLE in base.folders:
            old = {n: f"{base.folders[WHOLE]}/{n}" for n in files.folders(spark, f"{path}/{base.folders[WHOLE]}") if "=" in n}
            if not old:
                raise ValueError(f"{path} has been written whole, without partitions that could be replaced")
        else:
            old = base.folders
        return Version(folders={**old, **parts})

    return commit(spark, path, replaced)

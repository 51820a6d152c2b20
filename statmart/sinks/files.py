"""Moves on the file system the session works on."""

from __future__ import annotations

import time
import uuid
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def beside(path: str, purpose: str) -> str:
    """A new hidden sibling of ``path``; on the same file system, so renames are cheap."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{purpose}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder or file in place; the old one comes back if that fails.

    For what is read under a fixed name. Tables are not moved (``sinks.versions``).
    """
    fs, target = _fs(spark, path)
    _, source = _fs(spark, staged)
    fs.mkdirs(target.getParent())
    if not fs.exists(target):
        _rename(fs, source, target)
        return
    _, aside = _fs(spark, beside(path, "old"))
    _rename(fs, target, aside)
    try:
        _rename(fs, source, target)
    except Exception:
        _rename(fs, aside, target)
        raise
    fs.delete(aside, True)


def copy(spark: SparkSession, source: str, path: str) -> None:
    """Put a copy of a small file under a name; it appears there when it is complete."""
    fs, origin = _fs(spark, source)
    staged = beside(path, "staged")
    to_fs, target = _fs(spark, staged)
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, origin, to_fs, target, False, spark._jsc.hadoopConfiguration()):
        raise OSError(f"cannot copy {source} to {staged}")
    swap_in(spark, staged, path)


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


def only_part(spark: SparkSession, folder: str) -> str | None:
    """The one data file in a folder written from one partition; None if that had no rows."""
    fs, target = _fs(spark, folder)
    parts = [s for s in fs.listStatus(target) if s.getPath().getName().startswith("part-")]
    names = [s.getPath().toString() for s in parts if s.getLen()]
    if not names:
        return None
    if len(names) != 1:
        raise OSError(f"expected one part in {folder}, found {len(names)}")
    return names[0]


def _listed(spark: SparkSession, path: str) -> list:
    fs, target = _fs(spark, path)
    return list(fs.listStatus(target)) if fs.exists(target) else []


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; nothing if there is none."""
    return sorted(s.getPath().getName() for s in _listed(spark, path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    return sorted(s.getPath().getName() for s in _listed(spark, path) if s.isDirectory())


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was last written to."""
    fs, target = _fs(spark, path)
    return time.time() - fs.getFileStatus(target).getModificationTime() / 1000


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file if there is none of the name; whether this call has made it."""
    fs, target = _fs(spark, path)
    fs.mkdirs(target.getParent())
    try:
        out = fs.create(target, False)
    except Py4JJavaError as error:
        if fs.exists(target):
            return False
        raise error
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file; None if it is not there."""
    fs, target = _fs(spark, path)
    try:
        source = fs.open(target)
    except Py4JJavaError as error:
        if not fs.exists(target):
            return None
        raise error
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def quoted(text: str) -> str:
    """A text as part of a path."""
    return quote(text, safe="")


def partition_value(name: str) -> str | None:
    """The value in the name of a partition's folder, as ``column=value``."""
    value = unquote(name.partition("=")[2])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)

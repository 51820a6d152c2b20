"""Published JSON: one document per file, one row per line for sections of any size, and sets of both.

A set is all that one run publishes. It lies in a folder of its own with a
manifest, and becomes the published one by a pointer (``sinks.versions``):

    <folder>/.published/load=<id>/<document>, <section>/, manifest.json
    <folder>/.published/_versions/<number>.json
    <folder>/<document>, <section>/         copies under fixed names

Readers of ``published_set`` see the documents of one run, whatever goes on
meanwhile. Readers of the fixed names see every document as a whole, but of
the newer or the older run while copies are made; they are made when the set
is complete, so a run that fails changes none of them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.sinks import files, versions

SETS = ".published"
MANIFEST = "manifest.json"


def publish_document(document: DataFrame, path: str) -> bool:
    """Write a one-row frame as one indented JSON file, nulls kept; nothing if it has no row.

    The document is worked out once. The file appears under its name only when
    it is complete.
    """
    spark = document.sparkSession
    text = F.to_json(F.struct(*document.columns), {"ignoreNullFields": "false", "pretty": "true"})
    staged = files.beside(path, "staged")
    # One row by construction: every section is an aggregate.
    document.select(text.alias("value")).coalesce(1).write.text(staged)
    try:
        part = files.only_part(spark, staged)
        if part is None:
            return False
        files.swap_in(spark, part, path)
        return True
    finally:
        files.remove(spark, staged)


def publish_rows(rows: DataFrame, path: str) -> None:
    """Write a section of any size as JSON lines, in parallel; the old lines stay until the new ones are complete."""
    staged = files.beside(path, "staged")
    try:
        rows.write.option("ignoreNullFields", "false").json(staged)
        files.swap_in(rows.sparkSession, staged, path)
    finally:
        files.remove(rows.sparkSession, staged)


@dataclass(frozen=True)
class PublishedSet:
    """The documents of one run: paths of documents, and of the sections of each; names of documents that had nothing to say."""

    run_id: str
    folder: str
    documents: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    skipped: Sequence[str] = ()

    def path(self, document: str, section: str | None = None) -> str:
        """Where a document, or one of its sections, lies."""
        return f"{self.folder}/{document if section is None else self.documents[document][section]}"


def new_set(folder: str) -> str:
    """Where the documents of a run are written."""
    return versions.new_folder(f"{folder.rstrip('/')}/{SETS}")


def publish_set(spark: SparkSession, folder: str, written: PublishedSet) -> None:
    """Make a complete set the published one, then renew the copies under fixed names."""
    manifest = {"run_id": written.run_id, "documents": written.documents, "skipped": list(written.skipped)}
    if not files.create(spark, f"{written.folder}/{MANIFEST}", json.dumps(manifest, indent=1)):
        raise FileExistsError(f"{written.folder} has been published")
    versions.replace_all(spark, f"{folder.rstrip('/')}/{SETS}", written.folder)
    for document, sections in written.documents.items():
        # Sections first, so that a document never lacks them.
        for name in sections.values():
            lines = spark.read.text(f"{written.folder}/{name}")
            staged = files.beside(f"{folder.rstrip('/')}/{name}", "staged")
            lines.write.text(staged)
            files.swap_in(spark, staged, f"{folder.rstrip('/')}/{name}")
        files.copy(spark, f"{written.folder}/{document}", f"{folder.rstrip('/')}/{document}")


def discard_set(spark: SparkSession, folder: str, at: str) -> None:
    """Remove a set that has not been published."""
    version = versions.current(spark, f"{folder.rstrip('/')}/{SETS}")
    if version is None or not at.endswith("/" + version.folders[versions.WHOLE]):
        files.remove(spark, at)


def published_set(spark: SparkSession, folder: str) -> PublishedSet | None:
    """The set readers should use; None before the first publication."""
    base = f"{folder.rstrip('/')}/{SETS}"
    version = versions.current(spark, base)
    if version is None:
        return None
    at = f"{base}/{version.folders[versions.WHOLE]}"
    said = json.loads(files.read_text(spark, f"{at}/{MANIFEST}"))
    return PublishedSet(said["run_id"], at, said["documents"], tuple(said["skipped"]))

"""Folders whose tables are replaced together: each refresh is a new version, published by one marker.

A version is complete before its marker is made, and making the marker is a single
operation of the file system, so readers see the old tables or the new ones. A
refresh that fails leaves a folder without a marker, which nobody reads.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_MARKERS = "_published"
_DIGITS = 12


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files, files.makeQualified(place)


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def published_versions(spark: SparkSession, folder: str) -> list[str]:
    """Folders of the published versions, the newest last."""
    base = folder.rstrip("/")
    return [f"{base}/{name}" for name in _names(spark, f"{base}/{_MARKERS}")]


def published_version(spark: SparkSession, folder: str) -> str:
    """Folder of the newest published version."""
    found = published_versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return found[-1]


def refuse_own_input(tables: dict[str, DataFrame], folder: str) -> None:
    """Raise if a table is read from the folder, as its files may be cleared away while it is used."""
    for name, table in tables.items():
        _, place = _files(table.sparkSession, folder)
        own = place.toUri().getPath().rstrip("/") + "/"
        for file in table.inputFiles():
            if _files(table.sparkSession, file)[1].toUri().getPath().startswith(own):
                raise ValueError(f"{name} is read from {folder}, which it is to be written to")


def publish_version(spark: SparkSession, folder: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Let ``write(path)`` fill a new version and publish it; returns its folder.

    ``keep`` newest versions stay, for readers that are still at work. If someone
    else publishes meanwhile, the marker can't be made and the refresh fails.
    """
    base = folder.rstrip("/")
    before = [name.rsplit("/", 1)[-1] for name in published_versions(spark, folder)]
    number = int(before[-1].split("-")[0][1:]) + 1 if before else 1
    draft = f"{base}/v{number:0{_DIGITS}d}-{uuid4().hex[:8]}"
    try:
        write(draft)
    except BaseException:
        files, place = _files(spark, draft)
        files.delete(place, True)
        raise
    taken, turn = _files(spark, f"{base}/_numbers/{number:0{_DIGITS}d}")
    taken.create(turn, False).close()  # fails if the number is taken
    name = draft.rsplit("/", 1)[-1]
    files, marker = _files(spark, f"{base}/{_MARKERS}/{name}")
    files.create(marker, False).close()
    for old in before[: max(0, len(before) + 1 - keep)]:
        for path in (f"{base}/{_MARKERS}/{old}", f"{base}/{old}"):
            files, place = _files(spark, path)
            files.delete(place, True)
    return draft

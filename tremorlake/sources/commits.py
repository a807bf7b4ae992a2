"""Folders that are there as a whole or not at all.

A write goes to a side folder next to its target and is counted as it runs. Then a small
manifest is added and the folder is renamed into place; what was there before stays until
that moment. A reader asks for the manifest, so it neither takes an unfinished folder nor
lists files to find out. Names that start with an underscore are hidden from Spark's reads.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest.json"
RECORDS = "records"


@dataclass(frozen=True)
class Manifest:
    """What a finished write has left: rows, and files (markers of the writer included)."""

    rows: int
    files: int
    bytes: int


class Folder:
    """A path in whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def beside(self, word: str) -> Folder:
        """A fresh hidden folder with the same parent."""
        parent, name = posixpath.split(self.path)
        return Folder(self.spark, f"{parent}/_{name}.{word}.{uuid.uuid4().hex[:12]}")

    def below(self, name: str) -> Folder:
        return Folder(self.spark, f"{self.path}/{name}")

    def exists(self) -> bool:
        return self._files.exists(self._path)

    def matches(self) -> list[Folder]:
        """The folders a path with wildcards stands for."""
        found = self._files.globStatus(self._path)
        return [Folder(self.spark, status.getPath().toString()) for status in found or []]

    def modified_ms(self) -> int:
        return self._files.getFileStatus(self._path).getModificationTime()

    def delete(self) -> None:
        self._files.delete(self._path, True)

    def rename(self, to: Folder) -> None:
        self._files.mkdirs(to._path.getParent())
        if not self._files.rename(self._path, to._path):
            raise OSError(f"cannot rename {self.path} to {to.path}")

    def size(self) -> tuple[int, int]:
        """Number of files and bytes, summed up by the file system."""
        summary = self._files.getContentSummary(self._path)
        return summary.getFileCount(), summary.getLength()

    def write_text(self, text: str) -> None:
        stream = self._files.create(self._path, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read_text(self) -> str:
        stream = self._files.open(self._path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def seal(folder: Folder, rows: int) -> Manifest:
    """Add the manifest of a finished write."""
    files, length = folder.size()
    manifest = Manifest(rows, files, length)
    folder.below(MANIFEST).write_text(json.dumps(asdict(manifest)))
    return manifest


def manifest_of(spark: SparkSession, path: str) -> Manifest:
    """The manifest of a folder; FileNotFoundError if the folder is missing or unfinished.

    Files that were lost or added since then are an error as well.
    """
    folder = Folder(spark, path)
    note = folder.below(MANIFEST)
    if not note.exists():
        raise FileNotFoundError(f"no finished write in {path}")
    manifest = Manifest(**json.loads(note.read_text()))
    files, _ = folder.size()
    if files != manifest.files + 1:
        raise FileNotFoundError(f"{path} has {files - 1} files, its manifest {manifest.files}")
    return manifest


def publish(side: Folder, target: Folder) -> None:
    """Put a side folder in the place of the target; on an error the former one is back."""
    former = None
    if target.exists():
        former = target.beside("former")
        target.rename(former)
    try:
        side.rename(target)
    except Exception:
        if former is not None:
            former.rename(target)
        raise
    if former is not None:
        former.delete()


def write_complete(
    df: DataFrame,
    path: str,
    write: Callable[[DataFrame, str], None],
    observation: Observation | None = None,
    keep_empty: bool = True,
) -> int:
    """Write the frame in place of what is at the path and return its number of rows.

    The rows are counted by the write itself, as `records` of the observation. If the write
    fails, or has no row and `keep_empty` is off, the path is left as it was.
    """
    target = Folder(df.sparkSession, path)
    side = target.beside("side")
    counted = observation or Observation()
    try:
        write(df.observe(counted, F.count(F.lit(1)).alias(RECORDS)), side.path)
        rows = counted.get[RECORDS]
        if rows == 0 and not keep_empty:
            side.delete()
            return 0
        seal(side, rows)
    except Exception:
        side.delete()
        raise
    publish(side, target)
    return rows

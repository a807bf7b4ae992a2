"""What the corpus operators share: words, written intermediates, checked joins."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tremorlake.session import scratch_dir

# A word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

# A side of a join is broadcast up to this many cells (rows times columns, and
# values in arrays), about 30 MB as a hash table; a larger one is joined by shuffling.
BROADCAST_CELLS = 250_000

# Texts are handled in groups of about this many bytes inside a task.
GROUP_BYTES = 4 << 20


def saved(df: DataFrame, label: str) -> DataFrame:
    """The frame, written once to the shared scratch folder and read back.

    What follows starts from those files, also after executors are lost.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cells(df: DataFrame) -> int:
    """Number of values in a frame, those in elements of arrays included: a struct of three counts as three."""
    per_row = F.lit(len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, ArrayType):
            element = field.dataType.elementType
            width = len(element.fields) if isinstance(element, StructType) else 1
            # The size of null is -1 or null, by a setting.
            per_row = per_row + width * F.coalesce(F.greatest(F.size(F.col(f"`{field.name}`")), F.lit(0)), F.lit(0))
    return df.agg(F.sum(per_row.cast("long"))).first()[0] or 0


def checked(small: DataFrame, bound: int = BROADCAST_CELLS) -> DataFrame:
    """A written frame, marked for broadcast if it is below the bound."""
    return F.broadcast(small) if cells(small) <= bound else small


def same(left: DataFrame, right: DataFrame, pairs: Iterable[tuple[str, str]]):
    """Null-safe equality of columns of two frames."""
    condition = None
    for a, b in pairs:
        equal = left[a].eqNullSafe(right[b])
        condition = equal if condition is None else condition & equal
    return condition


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column has it."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def text_key(column: str = "text"):
    """A hash of a text; with the doc_id it tells rows apart that share a doc_id."""
    return F.xxhash64(F.col(column), F.lit(17))


def groups_of(texts: Iterable[bytes], limit: int = GROUP_BYTES) -> Iterator[list[bytes]]:
    """Consecutive texts, cut into groups of about `limit` bytes."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text) + 64
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def text_groups(batches: Iterable[pa.RecordBatch], limit: int = GROUP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Arrow batches with a column `text`, in slices of about `limit` bytes of text, and
    the UTF-8 of the texts of a slice; null is empty."""
    for batch in batches:
        first, size, texts = 0, 0, []
        for value in batch.column("text"):
            texts.append(value.as_buffer().to_pybytes() if value.is_valid else b"")
            size += len(texts[-1]) + 64
            if size >= limit:
                yield batch.slice(first, len(texts)), texts
                first, size, texts = first + len(texts), 0, []
        if texts:
            yield batch.slice(first), texts


def encoded(texts: Iterable[str | None]) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if text is None else text.encode() for text in texts]


class Numbers(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


def word_numbers(group: list[bytes]) -> tuple[list[bytes], list[np.ndarray]]:
    """The distinct words of a group of texts, and each text as numbers into them.

    `bytes.split()` cuts at exactly the six ASCII blanks.
    """
    seen = Numbers()
    numbers = [seen.of(text.split()) for text in group]
    return list(seen), numbers


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, if they cannot import it already.

    Workers look where the driver was started and in PYTHONPATH.
    """
    root = Path(__file__).resolve().parents[2]
    reached = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    if any(Path(place).resolve() == root for place in reached) or spark.sparkContext.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="tremorlake-")) / "tremorlake.zip"
    with zipfile.ZipFile(archive, "w") as files:
        for path in sorted((root / "tremorlake").rglob("*.py")):
            files.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(spark.sparkContext.applicationId)


_shipped: set[str] = set()

"""File layers: raw documents, bronze text, silver Parquet."""

from __future__ import annotations

import datetime as dt
import posixpath
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tremorlake.operators.shape import conform_schema
from tremorlake.schemas import BRONZE
from tremorlake.sources import commits

# Names that make up a dated path.
BRONZE_NAME = "raw_data.json"
SILVER_NAME = "transformed_data"
QUARANTINE_NAME = "lost_input"
RUN_DATE_FORMAT = "%Y%m%d"
PARQUET_FILES = "*.parquet"

# What a load makes of its input, and the columns that tell it.
ROW_KIND = "row"
DOCUMENT_KIND = "document"
FEATURE_KIND = "feature"
LOST_KINDS = (DOCUMENT_KIND, FEATURE_KIND)
KIND = StructField("kind", StringType())
LOST = StructField("lost", StringType())


def dated_path(root: str, layer: str, flavour: str, feed: str, run_date: dt.date, name: str) -> str:
    """`<root>/<layer>/<flavour>/<feed>/<yyyymmdd>/<name>`.

    The run date is an argument, never the clock, so a re-run of an old day
    reads and writes that day. The feed name keeps the daily and historical
    loads of one day apart.
    """
    return "/".join(
        [root.rstrip("/"), layer, flavour, feed, run_date.strftime(RUN_DATE_FORMAT), name]
    )


@dataclass(frozen=True)
class Layers:
    """The dated paths of one feed on one run date."""

    root: str
    flavour: str
    feed: str
    run_date: dt.date

    @property
    def bronze(self) -> str:
        return dated_path(self.root, "bronze", self.flavour, self.feed, self.run_date, BRONZE_NAME)

    @property
    def silver(self) -> str:
        return dated_path(self.root, "silver", self.flavour, self.feed, self.run_date, SILVER_NAME)

    @property
    def quarantine(self) -> str:
        return dated_path(self.root, "quarantine", self.flavour, self.feed, self.run_date, QUARANTINE_NAME)

    @property
    def features(self) -> str:
        """Landed features, one a row."""
        return dated_path(self.root, "features", self.flavour, self.feed, self.run_date, "landed")

    @property
    def cuts(self) -> str:
        """Where documents are cut at a bad feature."""
        return dated_path(self.root, "features", self.flavour, self.feed, self.run_date, "cuts")


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """Staged raw documents, one file each, as a frame with one text column `value`."""
    return spark.read.text(path, wholetext=True)


def one_line(document: Column | str) -> Column:
    """The document on one line.

    A valid JSON text holds line breaks only between tokens, so blanks in their
    place leave its value as it was.
    """
    blank = F.lit(" ")
    return F.replace(F.replace(document, F.lit("\r"), blank), F.lit("\n"), blank)


def land_bronze(documents: DataFrame, path: str, observation: Observation | None = None) -> bool:
    """Store raw documents (column `value`), one line each, in place of what is there.

    The documents are read once: they are counted, as `records` of the observation, while
    they are written. Without any document nothing is stored and the result is False.
    """
    lines = documents.select(one_line("value").alias("value"))
    return commits.write_complete(lines, path, lambda df, to: df.write.text(to), observation, keep_empty=False) > 0


def read_bronze_text(spark: SparkSession, path: str, wholetext: bool = False) -> DataFrame:
    """Bronze as text: one row per line, or one per file."""
    return spark.read.text(path, wholetext=wholetext)


def read_bronze_json(spark: SparkSession, path: str, schema: StructType = BRONZE) -> DataFrame:
    """Bronze documents with the declared nested schema, one document per line.

    A line that is no JSON gives a row of nulls, a leaf of the wrong type a
    null leaf. A narrower schema parses only the fields it names.
    """
    return spark.read.schema(schema).json(path)


def write_silver(df: DataFrame, path: str) -> str:
    """Replace the dated Parquet directory and return its path.

    If the write fails, the directory is as it was.
    """
    commits.write_complete(df, path, lambda rows, to: rows.write.parquet(to))
    return path


def write_silver_typed(
    df: DataFrame, path: str, schema: StructType, n_files: int | None = None
) -> str:
    """Replace the dated Parquet directory after forcing the declared schema.

    `n_files=1` writes a single file through a single task; leave it out for
    any load that does not fit one task.
    """
    typed = conform_schema(df, schema)
    if n_files is not None:
        typed = typed.coalesce(n_files)
    return write_silver(typed, path)


def write_tagged(
    tagged: DataFrame, schema: StructType, silver: str, quarantine: str, n_files: int | None = None
) -> dict[str, int]:
    """Write rows to silver and what was lost to the quarantine, in one action; rows by kind.

    The frame has `kind`, the columns of the schema and `lost`. It is written once, a folder
    for each kind, and then the folders are moved into place; if the write fails, both
    places are as they were. `n_files` is as for `write_silver_typed`, for each kind.
    """
    spark = tagged.sparkSession
    rows = conform_schema(tagged, StructType([KIND, *schema.fields, LOST]))
    rows = rows if n_files is None else rows.coalesce(n_files)
    target, lost = commits.Folder(spark, silver), commits.Folder(spark, quarantine)
    side, counted = target.beside("side"), Observation()
    kinds = [ROW_KIND, *LOST_KINDS]
    by_kind = [F.count(F.when(F.col(KIND.name) == kind, 1)).alias(kind) for kind in kinds]
    try:
        rows.observe(counted, *by_kind).write.partitionBy(KIND.name).parquet(side.path)
        counts = {kind: counted.get[kind] for kind in kinds}
        good = target.beside("rows")
        if counts[ROW_KIND]:
            side.below(f"{KIND.name}={ROW_KIND}").rename(good)
        else:  # no row, no folder: an empty one has a file for its schema
            spark.createDataFrame([], schema).coalesce(1).write.parquet(good.path)
        commits.seal(good, counts[ROW_KIND])
        commits.seal(side, sum(counts[kind] for kind in LOST_KINDS))
    except Exception:
        side.delete()
        raise
    commits.publish(side, lost)
    commits.publish(good, target)
    return counts


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """What a load has lost: `kind` (document or feature) and its text `value`."""
    commits.manifest_of(spark, path)
    lost = spark.read.schema(StructType([LOST, KIND])).parquet(path)
    return lost.select(KIND.name, F.col(LOST.name).alias("value"))


def read_silver(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Silver Parquet with the declared schema; the path may hold a glob.

    Each folder must have the manifest of a finished write. A folder without one is what a
    failed write leaves, not an empty table.
    """
    folder = posixpath.dirname(path) if path.endswith(PARQUET_FILES) else path
    for found in commits.Folder(spark, folder).matches() or [commits.Folder(spark, folder)]:
        commits.manifest_of(spark, found.path)
    return spark.read.schema(schema).parquet(path)


def memory_frame(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """A few literal rows of the driver as a frame of one partition."""
    return spark.createDataFrame(list(rows), schema).coalesce(1)


def debug_sample(df: DataFrame, n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """At most `n` rows to look at; the first ones when an order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)

"""Derived data the registered queries start from, written once per session.

The staged documents and the bronze text of a table folder are the same for
every query, so they are written on first use and kept for the session. All
paths are below the shared scratch folder, so they outlive lost executors.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tremorlake import session
from tremorlake.operators import nullable as N
from tremorlake.schemas import NULLABLE
from tremorlake.sources import layers as L
from tremorlake.sources import tables as T
from workload import feed

RUN_DATE = dt.date(2024, 1, 30)
AS_OF = RUN_DATE

# Bytes of staged documents in a row group, compressed. Parquet is read in batches of rows that
# end with their row group; a batch of the usual one would hold thousands of whole documents.
STAGED_GROUP = 8 << 20


def _feed_name(rough: bool, faults: bool) -> str:
    return "" if not rough else "rough_" if faults else "mixed_"


class Store:
    """Derived data of one table folder in one session."""

    def __init__(self, spark: SparkSession, sf_dir: str, done: dict[str, str]):
        self.spark = spark
        self.sf_dir = sf_dir
        self._done = done

    @property
    def events(self) -> DataFrame:
        """The events table; its file footers are read for the schema only once."""
        if "events" not in self._done:
            self._done["events"] = feed.events(self.spark, self.sf_dir).schema.json()
        schema = StructType.fromJson(json.loads(self._done["events"]))
        return feed.events(self.spark, self.sf_dir, schema)

    def fresh(self, label: str) -> str:
        return session.scratch_dir(self.spark, label)

    def namespace(self) -> str:
        """A database of this session below the scratch folder."""
        if "namespace" not in self._done:
            name = f"lake_{uuid.uuid4().hex[:12]}"
            T.ensure_namespace(self.spark, name, self.fresh(name))
            self._done["namespace"] = name
        return self._done["namespace"]

    def fresh_table(self, label: str) -> str:
        return f"{self.namespace()}.{label}_{uuid.uuid4().hex[:12]}"

    def staged(self, rough: bool = False, faults: bool = True) -> DataFrame:
        """Raw documents, as a feed client would have staged them."""
        key = _feed_name(rough, faults) + "staged"
        if key not in self._done:
            path = self.fresh(key)
            feed.documents(self.events, rough, faults).write.option("parquet.block.size", STAGED_GROUP).parquet(path)
            self._done[key] = path
        return self.spark.read.schema("value string").parquet(self._done[key])

    def staged_files(self) -> str:
        """Path of the raw documents as text files, one each."""
        if "staged_files" not in self._done:
            path = self.fresh("staged_files")
            self.staged().write.option("maxRecordsPerFile", 1).text(path)
            self._done["staged_files"] = path
        return self._done["staged_files"]

    def bronze(self, rough: bool = False, faults: bool = True) -> str:
        """Path of the landed documents."""
        key = _feed_name(rough, faults) + "bronze"
        if key not in self._done:
            path = self.fresh(key)
            L.land_bronze(self.staged(rough, faults), path)
            self._done[key] = path
        return self._done[key]

    def lines(self, rough: bool = False, faults: bool = True) -> DataFrame:
        return L.read_bronze_text(self.spark, self.bronze(rough, faults))

    def documents(self) -> DataFrame:
        return L.read_bronze_json(self.spark, self.bronze())

    def silver(self) -> str:
        """Path of the nullable silver rows."""
        if "silver" not in self._done:
            rows = N.transform_columns(N.flatten(self.documents()))
            self._done["silver"] = L.write_silver(rows, self.fresh("silver"))
        return self._done["silver"]

    def gold(self) -> str:
        """Name of the nullable gold table."""
        if "gold" not in self._done:
            table = self.fresh_table("gold")
            T.truncate_and_load(L.read_silver(self.spark, self.silver(), NULLABLE), table, NULLABLE)
            self._done["gold"] = table
        return self._done["gold"]


# What is already written or known, by application and table folder.
_written: dict[tuple[str, str], dict[str, str]] = {}


def store(spark: SparkSession, sf_dir: str) -> Store:
    session.configure(spark)
    folder = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, folder)
    return Store(spark, folder, _written.setdefault(key, {}))

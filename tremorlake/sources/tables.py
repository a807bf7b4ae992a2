"""Gold tables in the Spark catalog."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tremorlake.operators.shape import conform_schema
from tremorlake.session import scratch_dir
from tremorlake.sources.commits import Folder

# The partition column of tables whose loads can be repeated.
LOAD_ID = "load_id"
# How long files that a table no longer shows are kept for readers that have begun.
KEEP = dt.timedelta(days=1)

# Between the folder or name of a table and what tells a version of it.
_VERSION = "__load_"
_FORMER = "__former_"
# In a folder that was replaced; the time of this file is when that was.
_RETIRED = "_retired"
_READ = "__file_read"


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create the database unless it exists."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}{where}")


def ensure_namespace_of(spark: SparkSession, table: str) -> None:
    """Create the database a qualified table name asks for."""
    namespace, _, _name = table.rpartition(".")
    if namespace:
        ensure_namespace(spark, namespace)


def _column_list(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_table(spark: SparkSession, table: str, schema: StructType, repeatable: bool = False) -> None:
    """Create an empty Parquet table with the schema unless the table exists.

    A repeatable one has a partition for each load id as well.
    """
    columns, parted = _column_list(schema), ""
    if repeatable:
        columns, parted = f"{columns}, {LOAD_ID} string", f" PARTITIONED BY ({LOAD_ID})"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{parted}")


def append_by_name(df: DataFrame, table: str, schema: StructType, load_id: str | None = None) -> None:
    """Append to the table, creating it if needed. Columns match by name.

    A column the frame lacks is stored as null; rows already loaded stay, and
    an event that comes again is added again.

    With a `load_id` the rows are a partition of their own, and what was loaded under
    that id before is replaced in the same step: such a load may be run again. The table
    must have been created by such a load.
    """
    spark = df.sparkSession
    ensure_table(spark, table, schema, repeatable=load_id is not None)
    present = [f for f in schema.fields if f.name in df.columns]
    if load_id is None:
        typed = conform_schema(df, StructType(present))
        spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{loaded}}", loaded=typed)
        return
    if LOAD_ID not in _partition_columns(spark, table):
        raise ValueError(f"{table} has no loads that can be repeated: it has no partition {LOAD_ID}")
    typed = conform_schema(df, schema)
    of_table = [name for name in spark.table(table).columns if name != LOAD_ID]
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD_ID} = {_literal(load_id)}) SELECT * FROM {{loaded}}",
        loaded=typed.select(*of_table),
    )


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def truncate_and_load(df: DataFrame, table: str, schema: StructType, keep: dt.timedelta = KEEP) -> None:
    """Replace the table's contents, forced into the declared schema.

    The rows are written to a version folder of their own first. If the columns are those of
    the table, one change in the catalog points it to that folder. Other columns are a table
    of their own over that folder, which then takes the name. If a step fails, the table is
    readable: as it was, or loaded. The former folder stays for `keep`, so a reader that has
    begun can finish; a later load removes it.

    The table is external, so that no rename or drop touches its files. A table made
    elsewhere as a managed one moves its files if its columns change.
    """
    spark = df.sparkSession
    _recover(spark, table)
    typed = conform_schema(df, schema)
    former = _location(spark, table) if spark.catalog.tableExists(table) else None
    base = (former or _default_location(spark, table)).rstrip("/").partition(_VERSION)[0]
    version = f"{base}{_VERSION}{uuid.uuid4().hex[:12]}"
    try:
        typed.write.parquet(version)
        if former is None:
            _run(spark, f"CREATE TABLE {table} ({_column_list(typed.schema)}) USING parquet LOCATION '{version}'")
        elif _column_types(spark.table(table).schema) == _column_types(typed.schema):
            _run(spark, f"ALTER TABLE {table} SET LOCATION '{version}'")
        else:
            _replace(spark, table, typed.schema, version)
    except Exception:
        if not spark.catalog.tableExists(table) or _location(spark, table).rstrip("/") != _qualified(spark, version):
            Folder(spark, version).delete()
        raise
    spark.catalog.refreshTable(table)
    if former is not None:
        Folder(spark, former).below(_RETIRED).write_text("")
    _remove_old(spark, base, _location(spark, table), keep)


def _replace(spark: SparkSession, table: str, schema: StructType, version: str) -> None:
    """Give the table's name to a table over the version folder."""
    mark = uuid.uuid4().hex[:12]
    loaded, former = f"{table}{_VERSION}{mark}", f"{table}{_FORMER}{mark}"
    _run(spark, f"CREATE TABLE {loaded} ({_column_list(schema)}) USING parquet LOCATION '{version}'")
    try:
        _run(spark, f"ALTER TABLE {table} RENAME TO {former}")
        _run(spark, f"ALTER TABLE {loaded} RENAME TO {table}")
    except Exception:
        _recover(spark, table)
        spark.sql(f"DROP TABLE IF EXISTS {loaded}")
        raise
    _run(spark, f"DROP TABLE {former}")


def _recover(spark: SparkSession, table: str) -> None:
    """Bring back a table whose load ended after its name was taken and before it was given."""
    if spark.catalog.tableExists(table):
        return
    namespace, _, name = table.rpartition(".")
    where = f" IN {namespace}" if namespace and spark.catalog.databaseExists(namespace) else ""
    if namespace and not where:
        return
    found = spark.sql(f"SHOW TABLES{where}").where(F.col("tableName").startswith(f"{name.lower()}{_FORMER}")).collect()
    if found:
        left = f"{namespace}.{found[0].tableName}" if namespace else found[0].tableName
        spark.sql(f"ALTER TABLE {left} RENAME TO {table}")


def _run(spark: SparkSession, statement: str) -> None:
    """One step of a load in the catalog."""
    spark.sql(statement)


def _column_types(schema: StructType) -> list[tuple]:
    return [(field.name, field.dataType) for field in schema.fields]


def _location(spark: SparkSession, table: str) -> str:
    """The folder the catalog has for the table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def _default_location(spark: SparkSession, table: str) -> str:
    """Where a table without a folder of its own is: below its database."""
    namespace, _, name = table.rpartition(".")
    database = spark.catalog.getDatabase(namespace or spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{name.lower()}"


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as a listing of its file system names it."""
    found = Folder(spark, path).matches()
    return found[0].path if found else path


def _remove_old(spark: SparkSession, base: str, current: str, keep: dt.timedelta) -> None:
    """Delete folders that were replaced, or left by a load that died, longer ago than `keep`.

    The folder a table began with has no version; it goes only if it was replaced.
    """
    limit = (dt.datetime.now(dt.timezone.utc) - keep).timestamp() * 1000
    in_use = _qualified(spark, current)
    first = [folder for folder in Folder(spark, base).matches() if folder.below(_RETIRED).exists()]
    for folder in [*first, *Folder(spark, f"{base}{_VERSION}*").matches()]:
        retired = folder.below(_RETIRED)
        if folder.path != in_use and (retired if retired.exists() else folder).modified_ms() <= limit:
            folder.delete()


def scan_table(spark: SparkSession, table: str) -> DataFrame:
    _recover(spark, table)
    return spark.table(table)


def compact(spark: SparkSession, table: str, month_of: str, keep: dt.timedelta = KEEP) -> int:
    """Rewrite a table of many small files as one file a month of the column; files after it.

    The rows go to a version folder, and one change in the catalog points the table to it.
    What was appended in the meantime is in files the rewrite has not read; those rows are
    added afterwards, so a reader may miss them for that moment but none is lost. A month has
    to fit one task, as months of audit rows do.
    """
    schema = spark.table(table).schema
    former = _location(spark, table)
    base = former.rstrip("/").partition(_VERSION)[0]
    version = f"{base}{_VERSION}{uuid.uuid4().hex[:12]}"
    month = F.date_trunc("month", F.col(month_of))
    file = F.col("_metadata.file_path")
    read = Folder(spark, scratch_dir(spark, "compacted"))
    try:
        rows = spark.read.schema(schema).parquet(former)  # files are listed here, once
        rows.select(file.alias("file")).distinct().write.parquet(read.path)
        months = sorted(row.month for row in rows.select(month.alias("month")).distinct().collect() if row.month)
        # The place of a row's month in their list; a row without one goes with the first.
        place = F.coalesce(F.array_position(F.array(*map(F.lit, months)), month) - 1, F.lit(0)) if months else F.lit(0)
        one_each = rows.repartitionById(max(len(months), 1), place.cast("int"))
        one_each.sortWithinPartitions(month_of).write.parquet(version)
        _run(spark, f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table)
        known = F.broadcast(spark.read.schema("file string").parquet(read.path))
        now = spark.read.schema(schema).parquet(former).select("*", file.alias(_READ))
        late = now.join(known, now[_READ] == known["file"], "left_anti").drop(_READ)
        if not late.isEmpty():
            append_by_name(late, table, schema)
    finally:
        read.delete()
    Folder(spark, former).below(_RETIRED).write_text("")
    _remove_old(spark, base, version, keep)
    return len(Folder(spark, f"{version}/part-*").matches())

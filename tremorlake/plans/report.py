"""The analytical report over a gold table.

Eight of the nine questions need no more than count, sum and maximum of the
magnitude per day and area. So the table is scanned once for that summary, the
summary is written to the shared scratch folder, and the questions run over
it. Only the list of strong events scans the table again, for two columns and
with its filter pushed down.

Counts, sums and maxima of parts merge into those of the whole. So a table that
grows by loads needs no second scan: each load leaves its states, by day, and
the summary is what they merge to.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tremorlake.operators import analytics as A
from tremorlake.sources import commits

DAY, LOAD = "date", "load"
STATES = (
    StructType()
    .add("area", "string")
    .add("events", "long")
    .add("measured", "long")
    .add("mag_sum", "double")
    .add("mag_max", "float")
    .add(DAY, "date")
    .add(LOAD, "string")
)


def day_area_summary(gold: DataFrame, date_col: str = "updated") -> DataFrame:
    dated = A.with_event_date(gold, date_col)
    return dated.groupBy("date", "area").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("mag").alias("measured"),
        F.sum(F.col("mag").cast("double")).alias("mag_sum"),
        F.max("mag").alias("mag_max"),
    )


def stored_summary(gold: DataFrame, path: str, date_col: str = "updated") -> DataFrame:
    """The summary, written and read back, so that later plans start from it."""
    summary = day_area_summary(gold, date_col)
    summary.write.mode("overwrite").parquet(path)
    return gold.sparkSession.read.schema(summary.schema).parquet(path)


def store_load_states(rows: DataFrame, path: str, load_id: str, date_col: str = "updated") -> None:
    """The states of one load, by day and area, below the path.

    Only the rows of the load are scanned, and only its days are written. A load that is
    run again under its id replaces its states, so they count once.
    """
    states = day_area_summary(rows, date_col)
    folder = f"{path.rstrip('/')}/{LOAD}={load_id}"
    commits.write_complete(states, folder, lambda df, to: df.write.partitionBy(DAY).parquet(to))


def merged_summary(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """The day and area summary of all loads below the path; of the days from `since` on, if given.

    Folders of other days are not read. One exchange, with a partial step.
    """
    loads = commits.Folder(spark, f"{path.rstrip('/')}/{LOAD}=*").matches()
    for load in loads:
        commits.manifest_of(spark, load.path)
    states = spark.read.schema(STATES).option("basePath", path).parquet(*(load.path for load in loads))
    states = states if since is None else states.filter(F.col(DAY) >= F.lit(since))
    merged = states.groupBy(DAY, "area").agg(
        F.sum("events").alias("events"),
        F.sum("measured").alias("measured"),
        F.sum("mag_sum").alias("mag_sum"),
        F.max("mag_max").alias("mag_max"),
    )
    return merged


def report(
    gold: DataFrame, summary: DataFrame, as_of: dt.date | None = None
) -> dict[str, DataFrame]:
    """All nine answers by name; `summary` is the day and area summary of `gold`."""
    by_area = summary.groupBy("area").agg(
        F.sum("events").alias("earthquake_count_by_region"),
        (F.sum("mag_sum") / F.nullif(F.sum("measured"), F.lit(0))).alias("avg_mag"),
        F.max("mag_max").alias("highest_intensity"),
    )
    by_day = summary.groupBy("date").agg(F.sum("events").alias("num_of_eq"))
    by_day_area = summary.select("date", "area", F.col("events").alias("num_of_eq"))
    recent = summary.filter(F.col("date") >= A.days_before(as_of, A.WEEK_DAYS))
    strongest = recent.groupBy("area").agg(
        F.max("mag_max").alias("highest_magnitude_last_week")
    )
    busiest = by_area.select(
        "area",
        F.col("earthquake_count_by_region").alias("highest_frequency"),
        "highest_intensity",
    )
    return {
        "count_by_area": by_area.select("area", "earthquake_count_by_region"),
        "avg_mag_by_area": by_area.select("area", "avg_mag"),
        "count_by_day": by_day,
        "count_by_day_area": by_day_area,
        "avg_daily_count": by_day.agg(
            F.avg("num_of_eq").alias("average_earthquakes_same_day")
        ),
        "avg_count_day_area": A.window_avg(
            by_day_area.withColumnRenamed("num_of_eq", "earthquake_count"),
            "earthquake_count",
            ["date", "area"],
            "average_earthquakes_same_day_same_region",
        ),
        "top_area_last_week": A.top_rows(strongest, ["highest_magnitude_last_week"], 1, "area"),
        "areas_above_5": A.magnitude_above(gold),
        "top5_frequency_intensity": A.top_rows(
            busiest, ["highest_frequency", "highest_intensity"], A.BUSIEST_AREAS, "area"
        ),
    }

"""Questions over the nullable gold table.

Each is one hash aggregate with a partial step before its exchange, so a hot
area or day arrives at the reducer as one partial row per task. Top-k runs as
TakeOrderedAndProject and collects no more than k rows per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.functions.scalars import days_before

# Thresholds of the questions, and the names of their result columns below.
STRONG_MAGNITUDE = 5
WEEK_DAYS = 7
BUSIEST_AREAS = 5


def with_event_date(df: DataFrame, date_col: str = "updated") -> DataFrame:
    """Add the calendar day of a timestamp column, by default the last update."""
    return df.withColumn("date", F.to_date(date_col))


def count_by_area(df: DataFrame) -> DataFrame:
    return df.groupBy("area").agg(F.count(F.lit(1)).alias("earthquake_count_by_region"))


def avg_mag_by_area(df: DataFrame) -> DataFrame:
    return df.groupBy("area").agg(F.avg("mag").alias("avg_mag"))


def count_by_day(df: DataFrame, date_col: str = "updated") -> DataFrame:
    return with_event_date(df, date_col).groupBy("date").agg(F.count(F.lit(1)).alias("num_of_eq"))


def count_by_day_area(
    df: DataFrame, date_col: str = "updated", count_name: str = "num_of_eq"
) -> DataFrame:
    dated = with_event_date(df, date_col)
    return dated.groupBy("date", "area").agg(F.count(F.lit(1)).alias(count_name))


def avg_daily_count(df: DataFrame, date_col: str = "updated") -> DataFrame:
    """Mean of the daily counts, over days that have events."""
    return count_by_day(df, date_col).agg(F.avg("num_of_eq").alias("average_earthquakes_same_day"))


def window_avg(counts: DataFrame, value: str, keys: list[str], name: str) -> DataFrame:
    """Add the mean of `value` over all rows with the same keys.

    Meant for a frame already grouped by these keys: it then reuses that
    exchange, and a window partition is a single row however hot the key was.
    """
    return counts.withColumn(name, F.avg(value).over(Window.partitionBy(*keys)))


def avg_count_by_day_area(df: DataFrame, date_col: str = "updated") -> DataFrame:
    counts = count_by_day_area(df, date_col, count_name="earthquake_count")
    return window_avg(
        counts, "earthquake_count", ["date", "area"], "average_earthquakes_same_day_same_region"
    )


def last_week(
    df: DataFrame, as_of: dt.date | None = None, date_col: str = "updated"
) -> DataFrame:
    """Events dated seven days before `as_of` or later; there is no upper bound."""
    return with_event_date(df, date_col).filter(F.col("date") >= days_before(as_of, WEEK_DAYS))


def top_rows(df: DataFrame, descending: list[str], n: int, tiebreak: str) -> DataFrame:
    """The `n` largest rows by the given columns; ties go by the tiebreak column."""
    order = [F.col(name).desc() for name in descending]
    return df.orderBy(*order, F.col(tiebreak).asc()).limit(n)


def max_mag_by_area(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("area").agg(F.max("mag").alias(name))


def top_area_last_week(
    df: DataFrame, as_of: dt.date | None = None, date_col: str = "updated"
) -> DataFrame:
    strongest = max_mag_by_area(last_week(df, as_of, date_col), "highest_magnitude_last_week")
    return top_rows(strongest, ["highest_magnitude_last_week"], 1, "area")


def magnitude_above(df: DataFrame, threshold: float = STRONG_MAGNITUDE) -> DataFrame:
    """Area and magnitude of the stronger events; reads and filters two columns only.

    The threshold takes the column's own type, so the comparison reaches the
    Parquet scan without a cast in its way.
    """
    bound = F.lit(threshold).cast(df.schema["mag"].dataType)
    return df.select("area", "mag").filter(F.col("mag") > bound)


def top_frequency_intensity(df: DataFrame, n: int = BUSIEST_AREAS) -> DataFrame:
    """The busiest areas, the stronger first among equals."""
    totals = df.groupBy("area").agg(
        F.count(F.lit(1)).alias("highest_frequency"),
        F.max("mag").alias("highest_intensity"),
    )
    return top_rows(totals, ["highest_frequency", "highest_intensity"], n, "area")

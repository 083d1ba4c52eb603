"""Exchange calendar as a table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CUTOFF_HOUR = 18
CUTOFF_ZONE = "America/New_York"


def open_days(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Weekdays among `trade_date`, without the dates of the holiday table (`holiday`)."""
    week = days.filter(~F.dayofweek("trade_date").isin(1, 7))
    if holidays is None:
        return week
    return week.join(holidays, F.col("trade_date") == F.col("holiday"), "left_anti")


def trading_days(
    spark: SparkSession, start: dt.date, end: dt.date, holidays: DataFrame | None = None
) -> DataFrame:
    days = F.sequence(F.lit(start), F.lit(end))
    every = spark.range(1).select(F.explode(days).alias("trade_date"))
    return open_days(every, holidays)


def cutoff_ts(day: Column) -> Column:
    """Signal cutoff of a day as an instant: 18:00 New York time."""
    return F.make_timestamp(
        F.year(day), F.month(day), F.day(day), F.lit(CUTOFF_HOUR), F.lit(0), F.lit(0),
        F.lit(CUTOFF_ZONE),
    )


def cutoff_utc(day: Column) -> Column:
    """The same cutoff as UTC wall-clock time without a zone."""
    local = F.make_timestamp_ntz(
        F.year(day), F.month(day), F.day(day), F.lit(CUTOFF_HOUR), F.lit(0), F.lit(0)
    )
    return F.convert_timezone(F.lit(CUTOFF_ZONE), F.lit("UTC"), local)


def neighbours(days: DataFrame) -> DataFrame:
    """Previous and next trading day of every trading day."""
    ordered = Window.orderBy("trade_date")
    return days.select(
        "trade_date",
        F.lag("trade_date").over(ordered).alias("previous_date"),
        F.lead("trade_date").over(ordered).alias("next_date"),
    )


def schedule(
    spark: SparkSession, start: dt.date, end: dt.date, holidays: DataFrame | None = None
) -> DataFrame:
    """(trade_date, cutoff_ts, prediction_date); looks past `end` for the last next day."""
    days = neighbours(trading_days(spark, start, end + dt.timedelta(days=14), holidays))
    return days.filter(F.col("trade_date") <= F.lit(end)).select(
        "trade_date",
        cutoff_ts(F.col("trade_date")).alias("cutoff_ts"),
        F.col("next_date").alias("prediction_date"),
    )

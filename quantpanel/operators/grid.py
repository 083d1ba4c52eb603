"""Trading calendar of a panel and its dense date x ticker form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from quantpanel.config import CASH
from quantpanel.functions.columns import by_ticker
from quantpanel.functions.storage import split_rows


DAY_KEYS = ("date", "asof_date", "day_idx")
DAY_TABLE_COLUMNS = 64


def day_table(table: DataFrame, keys: list[str] | str = "date") -> DataFrame:
    """Mark a table with one row (or a few) per calendar day for broadcast.

    The key proves the bound: a century has 36,525 days, and a table of more than
    `DAY_TABLE_COLUMNS` columns (or with arrays) is left to the planner, so that no more than about
    20 MB are sent. Joining such a table by shuffle would move the large side by date, and one date
    may hold a large part of it. Tables with any other key are left to the planner as well.
    """
    wide = any(f.dataType.typeName() in ("array", "map", "struct") for f in table.schema.fields)
    if wide or len(table.columns) > DAY_TABLE_COLUMNS:
        return table
    keys = [keys] if isinstance(keys, str) else list(keys)
    if len(keys) != 1 or keys[0] not in DAY_KEYS:
        return table
    kind = table.schema[keys[0]].dataType
    if keys[0] != "day_idx" and not isinstance(kind, DateType):
        return table
    return F.broadcast(table)


def calendar_of(panel: DataFrame, date_col: str = "date") -> DataFrame:
    """(date, day_idx, n_days, next_date): one row per distinct date.

    The window has no key, but it runs on the distinct dates only (about 250 a year).
    """
    ordered = Window.orderBy("date")
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        panel.select(F.col(date_col).alias("date"))
        .distinct()
        .select(
            "date",
            (F.row_number().over(ordered) - 1).alias("day_idx"),
            F.count("*").over(everything).cast("int").alias("n_days"),
            F.lead("date").over(ordered).alias("next_date"),
        )
    )


def dense_grid(panel: DataFrame, values: list[str], calendar: DataFrame) -> DataFrame:
    """One row per (ticker, calendar day).

    Each value appears twice: `<v>` is the observation (null on gap days), `<v>_filled` is
    carried forward, and carried backward before the first one. The panel is shuffled once
    by ticker: a row is repeated until the day before the next row, and the first row also
    covers the days before it, so no calendar join or second shuffle is needed. Tickers are dealt over
    as many partitions as the rows of the grid need, because windows over it sort each partition.
    """
    window = by_ticker(order="day_idx")
    size = panel.agg(F.approx_count_distinct("ticker").alias("tickers"), F.count_distinct("date").alias("days")).first()
    spans = (
        split_rows(panel.select("date", "ticker", *values), size["tickers"] * size["days"], "ticker")
        .join(day_table(calendar.select("date", "day_idx", "n_days")), "date")
        .withColumn("_next", F.coalesce(F.lead("day_idx").over(window), F.col("n_days")))
        .withColumn("_first", F.row_number().over(window) == 1)
    )
    days = F.sequence(
        F.when(F.col("_first"), F.lit(0)).otherwise(F.col("day_idx")), F.col("_next") - 1
    )
    rows = spans.select(
        "ticker", F.col("day_idx").alias("_obs"), *values, F.explode(days).alias("day_idx")
    )
    observed = F.col("day_idx") == F.col("_obs")
    columns = [F.when(observed, F.col(v)).alias(v) for v in values]
    filled = [F.col(v).alias(f"{v}_filled") for v in values]
    return rows.select("ticker", "day_idx", observed.alias("is_obs"), *columns, *filled)


def with_dates(grid: DataFrame, calendar: DataFrame) -> DataFrame:
    return grid.join(day_table(calendar.select("day_idx", "date"), "day_idx"), "day_idx")


def cash_rows(calendar: DataFrame, cash: str = CASH) -> DataFrame:
    return calendar.select("date", "day_idx", F.lit(cash).alias("ticker"))

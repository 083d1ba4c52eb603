"""Date-level market tables: volatility index, yields, factors, macro series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.functions.columns import ratio

METADATA_COLUMNS = ("source_ts", "ingested_at", "source_name", "source_version")
VIX_SERIES = "VIXCLS"
MAX_PIVOT_VALUES = 2_000


def distinct_values(df: DataFrame, column: str) -> list[str]:
    """Pivot values of a column that names output columns, at most `MAX_PIVOT_VALUES`."""
    found = df.select(column).distinct().limit(MAX_PIVOT_VALUES + 1).collect()
    if len(found) > MAX_PIVOT_VALUES:
        raise ValueError(f"{column} has more than {MAX_PIVOT_VALUES} values; name the ones wanted")
    return sorted((row[0] for row in found), key=lambda v: (v is not None, v))


def vix_features(series: DataFrame) -> DataFrame:
    if "series_id" in series.columns:
        series = series.filter(F.col("series_id") == VIX_SERIES)
    # One value a day: an unkeyed window over a single series.
    ordered = Window.orderBy("asof_date")
    rows = series.select(F.col("date").alias("asof_date"), F.col("value").alias("vix"))
    out = {}
    for k in (5, 20):
        out[f"vix_chg_{k}"] = F.col("vix") - F.lag("vix", k).over(ordered)
        out[f"vix_pct_chg_{k}"] = ratio(F.col("vix"), F.lag("vix", k).over(ordered)) - 1
    return rows.withColumns(out)


def pivot_long(df: DataFrame, index: str, column: str, value: str, names: list[str]) -> DataFrame:
    return df.groupBy(index).pivot(column, names).agg(F.first(value, ignorenulls=True))


def treasury_features(yields: DataFrame, maturities: list[str] | None = None) -> DataFrame:
    maturities = maturities or distinct_values(yields, "maturity")
    wide = pivot_long(yields, "date", "maturity", "yield_pct", maturities)
    wide = wide.select(
        F.col("date").alias("asof_date"), *[F.col(m).alias(f"tsy_{m}") for m in maturities]
    )
    slopes = {}
    for short in ("2y", "3m"):
        if {"10y", short} <= set(maturities):
            slopes[f"tsy_slope_10y_{short}"] = F.col("tsy_10y") - F.col(f"tsy_{short}")
    return wide.withColumns(slopes) if slopes else wide


def factor_features(factors: DataFrame) -> DataFrame:
    kept = factors.drop(*METADATA_COLUMNS)

    def rename(name: str) -> str:
        if name in ("date", "asof_date"):
            return "asof_date"
        clean = name.lower().replace("-", "_").replace(" ", "_")
        return clean if clean.startswith("ff_") else f"ff_{clean}"

    return kept.toDF(*[rename(c) for c in kept.columns])


def forward_fill_series(macro: DataFrame) -> DataFrame:
    """Last known value of every series on every date that any series reports.

    A series has one row per date, so the window of a series is as short as the calendar.
    """
    dates = macro.select("date").distinct()
    window = Window.partitionBy("series_id").orderBy("date")
    last_day = dates.agg(F.max("date").alias("_last")).scalar()
    spans = (
        macro.filter(F.col("value").isNotNull())
        .select("series_id", "date", "value")
        .withColumn("_until", F.lead("date").over(window))
        .withColumn("_until", F.coalesce(F.date_sub("_until", 1), last_day))
    )
    # Each value is valid until the day before the next one; keep the days that exist.
    days = spans.select(
        "series_id", "value", F.explode(F.sequence("date", "_until")).alias("date")
    )
    return days.join(dates, "date", "left_semi")


def macro_features(macro: DataFrame, series: list[str] | None = None) -> DataFrame:
    series = series or distinct_values(macro, "series_id")
    wide = pivot_long(forward_fill_series(macro), "date", "series_id", "value", series)
    # Dates before the first value of every series still belong to the table.
    rows = macro.select("date").distinct().join(wide, "date", "left")
    return rows.select(
        F.col("date").alias("asof_date"),
        *[F.col(f"`{s}`").alias(f"macro_{s.lower()}") for s in series],
    )


def outer_join_blocks(blocks: list[DataFrame], key: str = "asof_date") -> DataFrame | None:
    if not blocks:
        return None
    return reduce(lambda left, right: left.join(right, key, "full"), blocks)


def market_features(
    treasury: DataFrame | None = None,
    factors: DataFrame | None = None,
    macro: DataFrame | None = None,
    vix: DataFrame | None = None,
) -> DataFrame | None:
    """Full outer join of the blocks that are present."""
    blocks = []
    if vix is not None:
        blocks.append(vix_features(vix))
    if treasury is not None:
        blocks.append(treasury_features(treasury))
    if factors is not None:
        blocks.append(factor_features(factors))
    if macro is not None:
        blocks.append(macro_features(macro))
    return outer_join_blocks(blocks)

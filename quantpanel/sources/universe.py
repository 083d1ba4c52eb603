"""Universe tables: order, membership, weight caps, history filter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantpanel.config import UniverseConfig
from quantpanel.operators.ranks import rank_in_group


def universe_order(panel: DataFrame, cfg: UniverseConfig = UniverseConfig()) -> DataFrame:
    """(ticker, is_cash, asset_idx): tickers by name, cash last, counted from 0."""
    tickers = panel.select("ticker").distinct().select(
        "ticker", (F.col("ticker") == cfg.cash_ticker).alias("is_cash")
    )
    if cfg.include_cash:
        cash = tickers.sparkSession.createDataFrame([(cfg.cash_ticker, True)], tickers.schema)
        tickers = tickers.unionByName(cash).distinct()
    ranked = rank_in_group(
        tickers.withColumn("_all", F.lit(1)), ["_all"], ["is_cash", "ticker"], "asset_idx"
    )
    return ranked.select("ticker", "is_cash", F.col("asset_idx").cast("int").alias("asset_idx"))


def universe_members(
    panel: DataFrame,
    cfg: UniverseConfig = UniverseConfig(),
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Order table with validity interval and single-name cap (cash is uncapped)."""
    caps = F.when(F.col("is_cash"), 1.0).otherwise(F.lit(cfg.max_single_name_weight))
    return universe_order(panel, cfg).select(
        "*",
        F.lit(start).cast(T.DateType()).alias("start_date"),
        F.lit(end).cast(T.DateType()).alias("end_date"),
        caps.alias("weight_cap"),
    )


def active_members(members: DataFrame, day: dt.date, include_cash: bool = True) -> DataFrame:
    """Members valid on a day; an open start or end does not limit."""
    starts = F.col("start_date").isNull() | (F.col("start_date") <= F.lit(day))
    ends = F.col("end_date").isNull() | (F.col("end_date") >= F.lit(day))
    rows = members.filter(starts & ends)
    return rows if include_cash else rows.filter(~F.col("is_cash"))


def with_min_history(prices: DataFrame, min_rows: int) -> DataFrame:
    """Rows of tickers that have at least `min_rows` rows."""
    enough = prices.groupBy("ticker").count().filter(F.col("count") >= min_rows)
    return prices.join(enough.select("ticker"), "ticker", "left_semi")


def ticker_presence(requested: DataFrame, prices: DataFrame) -> DataFrame:
    """Each requested ticker with whether the price table knows it."""
    known = prices.select("ticker").distinct()
    present = requested.join(known, "ticker", "left_semi").withColumn("present", F.lit(True))
    missing = requested.join(known, "ticker", "left_anti").withColumn("present", F.lit(False))
    return present.unionByName(missing)

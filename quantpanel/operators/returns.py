"""Daily return tables on the dense grid, liquidity and volatility inputs of label runs.

Three return definitions exist and differ on sparse panels: row to row
(`asset_features.returns_rowlag`), grid with gaps as 0 (`returns_gap_zero`) and grid of
filled prices (`returns_filled`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.config import CASH, CASH_ADV
from quantpanel.functions.columns import annualise, by_ticker, finite_or_zero, ratio, trailing
from quantpanel.operators.grid import calendar_of, cash_rows, dense_grid, with_dates


def _with_cash(rows: DataFrame, calendar: DataFrame, column: str, value: float, cash: bool):
    if not cash:
        return rows
    extra = cash_rows(calendar).withColumn(column, F.lit(float(value)))
    return rows.unionByName(extra.select(*rows.columns))


def _grid_return(price: str):
    previous = F.lag(price).over(by_ticker(order="day_idx"))
    return finite_or_zero(ratio(F.col(price), previous) - 1)


def returns_gap_zero(prices: DataFrame, cash: bool = True) -> DataFrame:
    """(date, day_idx, ticker, ret): 0 unless both this and the previous calendar day trade."""
    calendar = calendar_of(prices)
    grid = dense_grid(prices.filter(F.col("adj_close").isNotNull()), ["adj_close"], calendar)
    rows = grid.select("day_idx", "ticker", _grid_return("adj_close").alias("ret"))
    rows = with_dates(rows, calendar).select("date", "day_idx", "ticker", "ret")
    return _with_cash(rows, calendar, "ret", 0.0, cash)


def returns_filled(prices: DataFrame, cash: bool = True) -> DataFrame:
    """(date, day_idx, ticker, ret) of prices carried forward, then backward."""
    calendar = calendar_of(prices)
    grid = dense_grid(prices.filter(F.col("adj_close").isNotNull()), ["adj_close"], calendar)
    rows = grid.select("day_idx", "ticker", _grid_return("adj_close_filled").alias("ret"))
    rows = with_dates(rows, calendar).select("date", "day_idx", "ticker", "ret")
    return _with_cash(rows, calendar, "ret", 0.0, cash)


def adv20(prices: DataFrame, cash: bool = True, width: int = 20) -> DataFrame:
    """(date, day_idx, ticker, adv): mean dollar volume of up to `width` calendar days."""
    calendar = calendar_of(prices)
    grid = dense_grid(prices, ["dollar_volume"], calendar)
    frame = trailing(by_ticker(order="day_idx"), width)
    mean = F.avg(F.coalesce("dollar_volume", F.lit(0.0))).over(frame)
    rows = grid.select("day_idx", "ticker", mean.alias("adv"))
    rows = with_dates(rows, calendar).select("date", "day_idx", "ticker", "adv")
    return _with_cash(rows, calendar, "adv", CASH_ADV, cash)


def vol20_pop(returns: DataFrame, width: int = 20, backfill: bool = False) -> DataFrame:
    """Trailing population volatility; the first `width` days are null.

    `backfill` copies the first value into them, which looks ahead and is off by default.
    """
    window = by_ticker(order="day_idx")
    value = F.when(
        F.col("day_idx") >= width,
        annualise(F.stddev_pop("ret").over(trailing(window, width))),
    )
    rows = returns.withColumn("vol", value).drop("ret")
    if backfill:
        ahead = window.rowsBetween(0, Window.unboundedFollowing)
        rows = rows.withColumn("vol", F.first("vol", ignorenulls=True).over(ahead))
    return rows


def align_returns(returns: DataFrame, dates: DataFrame, universe: DataFrame) -> DataFrame:
    """Returns of every universe ticker on the requested dates; 0 where unknown.

    `dates` has columns (date, n_assets) or (date); the scaffold is built from the universe
    by repeating each ticker for the requested dates, a list no longer than a calendar.
    """
    wanted = dates.select("date").distinct().agg(F.sort_array(F.collect_list("date"))).scalar()
    scaffold = universe.select("ticker", F.explode(wanted).alias("date"))
    rows = scaffold.join(returns.select("date", "ticker", "ret"), ["date", "ticker"], "left")
    return rows.withColumn("ret", F.coalesce("ret", F.lit(0.0)))


def feature_on_grid(
    features: DataFrame, scaffold: DataFrame, column: str, default: float = 0.0
) -> DataFrame:
    """Value of a feature for every (date, ticker) of the scaffold, with a default."""
    source = features.select(F.col("asof_date").alias("date"), "ticker", column)
    value = F.when(F.abs(column) < float("inf"), F.col(column))
    rows = scaffold.select("date", "ticker").join(source, ["date", "ticker"], "left")
    return rows.withColumn(column, F.coalesce(value, F.lit(float(default))))


def rolling_covariance(returns: DataFrame, pairs: DataFrame, width: int = 60) -> DataFrame:
    """Trailing sample covariance (from day 1 on, at least two rows) of the listed pairs.

    The full matrix has N^2 entries a day, so the pairs of interest are an input
    (ticker_i, ticker_j); portfolio code that needs the whole matrix works on Gram matrices.
    """
    rows = returns.filter(F.col("day_idx") >= 1).select("date", "day_idx", "ticker", "ret")
    left = rows.select("date", "day_idx", F.col("ticker").alias("ticker_i"), F.col("ret").alias("x"))
    right = rows.select("date", F.col("ticker").alias("ticker_j"), F.col("ret").alias("y"))
    joined = left.join(pairs, "ticker_i").join(right, ["date", "ticker_j"])
    frame = trailing(Window.partitionBy("ticker_i", "ticker_j").orderBy("day_idx"), width)
    return joined.select(
        "date",
        "ticker_i",
        "ticker_j",
        F.when(F.count("*").over(frame) >= 2, F.covar_samp("x", "y").over(frame)).alias("cov"),
    )


def is_cash():
    return F.col("ticker") == CASH

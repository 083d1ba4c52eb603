"""Performance of backtest paths and series behind the usual charts.

A path has one row per day, so windows by path are as short as the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.config import TRADING_DAYS_PER_YEAR

METRICS = (
    "cagr", "ann_vol", "sharpe", "sortino", "max_drawdown", "calmar", "avg_turnover",
    "avg_active", "avg_cash", "hhi", "total_return", "n_trades", "n_days",
)
FLOOR = 1e-10


def cumulative(daily: DataFrame, column: str) -> DataFrame:
    """Add growth of 1 (`cum`), its running maximum and the drawdown."""
    so_far = Window.partitionBy("path_id").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    rows = daily.withColumn(
        "cum", F.coalesce(F.product(1 + F.col(column)).over(so_far), F.lit(1.0))
    )
    rows = rows.withColumn("peak", F.max("cum").over(so_far))
    return rows.withColumn("drawdown", F.try_divide("cum", "peak") - 1)


def portfolio_metrics(daily: DataFrame, net: bool = True, rf_annual: float = 0.0) -> DataFrame:
    column = "net" if net else "gross"
    year = float(TRADING_DAYS_PER_YEAR)
    rf = (1 + rf_annual) ** (1 / year) - 1
    rows = cumulative(daily, column).withColumn("_x", F.col(column) - rf)
    sums = rows.groupBy("path_id").agg(
        F.count("*").alias("n_days"),
        F.max_by("cum", "date").alias("_cum"),
        F.stddev_pop(column).alias("_std"),
        F.avg("_x").alias("_mean"),
        F.stddev_pop("_x").alias("_xstd"),
        F.sqrt(F.avg(F.pow(F.least("_x", F.lit(0.0)), 2))).alias("_down"),
        F.min("drawdown").alias("max_drawdown"),
        F.avg("turnover").alias("avg_turnover"),
        F.avg("n_active").alias("avg_active"),
        F.avg("cash_weight").alias("avg_cash"),
        F.avg("hhi").alias("hhi"),
        F.count(F.when(F.col("traded"), 1)).alias("n_trades"),
    )
    years = F.greatest(F.col("n_days") / year, F.lit(1e-6))
    cagr = F.when(F.col("_cum") > 0, F.pow(F.col("_cum"), 1 / years) - 1).otherwise(-1.0)
    root = F.sqrt(F.lit(year))
    table = sums.withColumns(
        {
            "cagr": cagr,
            "ann_vol": F.col("_std") * root,
            "sharpe": F.col("_mean") / F.greatest("_xstd", F.lit(FLOOR)) * root,
            "sortino": F.col("_mean") / F.greatest("_down", F.lit(FLOOR)) * root,
            "total_return": F.col("_cum") - 1,
        }
    )
    table = table.withColumn(
        "calmar", F.col("cagr") / F.greatest(F.abs("max_drawdown"), F.lit(FLOOR))
    )
    return table.select("path_id", *METRICS)


def report_series(daily: DataFrame, net: bool = True, width: int = 60) -> DataFrame:
    """Cumulative return, drawdown, turnover and rolling Sharpe per path and day."""
    column = "net" if net else "gross"
    days = Window.partitionBy("path_id").orderBy("date")
    frame = days.rowsBetween(-(width - 1), 0)
    ratio = F.avg(column).over(frame) / F.greatest(F.stddev_pop(column).over(frame), F.lit(FLOOR))
    rows = cumulative(daily, column)
    return rows.select(
        "path_id",
        "date",
        (F.col("cum") - 1).alias("cumulative_return"),
        "drawdown",
        "turnover",
        F.when(
            F.count("*").over(frame) == width, ratio * F.sqrt(F.lit(float(TRADING_DAYS_PER_YEAR)))
        ).alias(f"rolling_sharpe_{width}"),
    )


def fold_aggregate(metrics: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Mean, population deviation, min and max of every metric over the rows (folds)."""
    names = names or [m for m in METRICS if m in metrics.columns]
    doubles = metrics.select(*[F.col(n).cast("double").alias(n) for n in names], F.lit(1).alias("_k"))
    long = doubles.unpivot("_k", names, "metric", "value")
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Strategies ordered by Sharpe ratio, best first."""
    columns = ("path_id", "sharpe", "cagr", "max_drawdown", "avg_turnover", "total_return")
    return metrics.select(*columns).orderBy(F.desc("sharpe"), "path_id")

"""Rule-based portfolios as long tables (keys, ticker, w).

A date may hold any number of tickers, so totals per date are aggregates that are joined
back, not windows over the date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.config import CASH
from quantpanel.functions.columns import by_ticker, ratio
from quantpanel.functions.storage import materialise
from quantpanel.operators.gram import (
    group_count,
    ridge_solutions,
    window_gram,
    window_products,
)
from quantpanel.operators.grid import day_table


def normalise(rows: DataFrame, keys: list[str], column: str = "w") -> DataFrame:
    """Divide by the total of the keys; equal weight where the total is not positive."""
    totals = rows.groupBy(*keys).agg(F.sum(column).alias("_total"), F.count("*").alias("_n"))
    scaled = F.when(F.col("_total") > 0, ratio(F.col(column), F.col("_total")))
    return (
        rows.join(day_table(totals, keys), keys)
        .withColumn(column, F.coalesce(scaled, 1 / F.col("_n")))
        .drop("_total", "_n")
    )


def equal_weight(scaffold: DataFrame) -> DataFrame:
    rows = scaffold.select("date", "ticker").withColumn("w", F.lit(1.0))
    return normalise(rows, ["date"])


def cash_only(scaffold: DataFrame) -> DataFrame:
    return scaffold.select(
        "date", "ticker", F.when(F.col("ticker") == CASH, 1.0).otherwise(0.0).alias("w")
    )


def inverse_volatility(scaffold: DataFrame, vol: DataFrame | None = None, column: str = "vol") -> DataFrame:
    """Weights proportional to 1 / volatility; floor 1e-8, missing volatility counts as 1.

    Without `vol` the scaffold itself has the column, and nothing is joined.
    """
    if vol is None:
        # as in the join, a row without a ticker has no volatility
        rows = scaffold.select("date", "ticker", F.when(F.col("ticker").isNotNull(), F.col(column)).alias("_vol"))
    else:
        source = vol.select("date", "ticker", F.col(column).alias("_vol"))
        rows = scaffold.select("date", "ticker").join(source, ["date", "ticker"], "left")
    floored = F.greatest(F.coalesce("_vol", F.lit(1.0)), F.lit(1e-8))
    # stored, because totals and weights both read it
    return normalise(materialise(rows.select("date", "ticker", (1 / floored).alias("w"))), ["date"])


def minimum_variance(returns: DataFrame, width: int = 60, ridge: float = 1e-6) -> DataFrame:
    """Long-only part of the minimum-variance portfolio of each day's trailing covariance.

    With X the centred W x N window, `inv(X'X/(m-1) + ridge I) 1` equals, up to scale,
    `1 - X' y` where `((m-1) ridge I + X X') y = X 1`. So one W x W system per day replaces
    the N x N inverse, and the weights are dot products next to the data. Days with fewer than
    two usable rows are equally weighted.
    """
    n_days = returns.agg(F.max("day_idx") + 1).scalar()
    observed = returns.filter(F.col("day_idx") >= 1).withColumn("n_days", n_days)
    groups = group_count(returns)
    grams = window_gram(observed, width, "centred", groups)
    vectors = ridge_solutions(grams, width, ridge).select(
        "day_idx", F.array("y").alias("directions")
    )
    products = window_products(observed, vectors, width, "centred", groups)
    days = returns.select("date", "day_idx").distinct()
    raw = products.join(day_table(days, "day_idx"), "day_idx").select("date", "ticker", (1 - F.col("value")).alias("w"))
    first = returns.filter(F.col("day_idx") == 0).select("date", "ticker", F.lit(1.0).alias("w"))
    clipped = raw.unionByName(first).withColumn("w", F.greatest("w", F.lit(0.0)))
    # stored, because totals and weights both read it
    return normalise(materialise(clipped), ["date"])


def previous_hold(returns: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """Buy and hold: initial weight times growth up to the previous day, renormalised."""
    past = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    growth = F.coalesce(F.product(1 + F.col("ret")).over(past), F.lit(1.0))
    rows = returns.select("date", "ticker", growth.alias("w"))
    if initial is not None:
        start = initial.select("ticker", F.col("w").alias("_w0"))
        rows = rows.join(start, "ticker").select("date", "ticker", (F.col("w") * F.col("_w0")).alias("w"))
    return normalise(rows, ["date"])


def teacher_replay(scaffold: DataFrame, hard: DataFrame) -> DataFrame:
    """Hard target of the date, else of the last labelled date before, else equal weight."""
    labels = hard.select("date", "ticker", F.col("w").alias("_hard"))
    rows = scaffold.select("date", "ticker").join(labels, ["date", "ticker"], "left")
    window = by_ticker().rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.withColumn("_hard", F.last("_hard", ignorenulls=True).over(window))
    sizes = rows.groupBy("date").agg(F.count("*").alias("_n"))
    return carried.join(day_table(sizes), "date").select(
        "date", "ticker", F.coalesce("_hard", 1 / F.col("_n")).alias("w")
    )

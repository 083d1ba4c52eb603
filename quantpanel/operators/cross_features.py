"""Features of the whole cross-section of a date.

Everything per date is an aggregate with partial sums; moments of trailing windows are taken in blocks
of days (`gram.py`). No pair of assets is ever formed: the mean pairwise correlation of n standardised
series z over W days is `(sum_t (sum_i z_it)^2 / W - n) / (n (n - 1))`, and the leading
eigenvalues of the n x n correlation matrix are those of the W x W matrix Z Z' / W.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.config import FeatureConfig
from quantpanel.functions.columns import annualise, by_ticker, trailing
from quantpanel.functions.storage import materialise
from quantpanel.operators.asset_features import equal_weight_return, returns_rowlag
from quantpanel.operators.gram import (
    FLAT,
    group_count,
    top_eigen,
    window_gram,
    window_moments,
    window_products,
)
from quantpanel.operators.grid import calendar_of, day_table, dense_grid
from quantpanel.operators.market_features import outer_join_blocks
from quantpanel.operators.ranks import rank_in_group


def return_grid(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Dense (ticker, day_idx, n_days, ret): row-to-row returns, null where the ticker has no row."""
    rets = returns_rowlag(prices.select("date", "ticker", "adj_close"))
    return dense_grid(
        rets.select("date", "ticker", F.col("simple_ret").alias("ret")), ["ret"], calendar
    ).select("ticker", "day_idx", calendar.agg(F.max("n_days")).scalar().alias("n_days"), "ret")


def observed_returns(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sparse (ticker, day_idx, n_days, ret): only the days on which the ticker has a row."""
    rets = returns_rowlag(prices.select("date", "ticker", "adj_close"))
    days = calendar.select("date", "day_idx", "n_days")
    return rets.join(day_table(days), "date").select(
        "ticker", "day_idx", "n_days", F.col("simple_ret").alias("ret")
    )


def universe_return(prices: DataFrame) -> DataFrame:
    rets = returns_rowlag(prices.select("date", "ticker", "adj_close"))
    return equal_weight_return(rets).select(
        F.col("date").alias("asof_date"), F.col("eqw_ret").alias("eqw_universe_ret")
    )


def correlation_and_vol(rows: DataFrame, width: int) -> DataFrame:
    """`avg_pairwise_corr_w` and `avg_vol_w` per day.

    `rows`: (ticker, day_idx, ret) with or without the cells that have no return, and n_days (taken from
    the rows if they lack it).
    """
    if "n_days" not in rows.columns:
        rows = rows.withColumn("n_days", rows.agg(F.max("day_idx") + 1).scalar())
    sums = window_moments(rows, width, group_count(rows))
    squares = reduce(add, [F.pow(F.coalesce(f"_s{k}", F.lit(0.0)), 2) for k in range(width)])
    n = F.col("n").cast("double")
    corr = F.when(F.col("n") >= 2, (squares / width - n) / (n * (n - 1)))
    enough = F.col("n_valid") >= 2
    return sums.select(
        "day_idx",
        F.when(enough, corr).alias(f"avg_pairwise_corr_{width}"),
        F.when(enough, annualise(F.col("deviation")) / F.col("n_valid")).alias(f"avg_vol_{width}"),
    )


def pca_ratios(observed: DataFrame, width: int, k: int = 3) -> DataFrame:
    """Share of the k leading eigenvalues of each day's correlation matrix."""
    grams = window_gram(observed, width, "standardised", group_count(observed))
    eigen = top_eigen(grams, width, k)
    share = [
        F.when(
            (F.col("n") > j) & (F.col("n") >= 2),
            F.coalesce(F.get("eig", j), F.lit(0.0)) / width / F.col("n"),
        ).alias(f"pca_var_ratio_{j}_{width}")
        for j in range(k)
    ]
    return eigen.select("day_idx", *share)


def pca_loadings(observed: DataFrame, width: int, k: int = 3) -> DataFrame:
    """(day_idx, ticker, pc, loading): unit eigenvectors of the correlation matrix.

    An eigenvector u of Z Z' becomes the one of the correlation matrix as Z' u / sqrt(eig).
    The sign makes the entry of largest size positive (first ticker on ties).
    """
    groups = group_count(observed)
    eigen = top_eigen(window_gram(observed, width, "standardised", groups), width, k)
    scaled = F.zip_with(
        "vecs",
        "eig",
        lambda u, e: F.transform(u, lambda x: F.when(e > 1e-9, x / F.sqrt(e)).otherwise(0.0)),
    )
    directions = eigen.select("day_idx", scaled.alias("directions"))
    raw = window_products(observed, directions, width, "standardised", groups).select(
        "day_idx", "ticker", F.col("k").alias("pc"), F.col("value").alias("raw")
    )
    largest = raw.groupBy("day_idx", "pc").agg(
        F.min_by("raw", F.struct(-F.round(F.abs("raw"), 9), "ticker")).alias("_top")
    )
    signed = F.col("raw") * F.when(F.col("_top") < 0, -1.0).otherwise(1.0)
    # k rows per day.
    return raw.join(F.broadcast(largest), ["day_idx", "pc"]).select(
        "day_idx", "ticker", "pc", signed.alias("loading")
    )


def breadth(grid: DataFrame, width: int = 20, group_rows: int | None = None) -> DataFrame:
    """Mean cumulative return of the best and worst quarter of tickers per day.

    Missing returns count as growth 1, so a ticker without data stays in with 0%.
    """
    frame = trailing(by_ticker(order="day_idx"), width)
    growth = F.coalesce(F.product(1 + F.col("ret")).over(frame), F.lit(1.0))
    rows = grid.select("ticker", "day_idx", (growth - 1).alias("cum")).filter(
        F.col("day_idx") >= width
    )
    sizes = rows.groupBy("day_idx").agg(F.count("*").alias("n"))
    ranked = rank_in_group(
        rows, ["day_idx"], [F.desc("cum"), "ticker"], "r", group_rows=group_rows
    ).join(day_table(sizes, "day_idx"), "day_idx")
    quarter = F.greatest(F.lit(1), F.floor(F.col("n") / 4))
    means = ranked.groupBy("day_idx").agg(
        F.max("n").alias("n"),
        F.avg(F.when(F.col("r") < quarter, F.col("cum"))).alias("top"),
        F.avg(F.when(F.col("r") >= F.col("n") - quarter, F.col("cum"))).alias("bottom"),
    )
    enough = F.col("n") >= 4
    return means.select(
        "day_idx",
        F.when(enough, F.col("top")).alias(f"breadth_top_quartile_{width}"),
        F.when(enough, F.col("bottom")).alias(f"breadth_bottom_quartile_{width}"),
        F.when(enough, F.col("top") - F.col("bottom")).alias(f"breadth_spread_{width}"),
    )


def cross_asset_features(prices: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """All cross-sectional features keyed by asof_date.

    The returns are stored once, because every block reads them.
    """
    prices = materialise(prices.select("date", "ticker", "adj_close"))
    calendar = materialise(calendar_of(prices))
    grid = materialise(return_grid(prices, calendar))
    observed = materialise(observed_returns(prices, calendar))
    blocks = [breadth(grid)]
    for width in cfg.cross_windows:
        blocks.append(correlation_and_vol(observed, width))
        blocks.append(pca_ratios(observed, width, cfg.pca_components))
    days = calendar.select("day_idx", F.col("date").alias("asof_date"))
    table = outer_join_blocks(blocks, "day_idx")
    rows = days.join(table, "day_idx", "left").drop("day_idx")
    return universe_return(prices).join(rows, "asof_date")

"""Small panels for the tests."""

import datetime as dt

import numpy as np
import pandas as pd


def business_days(n, start=dt.date(2024, 1, 1)):
    return [d.date() for d in pd.bdate_range(start, periods=n)]


def price_matrix(n_days, n_tickers, seed=0, gap_share=0.0):
    rng = np.random.default_rng(seed)
    prices = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, (n_days, n_tickers)), axis=0))
    prices[rng.random(prices.shape) < gap_share] = np.nan
    return prices


def price_frame(spark, prices, names=None):
    days = business_days(len(prices))
    names = names or [f"T{j:03d}" for j in range(prices.shape[1])]
    rows = [
        (days[i], names[j], float(prices[i, j]), 1000.0 + i, 1e6 + 10.0 * i)
        for i in range(prices.shape[0])
        for j in range(prices.shape[1])
        if not np.isnan(prices[i, j])
    ]
    return spark.createDataFrame(
        rows, "date date, ticker string, adj_close double, volume double, dollar_volume double"
    )


def long_frame(spark, matrix, column, path=None, names=None):
    days = business_days(len(matrix))
    names = names or [f"T{j:03d}" for j in range(matrix.shape[1])]
    rows = [
        ((path,) if path else ()) + (days[i], i, names[j], float(matrix[i, j]))
        for i in range(matrix.shape[0])
        for j in range(matrix.shape[1])
    ]
    head = "path_id string, " if path else ""
    return spark.createDataFrame(rows, f"{head}date date, day_idx int, ticker string, {column} double")


def matrix_of(df, column, row="date", col="ticker"):
    wide = df.select(row, col, column).toPandas().pivot(index=row, columns=col, values=column)
    return wide.sort_index().sort_index(axis=1).to_numpy(dtype=float)

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantpanel.operators import evaluate as ev
from quantpanel.operators import stats
from quantpanel.operators.ranks import average_rank, rank_in_group, scaled_rank


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with most rows, and one value that fills a third of them."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(900):
        group = "hot" if i % 10 else f"g{i % 70}"
        value = 0.0 if i % 3 == 0 else float(round(rng.normal(), 2))
        rows.append((group, i, value))
    return spark.createDataFrame(rows, "g string, id int, v double").repartition(7)


@pytest.mark.parametrize("order", [["v", "id"], [F.desc, "id"]])
def test_sorted_rank_equals_window_rank(skewed, order):
    keys = [F.desc("v"), "id"] if callable(order[0]) else order
    small = rank_in_group(skewed, ["g"], keys, "r")
    large = rank_in_group(skewed, ["g"], keys, "r", window_rows=0)
    assert small.select("g", "id", "r").exceptAll(large.select("g", "id", "r")).count() == 0
    assert large.count() == 900


def test_scaled_and_average_rank(skewed):
    lows = scaled_rank(skewed, ["g"], ["v", "id"], "s", window_rows=0)
    row = lows.groupBy("g").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).filter("g = 'hot'").first()
    assert (row["lo"], row["hi"]) == (0.0, 1.0)
    a = average_rank(skewed, ["g"], "v", ["id"], "r")
    b = average_rank(skewed, ["g"], "v", ["id"], "r", window_rows=0)
    assert a.select("g", "id", "r").exceptAll(b.select("g", "id", "r")).count() == 0


def test_median_of_large_groups(skewed):
    exact = {r["g"]: r["m"] for r in skewed.groupBy("g").agg(F.median("v").alias("m")).collect()}
    for limit in (1_000_000, 0):
        got = stats.group_median(skewed, ["g"], "v", window_rows=limit).collect()
        assert {r["g"]: r["median"] for r in got} == pytest.approx(exact)


def test_column_medians_default_to_zero(spark):
    rows = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    assert stats.column_medians(rows, ["a", "b"]) == {"a": 2.0, "b": 0.0}


@pytest.mark.parametrize("block", [4, 10_000])
def test_kendall_against_all_pairs(spark, block):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for g, n in (("a", 37), ("b", 2), ("c", 16)):
        x, y = rng.integers(0, 9, n), rng.integers(0, 7, n)
        rows += [(g, i, float(x[i]), float(y[i])) for i in range(n)]
        s = tx = ty = 0
        for i, j in itertools.combinations(range(n), 2):
            s += np.sign(x[i] - x[j]) * np.sign(y[i] - y[j])
            tx += x[i] != x[j]
            ty += y[i] != y[j]
        want[g] = s / np.sqrt(tx * ty) if tx * ty else None
    frame = spark.createDataFrame(rows, "g string, id int, pred double, truth double")
    got = {r["g"]: r["kendall"] for r in ev.kendall_tau(frame, ["g"], "id", block).collect()}
    for g, value in want.items():
        assert got[g] is None if value is None else got[g] == pytest.approx(value, abs=1e-12)


def test_top_share_recall(spark):
    rows = [("d", i, float(i), float(-i if i < 8 else i)) for i in range(10)]
    frame = spark.createDataFrame(rows, "date string, id int, truth double, pred double")
    assert ev.top_share_recall(frame, ["date"], "id").first()["recall"] == 1.0


@pytest.mark.parametrize("limit", [1_000_000, 20, 1])
def test_column_summaries_equal_numpy(spark, limit):
    rng = np.random.default_rng(4)
    n = 5000
    columns = {
        "even": rng.normal(size=n), "ties": np.where(np.arange(n) % 3, 2.0, rng.normal(size=n)),
        "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n)), "whole": rng.integers(0, 9, n).astype(float),
        "none": np.full(n, np.nan),
    }
    frame = spark.createDataFrame(pd.DataFrame(columns)).withColumn("even", F.when(F.rand(3) < 2, F.col("even")))
    got = stats.column_summaries(frame, list(columns), accuracy=50, window_rows=limit)
    for name, values in columns.items():
        known = values[~np.isnan(values)]
        assert got[name].count == len(known)
        if len(known):
            assert got[name].median == np.median(known), name
            assert (got[name].mean, got[name].std) == pytest.approx((known.mean(), known.std()))
    assert got["none"] == stats.ColumnSummary(0, 0.0, 0.0, 0.0)


def test_column_summaries_of_few_rows(spark):
    frame = spark.createDataFrame([(1.0, None), (4.0, 7.0), (2.0, None)], "a double, b double")
    assert stats.column_medians(frame, ["a", "b"]) == {"a": 2.0, "b": 7.0}
    assert stats.column_medians(frame.limit(0), ["a"]) == {"a": 0.0}


def test_partitions_follow_the_rows_of_the_grid(spark, monkeypatch):
    """Sorted partitions of a grid and of ranks hold a bounded number of rows."""
    from quantpanel.functions import storage
    from quantpanel.operators.grid import calendar_of, dense_grid
    from tests.helpers import price_frame, price_matrix

    monkeypatch.setattr(storage, "ROWS_PER_PARTITION", 20)
    frame = price_frame(spark, price_matrix(10, 40))
    grid = dense_grid(frame, ["adj_close"], calendar_of(frame))
    assert grid.count() == 400 and 15 <= grid.rdd.getNumPartitions() <= 25
    ranked = rank_in_group(grid, ["day_idx"], ["ticker"], "r")
    assert ranked.rdd.getNumPartitions() == 20


def test_inverse_volatility_without_a_join(spark):
    """A volatility column of the scaffold counts as the joined one; no ticker, no volatility."""
    from quantpanel.operators.portfolios import inverse_volatility

    rows = [(d, t, v) for d in ("2024-01-01", "2024-01-02") for t, v in (("A", 0.2), ("B", None), (None, 0.5), ("C", 0.0))]
    table = spark.createDataFrame(rows, "day string, ticker string, vol double").selectExpr("cast(day as date) date", "ticker", "vol")
    joined = inverse_volatility(table.select("date", "ticker"), table)
    key = lambda r: (r["date"], r["ticker"] or "")
    assert sorted(inverse_volatility(table).collect(), key=key) == sorted(joined.collect(), key=key)

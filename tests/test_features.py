import numpy as np
import pytest
from pyspark.sql import functions as F

from quantpanel.operators import asset_features as af
from quantpanel.operators import cross_features as cf
from quantpanel.operators import gram
from quantpanel.operators.grid import calendar_of, dense_grid
from quantpanel.operators.portfolios import minimum_variance
from quantpanel.operators.returns import returns_filled, returns_gap_zero
from tests.helpers import business_days, long_frame, matrix_of, price_frame, price_matrix

W = 20


@pytest.fixture(scope="module")
def prices():
    p = price_matrix(45, 9, seed=5, gap_share=0.1)
    p[:12, 3] = np.nan  # starts late
    p[:, 4] = 50.0  # never moves
    return p


def row_returns(prices):
    """Return to the previous row of the ticker, NaN where it has no row."""
    out = np.full(prices.shape, np.nan)
    for j in range(prices.shape[1]):
        at = np.flatnonzero(~np.isnan(prices[:, j]))
        out[at[1:], j] = prices[at[1:], j] / prices[at[:-1], j] - 1
    return out


def window(returns, day):
    """Zero-filled returns of the tickers with data and movement in the window."""
    block = returns[day - W + 1 : day + 1]
    block = np.nan_to_num(block[:, ~np.isnan(block).all(axis=0)])
    return block[:, block.std(axis=0) > 1e-12]


def test_mean_pairwise_correlation(spark, prices):
    frame = price_frame(spark, prices)
    calendar = calendar_of(frame)
    table = cf.correlation_and_vol(cf.return_grid(frame, calendar), W).orderBy("day_idx").collect()
    returns = row_returns(prices)
    assert [r["day_idx"] for r in table] == list(range(W, 45))
    for row in table:
        corr = np.corrcoef(window(returns, row["day_idx"]).T)
        upper = corr[np.triu_indices(len(corr), 1)]
        assert row["avg_pairwise_corr_20"] == pytest.approx(upper.mean(), abs=1e-12)


@pytest.mark.parametrize("per_group", [2048, 2])
def test_window_moments_need_no_dense_cells(spark, prices, per_group, monkeypatch):
    """The days on which a ticker trades are enough; a ticker without a name is one of its own."""
    monkeypatch.setattr(gram, "TICKERS_PER_GROUP", per_group)
    frame = price_frame(spark, prices)
    frame = frame.withColumn("ticker", F.when(F.col("ticker") != "T002", F.col("ticker")))
    table = cf.correlation_and_vol(cf.observed_returns(frame, calendar_of(frame)), W).orderBy("day_idx").collect()
    returns = row_returns(prices)
    assert [r["day_idx"] for r in table] == list(range(W, 45))
    for row in table:
        block = returns[row["day_idx"] - W + 1 : row["day_idx"] + 1]
        block = np.nan_to_num(block[:, ~np.isnan(block).all(axis=0)])
        corr = np.corrcoef(window(returns, row["day_idx"]).T)
        assert row["avg_vol_20"] == pytest.approx(block.std(axis=0).mean() * np.sqrt(252), abs=1e-12)
        assert row["avg_pairwise_corr_20"] == pytest.approx(corr[np.triu_indices(len(corr), 1)].mean(), abs=1e-12)


@pytest.mark.parametrize("per_group", [2048, 2])
def test_pca_ratios(spark, prices, per_group, monkeypatch):
    monkeypatch.setattr(gram, "TICKERS_PER_GROUP", per_group)
    frame = price_frame(spark, prices)
    table = cf.pca_ratios(cf.observed_returns(frame, calendar_of(frame)), W).collect()
    returns = row_returns(prices)
    assert len(table) == 45 - W
    for row in table:
        corr = np.corrcoef(window(returns, row["day_idx"]).T)
        eig = np.sort(np.linalg.eigvalsh(corr))[::-1] / len(corr)
        for k in range(3):
            assert row[f"pca_var_ratio_{k}_20"] == pytest.approx(eig[k], abs=1e-10)


@pytest.mark.parametrize("per_group", [2048, 2])
def test_pca_loadings_are_unit_eigenvectors(spark, prices, per_group, monkeypatch):
    monkeypatch.setattr(gram, "TICKERS_PER_GROUP", per_group)
    frame = price_frame(spark, prices)
    rows = cf.pca_loadings(cf.observed_returns(frame, calendar_of(frame)), W)
    day = 40
    block = rows.filter(F.col("day_idx") == day).toPandas().pivot(index="ticker", columns="pc", values="loading")
    corr = np.corrcoef(window(row_returns(prices), day).T)
    value, vector = np.linalg.eigh(corr)
    for k in range(3):
        got = block[k].to_numpy()
        assert np.abs(got @ vector[:, -1 - k]) == pytest.approx(1.0, abs=1e-9)
        assert got[np.abs(got).argmax()] > 0


@pytest.mark.parametrize("per_group", [2048, 3])
def test_minimum_variance(spark, per_group, monkeypatch):
    monkeypatch.setattr(gram, "TICKERS_PER_GROUP", per_group)
    returns = np.random.default_rng(2).normal(0, 0.02, (80, 7))
    returns[0] = 0
    got = matrix_of(minimum_variance(long_frame(spark, returns, "ret"), 60), "w")
    for day in range(80):
        block = returns[max(1, day - 59) : day + 1]
        if len(block) < 2:
            want = np.full(7, 1 / 7)
        else:
            raw = np.linalg.solve(np.cov(block.T) + 1e-6 * np.eye(7), np.ones(7))
            want = np.maximum(raw / raw.sum(), 0)
            want = want / want.sum()
        np.testing.assert_allclose(got[day], want, atol=1e-8)


def test_features_do_not_look_ahead(spark):
    p = price_matrix(160, 3, seed=1, gap_share=0.05)
    cut = business_days(160)[130]
    frame = price_frame(spark, p)
    whole = af.asset_features(frame).filter(F.col("asof_date") <= cut)
    short = af.asset_features(frame.filter(F.col("date") <= cut))
    assert whole.exceptAll(short).count() == 0 and short.exceptAll(whole).count() == 0
    left = cf.breadth(cf.return_grid(frame, calendar_of(frame)))
    assert left.filter(F.col("day_idx") < 20).count() == 0


def test_volatility_needs_a_full_window(spark):
    frame = price_frame(spark, price_matrix(30, 1, seed=4))
    rows = af.asset_features(frame).orderBy("asof_date").collect()
    assert [r["vol_20"] is None for r in rows] == [True] * 20 + [False] * 10
    # Missing first return counts as 0, so downside volatility starts one row earlier.
    assert [r["downvol_20"] is None for r in rows] == [True] * 19 + [False] * 11
    assert rows[0]["missing_feature_count_with_state"] == rows[0]["missing_feature_count"] + 3


def test_constant_prices_give_null_correlation_not_an_error(spark):
    p = price_matrix(70, 3, seed=6)
    p[:, 1] = 10.0
    rows = af.market_beta_corr(price_frame(spark, p)).filter("ticker = 'T001'").collect()
    assert all(r["corr_eqw_20"] is None for r in rows)


def test_dense_grid_fills_both_ways(spark):
    p = np.array([[np.nan, 1.0], [2.0, np.nan], [np.nan, np.nan], [4.0, 3.0]])
    p = np.column_stack([p, [1.0, 1.0, 1.0, 1.0]])
    frame = price_frame(spark, p)
    grid = dense_grid(frame, ["adj_close"], calendar_of(frame))
    filled = matrix_of(grid, "adj_close_filled", row="day_idx")
    np.testing.assert_array_equal(filled[:, 0], [2, 2, 2, 4])
    np.testing.assert_array_equal(filled[:, 1], [1, 1, 1, 3])
    assert grid.filter("is_obs").count() == 8


def test_return_definitions_differ_on_gaps(spark):
    p = np.array([[100.0, 1.0], [np.nan, 1.0], [121.0, 1.0], [133.1, 1.0]])
    frame = price_frame(spark, p)
    rowlag = af.returns_rowlag(frame).filter("ticker = 'T000'").orderBy("date").collect()
    assert [r["simple_ret"] for r in rowlag][1:] == pytest.approx([0.21, 0.1])
    assert matrix_of(returns_gap_zero(frame, cash=False), "ret")[:, 0] == pytest.approx([0, 0, 0, 0.1])
    assert matrix_of(returns_filled(frame, cash=False), "ret")[:, 0] == pytest.approx([0, 0, 0.21, 0.1])


def test_alignment_uses_the_return_of_the_requested_date(spark):
    from quantpanel.operators.returns import align_returns
    from quantpanel.sources.universe import universe_order

    frame = price_frame(spark, np.array([[100.0], [110.0], [121.0]]), ["AAA"])
    day = business_days(3)[2]
    dates = spark.createDataFrame([(day,)], "date date")
    rows = align_returns(returns_filled(frame), dates, universe_order(frame)).collect()
    got = {r["ticker"]: r["ret"] for r in rows}
    assert got["AAA"] == pytest.approx(0.10) and got["CASH"] == 0.0

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantpanel.config import CostConfig, ExecutionConfig, LiquidityBucket
from quantpanel.operators import backtest as bt
from quantpanel.operators import evaluate as ev
from quantpanel.operators.metrics import portfolio_metrics
from quantpanel.operators.portfolios import equal_weight, previous_hold
from tests.helpers import long_frame, matrix_of

RETURNS = np.array([[0.01, -0.02], [0.03, 0.01], [-0.01, 0.02], [0.0, 0.01]])
FREE = CostConfig(
    default_spread_bps=0.0, impact_coeff=0.0, buckets=(LiquidityBucket(0.0, 1e20, 0.0),)
)


def walk(target, returns, band, alpha):
    """Plain day-by-day reference."""
    held = np.full(target.shape[1], 1 / target.shape[1])
    live, after, flags = [], [], []
    for t, r in zip(target, returns):
        live.append(held)
        trade = 0.5 * np.abs(t - held).sum() >= band
        if trade:
            held = np.maximum(held + alpha * (t - held), 0)
            held = held / held.sum()
        after.append(held)
        flags.append(trade)
        held = held * (1 + r) / (held * (1 + r)).sum()
    return np.array(live), np.array(after), np.array(flags)


def signals(weights, path):
    return weights.select(F.lit(path).alias("path_id"), "date", "ticker", "w")


def test_pinned_equal_weight_and_hold(spark):
    returns = long_frame(spark, RETURNS, "ret")
    both = signals(equal_weight(returns), "equal").unionByName(
        signals(previous_hold(returns), "hold")
    )
    daily, _ = bt.backtest_full(both, returns, cfg=FREE)
    rows = {r["path_id"]: r for r in portfolio_metrics(daily).collect()}
    assert rows["equal"]["sharpe"] == pytest.approx(11.114378604524228, rel=1e-12)
    assert rows["equal"]["total_return"] == pytest.approx(0.025074372499999775, rel=1e-12)
    assert rows["equal"]["avg_turnover"] == pytest.approx(0.004975583948422235, rel=1e-12)
    assert rows["hold"]["sharpe"] == pytest.approx(10.902292894568998, rel=1e-12)
    assert rows["hold"]["total_return"] == pytest.approx(0.02479447999999973, rel=1e-12)
    assert rows["hold"]["avg_turnover"] == pytest.approx(0.0, abs=1e-15)


@pytest.fixture
def random_case(spark):
    rng = np.random.default_rng(3)
    target = rng.dirichlet(np.full(9, 0.7), 40)
    target[10:18] = target[10]  # a quiet stretch, so that the band matters
    returns = rng.normal(0, 0.02, (40, 9))
    return target, returns, long_frame(spark, target, "w", "p"), long_frame(spark, returns, "ret")


def test_full_equals_banded_without_band(random_case):
    _, _, sig, ret = random_case
    full, _ = bt.backtest_full(sig, ret)
    banded, _ = bt.backtest_banded(sig, ret, execution=ExecutionConfig(0.0, 1.0))
    left = full.orderBy("date").toPandas()
    right = banded.orderBy("date").toPandas()
    for name in ("gross", "net", "turnover", "cost_bps"):
        np.testing.assert_allclose(left[name], right[name], atol=1e-12)


@pytest.mark.parametrize("band,alpha", [(0.3, 0.5), (0.45, 0.25), (0.6, 1.0), (0.0, 1.0), (2.0, 0.5)])
@pytest.mark.parametrize("max_rows", [10_000_000, 0])
def test_banded_matches_day_by_day(random_case, band, alpha, max_rows, monkeypatch):
    """Both routes: whole paths, and (max_rows = 0) paths split by ticker."""
    monkeypatch.setattr(bt, "TICKERS_PER_BLOCK", 2)
    target, returns, sig, ret = random_case
    _, weights = bt.backtest_banded(
        sig, ret, execution=ExecutionConfig(band, alpha), max_path_rows=max_rows
    )
    weights = weights.persist()
    live, after, flags = walk(target, returns, band, alpha)
    np.testing.assert_allclose(matrix_of(weights, "live"), live, atol=1e-12)
    np.testing.assert_allclose(matrix_of(weights, "w"), after, atol=1e-12)
    got = weights.groupBy("date").agg(F.bool_or("traded").alias("t")).orderBy("date").toPandas()
    assert got["t"].tolist() == flags.tolist()
    weights.unpersist()


def test_paths_do_not_influence_each_other(spark, random_case):
    target, _, sig, ret = random_case
    other = long_frame(spark, target[:, ::-1], "w", "q")
    rules = ExecutionConfig(0.3, 0.5)
    alone = bt.backtest_banded(sig, ret, execution=rules)[0].orderBy("date").toPandas()
    both = bt.backtest_banded(sig.unionByName(other), ret, execution=rules)[0]
    mine = both.filter("path_id = 'p'").orderBy("date").toPandas()
    np.testing.assert_array_equal(alone["net"], mine["net"])


def test_cost_scenarios_scale_from_the_same_base(spark, random_case):
    _, _, sig, ret = random_case
    paths = bt.scenario_signals(sig, ev.cost_scenarios(spark))
    daily, _ = bt.backtest_banded(paths, ret)
    rows = {r["path_id"]: r["c"] for r in daily.groupBy("path_id").agg(F.sum("cost_bps").alias("c")).collect()}
    assert rows["p|cost_0.5x"] == pytest.approx(0.5 * rows["p|cost_1.0x"])
    assert rows["p|cost_2.0x"] == pytest.approx(2.0 * rows["p|cost_1.0x"])


def test_execution_step_keeps_the_simplex(spark):
    rng = np.random.default_rng(1)
    target, live = rng.dirichlet(np.ones(5), 12), rng.dirichlet(np.ones(5), 12)
    out = bt.execute(
        long_frame(spark, target, "w"), long_frame(spark, live, "w"), ["date"], ExecutionConfig(0.3, 0.5)
    )
    weights = matrix_of(out, "w")
    assert (weights >= 0).all()
    np.testing.assert_allclose(weights.sum(axis=1), 1.0)
    kept = 0.5 * np.abs(target - live).sum(axis=1) < 0.3
    np.testing.assert_allclose(weights[kept], live[kept])


def test_profiles_custom_replaces_builtin(spark):
    from quantpanel.config import StrategyProfile

    custom = StrategyProfile("neutral", 0, 0, 0, 0.1, 0.3, 0.5, 0.9)
    rows = {r["name"]: r for r in ev.profile_table(spark, (custom,)).collect()}
    assert set(rows) == {"aggressive", "neutral", "conservative"}
    assert rows["neutral"]["rebalance_band"] == 0.5
    assert rows["aggressive"]["partial_rebalance_alpha"] == 0.75


def day_by_day(target, returns, band, alpha):
    """As `walk`, where sums that are not positive divide nothing."""
    held = np.full(target.shape[1], 1 / target.shape[1])
    live, after = [], []
    for t, r in zip(target, returns):
        live.append(held)
        if 0.5 * np.abs(t - held).sum() >= band:
            held = np.maximum(held + alpha * (t - held), 0)
            held = held / held.sum() if held.sum() > 0 else held
        after.append(held)
        grown = held * (1 + r)
        held = grown / grown.sum() if grown.sum() > 0 else held
    return np.array(live), np.array(after)


CASES = {
    "wiped out": (np.array([[0.5, 0.5], [0.5, 0.5], [0.9, 0.1], [0.2, 0.8]]), {1: [-1.0, -1.0]}),
    "negative targets": (np.array([[0.9, -0.4], [-0.5, 0.7], [-0.2, -0.3], [0.6, 0.4]]), {}),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("band,alpha", [(0.0, 1.0), (0.2, 0.5)])
@pytest.mark.parametrize("max_rows", [10_000_000, 0])
def test_one_behaviour_at_every_size(spark, case, band, alpha, max_rows, monkeypatch):
    monkeypatch.setattr(bt, "TICKERS_PER_BLOCK", 1)
    target, changed = CASES[case]
    returns = RETURNS.copy()
    for day, values in changed.items():
        returns[day] = values
    sig, ret = long_frame(spark, target, "w", "p"), long_frame(spark, returns, "ret")
    _, weights = bt.backtest_banded(sig, ret, execution=ExecutionConfig(band, alpha), max_path_rows=max_rows)
    live, after = day_by_day(target, returns, band, alpha)
    np.testing.assert_allclose(matrix_of(weights, "live"), live, atol=1e-12)
    np.testing.assert_allclose(matrix_of(weights, "w"), after, atol=1e-12)


@pytest.mark.parametrize("full", [True, False])
def test_left_out_members_have_weight_zero(spark, full):
    target = np.array([[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.5, 0.0, 0.5]])
    returns = np.array([[0.01, 0.02, 0.0], [0.03, -0.01, 0.01], [0.0, 0.01, 0.02]])
    whole, ret = long_frame(spark, target, "w", "p"), long_frame(spark, returns, "ret")
    sparse = whole.filter("w > 0")
    run = bt.backtest_full if full else bt.backtest_banded
    for a, b in zip(run(whole, ret), run(sparse, ret)):
        keys = [c for c in ("path_id", "date", "ticker") if c in a.columns]
        left, right = (x.orderBy(*keys).toPandas() for x in (a, b))
        for name in ("gross", "turnover", "cost_bps", "live", "w"):
            if name in left:
                np.testing.assert_allclose(left[name], right[name], atol=1e-12)

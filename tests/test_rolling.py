import numpy as np
import pytest

from quantpanel.operators import asset_features as af
from quantpanel.operators.rolling import rolled_name, rolling
from tests.helpers import business_days, price_frame, price_matrix

WANTED = [("mean", 4, "x"), ("max", 2, "x"), ("std", 7, "x"), ("var", 4, "y"), ("cov", 5, "x", "y")]


def slow(kind, window):
    if any(v is None for values in window for v in values):
        return None
    x = np.array(window[0])
    return {
        "mean": lambda: x.mean(),
        "max": lambda: x.max(),
        "std": lambda: x.std(ddof=1),
        "var": lambda: x.var(ddof=1),
        "cov": lambda: np.cov(x, np.array(window[-1]))[0, 1],
    }[kind]()


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_windows_across_batches_and_tickers(spark, batch):
    rng = np.random.default_rng(3)
    days = business_days(23)
    table = {
        name: [[None if rng.random() < 0.06 else float(v) for v in rng.normal(1e3, 1, 23)] for _ in "xy"]
        for name in ("A", "B", None)
    }
    table["C"] = [[0.1] * 23, [0.3] * 23]  # never moves
    table["D"] = [[2.5], [1.0]]
    rows = [(name, days[i], xs[i], ys[i]) for name, (xs, ys) in table.items() for i in range(len(xs))]
    order = rng.permutation(len(rows))
    frame = spark.createDataFrame([rows[i] for i in order], "ticker string, date date, x double, y double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = rolling(frame, WANTED).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(rows)
    for row in got:
        columns = dict(zip("xy", table[row["ticker"]]))
        at = days.index(row["date"])
        for kind, n, *names in WANTED:
            window = [columns[c][at - n + 1 : at + 1] if at >= n - 1 else [None] for c in names]
            want = slow(kind, window)
            value = row[rolled_name(kind, n, *names)]
            assert (value is None) == (want is None)
            if want is not None:
                assert value == pytest.approx(want, rel=1e-9, abs=1e-9)
            if row["ticker"] == "C" and value is not None and kind in ("std", "var", "cov"):
                assert value == 0.0  # exactly, as ratios of such values are null


@pytest.mark.parametrize("table", [af.asset_features, af.market_beta_corr])
def test_no_sliding_frames(spark, table, capsys):
    table(price_frame(spark, price_matrix(5, 2))).explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan
    for rows in (5, 20, 60, 120):
        assert f"RowFrame, -{rows - 1}, currentrow" not in plan

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quantpanel.config import UniverseConfig
from quantpanel.sources import calendar as xc
from quantpanel.sources import tables as tb
from quantpanel.sources import universe as un


@pytest.fixture
def holidays(spark):
    return spark.createDataFrame([(dt.date(2024, 1, 1),)], "holiday date")


def days_of(df):
    return {r[0] for r in df.select("trade_date").collect()}


def test_weekends_and_holidays_are_closed(spark, holidays):
    days = days_of(xc.trading_days(spark, dt.date(2023, 12, 29), dt.date(2024, 1, 8), holidays))
    assert dt.date(2024, 1, 1) not in days
    assert not {dt.date(2024, 1, 6), dt.date(2024, 1, 7)} & days
    assert {dt.date(2024, 1, 5), dt.date(2024, 1, 8)} <= days


def test_schedule_has_four_sessions_with_later_predictions(spark, holidays):
    rows = xc.schedule(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 5), holidays).collect()
    assert len(rows) == 4
    assert all(r["prediction_date"] > r["trade_date"] for r in rows)
    friday = next(r for r in rows if r["trade_date"] == dt.date(2024, 1, 5))
    assert friday["prediction_date"] == dt.date(2024, 1, 8)


def test_cutoff_is_six_in_the_evening_in_new_york(spark):
    days = spark.createDataFrame([(dt.date(2024, 3, 15),), (dt.date(2024, 1, 15),)], "d date")
    rows = days.select(
        F.date_format(F.from_utc_timestamp(F.to_timestamp(xc.cutoff_utc(F.col("d"))), "America/New_York"), "HH:mm"),
        F.hour(xc.cutoff_utc(F.col("d"))),
    ).collect()
    assert [r[0] for r in rows] == ["18:00", "18:00"]
    assert [r[1] for r in rows] == [22, 23]  # summer and winter time


def test_previous_day_over_weekend(spark):
    rows = xc.neighbours(xc.trading_days(spark, dt.date(2024, 1, 4), dt.date(2024, 1, 9)))
    monday = rows.filter(F.col("trade_date") == dt.date(2024, 1, 8)).first()
    assert monday["previous_date"] == dt.date(2024, 1, 5)


def panel(spark, names):
    return spark.createDataFrame([(n,) for n in names], "ticker string")


def test_universe_order_puts_cash_last(spark):
    rows = un.universe_members(panel(spark, ["GOOG", "AAPL", "ZZ"])).orderBy("asset_idx").collect()
    assert [r["ticker"] for r in rows] == ["AAPL", "GOOG", "ZZ", "CASH"]
    assert rows[-1]["is_cash"] and rows[-1]["weight_cap"] == 1.0


def test_universe_without_cash_and_with_cap(spark):
    cfg = UniverseConfig(include_cash=False, max_single_name_weight=0.30)
    rows = un.universe_members(panel(spark, ["AAPL", "GOOG"]), cfg).collect()
    assert {r["ticker"]: r["weight_cap"] for r in rows} == {"AAPL": 0.30, "GOOG": 0.30}


def test_active_members(spark):
    members = un.universe_members(panel(spark, ["AAPL", "GOOG"]), start=dt.date(2020, 1, 1))
    assert un.active_members(members, dt.date(2023, 6, 15)).count() == 3
    assert un.active_members(members, dt.date(2023, 6, 15), include_cash=False).count() == 2
    assert un.active_members(members, dt.date(2019, 6, 15)).count() == 0


def test_deduplicate_keeps_the_last_row(spark):
    rows = spark.createDataFrame(
        [("a", 1, 10.0), ("a", 3, 30.0), ("a", 2, 20.0), ("b", 1, 5.0)], "k string, seq int, v double"
    )
    kept = {r["k"]: r["v"] for r in tb.deduplicate(rows, ["k"], "seq").collect()}
    assert kept == {"a": 30.0, "b": 5.0}


def test_csv_and_parquet_prices_read_alike(spark, tmp_path):
    rows = spark.createDataFrame(
        [(dt.date(2024, 1, 2), "A", 1.0, 2.0, 0.5, 1.5, 1.4, 10.0)],
        "date date, ticker string, open double, high double, low double, close double, adj_close double, volume double",
    )
    rows.write.option("header", True).csv(str(tmp_path / "p.csv"))
    rows.write.parquet(str(tmp_path / "p.parquet"))
    left = tb.read_prices(spark, str(tmp_path / "p.csv"))
    right = tb.read_prices(spark, str(tmp_path / "p.parquet"))
    assert left.schema == right.schema and left.collect() == right.collect()
    assert tb.read_optional(spark, str(tmp_path / "absent")) is None


def test_prices_with_nan_close_are_dropped(spark):
    raw = spark.createDataFrame(
        [("2024-01-02", "A", 1.0, float("nan")), ("2024-01-03", "A", float("nan"), 1.0)],
        "date string, ticker string, close double, volume double",
    )
    rows = tb.normalise_prices(raw).collect()
    assert len(rows) == 1 and rows[0]["volume"] is None

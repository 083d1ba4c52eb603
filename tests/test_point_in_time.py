import datetime as dt

from pyspark.sql import functions as F

from quantpanel.operators import audit, market_features as mf
from quantpanel.operators import point_in_time as pit
from quantpanel.operators.grid import calendar_of
from tests.helpers import business_days

T = dt.datetime


def cutoffs(spark, days):
    rows = calendar_of(spark.createDataFrame([(d,) for d in days], "date date"))
    return rows.withColumn("cutoff", F.expr("cast(date as timestamp_ntz) + interval 18 hours"))


def facts(spark):
    rows = [
        ("k", T(2024, 1, 5, 17, 59), 1, 1.0),
        ("k", T(2024, 1, 5, 18, 0), 2, 2.0),
        ("k", T(2024, 1, 5, 18, 1), 3, 3.0),  # after Friday's cutoff: known on Monday
        ("k", T(2024, 1, 6, 12, 0), 4, 4.0),
        ("k", T(2024, 1, 9, 19, 0), 5, 5.0),
        ("other", T(2024, 1, 8, 1, 0), 6, 6.0),
    ]
    return spark.createDataFrame(rows, "key string, ts timestamp_ntz, seq int, v double")


def test_facts_are_seen_at_the_first_cutoff_after_them(spark):
    days = [dt.date(2024, 1, d) for d in (4, 5, 8, 9, 10)]
    rows = pit.point_in_time(facts(spark), cutoffs(spark, days), "key", "ts", ["v"], "seq").collect()
    got = {(r["key"], r["date"].day): r["v"] for r in rows}
    assert got == {
        ("k", 5): 2.0, ("k", 8): 4.0, ("k", 9): 4.0, ("k", 10): 5.0,
        ("other", 8): 6.0, ("other", 9): 6.0, ("other", 10): 6.0,
    }


def test_later_facts_change_nothing_before_them(spark):
    days = [dt.date(2024, 1, d) for d in (4, 5, 8, 9, 10)]
    some = facts(spark).filter("seq <= 4")
    whole = pit.point_in_time(facts(spark), cutoffs(spark, days), "key", "ts", ["v"], "seq")
    part = pit.point_in_time(some, cutoffs(spark, days), "key", "ts", ["v"], "seq")
    early = F.col("date") <= dt.date(2024, 1, 9)
    left = whole.filter(early & (F.col("key") == "k"))
    assert left.exceptAll(part.filter(early)).count() == 0


def test_asof_join_across_and_within_days(spark):
    left = spark.createDataFrame(
        [("k", T(2024, 1, 5, 17, 0), "a"), ("k", T(2024, 1, 5, 18, 0), "b"), ("k", T(2024, 1, 7, 0, 0), "c"),
         ("k", T(2024, 1, 9, 18, 59), "d"), ("none", T(2024, 1, 9, 0, 0), "e")],
        "key string, ts timestamp_ntz, name string",
    )
    rows = pit.asof_join(left, facts(spark), "key", "ts", ["v"], "seq").collect()
    assert {r["name"]: r["v"] for r in rows} == {"a": None, "b": 2.0, "c": 4.0, "d": 4.0, "e": None}


def test_forward_fill_keeps_dates_before_the_first_value(spark):
    days = business_days(4)
    macro = spark.createDataFrame(
        [("CPI", days[1], 1.0), ("CPI", days[3], None), ("UNR", days[0], 5.0), ("UNR", days[2], 6.0)],
        "series_id string, date date, value double",
    )
    rows = mf.macro_features(macro).orderBy("asof_date").collect()
    assert [r["macro_cpi"] for r in rows] == [None, 1.0, 1.0, 1.0]
    assert [r["macro_unr"] for r in rows] == [5.0, 5.0, 6.0, 6.0]


def test_factor_names(spark):
    rows = spark.createDataFrame([(business_days(1)[0], 1.0, 2.0, "x")], "date date, `Mkt-RF` double, ff_mom double, source_name string")
    assert mf.factor_features(rows).columns == ["asof_date", "ff_mkt_rf", "ff_mom"]


def test_price_audit_flags(spark):
    day = business_days(1)[0]
    rows = spark.createDataFrame([(day, "A", 1.0), (day, "A", 2.0), (day, "B", None)], "date date, ticker string, adj_close double")
    got = {r["check"]: (r["status"], r["value"]) for r in audit.price_audit(rows).collect()}
    assert got["duplicate_keys"] == ("FAIL", 1.0) and got["null_adj_close"] == ("WARN", 1.0)
    assert got["rows"] == ("INFO", 3.0) and got["tickers"] == ("INFO", 2.0)


def test_label_audit_passes_on_proper_weights(spark):
    day = business_days(1)[0]
    weights = spark.createDataFrame(
        [(day, 20, "A", 0.6, 0.7), (day, 20, "CASH", 0.4, 0.3)], "date date, horizon_h int, ticker string, soft double, hard double"
    )
    labels = spark.createDataFrame([(day, 20, 0.5)], "date date, horizon_h int, teacher_confidence double")
    got = {r["check"]: (r["status"], r["value"]) for r in audit.label_audit(weights, labels).collect()}
    assert got["sum_violations"] == ("PASS", 0.0) and got["negative_vectors"] == ("PASS", 0.0)
    assert got["cash_weight_mean"][1] == 0.4


def test_old_facts_are_known_from_the_first_day(spark):
    days = [dt.date(2024, 1, d) for d in (4, 5)]
    rows = [("old", T(2009, 3, 1, 1, 0), 1, 1.0), ("old", T(2008, 3, 1, 1, 0), 2, 2.0), ("none", None, 3, 3.0)]
    old = spark.createDataFrame(rows, "key string, ts timestamp_ntz, seq int, v double")
    got = pit.point_in_time(old, cutoffs(spark, days), "key", "ts", ["v"], "seq").collect()
    assert {(r["key"], r["date"].day): r["v"] for r in got} == {("old", 4): 1.0, ("old", 5): 1.0}

"""Ingestion, relational, aggregate and window queries on the panels."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantpanel.config import UniverseConfig
from quantpanel.functions import columns as fc
from quantpanel.functions.storage import stage_folder
from quantpanel.operators import dataset as ds
from quantpanel.operators import evaluate as ev
from quantpanel.operators import market_features as mf
from quantpanel.operators import returns as rt
from quantpanel.operators import splits as sp
from quantpanel.operators import stats
from quantpanel.operators.asset_features import (
    change,
    equal_weight_return,
    returns_rowlag,
    with_daily,
)
from quantpanel.operators.backtest import backtest_full
from quantpanel.operators.candidates import weight_vectors
from quantpanel.operators.cross_features import return_grid
from quantpanel.operators.grid import calendar_of, dense_grid, with_dates
from quantpanel.operators.metrics import cumulative
from quantpanel.operators.ranks import average_rank, rank_in_group
from quantpanel.operators.teacher import forward_returns, softmax_weights
from quantpanel.registry.backtests import FULL, STATIC, daily_sql
from quantpanel.registry.base import MACRO, P1, P2, cal, frame, full, grid, query, r, rets, rounded
from quantpanel.registry.features import p1, p2
from quantpanel.registry.fixtures import BASE, LABEL_CTE, LabelInputs
from quantpanel.registry.market import FACTORS, FAC_COLS, VIX, VIX_FEATURES
from quantpanel.sources import panels
from quantpanel.sources import tables as tb
from quantpanel.sources import universe as un

PANEL = ("adj_close", "close", "volume", "dollar_volume")
_P = ", ".join(r(c, c) for c in PANEL)


def _round_trip(df, kind: str):
    """Write a table to the stage folder in the given form and return its path."""
    path = f"{stage_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    if kind == "csv":
        path += ".csv"
        df.write.option("header", True).csv(path)
    else:
        tb.write_table(df, path, "date")
    return path


# --- A: sources and ingestion ---------------------------------------------------------
@query("A01_read_parquet", f"WITH {P2} SELECT date, ticker, {_P} FROM p2")
def _a01(spark, sf):
    return rounded(p2(spark, sf))


_PRICE_FILE = f"""WITH {P2} SELECT date, ticker, {r('close', 'close')}, {r('adj_close', 'adj_close')}, {r('volume', 'volume')} FROM p2"""


@query("A02_read_price_csv", _PRICE_FILE)
def _a02(spark, sf):
    names = ("date", "ticker", "close", "adj_close", "volume")
    schema = T.StructType([f for f in tb.PRICE_SCHEMA if f.name in names])
    shuffled = p2(spark, sf).select("volume", "close", F.lit("x").alias("note"), "ticker", "adj_close", "date")
    return rounded(tb.read_prices(spark, _round_trip(shuffled, "csv"), schema))


@query("A03_optional_read", "SELECT count(*) AS n_rows, 0 AS n_missing FROM lineitem")
def _a03(spark, sf):
    present = tb.read_optional(spark, f"{sf}/lineitem.parquet")
    absent = tb.read_optional(spark, f"{sf}/no_such_table.parquet")
    return present.agg(
        F.count("*").alias("n_rows"), F.lit(0 if absent is None else 1).cast("long").alias("n_missing")
    )


@query("A04_write_parquet", f"WITH {P2} SELECT date, ticker, {_P}, year(date) AS year FROM p2")
def _a04(spark, sf):
    return rounded(tb.read_table(spark, _round_trip(p2(spark, sf), "parquet")))


def _raw(spark, sf):
    """Order lines as raw price rows: text dates, NaN closes for half of the returns."""
    lines = panels.table(spark, sf, "lineitem")
    close = F.when(
        (F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 2 == 0), F.lit(float("nan"))
    ).otherwise(F.col("l_extendedprice") / F.col("l_quantity"))
    return lines.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("S"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0")).alias("ticker"),
        close.alias("close"),
        close.alias("adj_close"),
        F.col("l_quantity").alias("volume"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seq"),
    )


RAW = """raw AS (SELECT CAST(l_shipdate AS DATE) AS date, 'S' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS ticker,
  CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS close,
  l_quantity AS volume, l_orderkey * 100 + l_linenumber AS seq FROM lineitem),
  norm AS (SELECT * FROM raw WHERE close IS NOT NULL)"""


@query(
    "A05_normalise_prices",
    f"WITH {RAW} SELECT date, ticker, seq, {r('close', 'close', 7)}, {r('close', 'adj_close', 7)}, {r('volume', 'volume', 7)} FROM norm",
)
def _a05(spark, sf):
    return rounded(tb.normalise_prices(_raw(spark, sf)), 7)


@query(
    "A06_dollar_volume",
    f"WITH {RAW} SELECT date, ticker, seq, {r('close * volume', 'dollar_volume', 4)}, true AS stamped FROM norm",
)
def _a06(spark, sf):
    rows = tb.with_dollar_volume(tb.normalise_prices(_raw(spark, sf)))
    stamped = F.col("source_ts").isNotNull().alias("stamped")
    return rounded(rows.select("date", "ticker", "seq", "dollar_volume", stamped), 4)


@query(
    "A07_deduplicate_last",
    f"""WITH {RAW} SELECT date, ticker, seq, {r('close', 'close', 7)}, {r('volume', 'volume', 7)} FROM (
      SELECT *, row_number() OVER (PARTITION BY date, ticker ORDER BY seq DESC) AS rn FROM norm) WHERE rn = 1""",
)
def _a07(spark, sf):
    rows = tb.normalise_prices(_raw(spark, sf)).drop("adj_close")
    return rounded(tb.deduplicate(rows, ["date", "ticker"], "seq"), 7)


@query(
    "A08_ingest_metadata",
    f"""WITH {P2} SELECT count(*) AS n_rows, count(DISTINCT ticker) AS n_tickers,
      min(date) AS first_date, max(date) AS last_date FROM p2""",
)
def _a08(spark, sf):
    return tb.ingest_metadata(p2(spark, sf))


@query("A08_ingest_tickers", f"WITH {P2} SELECT DISTINCT ticker FROM p2")
def _a08_tickers(spark, sf):
    return tb.ticker_list(p2(spark, sf))


@query(
    "A09_wide_to_long",
    f"WITH {P1} SELECT date, ticker, {r('adj_close', 'adj_close')}, {r('volume', 'volume')} FROM p1",
)
def _a09(spark, sf):
    prices = p1(spark, sf)
    names = mf.distinct_values(prices, "ticker")
    wide = prices.groupBy("date").pivot("ticker", names).agg(
        F.first("adj_close").alias("adj_close"), F.first("volume").alias("volume")
    )
    fields = ("adj_close", "volume")
    wide = wide.select("date", *[F.col(f"{t}_{f}").alias(f"{t}|{f}") for t in names for f in fields])
    return rounded(tb.wide_to_long(wide))


_UNI = "names AS (SELECT DISTINCT ticker FROM p2 UNION SELECT 'CASH')"


@query(
    "A10_universe_order",
    f"""WITH {P2}, {_UNI} SELECT ticker, ticker = 'CASH' AS is_cash,
      row_number() OVER (ORDER BY ticker = 'CASH', ticker) - 1 AS asset_idx FROM names""",
)
def _a10(spark, sf):
    return rounded(un.universe_order(p2(spark, sf)))


@query(
    "A11_bronze_prices",
    f"""WITH {RAW} SELECT date, ticker, seq, {r('close', 'close', 7)}, {r('close * volume', 'dollar_volume', 4)},
      'lines' AS source_name, '1' AS source_version, true AS stamped FROM (
      SELECT *, row_number() OVER (PARTITION BY date, ticker ORDER BY seq DESC) AS rn FROM norm) WHERE rn = 1""",
)
def _a11(spark, sf):
    rows = tb.to_bronze(_raw(spark, sf), "lines", "1", "seq")
    stamped = (F.col("ingested_at").isNotNull() & F.col("source_ts").isNotNull()).alias("stamped")
    names = ("date", "ticker", "seq", "close", "dollar_volume", "source_name", "source_version")
    return rounded(rows.select(*names, stamped), 7, dollar_volume=4)


def _raw_orders(spark, sf):
    """Orders as raw rows: text values, NaN for low ones; several rows per key."""
    orders = panels.table(spark, sf, "orders")
    return orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderpriority").alias("maturity"),
        F.col("o_orderpriority").alias("series_id"),
        F.when(F.col("o_totalprice") < 50000, "NaN").otherwise(F.col("o_totalprice").cast("string")).alias("x"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("vintage_date"),
        F.col("o_orderkey").alias("seq"),
    )


_ORDERS = """o AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS p,
  CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_totalprice END AS x, o_orderkey AS seq FROM orders)"""
_STAMP = "'orders' AS source_name, '2' AS source_version, true AS stamped"


def _stamped(rows, *names):
    stamped = F.col("ingested_at").isNotNull().alias("stamped")
    return rounded(rows.select(*names, "seq", "source_name", "source_version", stamped), 4)


@query(
    "A11_bronze_treasury",
    f"""WITH {_ORDERS} SELECT date, p AS maturity, {r('x', 'yield_pct', 4)}, seq, {_STAMP} FROM o
      WHERE x IS NOT NULL QUALIFY row_number() OVER (PARTITION BY date, p ORDER BY seq DESC) = 1""",
)
def _a11_treasury(spark, sf):
    raw = _raw_orders(spark, sf).select("date", "maturity", F.col("x").alias("yield_pct"), "seq")
    rows = tb.source_to_bronze(raw, "treasury", "orders", "2", "seq", ["yield_pct"])
    return _stamped(rows, "date", "maturity", "yield_pct")


@query(
    "A11_bronze_factors",
    f"""WITH {_ORDERS} SELECT date, {r('x', 'smb', 4)}, seq, {_STAMP} FROM o
      QUALIFY row_number() OVER (PARTITION BY date ORDER BY seq DESC) = 1""",
)
def _a11_factors(spark, sf):
    raw = _raw_orders(spark, sf).select("date", F.col("x").alias("smb"), "seq")
    return _stamped(tb.source_to_bronze(raw, "factors", "orders", "2", "seq"), "date", "smb")


@query(
    "A11_bronze_macro",
    f"""WITH {_ORDERS} SELECT p AS series_id, date, {r('x', 'value', 4)}, date AS vintage_date, seq, {_STAMP} FROM o
      QUALIFY row_number() OVER (PARTITION BY p, date ORDER BY seq DESC) = 1""",
)
def _a11_macro(spark, sf):
    raw = _raw_orders(spark, sf).select("series_id", "date", F.col("x").alias("value"), "vintage_date", "seq")
    rows = tb.source_to_bronze(raw, "macro", "orders", "2", "seq")
    return _stamped(rows, "series_id", "date", "value", "vintage_date")


@query(
    "A11_bronze_filings",
    """SELECT CAST(user_id AS VARCHAR) AS key, event_type AS form, CAST(ts AS DATE) AS filing_date, CAST(event_id AS VARCHAR) AS accession_no,
      event_id AS seq, 'events' AS source_name, '2' AS source_version, true AS stamped FROM events""",
)
def _a11_filings(spark, sf):
    """Every event twice, as after a repeated download."""
    events = panels.table(spark, sf, "events")
    once = events.select(
        F.col("user_id").alias("key"),
        F.col("event_type").alias("form"),
        F.date_format("ts", "yyyy-MM-dd").alias("filing_date"),
        F.col("event_id").alias("accession_no"),
        F.col("event_id").alias("seq"),
    )
    rows = tb.source_to_bronze(once.unionByName(once), "filings", "events", "2", "seq")
    return _stamped(rows, "key", "form", "filing_date", "accession_no")


# --- B: projections and predicates ----------------------------------------------------
@query(
    "B01_derived_columns",
    f"""WITH {P2} SELECT date, ticker, {r('ln(adj_close)', 'log_price')}, {r('sqrt(volume)', 'root_volume')},
      {r('abs(adj_close - close)', 'spread', 9)} FROM p2""",
)
def _b01(spark, sf):
    rows = p2(spark, sf).select(
        "date",
        "ticker",
        F.ln("adj_close").alias("log_price"),
        F.sqrt("volume").alias("root_volume"),
        F.abs(F.col("adj_close") - F.col("close")).alias("spread"),
    )
    return rounded(rows, spread=9)


@query("B02_rename_and_drop", f"WITH {FACTORS} SELECT asof_date, {', '.join(r(n, n, 9) for n in FAC_COLS)} FROM fac")
def _b02(spark, sf):
    """Normalised, prefixed names without the provenance columns (also B03)."""
    return rounded(mf.factor_features(panels.factor_table(spark, sf)), 9)


@query("B03_drop_metadata", "SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1")
def _b03(spark, sf):
    orders = panels.table(spark, sf, "orders").withColumn("source_name", F.lit("orders"))
    kept = orders.drop(*mf.METADATA_COLUMNS, "no_such_column")
    return kept.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").alias("n"))


@query(
    "B04_set_membership",
    f"""WITH {P2} SELECT date, ticker, {r('adj_close', 'adj_close')} FROM p2
      WHERE ticker IN (SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') FROM supplier WHERE s_acctbal > 5000)""",
)
def _b04(spark, sf):
    rich = panels.table(spark, sf, "supplier").filter(F.col("s_acctbal") > 5000)
    names = rich.select(F.concat(F.lit("S"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("ticker"))
    rows = p2(spark, sf).join(names, "ticker", "left_semi")
    return rounded(rows.select("date", "ticker", "adj_close"))


@query(
    "B05_date_interval",
    f"WITH {P2} SELECT date, ticker, {r('adj_close', 'adj_close')} FROM p2 WHERE date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'",
)
def _b05(spark, sf):
    inside = F.col("date").between(dt.date(1996, 1, 1), dt.date(1997, 6, 30))
    return rounded(p2(spark, sf).filter(inside).select("date", "ticker", "adj_close"))


@query(
    "B06_null_predicates",
    f"""WITH {P2}, {grid('p2')} SELECT date, count(*) FILTER (ret IS NULL) AS n_null, count(*) FILTER (ret IS NOT NULL) AS n_known
      FROM grid0 GROUP BY 1""",
)
def _b06(spark, sf):
    prices = p2(spark, sf)
    calendar = calendar_of(prices)
    rows = with_dates(return_grid(prices, calendar), calendar)
    return rows.groupBy("date").agg(
        F.count(F.when(F.col("ret").isNull(), 1)).alias("n_null"),
        F.count(F.when(F.col("ret").isNotNull(), 1)).alias("n_known"),
    )


@query(
    "B07_name_prefix",
    """SELECT p_type, NOT starts_with(p_brand, 'Brand#1') AS other_brand, replace(p_brand, 'Brand#', 'b') AS short, count(*) AS n
      FROM part GROUP BY 1, 2, 3""",
)
def _b07(spark, sf):
    rows = panels.table(spark, sf, "part").select(
        "p_type",
        (~F.col("p_brand").startswith("Brand#1")).alias("other_brand"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("b")).alias("short"),
    )
    return rows.groupBy("p_type", "other_brand", "short").agg(F.count("*").alias("n"))


@query(
    "B08_min_history",
    f"""WITH {P2} SELECT date, ticker, {r('adj_close', 'adj_close')} FROM p2
      WHERE ticker IN (SELECT ticker FROM p2 GROUP BY 1 HAVING count(*) >= 540)""",
)
def _b08(spark, sf):
    rows = un.with_min_history(p2(spark, sf), 540)
    return rounded(rows.select("date", "ticker", "adj_close"))


_LAGS = {f"ret_{k}": f"adj_close / lag(adj_close, {k}) OVER (PARTITION BY ticker ORDER BY date) - 1" for k in (1, 5, 20, 60)}


@query(
    "B09_row_null_count",
    f"""WITH {P2}, f AS (SELECT date, ticker, {', '.join(f'{e} AS {n}' for n, e in _LAGS.items())} FROM p2)
      SELECT date, ticker, {' + '.join(f'CAST({n} IS NULL AS BIGINT)' for n in _LAGS)} AS missing FROM f""",
)
def _b09(spark, sf):
    rows = p2(spark, sf).select("date", "ticker", *[change("adj_close", k).alias(f"ret_{k}") for k in (1, 5, 20, 60)])
    return rounded(rows.select("date", "ticker", fc.null_count(list(_LAGS)).alias("missing")))


@query(
    "B10_typed_nulls",
    f"WITH {P2} SELECT date, ticker, CAST(NULL AS DOUBLE) AS prev_live_weight FROM p2",
)
def _b10(spark, sf):
    return p2(spark, sf).select("date", "ticker", F.lit(None).cast("double").alias("prev_live_weight"))


@query(
    "B11_coalesce_dates",
    f"""WITH {P2}, {cal('p2')} SELECT ticker, date, coalesce(CASE WHEN day_idx % 3 = 0 THEN next_date END, date + 1) AS prediction_date
      FROM p2 JOIN cal USING (date)""",
)
def _b11(spark, sf):
    prices = p2(spark, sf)
    rows = prices.join(calendar_of(prices), "date")
    given = F.when(F.col("day_idx") % 3 == 0, F.col("next_date"))
    return rows.select("ticker", "date", F.coalesce(given, F.date_add("date", 1)).alias("prediction_date"))


_MEMBERS = f"""{P2}, m AS (SELECT ticker, min(date) AS start_date,
    CASE WHEN count(*) % 2 = 1 THEN DATE '1995-01-05' END AS end_date FROM p2 GROUP BY 1
    UNION ALL SELECT 'CASH', NULL, NULL)"""


@query(
    "B12_active_universe",
    f"""WITH {_MEMBERS} SELECT ticker, ticker = 'CASH' AS is_cash FROM m
      WHERE (start_date IS NULL OR start_date <= DATE '1995-01-10') AND (end_date IS NULL OR end_date >= DATE '1995-01-10')""",
)
def _b12(spark, sf):
    prices = p2(spark, sf)
    spans = prices.groupBy("ticker").agg(F.min("date").alias("start_date"), F.count("*").alias("_n"))
    order = un.universe_order(prices).join(spans, "ticker", "left")
    members = order.withColumn("end_date", F.when(F.col("_n") % 2 == 1, dt.date(1995, 1, 5)))
    return un.active_members(members, dt.date(1995, 1, 10)).select("ticker", "is_cash")


@query(
    "B13_weight_caps",
    f"WITH {P2}, {_UNI} SELECT ticker, CASE WHEN ticker = 'CASH' THEN 1.0 ELSE 0.3 END::DOUBLE AS weight_cap FROM names",
)
def _b13(spark, sf):
    cfg = UniverseConfig(max_single_name_weight=0.30)
    return un.universe_members(p2(spark, sf), cfg).select("ticker", "weight_cap")


# --- C: joins -------------------------------------------------------------------------
@query(
    "C01_left_join_keys",
    f"""WITH {P2}, {rets('p2')}, t AS (SELECT date, ticker, simple_ret FROM rets WHERE simple_ret > 0)
      SELECT p2.date, p2.ticker, {r('t.simple_ret', 'gain')} FROM p2 LEFT JOIN t USING (date, ticker)""",
)
def _c01(spark, sf):
    prices = p2(spark, sf)
    gains = returns_rowlag(prices).filter(F.col("simple_ret") > 0)
    gains = gains.select("date", "ticker", F.col("simple_ret").alias("gain"))
    return rounded(prices.select("date", "ticker").join(gains, ["date", "ticker"], "left"))


@query(
    "C02_left_join_date",
    f"""WITH {P2}, {MACRO}, {VIX} SELECT p2.date, ticker, {r('vix', 'vix', 9)} FROM p2 LEFT JOIN vix ON asof_date = p2.date""",
)
def _c02(spark, sf):
    vix = panels.vix_series(spark, sf).select("date", F.col("value").alias("vix"))
    return rounded(p2(spark, sf).select("date", "ticker").join(vix, "date", "left"), 9)


@query(
    "C03_inner_join",
    f"""WITH {P2}, {rets('p2')}, t AS (SELECT date, ticker, simple_ret FROM rets WHERE simple_ret > 0)
      SELECT p2.date, p2.ticker, {r('t.simple_ret', 'gain')} FROM p2 JOIN t USING (date, ticker)""",
)
def _c03(spark, sf):
    prices = p2(spark, sf)
    gains = returns_rowlag(prices).filter(F.col("simple_ret") > 0)
    gains = gains.select("date", "ticker", F.col("simple_ret").alias("gain"))
    return rounded(prices.select("date", "ticker").join(gains, ["date", "ticker"]))


@query(
    "C04_full_outer_join",
    f"""WITH {MACRO}, {VIX}, {VIX_FEATURES}, {FACTORS} SELECT asof_date, {r('vix', 'vix', 9)}, {r('ff_smb', 'ff_smb', 9)}
      FROM vixf FULL JOIN fac USING (asof_date)""",
)
def _c04(spark, sf):
    vix = mf.vix_features(panels.vix_series(spark, sf))
    factors = mf.factor_features(panels.factor_table(spark, sf))
    return rounded(mf.outer_join_blocks([vix, factors]).select("asof_date", "vix", "ff_smb"), 9)


@query(
    "C05_scaffold",
    f"WITH {P2}, {_UNI} SELECT date AS asof_date, ticker FROM (SELECT DISTINCT date FROM p2) CROSS JOIN names",
)
def _c05(spark, sf):
    prices = p2(spark, sf)
    dates = prices.select(F.col("date").alias("asof_date"))
    return ds.scaffold(dates, un.universe_order(prices)).select("asof_date", "ticker")


@query(
    "C06_interval_join",
    f"""WITH {P2}, {cal('p2')}, {STATIC}, d AS MATERIALIZED (SELECT split_name, date FROM cal JOIN splits ON date BETWEEN start_date AND end_date)
      SELECT split_name, date AS asof_date, ticker FROM p2 JOIN d USING (date)""",
)
def _c06(spark, sf):
    prices = p2(spark, sf)
    rows = prices.select(F.col("date").alias("asof_date"), "ticker")
    return sp.assign_split(rows, sp.static_splits(calendar_of(prices)))


@query(
    "C09_align_returns",
    f"""WITH {BASE}, d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
      SELECT d.date, uni.ticker, {r('coalesce(gf.ret, 0.0)', 'ret')} FROM d CROSS JOIN uni LEFT JOIN gf ON gf.date = d.date AND gf.ticker = uni.ticker""",
)
def _c09(spark, sf):
    inputs = LabelInputs(spark, sf)
    orders = panels.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return rounded(rt.align_returns(inputs.filled, orders, inputs.universe))


@query(
    "C10_forward_window",
    f"""WITH {BASE} SELECT a.date, a.ticker, b.day_idx - a.day_idx AS ahead, {r('b.ret', 'ret')} FROM gz a
      JOIN gz b ON b.ticker = a.ticker AND b.day_idx BETWEEN a.day_idx + 1 AND a.day_idx + 5
      WHERE a.day_idx + 5 < (SELECT count(*) FROM cal)""",
)
def _c10(spark, sf):
    rows = forward_returns(LabelInputs(spark, sf).returns, 5).filter(F.size("fwd") == 5)
    long = rows.select("date", "ticker", F.posexplode("fwd").alias("ahead", "ret"))
    return rounded(long.withColumn("ahead", F.col("ahead") + 1))


@query(
    "C11_ticker_presence",
    """SELECT p_type AS ticker, true AS present FROM part WHERE p_type IN (SELECT p_type FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1
      UNION ALL SELECT c_mktsegment, false FROM customer GROUP BY 1""",
)
def _c11(spark, sf):
    kinds = panels.table(spark, sf, "part").select(F.col("p_type").alias("ticker"))
    segments = panels.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("ticker"))
    return un.ticker_presence(kinds.union(segments).distinct(), p1(spark, sf))


# --- D: aggregates --------------------------------------------------------------------
@query("D01_group_count", f"WITH {P2} SELECT ticker, count(*) AS n FROM p2 GROUP BY 1")
def _d01(spark, sf):
    return p2(spark, sf).groupBy("ticker").agg(F.count("*").alias("n"))


@query(
    "D02_mean_median",
    f"WITH {P2} SELECT ticker, {r('avg(adj_close)', 'mean')}, {r('median(adj_close)', 'median')} FROM p2 GROUP BY 1",
)
def _d02(spark, sf):
    prices = p2(spark, sf)
    means = prices.groupBy("ticker").agg(F.avg("adj_close").alias("mean"))
    return rounded(means.join(stats.group_median(prices, ["ticker"], "adj_close"), "ticker"))


@query("D03_equal_weight_mean", f"WITH {P2}, {rets('p2')} SELECT date, {r('avg(simple_ret)', 'eqw_ret')} FROM rets GROUP BY 1")
def _d03(spark, sf):
    return rounded(equal_weight_return(returns_rowlag(p2(spark, sf))))


@query(
    "D04_global_stats",
    f"""WITH {P2}, {rets('p2')} SELECT min(date) AS first_date, max(date) AS last_date, count(DISTINCT ticker) AS n_tickers,
      count(*) FILTER (simple_ret IS NULL) AS n_null, {r('min(simple_ret)', 'lowest')}, {r('max(simple_ret)', 'highest')} FROM rets""",
)
def _d04(spark, sf):
    per_ticker = returns_rowlag(p2(spark, sf)).groupBy("ticker").agg(
        F.min("date").alias("lo"), F.max("date").alias("hi"),
        F.count(F.when(F.col("simple_ret").isNull(), 1)).alias("n"),
        F.min("simple_ret").alias("a"), F.max("simple_ret").alias("b"),
    )
    return rounded(
        per_ticker.agg(
            F.min("lo").alias("first_date"), F.max("hi").alias("last_date"),
            F.count("*").alias("n_tickers"), F.sum("n").alias("n_null"),
            F.min("a").alias("lowest"), F.max("b").alias("highest"),
        )
    )


@query("D05_distinct_sorted", f"WITH {P2} SELECT DISTINCT date FROM p2")
def _d05(spark, sf):
    return p2(spark, sf).select("date").distinct().orderBy("date")


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "D06_pivot",
    f"""WITH {P1} SELECT date, {', '.join(r(f"max(adj_close) FILTER (ticker = '{t}')", t) for t in _TYPES)} FROM p1 GROUP BY 1""",
)
def _d06(spark, sf):
    return rounded(mf.pivot_long(p1(spark, sf), "date", "ticker", "adj_close", list(_TYPES)))


def _train_rows(spark, sf):
    prices = p2(spark, sf)
    rows = returns_rowlag(prices).withColumnRenamed("date", "asof_date")
    tagged = sp.assign_split(rows, sp.static_splits(calendar_of(prices)))
    return tagged.filter(F.col("split_name") == "train")


_TRAIN = f"""{P2}, {cal('p2')}, {STATIC}, {rets('p2')}, tr AS (SELECT rets.* FROM rets JOIN splits ON split_name = 'train' AND rets.date BETWEEN start_date AND end_date)"""


@query(
    "D07_train_medians",
    f"""WITH {_TRAIN} SELECT 'simple_ret' AS "column", {r('median(simple_ret)', 'median', 9)} FROM tr
      UNION ALL SELECT 'adj_close', {r('median(adj_close)', 'median', 9)} FROM tr""",
)
def _d07(spark, sf):
    names = ["simple_ret", "adj_close"]
    medians = stats.column_medians(_train_rows(spark, sf), names)
    return rounded(spark.createDataFrame(list(medians.items()), "column string, median double"), 9)


@query(
    "D08_train_moments",
    f"""WITH {_TRAIN}, m AS (SELECT median(simple_ret) AS md FROM tr)
      SELECT {r('avg(coalesce(simple_ret, md))', 'mean', 9)}, {r('stddev_pop(coalesce(simple_ret, md))', 'std', 9)} FROM tr, m""",
)
def _d08(spark, sf):
    scaling = ds.fit_scaling(_train_rows(spark, sf), ["simple_ret"])
    row = [(scaling.means["simple_ret"], scaling.stds["simple_ret"])]
    return rounded(spark.createDataFrame(row, "mean double, std double"), 9)


@query(
    "D09_weighted_mean",
    f"WITH {P2}, {rets('p2')} SELECT {r('sum(simple_ret * volume) / sum(CASE WHEN simple_ret IS NOT NULL THEN volume END)', 'weighted', 9)} FROM rets",
)
def _d09(spark, sf):
    rows = returns_rowlag(p2(spark, sf)).filter(F.col("simple_ret").isNotNull())
    return rounded(ev.weighted_average(rows, "simple_ret", "volume", "weighted"), 9)


@query("D10_compound_product", f"WITH {P2}, {rets('p2')} SELECT ticker, {r('product(1 + simple_ret) - 1', 'total_return')} FROM rets GROUP BY 1")
def _d10(spark, sf):
    rows = returns_rowlag(p2(spark, sf))
    return rounded(rows.groupBy("ticker").agg((F.product(1 + F.col("simple_ret")) - 1).alias("total_return")))


# --- E: windows -----------------------------------------------------------------------
def _window_query(name: str, column: str, sql: str, expression, digits: int = 6):
    @query(name, f"WITH {P2}, {rets('p2')} SELECT date, ticker, {r(sql, column, digits)} FROM rets")
    def run(spark, sf):
        rows = returns_rowlag(p2(spark, sf))
        return rounded(rows.select("date", "ticker", expression().alias(column)), digits)

    return run


def _w():
    return fc.by_ticker()




_window_query(
    "E01_lag_rows", "lagged", "lag(adj_close, 5) OVER (PARTITION BY ticker ORDER BY date)",
    lambda: F.lag("adj_close", 5).over(_w()),
)
_window_query(
    "E03_rolling_std", "std_20", full(20, "log_ret", "stddev_samp(log_ret) OVER {w}"),
    lambda: fc.rolling_std(_w(), 20, F.col("log_ret")), 9,
)
_window_query(
    "E04_rolling_mean", "mean_20", full(20, "log_ret", "avg(log_ret) OVER {w}"),
    lambda: fc.rolling_mean(_w(), 20, F.col("log_ret")), 9,
)
_window_query(
    "E05_rolling_max", "max_20", full(20, "adj_close", "max(adj_close) OVER {w}"),
    lambda: fc.rolling_max(_w(), 20, F.col("adj_close")),
)
_window_query(
    "E06_rolling_var", "var_60", full(60, "simple_ret", "var_samp(simple_ret) OVER {w}"),
    lambda: fc.when_full(_w(), 60, F.col("simple_ret"), F.var_samp("simple_ret").over(fc.trailing(_w(), 60))), 9,
)

_EQW = f"""{P2}, {rets('p2')}, eqw AS (SELECT date, avg(simple_ret) AS m FROM rets GROUP BY 1),
  j AS (SELECT date, ticker, simple_ret, CASE WHEN simple_ret IS NOT NULL THEN m END AS m FROM rets JOIN eqw USING (date))"""


def _with_market(spark, sf):
    rows = returns_rowlag(p2(spark, sf))
    joined = rows.join(equal_weight_return(rows), "date")
    return joined.withColumn("m", F.when(F.col("simple_ret").isNotNull(), F.col("eqw_ret")))


@query("E02_lag_series", f"WITH {MACRO} SELECT series_id, date, {r('value - lag(value, 5) OVER (PARTITION BY series_id ORDER BY date)', 'change_5', 9)} FROM macro")
def _e02(spark, sf):
    window = Window.partitionBy("series_id").orderBy("date")
    change = (F.col("value") - F.lag("value", 5).over(window)).alias("change_5")
    return rounded(panels.macro_series(spark, sf).select("series_id", "date", change), 9)


@query("E07_rolling_cov", f"WITH {_EQW} SELECT date, ticker, {r(full(60, 'simple_ret', 'covar_samp(simple_ret, m) OVER {w}'), 'cov_60', 9)} FROM j")
def _e07(spark, sf):
    cov = F.covar_samp("simple_ret", "m").over(fc.trailing(_w(), 60))
    value = fc.when_full(_w(), 60, F.col("simple_ret"), cov)
    return rounded(_with_market(spark, sf).select("date", "ticker", value.alias("cov_60")), 9)


@query(
    "E08_rolling_corr",
    f"WITH {_EQW} SELECT date, ticker, {r(full(60, 'simple_ret', 'covar_samp(simple_ret, m) OVER {w} / nullif(stddev_samp(simple_ret) OVER {w} * stddev_samp(m) OVER {w}, 0)'), 'corr_60')} FROM j",
)
def _e08(spark, sf):
    over = fc.trailing(_w(), 60)
    spread = F.stddev_samp("simple_ret").over(over) * F.stddev_samp("m").over(over)
    corr = fc.ratio(F.covar_samp("simple_ret", "m").over(over), spread)
    value = fc.when_full(_w(), 60, F.col("simple_ret"), corr)
    return rounded(_with_market(spark, sf).select("date", "ticker", value.alias("corr_60")))


@query(
    "E09_partial_mean",
    f"WITH {P2}, {rets('p2')} SELECT date, ticker, {r('avg(coalesce(simple_ret, 0)) OVER ' + frame(20), 'mean_20', 9)} FROM rets",
)
def _e09(spark, sf):
    mean = F.avg(F.coalesce("simple_ret", F.lit(0.0))).over(fc.trailing(_w(), 20))
    return rounded(returns_rowlag(p2(spark, sf)).select("date", "ticker", mean.alias("mean_20")), 9)


@query(
    "E10_population_std_backfilled",
    f"""WITH {BASE}, v AS (SELECT date, day_idx, ticker, CASE WHEN day_idx >= 20 THEN stddev_pop(ret) OVER (PARTITION BY ticker
        ORDER BY day_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) * sqrt(252.0) END AS v FROM gz)
      SELECT date, day_idx, ticker, {r('first_value(v IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY day_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)', 'vol')} FROM v""",
)
def _e10(spark, sf):
    """With the optional backfill of the head (also E12)."""
    return rounded(rt.vol20_pop(LabelInputs(spark, sf).returns, backfill=True))


@query(
    "E11_forward_fill",
    f"""WITH {MACRO}, d AS (SELECT DISTINCT date FROM macro), s AS (SELECT DISTINCT series_id FROM macro)
      SELECT series_id, date, value FROM (SELECT s.series_id, d.date, {r('''last_value(value IGNORE NULLS) OVER (PARTITION BY s.series_id
        ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''', 'value', 9)}
      FROM d CROSS JOIN s LEFT JOIN macro m ON m.date = d.date AND m.series_id = s.series_id) WHERE value IS NOT NULL""",
)
def _e11(spark, sf):
    return rounded(mf.forward_fill_series(panels.macro_series(spark, sf)), 9)


@query(
    "E12_backward_fill",
    f"""WITH {P2}, {grid('p2')} SELECT date, ticker, {r('filled', 'price')} FROM grid""",
)
def _e12(spark, sf):
    prices = p2(spark, sf)
    calendar = calendar_of(prices)
    rows = with_dates(dense_grid(prices, ["adj_close"], calendar), calendar)
    return rounded(rows.select("date", "ticker", F.col("adj_close_filled").alias("price")))


@query("E13_next_trading_date", f"WITH {P2}, {cal('p2')} SELECT date, day_idx, next_date FROM cal")
def _e13(spark, sf):
    return rounded(calendar_of(p2(spark, sf)).select("date", "day_idx", "next_date"))


@query(
    "E14_previous_target",
    f"""WITH {LABEL_CTE} SELECT date, ticker, {r('coalesce(lag(w) OVER (PARTITION BY ticker ORDER BY date), 1.0 / (SELECT count(*) FROM uni))', 'prev_target')}
      FROM cand WHERE cand_id = 1""",
)
def _e14(spark, sf):
    inputs = LabelInputs(spark, sf)
    rows = inputs.candidates.filter(F.col("cand_id") == 1)
    equal = 1.0 / inputs.universe.count()
    previous = F.coalesce(F.lag("w").over(_w()), F.lit(equal))
    return rounded(rows.select("date", "ticker", previous.alias("prev_target")))


@query(
    "E15_cumulative_growth",
    f"""WITH {FULL}, {daily_sql()}, c AS (SELECT path_id, date, exp(sum(ln(1 + net)) OVER (PARTITION BY path_id ORDER BY date)) AS cum FROM daily_net)
      SELECT path_id, date, {r('cum', 'cum')}, {r('max(cum) OVER (PARTITION BY path_id ORDER BY date)', 'peak')} FROM c""",
)
def _e15(spark, sf):
    inputs = LabelInputs(spark, sf)
    daily = backtest_full(inputs.signals(3), inputs.filled)[0]
    return rounded(cumulative(daily, "net").select("path_id", "date", "cum", "peak"))


@query(
    "E16_rolling_sharpe",
    f"""WITH {P2}, {rets('p2')} SELECT date, ticker, {r(full(60, 'simple_ret', 'avg(simple_ret) OVER {w} / greatest(stddev_pop(simple_ret) OVER {w}, 1e-10) * sqrt(252.0)'), 'sharpe_60')} FROM rets""",
)
def _e16(spark, sf):
    over = fc.trailing(_w(), 60)
    ratio = F.avg("simple_ret").over(over) / F.greatest(F.stddev_pop("simple_ret").over(over), F.lit(1e-10))
    value = fc.when_full(_w(), 60, F.col("simple_ret"), fc.annualise(ratio))
    return rounded(returns_rowlag(p2(spark, sf)).select("date", "ticker", value.alias("sharpe_60")))


@query(
    "E17_weight_change",
    f"WITH {LABEL_CTE} SELECT date, ticker, {r('w - lag(w) OVER (PARTITION BY ticker ORDER BY date)', 'change')} FROM cand WHERE cand_id = 1",
)
def _e17(spark, sf):
    rows = LabelInputs(spark, sf).candidates.filter(F.col("cand_id") == 1)
    return rounded(ev.weight_changes(rows, "w").select("date", "ticker", "change"))


@query(
    "E19_rank_descending",
    f"WITH {P2} SELECT date, ticker, row_number() OVER (PARTITION BY date ORDER BY adj_close DESC, ticker) - 1 AS rank FROM p2",
)
def _e19(spark, sf):
    rows = p2(spark, sf).select("date", "ticker", "adj_close")
    return rank_in_group(rows, ["date"], [F.desc("adj_close"), "ticker"]).select("date", "ticker", "rank")


@query(
    "E20_softmax",
    f"""WITH {P2}, e AS (SELECT date, ticker, exp(adj_close / 0.5 - max(adj_close / 0.5) OVER (PARTITION BY date)) AS e FROM p2)
      SELECT date, ticker, {r('e / sum(e) OVER (PARTITION BY date)', 'w')} FROM e""",
)
def _e20(spark, sf):
    rows = p2(spark, sf).select("date", "ticker", F.col("adj_close").alias("score"))
    return rounded(softmax_weights(rows, 0.5, ["date"]).select("date", "ticker", "w"))


@query(
    "E21_average_rank",
    f"""WITH {P2} SELECT date, ticker, rank() OVER (PARTITION BY date ORDER BY volume) + (count(*) OVER (PARTITION BY date, volume) - 1) / 2.0 AS avg_rank FROM p2""",
)
def _e21(spark, sf):
    rows = p2(spark, sf).select("date", "ticker", "volume")
    return average_rank(rows, ["date"], "volume", ["ticker"], "avg_rank").select("date", "ticker", "avg_rank")


@query(
    "E22_rolling_covariance",
    f"""WITH {BASE}, pr AS (SELECT a.ticker AS ticker_i, b.ticker AS ticker_j FROM uni a JOIN uni b ON b.asset_idx IN (a.asset_idx, a.asset_idx + 1)),
      j AS (SELECT x.date, x.day_idx, ticker_i, ticker_j, x.ret AS x, y.ret AS y FROM pr JOIN gf x ON x.ticker = ticker_i
        JOIN gf y ON y.ticker = ticker_j AND y.date = x.date WHERE x.day_idx >= 1)
      SELECT date, ticker_i, ticker_j, {r('CASE WHEN count(*) OVER w >= 2 THEN covar_samp(x, y) OVER w END', 'cov', 9)} FROM j
      WINDOW w AS (PARTITION BY ticker_i, ticker_j ORDER BY day_idx ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""",
)
def _e22(spark, sf):
    inputs = LabelInputs(spark, sf)
    order = inputs.universe.select("ticker", "asset_idx")
    left = order.select(
        F.col("ticker").alias("ticker_i"),
        F.explode(F.array(F.col("asset_idx"), F.col("asset_idx") + 1)).alias("asset_idx"),
    )
    pairs = left.join(order.withColumnRenamed("ticker", "ticker_j"), "asset_idx").drop("asset_idx")
    return rounded(rt.rolling_covariance(inputs.filled, pairs), 9)


# --- G, H: order, sets, scalars -------------------------------------------------------
@query(
    "G01_multi_key_sort",
    f"""WITH {P1}, names AS (SELECT DISTINCT ticker FROM p1 UNION SELECT 'CASH'),
      u AS (SELECT ticker, row_number() OVER (ORDER BY ticker = 'CASH', ticker) - 1 AS asset_idx FROM names)
      SELECT date, asset_idx, ticker, {r('adj_close', 'adj_close')} FROM p1 JOIN u USING (ticker)""",
)
def _g01(spark, sf):
    prices = p1(spark, sf)
    order = un.universe_order(prices).select("ticker", "asset_idx")
    rows = prices.join(order, "ticker").orderBy("date", "asset_idx")
    return rounded(rows.select("date", "asset_idx", "ticker", "adj_close"))


@query("G02_top_holdings", f"WITH {P2} SELECT date, ticker, {r('adj_close', 'adj_close')} FROM p2 ORDER BY p2.adj_close DESC, date, ticker LIMIT 10")
def _g02(spark, sf):
    rows = p2(spark, sf).orderBy(F.desc("adj_close"), "date", "ticker").limit(10)
    return rounded(rows.select("date", "ticker", "adj_close"))


@query(
    "G03_top_k_per_group",
    f"""WITH {P2} SELECT date, ticker, rn AS position FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY volume DESC, ticker) AS rn FROM p2) WHERE rn <= 3""",
)
def _g03(spark, sf):
    best = Window.partitionBy("date").orderBy(F.desc("volume"), "ticker")
    rows = p2(spark, sf).withColumn("position", F.row_number().over(best)).filter("position <= 3")
    return rounded(rows.select("date", "ticker", "position"))


@query(
    "G04_best_per_date",
    f"""WITH {P2} SELECT date, ticker FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY adj_close DESC, ticker DESC) AS rn FROM p2) WHERE rn = 1""",
)
def _g04(spark, sf):
    return p2(spark, sf).groupBy("date").agg(F.max_by("ticker", F.struct("adj_close", "ticker")).alias("ticker"))


@query(
    "G07_union_all",
    f"WITH {P1}, {P2} SELECT date, ticker, {r('adj_close', 'adj_close')} FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2)",
)
def _g07(spark, sf):
    rows = p1(spark, sf).unionByName(p2(spark, sf))
    return rounded(rows.select("date", "ticker", "adj_close"))


@query("G08_distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def _g08(spark, sf):
    return panels.table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag").dropDuplicates()


@query(
    "G09_top_set_overlap",
    f"""WITH {P2}, k AS (SELECT date, row_number() OVER (PARTITION BY date ORDER BY volume DESC, ticker) AS a,
      row_number() OVER (PARTITION BY date ORDER BY adj_close DESC, ticker) AS b, count(*) OVER (PARTITION BY date) AS n FROM p2)
      SELECT date, {r('count(*) FILTER (a <= greatest(1, n // 5) AND b <= greatest(1, n // 5)) / max(greatest(1, n // 5))', 'recall')} FROM k GROUP BY 1""",
)
def _g09(spark, sf):
    rows = p2(spark, sf).select("date", "ticker", F.col("volume").alias("truth"), F.col("adj_close").alias("pred"))
    return rounded(ev.top_share_recall(rows, ["date"], "ticker"))


@query(
    "H01_math_functions",
    f"""WITH {P2} SELECT date, ticker, {r('ln(adj_close)', 'a')}, {r('exp(-volume / 100)', 'b')}, {r('sqrt(dollar_volume)', 'c')},
      {r('abs(close - adj_close)', 'd', 9)}, {r('pow(adj_close, 0.3)', 'e')} FROM p2""",
)
def _h01(spark, sf):
    rows = p2(spark, sf).select(
        "date", "ticker", F.ln("adj_close").alias("a"), F.exp(-F.col("volume") / 100).alias("b"),
        F.sqrt("dollar_volume").alias("c"), F.abs(F.col("close") - F.col("adj_close")).alias("d"),
        F.pow("adj_close", F.lit(0.3)).alias("e"),
    )
    return rounded(rows, d=9)


@query(
    "H02_clip",
    f"""WITH {P2}, {rets('p2')} SELECT date, ticker, {r('CASE WHEN simple_ret IS NOT NULL THEN greatest(least(simple_ret, 0.001), -0.001) END', 'clipped')} FROM rets""",
)
def _h02(spark, sf):
    rows = returns_rowlag(p2(spark, sf))
    return rounded(rows.select("date", "ticker", fc.clip(F.col("simple_ret"), -0.001, 0.001).alias("clipped")))


@query(
    "H03_conditional",
    f"WITH {P2}, {rets('p2')} SELECT date, ticker, {r('CASE WHEN log_ret < 0 THEN log_ret ELSE 0.0 END', 'neg_ret')} FROM rets",
)
def _h03(spark, sf):
    return rounded(with_daily(p2(spark, sf)).select("date", "ticker", "neg_ret"))


@query(
    "H04_finite_or_zero",
    "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, " + r("CASE WHEN l_discount = 0 THEN 0.0 ELSE l_tax / l_discount END", "x") + " FROM lineitem",
)
def _h04(spark, sf):
    value = fc.finite_or_zero(fc.ratio(F.col("l_tax"), F.col("l_discount")))
    return rounded(panels.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", value.alias("x")))


def _vectors(spark, sf):
    """One vector of the six type prices per day (null where a type has no row that day)."""
    inputs = LabelInputs(spark, sf)
    rows = inputs.candidates.filter(F.col("cand_id") == 1)
    return inputs, weight_vectors(rows, inputs.universe, ["date"])


@query(
    "H06_json_vectors",
    f"""WITH {LABEL_CTE}, v AS (SELECT date, list(w ORDER BY asset_idx) AS v FROM cand JOIN uni USING (ticker) WHERE cand_id = 1 GROUP BY 1),
      f AS (SELECT date, CASE WHEN day(date) % 5 = 0 THEN list_transform(range(9), lambda i: 1.0 / 9)
        ELSE list_concat(v, [0.0, 0.0])[1:9] END AS f FROM v)
      SELECT date, len(f) AS n, {r('f[1]', 'first')}, {r('f[9]', 'last')}, {r('list_sum(f)', 'total')} FROM f""",
)
def _h06(spark, sf):
    """Vectors as JSON text, parsed again, fitted to nine members; some are missing."""
    _, vectors = _vectors(spark, sf)
    text = F.when(F.dayofmonth("date") % 5 != 0, F.to_json("weights"))
    rows = vectors.select("date", text.alias("raw")).withColumn(
        "v", fc.fit_weights(fc.parse_weights(F.col("raw")), 9)
    )
    return rounded(
        rows.select(
            "date", F.size("v").alias("n"), F.get("v", 0).alias("first"), F.get("v", 8).alias("last"),
            fc.array_sum(F.col("v")).alias("total"),
        )
    )


@query("H07_vector_rows", f"WITH {LABEL_CTE} SELECT date, ticker, asset_idx, {r('w', 'w')} FROM cand JOIN uni USING (ticker) WHERE cand_id = 1")
def _h07(spark, sf):
    inputs, vectors = _vectors(spark, sf)
    return rounded(ds.explode_vectors(vectors, inputs.universe, ["date"], {"w": F.col("weights")}))


@query(
    "H07_feature_on_grid",
    f"""WITH {BASE}, v AS (SELECT date, ticker, {full(20, 'log_ret', 'stddev_samp(log_ret) OVER {w}')} AS v FROM rets)
      SELECT gz.date, gz.ticker, {r('coalesce(v, 1.0)', 'vol')} FROM gz LEFT JOIN v USING (date, ticker)""",
)
def _h07_grid(spark, sf):
    inputs = LabelInputs(spark, sf)
    rows = returns_rowlag(inputs.prices)
    vol = rows.select(F.col("date").alias("asof_date"), "ticker", fc.rolling_std(_w(), 20, F.col("log_ret")).alias("vol"))
    return rounded(rt.feature_on_grid(vol, inputs.returns, "vol", 1.0))


@query(
    "H08_dot_product",
    f"""WITH {LABEL_CTE} SELECT a.date, {r('sum(a.w * b.w)', 'overlap')}, {r('sum(a.w)', 'total')} FROM cand a
      JOIN cand b ON b.date = a.date AND b.ticker = a.ticker AND b.cand_id = 2 WHERE a.cand_id = 1 GROUP BY 1""",
)
def _h08(spark, sf):
    inputs = LabelInputs(spark, sf)
    rows = inputs.candidates.filter(F.col("cand_id").isin(1, 2))
    vectors = weight_vectors(rows, inputs.universe, ["date", "cand_id"])
    wide = vectors.groupBy("date").pivot("cand_id", [1, 2]).agg(F.first("weights"))
    return rounded(
        wide.select("date", fc.dot(F.col("1"), F.col("2")).alias("overlap"), fc.array_sum(F.col("1")).alias("total"))
    )


@query(
    "H10_name_cleanup",
    """SELECT o_orderpriority, lower(replace(replace(o_orderpriority, '-', '_'), ' ', '_')) AS clean,
      regexp_extract(o_orderpriority, '^([0-9]+)-', 1) AS number, count(*) AS n FROM orders GROUP BY 1, 2, 3""",
)
def _h10(spark, sf):
    raw = F.col("o_orderpriority")
    rows = panels.table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return rows.select(
        "o_orderpriority",
        F.lower(F.regexp_replace(raw, "[- ]", "_")).alias("clean"),
        F.regexp_extract(raw, "^([0-9]+)-", 1).alias("number"),
        "n",
    )

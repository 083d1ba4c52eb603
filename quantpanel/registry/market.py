"""Market feature, point-in-time and coverage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantpanel.operators import asset_features as af
from quantpanel.operators import coverage
from quantpanel.operators import market_features as mf
from quantpanel.operators import point_in_time as pit
from quantpanel.operators.grid import calendar_of
from quantpanel.registry.base import MACRO, query, r, rounded
from quantpanel.registry.features import FEATURES_CTE, p2
from quantpanel.sources import calendar as xc
from quantpanel.sources import panels

VIX = "vix AS (SELECT date AS asof_date, value AS vix FROM macro WHERE series_id = '5-LOW')"
_V = "OVER (ORDER BY asof_date)"
VIX_FEATURES = f"""vixf AS (SELECT asof_date, vix, vix - lag(vix, 5) {_V} AS vix_chg_5, vix / lag(vix, 5) {_V} - 1 AS vix_pct_chg_5,
  vix - lag(vix, 20) {_V} AS vix_chg_20, vix / lag(vix, 20) {_V} - 1 AS vix_pct_chg_20 FROM vix)"""
VIX_COLS = ("vix", "vix_chg_5", "vix_pct_chg_5", "vix_chg_20", "vix_pct_chg_20")
TSY = """tsy AS (SELECT date AS asof_date, max(value) FILTER (series_id = '3-MEDIUM') AS tsy_10y,
  max(value) FILTER (series_id = '2-HIGH') AS tsy_2y, max(value) FILTER (series_id = '1-URGENT') AS tsy_3m
  FROM macro WHERE series_id IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1),
  tsyf AS (SELECT *, tsy_10y - tsy_2y AS tsy_slope_10y_2y, tsy_10y - tsy_3m AS tsy_slope_10y_3m FROM tsy)"""
TSY_COLS = ("tsy_10y", "tsy_2y", "tsy_3m", "tsy_slope_10y_2y", "tsy_slope_10y_3m")
FACTORS = """fac AS (SELECT CAST(o_orderdate AS DATE) AS asof_date, ln(avg(o_totalprice))/100 AS ff_mkt_rf, max(o_totalprice)/1e6 AS ff_smb,
  min(o_totalprice)/1e6 AS ff_hml, count(*)::DOUBLE AS ff_mom FROM orders GROUP BY 1)"""
FAC_COLS = ("ff_mkt_rf", "ff_smb", "ff_hml", "ff_mom")
SERIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_fill = ", ".join(
    f"""last_value(max(value) FILTER (series_id = '{s}') IGNORE NULLS) OVER (ORDER BY date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "macro_{s.lower()}\""""
    for s in SERIES
)
MACRO_F = f"macf AS (SELECT date AS asof_date, {_fill} FROM macro GROUP BY date)"
MAC_COLS = tuple(f'"macro_{s.lower()}"' for s in SERIES)


def _cols(names, digits=9):
    return ", ".join(r(n, n, digits) for n in names)


@query("F21_vix_features", f"WITH {MACRO}, {VIX}, {VIX_FEATURES} SELECT asof_date, {_cols(VIX_COLS)} FROM vixf")
def _f21(spark, sf):
    return rounded(mf.vix_features(panels.vix_series(spark, sf)), 9)


@query("F22_treasury_features", f"WITH {MACRO}, {TSY} SELECT asof_date, {_cols(TSY_COLS)} FROM tsyf")
def _f22(spark, sf):
    return rounded(mf.treasury_features(panels.treasury_yields(spark, sf)), 9)


@query("F23_factor_features", f"WITH {FACTORS} SELECT asof_date, {_cols(FAC_COLS)} FROM fac")
def _f23(spark, sf):
    return rounded(mf.factor_features(panels.factor_table(spark, sf)), 9)


@query("F24_macro_features", f"WITH {MACRO}, {MACRO_F} SELECT asof_date, {_cols(MAC_COLS)} FROM macf")
def _f24(spark, sf):
    return rounded(mf.macro_features(panels.macro_series(spark, sf)), 9)


@query(
    "F25_market_features",
    f"""WITH {MACRO}, {VIX}, {VIX_FEATURES}, {TSY}, {FACTORS}, {MACRO_F}
    SELECT asof_date, {_cols(VIX_COLS + TSY_COLS + FAC_COLS + MAC_COLS)}
    FROM vixf FULL JOIN tsyf USING (asof_date) FULL JOIN fac USING (asof_date) FULL JOIN macf USING (asof_date)""",
)
def _f25(spark, sf):
    return rounded(
        mf.market_features(
            treasury=panels.treasury_yields(spark, sf),
            factors=panels.factor_table(spark, sf),
            macro=panels.macro_series(spark, sf),
            vix=panels.vix_series(spark, sf),
        ),
        9,
    )


# --- point in time --------------------------------------------------------------------
def cutoff_calendar(spark, sf):
    """Weekdays of the period the events cover, with their cutoffs as UTC wall-clock time.

    The period ends four days after the last event, so that every event has a cutoff after it.
    """
    day = F.to_date("ts")
    span = F.sequence(F.min(day), F.date_add(F.max(day), 4))
    every = panels.table(spark, sf, "events").agg(span.alias("days"))
    every = every.select(F.explode("days").alias("trade_date"))
    days = calendar_of(xc.open_days(every), "trade_date")
    return days.withColumn("cutoff", xc.cutoff_utc(F.col("date")))


CUTS = """cuts AS (SELECT d::DATE AS date, row_number() OVER (ORDER BY d) - 1 AS day_idx,
  CAST(timezone('UTC', timezone('America/New_York', d + INTERVAL 18 HOUR)) AS TIMESTAMP) AS cutoff
  FROM (SELECT unnest(generate_series(CAST(CAST(min(ts) AS DATE) AS TIMESTAMP), CAST(CAST(max(ts) AS DATE) + 4 AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM events)
  WHERE dayofweek(d) NOT IN (0, 6))"""


@query(
    "C07_point_in_time",
    f"""WITH {CUTS}, facts AS (SELECT user_id AS key, ts, event_id AS seq, value, event_type AS form FROM events),
    k AS (SELECT DISTINCT key FROM facts), m AS (SELECT k.key, c.date, arg_max(f.seq, (f.ts, f.seq)) AS seq
      FROM k CROSS JOIN cuts c JOIN facts f ON f.key = k.key AND f.ts <= c.cutoff GROUP BY 1, 2)
    SELECT m.key, m.date, m.seq, {r('value', 'value')}, form FROM m JOIN facts USING (seq)""",
)
def _c07(spark, sf):
    facts = panels.event_facts(spark, sf)
    rows = pit.point_in_time(
        facts, cutoff_calendar(spark, sf), "key", "accepted_ts", ["seq", "value", "form"], "seq"
    )
    return rounded(rows)


@query(
    "C07_vintages",
    f"""WITH {CUTS}, s AS (SELECT user_id AS series, CAST(ts AS DATE) - CAST(event_id % 5 AS INTEGER) AS observed, CAST(ts AS DATE) AS vintage, ts, value FROM events),
    m AS (SELECT k.series, c.date, max((s.observed, s.vintage, s.ts, s.value)) AS v
      FROM (SELECT DISTINCT series FROM s) k CROSS JOIN cuts c JOIN s ON s.series = k.series AND s.ts <= c.cutoff GROUP BY 1, 2)
    SELECT series, date, v[1] AS observed, v[2] AS vintage_date, {r('v[4]', 'value')} FROM m""",
)
def _c07_vintages(spark, sf):
    """Events as values of a series that are observed up to four days before their release."""
    events = panels.table(spark, sf, "events")
    day = F.to_date("ts")
    series = events.select(
        F.col("user_id").alias("series"),
        F.date_sub(day, (F.col("event_id") % 5).cast("int")).alias("date"),
        day.alias("vintage_date"),
        F.col("ts").alias("release_ts"),
        "value",
    )
    return rounded(pit.known_vintages(series, cutoff_calendar(spark, sf), "series"))


@query(
    "C07_asof_join",
    f"""WITH l AS (SELECT user_id AS key, ts, event_id FROM events),
    f AS (SELECT user_id AS key, ts, event_id AS seq, value FROM events WHERE event_type = (SELECT min(event_type) FROM events)),
    u AS (SELECT key, ts, arg_max(seq, seq) AS seq, arg_max(value, seq) AS value FROM f GROUP BY 1, 2)
    SELECT l.key, l.ts, l.event_id, coalesce(u.seq, -1) AS fact_id, {r('u.value', 'value')}
    FROM l ASOF LEFT JOIN u ON l.key = u.key AND l.ts >= u.ts""",
)
def _c07_asof(spark, sf):
    facts = panels.event_facts(spark, sf).withColumnRenamed("accepted_ts", "ts")
    kind = facts.agg(F.min("form")).scalar()
    right = facts.filter(F.col("form") == kind).select("key", "ts", "seq", F.col("seq").alias("fact_id"), "value")
    left = facts.select("key", "ts", F.col("seq").alias("event_id"))
    rows = pit.asof_join(left, right, "key", "ts", ["fact_id", "value"], "seq")
    return rounded(rows.fillna(-1, ["fact_id"]))


@query(
    "C08_resolve_dates",
    """WITH p AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem),
    q AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS requested FROM orders)
    SELECT requested, p.date FROM q ASOF JOIN p ON q.requested >= p.date""",
)
def _c08(spark, sf):
    lines = panels.table(spark, sf, "lineitem")
    orders = panels.table(spark, sf, "orders")
    panel = lines.select(F.col("l_shipdate").cast("date").alias("date"))
    asked = orders.select(F.col("o_orderdate").cast("date").alias("requested"))
    return pit.resolve_dates(asked, panel)


FORMS = {"annual": "purchase", "quarterly": "click"}


@query(
    "F26_filing_features",
    f"""WITH {CUTS}, facts AS (SELECT user_id AS key, ts, event_type AS form FROM events),
    known AS (SELECT key, form, CAST(ts AS DATE) AS filed, (SELECT min(date) FROM cuts WHERE cutoff >= ts) AS date FROM facts),
    first AS (SELECT key, min(date) AS d0 FROM known WHERE date IS NOT NULL GROUP BY 1),
    g AS (SELECT key, c.date FROM first JOIN cuts c ON c.date >= d0)
    SELECT g.key, g.date,
      coalesce(date_diff('day', max(filed) FILTER (form = 'purchase'), g.date), -1) AS days_since_annual,
      coalesce(date_diff('day', max(filed) FILTER (form = 'click'), g.date), -1) AS days_since_quarterly,
      count(*) FILTER (k.date > g.date - 365) AS filings_365d
    FROM g JOIN known k ON k.key = g.key AND k.date <= g.date GROUP BY 1, 2""",
)
def _f26(spark, sf):
    facts = panels.event_facts(spark, sf)
    rows = pit.filing_features(facts, cutoff_calendar(spark, sf), "key", "accepted_ts", FORMS)
    return rounded(rows.fillna(-1, ["days_since_annual", "days_since_quarterly"]))


GROUPS = {
    "returns": ["ret_1", "ret_5", "ret_20", "ret_60", "ret_120"],
    "risk": ["vol_5", "vol_20", "vol_60", "vol_120"],
    "liquidity": ["dollar_vol_20", "dollar_vol_60", "amihud_20"],
}
CORE = ["ret_1", "ret_20", "vol_20"]


def _any_null(columns):
    return "(" + " OR ".join(f"{c} IS NULL" for c in columns) + ")"


@query(
    "F27_missing_flags",
    f"""WITH {FEATURES_CTE} SELECT asof_date, ticker,
    {', '.join(f'{_any_null(c)} AS missing_{n}' for n, c in GROUPS.items())} FROM feats""",
)
def _f27(spark, sf):
    table = coverage.missing_flags(af.asset_features(p2(spark, sf)), GROUPS)
    return table.select("asof_date", "ticker", *[f"missing_{n}" for n in GROUPS])


@query(
    "F27_day_coverage",
    f"""WITH {FEATURES_CTE}, n AS (SELECT count(DISTINCT ticker) AS n FROM feats),
    c AS (SELECT asof_date, count(*) FILTER (NOT {_any_null(CORE)}) AS n_complete FROM feats GROUP BY 1)
    SELECT asof_date, n_complete, {r('n_complete / n', 'coverage')}, n_complete / n >= 0.8 AS accepted FROM c, n""",
)
def _f27_days(spark, sf):
    return rounded(coverage.day_coverage(af.asset_features(p2(spark, sf)), CORE))


# --- calendar -------------------------------------------------------------------------
@query(
    "H09_calendar_schedule",
    f"""WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem),
    hol AS (SELECT day FROM d WHERE day(day) = 1),
    t AS (SELECT day AS trade_date FROM d WHERE dayofweek(day) NOT IN (0, 6) AND day NOT IN (SELECT day FROM hol))
    SELECT trade_date, lag(trade_date) OVER w AS previous_date, lead(trade_date) OVER w AS next_date,
      CAST(timezone('UTC', timezone('America/New_York', CAST(trade_date AS TIMESTAMP) + INTERVAL 18 HOUR)) AS TIMESTAMP) AS cutoff
    FROM t WINDOW w AS (ORDER BY trade_date)""",
)
def _h09(spark, sf):
    """Trading days among the ship dates; the first of a month plays the holiday."""
    days = panels.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("trade_date")
    ).distinct()
    holidays = days.filter(F.dayofmonth("trade_date") == 1).select(
        F.col("trade_date").alias("holiday")
    )
    open_days = xc.open_days(days, holidays)
    return xc.neighbours(open_days).withColumn("cutoff", xc.cutoff_utc(F.col("trade_date")))

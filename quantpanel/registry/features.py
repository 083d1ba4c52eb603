"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantpanel.config import FeatureConfig
from quantpanel.functions.storage import materialise
from quantpanel.operators import asset_features as af
from quantpanel.operators import cross_features as cf
from quantpanel.operators import market_features as mf
from quantpanel.operators.grid import calendar_of, with_dates
from quantpanel.operators.rolling import rolling
from quantpanel.registry.base import P1, P2, frame, full, grid, query, r, rets, rounded
from quantpanel.sources import panels

CFG = FeatureConfig()
KEYS = ["date", "ticker"]
WT = "(PARTITION BY ticker ORDER BY date)"


def p2(spark, sf):
    return panels.prices_by_supplier(spark, sf)


def stored_p2(spark, sf, *columns):
    """The supplier panel as a stage table, for queries that read it more than once."""
    return materialise(p2(spark, sf).select("date", "ticker", *columns))


def p1(spark, sf):
    return panels.prices_by_type(spark, sf)


def features(rows, columns, digits=6, **special):
    named = [c.alias(n) for n, c in columns.items()]
    return rounded(rows.select(*KEYS, *named), digits, **special)


# --- SQL of each feature family over a table with simple_ret, log_ret -----------------
def chg(k):
    return f"adj_close / lag(adj_close, {k}) OVER {WT} - 1"


RET_SQL = {f"ret_{w}": chg(w) for w in (1, 5, 20, 60, 120)}
VOL_SQL = {
    f"vol_{w}": full(w, "log_ret", "stddev_samp(log_ret) OVER {w} * sqrt(252.0)")
    for w in (5, 20, 60, 120)
}
DOWN_SQL = {
    f"downvol_{w}": full(w, "neg_ret", "stddev_samp(neg_ret) OVER {w} * sqrt(252.0)")
    for w in (20, 60)
}
DD_SQL = {
    f"dd_{w}": full(w, "adj_close", "adj_close / max(adj_close) OVER {w} - 1") for w in (20, 60, 120)
}
MOM_SQL = {f"mom_{w}": chg(w) for w in (20, 60, 120)} | {"rev_5": f"-({chg(5)})"}
LIQ_SQL = {
    f"dollar_vol_{w}": full(w, "dollar_volume", "avg(dollar_volume) OVER {w}") for w in (20, 60)
}
AMI_SQL = {"amihud_20": full(20, "amihud", "avg(amihud) OVER {w}")}
Z_SQL = {
    f"{n}_zscore_20": full(
        20, c, f"({c} - avg({c}) OVER {{w}}) / greatest(stddev_samp({c}) OVER {{w}}, 1.0)"
    )
    for n, c in (("volume", "volume"), ("dollar_vol", "dollar_volume"))
}
DAILY = f"""{P2}, {rets('p2')}, daily AS (SELECT *,
  CASE WHEN log_ret < 0 THEN log_ret ELSE 0.0 END AS neg_ret,
  abs(simple_ret) / greatest(dollar_volume, 1.0) AS amihud FROM rets)"""


def feature_sql(columns: dict[str, str], digits: int = 6) -> str:
    body = ", ".join(r(e, n, digits) for n, e in columns.items())
    return f"WITH {DAILY} SELECT date, ticker, {body} FROM daily"


@query(
    "F01_returns_rowlag",
    f"WITH {P2}, {rets('p2')} SELECT date, ticker, {r('simple_ret', 'simple_ret')}, {r('log_ret', 'log_ret')} FROM rets",
)
def _f01(spark, sf):
    return rounded(af.returns_rowlag(p2(spark, sf)).select(*KEYS, "simple_ret", "log_ret"))


@query("F02_ret_windows", feature_sql(RET_SQL))
def _f02(spark, sf):
    return features(p2(spark, sf), af.return_features(CFG))


@query("F03_vol_windows", feature_sql(VOL_SQL))
def _f03(spark, sf):
    rows = rolling(af.with_daily(p2(spark, sf)), af.vol_rolling(CFG))
    return features(rows, af.vol_features(CFG))


@query("F04_downvol_windows", feature_sql(DOWN_SQL))
def _f04(spark, sf):
    rows = rolling(af.with_daily(p2(spark, sf)), af.downvol_rolling(CFG))
    return features(rows, af.downvol_features(CFG))


@query("F05_drawdown_windows", feature_sql(DD_SQL))
def _f05(spark, sf):
    return features(rolling(p2(spark, sf), af.drawdown_rolling(CFG)), af.drawdown_features(CFG))


@query("F06_momentum_reversal", feature_sql(MOM_SQL))
def _f06(spark, sf):
    return features(p2(spark, sf), af.momentum_features(CFG))


@query("F07_dollar_volume", feature_sql(LIQ_SQL, 4))
def _f07(spark, sf):
    return features(rolling(p2(spark, sf), af.liquidity_rolling(CFG)), af.liquidity_features(CFG), 4)


@query("F08_amihud", feature_sql(AMI_SQL, 15))
def _f08(spark, sf):
    rows = rolling(af.with_daily(p2(spark, sf)), af.AMIHUD_ROLLING)
    return features(rows, af.amihud_feature(), 15)


@query("F09_volume_zscores", feature_sql(Z_SQL))
def _f09(spark, sf):
    return features(rolling(p2(spark, sf), af.ZSCORE_ROLLING), af.zscore_features())


ALL_SQL = {
    **RET_SQL, **VOL_SQL, **DOWN_SQL, **DD_SQL, **MOM_SQL, **LIQ_SQL, **AMI_SQL, **Z_SQL,
}
SPECIAL = {"amihud_20": 15, "dollar_vol_20": 4, "dollar_vol_60": 4}
STATE = ("prev_live_weight", "prev_target_weight", "delta_from_prev_target")
FEATURES_CTE = f"""{DAILY}, feats AS (SELECT date AS asof_date, ticker,
  {', '.join(f'{e} AS {n}' for n, e in ALL_SQL.items())} FROM daily)"""
_missing = " + ".join(f"CAST({n} IS NULL AS BIGINT)" for n in ALL_SQL)
F10_SQL = f"""WITH {FEATURES_CTE} SELECT asof_date, ticker,
  {', '.join(r(n, n, SPECIAL.get(n, 6)) for n in ALL_SQL)},
  {', '.join(f'CAST(NULL AS DOUBLE) AS {s}' for s in STATE)},
  {_missing} AS missing_feature_count, {_missing} + 3 AS missing_feature_count_with_state FROM feats"""


@query("F10_asset_features", F10_SQL)
def _f10(spark, sf):
    return rounded(af.asset_features(p2(spark, sf)), **SPECIAL)


def _beta_sql():
    pair = "CASE WHEN simple_ret IS NOT NULL THEN eqw_ret END"
    cov = "covar_samp(simple_ret, m) OVER {w}"
    cols = {
        f"beta_eqw_{w}": full(w, "simple_ret", cov + " / greatest(var_samp(m) OVER {w}, 1e-10)")
        for w in (60, 120)
    }
    ratio = f"{cov} / nullif(stddev_samp(simple_ret) OVER {{w}} * stddev_samp(m) OVER {{w}}, 0)"
    for w in (20, 60):
        cols[f"corr_eqw_{w}"] = full(w, "simple_ret", ratio)
    base = f"""{P2}, {rets('p2')}, eqw AS (SELECT date, avg(simple_ret) AS eqw_ret FROM rets GROUP BY 1),
  rows AS (SELECT date, ticker, simple_ret, {pair} AS m FROM rets JOIN eqw USING (date))"""
    return base, cols


_BETA_BASE, _BETA = _beta_sql()


def _beta_select(names):
    return f"""WITH {_BETA_BASE} SELECT date AS asof_date, ticker,
      {', '.join(r(_BETA[n], n) for n in names)} FROM rows"""


@query("F11_beta_eqw", _beta_select(["beta_eqw_60", "beta_eqw_120"]))
def _f11(spark, sf):
    table = af.market_beta_corr(p2(spark, sf))
    return rounded(table.select("asof_date", "ticker", "beta_eqw_60", "beta_eqw_120"))


@query("F12_corr_eqw", _beta_select(["corr_eqw_20", "corr_eqw_60"]))
def _f12(spark, sf):
    table = af.market_beta_corr(p2(spark, sf))
    return rounded(table.select("asof_date", "ticker", "corr_eqw_20", "corr_eqw_60"))


@query(
    "F13_idio_vol",
    f"""WITH {_BETA_BASE}, c AS (SELECT date, ticker, {_BETA['corr_eqw_60']} AS corr,
      {full(60, 'simple_ret', 'var_samp(simple_ret) OVER {w}')} AS v FROM rows)
    SELECT date AS asof_date, ticker,
      {r('sqrt(CASE WHEN (1-corr*corr)*v < 0 THEN 0 ELSE (1-corr*corr)*v END)*sqrt(252.0)', 'idio_vol_60')} FROM c""",
)
def _f13(spark, sf):
    return rounded(af.market_beta_corr(p2(spark, sf)).select("asof_date", "ticker", "idio_vol_60"))


@query(
    "F14_dense_return_grid",
    f"WITH {P2}, {grid('p2')} SELECT date, ticker, {r('ret', 'ret')} FROM grid0",
)
def _f14(spark, sf):
    prices = stored_p2(spark, sf, "adj_close")
    calendar = calendar_of(prices)
    rows = with_dates(cf.return_grid(prices, calendar), calendar)
    return rounded(rows.select("date", "ticker", "ret"))


@query(
    "F15_universe_return",
    f"""WITH {P2}, {rets('p2')} SELECT date AS asof_date,
    {r('avg(simple_ret)', 'eqw_universe_ret')} FROM rets GROUP BY 1""",
)
def _f15(spark, sf):
    return rounded(cf.universe_return(p2(spark, sf)))


def _dated(table, calendar):
    days = calendar.select("day_idx", F.col("date").alias("asof_date"))
    return days.join(table, "day_idx", "left").drop("day_idx")


def _moments(w):
    """Window members of the dense grid, zero-filled."""
    f = frame(w, "day_idx")
    return f"""m{w} AS (SELECT * FROM (SELECT date, day_idx, ticker,
      count(ret) OVER {f} AS n_obs, avg(coalesce(ret, 0)) OVER {f} AS mu,
      stddev_pop(coalesce(ret, 0)) OVER {f} AS sd FROM grid0) WHERE n_obs > 0 AND day_idx >= {w})"""


def _pair_corr(w):
    """Plain pairwise form: correlation of every pair of tickers, then the mean."""
    f = f"(PARTITION BY a.ticker, b.ticker ORDER BY a.day_idx ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return f"""{_moments(w)},
    pairs{w} AS (SELECT a.day_idx, a.ticker AS t1, b.ticker AS t2,
      covar_pop(coalesce(a.ret, 0), coalesce(b.ret, 0)) OVER {f} AS c
      FROM grid0 a JOIN grid0 b ON a.day_idx = b.day_idx AND a.ticker < b.ticker),
    corr{w} AS (SELECT p.day_idx, avg(c / (x.sd * y.sd)) AS avg_pairwise_corr_{w}
      FROM pairs{w} p JOIN m{w} x ON x.day_idx = p.day_idx AND x.ticker = t1 AND x.sd > 1e-12
      JOIN m{w} y ON y.day_idx = p.day_idx AND y.ticker = t2 AND y.sd > 1e-12 GROUP BY 1)"""


@query(
    "F16_avg_pairwise_corr",
    f"""WITH {P1}, {grid('p1')}, {_pair_corr(20)}, {_pair_corr(60)}
    SELECT date AS asof_date, {r('avg_pairwise_corr_20', 'avg_pairwise_corr_20')},
    {r('avg_pairwise_corr_60', 'avg_pairwise_corr_60')}
    FROM cal LEFT JOIN corr20 USING (day_idx) LEFT JOIN corr60 USING (day_idx)""",
)
def _f16(spark, sf):
    prices = p1(spark, sf)
    calendar = calendar_of(prices)
    rows = cf.return_grid(prices, calendar)
    table = mf.outer_join_blocks([cf.correlation_and_vol(rows, w) for w in (20, 60)], "day_idx")
    return rounded(
        _dated(table, calendar).select("asof_date", "avg_pairwise_corr_20", "avg_pairwise_corr_60")
    )


@query(
    "F16_avg_pairwise_corr_wide",
    f"""WITH {P2}, {grid('p2')}, {_moments(20)},
    z AS (SELECT m.day_idx, g.day_idx AS obs, sum((coalesce(g.ret, 0) - mu) / sd) AS s, count(*) AS n
      FROM m20 m JOIN grid0 g ON g.ticker = m.ticker AND g.day_idx BETWEEN m.day_idx - 19 AND m.day_idx
      WHERE m.sd > 1e-12 GROUP BY 1, 2),
    c AS (SELECT day_idx, (sum(s*s)/20 - max(n)) / (max(n) * (max(n) - 1)) AS avg_pairwise_corr_20 FROM z GROUP BY 1)
    SELECT date AS asof_date, {r('avg_pairwise_corr_20', 'avg_pairwise_corr_20')}
    FROM cal LEFT JOIN c USING (day_idx)""",
)
def _f16_wide(spark, sf):
    prices = stored_p2(spark, sf, "adj_close")
    calendar = calendar_of(prices)
    table = cf.correlation_and_vol(cf.return_grid(prices, calendar), 20)
    return rounded(_dated(table, calendar).select("asof_date", "avg_pairwise_corr_20"))


def _avg_vol(w):
    return f"""v{w} AS (SELECT day_idx, CASE WHEN count(*) >= 2 THEN avg(sd * sqrt(252.0)) END AS avg_vol_{w}
      FROM m{w} GROUP BY 1)"""


@query(
    "F17_avg_vol",
    f"""WITH {P2}, {grid('p2')}, {_moments(20)}, {_moments(60)}, {_avg_vol(20)}, {_avg_vol(60)}
    SELECT date AS asof_date, {r('avg_vol_20', 'avg_vol_20')}, {r('avg_vol_60', 'avg_vol_60')}
    FROM cal LEFT JOIN v20 USING (day_idx) LEFT JOIN v60 USING (day_idx)""",
)
def _f17(spark, sf):
    prices = stored_p2(spark, sf, "adj_close")
    calendar = calendar_of(prices)
    rows = cf.return_grid(prices, calendar)
    blocks = [
        cf.correlation_and_vol(rows, w).select("day_idx", f"avg_vol_{w}") for w in (20, 60)
    ]
    return rounded(_dated(mf.outer_join_blocks(blocks, "day_idx"), calendar))


@query("F18_pca_ratios")
def _f18(spark, sf):
    prices = stored_p2(spark, sf, "adj_close")
    calendar = calendar_of(prices)
    rows = cf.observed_returns(prices, calendar)
    blocks = [cf.pca_ratios(rows, w) for w in (20, 60)]
    return rounded(_dated(mf.outer_join_blocks(blocks, "day_idx"), calendar))


@query(
    "F19_breadth",
    f"""WITH {P2}, {grid('p2')}, c AS (SELECT day_idx, ticker,
      coalesce(product(1 + ret) OVER {frame(20, 'day_idx')}, 1.0) - 1 AS cum FROM grid0),
    k AS (SELECT *, row_number() OVER (PARTITION BY day_idx ORDER BY cum DESC, ticker) AS rn,
      count(*) OVER (PARTITION BY day_idx) AS n FROM c WHERE day_idx >= 20),
    b AS (SELECT day_idx, avg(cum) FILTER (rn <= greatest(1, n // 4)) AS top,
      avg(cum) FILTER (rn > n - greatest(1, n // 4)) AS bottom FROM k GROUP BY day_idx HAVING max(n) >= 4)
    SELECT date AS asof_date, {r('top', 'breadth_top_quartile_20')},
      {r('bottom', 'breadth_bottom_quartile_20')}, {r('top - bottom', 'breadth_spread_20')}
    FROM cal LEFT JOIN b USING (day_idx)""",
)
def _f19(spark, sf):
    prices = stored_p2(spark, sf, "adj_close")
    calendar = calendar_of(prices)
    return rounded(_dated(cf.breadth(cf.return_grid(prices, calendar)), calendar))


@query("F20_cross_asset_features")
def _f20(spark, sf):
    return rounded(cf.cross_asset_features(p2(spark, sf)))


@query("F28_pca_loadings")
def _f28(spark, sf):
    prices = p1(spark, sf)
    calendar = calendar_of(prices)
    observed = cf.observed_returns(prices, calendar)
    loadings = cf.pca_loadings(observed, 20)
    days = calendar.select("day_idx", F.col("date").alias("asof_date"))
    return rounded(loadings.join(days, "day_idx").drop("day_idx"))
